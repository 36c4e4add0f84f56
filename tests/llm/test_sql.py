"""Queries that SQL can express, against DuckDB."""

import pytest

from strata.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SMALL
from tests.oracle_compare import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, SMALL), duck(SMALL), ORACLE[name]) is None


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))


def test_frequent_lines_and_chunks_match_sql(spark, tmp_path):
    """A table on which the limits bite: shared lines, copies, two hosts."""
    rows = []
    for i in range(120):
        own = [f"word{i} only in this text number {i} and a few more words" for _ in range(1)]
        shared = ["Shared  LINE of a host", "another shared line of it"] if i % 2 else []
        body = "\n".join([*shared, *own, *(["tail one", f"tail {i % 3}", "tail three of them"] if i % 5 == 0 else [])])
        rows.append((i, body if i != 17 else None, "en", "h1" if i < 90 else "h2", len(body)))
    rows.append((500, rows[1][1], "en", "h1", 1))
    for i in range(600, 640):  # depleted: little beside the frequent lines
        rows.append((i, f"Shared LINE of a host\nanother shared line of it\nalone{i} " + "and " * 3, "en", "h1", 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(1).write.parquet(f"{tmp_path}/all")
    docs = spark.read.parquet(f"{tmp_path}/all")
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/all/*.parquet')")
    from strata.llm import chunk_dedup, line_frequency

    judged = line_frequency.judge(docs)
    assert judged.filter("NOT base_failed AND NOT kept").count() > 0
    assert compare(judged, con, ORACLE["op3_line_frequency"]) is None
    cleaned = chunk_dedup.dedup(docs.select("doc_id", "text"), removed="n_removed_chunks")
    assert cleaned.filter("n_removed_chunks > 0").count() > 0
    assert compare(cleaned, con, ORACLE["op8_line_chunks"]) is None
    # clean() keeps what judge() keeps and takes the frequent lines out.
    kept = {r.doc_id: r.text for r in line_frequency.clean(docs).collect()}
    assert set(kept) == {r.doc_id for r in judged.filter("kept").collect()}
    assert not any("shared" in t.lower() for i, t in kept.items() if i < 90)
