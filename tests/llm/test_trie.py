"""Conversation prefix trie against a plain version."""

import hashlib
import zlib

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import conv_trie
from strata.llm.queries import ORACLE, QUERIES

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """All nodes of ``rows`` (conv_id, turn, role, text) by walking dictionaries."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    members = {}
    ends = {}
    for c in own:
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        h = zlib.crc32(str(c).encode()) % 6
        seq = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    children = {}
    for seq in members:
        if seq:
            children.setdefault(seq[:-1], []).append(seq)

    def subtree(top):
        stack = [top]
        while stack:
            node = stack.pop()
            yield node
            stack += children.get(node, [])

    out = []
    for seq, own_members in members.items():
        below = list(subtree(seq))
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ids = ",".join(map(str, sorted(ends.get(seq, []))))
        out.append(
            (
                min(own_members),
                len(seq),
                min(members[seq[:-1]]) if seq else None,
                len(own_members),
                len(children.get(seq, [])),
                sum(n not in children for n in below),
                saved,
                hashlib.sha256(ids.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def found(df):
    numbered = conv_trie.turns(df)
    nodes = conv_trie.with_digests(conv_trie.collapse(conv_trie.rebuild(numbered)))
    return sorted((tuple(r) for r in nodes.select(*COLUMNS).collect()), key=str)


def test_given_conversations(spark):
    data = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = QUERIES["op12_conversation_trie"](spark, data)
    assert out.columns == COLUMNS
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain(rows)


def odd_rows():
    """Nulls, copies, prefixes, ties, repeated rows, absent bases, negative ids, one long conversation."""
    rows = [(None, 0, "user", "no conversation"), (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", "a"), (1, 0, "user", "a")]
    for c in [0, 2, 3, 4, 5, 6, 7, 8, 100, 101, 102, 250, 251, -3, -100, -101]:
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"text {t}") for t in range(abs(c) % 9)]
    rows += [(300 + c, t, "user", f"same {t}") for c in range(60) for t in range(8)]  # copies
    rows += [(7000, t, "user", f"long {t % 3} " + "é🙂" * (t % 5)) for t in range(900)]  # a third of all rows
    rows += [(400, t, "user", "s") for t in range(2)] + [(400, None, None, "x" * 20_000), (9, 1, "user", "user")]
    return rows


@pytest.mark.parametrize("per_part", [conv_trie.ROWS, 7])
def test_odd_conversations(spark, monkeypatch, per_part):
    monkeypatch.setattr(conv_trie, "ROWS", per_part)
    monkeypatch.setattr(conv_trie, "IDS", 10)
    names = "pos part rep len k k0 k1 pid mid h m base digest chars weight".split()
    df = spark.createDataFrame(odd_rows(), "conv_id long, turn long, role string, text string").repartition(5)
    df = df.withColumns({n: F.lit("clash") for n in names})
    assert found(df) == plain(odd_rows())


def test_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert found(empty) == []
    assert found(spark.createDataFrame([(None, 1, "user", "x")], empty.schema)) == []


def test_sql_on_odd_conversations():
    """The SQL of the query against the plain version."""
    con = duckdb.connect()
    names = ["conv_id", "turn", "role", "text"]
    table = pa.table(dict(zip(names, zip(*odd_rows()))), pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
    con.register("conversations", table)
    found_rows = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE['op12_conversation_trie']})").fetchall()
    assert sorted(found_rows, key=str) == plain(odd_rows())
