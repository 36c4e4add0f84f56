"""The driver contract: entry() smoke run and every query against its oracle."""

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import compare, duck

SMOKE = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()
OWN = entry.QUERIES


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["snapshot_date", "total_revenue", "total_orders", "total_transactions"]


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(OWN) <= set(ORACLE)  # every query of the reference's kind has SQL


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, con, name):
    problem = compare(QUERIES[name](spark, SMOKE), con, ORACLE[name])
    assert problem is None, problem


@pytest.mark.parametrize("name", ["silver_orders", "bike_gold", "checkpoint_after_run", "checkpoint_lag"])
def test_results_do_not_depend_on_the_session_time_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        problem = compare(QUERIES[name](spark, SMOKE), con, ORACLE[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert problem is None, problem


def test_other_queries_stay_when_a_dependency_of_the_operators_is_absent():
    """Run apart: importing the entry without the tokenizer files' package."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys, warnings; warnings.simplefilter('ignore'); sys.modules['public_tokenizers'] = None\n"
        f"sys.path.insert(0, {root!r}); import __spark_entry__ as e\n"
        "print(len(e.queries()), len(e.oracle_sql()), sum(n.startswith('op') for n in e.queries()))"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd="/", timeout=120)
    assert out.stdout.split() == [str(len(OWN)), str(len(OWN)), "0"], out.stderr
