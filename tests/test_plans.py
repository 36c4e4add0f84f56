"""Plan checks: pushdown, pruning, no cartesian products, bounded broadcasts."""

import datetime as dt

from strata.plans import incremental as inc
from strata.registry import QUERIES
from strata.session import cluster_conf

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_mark_filter_reaches_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "feed")
    spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 2, 1))], "id int, updated_at timestamp_ntz"
    ).write.parquet(path)
    batch = inc.newer_than(spark.read.parquet(path), dt.datetime(2024, 1, 15))
    plan = _plan(batch)
    assert "PushedFilters: [IsNotNull(updated_at), GreaterThan(updated_at," in plan
    assert [r.id for r in batch.collect()] == [2]


def test_scans_read_only_needed_columns():
    from strata.session import get_session

    spark = get_session()
    plan = _plan(QUERIES["gold_total_revenue"](spark, SF))
    lineitem = [line for line in plan.splitlines() if "lineitem.parquet" in line][0]
    assert "l_suppkey" not in lineitem and "l_tax" not in lineitem and "l_linestatus" not in lineitem


def test_no_cartesian_products_anywhere(spark):
    for name in ("gold_total_revenue", "gold_top_customers", "gold_return_rate", "bike_gold", "audit_gold"):
        assert "CartesianProduct" not in _plan(QUERIES[name](spark, SF)), name
        assert "BroadcastNestedLoopJoin" not in _plan(QUERIES[name](spark, SF)), name


def test_top_datasets_use_take_ordered(spark):
    for name in ("ds_top_products", "ds_top_customers"):
        assert "TakeOrderedAndProject" in _plan(QUERIES[name](spark, SF)), name


def test_cluster_conf_scales_with_input():
    small, big = cluster_conf(1 << 30), cluster_conf(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
