import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.dedupe import keep_first
from strata.operators.rank import global_row_number, moving_sums, running_sums, staged, top_k
from strata.operators.sequence import with_neighbor
from tests.conftest import order_key, rows


def test_keep_first_is_order_independent(spark):
    data = [("k1", "b", 2), ("k1", "a", 9), ("k1", None, 5), ("k2", "z", 1), ("k2", "z", 1), (None, "n", 0)]
    results = set()
    for seed in range(3):
        shuffled = data[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, "k string, s string, n int").repartition(3)
        results.add(tuple(rows(keep_first(df, ["k"]))))
    assert len(results) == 1
    # NULLs sort first; exact copies collapse; a NULL key is its own group.
    assert results.pop() == tuple(sorted([("k1", None, 5), ("k2", "z", 1), (None, "n", 0)], key=order_key))


def test_keep_first_plans_partial_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    plan = keep_first(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_global_row_number_matches_single_partition_window(spark):
    rnd = random.Random(7)
    data = [(i, rnd.choice([10.0, 20.0, 30.0, None])) for i in range(500)]
    df = spark.createDataFrame(data, "id long, v double")
    order = [F.desc("v"), F.asc("id")]
    ours = global_row_number(df, order, "r")
    ref = df.withColumn("r", F.row_number().over(Window.orderBy(*order)).cast("long"))
    assert rows(ours) == rows(ref)
    assert dict(ours.dtypes)["r"] == "bigint"
    # The rows are never gathered into one partition: the only single-partition
    # exchange is below the broadcast of the per-partition counts.
    plan = ours._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "row_number" not in plan
    assert plan.count("SinglePartition") == 1
    assert plan.index("SinglePartition") > plan.index("BroadcastExchange")


def test_global_row_number_empty_input(spark):
    df = spark.createDataFrame([], "id long, v double")
    assert global_row_number(df, ["v", "id"]).count() == 0


def test_partitions_follow_the_rows_not_the_setting(spark):
    df = spark.range(50).select("id", (F.col("id") % 3).alias("v"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    try:
        kept = staged(df, ["v", "id"])
        assert kept.rdd.getNumPartitions() == 1  # one checkpoint file for 50 rows
        assert rows(global_row_number(df, ["v", "id"], "r"), "r") == [(i,) for i in range(1, 51)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def many_partitions(spark):
    """Range partitions of a few rows, so that edges between them count."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_neighbors_with_a_hot_key(spark, many_partitions):
    rnd = random.Random(3)
    # key "hot" holds most rows; ties in t are broken by id.
    data = [("hot" if rnd.random() < 0.7 else f"k{rnd.randint(0, 5)}", rnd.randint(0, 20), i) for i in range(400)]
    data.append((None, 1, 1000))
    df = spark.createDataFrame(data, "k string, t int, id int")
    w = Window.partitionBy("k").orderBy("t", "id")
    for side, step in (("prev", F.lag), ("next", F.lead)):
        ours = with_neighbor(df, ["k"], ["t", "id"], ["id", "t"], side)
        plain = [step("id").over(w).alias(f"{side}_id"), step("t").over(w).alias(f"{side}_t")]
        assert rows(ours) == rows(df.select("*", *plain, step("id").over(w).isNotNull().alias(f"{side}_exists")))
    nxt = {r.id: r.next_id for r in with_neighbor(df, ["k"], ["t", "id"], ["id"]).collect()}
    hot = sorted((t, i) for k, t, i in data if k == "hot")
    assert all(nxt[a[1]] == b[1] for a, b in zip(hot, hot[1:]))
    assert nxt[hot[-1][1]] is None and nxt[1000] is None


def test_top_k_uses_take_ordered(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 10).alias("v"))
    out = top_k(df, [F.desc("v"), F.asc("id")], 3, "r")
    assert rows(out, "id", "r") == [(9, 1), (19, 2), (29, 3)]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_running_and_moving_sums(spark, many_partitions):
    from decimal import Decimal

    rnd = random.Random(11)
    data = [(i, Decimal(rnd.randint(0, 10000)) / 100, rnd.randint(0, 9)) for i in range(300)]
    df = spark.createDataFrame(data, "d int, amount decimal(18,2), n bigint")
    cum = {r.d: (r.cum_amount, r.cum_n) for r in running_sums(df, ["d"], ["amount", "n"]).collect()}
    # Partitions hold about 8 rows: windows of 7 and 30 reach over one and several.
    for width in (7, 30):
        moving = {r.d: (r.moving_amount, r.moving_n) for r in moving_sums(df, ["d"], ["amount", "n"], width).collect()}
        for i in range(300):
            assert cum[i] == (sum(a for _, a, _ in data[: i + 1]), sum(n for _, _, n in data[: i + 1]))
            last = data[max(0, i - width + 1) : i + 1]
            assert moving[i] == (sum(a for _, a, _ in last), sum(n for _, _, n in last))
