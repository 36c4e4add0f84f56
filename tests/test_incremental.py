import datetime as dt

from pyspark.sql import functions as F

from strata.functions import quality as q
from strata.plans import incremental as inc
from strata.sources.lake import scratch_lake
from tests.conftest import rows

SRC = (
    "customer_id string, first_name string, last_name string, email string, address string, city string, "
    "state string, country string, gender string, loyalty_tier string, updated_at timestamp_ntz"
)
T = [dt.datetime(2024, 1, d) for d in range(1, 10)]


def _row(cid, tier, ts, last="L"):
    return (cid, " F ", last, " X@Y.IO ", "", "C", "S", "K", "m", tier, ts)


def test_first_run_default_mark_and_strict_filter(spark):
    cps = inc.seed_checkpoints(inc.empty(spark, inc.CHECKPOINT), ["src"], T[0])
    assert inc.read_mark(cps, "src") == q.DEFAULT_MARK
    assert inc.read_mark(cps, "unknown") == q.DEFAULT_MARK
    # Seeding again adds nothing.
    assert inc.seed_checkpoints(cps, ["src"], T[1]).count() == 1
    src = spark.createDataFrame([(1, T[1]), (2, T[2])], "id int, updated_at timestamp_ntz")
    assert [r.id for r in inc.newer_than(src, T[1]).collect()] == [2]  # a row at the mark is not re-read


def test_empty_batch_keeps_mark(spark):
    cps = inc.seed_checkpoints(inc.empty(spark, inc.CHECKPOINT), ["src"], T[0])
    batch = spark.createDataFrame([], "id int, updated_at timestamp_ntz")
    assert rows(inc.record_progress(cps, "src", batch, T[3])) == rows(cps)


def test_incremental_batches_equal_one_full_batch(spark):
    feed = spark.createDataFrame(
        [
            _row("CUST_1", "Gold", T[0]),
            _row("CUST_2", "Gold", T[0]),
            _row("X_3", "Gold", T[0]),  # dropped by the id rule, still advances the mark
            _row("CUST_1", "Plat", T[3]),  # tracked change
            _row("CUST_2", "Gold", T[3], last="New"),  # untracked change
            _row("CUST_4", "Gold", T[5]),
        ],
        SRC,
    )

    def arrived(at):
        return feed.filter(F.col("updated_at") <= F.lit(at).cast("timestamp_ntz"))

    state = inc.initial_customers(spark, T[0])
    for at in (T[1], T[4], T[6]):
        state = inc.run_customers(arrived(at), state, at)
    one = inc.run_customers(arrived(T[6]), inc.initial_customers(spark, T[0]), T[6])
    assert rows(state.scd1) == rows(one.scd1)
    assert rows(state.scd2) == rows(one.scd2)
    mark = rows(state.checkpoints, "table_name", "last_processed_timestamp", "records_processed")
    assert mark == [("bronze_customers", T[5], 1)]
    scd1 = {r.customer_id: r for r in state.scd1.collect()}
    assert scd1["CUST_1"].loyalty_tier == "Plat" and scd1["CUST_2"].last_name == "New"
    assert scd1["CUST_1"].email == "x@y.io" and scd1["CUST_1"].is_valid_email is True
    current = {r.customer_id: r.loyalty_tier for r in state.scd2.filter("is_current").collect()}
    assert current == {"CUST_1": "Plat", "CUST_2": "Gold", "CUST_4": "Gold"}
    assert state.scd2.count() == 4


def test_two_sources_share_the_control_table(spark):
    feed = spark.createDataFrame([_row("CUST_1", "Gold", T[0]), _row("CUST_2", "Gold", T[2])], SRC)
    cps = inc.seed_checkpoints(inc.empty(spark, inc.CHECKPOINT), ["a", "b"], T[0])
    one = inc.record_progress(cps, "a", feed, T[4])
    two = inc.record_progress(one, "b", feed.limit(1), T[4])
    three = inc.record_progress(two, "new", feed.limit(1), T[5])
    assert rows(three) == [("a", T[2], 2, T[4]), ("b", T[0], 1, T[4]), ("new", T[0], 1, T[5])]
    # A batch with no newer mark changes nothing.
    assert rows(inc.record_progress(three, "a", feed.limit(1), T[6])) == rows(three)


def test_stored_run_writes_tables_and_control_row(spark):
    lake = scratch_lake(spark, "t")
    feed = spark.createDataFrame([_row("CUST_1", "Gold", T[0]), _row("CUST_1", "Plat", T[2])], SRC)
    inc.run_customers_stored(lake, feed.filter(F.col("updated_at") <= T[1]), T[1])
    inc.run_customers_stored(lake, feed, T[3])
    assert [r.loyalty_tier for r in lake.read(inc.SCD1_TABLE).collect()] == ["Plat"]
    cp = lake.read(inc.CHECKPOINT_TABLE).collect()
    assert [(r.table_name, r.last_processed_timestamp) for r in cp] == [("bronze_customers", T[2])]
    # Re-running with nothing new keeps everything as it is.
    before = rows(inc.read_versions(lake))
    inc.run_customers_stored(lake, feed, T[4])
    assert rows(inc.read_versions(lake)) == before and rows(lake.read(inc.CHECKPOINT_TABLE)) == [tuple(r) for r in cp]


def test_a_run_repeated_after_a_crash_gives_the_same_tables(spark, monkeypatch):
    lake = scratch_lake(spark, "t")
    feed = spark.createDataFrame([_row("CUST_1", "Gold", T[0]), _row("CUST_2", "Gold", T[0]), _row("CUST_1", "Plat", T[2])], SRC)
    inc.run_customers_stored(lake, feed.filter(F.col("updated_at") <= T[1]), T[1])

    def dies(*args, **kwargs):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as m:
        m.setattr(inc, "record_progress", dies)  # tables written, control row not
        try:
            inc.run_customers_stored(lake, feed, T[3])
            raise AssertionError
        except RuntimeError:
            pass
    assert inc.read_mark(lake.read(inc.CHECKPOINT_TABLE), inc.CUSTOMERS_SOURCE) == T[0]
    more = feed.unionByName(spark.createDataFrame([_row("CUST_1", "Diam", T[4])], SRC))
    inc.run_customers_stored(lake, more, T[5])
    one = inc.run_customers(more, inc.initial_customers(spark, T[0]), T[5])
    assert rows(inc.read_versions(lake)) == rows(one.scd2)
    assert rows(lake.read(inc.SCD1_TABLE).select(*[c.name for c in inc.SCD1])) == rows(one.scd1)


TXN_SRC = (
    "transaction_id string, order_id string, product_id string, quantity int, unit_price double, "
    "discount_pct double, line_total decimal(18,2), transaction_date date, return_flag boolean, "
    "cdc_operation string, updated_at timestamp_ntz"
)


def _txn(tid, day, qty, op, ts):
    from decimal import Decimal

    return (tid, "o", "p", qty, 1.0, 0.0, Decimal(qty), day, False, op, ts)


def test_stored_cdc_rewrites_only_touched_partitions(spark):
    jan, feb, mar = dt.date(2024, 1, 5), dt.date(2024, 2, 5), dt.date(2024, 3, 5)
    feed = spark.createDataFrame(
        [
            _txn("a", jan, 1, "I", T[0]),
            _txn("b", feb, 1, "I", T[0]),
            _txn("c", mar, 1, "I", T[0]),
            _txn("d", dt.date(2023, 12, 5), 1, "I", T[0]),
            _txn("a", jan, 2, "U", T[2]),  # January changes
            _txn("b", mar, 1, "U", T[2]),  # b moves from February to March
        ],
        TXN_SRC,
    )
    lake = scratch_lake(spark, "t")

    def files():
        out = {}
        for f in lake.read(inc.CDC_TABLE).inputFiles():
            out.setdefault(f.split("txn_month=")[1].split("/")[0], set()).add(f)
        return out

    inc.run_transactions_stored(lake, feed.filter(F.col("updated_at") <= T[1]), T[1])
    before = files()
    assert sorted(before) == ["2023-12", "2024-01", "2024-02", "2024-03"]
    inc.run_transactions_stored(lake, feed, T[3])
    after = files()
    # January and March rewritten, February dropped (b left it), December not touched.
    assert sorted(after) == ["2023-12", "2024-01", "2024-03"] and after["2023-12"] == before["2023-12"]
    assert not before["2024-01"] & after["2024-01"] and not before["2024-03"] & after["2024-03"]
    got = rows(inc.read_transactions(lake), "transaction_id", "quantity", "transaction_date")
    assert got == [("a", 2, jan), ("b", 1, mar), ("c", 1, mar), ("d", 1, dt.date(2023, 12, 5))]
    # The result equals the in-memory batch runs, and a replay changes nothing.
    state = inc.run_transactions(feed, inc.initial_transactions(spark, T[0]), T[3])
    assert rows(inc.read_transactions(lake)) == rows(state.table)
    inc.run_transactions_stored(lake, feed, T[4])
    assert rows(inc.read_transactions(lake)) == rows(state.table)


def test_checkpoint_counts_cleaned_rows_and_lag_keeps_every_source(spark):
    feed = spark.createDataFrame([_row("CUST_1", "Gold", T[0]), _row("X_3", "Gold", T[3])], SRC)
    state = inc.run_customers(feed, inc.initial_customers(spark, T[0]), T[4])
    assert rows(state.checkpoints, "last_processed_timestamp", "records_processed") == [(T[3], 1)]
    ahead = feed.filter("customer_id = 'CUST_1'")
    lag = inc.checkpoint_lag(state.checkpoints, {"bronze_customers": ahead, "new": feed, "none": feed.limit(0)})
    day = 24 * 3600
    got = {r.table_name: (r.last_processed_timestamp, r.source_max_updated_at, r.lag_seconds) for r in lag.collect()}
    assert got == {"bronze_customers": (T[3], T[0], -3 * day), "new": (None, T[3], None), "none": (None, None, None)}


def test_late_row_below_the_mark_is_not_read(spark):
    state = inc.initial_customers(spark, T[0])
    first = spark.createDataFrame([_row("CUST_1", "Gold", T[3])], SRC)
    state = inc.run_customers(first, state, T[4])
    # A row stamped before the mark arrives later: strict ">" never reads it.
    late = first.unionByName(spark.createDataFrame([_row("CUST_9", "Gold", T[1])], SRC))
    state = inc.run_customers(late, state, T[5])
    assert [r.customer_id for r in state.scd1.collect()] == ["CUST_1"]
    assert rows(state.checkpoints, "table_name", "last_processed_timestamp") == [("bronze_customers", T[3])]


def test_stored_scd2_adds_closed_versions_and_rewrites_touched_buckets(spark):
    lake = scratch_lake(spark, "t")
    feed = spark.createDataFrame(
        [
            _row("CUST_1", "Gold", T[0]),
            _row("CUST_2", "Gold", T[0]),
            _row("CUST_1", "Plat", T[2]),
            _row("CUST_1", "Diam", T[4]),
        ],
        SRC,
    )
    seen = []
    for at in (T[1], T[3], T[5]):
        inc.run_customers_stored(lake, feed.filter(F.col("updated_at") <= at), at)
        seen.append(set(lake.read(inc.SCD2_TABLE).inputFiles()))
    segments = {r.segment for r in lake.read(inc.SCD2_TABLE).select("segment").distinct().collect()}
    assert segments == {"current", "closed-20240101000000000000", "closed-20240103000000000000"}
    # What a run closed is not written again, and CUST_2's bucket stays as it is.
    assert len({f for f in seen[1] if "closed" in f} - seen[2]) == 0
    bucket = lake.read(inc.SCD2_TABLE).filter("customer_id = 'CUST_2'").first().key_bucket
    own = {f for f in seen[0] if f"key_bucket={bucket}/" in f}
    assert own and own <= seen[2]
    one = inc.run_customers(feed, inc.initial_customers(spark, T[0]), T[5])
    assert rows(inc.read_versions(lake)) == rows(one.scd2)
    assert rows(lake.read(inc.SCD1_TABLE).drop("key_bucket")) == rows(one.scd1)


def test_a_feed_stored_by_day_is_opened_from_the_mark_on(spark):
    lake = scratch_lake(spark, "t")
    day = dt.date(2024, 1, 5)
    feed = spark.createDataFrame([_txn(f"k{i}", day, i, "I", T[i]) for i in range(6)], TXN_SRC)
    inc.store_feed(lake, "feed", feed.filter(F.col("updated_at") < T[4]))
    inc.store_feed(lake, "feed", feed.filter(F.col("updated_at") >= T[4]))
    batch = inc.newer_than(lake.read("feed"), T[3], day=inc.CHANGE_DAY)
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(change_day" in plan and "change_day" in plan.split("PartitionFilters")[1]
    assert rows(batch, "transaction_id") == [("k4",), ("k5",)]
    # Days before the mark are not opened: spoil their files.
    import os

    spoiled = [f for f in lake.read("feed").inputFiles() if any(f"change_day=2024-01-0{d}/" in f for d in (1, 2, 3))]
    assert len(spoiled) == 3
    for f in spoiled:
        path = f.removeprefix("file://")
        os.chmod(path, 0o644)
        with open(path, "wb") as out:
            out.write(b"not parquet")
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.replace(crc, crc + ".old")
    assert rows(inc.newer_than(lake.read("feed"), T[3], day=inc.CHANGE_DAY), "transaction_id") == [("k4",), ("k5",)]
    cps = inc.seed_checkpoints(inc.empty(spark, inc.CHECKPOINT), [inc.TRANSACTIONS_SOURCE], T[0])
    lake.overwrite(inc.CHECKPOINT_TABLE, inc.record_progress(cps, inc.TRANSACTIONS_SOURCE, feed.limit(4), T[3]))
    inc.run_transactions_stored(lake, lake.read("feed"), T[6], day=inc.CHANGE_DAY)
    assert rows(inc.read_transactions(lake), "transaction_id") == [("k4",), ("k5",)]


def test_a_stored_run_of_many_tasks_writes_few_files(spark):
    lake = scratch_lake(spark, "t")
    lines = (
        "cast(id AS string) AS transaction_id", "'o' AS order_id", "'p' AS product_id", "1 AS quantity", "1D AS unit_price",
        "0D AS discount_pct", "1BD AS line_total", "add_months(DATE'2024-01-15', cast(id % 24 AS int)) AS transaction_date",
        "false AS return_flag", "if(id % 10 = 0, 'D', 'I') AS cdc_operation", "TIMESTAMP_NTZ'2024-01-02 00:00:00' AS updated_at",
    )
    feed = spark.range(0, 2_400, 1, 12).selectExpr(*lines)
    # Shuffles that keep their 16 parts, as those of a large table do.
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1b"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        inc.run_transactions_stored(lake, feed, dt.datetime(2024, 1, 3))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert inc.read_transactions(lake).count() == 2_160
    # 24 months: before, nearly every one had a file of each of the 16 tasks.
    assert len(lake.read(inc.CDC_TABLE).inputFiles()) <= 80
