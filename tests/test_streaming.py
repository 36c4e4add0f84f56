import datetime as dt
from decimal import Decimal

from strata.plans import incremental as inc
from strata.session import scratch_path
from strata.sources.lake import scratch_lake
from strata.streaming.cdc_stream import epoch_property, merge_epoch, start_cdc_stream
from tests.conftest import rows

FEED = (
    "transaction_id string, order_id string, product_id string, quantity int, unit_price double, "
    "discount_pct double, line_total decimal(18,2), transaction_date date, return_flag boolean, "
    "cdc_operation string, updated_at timestamp_ntz"
)
T = [dt.datetime(2024, 1, d) for d in range(1, 10)]
JAN, FEB = dt.date(2024, 1, 3), dt.date(2024, 2, 3)


def _r(tid, day, qty, op, ts):
    return (tid, "o", "p", qty, 1.0, 0.0, Decimal(qty), day, False, op, ts)


def _run(spark, root, lake, max_files=None):
    start_cdc_stream(
        spark,
        f"{root}/feed",
        spark.createDataFrame([], FEED).schema,
        lake,
        inc.CDC_TABLE,
        inc.TRANSACTIONS_KEPT,
        ["transaction_id"],
        f"{root}/ckpt",
        inc.TXN_MONTH,
        transform=inc.transaction_changes,
        max_files_per_trigger=max_files,
    ).awaitTermination()


def _epoch(lake):
    return int(lake.property(inc.CDC_TABLE, epoch_property("cdc")))


def test_stream_applies_each_drop_once(spark, tmp_path):
    root = str(tmp_path)
    lake = scratch_lake(spark, "t")
    spark.createDataFrame(
        [_r("a", JAN, 1, "I", T[0]), _r("b", FEB, 1, "I", T[0]), _r("c", FEB, 5, "I", T[0])], FEED
    ).write.mode("append").parquet(f"{root}/feed")
    _run(spark, root, lake)
    first = _epoch(lake)
    # Nothing new: the stream's own checkpoint says drop 1 is done.
    _run(spark, root, lake)
    assert _epoch(lake) == first
    second = spark.createDataFrame([_r("a", JAN, 7, "U", T[2]), _r("c", FEB, 5, "D", T[2])], FEED)
    second.write.mode("append").parquet(f"{root}/feed")
    _run(spark, root, lake)
    assert _epoch(lake) > first
    assert rows(inc.read_transactions(lake), "transaction_id", "quantity") == [("a", 7), ("b", 1)]
    assert rows(lake.read(inc.CDC_TABLE).select("txn_month").distinct()) == [("2024-01",), ("2024-02",)]


def test_files_in_reverse_time_order_and_a_replayed_epoch_give_the_batch_result(spark, tmp_path):
    import os
    import time

    root = str(tmp_path)
    lake = scratch_lake(spark, "t")
    changes = [
        _r("a", JAN, 1, "I", T[0]),
        _r("b", FEB, 1, "I", T[0]),
        _r("c", FEB, 5, "I", T[1]),
        _r("a", JAN, 7, "U", T[4]),
        _r("b", FEB, 1, "D", T[5]),
        _r("b", FEB, 2, "I", T[3]),  # older than the delete
        _r("c", JAN, 6, "U", T[3]),  # moves to another month
    ]
    os.makedirs(f"{root}/feed")
    # One file per change, the newest change in the oldest file.
    for i, change in enumerate(sorted(changes, key=lambda c: c[-1], reverse=True)):
        spark.createDataFrame([change], FEED).coalesce(1).write.parquet(f"{root}/made/{i}")
        made = [f for f in os.listdir(f"{root}/made/{i}") if f.endswith(".parquet")][0]
        os.link(f"{root}/made/{i}/{made}", f"{root}/feed/{i}.parquet")
        os.utime(f"{root}/feed/{i}.parquet", (time.time() - 100 + i,) * 2)
    _run(spark, root, lake, max_files=1)
    assert _epoch(lake) == len(changes) - 1
    feed = spark.createDataFrame(changes, FEED)
    batch = inc.run_transactions(feed, inc.initial_transactions(spark, T[0]), T[6])
    assert rows(inc.read_transactions(lake)) == rows(batch.table)
    assert rows(batch.table, "transaction_id", "quantity") == [("a", 7), ("c", 6)]
    # The stream died before it recorded its last epoch: the epoch comes again and is skipped.
    before = set(lake.read(inc.CDC_TABLE).inputFiles())
    last = max(int(n) for n in os.listdir(f"{root}/ckpt/commits") if n.isdigit())
    os.makedirs(f"{root}/lost")
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{root}/ckpt/commits/{name}"):
            os.replace(f"{root}/ckpt/commits/{name}", f"{root}/lost/{name}")
    _run(spark, root, lake, max_files=1)
    assert os.path.exists(f"{root}/ckpt/commits/{last}")
    assert set(lake.read(inc.CDC_TABLE).inputFiles()) == before


def test_an_epoch_merged_again_changes_nothing(spark):
    lake = scratch_lake(spark, "t")
    inc.create_tables(lake, (inc.CDC_TABLE,))
    feed = spark.createDataFrame([_r("a", JAN, 1, "I", T[0]), _r("a", JAN, 1, "D", T[2]), _r("b", FEB, 3, "I", T[1])], FEED)
    changes = inc.transaction_changes(feed)
    keys = ["transaction_id"]
    assert merge_epoch(lake, inc.CDC_TABLE, changes, 4, keys, inc.TXN_MONTH, "one") is True
    once = rows(lake.read(inc.CDC_TABLE))
    assert merge_epoch(lake, inc.CDC_TABLE, changes, 4, keys, inc.TXN_MONTH, "one") is False
    # Without the property (it was not set in time) the merge is made again.
    assert merge_epoch(lake, inc.CDC_TABLE, changes, 4, keys, inc.TXN_MONTH, "other") is True
    assert rows(lake.read(inc.CDC_TABLE)) == once and rows(inc.read_transactions(lake), "transaction_id") == [("b",)]


def test_a_drop_of_many_files_is_merged_in_two_batches_into_few_files(spark, tmp_path, monkeypatch):
    from strata import registry

    lines = (
        "id AS l_orderkey", "1 AS l_linenumber", "1 + id % 400 AS l_partkey", "5D AS l_quantity", "50D AS l_extendedprice",
        "0.1D AS l_discount", "add_months(DATE'2024-01-15', cast(id % 24 AS int)) AS l_shipdate", "'N' AS l_returnflag",
    )
    # Twelve files, each with rows of every month.
    spark.range(4_800).repartition(12).selectExpr(*lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    drops, lakes = [], []
    real_stream, real_lake = registry.start_cdc_stream, registry.scratch_lake

    def stream(session, folder, *args, **options):
        drops.append((len(session.read.parquet(folder).inputFiles()), options["max_files_per_trigger"]))
        return real_stream(session, folder, *args, **options)

    monkeypatch.setattr(registry, "start_cdc_stream", stream)
    monkeypatch.setattr(registry, "scratch_lake", lambda *args: lakes.append(real_lake(*args)) or lakes[0])
    spark.conf.set("spark.sql.files.openCostInBytes", "64m")  # a file is a task
    try:
        layers = registry.Layers(spark, str(tmp_path))
        out = rows(layers.streamed_transactions())
        assert out == rows(layers.transaction_runs().table) and out
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    # Written by the tasks of the scan, not by two; two batches a drop, whatever its files.
    assert drops[0][0] >= 6 and drops[1][0] - drops[0][0] >= 6
    assert drops[0][1] == -(-drops[0][0] // 2) and drops[1][1] == -(-(drops[1][0] - drops[0][0]) // 2)
    assert _epoch(lakes[0]) == 3
    # A month is in one file, not in one of every task of the merge.
    assert len(lakes[0].read(inc.CDC_TABLE).inputFiles()) <= 30
    # Staged files go with the merge.
    assert not _staged(spark)


def _staged(spark):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "staged"))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(path) and [x.getPath().getName() for x in files.listStatus(path)]
