"""Checkpointed incremental runs: SCD type 1 and 2 customers, CDC
transactions (INC-1..5, MRG-1..6, JOB-C1..C3).

One run = read the high-water mark -> take source rows strictly newer than
it -> transform with the shared silver rules -> merge -> store the new mark
(the newest source ``updated_at`` of the batch, never the wall clock) and
the batch size.  An empty batch keeps the old mark (SURVEY §2.14-5..7).

The mark is a single timestamp collected to the driver and used as a
literal filter, so Catalyst pushes ``updated_at > mark`` into the parquet
scan (row groups whose statistics are older are skipped).  A feed that is stored
by change day (``store_feed``) is pruned to the days from the mark on.

``run_customers`` / ``run_transactions`` return the new frames.
``run_customers_stored`` / ``run_transactions_stored`` run against the tables of
a ``Lake`` and rewrite only the partitions a batch touches; the control row is
written last, so a run that dies is run again and gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.sql import Column as ColumnExpr
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import quality as q
from strata.functions.schema import Column, literal_frame
from strata.operators.dedupe import keep_first
from strata.operators.merge import DELETED, apply_changes, live_rows, merge_partitions, scd2_merge, upsert
from strata.sources.lake import Lake, Partition, settled, staged

CUSTOMERS_SOURCE = "bronze_customers"
TRANSACTIONS_SOURCE = "bronze_transactions"

# Declared target schemas (column lists of the reference's DDL).
CHECKPOINT = [
    Column("table_name", "string"),
    Column("last_processed_timestamp", "timestamp_ntz"),
    Column("records_processed", "bigint"),
    Column("updated_at", "timestamp_ntz"),
]
_CUSTOMER = [
    Column("customer_id", "string"),
    Column("first_name", "string"),
    Column("last_name", "string"),
    Column("email", "string"),
    Column("city", "string"),
    Column("state", "string"),
    Column("country", "string"),
    Column("loyalty_tier", "string"),
    Column("is_valid_email", "boolean"),
]
SCD1 = [*_CUSTOMER, Column("updated_at", "timestamp_ntz")]
SCD2 = [
    *_CUSTOMER,
    Column("valid_from", "timestamp_ntz"),
    Column("valid_to", "timestamp_ntz"),
    Column("is_current", "boolean"),
]
TRANSACTIONS = [
    Column("transaction_id", "string"),
    Column("order_id", "string"),
    Column("product_id", "string"),
    Column("quantity", "int"),
    Column("unit_price", "double"),
    Column("discount_pct", "double"),
    Column("line_total", "decimal(18,2)"),
    Column("transaction_date", "date"),
    Column("return_flag", "boolean"),
    Column("calculated_line_total", "double"),
    Column("is_valid_line_total", "boolean"),
    Column("has_discount", "boolean"),
    Column("is_returned", "boolean"),
    Column("updated_at", "timestamp_ntz"),
]
# The table as it is kept: with a mark on deleted rows (see apply_changes).
TRANSACTIONS_KEPT = [*TRANSACTIONS, Column(DELETED, "boolean")]
SCD2_TRACKED = ["email", "city", "state", "loyalty_tier"]


def names(columns: list[Column]) -> list[str]:
    return [c.name for c in columns]


def empty(spark, columns: list[Column]) -> DataFrame:
    return literal_frame(spark, [], columns)


# --- checkpoint table ---------------------------------------------------------


def seed_checkpoints(checkpoints: DataFrame, sources: list[str], at: datetime) -> DataFrame:
    """Add a first-run row (mark 1900-01-01, 0 records) for each source that
    has none: an anti-join of the seeds against the table, then a union."""
    return checkpoints.unionByName(missing_seeds(checkpoints, sources, at))


def missing_seeds(checkpoints: DataFrame, sources: list[str], at: datetime) -> DataFrame:
    seeds = literal_frame(checkpoints.sparkSession, [(s, q.DEFAULT_MARK, 0, at) for s in sources], CHECKPOINT)
    return seeds.join(checkpoints.select("table_name"), "table_name", "left_anti")


def read_mark(checkpoints: DataFrame, source: str) -> datetime:
    """High-water mark of ``source``; 1900-01-01 when it has none."""
    row = checkpoints.filter(F.col("table_name") == source).agg(F.max("last_processed_timestamp")).first()
    return row[0] if row and row[0] is not None else q.DEFAULT_MARK


def newer_than(source: DataFrame, mark: datetime, ts: str = "updated_at", day: str | None = None) -> DataFrame:
    """Rows strictly newer than the mark; a row stamped exactly at the mark
    was taken by the run that set it and is not read again.  ``day`` names the
    column by whose days the source is stored: older days are not opened."""
    rows = source.filter(F.col(ts) > q.wall_clock(mark))
    return rows.filter(F.col(day) >= F.lit(mark.date())) if day else rows


def record_progress(
    checkpoints: DataFrame,
    source: str,
    batch: DataFrame,
    at: datetime,
    ts: str = "updated_at",
    processed: ColumnExpr | None = None,
) -> DataFrame:
    """Upsert (source, newest change time, rows processed, run time); an empty
    batch leaves the checkpoint as it was.

    The mark is the newest time of the whole batch, so rows that cleaning
    drops are not read again; the count is of the rows that pass it
    (``processed``).  The row with the newest mark stays.  The table has one row
    per source; it is computed here and now, so that plans do not grow from run
    to run.
    """
    counted = F.count(F.lit(1)) if processed is None else F.count_if(processed)
    row = batch.agg(F.max(ts).alias("last_processed_timestamp"), counted.alias("records_processed"))
    row = row.filter(F.col("last_processed_timestamp").isNotNull()).select(
        F.lit(source).alias("table_name"), "last_processed_timestamp", "records_processed", q.wall_clock(at).alias("updated_at")
    )
    merged = upsert(checkpoints, settled(row), ["table_name"], ts="last_processed_timestamp")
    return settled(merged.coalesce(1))


def checkpoint_lag(checkpoints: DataFrame, sources: dict[str, DataFrame], ts: str = "updated_at") -> DataFrame:
    """table_name, last_processed_timestamp, source_max_updated_at,
    lag_seconds: how far each source is ahead of its mark (INC-5).

    A source without a mark, and an empty source, have a NULL lag; a mark
    ahead of its source has a negative one.
    """
    spark = checkpoints.sparkSession
    heads = None
    for name, df in sources.items():
        head = df.agg(F.lit(name).alias("table_name"), F.max(ts).alias("source_max_updated_at"))
        heads = head if heads is None else heads.unionByName(head)
    if heads is None:
        heads = literal_frame(
            spark, [], [Column("table_name", "string"), Column("source_max_updated_at", "timestamp_ntz")]
        )
    # Wall-clock difference of two zone-less timestamps: no session time zone
    # (and no daylight-saving shift) is involved.
    lag = F.timestamp_diff("SECOND", F.col("last_processed_timestamp"), F.col("source_max_updated_at"))
    marks = checkpoints.select("table_name", "last_processed_timestamp")
    return heads.join(marks, "table_name", "left").select(
        "table_name", "last_processed_timestamp", "source_max_updated_at", lag.alias("lag_seconds")
    )


def current_versions(scd2: DataFrame) -> DataFrame:
    """The dimension as of now: current versions only (SCD-1)."""
    return scd2.filter(F.col("is_current"))


def version_history(scd2: DataFrame) -> DataFrame:
    """Every version, newest first within each customer (SCD-1, SRT-2)."""
    return scd2.orderBy("customer_id", F.desc("valid_from"))


def checkpoint_listing(checkpoints: DataFrame) -> DataFrame:
    """The checkpoint table ordered by source (INC-4)."""
    return checkpoints.orderBy("table_name")


# --- transforms (shared silver rules) ------------------------------------------


def customer_changes(batch: DataFrame) -> DataFrame:
    """Cleaned customer rows + ``updated_at``; one row per key and change
    time (rows repeated within one instant are reduced by a fixed tiebreak)."""
    df = batch.filter(q.valid_customer_id("customer_id")).select(
        "customer_id",
        *[F.trim(c).alias(c) for c in ("first_name", "last_name")],
        q.normalized_email("email").alias("email"),
        *[F.trim(c).alias(c) for c in ("city", "state", "country", "loyalty_tier")],
        q.valid_email("email").alias("is_valid_email"),
        "updated_at",
    )
    return keep_first(df, ["customer_id", "updated_at"])


def transaction_changes(batch: DataFrame, discount_unit: str = q.FRACTION) -> DataFrame:
    """Checked transaction rows + ``cdc_operation`` + ``updated_at``."""
    df = batch.filter(F.col("transaction_id").isNotNull())
    df = q.line_checks(df, unit=discount_unit)
    return df.select(*names(TRANSACTIONS[:-1]), "cdc_operation", "updated_at")


# --- runs ---------------------------------------------------------------------


@dataclass
class CustomerState:
    """Both dimensions and the checkpoints; SCD2 is built when first asked
    for, since its merge computes at once."""

    scd1: DataFrame
    build_scd2: Callable[[], DataFrame]
    checkpoints: DataFrame

    @cached_property
    def scd2(self) -> DataFrame:
        return self.build_scd2()


@dataclass
class TransactionState:
    """``kept`` holds tombstones, ``table`` shows the live rows."""

    kept: DataFrame
    checkpoints: DataFrame

    @property
    def table(self) -> DataFrame:
        return live_rows(self.kept)


def run_customers(source: DataFrame, state: CustomerState, at: datetime) -> CustomerState:
    """One incremental run of the customer dimension (SCD1 and SCD2)."""
    batch = staged_batch(source, read_mark(state.checkpoints, CUSTOMERS_SOURCE))
    changes = settled(customer_changes(batch))
    scd1 = upsert(state.scd1, changes.select(*names(SCD1)), ["customer_id"])
    progress = record_progress(
        state.checkpoints, CUSTOMERS_SOURCE, batch, at, processed=q.valid_customer_id("customer_id")
    )
    return CustomerState(scd1, lambda: scd2_merge(state.scd2, changes, ["customer_id"], SCD2_TRACKED), progress)


def run_transactions(
    source: DataFrame, state: TransactionState, at: datetime, discount_unit: str = q.FRACTION
) -> TransactionState:
    """One incremental run of the transaction table (CDC apply)."""
    batch = staged_batch(source, read_mark(state.checkpoints, TRANSACTIONS_SOURCE))
    kept = apply_changes(state.kept, settled(transaction_changes(batch, discount_unit)), ["transaction_id"])
    progress = record_progress(
        state.checkpoints, TRANSACTIONS_SOURCE, batch, at, processed=F.col("transaction_id").isNotNull()
    )
    return TransactionState(kept, progress)


def initial_customers(spark, at: datetime) -> CustomerState:
    return CustomerState(
        empty(spark, SCD1),
        lambda: empty(spark, SCD2),
        seed_checkpoints(empty(spark, CHECKPOINT), [CUSTOMERS_SOURCE], at),
    )


def initial_transactions(spark, at: datetime) -> TransactionState:
    return TransactionState(
        empty(spark, TRANSACTIONS_KEPT), seed_checkpoints(empty(spark, CHECKPOINT), [TRANSACTIONS_SOURCE], at)
    )


# --- stored runs ------------------------------------------------------------------

SCD1_TABLE = "silver_customers_scd1"
SCD2_TABLE = "silver_customers_scd2"
CDC_TABLE = "silver_transactions_incremental"
CHECKPOINT_TABLE = "checkpoint_table"


DECLARED = {CHECKPOINT_TABLE: CHECKPOINT, SCD1_TABLE: SCD1, SCD2_TABLE: SCD2, CDC_TABLE: TRANSACTIONS_KEPT}

# Customer dimensions are stored in buckets of a hash of the key: a key never
# changes its bucket, so a run reads and rewrites the buckets of its keys.
CUSTOMER_BUCKETS = 64
KEY_BUCKET = Partition("key_bucket", "int", f"pmod(xxhash64(customer_id), {CUSTOMER_BUCKETS})")
# One partition per month of the transaction.
TXN_MONTH = Partition("txn_month", "string", "coalesce(date_format(transaction_date, 'yyyy-MM'), 'none')")
# SCD2 versions also by segment: the current ones of a bucket are replaced, closed
# ones are added as a segment of the run that closed them.
CURRENT = "current"
SEGMENT = Column("segment", "string", "current, or the mark at which a run closed the version")

PARTITIONS = {SCD1_TABLE: KEY_BUCKET, SCD2_TABLE: KEY_BUCKET, CDC_TABLE: TXN_MONTH}


def create_tables(lake: Lake, tables: tuple[str, ...] = tuple(DECLARED)) -> list[str]:
    """The declared tables that were not there yet, created with their column
    types; returns their names."""
    made = []
    for name in tables:
        columns = [*DECLARED[name], *([SEGMENT] if name == SCD2_TABLE else [])]
        by = [SEGMENT.name] if name == SCD2_TABLE else []
        if lake.create(name, columns, PARTITIONS.get(name), also_by=by):
            made.append(name)
    return made


def seed_control(lake: Lake, sources: list[str], at: datetime) -> None:
    """Append a first-run row for each source without one (SNK-5): running it
    again appends nothing."""
    there = lake.read(CHECKPOINT_TABLE)
    lake.append(CHECKPOINT_TABLE, settled(missing_seeds(there, sources, at)))


def staged_batch(source: DataFrame, mark: datetime, day: str | None = None) -> DataFrame:
    """The new rows of ``source``, written once below the shared checkpoint
    folder: merge, mark and count all see the same rows."""
    return settled(newer_than(source, mark, day=day))


# --- the feed, stored by change day --------------------------------------------

CHANGE_DAY = "change_day"


def store_feed(lake: Lake, table: str, feed: DataFrame, ts: str = "updated_at") -> None:
    """Add ``feed`` to the stored feed ``table``, one partition per day of the
    change; made on first use with the feed's columns."""
    rows = feed.withColumn(CHANGE_DAY, F.to_date(ts))
    if not lake.exists(table):
        lake.overwrite(table, rows, partition_by=[CHANGE_DAY])
    else:
        lake.append(table, rows)


def run_customers_stored(lake: Lake, source: DataFrame, at: datetime, day: str | None = None) -> None:
    """One stored incremental run of the customer dimension: SCD1 rows and SCD2
    current versions of the touched key buckets replaced, closed SCD2 versions
    added, control row updated last.

    The segment of closed versions is named after the mark that the run began
    at: a run repeated after a crash writes the same segment again, with what it
    held by then.
    """
    create_tables(lake, (CHECKPOINT_TABLE, SCD1_TABLE, SCD2_TABLE))
    seed_control(lake, [CUSTOMERS_SOURCE], at)
    control = lake.read(CHECKPOINT_TABLE)
    mark = read_mark(control, CUSTOMERS_SOURCE)
    batch = staged_batch(source, mark, day)
    changes = settled(customer_changes(batch))
    buckets = merge_partitions(
        lake, SCD1_TABLE, changes, ["customer_id"], lambda old, ch: upsert(old, ch, ["customer_id"]), KEY_BUCKET, moves=False
    )
    stored = lake.read(SCD2_TABLE)
    live = stored.filter((F.col(SEGMENT.name) == CURRENT) & F.col(KEY_BUCKET.column).isin(buckets)).select(*names(SCD2))
    versions = scd2_merge(live, changes, ["customer_id"], SCD2_TRACKED)
    closed = F.lit(mark.strftime("closed-%Y%m%d%H%M%S%f"))
    segment = F.when(F.col("is_current"), F.lit(CURRENT)).otherwise(closed)
    versions = versions.withColumns({SEGMENT.name: segment, KEY_BUCKET.column: KEY_BUCKET.of()})
    if buckets:
        begun = stored.filter((F.col(SEGMENT.name) == closed) & F.col(KEY_BUCKET.column).isin(buckets))
        versions = versions.unionByName(begun).dropDuplicates(["customer_id", "valid_from"])
        lake.replace_partitions(SCD2_TABLE, settled(versions))
    progress = record_progress(control, CUSTOMERS_SOURCE, batch, at, processed=q.valid_customer_id("customer_id"))
    lake.replace(CHECKPOINT_TABLE, progress)


def read_versions(lake: Lake) -> DataFrame:
    """The stored SCD2 dimension, all versions."""
    return lake.read(SCD2_TABLE).select(*names(SCD2))


def read_transactions(lake: Lake) -> DataFrame:
    """The stored CDC table as it stands: live rows only."""
    return live_rows(lake.read(CDC_TABLE).select(*names(TRANSACTIONS_KEPT)))


def merge_transaction_changes(lake: Lake, changes: DataFrame) -> list:
    """CDC merge of ``changes`` into the stored table, touched months only."""
    create_tables(lake, (CDC_TABLE,))
    return merge_partitions(
        lake, CDC_TABLE, changes, ["transaction_id"], lambda old, ch: apply_changes(old, ch, ["transaction_id"]), TXN_MONTH
    )


def run_transactions_stored(
    lake: Lake, source: DataFrame, at: datetime, discount_unit: str = q.FRACTION, day: str | None = None
) -> None:
    """One stored incremental CDC run: only the months the batch touches are
    read and rewritten; the control row is updated last."""
    create_tables(lake, (CHECKPOINT_TABLE, CDC_TABLE))
    seed_control(lake, [TRANSACTIONS_SOURCE], at)
    control = lake.read(CHECKPOINT_TABLE)
    # Merge, mark and count all see the same rows.
    with staged(newer_than(source, read_mark(control, TRANSACTIONS_SOURCE), day=day)) as batch:
        with staged(transaction_changes(batch, discount_unit)) as changes:
            merge_transaction_changes(lake, changes)
        progress = record_progress(control, TRANSACTIONS_SOURCE, batch, at, processed=F.col("transaction_id").isNotNull())
    lake.replace(CHECKPOINT_TABLE, progress)
