"""Named queries over the driver tables: ``name -> fn(spark, sf_dir)``.

Each query builds the bronze entity frames from the driver tables, runs the
jobs and returns the resulting DataFrame (lazy, except where a job
checkpoints, collects its high-water mark, or - for the stored and
streaming runs - writes tables of a new database below the shared checkpoint
folder).  Processing-time columns (``processed_at``, ``_updated_at``)
are dropped, since they differ per run.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.quality import PERCENT, wall_clock
from strata.plans import audit, bronze, gold, incremental, medallion, rides, silver
from strata.plans import datasets as ds
from strata.session import scratch_path
from strata.operators.merge import delete_keys
from strata.sources import adapters, raw_files
from strata.sources.lake import Lake, scratch_lake, together
from strata.sources.tables import TABLE_NAMES, DriverTables
from strata.streaming.cdc_stream import start_cdc_stream

# Times of the two simulated incremental runs: run 1 sees batch 1 only,
# run 2 sees both batches and takes what is newer than run 1's mark.
RUN1_AT = datetime(2024, 1, 15)
RUN2_AT = datetime(2024, 3, 1)

RUN_COLUMNS = ("processed_at", "_updated_at")



def without_run_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in RUN_COLUMNS if c in df.columns])


class Layers:
    """The medallion frames for one data folder, built on first use."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.tables = DriverTables(spark, root)

    # bronze
    @cached_property
    def bronze_customers(self) -> DataFrame:
        return adapters.bronze_customers(self.tables)

    @cached_property
    def bronze_products(self) -> DataFrame:
        return adapters.bronze_products(self.tables)

    @cached_property
    def bronze_orders(self) -> DataFrame:
        return adapters.bronze_orders(self.tables)

    @cached_property
    def bronze_transactions(self) -> DataFrame:
        return adapters.bronze_transactions(self.tables)

    # silver
    @cached_property
    def customers(self) -> DataFrame:
        return silver.silver_customers(self.bronze_customers)

    @cached_property
    def products(self) -> DataFrame:
        return silver.silver_products(self.bronze_products)

    @cached_property
    def orders(self) -> DataFrame:
        return silver.silver_orders(self.bronze_orders)

    @cached_property
    def transactions(self) -> DataFrame:
        return silver.silver_transactions(self.bronze_transactions)

    # gold
    def total_revenue(self) -> DataFrame:
        return gold.gold_total_revenue(self.transactions, self.orders)

    def top_customers(self, limit: int | None = None, enriched: bool = False, ranked: bool = True) -> DataFrame:
        return gold.gold_top_customers(
            self.transactions, self.orders, self.customers, limit=limit, enriched=enriched, ranked=ranked
        )

    def top_products(self, limit: int | None = None, ranked: bool = True) -> DataFrame:
        return gold.gold_top_products(self.transactions, self.products, limit=limit, ranked=ranked)

    def avg_order_value(self) -> DataFrame:
        return gold.gold_avg_order_value(self.transactions)

    def return_rate(self) -> DataFrame:
        return gold.gold_return_rate(self.transactions, self.orders)

    # bike rides
    @cached_property
    def bronze_rides(self) -> DataFrame:
        return adapters.bronze_rides(self.tables)

    def silver_rides(self) -> DataFrame:
        return rides.silver_rides(self.spark, self.bronze_rides)

    def gold_rides(self) -> DataFrame:
        return rides.gold_rides(self.spark, self.silver_rides())

    # audits
    def audit_silver(self) -> DataFrame:
        return audit.audit_silver(
            {
                "silver_customers": self.customers,
                "silver_products": self.products,
                "silver_orders": self.orders,
                "silver_transactions": self.transactions,
            }
        )

    def audit_gold(self) -> DataFrame:
        return audit.audit_gold(
            self.total_revenue(),
            self.top_customers(ranked=False),
            self.top_products(ranked=False),
            self.avg_order_value(),
            self.return_rate(),
        )

    # incremental runs over the simulated change feeds
    @cached_property
    def customer_feed(self) -> DataFrame:
        return adapters.customer_feed(self.tables)

    @cached_property
    def transaction_feed(self) -> DataFrame:
        return adapters.transaction_feed(self.tables)

    def _arrived(self, feed: DataFrame, at: datetime) -> DataFrame:
        return feed.filter(F.col("updated_at") <= wall_clock(at))

    def _checkpoints(self, at: datetime) -> DataFrame:
        return incremental.seed_checkpoints(
            incremental.empty(self.spark, incremental.CHECKPOINT),
            [incremental.CUSTOMERS_SOURCE, incremental.TRANSACTIONS_SOURCE],
            at,
        )

    def customer_runs(self, runs=(RUN1_AT, RUN2_AT), checkpoints: DataFrame | None = None):
        """The customer flow (SCD1 + SCD2) run at each time in ``runs``."""
        cps = checkpoints if checkpoints is not None else self._checkpoints(runs[0])
        state = incremental.CustomerState(
            incremental.empty(self.spark, incremental.SCD1), lambda: incremental.empty(self.spark, incremental.SCD2), cps
        )
        for at in runs:
            state = incremental.run_customers(self._arrived(self.customer_feed, at), state, at)
        return state

    def transaction_runs(self, runs=(RUN1_AT, RUN2_AT), checkpoints: DataFrame | None = None):
        """The transaction flow (CDC apply) run at each time in ``runs``."""
        cps = checkpoints if checkpoints is not None else self._checkpoints(runs[0])
        state = incremental.TransactionState(incremental.empty(self.spark, incremental.TRANSACTIONS_KEPT), cps)
        for at in runs:
            state = incremental.run_transactions(self._arrived(self.transaction_feed, at), state, at)
        return state

    def incremental_runs(self, runs=(RUN1_AT, RUN2_AT)):
        """Both flows sharing one checkpoint table: the customer flow first,
        then the transaction flow; returns (customer state, transaction state)."""
        cust = self.customer_runs(runs)
        txn = self.transaction_runs(runs, cust.checkpoints)
        return cust, txn

    def stored_customer_runs(self, runs: tuple[datetime, ...] = (RUN1_AT, RUN2_AT)) -> Lake:
        """The customer flow run at each time in ``runs`` against stored tables
        (current versions replaced by bucket, closed versions added)."""
        lake = scratch_lake(self.spark, "customers")
        for at in runs:
            incremental.run_customers_stored(lake, self._arrived(self.customer_feed, at), at)
        return lake

    def seeded_control(self) -> DataFrame:
        """The declared tables created twice and the control table seeded twice,
        then one run of the customer flow (SNK-4, SNK-5): its row has moved on, the
        other source still has its seed."""
        lake = scratch_lake(self.spark, "control")
        for _ in range(2):
            incremental.create_tables(lake)
            incremental.seed_control(lake, [incremental.CUSTOMERS_SOURCE, incremental.TRANSACTIONS_SOURCE], RUN1_AT)
        incremental.run_customers_stored(lake, self._arrived(self.customer_feed, RUN1_AT), RUN1_AT)
        return incremental.checkpoint_listing(lake.read(incremental.CHECKPOINT_TABLE))

    def pruned_transaction_runs(self, runs: tuple[datetime, ...] = (RUN1_AT, RUN2_AT)) -> DataFrame:
        """The transaction flow over a feed stored by change day: each run opens
        the days from its mark on (INC-3, FLT-8)."""
        lake = scratch_lake(self.spark, "feed")
        previous = None
        for at in runs:
            arrived = self._arrived(self.transaction_feed, at)
            new = arrived if previous is None else arrived.filter(F.col("updated_at") > wall_clock(previous))
            incremental.store_feed(lake, "transaction_feed", new)
            previous = at
            incremental.run_transactions_stored(lake, lake.read("transaction_feed"), at, day=incremental.CHANGE_DAY)
        return incremental.read_transactions(lake)

    def transactions_without_deleted(self) -> DataFrame:
        """The table of the first run without the keys of a feed that holds
        deletes only (MRG-6, JN-6)."""
        first = self.transaction_runs((RUN1_AT,)).table
        deletes = self.transaction_feed.filter(F.col("cdc_operation") == "D")
        return delete_keys(first, deletes, ["transaction_id"])

    def stored_rides(self) -> Lake:
        """The bike results as stored views, refreshed twice (SNK-6, JOB-R2, JOB-R3)."""
        lake = scratch_lake(self.spark, "rides")
        for _ in range(2):
            rides.refresh_views(lake, self.bronze_rides)
        return lake

    def stored_ride_columns(self) -> DataFrame:
        """Name, type and comment of the stored views' columns, as the catalog has
        them, with the rows of each view."""
        lake = self.stored_rides()
        rows = None
        for view in rides.VIEWS:
            own = lake.read(view).agg(F.lit(view).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
            rows = own if rows is None else rows.unionByName(own)
        return lake.columns(list(rides.VIEWS)).join(rows, "table_name")

    def raw_copy(self, name: str, df: DataFrame, **options) -> str:
        """``df`` written as CSV files below the shared checkpoint folder, as a
        raw layer would hold it; every field is quoted."""
        import uuid

        folder = scratch_path(self.spark, "raw", uuid.uuid4().hex)
        df.write.option("header", True).option("quoteAll", True).option("escape", '"').options(**options).csv(f"{folder}/{name}")
        return folder

    def raw_documents(self) -> DataFrame:
        """Documents as a multi-line CSV (texts hold line ends and quotes), read back."""
        docs = self.tables.documents
        folder = self.raw_copy("documents", docs)
        return raw_files.read_csv(self.spark, f"{folder}/documents", docs.schema, multiline=True)

    def raw_rides(self) -> DataFrame:
        """Raw rides as a folder of CSV files, read back as text (JOB-R1)."""
        folder = self.raw_copy("rides", self.bronze_rides, emptyValue="")
        return rides.bronze_rides_from_csv(self.spark, f"{folder}/rides")

    def raw_medallion(self) -> DataFrame:
        """The retail layers through files and named tables: raw CSV, bronze,
        silver, gold, each table overwritten (JOB-B, SNK-1, SNK-2, SRC-1, SRC-4)."""
        import uuid

        frames = {
            "customers.csv": self.bronze_customers,
            "orders_part-0000.csv": self.bronze_orders.filter(F.col("order_id").cast("long") % 2 == 0),
            "orders_part-0001.csv": self.bronze_orders.filter(
                F.coalesce(F.col("order_id").cast("long") % 2 != 0, F.lit(True))
            ),
            "products.csv": self.bronze_products,
            "transactions.csv": self.bronze_transactions,
        }
        # A multi-line file is read by one task, whatever its size.
        frames["customers.csv"] = frames["customers.csv"].hint("rebalance")
        folder = scratch_path(self.spark, "raw", uuid.uuid4().hex)
        together([partial(df.write.option("header", True).option("escape", '"').csv, f"{folder}/{name}") for name, df in frames.items()])
        lake = scratch_lake(self.spark, "retail")
        schemas = {
            "bronze_customers": self.bronze_customers.schema,
            "bronze_orders": self.bronze_orders.schema,
            "bronze_products": self.bronze_products.schema,
            "bronze_transactions": self.bronze_transactions.schema,
        }
        bronze.ingest_retail(self.spark, folder, lake, schemas)
        medallion.build_silver(lake)
        medallion.build_gold(lake)
        return lake.read("gold_total_revenue")

    def raw_file_sizes(self) -> DataFrame:
        """Rows and bytes (without header lines) of the raw rides' files, by the
        file audit (SRC-5)."""
        folder = self.raw_copy("rides", self.bronze_rides.fillna(""), emptyValue="")
        df = rides.bronze_rides_from_csv(self.spark, f"{folder}/rides")
        header = sum(len(c) + 3 for c in df.columns)  # quotes, and a comma or line end
        return raw_files.file_audit(df).agg(
            F.sum("row_count").alias("row_count"), F.sum(F.col("file_size") - header).alias("data_bytes")
        )

    def raw_heads(self) -> DataFrame:
        """The first five rows of the four raw entities (SRC-6)."""
        names = ("bronze_customers", "bronze_products", "bronze_orders", "bronze_transactions")
        return medallion.first_rows({n: getattr(self, n) for n in names}, 5)

    def silver_samples(self) -> DataFrame:
        """Ten rows of the four silver tables (PRJ-5)."""
        tables = {"silver_customers": self.customers, "silver_products": self.products, "silver_orders": self.orders, "silver_transactions": self.transactions}
        return medallion.first_rows(tables, 10)

    def silver_percent(self) -> DataFrame:
        """Transactions from a raw file with text dates and percent discounts (DT-7, NUM-4)."""
        df = silver.silver_transactions(adapters.transactions_as_text(self.tables), discount_unit=PERCENT)
        return df.select(
            "transaction_id", "is_valid_line_total", "has_discount", F.round("discount_pct", 6).alias("discount_pct"), "transaction_date"
        )

    def streamed_transactions(self, runs: tuple[datetime, ...] = (RUN1_AT, RUN2_AT)) -> DataFrame:
        """The CDC table built by the streaming job (STM-1).

        The change feed arrives as parquet files in a folder below the shared
        checkpoint folder, one drop per run time, the newest changes first; an
        available-now stream after each drop merges the new files in two
        micro-batches, whatever their number (each may touch every month of the
        table, so batches of a fixed size would cost the square of the feed).  The
        result must equal the checkpointed batch runs (``cdc_transactions``).
        """
        import uuid

        root = scratch_path(self.spark, "cdc-stream", uuid.uuid4().hex)
        lake = scratch_lake(self.spark, "stream")
        feed = self.transaction_feed
        bounds = [None, *runs]
        seen: set[str] = set()
        for since, at in reversed(list(zip(bounds, runs))):
            drop = self._arrived(feed, at)
            if since is not None:
                drop = drop.filter(F.col("updated_at") > wall_clock(since))
            drop.write.mode("append").parquet(f"{root}/feed")
            files = set(self.spark.read.schema(feed.schema).parquet(f"{root}/feed").inputFiles()) - seen
            seen |= files
            start_cdc_stream(
                self.spark,
                f"{root}/feed",
                feed.schema,
                lake,
                incremental.CDC_TABLE,
                incremental.TRANSACTIONS_KEPT,
                ["transaction_id"],
                f"{root}/stream-checkpoint",
                incremental.TXN_MONTH,
                transform=incremental.transaction_changes,
                max_files_per_trigger=-(-len(files) // 2) or 1,
            ).awaitTermination()
        return incremental.read_transactions(lake)


Query = Callable[[SparkSession, str], DataFrame]


def _q(build: Callable[[Layers], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return without_run_columns(build(Layers(spark, sf_dir)))

    run.__doc__ = build.__doc__
    return run


QUERIES: dict[str, Query] = {
    # sources (SRC-6 profile, SRC-5 per-file audit)
    "source_profile": _q(lambda p: raw_files.profiles({n: p.tables.table(n) for n in TABLE_NAMES})),
    "source_file_audit": _q(
        lambda p: raw_files.file_audits({n: p.tables.table(n) for n in TABLE_NAMES}).select(
            "table_name", F.regexp_extract("file_path", r"([^/]+)$", 1).alias("file_name"), "row_count"
        )
    ),
    # raw files and the stored layers (SRC-1..3, JOB-B, JOB-R1, SNK-1/2)
    "raw_documents": _q(lambda p: p.raw_documents()),
    "raw_rides": _q(lambda p: p.raw_rides()),
    "raw_medallion": _q(lambda p: p.raw_medallion()),
    "raw_file_sizes": _q(lambda p: p.raw_file_sizes()),
    "raw_heads": _q(lambda p: p.raw_heads()),
    "silver_transactions_percent": _q(lambda p: p.silver_percent()),
    # silver full refresh (JOB-S1..S4)
    "silver_customers": _q(lambda p: p.customers),
    "silver_products": _q(lambda p: p.products),
    "silver_orders": _q(lambda p: p.orders),
    "silver_transactions": _q(lambda p: p.transactions),
    "silver_samples": _q(lambda p: p.silver_samples()),
    # gold (JOB-G1..G5)
    "gold_total_revenue": _q(lambda p: p.total_revenue()),
    "gold_top_customers": _q(lambda p: p.top_customers()),
    "gold_top_products": _q(lambda p: p.top_products()),
    "gold_avg_order_value": _q(lambda p: p.avg_order_value()),
    "gold_return_rate": _q(lambda p: p.return_rate()),
    # dashboard datasets (JOB-D1..D7)
    "ds_revenue_summary": _q(lambda p: ds.ds_revenue_summary(p.total_revenue())),
    "ds_top_products": _q(lambda p: ds.ds_top_products(p.top_products(limit=ds.TOP_N))),
    "ds_return_rate_summary": _q(lambda p: ds.ds_return_rate_summary(p.return_rate())),
    "ds_aov_trend": _q(lambda p: ds.ds_aov_trend(p.avg_order_value())),
    "ds_revenue_trend": _q(lambda p: ds.ds_revenue_trend(p.total_revenue())),
    "ds_top_customers": _q(lambda p: ds.ds_top_customers(p.top_customers(limit=ds.TOP_N))),
    "ds_category_distribution": _q(lambda p: ds.ds_category_distribution(p.top_products(ranked=False))),
    # prose-only gold items (WIN-3/4, DT-6, JOB-G6..G9)
    "gold_daily_revenue_kpis": _q(lambda p: gold.gold_daily_revenue_kpis(p.total_revenue())),
    "gold_revenue_monthly": _q(lambda p: gold.gold_revenue_monthly(p.total_revenue())),
    "gold_revenue_yearly": _q(lambda p: gold.gold_revenue_yearly(p.total_revenue())),
    "gold_aov_monthly": _q(lambda p: gold.gold_aov_by_period(p.avg_order_value())),
    "gold_aov_yearly": _q(lambda p: gold.gold_aov_by_period(p.avg_order_value(), monthly=False)),
    "gold_aov_moving_average": _q(lambda p: gold.gold_aov_moving_average(p.avg_order_value())),
    "gold_product_profit": _q(lambda p: gold.gold_product_profit(p.transactions, p.products)),
    "gold_return_rate_by_product": _q(lambda p: gold.gold_return_rate_by_product(p.transactions, p.products)),
    "gold_return_rate_by_category": _q(
        lambda p: gold.gold_return_rate_by_category(p.transactions, p.products)
    ),
    "gold_customer_profile": _q(lambda p: p.top_customers(enriched=True)),
    # bike rides (JOB-R2, JOB-R3)
    "bike_silver": _q(lambda p: p.silver_rides()),
    "bike_rejects": _q(lambda p: rides.rejected_rides(p.bronze_rides)),
    "bike_gold": _q(lambda p: p.gold_rides()),
    "bike_gold_stored": _q(lambda p: p.stored_rides().read(rides.GOLD_VIEW)),
    "bike_stored_columns": _q(lambda p: p.stored_ride_columns()),
    # audits (AUD-1, AUD-2)
    "audit_silver": _q(lambda p: p.audit_silver()),
    "audit_gold": _q(lambda p: p.audit_gold()),
    # incremental (JOB-C1..C3, INC-1..5, AUD-3)
    "scd1_customers": _q(lambda p: p.customer_runs().scd1),
    "scd2_customers": _q(lambda p: p.customer_runs().scd2),
    "scd2_customers_stored": _q(lambda p: incremental.read_versions(p.stored_customer_runs())),
    "scd2_current": _q(lambda p: incremental.current_versions(p.customer_runs().scd2)),
    "scd2_history": _q(lambda p: incremental.version_history(p.customer_runs().scd2)),
    "cdc_transactions": _q(lambda p: p.transaction_runs().table),
    "cdc_transactions_stream": _q(lambda p: p.streamed_transactions()),
    "cdc_transactions_pruned": _q(lambda p: p.pruned_transaction_runs()),
    "cdc_deletes_only": _q(lambda p: p.transactions_without_deleted()),
    "checkpoint_seeded": _q(lambda p: p.seeded_control()),
    "checkpoint_after_run": _q(lambda p: incremental.checkpoint_listing(p.incremental_runs()[1].checkpoints)),
    "checkpoint_lag": _q(
        lambda p: incremental.checkpoint_lag(
            p.incremental_runs((RUN1_AT,))[1].checkpoints,
            {
                incremental.CUSTOMERS_SOURCE: p.customer_feed,
                incremental.TRANSACTIONS_SOURCE: p.transaction_feed,
            },
        )
    ),
    "audit_stored_tables": _q(
        lambda p: audit.audit_stored(
            p.stored_customer_runs(),
            [incremental.CHECKPOINT_TABLE, incremental.SCD1_TABLE, incremental.SCD2_TABLE, incremental.CDC_TABLE],
        )
    ),
    "audit_incremental": _q(
        lambda p: (lambda c, t: audit.audit_incremental(t.checkpoints, c.scd1, c.scd2, t.table))(
            *p.incremental_runs()
        )
    ),
}
