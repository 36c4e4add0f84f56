"""Layer summaries (AUD-1..3): row counts and quality / headline figures.

Each table is summarised by one aggregate (all counts in one pass), not by
one job per metric; the per-table rows are then stacked with a union, so the
whole summary is a single Spark job.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import quality as q

# Quality flags reported per silver table, in report order.
SILVER_FLAGS = {
    "valid_emails": "is_valid_email",
    "valid_pricing": "is_valid_pricing",
    "valid_line_totals": "is_valid_line_total",
    "returned_items": "is_returned",
}


def _flag_rates(name: str, df: DataFrame) -> DataFrame:
    metrics = [(m, c) for m, c in SILVER_FLAGS.items() if c in df.columns]
    wide = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(F.col(c)).alias(m) for m, c in metrics],
    )
    long = wide.unpivot(
        ["total_records"], [m for m, _ in metrics], "metric", "metric_count"
    )
    return long.select(
        F.lit(name).alias("table_name"),
        "total_records",
        "metric",
        "metric_count",
        q.safe_ratio(F.col("metric_count"), F.col("total_records"), 100.0).alias("metric_pct"),
    )


def audit_silver(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, total_records, metric, metric_count, metric_pct: one row
    per (silver table, quality flag present in it)."""
    parts = [_flag_rates(name, df) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _headline(name: str, df: DataFrame, metric: str, value: F.Column, label: F.Column | None = None) -> DataFrame:
    return df.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("total_records"),
        F.lit(metric).alias("headline_metric"),
        (label if label is not None else F.lit(None).cast("string")).alias("headline_label"),
        value.cast("double").alias("headline_value"),
    )


def audit_gold(
    total_revenue: DataFrame,
    top_customers: DataFrame,
    top_products: DataFrame,
    avg_order_value: DataFrame,
    return_rate: DataFrame,
) -> DataFrame:
    """One row per gold table: row count and its headline figure, computed on
    the columns the tables really have (SURVEY §2.14-13).  Top customer and
    product are found by revenue, then id (``min_by``: no ranks, no sort)."""
    first_customer = F.struct(-F.col("total_revenue"), F.col("customer_id"))
    first_product = F.struct(-F.col("total_revenue"), F.col("product_id"))
    rows = [
        _headline("gold_total_revenue", total_revenue, "total_revenue", F.sum("total_revenue")),
        _headline(
            "gold_top_customers",
            top_customers,
            "top_customer_revenue",
            F.min_by(F.col("total_revenue"), first_customer),
            F.min_by(F.col("full_name"), first_customer),
        ),
        _headline(
            "gold_top_products",
            top_products,
            "top_product_revenue",
            F.min_by(F.col("total_revenue"), first_product),
            F.min_by(F.col("product_name"), first_product),
        ),
        _headline(
            "gold_avg_order_value",
            avg_order_value,
            "overall_avg_order_value",
            F.round(F.avg("avg_order_value"), 6),
        ),
        _headline(
            "gold_return_rate",
            return_rate,
            "overall_return_rate_pct",
            q.safe_ratio(F.sum("returned_orders"), F.sum("total_orders"), 100.0),
        ),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def audit_incremental(checkpoints: DataFrame, scd1: DataFrame, scd2: DataFrame, cdc: DataFrame) -> DataFrame:
    """table_name, records, current_records, historical_records (the last
    two only for the versioned dimension)."""

    def count_only(name: str, df: DataFrame) -> DataFrame:
        return df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("records"),
            F.lit(None).cast("long").alias("current_records"),
            F.lit(None).cast("long").alias("historical_records"),
        )

    versions = scd2.agg(
        F.lit("silver_customers_scd2").alias("table_name"),
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("is_current")).alias("current_records"),
        F.count_if(~F.col("is_current")).alias("historical_records"),
    )
    return (
        count_only("checkpoint_table", checkpoints)
        .unionByName(count_only("silver_customers_scd1", scd1))
        .unionByName(versions)
        .unionByName(count_only("silver_transactions_incremental", cdc))
    )


def audit_stored(store, names: list[str]) -> DataFrame:
    """table_name, records, error of stored tables; one that cannot be read is
    a row with the error's class and no count (AUD-3)."""
    out = None
    for name in names:
        try:
            rows = store.read(name).agg(
                F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("records"), F.lit(None).cast("string").alias("error")
            )
        except (KeyError, AnalysisException) as e:
            rows = store.spark.range(1).select(
                F.lit(name).alias("table_name"), F.lit(None).cast("long").alias("records"), F.lit(type(e).__name__).alias("error")
            )
        out = rows if out is None else out.unionByName(rows)
    return out
