"""Stored medallion run: bronze tables -> silver tables -> gold tables.

Each layer reads the previous layer's tables by name (SRC-4, ``spark.table``) and
overwrites its own tables, schema included (SNK-2, ``saveAsTable``).  Row counts are taken
with ``DataFrame.observe`` while the table is written, so the job is not run
a second time just to print how many rows it produced.
"""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strata.operators.rank import top_k
from strata.plans import datasets as ds
from strata.plans import gold, silver
from strata.sources.lake import Lake, together

SILVER_TABLES = {
    "silver_customers": ("bronze_customers", silver.silver_customers),
    "silver_products": ("bronze_products", silver.silver_products),
    "silver_orders": ("bronze_orders", silver.silver_orders),
    "silver_transactions": ("bronze_transactions", silver.silver_transactions),
}


def _observed(name: str, df: DataFrame) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _write_counted(lake: Lake, tables: dict[str, DataFrame]) -> dict[str, int]:
    def write(name: str, df: DataFrame) -> int:
        own, seen = _observed(name, df)
        lake.overwrite(name, own)
        return seen.get["rows"]

    return dict(zip(tables, together([partial(write, name, df) for name, df in tables.items()])))


def build_silver(lake: Lake, batch_ts: datetime | None = None) -> dict[str, int]:
    """Overwrite the four silver tables from the stored bronze tables; returns
    the row count of each."""
    tables = {name: job(lake.read(src), batch_ts) for name, (src, job) in SILVER_TABLES.items()}
    return _write_counted(lake, tables)


def build_gold(lake: Lake, batch_ts: datetime | None = None) -> dict[str, int]:
    """Overwrite the five gold tables from the stored silver tables."""
    txn = lake.read("silver_transactions")
    orders = lake.read("silver_orders")
    tables = {
        "gold_total_revenue": gold.gold_total_revenue(txn, orders, batch_ts),
        "gold_top_customers": gold.gold_top_customers(txn, orders, lake.read("silver_customers"), batch_ts),
        "gold_top_products": gold.gold_top_products(txn, lake.read("silver_products"), batch_ts),
        "gold_avg_order_value": gold.gold_avg_order_value(txn, batch_ts),
        "gold_return_rate": gold.gold_return_rate(txn, orders, batch_ts),
    }
    return _write_counted(lake, tables)


def dashboard(lake: Lake) -> dict[str, DataFrame]:
    """The seven dashboard datasets over the stored gold tables."""
    revenue = lake.read("gold_total_revenue")
    products = lake.read("gold_top_products")
    return {
        "revenue_summary": ds.ds_revenue_summary(revenue),
        "top_products": ds.ds_top_products(products),
        "return_rate_summary": ds.ds_return_rate_summary(lake.read("gold_return_rate")),
        "aov_trend": ds.ds_aov_trend(lake.read("gold_avg_order_value")),
        "revenue_trend": ds.ds_revenue_trend(revenue),
        "top_customers": ds.ds_top_customers(lake.read("gold_top_customers")),
        "category_distribution": ds.ds_category_distribution(products),
    }


def preview(lake: Lake, name: str, n: int = 10) -> DataFrame:
    """``SELECT * FROM <table> LIMIT n`` (PRJ-5): a sample, not a report."""
    return lake.read(name).limit(n)


# Per table the columns that first rows show, the key first.  Floating-point
# columns, whose text differs between engines, and processing times are not shown.
_CUSTOMER = "customer_id first_name last_name email address city state country gender loyalty_tier date_of_birth registration_date"
_PRODUCT = "product_id product_name category sub_category brand sku unit_price cost_price stock_qty"
_ORDER = "order_id customer_id status payment_method quantity return_flag order_ts"
_TRANSACTION = "transaction_id order_id product_id quantity line_total transaction_date return_flag"
SHOWN = {
    "bronze_customers": _CUSTOMER.split(),
    "bronze_products": _PRODUCT.split(),
    "bronze_orders": _ORDER.split(),
    "bronze_transactions": _TRANSACTION.split(),
    "silver_customers": [*_CUSTOMER.split(), "is_valid_email"],
    "silver_products": [*_PRODUCT.split(), "is_valid_pricing", "is_in_stock"],
    "silver_orders": [*_ORDER.split(), "is_returned", "order_date"],
    "silver_transactions": [*_TRANSACTION.split(), "is_valid_line_total", "has_discount", "is_returned"],
}


def first_rows(tables: dict[str, DataFrame], n: int) -> DataFrame:
    """The first ``n`` rows of each table by its key (nulls last), then by the text
    shown: table_name, position (from 1), fields (name=value, joined by bars)."""
    out = None
    for name, df in tables.items():
        text = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("NULL"))) for c in SHOWN[name]]
        rows = df.select(F.col(SHOWN[name][0]).alias("key"), F.concat_ws("|", *text).alias("fields"))
        own = top_k(rows, [F.col("key").asc_nulls_last(), F.col("fields").asc()], n, "position")
        own = own.select(F.lit(name).alias("table_name"), "position", "fields")
        out = own if out is None else out.unionByName(own)
    return out
