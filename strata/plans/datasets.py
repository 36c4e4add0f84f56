"""The dashboard's seven datasets, as queries over the gold tables.

The dashboard itself (widgets, layout) is not data work and is not built.
Roll-ups are kept as the dashboard defines them (SURVEY §2.14-14): total
orders is the sum of daily distinct counts, and the return rate is the
unweighted mean of daily rates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP_N = 10


def ds_revenue_summary(total_revenue: DataFrame) -> DataFrame:
    return total_revenue.agg(
        F.sum("total_revenue").cast("decimal(38,2)").alias("total_revenue"),
        F.sum("total_orders").cast("long").alias("total_orders"),
        F.sum("total_transactions").cast("long").alias("total_transactions"),
    )


def ds_top_products(top_products: DataFrame, n: int = TOP_N) -> DataFrame:
    return (
        top_products.filter(F.col("sales_rank") <= n)
        .select("product_name", "total_revenue", "sales_rank")
        .orderBy("sales_rank")
    )


def ds_return_rate_summary(return_rate: DataFrame) -> DataFrame:
    """Mean of the daily rates, rounded to 6 decimals: a mean of doubles
    depends on summation order in its last bits."""
    return return_rate.agg(F.round(F.avg("return_rate_pct"), 6).alias("avg_return_rate"))


def ds_aov_trend(avg_order_value: DataFrame) -> DataFrame:
    return avg_order_value.select("snapshot_date", "avg_order_value").orderBy("snapshot_date")


def ds_revenue_trend(total_revenue: DataFrame) -> DataFrame:
    return total_revenue.select("snapshot_date", "total_revenue").orderBy("snapshot_date")


def ds_top_customers(top_customers: DataFrame, n: int = TOP_N) -> DataFrame:
    return (
        top_customers.filter(F.col("revenue_rank") <= n)
        .select("full_name", "total_revenue", "total_orders", "avg_order_value", "revenue_rank")
        .orderBy("revenue_rank")
    )


def ds_category_distribution(top_products: DataFrame) -> DataFrame:
    """Products per category among products that sold (it reads the gold
    table, which only holds products with non-returned sales)."""
    return top_products.groupBy("category_name").agg(F.count(F.lit(1)).alias("product_count"))
