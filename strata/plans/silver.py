"""Silver full refresh: bronze entity frames -> cleaned, deduplicated frames.

Step order follows the reference (SURVEY §2.14-17): drop bad keys, keep one
row per key, then normalise and flag.  Keys are never trimmed, so a padded
id is dropped by the id pattern and other padded ids stay distinct keys.

The output column names are fixed by the tables that the jobs write.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strata.functions import quality as q
from strata.operators.dedupe import keep_first

ORDER_TS_FORMATS = ("yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy")
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy")


def _dates(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Text columns among ``columns`` as dates (DT-7); dates stay."""
    text = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, StringType)]
    return df.withColumns({c: q.parsed_date(c, DATE_FORMATS) for c in text}) if text else df


def silver_customers(bronze: DataFrame, batch_ts: datetime | None = None) -> DataFrame:
    df = bronze.filter(q.valid_customer_id("customer_id"))
    df = keep_first(df, ["customer_id"])
    df = df.withColumns(
        {
            **q.trimmed(["first_name", "last_name", "address", "city", "state", "country", "loyalty_tier"]),
            "email": q.normalized_email("email"),
            "gender": F.upper(F.trim("gender")),
        }
    )
    df = _dates(df, ("date_of_birth", "registration_date"))
    return df.withColumns({"is_valid_email": q.valid_email("email"), "processed_at": q.batch_time(batch_ts)})


def silver_products(bronze: DataFrame, batch_ts: datetime | None = None) -> DataFrame:
    df = keep_first(bronze.filter(F.col("product_id").isNotNull()), ["product_id"])
    df = df.withColumns(q.trimmed(["product_name", "category", "sub_category", "brand", "sku"]))
    df = df.withColumns(q.clamped(df, ["unit_price", "cost_price", "stock_qty"]))
    price, cost = F.col("unit_price"), F.col("cost_price")
    return df.withColumns(
        {
            "profit_margin": F.when(
                (price > 0) & cost.isNotNull(),
                (price.cast("double") - cost.cast("double")) / price.cast("double") * F.lit(100.0),
            ),
            "is_valid_pricing": q.flag((price > 0) & (cost > 0) & (price >= cost)),
            "is_in_stock": q.flag(F.col("stock_qty") > 0),
            "processed_at": q.batch_time(batch_ts),
        }
    )


def _order_timestamp(df: DataFrame) -> DataFrame:
    """Standardise ``order_ts`` (text in several layouts) to a timestamp."""
    if isinstance(df.schema["order_ts"].dataType, StringType):
        return df.withColumn("order_ts", q.parsed_timestamp("order_ts", ORDER_TS_FORMATS))
    return df


def silver_orders(bronze: DataFrame, batch_ts: datetime | None = None) -> DataFrame:
    df = keep_first(bronze.filter(F.col("order_id").isNotNull()), ["order_id"])
    df = df.withColumns({"status": F.upper(F.trim("status")), "payment_method": F.trim("payment_method")})
    df = df.withColumns(q.clamped(df, ["shipping_cost"]))
    df = q.line_checks(df, unit=q.FRACTION)
    df = _order_timestamp(df)
    return df.withColumns({"order_date": F.to_date("order_ts"), "processed_at": q.batch_time(batch_ts)})


def silver_transactions(
    bronze: DataFrame, batch_ts: datetime | None = None, discount_unit: str = q.FRACTION
) -> DataFrame:
    df = keep_first(bronze.filter(F.col("transaction_id").isNotNull()), ["transaction_id"])
    df = q.line_checks(_dates(df, ("transaction_date",)), unit=discount_unit)
    return df.withColumn("processed_at", q.batch_time(batch_ts))
