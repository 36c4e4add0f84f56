"""Gold KPI tables built from the silver frames.

Plan notes (checked with ``explain``):

* Transactions join orders on ``order_id``; at scale both sides are
  hash-partitioned on it (sort-merge join) and a following aggregate keyed
  by ``(date, order_id)`` reuses that partitioning, so the distinct count
  costs no extra shuffle and only one partial row per group crosses the
  next one.  When AQE broadcasts a small orders side instead, one extra
  exchange carries already pre-aggregated rows.
* Every aggregate is partial (map-side) first, so a hot date, product or
  customer sends one partial row per map task, not its raw rows.
* Rankings use ``global_row_number`` (range-partitioned, no single-task
  window) or ``top_k`` when only the first k ranks are wanted.
* Running and moving sums over the daily tables use ``running_sums`` /
  ``moving_sums``: a range-partitioned prefix sum at every size, so no
  unbounded set meets in one task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import quality as q
from strata.operators.rank import global_row_number, moving_sums, running_sums, top_k

REVENUE = "decimal(28,2)"
WIDE_MONEY = "decimal(38,2)"


def _kept(txn: DataFrame) -> DataFrame:
    """Transactions that were not returned (the revenue base)."""
    return txn.filter(~F.col("is_returned"))


def _stamp(df: DataFrame, batch_ts: datetime | None) -> DataFrame:
    return df.withColumn("_updated_at", q.batch_time(batch_ts))


def _order_days(txn: DataFrame) -> DataFrame:
    """order_id, transaction_date, spent, lines: the kept lines of an order on
    one day as one row, so that what follows (a join, a daily roll-up) sees an
    order once per day, however many lines it has."""
    return _kept(txn).groupBy("order_id", "transaction_date").agg(
        F.sum("line_total").cast(REVENUE).alias("spent"), F.count("transaction_id").alias("lines")
    )


def _by_day(order_days: DataFrame, *more) -> DataFrame:
    """snapshot_date, total_revenue, total_orders and ``more`` per day."""
    days = order_days.groupBy(F.col("transaction_date").alias("snapshot_date"))
    return days.agg(F.sum("spent").cast(REVENUE).alias("total_revenue"), F.count("order_id").alias("total_orders"), *more)


def gold_total_revenue(txn: DataFrame, orders: DataFrame, batch_ts: datetime | None = None) -> DataFrame:
    """snapshot_date, total_revenue, total_orders, total_transactions.

    Only transactions whose order exists count; orders are unique per id
    after silver, so the inner join of the reference is a semi-join here.
    """
    known = _order_days(txn).join(orders.select("order_id"), "order_id", "left_semi")
    return _stamp(_by_day(known, F.sum("lines").alias("total_transactions")), batch_ts)


def _spend_by_customer(txn: DataFrame, orders: DataFrame) -> DataFrame:
    # One row per order enters the join.
    baskets = _kept(txn).groupBy("order_id").agg(F.sum("line_total").alias("spent"))
    owned = baskets.join(orders.select("order_id", "customer_id"), "order_id").groupBy("customer_id")
    spend = owned.agg(F.sum("spent").cast(REVENUE).alias("total_revenue"), F.count(F.lit(1)).alias("total_orders"))
    return spend.withColumn("avg_order_value", q.safe_ratio(F.col("total_revenue"), F.col("total_orders")))


def _ranked(df: DataFrame, order, name: str, limit: int | None) -> DataFrame:
    if limit is None:
        return global_row_number(df, order, name)
    return top_k(df, order, limit, name)


def gold_top_customers(
    txn: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    batch_ts: datetime | None = None,
    limit: int | None = None,
    enriched: bool = False,
    ranked: bool = True,
) -> DataFrame:
    """customer_id, full_name, contact, total_revenue, total_orders,
    avg_order_value, revenue_rank (1 = highest revenue, ties by id).

    ``enriched`` adds city, state and loyalty_tier (the demographic columns
    the reference names in prose).  ``limit`` keeps only the first ranks,
    ``ranked=False`` leaves the rank out.
    """
    extra = ["city", "state", "loyalty_tier"] if enriched else []
    people = customers.select("customer_id", "first_name", "last_name", "email", *extra)
    df = _spend_by_customer(txn, orders).join(people, "customer_id").select(
        "customer_id",
        F.concat_ws(" ", "first_name", "last_name").alias("full_name"),
        F.col("email").alias("contact"),
        "total_revenue",
        "total_orders",
        "avg_order_value",
        *extra,
    )
    if not ranked:
        return _stamp(df, batch_ts)
    order = [F.desc("total_revenue"), F.asc("customer_id")]
    return _stamp(_ranked(df, order, "revenue_rank", limit), batch_ts)


def _sales_by_product(txn: DataFrame) -> DataFrame:
    sums = {
        "total_revenue": F.sum("line_total").cast(REVENUE),
        "total_qty_sold": F.sum("quantity").cast("long"),
        "total_transactions": F.count("transaction_id"),
    }
    return _kept(txn).groupBy("product_id").agg(*[value.alias(name) for name, value in sums.items()])


def gold_top_products(
    txn: DataFrame,
    products: DataFrame,
    batch_ts: datetime | None = None,
    limit: int | None = None,
    ranked: bool = True,
) -> DataFrame:
    """product_id, product_name, category_name, total_qty_sold,
    total_revenue, sales_rank.  ``ranked=False`` leaves out the rank (for
    consumers that only group the products, so no ranking pass is paid)."""
    info = products.select("product_id", "product_name", F.col("category").alias("category_name"))
    df = _sales_by_product(txn).join(info, "product_id").select(
        "product_id", "product_name", "category_name", "total_qty_sold", "total_revenue"
    )
    if not ranked:
        return _stamp(df, batch_ts)
    order = [F.desc("total_revenue"), F.asc("product_id")]
    return _stamp(_ranked(df, order, "sales_rank", limit), batch_ts)


def gold_avg_order_value(txn: DataFrame, batch_ts: datetime | None = None) -> DataFrame:
    """snapshot_date, total_revenue, total_orders, avg_order_value.

    Orders are totalled per (order, day) first; an order whose lines ship on
    several days counts once on each of them (as in the reference).
    """
    daily = _by_day(_order_days(txn))
    return _stamp(daily.withColumn("avg_order_value", q.safe_ratio(F.col("total_revenue"), F.col("total_orders"))), batch_ts)


def gold_return_rate(txn: DataFrame, orders: DataFrame, batch_ts: datetime | None = None) -> DataFrame:
    """snapshot_date, total_orders, returned_orders, return_rate_pct.

    All transactions count (returned or not); "returned" is the order-level
    flag.  The flag is a property of the order, so one row per (day, order)
    goes into the join and plain counts follow (two distinct counts would be
    planned with an Expand that doubles rows).
    """
    per_order = txn.select("order_id", "transaction_date").distinct()
    per_order = per_order.join(orders.select("order_id", "return_flag"), "order_id")
    daily = per_order.groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(F.col("return_flag")).alias("returned_orders"),
    )
    daily = daily.withColumn(
        "return_rate_pct", q.safe_ratio(F.col("returned_orders"), F.col("total_orders"), 100.0)
    )
    return _stamp(daily.withColumnRenamed("transaction_date", "snapshot_date"), batch_ts)


# --- items the reference states in prose only (SURVEY "S" rows) -------------


def gold_daily_revenue_kpis(total_revenue: DataFrame) -> DataFrame:
    """Daily revenue with year/month, average transaction value and the
    running total (WIN-3, DT-6, JOB-G9).  The running total is a prefix sum
    over the days (``running_sums``)."""
    daily = total_revenue.select(
        "snapshot_date",
        F.year("snapshot_date").alias("year"),
        F.month("snapshot_date").alias("month"),
        "total_revenue",
        "total_orders",
        "total_transactions",
        q.safe_ratio(F.col("total_revenue"), F.col("total_transactions")).alias("avg_transaction_value"),
    )
    out = running_sums(daily, ["snapshot_date"], ["total_revenue"], "cum_")
    return out.withColumn("cumulative_revenue", F.col("cum_total_revenue").cast(WIDE_MONEY)).drop(
        "cum_total_revenue"
    )


def gold_revenue_monthly(total_revenue: DataFrame) -> DataFrame:
    """Monthly roll-up of the daily table (DT-6).  ``total_orders`` is a sum
    of daily distinct counts, like the dashboard's total."""
    monthly = (
        total_revenue.groupBy(F.year("snapshot_date").alias("year"), F.month("snapshot_date").alias("month"))
        .agg(
            F.sum("total_revenue").cast(WIDE_MONEY).alias("total_revenue"),
            F.sum("total_orders").cast("long").alias("total_orders"),
            F.sum("total_transactions").cast("long").alias("total_transactions"),
        )
    )
    return monthly.withColumn(
        "avg_transaction_value", q.safe_ratio(F.col("total_revenue"), F.col("total_transactions"))
    )


def gold_revenue_yearly(total_revenue: DataFrame) -> DataFrame:
    """Yearly roll-up of the daily table (DT-6)."""
    yearly = total_revenue.groupBy(F.year("snapshot_date").alias("year")).agg(
        F.sum("total_revenue").cast(WIDE_MONEY).alias("total_revenue"),
        F.sum("total_orders").cast("long").alias("total_orders"),
        F.sum("total_transactions").cast("long").alias("total_transactions"),
    )
    return yearly.withColumn(
        "avg_transaction_value", q.safe_ratio(F.col("total_revenue"), F.col("total_transactions"))
    )


def gold_aov_by_period(avg_order_value: DataFrame, monthly: bool = True) -> DataFrame:
    """Average order value by year, or by year and month (DT-6): revenue over
    orders of the period's days taken together."""
    periods = [F.year("snapshot_date").alias("year")]
    periods += [F.month("snapshot_date").alias("month")] if monthly else []
    sums = avg_order_value.groupBy(*periods).agg(
        F.sum("total_revenue").cast(WIDE_MONEY).alias("total_revenue"),
        F.sum("total_orders").cast("long").alias("total_orders"),
    )
    return sums.withColumn("avg_order_value", q.safe_ratio(F.col("total_revenue"), F.col("total_orders")))


def gold_aov_moving_average(avg_order_value: DataFrame, days: int = 7) -> DataFrame:
    """AOV over the last ``days`` daily rows (WIN-4): revenue / orders over
    the frame, i.e. the AOV of those days taken together."""
    frame = moving_sums(avg_order_value, ["snapshot_date"], ["total_revenue", "total_orders"], days, "m_")
    return frame.select(
        "snapshot_date",
        "avg_order_value",
        q.safe_ratio(F.col("m_total_revenue"), F.col("m_total_orders")).alias(f"moving_avg_order_value_{days}d"),
    )


def gold_product_profit(txn: DataFrame, products: DataFrame) -> DataFrame:
    """Transactions, revenue, cost, profit and margin per product sold (JOB-G6).

    Cost is quantity x the product's cost price; quantities are summed per
    product before the join, so the join sees one row per product.
    """
    info = products.select(
        "product_id", "product_name", F.col("category").alias("category_name"), "cost_price"
    )
    df = _sales_by_product(txn).join(info, "product_id")
    cost = (F.col("total_qty_sold") * F.col("cost_price")).cast(WIDE_MONEY)
    return df.select(
        "product_id",
        "product_name",
        "category_name",
        "total_qty_sold",
        "total_transactions",
        "total_revenue",
        cost.alias("total_cost"),
        (F.col("total_revenue") - cost).cast(WIDE_MONEY).alias("total_profit"),
        q.safe_ratio(F.col("total_revenue") - cost, F.col("total_revenue"), 100.0).alias("profit_margin_pct"),
    )


def _return_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    returned = F.col("is_returned")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(returned).alias("returned_transactions"),
        F.coalesce(F.sum(F.when(returned, F.col("line_total"))), F.lit(0)).cast(REVENUE).alias("returned_revenue"),
    )


def _with_rate(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "return_rate_pct",
        q.safe_ratio(F.col("returned_transactions"), F.col("total_transactions"), 100.0),
    )


def gold_return_rate_by_product(txn: DataFrame, products: DataFrame) -> DataFrame:
    """Transaction-level return counts, rate and returned revenue per
    product (JOB-G7)."""
    info = products.select("product_id", "product_name", F.col("category").alias("category_name"))
    return _with_rate(_return_counts(txn, ["product_id"]).join(info, "product_id"))


def gold_return_rate_by_category(txn: DataFrame, products: DataFrame) -> DataFrame:
    """The same per category: per-product partial counts are rolled up, so
    the product join sees one row per product (JOB-G7)."""
    per_product = _return_counts(txn, ["product_id"]).join(
        products.select("product_id", F.col("category").alias("category_name")), "product_id"
    )
    per_category = per_product.groupBy("category_name").agg(
        F.sum("total_transactions").cast("long").alias("total_transactions"),
        F.sum("returned_transactions").cast("long").alias("returned_transactions"),
        F.sum("returned_revenue").cast(REVENUE).alias("returned_revenue"),
    )
    return _with_rate(per_category)
