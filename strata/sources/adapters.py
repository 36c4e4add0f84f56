"""Bronze entity frames derived from the driver's TPC-H-like tables.

The reference reads four raw retail CSV files and a folder of bike-ride CSV
files.  The driver ships TPC-H-like parquet tables instead, so these adapters
map them onto the entity schemas the jobs expect (FIXTURES.md §2) and inject
dirty values by key arithmetic, so that every cleaning rule has rows to act
on.  Each adapter is one scan of its source table(s) plus column expressions;
Spark broadcasts the small dimensions ``nation`` and ``region`` by their size.

The DuckDB oracle (``strata.oracle_sql``) repeats these expressions as CTEs.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.quality import wall_clock
from strata.operators.sequence import NEXT, with_neighbor
from strata.sources.tables import DriverTables

MONEY = "decimal(18,2)"


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _null(dtype: str = "string") -> Column:
    return F.lit(None).cast(dtype)


def _with_copies(rows: DataFrame, copies: list[tuple[Column, dict[str, Column]]]) -> DataFrame:
    """Every row once, plus one extra copy per ``(condition, replacements)``
    whose condition holds, with those columns replaced.  One scan of the
    source and an ``explode``, instead of a union of several scans."""
    marks = [F.lit(0), *[F.when(cond, F.lit(i + 1)) for i, (cond, _) in enumerate(copies)]]
    out = rows.withColumn("_copy", F.explode(F.array_compact(F.array(*marks))))
    for i, (_, replace) in enumerate(copies):
        if replace:
            out = out.withColumns(
                {c: F.when(F.col("_copy") == i + 1, e).otherwise(F.col(c)) for c, e in replace.items()}
            )
    return out.drop("_copy")


def _geography(t: DriverTables) -> DataFrame:
    region = t.region.select("r_regionkey", "r_name")
    return (
        t.nation.select("n_nationkey", "n_name", "n_regionkey")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("n_nationkey", "n_name", "r_name")
    )


def _customer_rows(t: DriverTables) -> DataFrame:
    """One bronze row per driver customer, with the key kept as ``_k``."""
    k = F.col("c_custkey")
    ks = _s(k)
    base = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment").join(
        _geography(t), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    rows = base.select(
        F.when(k % 97 == 0, _null())
        .when(k % 50 == 0, F.concat(F.lit("X_"), ks))
        .when(k % 53 == 0, F.concat(F.lit(" CUST_"), ks))
        .otherwise(F.concat(F.lit("CUST_"), ks))
        .alias("customer_id"),
        F.lit("  Customer ").alias("first_name"),
        F.substring("c_name", 10, 64).alias("last_name"),
        F.when(k % 11 == 0, _null())
        .when(k % 7 == 0, F.concat(F.lit("  User"), ks, F.lit("Example.COM ")))
        .when(k % 13 == 0, F.concat(F.lit("User"), ks, F.lit("@example.c")))
        .otherwise(F.concat(F.lit("  User"), ks, F.lit("@Example.COM ")))
        .alias("email"),
        F.concat(F.lit(" "), ks, F.lit(" Main Street ")).alias("address"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.concat(F.col("n_name"), F.lit(" ")).alias("country"),
        F.when(k % 2 == 0, F.lit(" f ")).otherwise(F.lit("M")).alias("gender"),
        F.col("c_mktsegment").alias("loyalty_tier"),
        _date_text("1950-01-01", k % 18000, k).alias("date_of_birth"),
        _date_text("2015-01-01", k % 3000, k + 1).alias("registration_date"),
        k.alias("_k"),
    )
    return rows


def _date_text(first: str, days: Column, k: Column) -> Column:
    """A date some days after ``first`` as text: two layouts, some malformed."""
    day = F.date_add(F.lit(first).cast("date"), days.cast("int"))
    return (
        F.when(k % 89 == 0, F.lit("unknown"))
        .when(k % 4 == 0, F.date_format(day, "MM/dd/yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )


def _customer_copies() -> list[tuple[Column, dict[str, Column]]]:
    # A second copy with a different payload (it sorts first, so keep-first
    # picks it) and an exact copy, so that deduplication has work to do.
    k = F.col("_k")
    return [
        (k % 19 == 0, {"first_name": F.lit("  Customer"), "loyalty_tier": F.lower("loyalty_tier")}),
        (k % 23 == 0, {}),
    ]


def bronze_customers(t: DriverTables) -> DataFrame:
    """customer_id, first_name, last_name, email, address, city, state,
    country, gender, loyalty_tier, date_of_birth, registration_date (two
    layouts, some malformed) — all strings, as read from CSV."""
    return _with_copies(_customer_rows(t), _customer_copies()).drop("_k")


def bronze_products(t: DriverTables) -> DataFrame:
    """product_id, product_name, category, sub_category, brand, sku,
    unit_price, cost_price (decimal money), stock_qty (int)."""
    k = F.col("p_partkey")
    price = F.col("p_retailprice")
    rows = t.part.select(
        _s(k).alias("product_id"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias("product_name"),
        F.col("p_type").alias("category"),
        F.concat(F.col("p_type"), F.lit(" ")).alias("sub_category"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit(" SKU-"), _s(k)).alias("sku"),
        F.when(k % 20 == 0, -price.cast(MONEY)).otherwise(price.cast(MONEY)).alias("unit_price"),
        F.when(k % 17 == 0, _null(MONEY))
        .when(k % 13 == 0, (price * 1.2).cast(MONEY))
        .otherwise((price * 0.6).cast(MONEY))
        .alias("cost_price"),
        (F.col("p_size") - 5).alias("stock_qty"),
        k.alias("_k"),
    )
    return _with_copies(rows, [(F.col("_k") % 31 == 0, {})]).drop("_k")


def bronze_orders(t: DriverTables) -> DataFrame:
    """order_id, customer_id, status, payment_method, quantity, unit_price,
    discount_pct, shipping_cost, line_total, return_flag, order_ts (string in
    two layouts, some malformed).  Every tenth order has no id (FLT-1 drops
    it), so that transactions without an order exist."""
    k = F.col("o_orderkey")
    ts = F.col("o_orderdate")
    rows = (
        t.orders.select(
            F.when(k % 10 == 0, _null()).otherwise(_s(k)).alias("order_id"),
            F.concat(F.lit("CUST_"), _s("o_custkey")).alias("customer_id"),
            F.concat(F.lit(" "), F.lower("o_orderstatus")).alias("status"),
            F.concat(F.col("o_orderpriority"), F.lit(" ")).alias("payment_method"),
            F.lit(1).alias("quantity"),
            F.col("o_totalprice").alias("unit_price"),
            F.when(k % 7 == 0, F.lit(-0.1))
            .when(k % 11 == 0, F.lit(1.5))
            .otherwise(F.lit(0.0))
            .alias("discount_pct"),
            ((k % 30) - 2).cast("double").alias("shipping_cost"),
            F.col("o_totalprice").alias("line_total"),
            F.when(k % 9 == 0, _null("boolean"))
            .otherwise(F.col("o_orderstatus") == "F")
            .alias("return_flag"),
            F.when(k % 173 == 0, F.lit("N/A"))
            .when(k % 4 == 0, F.date_format(ts, "MM/dd/yyyy"))
            .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .alias("order_ts"),
            k.alias("_k"),
        )
    )
    return _with_copies(rows, [(F.col("_k") % 37 == 0, {})]).drop("_k")


def bronze_transactions(t: DriverTables) -> DataFrame:
    """transaction_id (``orderkey-linenumber``: not unique, on purpose),
    order_id, product_id, quantity (int), unit_price (double), discount_pct
    (fraction with out-of-range and NULL values), line_total (decimal),
    transaction_date (date), return_flag (boolean)."""
    p = F.col("l_partkey")
    disc = F.col("l_discount")
    return t.lineitem.select(
        F.when(p % 211 == 0, _null())
        .otherwise(F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber")))
        .alias("transaction_id"),
        _s("l_orderkey").alias("order_id"),
        _s(p).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.when(p % 43 == 0, _null("double"))
        .when(p % 40 == 0, F.lit(-0.05))
        .when(p % 41 == 0, F.lit(1.5))
        .otherwise(disc)
        .alias("discount_pct"),
        (F.col("l_extendedprice").cast(MONEY) * (F.lit(1) - disc.cast(MONEY)))
        .cast(MONEY)
        .alias("line_total"),
        F.col("l_shipdate").cast("date").alias("transaction_date"),
        (F.col("l_returnflag") == "R").alias("return_flag"),
    )


def transactions_as_text(t: DriverTables) -> DataFrame:
    """Bronze transactions as a raw file gives them: ``transaction_date`` as
    text in two layouts (some malformed) and the discount in percent."""
    p = F.col("product_id").cast("long")
    day = F.col("transaction_date")
    return bronze_transactions(t).withColumns(
        {
            "discount_pct": F.col("discount_pct") * 100,
            "transaction_date": F.when(p % 83 == 0, F.lit("n/a"))
            .when(p % 3 == 0, F.date_format(day, "MM/dd/yyyy"))
            .otherwise(F.date_format(day, "yyyy-MM-dd")),
        }
    )


def bronze_rides(t: DriverTables) -> DataFrame:
    """Bike rides as raw CSV strings: ride_id, start_time, end_time,
    start_station_id, end_station_id, bike_id, user_type.

    A ride is an event and the next event of the same user (ordered by time,
    then id); the last event of each user has no ride.  The next event comes
    from ``with_neighbor`` (global order + join on position), so a user with
    a huge share of the events does not end up in one task.
    """
    e = t.events.select("event_id", "ts", "user_id", "event_type")
    e = with_neighbor(e, ["user_id"], ["ts", "event_id"], ["ts", "event_type"], NEXT, prefix="end_")
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    k = F.col("event_id")
    return e.filter(F.col("end_ts").isNotNull()).select(
        _s(k).alias("ride_id"),
        F.when(k % 29 == 0, F.lit("bad-time"))
        .otherwise(F.date_format("ts", fmt))
        .alias("start_time"),
        F.date_format("end_ts", fmt).alias("end_time"),
        F.when(k % 31 == 0, _null()).otherwise(F.col("event_type")).alias("start_station_id"),
        F.col("end_event_type").alias("end_station_id"),
        _s("user_id").alias("bike_id"),
        F.when(k % 23 == 0, _null())
        .when(k % 2 == 0, F.lit("member"))
        .otherwise(F.lit("casual"))
        .alias("user_type"),
    )


# --- change feeds for the incremental jobs -----------------------------------

# Change times of the two simulated batches (fixed values of the fixtures).
BATCH1_AT = datetime(2024, 1, 1)
BATCH2_AT = datetime(2024, 2, 1)
DELETES_AT = datetime(2024, 2, 2)


def _at(ts: datetime) -> Column:
    return wall_clock(ts)


def customer_feed(t: DriverTables) -> DataFrame:
    """Bronze customer rows + ``updated_at``.

    Batch 1 (2024-01-01): every bronze row.  Batch 2 (2024-02-01): customers
    with key % 3 = 0 get a new loyalty tier (tracked), key % 5 = 0 a new last
    name (not tracked), key % 8 = 0 arrive again unchanged.
    """
    k = F.col("_k")
    rows = _customer_rows(t).withColumn("updated_at", _at(BATCH1_AT))
    second = (
        (k % 3 == 0) | (k % 5 == 0) | (k % 8 == 0),
        {
            "loyalty_tier": F.when(k % 3 == 0, F.lit("PLATINUM")).otherwise(F.col("loyalty_tier")),
            "last_name": F.when(k % 5 == 0, F.concat(F.col("last_name"), F.lit("-B"))).otherwise(F.col("last_name")),
            "updated_at": _at(BATCH2_AT),
        },
    )
    return _with_copies(rows, [*_customer_copies(), second]).drop("_k")


def transaction_feed(t: DriverTables) -> DataFrame:
    """Bronze transaction rows + ``cdc_operation`` + ``updated_at``.

    Batch 1 (2024-01-01): every row as an insert.  Batch 2: product % 5 = 0
    updated with quantity + 1 (2024-02-01), product % 7 = 0 deleted
    (2024-02-02), product % 101 = 0 inserted again under a new id ``N-...``
    (2024-02-01).
    """
    rows = bronze_transactions(t).withColumns({"cdc_operation": F.lit("I"), "updated_at": _at(BATCH1_AT)})
    part = F.col("product_id").cast("long")
    return _with_copies(
        rows,
        [
            (
                part % 5 == 0,
                {"quantity": F.col("quantity") + 1, "cdc_operation": F.lit("U"), "updated_at": _at(BATCH2_AT)},
            ),
            (part % 7 == 0, {"cdc_operation": F.lit("D"), "updated_at": _at(DELETES_AT)}),
            (
                part % 101 == 0,
                {"transaction_id": F.concat(F.lit("N-"), F.col("transaction_id")), "updated_at": _at(BATCH2_AT)},
            ),
        ],
    )
