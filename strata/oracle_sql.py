"""DuckDB SQL for each registered query, written independently of Spark.

The driver runs these on the same parquet tables (pre-registered views) and
compares row count, schema and values with the Spark result.  Entity
adapters are repeated as CTEs; ``build(body, *ctes)`` pulls in every CTE a
query needs, in dependency order.

Typing choices that keep both engines equal (SURVEY §7.4): money is
DECIMAL(18,2) and its sums are cast to DECIMAL(28,2) or (38,2); integer sums
are cast to BIGINT; ratios are computed in DOUBLE from exact operands; rank
columns are BIGINT; ``ORDER BY`` inside windows says NULLS FIRST (Spark's
ascending default).
"""

from __future__ import annotations

from strata.plans.medallion import SHOWN
from strata.plans.rides import GOLD_RIDES, SILVER_RIDES

# The rules' patterns.
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
CUST_ID = r"^CUST_\d+$"


def _first(table: str, key: str, order: list[str]) -> str:
    """Keep-first dedupe, same tiebreak as ``keep_first``."""
    by = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    return (
        f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {by}) AS _rn FROM {table}) WHERE _rn = 1"
    )


CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


def build(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    parts = ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order)
    return f"WITH {parts}\n{body}"


# --- bronze adapters ---------------------------------------------------------

cte(
    "geo",
    "SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n "
    "LEFT JOIN region r ON n.n_regionkey = r.r_regionkey",
)
cte(
    "bc_rows",
    f"""
SELECT
  CASE WHEN c_custkey % 97 = 0 THEN NULL
       WHEN c_custkey % 50 = 0 THEN 'X_' || CAST(c_custkey AS VARCHAR)
       WHEN c_custkey % 53 = 0 THEN ' CUST_' || CAST(c_custkey AS VARCHAR)
       ELSE 'CUST_' || CAST(c_custkey AS VARCHAR) END AS customer_id,
  '  Customer ' AS first_name,
  substr(c_name, 10, 64) AS last_name,
  CASE WHEN c_custkey % 11 = 0 THEN NULL
       WHEN c_custkey % 7 = 0 THEN '  User' || CAST(c_custkey AS VARCHAR) || 'Example.COM '
       WHEN c_custkey % 13 = 0 THEN 'User' || CAST(c_custkey AS VARCHAR) || '@example.c'
       ELSE '  User' || CAST(c_custkey AS VARCHAR) || '@Example.COM ' END AS email,
  ' ' || CAST(c_custkey AS VARCHAR) || ' Main Street ' AS address,
  g.n_name AS city,
  g.r_name AS state,
  g.n_name || ' ' AS country,
  CASE WHEN c_custkey % 2 = 0 THEN ' f ' ELSE 'M' END AS gender,
  c_mktsegment AS loyalty_tier,
  CASE WHEN c_custkey % 89 = 0 THEN 'unknown'
       WHEN c_custkey % 4 = 0 THEN strftime(DATE '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER), '%m/%d/%Y')
       ELSE strftime(DATE '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER), '%Y-%m-%d') END AS date_of_birth,
  CASE WHEN (c_custkey + 1) % 89 = 0 THEN 'unknown'
       WHEN (c_custkey + 1) % 4 = 0 THEN strftime(DATE '2015-01-01' + CAST(c_custkey % 3000 AS INTEGER), '%m/%d/%Y')
       ELSE strftime(DATE '2015-01-01' + CAST(c_custkey % 3000 AS INTEGER), '%Y-%m-%d') END AS registration_date,
  c_custkey AS _k
FROM customer c LEFT JOIN geo g ON c.c_nationkey = g.n_nationkey""",
    "geo",
)
cte(
    "bronze_customers",
    """
SELECT * EXCLUDE (_k) FROM bc_rows
UNION ALL
SELECT customer_id, '  Customer' AS first_name, last_name, email, address, city, state,
       country, gender, lower(loyalty_tier) AS loyalty_tier, date_of_birth, registration_date
FROM bc_rows WHERE _k % 19 = 0
UNION ALL
SELECT * EXCLUDE (_k) FROM bc_rows WHERE _k % 23 = 0""",
    "bc_rows",
)
cte(
    "bp_rows",
    """
SELECT
  CAST(p_partkey AS VARCHAR) AS product_id,
  ' ' || p_name || ' ' AS product_name,
  p_type AS category,
  p_type || ' ' AS sub_category,
  p_brand AS brand,
  ' SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
  CASE WHEN p_partkey % 20 = 0 THEN -CAST(p_retailprice AS DECIMAL(18,2))
       ELSE CAST(p_retailprice AS DECIMAL(18,2)) END AS unit_price,
  CASE WHEN p_partkey % 17 = 0 THEN CAST(NULL AS DECIMAL(18,2))
       WHEN p_partkey % 13 = 0 THEN CAST(p_retailprice * CAST(1.2 AS DOUBLE) AS DECIMAL(18,2))
       ELSE CAST(p_retailprice * CAST(0.6 AS DOUBLE) AS DECIMAL(18,2)) END AS cost_price,
  p_size - 5 AS stock_qty,
  p_partkey AS _k
FROM part""",
)
cte(
    "bronze_products",
    "SELECT * EXCLUDE (_k) FROM bp_rows UNION ALL SELECT * EXCLUDE (_k) FROM bp_rows WHERE _k % 31 = 0",
    "bp_rows",
)
cte(
    "bo_rows",
    """
SELECT
  CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS order_id,
  'CUST_' || CAST(o_custkey AS VARCHAR) AS customer_id,
  ' ' || lower(o_orderstatus) AS status,
  o_orderpriority || ' ' AS payment_method,
  1 AS quantity,
  o_totalprice AS unit_price,
  CASE WHEN o_orderkey % 7 = 0 THEN CAST(-0.1 AS DOUBLE)
       WHEN o_orderkey % 11 = 0 THEN CAST(1.5 AS DOUBLE)
       ELSE CAST(0.0 AS DOUBLE) END AS discount_pct,
  CAST((o_orderkey % 30) - 2 AS DOUBLE) AS shipping_cost,
  o_totalprice AS line_total,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderstatus = 'F' END AS return_flag,
  CASE WHEN o_orderkey % 173 = 0 THEN 'N/A'
       WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%m/%d/%Y')
       ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_ts,
  o_orderkey AS _k
FROM orders""",
)
cte(
    "bronze_orders",
    "SELECT * EXCLUDE (_k) FROM bo_rows UNION ALL SELECT * EXCLUDE (_k) FROM bo_rows WHERE _k % 37 = 0",
    "bo_rows",
)
cte(
    "bronze_transactions",
    """
SELECT
  CASE WHEN l_partkey % 211 = 0 THEN NULL
       ELSE CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS transaction_id,
  CAST(l_orderkey AS VARCHAR) AS order_id,
  CAST(l_partkey AS VARCHAR) AS product_id,
  CAST(l_quantity AS INTEGER) AS quantity,
  l_extendedprice / l_quantity AS unit_price,
  CASE WHEN l_partkey % 43 = 0 THEN CAST(NULL AS DOUBLE)
       WHEN l_partkey % 40 = 0 THEN CAST(-0.05 AS DOUBLE)
       WHEN l_partkey % 41 = 0 THEN CAST(1.5 AS DOUBLE)
       ELSE l_discount END AS discount_pct,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))
       AS DECIMAL(18,2)) AS line_total,
  CAST(l_shipdate AS DATE) AS transaction_date,
  l_returnflag = 'R' AS return_flag
FROM lineitem""",
)

# --- silver ------------------------------------------------------------------

cte(
    "sc_first",
    _first(
        f"(SELECT * FROM bronze_customers WHERE customer_id IS NOT NULL "
        f"AND regexp_matches(customer_id, '{CUST_ID}'))",
        "customer_id",
        "first_name last_name email address city state country gender loyalty_tier date_of_birth registration_date".split(),
    ),
    "bronze_customers",
)
cte(
    "silver_customers",
    f"""
SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
       lower(trim(email)) AS email, trim(address) AS address, trim(city) AS city,
       trim(state) AS state, trim(country) AS country, upper(trim(gender)) AS gender,
       trim(loyalty_tier) AS loyalty_tier,
       CAST(COALESCE(try_strptime(date_of_birth, '%Y-%m-%d'), try_strptime(date_of_birth, '%m/%d/%Y')) AS DATE) AS date_of_birth,
       CAST(COALESCE(try_strptime(registration_date, '%Y-%m-%d'), try_strptime(registration_date, '%m/%d/%Y')) AS DATE) AS registration_date,
       COALESCE(regexp_matches(lower(trim(email)), '{EMAIL}'), false) AS is_valid_email
FROM sc_first""",
    "sc_first",
)
cte(
    "sp_first",
    _first(
        "(SELECT * FROM bronze_products WHERE product_id IS NOT NULL)",
        "product_id",
        "product_name category sub_category brand sku unit_price cost_price stock_qty".split(),
    ),
    "bronze_products",
)
cte(
    "sp_clean",
    """
SELECT product_id, trim(product_name) AS product_name, trim(category) AS category,
       trim(sub_category) AS sub_category, trim(brand) AS brand, trim(sku) AS sku,
       CASE WHEN unit_price < 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE unit_price END AS unit_price,
       CASE WHEN cost_price < 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE cost_price END AS cost_price,
       CASE WHEN stock_qty < 0 THEN 0 ELSE stock_qty END AS stock_qty
FROM sp_first""",
    "sp_first",
)
cte(
    "silver_products",
    """
SELECT *,
  CASE WHEN unit_price > 0 AND cost_price IS NOT NULL
       THEN (CAST(unit_price AS DOUBLE) - CAST(cost_price AS DOUBLE)) / CAST(unit_price AS DOUBLE) * 100.0
  END AS profit_margin,
  COALESCE(unit_price > 0 AND cost_price > 0 AND unit_price >= cost_price, false) AS is_valid_pricing,
  COALESCE(stock_qty > 0, false) AS is_in_stock
FROM sp_clean""",
    "sp_clean",
)


def _line_checks(source: str, extra: str = "", upper: str = "1.0") -> str:
    """Clamp and flag, as ``quality.line_checks``; ``extra`` are more
    select items evaluated on the clamped row."""
    return f"""
SELECT *,
  COALESCE(abs(CAST(line_total AS DOUBLE) - calculated_line_total) < 0.01, false) AS is_valid_line_total,
  COALESCE(discount_pct > 0, false) AS has_discount,
  COALESCE(return_flag = true, false) AS is_returned{extra}
FROM (
  SELECT *,
    CAST(quantity AS DOUBLE) * CAST(unit_price AS DOUBLE)
      * (1.0 - COALESCE(discount_pct, 0.0) / {upper}) AS calculated_line_total
  FROM (
    SELECT * REPLACE (
      CASE WHEN quantity < 0 THEN 0 ELSE quantity END AS quantity,
      CASE WHEN unit_price < 0 THEN CAST(0 AS DOUBLE) ELSE unit_price END AS unit_price,
      CASE WHEN discount_pct < 0 THEN 0.0 WHEN discount_pct > {upper} THEN {upper}
           ELSE CAST(discount_pct AS DOUBLE) END AS discount_pct)
    FROM {source}
  )
)"""


cte(
    "so_first",
    _first(
        "(SELECT * FROM bronze_orders WHERE order_id IS NOT NULL)",
        "order_id",
        "customer_id status payment_method quantity unit_price discount_pct shipping_cost "
        "line_total return_flag order_ts".split(),
    ),
    "bronze_orders",
)
cte(
    "so_base",
    """
SELECT * REPLACE (
  upper(trim(status)) AS status,
  trim(payment_method) AS payment_method,
  CASE WHEN shipping_cost < 0 THEN CAST(0 AS DOUBLE) ELSE shipping_cost END AS shipping_cost)
FROM so_first""",
    "so_first",
)
cte(
    "so_checked",
    _line_checks("so_base"),
    "so_base",
)
cte(
    "silver_orders",
    """
SELECT *, CAST(order_ts AS DATE) AS order_date
FROM (
  SELECT * REPLACE (COALESCE(try_strptime(order_ts, '%Y-%m-%d %H:%M:%S'),
                             try_strptime(order_ts, '%m/%d/%Y')) AS order_ts)
  FROM so_checked
)""",
    "so_checked",
)
cte(
    "st_first",
    _first(
        "(SELECT * FROM bronze_transactions WHERE transaction_id IS NOT NULL)",
        "transaction_id",
        "order_id product_id quantity unit_price discount_pct line_total transaction_date return_flag".split(),
    ),
    "bronze_transactions",
)
cte("silver_transactions", _line_checks("st_first"), "st_first")

# --- gold --------------------------------------------------------------------

cte(
    "gold_total_revenue",
    """
SELECT transaction_date AS snapshot_date,
       CAST(SUM(line_total) AS DECIMAL(28,2)) AS total_revenue,
       COUNT(DISTINCT order_id) AS total_orders,
       COUNT(transaction_id) AS total_transactions
FROM silver_transactions
WHERE NOT is_returned AND order_id IN (SELECT order_id FROM silver_orders)
GROUP BY transaction_date""",
    "silver_transactions",
    "silver_orders",
)
cte(
    "customer_spend",
    """
SELECT o.customer_id,
       CAST(SUM(t.line_total) AS DECIMAL(28,2)) AS total_revenue,
       COUNT(DISTINCT t.order_id) AS total_orders,
       CAST(CAST(SUM(t.line_total) AS DECIMAL(28,2)) AS DOUBLE) / COUNT(DISTINCT t.order_id) AS avg_order_value
FROM silver_transactions t JOIN silver_orders o ON t.order_id = o.order_id
WHERE NOT t.is_returned
GROUP BY o.customer_id""",
    "silver_transactions",
    "silver_orders",
)
cte(
    "customer_profile",
    """
SELECT m.customer_id, concat_ws(' ', c.first_name, c.last_name) AS full_name, c.email AS contact,
       m.total_revenue, m.total_orders, m.avg_order_value, c.city, c.state, c.loyalty_tier,
       CAST(row_number() OVER (ORDER BY m.total_revenue DESC, m.customer_id ASC) AS BIGINT) AS revenue_rank
FROM customer_spend m JOIN silver_customers c ON m.customer_id = c.customer_id""",
    "customer_spend",
    "silver_customers",
)
cte(
    "gold_top_customers",
    "SELECT * EXCLUDE (city, state, loyalty_tier) FROM customer_profile",
    "customer_profile",
)
cte(
    "product_sales",
    """
SELECT product_id, CAST(SUM(line_total) AS DECIMAL(28,2)) AS total_revenue,
       CAST(SUM(quantity) AS BIGINT) AS total_qty_sold, COUNT(transaction_id) AS total_transactions
FROM silver_transactions WHERE NOT is_returned GROUP BY product_id""",
    "silver_transactions",
)
cte(
    "gold_top_products",
    """
SELECT m.product_id, p.product_name, p.category AS category_name, m.total_qty_sold, m.total_revenue,
       CAST(row_number() OVER (ORDER BY m.total_revenue DESC, m.product_id ASC) AS BIGINT) AS sales_rank
FROM product_sales m JOIN silver_products p ON m.product_id = p.product_id""",
    "product_sales",
    "silver_products",
)
cte(
    "gold_avg_order_value",
    """
SELECT transaction_date AS snapshot_date,
       CAST(SUM(order_total) AS DECIMAL(28,2)) AS total_revenue,
       COUNT(order_id) AS total_orders,
       CAST(CAST(SUM(order_total) AS DECIMAL(28,2)) AS DOUBLE) / COUNT(order_id) AS avg_order_value
FROM (
  SELECT order_id, transaction_date, CAST(SUM(line_total) AS DECIMAL(28,2)) AS order_total
  FROM silver_transactions WHERE NOT is_returned GROUP BY order_id, transaction_date
) GROUP BY transaction_date""",
    "silver_transactions",
)
cte(
    "gold_return_rate",
    """
SELECT t.transaction_date AS snapshot_date,
       COUNT(DISTINCT t.order_id) AS total_orders,
       COUNT(DISTINCT CASE WHEN o.return_flag THEN t.order_id END) AS returned_orders,
       CAST(COUNT(DISTINCT CASE WHEN o.return_flag THEN t.order_id END) AS DOUBLE)
         / COUNT(DISTINCT t.order_id) * 100.0 AS return_rate_pct
FROM silver_transactions t JOIN silver_orders o ON t.order_id = o.order_id
GROUP BY t.transaction_date""",
    "silver_transactions",
    "silver_orders",
)
cte(
    "return_counts_by_product",
    """
SELECT product_id, COUNT(*) AS total_transactions,
       COUNT(*) FILTER (WHERE is_returned) AS returned_transactions,
       CAST(COALESCE(SUM(CASE WHEN is_returned THEN line_total END), 0) AS DECIMAL(28,2)) AS returned_revenue
FROM silver_transactions GROUP BY product_id""",
    "silver_transactions",
)

SILVER = ("silver_customers", "silver_products", "silver_orders", "silver_transactions")
GOLD = ("gold_total_revenue", "gold_top_customers", "gold_top_products", "gold_avg_order_value", "gold_return_rate")

ORACLE: dict[str, str] = {}
for _name in SILVER + GOLD:
    ORACLE[_name] = build(f"SELECT * FROM {_name}", _name)

ORACLE.update(
    {
        "ds_revenue_summary": build(
            """
SELECT CAST(SUM(total_revenue) AS DECIMAL(38,2)) AS total_revenue,
       CAST(SUM(total_orders) AS BIGINT) AS total_orders,
       CAST(SUM(total_transactions) AS BIGINT) AS total_transactions
FROM gold_total_revenue""",
            "gold_total_revenue",
        ),
        "ds_top_products": build(
            "SELECT product_name, total_revenue, sales_rank FROM gold_top_products "
            "WHERE sales_rank <= 10 ORDER BY sales_rank",
            "gold_top_products",
        ),
        "ds_return_rate_summary": build(
            "SELECT round(AVG(return_rate_pct), 6) AS avg_return_rate FROM gold_return_rate", "gold_return_rate"
        ),
        "ds_aov_trend": build(
            "SELECT snapshot_date, avg_order_value FROM gold_avg_order_value ORDER BY snapshot_date",
            "gold_avg_order_value",
        ),
        "ds_revenue_trend": build(
            "SELECT snapshot_date, total_revenue FROM gold_total_revenue ORDER BY snapshot_date",
            "gold_total_revenue",
        ),
        "ds_top_customers": build(
            "SELECT full_name, total_revenue, total_orders, avg_order_value, revenue_rank "
            "FROM gold_top_customers WHERE revenue_rank <= 10 ORDER BY revenue_rank",
            "gold_top_customers",
        ),
        "ds_category_distribution": build(
            "SELECT category_name, COUNT(*) AS product_count FROM gold_top_products GROUP BY category_name",
            "gold_top_products",
        ),
        "gold_daily_revenue_kpis": build(
            """
SELECT snapshot_date, CAST(year(snapshot_date) AS INTEGER) AS year, CAST(month(snapshot_date) AS INTEGER) AS month,
       total_revenue, total_orders, total_transactions,
       CAST(total_revenue AS DOUBLE) / total_transactions AS avg_transaction_value,
       CAST(SUM(total_revenue) OVER (ORDER BY snapshot_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS DECIMAL(38,2)) AS cumulative_revenue
FROM gold_total_revenue""",
            "gold_total_revenue",
        ),
        "gold_revenue_monthly": build(
            """
SELECT CAST(year(snapshot_date) AS INTEGER) AS year, CAST(month(snapshot_date) AS INTEGER) AS month,
       CAST(SUM(total_revenue) AS DECIMAL(38,2)) AS total_revenue,
       CAST(SUM(total_orders) AS BIGINT) AS total_orders,
       CAST(SUM(total_transactions) AS BIGINT) AS total_transactions,
       CAST(CAST(SUM(total_revenue) AS DECIMAL(38,2)) AS DOUBLE) / SUM(total_transactions) AS avg_transaction_value
FROM gold_total_revenue GROUP BY 1, 2""",
            "gold_total_revenue",
        ),
        "gold_revenue_yearly": build(
            """
SELECT CAST(year(snapshot_date) AS INTEGER) AS year, CAST(SUM(total_revenue) AS DECIMAL(38,2)) AS total_revenue,
       CAST(SUM(total_orders) AS BIGINT) AS total_orders, CAST(SUM(total_transactions) AS BIGINT) AS total_transactions,
       CAST(CAST(SUM(total_revenue) AS DECIMAL(38,2)) AS DOUBLE) / SUM(total_transactions) AS avg_transaction_value
FROM gold_total_revenue GROUP BY 1""",
            "gold_total_revenue",
        ),
        "gold_aov_monthly": build(
            """
SELECT CAST(year(snapshot_date) AS INTEGER) AS year, CAST(month(snapshot_date) AS INTEGER) AS month,
       CAST(SUM(total_revenue) AS DECIMAL(38,2)) AS total_revenue, CAST(SUM(total_orders) AS BIGINT) AS total_orders,
       CAST(CAST(SUM(total_revenue) AS DECIMAL(38,2)) AS DOUBLE) / SUM(total_orders) AS avg_order_value
FROM gold_avg_order_value GROUP BY 1, 2""",
            "gold_avg_order_value",
        ),
        "gold_aov_yearly": build(
            """
SELECT CAST(year(snapshot_date) AS INTEGER) AS year,
       CAST(SUM(total_revenue) AS DECIMAL(38,2)) AS total_revenue, CAST(SUM(total_orders) AS BIGINT) AS total_orders,
       CAST(CAST(SUM(total_revenue) AS DECIMAL(38,2)) AS DOUBLE) / SUM(total_orders) AS avg_order_value
FROM gold_avg_order_value GROUP BY 1""",
            "gold_avg_order_value",
        ),
        "gold_aov_moving_average": build(
            """
SELECT snapshot_date, avg_order_value,
       CAST(SUM(total_revenue) OVER w AS DOUBLE) / SUM(total_orders) OVER w AS moving_avg_order_value_7d
FROM gold_avg_order_value
WINDOW w AS (ORDER BY snapshot_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
            "gold_avg_order_value",
        ),
        "gold_product_profit": build(
            """
SELECT m.product_id, p.product_name, p.category AS category_name, m.total_qty_sold, m.total_transactions, m.total_revenue,
       CAST(m.total_qty_sold * p.cost_price AS DECIMAL(38,2)) AS total_cost,
       CAST(m.total_revenue - CAST(m.total_qty_sold * p.cost_price AS DECIMAL(38,2)) AS DECIMAL(38,2)) AS total_profit,
       CAST(m.total_revenue - CAST(m.total_qty_sold * p.cost_price AS DECIMAL(38,2)) AS DOUBLE)
         / CAST(m.total_revenue AS DOUBLE) * 100.0 AS profit_margin_pct
FROM product_sales m JOIN silver_products p ON m.product_id = p.product_id""",
            "product_sales",
            "silver_products",
        ),
        "gold_return_rate_by_product": build(
            """
SELECT r.product_id, r.total_transactions, r.returned_transactions, r.returned_revenue,
       p.product_name, p.category AS category_name,
       CAST(r.returned_transactions AS DOUBLE) / r.total_transactions * 100.0 AS return_rate_pct
FROM return_counts_by_product r JOIN silver_products p ON r.product_id = p.product_id""",
            "return_counts_by_product",
            "silver_products",
        ),
        "gold_return_rate_by_category": build(
            """
SELECT p.category AS category_name,
       CAST(SUM(r.total_transactions) AS BIGINT) AS total_transactions,
       CAST(SUM(r.returned_transactions) AS BIGINT) AS returned_transactions,
       CAST(SUM(r.returned_revenue) AS DECIMAL(28,2)) AS returned_revenue,
       CAST(SUM(r.returned_transactions) AS DOUBLE) / SUM(r.total_transactions) * 100.0 AS return_rate_pct
FROM return_counts_by_product r JOIN silver_products p ON r.product_id = p.product_id
GROUP BY p.category""",
            "return_counts_by_product",
            "silver_products",
        ),
        "gold_customer_profile": build("SELECT * FROM customer_profile", "customer_profile"),
    }
)

# --- bike rides --------------------------------------------------------------

cte(
    "bronze_rides",
    """
SELECT CAST(event_id AS VARCHAR) AS ride_id,
  CASE WHEN event_id % 29 = 0 THEN 'bad-time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS start_time,
  strftime(end_ts, '%Y-%m-%d %H:%M:%S.%f') AS end_time,
  CASE WHEN event_id % 31 = 0 THEN NULL ELSE event_type END AS start_station_id,
  end_type AS end_station_id,
  CAST(user_id AS VARCHAR) AS bike_id,
  CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'member' ELSE 'casual' END AS user_type
FROM (
  SELECT event_id, ts, user_id, event_type, lead(ts) OVER w AS end_ts, lead(event_type) OVER w AS end_type
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
) WHERE end_ts IS NOT NULL""",
)
cte(
    "silver_rides",
    """
SELECT CAST(start_ts AS DATE) AS ride_date, ride_id, start_ts AS start_time, end_ts AS end_time,
  start_station_id, end_station_id, bike_id, user_type,
  CAST(CAST(CAST(CAST(minutes AS DOUBLE) / 60.0 AS DECIMAL(27,6))
            * (CASE WHEN user_type = 'member' THEN 10.0 ELSE 15.0 END) AS DECIMAL(31,7))
       AS DECIMAL(19,4)) AS ride_revenue
FROM (
  SELECT *, date_sub('minute', start_ts, end_ts) AS minutes
  FROM (SELECT *, TRY_CAST(start_time AS TIMESTAMP) AS start_ts, TRY_CAST(end_time AS TIMESTAMP) AS end_ts
        FROM bronze_rides)
) WHERE minutes > 0""",
    "bronze_rides",
)
cte(
    "gold_rides",
    """
SELECT ride_date, bike_id, COUNT(DISTINCT ride_id) AS total_rides,
  CAST(SUM(ride_revenue) AS DECIMAL(19,4)) AS total_revenue,
  arg_min_null(start_station_id, (start_time, ride_id)) AS first_start_station_id,
  arg_max_null(end_station_id, (end_time, ride_id)) AS last_end_station_id
FROM silver_rides GROUP BY ALL""",
    "silver_rides",
)
ORACLE["bike_silver"] = build("SELECT * FROM silver_rides", "silver_rides")
ORACLE["bike_rejects"] = build(
    """
SELECT * EXCLUDE (start_ts, end_ts), CASE WHEN start_ts IS NULL THEN 'bad start time' WHEN end_ts IS NULL THEN 'bad end time'
  ELSE 'under a minute' END AS reason
FROM (SELECT *, TRY_CAST(start_time AS TIMESTAMP) AS start_ts, TRY_CAST(end_time AS TIMESTAMP) AS end_ts FROM bronze_rides)
WHERE start_ts IS NULL OR end_ts IS NULL OR date_sub('minute', start_ts, end_ts) <= 0""",
    "bronze_rides",
)
ORACLE["bike_gold"] = build("SELECT * FROM gold_rides", "gold_rides")

ORACLE["bike_gold_stored"] = ORACLE["bike_gold"]


def _stored_columns(view: str, rows: str, columns: list) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{view}' AS table_name, CAST({i} AS INTEGER) AS position, '{c.name}' AS column_name, '{c.type}' AS data_type, "
        f"'{c.comment}' AS comment, (SELECT COUNT(*) FROM {rows}) AS row_count"
        for i, c in enumerate(columns, 1)
    )


ORACLE["bike_stored_columns"] = build(
    _stored_columns("silver_bike_rides", "silver_rides", SILVER_RIDES)
    + "\nUNION ALL\n"
    + _stored_columns("gold_bike_days", "gold_rides", GOLD_RIDES),
    "silver_rides",
    "gold_rides",
)

# --- audits --------------------------------------------------------------------


def _rate_row(table: str, metric: str, flag: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, COUNT(*) AS total_records, '{metric}' AS metric, "
        f"COUNT(*) FILTER (WHERE {flag}) AS metric_count, "
        f"CAST(COUNT(*) FILTER (WHERE {flag}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100.0 AS metric_pct "
        f"FROM {table}"
    )


ORACLE["audit_silver"] = build(
    "\nUNION ALL\n".join(
        [
            _rate_row("silver_customers", "valid_emails", "is_valid_email"),
            _rate_row("silver_products", "valid_pricing", "is_valid_pricing"),
            _rate_row("silver_orders", "valid_line_totals", "is_valid_line_total"),
            _rate_row("silver_orders", "returned_items", "is_returned"),
            _rate_row("silver_transactions", "valid_line_totals", "is_valid_line_total"),
            _rate_row("silver_transactions", "returned_items", "is_returned"),
        ]
    ),
    *SILVER,
)
ORACLE["audit_gold"] = build(
    """
SELECT 'gold_total_revenue' AS table_name, COUNT(*) AS total_records, 'total_revenue' AS headline_metric,
       CAST(NULL AS VARCHAR) AS headline_label, CAST(SUM(total_revenue) AS DOUBLE) AS headline_value
FROM gold_total_revenue
UNION ALL
SELECT 'gold_top_customers', COUNT(*), 'top_customer_revenue', arg_min(full_name, revenue_rank),
       CAST(arg_min(total_revenue, revenue_rank) AS DOUBLE)
FROM gold_top_customers
UNION ALL
SELECT 'gold_top_products', COUNT(*), 'top_product_revenue', arg_min(product_name, sales_rank),
       CAST(arg_min(total_revenue, sales_rank) AS DOUBLE)
FROM gold_top_products
UNION ALL
SELECT 'gold_avg_order_value', COUNT(*), 'overall_avg_order_value', NULL, round(AVG(avg_order_value), 6)
FROM gold_avg_order_value
UNION ALL
SELECT 'gold_return_rate', COUNT(*), 'overall_return_rate_pct', NULL,
       CAST(SUM(returned_orders) AS DOUBLE) / CAST(SUM(total_orders) AS DOUBLE) * 100.0
FROM gold_return_rate""",
    *GOLD,
)

# --- incremental ---------------------------------------------------------------
# One-shot formulation: applying both batches in two checkpointed runs must
# equal processing the whole feed at once (the property the runs rely on).

cte(
    "cust_feed",
    """
SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM bronze_customers
UNION ALL
SELECT customer_id, first_name,
       CASE WHEN _k % 5 = 0 THEN last_name || '-B' ELSE last_name END AS last_name,
       email, address, city, state, country, gender,
       CASE WHEN _k % 3 = 0 THEN 'PLATINUM' ELSE loyalty_tier END AS loyalty_tier,
       date_of_birth, registration_date,
       TIMESTAMP '2024-02-01 00:00:00' AS updated_at
FROM bc_rows WHERE _k % 3 = 0 OR _k % 5 = 0 OR _k % 8 = 0""",
    "bronze_customers",
    "bc_rows",
)
cte(
    "cust_changes",
    _first(
        f"""(
SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
       lower(trim(email)) AS email, trim(city) AS city, trim(state) AS state, trim(country) AS country,
       trim(loyalty_tier) AS loyalty_tier,
       COALESCE(regexp_matches(lower(trim(email)), '{EMAIL}'), false) AS is_valid_email, updated_at
FROM cust_feed
WHERE updated_at <= TIMESTAMP '2024-03-01' AND customer_id IS NOT NULL
  AND regexp_matches(customer_id, '{CUST_ID}'))""",
        "customer_id, updated_at",
        "first_name last_name email city state country loyalty_tier is_valid_email".split(),
    ),
    "cust_feed",
)
_CUST_REST = "first_name last_name email city state country loyalty_tier is_valid_email".split()
cte(
    "scd1",
    "SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY "
    "updated_at DESC NULLS LAST, " + ", ".join(f"{c} ASC NULLS FIRST" for c in _CUST_REST) + ") AS _rn "
    "FROM cust_changes) WHERE _rn = 1",
    "cust_changes",
)
cte(
    "scd2",
    """
SELECT customer_id, first_name, last_name, email, city, state, country, loyalty_tier, is_valid_email,
       updated_at AS valid_from,
       lead(updated_at) OVER k AS valid_to,
       lead(updated_at) OVER k IS NULL AS is_current
FROM (
  SELECT * FROM (
    SELECT *, lag(updated_at) OVER w AS p_t, lag(email) OVER w AS p_email, lag(city) OVER w AS p_city,
           lag(state) OVER w AS p_state, lag(loyalty_tier) OVER w AS p_tier
    FROM cust_changes WINDOW w AS (PARTITION BY customer_id ORDER BY updated_at)
  )
  WHERE p_t IS NULL
     OR NOT (email IS NOT DISTINCT FROM p_email AND city IS NOT DISTINCT FROM p_city
             AND state IS NOT DISTINCT FROM p_state AND loyalty_tier IS NOT DISTINCT FROM p_tier)
)
WINDOW k AS (PARTITION BY customer_id ORDER BY updated_at)""",
    "cust_changes",
)
cte(
    "txn_feed",
    """
SELECT *, 'I' AS cdc_operation, TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM bronze_transactions
UNION ALL
SELECT * REPLACE (quantity + 1 AS quantity), 'U', TIMESTAMP '2024-02-01 00:00:00'
FROM bronze_transactions WHERE CAST(product_id AS BIGINT) % 5 = 0
UNION ALL
SELECT *, 'D', TIMESTAMP '2024-02-02 00:00:00'
FROM bronze_transactions WHERE CAST(product_id AS BIGINT) % 7 = 0
UNION ALL
SELECT * REPLACE ('N-' || transaction_id AS transaction_id), 'I', TIMESTAMP '2024-02-01 00:00:00'
FROM bronze_transactions WHERE CAST(product_id AS BIGINT) % 101 = 0""",
    "bronze_transactions",
)
_TXN_COLS = (
    "order_id product_id quantity unit_price discount_pct line_total transaction_date return_flag "
    "calculated_line_total is_valid_line_total has_discount is_returned"
).split()
cte(
    "txn_changes",
    "SELECT transaction_id, " + ", ".join(_TXN_COLS) + ", cdc_operation, updated_at FROM ("
    + _line_checks(
        "(SELECT * FROM txn_feed WHERE updated_at <= TIMESTAMP '2024-03-01' AND transaction_id IS NOT NULL)"
    )
    + ")",
    "txn_feed",
)
cte(
    "cdc",
    "SELECT * EXCLUDE (_rn, cdc_operation) FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id "
    "ORDER BY updated_at DESC NULLS LAST, (cdc_operation = 'D') DESC NULLS LAST, "
    + ", ".join(f"{c} ASC NULLS FIRST" for c in [*_TXN_COLS, "cdc_operation"])
    + ") AS _rn FROM txn_changes) WHERE _rn = 1 AND cdc_operation <> 'D'",
    "txn_changes",
)
cte(
    "checkpoint_rows",
    """
SELECT 'bronze_customers' AS table_name, MAX(updated_at) AS last_processed_timestamp,
       COUNT(*) FILTER (regexp_matches(customer_id, '^CUST_[0-9]+$')) AS records_processed, TIMESTAMP '2024-03-01 00:00:00' AS updated_at
FROM cust_feed WHERE updated_at > TIMESTAMP '2024-01-01' AND updated_at <= TIMESTAMP '2024-03-01'
UNION ALL
SELECT 'bronze_transactions', MAX(updated_at), COUNT(*) FILTER (transaction_id IS NOT NULL), TIMESTAMP '2024-03-01 00:00:00'
FROM txn_feed WHERE updated_at > TIMESTAMP '2024-01-01' AND updated_at <= TIMESTAMP '2024-03-01'""",
    "cust_feed",
    "txn_feed",
)
ORACLE["scd1_customers"] = build("SELECT * FROM scd1", "scd1")
ORACLE["scd2_customers"] = build("SELECT * FROM scd2", "scd2")
ORACLE["scd2_current"] = build("SELECT * FROM scd2 WHERE is_current", "scd2")
ORACLE["scd2_customers_stored"] = ORACLE["scd2_customers"]
ORACLE["scd2_history"] = build("SELECT * FROM scd2 ORDER BY customer_id, valid_from DESC", "scd2")
ORACLE["cdc_transactions"] = build("SELECT * FROM cdc", "cdc")
ORACLE["cdc_transactions_stream"] = ORACLE["cdc_transactions"]
ORACLE["cdc_transactions_pruned"] = ORACLE["cdc_transactions"]
ORACLE["cdc_deletes_only"] = build(
    "SELECT * EXCLUDE (_rn, cdc_operation) FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY "
    + ", ".join(f"{c} ASC NULLS FIRST" for c in [*_TXN_COLS, "cdc_operation"])
    + ") AS _rn FROM txn_changes WHERE updated_at <= TIMESTAMP '2024-01-15') "
    "WHERE _rn = 1 AND transaction_id NOT IN (SELECT transaction_id FROM txn_changes WHERE cdc_operation = 'D')",
    "txn_changes",
)
ORACLE["checkpoint_seeded"] = build(
    """
SELECT 'bronze_customers' AS table_name, MAX(updated_at) AS last_processed_timestamp,
       COUNT(*) FILTER (regexp_matches(customer_id, '^CUST_[0-9]+$')) AS records_processed, TIMESTAMP '2024-01-15 00:00:00' AS updated_at
FROM cust_feed WHERE updated_at <= TIMESTAMP '2024-01-15'
UNION ALL SELECT 'bronze_transactions', TIMESTAMP '1900-01-01 00:00:00', 0, TIMESTAMP '2024-01-15 00:00:00'""",
    "cust_feed",
)
ORACLE["checkpoint_after_run"] = build("SELECT * FROM checkpoint_rows", "checkpoint_rows")
ORACLE["checkpoint_lag"] = build(
    """
SELECT table_name, last_processed_timestamp, source_max_updated_at,
       CAST(epoch(source_max_updated_at) - epoch(last_processed_timestamp) AS BIGINT) AS lag_seconds
FROM (
  SELECT 'bronze_customers' AS table_name,
         (SELECT MAX(updated_at) FROM cust_feed WHERE updated_at <= TIMESTAMP '2024-01-15') AS last_processed_timestamp,
         (SELECT MAX(updated_at) FROM cust_feed) AS source_max_updated_at
  UNION ALL
  SELECT 'bronze_transactions',
         (SELECT MAX(updated_at) FROM txn_feed WHERE updated_at <= TIMESTAMP '2024-01-15'),
         (SELECT MAX(updated_at) FROM txn_feed)
)""",
    "cust_feed",
    "txn_feed",
)
ORACLE["audit_incremental"] = build(
    """
SELECT 'checkpoint_table' AS table_name, COUNT(*) AS records,
       CAST(NULL AS BIGINT) AS current_records, CAST(NULL AS BIGINT) AS historical_records
FROM checkpoint_rows
UNION ALL SELECT 'silver_customers_scd1', COUNT(*), NULL, NULL FROM scd1
UNION ALL SELECT 'silver_customers_scd2', COUNT(*), COUNT(*) FILTER (WHERE is_current),
                 COUNT(*) FILTER (WHERE NOT is_current) FROM scd2
UNION ALL SELECT 'silver_transactions_incremental', COUNT(*), NULL, NULL FROM cdc""",
    "checkpoint_rows",
    "scd1",
    "scd2",
    "cdc",
)

# --- sources -----------------------------------------------------------------

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Spark's name of each column type that occurs.
_KIND = (
    "CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' "
    "WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' END"
)
ORACLE["source_profile"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, "
    f"(SELECT CAST(COUNT(*) AS INTEGER) FROM information_schema.columns WHERE table_name = '{t}') AS column_count, "
    f"(SELECT 'struct<' || string_agg(column_name || ':' || {_KIND}, ',' ORDER BY ordinal_position) || '>' "
    f"FROM information_schema.columns WHERE table_name = '{t}') AS schema FROM {t}"
    for t in TABLES
)
ORACLE["source_file_audit"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{t}.parquet' AS file_name, COUNT(*) AS row_count FROM {t}" for t in TABLES
)


def _first_rows(tables: list[str], n: int) -> str:
    def one(table: str) -> str:
        text = ", ".join(f"'{c}=' || coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in SHOWN[table])
        key = SHOWN[table][0]
        return (
            f"SELECT * FROM (SELECT '{table}' AS table_name, row_number() OVER (ORDER BY {key} ASC NULLS LAST, fields ASC) AS position, fields "
            f"FROM (SELECT {key}, concat_ws('|', {text}) AS fields FROM {table})) WHERE position <= {n}"
        )

    return build("\nUNION ALL\n".join(one(x) for x in tables), *tables)


ORACLE["raw_heads"] = _first_rows(["bronze_customers", "bronze_products", "bronze_orders", "bronze_transactions"], 5)
ORACLE["silver_samples"] = _first_rows(["silver_customers", "silver_products", "silver_orders", "silver_transactions"], 10)

# --- raw layer -----------------------------------------------------------------

ORACLE["raw_documents"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"
ORACLE["raw_rides"] = build("SELECT * FROM bronze_rides", "bronze_rides")
# Every field stands in quotes; commas between fields, one line end per row.
ORACLE["raw_file_sizes"] = build(
    "SELECT CAST(COUNT(*) AS BIGINT) AS row_count, CAST(SUM("
    + " + ".join(f"strlen(coalesce({c}, '')) + 3" for c in "ride_id start_time end_time start_station_id end_station_id bike_id user_type".split())
    + ") AS BIGINT) AS data_bytes FROM bronze_rides",
    "bronze_rides",
)
ORACLE["raw_medallion"] = build(
    "SELECT snapshot_date, total_revenue, total_orders, total_transactions FROM gold_total_revenue", "gold_total_revenue"
)
ORACLE["silver_transactions_percent"] = build(
    """
SELECT transaction_id, is_valid_line_total, has_discount, round(discount_pct * 100, 6) AS discount_pct,
  CASE WHEN CAST(product_id AS BIGINT) % 83 = 0 THEN NULL ELSE transaction_date END AS transaction_date
FROM silver_transactions""",
    "silver_transactions",
)
ORACLE["audit_stored_tables"] = build(
    """
SELECT 'checkpoint_table' AS table_name, 1::BIGINT AS records, NULL::VARCHAR AS error
UNION ALL SELECT 'silver_customers_scd1', COUNT(*), NULL FROM scd1
UNION ALL SELECT 'silver_customers_scd2', COUNT(*), NULL FROM scd2
UNION ALL SELECT 'silver_transactions_incremental', NULL, 'KeyError'""",
    "scd1",
    "scd2",
)
