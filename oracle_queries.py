"""Each query in plain SQL over the given star-schema tables.

Written without the engine's shortcuts: direct joins, DISTINCT counts, one
window for the rank. Money is summed as whole cents and shown as DOUBLE.
"""

from __future__ import annotations

AS_OF = "DATE '2025-01-01'"

RAW = """
raw_customers AS (
  SELECT CASE WHEN c_custkey % 89 = 53 THEN '' ELSE 'C' || c_custkey END AS customer_id,
         CASE WHEN c_custkey % 89 = 71 THEN '' ELSE c_name END AS name,
         CASE WHEN c_custkey % 89 = 23 THEN 'no mail at all'
              WHEN c_custkey % 89 = 37 THEN NULL
              ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
         CAST(DATE '2023-07-01' + CAST(c_custkey % 430 AS INTEGER) AS DATE) AS signup_date,
         CASE WHEN c_custkey % 89 = 11 THEN ''
              WHEN n_name = 'NATION_0' THEN 'USA'
              WHEN n_name = 'NATION_1' THEN 'UK' ELSE n_name END AS country
  FROM (SELECT *, unnest(CASE WHEN c_custkey % 89 IN (5, 29) THEN [1, 2] ELSE [1] END) AS copy
        FROM customer) c
  JOIN nation ON c_nationkey = n_nationkey),
raw_products AS (
  SELECT 'P' || p_partkey AS product_id, p_name AS product_name,
         CASE WHEN p_partkey % 41 = 9 THEN '' ELSE p_type END AS category,
         CASE WHEN p_partkey % 41 = 3 THEN CAST(-7.25 AS DECIMAL(12,2))
              WHEN p_partkey % 41 = 17 THEN NULL
              ELSE CAST(p_retailprice AS DECIMAL(12,2)) END AS price,
         CAST(CASE WHEN p_partkey % 41 = 26 THEN -3 ELSE p_size END AS INTEGER) AS stock
  FROM part),
raw_orders AS (
  SELECT CASE WHEN o_orderkey % 4900 = 4801 THEN '' ELSE 'O' || o_orderkey END AS order_id,
         CASE WHEN o_orderkey % 190 = 77 THEN NULL ELSE 'C' || o_custkey END AS customer_id,
         CASE WHEN o_orderkey % 190 = 13 THEN '2024-06-31'
              WHEN o_orderkey % 190 = 149 THEN '2031-05-09'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
         CASE WHEN o_orderkey % 190 = 31 THEN NULL
              WHEN o_orderstatus = 'F' THEN 'Delivered'
              WHEN o_orderstatus = 'P' THEN 'Cancelled'
              WHEN o_orderkey % 2 = 0 THEN 'Shipped' ELSE 'Processing' END AS status,
         CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount
  FROM orders),
raw_order_items AS (
  SELECT CASE WHEN l_orderkey % 930 = 607 AND l_linenumber = 1 THEN ''
              ELSE 'OI' || l_orderkey || '-' || l_linenumber END AS order_item_id,
         'O' || l_orderkey AS order_id, 'P' || l_partkey AS product_id,
         CAST(CASE WHEN (l_orderkey + l_linenumber) % 470 = 19 THEN 0
                   ELSE l_quantity END AS INTEGER) AS quantity,
         CASE WHEN l_partkey % 41 = 3 THEN CAST(-7.25 AS DECIMAL(12,2))
              WHEN l_orderkey % 640 = 11 THEN NULL
              ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS price
  FROM lineitem),
raw_payments AS (
  SELECT CASE WHEN part = 2 THEN 'B' || o_orderkey
              WHEN o_orderkey % 870 = 215 THEN '' ELSE 'A' || o_orderkey END AS payment_id,
         'O' || o_orderkey AS order_id,
         CASE WHEN part = 2 THEN 'wallet' WHEN o_orderkey % 4 = 0 THEN 'card'
              WHEN o_orderkey % 4 = 1 THEN 'wallet' WHEN o_orderkey % 4 = 2 THEN 'cash'
              ELSE 'voucher' END AS payment_method,
         CASE WHEN part = 2 THEN CAST(6.45 AS DECIMAL(12,2))
              WHEN o_orderkey % 190 = 43 THEN CAST(-12.5 AS DECIMAL(12,2))
              WHEN o_orderkey % 190 = 88 THEN CAST(0 AS DECIMAL(12,2))
              WHEN o_orderkey % 190 = 121 THEN NULL
              ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS amount
  FROM (SELECT *, unnest(CASE WHEN o_orderkey % 9 = 4 THEN [1, 2] ELSE [1] END) AS part
        FROM orders))
"""

CLEAN = f"""
valid_customers AS (
  SELECT customer_id, name, email, signup_date, country,
         row_number() OVER (
           PARTITION BY customer_id
           ORDER BY country NULLS FIRST, name NULLS FIRST, email NULLS FIRST,
                    signup_date NULLS FIRST) AS copy
  FROM raw_customers
  WHERE customer_id IS NOT NULL AND customer_id <> ''
    AND name IS NOT NULL AND name <> '' AND email LIKE '%@%'),
clean_customers AS (SELECT * EXCLUDE (copy) FROM valid_customers WHERE copy = 1),
clean_products AS (
  SELECT * FROM raw_products
  WHERE product_id IS NOT NULL AND product_id <> '' AND price >= 0 AND stock >= 0
    AND category IS NOT NULL AND category <> ''),
clean_orders AS (
  SELECT order_id, customer_id, TRY_CAST(order_date AS DATE) AS order_date, status, total_amount
  FROM raw_orders
  WHERE order_id IS NOT NULL AND order_id <> ''
    AND customer_id IS NOT NULL AND customer_id <> ''
    AND TRY_CAST(order_date AS DATE) <= {AS_OF}),
clean_order_items AS (
  SELECT * FROM raw_order_items
  WHERE order_item_id IS NOT NULL AND order_item_id <> '' AND price >= 0 AND quantity > 0),
clean_payments AS (
  SELECT * FROM raw_payments
  WHERE payment_id IS NOT NULL AND payment_id <> ''
    AND order_id IS NOT NULL AND order_id <> '' AND amount > 0)
"""


def _metrics(as_of: str) -> str:
    def count(table: str, metric: str, condition: str | None = None) -> str:
        where = f" WHERE {condition}" if condition else ""
        return (
            f"SELECT '{table}' AS \"table\", '{metric}' AS metric, "
            f"CAST(count(*) AS BIGINT) AS value FROM raw_{table}{where}"
        )

    def blank(column: str) -> str:
        return f"{column} IS NULL OR {column} = ''"

    day = "TRY_CAST(order_date AS DATE)"
    parts = [
        count("customers", "total_records"),
        count("customers", "null_customer_ids", blank("customer_id")),
        count("customers", "null_names", blank("name")),
        count("customers", "invalid_emails", "NOT (email LIKE '%@%')"),
        "SELECT 'customers', 'duplicate_customer_ids', CAST(count(*) AS BIGINT) FROM "
        "(SELECT customer_id FROM raw_customers GROUP BY customer_id HAVING count(*) > 1)",
        count("products", "total_records"),
        count("products", "null_product_ids", blank("product_id")),
        count("products", "negative_prices", "price < 0"),
        count("products", "negative_stocks", "stock < 0"),
        count("products", "null_categories", blank("category")),
        count("orders", "total_records"),
        count("orders", "null_order_ids", blank("order_id")),
        count("orders", "null_customer_ids", blank("customer_id")),
        count("orders", "invalid_dates", f"{day} IS NULL"),
        count("orders", "future_dates", f"{day} > {as_of}"),
        count("order_items", "total_records"),
        count("order_items", "null_item_ids", blank("order_item_id")),
        count("order_items", "negative_prices", "price < 0"),
        count("order_items", "negative_or_zero_quantities", "quantity <= 0"),
        count("payments", "total_records"),
        count("payments", "null_payment_ids", blank("payment_id")),
        count("payments", "null_order_ids", blank("order_id")),
        count("payments", "negative_or_zero_amounts", "amount <= 0"),
    ]
    return " UNION ALL ".join(parts)


def _score(metrics: str) -> str:
    return f"""
  SELECT total_records_processed, total_errors_found,
         CASE WHEN total_records_processed = 0 THEN CAST(100 AS DOUBLE)
              ELSE CAST(floor((CAST(total_records_processed - total_errors_found AS DECIMAL(38,0))
                               * 20000 + total_records_processed)
                              / (2 * total_records_processed)) AS DOUBLE) / 100
         END AS data_quality_score
  FROM (SELECT CAST(coalesce(sum(value) FILTER (metric = 'total_records'), 0) AS BIGINT)
                 AS total_records_processed,
               CAST(coalesce(sum(value) FILTER (metric <> 'total_records'), 0) AS BIGINT)
                 AS total_errors_found
        FROM ({metrics}))"""


def _run(day: str) -> str:
    return (
        f"SELECT '{day}' AS run_id, '{day} 06:00:00' AS run_time, 'SUCCESS' AS status, s.* "
        f"FROM ({_score(_metrics(f'DATE {chr(39)}{day}{chr(39)}'))}) s"
    )


MARTS = f"""
metrics AS ({_metrics(AS_OF)}),
order_payments AS (
  SELECT o.order_id, o.customer_id, o.order_date, o.status, o.total_amount,
         p.payment_id, p.payment_method, p.amount
  FROM clean_orders o JOIN clean_payments p ON o.order_id = p.order_id
  WHERE o.status <> 'Cancelled'),
lifetime AS (
  SELECT customer_id, CAST(sum(CAST(amount * 100 AS BIGINT)) AS BIGINT) AS spent,
         count(DISTINCT order_id) AS order_count, count(*) AS n
  FROM order_payments GROUP BY customer_id),
ranked AS (
  SELECT rank() OVER (ORDER BY spent DESC) AS rank, customer_id, name, country,
         CAST(spent AS DOUBLE) / 100 AS total_spent, order_count,
         CAST((2 * spent + n) // (2 * n) AS DOUBLE) / 100 AS avg_order_value
  FROM lifetime JOIN clean_customers USING (customer_id)),
months AS (
  SELECT strftime(order_date, '%Y-%m') AS order_month,
         CAST(sum(CAST(amount * 100 AS BIGINT)) AS BIGINT) AS cents,
         count(DISTINCT order_id) AS orders_count
  FROM order_payments GROUP BY 1),
performance AS (
  SELECT i.product_id, p.product_name, p.category,
         CAST(sum(i.quantity) AS BIGINT) AS quantity_sold,
         CAST(sum(CAST(i.price * 100 AS BIGINT) * i.quantity) AS BIGINT) AS cents
  FROM clean_order_items i
  JOIN clean_products p ON i.product_id = p.product_id
  JOIN clean_orders o ON i.order_id = o.order_id AND o.status <> 'Cancelled'
  GROUP BY ALL),
portfolio AS (
  SELECT p.product_id, p.product_name, p.category, CAST(p.price AS DOUBLE) AS price, p.stock,
         s.quantity_sold, s.cents, CAST(s.cents AS DOUBLE) / 100 AS total_revenue
  FROM performance s JOIN clean_products p ON s.product_id = p.product_id),
run_log AS ({_run('2024-01-01')} UNION ALL {_run('2025-01-01')})
"""


def _segment(labels: list[str]) -> str:
    return (
        f"CASE WHEN total_spent >= 3000000 THEN '{labels[0]}' "
        f"WHEN total_spent >= 2400000 THEN '{labels[1]}' "
        f"WHEN total_spent >= 1800000 THEN '{labels[2]}' ELSE '{labels[3]}' END"
    )


def _reasons(table: str, cases: list[tuple[str, str]]) -> str:
    texts = ", ".join(f"CASE WHEN {condition} THEN '{reason}' END" for condition, reason in cases)
    columns = {
        "products": "* REPLACE (CAST(price AS DOUBLE) AS price)",
        "orders": "* REPLACE (CAST(total_amount AS DOUBLE) AS total_amount)",
        "order_items": "* REPLACE (CAST(price AS DOUBLE) AS price)",
        "payments": "* REPLACE (CAST(amount AS DOUBLE) AS amount)",
    }.get(table, "*")
    return (
        f"SELECT * FROM (SELECT {columns}, concat_ws(',', {texts}) AS reasons "
        f"FROM raw_{table}) WHERE reasons <> ''"
    )


def _missing(column: str) -> tuple[str, str]:
    return (f"{column} IS NULL OR {column} = ''", f"{column}_missing")


def _duplicates(table: str, key: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{key}' AS key_column, "
        "count(*) FILTER (n > 1) AS duplicate_keys, "
        "CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows "
        f"FROM (SELECT count(*) AS n FROM raw_{table} GROUP BY {key})"
    )


def _orphans(child: str, column: str, parent: str, key: str) -> str:
    return (
        f"SELECT '{child}' AS child_table, '{column}' AS child_column, "
        f"'{parent}' AS parent_table, "
        f"count(DISTINCT c.{column}) + CAST(count(*) > count(c.{column}) AS BIGINT) "
        "AS orphan_keys, count(*) AS orphan_rows "
        f"FROM clean_{child} c WHERE NOT EXISTS "
        f"(SELECT 1 FROM clean_{parent} p WHERE p.{key} = c.{column})"
    )


def _count(name: str, source: str) -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"


QUERIES = {
    "clean_customers": "SELECT * FROM clean_customers",
    "clean_products": "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM clean_products",
    "clean_orders": (
        "SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM clean_orders"
    ),
    "clean_order_items": "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM clean_order_items",
    "clean_payments": "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM clean_payments",
    "quarantine_customers": _reasons(
        "customers",
        [
            _missing("customer_id"),
            _missing("name"),
            ("email NOT LIKE '%@%'", "email_invalid"),
            ("email IS NULL", "email_missing"),
        ],
    )
    + " UNION ALL SELECT * EXCLUDE (copy), 'customer_id_duplicate' AS reasons "
    "FROM valid_customers WHERE copy > 1",
    "quarantine_products": _reasons(
        "products",
        [
            _missing("product_id"),
            ("price < 0", "price_negative"),
            ("price IS NULL", "price_missing"),
            ("stock < 0", "stock_negative"),
            ("stock IS NULL", "stock_missing"),
            _missing("category"),
        ],
    ),
    "quarantine_orders": _reasons(
        "orders",
        [
            _missing("order_id"),
            _missing("customer_id"),
            ("TRY_CAST(order_date AS DATE) IS NULL", "order_date_invalid"),
            (f"TRY_CAST(order_date AS DATE) > {AS_OF}", "order_date_in_future"),
        ],
    ),
    "quarantine_order_items": _reasons(
        "order_items",
        [
            _missing("order_item_id"),
            ("price < 0", "price_negative"),
            ("price IS NULL", "price_missing"),
            ("quantity <= 0", "quantity_not_positive"),
            ("quantity IS NULL", "quantity_missing"),
        ],
    ),
    "quarantine_payments": _reasons(
        "payments",
        [
            _missing("payment_id"),
            _missing("order_id"),
            ("amount <= 0", "amount_not_positive"),
            ("amount IS NULL", "amount_missing"),
        ],
    ),
    "dq_metrics": "SELECT * FROM metrics",
    "dq_score": _score("SELECT * FROM metrics"),
    "table_volumes": (
        'SELECT "table" AS table_name, value AS total_records_checked '
        "FROM metrics WHERE metric = 'total_records'"
    ),
    "anomaly_breakdown": (
        'SELECT "table" AS table_name, metric, value AS anomalies_count, '
        "value > 0 AS is_failing FROM metrics WHERE metric <> 'total_records'"
    ),
    "duplicate_keys": " UNION ALL ".join(
        [
            _duplicates("customers", "customer_id"),
            _duplicates("products", "product_id"),
            _duplicates("orders", "order_id"),
            _duplicates("order_items", "order_item_id"),
            _duplicates("payments", "payment_id"),
        ]
    ),
    "orphan_keys": " UNION ALL ".join(
        [
            _orphans("orders", "customer_id", "customers", "customer_id"),
            _orphans("order_items", "order_id", "orders", "order_id"),
            _orphans("order_items", "product_id", "products", "product_id"),
            _orphans("payments", "order_id", "orders", "order_id"),
        ]
    ),
    "order_payments": (
        "SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount, "
        "CAST(amount AS DOUBLE) AS amount) FROM order_payments"
    ),
    "customer_lifetime_value": (
        "SELECT customer_id, CAST(spent AS DOUBLE) / 100 AS total_spent, order_count, "
        "CAST((2 * spent + n) // (2 * n) AS DOUBLE) / 100 AS avg_order_value FROM lifetime"
    ),
    "top_customers": "SELECT * FROM ranked",
    "clv_leaderboard": "SELECT * FROM ranked ORDER BY rank, customer_id LIMIT 15",
    "customer_segments": "SELECT "
    + _segment(
        [
            "VIP Platinum (Spent > $3,000,000)",
            "Gold Tier ($2,400,000 - $3,000,000)",
            "Silver Tier ($1,800,000 - $2,400,000)",
            "Bronze Member (< $1,800,000)",
        ]
    )
    + " AS segment, count(*) AS customer_count FROM ranked GROUP BY 1",
    "customer_value_segments": "SELECT *, "
    + _segment(["VIP Platinum", "Gold Tier", "Silver Tier", "Bronze Member"])
    + " AS segment FROM ranked",
    "monthly_revenue": (
        "SELECT order_month, CAST(cents AS DOUBLE) / 100 AS revenue, orders_count FROM months"
    ),
    "monthly_revenue_daily": (
        "SELECT order_month, CAST(cents AS DOUBLE) / 100 AS revenue, orders_count FROM months"
    ),
    "revenue_growth": """
        SELECT order_month, CAST(cents AS DOUBLE) / 100 AS revenue, previous_month,
               CAST(previous_cents AS DOUBLE) / 100 AS previous_revenue,
               CAST(cents - previous_cents AS DOUBLE) / (CAST(previous_cents AS DOUBLE) / 100)
                 AS growth_pct
        FROM (SELECT *, lag(order_month) OVER (ORDER BY order_month) AS previous_month,
                     lag(cents) OVER (ORDER BY order_month) AS previous_cents FROM months)""",
    "product_performance": (
        "SELECT product_id, product_name, category, quantity_sold, "
        "CAST(cents AS DOUBLE) / 100 AS total_revenue FROM performance"
    ),
    "product_portfolio": "SELECT * EXCLUDE (cents) FROM portfolio",
    "category_revenue": (
        "SELECT category, CAST(sum(cents) AS DOUBLE) / 100 AS revenue FROM portfolio "
        "GROUP BY category ORDER BY revenue DESC, category"
    ),
    "top_products": (
        "SELECT product_id, product_name, category, quantity_sold, total_revenue FROM portfolio "
        "ORDER BY cents DESC, product_id, product_name, category LIMIT 10"
    ),
    "executive_kpis": """
        SELECT coalesce((SELECT CAST(sum(CAST(amount * 100 AS BIGINT)) AS DOUBLE) / 100
                         FROM clean_payments), 0) AS revenue,
               (SELECT count(*) FROM clean_orders WHERE status <> 'Cancelled') AS order_count,
               (SELECT count(DISTINCT customer_id) FROM clean_orders) AS cust_count,
               coalesce((SELECT CAST(sum(CAST(total_amount * 100 AS BIGINT)) AS DOUBLE) / 100
                                / CAST(count(total_amount) AS DOUBLE)
                         FROM clean_orders WHERE status <> 'Cancelled'), 0) AS aov""",
    "order_status_breakdown": (
        'SELECT status, count(*) AS "count" FROM clean_orders GROUP BY status'
    ),
    "customers_by_country": """
        SELECT CASE country WHEN 'USA' THEN 'United States' WHEN 'UK' THEN 'United Kingdom'
                            ELSE country END AS country, total_customers
        FROM (SELECT country, count(DISTINCT customer_id) AS total_customers
              FROM clean_customers WHERE country IS NOT NULL AND country <> ''
              GROUP BY country)""",
    "run_log": "SELECT * FROM run_log",
    "latest_run": "SELECT * FROM run_log ORDER BY run_time DESC, run_id DESC LIMIT 1",
    "row_count_audit": " UNION ALL ".join(
        [
            _count("raw_clean.customers", "clean_customers"),
            _count("raw_clean.products", "clean_products"),
            _count("raw_clean.orders", "clean_orders"),
            _count("raw_clean.order_items", "clean_order_items"),
            _count("raw_clean.payments", "clean_payments"),
            _count("analytics.top_customers", "ranked"),
            _count("analytics.monthly_revenue", "months"),
            _count("analytics.product_performance", "performance"),
            _count("analytics.pipeline_runs", "run_log"),
        ]
    ),
}


def statements() -> dict[str, str]:
    tables = ",".join([RAW, CLEAN, MARTS])
    return {name: f"WITH {tables} {query}" for name, query in QUERIES.items()}
