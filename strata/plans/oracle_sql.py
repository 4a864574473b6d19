"""Independent DuckDB SQL for every registered query (the correctness oracle).

The binding CTEs restate ``strata.plans.bindings`` in SQL; each query's SQL
is written from the operator's specification, not generated from the Spark
plan.
"""

from __future__ import annotations

def rr(num: str, den: str, scale: int) -> str:
    """Exact half-away-from-zero round(num/den, scale) for integer operands."""
    m = 10 ** scale
    return (f"(sign({num}) * ((CAST(abs({num}) AS HUGEINT) * {2 * m} + NULLIF({den}, 0))"
            f" // (2 * NULLIF({den}, 0)))) / {float(m)}")


def cents(c: str) -> str:
    return f"CAST(ROUND({c} * 100) AS BIGINT)"


def money_avg(c: str, scale: int = 2) -> str:
    return rr(f"SUM({cents(c)})", f"(COUNT({c}) * 100)", scale)


def int_avg(c: str, scale: int) -> str:
    return rr(f"SUM(CAST({c} AS BIGINT))", f"COUNT({c})", scale)


GEO = """geo AS (
  SELECT n.n_nationkey, n.n_name AS country, r.r_name AS region
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""

CUST_GEO = GEO + """,
cust_geo AS (
  SELECT c.c_custkey, c.c_name, c.c_acctbal, c.c_mktsegment, g.country, g.region
  FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey)"""

TXN = CUST_GEO + """,
txn AS (
  SELECT o.o_orderkey AS transaction_id, CAST(o.o_orderdate AS DATE) AS order_date,
         o.o_custkey AS customer_id, cg.c_mktsegment AS category, cg.country, cg.region,
         o.o_totalprice AS total_amount, o.o_orderstatus AS status
  FROM orders o JOIN cust_geo cg ON o.o_custkey = cg.c_custkey)"""

RAW_ERP = CUST_GEO + """,
raw_erp AS (
  SELECT
    CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
    CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS order_date,
    CASE WHEN l.l_orderkey % 17 = 0 THEN '' ELSE CAST(o.o_custkey AS VARCHAR) END AS customer_id,
    CASE WHEN l.l_orderkey % 29 = 0 THEN 'INVALID-' ELSE 'SKU-' END || CAST(l.l_partkey AS VARCHAR) AS product_sku,
    p.p_name AS product_name,
    CASE WHEN l.l_orderkey % 41 = 0 THEN ' ' ELSE cg.c_mktsegment END AS category,
    CAST(CASE WHEN l.l_orderkey % 23 = 0 THEN -CAST(l.l_quantity AS INTEGER)
              ELSE CAST(l.l_quantity AS INTEGER) END AS VARCHAR) AS quantity,
    CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS unit_price,
    CASE WHEN l.l_orderkey % 37 = 0 THEN 'n/a'
         ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS total_amount,
    CASE WHEN l.l_orderkey % 19 = 0 THEN 'MXN' WHEN l.l_orderkey % 43 = 0 THEN 'GBP'
         WHEN l.l_orderkey % 47 = 0 THEN NULL ELSE 'USD' END AS currency,
    CASE WHEN l.l_linenumber % 3 = 0 THEN 'card' WHEN l.l_linenumber % 3 = 1 THEN 'transfer'
         ELSE 'cash' END AS payment_method,
    CASE WHEN l.l_orderkey % 31 = 0 THEN 'Error' WHEN o.o_orderstatus = 'F' THEN 'Completed'
         WHEN o.o_orderstatus = 'O' THEN 'Pending' WHEN l.l_linestatus = 'F' THEN 'Shipped'
         ELSE 'Processing' END AS status,
    'WH-' || CAST(l.l_suppkey AS VARCHAR) AS warehouse_id,
    CASE WHEN l.l_orderkey % 13 = 0 THEN NULL ELSE CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) END AS ship_date,
    cg.country, cg.region
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN cust_geo cg ON o.o_custkey = cg.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""

STG = RAW_ERP + """,
stg AS (
  SELECT transaction_id, order_date, customer_id, product_sku, product_name, category,
         TRY_CAST(quantity AS INTEGER) AS quantity, TRY_CAST(unit_price AS DOUBLE) AS unit_price,
         TRY_CAST(total_amount AS DOUBLE) AS total_amount, currency, payment_method, status,
         warehouse_id, ship_date, country, region,
         'erp_transactions' AS _source_file,
         md5(concat_ws(chr(1), COALESCE(transaction_id, ''),
             COALESCE(CAST(CAST(TRY_CAST(total_amount AS DOUBLE) AS DECIMAL(18,2)) AS VARCHAR), ''),
             COALESCE(status, ''), COALESCE(ship_date, ''))) AS _row_hash
  FROM raw_erp
  WHERE transaction_id IS NOT NULL AND transaction_id <> '')"""

_ARRIVAL_REST = ("order_date, customer_id, product_sku, product_name, category, quantity, unit_price, "
                 "total_amount, currency, payment_method, status, warehouse_id, ship_date, country, region")


def _nulls_first(cols: str) -> str:
    return ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in cols.split(","))


# Silver: of each transaction the first row counts; then the rules of each column.
INT_CLEANED = STG + f""",
one_each AS (
  SELECT * FROM stg
  QUALIFY ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY {_nulls_first(_ARRIVAL_REST)}) = 1),
parts AS (
  SELECT * REPLACE (NULLIF(TRIM(customer_id), '') AS customer_id, NULLIF(TRIM(category), '') AS category)
  FROM one_each WHERE NOT starts_with(product_sku, 'INVALID') AND status <> 'Error'),
int_cleaned AS (
  SELECT p.transaction_id, d.day AS order_date, TRY_CAST(p.ship_date AS DATE) AS ship_date,
    COALESCE(p.customer_id, 'UNKNOWN') AS customer_id, TRIM(p.product_sku) AS product_sku,
    TRIM(p.product_name) AS product_name,
    COALESCE(upper(p.category[1]) || lower(p.category[2:]), 'Uncategorized') AS category,
    p.quantity, IF(p.unit_price < 0, NULL, ROUND(p.unit_price, 2)) AS unit_price,
    ROUND(p.total_amount, 2) AS total_amount,
    IF(p.currency IS NULL, 'USD', IF(list_contains(['USD', 'MXN', 'EUR', 'CAD'], p.currency), p.currency, 'OTHER')) AS currency,
    IF(list_contains(['Completed', 'Pending', 'Shipped', 'Processing'], p.status), p.status, 'Unknown') AS status,
    TRIM(p.country) AS country, TRIM(p.region) AS region,
    FALSE AS _is_invalid_quantity,
    COALESCE(ABS(p.quantity * p.unit_price - p.total_amount) > 0.01, FALSE) AS _amount_mismatch,
    'silver' AS _layer, '1.0.0' AS _pipeline_version,
    CAST(YEAR(d.day) AS INTEGER) AS year, CAST(MONTH(d.day) AS INTEGER) AS month, CAST(DAY(d.day) AS INTEGER) AS day
  FROM parts p, LATERAL (SELECT TRY_CAST(p.order_date AS DATE) AS day) d
  WHERE p.quantity > 0 AND p.total_amount >= 0)"""

# Gold: figures per day, the leading category (revenue) and country (rows) from sorted
# lists of per-member figures, growth against the day before in the table.
FCT_DAILY = INT_CLEANED + f""",
by_member AS (
  SELECT order_date, category, country, GROUPING(category) AS no_cat, ROUND(SUM(total_amount), 2) AS revenue, COUNT(*) AS n
  FROM int_cleaned GROUP BY GROUPING SETS ((order_date, category), (order_date, country))),
leaders AS (
  SELECT order_date,
    list({{'m': category, 'v': revenue}} ORDER BY revenue DESC, category) FILTER (WHERE no_cat = 0) AS cats,
    list(country ORDER BY n DESC, country) FILTER (WHERE no_cat = 1) AS lands
  FROM by_member GROUP BY order_date),
per_day AS (
  SELECT order_date AS date, ROUND(SUM(total_amount), 2) AS total_revenue_usd, COUNT(*) AS transaction_count,
    COUNT(DISTINCT customer_id) AS unique_customers, {money_avg("total_amount")} AS avg_order_value_usd,
    MAX(total_amount) AS max_order_value_usd, MIN(total_amount) AS min_order_value_usd,
    CAST(SUM(quantity) AS BIGINT) AS total_units_sold, {int_avg("quantity", 1)} AS avg_units_per_order,
    COUNT(DISTINCT product_sku) AS unique_products_sold, COUNT(DISTINCT country) AS countries_served,
    {rr("COUNT(*) FILTER (WHERE NOT _is_invalid_quantity AND NOT _amount_mismatch)", "COUNT(*)", 4)} AS data_quality_score
  FROM int_cleaned GROUP BY order_date)
SELECT p.* EXCLUDE (data_quality_score), l.cats[1].m AS top_category, l.cats[1].v AS top_category_revenue,
  l.lands[1] AS top_country,
  ROUND((total_revenue_usd - LAG(total_revenue_usd) OVER w) / NULLIF(LAG(total_revenue_usd) OVER w, 0) * 100, 2)
    AS revenue_growth_pct,
  p.data_quality_score, 'gold' AS _layer, '1.0.0' AS _pipeline_version,
  CAST(YEAR(p.date) AS INTEGER) AS year, CAST(MONTH(p.date) AS INTEGER) AS month
FROM per_day p JOIN leaders l ON l.order_date IS NOT DISTINCT FROM p.date
WINDOW w AS (ORDER BY p.date)"""


def with_(cte: str, body: str) -> str:
    return "WITH " + cte + "\n" + body


SQL: dict[str, str] = {}

SQL["fct_daily_metrics"] = "WITH " + FCT_DAILY

SQL["stg_transactions"] = with_(STG, "SELECT * FROM stg")

SQL["int_cleaned"] = with_(INT_CLEANED, "SELECT * FROM int_cleaned")

SQL["silver_job"] = with_(RAW_ERP, f""",
typed AS (
  SELECT NULLIF(TRIM(transaction_id), '') AS transaction_id,
    TRY_CAST(NULLIF(TRIM(order_date), '') AS DATE) AS order_date,
    NULLIF(TRIM(customer_id), '') AS customer_id,
    NULLIF(TRIM(product_sku), '') AS product_sku,
    NULLIF(TRIM(product_name), '') AS product_name,
    NULLIF(TRIM(category), '') AS category,
    TRY_CAST(NULLIF(TRIM(quantity), '') AS INTEGER) AS quantity,
    TRY_CAST(NULLIF(TRIM(unit_price), '') AS DOUBLE) AS unit_price,
    TRY_CAST(NULLIF(TRIM(total_amount), '') AS DOUBLE) AS total_amount,
    NULLIF(TRIM(currency), '') AS currency,
    NULLIF(TRIM(payment_method), '') AS payment_method,
    NULLIF(TRIM(status), '') AS status,
    NULLIF(TRIM(warehouse_id), '') AS warehouse_id,
    TRY_CAST(NULLIF(TRIM(ship_date), '') AS DATE) AS ship_date,
    NULLIF(TRIM(country), '') AS country,
    NULLIF(TRIM(region), '') AS region
  FROM raw_erp),
valid AS (
  SELECT * FROM typed
  WHERE transaction_id IS NOT NULL AND transaction_id <> '' AND quantity > 0 AND total_amount >= 0
    AND status <> 'Error' AND NOT starts_with(product_sku, 'INVALID')),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY {_nulls_first(_ARRIVAL_REST)}) AS rk
  FROM valid)
SELECT * EXCLUDE (rk), 'silver' AS _layer, '1.0.0' AS _pipeline_version,
  ABS(quantity * unit_price - total_amount) < 0.01 AS _amount_validated,
  CAST(YEAR(order_date) AS INTEGER) AS year, CAST(MONTH(order_date) AS INTEGER) AS month, CAST(DAY(order_date) AS INTEGER) AS day
FROM ranked WHERE rk = 1""")


# ---- rollups and KPIs -------------------------------------------------------
def _top(src: str, key: str, value: str, out: str) -> str:
    return f"""(SELECT {key} AS date, {value} AS {out} FROM (
      SELECT {key}, {value}, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY COUNT(*) DESC, {value} ASC) AS rk
      FROM {src} WHERE {value} IS NOT NULL GROUP BY {key}, {value}) WHERE rk = 1)"""


SQL["daily_rollup"] = with_(TXN, f""",
base AS (
  SELECT order_date AS date, ROUND(COALESCE(SUM(total_amount), 0), 2) AS total_revenue,
    {money_avg("total_amount")} AS avg_order_value, MIN(total_amount) AS min_order_value,
    MAX(total_amount) AS max_order_value, COUNT(total_amount) AS transaction_count,
    COUNT(DISTINCT customer_id) AS unique_customer_ids
  FROM txn WHERE order_date IS NOT NULL GROUP BY order_date)
SELECT base.*, tc.top_category, tco.top_country, 'daily' AS _aggregation_type, 'gold' AS _layer
FROM base
LEFT JOIN {_top("txn", "order_date", "category", "top_category")} tc ON base.date = tc.date
LEFT JOIN {_top("txn", "order_date", "country", "top_country")} tco ON base.date = tco.date""")

_PERIOD_AGGS = f"""ROUND(COALESCE(SUM(total_amount), 0), 2) AS total_revenue,
    COUNT(total_amount) AS transaction_count, {money_avg("total_amount")} AS avg_order_value"""

SQL["weekly_rollup"] = with_(TXN, f"""
SELECT CAST(YEAR(order_date) AS INTEGER) AS year, CAST(weekofyear(order_date) AS INTEGER) AS week, {_PERIOD_AGGS},
  'weekly' AS _aggregation_type, 'gold' AS _layer
FROM txn WHERE order_date IS NOT NULL GROUP BY 1, 2""")

SQL["monthly_rollup"] = with_(TXN, f"""
SELECT CAST(YEAR(order_date) AS INTEGER) AS year, CAST(MONTH(order_date) AS INTEGER) AS month, {_PERIOD_AGGS},
  'monthly' AS _aggregation_type, 'gold' AS _layer
FROM txn WHERE order_date IS NOT NULL GROUP BY 1, 2""")

SQL["dimension_rollup"] = with_(TXN, f""",
g AS (SELECT country, {_PERIOD_AGGS}, SUM({cents("total_amount")}) AS c
      FROM txn WHERE country IS NOT NULL GROUP BY country)
SELECT country, total_revenue, transaction_count, avg_order_value,
  {rr("c * 100", "SUM(c) OVER ()", 2)} AS revenue_pct, 'by_country' AS _aggregation_type
FROM g""")

SQL["revenue_kpis"] = with_(TXN, f""",
x AS (SELECT total_amount AS v, {cents("total_amount")} AS c FROM txn WHERE total_amount IS NOT NULL)
SELECT ROUND(SUM(v), 2) AS total_revenue, {money_avg("v")} AS avg_order_value,
  ROUND(MEDIAN(c)) / 100.0 AS median_order_value,
  ROUND(MAX(v), 2) AS max_order_value, ROUND(MIN(v), 2) AS min_order_value,
  CASE WHEN COUNT(*) > 1 THEN ROUND(STDDEV_SAMP(v), 2) ELSE 0.0 END AS std_dev,
  COUNT(*) AS total_transactions
FROM x""")

SQL["revenue_by_category"] = with_(TXN, """
SELECT category, ROUND(SUM(total_amount), 2) AS revenue FROM txn GROUP BY category
ORDER BY revenue DESC, category LIMIT 10""")

SQL["revenue_by_country"] = with_(TXN, """
SELECT country, ROUND(SUM(total_amount), 2) AS revenue FROM txn GROUP BY country""")

SQL["customer_kpis"] = with_(TXN, f""",
per AS (SELECT customer_id, COALESCE(SUM({cents("total_amount")}), 0) AS c
        FROM txn WHERE customer_id IS NOT NULL GROUP BY customer_id),
ranked AS (SELECT c, ROW_NUMBER() OVER (ORDER BY c DESC) AS rn, COUNT(*) OVER () AS n FROM per)
SELECT COUNT(*) AS total_unique_customers,
  {rr("SUM(c)", "(COUNT(*) * 100)", 2)} AS avg_revenue_per_customer,
  MAX(c) / 100.0 AS max_revenue_customer,
  {rr("SUM(CASE WHEN rn <= GREATEST(1, FLOOR(n * 0.1)) THEN c ELSE 0 END) * 100", "GREATEST(SUM(c), 100)", 2)}
    AS top_10pct_revenue_share
FROM ranked""")

SQL["customers_by_country"] = with_(TXN, """
SELECT country, COUNT(DISTINCT customer_id) AS customers FROM txn GROUP BY country""")

SQL["operational_kpis"] = with_(INT_CLEANED, f"""
SELECT {rr(f"SUM({cents('CAST(quantity AS DOUBLE)')})", "(COUNT(quantity) * 100)", 2)} AS avg_quantity_per_order,
  CAST(SUM(quantity) AS BIGINT) AS total_units_sold
FROM int_cleaned""")

SQL["top_products"] = with_(INT_CLEANED, """
SELECT product_sku, COUNT(*) AS count FROM int_cleaned WHERE product_sku IS NOT NULL
GROUP BY product_sku ORDER BY count DESC, product_sku LIMIT 5""")

SQL["status_distribution"] = with_(INT_CLEANED, f"""
SELECT status, COUNT(*) AS count, {rr("COUNT(*) * 100", "SUM(COUNT(*)) OVER ()", 2)} AS pct
FROM int_cleaned WHERE status IS NOT NULL GROUP BY status""")

SQL["category_distribution"] = with_(INT_CLEANED, """
SELECT category, COUNT(*) AS count FROM int_cleaned WHERE category IS NOT NULL GROUP BY category""")

SQL["period_growth"] = with_(TXN, f""",
cur AS (SELECT COALESCE(SUM({cents("total_amount")}), 0) AS cur_c, COUNT(*) AS cur_n
        FROM txn WHERE CAST(YEAR(order_date) AS INTEGER) = 1998),
prev AS (SELECT COALESCE(SUM({cents("total_amount")}), 0) AS prev_c, COUNT(*) AS prev_n
         FROM txn WHERE CAST(YEAR(order_date) AS INTEGER) = 1997)
SELECT cur_c / 100.0 AS current_period_revenue, prev_c / 100.0 AS previous_period_revenue,
  CASE WHEN prev_c > 0 THEN {rr("(cur_c - prev_c) * 100", "GREATEST(prev_c, 100)", 2)} ELSE 0.0 END
    AS revenue_growth_pct,
  cur_n AS current_transactions, prev_n AS previous_transactions,
  {rr("(cur_n - prev_n) * 100", "GREATEST(prev_n, 1)", 2)} AS transaction_growth_pct
FROM cur, prev""")

SQL["compare_periods"] = with_(INT_CLEANED, """,
sums AS (
  SELECT CAST(YEAR(order_date) AS INTEGER) AS y,
    ROUND(SUM(CAST(quantity AS DOUBLE)), 2) AS quantity,
    ROUND(SUM(total_amount), 2) AS total_amount,
    ROUND(SUM(unit_price), 2) AS unit_price
  FROM int_cleaned WHERE CAST(YEAR(order_date) AS INTEGER) IN (1997, 1998) GROUP BY 1),
long AS (
  SELECT y, 'quantity' AS metric, quantity AS v FROM sums
  UNION ALL SELECT y, 'total_amount', total_amount FROM sums
  UNION ALL SELECT y, 'unit_price', unit_price FROM sums),
j AS (SELECT c.metric, c.v AS current, p.v AS previous
      FROM long c JOIN long p ON c.metric = p.metric AND c.y = 1998 AND p.y = 1997)
SELECT metric, current, previous, ROUND(current - previous, 2) AS change,
  CASE WHEN previous <> 0 THEN ROUND((current - previous) / previous * 100, 2) ELSE 0.0 END AS change_pct
FROM j""")

SQL["monthly_growth"] = with_(TXN, """,
m AS (SELECT CAST(YEAR(order_date) AS INTEGER) AS year, CAST(MONTH(order_date) AS INTEGER) AS month,
        ROUND(COALESCE(SUM(total_amount), 0), 2) AS total_revenue
      FROM txn WHERE order_date IS NOT NULL GROUP BY 1, 2)
SELECT year, month, total_revenue, LAG(total_revenue) OVER (ORDER BY year, month) AS prev_revenue,
  ROUND((total_revenue - LAG(total_revenue) OVER (ORDER BY year, month))
        / NULLIF(LAG(total_revenue) OVER (ORDER BY year, month), 0) * 100, 2) AS revenue_growth_pct
FROM m""")


# ---- validation / ingest ----------------------------------------------------
_RAW_ORDER = ("transaction_id, " + _ARRIVAL_REST)

VALIDATED_ERP = RAW_ERP + f""",
norm AS (
  SELECT NULLIF(TRIM(transaction_id), '') AS transaction_id, NULLIF(TRIM(order_date), '') AS order_date,
    NULLIF(TRIM(customer_id), '') AS customer_id, NULLIF(TRIM(product_sku), '') AS product_sku,
    NULLIF(TRIM(quantity), '') AS quantity, NULLIF(TRIM(total_amount), '') AS total_amount,
    NULLIF(TRIM(currency), '') AS currency, NULLIF(TRIM(status), '') AS status,
    NULLIF(TRIM(category), '') AS category, NULLIF(TRIM(country), '') AS country,
    ROW_NUMBER() OVER (PARTITION BY NULLIF(TRIM(transaction_id), '')
                       ORDER BY {_nulls_first(_RAW_ORDER)}) AS rn
  FROM raw_erp),
verr AS (
  SELECT *, NULLIF(concat_ws('; ',
    CASE WHEN transaction_id IS NULL THEN 'Missing required field: transaction_id' END,
    CASE WHEN order_date IS NULL THEN 'Missing required field: order_date' END,
    CASE WHEN product_sku IS NULL THEN 'Missing required field: product_sku' END,
    CASE WHEN quantity IS NULL THEN 'Missing required field: quantity' END,
    CASE WHEN total_amount IS NULL THEN 'Missing required field: total_amount' END,
    CASE WHEN transaction_id IS NOT NULL AND rn > 1 THEN 'Duplicate transaction_id: ' || transaction_id END,
    CASE WHEN quantity IS NOT NULL AND TRY_CAST(quantity AS INTEGER) IS NULL THEN 'Invalid quantity: ' || quantity END,
    CASE WHEN TRY_CAST(quantity AS INTEGER) <= 0 THEN 'Non-positive quantity: ' || CAST(TRY_CAST(quantity AS INTEGER) AS VARCHAR) END,
    CASE WHEN total_amount IS NOT NULL AND TRY_CAST(total_amount AS DOUBLE) IS NULL THEN 'Invalid total_amount: ' || total_amount END,
    CASE WHEN TRY_CAST(total_amount AS DOUBLE) < 0 THEN 'Negative total amount: ' || CAST(TRY_CAST(total_amount AS DOUBLE) AS VARCHAR) END,
    CASE WHEN currency IS NOT NULL AND currency NOT IN ('USD', 'MXN', 'EUR', 'CAD') THEN 'Invalid currency: ' || currency END,
    CASE WHEN status IS NOT NULL AND status NOT IN ('Completed', 'Pending', 'Shipped', 'Processing', 'Cancelled', 'Returned')
         THEN 'Invalid status: ' || status END,
    CASE WHEN customer_id IS NULL THEN 'Missing customer_id' END,
    CASE WHEN starts_with(product_sku, 'INVALID') THEN 'Invalid SKU format: ' || product_sku END), '') AS _error
  FROM norm)"""

SQL["validate_transactions"] = with_(VALIDATED_ERP, """
SELECT transaction_id, product_sku, quantity, total_amount, _error, _error IS NULL AS _is_valid FROM verr""")

SQL["ingest_metrics"] = with_(VALIDATED_ERP, f""",
m AS (SELECT COUNT(*) AS records_read, COUNT(*) FILTER (WHERE _error IS NULL) AS records_accepted,
        COUNT(*) FILTER (WHERE _error IS NOT NULL) AS records_rejected FROM verr)
SELECT 'erp_transactions' AS source_name, 'erp' AS source_type, records_read, records_accepted, records_rejected,
  CASE WHEN records_read = 0 THEN 0.0 ELSE {rr("records_rejected * 100", "records_read", 2)} END AS rejection_rate_pct,
  CASE WHEN records_rejected = 0 THEN 'success' WHEN records_accepted > 0 THEN 'partial' ELSE 'failed' END AS status
FROM m""")

CONTACTS = CUST_GEO + """,
c_all AS (SELECT *, 0 AS _seq FROM cust_geo UNION ALL SELECT *, 1 AS _seq FROM cust_geo WHERE c_custkey % 101 = 0),
contacts AS (
  SELECT CASE WHEN c_custkey % 59 = 0 THEN '' ELSE 'CRM-' || CAST(c_custkey AS VARCHAR) END AS contact_id,
    c_name AS name,
    CASE WHEN c_custkey % 53 = 0 THEN 'not-an-email' ELSE 'User' || CAST(c_custkey AS VARCHAR) || '@Example.COM' END AS email,
    CASE WHEN c_custkey % 61 = 0 THEN ' ' ELSE 'Co ' || CAST(c_custkey % 97 AS VARCHAR) END AS company,
    c_mktsegment AS industry, country, region,
    CASE WHEN c_custkey % 67 = 0 THEN -c_acctbal ELSE c_acctbal END AS deal_value_usd,
    CASE WHEN c_custkey % 4 = 0 THEN 'lead' WHEN c_custkey % 4 = 1 THEN 'Opportunity'
         WHEN c_custkey % 4 = 2 THEN 'CUSTOMER' ELSE 'churned' END AS lifecycle_stage,
    _seq
  FROM c_all)"""

SQL["validate_contacts"] = with_(CONTACTS, r""",
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY contact_id ORDER BY _seq) AS rn FROM contacts),
e AS (SELECT contact_id, email, _seq, NULLIF(concat_ws('; ',
    CASE WHEN contact_id IS NULL OR TRIM(contact_id) = '' THEN 'Missing or empty required field: contact_id' END,
    CASE WHEN email IS NULL OR TRIM(email) = '' THEN 'Missing or empty required field: email' END,
    CASE WHEN company IS NULL OR TRIM(company) = '' THEN 'Missing or empty required field: company' END,
    CASE WHEN email IS NOT NULL AND email <> '' AND NOT regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')
         THEN 'Invalid email format: ' || email END,
    CASE WHEN deal_value_usd < 0 THEN 'Negative deal value: ' || CAST(deal_value_usd AS VARCHAR) END,
    CASE WHEN contact_id IS NOT NULL AND contact_id <> '' AND rn > 1 THEN 'Duplicate contact_id: ' || contact_id END), '') AS _error
  FROM r)
SELECT *, _error IS NULL AS _is_valid FROM e""")

SQL["validate_events"] = """
WITH e AS (SELECT event_id, NULLIF(concat_ws('; ',
    CASE WHEN NOT (event_id IS NOT NULL AND event_id <> 0) THEN 'No identifier field found (event_id, id, record_id)' END,
    CASE WHEN ts IS NULL THEN 'No timestamp field found' END,
    CASE WHEN (CAST(event_id IS NOT NULL AS INT) + CAST(ts IS NOT NULL AS INT) + CAST(user_id IS NOT NULL AS INT)
             + CAST(event_type IS NOT NULL AND TRIM(event_type) <> '' AS INT) + CAST(value IS NOT NULL AS INT)
             + CAST(props IS NOT NULL AND TRIM(props) <> '' AS INT)) < 2
         THEN 'Record has too few non-null fields' END), '') AS _error
  FROM events)
SELECT *, _error IS NULL AS _is_valid FROM e"""

LAKE = """lake AS (
  SELECT l_orderkey AS factura_id, l_partkey AS sku_id,
    CASE WHEN l_orderkey % 23 = 0 THEN -l_quantity ELSE l_quantity END AS qty,
    ROUND(l_extendedprice / l_quantity, 2) AS precio_unit,
    ROUND(l_extendedprice * (1 - l_discount) / l_quantity, 2) AS costo_unit,
    CASE WHEN l_orderkey % 37 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS gross_amount,
    (['NORTH', 'SOUTH', 'EAST', 'WEST', 'CENTRAL', 'COAST', 'HILL',
      'LAKE', 'ACME'])[CAST(l_suppkey % 9 + 1 AS INTEGER)] AS company_id
  FROM lineitem)"""

SQL["validate_lake_rules"] = with_(LAKE, """,
e AS (SELECT factura_id, sku_id, company_id, NULLIF(concat_ws('; ',
    CASE WHEN precio_unit < 0 THEN 'Negative precio_unit: ' || CAST(precio_unit AS VARCHAR) END,
    CASE WHEN costo_unit < 0 THEN 'Negative costo_unit: ' || CAST(costo_unit AS VARCHAR) END,
    CASE WHEN gross_amount < 0 THEN 'Negative gross_amount: ' || CAST(gross_amount AS VARCHAR) END,
    CASE WHEN company_id IS NOT NULL AND company_id <> '' AND company_id NOT IN
      ('NORTH', 'SOUTH', 'EAST', 'WEST', 'CENTRAL', 'COAST', 'HILL', 'LAKE')
      THEN 'Unknown company_id: ' || company_id END), '') AS _error
  FROM lake)
SELECT *, _error IS NULL AS _is_valid FROM e""")


# ---- quality and schema -----------------------------------------------------
def _rule(name, dim, col, f, d, thr, sev):
    dd = f"GREATEST({d}, 1)"
    colv = "NULL" if col is None else f"'{col}'"
    return (f"SELECT 'erp_transactions' AS dataset_name, 'bronze' AS layer, '{name}' AS rule_name, "
            f"'{dim}' AS dimension, CAST({colv} AS VARCHAR) AS \"column\", {rr(f'{dd} - {f}', dd, 4)} AS score, "
            f"(1.0 - {f} / {dd}) >= {thr} AS passed, CAST({thr} AS DOUBLE) AS threshold, '{sev}' AS severity, "
            f"n AS total_records, CAST({f} AS BIGINT) AS failed_records, 1.0 - {f} / {dd} AS _raw_score FROM w")


DQ_REPORT = STG + """,
a AS (SELECT COUNT(*) AS n,
  COUNT(*) FILTER (WHERE customer_id IS NULL OR TRIM(customer_id) = '') AS f_cust,
  COUNT(*) FILTER (WHERE quantity IS NOT NULL AND NOT (quantity >= 0 AND quantity <= 10000)) AS f_qty,
  COUNT(*) FILTER (WHERE currency IS NOT NULL AND currency NOT IN ('USD', 'MXN', 'EUR', 'CAD')) AS f_cur,
  COUNT(*) FILTER (WHERE transaction_id IS NOT NULL AND NOT regexp_matches(transaction_id, '^(?:[0-9]+-[0-9]+)')) AS f_pat,
  COUNT(*) FILTER (WHERE TRY_CAST(order_date AS TIMESTAMP) < TIMESTAMP '1998-05-31 00:00:00') AS f_time,
  COUNT(*) FILTER (WHERE unit_price IS NOT NULL AND total_amount IS NOT NULL AND unit_price > total_amount) AS f_cons,
  COUNT(*) FILTER (WHERE unit_price IS NOT NULL AND total_amount IS NOT NULL) AS d_cons
  FROM stg),
u AS (SELECT COALESCE(SUM(k - 1), 0) AS f_uniq FROM (SELECT COUNT(*) AS k FROM stg GROUP BY transaction_id)),
w AS (SELECT * FROM a, u),
report AS (
""" + "\nUNION ALL ".join([
    _rule("completeness_customer_id", "completeness", "customer_id", "f_cust", "n", 0.95, "error"),
    _rule("completeness_email", "completeness", "email", "n", "n", 0.95, "error"),
    _rule("accuracy_quantity", "accuracy", "quantity", "f_qty", "n", 0.98, "error"),
    _rule("accuracy_currency", "accuracy", "currency", "f_cur", "n", 0.98, "error"),
    _rule("accuracy_transaction_id", "accuracy", "transaction_id", "f_pat", "n", 0.98, "error"),
    _rule("uniqueness_transaction_id", "uniqueness", "transaction_id", "f_uniq", "n", 1.0, "error"),
    _rule("timeliness_order_date", "timeliness", "order_date", "f_time", "n", 0.95, "warning"),
    _rule("consistency_unit_price_vs_total_amount", "consistency", "unit_price", "f_cons", "d_cons", 0.98,
          "warning"),
]) + ")"

SQL["dq_report"] = with_(DQ_REPORT, "SELECT * EXCLUDE (_raw_score) FROM report")

SQL["dq_summary"] = with_(DQ_REPORT, """
SELECT 'erp_transactions' AS dataset_name, 'bronze' AS layer, MAX(total_records) AS total_records,
  ROUND(AVG(_raw_score), 4) AS overall_score, BOOL_AND(passed) AS all_passed, COUNT(*) AS rules_checked,
  COUNT(*) FILTER (WHERE passed) AS rules_passed, COUNT(*) FILTER (WHERE NOT passed) AS rules_failed
FROM report""")

SQL["dq_dimensions"] = with_(DQ_REPORT, """
SELECT dimension, ROUND(AVG(_raw_score), 4) AS score, COUNT(*) AS rules FROM report GROUP BY dimension""")

SQL["dq_gate"] = with_(DQ_REPORT, """,
d AS (SELECT dimension, ROUND(AVG(_raw_score), 4) AS score FROM report GROUP BY dimension),
g AS (SELECT * FROM (VALUES ('completeness', 0.95), ('accuracy', 0.98), ('uniqueness', 1.0),
                            ('timeliness', 0.95), ('consistency', 0.98)) t(dim, thr))
SELECT dimension, score, CAST(g.thr AS DOUBLE) AS gate_threshold,
  score >= g.thr AS gate_passed, 'bronze_to_silver' AS transition
FROM d JOIN g ON d.dimension = g.dim""")

SQL["dq_samples"] = with_(STG, """,
a AS (SELECT 'uniqueness_product_sku_order_date' AS rule_name,
        '{"product_sku":"' || product_sku || '","order_date":"' || order_date || '"}' AS key, COUNT(*) AS rows
      FROM stg GROUP BY product_sku, order_date HAVING COUNT(*) > 1 ORDER BY 2 LIMIT 5),
b AS (SELECT 'uniqueness_customer_id' AS rule_name, '{"customer_id":"' || customer_id || '"}' AS key, COUNT(*) AS rows
      FROM stg GROUP BY customer_id HAVING COUNT(*) > 1 ORDER BY 2 LIMIT 5)
SELECT * FROM a UNION ALL SELECT * FROM b""")

SQL["schema_violations"] = with_(RAW_ERP, """
SELECT 'extra_columns_kept' AS type, 'payment_method,warehouse_id,ship_date' AS "column",
  CAST(NULL AS VARCHAR) AS expected_type, CAST(NULL AS BIGINT) AS count,
  '3 extra columns found and kept: [''payment_method'', ''warehouse_id'', ''ship_date'']' AS message
UNION ALL
SELECT * FROM (
  SELECT 'type_mismatch', 'total_amount', 'float', cnt,
    'Column ''total_amount'': ' || CAST(cnt AS VARCHAR) || ' non-numeric values'
  FROM (SELECT COUNT(*) FILTER (WHERE total_amount IS NOT NULL AND TRY_CAST(TRIM(total_amount) AS DOUBLE) IS NULL) AS cnt
        FROM raw_erp)) WHERE cnt > 0""")

SQL["schema_strict"] = with_(RAW_ERP, """
SELECT * FROM raw_erp
WHERE transaction_id IS NOT NULL
  AND NOT COALESCE(TRY_CAST(TRIM(order_date) AS TIMESTAMP) IS NULL AND order_date IS NOT NULL, FALSE)
  AND NOT COALESCE(quantity IS NOT NULL AND TRY_CAST(TRIM(quantity) AS DOUBLE) IS NULL, FALSE)
  AND NOT COALESCE(unit_price IS NOT NULL AND TRY_CAST(TRIM(unit_price) AS DOUBLE) IS NULL, FALSE)
  AND NOT COALESCE(total_amount IS NOT NULL AND TRY_CAST(TRIM(total_amount) AS DOUBLE) IS NULL, FALSE)""")

SQL["schema_evolve"] = with_(RAW_ERP, """
SELECT transaction_id, TRY_CAST(order_date AS DATE) AS order_date, customer_id, product_sku, product_name,
  category, TRY_CAST(quantity AS BIGINT) AS quantity, TRY_CAST(unit_price AS DOUBLE) AS unit_price,
  TRY_CAST(total_amount AS DOUBLE) AS total_amount, currency, status, country,
  COALESCE(region, 'UNASSIGNED') AS region, COALESCE(sales_channel, 'direct') AS sales_channel,
  payment_method, warehouse_id, ship_date
FROM (SELECT * EXCLUDE (region), CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS sales_channel
      FROM raw_erp WHERE customer_id <> ''
      UNION ALL
      SELECT *, 'web' AS sales_channel FROM raw_erp WHERE customer_id = '')""")


# ---- deduplication ----------------------------------------------------------
_LINE_ORDER = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"

SQL["dedup_exact_first"] = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_nulls_first(_LINE_ORDER)}) AS rn
  FROM lineitem) WHERE rn = 1"""

SQL["dedup_exact_last"] = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {", ".join(c.strip() + " DESC NULLS LAST" for c in _LINE_ORDER.split(","))}) AS rn
  FROM lineitem) WHERE rn = 1"""

SQL["dedup_most_complete"] = with_(RAW_ERP, f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY
    ({" + ".join(f"CAST({c} IS NULL AS INT)" for c in ["transaction_id"] + [x.strip() for x in _ARRIVAL_REST.split(",")])}) ASC,
    {_nulls_first(_ARRIVAL_REST)}) AS rn
  FROM raw_erp) WHERE rn = 1""")

SQL["dedup_metrics"] = f"""
WITH g AS (SELECT COUNT(*) AS k FROM lineitem GROUP BY l_orderkey, l_linenumber),
a AS (SELECT CAST(COALESCE(SUM(CASE WHEN k > 1 THEN k ELSE 0 END), 0) AS BIGINT) AS found,
        CAST(SUM(k) AS BIGINT) AS input, COUNT(*) AS output FROM g)
SELECT 'exact' AS strategy, input AS total_input, output AS total_output, found AS duplicates_found,
  input - output AS duplicates_removed,
  CASE WHEN input > 0 THEN {rr("(input - output) * 100", "input", 2)} ELSE 0.0 END AS dedup_rate_pct
FROM a"""

SQL["dedup_window"] = """
WITH RECURSIVE n AS (
  SELECT user_id, event_type, ts, MIN(event_id) AS event_id FROM events WHERE ts IS NOT NULL GROUP BY ALL),
chain(user_id, event_type, ts) AS (
  SELECT user_id, event_type, MIN(ts) FROM n GROUP BY user_id, event_type
  UNION ALL
  SELECT c.user_id, c.event_type,
    (SELECT MIN(m.ts) FROM n m WHERE m.user_id IS NOT DISTINCT FROM c.user_id
       AND m.event_type IS NOT DISTINCT FROM c.event_type AND m.ts > c.ts + INTERVAL 24 HOUR)
  FROM chain c WHERE c.ts IS NOT NULL)
SELECT e.* FROM events e
WHERE e.event_id IN (SELECT n.event_id FROM chain c JOIN n ON n.user_id IS NOT DISTINCT FROM c.user_id
                       AND n.event_type IS NOT DISTINCT FROM c.event_type AND n.ts = c.ts)"""

_BG = "list_distinct([substr({s}, i, 2) FOR i IN range(1, length({s}))])"


def _sim(a: str, b: str) -> str:
    ba, bb = _BG.format(s=a), _BG.format(s=b)
    inter = f"length(list_intersect({ba}, {bb}))"
    union = f"(length({ba}) + length({bb}) - {inter})"
    return (f"CASE WHEN {a} = '' AND {b} = '' THEN 1.0 WHEN {a} = '' OR {b} = '' THEN 0.0 "
            f"WHEN {union} = 0 THEN CASE WHEN {a} = {b} THEN 1.0 ELSE 0.0 END "
            f"ELSE {inter} / GREATEST({union}, 1) END")


SQL["fuzzy_pairs"] = f"""
WITH p AS (SELECT p_partkey AS id, lower(regexp_replace(COALESCE(p_name, ''), '^\\s+|\\s+$', '', 'g')) AS s FROM part),
b AS (SELECT *, substr(s, 1, 5) AS blk FROM p),
pairs AS (SELECT x.id AS a_partkey, y.id AS b_partkey, {_sim("x.s", "y.s")} AS similarity
          FROM b x JOIN b y ON x.blk = y.blk AND x.id < y.id)
SELECT * FROM pairs WHERE similarity >= 0.5"""


# ---- silver transforms, flattening, joins -----------------------------------
_TOKENS = "('', 'NULL', 'null', 'None', 'none', 'N/A', 'n/a', 'NA', '#N/A')"


def _clean(c: str) -> str:
    return f"CASE WHEN TRIM({c}) IN {_TOKENS} THEN NULL ELSE TRIM({c}) END"


SQL["silver_contacts"] = with_(CONTACTS, f"""
SELECT {_clean("contact_id")} AS contact_id, {_clean("name")} AS name, lower({_clean("email")}) AS email,
  {_clean("company")} AS company, {_clean("industry")} AS industry, {_clean("country")} AS country,
  {_clean("region")} AS region, deal_value_usd,
  COALESCE(CASE lower({_clean("lifecycle_stage")}) WHEN 'lead' THEN 'Lead' WHEN 'opportunity' THEN 'Opportunity'
    WHEN 'customer' THEN 'Customer' WHEN 'churned' THEN 'Churned' END, {_clean("lifecycle_stage")}) AS lifecycle_stage,
  _seq, COALESCE(deal_value_usd > 0, FALSE) AS has_deal,
  2024 AS _partition_year, '01' AS _partition_month, '31' AS _partition_day,
  'silver' AS _layer, '1.0.0' AS _transformation_version
FROM contacts""")

SQL["silver_events"] = f"""
SELECT event_id, ts AS "timestamp", user_id AS customer_id, replace(lower({_clean("event_type")}), ' ', '_') AS event_type,
  value, {_clean("props")} AS props,
  CAST(YEAR(ts) AS INTEGER) AS _partition_year, lpad(CAST(CAST(MONTH(ts) AS INTEGER) AS VARCHAR), 2, '0') AS _partition_month,
  lpad(CAST(CAST(DAY(ts) AS INTEGER) AS VARCHAR), 2, '0') AS _partition_day, 'silver' AS _layer, '1.0.0' AS _transformation_version
FROM events"""

SQL["flatten_events"] = """
SELECT event_id, event_type AS metadata_event_type,
  TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS metadata_detail_k, value AS metadata_detail_value
FROM events"""

SQL["flatten_contacts"] = """
SELECT c_custkey AS contact_id, c_acctbal AS cf_annual_revenue, c_nationkey AS cf_employee_count,
  c_mktsegment AS cf_subscription_tier,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE
    array_to_string(list_sort([lower(c_mktsegment), 'n' || CAST(c_nationkey AS VARCHAR)]), ',') END AS tags
FROM customer"""

LOADS = """o1 AS (SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
                CAST(o_orderdate AS DATE) AS odate FROM orders),
o2 AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN price + 1 ELSE price END AS price, odate
       FROM o1 WHERE o_orderkey % 11 <> 0
       UNION ALL SELECT o_orderkey + 10000000, o_orderstatus, price, odate FROM o1 WHERE o_orderkey % 13 = 0),
o3 AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, price, odate
       FROM o2)"""


def _h(t: str) -> str:
    return (f"md5(concat_ws(chr(1), COALESCE(CAST({t}.o_orderstatus AS VARCHAR), ''), "
            f"COALESCE(CAST({t}.price AS VARCHAR), ''), COALESCE(CAST({t}.odate AS VARCHAR), '')))")


SQL["change_detection"] = with_(LOADS, f"""
SELECT COALESCE(a.o_orderkey, b.o_orderkey) AS o_orderkey,
  CASE WHEN a.o_orderkey IS NULL THEN 'new' WHEN b.o_orderkey IS NULL THEN 'deleted'
       WHEN {_h("a")} <> {_h("b")} THEN 'changed' ELSE 'unchanged' END AS change_type,
  CASE WHEN a.o_orderkey IS NOT NULL THEN {_h("a")} END AS old_hash,
  CASE WHEN b.o_orderkey IS NOT NULL THEN {_h("b")} END AS new_hash
FROM o1 a FULL OUTER JOIN o2 b ON a.o_orderkey = b.o_orderkey""")

SQL["scd2_history"] = with_(LOADS, f""",
hist AS (SELECT *, DATE '2024-01-01' AS load_date FROM o1 UNION ALL SELECT *, DATE '2024-01-02' FROM o2
         UNION ALL SELECT *, DATE '2024-01-03' FROM o3),
hh AS (SELECT *, {_h("hist")} AS h FROM hist),
v AS (SELECT * FROM (SELECT *, LAG(h) OVER (PARTITION BY o_orderkey ORDER BY load_date) AS prev FROM hh)
      WHERE prev IS NULL OR prev <> h),
loads AS (SELECT load_date AS l, LEAD(load_date) OVER (ORDER BY load_date) AS after
          FROM (SELECT DISTINCT load_date FROM hist)),
close AS (SELECT s.o_orderkey, loads.after FROM (SELECT o_orderkey, MAX(load_date) AS last FROM hist GROUP BY 1) s
          LEFT JOIN loads ON s.last = loads.l),
vv AS (SELECT v.*, LEAD(load_date) OVER (PARTITION BY o_orderkey ORDER BY load_date) AS nxt FROM v)
SELECT vv.o_orderkey, o_orderstatus, price, odate, load_date AS valid_from, COALESCE(nxt, close.after) AS valid_to,
  (nxt IS NULL AND close.after IS NULL) AS is_current
FROM vv LEFT JOIN close ON vv.o_orderkey = close.o_orderkey""")

SQL["anti_dimension"] = """
SELECT * FROM orders o WHERE NOT EXISTS (
  SELECT 1 FROM customer c WHERE c.c_custkey % 10 <> 0 AND c.c_custkey = o.o_custkey)"""

SQL["customer_360"] = with_(TXN, f""",
t AS (SELECT customer_id, COUNT(*) AS order_count, SUM({cents("total_amount")}) / 100.0 AS lifetime_revenue,
        MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date FROM txn GROUP BY 1),
e AS (SELECT user_id AS customer_id, COUNT(*) AS interaction_count, COUNT(DISTINCT event_type) AS interaction_types,
        MAX(ts) AS last_interaction FROM events GROUP BY 1)
SELECT c.c_custkey AS customer_id, c.c_name, c.c_acctbal, c.c_mktsegment, c.country, c.region,
  COALESCE(t.order_count, 0) AS order_count, COALESCE(t.lifetime_revenue, 0.0) AS lifetime_revenue,
  t.first_order_date, t.last_order_date,
  COALESCE(e.interaction_count, 0) AS interaction_count, e.interaction_types, e.last_interaction
FROM cust_geo c LEFT JOIN t ON c.c_custkey = t.customer_id LEFT JOIN e ON c.c_custkey = e.customer_id""")

SQL["window_pairs"] = """
SELECT e.event_id, e.user_id, e.ts,
  (SELECT COUNT(*) FROM events f WHERE f.user_id = e.user_id AND f.ts >= e.ts - INTERVAL 24 HOUR AND f.ts < e.ts)
    AS neighbors_within
FROM events e"""


# ---- profiles, reports, catalog ---------------------------------------------
def _median(t: str, x: str) -> str:
    return (f"(SELECT AVG(v) FROM (SELECT v, ROW_NUMBER() OVER (ORDER BY v) AS rn, COUNT(*) OVER () AS n "
            f"FROM (SELECT CAST({x} AS DOUBLE) AS v FROM {t} WHERE {x} IS NOT NULL)) "
            f"WHERE rn = (n + 1) // 2 OR rn = n // 2 + 1)")


def _prof(t: str, c: str, dtype: str, numeric: bool, median: bool = True) -> str:
    stats = (f"ROUND(AVG({c}), 2), ROUND(STDDEV_SAMP({c}), 2), CAST(MIN({c}) AS DOUBLE), CAST(MAX({c}) AS DOUBLE)"
             + (f", {_median(t, c)}" if median else "")) if numeric else \
        ("CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)"
         + (", CAST(NULL AS DOUBLE)" if median else ""))
    return (f"SELECT '{c}' AS \"column\", '{dtype}' AS dtype, COUNT(*) - COUNT({c}) AS null_count, "
            f"COUNT(DISTINCT {c}) AS unique_count, {rr(f'(COUNT(*) - COUNT({c})) * 100', 'COUNT(*)', 2)} AS null_pct, "
            f"{stats} FROM {t}")


_PROFILE_COLS = ' AS mean, '  # placeholder for readability

SQL["profile_columns"] = "SELECT * FROM (" + " UNION ALL ".join([
    _prof("customer", "c_custkey", "bigint", True), _prof("customer", "c_name", "string", False),
    _prof("customer", "c_nationkey", "int", True), _prof("customer", "c_acctbal", "double", True),
    _prof("customer", "c_mktsegment", "string", False)]) + ") t(\"column\", dtype, null_count, unique_count, " \
    "null_pct, mean, std, min, max, median)"

SQL["top_values"] = """
SELECT "column", value, count, CAST(rank AS INTEGER) AS rank FROM (
  SELECT "column", value, count, ROW_NUMBER() OVER (PARTITION BY "column" ORDER BY count DESC, value) AS rank
  FROM (SELECT "column", value, COUNT(*) AS count FROM (
          SELECT 'p_name' AS "column", p_name AS value FROM part UNION ALL
          SELECT 'p_brand', p_brand FROM part UNION ALL SELECT 'p_type', p_type FROM part)
        WHERE value IS NOT NULL GROUP BY 1, 2))
WHERE rank <= 5"""


def _quart(c: str, dtype: str, numeric: bool) -> str:
    stats = (f"ROUND(AVG({c}), 2), ROUND(STDDEV_SAMP({c}), 2), CAST(MIN({c}) AS DOUBLE), CAST(MAX({c}) AS DOUBLE), "
             f"quantile_cont(CAST({c} AS DOUBLE), 0.25), quantile_cont(CAST({c} AS DOUBLE), 0.75)") if numeric else \
        "NULL, NULL, NULL, NULL, NULL, NULL"
    return (f"SELECT '{c}', '{dtype}', COUNT(*) - COUNT({c}), COUNT(DISTINCT {c}), {stats} FROM part")


SQL["column_quartiles"] = "SELECT * FROM (" + " UNION ALL ".join([
    _quart("p_partkey", "bigint", True), _quart("p_size", "int", True),
    _quart("p_retailprice", "double", True), _quart("p_brand", "string", False)]) + \
    ") t(\"column\", dtype, null_count, unique_count, mean, std, min, max, q25, q75)"

SQL["outliers_iqr"] = """
WITH q AS (SELECT quantile_cont(CAST(n_chars AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(n_chars AS DOUBLE), 0.75) AS q3
           FROM documents),
f AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT d.doc_id, d.lang, d.source, d.n_chars, f.lo AS lower_fence, f.hi AS upper_fence,
  CASE WHEN d.n_chars < f.lo THEN 'low' ELSE 'high' END AS outlier_side
FROM documents d, f WHERE d.n_chars < f.lo OR d.n_chars > f.hi"""

SQL["numeric_summary"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", ROUND(CAST(SUM({c}) AS DOUBLE), 2) AS sum, ROUND(AVG({c}), 2) AS mean, "
    f"CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max FROM lineitem"
    for c in ["l_quantity", "l_discount", "l_tax"])

_STG_COLS = ["transaction_id", "order_date", "customer_id", "product_sku", "product_name", "category", "quantity",
             "unit_price", "total_amount", "currency", "payment_method", "status", "warehouse_id", "ship_date",
             "country", "region", "_source_file", "_row_hash"]
_NULLS = " + ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL)" for c in _STG_COLS)

SQL["completeness_report"] = with_(STG, f""",
per AS (SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS col, {rr(f'COUNT(*) FILTER (WHERE {c} IS NULL) * 100', 'COUNT(*)', 2)} AS value FROM stg"
    for c in _STG_COLS if not c.startswith("_")) + f""") WHERE value > 0)
SELECT 'overall_completeness_pct' AS metric, CAST(NULL AS VARCHAR) AS "column",
  {rr(f"(COUNT(*) * {len(_STG_COLS)} - ({_NULLS})) * 100", f"(COUNT(*) * {len(_STG_COLS)})", 2)} AS value FROM stg
UNION ALL SELECT 'null_pct', col, value FROM per""")

SQL["trend"] = with_(TXN, """,
d AS (SELECT order_date AS date, ROUND(COALESCE(SUM(total_amount), 0), 2) AS total_revenue
      FROM txn WHERE order_date IS NOT NULL GROUP BY 1),
r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY date) AS rn, COUNT(*) OVER () AS n FROM d),
h AS (SELECT AVG(CASE WHEN rn <= n // 2 THEN total_revenue END) AS f,
             AVG(CASE WHEN rn > n // 2 THEN total_revenue END) AS s FROM r),
p AS (SELECT (s - f) / GREATEST(f, 1.0) * 100 AS pct FROM h)
SELECT CASE WHEN pct > 5 THEN 'increasing' WHEN pct < -5 THEN 'decreasing' ELSE 'stable' END AS trend,
  ROUND(pct, 4) AS change_pct FROM p""")

SQL["report_sections"] = with_(TXN, f""",
x AS (SELECT * FROM txn WHERE total_amount IS NOT NULL),
r AS (SELECT total_amount, ROW_NUMBER() OVER (ORDER BY transaction_id) AS rn, COUNT(*) OVER () AS n FROM x),
h AS (SELECT (AVG(CASE WHEN rn > n // 2 THEN total_amount END) - AVG(CASE WHEN rn <= n // 2 THEN total_amount END))
          / GREATEST(AVG(CASE WHEN rn <= n // 2 THEN total_amount END), 1.0) * 100 AS pct FROM r),
t AS (SELECT CASE WHEN pct > 5 THEN 'increasing' WHEN pct < -5 THEN 'decreasing' ELSE 'stable' END AS trend FROM h),
s AS (SELECT ROUND(SUM(total_amount), 2) AS total, {money_avg("total_amount")} AS average,
        ROUND(MEDIAN({cents("total_amount")})) / 100.0 AS median FROM x),
d AS (SELECT CAST(MIN(order_date) AS VARCHAR) AS a, CAST(MAX(order_date) AS VARCHAR) AS b, COUNT(*) AS n FROM txn)
SELECT 'revenue_summary' AS section, 'total' AS metric, total AS num_value, CAST(NULL AS VARCHAR) AS text_value FROM s
UNION ALL SELECT 'revenue_summary', 'average', average, NULL FROM s
UNION ALL SELECT 'revenue_summary', 'median', median, NULL FROM s
UNION ALL SELECT 'revenue_summary', 'trend', NULL, trend FROM t
UNION ALL SELECT 'volume_metrics', 'total_records', CAST(n AS DOUBLE), NULL FROM d
UNION ALL SELECT 'volume_metrics', 'date_range_start', NULL, a FROM d
UNION ALL SELECT 'volume_metrics', 'date_range_end', NULL, b FROM d
UNION ALL SELECT 'narrative', 'summary', NULL,
  'Total revenue for the period: $' || format('{{:,.2f}}', total) || ' (average: $' || format('{{:,.2f}}', average)
  || '). Trend: ' || trend || '. Total records processed: ' || format('{{:,d}}', n) || '.' FROM s, t, d
UNION ALL SELECT * FROM (SELECT 'top_categories', category, ROUND(SUM(total_amount), 2), NULL FROM txn
  GROUP BY category ORDER BY 3 DESC, category LIMIT 5)""")

_LAYERS = {"bronze": ["orders", "lineitem", "events", "documents", "pages", "conversations"],
           "silver": ["customer", "supplier", "part", "labels", "embeddings", "benchmark"],
           "gold": ["nation", "region"]}
_NCOLS = {"orders": 6, "lineitem": 11, "events": 6, "documents": 5, "pages": 3, "conversations": 4,
          "customer": 5, "supplier": 4, "part": 6, "labels": 3, "embeddings": 3, "benchmark": 2,
          "nation": 3, "region": 2}

SQL["list_datasets"] = with_(DQ_REPORT, " UNION ALL ".join(
    f"SELECT '{ly}' AS layer, '{n}' AS name, '{n} table' AS description, (SELECT COUNT(*) FROM {n}) AS row_count, "
    f"{_NCOLS[n]} AS column_count, "
    + ("(SELECT ROUND(AVG(_raw_score), 4) FROM report)" if n == "orders" else "CAST(NULL AS DOUBLE)")
    + " AS quality_score, TRUE AS has_time" for ly, ns in _LAYERS.items() for n in ns))

SQL["select_datasets"] = " UNION ALL ".join(
    f"SELECT 'bronze' AS layer, '{n}' AS name, '{n} table' AS description, COUNT(*) AS row_count, "
    f"{_NCOLS[n]} AS column_count FROM {n}" for n in ["orders", "events"])

SQL["get_schema"] = """
SELECT column_name, CAST(ordinal_position AS INTEGER) AS ordinal_position, data_type, is_nullable = 'YES' AS is_nullable
FROM information_schema.columns WHERE table_name = 'lineitem'"""

SQL["adhoc_sql"] = ("SELECT o_orderpriority, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS revenue "
                    "FROM orders GROUP BY o_orderpriority ORDER BY n DESC, o_orderpriority LIMIT 100")


# ---- file sources and sinks -------------------------------------------------
SQL["read_transactions_csv"] = with_(RAW_ERP, "SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record FROM raw_erp")

SQL["read_events_envelope"] = """
SELECT event_id, ts, user_id, event_type, value, props, '2.1' AS api_version,
  CAST(floor(event_id / 500) AS BIGINT) AS page FROM events"""

SQL["read_contacts_json"] = """
SELECT 'CRM-' || CAST(c_custkey AS VARCHAR) AS contact_id, c_name AS first_name,
  'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email, 'Co ' || CAST(c_custkey % 97 AS VARCHAR) AS company,
  CAST(ROUND(c_acctbal * 1000) AS BIGINT) AS cf_annual_revenue, CAST(c_nationkey AS BIGINT) AS cf_employee_count,
  c_mktsegment AS cf_subscription_tier,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE
    array_to_string(list_sort([lower(c_mktsegment), 'n' || CAST(c_nationkey AS VARCHAR)]), ',') END AS tags
FROM customer"""


def _infer(c: str, t: str) -> str:
    v = f"NULLIF(TRIM(CAST({c} AS VARCHAR)), '')"
    return (f"SELECT '{c}' AS \"column\", '{t}' AS inferred_type, COUNT({v}) AS non_null, "
            f"COUNT(*) FILTER (WHERE regexp_matches({v}, '^[+-]?[0-9]+$')) AS int_values, COUNT(TRY_CAST({v} AS DOUBLE)) AS numeric_values, "
            f"COUNT(*) FILTER (WHERE lower({v}) IN ('true', 'yes', 'false', 'no')) AS bool_values FROM customer")


SQL["infer_types"] = " UNION ALL ".join([
    _infer("c_custkey", "bigint"), _infer("c_name", "string"), _infer("c_nationkey", "bigint"),
    _infer("c_acctbal", "double"), _infer("c_mktsegment", "string")])

SQL["detect_delimiter"] = ("SELECT * FROM (VALUES ('comma', ','), ('semicolon', ';'), ('tab', chr(9)), "
                           "('pipe', '|')) t(dataset, delimiter)")

SQL["detect_encoding"] = "SELECT * FROM (VALUES ('utf8', 'utf-8'), ('latin1', 'latin-1')) t(dataset, encoding)"

SQL["snapshot_latest"] = "SELECT *, DATE '2024-03-01' AS _snapshot FROM orders"

SQL["list_snapshots"] = "SELECT * FROM (VALUES ('2024-01-01'), ('2024-02-01'), ('2024-03-01')) t(snapshot)"

SQL["sink_partitioned"] = with_(INT_CLEANED, "SELECT * FROM int_cleaned")

SQL["dead_letter"] = with_(VALIDATED_ERP, """
SELECT transaction_id, _error AS error, DATE '2024-01-31' AS reject_date FROM verr WHERE _error IS NOT NULL""")

SQL["quality_history"] = with_(DQ_REPORT.replace("1998-05-31", "1998-12-31"), "SELECT * EXCLUDE (_raw_score) FROM report")

SQL["quality_reports"] = with_(DQ_REPORT, "SELECT * EXCLUDE (_raw_score), TIMESTAMP '1998-06-01' AS run_ts FROM report")

SQL["run_metrics_json"] = SQL["ingest_metrics"]

SQL["register_table"] = """
SELECT 1 AS batch, COUNT(*) AS n, 0 AS n_priority, 0 AS n_channel FROM orders WHERE o_orderkey % 2 = 0
UNION ALL
SELECT 2, COUNT(*), COUNT(o_orderpriority), COUNT(*) FROM orders WHERE o_orderkey % 2 = 1"""


# ---- streaming --------------------------------------------------------------
SQL["stream_ingest_split"] = """
SELECT * FROM events WHERE event_id IS NOT NULL AND event_id <> 0 AND ts IS NOT NULL"""

SQL["stream_rejects"] = """
SELECT event_id, concat_ws('; ', CASE WHEN event_type = 'error' THEN 'Error event of user ' || CAST(user_id AS VARCHAR) END,
  CASE WHEN value > 400 THEN 'Value above 400' END) AS error
FROM events WHERE event_type = 'error' OR value > 400"""

SQL["stream_quality"] = f"""
WITH n AS (SELECT COUNT(*) AS n,
    COUNT(*) FILTER (WHERE event_type IS NULL OR TRIM(event_type) = '') AS blank,
    COUNT(*) FILTER (WHERE value < 0) AS negative FROM events),
u AS (SELECT SUM(k - 1) AS repeats FROM (SELECT COUNT(*) AS k FROM events GROUP BY user_id, event_type)),
r AS (
  SELECT 'completeness_event_type' AS rule_name, 'completeness' AS dimension, 'event_type' AS "column", blank AS failed,
    0.95 AS threshold, n FROM n
  UNION ALL SELECT 'accuracy_value', 'accuracy', 'value', negative, 0.98, n FROM n
  UNION ALL SELECT 'uniqueness_user_id_event_type', 'uniqueness', 'user_id,event_type', CAST(repeats AS BIGINT), 1.0, n FROM n, u
  UNION ALL SELECT 'completeness_channel', 'completeness', 'channel', n, 0.95, n FROM n)
SELECT 'events' AS dataset_name, 'stream' AS layer, rule_name, dimension, "column",
  {rr("(n - failed)", "n", 4)} AS score, 1.0 - failed / n >= threshold AS passed, CAST(threshold AS DOUBLE) AS threshold,
  'error' AS severity, n AS total_records, CAST(failed AS BIGINT) AS failed_records
FROM r"""

SQL["stream_dedup"] = SQL["dedup_window"]

SQL["stream_daily"] = """
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
  event_type, COUNT(*) AS events, SUM(CAST(ROUND(value * 100) AS BIGINT)) / 100.0 AS value_sum
FROM events GROUP BY 1, 2, 3"""

SQL["stream_sliding"] = """
WITH s AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE AS window_start
           FROM events, UNNEST(range(4)) AS r(k))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, COUNT(*) AS events FROM s GROUP BY 1, 2"""

SQL["stream_session"] = """
WITH l AS (SELECT user_id, ts, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
f AS (SELECT *, SUM(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM l)
SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 30 MINUTE AS session_end, COUNT(*) AS events
FROM f GROUP BY user_id, sid"""

SQL["stream_reject_alarm"] = """
WITH c AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, COUNT(*) AS events
           FROM events WHERE event_type = 'error' OR value > 400 GROUP BY 1)
SELECT c.window_start, c.events, p.events AS prev_events
FROM c JOIN c p ON p.window_start + INTERVAL 5 MINUTE = c.window_start
WHERE c.events > 1 AND p.events > 1"""

SQL["stream_layers"] = """
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
  replace(lower(CASE WHEN TRIM(event_type) IN ('', 'NULL', 'null', 'None', 'none', 'N/A', 'n/a', 'NA', '#N/A')
                     THEN NULL ELSE TRIM(event_type) END), ' ', '_') AS event_type,
  COUNT(*) AS events, SUM(CAST(ROUND(value * 100) AS BIGINT)) / 100.0 AS value_sum
FROM events GROUP BY 1, 2, 3"""


# ---- pipeline jobs ----------------------------------------------------------
SQL["bronze_metrics"] = with_(VALIDATED_ERP, f""",
{CONTACTS.replace(CUST_GEO + ",", "", 1)},
cr AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY contact_id ORDER BY _seq) AS rn FROM contacts),
cv AS (SELECT (contact_id IS NULL OR TRIM(contact_id) = '') OR (email IS NULL OR TRIM(email) = '')
          OR (company IS NULL OR TRIM(company) = '')
          OR (email IS NOT NULL AND email <> '' AND NOT regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}$'))
          OR COALESCE(deal_value_usd < 0, FALSE)
          OR (contact_id IS NOT NULL AND contact_id <> '' AND rn > 1) AS bad FROM cr),
ev AS (SELECT NOT (event_id IS NOT NULL AND event_id <> 0) OR ts IS NULL AS bad FROM events),
m AS (
  SELECT 'erp_transactions' AS source_name, 'erp' AS source_type, COUNT(*) AS records_read,
    COUNT(*) FILTER (WHERE _error IS NULL) AS records_accepted, COUNT(*) FILTER (WHERE _error IS NOT NULL) AS records_rejected FROM verr
  UNION ALL SELECT 'crm_contacts', 'crm', COUNT(*), COUNT(*) FILTER (WHERE NOT bad), COUNT(*) FILTER (WHERE bad) FROM cv
  UNION ALL SELECT 'api_events', 'api', COUNT(*), COUNT(*) FILTER (WHERE NOT bad), COUNT(*) FILTER (WHERE bad) FROM ev
  UNION ALL SELECT 'lake_invoices', 'lake', 0, 0, 0)
SELECT source_name, source_type, records_read, records_accepted, records_rejected,
  CASE WHEN records_read = 0 THEN 0.0 ELSE {rr("records_rejected * 100", "records_read", 2)} END AS rejection_rate_pct,
  CASE WHEN records_read = 0 THEN 'failed' WHEN records_rejected = 0 THEN 'success'
       WHEN records_accepted > 0 THEN 'partial' ELSE 'failed' END AS status
FROM m""")

GROUPED_KPIS = """UNION ALL SELECT 'revenue_by_category', category, ROUND(SUM(v), 2) FROM acc GROUP BY category
UNION ALL SELECT 'revenue_by_country', country, ROUND(SUM(v), 2) FROM acc GROUP BY country
UNION ALL SELECT 'customers_by_country', country, CAST(COUNT(DISTINCT customer_id) AS DOUBLE) FROM acc GROUP BY country
UNION ALL SELECT 'top_products', product_sku, n FROM (SELECT product_sku, CAST(COUNT(*) AS DOUBLE) AS n FROM acc
  GROUP BY product_sku ORDER BY n DESC, product_sku LIMIT 5)
UNION ALL SELECT 'status_distribution', status, CAST(COUNT(*) AS DOUBLE) FROM acc GROUP BY status"""

SQL["bronze_to_gold"] = with_(VALIDATED_ERP, f""",
acc AS (SELECT TRY_CAST(total_amount AS DOUBLE) AS v, TRY_CAST(quantity AS DOUBLE) AS q, customer_id,
          category, country, product_sku, status, TRY_CAST(order_date AS DATE) AS day
        FROM verr WHERE _error IS NULL),
x AS (SELECT v, {cents("v")} AS c FROM acc WHERE v IS NOT NULL),
per AS (SELECT customer_id, COALESCE(SUM({cents("v")}), 0) AS c FROM acc WHERE customer_id IS NOT NULL GROUP BY 1),
ranked AS (SELECT c, ROW_NUMBER() OVER (ORDER BY c DESC) AS rn, COUNT(*) OVER () AS n FROM per)
SELECT 'revenue' AS kpi_group, 'total_revenue' AS kpi, ROUND(SUM(v), 2) AS value FROM x
UNION ALL SELECT 'revenue', 'avg_order_value', {money_avg("v")} FROM x
UNION ALL SELECT 'revenue', 'median_order_value', ROUND(MEDIAN(c)) / 100.0 FROM x
UNION ALL SELECT 'revenue', 'max_order_value', ROUND(MAX(v), 2) FROM x
UNION ALL SELECT 'revenue', 'min_order_value', ROUND(MIN(v), 2) FROM x
UNION ALL SELECT 'revenue', 'std_dev', CASE WHEN COUNT(*) > 1 THEN ROUND(STDDEV_SAMP(v), 2) ELSE 0.0 END FROM x
UNION ALL SELECT 'revenue', 'total_transactions', CAST(COUNT(*) AS DOUBLE) FROM x
UNION ALL SELECT 'customer', 'total_unique_customers', CAST(COUNT(*) AS DOUBLE) FROM ranked
UNION ALL SELECT 'customer', 'avg_revenue_per_customer', {rr("SUM(c)", "(COUNT(*) * 100)", 2)} FROM ranked
UNION ALL SELECT 'customer', 'max_revenue_customer', MAX(c) / 100.0 FROM ranked
UNION ALL SELECT 'customer', 'top_10pct_revenue_share',
  {rr("SUM(CASE WHEN rn <= GREATEST(1, FLOOR(n * 0.1)) THEN c ELSE 0 END) * 100", "GREATEST(SUM(c), 100)", 2)} FROM ranked
UNION ALL SELECT 'operational', 'avg_quantity_per_order', {rr(f"SUM({cents('q')})", "(COUNT(q) * 100)", 2)} FROM acc
UNION ALL SELECT 'operational', 'total_units_sold', CAST(CAST(SUM(q) AS BIGINT) AS DOUBLE) FROM acc
{GROUPED_KPIS}
UNION ALL SELECT 'summary', 'record_count', CAST(COUNT(*) AS DOUBLE) FROM acc""")

SQL["union_sources"] = """
SELECT DISTINCT * FROM (
  SELECT o_orderkey AS record_id, o_custkey AS customer_id, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS event_type,
    CAST(NULL AS VARCHAR) AS name, 'orders' AS _source_system FROM orders
  UNION ALL SELECT event_id, user_id, value, event_type, NULL, 'events' FROM events
  UNION ALL SELECT NULL, c_custkey, NULL, NULL, c_name, 'customer' FROM customer)"""


SQL["interaction_daily"] = f"""
WITH d AS (SELECT *, CAST(ts AS DATE) AS date FROM events),
f AS (SELECT date, COUNT(*) AS new_customers FROM (SELECT user_id, MIN(date) AS date FROM d GROUP BY 1) GROUP BY 1),
g AS (SELECT date, COUNT(*) AS customer_interactions, COUNT(DISTINCT user_id) AS active_customers,
        COUNT(*) FILTER (WHERE event_type = 'purchase') AS conversions,
        {rr("COUNT(*) FILTER (WHERE event_type = 'purchase') * 100", "COUNT(*)", 2)} AS conversion_rate,
        {money_avg("value", 4)} / 60.0 AS resp
      FROM d GROUP BY date)
SELECT g.date, customer_interactions, active_customers, COALESCE(new_customers, 0) AS new_customers, conversions,
  conversion_rate, ROUND(resp, 2) AS avg_response_time_minutes
FROM g LEFT JOIN f ON g.date = f.date"""

SQL["interaction_leads"] = f"""
WITH i AS ({SQL["interaction_daily"]}),
c AS (SELECT o_custkey AS k, CAST(MIN(o_orderdate) AS DATE) AS date FROM orders GROUP BY 1),
l AS (SELECT date, COUNT(*) AS new_leads FROM customer JOIN c ON c.k = c_custkey
      WHERE c_custkey % 4 = 0 AND c_custkey % 59 <> 0 GROUP BY 1)
SELECT COALESCE(i.date, l.date) AS date, COALESCE(customer_interactions, 0) AS customer_interactions,
  COALESCE(active_customers, 0) AS active_customers, COALESCE(new_customers, 0) AS new_customers,
  COALESCE(conversions, 0) AS conversions, COALESCE(new_leads, 0) AS new_leads, conversion_rate, avg_response_time_minutes
FROM i FULL JOIN l ON i.date = l.date"""

SQL["dedup_sample_groups"] = """
SELECT l_orderkey, l_linenumber, COUNT(*) AS count, LEAST(COUNT(*), 2) AS sample_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
ORDER BY l_orderkey, l_linenumber LIMIT 3"""


def _info(c: str, pos: int, dtype: str) -> str:
    v = f"CAST({c} AS VARCHAR)"
    return (f"SELECT '{c}' AS \"column\", {pos} AS position, '{dtype}' AS dtype, COUNT({c}) AS non_null, "
            f"COUNT(*) - COUNT({c}) AS null_count, COUNT(DISTINCT {v}) AS unique_count, "
            f"(SELECT array_to_string(list_sort(list(v)), ' | ') FROM (SELECT DISTINCT {v} AS v FROM supplier "
            f"WHERE {c} IS NOT NULL ORDER BY v LIMIT 3)) AS sample_values FROM supplier")


SQL["schema_info"] = " UNION ALL ".join([
    _info("s_suppkey", 1, "bigint"), _info("s_name", 2, "string"), _info("s_nationkey", 3, "int"),
    _info("s_acctbal", 4, "double")])

SQL["validate_csv_rows"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS col_0,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderstatus END AS col_1, o_orderpriority AS col_2,
  CASE WHEN o_orderkey % 19 = 0 THEN 'Missing required column: col_1' END AS _error,
  o_orderkey % 19 <> 0 AS _is_valid
FROM orders"""

SQL["dq_route"] = with_(STG, f""",
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY {_nulls_first(_RAW_ORDER)}) AS rn FROM stg),
f AS (SELECT transaction_id, concat_ws('; ',
    CASE WHEN customer_id IS NULL OR TRIM(customer_id) = '' THEN 'completeness_customer_id' END,
    CASE WHEN quantity IS NOT NULL AND NOT (quantity >= 0 AND quantity <= 10000) THEN 'accuracy_quantity' END,
    CASE WHEN currency IS NOT NULL AND currency NOT IN ('USD', 'MXN', 'EUR', 'CAD') THEN 'accuracy_currency' END,
    CASE WHEN rn > 1 THEN 'uniqueness_transaction_id' END,
    CASE WHEN TRY_CAST(order_date AS TIMESTAMP) < TIMESTAMP '1998-05-31 00:00:00' THEN 'timeliness_order_date' END,
    CASE WHEN unit_price IS NOT NULL AND total_amount IS NOT NULL AND unit_price > total_amount
         THEN 'consistency_unit_price_vs_total_amount' END) AS failed_rules FROM r)
SELECT transaction_id, failed_rules, failed_rules = '' AS _dq_passed FROM f""")

SQL["gold_partitioned"] = SQL["fct_daily_metrics"]

SQL["weekly_rollup_iso"] = with_(TXN, f"""
SELECT CAST(isoyear(order_date) AS INTEGER) AS year, CAST(weekofyear(order_date) AS INTEGER) AS week, {_PERIOD_AGGS},
  'weekly' AS _aggregation_type, 'gold' AS _layer
FROM txn WHERE order_date IS NOT NULL GROUP BY 1, 2""")

SQL["validate_company_dim"] = """
WITH d AS (SELECT (['NORTH', 'SOUTH', 'EAST', 'WEST', 'CENTRAL', 'COAST', 'HILL',
                    'LAKE', 'ACME'])[CAST(s_suppkey % 9 + 1 AS INTEGER)] AS company_id,
                  s_name AS company_name FROM supplier),
e AS (SELECT company_id, company_name,
        CASE WHEN company_id IS NOT NULL AND company_id <> '' AND company_id NOT IN
          ('NORTH', 'SOUTH', 'EAST', 'WEST', 'CENTRAL', 'COAST', 'HILL', 'LAKE')
          THEN 'Unknown company_id: ' || company_id END AS _error FROM d)
SELECT *, _error IS NULL AS _is_valid FROM e"""


# Greedy near-duplicate removal: the similarity graph of each block, then one row
# after the other in order, each kept unless an earlier kept row is its neighbour.
SQL["dedup_fuzzy"] = r"""
WITH RECURSIVE n AS (
  SELECT doc_id, lang, source,
    lower(regexp_replace(regexp_replace(COALESCE(text, ''), '^\s+', ''), '\s+$', '')) AS t
  FROM documents),
firsts AS (SELECT t, MIN(doc_id) AS doc_id FROM n GROUP BY t),
letters AS (SELECT doc_id, t, substr(t, 1, 5) AS blk, regexp_extract_all(t, '(?s).') AS c FROM firsts),
grams AS (SELECT doc_id, t, blk, CASE WHEN len(c) < 2 THEN [t] ELSE
    list_distinct([c[i] || c[i + 1] for i in range(1, len(c))]) END AS g FROM letters),
near AS (
  SELECT a.doc_id AS earlier, b.doc_id AS later
  FROM grams a JOIN grams b ON a.blk = b.blk AND a.doc_id < b.doc_id
  WHERE len(list_intersect(a.g, b.g)) >= 0.85 * (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g)))),
seq AS (SELECT doc_id, ROW_NUMBER() OVER (ORDER BY doc_id) AS i
        FROM (SELECT earlier AS doc_id FROM near UNION SELECT later FROM near)),
nb AS (SELECT s.i, s.doc_id, list(x.earlier) FILTER (WHERE x.earlier IS NOT NULL) AS ns
       FROM seq s LEFT JOIN near x ON x.later = s.doc_id GROUP BY s.i, s.doc_id),
walk(i, kept) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL
  SELECT w.i + 1, CASE WHEN list_has_any(COALESCE(nb.ns, []), w.kept) THEN w.kept ELSE list_append(w.kept, nb.doc_id) END
  FROM walk w JOIN nb ON nb.i = w.i + 1),
chosen AS (SELECT unnest(kept) AS doc_id FROM walk WHERE i = (SELECT MAX(i) FROM walk))
SELECT n.doc_id, n.lang, n.source FROM n JOIN firsts f ON n.doc_id = f.doc_id
WHERE n.doc_id NOT IN (SELECT doc_id FROM seq) OR n.doc_id IN (SELECT doc_id FROM chosen)"""


# ---- layers from storage, options of earlier operators ----------------------
ACCEPTED = VALIDATED_ERP + """,
acc AS (SELECT TRY_CAST(total_amount AS DOUBLE) AS v, TRY_CAST(quantity AS DOUBLE) AS q, customer_id,
          category, country, product_sku, status, TRY_CAST(order_date AS DATE) AS day
        FROM verr WHERE _error IS NULL)"""

SQL["gold_layer_kpis"] = with_(ACCEPTED, "\n" + GROUPED_KPIS.replace(
    "UNION ALL SELECT 'revenue_by_category', category, ROUND(SUM(v), 2)",
    "SELECT 'revenue_by_category' AS kpi_group, category AS kpi, ROUND(SUM(v), 2) AS value", 1))

SQL["silver_layer"] = with_(ACCEPTED, """
SELECT 'bronze' AS step, COUNT(*) AS rows FROM acc UNION ALL SELECT 'silver', COUNT(*) FROM acc
UNION ALL SELECT 'quality_rules', 3
UNION ALL SELECT 'quality_failed', CAST(AVG(CASE WHEN q BETWEEN 0 AND 10000 THEN 1 ELSE 0 END) < 0.98 AS INT)
  + CAST(AVG(CASE WHEN customer_id IS NULL THEN 0 ELSE 1 END) < 0.95 AS INT) FROM acc""")

SQL["gold_layer_daily"] = with_(ACCEPTED, f""",
base AS (SELECT day AS date, ROUND(SUM(v), 2) AS total_revenue, COUNT(v) AS transaction_count,
    COUNT(DISTINCT customer_id) AS unique_customer_ids, COUNT(DISTINCT product_sku) AS unique_product_skus
  FROM acc GROUP BY day)
SELECT base.*, tc.top_category, tco.top_country FROM base
LEFT JOIN {_top("acc", "day", "category", "top_category")} tc ON base.date = tc.date
LEFT JOIN {_top("acc", "day", "country", "top_country")} tco ON base.date = tco.date""")

SQL["pipeline_run_report"] = with_(VALIDATED_ERP, """,
m AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE _error IS NULL) AS ok FROM verr)
SELECT 'ingest:erp_transactions' AS section, 'records_read' AS metric, CAST(n AS DOUBLE) AS value FROM m
UNION ALL SELECT 'ingest:erp_transactions', 'records_accepted', ok FROM m
UNION ALL SELECT 'ingest:erp_transactions', 'records_rejected', n - ok FROM m
UNION ALL SELECT 'quality:erp_transactions', 'completeness_customer_id',
  CAST(COUNT(customer_id) AS DOUBLE) / COUNT(*) FROM verr WHERE _error IS NULL
UNION ALL SELECT 'quality:erp_transactions', 'accuracy_quantity',
  CAST(COUNT(*) FILTER (WHERE TRY_CAST(quantity AS DOUBLE) BETWEEN 0 AND 10000) AS DOUBLE) / COUNT(*) FROM verr WHERE _error IS NULL
UNION ALL SELECT 'quality:erp_transactions', 'uniqueness_transaction_id',
  CAST(COUNT(DISTINCT transaction_id) AS DOUBLE) / COUNT(*) FROM verr WHERE _error IS NULL""")

SQL["weekly_growth"] = with_(TXN, """,
m AS (SELECT CAST(isoyear(order_date) AS INTEGER) AS year, CAST(weekofyear(order_date) AS INTEGER) AS week,
        ROUND(COALESCE(SUM(total_amount), 0), 2) AS total_revenue
      FROM txn WHERE order_date IS NOT NULL GROUP BY 1, 2)
SELECT year, week, total_revenue, LAG(total_revenue) OVER (ORDER BY year, week) AS prev_revenue,
  ROUND((total_revenue - LAG(total_revenue) OVER (ORDER BY year, week))
        / NULLIF(LAG(total_revenue) OVER (ORDER BY year, week), 0) * 100, 2) AS revenue_growth_pct
FROM m""")

SQL["typed_projection"] = """
SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier"""

SQL["read_gzip_csv"] = "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus FROM orders"

SQL["snapshot_json"] = "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, '2024-01-02' AS dt FROM customer"

SQL["snapshot_nested"] = ("SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_totalprice, "
                          "o_orderstatus AS status, '2024-02-01' AS snapshot FROM orders")

SQL["snapshot_index"] = """
WITH f AS (SELECT o_orderkey AS k, o_orderstatus AS status, CASE WHEN o_orderstatus = 'O' THEN 'json' ELSE 'parquet' END AS format
           FROM orders)
SELECT snapshot, status, format, CAST(COUNT(*) AS BIGINT) AS n
FROM (SELECT '2024-01-01' AS snapshot, status, format FROM f WHERE k % 2 = 0
      UNION ALL SELECT '2024-02-01', status, format FROM f
      UNION ALL SELECT '2024-04-01', NULL, 'parquet' FROM f WHERE k % 3 = 0) GROUP BY ALL"""

SQL["quarantine_files"] = """
SELECT 'row' AS status, o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS file FROM orders
UNION ALL SELECT 'empty', NULL, NULL, 'empty.parquet'
UNION ALL SELECT 'unreadable', NULL, NULL, 'broken.parquet'
UNION ALL SELECT 'empty', NULL, NULL, 'nothing.parquet'"""

SQL["source_file_names"] = with_(RAW_ERP, """
SELECT transaction_id, product_sku, TRUE AS named, TIMESTAMP '2024-01-31 12:00:00' AS _ingested_at, 'erp' AS _source_system,
  'csv' AS _source_type, 'run-0001' AS _run_id, '1.0.0' AS _pipeline_version FROM raw_erp""")

SQL["silver_job_counts"] = SQL["silver_job"].rsplit("SELECT * EXCLUDE (rk)", 1)[0].rstrip() + """,
n AS (SELECT (SELECT COUNT(*) FROM raw_erp) AS r, (SELECT COUNT(*) FROM valid) AS c,
        (SELECT COUNT(*) FROM ranked WHERE rk = 1) AS w)
SELECT 'read' AS step, r AS rows FROM n UNION ALL SELECT 'rejected', r - c FROM n UNION ALL SELECT 'cleaned', c FROM n
UNION ALL SELECT 'duplicates', c - w FROM n UNION ALL SELECT 'written', w FROM n UNION ALL SELECT 'stored', w FROM n"""

SQL["schema_row_tags"] = with_(RAW_ERP, """
SELECT *, list_filter([
  CASE WHEN transaction_id IS NULL THEN 'null:transaction_id' END,
  CASE WHEN order_date IS NOT NULL AND TRY_CAST(TRIM(order_date) AS TIMESTAMP) IS NULL THEN 'type:order_date' END,
  CASE WHEN quantity IS NOT NULL AND TRY_CAST(TRIM(quantity) AS DOUBLE) IS NULL THEN 'type:quantity' END,
  CASE WHEN unit_price IS NOT NULL AND TRY_CAST(TRIM(unit_price) AS DOUBLE) IS NULL THEN 'type:unit_price' END,
  CASE WHEN total_amount IS NOT NULL AND TRY_CAST(TRIM(total_amount) AS DOUBLE) IS NULL THEN 'type:total_amount' END
  ], lambda x: x IS NOT NULL) AS _schema_violations
FROM raw_erp""")

SQL["schema_drop"] = with_(RAW_ERP, "SELECT * EXCLUDE (payment_method, warehouse_id, ship_date) FROM raw_erp")

_STRATEGY = f"""input AS total_input, output AS total_output, found AS duplicates_found,
  input - output AS duplicates_removed,
  CASE WHEN input > 0 THEN {rr("(input - output) * 100", "input", 2)} ELSE 0.0 END AS dedup_rate_pct"""

SQL["dedup_dispatch"] = f"""
WITH g AS (SELECT COUNT(*) AS k FROM lineitem GROUP BY l_orderkey, l_linenumber),
a AS (SELECT CAST(COALESCE(SUM(CASE WHEN k > 1 THEN k ELSE 0 END), 0) AS BIGINT) AS found,
        CAST(SUM(k) AS BIGINT) AS input, COUNT(*) AS output FROM g),
kept AS ({SQL["dedup_window"]}),
w AS (SELECT i AS input, o AS output, i - o AS found
      FROM (SELECT (SELECT COUNT(*) FROM events) AS i, (SELECT COUNT(*) FROM kept) AS o)),
z AS (SELECT i AS input, o AS output, i - o AS found
      FROM (SELECT (SELECT COUNT(*) FROM documents) AS i, (SELECT COUNT(*) FROM ({SQL["dedup_fuzzy"]})) AS o))
SELECT 'exact' AS strategy, {_STRATEGY} FROM a
UNION ALL SELECT 'window->exact', {_STRATEGY} FROM a
UNION ALL SELECT 'window', {_STRATEGY} FROM w
UNION ALL SELECT 'fuzzy', {_STRATEGY} FROM z"""

SQL["daily_quality_counts"] = with_(STG, """,
silver AS (
  SELECT TRY_CAST(order_date AS DATE) AS date, total_amount, quantity, unit_price FROM stg
  WHERE NOT starts_with(product_sku, 'INVALID') AND status <> 'Error')
SELECT date, ROUND(STDDEV_SAMP(total_amount), 2) AS stddev_order_value_usd,
  COUNT(*) FILTER (WHERE quantity IS NULL OR quantity <= 0) AS invalid_quantity_count,
  COUNT(*) FILTER (WHERE ABS(quantity * unit_price - total_amount) > 0.01) AS amount_mismatch_count
FROM silver GROUP BY date""")

SQL["bronze_view"] = with_(STG, "SELECT status, COUNT(*) AS n, COUNT(total_amount) AS n_amount FROM stg GROUP BY status")

SQL["adhoc_sql_layers"] = """
SELECT COUNT(*) AS n, 'bronze' AS layer FROM orders UNION ALL SELECT COUNT(*), 'gold' FROM orders WHERE o_orderstatus = 'F'"""
