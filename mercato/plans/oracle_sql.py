"""Plain-SQL formulations of every registered query, for DuckDB.

They read the same parquet tables as the Spark operators and are written the
naive, row-level way (joins before aggregation, ordinary windows), so they
check the Spark plans' rewrites (pre-aggregation, bucketed ranks, one-shuffle
diff) independently. Rounding and money conversions use the same exact
integer formulas as ``mercato.functions`` so both engines give the same bits.
"""

from __future__ import annotations


def rr(num: str, den: str, digits: int = 2, mult: int = 1, num_scale: int = 0, den_scale: int = 0) -> str:
    """SQL for round(num/den*mult, digits), exact HALF_UP, as DOUBLE; NULL when den = 0."""
    a = f"CAST(({num}) * {10 ** num_scale} AS HUGEINT)"
    b = f"CAST(({den}) * {10 ** den_scale} AS HUGEINT)"
    p = f"(abs({a}) * {mult * 10 ** (digits + den_scale)})"
    q = f"(abs({b}) * {10 ** num_scale})"
    return (f"(CASE WHEN {b} <> 0 THEN CAST(sign({a}) * sign({b}) * ((2 * {p} + {q}) // (2 * {q})) AS DOUBLE)"
            f" / {float(10 ** digits)} END)")


def rr0(num: str, den: str, **kw) -> str:
    """Guarded ratio: the rounded ratio when den > 0, else 0."""
    return f"(CASE WHEN ({den}) > 0 THEN {rr(num, den, **kw)} ELSE 0.0 END)"


def dbl(x: str) -> str:
    """Exact decimal -> correctly rounded double (through text)."""
    return f"CAST(CAST(({x}) AS VARCHAR) AS DOUBLE)"


FACT = """
fact AS (
  SELECT
    concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR), '-',
           CAST(l_partkey AS VARCHAR), '-', CAST(l_suppkey AS VARCHAR)) AS order_id,
    CAST(o_custkey AS VARCHAR) AS customer_id,
    CAST(o_orderdate AS DATE) AS order_date,
    CAST(l_shipdate AS DATE) AS delivery_date,
    CAST(l_partkey AS VARCHAR) AS product_id,
    p_name AS product_type,
    p_type AS category,
    CAST(l_quantity AS INTEGER) AS quantity,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS total_amount,
    CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS INTEGER) AS discount_percent,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS discount_amount,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
         * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS grand_total,
    o_orderpriority AS payment_method,
    r_name AS region,
    n_name AS city,
    c_mktsegment AS customer_segment,
    CASE WHEN l_returnflag = 'R' THEN 'Returned' WHEN o_orderstatus = 'P' THEN 'Processing'
         ELSE 'Delivered' END AS order_status,
    CAST(1 + (l_orderkey + l_linenumber + l_partkey) % 7 AS DOUBLE) AS rating,
    CASE o_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_prime_member
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
clean AS (
  SELECT * REPLACE (CASE WHEN rating >= 1 AND rating <= 5 THEN rating END AS rating)
  FROM fact
  WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL
    AND order_date IS NOT NULL AND grand_total IS NOT NULL AND grand_total >= 0
    AND quantity IS NOT NULL AND quantity > 0
),
delivered AS (SELECT * FROM clean WHERE order_status = 'Delivered')"""

DIMS = """
customers_dim AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         CAST(18 + c_custkey % 53 AS INTEGER) AS age,
         CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'Other' END AS gender,
         CAST(30 + (c_custkey * 37) % 1796 AS INTEGER) AS account_age_days,
         CAST(1 + c_custkey % 50 AS INTEGER) AS total_lifetime_orders,
         c_mktsegment AS preferred_payment
  FROM customer WHERE c_custkey % 11 <> 0
),
products_dim AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_brand AS brand,
         'S' || CAST(p_partkey % 100 AS VARCHAR) AS seller_id, p_size AS stock_quantity,
         CAST(2.5 + (p_partkey % 26) * 0.1 AS DOUBLE) AS avg_rating,
         CAST(p_partkey % 5001 AS INTEGER) AS num_reviews
  FROM part WHERE p_partkey % 13 <> 0
)"""


def with_fact(body: str, *extra_ctes: str, dims: bool = False) -> str:
    ctes = [FACT] + ([DIMS] if dims else []) + list(extra_ctes)
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


VALIDATED_ORDERS = with_fact("""
SELECT order_id, customer_id, order_date, delivery_date, product_id, product_type, category, quantity,
       CAST(total_amount AS DOUBLE) AS total_amount, discount_percent,
       CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(grand_total AS DOUBLE) AS grand_total,
       payment_method, region, city, customer_segment, order_status, rating, is_prime_member
FROM clean""")

REVENUE_ANALYSIS = with_fact(f"""
SELECT region, category, payment_method,
       CAST(SUM(grand_total) AS DOUBLE) AS total_revenue,
       COUNT(order_id) AS order_count,
       CAST(SUM(grand_total) AS DOUBLE) / COUNT(grand_total) AS avg_order_value,
       CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       CAST(SUM(discount_percent) AS DOUBLE) / COUNT(discount_percent) AS avg_discount_pct,
       COUNT(DISTINCT customer_id) AS unique_customers,
       {rr0('SUM(grand_total)', 'COUNT(DISTINCT customer_id)', num_scale=2)} AS revenue_per_customer
FROM delivered GROUP BY region, category, payment_method""")

_GRAIN = "product_id ASC NULLS FIRST, product_type ASC NULLS FIRST, category ASC NULLS FIRST, region ASC NULLS FIRST"

PRODUCT_PERFORMANCE = with_fact(f"""
SELECT product_id, product_type, category, region,
       CAST(rev AS DOUBLE) AS product_revenue, total_sold, unique_buyers,
       rank_in_category, rank_in_region, overall_rank,
       {rr('rev', 'cat_rev', mult=100, num_scale=2, den_scale=2)} AS category_revenue_pct
FROM ranked WHERE rank_in_category <= 5""", f"""
perf AS (
  SELECT product_id, product_type, category, region, SUM(grand_total) AS rev,
         CAST(SUM(quantity) AS BIGINT) AS total_sold, COUNT(DISTINCT customer_id) AS unique_buyers
  FROM delivered GROUP BY product_id, product_type, category, region
),
ranked AS (
  SELECT *,
    CAST(row_number() OVER (PARTITION BY category ORDER BY rev DESC NULLS LAST, {_GRAIN}) AS BIGINT) AS rank_in_category,
    CAST(row_number() OVER (PARTITION BY region ORDER BY rev DESC NULLS LAST, {_GRAIN}) AS BIGINT) AS rank_in_region,
    CAST(row_number() OVER (ORDER BY rev DESC NULLS LAST, {_GRAIN}) AS BIGINT) AS overall_rank,
    SUM(rev) OVER (PARTITION BY category) AS cat_rev
  FROM perf
)""")

_RFM_CTES = """
rfm_base AS (
  SELECT customer_id,
         CAST(datediff('day', MAX(order_date), (SELECT MAX(order_date) FROM delivered)) AS INTEGER) AS recency,
         COUNT(order_id) AS frequency, SUM(grand_total) AS monetary
  FROM delivered GROUP BY customer_id
),
rfm AS (
  SELECT *,
    CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_score,
    CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
         WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
         WHEN r_score >= 4 AND f_score <= 2 THEN 'Promising'
         WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
         WHEN r_score <= 2 AND f_score <= 2 THEN 'Lost'
         ELSE 'Regular' END AS customer_value
  FROM (
    SELECT *,
      CAST(ntile(5) OVER (ORDER BY recency ASC NULLS FIRST, customer_id ASC NULLS FIRST) AS INTEGER) AS r_score,
      CAST(ntile(5) OVER (ORDER BY frequency DESC NULLS LAST, customer_id ASC NULLS FIRST) AS INTEGER) AS f_score,
      CAST(ntile(5) OVER (ORDER BY monetary DESC NULLS LAST, customer_id ASC NULLS FIRST) AS INTEGER) AS m_score
    FROM rfm_base) s
)"""

RFM_ANALYSIS = with_fact("""
SELECT customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary,
       r_score, f_score, m_score, rfm_score, customer_value
FROM rfm""", _RFM_CTES)

CUSTOMER_360 = with_fact(f"""
SELECT customer_id, age, gender, customer_value, account_age_days, total_lifetime_orders, preferred_payment,
       COUNT(order_id) AS total_orders,
       CAST(SUM(grand_total) AS DOUBLE) AS lifetime_value,
       CAST(SUM(grand_total) AS DOUBLE) / COUNT(grand_total) AS avg_order_value,
       COUNT(DISTINCT product_brand) AS brands_purchased,
       CASE WHEN COUNT(rating) > 0 THEN SUM(rating) / COUNT(rating) END AS avg_rating_given,
       CAST(SUM(CASE WHEN discount_percent > 0 THEN 1 ELSE 0 END) AS BIGINT) AS orders_with_discount,
       CAST(SUM(discount_amount) AS DOUBLE) AS total_discounts_availed,
       {rr0('SUM(CASE WHEN discount_percent > 0 THEN 1 ELSE 0 END)', 'COUNT(order_id)', mult=100)} AS discount_affinity,
       {rr0('SUM(grand_total)', 'account_age_days', num_scale=2)} AS daily_value
FROM joined
GROUP BY customer_id, age, gender, customer_value, account_age_days, total_lifetime_orders, preferred_payment""",
    _RFM_CTES, """
joined AS (
  SELECT o.customer_id, o.order_id, o.grand_total, o.discount_percent, o.discount_amount, o.rating,
         c.age, c.gender, c.account_age_days, c.total_lifetime_orders, c.preferred_payment,
         p.brand AS product_brand, r.customer_value
  FROM delivered o
  JOIN customers_dim c ON o.customer_id = c.customer_id
  JOIN products_dim p ON o.product_id = p.product_id
  LEFT JOIN rfm r ON o.customer_id = r.customer_id
)""", dims=True)

DAILY_SALES = with_fact(f"""
SELECT order_date, CAST(rev AS DOUBLE) AS daily_revenue, daily_orders, avg_order_value,
       {rr('SUM(rev) OVER w7', 'COUNT(rev) OVER w7', num_scale=2)} AS revenue_7day_ma,
       {rr('SUM(rev) OVER w30', 'COUNT(rev) OVER w30', num_scale=2)} AS revenue_30day_ma,
       {rr('SUM(daily_orders) OVER w7', 'COUNT(daily_orders) OVER w7')} AS orders_7day_ma,
       CAST(month(order_date) AS INTEGER) AS month,
       CAST(year(order_date) AS INTEGER) AS year,
       CAST(dayofweek(order_date) + 1 AS INTEGER) AS day_of_week
FROM daily
WINDOW w7 AS (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       w30 AS (ORDER BY order_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""", """
daily AS (
  SELECT order_date, SUM(grand_total) AS rev, COUNT(order_id) AS daily_orders,
         CAST(SUM(grand_total) AS DOUBLE) / COUNT(grand_total) AS avg_order_value
  FROM delivered GROUP BY order_date
)""")

# Every day of the calendar, frames of days: a day without sales counts with 0.
DAILY_SALES_CALENDAR = with_fact(f"""
SELECT order_date, CAST(rev AS DOUBLE) AS daily_revenue, daily_orders, avg_order_value,
       {rr('SUM(rev) OVER w7', 'COUNT(rev) OVER w7', num_scale=2)} AS revenue_7day_ma,
       {rr('SUM(rev) OVER w30', 'COUNT(rev) OVER w30', num_scale=2)} AS revenue_30day_ma,
       {rr('SUM(daily_orders) OVER w7', 'COUNT(daily_orders) OVER w7')} AS orders_7day_ma,
       CAST(month(order_date) AS INTEGER) AS month,
       CAST(year(order_date) AS INTEGER) AS year,
       CAST(dayofweek(order_date) + 1 AS INTEGER) AS day_of_week
FROM daily
WINDOW w7 AS (ORDER BY order_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW),
       w30 AS (ORDER BY order_date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)""", """
sales AS (
  SELECT order_date, SUM(grand_total) AS rev, COUNT(order_id) AS daily_orders,
         CAST(SUM(grand_total) AS DOUBLE) / COUNT(grand_total) AS avg_order_value
  FROM delivered GROUP BY order_date
),
days AS (SELECT CAST(unnest(generate_series(MIN(order_date), MAX(order_date), INTERVAL 1 DAY)) AS DATE) AS order_date FROM sales),
daily AS (
  SELECT days.order_date, coalesce(rev, 0) AS rev, coalesce(daily_orders, 0) AS daily_orders, avg_order_value
  FROM days LEFT JOIN sales ON days.order_date = sales.order_date
)""")

_DEFECTS = """
broken AS (
  SELECT order_id, order_status, product_id,
         CASE WHEN k % 29 <> 1 THEN order_date END AS order_date, CASE WHEN k % 29 = 1 THEN '2024-13-45' END AS bad_date,
         CASE WHEN k % 31 <> 2 THEN customer_id END AS customer_id,
         CASE WHEN k % 37 = 3 THEN 0 ELSE quantity END AS quantity,
         CASE WHEN k % 43 = 5 THEN 'NaN'::DOUBLE WHEN k % 41 = 4 THEN -CAST(grand_total AS DOUBLE) - 1
              ELSE CAST(grand_total AS DOUBLE) END AS grand_total
  FROM (SELECT *, CAST(split_part(order_id, '-', 1) AS BIGINT) AS k FROM fact) f
),
judged AS (
  SELECT order_id, order_status, list_filter([
           CASE WHEN order_id IS NULL THEN 'missing order_id' END,
           CASE WHEN customer_id IS NULL THEN 'missing customer_id' END,
           CASE WHEN product_id IS NULL THEN 'missing product_id' END,
           CASE WHEN order_date IS NULL THEN CASE WHEN bad_date IS NULL THEN 'missing order_date' ELSE 'unreadable order_date' END END,
           CASE WHEN grand_total IS NULL THEN 'missing grand_total' END,
           CASE WHEN quantity IS NULL THEN 'missing quantity' END,
           CASE WHEN isnan(grand_total) THEN 'not a number grand_total' END,
           CASE WHEN NOT isnan(grand_total) AND grand_total < 0 THEN 'negative grand_total' END,
           CASE WHEN quantity <= 0 THEN 'not positive quantity' END], lambda r: r IS NOT NULL) AS reasons
  FROM broken
)"""

REJECTED_ORDERS = with_fact(
    "SELECT order_id, array_to_string(reasons, '; ') AS reasons FROM judged WHERE len(reasons) > 0", _DEFECTS)

INPUT_COUNTS = with_fact("""
SELECT COUNT(*) AS orders, COUNT(*) FILTER (WHERE len(reasons) = 0 AND order_status = 'Delivered') AS delivered,
       COUNT(*) FILTER (WHERE len(reasons) > 0) AS rejected,
       (SELECT COUNT(*) FROM customers_dim) AS customers, (SELECT COUNT(*) FROM products_dim) AS products
FROM judged""", _DEFECTS, dims=True)

_MONTHS_BETWEEN = ("((year(order_date) - year(first_date)) * 12 + (month(order_date) - month(first_date))"
                   " + CASE WHEN day(order_date) = day(first_date)"
                   " OR (order_date = last_day(order_date) AND first_date = last_day(first_date)) THEN 0"
                   " ELSE (day(order_date) - day(first_date)) / 31.0 END)")

COHORT_RETENTION = with_fact(f"""
SELECT CAST(year(first_date) AS VARCHAR) || '-' || lpad(CAST(month(first_date) AS VARCHAR), 2, '0') AS cohort_month,
       CAST(round({_MONTHS_BETWEEN}, 0) AS INTEGER) AS months_since_first,
       COUNT(DISTINCT customer_id) AS active_customers
FROM (SELECT d.customer_id, d.order_date, f.first_date
      FROM delivered d
      JOIN (SELECT customer_id, MIN(order_date) AS first_date FROM delivered GROUP BY customer_id) f
        ON d.customer_id = f.customer_id) t
GROUP BY 1, 2""")

_CENTS = "CAST(grand_total * 100 AS HUGEINT)"
_VAR_NUM = f"(COUNT(grand_total) * SUM({_CENTS} * {_CENTS}) - SUM({_CENTS}) * SUM({_CENTS}))"
_STDDEV = (f"(CASE WHEN COUNT(grand_total) > 1 THEN sqrt(CAST(CAST({_VAR_NUM} AS VARCHAR) || 'e-4' AS DOUBLE)"
           f" / CAST(COUNT(grand_total) * (COUNT(grand_total) - 1) AS DOUBLE)) END)")

STATISTICAL_PROFILE = with_fact(f"""
SELECT category, region, order_count, total_revenue, mean_order_value, stddev_order_value,
       min_order_value, q1_order_value, median_order_value, q3_order_value, max_order_value,
       avg_rating, prime_orders, non_prime_orders,
       {rr0('prime_orders', 'order_count', mult=100)} AS prime_order_pct,
       CASE WHEN mean_order_value IS NOT NULL AND mean_order_value > 0
            THEN round(stddev_order_value / mean_order_value * 100, 2) END AS cv_order_value
FROM (
  SELECT category, region,
         COUNT(order_id) AS order_count,
         CAST(SUM(grand_total) AS DOUBLE) AS total_revenue,
         CAST(SUM(grand_total) AS DOUBLE) / COUNT(grand_total) AS mean_order_value,
         {_STDDEV} AS stddev_order_value,
         CAST(MIN(grand_total) AS DOUBLE) AS min_order_value,
         CAST(quantile_disc(grand_total, 0.25) AS DOUBLE) AS q1_order_value,
         CAST(quantile_disc(grand_total, 0.5) AS DOUBLE) AS median_order_value,
         CAST(quantile_disc(grand_total, 0.75) AS DOUBLE) AS q3_order_value,
         CAST(MAX(grand_total) AS DOUBLE) AS max_order_value,
         CASE WHEN COUNT(rating) > 0 THEN SUM(rating) / COUNT(rating) END AS avg_rating,
         CAST(count_if(is_prime_member = true) AS BIGINT) AS prime_orders,
         CAST(count_if(is_prime_member = false) AS BIGINT) AS non_prime_orders
  FROM delivered GROUP BY category, region
) g""")

REPORT_SQL = {
    "validated_orders": VALIDATED_ORDERS,
    "revenue_analysis": REVENUE_ANALYSIS,
    "product_performance": PRODUCT_PERFORMANCE,
    "rfm_analysis": RFM_ANALYSIS,
    "customer_360": CUSTOMER_360,
    "daily_sales_moving_avg": DAILY_SALES,
    "daily_sales_calendar": DAILY_SALES_CALENDAR,
    "rejected_orders": REJECTED_ORDERS,
    "input_counts": INPUT_COUNTS,
    "cohort_retention": COHORT_RETENTION,
    "statistical_profile": STATISTICAL_PROFILE,
}


# ------------------------------------------------------------------ diffs
RUN_TS = "1970-01-01T00:00:00"
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]

ORDERS_PAIR = """
control AS (SELECT * FROM orders),
kept AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 97 = 0 THEN o_totalprice + CAST(0.01 AS DOUBLE) ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 101 <> 0
),
target AS (SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE o_orderkey % 103 = 0)"""

CUSTOMER_PAIR = """
control AS (SELECT * FROM customer),
target AS (SELECT * FROM customer WHERE c_custkey % 89 <> 0)"""


def _rounded(rel: str, cols: list[str], fractional: set[str], precision: int) -> str:
    sel = ", ".join(
        f"CAST(CAST(CAST({c} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,{precision})) AS {c}" if c in fractional else c
        for c in cols)
    return f"SELECT {sel} FROM {rel}"


def _stringified(rel: str, cols: list[str]) -> str:
    return f"SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in cols)} FROM {rel}"


def diff_record(table_name: str, pair_ctes: str, tolerance: float, control: str = "control",
                target: str = "target", prefix: str = "") -> str:
    """The per-table result record, computed the way the contract describes it:
    two EXCEPTs, and when the counts differ the EXCEPT of the grouped counts."""
    p = prefix
    return f"""
{p}cc AS (SELECT COUNT(*) AS n FROM {control}),
{p}tc AS (SELECT COUNT(*) AS n FROM {target}),
{p}miss AS (SELECT COUNT(*) AS n FROM (SELECT * FROM {control} EXCEPT SELECT * FROM {target})),
{p}new AS (SELECT COUNT(*) AS n FROM (SELECT * FROM {target} EXCEPT SELECT * FROM {control})),
{p}gc AS (SELECT *, COUNT(*) AS __n FROM {control} GROUP BY ALL),
{p}gt AS (SELECT *, COUNT(*) AS __n FROM {target} GROUP BY ALL),
{p}gmiss AS (SELECT COUNT(*) AS n FROM (SELECT * FROM {p}gc EXCEPT SELECT * FROM {p}gt)),
{p}gnew AS (SELECT COUNT(*) AS n FROM (SELECT * FROM {p}gt EXCEPT SELECT * FROM {p}gc)),
{p}dc AS (SELECT COUNT(*) AS n FROM {p}gc),
{p}rec AS (
  SELECT '{table_name}' AS table_name, cc.n AS control_count, tc.n AS target_count,
         miss.n AS missing_rows_count, new.n AS new_rows_count,
         miss.n + new.n AS total_differences,
         CAST({tolerance!r} AS DOUBLE) AS tolerance,
         CAST({tolerance!r} AS DOUBLE) * cc.n AS tolerance_threshold,
         (CAST(miss.n + new.n AS DOUBLE) <= CAST({tolerance!r} AS DOUBLE) * cc.n)
           AND (cc.n = tc.n OR CAST(gmiss.n + gnew.n AS DOUBLE) <= CAST({tolerance!r} AS DOUBLE) * dc.n) AS passed,
         '{RUN_TS}' AS timestamp,
         CASE WHEN cc.n <> tc.n THEN true END AS grouped_comparison,
         CASE WHEN cc.n <> tc.n THEN gmiss.n + gnew.n END AS grouped_differences,
         CAST(NULL AS VARCHAR) AS grouped_comparison_error
  FROM {p}cc cc, {p}tc tc, {p}miss miss, {p}new new, {p}gmiss gmiss, {p}gnew gnew, {p}dc dc
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


DIFF_TOLERANCE = 0.05
ROUND_PRECISION = 1

DIFF_MISSING = _with(ORDERS_PAIR) + "SELECT * FROM control EXCEPT SELECT * FROM target"
DIFF_NEW = _with(ORDERS_PAIR) + "SELECT * FROM target EXCEPT SELECT * FROM control"
_ON = " AND ".join(f"c.{c} IS NOT DISTINCT FROM t.{c}" for c in ORDERS_COLS)
DIFF_MULTIPLICITY = _with(
    ORDERS_PAIR,
    f"c AS (SELECT {', '.join(ORDERS_COLS)}, COUNT(*) AS control_n FROM control GROUP BY ALL)",
    f"t AS (SELECT {', '.join(ORDERS_COLS)}, COUNT(*) AS target_n FROM target GROUP BY ALL)",
) + f"SELECT c.*, t.target_n FROM c JOIN t ON {_ON} WHERE c.control_n <> t.target_n"

DIFF_RESULT = _with(ORDERS_PAIR, diff_record("orders", "", DIFF_TOLERANCE)) + "SELECT * FROM rec"

DIFF_BY_DIGESTS = _with("""
control AS (SELECT * FROM orders),
kept AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 1999 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 4001 <> 5
),
target AS (SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE o_orderkey % 6007 = 11)""",
                        diff_record("orders", "", DIFF_TOLERANCE)) + "SELECT * FROM rec"

DIFF_ROUNDED = _with(
    ORDERS_PAIR,
    f"rc AS ({_rounded('control', ORDERS_COLS, {'o_totalprice'}, ROUND_PRECISION)})",
    f"rt AS ({_rounded('target', ORDERS_COLS, {'o_totalprice'}, ROUND_PRECISION)})",
    diff_record("orders", "", DIFF_TOLERANCE, "rc", "rt"),
) + "SELECT * FROM rec"

DIFF_STRINGIFIED = _with(
    ORDERS_PAIR,
    f"sc AS ({_stringified('control', ORDERS_COLS)})",
    f"st AS ({_stringified('target', ORDERS_COLS)})",
    diff_record("orders", "", DIFF_TOLERANCE, "sc", "st"),
) + "SELECT * FROM rec"

# Catalog mode over two view pairs (D2): orders and customer.
_MULTI_CTES = [
    ORDERS_PAIR.replace("control AS", "o_control AS").replace("target AS", "o_target AS")
               .replace("FROM kept", "FROM o_kept").replace("kept AS", "o_kept AS"),
    diff_record("orders_control", "", DIFF_TOLERANCE, "o_control", "o_target", prefix="o_"),
    CUSTOMER_PAIR.replace("control AS", "c_control AS").replace("target AS", "c_target AS"),
    diff_record("customer_control", "", DIFF_TOLERANCE, "c_control", "c_target", prefix="c_"),
]
DIFF_MULTI_TABLE = _with(*_MULTI_CTES) + "SELECT * FROM o_rec UNION ALL SELECT * FROM c_rec"

DIFF_SUMMARY = _with(*_MULTI_CTES, "res AS (SELECT * FROM o_rec UNION ALL SELECT * FROM c_rec)") + f"""
SELECT '{RUN_TS}' AS comparison_timestamp, COUNT(*) AS total_tables,
       CAST(count_if(passed) AS BIGINT) AS passed_tables, CAST(count_if(NOT passed) AS BIGINT) AS failed_tables,
       'N/A' AS control_root, CAST({DIFF_TOLERANCE!r} AS DOUBLE) AS tolerance,
       CAST(to_json(list(res ORDER BY table_name)) AS VARCHAR) AS results
FROM res"""

# Directory mode (D3) over the driver's tables; the target folder is made from them (sources.testdata.directory_target).
DIRECTORY_TABLES = ("region", "nation", "supplier", "customer", "part", "orders", "lineitem")
_FIRST_COLUMNS = ("r_regionkey", "n_nationkey", "s_suppkey", "c_custkey", "p_partkey", "o_orderkey", "l_orderkey")
DIFF_DIRECTORIES = _with(*[
    f"{t}_target AS (SELECT * FROM {t} WHERE {k} % 89 <> 3 UNION ALL SELECT * FROM {t} WHERE {k} % 89 <> 3 AND {k} % 97 = 1),"
    + diff_record(f"{t}.parquet", "", DIFF_TOLERANCE, t, f"{t}_target", prefix=f"{t}_")
    for t, k in zip(DIRECTORY_TABLES, _FIRST_COLUMNS)
]) + " UNION ALL ".join(f"SELECT * FROM {t}_rec" for t in DIRECTORY_TABLES)

# ------------------------------------------------------------- snapshots
RESTATED_BASE = 10_000
_HISTORY = f"""
years AS (SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS y FROM orders),
lineage AS (
  SELECT 'orders' AS table_name, y AS snapshot_id, lag(y) OVER (ORDER BY y) AS parent_id FROM years
  UNION ALL
  SELECT 'orders', y + {RESTATED_BASE}, y FROM years
),
anc AS (
  SELECT table_name, snapshot_id, snapshot_id AS ancestor_id, CAST(0 AS INTEGER) AS depth FROM lineage
  UNION ALL
  SELECT a.table_name, a.snapshot_id, l.parent_id, CAST(a.depth + 1 AS INTEGER)
  FROM anc a JOIN lineage l ON a.table_name = l.table_name AND a.ancestor_id = l.snapshot_id
  WHERE l.parent_id IS NOT NULL
),
ids AS (SELECT MAX(y) AS ctrl, MAX(y) - 1 + {RESTATED_BASE} AS tgt FROM years),
shared AS (
  SELECT c.ancestor_id, c.depth AS control_depth, t.depth AS target_depth
  FROM anc c JOIN anc t ON c.ancestor_id = t.ancestor_id, ids
  WHERE c.snapshot_id = ids.ctrl AND t.snapshot_id = ids.tgt
),
best AS (SELECT * FROM shared ORDER BY target_depth LIMIT 1),
snap_base AS (SELECT o.* FROM orders o, best, years
              WHERE year(o.o_orderdate) <= best.ancestor_id AND years.y = best.ancestor_id),
snap_ctrl AS (SELECT o.* FROM orders o, ids WHERE year(o.o_orderdate) <= ids.ctrl),
snap_tgt AS (SELECT o.* FROM orders o, ids
             WHERE year(o.o_orderdate) <= ids.tgt - {RESTATED_BASE} AND o.o_orderstatus <> 'P'),
ch_ctrl AS (
  SELECT *, 'INSERT' AS _change_type FROM (SELECT * FROM snap_ctrl EXCEPT ALL SELECT * FROM snap_base)
  UNION ALL
  SELECT *, 'DELETE' AS _change_type FROM (SELECT * FROM snap_base EXCEPT ALL SELECT * FROM snap_ctrl)
),
ch_tgt AS (
  SELECT *, 'INSERT' AS _change_type FROM (SELECT * FROM snap_tgt EXCEPT ALL SELECT * FROM snap_base)
  UNION ALL
  SELECT *, 'DELETE' AS _change_type FROM (SELECT * FROM snap_base EXCEPT ALL SELECT * FROM snap_tgt)
)"""

SNAPSHOT_ANCESTORS = "WITH RECURSIVE " + _HISTORY.strip() + "\nSELECT table_name, snapshot_id, ancestor_id, depth FROM anc"
COMMON_ANCESTOR = "WITH RECURSIVE " + _HISTORY.strip() + """
SELECT 'orders' AS table_name, ids.ctrl AS control_snapshot, ids.tgt AS target_snapshot,
       best.ancestor_id, best.control_depth, best.target_depth
FROM best, ids"""
CHANGELOG = "WITH RECURSIVE " + _HISTORY.strip() + "\nSELECT * FROM ch_ctrl"
CDC_DIFF = ("WITH RECURSIVE " + _HISTORY.strip() + ",\n"
            + diff_record("orders", "", DIFF_TOLERANCE, "ch_ctrl", "ch_tgt").strip()
            + "\nSELECT * FROM rec")

DIFF_SQL = {
    "diff_missing": DIFF_MISSING,
    "diff_new": DIFF_NEW,
    "diff_multiplicity": DIFF_MULTIPLICITY,
    "diff_result": DIFF_RESULT,
    "diff_by_digests": DIFF_BY_DIGESTS,
    "diff_rounded": DIFF_ROUNDED,
    "diff_stringified": DIFF_STRINGIFIED,
    "diff_multi_table": DIFF_MULTI_TABLE,
    "diff_summary": DIFF_SUMMARY,
    "diff_directories": DIFF_DIRECTORIES,
    "snapshot_ancestors": SNAPSHOT_ANCESTORS,
    "common_ancestor": COMMON_ANCESTOR,
    "changelog": CHANGELOG,
    "cdc_diff": CDC_DIFF,
}
