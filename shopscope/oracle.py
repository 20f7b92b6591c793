"""Independent SQL definitions (DuckDB dialect) of every registered query.

They restate the workflow in plain SQL over the driver's tables - rounding,
segment rules, test statistics and p-values too - and are the correctness
oracle. Nothing here comes from the operators or functions they check; only
the raw view's SQL text is the one that ``sources.raw_view`` publishes. ``BASE`` holds the shared CTEs: the raw view,
the cleaning rules, the star schema and the segment table.
"""

from __future__ import annotations

from shopscope.sources.raw_view import RAW_SALES_SQL


def R(num: str, den: str, places: int, *, num_scale: int = 0, den_scale: int = 0, mult: int = 1, half_even: bool = False) -> str:
    """num * mult / den to ``places`` places by whole division and remainder; NULL over 0. Halves go
    away from zero, or to the even neighbour."""
    n = f"(CAST(({num}) * {10 ** num_scale} AS HUGEINT) * {mult} * {10 ** places} * {10 ** den_scale})"
    d = f"(CAST(({den}) * {10 ** den_scale} AS HUGEINT) * {10 ** num_scale})"
    whole, twice = f"(abs({n}) // abs({d}))", f"(2 * (abs({n}) % abs({d})))"
    tie = f"{whole} % 2 = 1" if half_even else "true"
    up = f"CASE WHEN {twice} > abs({d}) OR ({twice} = abs({d}) AND {tie}) THEN 1 ELSE 0 END"
    value = f"CAST(sign({n}) * sign({d}) * ({whole} + {up}) AS DECIMAL({37 - places},0))"
    unit = f" * CAST('{10 ** -places:.{places}f}' AS DECIMAL({places + 1},{places}))" if places else ""
    return f"CAST(CASE WHEN {d} <> 0 THEN {value}{unit} END AS DECIMAL(38,{places}))"


def SD(n: str, s: str, q: str) -> str:
    """Sample standard deviation from count, sum and sum of squares, 6 places."""
    n, s, q = (f"CAST({x} AS DOUBLE)" for x in (n, s, q))
    return f"CAST(CASE WHEN {n} > 1 THEN sqrt(greatest(({q} - {s} * {s} / {n}) / ({n} - 1.0::DOUBLE), 0)) END AS DECIMAL(38,6))"


def T(n1: str, s1: str, q1: str, n2: str, s2: str, q2: str) -> str:
    """Student's t from both groups' counts, sums and sums of squares: the difference of the means
    over the pooled standard error, 6 places."""
    n1, s1, q1, n2, s2, q2 = (f"CAST({x} AS DOUBLE)" for x in (n1, s1, q1, n2, s2, q2))
    within = f"(({q1} - {s1} * {s1} / {n1}) + ({q2} - {s2} * {s2} / {n2}))"
    error = f"sqrt({within} / ({n1} + {n2} - 2) * ({n1} + {n2}) / ({n1} * {n2}))"
    return f"CAST(({s1} / {n1} - {s2} / {n2}) / {error} AS DECIMAL(38,6))"


SEGMENT_SQL = """CASE
    WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champion'
    WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 4 THEN 'Loyal Customer'
    WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customer'
    WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Potential Loyalist'
    WHEN r_score <= 2 AND f_score >= 4 AND m_score >= 4 THEN 'At Risk'
    WHEN r_score <= 2 AND f_score >= 3 AND m_score >= 3 THEN 'Needs Attention'
    WHEN r_score = 1 AND f_score <= 2 AND m_score <= 2 THEN 'Lost'
    WHEN r_score + f_score + m_score >= 9 THEN 'Promising'
    WHEN r_score + f_score + m_score >= 6 THEN 'About to Sleep'
    ELSE 'Hibernating' END"""

FIRST_ORDER_SQL = ("invoice_ts, invoice, stock_code, quantity, price, "
                   "country NULLS FIRST, description NULLS FIRST")
SALE_ORDER_SQL = ("invoice_ts, invoice, stock_code, quantity, price, customer_id, "
                  "country NULLS FIRST, description NULLS FIRST")

STEP_SQL = """CASE WHEN coalesce(starts_with(invoice, 'C'), false) THEN 2
       WHEN coalesce(quantity < 0, false) THEN 3
       WHEN NOT coalesce(price > 0, false) THEN 4
       WHEN customer_id IS NULL THEN 5
       WHEN NOT coalesce(CAST(quantity * price AS DECIMAL(18,4)) >= 0.01, false) THEN 6
       ELSE 7 END"""

BASE = RAW_SALES_SQL + f""",
dedup AS (SELECT DISTINCT * FROM raw_sales),
stepped AS (SELECT *, {STEP_SQL} AS step_no FROM dedup),
clean_sales AS (
  SELECT invoice, stock_code, description, quantity, invoice_ts, price, customer_id, country,
         CAST(quantity * price AS DECIMAL(18,4)) AS revenue
  FROM stepped WHERE step_no = 7
),
fact_sales AS (
  SELECT row_number() OVER (ORDER BY {SALE_ORDER_SQL}) AS sale_id,
         invoice, customer_id, stock_code, CAST(invoice_ts AS DATE) AS date_id, quantity,
         CAST(price AS DECIMAL(10,2)) AS price, CAST(revenue AS DECIMAL(12,2)) AS revenue
  FROM clean_sales
),
dim_customer AS (
  SELECT customer_id, country FROM (
    SELECT customer_id, country,
           row_number() OVER (PARTITION BY customer_id ORDER BY {FIRST_ORDER_SQL}) AS rn
    FROM clean_sales) WHERE rn = 1
),
dim_product AS (
  SELECT stock_code, description FROM (
    SELECT stock_code, description,
           row_number() OVER (PARTITION BY stock_code ORDER BY {FIRST_ORDER_SQL}) AS rn
    FROM clean_sales) WHERE rn = 1
),
dim_date AS (
  SELECT date_id, CAST(year(date_id) AS INTEGER) AS year, CAST(month(date_id) AS INTEGER) AS month,
         CAST(day(date_id) AS INTEGER) AS day, CAST(quarter(date_id) AS INTEGER) AS quarter,
         strftime(date_id, '%B') AS month_name,
         CAST(CASE WHEN month(date_id) IN (10, 11, 12) THEN 1 ELSE 0 END AS INTEGER) AS is_q4
  FROM (SELECT DISTINCT CAST(invoice_ts AS DATE) AS date_id FROM clean_sales)
),
rfm_orders AS (
  SELECT customer_id, invoice, sum(revenue) AS rev, max(invoice_ts) AS last_ts
  FROM clean_sales GROUP BY customer_id, invoice
),
rfm_base AS (
  SELECT customer_id,
         CAST(date_sub('day', max(last_ts), (SELECT max(invoice_ts) + INTERVAL 1 DAY FROM clean_sales)) AS INTEGER) AS recency,
         count(*) AS frequency,
         CAST(sum(rev) AS DECIMAL(18,2)) AS monetary
  FROM rfm_orders GROUP BY customer_id
),
rfm_edges AS (
  SELECT quantile_cont(CAST(recency AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS re,
         quantile_cont(CAST(monetary AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS me,
         count(*) AS n
  FROM rfm_base
),
rfm_scored AS (
  SELECT b.customer_id, b.recency, b.frequency, b.monetary,
         CAST(5 - ((e.re[1] < b.recency)::INT + (e.re[2] < b.recency)::INT
                 + (e.re[3] < b.recency)::INT + (e.re[4] < b.recency)::INT) AS INTEGER) AS r_score,
         CAST(CASE WHEN e.n <= 1 THEN 1 ELSE greatest(1,
              ((row_number() OVER (ORDER BY b.frequency, b.customer_id) - 1) * 5 + e.n - 2) // (e.n - 1)) END
              AS INTEGER) AS f_score,
         CAST(1 + ((e.me[1] < CAST(b.monetary AS DOUBLE))::INT + (e.me[2] < CAST(b.monetary AS DOUBLE))::INT
                 + (e.me[3] < CAST(b.monetary AS DOUBLE))::INT + (e.me[4] < CAST(b.monetary AS DOUBLE))::INT)
              AS INTEGER) AS m_score
  FROM rfm_base b CROSS JOIN rfm_edges e
),
rfm_segments AS (
  SELECT customer_id, recency, frequency, monetary, r_score, f_score, m_score,
         CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_score,
         CAST(r_score + f_score + m_score AS INTEGER) AS rfm_total,
         {SEGMENT_SQL} AS segment
  FROM rfm_scored
),
monthly AS (
  SELECT strftime(date_id, '%Y-%m') AS revenue_month, sum(revenue) AS rev,
         count(DISTINCT invoice) AS total_orders, count(DISTINCT customer_id) AS unique_customers
  FROM fact_sales GROUP BY 1
),
monthly_r AS (SELECT *, CAST(round(rev, 2) AS DECIMAL(38,2)) AS monthly_revenue FROM monthly),
customer_cohort AS (
  SELECT customer_id, min(year(date_id) * 12 + month(date_id) - 1) AS cohort_mo
  FROM fact_sales GROUP BY customer_id
),
customer_activity AS (
  SELECT DISTINCT customer_id, year(date_id) * 12 + month(date_id) - 1 AS activity_mo FROM fact_sales
),
month1 AS (
  SELECT strftime(make_date(CAST(c.cohort_mo // 12 AS BIGINT), CAST(c.cohort_mo % 12 + 1 AS BIGINT), 1), '%Y-%m') AS cohort_month,
         count(*) AS cohort_size,
         count(a.customer_id) AS returned_month1
  FROM customer_cohort c
  LEFT JOIN customer_activity a ON a.customer_id = c.customer_id AND a.activity_mo = c.cohort_mo + 1
  GROUP BY c.cohort_mo
)"""


def q(body: str) -> str:
    return f"WITH {BASE}\n{body}"


def M(expr: str, scale: int = 2) -> str:
    return f"CAST(round({expr}, {scale}) AS DECIMAL(38,{scale}))"


ORACLE: dict[str, str] = {}

# ------------------------------------------------------------- reports
ORACLE["rfm_top_customers"] = q("""SELECT customer_id, recency, frequency, monetary, r_score, f_score,
  m_score, rfm_score, rfm_total, segment FROM rfm_segments ORDER BY monetary DESC, customer_id LIMIT 20""")

ORACLE["segment_scorecard"] = q(f"""SELECT segment, count(customer_id) AS customer_count,
  {R('count(customer_id)', '(SELECT count(*) FROM rfm_segments)', 2, mult=100)} AS customer_pct,
  {M('sum(monetary)')} AS total_revenue,
  {R('sum(monetary)', 'count(customer_id)', 2, num_scale=2)} AS avg_revenue,
  {R('sum(recency)', 'count(customer_id)', 1)} AS avg_recency_days,
  {R('sum(frequency)', 'count(customer_id)', 1)} AS avg_frequency
FROM rfm_segments GROUP BY segment""")


def _detail(seg: str, rec: str, freq: str) -> str:
    return q(f"""SELECT r.customer_id, c.country, r.recency AS {rec}, r.frequency AS {freq},
  {M('r.monetary')} AS total_spent, r.rfm_score
FROM rfm_segments r JOIN dim_customer c ON r.customer_id = c.customer_id
WHERE r.segment = '{seg}' ORDER BY r.monetary DESC, r.customer_id LIMIT 20""")


ORACLE["champion_detail"] = _detail("Champion", "recency", "frequency")
ORACLE["at_risk_recovery_list"] = _detail("At Risk", "days_since_last_purchase", "total_orders")

ORACLE["segment_pareto"] = q(f"""SELECT segment, count(customer_id) AS customer_count,
  {M('sum(monetary)')} AS total_revenue,
  {R('sum(monetary)', '(SELECT sum(monetary) FROM rfm_segments)', 2, num_scale=2, den_scale=2, mult=100)} AS revenue_pct,
  {M('sum(sum(monetary)) OVER (ORDER BY sum(monetary) DESC)')} AS cumulative_revenue
FROM rfm_segments GROUP BY segment""")

ORACLE["at_risk_product_affinity"] = q(f"""SELECT p.description, f.stock_code,
  count(DISTINCT f.customer_id) AS at_risk_customers, count(DISTINCT f.invoice) AS total_orders,
  CAST(sum(f.quantity) AS BIGINT) AS total_units, {M('sum(f.revenue)')} AS total_revenue,
  {R('sum(f.price)', 'count(*)', 2, num_scale=2)} AS avg_price
FROM fact_sales f JOIN dim_product p ON f.stock_code = p.stock_code
JOIN rfm_segments r ON f.customer_id = r.customer_id
WHERE r.segment = 'At Risk'
GROUP BY f.stock_code, p.description ORDER BY sum(f.revenue) DESC, f.stock_code LIMIT 15""")

ORACLE["monthly_revenue_trend"] = q(f"""SELECT revenue_month, total_orders, unique_customers,
  {M('rev')} AS total_revenue, {R('rev', 'total_orders', 2, num_scale=2)} AS avg_order_value
FROM monthly""")

ORACLE["country_revenue_top10"] = q(f"""SELECT c.country, count(DISTINCT f.invoice) AS total_orders,
  count(DISTINCT f.customer_id) AS unique_customers, {M('sum(f.revenue)')} AS total_revenue,
  {R('sum(f.revenue)', '(SELECT sum(revenue) FROM fact_sales)', 2, num_scale=2, den_scale=2, mult=100)} AS revenue_pct,
  {R('sum(f.revenue)', 'count(DISTINCT f.customer_id)', 2, num_scale=2)} AS revenue_per_customer
FROM fact_sales f JOIN dim_customer c ON f.customer_id = c.customer_id
GROUP BY c.country ORDER BY sum(f.revenue) DESC, c.country LIMIT 10""")

ORACLE["rolling_3m_revenue"] = q(f"""SELECT revenue_month, monthly_revenue,
  {R('sum(monthly_revenue) OVER w3', 'count(monthly_revenue) OVER w3', 2, num_scale=2)} AS rolling_3month_avg,
  {M('monthly_revenue - lag(monthly_revenue) OVER w')} AS month_over_month_change,
  {R('monthly_revenue - lag(monthly_revenue) OVER w', 'lag(monthly_revenue) OVER w', 2, num_scale=2, den_scale=2, mult=100)} AS mom_growth_pct
FROM monthly_r
WINDOW w AS (ORDER BY revenue_month), w3 AS (ORDER BY revenue_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")

ORACLE["q4_vs_nonq4"] = q(f"""SELECT d.is_q4,
  CASE WHEN d.is_q4 = 1 THEN 'Q4 (Oct-Dec)' ELSE 'Non-Q4 (Jan-Sep)' END AS period,
  count(DISTINCT f.invoice) AS total_orders, {M('sum(f.revenue)')} AS total_revenue,
  {R('sum(f.revenue)', 'count(DISTINCT f.invoice)', 2, num_scale=2)} AS avg_order_value
FROM fact_sales f JOIN dim_date d ON f.date_id = d.date_id GROUP BY d.is_q4""")

ORACLE["top_products"] = q(f"""SELECT f.stock_code, p.description, count(DISTINCT f.invoice) AS total_orders,
  CAST(sum(f.quantity) AS BIGINT) AS total_units_sold, {M('sum(f.revenue)')} AS total_revenue,
  {R('sum(f.revenue)', '(SELECT sum(revenue) FROM fact_sales)', 2, num_scale=2, den_scale=2, mult=100)} AS revenue_pct,
  {R('sum(f.price)', 'count(*)', 2, num_scale=2)} AS avg_price
FROM fact_sales f JOIN dim_product p ON f.stock_code = p.stock_code
GROUP BY f.stock_code, p.description ORDER BY sum(f.revenue) DESC, f.stock_code LIMIT 10""")

ORACLE["cohort_sizes"] = q("""SELECT cohort_month, count(customer_id) AS cohort_size FROM (
  SELECT customer_id, strftime(min(date_id), '%Y-%m') AS cohort_month FROM fact_sales GROUP BY customer_id)
GROUP BY cohort_month""")

ORACLE["cohort_retention_long"] = q("""SELECT
  strftime(make_date(CAST(c.cohort_mo // 12 AS BIGINT), CAST(c.cohort_mo % 12 + 1 AS BIGINT), 1), '%Y-%m') AS cohort_month,
  CAST(a.activity_mo - c.cohort_mo AS BIGINT) AS cohort_index,
  count(DISTINCT a.customer_id) AS active_customers
FROM customer_cohort c JOIN customer_activity a ON c.customer_id = a.customer_id
WHERE a.activity_mo - c.cohort_mo BETWEEN 0 AND 12
GROUP BY c.cohort_mo, a.activity_mo""")

ORACLE["month1_retention"] = q(f"""SELECT cohort_month, cohort_size, returned_month1,
  {R('returned_month1', 'cohort_size', 2, mult=100)} AS month1_retention_pct FROM month1""")

ORACLE["month1_retention_ranked"] = q(f"""SELECT cohort_month, cohort_size, returned_month1, retention_pct,
  rank() OVER (ORDER BY retention_pct DESC) AS retention_rank FROM (
  SELECT cohort_month, cohort_size, returned_month1,
    {R('returned_month1', 'cohort_size', 2, mult=100)} AS retention_pct FROM month1)""")

ORACLE["rolling_retention"] = q(f"""SELECT cohort_month, month1_retention_pct,
  {R('sum(month1_retention_pct) OVER w', 'count(month1_retention_pct) OVER w', 2, num_scale=2)} AS rolling_3cohort_avg_pct
FROM (SELECT cohort_month, {R('returned_month1', 'cohort_size', 2, mult=100)} AS month1_retention_pct FROM month1)
WINDOW w AS (ORDER BY cohort_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")

ORACLE["customer_revenue_rank"] = q(f"""SELECT f.customer_id, c.country, {M('sum(f.revenue)')} AS total_revenue,
  count(DISTINCT f.invoice) AS total_orders,
  rank() OVER (ORDER BY sum(f.revenue) DESC) AS revenue_rank,
  {R('sum(f.revenue)', '(SELECT sum(revenue) FROM fact_sales)', 4, num_scale=2, den_scale=2, mult=100)} AS revenue_pct
FROM fact_sales f JOIN dim_customer c ON f.customer_id = c.customer_id
GROUP BY f.customer_id, c.country ORDER BY revenue_rank, f.customer_id LIMIT 20""")

ORACLE["product_dense_rank"] = q(f"""SELECT f.stock_code, p.description, {M('sum(f.revenue)')} AS total_revenue,
  CAST(sum(f.quantity) AS BIGINT) AS total_units,
  dense_rank() OVER (ORDER BY sum(f.revenue) DESC) AS revenue_rank,
  {R('sum(f.revenue)', '(SELECT sum(revenue) FROM fact_sales)', 4, num_scale=2, den_scale=2, mult=100)} AS pct_of_total
FROM fact_sales f JOIN dim_product p ON f.stock_code = p.stock_code
GROUP BY f.stock_code, p.description ORDER BY revenue_rank, f.stock_code LIMIT 20""")

ORACLE["running_total_revenue"] = q(f"""SELECT revenue_month, monthly_revenue,
  {M('sum(monthly_revenue) OVER w')} AS running_total,
  {R('sum(monthly_revenue) OVER w', 'sum(monthly_revenue) OVER ()', 2, num_scale=2, den_scale=2, mult=100)} AS running_pct_of_total
FROM monthly_r WINDOW w AS (ORDER BY revenue_month ROWS UNBOUNDED PRECEDING)""")

ORACLE["customer_percentile"] = q(f"""SELECT customer_id, total_revenue, segment, percentile_rank, decile FROM (
  SELECT customer_id, monetary, {M('monetary')} AS total_revenue, segment,
    {R('(rank() OVER (ORDER BY monetary) - 1)', '(count(*) OVER () - 1)', 2, mult=100)} AS percentile_rank,
    ntile(10) OVER (ORDER BY monetary DESC, customer_id) AS decile
  FROM rfm_segments) ORDER BY monetary DESC, customer_id LIMIT 20""")

ORACLE["revenue_by_decile"] = q(f"""SELECT decile, count(*) AS customers, {M('sum(monetary)')} AS total_revenue FROM (
  SELECT monetary, ntile(10) OVER (ORDER BY monetary DESC, customer_id) AS decile FROM rfm_segments)
GROUP BY decile""")

ORACLE["mom_growth"] = q(f"""SELECT revenue_month, monthly_revenue, total_orders, unique_customers,
  lag(monthly_revenue) OVER w AS prev_month_revenue,
  {M('monthly_revenue - lag(monthly_revenue) OVER w')} AS revenue_change,
  {R('monthly_revenue - lag(monthly_revenue) OVER w', 'lag(monthly_revenue) OVER w', 2, num_scale=2, den_scale=2, mult=100)} AS growth_pct
FROM monthly_r WINDOW w AS (ORDER BY revenue_month)""")

ORACLE["country_contribution"] = q(f"""SELECT c.country, {M('sum(f.revenue)')} AS total_revenue,
  {R('sum(f.revenue)', 'sum(sum(f.revenue)) OVER ()', 2, num_scale=2, den_scale=2, mult=100)} AS pct_contribution,
  {M('sum(sum(f.revenue)) OVER (ORDER BY sum(f.revenue) DESC, c.country ROWS UNBOUNDED PRECEDING)')} AS cumulative_revenue,
  rank() OVER (ORDER BY sum(f.revenue) DESC) AS country_rank
FROM fact_sales f JOIN dim_customer c ON f.customer_id = c.customer_id
GROUP BY c.country ORDER BY sum(f.revenue) DESC, c.country LIMIT 15""")


# ============================================================ operators
def RE(num: str, den: str, places: int, **kw) -> str:
    return R(num, den, places, half_even=True, **kw)


def ME(expr: str, scale: int = 2) -> str:
    return f"CAST(round_even({expr}, {scale}) AS DECIMAL(38,{scale}))"


HOME = "NATION_2"
AUDIT_YEAR = 1998
RAW_COLS = ["invoice", "stock_code", "description", "quantity", "invoice_ts", "price",
            "customer_id", "country"]
CANCEL = "coalesce(starts_with(invoice, 'C'), false)"
SUSPICIOUS = f"(coalesce(quantity < 0, false) AND NOT {CANCEL})"

# ---- audit
ORACLE["dq_null_audit"] = q("\nUNION ALL\n".join(
    f"""SELECT {i} AS position, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count,
  {RE(f'count(*) FILTER (WHERE {c} IS NULL)', 'count(*)', 2, mult=100)} AS null_pct, count(*) AS total_rows
FROM raw_sales""" for i, c in enumerate(RAW_COLS)))

_RULES = [("null_customer", "customer_id IS NULL"), ("cancellation", CANCEL),
          ("negative_quantity", "quantity < 0"), ("non_positive_price", "price <= 0"),
          ("negative_quantity_without_c", SUSPICIOUS), ("null_description", "description IS NULL")]
ORACLE["dq_rule_counts"] = q("\nUNION ALL\n".join(
    [f"""SELECT {i} AS rule_no, '{r}' AS rule, count(*) FILTER (WHERE {c}) AS rows,
  {RE(f'count(*) FILTER (WHERE {c})', 'count(*)', 2, mult=100)} AS pct_of_total FROM raw_sales"""
     for i, (r, c) in enumerate(_RULES)]
    + [f"""SELECT 6 AS rule_no, 'duplicate_rows' AS rule, CAST(count(*) - (SELECT count(*) FROM dedup) AS BIGINT) AS rows,
  {RE('count(*) - (SELECT count(*) FROM dedup)', 'count(*)', 2, mult=100)} AS pct_of_total FROM raw_sales"""]))

ORACLE["dq_duplicates"] = q(f"""SELECT {', '.join(RAW_COLS)}, count(*) AS copies FROM raw_sales
GROUP BY {', '.join(RAW_COLS)} HAVING count(*) > 1""")

ORACLE["dq_prefix_counts"] = q(f"""SELECT substr(invoice, 1, 1) AS invoice_prefix, count(*) AS rows
FROM raw_sales WHERE {SUSPICIOUS} GROUP BY 1""")

ORACLE["dq_date_range"] = q("""SELECT min(invoice_ts) AS earliest, max(invoice_ts) AS latest,
  CAST(date_sub('day', min(invoice_ts), max(invoice_ts)) AS BIGINT) AS span_days FROM raw_sales""")

ORACLE["dq_year_counts"] = q("""SELECT CAST(year(invoice_ts) AS INTEGER) AS year, count(*) AS rows
FROM raw_sales GROUP BY 1""")

ORACLE["dq_month_counts"] = q(f"""SELECT CAST(month(invoice_ts) AS INTEGER) AS month, count(*) AS rows
FROM raw_sales WHERE year(invoice_ts) = {AUDIT_YEAR} GROUP BY 1""")

ORACLE["dq_country_distribution"] = q(f"""SELECT country, count(*) AS rows,
  {RE('count(*)', '(SELECT count(*) FROM raw_sales)', 2, mult=100)} AS pct_of_rows
FROM raw_sales GROUP BY country ORDER BY count(*) DESC, country LIMIT 10""")

ORACLE["dq_country_summary"] = q(f"""SELECT count(DISTINCT country) AS distinct_countries,
  count(*) FILTER (WHERE country = '{HOME}') AS home_rows,
  count(*) - count(*) FILTER (WHERE country = '{HOME}') AS other_rows,
  {RE(f"count(*) FILTER (WHERE country = '{HOME}')", 'count(*)', 2, mult=100)} AS home_pct FROM raw_sales""")

# ---- cleaning
ORACLE["clean_sales"] = q("SELECT * FROM clean_sales")

ORACLE["clean_funnel"] = q(f"""SELECT step_no, step, CAST(rows_after + rows_removed AS BIGINT) AS rows_before,
  rows_removed, rows_after,
  {RE('rows_removed', 'raw_n', 2, mult=100)} AS removed_pct_of_raw,
  {RE('rows_after', 'raw_n', 2, mult=100)} AS retention_pct
FROM (
  SELECT *, CAST(raw_n - sum(rows_removed) OVER (ORDER BY step_no ROWS UNBOUNDED PRECEDING) AS BIGINT) AS rows_after
  FROM (
    SELECT s.step_no, s.step, t.raw_n,
      CAST(CASE WHEN s.step_no = 1 THEN t.raw_n - t.nd WHEN s.step_no = 7 THEN 0 ELSE coalesce(c.c, 0) END AS BIGINT) AS rows_removed
    FROM (VALUES (1, 'duplicate'), (2, 'cancellation'), (3, 'stock_adjustment'), (4, 'non_positive_price'),
                 (5, 'null_customer'), (6, 'near_zero_revenue'), (7, 'kept')) s(step_no, step)
    CROSS JOIN (SELECT (SELECT count(*) FROM raw_sales) AS raw_n, (SELECT count(*) FROM dedup) AS nd) t
    LEFT JOIN (SELECT step_no, count(*) AS c FROM stepped GROUP BY step_no) c ON c.step_no = s.step_no))""")

GUEST = """guest AS (SELECT *, CAST(quantity * price AS DECIMAL(18,4)) AS revenue FROM raw_sales
  WHERE customer_id IS NULL AND quantity > 0 AND price > 0)"""


def qg(body: str) -> str:
    return f"WITH {BASE},\n{GUEST}\n{body}"


ORACLE["guest_summary"] = qg(f"""SELECT count(*) AS guest_rows, {M('coalesce(sum(revenue), 0)')} AS guest_revenue,
  {RE('sum(revenue)', 'count(*)', 2, num_scale=4)} AS mean_line_revenue,
  min(invoice_ts) AS first_ts, max(invoice_ts) AS last_ts FROM guest""")

ORACLE["guest_countries"] = qg("""SELECT country, count(*) AS guest_rows FROM guest GROUP BY country
ORDER BY count(*) DESC, country LIMIT 10""")

ORACLE["revenue_impact"] = qg(f"""SELECT {M('identified')} AS identified_revenue, {M('guest')} AS guest_revenue,
  {M('identified + guest')} AS total_revenue,
  {RE('guest', 'identified + guest', 2, num_scale=4, den_scale=4, mult=100)} AS guest_pct
FROM (SELECT coalesce((SELECT sum(revenue) FROM clean_sales), 0) AS identified,
             coalesce((SELECT sum(revenue) FROM guest), 0) AS guest)""")

IBF = "ibf AS (SELECT *, CAST(quantity * price AS DECIMAL(18,4)) AS revenue FROM stepped WHERE step_no >= 6)"
ORACLE["revenue_stats"] = f"""WITH {BASE},
{IBF}
SELECT min(revenue) AS min_revenue, max(revenue) AS max_revenue, count(*) AS rows,
  CAST(sum(revenue) AS DECIMAL(38,4)) AS total_revenue,
  {R('sum(revenue)', 'count(*)', 2, num_scale=4)} AS mean_revenue,
  count(*) FILTER (WHERE revenue = 0) AS zero_revenue_rows,
  count(*) FILTER (WHERE revenue < 0.01) AS rows_below_0_01,
  count(*) FILTER (WHERE revenue < 0.10) AS rows_below_0_10,
  count(DISTINCT customer_id) FILTER (WHERE revenue >= 0.01) AS customers,
  count(DISTINCT invoice) FILTER (WHERE revenue >= 0.01) AS invoices,
  count(DISTINCT stock_code) FILTER (WHERE revenue >= 0.01) AS products
FROM ibf"""

ORACLE["smallest_revenue_lines"] = f"""WITH {BASE},
{IBF}
SELECT invoice, stock_code, quantity, price, revenue, invoice_ts FROM ibf
ORDER BY revenue, invoice, stock_code, invoice_ts, quantity, price LIMIT 5"""

# ---- RFM
ORACLE["rfm_base"] = q("SELECT customer_id, recency, frequency, monetary FROM rfm_base")
ORACLE["rfm_segments_table"] = q("SELECT * FROM rfm_segments")
ORACLE["segment_distribution"] = q(f"""SELECT segment, count(*) AS customer_count,
  {RE('count(*)', '(SELECT count(*) FROM rfm_segments)', 2, mult=100)} AS customer_pct
FROM rfm_segments GROUP BY segment""")
ORACLE["segment_revenue"] = q(f"""SELECT segment, count(*) AS customer_count, {ME('sum(monetary)')} AS total_revenue,
  {RE('sum(monetary)', 'count(*)', 2, num_scale=2)} AS avg_revenue,
  {RE('sum(recency)', 'count(*)', 2)} AS avg_recency,
  {RE('sum(frequency)', 'count(*)', 2)} AS avg_frequency,
  {RE('sum(monetary)', '(SELECT sum(monetary) FROM rfm_segments)', 2, num_scale=2, den_scale=2, mult=100)} AS revenue_pct
FROM rfm_segments GROUP BY segment""")
ORACLE["rfm_scatter_points"] = q("""SELECT customer_id, recency, monetary, segment,
  CAST(frequency * 3 AS BIGINT) AS marker_size FROM rfm_segments""")

# ---- cohorts (clean lines)
COH = """cl_mo AS (SELECT *, year(invoice_ts) * 12 + month(invoice_ts) - 1 AS mo FROM clean_sales),
cust_months AS (SELECT DISTINCT customer_id, mo FROM cl_mo),
cust_first AS (SELECT customer_id, min(mo) AS cmo FROM cust_months GROUP BY customer_id),
coh_counts AS (SELECT f.cmo, CAST(m.mo - f.cmo AS INTEGER) AS cohort_index, count(*) AS customers
  FROM cust_months m JOIN cust_first f ON m.customer_id = f.customer_id GROUP BY f.cmo, m.mo - f.cmo),
coh_matrix AS (
  SELECT strftime(make_date(CAST(c.cmo // 12 AS BIGINT), CAST(c.cmo % 12 + 1 AS BIGINT), 1), '%Y-%m') AS cohort_month,
         c.cohort_index, c.customers, s.customers AS cohort_size,
         """ + RE("c.customers", "s.customers", 3) + """ AS retention_rate
  FROM coh_counts c JOIN coh_counts s ON s.cmo = c.cmo AND s.cohort_index = 0)"""


def qc(body: str) -> str:
    return f"WITH {BASE},\n{COH}\n{body}"


LABEL = "strftime(make_date(CAST({o} // 12 AS BIGINT), CAST({o} % 12 + 1 AS BIGINT), 1), '%Y-%m')"
ORACLE["cohort_assign"] = qc(f"""SELECT l.invoice, l.stock_code, l.customer_id, l.invoice_ts,
  {LABEL.format(o='l.mo')} AS invoice_month, {LABEL.format(o='f.cmo')} AS cohort_month,
  CAST(l.mo - f.cmo AS INTEGER) AS cohort_index
FROM cl_mo l JOIN cust_first f ON l.customer_id = f.customer_id""")
ORACLE["cohort_counts"] = qc(f"""SELECT {LABEL.format(o='cmo')} AS cohort_month, cohort_index, customers FROM coh_counts""")
ORACLE["cohort_retention_matrix"] = qc("SELECT * FROM coh_matrix")
ORACLE["avg_retention_curve"] = qc(f"""SELECT cohort_index, count(retention_rate) AS cohorts,
  {RE('sum(retention_rate)', 'count(retention_rate)', 2, num_scale=3, mult=100)} AS avg_retention_pct
FROM coh_matrix GROUP BY cohort_index""")
_mil = ",\n  ".join(
    RE(f"sum(retention_rate) FILTER (WHERE cohort_index = {i})",
       f"count(retention_rate) FILTER (WHERE cohort_index = {i})", 2, num_scale=3, mult=100)
    + f" AS avg_month{i}_pct" for i in (1, 3, 6, 12))
ORACLE["cohort_milestones"] = qc(f"""SELECT * FROM
  (SELECT count(*) AS cohorts, CAST(sum(cohort_size) AS BIGINT) AS customers, max(cohort_size) AS largest_cohort_size,
          min(cohort_size) AS smallest_cohort_size FROM coh_matrix WHERE cohort_index = 0) a,
  (SELECT cohort_month AS best_month1_cohort, retention_rate AS best_month1_rate FROM coh_matrix
     WHERE cohort_index = 1 ORDER BY retention_rate DESC, cohort_month LIMIT 1) b,
  (SELECT cohort_month AS worst_month1_cohort, retention_rate AS worst_month1_rate FROM coh_matrix
     WHERE cohort_index = 1 ORDER BY retention_rate, cohort_month LIMIT 1) w,
  (SELECT {_mil} FROM coh_matrix) m,
  (SELECT {RE('sum(mean)', 'count(mean)', 2, num_scale=6)} AS avg_month1_12_pct FROM (
     SELECT {R('sum(retention_rate)', 'count(retention_rate)', 6, num_scale=3, mult=100)} AS mean
     FROM coh_matrix WHERE cohort_index BETWEEN 1 AND 12 GROUP BY cohort_index)) l""")
ORACLE["cohort_curve"] = qc("""SELECT cohort_month, cohort_index, retention_rate,
  coalesce(cohort_index = (SELECT cohort_index FROM coh_matrix WHERE cohort_month = (SELECT min(cohort_month) FROM coh_matrix)
      AND cohort_index > 0 ORDER BY retention_rate DESC, cohort_index LIMIT 1), false) AS is_peak
FROM coh_matrix WHERE cohort_month = (SELECT min(cohort_month) FROM coh_matrix)""")

# ---- revenue (clean lines)
MS = f"""msum AS (SELECT strftime(invoice_ts, '%Y-%m') AS year_month, {ME('sum(revenue)')} AS revenue,
  count(DISTINCT invoice) AS orders, count(DISTINCT customer_id) AS customers,
  {RE('sum(revenue)', 'count(DISTINCT invoice)', 2, num_scale=4)} AS aov FROM clean_sales GROUP BY 1),
ctab AS (SELECT *, {RE('revenue', 'sum(revenue) OVER ()', 2, num_scale=2, den_scale=2, mult=100)} AS revenue_pct FROM (
  SELECT country, {ME('sum(revenue)')} AS revenue, count(DISTINCT invoice) AS orders,
         count(DISTINCT customer_id) AS customers FROM clean_sales GROUP BY country)),
cust_rev AS (SELECT customer_id, sum(revenue) AS revenue FROM clean_sales GROUP BY customer_id),
prod_first AS (SELECT stock_code, description FROM (
  SELECT stock_code, description, row_number() OVER (PARTITION BY stock_code ORDER BY {FIRST_ORDER_SQL}) AS rn
  FROM clean_sales WHERE description IS NOT NULL) WHERE rn = 1),
prod_rev AS (SELECT c.stock_code, p.description, sum(revenue) AS revenue, CAST(sum(quantity) AS BIGINT) AS quantity
  FROM clean_sales c LEFT JOIN prod_first p ON c.stock_code = p.stock_code GROUP BY c.stock_code, p.description),
cust_par AS (SELECT customer_id, CAST(revenue AS DECIMAL(38,4)) AS revenue, rank,
  CAST(cum AS DECIMAL(38,4)) AS cumulative_revenue,
  {RE('cum', 'tot', 4, num_scale=4, den_scale=4, mult=100)} AS cumulative_pct,
  {RE('rank', 'n', 4, mult=100)} AS rank_pct FROM (
  SELECT *, row_number() OVER w AS rank, sum(revenue) OVER w AS cum, sum(revenue) OVER () AS tot, count(*) OVER () AS n
  FROM cust_rev WINDOW w AS (ORDER BY revenue DESC, customer_id ROWS UNBOUNDED PRECEDING))),
prod_par AS (SELECT stock_code, description, CAST(revenue AS DECIMAL(38,4)) AS revenue, quantity, rank,
  CAST(cum AS DECIMAL(38,4)) AS cumulative_revenue,
  {RE('cum', 'tot', 4, num_scale=4, den_scale=4, mult=100)} AS cumulative_pct,
  {RE('rank', 'n', 4, mult=100)} AS rank_pct FROM (
  SELECT *, row_number() OVER w AS rank, sum(revenue) OVER w AS cum, sum(revenue) OVER () AS tot, count(*) OVER () AS n
  FROM prod_rev WINDOW w AS (ORDER BY revenue DESC, stock_code ROWS UNBOUNDED PRECEDING)))"""


def qr(body: str) -> str:
    return f"WITH {BASE},\n{MS}\n{body}"


ORACLE["monthly_summary"] = qr("SELECT * FROM msum")
ORACLE["month_extremes"] = qr(f"""SELECT * FROM
  (SELECT year_month AS best_month, revenue AS best_revenue FROM msum ORDER BY revenue DESC, year_month LIMIT 1) b,
  (SELECT year_month AS worst_month, revenue AS worst_revenue FROM msum ORDER BY revenue, year_month LIMIT 1) w,
  (SELECT count(*) AS months, {RE('sum(revenue)', 'count(*)', 2, num_scale=2)} AS mean_monthly_revenue,
          {RE('sum(aov)', 'count(*)', 2, num_scale=2)} AS mean_monthly_aov FROM msum) m""")
ORACLE["country_summary"] = qr("""SELECT country, revenue, orders, customers, revenue_pct FROM ctab
ORDER BY revenue DESC, country LIMIT 15""")
ORACLE["home_vs_abroad"] = qr(f"""SELECT '{HOME}' AS home_country,
  coalesce(sum(revenue) FILTER (WHERE country = '{HOME}'), 0) AS home_revenue,
  coalesce(sum(revenue_pct) FILTER (WHERE country = '{HOME}'), 0) AS home_pct,
  coalesce(sum(revenue) FILTER (WHERE country <> '{HOME}'), 0) AS other_revenue,
  coalesce(sum(revenue_pct) FILTER (WHERE country <> '{HOME}'), 0) AS other_pct FROM ctab""")
ORACLE["customer_pareto"] = qr("SELECT * FROM cust_par")
ORACLE["product_pareto"] = qr("SELECT * FROM prod_par")
ORACLE["pareto_cutoff"] = qr(f"""SELECT entity, cutoff_rank, entities, {RE('cutoff_rank', 'entities', 2, mult=100)} AS share_pct FROM (
  SELECT 'customers' AS entity, min(rank) FILTER (WHERE cumulative_pct >= 80) AS cutoff_rank, count(*) AS entities FROM cust_par
  UNION ALL
  SELECT 'products', min(rank) FILTER (WHERE cumulative_pct >= 80), count(*) FROM prod_par)""")


def _slice(entity: str, src: str, name: str, num: int, den: int, side: str) -> str:
    cond = (f"rank <= (SELECT count(*) FROM {src}) * {num} // {den}" if side == "top" else
            f"rank > (SELECT count(*) FROM {src}) - (SELECT count(*) FROM {src}) * {num} // {den}")
    return (f"""SELECT '{entity}' AS entity, '{name}' AS slice, CAST((SELECT count(*) FROM {src}) * {num} // {den} AS BIGINT) AS members,
  {ME(f'coalesce(sum(revenue) FILTER (WHERE {cond}), 0)')} AS revenue,
  {RE(f'coalesce(sum(revenue) FILTER (WHERE {cond}), 0)', 'sum(revenue)', 2, num_scale=4, den_scale=4, mult=100)} AS revenue_pct
FROM {src}""")


ORACLE["top_bottom_share"] = qr("\nUNION ALL\n".join([
    _slice("customers", "cust_par", "top_10pct", 1, 10, "top"),
    _slice("customers", "cust_par", "top_20pct", 1, 5, "top"),
    _slice("customers", "cust_par", "bottom_50pct", 1, 2, "bottom"),
    _slice("products", "prod_par", "top_10pct", 1, 10, "top")]))
ORACLE["overall_kpis"] = q(f"""SELECT {ME('sum(revenue)')} AS total_revenue, count(DISTINCT invoice) AS orders,
  count(DISTINCT customer_id) AS customers, {RE('sum(revenue)', 'count(DISTINCT invoice)', 2, num_scale=4)} AS aov
FROM clean_sales""")
ORACLE["non_product_codes"] = q(f"""SELECT c.stock_code, {ME('coalesce(sum(s.revenue), 0)')} AS revenue,
  CAST(count(s.stock_code) AS BIGINT) AS lines
FROM (VALUES ('M'), ('POST')) c(stock_code) LEFT JOIN clean_sales s ON s.stock_code = c.stock_code
GROUP BY c.stock_code""")

# ---- lifetime value
CLV = f"""clv_base AS (
  SELECT customer_id, sum(rev) AS rev, count(*) AS total_orders, min(first_ts) AS first_purchase,
         max(last_ts) AS last_purchase FROM (
    SELECT customer_id, invoice, sum(revenue) AS rev, min(invoice_ts) AS first_ts, max(invoice_ts) AS last_ts
    FROM clean_sales GROUP BY customer_id, invoice) GROUP BY customer_id),
clv_1 AS (SELECT customer_id, {ME('rev')} AS total_revenue, total_orders, first_purchase, last_purchase,
  {RE('rev', 'total_orders', 2, num_scale=4)} AS aov,
  CAST(date_sub('day', first_purchase, last_purchase) AS BIGINT) AS lifespan_days FROM clv_base),
clv_2 AS (SELECT *, {RE('lifespan_days', '365', 4)} AS lifespan_years FROM clv_1),
customer_clv AS (SELECT *, {ME('CAST(CAST(aov AS DECIMAL(18,2)) * CAST(total_orders AS DECIMAL(20,0)) AS DECIMAL(20,2)) * CAST(lifespan_years + 1 AS DECIMAL(10,4))')} AS clv FROM clv_2),
clv_seg AS (SELECT c.*, r.segment FROM customer_clv c LEFT JOIN rfm_segments r ON c.customer_id = r.customer_id)"""


def qv(body: str) -> str:
    return f"WITH {BASE},\n{CLV}\n{body}"


MEDIAN = RE("sum(clv)", "count(*)", 3, num_scale=2)
ORACLE["customer_clv"] = qv("SELECT * FROM customer_clv")
ORACLE["clv_stats"] = qv(f"""SELECT count(*) AS customers,
  {RE('sum(aov)', 'count(*)', 2, num_scale=2)} AS avg_aov,
  {RE('sum(total_orders)', 'count(*)', 2)} AS avg_orders,
  {RE('sum(lifespan_years)', 'count(*)', 4, num_scale=4)} AS avg_lifespan_years,
  min(clv) AS min_clv, max(clv) AS max_clv,
  {RE('sum(clv)', 'count(*)', 2, num_scale=2)} AS mean_clv, sum(clv) AS total_clv,
  (SELECT {MEDIAN} FROM (SELECT clv, row_number() OVER (ORDER BY clv, customer_id) AS rn, count(*) OVER () AS n
     FROM customer_clv) WHERE rn IN ((n + 1) // 2, n // 2 + 1)) AS median_clv
FROM customer_clv""")
ORACLE["clv_by_segment"] = qv(f"""SELECT g.segment, customer_count,
  {RE('total_clv', 'customer_count', 2, num_scale=2)} AS avg_clv, m.median_clv, total_clv,
  {RE('days', 'customer_count', 2)} AS avg_lifespan_days, {RE('ord', 'customer_count', 2)} AS avg_orders
FROM (SELECT segment, count(*) AS customer_count, sum(clv) AS total_clv, sum(lifespan_days) AS days,
             sum(total_orders) AS ord FROM clv_seg WHERE segment IS NOT NULL GROUP BY segment) g
LEFT JOIN (SELECT segment, {RE('sum(clv)', 'count(*)', 2, num_scale=2)} AS median_clv FROM (
    SELECT segment, clv, row_number() OVER (PARTITION BY segment ORDER BY clv, customer_id) AS rn,
           count(*) OVER (PARTITION BY segment) AS n FROM clv_seg WHERE segment IS NOT NULL)
  WHERE rn IN ((n + 1) // 2, n // 2 + 1) GROUP BY segment) m ON g.segment = m.segment""")
ORACLE["clv_top20"] = qv("""SELECT customer_id, total_revenue, total_orders, aov, lifespan_days, clv, segment
FROM clv_seg ORDER BY clv DESC, customer_id LIMIT 20""")
ORACLE["clv_top20_share"] = qv(f"""SELECT top_clv, total_clv, {RE('top_clv', 'total_clv', 2, num_scale=2, den_scale=2, mult=100)} AS top_pct
FROM (SELECT (SELECT sum(clv) FROM (SELECT clv FROM customer_clv ORDER BY clv DESC, customer_id LIMIT 20)) AS top_clv,
             (SELECT sum(clv) FROM customer_clv) AS total_clv)""")
ORACLE["clv_histogram"] = qv("""SELECT CAST(bin AS INTEGER) AS bin, count(*) AS customers, lo AS range_low, hi AS range_high FROM (
  SELECT k.clv, r.lo, r.hi, CASE WHEN r.hi = r.lo THEN 0 ELSE least(49,
      CAST((CAST((k.clv - r.lo) * 100 AS HUGEINT) * 50) // CAST((r.hi - r.lo) * 100 AS HUGEINT) AS INTEGER)) END AS bin
  FROM (SELECT clv FROM customer_clv WHERE CAST(clv AS DOUBLE) <= (SELECT quantile_cont(CAST(clv AS DOUBLE), 0.95) FROM customer_clv)) k,
       (SELECT min(clv) AS lo, max(clv) AS hi FROM customer_clv
        WHERE CAST(clv AS DOUBLE) <= (SELECT quantile_cont(CAST(clv AS DOUBLE), 0.95) FROM customer_clv)) r)
GROUP BY bin, lo, hi""")
ORACLE["clv_segment_ratio"] = qv(f"""SELECT c AS champion_avg_clv, l AS lost_avg_clv, a AS at_risk_avg_clv,
  {RE('c', 'l', 1, num_scale=2, den_scale=2)} AS champion_vs_lost,
  {RE('c', 'a', 1, num_scale=2, den_scale=2)} AS champion_vs_at_risk FROM (
  SELECT max(avg_clv) FILTER (WHERE segment = 'Champion') AS c, max(avg_clv) FILTER (WHERE segment = 'Lost') AS l,
         max(avg_clv) FILTER (WHERE segment = 'At Risk') AS a FROM (
    SELECT segment, {RE('sum(clv)', 'count(*)', 2, num_scale=2)} AS avg_clv FROM clv_seg WHERE segment IS NOT NULL GROUP BY segment))""")
ORACLE["recovery_scenario"] = qg(f"""SELECT scenario, members, base_value, CAST(0.20 AS DECIMAL(5,4)) AS assumed_rate,
  CAST(round(base_value * CAST(0.20 AS DECIMAL(5,4)), 2) AS DECIMAL(38,2)) AS recoverable_value FROM (
  SELECT 'At Risk customers' AS scenario, count(*) AS members, CAST(coalesce(sum(monetary), 0) AS DECIMAL(38,2)) AS base_value
  FROM rfm_segments WHERE segment = 'At Risk'
  UNION ALL
  SELECT 'guest checkouts', count(*), CAST({M('coalesce(sum(revenue), 0)')} AS DECIMAL(38,2)) FROM guest)""")

# ---- star schema and integrity
for _t in ("dim_customer", "dim_product", "dim_date", "fact_sales"):
    ORACLE[_t] = q(f"SELECT * FROM {_t}")


def _integrity() -> None:
    from shopscope import schemas
    fks = [f"""SELECT '{c}' AS child_table, '{col}' AS child_column, '{p}' AS parent_table,
  (SELECT count(*) FROM {c} x WHERE NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{pc} = x.{col})) AS orphan_rows"""
           for c, col, p, pc in schemas.FOREIGN_KEYS]
    ORACLE["fk_orphans"] = q("\nUNION ALL\n".join(fks))
    pks = []
    for name, keys in schemas.PRIMARY_KEYS.items():
        nn = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in schemas.NOT_NULL[name])
        kcols = ", ".join(keys)
        knull = " OR ".join(f"{k} IS NULL" for k in keys)
        pks.append(f"""SELECT '{name}' AS table_name, count(*) AS rows,
  (SELECT count(*) FROM (SELECT {kcols} FROM {name} GROUP BY {kcols} HAVING count(*) > 1)) AS duplicate_keys,
  count(*) FILTER (WHERE {knull}) AS null_keys, CAST({nn} AS BIGINT) AS not_null_violations FROM {name}""")
    ORACLE["pk_violations"] = q("\nUNION ALL\n".join(pks))
    ORACLE["load_row_counts"] = q("\nUNION ALL\n".join(
        f"SELECT {i + 1} AS load_order, '{t}' AS table_name, count(*) AS rows FROM {t}"
        for i, t in enumerate(["dim_customer", "dim_product", "dim_date", "fact_sales", "rfm_segments"])))


_integrity()

# ---- significance tests
def _two_sample(src: str, flag: str, v: str, scale: int, test: str, g1: str, g2: str) -> str:
    return f"""SELECT '{test}' AS test, '{g1}' AS group1, '{g2}' AS group2, n1, n2,
  {RE('s1', 'n1', 2, num_scale=scale)} AS mean1, {RE('s2', 'n2', 2, num_scale=scale)} AS mean2,
  {RE('s1 * n2 - s2 * n1', 'n1 * n2', 2, num_scale=scale)} AS mean_difference,
  {T('n1', 's1', 'q1', 'n2', 's2', 'q2')} AS t_stat, CAST(n1 + n2 - 2 AS BIGINT) AS df
FROM (SELECT count(*) FILTER (WHERE {flag}) AS n1, sum({v}) FILTER (WHERE {flag}) AS s1,
             sum({v} * {v}) FILTER (WHERE {flag}) AS q1,
             count(*) FILTER (WHERE NOT ({flag})) AS n2, sum({v}) FILTER (WHERE NOT ({flag})) AS s2,
             sum({v} * {v}) FILTER (WHERE NOT ({flag})) AS q2 FROM {src})"""


ORACLE["ttest_champion"] = q(_two_sample("rfm_segments", "coalesce(segment = 'Champion', false)", "monetary", 2,
                                         "champion_vs_other_monetary", "Champion", "other"))
ORACLE["ttest_country"] = q(_two_sample(
    f"(SELECT coalesce(country = '{HOME}', false) AS g, invoice, sum(revenue) AS order_revenue FROM clean_sales GROUP BY 1, 2)",
    "g", "order_revenue", 4, "home_vs_other_order_value", HOME, "other"))
_Q4 = "month(invoice_ts) IN (10, 11, 12)"
ORACLE["ttest_q4_order_value"] = q(f"""SELECT * FROM ({_two_sample(
    f"(SELECT {_Q4} AS g, invoice, sum(revenue) AS order_revenue FROM clean_sales GROUP BY 1, 2)",
    "g", "order_revenue", 4, "q4_vs_other_order_value", "Q4", "other")}) t,
  (SELECT {RE(f'coalesce(sum(revenue) FILTER (WHERE {_Q4}), 0)', 'sum(revenue)', 2, num_scale=4, den_scale=4, mult=100)} AS q4_revenue_pct
   FROM clean_sales) s""")
_MQ = f"(SELECT year(invoice_ts) * 12 + month(invoice_ts) - 1 AS mo, {_Q4} AS g, sum(revenue) AS month_revenue FROM clean_sales GROUP BY 1, 2)"
ORACLE["ttest_q4_monthly"] = q(f"""SELECT * FROM ({_two_sample(_MQ, "g", "month_revenue", 4,
                                                             "q4_vs_other_monthly_revenue", "Q4", "other")}) t,
  (SELECT {RE('s1 * n2 - s2 * n1', 's2 * n1', 2, num_scale=4, den_scale=4, mult=100)} AS q4_premium_pct FROM (
     SELECT count(*) FILTER (WHERE g) AS n1, sum(month_revenue) FILTER (WHERE g) AS s1,
            count(*) FILTER (WHERE NOT g) AS n2, sum(month_revenue) FILTER (WHERE NOT g) AS s2 FROM {_MQ})) p""")
ORACLE["chi2_segment_counts"] = q(f"""SELECT segment, observed, {RE('n', 'k', 1)} AS expected,
  {RE('observed * k - n', 'k', 1)} AS difference FROM (
  SELECT segment, count(*) AS observed FROM rfm_segments GROUP BY segment) g,
  (SELECT count(*) AS n, count(DISTINCT segment) AS k FROM rfm_segments) t""")
ORACLE["chi2_segments"] = q(f"""SELECT 'segment_uniformity' AS test, CAST(n AS BIGINT) AS n, k, {RE('k * sq - n * n', 'n', 4)} AS chi2_stat,
  CAST(k - 1 AS BIGINT) AS df FROM (SELECT sum(o) AS n, count(*) AS k, sum(o * o) AS sq FROM (
  SELECT count(*) AS o FROM rfm_segments GROUP BY segment))""")


def _describe() -> None:
    parts = []
    for m in ("recency", "frequency", "monetary", "r_score", "f_score", "m_score"):
        v = f"CAST({m} AS DECIMAL(38,4))"
        qs = []
        for k in (1, 2, 3):
            lo = f"((n - 1) * {k} // 4)"
            frac = f"((n - 1) * {k} % 4)"
            vlo = f"max(v) FILTER (WHERE rn = {lo} + 1)"
            vhi = f"max(v) FILTER (WHERE rn = {lo} + CASE WHEN {frac} > 0 THEN 2 ELSE 1 END)"
            afrac = f"((max(n) - 1) * {k} % 4)"
            qs.append(f"CAST({vlo} + ({vhi} - {vlo}) * {afrac} * CAST(0.25 AS DECIMAL(3,2)) AS DECIMAL(38,4)) AS p{25 * k}")
        parts.append(f"""SELECT '{m}' AS measure, count(v) AS count,
  {RE('sum(v)', 'count(v)', 6, num_scale=4)} AS mean, {SD('count(v)', 'sum(v)', 'sum(v * v)')} AS std,
  min(v) AS min, {', '.join(qs)}, max(v) AS max
FROM (SELECT {v} AS v, row_number() OVER (ORDER BY {v}, customer_id) AS rn, count(*) OVER () AS n FROM rfm_segments)""")
    ORACLE["rfm_describe"] = q("\nUNION ALL\n".join(parts))


_describe()

ORACLE["output_verification"] = q("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, true AS written, true AS has_bytes, count(*) AS rows_expected, count(*) AS rows_read, "
    f"true AS schema_equal, true AS content_equal FROM {t}"
    for t in ["dim_customer", "dim_product", "dim_date", "fact_sales", "rfm_segments"]))

ORACLE["cohort_retention_wide"] = qc("SELECT cohort_month, " + ", ".join(
    f'max(retention_rate) FILTER (WHERE cohort_index = {i}) AS "{i}"' for i in range(80)) + " FROM coh_matrix GROUP BY cohort_month")

# p-values: Simpson's rule over the density between 0 and the statistic
_SIMPSON = "CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
_TESTS = "\nUNION ALL\n".join(
    [f"SELECT test, 't' AS kind, t_stat AS statistic, df FROM ({ORACLE[k]})"
     for k in ("ttest_champion", "ttest_country", "ttest_q4_order_value", "ttest_q4_monthly")]
    + [f"SELECT test, 'chi2', CAST(chi2_stat AS DECIMAL(38,6)), df FROM ({ORACLE['chi2_segments']})"])
ORACLE["tests_summary"] = f"""WITH tests AS ({_TESTS}),
points AS (
  SELECT test, i, abs(CAST(statistic AS DOUBLE)) / 20000 AS h, CAST(df AS DOUBLE) AS k,
         abs(CAST(statistic AS DOUBLE)) * i / 20000 AS x, kind
  FROM tests, (SELECT unnest(range(0, 20001)) AS i)
), areas AS (
  SELECT test, sum({_SIMPSON} * CASE WHEN kind = 't'
      THEN exp(lgamma((k + 1) / 2) - lgamma(k / 2) - ln(k * pi()) / 2 - (k + 1) / 2 * ln(1 + x * x / k))
      WHEN x > 0 THEN exp((k / 2 - 1) * ln(x) - x / 2 - k / 2 * ln(2) - lgamma(k / 2)) ELSE 0 END) * any_value(h) / 3 AS area
  FROM points GROUP BY test
), p AS (
  SELECT t.test, t.kind, t.statistic, t.df,
         greatest(round(CASE WHEN t.kind = 't' THEN 1 - 2 * a.area ELSE 1 - a.area END, 6), 0) AS p_value
  FROM tests t JOIN areas a ON a.test = t.test
)
SELECT test, kind, statistic, df, p_value, p_value < 0.05 AS significant FROM p"""


def _profile() -> None:
    from shopscope import schemas
    rows = "\nUNION ALL\n".join(
        f"SELECT {i} AS position, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type, "
        f"(SELECT count(*) FROM raw_sales) AS total_rows, {len(schemas.RAW_SALES.fields)} AS total_columns"
        for i, f in enumerate(schemas.RAW_SALES.fields))
    ORACLE["dq_profile"] = q(rows)
    order = ", ".join(f"{c} NULLS FIRST" for c in ("invoice", "invoice_ts", "stock_code", "quantity", "price", "customer_id",
                                                    "country", "description"))
    ORACLE["dq_sample_rows"] = q(f"SELECT * FROM raw_sales ORDER BY {order} LIMIT 3")
    cols = ", ".join(RAW_COLS)
    ORACLE["dq_duplicate_sample"] = q(f"""SELECT {cols} FROM (
  SELECT *, count(*) OVER (PARTITION BY {cols}) AS copies FROM raw_sales) WHERE copies > 1
ORDER BY {order} LIMIT 6""")


_profile()

ORACLE["event_rfm_base"] = """WITH p AS (
  SELECT CAST(event_id AS VARCHAR) AS invoice, ts AS invoice_ts, user_id AS customer_id,
         CAST(CAST(value AS DECIMAL(12,4)) AS DECIMAL(18,4)) AS revenue
  FROM events WHERE event_type = 'purchase'
), o AS (
  SELECT customer_id, invoice, sum(revenue) AS rev, max(invoice_ts) AS last_ts FROM p GROUP BY customer_id, invoice
)
SELECT customer_id,
       CAST(date_sub('day', max(last_ts), (SELECT max(invoice_ts) + INTERVAL 1 DAY FROM p)) AS INTEGER) AS recency,
       count(*) AS frequency, CAST(round_even(sum(rev), 2) AS DECIMAL(18,2)) AS monetary
FROM o GROUP BY customer_id"""


def _event_segments() -> None:
    scoring = BASE[BASE.index("rfm_edges AS ("):BASE.index("monthly AS (")].rstrip().rstrip(",")
    base_sql = ORACLE["event_rfm_base"]
    body = base_sql[len("WITH "):]
    last_select = body.rindex("SELECT customer_id,")
    ctes, base_select = body[:last_select].rstrip().rstrip(","), body[last_select:]
    ORACLE["event_rfm_segments"] = (f"WITH {ctes},\nrfm_base AS (\n{base_select}\n),\n{scoring}\n"
                                    "SELECT * FROM rfm_segments")


_event_segments()
