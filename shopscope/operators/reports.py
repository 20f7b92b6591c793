"""The 21 report queries over the star schema (Q-01 ... Q-21) and the two
reports the workflow describes without SQL (rolling retention, revenue by
decile).

Plan notes:
  * every "ORDER BY x LIMIT k" is a distributed top-k (TakeOrderedAndProject)
    with a unique tie-break, and ranks / percent ranks / deciles of those k
    rows are derived exactly from the k rows plus global counts, so no
    customer- or product-sized single-task window is needed;
  * month / segment / country / cohort tables are bounded (hundreds of rows),
    so their windows run as plain windows after the aggregate;
  * COUNT(DISTINCT ...) by month, country and in total come from bitmaps that
    roll up (``operators.cells``); from plain lines, several of them in one
    group are computed over (group, invoice, customer), which shrinks the Expand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopscope.functions.calendar import month_ordinal, ordinal_label
from shopscope.functions.exact import money, ratio
from shopscope.operators.activity import activity, cohort_cells
from shopscope.operators.cells import rolled_up
from shopscope.plans.selection import Rank, at_ranks
from shopscope.plans.summary import in_order

RFM_COLUMNS = ["customer_id", "recency", "frequency", "monetary", "r_score", "f_score",
               "m_score", "rfm_score", "rfm_total", "segment"]


def _scalar(df: DataFrame, expr) -> object:
    return df.select(expr).scalar()


# ----------------------------------------------------------------- RFM
@in_order("-monetary", "customer_id")
def rfm_top_customers(rfm: DataFrame, k: int = 20) -> DataFrame:
    """Q-01."""
    return rfm.select(*RFM_COLUMNS).orderBy(F.desc("monetary"), F.asc("customer_id")).limit(k)


@in_order("-total_revenue", "segment")
def segment_scorecard(rfm: DataFrame) -> DataFrame:
    """Q-02."""
    g = rfm.groupBy("segment").agg(
        F.count("customer_id").alias("customer_count"),
        F.sum("monetary").alias("_m"), F.sum("recency").alias("_r"),
        F.sum("frequency").alias("_f"))
    g = g.withColumn("_n", _scalar(rfm, F.count(F.lit(1))))
    return g.select(
        "segment", "customer_count",
        ratio("customer_count", "_n", 2, mult=100).alias("customer_pct"),
        money("_m").alias("total_revenue"),
        ratio("_m", "customer_count", 2, num_scale=2).alias("avg_revenue"),
        ratio("_r", "customer_count", 1).alias("avg_recency_days"),
        ratio("_f", "customer_count", 1).alias("avg_frequency"))


def _segment_detail(rfm: DataFrame, dim_customer: DataFrame, segment: str, names: dict,
                    k: int) -> DataFrame:
    # members without a dimension row drop out before the cut to k rows
    known = rfm.where(F.col("segment") == segment).join(dim_customer.select("customer_id"), "customer_id", "left_semi")
    top = (known
              .orderBy(F.desc("monetary"), F.asc("customer_id")).limit(k))
    return top.join(dim_customer, "customer_id").select(
        "customer_id", "country",
        F.col("recency").alias(names["recency"]), F.col("frequency").alias(names["frequency"]),
        money("monetary").alias("total_spent"), "rfm_score")


@in_order("-total_spent", "customer_id")
def champion_detail(rfm: DataFrame, dim_customer: DataFrame, k: int = 20) -> DataFrame:
    """Q-03."""
    return _segment_detail(rfm, dim_customer, "Champion",
                           {"recency": "recency", "frequency": "frequency"}, k)


@in_order("-total_spent", "customer_id")
def at_risk_recovery_list(rfm: DataFrame, dim_customer: DataFrame, k: int = 20) -> DataFrame:
    """Q-04."""
    return _segment_detail(rfm, dim_customer, "At Risk",
                           {"recency": "days_since_last_purchase", "frequency": "total_orders"}, k)


@in_order("-total_revenue", "segment")
def segment_pareto(rfm: DataFrame) -> DataFrame:
    """Q-05: running revenue over segments by revenue desc, RANGE frame
    (segments with equal revenue share the running value)."""
    g = rfm.groupBy("segment").agg(F.count("customer_id").alias("customer_count"),
                                   F.sum("monetary").alias("_m"))
    g = g.withColumn("_all", _scalar(rfm, F.sum("monetary")))
    w = Window.orderBy(F.desc("_m"))  # default frame: RANGE UNBOUNDED PRECEDING
    return g.select(
        "segment", "customer_count", money("_m").alias("total_revenue"),
        ratio("_m", "_all", 2, num_scale=2, den_scale=2, mult=100).alias("revenue_pct"),
        money(F.sum("_m").over(w)).alias("cumulative_revenue"))


@in_order("-total_revenue", "stock_code")
def at_risk_product_affinity(fact: DataFrame, dim_product: DataFrame, rfm: DataFrame,
                             k: int = 15) -> DataFrame:
    """Q-06."""
    at_risk = rfm.where(F.col("segment") == "At Risk").select("customer_id")
    lines = fact.join(at_risk, "customer_id", "left_semi")
    per_order = lines.groupBy("stock_code", "invoice", "customer_id").agg(
        F.sum("quantity").alias("_q"), F.sum("revenue").alias("_rev"),
        F.sum("price").alias("_p"), F.count(F.lit(1)).alias("_c"))
    g = per_order.groupBy("stock_code").agg(
        F.count_distinct("customer_id").alias("at_risk_customers"),
        F.count_distinct("invoice").alias("total_orders"),
        F.sum("_q").cast("bigint").alias("total_units"),
        F.sum("_rev").alias("_rev"), F.sum("_p").alias("_p"), F.sum("_c").alias("_c"))
    known = g.join(dim_product.select("stock_code"), "stock_code", "left_semi")
    top = known.orderBy(F.desc("_rev"), F.asc("stock_code")).limit(k)
    return top.join(dim_product, "stock_code").select(
        "description", "stock_code", "at_risk_customers", "total_orders", "total_units",
        money("_rev").alias("total_revenue"),
        ratio("_p", "_c", 2, num_scale=2).alias("avg_price"))


# ----------------------------------------------------------------- revenue
def _invoice_lines(fact: DataFrame, *keys: str) -> DataFrame:
    """Lines pre-aggregated to (keys, invoice): when only distinct invoices
    are counted per group, counting these rows replaces COUNT(DISTINCT)
    (one shuffle fewer, no Expand)."""
    return fact.groupBy(*keys, "invoice").agg(
        F.sum("revenue").alias("_rev"), F.sum("quantity").alias("_q"),
        F.sum("price").alias("_p"), F.count(F.lit(1)).alias("_c"))


def _order_lines(fact: DataFrame, *keys: str) -> DataFrame:
    """Lines pre-aggregated to (keys, invoice, customer): the input of every
    report that counts distinct orders and customers per group."""
    return fact.groupBy(*keys, "invoice", "customer_id").agg(
        F.sum("revenue").alias("_rev"), F.sum("quantity").alias("_q"),
        F.sum("price").alias("_p"), F.count(F.lit(1)).alias("_c"))


def sale_month_ordinal(fact: DataFrame) -> Column:
    """The month ordinal of a fact line: from the partition it lies in, where the fact has month partitions."""
    if "sale_month" in fact.columns:
        return F.expr("(sale_month div 100) * 12 + sale_month % 100 - 1").cast("int")
    return month_ordinal(F.col("date_id"))


def in_period(fact: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """The lines of the months ``since`` to ``until`` ('yyyy-MM', both included, None: open). On a fact
    with month partitions only the folders of these months are read."""
    month = F.col("sale_month") if "sale_month" in fact.columns else (F.year("date_id") * 100 + F.month("date_id"))
    for label, holds in ((since, month.__ge__), (until, month.__le__)):
        if label is not None:
            fact = fact.where(holds(int(label.replace("-", ""))))
    return fact


def monthly(fact: DataFrame) -> DataFrame:
    """Per calendar month: month ordinal, revenue (exact), orders, customers.
    ``fact``: lines, or their cells (``operators.cells``), which count without lines."""
    if "bits" in fact.columns:
        g = rolled_up(fact, "sale_month").withColumn("_mo", sale_month_ordinal(fact))
        return g.withColumn("revenue_month", ordinal_label(F.col("_mo")))
    lines = fact.withColumn("_mo", sale_month_ordinal(fact))
    g = _order_lines(lines, "_mo").groupBy("_mo").agg(
        F.sum("_rev").alias("_rev"),
        F.count_distinct("invoice").alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"))
    return g.withColumn("revenue_month", ordinal_label(F.col("_mo")))


@in_order("revenue_month")
def monthly_revenue_trend(fact: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """Q-07, of all months or of a period."""
    return monthly(in_period(fact, since, until)).select(
        "revenue_month", "total_orders", "unique_customers",
        money("_rev").alias("total_revenue"),
        ratio("_rev", "total_orders", 2, num_scale=2).alias("avg_order_value"))


@in_order("-total_revenue", "country")
def country_revenue_top10(fact: DataFrame, dim_customer: DataFrame, k: int = 10,
                          since: str | None = None, until: str | None = None) -> DataFrame:
    """Q-08: by the customer's (first) country, of all months or of a period, from lines or cells."""
    fact = in_period(fact, since, until)
    if "bits" in fact.columns:
        g = rolled_up(fact.where("known"), "country")
    else:
        # lines shrink to orders before they meet the dimension
        g = _order_lines(fact).join(dim_customer, "customer_id").groupBy("country").agg(
            F.count_distinct("invoice").alias("total_orders"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.sum("_rev").alias("_rev"))
    top = g.orderBy(F.desc("_rev"), F.asc("country")).limit(k)
    top = top.withColumn("_all", _scalar(fact, F.sum("revenue")))
    return top.select(
        "country", "total_orders", "unique_customers", money("_rev").alias("total_revenue"),
        ratio("_rev", "_all", 2, num_scale=2, den_scale=2, mult=100).alias("revenue_pct"),
        ratio("_rev", "unique_customers", 2, num_scale=2).alias("revenue_per_customer"))


def _monthly_rounded(fact: DataFrame) -> DataFrame:
    return monthly(fact).withColumn("monthly_revenue", money("_rev"))


@in_order("revenue_month")
def rolling_3m_revenue(fact: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """Q-09: rows-based 3-month moving average, change and growth vs the
    previous row (a calendar gap is stepped over, as in the SQL), of all
    months or of a period."""
    m = _monthly_rounded(in_period(fact, since, until))
    w = Window.orderBy("revenue_month")
    w3 = w.rowsBetween(-2, Window.currentRow)
    m = (m.withColumn("_s3", F.sum("monthly_revenue").over(w3))
          .withColumn("_c3", F.count("monthly_revenue").over(w3))
          .withColumn("_prev", F.lag("monthly_revenue").over(w)))
    return m.select(
        "revenue_month", "monthly_revenue",
        ratio("_s3", "_c3", 2, num_scale=2).alias("rolling_3month_avg"),
        money(F.col("monthly_revenue") - F.col("_prev")).alias("month_over_month_change"),
        ratio("monthly_revenue - _prev", "_prev", 2, num_scale=2, den_scale=2,
              mult=100).alias("mom_growth_pct"))


@in_order("-is_q4")
def q4_vs_nonq4(fact: DataFrame, dim_date: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Q-10, of all years or of some: a condition on the dates reaches the fact's month partitions
    through the join (dynamic partition pruning)."""
    days = dim_date.where(F.col("year").isin(*years)) if years else dim_date
    if "sale_month" in fact.columns:
        days = days.select("date_id", "is_q4", (F.col("year") * 100 + F.col("month")).alias("sale_month"))
        lines = fact.join(days, ["date_id", "sale_month"])
    else:
        lines = fact.join(days.select("date_id", "is_q4"), "date_id")
    g = _invoice_lines(lines, "is_q4").groupBy("is_q4").agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("_rev").alias("_rev"))
    return g.select(
        "is_q4",
        F.when(F.col("is_q4") == 1, "Q4 (Oct-Dec)").otherwise("Non-Q4 (Jan-Sep)").alias("period"),
        "total_orders", money("_rev").alias("total_revenue"),
        ratio("_rev", "total_orders", 2, num_scale=2).alias("avg_order_value"))


@in_order("-total_revenue", "stock_code")
def top_products(fact: DataFrame, dim_product: DataFrame, k: int = 10) -> DataFrame:
    """Q-11."""
    g = _invoice_lines(fact, "stock_code").groupBy("stock_code").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("_q").cast("bigint").alias("total_units_sold"),
        F.sum("_rev").alias("_rev"), F.sum("_p").alias("_p"), F.sum("_c").alias("_c"))
    known = g.join(dim_product.select("stock_code"), "stock_code", "left_semi")
    top = known.orderBy(F.desc("_rev"), F.asc("stock_code")).limit(k)
    top = top.withColumn("_all", _scalar(fact, F.sum("revenue")))
    return top.join(dim_product, "stock_code").select(
        "stock_code", "description", "total_orders", "total_units_sold",
        money("_rev").alias("total_revenue"),
        ratio("_rev", "_all", 2, num_scale=2, den_scale=2, mult=100).alias("revenue_pct"),
        ratio("_p", "_c", 2, num_scale=2).alias("avg_price"))


# ----------------------------------------------------------------- cohorts
def _cells(fact: DataFrame | None, bitsets: DataFrame | None) -> DataFrame:
    """Cohort cells of the customers' month bitsets, which are made from the fact unless given."""
    return cohort_cells(bitsets if bitsets is not None else activity(fact, sale_month_ordinal(fact)))


@in_order("cohort_month")
def cohort_sizes(fact: DataFrame | None, *, bitsets: DataFrame | None = None) -> DataFrame:
    """Q-12."""
    return _cells(fact, bitsets).where("cohort_index = 0").select(
        ordinal_label(F.col("cohort_mo")).alias("cohort_month"), F.col("customers").alias("cohort_size"))


@in_order("cohort_month", "cohort_index")
def cohort_retention_long(fact: DataFrame | None, max_index: int = 12, *, bitsets: DataFrame | None = None) -> DataFrame:
    """Q-13."""
    g = _cells(fact, bitsets).where(F.col("cohort_index").between(0, max_index))
    return g.select(ordinal_label(F.col("cohort_mo")).alias("cohort_month"),
                    F.col("cohort_index").cast("bigint").alias("cohort_index"), F.col("customers").alias("active_customers"))


@in_order("cohort_month")
def month1_retention(fact: DataFrame | None, *, bitsets: DataFrame | None = None) -> DataFrame:
    """Q-14: cohort size, customers active in the following calendar month
    (0 when none) and the rate in % (2 places)."""
    at = lambda i: F.coalesce(F.sum(F.when(F.col("cohort_index") == i, F.col("customers"))), F.lit(0)).cast("bigint")
    g = _cells(fact, bitsets).groupBy("cohort_mo").agg(at(0).alias("cohort_size"), at(1).alias("returned_month1"))
    return g.select(
        ordinal_label(F.col("cohort_mo")).alias("cohort_month"), "cohort_size", "returned_month1",
        ratio("returned_month1", "cohort_size", 2, mult=100).alias("month1_retention_pct"))


@in_order("-retention_pct", "cohort_month")
def month1_retention_ranked(fact: DataFrame | None, *, bitsets: DataFrame | None = None) -> DataFrame:
    """Q-15."""
    m = month1_retention(fact, bitsets=bitsets).withColumnRenamed("month1_retention_pct", "retention_pct")
    return m.withColumn("retention_rank",
                        F.rank().over(Window.orderBy(F.desc("retention_pct"))).cast("bigint"))


@in_order("cohort_month")
def rolling_retention(fact: DataFrame | None, *, bitsets: DataFrame | None = None) -> DataFrame:
    """3-row moving average of the month-1 retention % by cohort month."""
    m = month1_retention(fact, bitsets=bitsets)
    w = Window.orderBy("cohort_month").rowsBetween(-2, Window.currentRow)
    m = (m.withColumn("_s", F.sum("month1_retention_pct").over(w))
          .withColumn("_c", F.count("month1_retention_pct").over(w)))
    return m.select("cohort_month", "month1_retention_pct",
                    ratio("_s", "_c", 2, num_scale=2).alias("rolling_3cohort_avg_pct"))


# ----------------------------------------------------------------- advanced
@in_order("revenue_rank", "customer_id", "country")
def customer_revenue_rank(fact: DataFrame, dim_customer: DataFrame, k: int = 20) -> DataFrame:
    """Q-16: RANK() of customers by revenue, top k.

    RANK of a row counts rows with strictly larger revenue; all of them sort
    before it and are therefore inside the top k, so ranking the k rows
    alone is exact.
    """
    g = _invoice_lines(fact, "customer_id").groupBy("customer_id").agg(
        F.sum("_rev").alias("_rev"), F.count(F.lit(1)).alias("total_orders"))
    g = g.join(dim_customer, "customer_id")  # one row per customer on both sides
    top = g.orderBy(F.desc("_rev"), F.asc("customer_id"), F.asc("country")).limit(k)
    top = top.withColumn("_all", _scalar(fact, F.sum("revenue")))
    return top.select(
        "customer_id", "country", money("_rev").alias("total_revenue"), "total_orders",
        F.rank().over(Window.orderBy(F.desc("_rev"))).cast("bigint").alias("revenue_rank"),
        ratio("_rev", "_all", 4, num_scale=2, den_scale=2, mult=100).alias("revenue_pct"))


@in_order("revenue_rank", "stock_code")
def product_dense_rank(fact: DataFrame, dim_product: DataFrame, k: int = 20) -> DataFrame:
    """Q-17: DENSE_RANK() of products by revenue, top k (exact on k rows, as Q-16)."""
    g = fact.groupBy("stock_code").agg(F.sum("revenue").alias("_rev"),
                                       F.sum("quantity").cast("bigint").alias("total_units"))
    g = g.join(dim_product, "stock_code")
    top = g.orderBy(F.desc("_rev"), F.asc("stock_code")).limit(k)
    top = top.withColumn("_all", _scalar(fact, F.sum("revenue")))
    return top.select(
        "stock_code", "description", money("_rev").alias("total_revenue"), "total_units",
        F.dense_rank().over(Window.orderBy(F.desc("_rev"))).cast("bigint").alias("revenue_rank"),
        ratio("_rev", "_all", 4, num_scale=2, den_scale=2, mult=100).alias("pct_of_total"))


@in_order("revenue_month")
def running_total_revenue(fact: DataFrame) -> DataFrame:
    """Q-18."""
    m = _monthly_rounded(fact)
    w = Window.orderBy("revenue_month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    m = (m.withColumn("_run", F.sum("monthly_revenue").over(w))
          .withColumn("_tot", F.sum("monthly_revenue").over(Window.partitionBy())))
    return m.select("revenue_month", "monthly_revenue", money("_run").alias("running_total"),
                    ratio("_run", "_tot", 2, num_scale=2, den_scale=2, mult=100).alias("running_pct_of_total"))


def _ntile(rn: str, n: str, tiles: int) -> str:
    """NTILE(tiles) of 1-based row ``rn`` among ``n`` rows, as SQL text."""
    big = f"({n} div {tiles} + 1)"
    rem = f"({n} % {tiles})"
    return (f"CASE WHEN {rn} <= {rem} * {big} THEN ({rn} - 1) div {big} + 1 "
            f"ELSE {rem} + ({rn} - 1 - {rem} * {big}) div ({n} div {tiles}) + 1 END")


@in_order("-total_revenue", "customer_id")
def customer_percentile(rfm: DataFrame, k: int = 20) -> DataFrame:
    """Q-19: PERCENT_RANK (ascending monetary) x 100 and NTILE(10)
    (descending, ties by customer id) for the top k customers.

    Exact from k rows plus two global counts: n, and for each of the (at
    most k) top values the number of customers at or above it.
    """
    top = rfm.orderBy(F.desc("monetary"), F.asc("customer_id")).limit(k)
    top = top.withColumn("_rn", F.row_number().over(
        Window.orderBy(F.desc("monetary"), F.asc("customer_id"))).cast("bigint"))
    floor_value = top.select(F.min("monetary")).scalar()
    at_or_above = (rfm.where(F.col("monetary") >= floor_value)
                      .groupBy("monetary").agg(F.count(F.lit(1)).alias("_eq"))
                      .withColumn("_ge", F.sum("_eq").over(Window.orderBy(F.desc("monetary")))))
    top = (top.join(at_or_above, "monetary")
              .withColumn("_n", rfm.select(F.count(F.lit(1))).scalar()))
    return top.select(
        "customer_id", money("monetary").alias("total_revenue"), "segment",
        F.when(F.col("_n") <= 1, F.lit(0).cast("decimal(38,2)")).otherwise(
            ratio("_n - _ge", "_n - 1", 2, mult=100)).alias("percentile_rank"),
        F.expr(_ntile("_rn", "_n", 10)).cast("bigint").alias("decile"))


@in_order("decile")
def revenue_by_decile(rfm: DataFrame) -> DataFrame:
    """Customers and revenue per NTILE(10) decile of monetary (descending,
    ties by customer id), over all customers: the last customers of nine
    deciles are found by counting, then one conditional aggregate sums."""
    def last(k: int) -> Rank:
        return Rank(k / 10, lambda n: [k * (n // 10) + min(k, n % 10)])

    borders = at_ranks(rfm, "monetary", "customer_id", [last(k) for k in range(1, 10)], descending=True)[1]
    beyond = [(F.col("monetary") < m) | ((F.col("monetary") == m) & (F.col("customer_id") > c)) for m, c in borders]
    d = rfm.withColumn("decile", sum([F.when(b, 1).otherwise(0) for b in beyond], F.lit(1)).cast("bigint"))
    return d.groupBy("decile").agg(F.count(F.lit(1)).alias("customers"),
                                   money(F.sum("monetary")).alias("total_revenue"))


@in_order("revenue_month")
def mom_growth(fact: DataFrame) -> DataFrame:
    """Q-20."""
    m = _monthly_rounded(fact)
    w = Window.orderBy("revenue_month")
    m = m.withColumn("prev_month_revenue", F.lag("monthly_revenue").over(w))
    return m.select(
        "revenue_month", "monthly_revenue", "total_orders", "unique_customers", "prev_month_revenue",
        money(F.col("monthly_revenue") - F.col("prev_month_revenue")).alias("revenue_change"),
        ratio("monthly_revenue - prev_month_revenue", "prev_month_revenue", 2, num_scale=2,
              den_scale=2, mult=100).alias("growth_pct"))


@in_order("-total_revenue", "country")
def country_contribution(fact: DataFrame, dim_customer: DataFrame, k: int = 15) -> DataFrame:
    """Q-21: ROWS running total by revenue desc (ties by country), from lines or cells."""
    if "bits" in fact.columns:
        g = fact.where("known").groupBy("country").agg(F.sum("revenue").alias("_rev"))
    else:
        per_customer = fact.groupBy("customer_id").agg(F.sum("revenue").alias("_r"))
        g = per_customer.join(dim_customer, "customer_id").groupBy("country").agg(F.sum("_r").alias("_rev"))
    w_all = Window.partitionBy()
    w_run = Window.orderBy(F.desc("_rev"), F.asc("country")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    g = (g.withColumn("_tot", F.sum("_rev").over(w_all))
          .withColumn("_run", F.sum("_rev").over(w_run))
          .withColumn("country_rank", F.rank().over(Window.orderBy(F.desc("_rev"))).cast("bigint")))
    top = g.orderBy(F.desc("_rev"), F.asc("country")).limit(k)
    return top.select(
        "country", money("_rev").alias("total_revenue"),
        ratio("_rev", "_tot", 2, num_scale=2, den_scale=2, mult=100).alias("pct_contribution"),
        money("_run").alias("cumulative_revenue"), "country_rank")
