"""Cleaning funnel (C-10 ... C-14).

The cleaning steps run in a fixed order; each row is attributed to the
first step that removes it. All steps are narrow filters after a single
whole-row de-duplication, so Catalyst fuses them into one stage and the
funnel statistics come from one pass (``first_failing_step`` + one
aggregate), never one job per step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopscope import schemas
from shopscope.functions.exact import money, ratio
from shopscope.plans.marks import counted_rows
from shopscope.plans.summary import one_row

# Funnel step names and order, and the near-zero revenue floor.
STEPS = [
    (1, "duplicate"),
    (2, "cancellation"),
    (3, "stock_adjustment"),
    (4, "non_positive_price"),
    (5, "null_customer"),
    (6, "near_zero_revenue"),
]
KEPT_STEP = 7
MIN_REVENUE = "0.01"


def is_cancellation(invoice: Column) -> Column:
    """Invoice text starts with 'C' (a missing invoice is not a cancellation)."""
    return F.coalesce(invoice.startswith("C"), F.lit(False))


def line_revenue(quantity: Column, price: Column) -> Column:
    return (quantity * price).cast(schemas.REV4)


def first_failing_step(df: DataFrame) -> Column:
    """Number (2..6) of the first cleaning rule a de-duplicated row fails, 7 if kept.

    A missing quantity passes the stock-adjustment test and fails the
    revenue floor, a missing price fails the price test.
    """
    q, p = F.col("quantity"), F.col("price")
    rev = line_revenue(q, p)
    return (F.when(is_cancellation(F.col("invoice")), 2)
             .when(F.coalesce(q < 0, F.lit(False)), 3)
             .when(~F.coalesce(p > 0, F.lit(False)), 4)
             .when(F.col("customer_id").isNull(), 5)
             .when(~F.coalesce(rev >= F.lit(MIN_REVENUE).cast(schemas.REV4), F.lit(False)), 6)
             .otherwise(KEPT_STEP))


def classify(raw: DataFrame, n_rows: int | None = None) -> DataFrame:
    """Distinct raw rows with their number of ``copies`` and the ``step_no``
    of the first cleaning rule they fail (7 = kept).

    This is the single whole-row de-duplication of the workflow; the clean
    table, the funnel, the duplicate count and the pre-floor statistics all
    derive from it. Only rows whose fingerprint repeats are shuffled whole
    (``plans.marks``), the others go straight on. ``n_rows``: about how many
    raw rows there are, if known.
    """
    counted = counted_rows(raw, [f.name for f in schemas.RAW_SALES.fields], n_rows=n_rows)
    return counted.withColumn("step_no", first_failing_step(counted))


def clean_from_classified(classified: DataFrame) -> DataFrame:
    kept = classified.where(F.col("step_no") == KEPT_STEP)
    return kept.select(
        *[F.col(f.name) for f in schemas.RAW_SALES.fields],
        line_revenue(F.col("quantity"), F.col("price")).alias("revenue"))


def clean_sales(raw: DataFrame) -> DataFrame:
    """C-10: de-duplicate, drop cancellations/adjustments/bad prices/guests,
    add revenue and drop near-zero revenue lines."""
    return clean_from_classified(classify(raw))


def clean_funnel(raw: DataFrame) -> DataFrame:
    """C-11 on raw rows (see :func:`funnel_from_classified`)."""
    return funnel_from_classified(classify(raw))


def funnel_from_classified(classified: DataFrame) -> DataFrame:
    """C-11: per step rows before, removed, after, % of raw removed, and
    the retention rate of the kept row ('kept' line).

    Output: step_no, step, rows_before, rows_removed, rows_after,
    removed_pct_of_raw, retention_pct.
    """
    spark = classified.sparkSession
    per_row = classified.select("step_no", F.col("copies").alias("_n"))
    # removed by dedup = copies beyond the first; every distinct row then
    # counts once at the step that removes (or keeps) it
    per_step = per_row.groupBy("step_no").agg(
        F.count(F.lit(1)).alias("distinct_rows"),
        F.sum(F.col("_n") - 1).alias("extra_copies"))
    steps = spark.createDataFrame(
        [(n, s) for n, s in STEPS] + [(KEPT_STEP, "kept")], "step_no int, step string")
    # the step table is the fixed 7-row list above: a bounded broadcast
    joined = (F.broadcast(steps).join(per_step, "step_no", "left")
              .withColumn("n_distinct", per_step.select(F.sum("distinct_rows")).scalar())
              .withColumn("n_dupes", per_step.select(F.sum("extra_copies")).scalar()))
    removed = F.when(F.col("step_no") == 1, F.col("n_dupes")).otherwise(
        F.coalesce(F.col("distinct_rows"), F.lit(0)))
    removed = F.when(F.col("step_no") == KEPT_STEP, F.lit(0)).otherwise(removed)
    w = Window.orderBy("step_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    raw_n = F.col("n_distinct") + F.col("n_dupes")
    out = (joined.withColumn("rows_removed", removed.cast("bigint"))
                 .withColumn("raw_rows", raw_n.cast("bigint"))
                 .withColumn("rows_after", (F.col("raw_rows") - F.sum("rows_removed").over(w)).cast("bigint"))
                 .withColumn("rows_before", (F.col("rows_after") + F.col("rows_removed")).cast("bigint")))
    return out.select(
        "step_no", "step", "rows_before", "rows_removed", "rows_after",
        ratio("rows_removed", "raw_rows", 2, mult=100, half_even=True).alias("removed_pct_of_raw"),
        ratio("rows_after", "raw_rows", 2, mult=100, half_even=True).alias("retention_pct"))


def guest_lines(raw: DataFrame) -> DataFrame:
    """Guest lines as the workflow isolates them: raw rows (no
    de-duplication) without a customer, with positive quantity and price."""
    return (raw.where(F.col("customer_id").isNull()
                      & (F.col("quantity") > 0) & (F.col("price") > 0))
               .withColumn("revenue", line_revenue(F.col("quantity"), F.col("price"))))


def guest_summary(raw: DataFrame) -> DataFrame:
    """C-12: one row: guest rows, total revenue, mean line revenue, date range."""
    g = guest_lines(raw)
    agg = g.agg(F.count(F.lit(1)).alias("guest_rows"),
                F.sum("revenue").alias("_rev"),
                F.min("invoice_ts").alias("first_ts"),
                F.max("invoice_ts").alias("last_ts"))
    return agg.select(
        "guest_rows",
        money(F.coalesce(F.col("_rev"), F.lit(0).cast(schemas.REV4)), 2).alias("guest_revenue"),
        ratio("_rev", "guest_rows", 2, num_scale=4, half_even=True).alias("mean_line_revenue"),
        "first_ts", "last_ts")


def guest_countries(raw: DataFrame, top: int = 10) -> DataFrame:
    """C-12: guest rows per country, top ``top`` by rows (ties by name)."""
    return (guest_lines(raw).groupBy("country").agg(F.count(F.lit(1)).alias("guest_rows"))
            .orderBy(F.desc("guest_rows"), F.asc("country")).limit(top))


def revenue_impact(clean: DataFrame, raw: DataFrame) -> DataFrame:
    """C-13: identified revenue, guest revenue, their total, guest share %."""
    ident = clean.agg(F.sum("revenue").alias("identified"))
    guest = guest_lines(raw).agg(F.sum("revenue").alias("guest"))
    both = one_row(ident, guest).select(
        F.coalesce("identified", F.lit(0).cast(schemas.REV4)).alias("identified"),
        F.coalesce("guest", F.lit(0).cast(schemas.REV4)).alias("guest"))
    both = both.withColumn("total", F.col("identified") + F.col("guest"))
    return both.select(
        money("identified").alias("identified_revenue"),
        money("guest").alias("guest_revenue"),
        money("total").alias("total_revenue"),
        ratio("guest", "total", 2, num_scale=4, den_scale=4, mult=100, half_even=True).alias("guest_pct"))


def revenue_stats(clean_before_floor: DataFrame) -> DataFrame:
    """C-14: line-revenue statistics of the identified rows before the
    near-zero floor (the state the workflow inspects), plus distinct
    customers / invoices / products of the final clean table.
    """
    df = clean_before_floor
    rev = F.col("revenue")
    floor_ok = rev >= F.lit(MIN_REVENUE).cast(schemas.REV4)
    return df.agg(
        F.min(rev).alias("min_revenue"),
        F.max(rev).alias("max_revenue"),
        F.count(F.lit(1)).alias("rows"),
        F.sum(rev).cast("decimal(38,4)").alias("total_revenue"),
        F.count_if(rev == 0).alias("zero_revenue_rows"),
        F.count_if(rev < F.lit("0.01").cast(schemas.REV4)).alias("rows_below_0_01"),
        F.count_if(rev < F.lit("0.10").cast(schemas.REV4)).alias("rows_below_0_10"),
        F.count_distinct(F.when(floor_ok, F.col("customer_id"))).alias("customers"),
        F.count_distinct(F.when(floor_ok, F.col("invoice"))).alias("invoices"),
        F.count_distinct(F.when(floor_ok, F.col("stock_code"))).alias("products"),
    ).select("min_revenue", "max_revenue", "rows", "total_revenue",
             ratio("total_revenue", "rows", 2, num_scale=4).alias("mean_revenue"),
             "zero_revenue_rows", "rows_below_0_01", "rows_below_0_10",
             "customers", "invoices", "products")


def identified_before_floor(raw: DataFrame) -> DataFrame:
    """Rows after steps 1-5 (identified customers, revenue added), before the floor."""
    return identified_from_classified(classify(raw))


def identified_from_classified(classified: DataFrame) -> DataFrame:
    return (classified.where(F.col("step_no") >= 6)
                      .select(*[f.name for f in schemas.RAW_SALES.fields])
                      .withColumn("revenue", line_revenue(F.col("quantity"), F.col("price"))))


def smallest_revenue_lines(clean_before_floor: DataFrame, n: int = 5) -> DataFrame:
    """C-14: the ``n`` lowest-revenue lines (ties by invoice, stock code, time)."""
    return (clean_before_floor.select("invoice", "stock_code", "quantity", "price", "revenue", "invoice_ts")
            .orderBy("revenue", "invoice", "stock_code", "invoice_ts", "quantity", "price").limit(n))
