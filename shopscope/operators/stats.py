"""Significance tests (C-70 ... C-75): pooled two-sample Student t-tests and
a chi-square goodness-of-fit test against a uniform split.

Spark reduces each test to a few exact sums in one conditional aggregate
(n, sum, sum of squares per side) - the data never leaves the executors.
The statistic is then one fixed double expression of those sums (the same
text runs in the SQL oracle) and is reported to 6 places; means and
differences are exact decimals. p-values come from ``tests_summary``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.functions.calendar import is_q4, month_ordinal
from shopscope.functions.distributions import p_value
from shopscope.functions.exact import ratio
from shopscope.plans.summary import one_row

ALPHA = 0.05
# counts as decimals: the product of two BIGINT counts can overflow
WIDE_N1, WIDE_N2 = "CAST(n1 AS DECIMAL(18,0))", "CAST(n2 AS DECIMAL(18,0))"


def t_stat_sql(n1: str, s1: str, q1: str, n2: str, s2: str, q2: str) -> str:
    """Pooled-variance t from counts, sums and sums of squares (SQL text
    valid in Spark SQL and DuckDB)."""
    d = lambda x: f"CAST({x} AS DOUBLE)"
    m1, m2 = f"({d(s1)} / {d(n1)})", f"({d(s2)} / {d(n2)})"
    ss1, ss2 = f"({d(q1)} - {d(s1)} * {m1})", f"({d(q2)} - {d(s2)} * {m2})"
    sp2 = f"(({ss1} + {ss2}) / ({d(n1)} + {d(n2)} - CAST(2 AS DOUBLE)))"
    se = f"sqrt({sp2} * (CAST(1 AS DOUBLE) / {d(n1)} + CAST(1 AS DOUBLE) / {d(n2)}))"
    return f"CAST(({m1} - {m2}) / {se} AS DECIMAL(38,6))"


def two_sample(df: DataFrame, in_first: Column, value: str, scale: int, test: str,
               first: str, second: str) -> DataFrame:
    """One row: sizes, exact means (2 places) and their difference, t, df."""
    v = F.col(value)
    a = df.agg(
        F.count_if(in_first).alias("n1"), F.sum(F.when(in_first, v)).alias("s1"),
        F.sum(F.when(in_first, v * v)).alias("q1"),
        F.count_if(~in_first).alias("n2"), F.sum(F.when(~in_first, v)).alias("s2"),
        F.sum(F.when(~in_first, v * v)).alias("q2"))
    return a.select(
        F.lit(test).alias("test"), F.lit(first).alias("group1"), F.lit(second).alias("group2"),
        "n1", "n2",
        ratio("s1", "n1", 2, num_scale=scale, half_even=True).alias("mean1"),
        ratio("s2", "n2", 2, num_scale=scale, half_even=True).alias("mean2"),
        ratio(f"s1 * {WIDE_N2} - s2 * {WIDE_N1}", f"{WIDE_N1} * {WIDE_N2}", 2, num_scale=scale, half_even=True).alias("mean_difference"),
        F.expr(t_stat_sql("n1", "s1", "q1", "n2", "s2", "q2")).alias("t_stat"),
        (F.col("n1") + F.col("n2") - 2).cast("bigint").alias("df"))


def ttest_champion(rfm: DataFrame) -> DataFrame:
    """C-70: monetary of Champions vs every other customer."""
    return two_sample(rfm, F.coalesce(F.col("segment") == "Champion", F.lit(False)), "monetary", 2,
                      "champion_vs_other_monetary", "Champion", "other")


def _invoice_totals(clean: DataFrame, flag: Column) -> DataFrame:
    """Per-invoice revenue, grouped after the split (as the test defines it)."""
    return (clean.withColumn("_g", flag).groupBy("_g", "invoice")
                 .agg(F.sum("revenue").alias("order_revenue")))


def ttest_country(clean: DataFrame, home: str) -> DataFrame:
    """C-71: per-invoice revenue in the home country vs elsewhere
    (transaction country)."""
    o = _invoice_totals(clean, F.coalesce(F.col("country") == home, F.lit(False)))
    return two_sample(o, F.col("_g"), "order_revenue", 4, "home_vs_other_order_value", home, "other")


def _is_q4(ts: str = "invoice_ts") -> Column:
    return is_q4(F.col(ts))


def ttest_q4_order_value(clean: DataFrame) -> DataFrame:
    """C-73: per-invoice revenue in Q4 months vs other months, plus the Q4
    share of revenue (%)."""
    o = _invoice_totals(clean, _is_q4())
    t = two_sample(o, F.col("_g"), "order_revenue", 4, "q4_vs_other_order_value", "Q4", "other")
    share = clean.agg(F.sum(F.when(_is_q4(), F.col("revenue"))).alias("_q"),
                      F.sum("revenue").alias("_a")).select(
        ratio("coalesce(_q, 0)", "_a", 2, num_scale=4, den_scale=4, mult=100, half_even=True).alias("q4_revenue_pct"))
    return one_row(t, share)


def ttest_q4_monthly(clean: DataFrame) -> DataFrame:
    """C-74: monthly revenue totals of Q4 months vs other months and the Q4
    premium % = (mean Q4 / mean other - 1) x 100."""
    m = (clean.groupBy(month_ordinal(F.col("invoice_ts")).alias("_mo"), _is_q4().alias("_g"))
              .agg(F.sum("revenue").alias("month_revenue")))
    t = two_sample(m, F.col("_g"), "month_revenue", 4, "q4_vs_other_monthly_revenue", "Q4", "other")
    prem = m.agg(F.count_if("_g").alias("n1"), F.sum(F.when(F.col("_g"), F.col("month_revenue"))).alias("s1"),
                 F.count_if(~F.col("_g")).alias("n2"),
                 F.sum(F.when(~F.col("_g"), F.col("month_revenue"))).alias("s2"))
    prem = prem.select(ratio(f"s1 * {WIDE_N2} - s2 * {WIDE_N1}", f"s2 * {WIDE_N1}", 2, num_scale=4, den_scale=4, mult=100,
                             half_even=True).alias("q4_premium_pct"))
    return one_row(t, prem)


def chi2_segment_counts(rfm: DataFrame) -> DataFrame:
    """C-72 listing: observed customers per segment, the uniform expectation
    over the segments present (1 place) and the difference."""
    g = rfm.groupBy("segment").agg(F.count(F.lit(1)).alias("observed"))
    j = (g.withColumn("_n", g.select(F.sum("observed")).scalar())
          .withColumn("_k", g.select(F.count(F.lit(1))).scalar()))
    return j.select("segment", "observed",
                    ratio("_n", "_k", 1, half_even=True).alias("expected"),
                    ratio("CAST(observed AS DECIMAL(18,0)) * _k - _n", "_k", 1, half_even=True).alias("difference"))


def chi2_segments(rfm: DataFrame) -> DataFrame:
    """C-72 statistic: chi2 = k * sum(o^2) / n - n (exact, 4 places), df = k - 1."""
    g = rfm.groupBy("segment").agg(F.count(F.lit(1)).alias("o"))
    return chi2_from_counts(g)


def chi2_from_counts(g: DataFrame) -> DataFrame:
    """The statistic from (segment, o); squares and products are wide decimals."""
    o = F.col("o").cast("decimal(18,0)")
    a = g.agg(F.sum("o").alias("n"), F.count(F.lit(1)).alias("k"), F.sum(o * o).cast("decimal(38,0)").alias("sq"))
    n = "CAST(n AS DECIMAL(18,0))"
    return a.select(F.lit("segment_uniformity").alias("test"), "n", "k",
                    ratio(f"k * sq - {n} * {n}", "n", 4, half_even=True).alias("chi2_stat"),
                    (F.col("k") - 1).cast("bigint").alias("df"))


def tests_summary(rfm: DataFrame, clean: DataFrame, home: str, alpha: float = ALPHA) -> DataFrame:
    """C-75: all five tests with statistic, df, p-value and verdict."""
    rows = [t.select("test", F.lit("t").alias("kind"), F.col("t_stat").alias("statistic"), "df")
            for t in (ttest_champion(rfm), ttest_country(clean, home), ttest_q4_order_value(clean),
                      ttest_q4_monthly(clean))]
    c = chi2_segments(rfm).select("test", F.lit("chi2").alias("kind"),
                                  F.col("chi2_stat").cast("decimal(38,6)").alias("statistic"), "df")
    allr = rows[0]
    for r in rows[1:] + [c]:
        allr = allr.unionByName(r)
    # reported to 6 places, like the statistics
    allr = allr.withColumn("p_value", F.round(p_value(F.col("kind"), F.col("statistic"), F.col("df")), 6))
    return allr.withColumn("significant", F.col("p_value") < F.lit(alpha))
