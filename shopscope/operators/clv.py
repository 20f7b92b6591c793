"""Historical customer lifetime value (C-50 ... C-56).

CLV = AOV x orders x (lifespan_years + 1), with AOV = revenue / orders
(2 places), lifespan in whole elapsed days between first and last line,
years = days / 365 (4 places); all exact decimals, half-even.
Medians are exact: the mean of the two middle values, which
``plans.selection`` finds by counting, without an order of the customers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.functions.calendar import elapsed_days
from shopscope.functions.exact import money_even, ratio
from shopscope.operators.rfm import SEGMENTS, customer_orders
from shopscope.plans.ordering import durable
from shopscope.plans.selection import medians, quantiles
from shopscope.plans.summary import in_order, one_row

HIST_BINS = 50
HIST_QUANTILE = 0.95


def customer_clv(clean: DataFrame) -> DataFrame:
    """C-50: per customer revenue, orders, first/last purchase, AOV,
    lifespan days / years and CLV."""
    return clv_of_orders(customer_orders(clean))


def clv_of_orders(orders: DataFrame) -> DataFrame:
    """C-50 from orders (see ``rfm.customer_orders``)."""
    per = orders.groupBy("customer_id").agg(
        F.sum("order_revenue").alias("_rev"), F.count(F.lit(1)).alias("total_orders"),
        F.min("first_ts").alias("first_purchase"), F.max("last_ts").alias("last_purchase"))
    per = per.select(
        "customer_id", money_even("_rev").alias("total_revenue"), "total_orders",
        "first_purchase", "last_purchase",
        ratio("_rev", "total_orders", 2, num_scale=4, half_even=True).alias("aov"),
        elapsed_days(F.col("first_purchase"), F.col("last_purchase")).cast("bigint").alias("lifespan_days"))
    per = per.withColumn("lifespan_years", ratio("lifespan_days", "365", 4, half_even=True))
    clv = F.col("aov") * F.col("total_orders").cast("decimal(20,0)") * (F.col("lifespan_years") + 1)
    return per.withColumn("clv", money_even(clv))


def _mean(middle: tuple[object, int] | None, places: int) -> Column:
    """The mean of the middle values, given as (sum, number); null where there are none."""
    if middle is None:
        return F.lit(None).cast(f"decimal(38,{places})")
    total, n = middle
    return ratio(f"CAST('{total}' AS DECIMAL(38,2))", f"CAST({n} AS BIGINT)", places, num_scale=2, half_even=True)


def clv_stats(clv: DataFrame) -> DataFrame:
    """C-51: mean AOV, orders, lifespan; min / max / mean / median / total CLV."""
    a = clv.agg(F.count(F.lit(1)).alias("customers"), F.sum("aov").alias("_aov"),
                F.sum("total_orders").alias("_ord"), F.sum("lifespan_years").alias("_yrs"),
                F.min("clv").alias("min_clv"), F.max("clv").alias("max_clv"),
                F.sum("clv").alias("total_clv"))
    a = a.select("customers",
                 ratio("_aov", "customers", 2, num_scale=2, half_even=True).alias("avg_aov"),
                 ratio("_ord", "customers", 2, half_even=True).alias("avg_orders"),
                 ratio("_yrs", "customers", 4, num_scale=4, half_even=True).alias("avg_lifespan_years"),
                 "min_clv", "max_clv",
                 ratio("total_clv", "customers", 2, num_scale=2, half_even=True).alias("mean_clv"),
                 "total_clv")
    return a.withColumn("median_clv", _mean(medians(clv, {"clv": F.col("clv")})["clv"], 3))


def grouped_medians(df: DataFrame, group: str, groups: Sequence[str], value: str) -> dict[str, tuple[object, int] | None]:
    """(sum, number) of the middle values of ``value`` in each of a fixed list of groups, all in the same
    passes; a group with a third of the rows is counted like any other."""
    return medians(df, {g: F.when(F.col(group) == g, F.col(value)) for g in groups})


@in_order("-avg_clv", "segment")
def clv_by_segment(clv: DataFrame, rfm: DataFrame) -> DataFrame:
    """C-52: per segment count, average / median / total CLV, average
    lifespan days and orders."""
    # customers without a segment fall out of the grouping (as in a pandas groupby)
    j = (clv.join(rfm.select("customer_id", "segment"), "customer_id", "left")
            .where(F.col("segment").isNotNull()))
    j = durable(j.select("segment", "clv", "lifespan_days", "total_orders"))  # read by every counting pass
    g = j.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customer_count"), F.sum("clv").alias("total_clv"),
        F.sum("lifespan_days").alias("_days"), F.sum("total_orders").alias("_ord"))
    median = F.lit(None).cast("decimal(38,2)")
    for segment, middle in grouped_medians(j, "segment", SEGMENTS, "clv").items():
        median = F.when(F.col("segment") == segment, _mean(middle, 2)).otherwise(median)
    return g.select(
        "segment", "customer_count",
        ratio("total_clv", "customer_count", 2, num_scale=2, half_even=True).alias("avg_clv"),
        median.alias("median_clv"), "total_clv",
        ratio("_days", "customer_count", 2, half_even=True).alias("avg_lifespan_days"),
        ratio("_ord", "customer_count", 2, half_even=True).alias("avg_orders"))


@in_order("-clv", "customer_id")
def clv_top20(clv: DataFrame, rfm: DataFrame, k: int = 20) -> DataFrame:
    """C-53: the k customers with the highest CLV (ties by id) and their segment."""
    top = clv.orderBy(F.desc("clv"), F.asc("customer_id")).limit(k)
    return top.join(rfm.select("customer_id", "segment"), "customer_id", "left").select(
        "customer_id", "total_revenue", "total_orders", "aov", "lifespan_days", "clv", "segment")


def clv_top20_share(clv: DataFrame, k: int = 20) -> DataFrame:
    """C-53: combined CLV of the top k and its % of total CLV."""
    top = clv.orderBy(F.desc("clv"), F.asc("customer_id")).limit(k).agg(F.sum("clv").alias("top_clv"))
    tot = clv.agg(F.sum("clv").alias("total_clv"))
    return one_row(top, tot).select(
        "top_clv", "total_clv",
        ratio("top_clv", "total_clv", 2, num_scale=2, den_scale=2, mult=100, half_even=True).alias("top_pct"))


@in_order("bin")
def clv_histogram(clv: DataFrame) -> DataFrame:
    """C-54: 50 equal-width bins of CLV over the customers at or below the
    95th percentile; the last bin is closed. Bin = floor((x - lo) * 50 /
    (hi - lo)) in exact integer arithmetic."""
    p95 = quantiles(clv, {"clv": [HIST_QUANTILE]})["clv"][0]
    kept = clv.where(F.col("clv").cast("double") <= F.lit(p95)).select("clv")
    b = (kept.withColumn("lo", kept.select(F.min("clv")).scalar())
             .withColumn("hi", kept.select(F.max("clv")).scalar())).withColumn(
        "bin", F.expr(f"""CASE WHEN hi = lo THEN 0 ELSE least({HIST_BINS - 1},
            CAST((CAST((clv - lo) * 100 AS DECIMAL(38,0)) * {HIST_BINS})
                 div CAST((hi - lo) * 100 AS DECIMAL(38,0)) AS INT)) END"""))
    return b.groupBy("bin", "lo", "hi").agg(F.count(F.lit(1)).alias("customers")).select(
        F.col("bin").cast("int").alias("bin"), "customers",
        F.col("lo").alias("range_low"), F.col("hi").alias("range_high"))


def clv_segment_ratio(clv: DataFrame, rfm: DataFrame) -> DataFrame:
    """C-55: average CLV of Champion over Lost and over At Risk (ratios of
    the rounded averages, 1 place)."""
    j = clv.join(rfm.select("customer_id", "segment"), "customer_id")
    g = j.groupBy("segment").agg(F.sum("clv").alias("_s"), F.count(F.lit(1)).alias("_n"))
    avg = g.select("segment", ratio("_s", "_n", 2, num_scale=2, half_even=True).alias("avg_clv"))
    piv = avg.agg(*[F.max(F.when(F.col("segment") == s, F.col("avg_clv"))).alias(a)
                    for s, a in (("Champion", "champion_avg_clv"), ("Lost", "lost_avg_clv"),
                                 ("At Risk", "at_risk_avg_clv"))])
    return piv.select(
        "champion_avg_clv", "lost_avg_clv", "at_risk_avg_clv",
        ratio("champion_avg_clv", "lost_avg_clv", 1, num_scale=2, den_scale=2, half_even=True).alias("champion_vs_lost"),
        ratio("champion_avg_clv", "at_risk_avg_clv", 1, num_scale=2, den_scale=2, half_even=True).alias("champion_vs_at_risk"))


def recovery_scenario(rfm: DataFrame, guest_revenue: DataFrame, rate: str = "0.20",
                      segment: str = "At Risk") -> DataFrame:
    """C-56: value recoverable at an assumed rate from a segment's revenue
    and from guest revenue (``guest_revenue``: one row with guest_rows and
    guest_revenue). ``members`` is the size of each base: customers of the
    segment, lines of the guest checkouts."""
    seg = rfm.where(F.col("segment") == segment).agg(
        F.count(F.lit(1)).alias("members"), F.sum("monetary").alias("base_value"))
    seg = seg.select(F.lit(f"{segment} customers").alias("scenario"), "members",
                     F.coalesce("base_value", F.lit(0)).cast("decimal(38,2)").alias("base_value"))
    gst = guest_revenue.select(F.lit("guest checkouts").alias("scenario"),
                               F.col("guest_rows").cast("bigint").alias("members"),
                               F.col("guest_revenue").cast("decimal(38,2)").alias("base_value"))
    both = seg.unionByName(gst)
    r = F.lit(rate).cast("decimal(5,4)")
    return both.select("scenario", "members", "base_value", r.alias("assumed_rate"),
                       F.round(F.col("base_value") * r, 2).cast("decimal(38,2)").alias("recoverable_value"))
