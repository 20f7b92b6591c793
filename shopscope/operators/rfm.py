"""Recency / frequency / monetary segmentation (C-20 ... C-26).

Scores follow the equal-frequency (quintile) binning rule:
  * recency and monetary: edges = 20/40/60/80 % quantiles (linear
    interpolation); a value's bin is the number of edges strictly below it
    (right-closed bins, ties share a bin). R = 5 - bin, M = 1 + bin.
  * frequency: binned on its row number rk in (frequency, customer_id)
    order, which gives F = max(1, ceil(5 (rk - 1) / (n - 1))).
Both need only the values (the rows, for frequency) at four places, which
``plans.selection`` finds by counting; a row is then scored by comparison.
Segments are one CASE expression (first matching rule wins) - no Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope import schemas
from shopscope.functions.exact import money_even, ratio
from shopscope.plans.ordering import durable
from shopscope.plans.selection import Rank, at_ranks, order_statistics, quantiles
from shopscope.plans.summary import in_order

QUINTILES = [0.2, 0.4, 0.6, 0.8]

# The segment labels, in the order in which their rules are checked.
SEGMENTS = ["Champion", "Loyal Customer", "New Customer", "Potential Loyalist", "At Risk", "Needs Attention",
            "Lost", "Promising", "About to Sleep", "Hibernating"]


def segment_expr(r: Column, f: Column, m: Column, total: Column) -> Column:
    """The label of the first rule that holds."""
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), "Champion")
            .when((r >= 3) & (f >= 3) & (m >= 4), "Loyal Customer")
            .when((r >= 4) & (f <= 2), "New Customer")
            .when((r >= 3) & (f >= 3) & (m >= 3), "Potential Loyalist")
            .when((r <= 2) & (f >= 4) & (m >= 4), "At Risk")
            .when((r <= 2) & (f >= 3) & (m >= 3), "Needs Attention")
            .when((r == 1) & (f <= 2) & (m <= 2), "Lost")
            .when(total >= 9, "Promising")
            .when(total >= 6, "About to Sleep")
            .otherwise("Hibernating"))


def customer_orders(clean: DataFrame) -> DataFrame:
    """One row per (customer, invoice): order revenue and last line time.

    Aggregating lines to orders first keeps every later per-customer
    aggregate skew-safe: a customer with a third of all lines still
    pre-aggregates map-side.
    """
    return (clean.groupBy("customer_id", "invoice")
                 .agg(F.sum("revenue").alias("order_revenue"),
                      F.min("invoice_ts").alias("first_ts"),
                      F.max("invoice_ts").alias("last_ts")))


def rfm_base(clean: DataFrame) -> DataFrame:
    """C-20: customer_id, recency (whole elapsed days to max(ts) + 1 day),
    frequency (distinct invoices), monetary (revenue rounded to 2 places)."""
    return base_of_orders(customer_orders(clean))


def base_of_orders(orders: DataFrame) -> DataFrame:
    """C-20 from orders (see ``customer_orders``)."""
    ref_ts = orders.select(F.max("last_ts") + F.expr("INTERVAL 1 DAY")).scalar()
    per_cust = (orders.groupBy("customer_id")
                .agg(F.max("last_ts").alias("_last_ts"),
                     F.count(F.lit(1)).alias("frequency"),
                     F.sum("order_revenue").alias("_rev")))
    return (per_cust.withColumn("_ref_ts", ref_ts)  # scalar subquery, computed once
            .select("customer_id",
                    F.timestamp_diff("DAY", F.col("_last_ts"), F.col("_ref_ts")).cast("int").alias("recency"),
                    F.col("frequency").cast("bigint").alias("frequency"),
                    money_even("_rev", 2, 18).alias("monetary")))


def _bin(value: Column, edges: Sequence[float | None]) -> Column:
    """Number of quantile edges strictly below ``value`` (0..4)."""
    v = value.cast("double")
    return sum(F.when(F.lit(e) < v, 1).otherwise(0) for e in edges)


def _frequency_borders(base: DataFrame) -> list[tuple[int, int]]:
    """(frequency, customer_id) of the last row of each of the four lower frequency scores."""
    def last(k: int) -> Rank:
        return Rank(k / 5, lambda n: [k * (n - 1) // 5 + 1])

    return at_ranks(base, "frequency", "customer_id", [last(k) for k in (1, 2, 3, 4)])[1]


def rfm_scores(base: DataFrame) -> DataFrame:
    """C-21: add r_score, f_score, m_score, rfm_score, rfm_total."""
    # the per-customer table is counted several times: materialise it once
    # instead of re-aggregating the lines
    base = durable(base.select("customer_id", "recency", "frequency", "monetary"))
    edges = quantiles(base, {"recency": QUINTILES, "monetary": QUINTILES})
    beyond = [(F.col("frequency") > f) | ((F.col("frequency") == f) & (F.col("customer_id") > c)) for f, c in _frequency_borders(base)]
    scored = base.select(
        "customer_id", "recency", "frequency", "monetary",
        (F.lit(5) - _bin(F.col("recency"), edges["recency"])).cast("int").alias("r_score"),
        sum([F.when(b, 1).otherwise(0) for b in beyond], F.lit(1)).cast("int").alias("f_score"),
        (F.lit(1) + _bin(F.col("monetary"), edges["monetary"])).cast("int").alias("m_score"))
    return scored.select(
        "*",
        F.concat(F.col("r_score").cast("string"), F.col("f_score").cast("string"),
                 F.col("m_score").cast("string")).alias("rfm_score"),
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).cast("int").alias("rfm_total"))


def rfm_segments(clean: DataFrame) -> DataFrame:
    """C-22: the full segment table (schema ``schemas.RFM_SEGMENTS``)."""
    scored = rfm_scores(rfm_base(clean))
    seg = segment_expr(F.col("r_score"), F.col("f_score"), F.col("m_score"), F.col("rfm_total"))
    return scored.select(*[f.name for f in schemas.RFM_SEGMENTS.fields[:-1]], seg.alias("segment"))


@in_order("-customer_count", "segment")
def segment_distribution(rfm: DataFrame) -> DataFrame:
    """C-23: customers and % of customers per segment (half-even, 2 places)."""
    counts = rfm.groupBy("segment").agg(F.count(F.lit(1)).alias("customer_count"))
    return (counts.withColumn("_n", rfm.select(F.count(F.lit(1))).scalar())
            .select("segment", "customer_count",
                    ratio("customer_count", "_n", 2, mult=100, half_even=True).alias("customer_pct")))


@in_order("-total_revenue", "segment")
def segment_revenue(rfm: DataFrame) -> DataFrame:
    """C-24: per segment count, total/mean monetary, mean recency and
    frequency (2 places, half-even) and revenue % of the summed totals."""
    g = rfm.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("monetary").alias("total_revenue"),
        F.sum("recency").alias("_rec"),
        F.sum("frequency").alias("_freq"))
    return (g.withColumn("_all", g.select(F.sum("total_revenue")).scalar()).select(
        "segment", "customer_count",
        money_even("total_revenue", 2).alias("total_revenue"),
        ratio("total_revenue", "customer_count", 2, num_scale=2, half_even=True).alias("avg_revenue"),
        ratio("_rec", "customer_count", 2, half_even=True).alias("avg_recency"),
        ratio("_freq", "customer_count", 2, half_even=True).alias("avg_frequency"),
        ratio("total_revenue", "_all", 2, num_scale=2, den_scale=2, mult=100,
              half_even=True).alias("revenue_pct")))


DESCRIBE_MEASURES = ["recency", "frequency", "monetary", "r_score", "f_score", "m_score"]


def std_sql(n: str, s: str, q: str) -> str:
    """Sample standard deviation from count, sum and sum of squares (SQL
    text valid in Spark SQL and DuckDB), reported to 6 places."""
    d = lambda x: f"CAST({x} AS DOUBLE)"
    return (f"CAST(CASE WHEN {n} > 1 THEN sqrt(greatest(({d(q)} - {d(s)} * {d(s)} / {d(n)}) "
            f"/ ({d(n)} - CAST(1 AS DOUBLE)), CAST(0 AS DOUBLE))) END AS DECIMAL(38,6))")


def rfm_describe(rfm: DataFrame) -> DataFrame:
    """C-25: count, mean, sample std, min, quartiles, max of the R/F/M values
    and scores, one row per measure.

    Each measure is one set of exact sums of a single aggregate. Quartiles are
    exact (linear interpolation at (n - 1) p, in decimals) between the two
    neighbouring values, which counting passes find for all measures together.
    """
    dec = "decimal(38,4)"
    values = {m: F.col(m).cast(dec) for m in DESCRIBE_MEASURES}
    aggs = []
    for i, v in enumerate(values.values()):
        # squares counted per value would need a shuffle of all values; sums of squares need none
        aggs += [F.count(v).alias(f"n{i}"), F.sum(v).cast(dec).alias(f"s{i}"), F.sum(v * v).alias(f"q{i}"), F.min(v).alias(f"a{i}"), F.max(v).alias(f"z{i}")]
    stack = ", ".join(f"{i}, n{i}, s{i}, q{i}, a{i}, z{i}" for i in range(len(values)))
    sums = rfm.agg(*aggs).selectExpr(f"stack({len(values)}, {stack}) AS (no, _n, _s, _q, min, max)").where("_n > 0")
    places = {k: Rank(k / 4, lambda n, k=k: sorted({(n - 1) * k // 4 + 1, ((n - 1) * k + 3) // 4 + 1})) for k in (1, 2, 3)}
    found = order_statistics(rfm, {m: (v, list(places.values())) for m, v in values.items()})

    def quartile(k: int) -> Column:
        out = F.lit(None).cast(dec)
        for i, m in enumerate(DESCRIBE_MEASURES):
            n, at = found[m]
            if at:
                at = [at[k - 1][r].value for r in places[k].of(n)]
                part = F.lit((n - 1) * k % 4).cast("decimal(2,0)") * F.lit("0.25").cast("decimal(3,2)")
                lo, hi = F.lit(at[0]).cast(dec), F.lit(at[-1]).cast(dec)
                out = F.when(F.col("no") == i, (lo + (hi - lo) * part).cast(dec)).otherwise(out)
        return out.alias(f"p{25 * k}")

    return (sums.orderBy("no").select(
        F.element_at(F.array(*map(F.lit, DESCRIBE_MEASURES)), F.col("no") + 1).alias("measure"), F.col("_n").alias("count"),
        ratio("_s", "_n", 6, num_scale=4, half_even=True).alias("mean"),
        F.expr(std_sql("_n", "_s", "_q")).alias("std"),
        "min", *[quartile(k) for k in (1, 2, 3)], "max"))


def rfm_scatter_points(rfm: DataFrame) -> DataFrame:
    """C-26: chart data: recency, monetary, segment, marker size = 3 x frequency."""
    return rfm.select("customer_id", "recency", "monetary", "segment",
                      (F.col("frequency") * 3).cast("bigint").alias("marker_size"))
