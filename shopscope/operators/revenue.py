"""Revenue trends, geography and concentration on the cleaned lines
(C-40 ... C-49). Rounding is half-even (the analysis layer's rule), every
ratio exact.

Customer- and product-level cumulative shares use the bucketed global
order (``plans.ordering``), so a ranking over millions of customers never
runs as one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.functions.calendar import month_ordinal, ordinal_label
from shopscope.functions.exact import money_even, ratio
from shopscope.operators.cells import rolled_up
from shopscope.plans.marks import first_rows
from shopscope.plans.ordering import durable, global_order
from shopscope.plans.star import FIRST_ORDER
from shopscope.plans.summary import one_row

PARETO_SHARE = 80
# Slices of the concentration table as (entity, slice, numerator, denominator, side).
SLICES = [("customers", "top_10pct", 1, 10, "top"), ("customers", "top_20pct", 1, 5, "top"),
          ("customers", "bottom_50pct", 1, 2, "bottom"), ("products", "top_10pct", 1, 10, "top")]


def _orders(clean: DataFrame, *keys: str) -> DataFrame:
    return clean.groupBy(*keys, "invoice", "customer_id").agg(F.sum("revenue").alias("_rev"))


def monthly_summary(clean: DataFrame) -> DataFrame:
    """C-40: revenue, orders, customers and average order value per month."""
    o = _orders(clean.withColumn("_mo", month_ordinal(F.col("invoice_ts"))), "_mo")
    g = o.groupBy("_mo").agg(F.sum("_rev").alias("_rev"),
                             F.count_distinct("invoice").alias("orders"),
                             F.count_distinct("customer_id").alias("customers"))
    return g.select(ordinal_label(F.col("_mo")).alias("year_month"),
                    money_even("_rev").alias("revenue"), "orders", "customers",
                    ratio("_rev", "orders", 2, num_scale=4, half_even=True).alias("aov"))


def month_extremes(clean: DataFrame) -> DataFrame:
    """C-41: best and worst month, mean monthly revenue, unweighted mean of
    the monthly AOVs."""
    m = monthly_summary(clean)
    best = m.orderBy(F.desc("revenue"), F.asc("year_month")).limit(1).select(
        F.col("year_month").alias("best_month"), F.col("revenue").alias("best_revenue"))
    worst = m.orderBy(F.asc("revenue"), F.asc("year_month")).limit(1).select(
        F.col("year_month").alias("worst_month"), F.col("revenue").alias("worst_revenue"))
    means = m.agg(F.sum("revenue").alias("_r"), F.sum("aov").alias("_a"),
                  F.count(F.lit(1)).alias("months")).select(
        "months", ratio("_r", "months", 2, num_scale=2, half_even=True).alias("mean_monthly_revenue"),
        ratio("_a", "months", 2, num_scale=2, half_even=True).alias("mean_monthly_aov"))
    return one_row(best, worst, means)


def _country_table(clean: DataFrame) -> DataFrame:
    o = _orders(clean, "country")
    g = o.groupBy("country").agg(F.sum("_rev").alias("_rev"),
                                 F.count_distinct("invoice").alias("orders"),
                                 F.count_distinct("customer_id").alias("customers"))
    g = g.withColumn("revenue", money_even("_rev"))
    g = g.withColumn("_all", g.select(F.sum("revenue")).scalar())
    return g.withColumn("revenue_pct",
                        ratio("revenue", "_all", 2, num_scale=2, den_scale=2, mult=100, half_even=True))


def country_summary(clean: DataFrame, top: int = 15) -> DataFrame:
    """C-42: by the transaction's country; top ``top`` by revenue."""
    t = _country_table(clean)
    return (t.orderBy(F.desc("revenue"), F.asc("country")).limit(top)
             .select("country", "revenue", "orders", "customers", "revenue_pct"))


def home_vs_abroad(clean: DataFrame, home: str) -> DataFrame:
    """C-43: revenue and % inside / outside the home country (sums of the
    per-country rounded figures, as the country table shows them)."""
    t = _country_table(clean)
    is_home = F.col("country") == home
    return t.agg(
        F.lit(home).alias("home_country"),
        F.coalesce(F.sum(F.when(is_home, F.col("revenue"))), F.lit(0)).alias("home_revenue"),
        F.coalesce(F.sum(F.when(is_home, F.col("revenue_pct"))), F.lit(0)).alias("home_pct"),
        F.coalesce(F.sum(F.when(~is_home, F.col("revenue"))), F.lit(0)).alias("other_revenue"),
        F.coalesce(F.sum(F.when(~is_home, F.col("revenue_pct"))), F.lit(0)).alias("other_pct"))


def _pareto(per_entity: DataFrame, key: str) -> DataFrame:
    per_entity = durable(per_entity)  # read by the totals and the ordering
    o = global_order(per_entity, [("revenue", False), (key, True)], running="revenue", rows=per_entity.count())
    all_of_it = per_entity.select(F.struct(F.sum("revenue").alias("tot"), F.count(F.lit(1)).alias("n"))).scalar()
    return (o.withColumn("_all", all_of_it).withColumn("_tot", F.col("_all.tot")).withColumn("_n", F.col("_all.n")).drop("_all")
             .withColumnRenamed("_rn", "rank").withColumnRenamed("_cum", "cumulative_revenue")
             .withColumn("cumulative_pct", ratio("cumulative_revenue", "_tot", 4, num_scale=4,
                                                 den_scale=4, mult=100, half_even=True))
             .withColumn("rank_pct", ratio("rank", "_n", 4, mult=100, half_even=True)))


def customer_revenue(clean: DataFrame) -> DataFrame:
    return clean.groupBy("customer_id").agg(F.sum("revenue").cast("decimal(38,4)").alias("revenue"))


def product_revenue(clean: DataFrame) -> DataFrame:
    """Per stock code: revenue, units and the first non-null description."""
    sums = clean.groupBy("stock_code").agg(
        F.sum("revenue").cast("decimal(38,4)").alias("revenue"),
        F.sum("quantity").cast("bigint").alias("quantity"))
    first = first_rows(clean.where("description is not null"), "stock_code", "description", FIRST_ORDER)
    on = F.col("s.stock_code").eqNullSafe(F.col("f.stock_code"))
    return sums.alias("s").join(first.alias("f"), on, "left").select("s.stock_code", "revenue", "quantity", "description")


def customer_pareto(clean: DataFrame) -> DataFrame:
    """C-44: customers by revenue desc with cumulative revenue and %."""
    p = _pareto(customer_revenue(clean), "customer_id")
    return p.select("customer_id", "revenue", "rank", "cumulative_revenue", "cumulative_pct", "rank_pct")


def product_pareto(clean: DataFrame) -> DataFrame:
    """C-47: products by revenue desc with units, first description and cumulative %."""
    p = _pareto(product_revenue(clean), "stock_code")
    return p.select("stock_code", "description", "revenue", "quantity", "rank",
                    "cumulative_revenue", "cumulative_pct", "rank_pct")


def pareto_cutoff(clean: DataFrame) -> DataFrame:
    """C-45 from the cleaned lines (see :func:`pareto_cutoff_from`)."""
    return pareto_cutoff_from(customer_pareto(clean), product_pareto(clean))


def pareto_cutoff_from(customers: DataFrame, products: DataFrame) -> DataFrame:
    """C-45: smallest rank whose rounded cumulative % reaches 80, for
    customers and for products, and that rank's share of the entities."""
    parts = []
    for entity, p in (("customers", customers), ("products", products)):
        parts.append(p.agg(F.lit(entity).alias("entity"),
                           F.min(F.when(F.col("cumulative_pct") >= PARETO_SHARE, F.col("rank"))).alias("cutoff_rank"),
                           F.count(F.lit(1)).alias("entities")))
    both = parts[0].unionByName(parts[1])
    return both.withColumn("share_pct", ratio("cutoff_rank", "entities", 2, mult=100, half_even=True))


def top_bottom_share(clean: DataFrame) -> DataFrame:
    """C-46 from the cleaned lines (see :func:`top_bottom_share_from`)."""
    return top_bottom_share_from(customer_pareto(clean), product_pareto(clean))


def top_bottom_share_from(customers: DataFrame, products: DataFrame) -> DataFrame:
    """C-46: revenue held by the top 10 % / 20 % and bottom 50 % of customers
    and the top 10 % of products (member counts truncated: floor(n * p))."""
    out = None
    for entity, p in (("customers", customers), ("products", products)):
        of = [(name, num, den, side) for e, name, num, den, side in SLICES if e == entity]
        counted = p.withColumn("_nn", p.select(F.count(F.lit(1))).scalar())
        sums = []
        for i, (_, num, den, side) in enumerate(of):
            inside = F.expr(f"rank <= _nn * {num} div {den}" if side == "top" else f"rank > _nn - _nn * {num} div {den}")
            sums.append(F.coalesce(F.sum(F.when(inside, F.col("revenue"))), F.lit(0)).alias(f"_r{i}"))
        # one conditional aggregate per entity, then one row per slice
        one = counted.agg(F.count(F.lit(1)).alias("_n"), F.sum("revenue").alias("_tot"), *sums)
        slices = F.explode(F.array(*[F.struct(
            F.lit(i).alias("no"), F.lit(name).alias("slice"), F.expr(f"_n * {num} div {den}").cast("bigint").alias("members"),
            F.col(f"_r{i}").cast("decimal(38,4)").alias("_r")) for i, (name, num, den, _) in enumerate(of)])).alias("s")
        rows = one.select("_tot", slices).select(
            F.lit(entity).alias("entity"), "s.slice", "s.members", money_even("s._r").alias("revenue"),
            ratio("s._r", "_tot", 2, num_scale=4, den_scale=4, mult=100, half_even=True).alias("revenue_pct"))
        out = rows if out is None else out.unionByName(rows)
    return out


def overall_kpis(clean: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """C-48: total revenue, orders, customers, AOV = total / orders. ``cells``: bitmaps that give the
    distinct counts (``operators.cells``), so that lines are only summed."""
    if cells is None:
        a = clean.agg(F.sum("revenue").alias("_rev"), F.count_distinct("invoice").alias("orders"),
                      F.count_distinct("customer_id").alias("customers"))
    else:
        counts = rolled_up(cells).select(F.col("total_orders").alias("orders"), F.col("unique_customers").alias("customers"))
        a = one_row(clean.agg(F.sum("revenue").alias("_rev")), counts)
    return a.select(money_even("_rev").alias("total_revenue"), "orders", "customers",
                    ratio("_rev", "orders", 2, num_scale=4, half_even=True).alias("aov"))


# Stock codes that book non-product revenue (manual entries, postage).
NON_PRODUCT_CODES = ["M", "POST"]


def non_product_codes(clean: DataFrame, codes: list[str] = NON_PRODUCT_CODES) -> DataFrame:
    """C-49: revenue booked on non-product codes (flagged, kept in totals)."""
    hits = (clean.where(F.col("stock_code").isin(codes))
                 .groupBy("stock_code").agg(F.sum("revenue").alias("_rev"), F.count(F.lit(1)).alias("lines")))
    codes_df = clean.sparkSession.createDataFrame([(c,) for c in codes], "stock_code string")
    return (F.broadcast(codes_df).join(hits, "stock_code", "left")
            .select("stock_code", money_even(F.coalesce(F.col("_rev"), F.lit(0))).alias("revenue"),
                    F.coalesce(F.col("lines"), F.lit(0)).cast("bigint").alias("lines")))
