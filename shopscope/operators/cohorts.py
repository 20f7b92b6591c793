"""Monthly acquisition cohorts on the cleaned lines (C-30 ... C-35).

The long form (cohort month, cohort index, customers, rate) is canonical;
the wide matrix is an explicit-values pivot of it. Averages "over cohorts"
skip missing cells, i.e. they average the rates that exist.

Plan: one bitset of active months per customer (``operators.activity``), the
only shuffle that lines take part in; cohort cells are read off the bitsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.functions.calendar import month_ordinal, ordinal_label
from shopscope.functions.exact import ratio
from shopscope.operators.activity import active_months, activity, cohort_cells
from shopscope.plans.summary import one_row

MILESTONES = [1, 3, 6, 12]


def _bitsets(clean: DataFrame | None, bitsets: DataFrame | None) -> DataFrame:
    return bitsets if bitsets is not None else activity(clean, month_ordinal(F.col("invoice_ts")))


def cohort_assign(clean: DataFrame, *, bitsets: DataFrame | None = None) -> DataFrame:
    """C-30: every line with invoice month, cohort month and cohort index."""
    lines = clean.withColumn("_mo", month_ordinal(F.col("invoice_ts")))
    first = active_months(_bitsets(clean, bitsets)).select("customer_id", F.col("cohort_mo").alias("_cmo"))
    out = lines.join(first, "customer_id")
    return out.select("invoice", "stock_code", "customer_id", "invoice_ts",
                      ordinal_label(F.col("_mo")).alias("invoice_month"),
                      ordinal_label(F.col("_cmo")).alias("cohort_month"),
                      (F.col("_mo") - F.col("_cmo")).cast("int").alias("cohort_index"))


def cohort_counts(clean: DataFrame | None, *, bitsets: DataFrame | None = None) -> DataFrame:
    """C-31: distinct customers by (cohort month, cohort index)."""
    return _cohort_counts(clean, bitsets).drop("_cmo")


def _cohort_counts(clean: DataFrame | None, bitsets: DataFrame | None) -> DataFrame:
    g = cohort_cells(_bitsets(clean, bitsets))
    return g.select(ordinal_label(F.col("cohort_mo")).alias("cohort_month"),
                    F.col("cohort_index").cast("int").alias("cohort_index"), "customers", F.col("cohort_mo").alias("_cmo"))


def cohort_retention_matrix(clean: DataFrame | None, *, bitsets: DataFrame | None = None) -> DataFrame:
    """C-32 (long form): customers / cohort size, 3 places half-even.
    Cells that do not exist stay absent (the wide form shows them as null)."""
    c = _cohort_counts(clean, bitsets)
    size = c.where(F.col("cohort_index") == 0).select("_cmo", F.col("customers").alias("cohort_size"))
    return (c.join(size, "_cmo")
             .select("cohort_month", "cohort_index", "customers", "cohort_size",
                     ratio("customers", "cohort_size", 3, half_even=True).alias("retention_rate")))


def _matrix(clean: DataFrame | None, matrix: DataFrame | None) -> DataFrame:
    return matrix if matrix is not None else cohort_retention_matrix(clean)


def _months_spanned(matrix: DataFrame) -> int:
    """Months from the first cohort to the last activity, from one aggregate over the cells."""
    cohort = F.substring("cohort_month", 1, 4).cast("int") * 12 + F.substring("cohort_month", 6, 2).cast("int")
    return matrix.agg(F.max(cohort + F.col("cohort_index")) - F.min(cohort)).first()[0] or 0


def cohort_retention_wide(clean: DataFrame | None, max_index: int | None = None, *,
                          matrix: DataFrame | None = None) -> DataFrame:
    """C-32 (wide form): one row per cohort, one column per cohort index;
    missing cells null. There are as many columns as the history has months,
    unless ``max_index`` gives the last one; an index beyond that is an error."""
    long = _matrix(clean, matrix)
    if max_index is None:
        max_index = _months_spanned(long)
    else:
        index = F.col("cohort_index")
        beyond = F.raise_error(F.concat(F.lit(f"cohort index above {max_index}: "), index.cast("string")))
        long = long.withColumn("cohort_index", F.when(index > max_index, beyond.cast(long.schema["cohort_index"].dataType)).otherwise(index))
    return (long.groupBy("cohort_month").pivot("cohort_index", list(range(max_index + 1)))
                .agg(F.max("retention_rate")))


def avg_retention_curve(clean: DataFrame | None, *, matrix: DataFrame | None = None) -> DataFrame:
    """C-35: mean rate x 100 per cohort index over the cohorts that have it
    (mean of the rounded rates, 2 places half-even)."""
    m = _matrix(clean, matrix)
    g = m.groupBy("cohort_index").agg(F.sum("retention_rate").alias("_s"),
                                      F.count("retention_rate").alias("cohorts"))
    return g.select("cohort_index", "cohorts",
                    ratio("_s", "cohorts", 2, num_scale=3, mult=100, half_even=True).alias("avg_retention_pct"))


def cohort_milestones(clean: DataFrame | None, *, matrix: DataFrame | None = None) -> DataFrame:
    """C-33: one row: average retention % at indexes 1, 3, 6, 12; best and
    worst cohort at index 1; cohorts; customers; largest / smallest cohort;
    mean over indexes 1..12 of the per-index mean rates.

    Per-index means are exact ratios of the rounded rates (6 places, then the
    mean of those means to 2 places), so the figure does not depend on
    summation order. Every part is a one-row aggregate; ``one_row`` puts
    them side by side.
    """
    m = _matrix(clean, matrix)
    idx1 = m.where(F.col("cohort_index") == 1)
    best = idx1.orderBy(F.desc("retention_rate"), F.asc("cohort_month")).limit(1).select(
        F.col("cohort_month").alias("best_month1_cohort"), F.col("retention_rate").alias("best_month1_rate"))
    worst = idx1.orderBy(F.asc("retention_rate"), F.asc("cohort_month")).limit(1).select(
        F.col("cohort_month").alias("worst_month1_cohort"), F.col("retention_rate").alias("worst_month1_rate"))
    sizes = m.where(F.col("cohort_index") == 0).agg(
        F.count(F.lit(1)).alias("cohorts"), F.sum("cohort_size").alias("customers"),
        F.max("cohort_size").alias("largest_cohort_size"), F.min("cohort_size").alias("smallest_cohort_size"))
    mil = m.agg(*[F.sum(F.when(F.col("cohort_index") == i, F.col("retention_rate"))).alias(f"_s{i}")
                  for i in MILESTONES],
                *[F.count(F.when(F.col("cohort_index") == i, F.col("retention_rate"))).alias(f"_c{i}")
                  for i in MILESTONES])
    mil = mil.select(*[ratio(f"_s{i}", f"_c{i}", 2, num_scale=3, mult=100, half_even=True)
                       .alias(f"avg_month{i}_pct") for i in MILESTONES])
    per_idx = (m.where(F.col("cohort_index").between(1, 12)).groupBy("cohort_index")
                .agg(F.sum("retention_rate").alias("_s"), F.count("retention_rate").alias("_c"))
                .select(ratio("_s", "_c", 6, num_scale=3, mult=100).alias("_mean")))
    long_term = (per_idx.agg(F.sum("_mean").alias("_s"), F.count("_mean").alias("_c"))
                 .select(ratio("_s", "_c", 2, num_scale=6, half_even=True).alias("avg_month1_12_pct")))
    return one_row(sizes, best, worst, mil, long_term)


def cohort_curve(clean: DataFrame | None, cohort_month: str | None = None, *,
                 matrix: DataFrame | None = None) -> DataFrame:
    """C-34: one cohort's rates by index (default: the first cohort), with
    a flag on its peak index after acquisition (ties: earliest index)."""
    m = _matrix(clean, matrix)
    target = F.lit(cohort_month) if cohort_month else m.select(F.min("cohort_month")).scalar()
    c = m.where(F.col("cohort_month") == target)
    peak = (c.where(F.col("cohort_index") > 0)
             .orderBy(F.desc("retention_rate"), F.asc("cohort_index")).limit(1)
             .select("cohort_index").scalar())
    return c.select("cohort_month", "cohort_index", "retention_rate",
                    F.coalesce(F.col("cohort_index") == peak, F.lit(False)).alias("is_peak"))
