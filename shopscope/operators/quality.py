"""Data-quality audit of raw sales lines (C-01 ... C-07).

Every audit counts on the raw rows as loaded (no de-duplication) and each
rule is counted independently. All rule counts come from one conditional
aggregate (one scan); percentages are exact, half-even, 2 places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.functions.calendar import elapsed_days
from shopscope.functions.exact import ratio
from shopscope.operators.cleaning import is_cancellation
from shopscope.plans.marks import repeated_rows

# Audit rule names in report order.
RULES = ["null_customer", "cancellation", "negative_quantity", "non_positive_price",
         "negative_quantity_without_c", "null_description", "duplicate_rows"]


def dq_profile(raw: DataFrame) -> DataFrame:
    """Rows, columns and declared type of each column (one row per column)."""
    n = raw.select(F.count(F.lit(1))).scalar()
    spark = raw.sparkSession
    cols = spark.createDataFrame([(i, f.name, f.dataType.simpleString())
                                  for i, f in enumerate(raw.schema.fields)],
                                 "position int, column_name string, data_type string")
    return cols.withColumn("total_rows", n).withColumn("total_columns", F.lit(len(raw.columns)))


# total order of raw lines for display samples
SAMPLE_ORDER = ["invoice", "invoice_ts", "stock_code", "quantity", "price", "customer_id",
                "country", "description"]


def dq_sample_rows(raw: DataFrame, n: int = 3) -> DataFrame:
    """C-01 / P-16: the first ``n`` raw rows in invoice order (a display
    sample: distributed top-k, no full sort)."""
    return raw.orderBy(*[F.col(c).asc_nulls_first() for c in SAMPLE_ORDER]).limit(n)


def dq_null_audit(raw: DataFrame) -> DataFrame:
    """C-01: per column null count and % of rows, from a single aggregate."""
    cols = raw.columns
    agg = raw.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', {i}, n{i}" for i, c in enumerate(cols))
    long = agg.selectExpr("_n", f"stack({len(cols)}, {stack}) AS (column_name, position, null_count)")
    return long.select("position", "column_name", "null_count",
                       ratio("null_count", "_n", 2, mult=100, half_even=True).alias("null_pct"),
                       F.col("_n").alias("total_rows"))


def _suspicious(df: DataFrame) -> Column:
    return F.coalesce(F.col("quantity") < 0, F.lit(False)) & ~is_cancellation(F.col("invoice"))


def dq_rule_counts(raw: DataFrame, classified: DataFrame | None = None) -> DataFrame:
    """C-02: rows matching each rule, counted independently on raw rows.
    ``classified`` (distinct rows, see ``cleaning.classify``) avoids a second
    de-duplication when it is already materialised."""
    again = dq_duplicates(raw, classified).select(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))).scalar()
    agg = raw.agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customer"),
        F.count_if(is_cancellation(F.col("invoice"))).alias("cancellation"),
        F.count_if(F.col("quantity") < 0).alias("negative_quantity"),
        F.count_if(F.col("price") <= 0).alias("non_positive_price"),
        F.count_if(_suspicious(raw)).alias("negative_quantity_without_c"),
        F.count_if(F.col("description").isNull()).alias("null_description"),
    ).withColumn("duplicate_rows", again.cast("bigint"))
    stack = ", ".join(f"'{r}', {i}, {r}" for i, r in enumerate(RULES))
    long = agg.selectExpr("_n", f"stack({len(RULES)}, {stack}) AS (rule, rule_no, rows)")
    return long.select("rule_no", "rule", F.col("rows").cast("bigint").alias("rows"),
                       ratio("rows", "_n", 2, mult=100, half_even=True).alias("pct_of_total"))


def dq_duplicates(raw: DataFrame, classified: DataFrame | None = None) -> DataFrame:
    """C-03: every duplicated raw row with its number of copies
    (copies - 1 of them are removed by de-duplication). From raw rows, only
    those whose fingerprint repeats are shuffled."""
    g = classified.drop("step_no") if classified is not None else repeated_rows(raw, raw.columns)[1]
    return g.where(F.col("copies") > 1)


def dq_duplicate_sample(raw: DataFrame, classified: DataFrame | None = None, n: int = 6) -> DataFrame:
    """C-03: the first ``n`` members of duplicate groups by invoice (every
    copy is a member; groups are expanded back to their copies)."""
    dups = dq_duplicates(raw, classified)
    members = dups.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return (members.orderBy(*[F.col(c).asc_nulls_first() for c in SAMPLE_ORDER], "_copy")
                   .limit(n).drop("_copy", "copies"))


def dq_prefix_counts(raw: DataFrame) -> DataFrame:
    """C-04: first character of the invoice among negative-quantity rows
    whose invoice does not start with 'C'."""
    return (raw.where(_suspicious(raw))
               .groupBy(F.substring(F.col("invoice").cast("string"), 1, 1).alias("invoice_prefix"))
               .agg(F.count(F.lit(1)).alias("rows")))


def dq_date_range(raw: DataFrame) -> DataFrame:
    """C-05: earliest and latest line time and the span in whole days."""
    a = raw.agg(F.min("invoice_ts").alias("earliest"), F.max("invoice_ts").alias("latest"))
    return a.select("earliest", "latest", elapsed_days(F.col("earliest"), F.col("latest"))
                    .cast("bigint").alias("span_days"))


def dq_year_counts(raw: DataFrame) -> DataFrame:
    """C-06: rows per calendar year, in year order."""
    return (raw.groupBy(F.year("invoice_ts").alias("year")).agg(F.count(F.lit(1)).alias("rows"))
               .orderBy("year"))


def dq_month_counts(raw: DataFrame, year: int) -> DataFrame:
    """C-06: rows per month of one year (the year filter reaches the scan side)."""
    first, after = (F.lit(f"{y}-01-01 00:00:00").cast("timestamp_ntz") for y in (year, year + 1))
    return (raw.where((F.col("invoice_ts") >= first) & (F.col("invoice_ts") < after))
               .groupBy(F.month("invoice_ts").alias("month")).agg(F.count(F.lit(1)).alias("rows"))
               .orderBy("month"))


def dq_country_distribution(raw: DataFrame, top: int = 10) -> DataFrame:
    """C-07: the ``top`` countries by rows with % of all rows."""
    g = raw.groupBy("country").agg(F.count(F.lit(1)).alias("rows"))
    t = g.orderBy(F.desc("rows"), F.asc("country")).limit(top)
    t = t.withColumn("_n", raw.select(F.count(F.lit(1))).scalar())
    return t.select("country", "rows", ratio("rows", "_n", 2, mult=100, half_even=True).alias("pct_of_rows"))


def dq_country_summary(raw: DataFrame, home: str) -> DataFrame:
    """C-07: distinct countries and the home / other split of raw rows."""
    a = raw.agg(F.count(F.lit(1)).alias("_n"),
                F.count_distinct("country").alias("distinct_countries"),
                F.count_if(F.col("country") == home).alias("home_rows"))
    return a.select("distinct_countries", "home_rows",
                    (F.col("_n") - F.col("home_rows")).alias("other_rows"),
                    ratio("home_rows", "_n", 2, mult=100, half_even=True).alias("home_pct"))
