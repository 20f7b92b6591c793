"""Key and reference checks on the star schema (C-61, C-62) and the
post-load row counts (S-07).

Declared keys become validation jobs: orphans are ``left_anti`` joins,
primary-key violations are keys seen more than once, NOT NULL checks are
one conditional aggregate per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope import schemas
from shopscope.plans.summary import one_row


def fk_orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """C-61: per declared foreign key, child rows whose key has no parent."""
    out = None
    for child, col, parent, pcol in schemas.FOREIGN_KEYS:
        # a row per key before the join: a key with a third of all rows is one row
        c = tables[child].groupBy(F.col(col).alias("_k")).agg(F.count(F.lit(1)).alias("_c"))
        p = tables[parent].select(F.col(pcol).alias("_k"))
        n = c.join(p, "_k", "left_anti").agg(F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("orphan_rows"))
        row = n.select(F.lit(child).alias("child_table"), F.lit(col).alias("child_column"),
                       F.lit(parent).alias("parent_table"), "orphan_rows")
        out = row if out is None else out.unionByName(row)
    return out


def pk_violations(tables: dict[str, DataFrame], metrics: dict[str, dict] | None = None) -> DataFrame:
    """C-62: per table, duplicated primary-key values, rows with a null key
    and nulls in every declared NOT NULL column (one row per table).
    ``metrics``: rows and nulls as the write has observed them; only the
    keys are read again then."""
    out = None
    for name, keys in schemas.PRIMARY_KEYS.items():
        t = tables[name]
        dup = (t.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1)
                .agg(F.count(F.lit(1)).alias("duplicate_keys")))
        if metrics and name in metrics:
            m = metrics[name]
            row = dup.select(F.lit(name).alias("table_name"), F.lit(m["n"]).cast("bigint").alias("rows"), "duplicate_keys",
                             F.lit(m["null_keys"]).cast("bigint").alias("null_keys"), F.lit(m["not_null_violations"]).cast("bigint").alias("not_null_violations"))
        else:
            nulls = t.agg(F.count(F.lit(1)).alias("rows"),
                          F.count_if(F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1
                                     else F.col(keys[0]).isNull()).alias("null_keys"),
                          sum(F.count_if(F.col(c).isNull()) for c in schemas.NOT_NULL[name]).alias("not_null_violations"))
            row = one_row(dup, nulls).select(F.lit(name).alias("table_name"), "rows", "duplicate_keys",
                                              "null_keys", F.col("not_null_violations").cast("bigint"))
        out = row if out is None else out.unionByName(row)
    return out


def load_row_counts(tables: dict[str, DataFrame], metrics: dict[str, dict] | None = None) -> DataFrame:
    """S-07: rows per loaded table, in load order. ``metrics``: as observed
    by the writes, each held against the number that the stored files give
    (a count that reads no column); a difference is an error."""
    out = None
    for i, name in enumerate(["dim_customer", "dim_product", "dim_date", "fact_sales", "rfm_segments"]):
        row = tables[name].agg(F.lit(i + 1).alias("load_order"), F.lit(name).alias("table_name"),
                               F.count(F.lit(1)).alias("rows"))
        if metrics and name in metrics:
            differs = F.raise_error(F.concat(F.lit(f"{name}: {metrics[name]['n']} rows written, stored: "), F.col("rows").cast("string")))
            row = row.withColumn("rows", F.when(F.col("rows") == metrics[name]["n"], F.col("rows")).otherwise(differs.cast("bigint")))
        out = row if out is None else out.unionByName(row)
    return out
