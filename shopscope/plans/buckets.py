"""Lines stored by customer, so that per-customer figures need no shuffle.

``store`` writes lines as a catalog table bucketed and sorted by customer. An
aggregate or join by customer (or by customer and more) then runs bucket by
bucket on what a scan reads. A bucket is one task, so a customer with a large
share of all lines may not be in one: customers with more lines than half a
bucket's mean are kept in a second, plain table, where map-side partial
aggregates take care of them. There are fewer than ``2 * buckets`` such
customers, whatever the data. Both parts hold different customers, so
per-customer results of the two are simply put together.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "customer_id"


@dataclass(frozen=True)
class ByCustomer:
    """Lines by customer: those in buckets, and those of customers too large for one."""

    bucketed: DataFrame
    heavy: DataFrame

    def each(self, per_customer: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A result with rows per customer, computed from lines: ``per_customer`` of all lines."""
        return per_customer(self.bucketed).unionByName(per_customer(self.heavy))

    def lines(self) -> DataFrame:
        return self.bucketed.unionByName(self.heavy)


def heavy_customers(lines: DataFrame, buckets: int) -> DataFrame:
    """Customers with more lines than half a bucket's mean; at most ``2 * buckets - 1`` rows."""
    counts = lines.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"))
    total = lines.select(F.count(F.lit(1))).scalar()
    return counts.where(F.col("_n") * (2 * buckets) > total).select(KEY)


def store(lines: DataFrame, database: str, name: str, buckets: int | None = None) -> ByCustomer:
    """Write the lines as tables ``name`` (bucketed) and ``name_heavy`` of a catalog database. The number
    of buckets (by default that of shuffle partitions) should leave a bucket a few hundred MB."""
    spark = lines.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = F.broadcast(heavy_customers(lines, n).withColumnRenamed(KEY, "_heavy"))  # fewer than 2 n rows
    flagged = lines.join(heavy, F.col(KEY).eqNullSafe(F.col("_heavy")), "left_anti")
    # dealt out as the buckets are: a task writes one file
    flagged.repartition(n, KEY).write.mode("overwrite").bucketBy(n, KEY).sortBy(KEY).saveAsTable(f"{database}.{name}")
    lines.join(heavy, F.col(KEY).eqNullSafe(F.col("_heavy")), "left_semi").write.mode("overwrite").saveAsTable(f"{database}.{name}_heavy")
    return stored(spark, database, name)


def stored(spark: SparkSession, database: str, name: str) -> ByCustomer:
    return ByCustomer(spark.table(f"{database}.{name}"), spark.table(f"{database}.{name}_heavy"))
