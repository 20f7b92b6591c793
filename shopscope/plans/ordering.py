"""Skew-safe global ordering: row number and running sum over a total order,
without funnelling all rows through one task. (Values at a few ranks need no
order at all: see ``selection``.)

A window with ORDER BY and no PARTITION BY runs in a single task. That is
fine for a few hundred months or countries, not for customers, products or
lines. The plan, the same at every size:

1. ``repartitionByRange(B, order)`` - Spark samples the order key and splits
   it into B contiguous ranges. The order is total (it ends with a unique
   tie-break), so even a value shared by a third of all rows is spread over
   many buckets.
2. The bucket number, written to the shared checkpoint folder: the bucket
   assignment is frozen, so re-running a lost task can never move a row to
   another bucket.
3. Per-bucket count / sum (B rows), an exclusive prefix over those B rows,
   broadcast back (B is bounded by configuration).
4. Local row numbers and running sums per bucket; adding the bucket offsets
   makes them global.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopscope.plans.selection import quantiles
from shopscope.session import ensure_checkpoint_dir

BUCKETS_CONF = "shopscope.ordering.buckets"

Order = Sequence[tuple[str, bool]]  # (column, ascending)


def _sort_exprs(order: Order) -> list[Column]:
    return [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order]


#: Rows that one bucket's sort holds in memory (about 100 MB).
BUCKET_ROWS = 1 << 20


def _buckets(spark, rows: int | None = None) -> int:
    b = spark.conf.get(BUCKETS_CONF, None)
    return int(b) if b else max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(rows or 0) // BUCKET_ROWS))


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a table in the shared checkpoint folder and cut its lineage. (A reliable
    ``checkpoint()`` runs the plan twice, once to compute and once to write it, and stores rows.)"""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/durable-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_LOW33 = (1 << 33) - 1


def global_order(df: DataFrame, order: Order, *, running: str | None = None, rows: int | None = None) -> DataFrame:
    """Add ``_rn`` (1-based position in ``order``) and optionally ``_cum``
    (running sum of ``running``, ROWS UNBOUNDED PRECEDING).

    ``order`` must be total (make its last columns a unique key). After the
    range exchange and the sort in the same stage,
    ``monotonically_increasing_id`` is (bucket << 33) + position in the
    bucket, so the row number needs no window. ``rows``: about how many rows
    there are, if known; more of them get more buckets, not larger ones.
    """
    spark = df.sparkSession
    sort = _sort_exprs(order)
    staged = durable(df.repartitionByRange(_buckets(spark, rows), *sort)
                       .sortWithinPartitions(*sort)
                       .withColumn("_mid", F.monotonically_increasing_id()))
    staged = (staged.withColumn("_bucket", F.shiftright("_mid", 33))
                    .withColumn("_lrn", (F.col("_mid").bitwiseAND(F.lit(_LOW33)) + 1)))
    aggs = [F.count(F.lit(1)).alias("_cnt")]
    if running:
        aggs.append(F.sum(running).alias("_sum"))
    stats = staged.groupBy("_bucket").agg(*aggs)
    # exclusive prefix over the B bucket rows (B is bounded: one small task)
    wb = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offs = stats.withColumn("_off", F.coalesce(F.sum("_cnt").over(wb), F.lit(0)).cast("bigint"))
    keep = ["_bucket", "_off"]
    if running:
        offs = offs.withColumn("_soff", F.coalesce(F.sum("_sum").over(wb), F.lit(0).cast(stats.schema["_sum"].dataType)))
        keep.append("_soff")
        local = Window.partitionBy("_bucket").orderBy("_lrn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        staged = staged.withColumn("_lcum", F.sum(running).over(local))
    out = staged.join(F.broadcast(offs.select(*keep)), "_bucket")
    out = out.withColumn("_rn", (F.col("_off") + F.col("_lrn")).cast("bigint"))
    if running:
        out = out.withColumn("_cum", F.col("_soff") + F.col("_lcum"))
    drop = ["_mid", "_bucket", "_lrn", "_off", "_soff", "_lcum"]
    return out.drop(*[c for c in drop if c in out.columns])


def quantile_edges(df: DataFrame, value: str, tiebreak: str, qs: Sequence[float]) -> DataFrame:
    """One row with column ``edges`` (array<double>): exact quantiles of
    ``value`` at ``qs``, see ``selection.quantiles``. Equal values are equal
    quantiles, so ``tiebreak`` plays no part."""
    return df.sparkSession.createDataFrame([(quantiles(df, {value: qs})[value],)], "edges array<double>")
