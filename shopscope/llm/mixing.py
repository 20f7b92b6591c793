"""Mixing sources to target weights, with DataFrame operations only.

Words of a source, its documents one after another, form blocks of ``BLOCK``
words. Targets say how many block slots each source gets. Output shards of
``SHARD`` slots draw their counts per source: the whole part of the expected
count, and the remaining slots of the shard multinomially by the fractional
parts; the last shard makes up what the others drew too little, and a draw
beyond a source's quota is void. Slot j of a source takes block
``permutation(j mod blocks)`` of pass ``j div blocks``: every pass uses each
block at most once, and a quota has two passes at most, so no document is taken
more than twice. Blocks are joined by (source, index) and credited to the
documents they overlap.

Sums and draws are integer arithmetic on fixed multipliers: reruns agree. A
document's place in its source comes from sums per bucket of ids and a running
sum within the bucket, so a source with a third of all rows is dealt over many
tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopscope.llm.shared import made, n_words, numbered, unused, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK = 128
SHARD = 4096
BUCKETS = 4096
ROUNDS = 20
#: Steps of the fraction of a document.
FRACTION = 1 << 20

# Fixed values of the pseudorandom numbers: the prime and two multipliers of full period.
PRIME, FIRST, SECOND = 2147483647, 48271, 69621


def scattered(x: Column) -> Column:
    """A pseudorandom number below PRIME from a non-negative BIGINT."""
    return ((x % PRIME) * FIRST % PRIME + 1) * SECOND % PRIME


def permuted(i: Column, n: Column, salt: Column) -> Column:
    """Place i of a pseudorandom permutation of 0..n-1: swap-or-not rounds. Each round pairs every
    place with one other and swaps a pair or not by a bit that depends on the pair."""

    def one(x: Column, r: Column) -> Column:
        other = (scattered(scattered(salt * 64 + r)) + n - x) % n
        bit = F.floor(scattered(scattered(F.greatest(x, other)) + scattered(salt * 64 + r + 32)) / 65536) % 2
        return F.when(bit == 1, other).otherwise(x)

    rounds = F.sequence(F.lit(0).cast("long"), F.lit(ROUNDS - 1).cast("long"))
    return F.aggregate(rounds, i.cast("long"), lambda x, r: one(x, r).cast("long"))


def _key(source: Column) -> Column:
    """Text that is equal for equal sources and sorts them by code point, null last."""
    return F.concat(F.when(source.isNull(), "1").otherwise("0"), F.coalesce(source, F.lit("")))


def _bucket() -> Column:
    return F.pmod(scattered(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(PRIME))), F.lit(BUCKETS)).alias("bucket")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(key, source_size, target) from (key, source_size), one row per source.

    Sources fill up in the order of limit to weight: those whose limit is below their share of
    what is left get their limit, the others share the rest by weight."""
    turn = (F.row_number().over(Window.orderBy("key")) - 1) % len(weights)
    s = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("long"))
    s = s.withColumn("cap", F.col("source_size") * most)
    everything = Window.partitionBy(F.lit(1))
    up = Window.orderBy(F.col("cap") / F.col("w"), "key")
    s = s.withColumn("want", F.sum("source_size").over(everything) * F.lit(share))
    s = s.withColumn("filled", F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    s = s.withColumn("w_left", F.sum("w").over(up.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("full", F.col("cap") * F.col("w_left") <= F.col("w") * (F.col("want") - F.col("filled")))
    s = s.withColumn("spent", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(everything))
    s = s.withColumn("w_open", F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(everything))
    level = (F.col("want") - F.col("spent")) / F.nullif(F.col("w_open"), F.lit(0))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("w") * level)
    return s.select("key", "source_size", target.alias("target"))


def block_uses(sources: DataFrame, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """(key, block, uses): how often the mix takes each block of each source."""
    s = sources.filter("source_size > 0").withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
    s = s.withColumn("quota", F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"))
    s = s.withColumn("id", F.row_number().over(Window.orderBy("key")).cast("long"))
    s = s.withColumn("slots", F.sum("quota").over(Window.partitionBy(F.lit(1))))
    shards = F.ceil(F.col("slots") / shard).cast("long")
    s = s.withColumn("last", shards - 1).filter("slots > 0")
    s = s.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
    room = F.least(F.lit(shard).cast("long"), F.col("slots") - F.col("shard") * shard)
    s = s.withColumn("room", room).withColumn("whole", F.expr("(quota * room) div slots"))
    s = s.withColumn("part", F.col("quota") * F.col("room") - F.col("whole") * F.col("slots"))
    of_shard = Window.partitionBy("shard")
    s = s.withColumn("draws", F.col("room") - F.sum("whole").over(of_shard))
    s = s.withColumn("from", F.coalesce(F.sum("part").over(of_shard.orderBy("id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # one number per remaining slot of the shard, below the sum of the fractional parts
    number = lambda i: (scattered(scattered(F.col("shard")) + i) * PRIME + scattered(scattered(F.col("shard") + 7) + i)) % (F.col("draws") * F.col("slots"))
    drawn = F.filter(F.transform(F.sequence(F.lit(1).cast("long"), F.col("draws")), number), lambda u: (u >= F.col("from")) & (u < F.col("from") + F.col("part")))
    s = s.withColumn("n", F.col("whole") + F.when(F.col("draws") > 0, F.size(drawn)).otherwise(0))
    before = Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # the last shard closes the quota, no shard exceeds it
    s = s.withColumn("end", F.when(F.col("shard") == F.col("last"), F.col("quota")).otherwise(F.least("quota", F.col("first") + F.col("n"))))
    # a row of a shard becomes up to SHARD slots: deal the rows out first, by a fixed number of tasks
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = s.filter(F.col("first") < F.col("end")).select("key", "id", "blocks", "shard", "first", "end").repartition(tasks, "key", "shard")
    slot = s.withColumn("slot", F.explode(F.expr("sequence(first, end - 1)")))
    at = permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.col("id") * 4 + F.expr("slot div blocks"))
    return slot.select("key", at.alias("block")).groupBy("key", "block").agg(F.count(F.lit(1)).alias("uses"))


def sized(docs: DataFrame, *keep: str) -> DataFrame:
    """What the mix needs of documents: doc_id, source and size, and columns to keep."""
    size = n_words(F.col("text").cast("string"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"), *keep)


def mixture(rows: DataFrame, *keep: str, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source) for every row of ``sized`` documents.

    Null text: size 0, taken 0. Null is a source of its own, the last one. Null ids come first in
    their bucket; repeated rows are separate documents. Without any words all targets are 0. An
    empty table gives an empty result.
    """
    rows = written(rows.withColumn("key", _key(F.col("source"))), "sizes")
    sizes = rows.groupBy("key").agg(F.sum("size").alias("source_size"))
    sources = written(targets(sizes), "targets")
    uses = block_uses(sources, block, shard)

    some = rows.filter("size > 0").select("*", _bucket())
    per = some.groupBy("key", "bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select("key", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("key", "bucket").orderBy(F.col("doc_id").asc_nulls_first(), "size", *keep).rowsBetween(Window.unboundedPreceding, -1)
    placed = some.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0))).join(base, ["key", "bucket"])
    placed = placed.withColumn("start", F.col("base") + F.col("inner"))
    cut = placed.withColumn("block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
    overlap = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) - F.greatest(F.col("start"), F.col("block") * block)
    # the planner takes the exploded slots for a small table; they grow with the corpus
    used = cut.withColumn("overlap", overlap).join(uses.hint("merge"), ["key", "block"], "left")
    taken = used.groupBy("key", "start", "doc_id", "size", *keep).agg(F.sum(F.col("overlap") * F.coalesce("uses", F.lit(0))).alias("taken")).drop("start")
    none = rows.filter("size = 0").select("key", "doc_id", "size", *keep, F.lit(0).cast("long").alias("taken"))
    out = taken.union(none).join(sources, "key")
    source = F.when(F.col("key").startswith("0"), F.expr("substring(key, 2)"))
    return out.select("doc_id", "size", "source_size", "target", "taken", source.alias("source"), *keep)


def whole_copies(taken: DataFrame) -> DataFrame:
    """(mix_row, copies) of ``mixture`` rows: the whole documents that the words taken come to, and one
    more for a share of the rows. The remaining fractions are summed up along each source, and a row
    that takes the sum over a half gets one, so a source's copies add up to what is taken of it."""
    parts = taken.filter("size > 0").select(_key(F.col("source")).alias("key"), "doc_id", "size", "mix_row", _bucket(), F.expr("taken div size").alias("whole"), F.expr(f"(taken % size) * {FRACTION} div size").alias("part"))
    parts = written(parts, "fractions")
    per = parts.groupBy("key", "bucket").agg(F.sum("part").alias("n"))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select("key", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("key", "bucket").orderBy(F.col("doc_id").asc_nulls_first(), "size", "mix_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = parts.withColumn("inner", F.sum("part").over(within)).join(base, ["key", "bucket"])
    summed = summed.withColumn("upto", F.col("base") + F.col("inner") + FRACTION // 2)
    return summed.select("mix_row", F.expr(f"whole + upto div {FRACTION} - (upto - part) div {FRACTION}").alias("copies"))


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: each as often as the words taken of it come to
    whole documents, see ``whole_copies``. Rows without words go."""
    own = unused(docs, "mix_row")
    rows = numbered(docs, own)
    taken = lambda: mixture(sized(rows, F.col(own).alias("mix_row")), "mix_row")
    copies = made(docs.sparkSession, "copies", lambda: whole_copies(taken()).filter("copies > 0"))
    times = copies.select("mix_row", F.explode(F.expr("sequence(1, copies)")).alias("copy"))
    return rows.join(times.select(F.col("mix_row").alias(own)), own).select(*docs.columns)
