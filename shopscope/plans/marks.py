"""Whole-row duplicates and first rows per key, without shuffling or sorting
the rows that cannot matter.

Both work in two phases. The first finds, from a few bytes per row, which rows
may matter, and marks them in a bitmap of fixed size (one bit per place, kept
as 64-bit words, at most ``places / 64`` rows: a broadcast of a known bound).
The second shuffles only rows whose place is marked. The bitmap passes every
row it was made for and, the fuller it is, others: it saves work and decides
nothing. Everything is DataFrame functions.

* ``counted_rows``: rows whose 64-bit fingerprint is seen once are distinct
  already. Only rows whose fingerprint repeats are grouped as whole rows, so
  colliding fingerprints cost a little and change nothing.
* ``first_rows``: the least leading value per key (a hash aggregate: fixed-size
  buffers) leaves one row per key but for ties; only those meet the full order,
  whose text columns need a sort aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACES_CONF = "shopscope.marks.places"
#: 2**18 words of 64 bits: 4 MB.
PLACES = 1 << 24
#: As many places at most when the number of rows is known: 16 MB.
MOST_PLACES = 1 << 26


def _places(df: DataFrame, rows: int | None = None) -> int:
    """The setting, or a place for about every second row between the two limits."""
    n = int(df.sparkSession.conf.get(PLACES_CONF, None) or min(max(PLACES, 1 << ((rows or 0) // 2).bit_length()), MOST_PLACES))
    if n < 64 or n & (n - 1):
        raise ValueError(f"{PLACES_CONF} must be a power of two, 64 at least")
    return n


def fingerprint(df: DataFrame, columns: Sequence[str]) -> Column:
    """A 64-bit name of the columns, equal for rows that GROUP BY holds equal (0.0 and -0.0 are)."""
    def plain(c: str) -> Column:
        return F.col(c) + F.lit(0.0) if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) else F.col(c)

    # which columns are null goes in too: a null leaves the hash as it was
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(nulls, *[plain(c) for c in columns])


def _word(name: Column, places: int) -> Column:
    return F.shiftright(name.bitwiseAND(F.lit(places - 1)), 6)


def marks(names: DataFrame, name: str, places: int | None = None) -> DataFrame:
    """(_word, _bits): the places of the names as words of 64 bits, ``places / 64`` rows at most."""
    places = places or _places(names)
    bit = F.expr(f"shiftleft(1L, cast({name} & 63 as int))")
    return names.groupBy(_word(F.col(name), places).alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def with_mark(rows: DataFrame, name: Column, words: DataFrame, places: int | None = None) -> DataFrame:
    """The rows with ``_marked``: whether the place of their name is marked."""
    named = rows.withColumn("_name", name)
    joined = named.withColumn("_word", _word(F.col("_name"), places or _places(rows))).join(F.broadcast(words), "_word", "left")
    marked = F.expr("coalesce(bit_get(_bits, cast(_name & 63 as int)), 0) = 1")
    return joined.select(*rows.columns, marked.alias("_marked"))


def repeated_rows(df: DataFrame, columns: Sequence[str], copies: str = "copies", n_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that occur once, as far as fingerprints tell; the others, distinct, with their number of
    ``copies``, which may still be 1). ``n_rows``: about how many rows there are, if known, for the
    size of the bitmap."""
    places = _places(df, n_rows)
    rows = df.select(*columns)
    name = fingerprint(rows, columns)
    twice = rows.groupBy(name.alias("_name")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    flagged = with_mark(rows, name, marks(twice, "_name", places), places)
    once = flagged.where(~F.col("_marked")).select(*columns)
    others = flagged.where(F.col("_marked")).groupBy(*columns).agg(F.count(F.lit(1)).alias(copies))
    return once, others


def counted_rows(df: DataFrame, columns: Sequence[str], copies: str = "copies", n_rows: int | None = None) -> DataFrame:
    """The distinct rows and their number of ``copies``."""
    once, others = repeated_rows(df, columns, copies, n_rows)
    return once.withColumn(copies, F.lit(1).cast("bigint")).unionByName(others)


def first_rows(df: DataFrame, key: str, value: str, order: Sequence[str], n_rows: int | None = None) -> DataFrame:
    """(key, value): per key the ``value`` of its first row in ``order`` (ascending, nulls first).

    The first column of ``order`` must be of fixed size (a time, a number), so that its minimum is a
    hash aggregate; a row without it comes first, so its key's minimum is null.
    """
    lead, places = order[0], _places(df, n_rows)
    least = df.groupBy(key).agg(F.min(lead).alias("_least"), F.max(F.col(lead).isNull()).alias("_null"))
    least = least.select(key, F.when(~F.col("_null"), F.col("_least")).alias(lead))
    words = marks(least.select(fingerprint(least, [key, lead]).alias("_name")), "_name", places)
    needed = list(dict.fromkeys([key, value, *order]))
    may = with_mark(df.select(*needed), fingerprint(df, [key, lead]), words, places).where("_marked")
    return may.groupBy(key).agg(F.min_by(value, F.struct(*order)).alias(value))
