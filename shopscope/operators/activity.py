"""One bitset of active months per customer, and the cohorts that follow from it.

A row is (customer_id, base, months): bit i of the BIGINT array ``months`` says
that the customer bought in month ``base + i`` (month ordinals, see
``functions.calendar``). ``base`` is a multiple of 64 and the same in all rows of
a table. Lines meet their customer once, in a hash aggregate with map-side
combine of a few longs per customer, however often they bought; every cohort
figure is then read off the bitsets, row by row, and only cells of (cohort
month, index) are shuffled. Bitsets of several loads merge by OR.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 64


def _merged_words(rows: DataFrame, words: list[Column], base: int) -> DataFrame:
    names = [f"_w{i}" for i in range(len(words))]
    merged = rows.select("customer_id", *[w.alias(n) for w, n in zip(words, names)]).groupBy("customer_id").agg(
        *[F.bit_or(n).alias(n) for n in names])
    return merged.select("customer_id", F.lit(base).cast("int").alias("base"), F.array(*names).alias("months"))


def activity(lines: DataFrame, month: Column) -> DataFrame:
    """The bitsets of ``lines`` (with a customer_id), ``month`` being a line's month ordinal; lines
    without a month are left out. One aggregate finds the range of months, which sizes the arrays."""
    rows = lines.select("customer_id", month.alias("_mo")).where("_mo is not null")
    first, last = rows.agg(F.min("_mo"), F.max("_mo")).first()
    if first is None:
        return _merged_words(rows, [F.lit(0).cast("bigint")], 0)
    base = first // WORD * WORD
    at = F.col("_mo") - base
    bit = F.expr(f"shiftleft(1L, (_mo - {base}) % {WORD})")
    words = [F.when((at >= WORD * w) & (at < WORD * (w + 1)), bit).otherwise(F.lit(0).cast("bigint")) for w in range((last - base) // WORD + 1)]
    return _merged_words(rows, words, base)


def merged(some: DataFrame, others: DataFrame) -> DataFrame:
    """The bitsets of both tables together, whatever their ranges of months."""
    both = some.unionByName(others)
    first, end = both.agg(F.min("base"), F.max(F.col("base") + F.size("months") * WORD)).first()
    if first is None:
        return both
    at = lambda w: (F.lit(first + WORD * w) - F.col("base")) / WORD
    words = [F.coalesce(F.when(at(w) >= 0, F.get("months", at(w).cast("int"))), F.lit(0).cast("bigint")) for w in range((end - first) // WORD)]
    return _merged_words(both, words, first)


def active_months(bitsets: DataFrame) -> DataFrame:
    """(customer_id, cohort_mo, active): a customer's first month and all its months, rising."""
    places = F.sequence(F.lit(0), F.size("months") * WORD - 1)
    on = F.filter(places, lambda i: F.call_function("bit_get", F.get("months", F.floor(i / WORD).cast("int")), i % WORD) == 1)
    months = F.transform(on, lambda i: i + F.col("base"))
    return bitsets.select("customer_id", months.alias("active")).select("customer_id", F.get("active", F.lit(0)).alias("cohort_mo"), "active")


def cohort_cells(bitsets: DataFrame) -> DataFrame:
    """(cohort_mo, cohort_index, customers): distinct customers of each cohort active in each of its months."""
    each = active_months(bitsets).select("cohort_mo", F.explode("active").alias("_mo"))
    cells = each.groupBy("cohort_mo", (F.col("_mo") - F.col("cohort_mo")).alias("cohort_index"))
    return cells.agg(F.count(F.lit(1)).alias("customers"))
