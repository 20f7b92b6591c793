"""Two-phase duplicates and first rows against grouping in Python."""
import contextlib
import datetime as dt
import io
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shopscope.operators import cleaning, quality, revenue
from shopscope.plans import marks
from shopscope.plans.star import dim_customer, dim_product

COLUMNS = ["a", "b", "x"]


def _rows(n=3000, seed=4):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, f"t{i}", "same"]), rnd.choice([None, i % 50]), rnd.choice([0.0, -0.0, float("nan"), 1.5, None])) for i in range(n)]
    return rows + [("hot", 1, 2.5)] * n + [(None, None, None)] * 3


def _key(r):
    return tuple("nan" if isinstance(v, float) and v != v else v for v in r)


@pytest.mark.parametrize("places", [64, 1 << 24])
def test_counted_rows(spark, places):
    """64 places mark nearly every row: more is grouped, the result is the same."""
    rows = _rows()
    df = spark.createDataFrame(rows, "a string, b int, x double").repartition(5)
    spark.conf.set(marks.PLACES_CONF, str(places))
    try:
        got = Counter({_key(r[:3]): r[3] for r in marks.counted_rows(df, COLUMNS).collect()})
        once, others = marks.repeated_rows(df, COLUMNS)
        want = Counter(map(_key, rows))
        assert got == want
        assert once.count() + others.count() == len(want)
        if places > 64:  # singles pass by
            assert once.count() > 0.9 * sum(n == 1 for n in want.values())
    finally:
        spark.conf.unset(marks.PLACES_CONF)


def test_colliding_fingerprints_change_nothing(spark, monkeypatch):
    rows = _rows(500)
    monkeypatch.setattr(marks, "fingerprint", lambda df, columns: F.lit(7).cast("bigint") + F.rand(1).cast("int"))
    df = spark.createDataFrame(rows, "a string, b int, x double")
    assert {_key(r[:3]): r[3] for r in marks.counted_rows(df, COLUMNS).collect()} == Counter(map(_key, rows))


def test_empty(spark):
    df = spark.createDataFrame([], "a string, b int, x double")
    assert marks.counted_rows(df, COLUMNS).collect() == [] and marks.first_rows(df, "b", "a", ["x", "a"]).collect() == []


@pytest.mark.parametrize("places", [64, 1 << 24])
def test_first_rows_with_ties_and_nulls(spark, places):
    rnd = random.Random(8)
    days = [None, *[dt.datetime(2024, 1, d) for d in range(1, 6)]]
    rows = [(0 if i % 3 == 0 else rnd.choice([None, *range(40)]), rnd.choice(days), rnd.choice([None, "p", "q", "r"]), rnd.choice([None, "v1", "v2"])) for i in range(2000)]
    spark.conf.set(marks.PLACES_CONF, str(places))
    try:
        df = spark.createDataFrame(rows, "k int, t timestamp_ntz, s string, v string").repartition(4)
        got = {r.k: r.v for r in marks.first_rows(df, "k", "v", ["t", "s", "v"]).collect()}
    finally:
        spark.conf.unset(marks.PLACES_CONF)
    order = lambda r: [(v is not None, v or dt.datetime.min if j == 0 else v or "") for j, v in enumerate((r[1], r[2], r[3]))]
    for k in {r[0] for r in rows}:
        assert got[k] == min((r for r in rows if r[0] == k), key=order)[3]
    assert len(got) == len({r[0] for r in rows})


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_lines_meet_hash_aggregates_only(spark, star):
    """Every aggregate that reads lines before an exchange is a hash aggregate, but the last one, which
    reads marked lines."""
    for df in (dim_customer(star.clean), dim_product(star.clean), revenue.product_revenue(star.clean)):
        plan = _plan(df)
        assert plan.count("SortAggregate") == 2 and "HashAggregate" in plan and "bit_get" in plan  # partial and final of the marked lines


def test_only_repeated_fingerprints_are_grouped_whole(spark, star):
    plan = _plan(cleaning.classify(star.raw))
    whole = [line for line in plan.splitlines() if "hashpartitioning(invoice" in line]
    assert len(whole) == 1 and "bit_get" in plan
    once, others = marks.repeated_rows(star.raw, star.raw.columns)
    copies = {r.copies: r.n for r in others.groupBy("copies").agg(F.count("*").alias("n")).collect()}
    assert others.count() < 0.1 * star.raw.count() and once.count() + others.count() == star.classified.count()
    assert sum((c - 1) * n for c, n in copies.items()) == 188
    assert {r.rule: r.rows for r in quality.dq_rule_counts(star.raw).collect()}["duplicate_rows"] == 188
