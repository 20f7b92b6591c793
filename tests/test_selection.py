"""Order statistics by counting against sorting in Python: heavy ties, extreme values, ids beyond
doubles, and plans without a sort."""
import contextlib
import io
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopscope.plans import selection
from shopscope.plans.selection import Rank, at_ranks, medians, order_statistics, quantiles


def _check(df, values, ranks, **kw):
    n, places = order_statistics(df, {"m": (F.col("v"), [Rank((r - 0.5) / max(len(values), 1), lambda _, r=r: [r]) for r in ranks])}, **kw)["m"]
    values = sorted(values)
    assert n == len(values)
    for r, at in zip(ranks, places):
        v = values[r - 1]
        assert (at[r].value, at[r].below, at[r].upto) == (v, sum(x < v for x in values), sum(x <= v for x in values))


def _values(kind, n, rnd):
    if kind == "ties":
        return [42 if rnd.random() < 0.9 else rnd.randint(0, 100) for _ in range(n)]
    if kind == "two":
        return [rnd.choice([-5, 10 ** 15]) for _ in range(n)]
    if kind == "ids":  # neighbours that doubles cannot tell apart
        return [2 ** 62 + i for i in range(n)]
    if kind == "modes":
        return [rnd.randint(0, 50) if i % 2 else 10 ** 12 + rnd.randint(0, 50) for i in range(n)]
    return [int(10 ** (rnd.random() * 18)) * rnd.choice([-1, 1]) for _ in range(n)]


@pytest.mark.parametrize("kind", ["ties", "two", "ids", "modes", "spread"])
def test_ranks(spark, kind):
    rnd = random.Random(7)
    values = _values(kind, 2000, rnd)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, "v bigint").repartition(4).cache()
    # a coarse sketch and a low limit force many turns
    _check(df, values, [1, 2, 199, 200, 1000, 1001, 1777, 1999, 2000], accuracy=20, at_most=3)
    _check(df, values, [1, 1000, 2000])


def test_decimals_and_doubles(spark):
    rnd = random.Random(9)
    values = [Decimal(rnd.randint(-10 ** 6, 10 ** 6)).scaleb(-2) for _ in range(700)] + [Decimal("99999999999999999999999999999999.99")]
    _check(spark.createDataFrame([(v,) for v in values], "v decimal(38,2)"), values, [1, 350, 351, 700, 701], accuracy=10, at_most=2)
    values = [rnd.gauss(0, 1) for _ in range(500)] + [1e300, -1e-300]
    _check(spark.createDataFrame([(v,) for v in values], "v double"), values, [1, 250, 251, 502], accuracy=10, at_most=2)


def test_quantiles_and_medians_of_several_measures_at_once(spark, monkeypatch):
    rnd = random.Random(1)
    rows = [(rnd.randint(1, 9), Decimal(rnd.randint(0, 10 ** 7)).scaleb(-2), rnd.choice("abc")) for _ in range(3001)]
    df = spark.createDataFrame(rows, "a int, b decimal(18,2), g string")
    passes = []
    row = selection._row
    monkeypatch.setattr(selection, "_row", lambda d, c: passes.append(len(c)) or row(d, c))
    qs = [0.0, 0.2, 0.4, 0.5, 0.8, 0.95, 1.0]
    got = quantiles(df, {"a": qs, "b": qs})
    for i, c in enumerate("ab"):
        assert got[c] == pytest.approx(np.quantile([float(r[i]) for r in rows], qs).tolist(), rel=1e-12)
    assert len(passes) <= 3
    got = medians(df, {g: F.when(F.col("g") == g, F.col("b")) for g in "abcd"})
    for g in "abc":
        v = sorted(r[1] for r in rows if r[2] == g)
        both = sorted({(len(v) + 1) // 2, len(v) // 2 + 1})
        assert got[g] == (sum(v[r - 1] for r in both), len(both))
    assert got["d"] is None


@pytest.mark.parametrize("descending", [False, True])
def test_rows_at_ranks_of_two_columns(spark, descending):
    rnd = random.Random(2)
    rows = [(1 if i % 3 else rnd.randint(0, 4), 2 ** 60 + i) for i in range(900)]
    df = spark.createDataFrame(rows, "f bigint, id bigint").repartition(3)
    n, got = at_ranks(df, "f", "id", [Rank(k / 5, lambda n, k=k: [k * n // 5]) for k in (1, 2, 3, 4)], descending)
    assert n == 900 and got == [sorted(rows, key=lambda r: (-r[0] if descending else r[0], r[1]))[k * 180 - 1] for k in (1, 2, 3, 4)]
    assert at_ranks(df.where("f > 100"), "f", "id", [Rank(0.5, lambda n: [1])]) == (0, [])


def test_scores_describe_and_medians_plan_no_order(spark, star):
    """No range exchange and no sort of customers in these plans (their last ORDER BY is a report's)."""
    from shopscope.operators import clv, reports, rfm
    c = clv.customer_clv(star.clean)
    for df in (rfm.rfm_segments(star.clean), rfm.rfm_describe(star.rfm_segments), clv.clv_stats(c), reports.revenue_by_decile(star.rfm_segments)):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        plan = buf.getvalue()
        assert "Window" not in plan and plan.count("rangepartitioning") <= 1, plan
