"""Exact ratio rounding against Python's decimal module."""
import random
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal, getcontext

from shopscope.functions.exact import ratio


def _expected(a: Decimal, b: int, places: int, mult: int, mode) -> Decimal | None:
    if b == 0:
        return None
    q = Decimal(1).scaleb(-places)
    return (a * mult / Decimal(b)).quantize(q, rounding=mode)


def test_ratio_matches_decimal(spark):
    rnd = random.Random(7)
    rows = [(Decimal(rnd.randint(-10**7, 10**7)).scaleb(-3), rnd.choice([0, 1, 2, 3, 7, 8, 400, 12345]))
            for _ in range(400)]
    rows += [(Decimal("1.005"), 1), (Decimal("0.125"), 1), (Decimal("-0.125"), 1), (Decimal("2.5"), 2)]
    df = spark.createDataFrame(rows, "a decimal(18,3), b bigint")
    out = df.select("a", "b",
                    ratio("a", "b", 2, num_scale=3).alias("up"),
                    ratio("a", "b", 2, num_scale=3, half_even=True).alias("even"),
                    ratio("a", "b", 4, num_scale=3, mult=100).alias("pct")).collect()
    getcontext().prec = 60  # exact true quotient for the comparison
    for r in out:
        assert r.up == _expected(r.a, r.b, 2, 1, ROUND_HALF_UP)
        assert r.even == _expected(r.a, r.b, 2, 1, ROUND_HALF_EVEN)
        assert r.pct == _expected(r.a, r.b, 4, 100, ROUND_HALF_UP)
