"""p-values against published table values; t from sums equals the
textbook pooled-variance t."""
import math
import random
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

import reference_distributions as ref
from shopscope.functions.distributions import chi2_sf, t_two_sided_p
from shopscope.operators import stats


def _t_p(spark, pairs):
    df = spark.createDataFrame([(float(t), float(d)) for t, d in pairs], "t double, df double")
    return [r[0] for r in df.select(t_two_sided_p(F.col("t"), F.col("df"))).collect()]


def _chi2_p(spark, pairs):
    df = spark.createDataFrame([(float(x), float(k)) for x, k in pairs], "x double, k double")
    return [r[0] for r in df.select(chi2_sf(F.col("x"), F.col("k"))).collect()]


T_KNOWN = [(2.228138851986, 10, 0.05), (2.085963447265, 20, 0.05), (3.169272672617, 10, 0.01),
           (0.0, 5, 1.0), (2.0, 10, 0.0733880347707)]


def test_t_p_values(spark):
    got = _t_p(spark, [(t, d) for t, d, _ in T_KNOWN])
    for (t, d, p), g in zip(T_KNOWN, got):
        assert g == pytest.approx(p, rel=1e-8, abs=1e-12), (t, d)


def test_t_p_values_at_huge_df(spark):
    """Invoice-level tests at scale have billions of degrees of freedom;
    compare with the normal tail plus its first-order t correction."""
    pairs = [(t, d) for d in (1e6, 1e8, 1e10) for t in (0.438, 1.2, 1.7, 1.96, 3.28)]
    for (t, d), g in zip(pairs, _t_p(spark, pairs)):
        phi = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
        expected = math.erfc(t / math.sqrt(2)) + phi * (t ** 3 + t) / (2 * d)
        assert g == pytest.approx(expected, rel=2e-6), (t, d)


def test_t_matches_reference(spark):
    pairs = [(t, d) for d in (1, 2, 3, 7, 30, 118, 1131, 36967, 2e5) for t in (0.05, 0.5, 1.3, 2.4, 6.0, 25.0)]
    for (t, d), g in zip(pairs, _t_p(spark, pairs)):
        assert g == pytest.approx(ref.t_two_sided_p(t, d), rel=1e-9, abs=1e-300), (t, d)


CHI2_KNOWN = [(3.841458820694, 1, 0.05), (11.0704976935, 5, 0.05), (16.9189776046, 9, 0.05),
              (0.0, 3, 1.0), (2.0, 2, math.exp(-1.0))]


def test_chi2_p_values(spark):
    got = _chi2_p(spark, [(x, k) for x, k, _ in CHI2_KNOWN])
    for (x, k, p), g in zip(CHI2_KNOWN, got):
        assert g == pytest.approx(p, rel=1e-8), (x, k)


def test_chi2_matches_reference(spark):
    pairs = [(x, k) for k in (1, 2, 5, 9, 40) for x in (0.3, 2.0, 9.0, 30.0, 300.0)]
    for (x, k), g in zip(pairs, _chi2_p(spark, pairs)):
        assert g == pytest.approx(ref.chi2_sf(x, k), rel=1e-8, abs=1e-300), (x, k)


def test_two_sample_t(spark):
    rnd = random.Random(9)
    a = [Decimal(rnd.randint(100, 5000)).scaleb(-2) for _ in range(40)]
    b = [Decimal(rnd.randint(100, 9000)).scaleb(-2) for _ in range(55)]
    rows = [(True, v) for v in a] + [(False, v) for v in b]
    df = spark.createDataFrame(rows, "g boolean, v decimal(18,2)")
    from pyspark.sql import functions as F
    r = stats.two_sample(df, F.col("g"), "v", 2, "t", "a", "b").first()
    fa, fb = [float(x) for x in a], [float(x) for x in b]
    ma, mb = sum(fa) / len(fa), sum(fb) / len(fb)
    va = sum((x - ma) ** 2 for x in fa) / (len(fa) - 1)
    vb = sum((x - mb) ** 2 for x in fb) / (len(fb) - 1)
    sp2 = ((len(fa) - 1) * va + (len(fb) - 1) * vb) / (len(fa) + len(fb) - 2)
    t = (ma - mb) / math.sqrt(sp2 * (1 / len(fa) + 1 / len(fb)))
    assert float(r.t_stat) == pytest.approx(t, abs=2e-6)
    assert r.df == 93 and r.n1 == 40 and r.n2 == 55


def test_tests_summary(star, spark):
    from shopscope.registry import HOME_COUNTRY
    rows = stats.tests_summary(star.rfm_segments, star.clean, HOME_COUNTRY).collect()
    assert len(rows) == 5
    for r in rows:
        assert 0.0 <= r.p_value <= 1.0
        assert r.significant == (r.p_value < 0.05)


def test_counts_of_the_target_size_do_not_overflow(spark):
    """Sizes of 1e11 per side: products of counts exceed BIGINT."""
    from decimal import Decimal

    from shopscope.functions.exact import ratio
    from shopscope.operators.stats import WIDE_N1, WIDE_N2, chi2_from_counts
    big = 10**11
    df = spark.createDataFrame([(big, 4 * big, Decimal(3 * big), Decimal(8 * big))], "n1 bigint, n2 bigint, s1 decimal(38,4), s2 decimal(38,4)")
    row = df.select(ratio(f"s1 * {WIDE_N2} - s2 * {WIDE_N1}", f"{WIDE_N1} * {WIDE_N2}", 2, num_scale=4, half_even=True).alias("d"),
                    ratio("n2", "n1", 2, mult=100).alias("r")).first()
    assert (row.d, row.r) == (Decimal("1.00"), Decimal("400.00"))
    g = spark.createDataFrame([("a", 3 * big), ("b", big)], "segment string, o bigint")
    assert chi2_from_counts(g).first().chi2_stat == Decimal(big)


def test_p_value_is_null_where_it_does_not_converge(spark):
    from pyspark.sql import functions as F

    from shopscope.functions.distributions import chi2_sf
    r = spark.range(1).select(chi2_sf(F.lit(9.0), F.lit(8.0)).alias("a"), chi2_sf(F.lit(2e9), F.lit(2e9)).alias("b")).first()
    assert abs(r.a - 0.342296) < 1e-5 and r.b is None
