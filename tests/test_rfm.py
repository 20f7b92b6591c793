"""RFM scoring: pandas qcut parity, the segment rule table, edge frames."""
import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopscope.operators import rfm

# Expected segment counts over all 125 (r, f, m) score triples.
TRIPLE_COUNTS = {"Champion": 8, "Loyal Customer": 10, "New Customer": 20, "Potential Loyalist": 9,
                 "At Risk": 8, "Needs Attention": 10, "Lost": 4, "Promising": 19,
                 "About to Sleep": 31, "Hibernating": 6}


def test_all_score_triples(spark):
    rows = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    df = spark.createDataFrame(rows, "r int, f int, m int")
    seg = rfm.segment_expr(F.col("r"), F.col("f"), F.col("m"), F.col("r") + F.col("f") + F.col("m"))
    got = {r["s"]: r["n"] for r in df.groupBy(seg.alias("s")).agg(F.count("*").alias("n")).collect()}
    assert got == TRIPLE_COUNTS
    one = df.where("r = 1 and f = 1 and m = 3").select(seg.alias("s")).first()["s"]
    assert one == "Hibernating"


def _score(values, value):
    """1 + the number of 20/40/60/80 % edges below a value; an edge lies at position (n - 1) q of the
    sorted values, between two neighbours in proportion."""
    v = sorted(float(x) for x in values)
    below = 0
    for k in (1, 2, 3, 4):
        at = (len(v) - 1) * k / 5
        lo = int(at)
        edge = v[lo] + (v[min(lo + 1, len(v) - 1)] - v[lo]) * (at - lo)
        below += edge < float(value)
    return 1 + below


@pytest.mark.parametrize("n,seed", [(12, 1), (37, 2), (250, 3), (1001, 4)])
def test_scores_count_the_edges_below(spark, n, seed):
    rnd = random.Random(seed)
    rows = [(i + 1, rnd.randint(1, 400), rnd.randint(1, 9), Decimal(rnd.randint(100, 10**6)).scaleb(-2))
            for i in range(n)]
    base = spark.createDataFrame(rows, "customer_id bigint, recency int, frequency bigint, monetary decimal(18,2)")
    got = {r.customer_id: (r.r_score, r.f_score, r.m_score) for r in rfm.rfm_scores(base).collect()}
    place = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])))}
    for i, recency, _, monetary in rows:
        assert got[i] == (6 - _score([r[1] for r in rows], recency), _score(place.values(), place[i]),
                          _score([r[3] for r in rows], monetary)), i


def test_recency_is_elapsed_days_not_midnights(spark):
    # last purchase 23:00 on day 1, data ends 01:00 on day 2: reference = day 3 01:00
    rows = [("1", "A", "x", 1, "2024-01-01 23:00:00", Decimal("2.0000"), 1, "N"),
            ("2", "A", "x", 1, "2024-01-02 01:00:00", Decimal("2.0000"), 2, "N")]
    df = spark.createDataFrame(rows, "invoice string, stock_code string, description string, quantity int, "
                                     "ts string, price decimal(12,4), customer_id bigint, country string")
    df = df.withColumn("invoice_ts", F.to_timestamp_ntz("ts")).drop("ts").withColumn(
        "revenue", (F.col("quantity") * F.col("price")).cast("decimal(18,4)"))
    got = {r.customer_id: r.recency for r in rfm.rfm_base(df).collect()}
    assert got == {1: 1, 2: 1}  # 26 h and 24 h elapsed -> 1 whole day each


def test_single_customer_scores(spark):
    base = spark.createDataFrame([(1, 5, 2, Decimal("10.00"))],
                                 "customer_id bigint, recency int, frequency bigint, monetary decimal(18,2)")
    r = rfm.rfm_scores(base).first()
    assert (r.r_score, r.f_score, r.m_score) == (5, 1, 1)


def test_segment_table_properties(star):
    seg = star.rfm_segments
    bad = seg.where("r_score not between 1 and 5 or f_score not between 1 and 5 or m_score not between 1 and 5")
    assert bad.count() == 0
    assert seg.count() == seg.select("customer_id").distinct().count()
    assert seg.where("rfm_total != r_score + f_score + m_score").count() == 0
