"""The global order against sorting in Python, including a tie group that
spans many buckets (a third of all rows), and plans without a one-task window."""
import contextlib
import io
import random
from decimal import Decimal

import numpy as np
import pytest

from shopscope.plans.ordering import global_order, quantile_edges


def _rows(n=3000, seed=3):
    rnd = random.Random(seed)
    return [(i, Decimal("42.00") if i % 3 == 0 else Decimal(rnd.randint(0, 500)).scaleb(-1)) for i in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, v decimal(18,2)")


@pytest.fixture(params=[1, 7, 16])
def buckets(spark, request):
    spark.conf.set("shopscope.ordering.buckets", str(request.param))
    yield request.param
    spark.conf.unset("shopscope.ordering.buckets")


@pytest.mark.parametrize("ascending", [True, False])
def test_positions_and_running_sums(spark, buckets, ascending):
    rows = _rows()
    got = {r.id: (r._rn, r._cum) for r in global_order(_frame(spark, rows), [("v", ascending), ("id", True)], running="v").collect()}
    total = Decimal(0)
    for n, (i, v) in enumerate(sorted(rows, key=lambda r: (r[1] if ascending else -r[1], r[0])), 1):
        total += v
        assert got[i] == (n, total)


def test_row_number_only(spark, buckets):
    rows = _rows(2500, 21)
    got = global_order(_frame(spark, rows), [("v", False), ("id", True)])
    assert got.columns == ["id", "v", "_rn"]
    assert [r.id for r in got.orderBy("_rn").collect()] == [i for i, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]


def test_quantiles_interpolate(spark, buckets):
    for n in (1, 2, 5, 2001):
        rows = _rows(n, 5)
        qs = [0.0, 0.2, 0.4, 0.5, 0.6, 0.8, 0.95, 1.0]
        got = quantile_edges(_frame(spark, rows), "v", "id", qs).first()[0]
        assert got == pytest.approx(np.quantile([float(v) for _, v in rows], qs).tolist(), rel=1e-12)


def test_no_plan_orders_customers_products_or_lines_in_one_task(spark, star):
    """Windows without PARTITION BY run over reports of months, countries, segments and
    bucket totals only: their input is an aggregate or a top-k, never a whole table."""
    from shopscope.operators import clv, revenue, rfm
    c = clv.customer_clv(star.clean)
    for df in (rfm.rfm_segments(star.clean), rfm.rfm_describe(star.rfm_segments), revenue.customer_pareto(star.clean),
               revenue.product_pareto(star.clean), clv.clv_stats(c), clv.clv_histogram(c), clv.clv_by_segment(c, star.rfm_segments)):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        for line in buf.getvalue().splitlines():
            if "Window" in line and "windowspecdefinition" in line:
                spec = line[line.index("windowspecdefinition("):]
                first = spec[len("windowspecdefinition("):].split(",")[0]
                assert first.split("#")[0] in ("_bucket", "no", "segment"), line
