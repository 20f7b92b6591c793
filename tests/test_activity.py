"""Month bitsets against sets of months in Python, merging, the cohort reports that read them, and the
month partitions of the fact."""
import contextlib
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from shopscope.functions.calendar import month_ordinal
from shopscope.operators import activity as act
from shopscope.operators import cohorts, reports


def _lines(spark, rows):
    return spark.createDataFrame(rows, "customer_id bigint, mo int")


def _rows(months, n=4000, seed=6):
    rnd = random.Random(seed)
    return [(1 if i % 3 == 0 else rnd.randint(1, 200), rnd.choice(months)) for i in range(n)] + [(7, None)]


def _plain(rows):
    out = {}
    for c, m in rows:
        if m is not None:
            out.setdefault(c, set()).add(m)
    return out


@pytest.mark.parametrize("months", [range(24000, 24003), range(24000, 24200), [63, 64, 127, 128], [24000]])
def test_bitsets_hold_the_months(spark, months):
    rows = _rows(list(months))
    bits = act.activity(_lines(spark, rows).repartition(4), F.col("mo"))
    got = {r.customer_id: (r.cohort_mo, r.active) for r in act.active_months(bits).collect()}
    assert got == {c: (min(m), sorted(m)) for c, m in _plain(rows).items()}
    cells = {}
    for m in _plain(rows).values():
        for x in m:
            cells[min(m), x - min(m)] = cells.get((min(m), x - min(m)), 0) + 1
    assert {(r.cohort_mo, r.cohort_index): r.customers for r in act.cohort_cells(bits).collect()} == cells


def test_merging_loads_is_like_loading_all(spark):
    old, new = _rows(list(range(24000, 24100)), 900, 1), _rows([23900, 24163, 24164], 300, 2)
    one, two = (act.activity(_lines(spark, r), F.col("mo")) for r in (old, new))
    want = {c: (min(m), sorted(m)) for c, m in _plain(old + new).items()}
    for both in (act.merged(one, two), act.merged(two, one), act.merged(act.merged(one, two), two)):
        assert {r.customer_id: (r.cohort_mo, r.active) for r in act.active_months(both).collect()} == want
        assert both.count() == len(want)


def test_empty(spark):
    none = act.activity(_lines(spark, []), F.col("mo"))
    assert act.cohort_cells(none).collect() == [] and act.merged(none, none).collect() == []


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_lines_are_shuffled_once_for_all_cohort_reports(spark, star):
    bits = act.activity(star.fact_sales, reports.sale_month_ordinal(star.fact_sales))
    plan = _plan(bits)
    assert plan.count("\n* HashAggregate") + plan.count("HashAggregate (") >= 2 and "hashpartitioning(customer_id" in plan
    assert "Window" not in plan and "SortAggregate" not in plan
    from_fact = reports.month1_retention(star.fact_sales).collect()
    assert from_fact == reports.month1_retention(None, bitsets=bits).collect()
    own = act.activity(star.clean, month_ordinal(F.col("invoice_ts")))
    assert sorted(cohorts.cohort_counts(star.clean).collect()) == sorted(cohorts.cohort_counts(None, bitsets=own).collect())


def test_wide_form_has_a_column_for_each_month_of_a_long_history(spark):
    rows = [(i % 40, dt.datetime(1990 + i % 12, 1 + i % 11, 3)) for i in range(600)] + [(99, dt.datetime(2003, 5, 1))]
    clean = spark.createDataFrame(rows, "customer_id bigint, invoice_ts timestamp_ntz")
    wide = cohorts.cohort_retention_wide(clean)
    assert wide.columns == ["cohort_month", *map(str, range(161))]
    long = cohorts.cohort_retention_matrix(clean).count()
    assert sum(v is not None for r in wide.collect() for v in r[1:]) == long


def test_periods_read_their_month_folders_only(spark, star):
    fact, days = star.fact_sales, star.dim_date
    for df in (reports.monthly_revenue_trend(fact, "1996-03", "1997-02"), reports.country_revenue_top10(fact, star.dim_customer, since="1996-03"),
               reports.rolling_3m_revenue(fact, until="1997-02")):
        assert "PartitionFilters: [isnotnull(sale_month" in _plan(df)
    assert "dynamicpruning" in _plan(reports.q4_vs_nonq4(fact, days, years=[1996])).lower()
    part = reports.monthly_revenue_trend(fact, "1996-03", "1997-02").collect()
    assert part == [r for r in reports.monthly_revenue_trend(fact).collect() if "1996-03" <= r.revenue_month <= "1997-02"] and len(part) == 12
    unpartitioned = fact.drop("sale_month")
    assert reports.monthly_revenue_trend(unpartitioned, "1996-03", "1997-02").collect() == part
    assert reports.q4_vs_nonq4(fact, days).collect() == reports.q4_vs_nonq4(unpartitioned, days).collect()
    lines = reports.q4_vs_nonq4(fact, days, years=[1996]).agg(F.sum("total_revenue")).first()[0]
    assert lines == fact.where(F.year("date_id") == 1996).agg(F.sum("revenue")).first()[0]
