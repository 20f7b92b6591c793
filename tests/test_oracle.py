"""Every registered query against its DuckDB oracle on the smallest
fixture (same comparison as the driver's correctness gate)."""
import duckdb
import pytest

import __spark_entry__ as entry
from scripts.check_oracle import TABLES, digest
from shopscope.oracle import ORACLE
from shopscope.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(srows, df.columns)[0] == digest(orows, ocols)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "segment" in df.columns


def test_every_query_has_oracle_or_is_listed():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_oracle_takes_nothing_from_what_it_checks():
    import ast

    import shopscope.oracle as module
    tree = ast.parse(open(module.__file__).read())
    names = {n.module for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)}
    assert names <= {"__future__", "shopscope", "shopscope.sources.raw_view"}


# the last ORDER BY of each report, as (column, descending)
REPORT_ORDERS = {
    "rfm_top_customers": "-monetary", "segment_scorecard": "-total_revenue", "champion_detail": "-total_spent",
    "at_risk_recovery_list": "-total_spent", "segment_pareto": "-total_revenue", "at_risk_product_affinity": "-total_revenue",
    "monthly_revenue_trend": "revenue_month", "country_revenue_top10": "-total_revenue", "rolling_3m_revenue": "revenue_month",
    "q4_vs_nonq4": "-is_q4", "top_products": "-total_revenue", "cohort_sizes": "cohort_month",
    "cohort_retention_long": "cohort_month", "month1_retention": "cohort_month", "month1_retention_ranked": "-retention_pct",
    "rolling_retention": "cohort_month", "customer_revenue_rank": "revenue_rank", "product_dense_rank": "revenue_rank",
    "running_total_revenue": "revenue_month", "customer_percentile": "-total_revenue", "revenue_by_decile": "decile",
    "mom_growth": "revenue_month", "country_contribution": "-total_revenue", "clv_top20": "-clv", "clv_by_segment": "-avg_clv",
    "segment_distribution": "-customer_count", "segment_revenue": "-total_revenue",
}


@pytest.mark.parametrize("key", sorted(REPORT_ORDERS))
def test_reports_come_in_their_order(spark, key):
    column = REPORT_ORDERS[key].lstrip("-")
    got = [r[column] for r in entry.queries()[key](spark, SF).collect()]
    known = [v for v in got if v is not None]
    assert known == sorted(known, reverse=REPORT_ORDERS[key].startswith("-")) and len(got) > 1


def test_plans_have_no_cartesian_or_python(spark):
    """No registered query plans a Cartesian product, a nested-loop join or
    a Python UDF (checked on the physical plans at the smallest scale)."""
    import contextlib
    import io
    bad = {}
    for key, fn in QUERIES.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, SF).explain()
        plan = buf.getvalue()
        hits = [w for w in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                            "ArrowEvalPython", "PythonUDF") if w in plan]
        if hits:
            bad[key] = hits
    assert bad == {}
