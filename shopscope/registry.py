"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables under ``sf_dir`` through the
materialised star schema (built once per application and data folder, see
``plans.star.star_for``) or through the raw view.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopscope import schemas
from shopscope.operators import (cleaning, clv, cohorts, integrity, quality, reports, revenue, rfm,
                                 stats)
from shopscope.operators.activity import activity
from shopscope.operators.cells import sales_cells
from shopscope.plans.star import star_for
from shopscope.sources import sinks
from shopscope.sources.events import purchases_as_sales

Query = Callable[[SparkSession, str], DataFrame]


def _s(spark: SparkSession, sf_dir: str):
    return star_for(spark, sf_dir)


# Fixed parameters for the fixture data (the analysis layer takes them as arguments).
HOME_COUNTRY = "NATION_2"
AUDIT_YEAR = 1998


def _raw(spark: SparkSession, sf_dir: str):
    """The raw lines as loaded by the star build (written once per data folder)."""
    return star_for(spark, sf_dir).raw


def _clean(spark: SparkSession, sf_dir: str):
    return star_for(spark, sf_dir).clean


def _clv(spark: SparkSession, sf_dir: str):
    """Per-customer CLV, derived once per star and shared by the CLV reports."""
    return star_for(spark, sf_dir).derived("customer_clv", lambda st: clv.customer_clv(st.clean))


def _bitsets(spark: SparkSession, sf_dir: str):
    """Per-customer month bitsets, derived once per star: every cohort report reads them."""
    return star_for(spark, sf_dir).derived("customer_months", lambda st: activity(st.fact_sales, reports.sale_month_ordinal(st.fact_sales)))


def _cells(spark: SparkSession, sf_dir: str):
    """Bitmaps of orders and customers per month and country, derived once per star."""
    return star_for(spark, sf_dir).derived("sales_cells", lambda st: sales_cells(st.fact_sales, st.dim_customer))


def _cohort_matrix(spark: SparkSession, sf_dir: str):
    """The long cohort retention matrix, derived once per star."""
    bitsets = _bitsets(spark, sf_dir)
    return star_for(spark, sf_dir).derived("cohort_matrix", lambda st: cohorts.cohort_retention_matrix(None, bitsets=bitsets))


def _cust_pareto(spark: SparkSession, sf_dir: str):
    return star_for(spark, sf_dir).derived("customer_pareto", lambda st: revenue.customer_pareto(st.clean))


def _prod_pareto(spark: SparkSession, sf_dir: str):
    return star_for(spark, sf_dir).derived("product_pareto", lambda st: revenue.product_pareto(st.clean))


QUERIES: dict[str, Query] = {
    # ---- report queries (Q-01 ... Q-21) and their two companions
    "rfm_top_customers": lambda s, d: reports.rfm_top_customers(_s(s, d).rfm_segments),
    "segment_scorecard": lambda s, d: reports.segment_scorecard(_s(s, d).rfm_segments),
    "champion_detail": lambda s, d: reports.champion_detail(_s(s, d).rfm_segments, _s(s, d).dim_customer),
    "at_risk_recovery_list": lambda s, d: reports.at_risk_recovery_list(_s(s, d).rfm_segments, _s(s, d).dim_customer),
    "segment_pareto": lambda s, d: reports.segment_pareto(_s(s, d).rfm_segments),
    "at_risk_product_affinity": lambda s, d: reports.at_risk_product_affinity(
        _s(s, d).fact_sales, _s(s, d).dim_product, _s(s, d).rfm_segments),
    "monthly_revenue_trend": lambda s, d: reports.monthly_revenue_trend(_cells(s, d)),
    "country_revenue_top10": lambda s, d: reports.country_revenue_top10(_cells(s, d), _s(s, d).dim_customer),
    "rolling_3m_revenue": lambda s, d: reports.rolling_3m_revenue(_cells(s, d)),
    "q4_vs_nonq4": lambda s, d: reports.q4_vs_nonq4(_s(s, d).fact_sales, _s(s, d).dim_date),
    "top_products": lambda s, d: reports.top_products(_s(s, d).fact_sales, _s(s, d).dim_product),
    "cohort_sizes": lambda s, d: reports.cohort_sizes(None, bitsets=_bitsets(s, d)),
    "cohort_retention_long": lambda s, d: reports.cohort_retention_long(None, bitsets=_bitsets(s, d)),
    "month1_retention": lambda s, d: reports.month1_retention(None, bitsets=_bitsets(s, d)),
    "month1_retention_ranked": lambda s, d: reports.month1_retention_ranked(None, bitsets=_bitsets(s, d)),
    "rolling_retention": lambda s, d: reports.rolling_retention(None, bitsets=_bitsets(s, d)),
    "customer_revenue_rank": lambda s, d: reports.customer_revenue_rank(_s(s, d).fact_sales, _s(s, d).dim_customer),
    "product_dense_rank": lambda s, d: reports.product_dense_rank(_s(s, d).fact_sales, _s(s, d).dim_product),
    "running_total_revenue": lambda s, d: reports.running_total_revenue(_s(s, d).fact_sales),
    "customer_percentile": lambda s, d: reports.customer_percentile(_s(s, d).rfm_segments),
    "revenue_by_decile": lambda s, d: reports.revenue_by_decile(_s(s, d).rfm_segments),
    "mom_growth": lambda s, d: reports.mom_growth(_cells(s, d)),
    "country_contribution": lambda s, d: reports.country_contribution(_cells(s, d), _s(s, d).dim_customer),
}


QUERIES.update({  # operators (C-01 ... C-75, S-03 ... S-07)
    # ---- audit (C-01 ... C-07), on raw rows
    "dq_profile": lambda s, d: quality.dq_profile(_raw(s, d)),
    "dq_sample_rows": lambda s, d: quality.dq_sample_rows(_raw(s, d)),
    "dq_null_audit": lambda s, d: quality.dq_null_audit(_raw(s, d)),
    "dq_rule_counts": lambda s, d: quality.dq_rule_counts(_raw(s, d), _s(s, d).classified),
    "dq_duplicates": lambda s, d: quality.dq_duplicates(_raw(s, d), _s(s, d).classified),
    "dq_duplicate_sample": lambda s, d: quality.dq_duplicate_sample(_raw(s, d), _s(s, d).classified),
    "dq_prefix_counts": lambda s, d: quality.dq_prefix_counts(_raw(s, d)),
    "dq_date_range": lambda s, d: quality.dq_date_range(_raw(s, d)),
    "dq_year_counts": lambda s, d: quality.dq_year_counts(_raw(s, d)),
    "dq_month_counts": lambda s, d: quality.dq_month_counts(_raw(s, d), AUDIT_YEAR),
    "dq_country_distribution": lambda s, d: quality.dq_country_distribution(_raw(s, d)),
    "dq_country_summary": lambda s, d: quality.dq_country_summary(_raw(s, d), HOME_COUNTRY),
    # ---- cleaning (C-10 ... C-14)
    "clean_sales": lambda s, d: _clean(s, d),
    "clean_funnel": lambda s, d: cleaning.funnel_from_classified(_s(s, d).classified),
    "guest_summary": lambda s, d: cleaning.guest_summary(_raw(s, d)),
    "guest_countries": lambda s, d: cleaning.guest_countries(_raw(s, d)),
    "revenue_impact": lambda s, d: cleaning.revenue_impact(_clean(s, d), _raw(s, d)),
    "revenue_stats": lambda s, d: cleaning.revenue_stats(
        cleaning.identified_from_classified(_s(s, d).classified)),
    "smallest_revenue_lines": lambda s, d: cleaning.smallest_revenue_lines(
        cleaning.identified_from_classified(_s(s, d).classified)),
    # ---- RFM (C-20 ... C-26)
    "rfm_base": lambda s, d: rfm.rfm_base(_clean(s, d)),
    "event_rfm_base": lambda s, d: rfm.rfm_base(purchases_as_sales(s, d)),
    "event_rfm_segments": lambda s, d: rfm.rfm_segments(purchases_as_sales(s, d)),
    "rfm_segments_table": lambda s, d: _s(s, d).rfm_segments,
    "segment_distribution": lambda s, d: rfm.segment_distribution(_s(s, d).rfm_segments),
    "segment_revenue": lambda s, d: rfm.segment_revenue(_s(s, d).rfm_segments),
    "rfm_describe": lambda s, d: rfm.rfm_describe(_s(s, d).rfm_segments),
    "rfm_scatter_points": lambda s, d: rfm.rfm_scatter_points(_s(s, d).rfm_segments),
    # ---- cohorts (C-30 ... C-35)
    "cohort_assign": lambda s, d: cohorts.cohort_assign(_clean(s, d), bitsets=_bitsets(s, d)),
    "cohort_counts": lambda s, d: cohorts.cohort_counts(None, bitsets=_bitsets(s, d)),
    "cohort_retention_matrix": lambda s, d: _cohort_matrix(s, d),
    "cohort_retention_wide": lambda s, d: cohorts.cohort_retention_wide(
        None, matrix=_cohort_matrix(s, d)),
    "cohort_milestones": lambda s, d: cohorts.cohort_milestones(None, matrix=_cohort_matrix(s, d)),
    "cohort_curve": lambda s, d: cohorts.cohort_curve(None, matrix=_cohort_matrix(s, d)),
    "avg_retention_curve": lambda s, d: cohorts.avg_retention_curve(None, matrix=_cohort_matrix(s, d)),
    # ---- revenue, geography, concentration (C-40 ... C-49)
    "monthly_summary": lambda s, d: revenue.monthly_summary(_clean(s, d)),
    "month_extremes": lambda s, d: revenue.month_extremes(_clean(s, d)),
    "country_summary": lambda s, d: revenue.country_summary(_clean(s, d)),
    "home_vs_abroad": lambda s, d: revenue.home_vs_abroad(_clean(s, d), HOME_COUNTRY),
    "customer_pareto": lambda s, d: _cust_pareto(s, d),
    "pareto_cutoff": lambda s, d: revenue.pareto_cutoff_from(_cust_pareto(s, d), _prod_pareto(s, d)),
    "top_bottom_share": lambda s, d: revenue.top_bottom_share_from(_cust_pareto(s, d), _prod_pareto(s, d)),
    "product_pareto": lambda s, d: _prod_pareto(s, d),
    "overall_kpis": lambda s, d: revenue.overall_kpis(_clean(s, d), _cells(s, d)),
    "non_product_codes": lambda s, d: revenue.non_product_codes(_clean(s, d)),
    # ---- lifetime value (C-50 ... C-56)
    "customer_clv": lambda s, d: _clv(s, d),
    "clv_stats": lambda s, d: clv.clv_stats(_clv(s, d)),
    "clv_by_segment": lambda s, d: clv.clv_by_segment(_clv(s, d), _s(s, d).rfm_segments),
    "clv_top20": lambda s, d: clv.clv_top20(_clv(s, d), _s(s, d).rfm_segments),
    "clv_top20_share": lambda s, d: clv.clv_top20_share(_clv(s, d)),
    "clv_histogram": lambda s, d: clv.clv_histogram(_clv(s, d)),
    "clv_segment_ratio": lambda s, d: clv.clv_segment_ratio(_clv(s, d), _s(s, d).rfm_segments),
    "recovery_scenario": lambda s, d: clv.recovery_scenario(
        _s(s, d).rfm_segments, cleaning.guest_summary(_raw(s, d))),
    # ---- star schema and integrity (C-60 ... C-62, S-07)
    "dim_customer": lambda s, d: _s(s, d).dim_customer,
    "dim_product": lambda s, d: _s(s, d).dim_product,
    "dim_date": lambda s, d: _s(s, d).dim_date,
    "fact_sales": lambda s, d: _s(s, d).fact_sales.select(*schemas.FACT_SALES.names),
    "fk_orphans": lambda s, d: integrity.fk_orphans(_s(s, d).tables()),
    "pk_violations": lambda s, d: integrity.pk_violations(_s(s, d).tables(), _s(s, d).metrics),
    "load_row_counts": lambda s, d: integrity.load_row_counts(_s(s, d).tables(), _s(s, d).metrics),
    "output_verification": lambda s, d: sinks.output_verification(
        _s(s, d).tables(), f"{_s(s, d).location}/export_csv", "csv"),
    # ---- significance tests (C-70 ... C-75)
    "ttest_champion": lambda s, d: stats.ttest_champion(_s(s, d).rfm_segments),
    "ttest_country": lambda s, d: stats.ttest_country(_clean(s, d), HOME_COUNTRY),
    "chi2_segment_counts": lambda s, d: stats.chi2_segment_counts(_s(s, d).rfm_segments),
    "chi2_segments": lambda s, d: stats.chi2_segments(_s(s, d).rfm_segments),
    "ttest_q4_order_value": lambda s, d: stats.ttest_q4_order_value(_clean(s, d)),
    "ttest_q4_monthly": lambda s, d: stats.ttest_q4_monthly(_clean(s, d)),
    "tests_summary": lambda s, d: stats.tests_summary(_s(s, d).rfm_segments, _clean(s, d), HOME_COUNTRY),
})
