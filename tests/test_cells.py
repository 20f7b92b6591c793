"""Distinct counts from bitmaps against COUNT(DISTINCT) over lines."""
import contextlib
import datetime as dt
import io
import random
from decimal import Decimal

from pyspark.sql import functions as F

from shopscope.operators import reports, revenue
from shopscope.operators.cells import rolled_up, sales_cells


def _frames(spark, n=6000, invoices=45_000):
    """Invoices that span months and customers, a customer with a third of all lines, customers that the
    dimension lacks or has no country for; enough invoices for several buckets."""
    rnd = random.Random(3)
    rows = [(i, f"i{rnd.randrange(invoices)}", 1 if i % 3 == 0 else rnd.randrange(2, 300), dt.date(2020 + rnd.randrange(2), 1 + rnd.randrange(12), 5), Decimal(rnd.randrange(10 ** 6)).scaleb(-2))
            for i in range(n)]
    fact = spark.createDataFrame(rows, "sale_id bigint, invoice string, customer_id bigint, date_id date, revenue decimal(12,2)")
    fact = fact.withColumn("sale_month", (F.year("date_id") * 100 + F.month("date_id")).cast("int")).withColumn("quantity", F.lit(1)).withColumn("price", F.col("revenue")).repartition(4)
    dim = spark.createDataFrame([(c, None if c % 41 == 0 else f"c{c % 7}") for c in range(1, 290)], "customer_id bigint, country string")
    return fact, dim


def test_counts_roll_up_by_any_dimension(spark):
    fact, dim = _frames(spark, 60_000)
    cells = sales_cells(fact, dim).cache()
    assert cells.where("what = 'order'").select("bucket").distinct().count() >= 2
    joined = fact.join(dim.withColumn("known", F.lit(True)), "customer_id", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    for by in ([], ["sale_month"], ["country", "known"], ["sale_month", "country", "known"]):
        plain = joined.groupBy(*by).agg(F.sum("revenue").alias("_rev"), F.count_distinct("invoice").alias("total_orders"), F.count_distinct("customer_id").alias("unique_customers"))
        got = rolled_up(cells, *by)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str), by


def test_reports_from_cells_equal_those_from_lines(spark, star):
    for fact, dim in ((star.fact_sales, star.dim_customer), _frames(spark)):
        cells = sales_cells(fact, dim)
        for report in (reports.monthly_revenue_trend, reports.rolling_3m_revenue, reports.mom_growth):
            assert report(cells).collect() == report(fact).collect()
        assert reports.country_revenue_top10(cells, dim).collect() == reports.country_revenue_top10(fact, dim).collect()
        assert reports.country_contribution(cells, dim).collect() == reports.country_contribution(fact, dim).collect()
        since = "1996-03" if fact is star.fact_sales else "2020-06"
        assert reports.monthly_revenue_trend(cells, since=since).collect() == reports.monthly_revenue_trend(fact, since=since).collect()
    assert revenue.overall_kpis(star.clean, sales_cells(star.fact_sales, star.dim_customer)).collect() == revenue.overall_kpis(star.clean).collect()


def test_cells_are_bounded_and_need_no_expand(spark, star):
    cells = sales_cells(star.fact_sales, star.dim_customer)
    months, countries = (star.fact_sales.select("sale_month").distinct().count(), star.dim_customer.select("country").distinct().count())
    assert cells.where("what = 'revenue'").count() <= months * countries
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        reports.monthly_revenue_trend(cells).explain()
    assert "Expand" not in buf.getvalue()


def test_empty(spark, star):
    cells = sales_cells(star.fact_sales.where("false"), star.dim_customer)
    assert reports.monthly_revenue_trend(cells).collect() == []
    assert [tuple(r)[1:] for r in rolled_up(cells).collect()] == [(0, 0)]
