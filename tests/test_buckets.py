"""Lines bucketed by customer: same figures, no exchange of bucketed lines, heavy customers apart."""
import contextlib
import io

import pytest
from pyspark.sql import functions as F

from shopscope.operators import clv, reports, revenue, rfm
from shopscope.plans import buckets


@pytest.fixture(scope="module")
def by_customer(spark, star):
    spark.sql("CREATE DATABASE IF NOT EXISTS shopscope_buckets")
    big = star.clean.agg(F.max("customer_id")).first()[0]
    # one customer with a third of all lines
    lines = star.clean.withColumn("customer_id", F.when(F.pmod(F.xxhash64("invoice", "stock_code"), F.lit(3)) == 0, F.lit(big + 1)).otherwise(F.col("customer_id")))
    return lines, big + 1, buckets.store(lines, "shopscope_buckets", "lines", 8)


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _same(a, b):
    assert sorted(a.select(*b.columns).collect(), key=str) == sorted(b.collect(), key=str)


def test_parts_hold_all_lines_and_large_customers_apart(by_customer):
    lines, big, by = by_customer
    _same(by.lines(), lines)
    heavy = [r[0] for r in by.heavy.select("customer_id").distinct().collect()]
    counts = {r.customer_id: r["count"] for r in lines.groupBy("customer_id").count().collect()}
    assert big in heavy and len(heavy) < 16 and sorted(heavy) == sorted(c for c, n in counts.items() if 16 * n > sum(counts.values()))
    sizes = [r["count"] for r in by.bucketed.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < sum(counts.values()) / 4


@pytest.mark.parametrize("figure", [clv.customer_clv, revenue.customer_revenue, rfm.customer_orders])
def test_per_customer_figures_without_exchange(by_customer, figure):
    lines, _, by = by_customer
    _same(by.each(figure), figure(lines))
    assert "Exchange" in _plan(figure(lines)) and "Exchange" not in _plan(figure(by.bucketed))


def test_joins_and_reports_by_customer(spark, star, by_customer):
    spark.sql("CREATE DATABASE IF NOT EXISTS shopscope_buckets")
    fact = buckets.store(star.fact_sales, "shopscope_buckets", "fact", 8)
    revenue_of = lambda f: f.groupBy("customer_id").agg(F.sum("revenue").alias("r"))
    _same(fact.each(revenue_of), revenue_of(star.fact_sales))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = fact.bucketed.select("customer_id", "sale_id").join(by_customer[2].bucketed.select("customer_id", "invoice"), "customer_id")
        plan = _plan(both)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert reports.customer_revenue_rank(fact.lines(), star.dim_customer).collect() == reports.customer_revenue_rank(star.fact_sales, star.dim_customer).collect()


def test_empty(spark, star):
    spark.sql("CREATE DATABASE IF NOT EXISTS shopscope_buckets")
    by = buckets.store(star.clean.where("false"), "shopscope_buckets", "none", 4)
    assert by.each(clv.customer_clv).collect() == []
