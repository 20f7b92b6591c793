"""Invariants of the reports and the star schema."""
from decimal import Decimal

from pyspark.sql import functions as F

from shopscope.operators import clv, cohorts, integrity, reports, revenue, rfm
from shopscope.plans.star import materialize_star


def test_segment_revenue_sums_to_total(star):
    seg = rfm.segment_revenue(star.rfm_segments)
    assert seg.agg(F.sum("total_revenue")).first()[0] == star.rfm_segments.agg(F.sum("monetary")).first()[0]
    assert seg.agg(F.sum("customer_count")).first()[0] == star.rfm_segments.count()


def test_cohorts(star):
    m = cohorts.cohort_retention_matrix(star.clean)
    assert m.where("cohort_index = 0 and retention_rate != 1").count() == 0
    sizes = reports.cohort_sizes(star.fact_sales)
    assert sizes.agg(F.sum("cohort_size")).first()[0] == star.dim_customer.count()


def test_pareto_ends_at_100(star):
    p = revenue.customer_pareto(star.clean)
    last = p.orderBy(F.desc("rank")).first()
    assert last.cumulative_pct == Decimal("100.0000") and last.rank_pct == Decimal("100.0000")
    assert p.count() == star.dim_customer.count()


def test_keys_and_orphans(star):
    t = star.tables()
    assert all(r.orphan_rows == 0 for r in integrity.fk_orphans(t).collect())
    for r in integrity.pk_violations(t).collect():
        assert r.duplicate_keys == 0 and r.null_keys == 0 and r.not_null_violations == 0, r


def test_load_is_idempotent(spark, star, tmp_path):
    path = str(tmp_path / "star")
    a = materialize_star(star.raw, path)
    counts1 = {r.table_name: r.rows for r in integrity.load_row_counts(a.tables()).collect()}
    b = materialize_star(star.raw, path)
    counts2 = {r.table_name: r.rows for r in integrity.load_row_counts(b.tables()).collect()}
    assert counts1 == counts2
    assert counts1["fact_sales"] == star.fact_sales.count()


def test_sale_id_dense(star):
    f = star.fact_sales
    n = f.count()
    agg = f.agg(F.min("sale_id"), F.max("sale_id"), F.count_distinct("sale_id")).first()
    assert tuple(agg) == (1, n, n)


def test_top_k_rank_exact(star):
    """RANK of the top 20 computed from the 20 rows equals the full window."""
    from pyspark.sql import Window
    got = reports.customer_revenue_rank(star.fact_sales, star.dim_customer).select("customer_id", "revenue_rank")
    per = star.fact_sales.groupBy("customer_id").agg(F.sum("revenue").alias("r"))
    full = per.select("customer_id", F.rank().over(Window.orderBy(F.desc("r"))).alias("revenue_rank"))
    assert got.exceptAll(full.join(got.select("customer_id"), "customer_id")).count() == 0


def test_month_gap_growth(spark):
    """A missing calendar month is stepped over by LAG (rows, not months);
    a zero previous month gives a null growth %, not an error."""
    rows = [("1", 1, "A", "2024-01-15", 1, Decimal("0.00"), Decimal("0.00")),
            ("2", 1, "A", "2024-03-02", 2, Decimal("5.00"), Decimal("10.00"))]
    f = spark.createDataFrame(rows, "invoice string, customer_id bigint, stock_code string, d string, "
                                    "quantity int, price decimal(10,2), revenue decimal(12,2)")
    f = f.withColumn("date_id", F.to_date("d")).drop("d")
    out = {r.revenue_month: r for r in reports.mom_growth(f).collect()}
    assert set(out) == {"2024-01", "2024-03"}
    assert out["2024-03"].prev_month_revenue == Decimal("0.00")
    assert out["2024-03"].growth_pct is None


def test_customer_with_two_countries_first_by_time(spark):
    from shopscope.plans.star import dim_customer
    rows = [("2", "A", "x", 1, "2024-01-01 10:00:00", Decimal("1.0000"), 7, "LATE"),
            ("1", "A", "x", 1, "2024-01-01 09:00:00", Decimal("1.0000"), 7, "EARLY")]
    df = spark.createDataFrame(rows, "invoice string, stock_code string, description string, quantity int, "
                                     "ts string, price decimal(12,4), customer_id bigint, country string")
    df = df.withColumn("invoice_ts", F.to_timestamp_ntz("ts")).drop("ts")
    assert dim_customer(df).first().country == "EARLY"


def test_clv_formula(star):
    c = clv.customer_clv(star.clean).where("total_orders > 1").first()
    expect = (c.aov * c.total_orders * (c.lifespan_years + 1)).quantize(Decimal("0.01"))
    assert abs(c.clv - expect) <= Decimal("0.01")


def test_sale_ids_follow_the_line_order(star):
    from shopscope.plans.star import SALE_ORDER, fact_sales
    key = lambda r: tuple((v is not None, v) for v in r)
    lines = sorted((tuple(r) for r in star.clean.select(*SALE_ORDER).collect()), key=key)
    fact = fact_sales(star.clean).orderBy("sale_id").collect()
    assert [r.sale_id for r in fact] == list(range(1, len(lines) + 1))
    assert [(r.invoice, r.stock_code, r.quantity) for r in fact] == [(x[1], x[2], x[3]) for x in lines]


def test_null_description_first(spark):
    """Keep-first dimension keeps a leading null description; the product
    Pareto table takes the first non-null one."""
    from shopscope.operators.revenue import product_revenue
    from shopscope.plans.star import dim_product
    rows = [("1", "P", None, 1, "2024-01-01 09:00:00", Decimal("1.0000"), 7, "N"),
            ("2", "P", "LATER NAME", 1, "2024-01-02 09:00:00", Decimal("1.0000"), 7, "N")]
    df = spark.createDataFrame(rows, "invoice string, stock_code string, description string, quantity int, "
                                     "ts string, price decimal(12,4), customer_id bigint, country string")
    df = df.withColumn("invoice_ts", F.to_timestamp_ntz("ts")).drop("ts").withColumn(
        "revenue", (F.col("quantity") * F.col("price")).cast("decimal(18,4)"))
    assert dim_product(df).first().description is None
    assert product_revenue(df).first().description == "LATER NAME"


def test_star_does_not_depend_on_the_buckets(spark, star, tmp_path):
    """The whole star built with another number of ordering buckets is the
    same, table for table."""
    spark.conf.set("shopscope.ordering.buckets", "3")
    try:
        b = materialize_star(star.raw, str(tmp_path / "bucketed"))
        for name in ("fact_sales", "rfm_segments", "dim_customer", "dim_product", "dim_date"):
            x, y = star.tables()[name], b.tables()[name]
            assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name
    finally:
        spark.conf.unset("shopscope.ordering.buckets")


def test_planted_faults_are_counted(spark, star):
    """C-61 / C-62 with orphans, a repeated key and a null key."""
    t = dict(star.tables())
    fact = t["fact_sales"]
    lost = fact.agg({"stock_code": "min"}).first()[0]
    t["dim_product"] = t["dim_product"].where(F.col("stock_code") != lost)
    row = {(r.child_table, r.child_column): r.orphan_rows for r in integrity.fk_orphans(t).collect()}
    assert row[("fact_sales", "stock_code")] == fact.where(F.col("stock_code") == lost).count() > 0
    assert row[("fact_sales", "customer_id")] == 0
    one = t["dim_customer"].limit(1)
    t["dim_customer"] = t["dim_customer"].union(one).union(one.withColumn("customer_id", F.lit(None).cast("bigint")))
    bad = {r.table_name: r for r in integrity.pk_violations(t).collect()}["dim_customer"]
    assert (bad.duplicate_keys, bad.null_keys) == (1, 1)


def test_top_lists_keep_k_rows_with_an_orphan(star):
    """The cut to k rows comes after rows without a parent are gone."""
    full = reports.top_products(star.fact_sales, star.dim_product, 5).collect()
    without = star.dim_product.where(F.col("stock_code") != full[0].stock_code)
    assert [r.stock_code for r in reports.top_products(star.fact_sales, without, 5).collect()][:4] == [r.stock_code for r in full[1:]]


def test_wide_cohorts_do_not_drop_late_activity(spark):
    import pytest

    from shopscope.operators.cohorts import cohort_retention_wide

    matrix = spark.createDataFrame([("2020-01", 0, 1.0), ("2020-01", 2, 0.5)], "cohort_month string, cohort_index int, retention_rate double")
    assert [tuple(r) for r in cohort_retention_wide(None, 2, matrix=matrix).collect()] == [("2020-01", 1.0, None, 0.5)]
    with pytest.raises(Exception, match="cohort index above 1: 2"):
        cohort_retention_wide(None, 1, matrix=matrix).collect()
