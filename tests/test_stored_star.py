"""Tables are written on first read, in shares that follow the input's size, and nothing is sorted only to be written."""
import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from shopscope import schemas
from shopscope.operators import cells
from shopscope.plans import marks, ordering
from shopscope.plans.star import StoredStar, fact_sales, stored_star
from shopscope.session import writing


def _raw(spark, n=400):
    t = dt.datetime(2024, 1, 1)
    rows = [(f"{'C' if i % 40 == 0 else ''}{i // 4}", f"p{i % 7}", f"text {i % 3}", 1 + i % 5, t + dt.timedelta(days=i // 8 * 3), Decimal("2.5000"), None if i % 9 == 0 else i // 4 % 11, "N") for i in range(n)]
    return spark.createDataFrame(rows + rows[:50], schemas.RAW_SALES).repartition(3)


def test_a_table_is_written_when_it_is_read(spark, tmp_path):
    star = stored_star(_raw(spark), str(tmp_path / "star"))
    assert isinstance(star, StoredStar) and not os.path.exists(star.location)
    assert star.rfm_segments.count() == 11
    assert sorted(os.listdir(star.location)) == ["classified_sales", "raw_sales", "rfm_segments"]
    before = os.path.getmtime(f"{star.location}/rfm_segments/_SUCCESS")
    assert {n: m["n"] for n, m in star.metrics.items()} == {n: star.tables()[n].count() for n in StoredStar.TABLES}
    assert os.path.getmtime(f"{star.location}/rfm_segments/_SUCCESS") == before  # once


def test_folders_are_written_without_a_sort(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 7).cast("int").alias("step_no"), "id")
    key = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(key)
    with writing(spark, 1 << 30):
        with writing(spark):  # writers overlap
            pass
        assert int(spark.conf.get(key)) >= 7 and spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "128"
        df.write.partitionBy("step_no").parquet(str(tmp_path / "t"))
    assert spark.conf.get(key) == old and spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None
    # a task that met all seven folders wrote one file in each: its rows stayed in the order in which they came
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 1000 and back.select("step_no").distinct().count() == 7


def test_shares_follow_the_rows(spark):
    assert ordering._buckets(spark) == ordering._buckets(spark, 10) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert ordering._buckets(spark, 200 << 20) == 200
    df = spark.range(1)
    assert marks._places(df) == marks._places(df, 1000) == 1 << 24
    assert marks._places(df, 36_000_000) == 1 << 25 and marks._places(df, 10 ** 12) == marks.MOST_PLACES


def test_fact_lines_that_differ_in_unseen_text_alone(spark):
    """The fact is numbered without the country and the description of its lines: the same table."""
    t = dt.datetime(2024, 5, 1)
    rows = [("1", "a", d, 2, t, Decimal("3.0000"), 5, c, Decimal("6.0000")) for d in (None, "x", "y") for c in ("N", "M")]
    rows += [("0", "b", None, 1, t, Decimal("1.0000"), 4, "N", Decimal("1.0000"))]
    names = "invoice string, stock_code string, description string, quantity int, invoice_ts timestamp_ntz, price decimal(12,4), customer_id bigint, country string, revenue decimal(18,4)"
    got = fact_sales(spark.createDataFrame(rows, names).repartition(4), len(rows)).orderBy("sale_id").collect()
    assert [(r.sale_id, r.invoice) for r in got] == [(1, "0")] + [(i, "1") for i in range(2, 8)]
    assert {tuple(r)[1:] for r in got[1:]} == {("1", 5, "a", t.date(), 2, Decimal("3.00"), Decimal("6.00"), 202405)}


def test_bitmaps_are_made_where_their_cell_is(spark):
    """A bit each is moved, not a bitmap per task: the aggregate that makes them has no exchange before its end."""
    n = 70_000
    rows = spark.range(n).select(F.expr("202401 + id div 1000000").alias("sale_month"), F.expr("concat('N', id div 1000000)").alias("country"), (F.col("id") >= 0).alias("known"),
                                 F.col("id").alias("order_no"), (F.col("id") % 5).alias("customer_no")).repartition(6)
    for no, what, bits in (("order_no", "order", n), ("customer_no", "customer", 5)):
        made = cells._bits(rows, what, no)
        assert made.agg(F.sum(F.bitmap_count("bits"))).first()[0] == bits
        plan = made._jdf.queryExecution().executedPlan().toString().splitlines()  # noqa: SLF001
        making = [i for i, line in enumerate(plan) if "bitmap_construct_agg" in line]
        exchanges = [i for i, line in enumerate(plan) if "Exchange" in line]
        assert making and max(making) < min(exchanges)
