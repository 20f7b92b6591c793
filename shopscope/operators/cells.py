"""Exact distinct counts that roll up: bitmaps of orders and customers per month and country.

A distinct count of a month can't be added to that of another; a bitmap can be
OR-ed. Orders and customers get dense numbers, and each cell (month, country of
the customer) holds the bitmaps of its orders and its customers, in buckets of
32,768 numbers, next to its revenue. Any report by month, by country or in
total is then one small aggregate over the cells. Orders are numbered by month
and customers by country, so the bits of a cell lie together and buckets are
full rather than many.

Lines are shuffled once, to orders; everything after works on orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.plans.ordering import durable, global_order


def _numbered(rows: DataFrame, at_most: int, *order: str) -> DataFrame:
    """The rows, ``at_most`` so many, with ``no``, their place (from 0) in a total order."""
    return global_order(rows, [(c, True) for c in order], rows=at_most).withColumn("no", F.col("_rn") - 1).drop("_rn")


def _bits(rows: DataFrame, what: str, no: str) -> DataFrame:
    # a bitmap is as long with one bit as with all: places are moved, each once, and every bitmap is made in one task, of 32,768 places at most
    cell = ["sale_month", "country", "known", "bucket"]
    places = rows.select(*cell[:3], F.bitmap_bucket_number(F.col(no)).alias("bucket"), F.bitmap_bit_position(F.col(no)).alias("place")).distinct()
    per = places.repartition(*cell).groupBy(*cell).agg(F.bitmap_construct_agg(F.col("place")).alias("bits"))
    return per.select("sale_month", "country", "known", F.lit(what).alias("what"), "bucket", "bits", F.lit(None).cast("decimal(38,2)").alias("revenue"))


def sales_cells(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """(sale_month, country, known, what, bucket, bits, revenue): per cell the bitmaps of its 'order's and
    'customer's and one row with its 'revenue'. ``known``: the customers are in the dimension, so the
    country is theirs; other lines have cells of their own, without a country."""
    orders = durable(fact.groupBy("sale_month", "invoice", "customer_id").agg(F.sum("revenue").alias("revenue")))
    n = orders.count()
    invoices = _numbered(orders.groupBy("invoice").agg(F.min("sale_month").alias("_first")), n, "_first", "invoice").select("invoice", F.col("no").alias("order_no"))
    everyone = orders.select("customer_id").distinct().join(dim_customer.select("customer_id", "country", F.lit(True).alias("known")), "customer_id", "left")
    customers = _numbered(everyone, n, "country", "customer_id").withColumnRenamed("no", "customer_no").withColumn("known", F.coalesce("known", F.lit(False)))
    rows = durable(orders.join(invoices, "invoice").join(customers, "customer_id").select("sale_month", "country", "known", "order_no", "customer_no", "revenue"))
    revenue = rows.groupBy("sale_month", "country", "known").agg(F.sum("revenue").cast("decimal(38,2)").alias("revenue"))
    revenue = revenue.select("sale_month", "country", "known", F.lit("revenue").alias("what"), F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("bits"), "revenue")
    return _bits(rows, "order", "order_no").unionByName(_bits(rows, "customer", "customer_no")).unionByName(revenue)


def rolled_up(cells: DataFrame, *by: str) -> DataFrame:
    """(by..., _rev, total_orders, unique_customers) of the cells put together."""
    put = cells.groupBy(*by, "what", "bucket").agg(F.bitmap_or_agg(F.col("bits")).alias("_bits"), F.sum("revenue").alias("_r"))
    n = F.bitmap_count(F.col("_bits"))
    count = lambda what: F.coalesce(F.sum(F.when(F.col("what") == what, n)), F.lit(0)).cast("bigint")
    return put.groupBy(*by).agg(F.sum("_r").cast("decimal(38,2)").alias("_rev"), count("order").alias("total_orders"), count("customer").alias("unique_customers"))
