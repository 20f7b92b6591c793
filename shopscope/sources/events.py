"""Purchase events as sales lines.

The ``events`` table carries purchases with times of day (the order
tables only have midnight dates). Each purchase event becomes one sales
line of its own invoice: customer = user, price = revenue = value. This
lets the recency rule (whole elapsed days, not midnights crossed) run on
real intra-day timestamps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope import schemas
from shopscope.sources.tables import read_table


def purchases_as_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    price = F.col("value").cast(schemas.MONEY4)
    return ev.select(
        F.col("event_id").cast("string").alias("invoice"),
        F.lit(None).cast("string").alias("stock_code"),
        F.lit(None).cast("string").alias("description"),
        F.lit(1).alias("quantity"),
        F.col("ts").cast("timestamp_ntz").alias("invoice_ts"),
        price.alias("price"),
        F.col("user_id").alias("customer_id"),
        F.lit(None).cast("string").alias("country"),
        price.cast(schemas.REV4).alias("revenue"))
