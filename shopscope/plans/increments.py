"""Reports kept up month by month, without reading the history's lines again.

A load of some months' raw lines is cleaned and reduced to order states: one row
per (month, customer, invoice) with revenue, lines, first and last time. States
of different months merge by sum, minimum and maximum, so the customer table
(recency, frequency, monetary), lifetime value, month bitsets with all cohort
reports and the monthly summary all come from the stored states, which are a
fraction of the lines. Copies of a line have the same time, so they are in the
same month, and cleaning a month by itself gives what cleaning everything does.

Each month is a load of its own in a ``Ledger``: a month that is loaded again
replaces itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.functions.exact import money_even, ratio
from shopscope.operators import cleaning, clv, rfm
from shopscope.operators.activity import activity
from shopscope.plans.star import sale_month
from shopscope.sources.ledger import Ledger

STATES = "order_states"


def order_states(clean: DataFrame) -> DataFrame:
    """(sale_month, customer_id, invoice, order_revenue, lines, first_ts, last_ts) of cleaned lines."""
    lines = clean.withColumn("sale_month", sale_month("invoice_ts"))
    return lines.groupBy("sale_month", "customer_id", "invoice").agg(
        F.sum("revenue").cast("decimal(38,4)").alias("order_revenue"), F.count(F.lit(1)).alias("lines"),
        F.min("invoice_ts").alias("first_ts"), F.max("invoice_ts").alias("last_ts"))


class MonthlyReports:
    """The stored order states under ``root`` and the reports that follow from them."""

    def __init__(self, spark: SparkSession, root: str):
        self.ledger = Ledger(spark, root)

    def add(self, raw: DataFrame, months: Sequence[int] | None = None) -> list[int]:
        """Load all raw lines of some months (yyyymm; by default those found in ``raw``), which replace
        what was stored of these months. Lines without a time are left out, as cleaned reports by month
        have no place for them. Returns the months loaded."""
        states = order_states(cleaning.clean_sales(raw.where("invoice_ts is not null")))
        at = f"{self.ledger.root}/{STATES}/{uuid.uuid4().hex}"
        # one pass over the lines for all months: a folder each
        states.repartitionByRange("sale_month", "customer_id").write.partitionBy("sale_month").parquet(at)
        if months is None:  # as many rows as the load has months
            months = [r[0] for r in raw.where("invoice_ts is not null").select(sale_month("invoice_ts")).distinct().collect()]
        found = set(self.ledger._names(at))  # noqa: SLF001
        self.ledger.publish({f"{m}": ({STATES: f"{at}/sale_month={m}"} if f"sale_month={m}" in found else {}) for m in months})
        return sorted(months)

    def states(self, since: int | None = None, until: int | None = None) -> DataFrame:
        """The stored states of the months ``since`` to ``until``, with their month."""
        kept = lambda m: (since is None or int(m) >= since) and (until is None or int(m) <= until)
        # the month is part of the folder's name, as of a partition
        rows = self.ledger.read(STATES, kept)
        return rows.select(F.regexp_extract(F.col("_metadata.file_path"), "sale_month=([0-9]+)", 1).cast("int").alias("sale_month"), "*")

    def orders(self) -> DataFrame:
        """One row per (customer, invoice), as ``rfm.customer_orders`` of all lines."""
        return self.states().groupBy("customer_id", "invoice").agg(
            F.sum("order_revenue").cast("decimal(38,4)").alias("order_revenue"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))

    def rfm_base(self) -> DataFrame:
        return rfm.base_of_orders(self.orders())

    def customer_clv(self) -> DataFrame:
        return clv.clv_of_orders(self.orders())

    def bitsets(self) -> DataFrame:
        """Month bitsets for the cohort reports (their ``bitsets=``)."""
        return activity(self.states(), F.expr("(sale_month div 100) * 12 + sale_month % 100 - 1").cast("int"))

    def monthly_summary(self, since: int | None = None, until: int | None = None) -> DataFrame:
        """C-40 from the states: an order has one state in each month."""
        per = self.states(since, until).groupBy("sale_month", "invoice", "customer_id").agg(F.sum("order_revenue").alias("_rev"))
        g = per.groupBy("sale_month").agg(F.sum("_rev").cast("decimal(38,4)").alias("_rev"), F.count_distinct("invoice").alias("orders"),
                                          F.count_distinct("customer_id").alias("customers"))
        return g.select(F.format_string("%04d-%02d", F.expr("sale_month div 100").cast("int"), F.expr("sale_month % 100").cast("int")).alias("year_month"),
                        money_even("_rev").alias("revenue"), "orders", "customers",
                        ratio("_rev", "orders", 2, num_scale=4, half_even=True).alias("aov"))
