"""The raw sales-line view over the TPC-H-style tables.

Each line item becomes one sales line (invoice = order, stock code = part,
country = the customer's nation). On top of that mapping the view injects
every data-quality issue the cleaning funnel handles: cancelled invoices
('C' prefix, negative quantity), stock adjustments (negative quantity without
'C'), zero and near-zero prices, guest lines (no customer), missing
descriptions, non-product codes, repeated rows, times of day and customers
seen under two countries. The same definition exists as SQL text for the DuckDB oracle, so
both engines see identical rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope import schemas
from shopscope.sources.tables import read_table

# Fixed values of the raw-view definition (they must equal the oracle text).
CANCEL_EVERY = 50        # ok % 50 = 0 -> 'C' invoice, negated quantity
ADJUST_EVERY = 97        # (ok + ln) % 97 = 0 -> negated quantity
NULL_DESC_EVERY = 83     # pk % 83 = 0 -> null description
ZERO_PRICE_EVERY = 43    # (ok + ln) % 43 = 0 -> price 0
TINY_PRICE_EVERY = 211   # (ok + ln) % 211 = 0 -> price 0.0001
MANUAL_EVERY = 101       # pk % 101 = 0 -> stock code 'M'
POSTAGE_EVERY = 103      # pk % 103 = 0 -> stock code 'POST'
GUEST_EVERY = 5          # ck % 5 = 0 -> null customer
OTHER_COUNTRY_EVERY = 20  # ok % 20 = 0 -> country 'NATION_0'
REPEAT_EVERY = 31        # ok % 31 = 0 -> line appears twice
MINUTES_MOD = 600        # time of day = (ok % 600) minutes


def _every(c: Column, n: int) -> Column:
    return (c % F.lit(n)) == 0


def raw_sales_from_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation is a fixed 25-row code table: broadcasting it is size-bounded.
    na = F.broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    pa = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")

    # Order-level attributes first (orders x customer x nation), then the
    # line stream joins them on the order key and the parts on the part key:
    # at scale the wide line stream is exchanged twice, not three times.
    # Customer / part joins are left to AQE: broadcast when their measured
    # size is under the threshold, otherwise a (skew-split) sort-merge join.
    order_attrs = (od.join(cu, od.o_custkey == cu.c_custkey)
                     .join(na, cu.c_nationkey == na.n_nationkey)
                     .select("o_orderkey", "o_custkey", "o_orderdate", "n_name"))
    base = (li.join(order_attrs, li.l_orderkey == order_attrs.o_orderkey)
              .join(pa, li.l_partkey == pa.p_partkey))
    ok, ln, pk, ck = (F.col("l_orderkey"), F.col("l_linenumber"),
                      F.col("l_partkey"), F.col("o_custkey"))
    q = F.col("l_quantity").cast("int")
    pr = F.col("p_retailprice").cast(schemas.MONEY4)
    okln = ok + ln
    cancelled = _every(ok, CANCEL_EVERY)
    lines = base.select(
        ok.alias("_ok"),
        F.when(cancelled, F.concat(F.lit("C"), ok.cast("string")))
         .otherwise(ok.cast("string")).alias("invoice"),
        F.when(_every(pk, MANUAL_EVERY), F.lit("M")).when(_every(pk, POSTAGE_EVERY), F.lit("POST"))
         .otherwise(pk.cast("string")).alias("stock_code"),
        F.when(_every(pk, NULL_DESC_EVERY), F.lit(None).cast("string"))
         .otherwise(F.col("p_name")).alias("description"),
        F.when(cancelled | _every(okln, ADJUST_EVERY), -q).otherwise(q).alias("quantity"),
        (F.col("o_orderdate")
         + F.make_dt_interval(F.lit(0), F.lit(0), (ok % MINUTES_MOD).cast("int"))
         ).alias("invoice_ts"),
        F.when(_every(okln, ZERO_PRICE_EVERY), F.lit(0).cast(schemas.MONEY4))
         .when(_every(okln, TINY_PRICE_EVERY), F.lit("0.0001").cast(schemas.MONEY4))
         .otherwise(pr).alias("price"),
        F.when(_every(ck, GUEST_EVERY), F.lit(None).cast("bigint"))
         .otherwise(ck).alias("customer_id"),
        F.when(_every(ok, OTHER_COUNTRY_EVERY), F.lit("NATION_0"))
         .otherwise(F.col("n_name")).alias("country"),
    )
    # Repeated lines appear twice: one pass over the joined stream emits the
    # copy (equal to a UNION ALL with the filtered stream, without joining twice).
    copies = F.when(_every(F.col("_ok"), REPEAT_EVERY), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    cols = [f.name for f in schemas.RAW_SALES.fields]
    return lines.withColumn("_copy", F.explode(copies)).select(*cols)


# The same view as SQL text, for DuckDB (the oracle) and for Spark SQL users.
RAW_SALES_SQL = """
rs_base AS (
  SELECT l.l_orderkey AS ok, l.l_linenumber AS ln, l.l_partkey AS pk, o.o_custkey AS ck,
         o.o_orderdate + INTERVAL '1' MINUTE * CAST(l.l_orderkey % 600 AS INT) AS ts, n.n_name, p.p_name,
         CAST(l.l_quantity AS INT) AS q, CAST(p.p_retailprice AS DECIMAL(12,4)) AS pr
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
), rs_issues AS (
  SELECT ok, CASE WHEN ok % 50 = 0 THEN concat('C', CAST(ok AS STRING)) ELSE CAST(ok AS STRING) END AS invoice,
         CASE WHEN pk % 101 = 0 THEN 'M' WHEN pk % 103 = 0 THEN 'POST' ELSE CAST(pk AS STRING) END AS stock_code,
         CASE WHEN pk % 83 = 0 THEN NULL ELSE p_name END AS description,
         CASE WHEN ok % 50 = 0 OR (ok + ln) % 97 = 0 THEN -q ELSE q END AS quantity,
         ts AS invoice_ts,
         CASE WHEN (ok + ln) % 43 = 0 THEN CAST(0 AS DECIMAL(12,4))
              WHEN (ok + ln) % 211 = 0 THEN CAST(0.0001 AS DECIMAL(12,4)) ELSE pr END AS price,
         CASE WHEN ck % 5 = 0 THEN NULL ELSE ck END AS customer_id,
         CASE WHEN ok % 20 = 0 THEN 'NATION_0' ELSE n_name END AS country
  FROM rs_base
), raw_sales AS (
  SELECT invoice, stock_code, description, quantity, invoice_ts, price, customer_id, country FROM rs_issues
  UNION ALL
  SELECT invoice, stock_code, description, quantity, invoice_ts, price, customer_id, country FROM rs_issues WHERE ok % 31 = 0
)"""
