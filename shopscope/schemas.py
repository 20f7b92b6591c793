"""Explicit schemas for every table of the workload (no inference).

The star-schema tables mirror the declared relational model: one fact table
of sale lines, three dimensions and the per-customer segment table.
"""

from pyspark.sql import types as T

MONEY4 = T.DecimalType(12, 4)   # unit price before the near-zero revenue test
REV4 = T.DecimalType(18, 4)     # line revenue in the cleaned table
PRICE2 = T.DecimalType(10, 2)   # fact price
REV2 = T.DecimalType(12, 2)     # fact line revenue
TOTAL2 = T.DecimalType(18, 2)   # sums of revenue

RAW_SALES = T.StructType([
    T.StructField("invoice", T.StringType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("invoice_ts", T.TimestampNTZType()),
    T.StructField("price", MONEY4),
    T.StructField("customer_id", T.LongType()),
    T.StructField("country", T.StringType()),
])

CLEAN_SALES = T.StructType(RAW_SALES.fields + [T.StructField("revenue", REV4)])

DIM_CUSTOMER = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("country", T.StringType(), False),
])

DIM_PRODUCT = T.StructType([
    T.StructField("stock_code", T.StringType(), False),
    T.StructField("description", T.StringType()),
])

DIM_DATE = T.StructType([
    T.StructField("date_id", T.DateType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("day", T.IntegerType(), False),
    T.StructField("quarter", T.IntegerType(), False),
    T.StructField("month_name", T.StringType(), False),
    T.StructField("is_q4", T.IntegerType(), False),
])

FACT_SALES = T.StructType([
    T.StructField("sale_id", T.LongType(), False),
    T.StructField("invoice", T.StringType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("stock_code", T.StringType(), False),
    T.StructField("date_id", T.DateType(), False),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("price", PRICE2, False),
    T.StructField("revenue", REV2, False),
])

RFM_SEGMENTS = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("recency", T.IntegerType(), False),
    T.StructField("frequency", T.LongType(), False),
    T.StructField("monetary", TOTAL2, False),
    T.StructField("r_score", T.IntegerType(), False),
    T.StructField("f_score", T.IntegerType(), False),
    T.StructField("m_score", T.IntegerType(), False),
    T.StructField("rfm_score", T.StringType(), False),
    T.StructField("rfm_total", T.IntegerType(), False),
    T.StructField("segment", T.StringType(), False),
])

STAR_TABLES = {
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_date": DIM_DATE,
    "fact_sales": FACT_SALES,
    "rfm_segments": RFM_SEGMENTS,
}

# Primary keys and NOT NULL columns as declared by the relational model.
PRIMARY_KEYS = {
    "dim_customer": ["customer_id"],
    "dim_product": ["stock_code"],
    "dim_date": ["date_id"],
    "fact_sales": ["sale_id"],
    "rfm_segments": ["customer_id"],
}

NOT_NULL = {name: [f.name for f in schema.fields if not f.nullable]
            for name, schema in STAR_TABLES.items()}

# Foreign keys: (child table, child column, parent table, parent column).
FOREIGN_KEYS = [
    ("fact_sales", "customer_id", "dim_customer", "customer_id"),
    ("fact_sales", "stock_code", "dim_product", "stock_code"),
    ("fact_sales", "date_id", "dim_date", "date_id"),
    ("rfm_segments", "customer_id", "dim_customer", "customer_id"),
]
