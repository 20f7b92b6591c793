"""File sources with declared schemas (S-01, S-02).

The workbook's two yearly sheets become two (or more) files of the raw
schema read as one DataFrame; the cleaned and segment tables are read back
with their own schemas. CSV and Parquet are both accepted; nothing is
inferred. ``read_sales_files`` stops at the first bad line; ``load_sales_files``
sets bad lines aside, with their reasons and counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopscope import schemas


def _read(spark: SparkSession, paths: Sequence[str] | str, schema, fmt: str,
          timestamp_format: str | None = None) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true").option("mode", "FAILFAST")
        if timestamp_format:
            reader = reader.option("timestampNTZFormat", timestamp_format)
        return reader.csv(paths)
    return reader.format(fmt).load(paths)


def read_sales_files(spark: SparkSession, paths: Sequence[str] | str, fmt: str = "parquet",
                     cleaned: bool = False, timestamp_format: str | None = None,
                     float_ids: bool = False) -> DataFrame:
    """Read one or more raw (or cleaned) sales files as one DataFrame.

    ``float_ids``: the customer id column holds numbers written as floats
    ('12346.0', empty for guests). Text like that does not cast to BIGINT
    under ANSI rules, so it is read as DOUBLE and cast to BIGINT (P-04).
    """
    schema = schemas.CLEAN_SALES if cleaned else schemas.RAW_SALES
    if not float_ids:
        return _read(spark, paths, schema, fmt, timestamp_format)
    loose = T.StructType([T.StructField(f.name, T.DoubleType(), f.nullable) if f.name == "customer_id" else f
                          for f in schema.fields])
    df = _read(spark, paths, loose, fmt, timestamp_format)
    return df.withColumn("customer_id", F.col("customer_id").cast("bigint"))


#: Holds the text of a line that doesn't fit the schema.
RECORD = "_record"


@dataclass(frozen=True)
class Loaded:
    """``rows``: the lines that fit the schema. ``rejects``: (source_file, record, reason, bad_columns)
    of the others. ``audit``: per file the lines read, kept and rejected."""

    rows: DataFrame
    rejects: DataFrame
    audit: DataFrame


class TooManyRejects(ValueError):
    pass


def _text_reads(text, kind: T.DataType, timestamp_format: str | None):
    """Whether a field's text is a value of its column's type."""
    if isinstance(kind, T.TimestampNTZType) and timestamp_format:
        return F.try_to_timestamp(text, F.lit(timestamp_format)).isNotNull()
    return text.try_cast(kind).isNotNull()


def load_sales_files(spark: SparkSession, paths: Sequence[str] | str, folder: str, *, cleaned: bool = False,
                     timestamp_format: str | None = None, float_ids: bool = False,
                     most_rejected: float | None = None) -> Loaded:
    """Read raw (or cleaned) CSV files, setting bad lines aside instead of ending the load.

    A line is bad if it has more or fewer columns than the schema or a text that is no value of its
    column's type. One pass over the files writes good and bad lines to two sides of ``folder``, with
    the file that each came from; results are read from there. ``reason`` is 'columns' or 'value', and
    ``bad_columns`` names the columns whose text doesn't read. ``most_rejected``: a load with a larger
    share of bad lines than this raises ``TooManyRejects`` after writing, so the rejects can be read.
    Good lines are those that ``read_sales_files`` would return, were the bad ones not there. A line
    broken by a line end inside quotes is bad in each part. Empty files and files of bad lines only are
    allowed.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    schema = schemas.CLEAN_SALES if cleaned else schemas.RAW_SALES
    fields = [T.StructField(f.name, T.DoubleType(), True) if float_ids and f.name == "customer_id" else f for f in schema.fields]
    reader = spark.read.schema(T.StructType([*fields, T.StructField(RECORD, T.StringType())]))
    # without column pruning every read sees whole lines, so a line is bad whatever columns are asked for
    reader = reader.option("header", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD).option("columnPruning", "false")
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    lines = reader.csv(paths).withColumn("source_file", F.col("_metadata.file_path"))
    lines.withColumn("bad", F.col(RECORD).isNotNull().cast("int")).write.mode("overwrite").partitionBy("bad").parquet(folder)

    written = T.StructType([*fields, T.StructField(RECORD, T.StringType()), T.StructField("source_file", T.StringType()), T.StructField("bad", T.IntegerType())])
    back = spark.read.schema(written).parquet(folder)
    rows = back.where("bad = 0").select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    # the text of each field: the same line against a schema of texts
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in fields] + [T.StructField("_more", T.StringType())])
    parsed = F.from_csv(F.col(RECORD), texts.simpleString()[len("struct<"):-1].replace(":", " "), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_more"})
    bad = back.where("bad = 1").select("source_file", F.col(RECORD).alias("record"), parsed.alias("p"))
    wrong = F.filter(F.array(*[F.when(F.col(f"p.{f.name}").isNotNull() & ~_text_reads(F.col(f"p.{f.name}"), f.dataType, timestamp_format), F.lit(f.name)) for f in fields]), lambda c: c.isNotNull())
    rejects = bad.select("source_file", "record", F.when(F.col("p._more").isNotNull(), "columns").otherwise("value").alias("reason"), wrong.alias("bad_columns"))
    audit = back.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("lines_read"), F.count_if(F.col("bad") == 0).alias("lines_kept"), F.count_if(F.col("bad") == 1).alias("lines_rejected"))
    if most_rejected is not None:
        read, rejected = audit.agg(F.coalesce(F.sum("lines_read"), F.lit(0)), F.coalesce(F.sum("lines_rejected"), F.lit(0))).first()
        if rejected > most_rejected * read:
            raise TooManyRejects(f"{rejected} of {read} lines rejected, see {folder}")
    return Loaded(rows, rejects, audit)


def read_rfm_file(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, schemas.RFM_SEGMENTS, fmt)
