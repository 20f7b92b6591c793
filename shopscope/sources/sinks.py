"""Sinks, output verification, DDL and catalog (S-03 ... S-09).

* ``write_parquet`` / ``write_csv``: overwrite writes (idempotent re-runs);
  CSV has a header and no index column.
* ``write_jdbc``: append to a database table in batches (default 10,000
  rows per batch), credentials passed as options - never in source. Tasks
  write in parallel, one connection per partition.
* ``verify_written``: read a written table back with its own schema and report
  existence, size, rows, schema and content equality.
* ``star_ddl`` / ``create_star_tables``: ``CREATE TABLE IF NOT EXISTS ...
  USING parquet`` from the declared schemas; ``load_star`` writes the five
  tables in foreign-key-safe order (parents before children);
  ``load_star_ledger`` does so as one transaction (``sources.ledger``).
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopscope import schemas
from shopscope.sources.ledger import Ledger

LOAD_ORDER = ["dim_customer", "dim_product", "dim_date", "fact_sales", "rfm_segments"]
JDBC_BATCH = 10_000


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, *, user: str | None = None,
               password: str | None = None, batchsize: int = JDBC_BATCH, mode: str = "append",
               driver: str | None = None) -> None:
    props = {"batchsize": str(batchsize)}
    if user is not None:
        props["user"] = user
    if password is not None:
        props["password"] = password
    if driver is not None:
        props["driver"] = driver
    df.write.jdbc(url=url, table=table, mode=mode, properties=props)


def _bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a written table, -1 where there is none."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem through the public gateway
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else -1


def _content(columns: dict[str, Column]) -> Column:
    """One number for all rows, whatever their order: the sum of row hashes."""
    return F.sum(F.xxhash64(F.struct(*[c.alias(n) for n, c in columns.items()])).cast("decimal(38,0)"))


def checks(df: DataFrame, keys: Sequence[str] = (), required: Sequence[str] = ()) -> list[Column]:
    """What a write finds out about its rows on the way: their number, a hash of their content, rows
    with a null key, nulls in required columns."""
    null_key = F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda x: x) if keys else F.lit(False)
    return [F.count(F.lit(1)).alias("n"), _content({f.name: F.col(f.name) for f in df.schema.fields}).alias("h"),
            F.count_if(null_key).alias("null_keys"), sum([F.count_if(F.col(c).isNull()) for c in required], F.lit(0)).cast("bigint").alias("not_null_violations")]


def observed(df: DataFrame, keys: Sequence[str] = (), required: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    """The frame to write in place of ``df``, and its ``checks``, which the writing job itself computes:
    no second pass over the rows. The observation answers when the job has ended."""
    seen = Observation()
    return df.observe(seen, *checks(df, keys, required)), seen


def verify_written(df: DataFrame, path: str, fmt: str, name: str, own: dict | None = None) -> DataFrame:
    """S-04: one row: table, written, has bytes, rows expected, rows read back, schema and content equal.

    The file is read with its own schema (Parquet) or header (CSV), never with
    the expected one. CSV text counts as equal when every value casts to its
    column's type; the content is equal when the row hashes of source and
    file have the same sum. ``own``: number (n) and content (h) of the source's
    rows as ``observed`` while they were written; else they are counted here.
    """
    spark = df.sparkSession
    size = _bytes(spark, path)
    if size > 0:
        back = spark.read.option("header", "true").csv(path) if fmt == "csv" else spark.read.format(fmt).load(path)
    else:
        back = spark.range(0).toDF("_nothing")
    named = back.columns == df.columns
    typed = named and (fmt == "csv" or [f.dataType for f in back.schema.fields] == [f.dataType for f in df.schema.fields])
    if named:
        cast = {f.name: F.col(f.name).try_cast(f.dataType) for f in df.schema.fields}
        lost = F.exists(F.array(*[F.col(n).isNotNull() & c.isNull() for n, c in cast.items()]), lambda x: x)
        row = back.agg(F.count(F.lit(1)).alias("rows_read"), F.count_if(lost).alias("_lost"), _content(cast).alias("_h"))
    else:
        row = back.agg(F.count(F.lit(1)).alias("rows_read"), F.lit(0).alias("_lost"), F.lit(None).cast("decimal(38,0)").alias("_h"))
    if own is None:
        source = df.agg(*checks(df)).select(F.struct("n", "h")).scalar()
    else:
        source = F.struct(F.lit(own["n"]).cast("bigint").alias("n"), F.lit(own["h"]).cast("decimal(38,0)").alias("h"))
    row = row.withColumn("_own", source)
    return row.select(
        F.lit(name).alias("table_name"), F.lit(size >= 0).alias("written"), F.lit(size > 0).alias("has_bytes"),
        F.col("_own.n").alias("rows_expected"), "rows_read",
        (F.lit(typed) & (F.col("_lost") == 0)).alias("schema_equal"),
        (F.lit(named) & F.col("_h").eqNullSafe(F.col("_own.h"))).alias("content_equal"))


def output_verification(tables: dict[str, DataFrame], folder: str, fmt: str = "csv") -> DataFrame:
    """S-03 + S-04 for the star tables: write each in ``fmt`` under
    ``folder`` (FK-safe order) and verify it by reading it back. The source
    side of the comparison is observed by the write."""
    out = None
    for name in LOAD_ORDER:
        df = tables[name]
        path = os.path.join(folder, name)
        checked, seen = observed(df)
        (write_csv if fmt == "csv" else write_parquet)(checked, path)
        row = verify_written(df, path, fmt, name, seen.get)
        out = row if out is None else out.unionByName(row)
    return out


def star_ddl(database: str | None = None, location: str | None = None) -> list[str]:
    """S-08: CREATE TABLE IF NOT EXISTS statements of the star schema."""
    stmts = []
    for name, schema in schemas.STAR_TABLES.items():
        cols = ", ".join(f"{f.name} {f.dataType.simpleString().upper()}"
                         + ("" if f.nullable else " NOT NULL") for f in schema.fields)
        full = f"{database}.{name}" if database else name
        loc = f" LOCATION '{location.rstrip('/')}/{name}'" if location else ""
        stmts.append(f"CREATE TABLE IF NOT EXISTS {full} ({cols}) USING parquet{loc}")
    return stmts


def create_star_tables(spark: SparkSession, database: str, location: str | None = None) -> list[str]:
    """S-08 / S-09: create the database and the five tables; return the
    catalog listing (``SHOW TABLES``)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for stmt in star_ddl(database, location):
        spark.sql(stmt)
    return sorted(t.name for t in spark.catalog.listTables(database))


def load_star(tables: dict[str, DataFrame], database: str) -> None:
    """S-05 into catalog tables: overwrite each table in FK-safe order
    (use :func:`write_jdbc` with the same order for a database target)."""
    for name in LOAD_ORDER:
        df = tables[name].select(*[f.name for f in schemas.STAR_TABLES[name].fields])
        df.write.mode("overwrite").insertInto(f"{database}.{name}")


def load_star_ledger(tables: dict[str, DataFrame], ledger: Ledger, load_id: str) -> None:
    """S-05 into folders: all tables of a load become visible together, and a load that was killed or is
    run again under its id counts once."""
    ledger.load(load_id, {n: tables[n].select(*schemas.STAR_TABLES[n].names) for n in LOAD_ORDER})


def load_star_jdbc(tables: dict[str, DataFrame], url: str, write=write_jdbc, **options) -> None:
    """S-05 into a database: append every table, parents before children."""
    for name in LOAD_ORDER:
        write(tables[name].select(*[f.name for f in schemas.STAR_TABLES[name].fields]), url, name, **options)
