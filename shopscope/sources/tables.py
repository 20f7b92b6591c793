"""Readers for the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TPCH_NAMES = ("region", "nation", "customer", "supplier", "part", "orders",
              "lineitem", "events")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tpch_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: read_table(spark, sf_dir, n) for n in TPCH_NAMES}
