"""Parquet table sources."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    """Read one driver table (``{sf_dir}/{name}.parquet``). With ``schema`` (a DDL string of the
    columns wanted) no footer is read to infer one, and only those columns are scanned."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(table_path(sf_dir, name))


def register(df: DataFrame, name: str) -> DataFrame:
    """Expose a DataFrame by name for SQL users, e.g. ``bronze_events``."""
    df.createOrReplaceTempView(name)
    return df


def named(spark: SparkSession, name: str) -> DataFrame:
    """Resolve a table or view by name."""
    return spark.table(name)
