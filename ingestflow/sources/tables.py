"""Readers for the parquet tables and for JSON-lines request/history files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables; filters and projections push into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Request or history records written one JSON object per line (explicit schema)."""
    return spark.read.schema(schema).json(path)
