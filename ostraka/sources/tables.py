"""Readers of the tables that a corpus directory holds as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The Parquet table ``name`` (one file or a folder of parts) under ``root``."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
