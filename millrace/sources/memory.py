"""Small in-memory collections as tables (settings, look-up rows, fixtures)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def from_elements(spark: SparkSession, *values: object, data_type: str) -> DataFrame:
    """Scalars as one column ``value``."""
    return spark.createDataFrame([(v,) for v in values], f"value {data_type}")


def from_collection(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
