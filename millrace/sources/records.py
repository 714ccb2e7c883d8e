"""Parsing of ``id,ts,vc`` lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SENSOR_SCHEMA = "id string, ts bigint, vc int"


def _fields(value: str) -> tuple[Column, Column, Column]:
    parts = F.split(F.col(value), ",")
    return parts[0], parts[1], parts[2]


def parse_sensor(lines: DataFrame, value: str = "value") -> DataFrame:
    """Replace ``value`` by ``id, ts, vc``; a malformed line fails the query."""
    name, ts, vc = _fields(value)
    others = [c for c in lines.columns if c != value]
    return lines.select(
        *others, name.alias("id"), ts.cast("bigint").alias("ts"), vc.cast("int").alias("vc")
    )


def try_parse_sensor(lines: DataFrame, value: str = "value") -> DataFrame:
    """Like ``parse_sensor``, but keeps malformed lines with ``ok = false``."""
    parts = F.split(F.col(value), ",")
    name, ts, vc = (F.get(parts, F.lit(i)) for i in range(3))
    parsed = lines.select(
        "*", name.alias("id"), ts.try_cast("bigint").alias("ts"), vc.try_cast("int").alias("vc")
    )
    whole = F.col("id").isNotNull() & F.col("ts").isNotNull() & F.col("vc").isNotNull()
    return parsed.withColumn("ok", F.coalesce(whole, F.lit(False)))


def to_lines(df: DataFrame) -> DataFrame:
    """The text form of ``id, ts, vc`` rows."""
    return df.select(F.concat_ws(",", "id", "ts", "vc").alias("value"))
