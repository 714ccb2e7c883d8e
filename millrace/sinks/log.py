"""Rows for a message log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def keyed_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``key`` is the first comma-separated field, ``value`` the whole line; other columns stay."""
    others = [c for c in lines.columns if c not in (value, "key", "value")]
    return lines.select(
        F.split(F.col(value), ",")[0].alias("key"), F.col(value).alias("value"), *others
    )


def kafka_writer(
    stream: DataFrame, servers: str, topic: str, checkpoint: str, interval: str = "2 seconds"
) -> DataStreamWriter:
    """At-least-once output to a topic. For exactly-once use ``FileLog`` or dedupe by key downstream."""
    return (
        stream.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=interval)
    )
