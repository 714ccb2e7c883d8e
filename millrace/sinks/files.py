"""Text files in hourly buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

BUCKET_FORMAT = "yyyy-MM-dd HH"


def with_bucket(df: DataFrame, time: str, value: Column) -> DataFrame:
    return df.select(F.date_format(time, BUCKET_FORMAT).alias("bucket"), value.alias("value"))


def write_bucketed(
    df: DataFrame,
    path: str,
    time: str,
    value: Column,
    max_rows_per_file: int = 1_000_000,
    files: int | None = None,
) -> None:
    """Write one line per row below ``bucket=<hour>`` folders.

    Rows are dealt by hour; adaptive execution splits an hour of many rows among tasks and
    lets quiet hours share one. ``files`` bounds the number of tasks.
    """
    placed = with_bucket(df, time, value)
    rows = placed.hint("rebalance", files, "bucket") if files else placed.hint("rebalance", "bucket")
    rows.write.partitionBy("bucket").option("maxRecordsPerFile", max_rows_per_file).mode(
        "append"
    ).text(path)


def stream_bucketed(
    stream: DataFrame, path: str, checkpoint: str, time: str, value: Column, roll: str = "10 seconds"
) -> DataStreamWriter:
    """The same for a stream: a new file per task and trigger, visible once committed."""
    rows = with_bucket(stream, time, value)
    return (
        rows.writeStream.format("text")
        .partitionBy("bucket")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=roll)
    )


def console(stream: DataFrame, label: str) -> DataStreamWriter:
    """Print a stream under a label."""
    return stream.writeStream.format("console").queryName(label)
