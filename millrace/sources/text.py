"""Line-oriented files, read at once or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Lines end with a line feed only, so a carriage return stays part of its line.
LINE_FEED = "\n"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line in column ``value``."""
    return spark.read.option("lineSep", LINE_FEED).text(path)


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The same as a stream; with ``trigger(availableNow=True)`` it ends at the last file."""
    reader = spark.readStream.option("lineSep", LINE_FEED)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)
