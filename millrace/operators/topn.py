"""The most frequent values per window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def windowed_counts(df: DataFrame, time: str, value: str, length: str, slide: str) -> DataFrame:
    """Rows per value and sliding window: ``window_end``, value, ``cnt``."""
    spans = F.window(time, length, slide)
    counts = df.groupBy(spans.alias("__w"), value).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.select(F.col("__w.end").alias("window_end"), value, "cnt")


def closing_counts(stream: DataFrame, time: str, value: str, length: str, slide: str) -> DataFrame:
    """The same on a stream, for a stateful operator behind it: ``end_ms``, value, ``cnt`` and ``closed``, the
    window's own time, which keeps the watermark."""
    counts = stream.groupBy(F.window(time, length, slide).alias("__w"), value).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.select(F.unix_millis(F.col("__w.end")).alias("end_ms"), value, "cnt", F.window_time("__w").alias("closed"))


def rank_counts(counts: DataFrame, value: str, n: int) -> DataFrame:
    """The ``n`` largest counts per window end with their rank; equal counts by value.

    Spark limits each task to n rows per window before it shuffles for the rank.
    """
    order = Window.partitionBy("window_end").orderBy(F.col("cnt").desc(), value)
    ranked = counts.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= n)


def top_values_per_window(
    df: DataFrame, time: str, value: str, length: str, slide: str, n: int
) -> DataFrame:
    """Count per value and window first, then rank: two shuffles, no single-task stage."""
    return rank_counts(windowed_counts(df, time, value, length, slide), value, n)
