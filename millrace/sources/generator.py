"""Generated rows: numbered values, bounded random columns, rate streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def numbered(spark: SparkSession, count: int, prefix: str, partitions: int | None = None) -> DataFrame:
    """``index`` 0 to count-1 and ``value = prefix + index``.

    Each partition owns one contiguous range of indices.
    """
    rows = spark.range(0, count, 1, partitions).withColumnRenamed("id", "index")
    return rows.withColumn("value", F.concat(F.lit(prefix), F.col("index").cast("string")))


def bounded_random(index: Column, low: int, high: int, seed: int = 0) -> Column:
    """An integer in [low, high], both included, repeatable for an index and a seed."""
    spread = F.pmod(F.xxhash64(index, F.lit(seed)), F.lit(high - low + 1).cast("bigint"))
    return (spread + low).cast("int")


def generator_table(
    spark: SparkSession,
    name: str | None,
    count: int,
    columns: dict[str, tuple[str, int, int]],
    partitions: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """A table of generated columns; a name also makes it a view.

    ``columns`` maps a name to ``("random", min, max)`` or ``("sequence", start, end)``;
    a sequence shorter than ``count`` ends the table, as its bound is inclusive.
    """
    for kind, low, high in columns.values():
        if kind == "sequence":
            count = min(count, high - low + 1)
    rows = spark.range(0, count, 1, partitions)
    index = F.col("id")
    made = {}
    for offset, (column, (kind, low, high)) in enumerate(columns.items()):
        if kind == "sequence":
            made[column] = index + low
        elif kind == "random":
            made[column] = bounded_random(index, low, high, seed + offset)
        else:
            raise ValueError(f"unknown generator kind {kind!r}")
    table = rows.select(*[value.alias(column) for column, value in made.items()])
    if name:
        table.createOrReplaceTempView(name)
    return table


def rate_stream(spark: SparkSession, rows_per_second: int, partitions: int, prefix: str) -> DataFrame:
    """An endless stream of numbered values at a fixed rate, with their creation time."""
    rate = (
        spark.readStream.format("rate")
        .option("rowsPerSecond", rows_per_second)
        .option("numPartitions", partitions)
        .load()
    )
    return rate.select(
        F.col("value").alias("index"),
        F.concat(F.lit(prefix), F.col("value").cast("string")).alias("value"),
        F.col("timestamp").alias("created"),
    )
