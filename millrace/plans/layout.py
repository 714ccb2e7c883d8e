"""Where rows go: the named ways of spreading a table over partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_key(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """All rows of a key in one partition."""
    return df.repartition(partitions, key)


def shuffled(df: DataFrame, row_id: str, partitions: int, seed: int = 0) -> DataFrame:
    """Random spread, drawn from a row's id so that a retried task repeats it."""
    return df.repartition(partitions, F.xxhash64(F.col(row_id), F.lit(seed)))


def rebalanced(df: DataFrame, partitions: int) -> DataFrame:
    """Round robin into partitions of even size."""
    return df.repartition(partitions)


def rescaled(df: DataFrame, partitions: int) -> DataFrame:
    """Fewer partitions by joining neighbours, without a shuffle."""
    return df.coalesce(partitions)


def replicated(df: DataFrame, partitions: int) -> DataFrame:
    """Every row in every partition, with the partition in column ``target``."""
    copies = df.withColumn("target", F.explode(F.sequence(F.lit(0), F.lit(partitions - 1))))
    return copies.repartitionById(partitions, F.col("target"))


def by_function(df: DataFrame, target: Column, partitions: int) -> DataFrame:
    """Rows in exactly the partition ``target mod partitions``, never a negative one."""
    return df.repartitionById(partitions, F.pmod(target, F.lit(partitions)).cast("int"))


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per non-empty partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("n")
    )
