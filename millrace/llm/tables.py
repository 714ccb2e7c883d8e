"""Tables that the operators share: cut lineage, components, columns by alias."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import scratch_dir


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def extended(df: DataFrame, *fields: tuple[str, str]) -> T.StructType:
    """The schema of the table with (name, type) fields appended."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields)).fields])


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: cuts lineage, survives executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for links (a, b): the least node that links reach.

    Alternating large and small stars: each round is two partial aggregations and
    joins on the node, so no node's links meet in one task beyond a join that can
    be split; the rounds grow with the logarithm of the longest chain. Nodes
    without a link have no row. Null ends and loops are no links.
    """
    spark = edges.sparkSession
    now = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    total = None
    for _ in range(rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        after = written(small, "links")
        # A fixed point has as many links, and the same sum of their lower ends.
        sums = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sums == total:
            break
        total, now = sums, after
    else:
        raise RuntimeError("components did not settle")
    del spark
    return after.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        after.select(F.col("b"), F.col("b")).distinct()
    )


def crowds(rows: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """(keys, n): how many blocks of about ``limit`` rows each key with more rows is cut into."""
    counted = rows.groupBy(*keys).agg(F.count("*").alias("c")).where(F.col("c") > limit)
    return counted.select(*keys, F.ceil(F.col("c") / limit).cast("int").alias("n"))


def paired_blocks(rows: DataFrame, keys: list[str], member: str, large: DataFrame) -> DataFrame:
    """Adds lo, hi and own: a key's rows meet by pairs of blocks, so that all its pairs meet somewhere.

    ``large`` is from ``crowds``; other keys are one block. Members are spread by their hash.
    """
    sized = rows.join(large, keys, "left").withColumn("n", F.coalesce("n", F.lit(1)))
    return (
        sized.withColumn("own", F.pmod(F.xxhash64(member), F.col("n")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
        .drop("n", "other")
    )


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold whole groups, from batches sorted by the keys; many small groups each."""
    import numpy as np

    held: list[pa.RecordBatch] = []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        if held:
            last = held[-1]
            same = all(
                last.column(last.schema.get_field_index(k))[last.num_rows - 1].as_py() == c[0] for k, c in zip(keys, columns, strict=True)
            )
            if not same:
                yield pa.Table.from_batches(held)
                held = []
        cut = np.zeros(max(n - 1, 0), bool)
        for c in columns:
            cut |= c[1:] != c[:-1]
        at = np.flatnonzero(cut)
        if len(at):
            end = int(at[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, end)])
            held = [batch.slice(end)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)
