"""Splitting one table into several tagged outputs in a single pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag_first(df: DataFrame, rules: Mapping[str, Column], rest: str, tag: str = "tag") -> DataFrame:
    """Tag each row with the first rule that holds, else ``rest``."""
    chosen = F.lit(None).cast("string")
    for name, holds in reversed(list(rules.items())):
        chosen = F.when(holds, F.lit(name)).otherwise(chosen)
    return df.withColumn(tag, F.coalesce(chosen, F.lit(rest)))


def outputs(tagged: DataFrame, *names: str, tag: str = "tag") -> list[DataFrame]:
    """The rows of each tag. Persist ``tagged`` first if it is dear to compute."""
    return [tagged.filter(F.col(tag) == name).drop(tag) for name in names]


def split_parity(df: DataFrame, value: str, tag: str = "tag") -> DataFrame:
    """Even and odd rows. A negative odd number has remainder -1 and is in neither."""
    remainder = F.col(value) % 2
    name = F.when(remainder == 0, "even").when(remainder == 1, "odd")
    return df.withColumn(tag, name).filter(F.col(tag).isNotNull())


def with_alerts(df: DataFrame, holds: Column, message: Column, main: str, alert: str) -> DataFrame:
    """Every row under ``main``, and a second row with a message under ``alert`` where it holds.

    Both outputs come from one scan: the row expands to one or two tags.
    """
    tags = F.when(holds, F.array(F.lit(main), F.lit(alert))).otherwise(F.array(F.lit(main)))
    return df.select("*", F.explode(tags).alias("tag")).withColumn(
        "message", F.when(F.col("tag") == alert, message)
    )


def write_outputs(tagged: DataFrame, path: str, tag: str = "tag") -> None:
    """Write every output in one pass, a folder ``tag=<name>`` each."""
    tagged.write.partitionBy(tag).mode("append").parquet(path)
