"""Row-by-row operators: projection, filter, expansion, formatting."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import java_split

MILLISECONDS = "yyyy-MM-dd HH:mm:ss.SSS"


def keep_equal(df: DataFrame, column: str, wanted: object) -> DataFrame:
    """Rows whose column equals the parameter; null never does."""
    return df.filter(F.col(column) == F.lit(wanted))


def with_setup(
    df: DataFrame,
    resource: Callable[[], AbstractContextManager],
    fn: Callable[[object, pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """Apply ``fn(opened resource, batch)`` with the resource opened and closed once per task.

    For work that needs a connection or a model; plain arithmetic belongs in ``select``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with resource() as opened:
            for batch in batches:
                yield fn(opened, batch)

    return df.mapInPandas(run, schema)


def expand(df: DataFrame, values: Column, position: str = "pos", value: str = "value") -> DataFrame:
    """One row per array element with its position; rows without elements vanish."""
    return df.select("*", F.posexplode(values).alias(position, value))


def values_by_id(df: DataFrame, one: str, two: str) -> DataFrame:
    """Rows of id ``one`` give their vc, those of ``two`` their ts and then vc, others nothing."""
    vc, ts = F.col("vc").cast("string"), F.col("ts").cast("string")
    picked = F.when(F.col("id") == one, F.array(vc)).when(F.col("id") == two, F.array(ts, vc))
    return expand(df.filter(F.col("id").isin(one, two)), picked)


def tokenize(df: DataFrame, text: str = "value") -> DataFrame:
    """Replace a text column by ``pos, word``, one row per token."""
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.posexplode(java_split(text)).alias("pos", "word"))


def epoch_ms(ts: str | Column) -> Column:
    return F.unix_millis(F.col(ts) if isinstance(ts, str) else ts)


def event_time(seconds: str) -> Column:
    """Event time of an epoch-seconds column."""
    return F.timestamp_seconds(F.col(seconds))


def format_time(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS`` in the session's zone, UTC by default."""
    return F.date_format(ts, MILLISECONDS)
