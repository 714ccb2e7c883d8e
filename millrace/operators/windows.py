"""Time, session and count windows over tables.

Aggregating windows are two-phase ``groupBy`` plans: map tasks fold their own rows
first, so neither a hot key nor an un-keyed window overloads a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.plans.scan import (
    CHUNK_ROWS,
    OrderedScan,
    last_value,
    running_count,
    running_max,
    whole_count,
)


def time_windows(
    df: DataFrame,
    time: str,
    length: str,
    aggregates: Sequence[Column],
    keys: Sequence[str | Column] = (),
    slide: str | None = None,
) -> DataFrame:
    """Tumbling (or, with ``slide``, sliding) windows, aligned to the epoch, end exclusive.

    ``keys`` may be empty: one set of windows over the whole table. Works on
    streams, given a watermark on ``time``.
    """
    spans = F.window(time, length, slide) if slide else F.window(time, length)
    made = df.groupBy(*keys, spans.alias("window")).agg(*aggregates)
    others = [c for c in made.columns if c != "window"]
    return made.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *others
    )


def reduce_aggregates(first: Sequence[str], last: Sequence[str], summed: Sequence[str], order: str) -> list[Column]:
    """The pairwise fold of a window: earliest ``first``, latest ``last``, sums."""
    return [
        *[F.min_by(c, order).alias(c) for c in first],
        *[F.max_by(c, order).alias(c) for c in last],
        *[F.sum(c).alias(c) for c in summed],
    ]


def window_elements(
    df: DataFrame,
    time: str,
    length: str,
    keys: Sequence[str],
    order: Sequence[str],
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Every row with its window's bounds, its place in the window and the window's row count.

    The full content of each window in rows rather than one growing list, so a
    window may hold any number of rows.
    """
    placed = df.withColumn("__w", F.window(time, length)).select(
        *df.columns, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end")
    )
    group = [*keys, "window_start"]
    scan = OrderedScan(placed, group, order, chunk_rows)
    return scan.add(place=running_count(), n=whole_count()).result()


def session_windows(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    order: Sequence[str],
    gap_us: int,
    aggregates: Sequence[Column],
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Sessions of rows at most ``gap_us`` apart; a session ends one gap after its last row.

    Same result as ``session_window``, which needs all rows of a key in one task;
    here a hot key is cut along time and its sessions are stitched together.
    """
    at = F.unix_micros(F.col(time).cast("timestamp"))
    scan = OrderedScan(df.withColumn("__at", at), keys, ["__at", *order], chunk_rows)
    scan = scan.add(__before=last_value(F.col("__at"), before=True)).map(
        __opens=F.when(
            F.col("__before").isNull() | (F.col("__at") - F.col("__before") > gap_us), F.col("__at")
        )
    )
    scan = scan.add(__start=running_max(F.col("__opens")))
    sessions = scan.result().groupBy(*keys, "__start").agg(F.max("__at").alias("__last"), *aggregates)
    others = [c for c in sessions.columns if c not in (*keys, "__start", "__last")]
    return sessions.select(
        *keys,
        F.timestamp_micros("__start").alias("session_start"),
        F.timestamp_micros(F.col("__last") + gap_us).alias("session_end"),
        *others,
    )


def count_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    size: int,
    aggregates: Sequence[Column],
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Windows of ``size`` consecutive rows per key; an incomplete last window never fires."""
    scan = OrderedScan(df, keys, order, chunk_rows).add(__rn=running_count())
    block = F.floor((F.col("__rn") - 1) / size).alias("firing")
    made = scan.result().groupBy(*keys, block).agg(F.count(F.lit(1)).alias("n"), *aggregates)
    return made.filter(F.col("n") == size)


BLOCK_ROWS = 65_536


def _recent(value: str, frame: WindowSpec) -> dict[str, Column]:
    return {"n": F.count(F.lit(1)).over(frame), "total": F.sum(value).over(frame)}


def sliding_count_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    size: int,
    slide: int,
    value: str,
    chunk_rows: int = CHUNK_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every ``slide`` rows per key, count and sum of the last ``size`` rows (fewer at first).

    Where a key is hot, rows are numbered and cut into blocks of ``block_rows``, and a
    block gets copies of the last ``size - 1`` rows before it. So the frame never
    looks outside its block, however many rows a key has.
    """
    scan = OrderedScan(df, keys, order, chunk_rows)
    if not scan.split:
        frame = scan.window.rowsBetween(-(size - 1), 0)
        summed = scan.add(__rn=running_count()).result().withColumns(_recent(value, frame))
        fired = summed.filter(F.col("__rn") % slide == 0)
        return fired.select(*keys, F.col("__rn").alias("firing"), "n", "total")
    numbered = scan.add(__rn=running_count()).result()
    fired = recent_sums(numbered, keys, "__rn", size, value, block_rows).filter(F.col("__rn") % slide == 0)
    return fired.select(*keys, F.col("__rn").alias("firing"), "n", "total")


def recent_sums(numbered: DataFrame, keys: Sequence[str], number: str, size: int, value: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Adds count and sum of the last ``size`` rows to rows that ``number`` counts per key.

    Rows are cut into blocks by number, and a block gets copies of the ``size - 1`` rows before it.
    """
    step = max(block_rows, size)
    home = F.floor((F.col(number) - 1) / step)
    reach = F.floor((F.col(number) + (size - 2)) / step)
    blocks = numbered.withColumn("__home", home).withColumn("__block", F.explode(F.sequence(home, reach)))
    frame = Window.partitionBy(*keys, "__block").orderBy(number).rowsBetween(-(size - 1), 0)
    return blocks.withColumns(_recent(value, frame)).filter(F.col("__home") == F.col("__block")).drop("__home", "__block")
