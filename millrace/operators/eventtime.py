"""Event time over rows in arrival order: watermarks, late rows, repeated firings.

These operators replay a table in its arrival order and apply the per-row rules of
event time exactly: after a row the watermark is the largest event time so far,
less the allowed delay and one millisecond. The running maximum is global, and
``OrderedScan`` with no key computes it without a single-task stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.combine import interval_join
from millrace.plans.scan import (
    CHUNK_ROWS,
    OrderedScan,
    last_value,
    running_count,
    running_max,
    running_sum,
)
from millrace.session import settled


def running_watermark(
    df: DataFrame,
    time_ms: Column,
    arrival: Sequence[str],
    delay_ms: int,
    chunk_rows: int = CHUNK_ROWS,
    max_before_ms: int | None = None,
) -> DataFrame:
    """Adds ``watermark_ms`` after each row, and ``visible_ms`` as the row itself sees it.

    ``max_before_ms`` is the largest event time of rows before this table, where the
    table is one batch of a stream.
    """
    past = F.lit(max_before_ms).cast("bigint")
    scan = OrderedScan(df.withColumn("__t", time_ms), [], arrival, chunk_rows).add(
        __upto=running_max(F.col("__t")), __before=running_max(F.col("__t"), before=True)
    )
    return scan.result().select(
        *df.columns,
        (F.greatest("__upto", past) - (delay_ms + 1)).alias("watermark_ms"),
        (F.greatest("__before", past) - (delay_ms + 1)).alias("visible_ms"),
    )


def classify_lateness(
    df: DataFrame,
    time_ms: Column,
    arrival: Sequence[str],
    window_ms: int,
    delay_ms: int,
    lateness_ms: int = 0,
    chunk_rows: int = CHUNK_ROWS,
    max_before_ms: int | None = None,
) -> DataFrame:
    """Adds each row's window (``start_ms``, ``end_ms``) and ``status``.

    ``on_time``: the window had not fired; ``accepted``: it had, but still takes late
    rows; ``late``: it is closed, the row belongs in the late output.
    """
    start = F.floor(time_ms / window_ms) * window_ms
    seen = running_watermark(
        df.withColumn("start_ms", start).withColumn("end_ms", start + window_ms),
        time_ms,
        arrival,
        delay_ms,
        chunk_rows,
        max_before_ms,
    )
    last_instant = F.col("end_ms") - 1
    open_still = F.col("visible_ms").isNull() | (F.col("visible_ms") < last_instant)
    status = (
        F.when(open_still, "on_time")
        .when(F.col("visible_ms") < last_instant + lateness_ms, "accepted")
        .otherwise("late")
    )
    return seen.withColumn("status", status).drop("watermark_ms", "visible_ms")


def window_firings(
    classified: DataFrame,
    keys: Sequence[str],
    arrival: Sequence[str],
    value: str,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Every result a window gives: at its end, then once more per accepted late row.

    Columns: keys, ``start_ms``, ``end_ms``, ``firing`` (from 0), ``n`` and ``total``
    of the rows the window holds at that firing.
    """
    # Two aggregations and a scan read the rows, whose own scan is global: run it once.
    group = [*keys, "start_ms", "end_ms"]
    classified = settled(classified.select(*group, *arrival, value, "status"), "classified")
    number = F.coalesce(F.col(value), F.lit(0)).cast("bigint")
    first = (
        classified.filter(F.col("status") == "on_time")
        .groupBy(*group)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(number).alias("total"))
    )
    again = OrderedScan(
        classified.filter(F.col("status") == "accepted").select(*group, *arrival, value),
        group,
        arrival,
        chunk_rows,
    ).add(late_n=running_count(), late_total=running_sum(number))
    base = first.select(
        *[F.col(c).alias(f"__{c}") for c in group],
        F.col("n").alias("__n"),
        F.col("total").alias("__total"),
    )
    on = F.lit(True)
    for c in group:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    later = again.result().join(base, on, "left").select(
        *group,
        (F.col("late_n") - F.when(F.col("__n").isNull(), 1).otherwise(0)).alias("firing"),
        (F.col("late_n") + F.coalesce("__n", F.lit(0))).alias("n"),
        (F.col("late_total") + F.coalesce("__total", F.lit(0))).alias("total"),
    )
    return first.select(
        *group, F.lit(0).cast("bigint").alias("firing"), "n", "total"
    ).unionByName(later)


def source_watermark(
    df: DataFrame,
    source: str,
    sources: Sequence[str],
    time_ms: Column,
    clock_ms: Column,
    arrival: Sequence[str],
    delay_ms: int,
    idle_ms: int,
    chunk_rows: int = CHUNK_ROWS,
    before: Mapping[str, tuple[int | None, int | None]] | None = None,
    low_before_ms: int | None = None,
) -> DataFrame:
    """Adds ``watermark_ms`` of several sources together: the lowest of the active ones.

    A source without an arrival for ``idle_ms`` of ``clock_ms`` is left out. One that
    has never sent anything counts as idle. The watermark never goes back when an
    idle source returns. Where the table is one batch of a stream, ``before`` gives each source's largest
    event time and latest arrival so far, and ``low_before_ms`` the watermark.
    """
    scan = OrderedScan(
        df.withColumns({"__t": time_ms, "__now": clock_ms}), [], arrival, chunk_rows
    )
    values = {}
    for i, name in enumerate(sources):
        mine = F.col(source) == name
        values[f"__t_{i}"] = running_max(F.when(mine, F.col("__t")))
        values[f"__at_{i}"] = last_value(F.when(mine, F.col("__now")))
    scan = scan.add(**values)
    if before:
        past = {name: before.get(name, (None, None)) for name in sources}
        scan = scan.map(
            **{f"__t_{i}": F.greatest(f"__t_{i}", F.lit(past[name][0]).cast("bigint")) for i, name in enumerate(sources)},
            **{f"__at_{i}": F.coalesce(f"__at_{i}", F.lit(past[name][1]).cast("bigint")) for i, name in enumerate(sources)},
        )
    active = [
        F.when(F.col("__now") - F.col(f"__at_{i}") <= idle_ms, F.col(f"__t_{i}"))
        for i in range(len(sources))
    ]
    lowest = F.least(*active) if len(active) > 1 else active[0]
    scan = scan.map(__low=lowest - (delay_ms + 1)).add(watermark_ms=running_max(F.col("__low")))
    watermark = F.greatest("watermark_ms", F.lit(low_before_ms).cast("bigint"))
    return scan.result().select(*df.columns, watermark.alias("watermark_ms"))


def tag_late_of_pair(
    left: DataFrame,
    right: DataFrame,
    time_ms: Column,
    arrival: Sequence[str],
    delay_ms: int,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Both inputs in one table with ``side`` and ``late``; see ``tag_late_sides``."""
    both = left.withColumn("side", F.lit("left")).unionByName(
        right.withColumn("side", F.lit("right")), allowMissingColumns=True
    )
    return tag_late_sides(both, time_ms, arrival, delay_ms, chunk_rows)


def tag_late_sides(
    both: DataFrame,
    time_ms: Column,
    arrival: Sequence[str],
    delay_ms: int,
    chunk_rows: int = CHUNK_ROWS,
    before: tuple[int | None, int | None] = (None, None),
) -> DataFrame:
    """Adds ``late`` to rows whose ``side`` is left or right.

    A row is late when its time lies below the watermark it sees, which is the lower
    of both inputs' watermarks and absent until both have sent a row. ``before`` gives the largest times
    of either side in the batches before this one.
    """
    scan = OrderedScan(both.withColumn("__t", time_ms), [], arrival, chunk_rows).add(
        __l=running_max(F.when(F.col("side") == "left", F.col("__t")), before=True),
        __r=running_max(F.when(F.col("side") == "right", F.col("__t")), before=True),
    )
    if before != (None, None):
        scan = scan.map(
            __l=F.greatest("__l", F.lit(before[0]).cast("bigint")), __r=F.greatest("__r", F.lit(before[1]).cast("bigint"))
        )
    watermark = F.when(
        F.col("__l").isNotNull() & F.col("__r").isNotNull(),
        F.least("__l", "__r") - (delay_ms + 1),
    )
    late = F.coalesce(F.col("__t") < watermark, F.lit(False))
    return scan.result().select(*both.columns, late.alias("late"))


def interval_join_with_late(
    left: DataFrame,
    right: DataFrame,
    key: str,
    row_id: str,
    time: str,
    arrival: Sequence[str],
    lower_us: int,
    upper_us: int,
    delay_ms: int,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Interval join of the rows in time, and the late rows of each side as extra outputs.

    Columns: ``tag`` (``joined``, ``late_left``, ``late_right``), the key, ``left_id``
    and ``right_id``.
    """
    needed = list(dict.fromkeys([key, row_id, time, *arrival]))
    # Three outputs read the tagged rows, whose scan is global: run it once.
    tagged = settled(
        tag_late_of_pair(
            left.select(*needed),
            right.select(*needed),
            F.unix_millis(F.col(time)),
            arrival,
            delay_ms,
            chunk_rows,
        ),
        "tagged",
    )

    def in_time(side: str) -> DataFrame:
        rows = tagged.filter((F.col("side") == side) & ~F.col("late"))
        return rows.select(key, F.col(row_id).alias(f"{side}_id"), F.col(time).alias(f"{side}_time"))

    joined = interval_join(
        in_time("left"), in_time("right"), key, "left_time", "right_time", lower_us, upper_us
    ).select(F.lit("joined").alias("tag"), key, "left_id", "right_id")
    is_left = F.col("side") == "left"
    late = tagged.filter("late").select(
        F.concat(F.lit("late_"), "side").alias("tag"),
        key,
        F.when(is_left, F.col(row_id)).alias("left_id"),
        F.when(~is_left, F.col(row_id)).alias("right_id"),
    )
    return joined.unionByName(late)
