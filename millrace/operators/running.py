"""Keyed aggregates, as one result per row and as one result per key.

A stream that folds rows per key emits an updated value for every row. The
``running_*`` operators give exactly these rows; ``final_*`` give the last one of
each key. All running forms are safe for hot keys (see ``plans.scan``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans.scan import (
    CHUNK_ROWS,
    OrderedScan,
    first_value,
    last_value,
    running_count,
    running_max,
    running_min,
    running_sum,
)


def running_extreme(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    field: str,
    largest: bool = True,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Largest (or smallest) ``field`` so far; other columns stay those of the key's first row.

    The order columns keep the current row's values.
    """
    extreme = running_max if largest else running_min
    others = [c for c in df.columns if c not in (*keys, *order, field)]
    scan = OrderedScan(df, keys, order, chunk_rows).add(
        **{c: first_value(F.col(c)) for c in others}, **{field: extreme(F.col(field))}
    )
    return scan.result().select(*df.columns)


def _whole_row(df: DataFrame, field: str, order: Sequence[str], largest: bool) -> Column:
    """A struct that sorts by ``field`` and, among equals, puts the earliest row ahead."""
    rank = [(-F.col(c) if largest else F.col(c)).alias(f"__rank_{i}") for i, c in enumerate(order)]
    return F.struct(F.col(field).alias("__field"), *rank, *[F.col(c) for c in df.columns])


def running_row_of_extreme(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    field: str,
    largest: bool = True,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The whole row holding the largest (or smallest) ``field`` so far, ties to the earliest.

    Order columns must be numbers. The row's own order values come as ``row_<name>``.
    """
    extreme = running_max if largest else running_min
    whole = _whole_row(df, field, order, largest)
    scan = OrderedScan(df, keys, order, chunk_rows).add(
        __row=extreme(F.when(F.col(field).isNotNull(), whole))
    )
    picked = F.col("__row")
    others = [c for c in df.columns if c not in (*keys, *order)]
    return scan.result().select(
        *keys,
        *order,
        *[picked.getField(c).alias(c) for c in others],
        *[picked.getField(c).alias(f"row_{c}") for c in order],
    )


def final_row_of_extreme(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], field: str, largest: bool = True
) -> DataFrame:
    """Per key the whole row of the largest (or smallest) ``field``, ties to the earliest."""
    fold = F.max if largest else F.min
    whole = _whole_row(df, field, order, largest)
    best = df.filter(F.col(field).isNotNull()).groupBy(*keys).agg(fold(whole).alias("__row"))
    return best.select(
        *keys, *[F.col("__row").getField(c).alias(c) for c in df.columns if c not in keys]
    )


def running_reduce(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    first: Sequence[str],
    summed: Sequence[str],
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Fold rows pairwise: ``first`` columns of the earliest row, sums of ``summed``, rest latest.

    Sums must be exact, whatever chunks the rows fall into, so floating-point columns
    are refused: cast them to a decimal.
    """
    inexact = [c for c in summed if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))]
    if inexact:
        raise TypeError(f"running sums of floating-point columns depend on the order of addition: {inexact}")
    scan = OrderedScan(df, keys, order, chunk_rows).add(
        **{c: first_value(F.col(c)) for c in first},
        **{c: running_sum(F.col(c)) for c in summed},
    )
    return scan.result().select(*df.columns)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Adds ``total``, ``n`` and ``mean`` of the values so far."""
    scan = OrderedScan(df, keys, order, chunk_rows).add(
        total=running_sum(value.cast("bigint")), n=running_count()
    )
    mean = F.col("total").cast("double") / F.col("n")
    return scan.result().withColumn("mean", mean)


def running_occurrences(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Adds ``cnt``, how often the row's key has come up so far.

    Keyed by word this is a streaming word count; keyed by (key, value) it is the
    map entry each row touches in a per-key map of counts.
    """
    return OrderedScan(df, keys, order, chunk_rows).add(cnt=running_count()).result()


def running_top(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    k: int = 3,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Adds ``top``, the k largest values so far, descending, duplicates kept."""
    return OrderedScan(df, keys, order, chunk_rows).add_top("top", F.col(value), k).result()


def jump_alerts(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    limit: int,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Rows that differ by more than ``limit`` from the key's previous row, 0 for the first."""
    scan = OrderedScan(df, keys, order, chunk_rows).add(
        last=last_value(F.col(value), before=True)
    )
    seen = scan.result().withColumn("last", F.coalesce("last", F.lit(0)))
    return seen.filter(F.abs(F.col(value) - F.col("last")) > limit)


def value_with_expiry(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    stored: Column,
    clock: Column,
    ttl: int,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Adds ``state``: the value a row reads from a per-key store whose entries expire.

    ``stored`` is what the row writes (null: nothing). Reads and writes both renew
    the entry, so it lives while the key's rows follow each other in less than
    ``ttl`` units of ``clock`` and is gone after a longer pause.
    """
    scan = OrderedScan(df.withColumns({"__at": clock, "__put": stored}), keys, order, chunk_rows)
    scan = scan.add(
        __before=last_value(F.col("__at"), before=True), __n=running_count()
    ).map(
        __fresh=F.when(
            F.col("__before").isNull() | (F.col("__at") - F.col("__before") >= ttl), F.col("__n")
        ),
        __write=F.when(
            F.col("__put").isNotNull(), F.struct(F.col("__n").alias("n"), F.col("__put").alias("v"))
        ),
    )
    scan = scan.add(
        __since=running_max(F.col("__fresh")), __held=last_value(F.col("__write"), before=True)
    )
    held = F.col("__held")
    alive = F.when(held.getField("n") >= F.col("__since"), held.getField("v"))
    return scan.result().select(*df.columns, alive.alias("state"))


def sum_changelog(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The change rows of ``sum(value) GROUP BY keys`` in column ``op``.

    A key's first row inserts (``+I``); each later one retracts the old sum
    (``-U``) and puts the new one (``+U``).
    """
    scan = OrderedScan(df.select(*keys, *order, value), keys, order, chunk_rows).add(
        __new=running_sum(F.col(value).cast("bigint")), __n=running_count()
    )

    rows = change_rows(scan.result(), value, "__new", "__n")
    return rows.select(*order, *keys, "op", "total")


def change_rows(df: DataFrame, value: str, total: str, n: str) -> DataFrame:
    """Rows with their running sum and count as change rows: ``op`` and ``total`` in place of the three columns."""

    def change(op: str, amount: Column) -> Column:
        return F.struct(F.lit(op).alias("op"), amount.alias("total"))

    new = F.col(total)
    old = new - F.coalesce(F.col(value), F.lit(0)).cast("bigint")
    changes = F.when(F.col(n) == 1, F.array(change("+I", new))).otherwise(F.array(change("-U", old), change("+U", new)))
    others = [c for c in df.columns if c not in (value, total, n)]
    return df.select(*others, F.explode(changes).alias("__change")).select(*others, "__change.op", "__change.total")
