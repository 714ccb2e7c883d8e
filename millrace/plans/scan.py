"""Running values over the ordered rows of a key, without one task per key.

``F.sum(x).over(Window.partitionBy(key).orderBy(seq))`` sends every row of a
key to one task, so a key with a third of the table decides the run time. Here
the rows of such a *hot* key are cut into chunks along the order column:

1. a count of the table and then per key finds the *hot* keys, those above the threshold
   ``T = max(chunk_rows, N / MAX_SPLITS)``. Fewer than ``N / T <= MAX_SPLITS`` keys
   can exceed it, so the list of them is bounded however large the table grows;
2. rows of a hot key get a chunk number: the position of the order value within
   the key's range. Where rows crowd together in time and a chunk stays too large,
   it is cut again in the same way, so chunks follow the data's density. Windows
   then run per (key, chunk);
3. ``carry`` holds per hot (key, chunk) the value accumulated over all earlier
   chunks. A round of cutting makes at most ``2 * MAX_SPLITS`` chunks, so these rows
   are few; they are broadcast back and merged into each row.

The table itself is shuffled once; without hot keys the plan is the plain window.
With no key at all the whole table is one hot key, which makes a global running
value as parallel as any other. Chunks depend on exact aggregates only, so every
recomputation draws them alike.
"""

from __future__ import annotations

import warnings
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_SPLITS = 65_536
CHUNK_ROWS = 131_072
# A chunk this many times larger than planned is cut again.
TOO_LARGE = 4


@dataclass(frozen=True)
class Running:
    """One running value: how to fold rows, and which rows count.

    ``before`` leaves out the current row, ``whole`` takes all rows of the key.
    """

    kind: str
    value: Column
    before: bool = False
    whole: bool = False

    def local(self, window: WindowSpec) -> Column:
        last = Window.unboundedFollowing if self.whole else -1 if self.before else 0
        w = window.rowsBetween(Window.unboundedPreceding, last)
        if self.kind == "first":
            return F.first(F.struct(self.value.alias("v"))).over(w)
        if self.kind == "last":
            return F.last(self.value, ignorenulls=True).over(w)
        return _FOLDS[self.kind](self.value).over(w)

    def total(self, order: Column) -> Column:
        if self.kind == "first":
            return F.min_by(F.struct(self.value.alias("v")), order)
        if self.kind == "last":
            return F.max_by(self.value, F.when(self.value.isNotNull(), order))
        return _FOLDS[self.kind](self.value)

    def prefix(self, total: Column, window: WindowSpec) -> Column:
        last = Window.unboundedFollowing if self.whole else -1
        w = window.rowsBetween(Window.unboundedPreceding, last)
        if self.kind == "first":
            return F.first(total, ignorenulls=True).over(w)
        if self.kind == "last":
            return F.last(total, ignorenulls=True).over(w)
        return _FOLDS[self.kind](total).over(w)

    def merge(self, carry: Column | None, local: Column) -> Column:
        if carry is None:
            return local.getField("v") if self.kind == "first" else local
        if self.whole:
            return F.coalesce(carry, local)
        if self.kind == "sum":
            return F.coalesce(carry + local, carry, local)
        if self.kind == "max":
            return F.greatest(carry, local)
        if self.kind == "min":
            return F.least(carry, local)
        if self.kind == "first":
            return F.coalesce(carry, local).getField("v")
        return F.coalesce(local, carry)


_FOLDS: dict[str, Callable[[Column], Column]] = {"sum": F.sum, "max": F.max, "min": F.min}


def running_sum(value: Column, before: bool = False) -> Running:
    return Running("sum", value, before)


def running_count(before: bool = False) -> Running:
    return Running("sum", F.lit(1).cast("bigint"), before)


def whole_count() -> Running:
    """The key's row count, on every row."""
    return Running("sum", F.lit(1).cast("bigint"), whole=True)


def running_max(value: Column, before: bool = False) -> Running:
    return Running("max", value, before)


def running_min(value: Column, before: bool = False) -> Running:
    return Running("min", value, before)


def first_value(value: Column) -> Running:
    """Value of the key's first row, null or not."""
    return Running("first", value)


def last_value(value: Column, before: bool = False) -> Running:
    """Latest non-null value."""
    return Running("last", value, before)


class OrderedScan:
    """Adds running values to ``df`` per key in the given order.

    ``keys`` may be empty (one global order). ``order`` lists column names, the
    first numeric or a timestamp; together they should order rows totally.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        chunk_rows: int = CHUNK_ROWS,
    ) -> None:
        self.keys = list(keys)
        self.order = list(order)
        self.chunks: list[str] = []
        self.rows = df
        self._cut_hot_keys(chunk_rows)

    def _positions(self) -> list[Column]:
        """The order columns that rows can be cut along, as integers."""
        found = []
        for name in self.order:
            kind = self.rows.schema[name].dataType
            if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
                found.append(F.unix_micros(F.col(name).cast("timestamp")))
            elif isinstance(kind, T.IntegralType):
                found.append(F.col(name).cast("bigint"))
            else:
                break
        if not found:
            raise TypeError("the first order column must be an integer or a timestamp")
        return found

    def _cut_hot_keys(self, chunk_rows: int) -> None:
        at = self._positions()
        # On a plain scan this reads file footers only.
        count = self.rows.count()
        limit = max(chunk_rows, count / MAX_SPLITS)
        if count <= limit:
            return
        while True:
            group = [*self.keys, *self.chunks]
            source = self.hot_rows() if self.chunks else self.rows
            sizes = source.groupBy(*group).agg(
                F.count(F.lit(1)).alias("__n"),
                *[F.min(p).alias(f"__lo_{i}") for i, p in enumerate(at)],
                *[F.max(p).alias(f"__hi_{i}") for i, p in enumerate(at)],
            )
            # Only a column that varies can cut a group; the first such one orders it.
            varies = [F.col(f"__hi_{i}") > F.col(f"__lo_{i}") for i in range(len(at))]
            cut_by, lo, hi = F.lit(None), F.lit(None), F.lit(None)
            for i in reversed(range(len(at))):
                cut_by = F.when(varies[i], F.lit(i)).otherwise(cut_by)
                lo = F.when(varies[i], F.col(f"__lo_{i}")).otherwise(lo)
                hi = F.when(varies[i], F.col(f"__hi_{i}")).otherwise(hi)
            ranges = sizes.select(
                *[F.col(k).alias(f"__hot_{i}") for i, k in enumerate(group)],
                "__n",
                cut_by.cast("int").alias("__by"),
                lo.cast("bigint").alias("__lo"),
                hi.cast("bigint").alias("__hi"),
            )
            most = limit * (TOO_LARGE if self.chunks else 1)
            width = (F.col("__hi") - F.col("__lo") + 1) / F.ceil(F.col("__n") / limit)
            hot = ranges.filter(F.col("__n") > most).select(
                *[f"__hot_{i}" for i in range(len(group))], "__by", "__lo", width.alias("__width")
            )
            found = hot.collect()
            whole = [r for r in found if r["__by"] is None]
            if whole:
                warnings.warn(
                    f"{len(whole)} keys of more than {most:.0f} rows have one order value only and stay whole",
                    stacklevel=2,
                )
            found = [r for r in found if r["__by"] is not None]
            if not found:
                return
            self._add_chunks(group, at, self.rows.sparkSession.createDataFrame(found, hot.schema))

    def _add_chunks(self, group: list[str], at: list[Column], hot: DataFrame) -> None:
        where = at[0]
        for i in range(1, len(at)):
            where = F.when(F.col("__by") == i, at[i]).otherwise(where)
        # A row without an order value sorts first, in a chunk of its own.
        chunk = F.when(
            F.col("__width").isNotNull(),
            F.coalesce(F.floor((where - F.col("__lo")) / F.col("__width")), F.lit(-1)),
        )
        name = f"__chunk_{len(self.chunks)}"
        if group:
            spread = self.rows.join(F.broadcast(hot), _same(group, "__hot_"), "left")
        else:
            only = hot.first()
            literals = {c: F.lit(only[c]) for c in ("__by", "__lo", "__width")}
            spread = self.rows.withColumns(literals)
        self.rows = spread.withColumn(name, chunk.cast("bigint")).drop(
            "__by", "__lo", "__width", *[f"__hot_{i}" for i in range(len(group))]
        )
        self.chunks = [*self.chunks, name]

    @property
    def split(self) -> bool:
        """Whether any key was cut into chunks."""
        return bool(self.chunks)

    @property
    def window(self) -> WindowSpec:
        """Window of one chunk of one key, in order."""
        parts = [*self.keys, *self.chunks]
        ordered = Window.orderBy(*self.order)
        return ordered.partitionBy(*parts) if parts else ordered

    @property
    def chunk_window(self) -> WindowSpec:
        """Window over the chunk totals of one key."""
        by_chunk = Window.orderBy(*self.chunks)
        return by_chunk.partitionBy(*self.keys) if self.keys else by_chunk

    def hot_rows(self) -> DataFrame:
        return self.rows.filter(F.col(self.chunks[0]).isNotNull())

    def with_carry(self, rows: DataFrame, carry: DataFrame) -> DataFrame:
        """Attach per-(key, chunk) columns, a bounded number of rows of them."""
        group = [*self.keys, *self.chunks]
        side = carry.select(
            *[F.col(c).alias(f"__carry_{i}") for i, c in enumerate(group)],
            *[c for c in carry.columns if c not in group],
        )
        return rows.join(F.broadcast(side), _same(group, "__carry_"), "left").drop(
            *[f"__carry_{i}" for i in range(len(group))]
        )

    def add(self, **values: Running) -> OrderedScan:
        """Add columns; later calls may build on columns of earlier ones."""
        keep = [c for c in self.rows.columns if c not in values]
        local = self.rows.withColumns(
            {f"__l_{name}": v.local(self.window) for name, v in values.items()}
        )
        if not self.split:
            return self._next(
                local.select(
                    *keep,
                    *[v.merge(None, F.col(f"__l_{n}")).alias(n) for n, v in values.items()],
                )
            )
        order = F.struct(*self.order) if len(self.order) > 1 else F.col(self.order[0])
        totals = (
            self.hot_rows()
            .groupBy(*self.keys, *self.chunks)
            .agg(*[v.total(order).alias(f"__t_{name}") for name, v in values.items()])
        )
        carry = totals.select(
            *self.keys,
            *self.chunks,
            *[
                v.prefix(F.col(f"__t_{name}"), self.chunk_window).alias(f"__c_{name}")
                for name, v in values.items()
            ],
        )
        merged = self.with_carry(local, carry).select(
            *keep,
            *[
                v.merge(F.col(f"__c_{name}"), F.col(f"__l_{name}")).alias(name)
                for name, v in values.items()
            ],
        )
        return self._next(merged)

    def map(self, **columns: Column) -> OrderedScan:
        """Add ordinary columns between two ``add`` calls."""
        return self._next(self.rows.withColumns(columns))

    def add_top(self, name: str, value: Column, k: int) -> OrderedScan:
        """Add the array of the ``k`` largest values so far, descending.

        Slot i holds the running maximum of what slot i-1 gave up, so the cost is
        k window columns over one sort rather than a growing list per row.
        """
        rows, tops = _top_slots(self.rows.withColumn("__v", value), F.col("__v"), self.window, k)
        local = rows.withColumn("__l_top", F.array_compact(F.array(*tops)))
        keep = [c for c in self.rows.columns if c != name]
        if not self.split:
            return self._next(local.select(*keep, F.col("__l_top").alias(name)))

        ranked = (
            self.hot_rows()
            .withColumn("__v", value)
            .filter(F.col("__v").isNotNull())
            .withColumn(
                "__rank",
                F.row_number().over(
                    Window.partitionBy(*self.keys, *self.chunks).orderBy(F.col("__v").desc(), *self.order)
                ),
            )
            .filter(F.col("__rank") <= k)
            .select(*self.keys, *self.chunks, "__rank", "__v")
        )
        per_key = self.chunk_window.orderBy(*self.chunks, "__rank")
        folded, slots = _top_slots(ranked, F.col("__v"), per_key, k)
        ends = folded.groupBy(*self.keys, *self.chunks).agg(
            F.max_by(F.array_compact(F.array(*slots)), "__rank").alias("__end")
        )
        # A chunk without any non-null value has no row in `ends`.
        group = [*self.keys, *self.chunks]
        marks = self.hot_rows().select(*group).distinct()
        named = ends.select(*[F.col(c).alias(f"__end_{i}") for i, c in enumerate(group)], "__end")
        carry = marks.join(named, _same(group, "__end_"), "left")
        before = self.chunk_window.rowsBetween(Window.unboundedPreceding, -1)
        carry = carry.select(
            *group, F.last("__end", ignorenulls=True).over(before).alias("__c_top")
        )
        both = F.concat(F.coalesce("__c_top", F.array().cast(_array_of(local))), F.col("__l_top"))
        merged = self.with_carry(local, carry).withColumn(
            "__top", F.slice(F.sort_array(both, asc=False), 1, k)
        )
        return self._next(merged.select(*keep, F.col("__top").alias(name)))

    def _next(self, rows: DataFrame) -> OrderedScan:
        twin = object.__new__(OrderedScan)
        twin.keys, twin.order, twin.chunks, twin.rows = self.keys, self.order, self.chunks, rows
        return twin

    def result(self) -> DataFrame:
        return self.rows.drop(*self.chunks)


def _same(columns: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of columns with their renamed twins."""
    on = F.lit(True)
    for i, name in enumerate(columns):
        on = on & F.col(name).eqNullSafe(F.col(f"{prefix}{i}"))
    return on


def _array_of(df: DataFrame) -> T.DataType:
    return df.schema["__l_top"].dataType


def _top_slots(
    df: DataFrame, value: Column, window: WindowSpec, k: int
) -> tuple[DataFrame, list[Column]]:
    upto = window.rowsBetween(Window.unboundedPreceding, 0)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    incoming = value
    slots = []
    for i in range(k):
        df = df.withColumns(
            {
                f"__top_{i}": F.max(incoming).over(upto),
                f"__held_{i}": F.max(incoming).over(before),
            }
        )
        slots.append(F.col(f"__top_{i}"))
        given_up = F.when(
            incoming.isNotNull() & F.col(f"__held_{i}").isNotNull(),
            F.least(incoming, F.col(f"__held_{i}")),
        )
        df = df.withColumn(f"__in_{i + 1}", given_up)
        incoming = F.col(f"__in_{i + 1}")
    return df, slots
