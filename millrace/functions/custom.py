"""User-defined aggregates with an accumulator, run in two phases.

The accumulator contract is the usual one: create, add rows, merge, give a result,
with input, accumulator and output of different types. ``add`` gets all rows of a
key in an Arrow batch at once, so its body can be vectorised.

Each task folds its own rows first. Accumulators are then merged in two steps, by
key and slot and then by key, so a hot key's accumulators never meet all at once. A merging
task takes sorted rows of many keys in one pass.
Prefer built-in aggregates where they express the same fold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLOTS = 64
HELD_KEYS = 50_000


@dataclass(frozen=True)
class Aggregator:
    """``merge`` must be associative and commutative."""

    create: Callable[[], tuple]
    add: Callable[[tuple, pd.DataFrame], tuple]
    merge: Callable[[tuple, tuple], tuple]
    result: Callable[[tuple], Any]
    accumulator: str
    output: str


def _names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]


def _key_types(df: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    return df.select(*keys).schema.fields


def _parts(key_types: Sequence[T.StructField], agg: Aggregator) -> T.StructType:
    slot = T.StructField("__slot", T.IntegerType())
    return T.StructType([*key_types, slot, *T._parse_datatype_string(agg.accumulator).fields])


def fold_rows(df: DataFrame, keys: Sequence[str], agg: Aggregator) -> DataFrame:
    """Each task's accumulators: the key columns, ``__slot`` and those of ``agg.accumulator``. No shuffle."""
    keys = list(keys)
    parts = _parts(_key_types(df, keys), agg)

    def rows_of(folded: dict[tuple, tuple], slot: int) -> pd.DataFrame:
        return pd.DataFrame(
            [(*key, slot, *acc) for key, acc in folded.items()], columns=_names(parts)
        ).astype(object)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slot = TaskContext.get().partitionId() % SLOTS
        folded: dict[tuple, tuple] = {}
        for batch in batches:
            for key, rows in batch.groupby(keys, dropna=False, sort=False):
                key = tuple(None if pd.isna(k) else k for k in key)
                folded[key] = agg.add(folded.get(key) or agg.create(), rows)
            if len(folded) > HELD_KEYS:
                yield rows_of(folded, slot)
                folded = {}
        if folded:
            yield rows_of(folded, slot)

    return df.mapInPandas(fold, parts)


def merge_folds(partial: DataFrame, keys: Sequence[str], agg: Aggregator, results: bool = True) -> DataFrame:
    """Accumulators of equal keys merged, by key and slot first: the key columns and ``agg.output``.

    Without ``results`` the accumulators themselves come out, for a later merge.
    """
    keys = list(keys)
    key_types = _key_types(partial, keys)
    parts = _parts(key_types, agg)
    held = _names(parts)[len(keys) + 1 :]
    ends = T.StructType(key_types + T._parse_datatype_string(agg.output if results else agg.accumulator).fields)

    def merging(whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """Merge the runs of equal keys in sorted rows; ``whole`` ends the merging."""
        width = len(keys) if whole else len(keys) + 1
        schema = to_arrow_schema(ends if whole else parts)

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

        def finished(key: tuple, total: tuple) -> tuple:
            if not (whole and results):
                return (*key, *total)
            result = agg.result(total)
            return (*key, *(result if isinstance(result, tuple) else (result,)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, total, rows = None, None, []
            for batch in batches:
                values = batch.to_pydict()
                heads = zip(*[values[c] for c in _names(parts)[:width]], strict=True)
                for head, acc in zip(heads, zip(*[values[c] for c in held], strict=True), strict=True):
                    if head == key:
                        total = agg.merge(total, acc)
                        continue
                    if key is not None:
                        rows.append(finished(key, total))
                    key, total = head, acc
                    if len(rows) >= HELD_KEYS:
                        yield made(rows)
                        rows = []
            if key is not None:
                yield made([*rows, finished(key, total)])

        return run

    n = int(partial.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = [*keys, "__slot"]
    rows = partial.select(*_names(parts))
    per_slot = rows.repartition(n, *slots).sortWithinPartitions(*slots).mapInArrow(merging(False), parts)
    return per_slot.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(merging(True), ends)


def aggregate_by(df: DataFrame, keys: Sequence[str], agg: Aggregator) -> DataFrame:
    """One row per key: the key columns and ``agg.output``."""
    return merge_folds(fold_rows(df, keys, agg), keys, agg)


def finish_folds(folds: DataFrame, keys: Sequence[str], agg: Aggregator) -> DataFrame:
    """The results of accumulators that need no more merging, one row per key."""
    key_types = _key_types(folds, keys)
    held = _names(T._parse_datatype_string(agg.accumulator))
    out = T.StructType(key_types + T._parse_datatype_string(agg.output).fields)
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.to_pydict()
            results = [agg.result(acc) for acc in zip(*[values[c] for c in held], strict=True)]
            results = [r if isinstance(r, tuple) else (r,) for r in results]
            columns = [*[values[k] for k in keys], *(zip(*results, strict=True) if results else [[] for _ in range(len(schema) - len(keys))])]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return folds.select(*keys, *held).mapInArrow(run, out)
