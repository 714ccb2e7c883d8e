"""Running values per key on streams, without a key's rows in one task.

A stateful operator hands all rows that a batch has for a key to one task. Here each micro-batch runs the batch form,
an ``OrderedScan``, over its rows and one row per key that holds the key's values so far. That row comes before all rows of
the batch, so it is a row like others, and a hot key is cut into chunks as in a table. What the batch leaves is again one row per
key, from a two-phase aggregation. Every batch rewrites the rows of all keys, so batches should be large against their number.

The order columns must rise from batch to batch. Output and carry lie under the checkpoint by batch number: a repeated batch
replaces its own, and a run with the same checkpoint goes on where the last stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.windows import BLOCK_ROWS, recent_sums
from millrace.plans.scan import CHUNK_ROWS, OrderedScan, Running, first_value, last_value, running_count, whole_count
from millrace.session import scratch_dir
from millrace.streaming.batchwise import Carry
from millrace.streaming.run import BatchTable, Replay, ddl, run_batches


def _follow(
    stream: DataFrame,
    step: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]],
    state_of: Callable[[DataFrame], DataFrame],
    then: Callable[[DataFrame], DataFrame],
    label: str,
    checkpoint: str | None,
    replays: Sequence[Replay],
    upto: int | None,
) -> DataFrame:
    """Run ``step(batch, past) -> (rows, state)`` per batch; ``state_of`` an empty batch gives the state's columns."""
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_dir(spark, f"{label}-ckpt")
    none = spark.createDataFrame([], stream.schema)
    empty = state_of(none)
    carry = Carry(spark, empty.schema, f"{checkpoint}/kept/state")
    out = BatchTable(spark, f"{checkpoint}/kept/rows")
    result = then(step(none, empty)[0]).schema

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        rows, state = step(batch, carry.table(batch_id))
        out.write(then(rows), batch_id)
        carry.leave_table(state, batch_id)
        batch.unpersist()

    run_batches(stream, handle, label, checkpoint, replays=replays, upto=upto)
    return out.read(ddl(result)).drop("batch")


def follow_running(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Running],
    label: str,
    then: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    checkpoint: str | None = None,
    replays: Sequence[Replay] = (),
    upto: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Adds running values to each row of a stream; ``then`` shapes a batch's rows before they are written."""
    held = F.col("__held")
    place = F.struct(*order)

    def total(name: str, value: Running) -> object:
        folded = value.total(place)
        return (folded.getField("v") if value.kind == "first" else folded).alias(f"__s_{name}")

    def state_of(rows: DataFrame, folds: Mapping[str, Running] = values) -> DataFrame:
        made = rows.groupBy(*keys).agg(F.max(place).alias("__at"), *[total(n, v) for n, v in folds.items()])
        return made.select(*keys, *[F.col("__at").getField(c).alias(c) for c in order], *[f"__s_{n}" for n in folds])

    def step(batch: DataFrame, past: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = batch.withColumn("__held", F.lit(False)).unionByName(past.withColumn("__held", F.lit(True)), allowMissingColumns=True)
        folds = {n: replace(v, value=F.when(held, F.col(f"__s_{n}")).otherwise(v.value)) for n, v in values.items()}
        made = OrderedScan(rows, keys, order, chunk_rows).add(**folds).result()
        return made.where(~held).select(*batch.columns, *values), state_of(rows, folds)

    return _follow(stream, step, state_of, then, label, checkpoint, replays, upto)


def follow_top(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    k: int,
    label: str,
    then: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    checkpoint: str | None = None,
    replays: Sequence[Replay] = (),
    upto: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Adds ``top``, the k largest values so far, descending, and ``top_before``, the same before the row."""
    at = [*order, "__slot"]

    def state_of(rows: DataFrame) -> DataFrame:
        # A key's list only ever rises in the order of arrays, so the greatest is the last.
        where = F.max(F.struct(*order)).alias("__at")
        made = rows.withColumn("top", F.array(F.col(value)) if "top" not in rows.columns else F.col("top")).groupBy(*keys).agg(where, F.max("top").alias("__top"))
        return made.select(*keys, *[F.col("__at").getField(c).alias(c) for c in order], "__top")

    def step(batch: DataFrame, past: DataFrame) -> tuple[DataFrame, DataFrame]:
        # A key without a value yet has an empty list, and must keep its row.
        slots = past.select(*keys, *order, F.posexplode_outer("__top").alias("__slot", value), F.lit(True).alias("__held"))
        fresh = batch.withColumns({"__held": F.lit(False), "__slot": F.lit(k)})
        scan = OrderedScan(fresh.unionByName(slots, allowMissingColumns=True), keys, at, chunk_rows).add_top("top", F.col(value), k)
        made = scan.add(top_before=last_value(F.col("top"), before=True)).result()
        none = F.array().cast(made.schema["top"].dataType)
        rows = made.where(~F.col("__held")).withColumn("top_before", F.coalesce("top_before", none))
        return rows.select(*batch.columns, "top", "top_before"), state_of(made)

    return _follow(stream, step, state_of, then, label, checkpoint, replays, upto)


def follow_counts(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    size: int,
    slide: int,
    value: str,
    label: str,
    checkpoint: str | None = None,
    replays: Sequence[Replay] = (),
    upto: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every ``slide`` rows per key, count and sum of the last ``size`` rows; ``firing`` is the row's number.

    The carry is a key's last rows with their numbers, as many as a later window can still reach. With
    ``slide == size`` windows do not overlap and only full ones fire.
    """
    reach = max(size - 1, 1)
    kept = [*keys, *order, value, "__no"]

    def numbered_of(rows: DataFrame) -> DataFrame:
        # A key's first row is its earliest carried one, whose number is known, or its very first.
        scan = OrderedScan(rows, keys, order, chunk_rows).add(__rn=running_count(), __first=first_value(F.col("__no")), __all=whole_count())
        return scan.result().withColumn("__no", F.col("__rn") + F.coalesce("__first", F.lit(1)) - 1)

    def state_of(rows: DataFrame) -> DataFrame:
        numbered = rows if "__rn" in rows.columns else numbered_of(rows.withColumn("__no", F.lit(None).cast("bigint")))
        return numbered.where(F.col("__rn") > F.col("__all") - reach).select(*kept)

    def step(batch: DataFrame, past: DataFrame) -> tuple[DataFrame, DataFrame]:
        fresh = batch.select(*keys, *order, value, F.lit(None).cast("bigint").alias("__no"), F.lit(False).alias("__held"))
        numbered = numbered_of(fresh.unionByName(past.withColumn("__held", F.lit(True))))
        summed = recent_sums(numbered, keys, "__no", size, value, block_rows)
        fired = summed.where(~F.col("__held") & (F.col("__no") % slide == 0))
        return fired.select(*keys, F.col("__no").alias("firing"), "n", "total"), state_of(numbered)

    return _follow(stream, step, state_of, lambda rows: rows, label, checkpoint, replays, upto)


def top_changes(rows: DataFrame, k: int) -> DataFrame:
    """The change rows of a top-k list: ``op`` -D and +I, ``rank`` and ``value``, for ranks that changed only."""

    def change(op: str, rank: int, value: object) -> object:
        return F.struct(F.lit(op).alias("op"), F.lit(rank).alias("rank"), value.alias("value"))

    changes = []
    for rank in range(1, k + 1):
        old, new = F.get("top_before", F.lit(rank - 1)), F.get("top", F.lit(rank - 1))
        differs = ~old.eqNullSafe(new)
        changes += [F.when(differs & old.isNotNull(), change("-D", rank, old)), F.when(differs & new.isNotNull(), change("+I", rank, new))]
    others = [c for c in rows.columns if c not in ("top", "top_before")]
    return rows.select(*others, F.explode(F.array_compact(F.array(*changes))).alias("__c")).select(*others, "__c.op", "__c.rank", "__c.value")
