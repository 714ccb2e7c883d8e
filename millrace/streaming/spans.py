"""Windows on streams with user-defined accumulators, and whole windows as rows.

Each micro-batch adds its rows to the windows that are still open. The watermark moves between batches: it is the largest time of
the batches before less the delay. A window that it has passed is finished; rows that come for it later make a window of
their own, marked ``late``. Rows without a time belong to no window. The carry is one accumulator per
open window, or the rows of the open windows, so it follows the delay and not the stream's length. The same checkpoint resumes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.custom import Aggregator, finish_folds, fold_rows, merge_folds
from millrace.operators.windows import window_elements
from millrace.plans.scan import CHUNK_ROWS, OrderedScan, running_max
from millrace.session import remove_dir, scratch_dir
from millrace.streaming.batchwise import Carry
from millrace.streaming.run import BatchTable, Replay, ddl, run_batches

NEVER = -(2**62)


def _until(agg: Aggregator) -> Aggregator:
    """The same accumulator with the time of its last row, which ends a session."""
    return Aggregator(
        create=lambda: (*agg.create(), NEVER),
        add=lambda acc, rows: (*agg.add(acc[:-1], rows), max(acc[-1], int(rows["__last"].max()))),
        merge=lambda a, b: (*agg.merge(a[:-1], b[:-1]), max(a[-1], b[-1])),
        result=lambda acc: agg.result(acc[:-1]),
        accumulator=f"{agg.accumulator}, __last bigint",
        output=agg.output,
    )


def follow_aggregates(
    stream: DataFrame,
    keys: Sequence[str],
    time: str,
    agg: Aggregator,
    delay_us: int,
    label: str,
    length_us: int | None = None,
    gap_us: int | None = None,
    checkpoint: str | None = None,
    replays: Sequence[Replay] = (),
    upto: int | None = None,
    at_end: bool = True,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """A user-defined accumulator per key and window: tumbling of ``length_us``, or sessions of rows at most ``gap_us`` apart.

    Tasks fold their own rows and accumulators are merged in two steps, so a hot key's rows need not meet. A row that joins two
    open sessions merges their accumulators. Gives the keys, ``window_start``, ``window_end``, ``late`` and the
    accumulator's output. ``at_end`` also gives the windows still open when the input ends; a run that will be
    resumed leaves it out.
    """
    if (length_us is None) == (gap_us is None):
        raise ValueError("give either length_us or gap_us")
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_dir(spark, f"{label}-ckpt")
    spanned = _until(agg)
    group = [*keys, "__start"]
    held = [*group, *(f.name for f in T._parse_datatype_string(spanned.accumulator).fields)]
    named = ", ".join(f"`{k}` {dict(stream.dtypes)[k]}" for k in keys)
    folds = f"{named}, __start bigint, {spanned.accumulator}"
    marks = Carry(spark, "seen_us bigint", f"{checkpoint}/kept/marks")
    windows = Carry(spark, folds, f"{checkpoint}/kept/windows")
    merged = BatchTable(spark, f"{checkpoint}/kept/merged")
    out = BatchTable(spark, f"{checkpoint}/kept/rows")
    end = F.col("__start") + length_us if length_us else F.col("__last") + gap_us

    def finished(rows: DataFrame, late: Column) -> DataFrame:
        bounds = {"window_start": F.timestamp_micros("__start"), "window_end": F.timestamp_micros(end), "late": late}
        placed = rows.withColumns(bounds)
        return finish_folds(placed, [*keys, *bounds], spanned)

    result = finished(windows.table(0), F.lit(False)).schema

    def started(rows: DataFrame, past: DataFrame) -> tuple[DataFrame, DataFrame]:
        """New rows and open windows with the start of the window they are in now."""
        at = F.unix_micros(F.col(time).cast("timestamp"))
        fresh = rows.withColumns({"__at": at, "__last": at}).where(F.col("__at").isNotNull())
        if length_us:
            return fresh.withColumn("__start", F.col("__at") - F.pmod("__at", F.lit(length_us))), past
        # An open session stands in the order as one row that reaches to its last.
        both = fresh.withColumn("__open", F.lit(False)).unionByName(
            past.withColumns({"__open": F.lit(True), "__at": F.col("__start")}).drop("__start"), allowMissingColumns=True
        )
        scan = OrderedScan(both, keys, ["__at", "__last"], chunk_rows).add(__reach=running_max(F.col("__last"), before=True))
        apart = F.col("__reach").isNull() | (F.col("__at") - F.col("__reach") > gap_us)
        joined = scan.map(__opens=F.when(apart, F.col("__at"))).add(__start=running_max(F.col("__opens"))).result()
        return joined.where(~F.col("__open")).select(*fresh.columns, "__start"), joined.where("__open").select(*held)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        past = marks.before(batch_id)
        seen = past["seen_us"] if past else None
        rows, still = started(batch, windows.table(batch_id))
        partial = fold_rows(rows, group, spanned).unionByName(still.withColumn("__slot", F.lit(0)))
        merged.write(merge_folds(partial, group, spanned, results=False), batch_id)
        latest = batch.agg(F.max(F.unix_micros(F.col(time).cast("timestamp")))).first()[0]
        batch.unpersist()
        known = [t for t in (seen, latest) if t is not None]
        now = max(known, default=None)
        made = merged.read(folds).where(F.col("batch") == batch_id).drop("batch")

        def passed(mark: int | None) -> Column:
            return F.lit(False) if mark is None else end <= mark - delay_us

        out.write(finished(made.where(passed(now)), passed(seen)), batch_id)
        windows.leave_table(made.where(~passed(now)), batch_id)
        marks.leave(spark.createDataFrame([(now,)], marks.schema), batch_id)
        remove_dir(spark, f"{merged.path}/batch={batch_id - 1}")

    run_batches(stream, handle, label, checkpoint, replays=replays, upto=upto)
    rows = out.read(ddl(result)).drop("batch")
    return rows.unionByName(finished(windows.latest(), F.lit(False))) if at_end else rows


def follow_elements(
    stream: DataFrame,
    keys: Sequence[str],
    time: str,
    length: str,
    order: Sequence[str],
    delay_us: int,
    label: str,
    checkpoint: str | None = None,
    replays: Sequence[Replay] = (),
    upto: int | None = None,
    at_end: bool = True,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``window_elements`` over a stream: a window's rows come out one by one once the watermark passes its end.

    Rows of open windows are carried as rows, so a window may hold any number. Late rows come out alone, with ``late`` and
    without place and count.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_dir(spark, f"{label}-ckpt")
    marks = Carry(spark, "seen_us bigint", f"{checkpoint}/kept/marks")
    open_rows = Carry(spark, stream.schema, f"{checkpoint}/kept/open")
    out = BatchTable(spark, f"{checkpoint}/kept/rows")

    def whole(rows: DataFrame) -> DataFrame:
        return window_elements(rows, time, length, keys, order, chunk_rows).withColumn("late", F.lit(False))

    result = whole(open_rows.table(0)).schema

    def passed(mark: int | None, delay: int = delay_us) -> Column:
        if mark is None:
            return F.lit(False)
        return F.unix_micros(F.window(time, length).end.cast("timestamp")) <= mark - delay

    def split(rows: DataFrame, mark: int | None) -> tuple[DataFrame, DataFrame]:
        """Rows of windows the mark has passed, and the others. A window column must be projected before it is compared."""
        marked = rows.where(F.col(time).isNotNull()).withColumn("__gone", passed(mark))
        return marked.where("__gone").drop("__gone"), marked.where(~F.col("__gone")).drop("__gone")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        past = marks.before(batch_id)
        seen = past["seen_us"] if past else None
        latest = batch.agg(F.max(F.unix_micros(F.col(time).cast("timestamp")))).first()[0]
        now = max([t for t in (seen, latest) if t is not None], default=None)
        late, fresh = split(batch, seen)
        closed, still = split(fresh.unionByName(open_rows.table(batch_id)), now)
        spans = late.withColumn("__w", F.window(time, length)).select(
            *stream.columns, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), F.lit(True).alias("late")
        )
        out.write(whole(closed).unionByName(spans, allowMissingColumns=True), batch_id)
        open_rows.leave_table(still, batch_id)
        marks.leave(spark.createDataFrame([(now,)], marks.schema), batch_id)
        batch.unpersist()

    run_batches(stream, handle, label, checkpoint, replays=replays, upto=upto)
    rows = out.read(ddl(result)).drop("batch")
    if not at_end:
        return rows
    return rows.unionByName(whole(open_rows.latest().where(F.col(time).isNotNull())))
