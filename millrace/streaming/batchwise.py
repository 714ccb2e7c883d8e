"""Streams whose rules need every earlier row: micro-batches with a small carry.

Each micro-batch runs the batch operator and leaves a carry for the next: the
largest event time so far, the latest setting, one row per source, or the rows and windows that are
still open. The carry is stored per batch
number, so a batch that Spark repeats finds the same past and rewrites its output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.combine import interval_join, keyed_connect, latest_setting
from millrace.operators.eventtime import classify_lateness, source_watermark, tag_late_sides
from millrace.plans.scan import CHUNK_ROWS, OrderedScan, running_count, running_sum
from millrace.session import remove_dir, scratch_dir
from millrace.streaming.run import BatchTable, Replay, ddl, run_batches


class Carry:
    """The rows a micro-batch leaves for the next, kept in the shared folder; older ones are removed."""

    def __init__(self, spark: SparkSession, schema: str | T.StructType, path: str | None = None) -> None:
        self.schema = schema
        self.rows = BatchTable(spark, path, "carry")
        empty = spark.createDataFrame([], schema)
        empty.write.mode("ignore").parquet(f"{self.rows.path}/batch=-1")

    def table(self, batch_id: int) -> DataFrame:
        """What the batch before ``batch_id`` left; batch numbers have no gaps."""
        folder = f"{self.rows.path}/batch={batch_id - 1}"
        return self.rows.spark.read.schema(self.schema).parquet(folder)

    def before(self, batch_id: int) -> Row | None:
        """The one row that the batch before ``batch_id`` left."""
        return self.table(batch_id).first()

    def leave(self, row: DataFrame, batch_id: int) -> None:
        self.leave_table(row.coalesce(1), batch_id)

    def leave_table(self, rows: DataFrame, batch_id: int) -> None:
        """Spark repeats the newest batch at most, so its own past and what it leaves are enough."""
        self.rows.write(rows, batch_id)
        remove_dir(self.rows.spark, f"{self.rows.path}/batch={batch_id - 2}")

    def latest(self) -> DataFrame:
        """What the newest batch left."""
        rows = self.rows.read(self.schema if isinstance(self.schema, str) else ddl(self.schema))
        last = rows.agg(F.max("batch")).first()[0]
        return self.table(-1 if last is None else last + 1)


def follow_connect(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    label: str,
    checkpoint: str | None = None,
    replays: Sequence[Replay] = (),
    upto: int | None = None,
) -> DataFrame:
    """``keyed_connect`` of two streams: every pair of rows with equal keys, once, whatever the arrival order.

    The history is a table under the checkpoint, with a folder per batch and side, as a state store would take each of its rows
    one by one. A batch joins its left rows with all right rows, and the left rows of earlier batches with its right ones.
    Every batch reads what came before, so batches should be large against it.
    """
    spark = left.sparkSession
    checkpoint = checkpoint or scratch_dir(spark, f"{label}-ckpt")
    kept, out = f"{checkpoint}/kept/sides", BatchTable(spark, f"{checkpoint}/kept/rows")
    sides = {"left": left, "right": right}
    schema = ", ".join(f"`{name}` {df.schema.simpleString()}" for name, df in sides.items())

    def tagged(name: str) -> DataFrame:
        values = [F.struct(*df.columns) if n == name else F.lit(None).cast(df.schema) for n, df in sides.items()]
        return sides[name].select(*[v.alias(n) for n, v in zip(sides, values, strict=True)], F.lit(name).alias("side"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("side").parquet(f"{kept}/batch={batch_id}")
        rows = spark.read.schema(f"{schema}, batch bigint, side string").parquet(kept)
        number = F.col("batch")

        def side(name: str, which: Column) -> DataFrame:
            return rows.where((F.col("side") == name) & which).select(f"{name}.*")

        made = keyed_connect(side("left", number == batch_id), side("right", number <= batch_id), left_key, right_key)
        if batch_id:
            before = keyed_connect(side("left", number < batch_id), side("right", number == batch_id), left_key, right_key)
            made = made.unionByName(before)
        out.write(made, batch_id)

    both = tagged("left").unionByName(tagged("right"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    run_batches(both, handle, label, checkpoint, partitions=partitions, replays=replays, upto=upto)
    return out.read(ddl(T.StructType([*left.schema.fields, *right.schema.fields]))).drop("batch")


def follow_lateness(
    stream: DataFrame,
    time_ms: Column,
    arrival: Sequence[str],
    window_ms: int,
    delay_ms: int,
    lateness_ms: int,
    label: str,
    checkpoint: str | None = None,
    replays: Sequence[Replay] = (),
    upto: int | None = None,
) -> DataFrame:
    """``classify_lateness`` over a stream, row by row and exact.

    Spark itself drops late rows silently and judges them once per micro-batch; here
    every row comes out with its status. ``arrival`` must rise from batch to batch.
    Carry and rows lie under the checkpoint, so a run that gives the same one goes on where
    the last stopped and returns the rows of all runs.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_dir(spark, f"{label}-ckpt")
    carry = Carry(spark, "max_ms bigint", f"{checkpoint}/kept/carry")
    out = BatchTable(spark, f"{checkpoint}/kept/rows")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        past = carry.before(batch_id)
        seen = past["max_ms"] if past else None
        rows = classify_lateness(
            batch, time_ms, arrival, window_ms, delay_ms, lateness_ms, max_before_ms=seen
        )
        out.write(rows, batch_id)
        latest = F.greatest(F.max(time_ms), F.lit(seen).cast("bigint"))
        carry.leave(batch.agg(latest.alias("max_ms")), batch_id)
        batch.unpersist()

    run_batches(stream, handle, label, checkpoint, replays=replays, upto=upto)
    kinds = ", ".join(f"{name} {kind}" for name, kind in stream.dtypes)
    return out.read(f"{kinds}, start_ms bigint, end_ms bigint, status string").drop("batch")


def follow_settings(
    stream: DataFrame,
    is_setting: Column,
    order: str,
    setting: str,
    default: int,
    label: str,
    checkpoint: str | None = None,
    replays: Sequence[Replay] = (),
    upto: int | None = None,
) -> DataFrame:
    """``latest_setting`` over one stream that carries data rows and setting rows.

    ``setting`` is the column that holds a setting row's value. Data rows come out
    with the setting in force in column ``threshold``. The same checkpoint resumes, as above.
    """
    spark = stream.sparkSession
    kind = dict(stream.dtypes)[setting]
    checkpoint = checkpoint or scratch_dir(spark, f"{label}-ckpt")
    carry = Carry(spark, f"setting {kind}", f"{checkpoint}/kept/carry")
    out = BatchTable(spark, f"{checkpoint}/kept/rows")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        past = carry.before(batch_id)
        seen = past["setting"] if past else None
        settings = batch.filter(is_setting).select(order, F.col(setting).alias("threshold"))
        current = latest_setting(
            batch.filter(~is_setting),
            settings,
            order,
            "threshold",
            default if seen is None else seen,
        )
        out.write(current, batch_id)
        last = settings.agg(F.max_by("threshold", order).alias("setting"))
        kept = F.coalesce("setting", F.lit(seen).cast(kind)).alias("setting")
        carry.leave(last.select(kept), batch_id)
        batch.unpersist()

    run_batches(stream, handle, label, checkpoint, replays=replays, upto=upto)
    kinds = ", ".join(f"{name} {t}" for name, t in stream.dtypes)
    return out.read(f"{kinds}, threshold {kind}").drop("batch")


def follow_sources(
    stream: DataFrame,
    source: str,
    sources: Sequence[str],
    time_ms: Column,
    clock_ms: Column,
    arrival: Sequence[str],
    delay_ms: int,
    idle_ms: int,
    label: str,
    checkpoint: str | None = None,
    replays: Sequence[Replay] = (),
    upto: int | None = None,
) -> DataFrame:
    """``source_watermark`` over a stream; the carry is one row per source.

    A source that went idle in an earlier batch, or before a restart, is still idle in the next one.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_dir(spark, f"{label}-ckpt")
    carry = Carry(spark, "source string, time_ms bigint, at_ms bigint, low_ms bigint", f"{checkpoint}/kept/carry")
    out = BatchTable(spark, f"{checkpoint}/kept/rows")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        past = {r["source"]: r for r in carry.table(batch_id).collect()}  # as many rows as sources
        low = max((r["low_ms"] for r in past.values() if r["low_ms"] is not None), default=None)
        seen = {name: (r["time_ms"], r["at_ms"]) for name, r in past.items()}
        rows = source_watermark(
            batch, source, sources, time_ms, clock_ms, arrival, delay_ms, idle_ms, before=seen, low_before_ms=low
        )
        out.write(rows, batch_id)
        written = out.read(f"{kinds}, watermark_ms bigint").where(F.col("batch") == batch_id)
        reached = written.agg(F.greatest(F.max("watermark_ms"), F.lit(low).cast("bigint"))).first()[0]
        order = F.struct(*arrival)
        now = batch.groupBy(F.col(source).alias("source")).agg(F.max(time_ms).alias("time_ms"), F.max_by(clock_ms, order).alias("at_ms"))
        known = carry.table(batch_id).select(F.col("source").alias("name"), F.col("time_ms").alias("t"), F.col("at_ms").alias("at"))
        both = now.where(F.col("source").isin(*sources)).join(known, F.col("source") == F.col("name"), "full")
        kept = both.select(
            F.coalesce("source", "name").alias("source"),
            F.greatest("time_ms", "t").alias("time_ms"),
            F.coalesce("at_ms", "at").alias("at_ms"),
            F.lit(reached).cast("bigint").alias("low_ms"),
        )
        carry.leave(kept, batch_id)
        batch.unpersist()

    kinds = ", ".join(f"{name} {kind}" for name, kind in stream.dtypes)
    run_batches(stream, handle, label, checkpoint, replays=replays, upto=upto)
    return out.read(f"{kinds}, watermark_ms bigint").drop("batch")


def follow_interval_join(
    stream: DataFrame,
    key: str,
    row_id: str,
    time: str,
    arrival: Sequence[str],
    lower_us: int,
    upper_us: int,
    delay_ms: int,
    label: str,
    checkpoint: str | None = None,
    replays: Sequence[Replay] = (),
    upto: int | None = None,
) -> DataFrame:
    """``interval_join_with_late`` over a stream of both inputs, whose ``side`` says left or right.

    Rows are tagged against the lower watermark of both sides first. Late ones come out by side; the others
    meet the new rows of the other side and the kept ones. A row is kept until no row in time can reach it any more, so what is
    carried follows the interval and the delay and not the stream's length.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_dir(spark, f"{label}-ckpt")
    kinds = dict(stream.dtypes)
    marks = Carry(spark, "left_ms bigint, right_ms bigint", f"{checkpoint}/kept/marks")
    held = Carry(spark, f"side string, `{key}` {kinds[key]}, id {kinds[row_id]}, at timestamp", f"{checkpoint}/kept/held")
    tags = BatchTable(spark, f"{checkpoint}/kept/tags")
    out = BatchTable(spark, f"{checkpoint}/kept/rows")
    columns = ["side", key, row_id, time]
    tagged_ddl = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", late boolean"

    def handle(batch: DataFrame, batch_id: int) -> None:
        past = marks.before(batch_id)
        seen = (past["left_ms"], past["right_ms"]) if past else (None, None)
        time_ms = F.unix_millis(F.col(time))
        tags.write(tag_late_sides(batch, time_ms, arrival, delay_ms, before=seen).select(*columns, "late"), batch_id)
        # Four outputs read the tagged rows, whose scan is global: run it once.
        tagged = tags.read(tagged_ddl).where(F.col("batch") == batch_id)
        new = tagged.where(~F.col("late")).select("side", key, F.col(row_id).alias("id"), F.col(time).alias("at"))
        old = held.table(batch_id)

        def of(rows: DataFrame, side: str) -> DataFrame:
            return rows.where(F.col("side") == side).select(key, F.col("id").alias(f"{side}_id"), F.col("at").alias(f"{side}_time"))

        def met(left: DataFrame, right: DataFrame) -> DataFrame:
            rows = interval_join(of(left, "left"), of(right, "right"), key, "left_time", "right_time", lower_us, upper_us)
            return rows.select(F.lit("joined").alias("tag"), key, "left_id", "right_id")

        is_left = F.col("side") == "left"
        late = tagged.where("late").select(
            F.concat(F.lit("late_"), "side").alias("tag"),
            key,
            F.when(is_left, F.col(row_id)).alias("left_id"),
            F.when(~is_left, F.col(row_id)).alias("right_id"),
        )
        out.write(met(new, new.unionByName(old)).unionByName(met(old, new)).unionByName(late), batch_id)
        reached = [F.greatest(F.max(F.when(F.col("side") == side, time_ms)), F.lit(s).cast("bigint")) for side, s in zip(("left", "right"), seen, strict=True)]
        left_ms, right_ms = tagged.agg(*reached).first()
        marks.leave(spark.createDataFrame([(left_ms, right_ms)], marks.schema), batch_id)
        kept = new.unionByName(old)
        if left_ms is not None and right_ms is not None:
            # No later row in time lies below this.
            least = F.lit((min(left_ms, right_ms) - delay_ms - 1) * 1000)
            reach = F.when(is_left, F.lit(upper_us)).otherwise(F.lit(-lower_us))
            kept = kept.where(F.unix_micros("at") + reach >= least)
        held.leave_table(kept, batch_id)
        remove_dir(spark, f"{tags.path}/batch={batch_id - 1}")

    run_batches(stream, handle, label, checkpoint, replays=replays, upto=upto)
    kind = kinds[row_id]
    return out.read(f"tag string, `{key}` {kinds[key]}, left_id {kind}, right_id {kind}").drop("batch")


def follow_firings(
    stream: DataFrame,
    keys: Sequence[str],
    time_ms: Column,
    arrival: Sequence[str],
    value: str,
    window_ms: int,
    delay_ms: int,
    lateness_ms: int,
    label: str,
    checkpoint: str | None = None,
    replays: Sequence[Replay] = (),
    upto: int | None = None,
    at_end: bool = True,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Windows with allowed lateness over a stream: main and late output of one operator, told apart by ``tag``.

    ``fired`` rows are those of ``window_firings``: each window at its end and again per accepted late row, with ``firing``, ``n``
    and ``total``. ``late`` rows come too late for their window and carry their value in ``total``. The carry holds the
    windows that still take rows: their rows so far and how often they fired. ``at_end`` also fires the
    windows still open when the input ends; a run that will be resumed leaves it out.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_dir(spark, f"{label}-ckpt")
    kinds = dict(stream.dtypes)
    group = [*keys, "start_ms", "end_ms"]
    named = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", start_ms bigint, end_ms bigint"
    marks = Carry(spark, "max_ms bigint", f"{checkpoint}/kept/marks")
    windows = Carry(spark, f"{named}, n bigint, total bigint, firings bigint", f"{checkpoint}/kept/windows")
    tags = BatchTable(spark, f"{checkpoint}/kept/tags")
    out = BatchTable(spark, f"{checkpoint}/kept/rows")
    result = f"tag string, {named}, firing bigint, n bigint, total bigint"
    needed = ", ".join(f"`{c}` {kinds[c]}" for c in dict.fromkeys([*arrival, value]))

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        past = marks.before(batch_id)
        seen = past["max_ms"] if past else None
        rows = classify_lateness(batch, time_ms, arrival, window_ms, delay_ms, lateness_ms, max_before_ms=seen)
        tags.write(rows.select(*group, *dict.fromkeys([*arrival, value]), "status"), batch_id)
        tagged = tags.read(f"{named}, {needed}, status string").where(F.col("batch") == batch_id).drop("batch")
        latest = batch.agg(F.greatest(F.max(time_ms), F.lit(seen).cast("bigint"))).first()[0]
        marks.leave(spark.createDataFrame([(latest,)], marks.schema), batch_id)
        batch.unpersist()
        watermark = None if latest is None else latest - delay_ms - 1
        number = F.coalesce(F.col(value), F.lit(0)).cast("bigint")
        fresh = tagged.where("status <> 'late'").groupBy(*group).agg(
            F.count_if(F.col("status") == "on_time").alias("new_n"),
            F.sum(F.when(F.col("status") == "on_time", number)).alias("new_total"),
            F.count_if(F.col("status") == "accepted").alias("late_n"),
            F.sum(F.when(F.col("status") == "accepted", number)).alias("late_total"),
        )
        # The windows carried and those of the batch, one row each.
        open_before = windows.table(batch_id)
        zero = F.lit(0).cast("bigint")
        state = (
            open_before.select(*group, "n", "total", "firings", *[zero.alias(c) for c in ("new_n", "new_total", "late_n", "late_total")])
            .unionByName(fresh.select(*group, *[zero.alias(c) for c in ("n", "total", "firings")], "new_n", F.coalesce("new_total", zero).alias("new_total"), "late_n", F.coalesce("late_total", zero).alias("late_total")))
            .groupBy(*group)
            .agg(*[F.sum(c).alias(c) for c in ("n", "total", "firings", "new_n", "new_total", "late_n", "late_total")])
        )
        passed = F.lit(False) if watermark is None else F.col("end_ms") - 1 <= F.lit(watermark)
        fires = passed & (F.col("firings") == 0) & (F.col("n") + F.col("new_n") > 0)
        state = state.select(
            *group,
            (F.col("n") + F.col("new_n")).alias("base_n"),
            (F.col("total") + F.col("new_total")).alias("base_total"),
            (F.col("firings") + fires.cast("bigint")).alias("base_firings"),
            fires.alias("fires"),
            "late_n",
            "late_total",
        )
        first = state.where("fires").select(F.lit("fired").alias("tag"), *group, zero.alias("firing"), F.col("base_n").alias("n"), F.col("base_total").alias("total"))
        accepted = OrderedScan(tagged.where("status = 'accepted'").select(*group, *dict.fromkeys([*arrival, value])), group, arrival, chunk_rows).add(
            k=running_count(), more=running_sum(number)
        )
        renamed = state.select(*[F.col(c).alias(f"__{c}") for c in group], "base_n", "base_total", "base_firings")
        on = F.lit(True)
        for c in group:
            on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
        again = accepted.result().join(renamed, on).select(
            F.lit("fired").alias("tag"),
            *group,
            (F.col("base_firings") + F.col("k") - 1).alias("firing"),
            (F.col("base_n") + F.col("k")).alias("n"),
            (F.col("base_total") + F.col("more")).alias("total"),
        )
        late = tagged.where("status = 'late'").select(
            F.lit("late").alias("tag"), *group, F.lit(None).cast("bigint").alias("firing"), F.lit(None).cast("bigint").alias("n"), F.col(value).cast("bigint").alias("total")
        )
        out.write(first.unionByName(again).unionByName(late), batch_id)
        left = state.select(
            *group, (F.col("base_n") + F.col("late_n")).alias("n"), (F.col("base_total") + F.col("late_total")).alias("total"), (F.col("base_firings") + F.col("late_n")).alias("firings")
        )
        if watermark is not None:
            left = left.where(F.col("end_ms") - 1 + lateness_ms > F.lit(watermark))
        windows.leave_table(left, batch_id)
        remove_dir(spark, f"{tags.path}/batch={batch_id - 1}")

    run_batches(stream, handle, label, checkpoint, replays=replays, upto=upto)
    made = out.read(result).drop("batch")
    if at_end:
        still = windows.latest().where((F.col("firings") == 0) & (F.col("n") > 0))
        made = made.unionByName(still.select(F.lit("fired").alias("tag"), *group, F.lit(0).cast("bigint").alias("firing"), "n", "total"))
    return made
