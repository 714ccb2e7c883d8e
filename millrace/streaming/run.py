"""Running streams to their end, replaying tables as streams, idempotent output."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from millrace.session import configure, scratch_dir


def step_of(df: DataFrame, order: str, steps: int) -> Column:
    """The number of a row's step, when the integer column ``order`` is cut at its quantiles into so many."""
    cuts = [i / steps for i in range(1, steps)]
    bounds = df.agg(F.percentile_approx(order, cuts, 100_000)).first()[0] if cuts else []
    return sum((F.coalesce(F.col(order) > b, F.lit(False)).cast("int") for b in bounds or []), F.lit(0))


class Replay:
    """A table published step by step to a folder that a stream reads.

    ``order``, an integer column, is cut at its quantiles into ``steps`` spans; the number of
    steps is the caller's alone. Two passes read the table whatever the steps: one for the
    quantiles, one that writes all steps in one job, many files each. ``publish`` then
    copies a step's folder to the stream's, and a run takes it as one micro-batch, so no row
    overtakes a row of an earlier step. Rows of equal order share a step. ``end`` adds
    a last step.
    """

    def __init__(self, df: DataFrame, order: str, steps: int, end: DataFrame | None = None) -> None:
        self.spark, self.schema, self.steps = df.sparkSession, df.schema, steps
        self.path, self.staged = scratch_dir(self.spark, "replay"), scratch_dir(self.spark, "staged")
        self.next = 0
        staged = df.withColumn("__step", step_of(df, order, steps))
        if end is not None:
            staged = staged.unionByName(end.withColumn("__step", F.lit(steps)))
            self.steps += 1
        staged.hint("rebalance", F.col("__step")).write.partitionBy("__step").parquet(self.staged)
        self.spark.createDataFrame([], self.schema).write.parquet(self.path)

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).parquet(self.path)

    def publish(self) -> None:
        """Hand the next step to the stream; nothing happens after the last."""
        staged = self.spark.read.schema(f"{ddl(self.schema)}, __step int").parquet(self.staged)
        staged.where(F.col("__step") == self.next).drop("__step").write.mode("append").parquet(self.path)
        self.next += 1


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


@contextmanager
def _state_partitions(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """A stateful stream keeps the partition count it starts with; one per core by default."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(partitions or max(2, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _finish(
    spark: SparkSession,
    writer: Callable[[], DataStreamWriter],
    partitions: int | None,
    replays: Sequence[Replay] = (),
    upto: int | None = None,
    single_batch: bool = False,
    drain: bool = False,
) -> None:
    """Run over what is there, or over each step of the replays in turn, up to ``upto`` of them."""
    configure(spark)
    if drain:
        with _state_partitions(spark, partitions):
            running = writer().start()
            try:
                running.processAllAvailable()
            finally:
                running.stop()
        return
    trigger = {"once": True} if single_batch else {"availableNow": True}
    with _state_partitions(spark, partitions):
        while True:
            for replay in replays:
                if replay.next < replay.steps:
                    replay.publish()
            writer().trigger(**trigger).start().awaitTermination()
            done = max((r.next for r in replays), default=1)
            if all(r.next >= r.steps for r in replays) or (upto is not None and done >= upto):
                break


def run_to_table(
    stream: DataFrame,
    label: str,
    path: str | None = None,
    checkpoint: str | None = None,
    mode: str = "append",
    partitions: int | None = None,
    single_batch: bool = False,
    replays: Sequence[Replay] = (),
    upto: int | None = None,
    drain: bool = False,
) -> DataFrame:
    """Run a stream over all available input into Parquet; return the table written.

    With ``replays`` each of their steps is published and taken as one micro-batch. ``drain`` lets a source that
    sets the size of its batches go through all of them, and close what their watermark reaches, in one run.

    Giving the same ``path`` and ``checkpoint`` again resumes where the run stopped.
    Processors on the ``ProcessingTime`` clock have no last batch, as a timer may
    always be due; run those with ``single_batch``, once per batch wanted.
    """
    spark = stream.sparkSession
    path = path or scratch_dir(spark, f"{label}-out")
    checkpoint = checkpoint or scratch_dir(spark, f"{label}-ckpt")

    def writer() -> DataStreamWriter:
        return (
            stream.writeStream.queryName(label)
            .format("parquet")
            .outputMode(mode)
            .option("path", path)
            .option("checkpointLocation", checkpoint)
        )

    _finish(spark, writer, partitions, replays, upto, single_batch, drain)
    return spark.read.schema(stream.schema).parquet(path)


def run_to_sink(
    stream: DataFrame,
    sink: str,
    options: Mapping[str, str],
    label: str,
    checkpoint: str,
    replays: Sequence[Replay] = (),
    upto: int | None = None,
) -> None:
    """Run a stream over all available input into a data source that takes streams."""

    def writer() -> DataStreamWriter:
        return stream.writeStream.queryName(label).format(sink).options(**options).option("checkpointLocation", checkpoint)

    _finish(stream.sparkSession, writer, None, replays, upto)


def run_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    label: str,
    checkpoint: str | None = None,
    mode: str = "append",
    partitions: int | None = None,
    replays: Sequence[Replay] = (),
    upto: int | None = None,
) -> None:
    """Run a stream over all available input, giving each micro-batch to ``handle``.

    After a failure Spark repeats the last batch under the same number, so
    ``handle`` must write idempotently by that number.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_dir(spark, f"{label}-ckpt")

    def writer() -> DataStreamWriter:
        return (
            stream.writeStream.queryName(label)
            .foreachBatch(handle)
            .outputMode(mode)
            .option("checkpointLocation", checkpoint)
        )

    _finish(spark, writer, partitions, replays, upto)


class BatchTable:
    """A Parquet table with one folder per micro-batch; a repeated batch replaces its folder."""

    def __init__(self, spark: SparkSession, path: str | None = None, label: str = "batches") -> None:
        self.spark = spark
        self.path = path or scratch_dir(spark, label)

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self, schema: str) -> DataFrame:
        return self.spark.read.schema(f"{schema}, batch bigint").parquet(self.path)

    def latest(self, schema: str, keys: Sequence[str]) -> DataFrame:
        """The newest row per key: the state of a stream in update mode."""
        rows = self.read(schema)
        values: list[str | Column] = [c for c in rows.columns if c not in (*keys, "batch")]
        newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("__row"))
        return newest.select(*keys, *[F.col("__row").getField(c).alias(c) for c in values])
