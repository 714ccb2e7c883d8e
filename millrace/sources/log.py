"""Keyed logs: options for a message-log connector, and a log kept in files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_dir
from millrace.streaming.run import run_batches


def kafka_source_options(
    servers: str,
    topic: str,
    start: str = "latest",
    committed_only: bool = False,
    group_prefix: str | None = None,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of ``readStream.format("kafka")``, a connector that ships apart from Spark.

    ``start`` is ``earliest`` or ``latest`` and applies whatever the group has read.
    """
    if start not in ("earliest", "latest"):
        raise ValueError("start must be earliest or latest")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
    }
    if committed_only:
        options["kafka.isolation.level"] = "read_committed"
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_lines(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The values of a topic as text, with the broker's time in ``created``."""
    rows = spark.readStream.format("kafka").options(**options).load()
    return rows.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("created"))


class FileLog:
    """A keyed log in Parquet: ``records/batch=N`` and, once complete, ``commits/batch=N``.

    Appending a batch that is already committed does nothing and an incomplete one
    is replaced, so a repeated append leaves exactly one copy.
    """

    RECORDS = "key string, value string, offset bigint, batch bigint"

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.spark = spark
        self.path = path or scratch_dir(spark, "log")
        # Batch -1 is empty and makes both folders readable before the first append.
        none = spark.range(0)
        self._records_of(none.select(F.lit("").alias("key"), F.lit("").alias("value"), F.lit(0).alias("offset"))
                         ).write.mode("ignore").parquet(f"{self.path}/records/batch=-1")
        none.select(F.col("id").alias("number")).coalesce(1).write.mode("ignore").parquet(
            f"{self.path}/commits/batch=-1"
        )

    @staticmethod
    def _records_of(rows: DataFrame) -> DataFrame:
        return rows.select("key", "value", F.col("offset").cast("bigint").alias("offset"))

    def append(self, records: DataFrame, batch: int) -> None:
        """Add ``key, value, offset`` rows as one batch."""
        if not self.commits().filter(F.col("number") == batch).isEmpty():
            return
        self.write_records(records, batch)
        self.commit(batch)

    def write_records(self, records: DataFrame, batch: int) -> None:
        self._records_of(records).write.mode("overwrite").parquet(f"{self.path}/records/batch={batch}")

    def commit(self, batch: int) -> None:
        mark = self.spark.range(1).select(F.lit(batch).cast("bigint").alias("number"))
        mark.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}")

    def commits(self) -> DataFrame:
        return self.spark.read.schema("number bigint, batch bigint").parquet(f"{self.path}/commits")

    def position(self) -> int:
        """The latest committed batch, where a reader that starts at ``latest`` stands."""
        return self.commits().agg(F.coalesce(F.max("number"), F.lit(-1))).first()[0]

    def read(self, committed_only: bool = True, after: int | None = None) -> DataFrame:
        """Records, by default of complete batches only; ``after`` skips batches up to it."""
        rows = self.spark.read.schema(self.RECORDS).parquet(f"{self.path}/records")
        if after is not None:
            rows = rows.filter(F.col("batch") > after)
        return rows.join(self.commits(), "batch", "left_semi") if committed_only else rows

    def follow(
        self, handle: Callable[[DataFrame, int], None], label: str, checkpoint: str | None = None
    ) -> None:
        """Stream the committed batches one by one to ``handle(records, batch)``.

        The stream reads the commit marks; a mark names the folder of its records.
        """
        marks = (
            self.spark.readStream.schema("number bigint")
            .option("maxFilesPerTrigger", 1)
            .parquet(f"{self.path}/commits/*")
        )

        def take(rows: DataFrame, _: int) -> None:
            for mark in rows.collect():
                batch = mark["number"]
                session = rows.sparkSession
                part = session.read.parquet(f"{self.path}/records/batch={batch}")
                handle(part, batch)

        run_batches(marks, take, label, checkpoint)


def copy_log(source: FileLog, target: FileLog, label: str, checkpoint: str | None = None) -> None:
    """Copy a log exactly once: source position in the checkpoint, idempotent appends."""
    source.follow(target.append, label, checkpoint)
