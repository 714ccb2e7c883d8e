"""Text files that roll by size or age, on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.scan import CHUNK_ROWS, OrderedScan, running_sum
from millrace.session import remove_dir, scratch_dir
from millrace.streaming.batchwise import Carry
from millrace.streaming.run import BatchTable, Replay, ddl, run_batches


class RollingFiles:
    """One text file per bucket and part, written when the part is full or old.

    A part takes rows in order until it holds ``max_bytes`` (a line and its end each), so part numbers do not depend on how
    batches are cut. With ``max_age_us`` a part whose first row is that much older than the newest row of the stream is closed
    though not full. Rows of open parts are carried, so no file is written in pieces, and readers see a
    batch's files once they are committed. A repeated batch replaces its files. Rows must rise in ``order`` from batch to
    batch; ``clock`` is a timestamp column. A null line is an empty one, a null bucket a bucket of its own.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        bucket: str,
        value: str,
        order: Sequence[str],
        clock: str,
        max_bytes: int,
        max_age_us: int | None = None,
        chunk_rows: int = CHUNK_ROWS,
    ) -> None:
        self.spark, self.path, self.order = spark, path, list(order)
        self.bucket, self.value, self.clock = bucket, value, clock
        self.max_bytes, self.max_age_us, self.chunk_rows = max_bytes, max_age_us, chunk_rows

    def _needed(self, rows: DataFrame) -> DataFrame:
        line = F.coalesce(F.col(self.value), F.lit("")).alias("value")
        return rows.select(F.col(self.bucket).alias("bucket"), line, *self.order, F.unix_micros(self.clock).alias("at_us"))

    def _part(self, total: Column) -> Column:
        return F.floor((total - F.pmod(total, F.lit(self.max_bytes))) / self.max_bytes)

    def run(
        self, stream: DataFrame, label: str, checkpoint: str | None = None, replays: Sequence[Replay] = (), upto: int | None = None
    ) -> None:
        """Write the full and old parts of a stream over all available input; ``close`` writes the others."""
        none = self.spark.createDataFrame([], stream.schema)
        checkpoint = checkpoint or scratch_dir(self.spark, f"{label}-ckpt")
        held = self._needed(none).withColumn("part", F.lit(0).cast("bigint"))
        self.open = Carry(self.spark, held.schema, f"{checkpoint}/kept/open")
        kinds = dict(stream.dtypes)
        ordered = ", ".join(f"`{c}` {kinds[c]}" for c in self.order)
        self.totals = Carry(self.spark, f"bucket {kinds[self.bucket]}, {ordered}, total bigint, newest_us bigint", f"{checkpoint}/kept/totals")
        self.placed = BatchTable(self.spark, f"{checkpoint}/kept/placed")
        run_batches(stream, self._handle, label, checkpoint, replays=replays, upto=upto)

    def _handle(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        size = F.octet_length("value").cast("bigint") + 1
        fresh = self._needed(batch).withColumn("__bytes", size)
        past = self.totals.table(batch_id)
        # What a bucket holds so far stands before its new rows as one row of so many bytes.
        before = past.select("bucket", *self.order, F.col("total").alias("__bytes"), F.lit(True).alias("__held"))
        both = fresh.withColumn("__held", F.lit(False)).unionByName(before, allowMissingColumns=True)
        scan = OrderedScan(both, ["bucket"], self.order, self.chunk_rows).add(__before=running_sum(F.col("__bytes"), before=True))
        part = self._part(F.coalesce("__before", F.lit(0).cast("bigint")))
        rows = scan.result().where(~F.col("__held")).select("bucket", "value", *self.order, "at_us", part.alias("part"))
        self.placed.write(rows.unionByName(self.open.table(batch_id)), batch_id)
        placed = self.placed.read(ddl(self.open.schema)).where(F.col("batch") == batch_id).drop("batch")

        newest = max([t for t in (past.agg(F.max("newest_us")).first()[0], fresh.agg(F.max("at_us")).first()[0]) if t is not None], default=None)
        place = F.max(F.struct(*self.order)).alias("__at")
        totals = both.groupBy("bucket").agg(F.sum("__bytes").alias("total"), place)
        totals = totals.select("bucket", *[F.col("__at").getField(c).alias(c) for c in self.order], "total")
        last = self._part(F.col("total"))
        parts = placed.groupBy("bucket", "part").agg(F.min("at_us").alias("opened_us"))
        joined = totals.withColumn("__last", last).alias("t").join(
            parts.alias("p"), F.col("t.bucket").eqNullSafe(F.col("p.bucket")) & (F.col("t.__last") == F.col("p.part")), "left"
        )
        old = F.lit(False)
        if self.max_age_us is not None and newest is not None:
            old = F.coalesce(F.lit(newest) - F.col("opened_us") >= self.max_age_us, F.lit(False))
        # A part closed for its age ends where a full one would.
        total = F.when(old, (F.col("__last") + 1) * self.max_bytes).otherwise(F.col("total"))
        kept = joined.select("t.bucket", *[f"t.{c}" for c in self.order], total.alias("total"), F.lit(newest).cast("bigint").alias("newest_us"))
        self.totals.leave_table(kept, batch_id)
        left = self.totals.table(batch_id + 1)
        current = left.select(F.col("bucket").alias("__bucket"), self._part(F.col("total")).alias("__current"))
        split = placed.join(current, F.col("bucket").eqNullSafe(F.col("__bucket")))
        self._write(split.where(F.col("part") < F.col("__current")), f"batch={batch_id}")
        self.open.leave_table(split.where(F.col("part") == F.col("__current")).select(*placed.columns), batch_id)
        remove_dir(self.spark, f"{self.placed.path}/batch={batch_id - 1}")
        batch.unpersist()

    def _write(self, rows: DataFrame, folder: str) -> None:
        # A part is no larger than max_bytes and a line, so one task may write it.
        placed = rows.repartition("bucket", "part").sortWithinPartitions("bucket", "part", *self.order)
        placed.select("bucket", "part", "value").write.partitionBy("bucket", "part").mode("overwrite").text(f"{self.path}/{folder}")

    def close(self) -> None:
        """Write the open parts; for after the last run."""
        self._write(self.open.latest(), "batch=last")

    def files(self) -> DataFrame:
        """The lines written with ``bucket``, ``part`` and the file they are in."""
        schema = "value string, batch string, bucket string, part bigint"
        rows = self.spark.read.schema(schema).text(self.path)
        return rows.select("bucket", "part", "value", F.input_file_name().alias("file"))
