"""A keyed log addressed by offsets: a streaming source with read limits and a transactional sink.

``spark.readStream.format("keyed_log")`` reads records (key, value, created, offset) and ``writeStream`` appends them.
A log is a folder that all nodes reach: ``data/`` holds Parquet segments, and ``commits/N.json`` names the segments of
the N-th transaction with the offsets they cover. A segment that no commit names does not exist for a reader.

Source options: ``path``; ``start``, ``earliest`` or ``latest``, where a new query begins; ``limit``, the most offsets of
a micro-batch; ``group``, whose planned position is kept, so that the limit also holds after a restart. A group belongs to one
checkpoint, which alone says where the query goes on. Each task reads one range of one segment.

Sink options: ``path`` and ``writer``, the name under which transactions are counted. Tasks write segments and
send back their names; the driver commits them all with one new file, or removes them if a task failed. A commit carries the
last batch of every writer, so a batch that Spark repeats after a crash is recognised and its segments are dropped. One
query at a time writes to a log.

Null keys and values are records like others; ``created`` comes from the writer.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

FORMAT = "keyed_log"
RECORDS = "key string, value string, created timestamp, offset bigint"
ARROW = pa.schema([("key", pa.string()), ("value", pa.string()), ("created", pa.timestamp("us", "UTC")), ("offset", pa.int64())])
#: Rows of a segment; a task that has more writes several.
SEGMENT_ROWS = 1_000_000


class LogFolder:
    """The files of one log, through whatever file system its path names."""

    def __init__(self, path: str) -> None:
        self.files, self.root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)

    def _json(self, name: str) -> dict | None:
        try:
            with self.files.open_input_file(f"{self.root}/{name}") as source:
                return json.loads(source.read())
        except FileNotFoundError:
            return None

    def _put(self, name: str, content: dict) -> None:
        """Write beside the place and move there, so that a reader sees all of it or nothing."""
        folder = f"{self.root}/{name}".rsplit("/", 1)[0]
        self.files.create_dir(folder, recursive=True)
        hidden = f"{folder}/.{uuid.uuid4().hex}"
        with self.files.open_output_stream(hidden) as sink:
            sink.write(json.dumps(content).encode())
        self.files.move(hidden, f"{self.root}/{name}")

    def commit(self, number: int) -> dict | None:
        return self._json(f"commits/{number:020d}.json")

    def last(self) -> dict:
        """The newest commit. The hint may be old, never ahead; commits are numbered without gaps."""
        number = (self._json("latest.json") or {"number": 0})["number"]
        found = self.commit(number)
        while (after := self.commit(number + 1 if found else 0)) is not None and after != found:
            found, number = after, after["number"]
        return found or {"number": -1, "end": 0, "writers": {}, "segments": []}

    def append(self, writer: str, batch: int, segments: Sequence[tuple[str, int]]) -> bool:
        """Commit segments (name, rows) as one transaction; a batch of the writer that is in already is not added."""
        last = self.last()
        if last["writers"].get(writer, -1) >= batch:
            return False
        end, listed = last["end"], []
        for name, rows in segments:
            listed.append([name, end, end + rows])
            end += rows
        number = last["number"] + 1
        content = {"number": number, "first": last["end"], "end": end, "writers": last["writers"] | {writer: batch}, "segments": listed}
        self._put(f"commits/{number:020d}.json", content)
        self._put("latest.json", {"number": number})
        return True

    def remove(self, names: Sequence[str]) -> None:
        for name in names:
            self.files.delete_file(f"{self.root}/data/{name}")

    def planned(self, group: str) -> dict | None:
        return self._json(f"groups/{group}.json")

    def plan(self, group: str, position: dict) -> None:
        self._put(f"groups/{group}.json", position)

    def advance(self, position: dict, limit: int | None) -> dict:
        """The position at most ``limit`` offsets on. A position names an offset and the commit to look for it in."""
        number, offset = position["commit"], position["offset"]
        goal = None if limit is None else offset + limit
        while (found := self.commit(number)) is not None:
            if goal is not None and goal < found["end"]:
                return {"offset": goal, "commit": number}
            offset, number = found["end"], number + 1
        return {"offset": offset, "commit": number}

    def ranges(self, start: dict, end: dict) -> Iterator[tuple[str, int, int, int]]:
        """(segment, first row, end row, offset of the segment's first row) between two positions."""
        number = start["commit"]
        while number <= end["commit"] and (found := self.commit(number)) is not None:
            for name, low, high in found["segments"]:
                a, b = max(low, start["offset"]), min(high, end["offset"])
                if a < b:
                    yield name, a - low, b - low, low
            number += 1


class Segment(InputPartition):
    def __init__(self, name: str, first: int, end: int, base: int) -> None:
        self.name, self.first, self.end, self.base = name, first, end, base


def read_segment(path: str, part: Segment) -> Iterator[pa.RecordBatch]:
    """The rows of a range with their offsets; row groups outside it are not read."""
    log = LogFolder(path)
    with log.files.open_input_file(f"{log.root}/data/{part.name}") as source:
        file, at, wanted = pq.ParquetFile(source), 0, []
        skipped = None
        for i in range(file.num_row_groups):
            rows = file.metadata.row_group(i).num_rows
            if at < part.end and at + rows > part.first:
                wanted.append(i)
                skipped = at if skipped is None else skipped
            at += rows
        at = skipped or 0
        for batch in file.iter_batches(batch_size=10_000, row_groups=wanted, columns=ARROW.names[:3]):
            low, high = max(part.first - at, 0), min(part.end - at, batch.num_rows)
            if low < high:
                rows = batch.slice(low, high - low)
                offsets = pa.array(range(part.base + at + low, part.base + at + high), pa.int64())
                columns = [c.cast(f.type) for c, f in zip(rows.columns, ARROW, strict=False)]
                yield pa.RecordBatch.from_arrays([*columns, offsets], schema=ARROW)
            at += batch.num_rows


class OffsetReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.start, self.group = options["path"], options.get("start", "latest"), options.get("group", "default")
        if self.start not in ("earliest", "latest"):
            raise ValueError("start must be earliest or latest")
        self.limit = int(options["limit"]) if "limit" in options else None

    def _begin(self) -> dict:
        last = LogFolder(self.path).last()
        return {"offset": 0, "commit": 0} if self.start == "earliest" else {"offset": last["end"], "commit": last["number"] + 1}

    def initialOffset(self) -> dict:
        return self._begin()

    def latestOffset(self) -> dict:
        log = LogFolder(self.path)
        return log.advance(log.planned(self.group) or self._begin(), self.limit)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        log = LogFolder(self.path)
        # Spark has noted the batch by now; it is planned again after a crash.
        log.plan(self.group, end)
        return [Segment(*part) for part in log.ranges(start, end)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return read_segment(self.path, partition)


class TableReader(DataSourceReader):
    """All committed records."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]

    def partitions(self) -> Sequence[InputPartition]:
        log = LogFolder(self.path)
        begin = {"offset": 0, "commit": 0}
        return [Segment(*part) for part in log.ranges(begin, log.advance(begin, None))]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return read_segment(self.path, partition) if partition else iter(())


@dataclass
class Written(WriterCommitMessage):
    segments: list[tuple[str, int]]


class TransactionWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.writer = options["path"], options.get("writer", "writer")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        log, made, sink = LogFolder(self.path), [], None
        schema = pa.schema(list(ARROW)[:3])
        log.files.create_dir(f"{log.root}/data", recursive=True)
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if sink is None or made[-1][1] >= SEGMENT_ROWS:
                    if sink is not None:
                        sink.close()
                    made.append((f"{uuid.uuid4().hex}.parquet", 0))
                    sink = pq.ParquetWriter(f"{log.root}/data/{made[-1][0]}", schema, filesystem=log.files)
                table = pa.Table.from_batches([batch]).select(schema.names).cast(schema)
                sink.write_table(table)
                made[-1] = (made[-1][0], made[-1][1] + batch.num_rows)
        except BaseException:
            # No commit will name them.
            if sink is not None:
                sink.close()
            log.remove([name for name, _ in made])
            raise
        if sink is not None:
            sink.close()
        return Written(made)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        segments = [s for m in messages if m is not None for s in m.segments]
        log = LogFolder(self.path)
        if not log.append(self.writer, batchId, segments):
            log.remove([name for name, _ in segments])

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        LogFolder(self.path).remove([name for m in messages if m is not None for name, _ in m.segments])


class KeyedLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RECORDS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return TableReader(dict(self.options))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return OffsetReader(dict(self.options))

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> TransactionWriter:
        return TransactionWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(KeyedLog)


def log_stream(
    spark: SparkSession, path: str, start: str = "latest", limit: int | None = None, group: str = "default", delay: str | None = None
) -> DataFrame:
    """The records as a stream; with ``delay`` the source itself sets the watermark, that far behind ``created``."""
    register(spark)
    options = {"path": path, "start": start, "group": group} | ({"limit": str(limit)} if limit else {})
    rows = spark.readStream.format(FORMAT).options(**options).load()
    return rows.withWatermark("created", delay) if delay else rows


def log_table(spark: SparkSession, path: str) -> DataFrame:
    register(spark)
    return spark.read.format(FORMAT).option("path", path).load()


class Backlog:
    """What a group has not read yet, in the steps that ``limit`` allows; a run takes one step as one micro-batch.

    Spark gives a source of this kind one batch per run and then ends it, before it closes the windows that the batch's
    watermark reaches. Use ``run_to_table(..., drain=True)`` to read to the end in one run.
    """

    def __init__(self, path: str, limit: int, group: str = "default") -> None:
        self.log, self.group, self.limit = LogFolder(path), group, limit
        self.next = 0

    @property
    def steps(self) -> int:
        done = (self.log.planned(self.group) or {"offset": 0})["offset"]
        return self.next + -(-(self.log.last()["end"] - done) // self.limit)

    def publish(self) -> None:
        """The records are there; the source hands them out."""
        self.next += 1
