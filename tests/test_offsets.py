"""The log with offsets: ranges, limits, crashes of the writer and of the reader."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from millrace.session import scratch_dir
from millrace.sources import offsets
from millrace.streaming.run import Replay, run_to_sink, run_to_table


def records(rows):
    return rows.select(
        (F.col("id") % 7).cast("string").alias("key"),
        F.concat(F.lit("v"), "id").alias("value"),
        F.timestamp_seconds("id").alias("created"),
        F.col("id").alias("offset"),
    )


def filled(spark, n=100, steps=4):
    path, checkpoint = scratch_dir(spark, "log"), scratch_dir(spark, "log-ckpt")
    offsets.register(spark)
    source = Replay(spark.range(n), "id", steps)
    run_to_sink(records(source.stream()), offsets.FORMAT, {"path": path}, "fill", checkpoint, [source])
    return path


def values(df):
    return sorted(int(r["value"][1:]) for r in df.collect())


def test_transactions_give_gapless_offsets(spark):
    path = filled(spark)
    table = offsets.log_table(spark, path)
    assert values(table) == list(range(100))
    assert sorted(r["offset"] for r in table.collect()) == list(range(100))
    log = offsets.LogFolder(path)
    assert log.last()["number"] == 3 and log.last()["end"] == 100
    # Steps keep their order in the log, whatever the order within.
    for number in range(4):
        commit = log.commit(number)
        assert (commit["first"], commit["end"]) == (25 * number, 25 * number + 25)


def test_positions_and_ranges():
    import tempfile

    log = offsets.LogFolder(tempfile.mkdtemp())
    begin = {"offset": 0, "commit": 0}
    assert log.advance(begin, 5) == begin and log.last()["end"] == 0
    assert log.append("w", 0, [("a", 3), ("b", 4)]) and log.append("w", 1, []) and log.append("x", 0, [("c", 2)])
    assert not log.append("w", 1, [("d", 9)])
    assert log.last()["end"] == 9 and log.last()["writers"] == {"w": 1, "x": 0}
    at = log.advance(begin, 4)
    assert at == {"offset": 4, "commit": 0}
    assert list(log.ranges(begin, at)) == [("a", 0, 3, 0), ("b", 0, 1, 3)]
    end = log.advance(at, None)
    assert end == {"offset": 9, "commit": 3}
    assert list(log.ranges(at, end)) == [("b", 1, 4, 3), ("c", 0, 2, 7)]
    assert log.advance(end, 5) == end
    os.remove(f"{log.root}/latest.json")
    assert log.last()["number"] == 2


def test_limit_holds_over_a_restart(spark):
    path = filled(spark)
    checkpoint, out = scratch_dir(spark, "ckpt"), scratch_dir(spark, "out")
    stream = offsets.log_stream(spark, path, "earliest", 30, "g")
    sizes = []
    for upto in (1, 2, None):
        backlog = offsets.Backlog(path, 30, "g")
        made = run_to_table(stream, "limited", out, checkpoint, replays=[backlog], upto=upto and 1)
        sizes.append(made.count())
    assert sizes == [30, 60, 100]
    again = run_to_table(offsets.log_stream(spark, path, "earliest", 30, "h"), "drained", drain=True)
    assert values(again) == list(range(100))
    assert values(made) == list(range(100))


def test_latest_starts_at_the_end(spark):
    path, checkpoint, out = filled(spark, 20, 1), scratch_dir(spark, "ckpt"), scratch_dir(spark, "out")
    stream = offsets.log_stream(spark, path, "latest", 100, "late")
    assert run_to_table(stream, "late", out, checkpoint).count() == 0
    more = Replay(spark.range(20, 30), "id", 1)
    run_to_sink(records(more.stream()), offsets.FORMAT, {"path": path, "writer": "second"}, "more", scratch_dir(spark, "w2"), [more])
    assert values(run_to_table(stream, "late", out, checkpoint)) == list(range(20, 30))
    with pytest.raises(ValueError):
        offsets.OffsetReader({"path": path, "start": "middle"})


def test_a_failed_task_leaves_nothing_and_the_batch_comes_again(spark):
    path, checkpoint, marker = scratch_dir(spark, "log"), scratch_dir(spark, "ckpt"), scratch_dir(spark, "marker")
    os.makedirs(marker)
    offsets.register(spark)
    source = Replay(spark.range(60).repartition(3), "id", 2)

    @F.udf("bigint")
    def fails_once(value):
        if value == 45 and not os.path.exists(f"{marker}/failed"):
            open(f"{marker}/failed", "w").close()
            raise RuntimeError("task lost")
        return value

    rows = records(source.stream().repartition(3).select(fails_once("id").alias("id")))
    sink = {"path": path, "writer": "w"}
    with pytest.raises(Exception, match="task lost"):
        run_to_sink(rows, offsets.FORMAT, sink, "fails", checkpoint, [source])
    assert values(offsets.log_table(spark, path)) == list(range(30))
    run_to_sink(rows, offsets.FORMAT, sink, "fails", checkpoint)
    assert values(offsets.log_table(spark, path)) == list(range(60))
    named = {s[0] for n in range(2) for s in offsets.LogFolder(path).commit(n)["segments"]}
    assert {os.path.basename(f) for f in glob.glob(f"{path}/data/*")} == named


def test_a_repeated_batch_is_not_added(spark):
    """A crash after the log's commit and before Spark's: the batch comes again under its number."""
    path, checkpoint = scratch_dir(spark, "log"), scratch_dir(spark, "ckpt")
    offsets.register(spark)
    source = Replay(spark.range(40), "id", 2)
    sink = {"path": path, "writer": "w"}
    run_to_sink(records(source.stream()), offsets.FORMAT, sink, "again", checkpoint, [source])
    newest = max(int(os.path.basename(f)) for f in glob.glob(f"{checkpoint}/commits/[0-9]*"))
    for name in (f"{newest}", f".{newest}.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    run_to_sink(records(source.stream()), offsets.FORMAT, sink, "again", checkpoint)
    assert values(offsets.log_table(spark, path)) == list(range(40))
    assert json.load(open(f"{path}/latest.json"))["number"] == 1
    assert len(glob.glob(f"{path}/data/*.parquet")) == sum(len(offsets.LogFolder(path).commit(n)["segments"]) for n in range(2))


def test_a_range_skips_row_groups(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    log = offsets.LogFolder(str(tmp_path))
    os.makedirs(tmp_path / "data")
    table = pa.table({"key": ["k"] * 50, "value": [f"v{i}" for i in range(50)], "created": pa.array([0] * 50, pa.timestamp("us", "UTC"))})
    pq.write_table(table, tmp_path / "data" / "a", row_group_size=8)
    log.append("w", 0, [("a", 50)])
    (part,) = [offsets.Segment(*p) for p in log.ranges({"offset": 13, "commit": 0}, {"offset": 37, "commit": 0})]
    rows = [r for b in offsets.read_segment(str(tmp_path), part) for r in b.to_pylist()]
    assert [(r["offset"], r["value"]) for r in rows] == [(i, f"v{i}") for i in range(13, 37)]
