"""Streams with carries against the batch operators: hot keys, nulls, repeated batches, bounded carries."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import eventtime
from millrace.plans.scan import first_value, last_value, running_count, running_max, running_min, running_sum
from millrace.session import scratch_dir
from millrace.streaming import batchwise, keyed
from millrace.streaming.run import Replay


def readings(spark, n=600, seed=1):
    """A third of the rows has one key; keys and values may be null."""
    rng = random.Random(seed)
    rows = [(i, rng.choice(["hot", "a", "b", None, f"k{i % 9}"]) if i % 3 else "hot", rng.choice([None, *range(9)])) for i in range(n)]
    return spark.createDataFrame(rows, "seq bigint, uid string, vc int"), rows


def again(checkpoint):
    """Forget that the newest batch was finished, as after a crash."""
    newest = max(int(os.path.basename(f)) for f in glob.glob(f"{checkpoint}/commits/[0-9]*"))
    for name in (f"{newest}", f".{newest}.crc"):
        os.remove(f"{checkpoint}/commits/{name}")


@pytest.mark.parametrize("chunk_rows", [20, 100_000])
def test_running_values_equal_the_loop(spark, chunk_rows):
    df, rows = readings(spark)
    source, checkpoint = Replay(df, "seq", 4), scratch_dir(spark, "running")
    vc = F.col("vc")
    folds = {
        "total": running_sum(vc.cast("bigint")),
        "n": running_count(),
        "low": running_min(vc),
        "high": running_max(vc),
        "first": first_value(vc),
        "last": last_value(vc, before=True),
    }
    for upto in (2, 2, 4):
        made = keyed.follow_running(source.stream(), ["uid"], ["seq"], folds, "running", checkpoint=checkpoint, replays=[source] if upto != 2 or source.next < 2 else [], upto=upto, chunk_rows=chunk_rows)
        again(checkpoint)
    state, want = {}, {}
    for seq, uid, value in rows:
        s = state.setdefault(uid, {"total": None, "n": 0, "low": None, "high": None, "first": value, "last": None})
        before = s["last"]
        s["n"] += 1
        if value is not None:
            s["total"] = value + (s["total"] or 0)
            s["low"] = value if s["low"] is None else min(s["low"], value)
            s["high"] = value if s["high"] is None else max(s["high"], value)
            s["last"] = value
        want[seq] = (s["total"], s["n"], s["low"], s["high"], s["first"], before)
    assert {r["seq"]: tuple(r[c] for c in folds) for r in made.collect()} == want
    # One row per key is carried, and only for the newest two batches.
    assert len(glob.glob(f"{checkpoint}/kept/state/batch=*")) == 2


@pytest.mark.parametrize("chunk_rows", [20, 100_000])
def test_top_changes_rebuild_the_lists(spark, chunk_rows):
    df, rows = readings(spark, seed=2)
    source = Replay(df, "seq", 3)
    made = keyed.follow_top(
        source.stream(), ["uid"], ["seq"], "vc", 2, "top", lambda r: keyed.top_changes(r, 2), replays=[source], chunk_rows=chunk_rows
    )
    changes = {}
    for r in made.collect():
        changes.setdefault(r["seq"], []).append(r)
    tops, n = {}, 0
    for seq, uid, value in rows:
        before = tops.setdefault(uid, [])
        after = sorted([*before, *([] if value is None else [value])], reverse=True)[:2]
        view = dict(enumerate(before, 1))
        for r in sorted(changes.get(seq, []), key=lambda r: r["op"], reverse=True):
            n += 1
            if r["op"] == "-D":
                assert view.pop(r["rank"]) == r["value"]
            else:
                assert r["rank"] not in view
                view[r["rank"]] = r["value"]
        assert [view[i] for i in sorted(view)] == after
        assert (seq in changes) == (before != after)
        tops[uid] = after
    assert n > 20


def arriving(spark, n=500, seed=3):
    rng = random.Random(seed)
    rows = [(i, i * 2, max(0, i * 2000 - rng.randrange(0, 90_000)), rng.choice(["hot", "hot", "b", None]), rng.choice([None, 1, 2, 3]), rng.choice("lr")) for i in range(n)]
    df = spark.createDataFrame(rows, "seq bigint, arrival bigint, ms bigint, uid string, vc int, side string")
    return df.withColumn("ts", F.timestamp_millis("ms")).withColumn("side", F.when(F.col("side") == "l", "left").otherwise("right"))


def bag(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_firings_equal_the_batch_operator(spark):
    df = arriving(spark)
    classed = eventtime.classify_lateness(df, F.col("ms"), ["arrival", "seq"], 60_000, 20_000, 15_000)
    fired = eventtime.window_firings(classed, ["uid"], ["arrival", "seq"], "vc").select(F.lit("fired").alias("tag"), "uid", "start_ms", "end_ms", "firing", "n", "total")
    late = classed.where("status = 'late'").select(F.lit("late"), "uid", "start_ms", "end_ms", F.lit(None).cast("bigint"), F.lit(None).cast("bigint"), F.col("vc").cast("bigint"))
    want = bag(fired.union(late))
    source, checkpoint = Replay(df.drop("side", "ts"), "arrival", 5), scratch_dir(spark, "firings")
    for upto in (3, 5):
        made = batchwise.follow_firings(
            source.stream(), ["uid"], F.col("ms"), ["arrival", "seq"], "vc", 60_000, 20_000, 15_000, "firings", checkpoint, [source], upto
        )
        again(checkpoint)
    assert bag(made) == want
    again_made = batchwise.follow_firings(
        source.stream(), ["uid"], F.col("ms"), ["arrival", "seq"], "vc", 60_000, 20_000, 15_000, "firings", checkpoint
    )
    assert bag(again_made) == want
    assert any("'late'" in row for row in want) and any(", 2, " in row for row in want)
    open_windows = spark.read.parquet(f"{checkpoint}/kept/windows").count()
    assert 0 < open_windows < 20


def test_late_pairs_equal_the_batch_operator(spark):
    df = arriving(spark, seed=4)
    sides = [df.where(F.col("side") == s).drop("side") for s in ("left", "right")]
    batch = eventtime.interval_join_with_late(*sides, "uid", "seq", "ts", ["arrival", "seq"], -5_000_000, 9_000_000, 10_000)
    source, checkpoint = Replay(df.select("side", "uid", "seq", "ts", "arrival"), "arrival", 5), scratch_dir(spark, "pairs")
    for upto in (2, 5):
        made = batchwise.follow_interval_join(
            source.stream(), "uid", "seq", "ts", ["arrival", "seq"], -5_000_000, 9_000_000, 10_000, "pairs", checkpoint, [source], upto
        )
        again(checkpoint)
    assert bag(made) == bag(batch)
    assert {r["tag"] for r in made.select("tag").distinct().collect()} == {"joined", "late_left", "late_right"}
    held = spark.read.parquet(f"{checkpoint}/kept/held").groupBy("batch").count().collect()
    assert all(r["count"] < 150 for r in held)


def test_idle_sources_equal_the_batch_operator(spark):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        # The second source falls silent in the middle, the third never speaks.
        name = "a" if 120 < i < 260 else rng.choice(["a", "b", "other"])
        rows.append((i, i, i * 1000 - rng.randrange(0, 20_000), name))
    df = spark.createDataFrame(rows, "seq bigint, arrival bigint, ms bigint, name string")
    args = ("name", ["a", "b", "c"], F.col("ms"), F.col("arrival") * 1000, ["arrival", "seq"], 3_000, 8_000)
    source, checkpoint = Replay(df, "arrival", 6), scratch_dir(spark, "idle")
    for upto in (2, 6):
        made = batchwise.follow_sources(source.stream(), *args, "idle", checkpoint, [source], upto)
        again(checkpoint)
    want = bag(eventtime.source_watermark(df, *args).select("seq", "watermark_ms"))
    assert bag(made.select("seq", "watermark_ms")) == want
