"""Processors on plain rows, the steps of their replays, and the connect of two streams, against plain loops."""

import random
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from millrace.catalog import streams
from millrace.session import scratch_dir
from millrace.streaming import processors
from millrace.streaming.batchwise import follow_connect
from millrace.streaming.run import Replay
from test_carried import again


class Handle:
    """Value state and timers of one key, as a processor sees them."""

    def __init__(self):
        self.values, self.set, self.deleted, self.watermark = {}, [], [], 0

    def getValueState(self, name, schema, ttlDurationMs=None):  # noqa: N802
        return Value(self.values, name)

    def registerTimer(self, at_ms):  # noqa: N802
        self.set.append(at_ms)

    def deleteTimer(self, at_ms):  # noqa: N802
        self.deleted.append(at_ms)

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.watermark


class Value:
    def __init__(self, values, name):
        self.values, self.name = values, name

    def get(self):
        return self.values.get(self.name)

    def exists(self):
        return self.name in self.values

    def update(self, value):
        self.values[self.name] = value

    def clear(self):
        self.values.pop(self.name, None)


def opened(processor):
    handle = Handle()
    processor.init(handle)
    return handle


def given(processor, *rows):
    """What a processor puts out for rows of a batch, without the key."""
    made = Row("seq", "uid", "time_ms", "vc")
    return [tuple(r)[1:] for r in processor.handleInputRows(("k",), (made(seq, "k", at, vc) for seq, at, vc in rows), None)]


@pytest.mark.parametrize(
    ("key", "steps"),
    [("seq % 100", 4), ("if(seq % 5 = 0, -1, seq % 100)", 8), ("if(seq < 100, -1, seq % 100)", 40), ("-1", 40)],
)
def test_steps_grow_with_the_rows_of_a_key_not_with_the_table(spark, monkeypatch, key, steps):
    """A step has ten rows of a key at most."""
    monkeypatch.setattr(streams, "BATCH_ROWS", 10)
    source = streams.small_steps(spark.range(400).withColumnRenamed("id", "seq").withColumn("uid", F.expr(key)))
    assert source.steps == steps


def test_one_call_takes_all_timers_that_the_watermark_has_passed():
    timers = processors.RowTimers(10)
    handle = opened(timers)
    assert given(timers, (3, 12, 0), (1, 0, 0), (2, 3, 0), (4, None, 0), (5, 40, 0)) == [] and handle.set == [10]
    assert given(timers, (6, 41, 0), (7, 50, 0)) == [] and handle.set == [10]
    handle.watermark = 30
    assert timers.on_timer(10, handle) == [[10, 22]] and handle.set == [10, 50]
    handle.watermark = 60
    assert timers.on_timer(50, handle) == [[50, 60]] and handle.set == [10, 50] and not handle.values


def test_folds_on_plain_rows():
    fold, carried = processors.RunningFold(), processors.CarriedFold()
    opened(fold)
    opened(carried)
    carried.handleInitialState(("k",), Row(uid="k", total=5, n=2, low=2, high=3), None)
    assert given(fold, (2, 0, 7), (1, 0, None)) == [(1, None, 1, None, None, None), (2, 7, 2, 3.5, 7, 7)]
    assert given(fold, (3, 0, -1)) == [(3, 6, 3, 2.0, -1, 7)]
    assert given(carried, (4, 0, None), (5, 0, 9)) == [(4, 5, 3, 1), (5, 14, 4, 7)]


def test_a_first_row_timer_on_plain_rows():
    timer = processors.FirstRowTimer(10, 50)
    handle = opened(timer)
    assert given(timer, (2, 1, 1), (1, 5, 99)) == [] and (handle.set, handle.deleted) == ([15], [])
    assert given(timer, (3, 7, None), (4, 8, 60)) == [] and (handle.set, handle.deleted) == ([15], [15])
    assert [tuple(r) for r in timer.handleExpiredTimer(("k",), handle, type("At", (), {"getExpiryTimeInMs": lambda self: 15})())] == [("k", 15)]


def test_an_expiring_value_on_plain_rows():
    value = processors.ExpiringValue(10, 1000)
    opened(value)
    assert given(value, (2, 0, 10), (1, 0, 11), (3, 0, None)) == [(1, None), (2, 11), (3, 11)]
    assert given(value, (5, 0, 3), (4, 0, 50)) == [(4, 11), (5, 50)]


def test_two_streams_connect_over_batches_and_resume(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, *range(12)]), rng.choice("lr")) for i in range(120)]
    df = spark.createDataFrame(rows, "seq bigint, k int, side string")
    source, checkpoint = Replay(df, "seq", 4), scratch_dir(spark, "connect")

    def one(side):
        return source.stream().where(F.col("side") == side).select(F.col("k").alias(f"{side}_k"), F.col("seq").alias(f"{side}_seq"))

    for upto, replays in ((2, [source]), (None, []), (4, [source]), (None, [])):
        made = follow_connect(one("l"), one("r"), "l_k", "r_k", "connect", checkpoint, replays, upto)
        if replays:
            again(checkpoint)
    want = Counter((k, i, k, j) for i, k, a in rows for j, other, b in rows if (a, b) == ("l", "r") and k is not None and k == other)
    assert Counter(tuple(r) for r in made.collect()) == want
