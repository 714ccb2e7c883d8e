"""Streams: state, timers, lateness, restart and repeated batches."""

import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from millrace.operators import combine, running, windows
from millrace.session import scratch_dir
from millrace.sinks.files import stream_bucketed, write_bucketed
from millrace.sinks.log import keyed_lines
from millrace.sinks.tables import create_sink_table, insert_select, jdbc_options
from millrace.sources.generator import bounded_random, generator_table, numbered, rate_stream
from millrace.sources.log import FileLog, copy_log, kafka_source_options
from millrace.sources.memory import from_elements
from millrace.streaming import processors
from millrace.streaming.batchwise import follow_lateness, follow_settings
from millrace.streaming.run import BatchTable, Replay, run_batches, run_to_table

SCHEMA = "seq bigint, uid string, ts bigint, vc int"


def rows_of(spark, *rows):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], SCHEMA)
    return df.withColumns({"et": F.timestamp_seconds("ts"), "time_ms": F.col("ts") * 1000})


def one_by_one(df):
    """A replay with one row per micro-batch."""
    return Replay(df, "seq", df.count())


def in_two(df):
    return Replay(df, "seq", 2)


def test_replay_steps_are_even_ordered_and_written_in_one_job(spark):
    """One far value, as in a skewed order column, does not fill a step."""
    df = rows_of(spark, *[("a", i, i) for i in range(200)]).withColumn(
        "seq", F.when(F.col("seq") == 199, F.lit(10**12)).otherwise(F.col("seq"))
    )
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    made = Replay(df.repartition(4), "seq", 5)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) - len(before) <= 8
    staged = spark.read.parquet(made.staged).groupBy("__step").agg(F.count("*").alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    rows = sorted(tuple(r) for r in staged.collect())
    assert [r[1] for r in rows] == [40] * 5
    assert all(a[3] < b[2] for a, b in zip(rows, rows[1:], strict=False))
    batches = BatchTable(spark)
    run_batches(made.stream(), batches.write, "even", replays=[made])
    sizes = batches.read(SCHEMA).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in sizes if r["count"]] == [40] * 5


STATE = [("s1", 1, 5), ("s1", 2, 16), ("s1", 3, 20), ("s1", 4, 9), ("s2", 5, 12), ("s2", 6, 1)]


def test_state_processors(spark):
    df = rows_of(spark, *STATE)

    def run(processor, label):
        source = in_two(df)
        made = run_to_table(processors.apply(source.stream(), "uid", processor), label, partitions=2, replays=[source])
        return [tuple(r) for r in made.drop("uid").orderBy(made.columns[1]).collect()]

    assert run(processors.JumpAlerts(10), "j") == [(1, 5, 16), (3, 20, 9), (4, 0, 12), (5, 12, 1)]
    assert [list(r[1]) for r in run(processors.TopValues(3), "t")] == [
        [5], [16, 5], [20, 16, 5], [20, 16, 9], [12], [12, 1],
    ]
    assert [r[1:4] for r in run(processors.RunningFold(), "f")] == [
        (5, 1, 5.0), (21, 2, 10.5), (41, 3, 41 / 3), (50, 4, 12.5), (12, 1, 12.0), (13, 2, 6.5),
    ]


def test_count_windows_on_a_stream(spark):
    df = rows_of(spark, *[("a", i, i) for i in range(1, 7)])

    def run(processor, label):
        source = in_two(df)
        made = run_to_table(processors.apply(source.stream(), "uid", processor), label, partitions=2, replays=[source])
        return sorted(tuple(r) for r in made.drop("uid").collect())

    assert run(processors.CountWindows(5, 2), "slide") == [(2, 2, 3), (4, 4, 10), (6, 5, 20)]
    assert run(processors.CountWindows(5), "tumble") == [(5, 5, 15)]


def test_null_values_and_keys_as_in_the_batch_operators(spark):
    rows = [("a", 1, None), ("a", 2, 7), (None, 3, 500), ("a", 4, None), (None, 5, None), ("a", 6, 200), ("b", 7, None)]
    df = rows_of(spark, *rows)

    def same(processor, label, batch, *columns):
        source = in_two(df)
        made = run_to_table(processors.apply(source.stream(), "uid", processor), label, partitions=2, replays=[source])
        got, want = (sorted(map(repr, d.select(*columns).collect())) for d in (made, batch))
        assert got == want

    totals = running.running_totals(df, ["uid"], ["seq"], F.col("vc"))
    same(processors.RunningFold(), "nf", totals, "uid", "seq", "total", "n", "mean")
    same(processors.JumpAlerts(10), "nj", running.jump_alerts(df, ["uid"], ["seq"], "vc", 10), "uid", "seq", "last", "vc")
    same(processors.ValueCounts(), "nv", running.running_occurrences(df, ["uid", "vc"], ["seq"]), "uid", "seq", "vc", "cnt")
    changes = running.sum_changelog(df, ["uid"], ["seq"], "vc")
    same(processors.SumChangelog(), "nc", changes, "uid", "seq", "op", "total")
    source = in_two(df)
    tops = run_to_table(processors.apply(source.stream(), "uid", processors.TopValues(2)), "nt", partitions=2, replays=[source])
    assert [r["top"] for r in tops.orderBy("seq").collect()] == [[], [7], [500], [7], [500], [200, 7], []]
    source = in_two(df)
    counted = run_to_table(processors.apply(source.stream(), "uid", processors.CountWindows(2)), "nw", partitions=2, replays=[source])
    assert sorted(map(tuple, counted.where("uid = 'a'").collect())) == [("a", 2, 2, 7), ("a", 4, 2, 200)]


def batch_by_batch(spark, df, processor, steps):
    """Run a processing-time processor over a replay, one run per step."""
    source = Replay(df, "seq", steps)
    applied = processors.apply(source.stream(), "uid", processor, "ProcessingTime")
    return run_to_table(applied, "clock", partitions=2, single_batch=True, replays=[source])


@pytest.mark.parametrize("ttl_ms, second", [(3_600_000, 50), (1, None)])
def test_value_expires_on_the_clock(spark, ttl_ms, second):
    df = rows_of(spark, ("a", 1, 50), ("a", 2, 1))
    held = batch_by_batch(spark, df, processors.ExpiringValue(10, ttl_ms), 2)
    assert [r["state"] for r in held.orderBy("seq").collect()] == [None, second]


def test_event_timer_fires_when_the_watermark_passes(spark):
    df = rows_of(spark, *[("s1", t, 1) for t in (1, 8, 9, 2, 20)])
    source = one_by_one(df)
    stream = source.stream().withWatermark("et", "3 seconds")
    timers = processors.apply(stream, "uid", processors.FirstRowTimer(4_000), "EventTime")
    assert [tuple(r) for r in run_to_table(timers, "timer", partitions=2, replays=[source]).collect()] == [("s1", 5000)]
    source = one_by_one(rows_of(spark, ("s1", 1, 1), ("s1", 2, 99), ("s1", 20, 1), ("s1", 30, 1)))
    cancelled = processors.apply(
        source.stream().withWatermark("et", "3 seconds"), "uid", processors.FirstRowTimer(4_000, 50), "EventTime"
    )
    assert run_to_table(cancelled, "cancelled", partitions=2, replays=[source]).count() == 0


def test_clock_timer(spark):
    df = rows_of(spark, ("a", 1, 1), ("b", 2, 1), ("c", 3, 1))
    fired = batch_by_batch(spark, df, processors.ClockTimer(1), 3)
    assert {r["uid"] for r in fired.collect()} == {"a", "b"}


LATE = [(1, 1), (9, 2), (12, 3), (8, 4), (13, 5), (7, 6), (14, 8), (6, 7), (25, 9)]


def test_built_in_windows_drop_late_rows(spark):
    source = one_by_one(rows_of(spark, *[("s1", t, v) for t, v in LATE]))
    made = windows.time_windows(
        source.stream().withWatermark("et", "3 seconds"), "et", "10 seconds", [F.sum("vc").alias("s")], keys=["uid"]
    )
    done = run_to_table(made, "late", partitions=2, replays=[source])
    got = [tuple(r) for r in done.select(F.unix_seconds("window_end"), "s").orderBy("s").collect()]
    # Each step ends with a batch that closes windows, so a row of the next step is late.
    assert got == [(10, 7), (20, 16)]


def test_lateness_windows_fire_again(spark):
    rows = [(1, 1), (9, 2), (14, 3), (15, 0), (7, 4), (8, 5), (30, 6), (31, 0), (6, 7)]
    source = one_by_one(rows_of(spark, *[("s1", t, v) for t, v in rows]))
    fired = processors.apply(
        source.stream().withWatermark("et", "10 seconds"),
        "uid",
        processors.LatenessWindows(10_000, 7_000),
        "EventTime",
    )
    done = run_to_table(fired, "again", partitions=2, replays=[source])
    got = sorted(tuple(r) for r in done.drop("uid").collect())
    assert [r for r in got if r[0] == 0] == [(0, 0, 2, 3), (0, 1, 3, 7), (0, 2, 4, 12)]
    assert [r for r in got if r[0] == 10_000] == [(10_000, 0, 2, 3)]


def test_late_rows_are_kept_exactly(spark):
    df = rows_of(spark, *[("s1", t, v) for t, v in LATE])
    for source, label in ((one_by_one(df), "single"), (in_two(df), "halves")):
        classed = follow_lateness(source.stream(), F.col("time_ms"), ["seq"], 10_000, 3_000, 0, label, replays=[source])
        late = classed.filter("status = 'late'").orderBy("vc")
        assert [r["vc"] for r in late.collect()] == [6, 7]


def test_settings_on_a_stream(spark):
    rows = [("data", 0, 1), ("set", 0, 10), ("data", 0, 5), ("data", 0, 11), ("set", 0, 20), ("data", 0, 15)]
    df = rows_of(spark, *rows)
    for source, label in ((one_by_one(df), "single"), (in_two(df), "halves")):
        current = follow_settings(source.stream(), F.col("uid") == "set", "seq", "vc", 0, label, replays=[source])
        alerts = current.filter("vc > threshold").orderBy("seq")
        assert [(r["vc"], r["threshold"]) for r in alerts.collect()] == [(1, 0), (11, 10)]


def words(stream):
    return stream.groupBy("uid").agg(F.count(F.lit(1)).alias("cnt"))


def test_restart_and_repeated_batch(spark):
    """The handler fails after writing; the repeated batch replaces what it wrote."""
    df = rows_of(spark, *[(f"w{i % 3}", i, 1) for i in range(12)])
    source = Replay(df, "seq", 4)
    checkpoint = scratch_dir(spark, "crash")
    counts = BatchTable(spark)
    failures = []

    def crash_once(batch, batch_id):
        counts.write(batch, batch_id)
        if batch_id == 2 and not failures:
            failures.append(batch_id)
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run_batches(words(source.stream()), crash_once, "c", checkpoint, "update", 2, [source])
    run_batches(words(source.stream()), crash_once, "c", checkpoint, "update", 2, [source])
    latest = counts.latest("uid string, cnt bigint", ["uid"])
    assert sorted(tuple(r) for r in latest.collect()) == [("w0", 4), ("w1", 4), ("w2", 4)]


def records(spark, low, high):
    return spark.range(low, high).select(
        F.lit("k").alias("key"), F.col("id").cast("string").alias("value"), F.col("id").alias("offset")
    )


def test_log_copy_survives_a_crash(spark):
    source, target = FileLog(spark), FileLog(spark)
    assert source.position() == -1
    source.append(records(spark, 0, 5), 0)
    source.append(records(spark, 5, 9), 1)
    source.append(records(spark, 5, 9), 1)
    source.write_records(records(spark, 9, 12), 2)
    assert source.position() == 1
    assert source.read().count() == 9
    assert source.read(committed_only=False).count() == 12
    assert source.read(after=0).count() == 4
    checkpoint = scratch_dir(spark, "copy")
    commit, lost = target.commit, []

    def fail_once(batch):
        if batch == 1 and not lost:
            lost.append(batch)
            raise RuntimeError("lost")
        commit(batch)

    target.commit = fail_once
    with pytest.raises(Exception, match="lost"):
        copy_log(source, target, "copying", checkpoint)
    assert target.read().count() == 5
    copy_log(source, target, "copying", checkpoint)
    assert sorted(int(r["value"]) for r in target.read().collect()) == list(range(9))


def test_sinks(spark):
    df = rows_of(spark, ("a", 0, 1), ("a", 3599, 2), ("b", 3600, 3))
    line = F.concat_ws(",", "uid", "ts", "vc")
    path = scratch_dir(spark, "files")
    write_bucketed(df, path, "et", line, files=2)
    back = spark.read.schema("value string, bucket string").text(path)
    assert sorted((r["bucket"], r["value"]) for r in back.collect()) == [
        ("1970-01-01 00", "a,0,1"), ("1970-01-01 00", "a,3599,2"), ("1970-01-01 01", "b,3600,3"),
    ]
    out, checkpoint = scratch_dir(spark, "files"), scratch_dir(spark, "ckpt")
    source = in_two(df)
    source.publish()
    source.publish()
    writer = stream_bucketed(source.stream(), out, checkpoint, "et", line)
    writer.trigger(availableNow=True).start().awaitTermination()
    again = spark.read.schema("value string, bucket string").text(out)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, back.collect()))
    keyed = keyed_lines(from_elements(spark, "s1,1,2", "", data_type="string"))
    assert sorted(map(tuple, keyed.collect())) == [("", ""), ("s1", "s1,1,2")]
    create_sink_table(spark, "sums", "uid STRING, s BIGINT", scratch_dir(spark, "table"))
    # A view of the table's name, as a user may have one, does not take the rows.
    spark.range(1).createOrReplaceTempView("sums")
    insert_select(spark, "sums", "SELECT uid, sum(vc) FROM {r} GROUP BY uid", r=df)
    spark.catalog.dropTempView("sums")
    assert sorted(map(tuple, spark.table("sums").collect())) == [("a", 3), ("b", 3)]
    spark.sql("DROP TABLE sums")


def test_connector_options():
    options = kafka_source_options("host:1", "topic", "earliest", committed_only=True)
    assert options["startingOffsets"] == "earliest"
    assert options["kafka.isolation.level"] == "read_committed"
    with pytest.raises(ValueError):
        kafka_source_options("host:1", "topic", "middle")
    assert jdbc_options("jdbc:x", "t")["batchsize"] == "100"


def test_generators(spark):
    made = numbered(spark, 100, "Number:", 2)
    assert made.filter("value = 'Number:99'").count() == 1
    table = generator_table(
        spark, "gen", 1000, {"id": ("random", 1, 10), "ts": ("sequence", 5, 104), "vc": ("random", 1, 3)}
    )
    span = table.agg(F.count("*"), F.min("ts"), F.max("ts"), F.min("id"), F.max("id"), F.max("vc")).first()
    assert tuple(span) == (100, 5, 104, 1, 10, 3)
    same = [[r[0] for r in table.orderBy("ts").select("id").collect()] for _ in "ab"]
    assert same[0] == same[1]
    assert made.select(bounded_random(F.col("index"), 4, 4)).distinct().count() == 1
    assert rate_stream(spark, 5, 2, "n").isStreaming


def test_lateness_resumes_and_repeats_a_batch(spark):
    df = rows_of(spark, *[("s1", t, v) for t, v in LATE])
    source, checkpoint = one_by_one(df), scratch_dir(spark, "resume")

    def follow(upto):
        return follow_lateness(
            source.stream(), F.col("time_ms"), ["seq"], 10_000, 3_000, 0, "resumed", checkpoint, [source], upto
        )

    assert follow(5).count() == 5
    classed = follow(9)
    assert [r["vc"] for r in classed.filter("status = 'late'").orderBy("vc").collect()] == [6, 7]
    assert classed.count() == 9


def test_window_join_on_streams_drops_its_state(spark):
    df = rows_of(spark, *[("a", 10 * i, i) for i in range(24)])
    left = Replay(df.select("seq", "uid", F.col("et").alias("lt")), "seq", 8)
    right = Replay(df.select(F.col("seq").alias("rs"), "uid", F.col("et").alias("rt")), "rs", 8)
    sides = [r.stream().withWatermark(t, "1 second") for r, t in ((left, "lt"), (right, "rt"))]
    seen = []
    joined = combine.window_join(*sides, "uid", "lt", "rt", "20 seconds").select("uid", "seq", "rs", "window_start")
    pairs = BatchTable(spark)

    def handle(batch, batch_id):
        pairs.write(batch, batch_id)

    checkpoint = scratch_dir(spark, "window-join")
    for upto in range(1, 9):
        writer = joined.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        left.publish()
        right.publish()
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        seen.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(seen) <= 12 and seen[-1] <= seen[1] + 2
    assert pairs.read("uid string, seq bigint, rs bigint, window_start timestamp").count() == 48


def test_settings_with_equal_order_come_after_the_data(spark):
    data = spark.createDataFrame([(1, 5), (2, 6)], "seq bigint, vc int")
    settings = spark.createDataFrame([(1, 9), (2, 3), (2, 4)], "seq bigint, threshold int")
    made = combine.latest_setting(data, settings, "seq", "threshold", 0)
    assert sorted(map(tuple, made.collect())) == [(1, 5, 0), (2, 6, 9)]


class Accessors(processors.KeyedProcessor):
    """Uses the list and map state calls that the shipped processors do without."""

    OUTPUT = "seq bigint, held array<int>, entries bigint, keys array<int>, left bigint"

    def open(self, handle):
        self.values = handle.getListState("values", "vc int")
        self.counts = handle.getMapState("counts", "vc int", "n bigint")

    def on_rows(self, rows, timers):
        for value in rows["vc"].tolist():
            if value < 0:
                self.values.clear()
                self.counts.clear()
            else:
                self.values.appendValue((value,))
                self.counts.updateValue((value,), (1,))
        keys = sorted(k[0] for k in self.counts.keys())
        entries = len(list(self.counts.iterator()))
        if keys:
            self.counts.removeKey((keys[0],))
        held = [v[0] for v in self.values.get()]
        return [[int(rows["seq"].iloc[-1])], [held], [entries], [keys], [len(list(self.counts.keys()))]]


def test_list_and_map_state_accessors(spark):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    source = in_two(rows_of(spark, ("a", 1, 5), ("a", 2, 3), ("a", 3, -1), ("a", 4, 8)))
    made = run_to_table(processors.apply(source.stream(), "uid", Accessors()), "calls", partitions=2, replays=[source])
    got = [tuple(r)[1:] for r in made.orderBy("seq").collect()]
    assert got == [(1, [5, 3], 2, [3, 5], 1), (3, [8], 1, [8], 0)]
