"""Golden results on small inputs, worked out by hand."""

import contextlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions.aggregates import register_functions, top_values, weighted_avg
from millrace.functions.custom import Aggregator, aggregate_by
from millrace.functions.text import java_hash, java_split, java_string_hash
from millrace.operators import combine, eventtime, project, route, running, topn, windows
from millrace.plans import layout
from millrace.sources.records import parse_sensor, to_lines, try_parse_sensor

SENSOR = "seq bigint, id string, ts bigint, vc int"


def sensor(spark, *rows):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], SENSOR)


def timed(df):
    return df.withColumn("et", F.timestamp_seconds("ts"))


def rows(df, *columns, order=None):
    picked = df.select(*columns) if columns else df
    found = [tuple(r) for r in picked.collect()]
    return sorted(found, key=str) if order is None else found


FOUR = [("s1", 1, 1), ("s1", 11, 11), ("s2", 2, 2), ("s3", 3, 3)]


def test_word_counts(spark):
    lines = spark.createDataFrame(
        [(0, "hello world"), (1, "hello java"), (2, "hello river")], "line bigint, value string"
    )
    words = project.tokenize(lines)
    final = dict(rows(words.groupBy("word").count()))
    assert final == {"hello": 3, "world": 1, "java": 1, "river": 1}
    seen = running.running_occurrences(words, ["word"], ["line", "pos"]).orderBy("line", "pos")
    assert rows(seen, "word", "cnt", order=True) == [
        ("hello", 1), ("world", 1), ("hello", 2), ("java", 1), ("hello", 3), ("river", 1),
    ]


def test_tokens_follow_java_split(spark):
    df = spark.createDataFrame([("a  b ",), ("",), (" ",), (" a",), (None,)], "s string")
    assert [r[0] for r in df.select(java_split("s")).collect()] == [
        ["a", "", "b"], [""], [], ["", "a"], None,
    ]


def test_filter_and_conditional_expansion(spark):
    df = sensor(spark, *FOUR, (None, 5, 5))
    assert rows(project.keep_equal(df, "id", "s1"), "id", "ts", "vc") == [("s1", 1, 1), ("s1", 11, 11)]
    values = project.values_by_id(df, "s1", "s2").orderBy("seq", "pos")
    assert [r["value"] for r in values.collect()] == ["1", "11", "2", "2"]


def test_parse(spark):
    df = sensor(spark, *FOUR)
    again = parse_sensor(to_lines(df))
    assert rows(again) == sorted(FOUR, key=str)
    assert again.dtypes == [("id", "string"), ("ts", "bigint"), ("vc", "int")]
    odd = spark.createDataFrame([("s1,1,2",), ("s1,x,2",), ("s1",), ("",)], "value string")
    assert [r["ok"] for r in try_parse_sensor(odd).collect()] == [True, False, False, False]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        parse_sensor(odd.filter(F.col("value") == "s1,x,2")).collect()


def test_setup_runs_once_per_task(spark):
    @contextlib.contextmanager
    def resource():
        calls = {"n": 0}
        yield calls

    def add_one(calls, batch):
        calls["n"] += 1
        return batch.assign(value=batch["value"] + 1, call=calls["n"])

    df = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "value int").coalesce(1)
    done = project.with_setup(df, resource, add_one, "value int, call int")
    assert sorted(r["value"] for r in done.collect()) == [2, 3, 4, 5]


def test_running_extremes(spark):
    df = sensor(spark, *FOUR)
    biggest = running.running_extreme(df, ["id"], ["seq"], "vc").orderBy("seq")
    assert rows(biggest, "id", "ts", "vc", order=True) == [
        ("s1", 1, 1), ("s1", 1, 11), ("s2", 2, 2), ("s3", 3, 3),
    ]
    whole = running.running_row_of_extreme(df, ["id"], ["seq"], "vc").orderBy("seq")
    assert rows(whole, "id", "ts", "vc", order=True) == FOUR
    tie = sensor(spark, ("a", 1, 5), ("a", 2, 5), ("a", 3, 4))
    assert rows(running.final_row_of_extreme(tie, ["id"], ["seq"], "vc"), "ts") == [(1,)]
    least = running.running_row_of_extreme(tie, ["id"], ["seq"], "vc", largest=False).orderBy("seq")
    assert rows(least, "ts", "row_seq", order=True) == [(1, 0), (1, 0), (3, 2)]


@pytest.mark.parametrize("chunk_rows", [1, 4096])
def test_reduce(spark, chunk_rows):
    df = sensor(spark, ("s1", 1, 1), ("s1", 11, 11), ("s1", 21, 21), ("s2", 2, 2), ("s3", 3, 3))
    df = df.withColumn("first", F.col("id"))
    done = running.running_reduce(df, ["id"], ["seq"], ["first"], ["vc"], chunk_rows).orderBy("seq")
    assert rows(done, "first", "ts", "vc", order=True) == [
        ("s1", 1, 1), ("s1", 11, 12), ("s1", 21, 33), ("s2", 2, 2), ("s3", 3, 3),
    ]


STATE = [("s1", 1, 5), ("s1", 2, 16), ("s1", 3, 20), ("s1", 4, 9), ("s2", 5, 12), ("s2", 6, 1)]


@pytest.mark.parametrize("chunk_rows", [1, 2, 4096])
def test_keyed_state(spark, chunk_rows):
    df = sensor(spark, *STATE)
    jumps = running.jump_alerts(df, ["id"], ["seq"], "vc", 10, chunk_rows).orderBy("seq")
    assert rows(jumps, "id", "last", "vc", order=True) == [
        ("s1", 5, 16), ("s1", 20, 9), ("s2", 0, 12), ("s2", 12, 1),
    ]
    top = running.running_top(df, ["id"], ["seq"], "vc", 3, chunk_rows).orderBy("seq")
    assert [list(r["top"]) for r in top.collect()] == [
        [5], [16, 5], [20, 16, 5], [20, 16, 9], [12], [12, 1],
    ]
    sums = running.running_totals(df, ["id"], ["seq"], F.col("vc"), chunk_rows).orderBy("seq")
    assert [r["total"] for r in sums.collect()] == [5, 21, 41, 50, 12, 13]
    assert [r["mean"] for r in sums.collect()] == pytest.approx([5, 10.5, 41 / 3, 12.5, 12, 6.5])


@pytest.mark.parametrize("chunk_rows", [1, 4096])
def test_expiring_value(spark, chunk_rows):
    df = sensor(
        spark, ("a", 0, 20), ("a", 4, 5), ("a", 8, 3), ("a", 13, 30), ("a", 14, 1), ("b", 1, 11), ("b", 2, 0)
    )
    held = running.value_with_expiry(
        df, ["id"], ["seq"], F.when(F.col("vc") > 10, F.col("vc")), F.col("ts"), 5, chunk_rows
    ).orderBy("seq")
    # The read at 4 renews the entry of 0; the pause from 8 to 13 is as long as the ttl.
    assert [r["state"] for r in held.collect()] == [None, 20, 20, None, 30, None, 11]


@pytest.mark.parametrize("chunk_rows", [1, 4096])
def test_changelog(spark, chunk_rows):
    df = sensor(spark, ("s1", 1, 1), ("s1", 2, 2), ("s2", 2, 2), ("s3", 3, 3), ("s3", 4, 4))
    log = running.sum_changelog(df, ["id"], ["seq"], "vc", chunk_rows)
    found = [tuple(r) for r in log.select("seq", "op", "id", "total").collect()]
    assert sorted(found) == sorted([
        (0, "+I", "s1", 1), (1, "-U", "s1", 1), (1, "+U", "s1", 3), (2, "+I", "s2", 2),
        (3, "+I", "s3", 3), (4, "-U", "s3", 3), (4, "+U", "s3", 7),
    ])


def test_unions_and_parity(spark):
    one = spark.createDataFrame([(1,), (2,), (3,)], "value int")
    two = spark.createDataFrame([(11,), (22,), (33,)], "value int")
    three = spark.createDataFrame([("111",), ("222",), ("333",)], "value string")
    parsed = three.select(F.col("value").cast("int").alias("value"))
    assert sorted(r[0] for r in combine.union_all(one, two, parsed).collect()) == [
        1, 2, 3, 11, 22, 33, 111, 222, 333,
    ]
    mapped = combine.co_map(one, F.col("value").cast("string"), three, F.col("value"))
    assert mapped.count() == 6
    numbers = spark.createDataFrame([(v,) for v in (-3, -2, 0, 1, 2)], "v int")
    even, odd = route.outputs(route.split_parity(numbers, "v"), "even", "odd")
    assert sorted(r[0] for r in even.collect()) == [-2, 0, 2]
    assert [r[0] for r in odd.collect()] == [1]


def test_routes(spark):
    df = sensor(spark, *FOUR, (None, 1, 20))
    rules = {"one": F.col("id") == "s1", "two": F.col("id") == "s2"}
    tags = route.tag_first(df, rules, "rest").orderBy("seq")
    assert [r["tag"] for r in tags.collect()] == ["one", "one", "two", "rest", "rest"]
    alerts = route.with_alerts(df, F.col("vc") > 10, F.lit("high"), "main", "warn")
    assert alerts.filter("tag = 'main'").count() == 5
    assert rows(alerts.filter("tag = 'warn'"), "vc", "message") == [(11, "high"), (20, "high")]


def test_keyed_connect(spark):
    left = spark.createDataFrame([(1, "a1"), (1, "a2"), (2, "b"), (3, "c")], "lid int, l string")
    right = spark.createDataFrame(
        [(1, "aa1", 1), (1, "aa2", 2), (2, "bb", 1), (3, "cc", 1)], "rid int, r string, n int"
    )
    pairs = combine.keyed_connect(left, right, "lid", "rid")
    assert rows(pairs, "l", "r") == [
        ("a1", "aa1"), ("a1", "aa2"), ("a2", "aa1"), ("a2", "aa2"), ("b", "bb"), ("c", "cc"),
    ]


def test_joins_in_time(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "k string, lt bigint")
    right = spark.createDataFrame(
        [("a", 1), ("a", 11), ("b", 2), ("b", 12), ("c", 14), ("d", 15)], "k string, rt bigint"
    )
    a = left.withColumn("l", F.timestamp_seconds("lt"))
    b = right.withColumn("r", F.timestamp_seconds("rt"))
    expected = [("a", 1, 1), ("a", 2, 1), ("b", 3, 2)]
    assert rows(combine.window_join(a, b, "k", "l", "r", "5 seconds"), "k", "lt", "rt") == expected
    near = combine.interval_join(a, b, "k", "l", "r", -2_000_000, 2_000_000)
    assert rows(near, "k", "lt", "rt") == expected
    # Both bounds belong to the interval, wherever the bucket borders fall.
    edge = combine.interval_join(a, b, "k", "l", "r", -1_000_000, 10_000_000)
    want = [(x, p, q) for x, p in left.collect() for y, q in right.collect() if x == y and -1 <= q - p <= 10]
    assert rows(edge, "k", "lt", "rt") == sorted(want, key=str)


@pytest.mark.parametrize("chunk_rows", [1, 4096])
def test_latest_setting(spark, chunk_rows):
    data = spark.createDataFrame([(0, 1), (2, 5), (3, 11), (5, 15)], "seq bigint, vc int")
    settings = spark.createDataFrame([(1, 10), (4, 20)], "seq bigint, threshold int")
    current = combine.latest_setting(data, settings, "seq", "threshold", 0, chunk_rows)
    assert rows(current.filter("vc > threshold"), "vc", "threshold") == [(1, 0), (11, 10)]


def test_lateral(spark):
    df = spark.createDataFrame([("hello river",), ("hello java hi",), (" ",)], "s string")
    assert combine.lateral_tokens(df, java_split("s"), "w", "n").count() == 5
    outer = combine.lateral_tokens(df, java_split("s"), "w", "n", outer=True)
    assert (" ", None, None) in rows(outer)
    assert outer.count() == 6


def test_functions(spark):
    df = spark.createDataFrame([("s1",), ("s2",), ("s3",), ("",), ("a😀b",)], "s string")
    assert [r[0] for r in df.select(java_string_hash("s")).collect()] == [3614, 3615, 3616, 0, 57849694]
    longs = spark.createDataFrame([(-1, 7), (5_000_000_000, -7)], "n bigint, i int")
    assert rows(longs.select(java_hash("n", "bigint"), java_hash("i", "int"))) == [(0, 7), (705032705, -7)]
    register_functions(spark)
    df.createOrReplaceTempView("texts")
    assert [r[0] for r in spark.sql("SELECT java_hash_text(s) FROM texts").collect()] == [
        3614, 3615, 3616, 0, 57849694,
    ]
    called = df.limit(1).select(F.call_function("java_hash_text", F.col("s")))
    assert called.first()[0] == 3614
    lateral = spark.sql(
        "SELECT w, n FROM VALUES ('ab c'), (' ') AS t(s) LEFT JOIN LATERAL split_words(s) AS f(w, n) ON TRUE"
    )
    assert rows(lateral) == [("ab", 2), ("c", 1), (None, None)]


def test_weighted_average(spark):
    scores = spark.createDataFrame(
        [("zs", 98, 3), ("zs", 90, 3), ("zs", 85, 4), ("ls", 92, 3), ("ls", 87, 3), ("ls", 95, 4), ("no", 1, 0)],
        "name string, score int, weight int",
    )
    mean = scores.groupBy("name").agg(weighted_avg(F.col("score"), F.col("weight")).alias("m"))
    assert dict(rows(mean)) == {"zs": pytest.approx(90.4), "ls": pytest.approx(91.7), "no": None}


def test_top2(spark):
    def top(*values):
        df = spark.createDataFrame([(v,) for v in values], "v int")
        return sorted(((r["value"], r["rank"]) for r in top_values(df, "v").collect()), key=lambda x: x[1])

    assert top(3, 6, 12, 5, 8, 9, 4) == [(12, 1), (9, 2)]
    assert top(0, -5) == []
    assert top(7) == [(7, 1)]
    assert top(12, 12, 9) == [(12, 1), (12, 2)]


def test_custom_aggregate_equals_builtin(spark):
    spread = Aggregator(
        create=lambda: (None, None),
        add=lambda acc, rows: (
            min(x for x in (acc[0], int(rows["v"].min())) if x is not None),
            max(x for x in (acc[1], int(rows["v"].max())) if x is not None),
        ),
        merge=lambda a, b: (min(a[0], b[0]), max(a[1], b[1])),
        result=lambda acc: (acc[1] - acc[0], f"{acc[0]}..{acc[1]}"),
        accumulator="lo bigint, hi bigint",
        output="width bigint, label string",
    )
    df = spark.range(1000).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("k"), F.pmod(F.xxhash64("id"), F.lit(97)).alias("v")
    ).repartition(5)
    want = df.groupBy("k").agg((F.max("v") - F.min("v")).alias("width"))
    assert rows(aggregate_by(df, ["k"], spread), "k", "width") == rows(want)


def test_count_windows(spark):
    df = sensor(spark, *[("a", i, i) for i in range(1, 7)])
    for chunk_rows in (1, 4096):
        full = windows.count_windows(df, ["id"], ["seq"], 5, [F.sum("vc").alias("s")], chunk_rows)
        assert rows(full, "s") == [(15,)]
        for block in (1, 4096):
            sliding = windows.sliding_count_sums(df, ["id"], ["seq"], 5, 2, "vc", chunk_rows, block)
            assert sorted(rows(sliding, "firing", "n", "total")) == [(2, 2, 3), (4, 4, 10), (6, 5, 20)]


@pytest.mark.parametrize("chunk_rows", [1, 3, 4096])
def test_sliding_counts_across_blocks(spark, chunk_rows):
    df = sensor(spark, *[("a", i, i * i) for i in range(37)], *[("b", i, i) for i in range(4)])
    done = windows.sliding_count_sums(df, ["id"], ["seq"], 5, 2, "vc", chunk_rows, block_rows=6)
    want = []
    for key, values in (("a", [i * i for i in range(37)]), ("b", list(range(4)))):
        for end in range(2, len(values) + 1, 2):
            part = values[max(0, end - 5) : end]
            want.append((key, end, len(part), sum(part)))
    assert sorted(rows(done, "id", "firing", "n", "total")) == want


@pytest.mark.parametrize("chunk_rows", [1, 4096])
def test_sessions(spark, chunk_rows):
    df = spark.createDataFrame(
        [("a", 0.0, 0), ("a", 5.0, 1), ("a", 10.001, 2), ("b", 3.0, 3)], "id string, s double, seq bigint"
    ).withColumn("et", F.timestamp_micros((F.col("s") * 1e6).cast("bigint")))
    count = F.count(F.lit(1)).alias("n")
    done = windows.session_windows(df, ["id"], "et", ["seq"], 5_000_000, [count], chunk_rows)
    bounds = done.select(
        "id", F.unix_millis("session_start"), F.unix_millis("session_end"), "n"
    )
    assert rows(bounds) == [("a", 0, 10000, 2), ("a", 10001, 15001, 1), ("b", 3000, 8000, 1)]
    native = df.groupBy("id", F.session_window("et", "5 seconds").alias("w")).agg(count).select(
        "id", F.unix_millis("w.start"), F.unix_millis("w.end"), "n"
    )
    assert rows(native) == rows(bounds)


def test_time_windows(spark):
    df = timed(sensor(spark, ("s1", 0, 1), ("s1", 9, 2), ("s1", 10, 4), ("s2", 12, 8)))
    total = F.sum("vc").alias("total")
    tumbling = windows.time_windows(df, "et", "10 seconds", [total], keys=["id"])
    starts = tumbling.select("id", F.unix_seconds("window_start"), F.unix_seconds("window_end"), "total")
    assert rows(starts) == [("s1", 0, 10, 3), ("s1", 10, 20, 4), ("s2", 10, 20, 8)]
    sliding = windows.time_windows(df, "et", "10 seconds", [total], slide="5 seconds")
    assert sorted(rows(sliding.select(F.unix_seconds("window_start"), "total"))) == [
        (-5, 1), (0, 3), (5, 14), (10, 12),
    ]
    folded = windows.time_windows(
        df, "et", "10 seconds", windows.reduce_aggregates(["id"], ["ts"], ["vc"], "seq"), keys=[]
    )
    assert rows(folded, "id", "ts", "vc") == [("s1", 12, 12), ("s1", 9, 3)]
    for chunk_rows in (1, 4096):
        inside = windows.window_elements(df, "et", "10 seconds", ["id"], ["seq"], chunk_rows)
        assert sorted(rows(inside, "seq", "place", "n")) == [(0, 1, 2), (1, 2, 2), (2, 1, 1), (3, 1, 1)]


LATE = [(1, 1), (9, 2), (12, 3), (8, 4), (13, 5), (7, 6), (14, 8), (6, 7), (25, 9)]


@pytest.mark.parametrize("chunk_rows", [1, 2, 4096])
def test_lateness(spark, chunk_rows):
    df = sensor(spark, *[("s1", ts, vc) for ts, vc in LATE])
    ms = F.col("ts") * 1000

    def firings(lateness):
        rows_in = eventtime.classify_lateness(df, ms, ["seq"], 10_000, 3_000, lateness, chunk_rows)
        late = sorted(r["vc"] for r in rows_in.filter("status = 'late'").collect())
        fired = eventtime.window_firings(rows_in, ["id"], ["seq"], "vc", chunk_rows)
        return late, sorted(rows(fired, "start_ms", "firing", "total"))

    assert firings(0) == ([6, 7], [(0, 0, 7), (10000, 0, 16), (20000, 0, 9)])
    assert firings(2_000) == ([], [(0, 0, 7), (0, 1, 13), (0, 2, 20), (10000, 0, 16), (20000, 0, 9)])


def test_running_watermark(spark):
    df = sensor(spark, *[("s1", ts, vc) for ts, vc in LATE])
    seen = eventtime.running_watermark(df, F.col("ts") * 1000, ["seq"], 3_000, chunk_rows=2)
    got = rows(seen.orderBy("seq"), "watermark_ms", "visible_ms", order=True)
    marks = [m * 1000 - 3001 for m in (1, 9, 12, 12, 13, 13, 14, 14, 25)]
    assert got == list(zip(marks, [None, *marks[:-1]]))


def test_source_watermark_leaves_out_idle_sources(spark):
    df = spark.createDataFrame(
        [(0, "a", 0, 10), (1, "b", 1, 4), (2, "a", 2, 20), (3, "a", 9, 30), (4, "b", 10, 12)],
        "seq bigint, src string, now bigint, t bigint",
    )
    seen = eventtime.source_watermark(
        df, "src", ["a", "b", "never"], F.col("t"), F.col("now"), ["seq"], 0, 5, chunk_rows=1
    )
    # b is idle at 9, so a alone counts; when b comes back the watermark stands still.
    assert [r["watermark_ms"] for r in seen.orderBy("seq").collect()] == [9, 9, 9, 29, 29]


def test_interval_join_with_late(spark):
    left = timed(sensor(spark, ("a", 10, 0), ("a", 20, 0), ("a", 1, 0)))
    right = timed(sensor(spark, ("a", 11, 0), ("a", 21, 0), ("a", 2, 0)))
    left = left.withColumn("seq", F.col("seq") * 2)
    right = right.withColumn("seq", F.col("seq") * 2 + 1)
    done = eventtime.interval_join_with_late(
        left, right, "id", "seq", "et", ["seq"], -2_000_000, 2_000_000, 3_000, chunk_rows=2
    )
    assert rows(done, "tag", "left_id", "right_id") == [
        ("joined", 0, 1), ("joined", 2, 3), ("late_left", 4, None), ("late_right", None, 5),
    ]


def test_top_n(spark):
    df = timed(sensor(spark, *[("x", t, v) for t, v in [(1, 7), (2, 7), (3, 8), (4, 9), (6, 9), (7, 9)]]))
    best = topn.top_values_per_window(df, "et", "vc", "10 seconds", "5 seconds", 2)
    got = sorted(rows(best.select(F.unix_seconds("window_end"), "rank", "vc", "cnt")))
    assert got == [(5, 1, 7, 2), (5, 2, 8, 1), (10, 1, 9, 3), (10, 2, 7, 2), (15, 1, 9, 2)]


def test_layout(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") - 50).alias("k"))
    placed = layout.by_function(df, F.col("k"), 3).select("k", F.spark_partition_id().alias("p"))
    assert all(r["p"] == r["k"] % 3 for r in placed.collect())
    assert rows(layout.partition_sizes(layout.replicated(df, 2))) == [(0, 100), (1, 100)]
    assert layout.rescaled(df, 2).rdd.getNumPartitions() == 2
    twice = [
        layout.shuffled(df, "id", 4, seed=3).select("id", F.spark_partition_id()).collect() for _ in "ab"
    ]
    assert sorted(map(tuple, twice[0])) == sorted(map(tuple, twice[1]))
    ranges = spark.range(0, 100, 1, 2).select("id", F.spark_partition_id().alias("p"))
    assert {r["p"] for r in ranges.filter("id < 50").collect()} == {0}


def test_event_time_format(spark):
    df = spark.createDataFrame([(1_700_000_000,)], "ts bigint")
    shown = df.select(project.format_time(project.event_time("ts"))).first()[0]
    assert shown == pd.Timestamp(1_700_000_000, unit="s").strftime("%Y-%m-%d %H:%M:%S.000")
