"""Windows with accumulators, whole windows, rolling files, timers and carried state on streams, against plain loops."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.functions.custom import Aggregator
from millrace.session import scratch_dir
from millrace.sinks.rolling import RollingFiles
from millrace.streaming import keyed, processors, spans
from millrace.streaming.run import Replay, run_to_table
from test_carried import again

S = 1_000_000

#: Smallest value and count: merging is no sum.
LEAST = Aggregator(
    create=lambda: (0, None),
    add=lambda acc, rows: (acc[0] + len(rows), min([*rows["vc"].dropna().astype(int), *([acc[1]] if acc[1] is not None else [])], default=None)),
    merge=lambda a, b: (a[0] + b[0], min((v for v in (a[1], b[1]) if v is not None), default=None)),
    result=lambda acc: acc,
    accumulator="n bigint, low int",
    output="n bigint, low int",
)


def readings(spark, n=400, seed=3, jitter=25):
    """Rows some seconds out of order; a third has one key, keys, values and a few times are null."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        at = None if i % 97 == 5 else i * 4 + rng.randrange(jitter) + (300 if i > n // 2 else 0)
        rows.append((i, key, at, rng.choice([None, *range(50)])))
    schema = "seq bigint, k string, at bigint, vc int"
    return spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("at")).drop("at"), rows


def steps_of(rows, steps):
    """The batches a replay by seq makes, for tables of distinct consecutive numbers."""
    n = len(rows)
    cuts = [-(-n * i // steps) for i in range(steps + 1)]
    return [rows[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def least(values):
    return min((v for v in values if v is not None), default=None)


def tumbled(rows, steps, length, delay):
    """Batch by batch: windows the watermark has passed go, later rows make late ones."""
    live, gone, seen = defaultdict(list), Counter(), None
    for batch in steps_of(rows, steps):
        late = defaultdict(list)
        for _, k, at, vc in batch:
            if at is not None:
                start = at // length * length
                (late if seen is not None and start + length <= seen - delay else live)[k, start].append(vc)
        seen = max([r[2] for r in batch if r[2] is not None] + ([seen] if seen is not None else []))
        for (k, start), values in late.items():
            gone[k, start, start + length, True, len(values), least(values)] += 1
        for k, start in [w for w in live if w[1] + length <= seen - delay]:
            values = live.pop((k, start))
            gone[k, start, start + length, False, len(values), least(values)] += 1
    for (k, start), values in live.items():
        gone[k, start, start + length, False, len(values), least(values)] += 1
    return gone


def sessions(rows, steps, gap, delay):
    live, gone, seen = [], Counter(), None
    for batch in steps_of(rows, steps):
        spans_of = [*live, *[(k, at, at, [vc]) for _, k, at, vc in batch if at is not None]]
        live, merged = [], []
        for k in {s[0] for s in spans_of}:
            mine = sorted((s for s in spans_of if s[0] == k), key=lambda s: s[1:3])
            for _, start, last, values in mine:
                if merged and merged[-1][0] == k and start - merged[-1][2] <= gap:
                    merged[-1] = (k, merged[-1][1], max(last, merged[-1][2]), merged[-1][3] + values)
                else:
                    merged.append((k, start, last, values))
        before, seen = seen, max([r[2] for r in batch if r[2] is not None] + ([seen] if seen is not None else []))
        for k, start, last, values in merged:
            if last + gap > seen - delay:
                live.append((k, start, last, values))
                continue
            late = before is not None and last + gap <= before - delay
            gone[k, start, last + gap, late, len(values), least(values)] += 1
    for k, start, last, values in live:
        gone[k, start, last + gap, False, len(values), least(values)] += 1
    return gone


def run_twice(spark, follow, df, steps, label):
    """Stop half way, repeat the newest batch as after a crash, go on."""
    source, checkpoint = Replay(df, "seq", steps), scratch_dir(spark, label)
    made = follow(source.stream(), checkpoint, [source], steps // 2)
    again(checkpoint)
    made = follow(source.stream(), checkpoint, [], None)
    made = follow(source.stream(), checkpoint, [source], steps)
    again(checkpoint)
    return follow(source.stream(), checkpoint, [], None) if made is not None else None


def bag(made):
    seconds = [F.unix_seconds(c).alias(c) for c in ("window_start", "window_end")]
    return Counter(tuple(r) for r in made.select("k", *seconds, "late", "n", "low").collect())


@pytest.mark.parametrize("chunk_rows", [20, 100_000])
def test_accumulators_in_windows_equal_the_loop(spark, chunk_rows):
    df, rows = readings(spark)

    def follow(stream, checkpoint, replays, upto):
        return spans.follow_aggregates(
            stream, ["k"], "ts", LEAST, 10 * S, "agg", 60 * S, None, checkpoint, replays, upto, chunk_rows=chunk_rows
        )

    want = tumbled(rows, 4, 60, 10)
    assert bag(run_twice(spark, follow, df, 4, "agg")) == want
    assert any(w[0] is None for w in want)


@pytest.mark.parametrize("chunk_rows", [20, 100_000])
def test_accumulators_merge_with_their_sessions(spark, chunk_rows):
    df, rows = readings(spark, jitter=40)

    def follow(stream, checkpoint, replays, upto):
        return spans.follow_aggregates(
            stream, ["k"], "ts", LEAST, 5 * S, "sessions", None, 9 * S, checkpoint, replays, upto, chunk_rows=chunk_rows
        )

    want = sessions(rows, 4, 9, 5)
    assert bag(run_twice(spark, follow, df, 4, "sessions")) == want
    assert len(want) > 20


def test_a_row_joins_two_open_sessions_and_late_rows_stay_apart(spark):
    rows = [(0, "a", 100, 5), (1, "a", 120, 3), (2, "b", 118, 9), (3, "b", 130, 7), (4, "a", 110, 4), (5, "c", 300, 1), (6, "a", 105, 2), (7, "c", 301, 0)]
    df = spark.createDataFrame(rows, "seq bigint, k string, at bigint, vc int").withColumn("ts", F.timestamp_seconds("at")).drop("at")
    source = Replay(df, "seq", 4)
    made = spans.follow_aggregates(source.stream(), ["k"], "ts", LEAST, 25 * S, "bridge", None, 10 * S, None, [source])
    assert bag(made) == Counter(
        {
            ("a", 100, 130, False, 3, 3): 1,
            ("b", 118, 128, False, 1, 9): 1,
            ("b", 130, 140, False, 1, 7): 1,
            ("a", 105, 115, True, 1, 2): 1,
            ("c", 300, 311, False, 2, 0): 1,
        }
    )


def test_one_kind_of_window_must_be_named(spark):
    df, _ = readings(spark, 4)
    with pytest.raises(ValueError, match="either"):
        spans.follow_aggregates(df, ["k"], "ts", LEAST, 0, "none")


@pytest.mark.parametrize("chunk_rows", [20, 100_000])
def test_whole_windows_come_out_row_by_row(spark, chunk_rows):
    df, rows = readings(spark)

    def follow(stream, checkpoint, replays, upto):
        return spans.follow_elements(stream, ["k"], "ts", "60 seconds", ["seq"], 10 * S, "rows", checkpoint, replays, upto, chunk_rows=chunk_rows)

    made = run_twice(spark, follow, df, 4, "rows")
    live, want, seen = defaultdict(list), Counter(), None

    def close(window):
        for place, seq in enumerate(sorted(live[window]), 1):
            want[seq, window[1], False, place, len(live[window])] += 1
        del live[window]

    for batch in steps_of(rows, 4):
        for seq, k, at, _ in batch:
            if at is None:
                continue
            start = at // 60 * 60
            if seen is not None and start + 60 <= seen - 10:
                want[seq, start, True, None, None] += 1
            else:
                live[k, start].append(seq)
        seen = max([r[2] for r in batch if r[2] is not None] + ([seen] if seen is not None else []))
        for window in [w for w in live if w[1] + 60 <= seen - 10]:
            close(window)
    for window in list(live):
        close(window)
    got = made.select("seq", F.unix_seconds("window_start"), "late", "place", "n").collect()
    assert Counter(tuple(r) for r in got) == want


def rolled(rows, steps, limit, age):
    """Parts by hand: (bucket, part) -> lines in order."""
    parts, total, opened, newest = defaultdict(list), Counter(), {}, None
    for batch in steps_of(rows, steps):
        for _, bucket, at, line in batch:
            part = total[bucket] // limit
            parts[bucket, part].append(line or "")
            total[bucket] += len((line or "").encode()) + 1
            if at is not None:
                opened[bucket, part] = min(at, opened.get((bucket, part), at))
                newest = at if newest is None else max(newest, at)
        for bucket in total:
            part = total[bucket] // limit
            if age is not None and (bucket, part) in opened and newest - opened[bucket, part] >= age:
                total[bucket] = (part + 1) * limit
    return parts


@pytest.mark.parametrize(("age", "chunk_rows"), [(None, 20), (400, 20), (400, 100_000)])
def test_files_roll_by_size_and_age(spark, age, chunk_rows):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        bucket = "hot" if i % 3 == 0 else rng.choice(["a", "é", None])
        line = rng.choice([None, "", "x" * rng.randrange(40), f"ö{i}", "z" * 120 if i % 50 == 0 else "y"])
        rows.append((i, bucket, None if i % 83 == 7 else i * 3, line))
    df = spark.createDataFrame(rows, "seq bigint, b string, at bigint, line string").withColumn("ts", F.timestamp_seconds("at")).drop("at")
    source, checkpoint = Replay(df, "seq", 6), scratch_dir(spark, "roll")
    path = scratch_dir(spark, "rolled")
    for upto, replays in ((3, [source]), (None, []), (6, [source]), (None, [])):
        # A new object each time, as after a restart; the newest batch is repeated in between.
        sink = RollingFiles(spark, path, "b", "line", ["seq"], "ts", 100, None if age is None else age * S, chunk_rows)
        sink.run(source.stream(), "roll", checkpoint, replays, upto)
        if replays:
            again(checkpoint)
    sink.close()
    got = defaultdict(list)
    files = defaultdict(set)
    for r in sink.files().collect():
        got[r["bucket"], r["part"]].append(r["value"])
        files[r["bucket"], r["part"]].add(r["file"])
    want = rolled(rows, 6, 100, age)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert all(len(f) == 1 for f in files.values())


def test_top_counts_wait_for_their_timer_and_clear_their_state(spark):
    rows = [(i, 60 * (i // 40) + i % 40, [None, 1, 2, 2, 3, 3, 4][i % 7]) for i in range(160)] + [(160, 10_000, 9)]
    df = spark.createDataFrame(rows, "seq bigint, at bigint, vc int").withColumn("ts", F.timestamp_seconds("at")).drop("at")
    from millrace.operators.topn import closing_counts

    source, checkpoint = Replay(df, "seq", 5), scratch_dir(spark, "top")
    stream = closing_counts(source.stream().withWatermark("ts", "0 seconds"), "ts", "vc", "60 seconds", "60 seconds")
    for upto in (2, 5):
        made = run_to_table(processors.apply(stream, "end_ms", processors.TopCounts(3), "EventTime"), "top", f"{checkpoint}-out", checkpoint, replays=[source], upto=upto)
    want = set()
    for w in range(4):
        counts = Counter(vc for _, at, vc in rows[:160] if at // 60 == w)
        best = sorted(counts.items(), key=lambda c: (-c[1], c[0] is not None, c[0] or 0))[:3]
        want |= {((w + 1) * 60_000, vc, n, rank) for rank, (vc, n) in enumerate(best, 1)}
    got = [tuple(r) for r in made.select("end_ms", "vc", "cnt", "rank").collect()]
    assert set(got) == want and len(got) == len(want)
    left = spark.read.format("statestore").option("stateVarName", "timer").option("operatorId", 0).load(checkpoint)
    assert left.count() == 0


def test_a_changed_query_starts_from_the_state_of_the_one_before(spark):
    first = [(0, "a", None), (1, "a", 5), (2, "b", None), (3, None, 4)]
    second = [(4, "a", 2), (5, "b", 7), (6, "c", 1), (7, None, 9), (8, "b", None)]
    schema = "seq bigint, uid string, vc int"
    one, two = (Replay(spark.createDataFrame(r, schema), "seq", 2) for r in (first, second))
    checkpoint = scratch_dir(spark, "old")
    run_to_table(processors.apply(one.stream(), "uid", processors.RunningFold()), "old", checkpoint=checkpoint, replays=[one])
    kept = processors.state_of(spark, checkpoint, "uid", "fold")
    assert {r["uid"]: (r["total"], r["n"]) for r in kept.collect()} == {"a": (5, 2), "b": (None, 1), None: (4, 1)}
    made = run_to_table(processors.apply(two.stream(), "uid", processors.CarriedFold(), before=kept), "new", replays=[two])
    got = {r["seq"]: (r["total"], r["n"], r["spread"]) for r in made.collect()}
    assert got == {4: (7, 3, 3), 5: (7, 2, 0), 6: (1, 1, 0), 7: (13, 2, 5), 8: (7, 3, 0)}


@pytest.mark.parametrize(("chunk_rows", "block_rows"), [(20, 16), (100_000, 65_536)])
@pytest.mark.parametrize(("size", "slide"), [(5, 2), (5, 5), (1, 1), (3, 4)])
def test_count_windows_reach_over_batches(spark, chunk_rows, block_rows, size, slide):
    df, rows = readings(spark, 200, seed=4)
    source, checkpoint = Replay(df, "seq", 4), scratch_dir(spark, "counts")
    for upto, replays in ((2, [source]), (None, []), (4, [source]), (None, [])):
        made = keyed.follow_counts(
            source.stream(), ["k"], ["seq"], size, slide, "vc", "counts", checkpoint, replays, upto, chunk_rows, block_rows
        )
        if replays:
            again(checkpoint)
    past, want = defaultdict(list), Counter()
    for _, k, _, vc in rows:
        past[k].append(vc)
        if len(past[k]) % slide == 0:
            last = past[k][-size:]
            known = [v for v in last if v is not None]
            want[k, len(past[k]), len(last), sum(known) if known else None] += 1
    assert Counter(tuple(r) for r in made.select("k", "firing", "n", "total").collect()) == want


def test_timers_follow_one_another_and_leave_no_state(spark):
    times = {"a": [0, 3, 10, 11, 25, 40], "b": [2, 12, 13], None: [5]}
    rows = sorted((at, k) for k, ats in times.items() for at in ats if k) + [(5, None)]
    rows = [(i, k, at, 0) for i, (at, k) in enumerate(sorted(rows, key=lambda r: r[0]))] + [(99, "end", 500, 0)]
    df = spark.createDataFrame(rows, "seq bigint, uid string, at bigint, vc int").withColumn("ts", F.timestamp_seconds(F.col("at") + 1000)).drop("at")
    for steps in (1, 3):
        source, checkpoint = Replay(df, "seq", steps), scratch_dir(spark, "timers")
        stream = source.stream().withColumn("time_ms", F.unix_millis("ts")).withWatermark("ts", "0 seconds")
        made = run_to_table(processors.apply(stream, "uid", processors.RowTimers(10_000), "EventTime"), "timers", checkpoint=checkpoint, replays=[source])
        got = Counter((r["uid"], r["timer_ms"] // 1000 - 1000) for r in made.collect())
        assert got == Counter([("a", 10), ("a", 20), ("a", 35), ("a", 50), ("b", 12), ("b", 22), (None, 15)])
        left = processors.state_of(spark, checkpoint, "uid", "last")
        assert [r["uid"] for r in left.collect()] == ["end"]
