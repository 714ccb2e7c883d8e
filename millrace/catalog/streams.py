"""Queries that run as streams over a replay of the tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import (
    DELAY_MS,
    GAP_US,
    HOUR_MS,
    JUMP,
    LATENESS_MS,
    REGISTRY,
    SENSOR,
    SLIDE,
    WINDOW,
    WINDOW_MS,
    epoch_s,
    out_of_order,
    query,
    sensor,
    sensor_of,
    table,
)
from millrace.catalog.joins import INTERVAL_JOIN, THRESHOLD, TOKENS
from millrace.catalog.keyed import CHANGES, FLOOR, JUMPS, RUNNING_AVG, TOP3, VALUE_COUNTS, three_of
from millrace.catalog.windowed import COUNT_SLIDE, LATE, SESSIONS, TOP, TUMBLE, count_and_sum, in_seconds
from millrace.functions.text import java_split
from millrace.operators import running, topn, windows
from millrace.operators.combine import lateral_tokens, window_join
from millrace.operators.route import tag_first
from millrace.plans.scan import Running, first_value, last_value, running_count, running_max, running_sum
from millrace.session import scratch_dir
from millrace.sources.log import FileLog, copy_log
from millrace.sources.text import stream_lines
from millrace.streaming import processors
from millrace.streaming.batchwise import follow_connect, follow_lateness, follow_settings
from millrace.streaming.keyed import follow_counts, follow_running, follow_top
from millrace.streaming.run import BatchTable, Replay, run_batches, run_to_table, step_of

STEPS = 4
#: A step of a replay has no more rows of one key than this where those meet in one task.
BATCH_ROWS = 100_000
HOUR_BOUND = "INTERVAL 2 HOURS"
SPOKEN = f"SELECT unnest({TOKENS}) AS word FROM conversations"
SPOKEN_COUNTS = f"SELECT word, count(*) AS cnt FROM ({SPOKEN}) GROUP BY word"


def end_of_input(rows: DataFrame) -> DataFrame:
    """One row a day past the last. It lets the watermark pass every window of the others, but
    not its own, so it never comes out itself."""
    last = rows.agg(F.max("ts").alias("ts"), F.max("seq").alias("seq"))
    values = {"ts": F.col("ts") + F.expr("INTERVAL 24 HOURS"), "seq": F.col("seq") + 1}
    return last.select(
        *[values.get(c, F.lit(None)).cast(rows.schema[c].dataType).alias(c) for c in rows.columns]
    )


def replay(rows: DataFrame, end: DataFrame | None = None, order: str = "seq") -> Replay:
    return Replay(rows, order, STEPS, end)


def small_steps(rows: DataFrame, end: DataFrame | None = None, key: str = "uid") -> Replay:
    """For processors, which take a key's rows of a batch at once: the steps double until none has more than ``BATCH_ROWS`` rows of a key.

    Each step calls every key it has rows of, so steps that grow with the table would call keys with the table times its keys.
    """
    steps, most = STEPS, -(-rows.count() // BATCH_ROWS)
    while steps < most:
        sizes = rows.groupBy(key, step_of(rows, "seq", steps).alias("__step")).agg(F.count(F.lit(1)).alias("n"))
        if sizes.agg(F.max("n")).first()[0] <= BATCH_ROWS:
            break
        steps = min(2 * steps, most)
    return Replay(rows, "seq", steps, end)


def streamed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's files as a stream, for queries that no order of rows changes."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    # A pattern, as the stream source takes a plain path for a folder and the table may be one file.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def windowed(spark: SparkSession, sf_dir: str, label: str, **options: object) -> DataFrame:
    rows = sensor(spark, sf_dir)
    source = replay(rows, end_of_input(rows))
    made = windows.time_windows(source.stream().withWatermark("ts", "2 hours"), "ts", WINDOW, count_and_sum(), **options)
    return in_seconds(run_to_table(made, label, replays=[source]))


@query("q_tumble_stream", TUMBLE)
def tumble_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed(spark, sf_dir, "tumble", keys=["id"])


@query("q_slide_stream", REGISTRY["q_slide"].oracle)
def slide_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed(spark, sf_dir, "slide", keys=["id"], slide=SLIDE)


@query("q_window_all_stream", REGISTRY["q_window_all"].oracle)
def window_all_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed(spark, sf_dir, "window_all")


@query("q_session_stream", SESSIONS)
def session_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark's own session windows; a row exactly one gap after the last opens a new one."""
    rows = sensor(spark, sf_dir)
    source = replay(rows, end_of_input(rows))
    stream = source.stream().withWatermark("ts", "2 hours")
    made = stream.groupBy("id", F.session_window("ts", f"{GAP_US + 1} microseconds").alias("w")).agg(*count_and_sum())
    bounds = [F.unix_micros("w.start").alias("session_start"), (F.unix_micros("w.end") - 1).alias("session_end")]
    return run_to_table(made.select("id", *bounds, "n", "sum_vc"), "session", replays=[source])


def spoken_counts(stream: DataFrame) -> DataFrame:
    words = stream.select(F.explode(java_split("text")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def turns_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "text")


@query("q_wordcount_stream", SPOKEN_COUNTS)
def wordcount_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = BatchTable(spark, label="wordcount")
    stream = streamed(spark, sf_dir, "conversations").select("conv_id", "text")
    run_batches(spoken_counts(stream), counts.write, "wordcount", mode="update")
    return counts.latest("word string, cnt bigint", ["word"])


@query("q_restart_wordcount", SPOKEN_COUNTS)
def restart_wordcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream stops half way; a new run takes up its checkpoint and finishes."""
    source = Replay(turns_of(spark, sf_dir), "conv_id", STEPS)
    checkpoint = scratch_dir(spark, "restart-ckpt")
    counts = BatchTable(spark, label="restart")
    for upto in (STEPS // 2, STEPS):
        run_batches(
            spoken_counts(source.stream()), counts.write, "restart", checkpoint, "update", replays=[source], upto=upto
        )
    return counts.latest("word string, cnt bigint", ["word"])


@query("q_state_jump_alert_stream", JUMPS)
def state_jump_alert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.coalesce("last", F.lit(0))
    return running_values(
        spark, sf_dir, "jumps", {"last": last_value(F.col("vc"), before=True)},
        lambda rows: rows.withColumn("last", last).where(F.abs(F.col("vc") - last) > JUMP),
    )


@query("q_changelog_sum_stream", CHANGES)
def changelog_sum_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {"total": running_sum(F.col("vc").cast("bigint")), "n": running_count()}
    return running_values(spark, sf_dir, "changes", values, lambda rows: running.change_rows(rows, "vc", "total", "n"))


@query(
    "q_event_timer",
    f"""WITH {SENSOR} SELECT uid, epoch_us(arg_min(ts, seq)) // 1000 + {6 * HOUR_MS} AS timer_ms
    FROM sensor GROUP BY uid""",
)
def event_timer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensor(spark, sf_dir).select("uid", "seq", "ts", "vc")
    source = small_steps(rows, end_of_input(rows))
    stream = source.stream().withColumn("time_ms", F.unix_millis("ts")).withWatermark("ts", "2 hours")
    timers = processors.apply(stream, "uid", processors.FirstRowTimer(6 * HOUR_MS), "EventTime")
    return run_to_table(timers, "timers", replays=[source])


@query(
    "q_event_timers_repeated",
    f"""WITH RECURSIVE {SENSOR}, e AS (SELECT uid, max(epoch_us(ts) // 1000) OVER (
      PARTITION BY uid ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ms FROM sensor),
    t AS (
      SELECT uid, min(ms) + {6 * HOUR_MS} AS timer_ms FROM e GROUP BY uid
      UNION ALL
      SELECT t.uid, min(e.ms) + {6 * HOUR_MS} FROM t JOIN e ON e.uid = t.uid AND e.ms >= t.timer_ms GROUP BY t.uid)
    SELECT uid, timer_ms FROM t""",
)
def event_timers_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's next timer is set by the first reading at or past the last one; one that fires clears the state."""
    rows = sensor(spark, sf_dir).select("uid", "seq", "ts", "vc")
    source = small_steps(rows, end_of_input(rows))
    stream = source.stream().withColumn("time_ms", F.unix_millis("ts")).withWatermark("ts", "2 hours")
    timers = processors.apply(stream, "uid", processors.RowTimers(6 * HOUR_MS), "EventTime")
    return run_to_table(timers, "timers-repeated", replays=[source])


def count_windows(spark: SparkSession, sf_dir: str, size: int, slide: int) -> DataFrame:
    """Count windows of the readings by user, whatever share of them one user has."""
    source = replay(sensor(spark, sf_dir).select("uid", "seq", "vc"))
    return follow_counts(source.stream(), ["uid"], ["seq"], size, slide, "vc", "counted", replays=[source])


def running_values(
    spark: SparkSession,
    sf_dir: str,
    label: str,
    values: dict[str, Running],
    then: Callable[[DataFrame], DataFrame],
    columns: Sequence[str | Column] = ("uid", "seq", "vc"),
    keys: Sequence[str] = ("uid",),
) -> DataFrame:
    """Running values of the readings by user, whatever share of them one user has."""
    source = replay(sensor(spark, sf_dir).select(*columns))
    return follow_running(source.stream(), keys, ["seq"], values, label, then, replays=[source])


def log_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The readings as log records, the earlier and the later half."""
    records = sensor(spark, sf_dir).select(
        F.col("id").alias("key"),
        F.concat_ws(",", "id", epoch_s("ts"), "vc").alias("value"),
        F.col("seq").alias("offset"),
    )
    span = records.agg(F.min("offset"), F.max("offset")).first()
    cut = (span[0] + span[1]) // 2
    return records.filter(F.col("offset") <= cut), records.filter(F.col("offset") > cut)


@query(
    "q_exactly_once_copy",
    f"""WITH {SENSOR} SELECT id AS key,
      concat_ws(',', id, CAST(floor(epoch(ts)) AS BIGINT), vc) AS value
    FROM sensor""",
)
def exactly_once_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = log_batches(spark, sf_dir)
    source, target = FileLog(spark), FileLog(spark)
    source.append(first, 0)
    source.append(second, 1)
    copy_log(source, target, "copy")
    return target.read().select("key", "value")


@query(
    "q_src_text_stream",
    """SELECT value, count(*) AS n FROM (
      SELECT unnest(string_split(text, chr(10))) AS value FROM documents)
    GROUP BY value""",
)
def src_text_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "lines")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    lines = run_to_table(stream_lines(spark, path), "lines")
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q_src_log_committed",
    f"""WITH {SENSOR}, cut AS (SELECT (min(seq) + max(seq)) // 2 AS cut_seq FROM sensor)
    SELECT id AS key, concat_ws(',', id, CAST(floor(epoch(ts)) AS BIGINT), vc) AS value
    FROM sensor, cut WHERE seq <= cut_seq""",
)
def src_log_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch is written but never committed, as after a crash."""
    first, second = log_batches(spark, sf_dir)
    log = FileLog(spark)
    log.append(first, 0)
    log.write_records(second, 1)
    return log.read().select("key", "value")


@query("q_table_append_stream", f"WITH {SENSOR} SELECT id, seq, vc FROM sensor WHERE vc > 200")
def table_append_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream as a SQL view, and the query's rows as an append-only stream again."""
    stream = sensor_of(streamed(spark, sf_dir, "events"))
    return run_to_table(spark.sql("SELECT id, seq, vc FROM {s} WHERE vc > 200", s=stream), "appended")


@query(
    "q_connect_join_stream",
    """SELECT o_orderkey, o_totalprice, l_linenumber, l_partkey
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def connect_join_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = streamed(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    items = streamed(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return follow_connect(orders, items, "o_orderkey", "l_orderkey", "connect").drop("l_orderkey")


def two_sides(spark: SparkSession, sf_dir: str, other: str) -> tuple[Replay, DataFrame, DataFrame]:
    """Purchases and readings of another type as two streams of one replay, cut at the same order values.

    So no side runs ahead of the other, and a watermark of hours is enough for both.
    """
    source = replay(sensor(spark, sf_dir).where(F.col("id").isin("purchase", other)).select("uid", "id", "seq", "ts"))

    def side(kind: str, name: str) -> DataFrame:
        rows = source.stream().where(F.col("id") == kind)
        return rows.select("uid", F.col("seq").alias(f"{name}_seq"), F.col("ts").alias(f"{name}_ts")).withWatermark(f"{name}_ts", "2 hours")

    return source, side("purchase", "left"), side(other, "right")


@query("q_interval_join_stream", INTERVAL_JOIN)
def interval_join_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides carry a watermark, so the join's state is bounded by the interval."""
    source, left, right = two_sides(spark, sf_dir, "view")
    near = F.col("right_ts").between(
        F.col("left_ts") - F.expr(HOUR_BOUND), F.col("left_ts") + F.expr(HOUR_BOUND)
    )
    right = right.withColumnRenamed("uid", "right_uid")
    joined = left.join(right, (F.col("uid") == F.col("right_uid")) & near)
    return run_to_table(joined.select("uid", "left_seq", "right_seq"), "near", replays=[source])


@query("q_window_join_stream", REGISTRY["q_window_join"].oracle)
def window_join_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join key holds the window, so both sides' state goes once the watermark passes it."""
    source, left, right = two_sides(spark, sf_dir, "click")
    joined = window_join(left, right, "uid", "left_ts", "right_ts", WINDOW)
    made = run_to_table(joined.select("uid", "window_start", "left_seq", "right_seq"), "window_join", replays=[source])
    return in_seconds(made, "window_start")


@query("q_topn_stream", f"{TOP} 2")
def topn_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per value come out once a window closes; each batch ranks its closed windows."""
    rows = sensor(spark, sf_dir).select("ts", "seq", "vc")
    source = replay(rows, end_of_input(rows))
    stream = source.stream().withWatermark("ts", "2 hours")
    counts = topn.windowed_counts(stream, "ts", "vc", WINDOW, SLIDE)
    ranked = BatchTable(spark, label="topn")

    def rank(batch: DataFrame, batch_id: int) -> None:
        ranked.write(topn.rank_counts(batch, "vc", 2), batch_id)

    run_batches(counts, rank, "topn", replays=[source])
    made = ranked.read("window_end timestamp, vc int, cnt bigint, rank int").drop("batch")
    return in_seconds(made, "window_end")


@query("q_state_top3_stream", TOP3)
def state_top3_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = replay(sensor(spark, sf_dir).select("uid", "seq", "vc"))
    top = follow_top(source.stream(), ["uid"], ["seq"], "vc", 3, "top", replays=[source])
    return top.select("uid", "seq", *three_of("top"))


@query("q_state_value_counts_stream", VALUE_COUNTS)
def state_value_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entry of the map per user and value."""
    return running_values(spark, sf_dir, "counts", {"cnt": running_count()}, lambda rows: rows, keys=("uid", "vc"))


@query("q_state_running_avg_stream", RUNNING_AVG)
def state_running_avg_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {"total": running_sum(F.col("vc").cast("bigint")), "n": running_count()}
    mean = (F.col("total").cast("double") / F.col("n")).alias("mean")
    return running_values(spark, sf_dir, "folds", values, lambda rows: rows.select("uid", "seq", mean))


@query("q_count_slide_stream", COUNT_SLIDE)
def count_slide_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_windows(spark, sf_dir, 5, 2)


def follow_late(spark: SparkSession, sf_dir: str, stops: tuple[int, ...]) -> DataFrame:
    """Every reading with its status; the stream stops after so many steps and resumes."""
    rows = out_of_order(sensor(spark, sf_dir)).select("id", "seq", "ts", "vc", "arrival")
    source, checkpoint = replay(rows, order="arrival"), scratch_dir(spark, "lateness")
    for upto in stops:
        classed = follow_lateness(
            source.stream(), F.unix_millis("ts"), ["arrival", "seq"], WINDOW_MS, DELAY_MS, LATENESS_MS,
            "lateness", checkpoint, [source], upto,
        )
    late = classed.filter(F.col("status") != "on_time")
    return late.select("id", "seq", "vc", "start_ms", "status")


@query("q_late_side_output_stream", LATE)
def late_side_output_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return follow_late(spark, sf_dir, (STEPS,))


@query("q_restart_late_side_output", LATE)
def restart_late_side_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return follow_late(spark, sf_dir, (STEPS // 2, STEPS))


def follow_threshold(spark: SparkSession, sf_dir: str, stops: tuple[int, ...]) -> DataFrame:
    source, checkpoint = replay(sensor(spark, sf_dir).select("id", "uid", "seq", "vc")), scratch_dir(spark, "thresholds")
    for upto in stops:
        current = follow_settings(
            source.stream(), F.col("id") == "signup", "seq", "vc", 0, "thresholds", checkpoint, [source], upto
        )
    alerts = current.filter(F.col("vc") > F.col("threshold"))
    return alerts.select("seq", "uid", "vc", "threshold")


@query("q_broadcast_threshold_stream", THRESHOLD)
def broadcast_threshold_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return follow_threshold(spark, sf_dir, (STEPS,))


@query("q_restart_threshold", THRESHOLD)
def restart_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return follow_threshold(spark, sf_dir, (STEPS // 2, STEPS))


def folded(spark: SparkSession, sf_dir: str, values: dict[str, Running], then: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return running_values(spark, sf_dir, "folded", values, then, ("uid", "seq", "id", epoch_s("ts").alias("ts"), "vc"))


@query("q_running_max_stream", REGISTRY["q_running_max"].oracle)
def running_max_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = {f"first_{c}": first_value(F.col(c)) for c in ("id", "ts")}
    names = [F.col("first_id").alias("id"), F.col("first_ts").alias("ts"), F.col("best").alias("vc")]
    return folded(spark, sf_dir, first | {"best": running_max(F.col("vc"))}, lambda rows: rows.select("uid", "seq", *names))


@query("q_running_maxby_stream", REGISTRY["q_running_maxby"].oracle)
def running_maxby_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The earliest row of equal values is the greater struct.
    whole = F.struct(F.col("vc"), (-F.col("seq")).alias("less"), F.col("id"), F.col("ts"), F.col("seq").alias("row_seq"))
    best = {"best": running_max(F.when(F.col("vc").isNotNull(), whole))}
    return folded(spark, sf_dir, best, lambda rows: rows.select("uid", "seq", "best.id", "best.ts", "best.vc", "best.row_seq"))


@query("q_running_reduce_stream", REGISTRY["q_running_reduce"].oracle)
def running_reduce_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {"first_id": first_value(F.col("id")), "total": running_sum(F.col("vc").cast("bigint"))}
    names = [F.col("first_id").alias("id"), "ts", F.col("total").alias("vc")]
    return folded(spark, sf_dir, values, lambda rows: rows.select("uid", "seq", *names))


@query("q_state_running_sum_stream", REGISTRY["q_state_running_sum"].oracle)
def state_running_sum_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {"total": running_sum(F.col("vc").cast("bigint"))}
    return running_values(spark, sf_dir, "sums", values, lambda rows: rows.select("uid", "seq", "total"))


@query(
    "q_count_tumble_stream",
    f"""WITH {SENSOR}, r AS (
      SELECT uid, vc, row_number() OVER (PARTITION BY uid ORDER BY seq) AS n FROM sensor)
    SELECT uid, ((n - 1) // 5 + 1) * 5 AS firing, CAST(5 AS BIGINT) AS n, CAST(sum(vc) AS BIGINT) AS total
    FROM r GROUP BY uid, (n - 1) // 5 HAVING count(*) = 5""",
)
def count_tumble_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_windows(spark, sf_dir, 5, 5)


@query(
    "q_state_ttl_stream",
    f"""WITH {SENSOR} SELECT uid, seq, last_value(CASE WHEN vc > {FLOOR} THEN vc END IGNORE NULLS) OVER (
      PARTITION BY uid ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS state FROM sensor""",
)
def state_ttl_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lifetime of a year on the clock, far beyond the run: equal to the plain last value."""
    source = small_steps(sensor(spark, sf_dir).select("uid", "seq", "vc"))
    held = processors.apply(source.stream(), "uid", processors.ExpiringValue(FLOOR, 365 * 24 * HOUR_MS), "ProcessingTime")
    return run_to_table(held, "ttl", replays=[source], single_batch=True)


@query(
    "q_process_context_stream",
    f"""WITH {SENSOR}, half AS (SELECT (min(seq) + max(seq)) // 2 AS cut FROM sensor), step AS (
      SELECT uid, seq, epoch_us(ts) // 1000 AS time_ms, seq > cut AS later FROM sensor, half)
    SELECT uid, seq, time_ms, CASE WHEN later THEN (SELECT max(time_ms) FROM step WHERE NOT later) ELSE 0 END AS watermark_ms
    FROM step""",
)
def process_context_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, time and watermark of each row as its batch sees them: the largest time of the step before, 0 in the first."""
    rows = sensor(spark, sf_dir).select("uid", "seq", "ts")
    span = rows.agg(F.min("seq"), F.max("seq")).first()
    halves = rows.withColumn("half", (F.col("seq") > (span[0] + span[1]) // 2).cast("int") if span[0] is not None else F.lit(0))
    source = Replay(halves, "half", 2)
    stream = source.stream().withColumn("time_ms", F.unix_millis("ts")).withWatermark("ts", "0 seconds")
    made = run_to_table(processors.apply(stream, "uid", processors.RowContext(), "EventTime"), "context", replays=[source])
    return made.select("uid", "seq", "time_ms", "watermark_ms")


@query("q_side_output_route_stream", REGISTRY["q_side_output_route"].oracle)
def side_output_route_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch is tagged in one pass and written with a folder per output."""
    rules = {"first": F.col("id") == "click", "second": F.col("id") == "view"}
    tagged = tag_first(sensor_of(streamed(spark, sf_dir, "events")), rules, "main").select("seq", "vc", "tag")
    path = scratch_dir(spark, "routed")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.partitionBy("tag").mode("overwrite").parquet(f"{path}/batch={batch_id}")

    run_batches(tagged, handle, "routed")
    return spark.read.schema("seq bigint, vc int, batch bigint, tag string").parquet(path).drop("batch")


@query("q_tokens_stream", REGISTRY["q_lateral_udtf"].oracle)
def tokens_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = streamed(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    words = lateral_tokens(stream, java_split("text"), "word", "length")
    return run_to_table(words.select("conv_id", "turn", "word", "length"), "tokens")
