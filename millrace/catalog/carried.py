"""Streams with a carry of their own, and streams over a log with offsets. Each stops half way and resumes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import (
    DELAY_MS,
    GAP_US,
    HOUR_US,
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
)
from millrace.catalog.streams import STEPS, end_of_input, replay, small_steps
from millrace.catalog.windowed import ELEMENTS, FIRINGS, IDLE_MS, LATE, SOURCES, TOP, TUMBLE, count_and_sum, in_seconds, source_oracle
from millrace.functions.custom import Aggregator
from millrace.operators import topn, windows
from millrace.session import scratch_dir
from millrace.sinks.rolling import RollingFiles
from millrace.sources.offsets import FORMAT, Backlog, log_stream, log_table, register
from millrace.streaming import processors
from millrace.streaming.batchwise import follow_firings, follow_interval_join, follow_sources
from millrace.streaming.keyed import follow_top, top_changes
from millrace.streaming.run import Replay, run_to_sink, run_to_table
from millrace.streaming.spans import follow_aggregates, follow_elements

#: A run stops after half of the steps, and the next goes on from the checkpoint.
STOPS = (STEPS // 2, STEPS)


@query("q_idle_source_watermark_stream", source_oracle())
def idle_source_watermark_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = out_of_order(sensor(spark, sf_dir)).select("seq", "arrival", "id", "ts")
    source, checkpoint = replay(rows, order="arrival"), scratch_dir(spark, "idle")
    for upto in STOPS:
        seen = follow_sources(
            source.stream(), "id", SOURCES, F.unix_millis("ts"), F.col("arrival") * 1000, ["arrival", "seq"], DELAY_MS, IDLE_MS,
            "idle", checkpoint, [source], upto,
        )
    return seen.select("seq", "watermark_ms")


@query("q_interval_join_late_stream", REGISTRY["q_interval_join_late"].oracle)
def interval_join_late_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both inputs in one replay, so that they are cut at the same order values."""
    rows = out_of_order(sensor(spark, sf_dir)).where(F.col("id").isin("purchase", "view"))
    rows = rows.select("uid", "seq", "ts", "arrival", F.when(F.col("id") == "purchase", "left").otherwise("right").alias("side"))
    source, checkpoint = replay(rows, order="arrival"), scratch_dir(spark, "near-late")
    for upto in STOPS:
        made = follow_interval_join(
            source.stream(), "uid", "seq", "ts", ["arrival", "seq"], -2 * HOUR_US, 2 * HOUR_US, DELAY_MS,
            "near-late", checkpoint, [source], upto,
        )
    return made


@query(
    "q_allowed_lateness_stream",
    f"""WITH fired AS ({FIRINGS}), missed AS ({LATE})
    SELECT 'fired' AS tag, id, start_ms, end_ms, firing, n, total FROM fired
    UNION ALL SELECT 'late', id, start_ms, start_ms + {WINDOW_MS}, NULL, NULL, CAST(vc AS BIGINT) FROM missed WHERE status = 'late'""",
)
def allowed_lateness_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = out_of_order(sensor(spark, sf_dir)).select("id", "seq", "ts", "vc", "arrival")
    source, checkpoint = replay(rows, order="arrival"), scratch_dir(spark, "firings")
    for upto in STOPS:
        made = follow_firings(
            source.stream(), ["id"], F.unix_millis("ts"), ["arrival", "seq"], "vc", WINDOW_MS, DELAY_MS, LATENESS_MS,
            "firings", checkpoint, [source], upto,
        )
    return made


@query(
    "q_top2_changes_stream",
    f"""WITH {SENSOR}, t AS (
      SELECT uid, seq, list_reverse_sort(list(vc) FILTER (WHERE vc IS NOT NULL) OVER w)[1:2] AS now FROM sensor
      WINDOW w AS (PARTITION BY uid ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    b AS (SELECT uid, seq, now, lag(now) OVER (PARTITION BY uid ORDER BY seq) AS old FROM t),
    c AS (SELECT uid, seq, rank, old[rank] AS old, now[rank] AS now FROM b, (SELECT unnest([1, 2])::INT AS rank))
    SELECT uid, seq, '-D' AS op, rank, old AS value FROM c WHERE old IS DISTINCT FROM now AND old IS NOT NULL
    UNION ALL SELECT uid, seq, '+I', rank, now FROM c WHERE old IS DISTINCT FROM now AND now IS NOT NULL""",
)
def top2_changes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two largest values per key as a table of changes; only the ranks that change come out."""
    source, checkpoint = replay(sensor(spark, sf_dir).select("uid", "seq", "vc")), scratch_dir(spark, "top2")
    for upto in STOPS:
        made = follow_top(
            source.stream(), ["uid"], ["seq"], "vc", 2, "top2", lambda rows: top_changes(rows.drop("vc"), 2), checkpoint, [source], upto
        )
    return made


def log_of(spark: SparkSession, rows: DataFrame, stops: tuple[int, ...] = (STEPS,), end: DataFrame | None = None) -> str:
    """The readings as a log that a stream wrote, one transaction per step."""
    path, checkpoint = scratch_dir(spark, "offsets"), scratch_dir(spark, "offsets-ckpt")
    register(spark)
    source = Replay(rows, "seq", STEPS, end)
    records = source.stream().select(
        F.col("id").alias("key"), F.concat_ws(",", "id", epoch_s("ts"), "vc").alias("value"), F.col("ts").alias("created"), F.col("seq").alias("offset")
    )
    for upto in stops:
        run_to_sink(records, FORMAT, {"path": path, "writer": "readings"}, "offsets", checkpoint, replays=[source], upto=upto if upto < STEPS else None)
    return path


@query("q_log_transactions", REGISTRY["q_exactly_once_copy"].oracle)
def log_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading once in the log, though the writing stream was stopped half way."""
    path = log_of(spark, sensor(spark, sf_dir), STOPS)
    return log_table(spark, path).select("key", "value")


@query("q_log_stream_offsets", TUMBLE)
def log_stream_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log read from its beginning in micro-batches of so many offsets, the watermark set by the source; one stop between."""
    rows = sensor(spark, sf_dir)
    path = log_of(spark, rows, end=end_of_input(rows))
    limit, checkpoint, out = rows.count() // STEPS + 1, scratch_dir(spark, "read-log"), scratch_dir(spark, "read-log-out")
    records = log_stream(spark, path, "earliest", limit, "readings", delay="2 hours")
    fields = F.split("value", ",")
    readings = records.select(F.col("key").alias("id"), F.col("created").alias("ts"), F.try_element_at(fields, F.lit(3)).cast("int").alias("vc"))
    counts = windows.time_windows(readings, "ts", WINDOW, count_and_sum(), keys=["id"])
    run_to_table(counts, "read-log", out, checkpoint, replays=[Backlog(path, limit, "readings")], upto=STEPS // 2)
    return in_seconds(run_to_table(counts, "read-log", out, checkpoint, drain=True))


#: Longer than any reading is on its way, so that none is late.
LONGEST_US = 5 * HOUR_US
SUM_AS_TEXT = Aggregator(
    create=lambda: (0,),
    add=lambda acc, rows: (acc[0] + int(rows["vc"].sum()),),
    merge=lambda a, b: (a[0] + b[0],),
    result=lambda acc: str(acc[0]),
    accumulator="total bigint",
    output="result string",
)


def _spread() -> Aggregator:
    """Rows, and the largest value less the smallest; null without a value."""

    def least(a: int | None, b: int | None) -> int | None:
        return min((v for v in (a, b) if v is not None), default=None)

    def most(a: int | None, b: int | None) -> int | None:
        return max((v for v in (a, b) if v is not None), default=None)

    def add(acc: tuple, rows: object) -> tuple:
        known = rows["vc"].dropna()
        low, high = (int(known.min()), int(known.max())) if len(known) else (None, None)
        return (acc[0] + len(rows), least(acc[1], low), most(acc[2], high))

    return Aggregator(
        create=lambda: (0, None, None),
        add=add,
        merge=lambda a, b: (a[0] + b[0], least(a[1], b[1]), most(a[2], b[2])),
        result=lambda acc: (acc[0], None if acc[1] is None else acc[2] - acc[1]),
        accumulator="n bigint, low int, high int",
        output="n bigint, spread int",
    )


def unordered(spark: SparkSession, sf_dir: str) -> Replay:
    """The readings in the order they arrive, hours late."""
    return replay(out_of_order(sensor(spark, sf_dir)).select("id", "seq", "ts", "vc", "arrival"), order="arrival")


@query("q_window_agg_stream", REGISTRY["q_window_agg"].oracle)
def window_agg_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user-defined accumulator in the windows of a stream."""
    source, checkpoint = unordered(spark, sf_dir), scratch_dir(spark, "window-agg")
    for upto in STOPS:
        made = follow_aggregates(
            source.stream(), ["id"], "ts", SUM_AS_TEXT, LONGEST_US, "window-agg", WINDOW_MS * 1000, None, checkpoint, [source], upto
        )
    return in_seconds(made.drop("late"))


@query(
    "q_session_agg_stream",
    f"""WITH {SENSOR}, g AS (
      SELECT id, seq, vc, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER (PARTITION BY id ORDER BY ts, seq) AS before FROM sensor),
    c AS (
      SELECT *, sum(CASE WHEN before IS NULL OR us - before > {GAP_US} THEN 1 ELSE 0 END) OVER (
        PARTITION BY id ORDER BY us, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session FROM g)
    SELECT id, min(us) AS session_start, max(us) + {GAP_US} AS session_end, count(*) AS n, max(vc) - min(vc) AS spread, FALSE AS late
    FROM c GROUP BY id, session""",
)
def session_agg_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows out of order open, extend and join sessions; accumulators merge where sessions do."""
    source, checkpoint = unordered(spark, sf_dir), scratch_dir(spark, "session-agg")
    for upto in STOPS:
        made = follow_aggregates(
            source.stream(), ["id"], "ts", _spread(), LONGEST_US, "session-agg", None, GAP_US, checkpoint, [source], upto
        )
    bounds = [F.unix_micros(f"window_{b}").alias(f"session_{b}") for b in ("start", "end")]
    return made.select("id", *bounds, "n", "spread", "late")


@query("q_window_process_stream", ELEMENTS)
def window_process_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of a finished window with its place and the window's row count."""
    source, checkpoint = unordered(spark, sf_dir), scratch_dir(spark, "elements")
    for upto in STOPS:
        made = follow_elements(source.stream(), ["id"], "ts", WINDOW, ["seq"], LONGEST_US, "elements", checkpoint, [source], upto)
    return in_seconds(made).select("id", "window_start", "window_end", "seq", "vc", "place", "n")


@query("q_topn_timer_stream", f"{TOP} 2")
def topn_timer_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stateful operators in a row: counts per window, then the largest of them when a timer at the window's end fires."""
    rows = sensor(spark, sf_dir).select("ts", "seq", "vc")
    source = replay(rows, end_of_input(rows))
    counts = topn.closing_counts(source.stream().withWatermark("ts", "2 hours"), "ts", "vc", WINDOW, SLIDE)
    made = run_to_table(processors.apply(counts, "end_ms", processors.TopCounts(2), "EventTime"), "topn-timer", replays=[source])
    return made.select(F.floor(F.col("end_ms") / 1000).alias("window_end"), "vc", "cnt", "rank")


@query(
    "q_state_carried_stream",
    f"""WITH {SENSOR}, cut AS (SELECT (min(seq) + max(seq)) // 2 AS cut_seq FROM sensor), r AS (
      SELECT uid, seq, CAST(sum(vc) OVER w AS BIGINT) AS total, count(*) OVER w AS n, max(vc) OVER w - min(vc) OVER w AS spread
      FROM sensor WINDOW w AS (PARTITION BY uid ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT uid, seq, total, n, spread FROM r, cut WHERE seq > cut_seq""",
)
def state_carried_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query stops; its state, read as a table, is where a changed query with other output starts."""
    rows = sensor(spark, sf_dir).select("uid", "seq", "vc")
    span = rows.agg(F.min("seq"), F.max("seq")).first()
    cut = None if span[0] is None else (span[0] + span[1]) // 2
    first, second = small_steps(rows.where(F.col("seq") <= cut)), small_steps(rows.where(F.col("seq") > cut))
    checkpoint = scratch_dir(spark, "fold-before")
    run_to_table(processors.apply(first.stream(), "uid", processors.RunningFold()), "fold-before", checkpoint=checkpoint, replays=[first])
    kept = processors.state_of(spark, checkpoint, "uid", "fold")
    return run_to_table(processors.apply(second.stream(), "uid", processors.CarriedFold(), before=kept), "fold-after", replays=[second])


PART_BYTES = 16_384


@query(
    "q_sink_rolling",
    f"""WITH {SENSOR}, l AS (
      SELECT id AS bucket, seq, strlen(concat_ws(',', id, CAST(floor(epoch(ts)) AS BIGINT), vc)) + 1 AS size FROM sensor),
    p AS (
      SELECT bucket, size, (sum(size) OVER (PARTITION BY bucket ORDER BY seq) - size) // {PART_BYTES} AS part FROM l)
    SELECT bucket, CAST(part AS BIGINT) AS part, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes, CAST(1 AS BIGINT) AS files
    FROM p GROUP BY bucket, part""",
)
def sink_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a stream that roll by size, whatever its batches are."""
    rows = sensor(spark, sf_dir)
    lines = rows.select("id", "seq", "ts", F.concat_ws(",", "id", epoch_s("ts"), "vc").alias("line"))
    source, checkpoint = replay(lines), scratch_dir(spark, "rolling")
    sink = RollingFiles(spark, scratch_dir(spark, "rolled"), "id", "line", ["seq"], "ts", PART_BYTES)
    for upto in STOPS:
        sink.run(source.stream(), "rolling", checkpoint, [source], upto)
    sink.close()
    size = F.octet_length("value") + 1
    return sink.files().groupBy("bucket", "part").agg(
        F.count(F.lit(1)).alias("n"), F.sum(size).cast("bigint").alias("bytes"), F.count_distinct("file").alias("files")
    )
