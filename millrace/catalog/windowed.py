"""Queries on windows, watermarks and top-N."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import (
    ARRIVING,
    DELAY_MS,
    GAP_US,
    HOUR_MS,
    HOUR_S,
    LATENESS_MS,
    SENSOR,
    SLIDE,
    WINDOW,
    WINDOW_MS,
    epoch_s,
    out_of_order,
    query,
    sensor,
)
from millrace.functions.custom import Aggregator, aggregate_by
from millrace.operators import eventtime, project, topn, windows

SIX = 6 * HOUR_S
THREE = 3 * HOUR_S

TUMBLED = f"""{SENSOR}, w AS (
      SELECT *, (CAST(floor(epoch(ts)) AS BIGINT) // {SIX}) * {SIX} AS window_start FROM sensor)"""


def count_and_sum() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.sum("vc").alias("sum_vc")]


def in_seconds(df: DataFrame, *bounds: str) -> DataFrame:
    return df.withColumns({c: epoch_s(c) for c in bounds or ("window_start", "window_end")})


TUMBLE = f"""WITH {TUMBLED} SELECT id, window_start, window_start + {SIX} AS window_end,
      count(*) AS n, CAST(sum(vc) AS BIGINT) AS sum_vc
    FROM w GROUP BY id, window_start"""


@query("q_tumble", TUMBLE)
def tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_seconds(
        windows.time_windows(sensor(spark, sf_dir), "ts", WINDOW, count_and_sum(), keys=["id"])
    )


@query(
    "q_slide",
    f"""WITH {SENSOR}, w AS (
      SELECT *, unnest([0, 1]) AS back,
        (CAST(floor(epoch(ts)) AS BIGINT) // {THREE}) * {THREE} AS s FROM sensor)
    SELECT id, s - back * {THREE} AS window_start, s - back * {THREE} + {SIX} AS window_end,
      count(*) AS n, CAST(sum(vc) AS BIGINT) AS sum_vc
    FROM w GROUP BY id, s - back * {THREE}""",
)
def slide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_seconds(
        windows.time_windows(
            sensor(spark, sf_dir), "ts", WINDOW, count_and_sum(), keys=["id"], slide=SLIDE
        )
    )


SESSIONS = f"""WITH {SENSOR}, g AS (
      SELECT id, seq, vc, epoch_us(ts) AS us,
        lag(epoch_us(ts)) OVER (PARTITION BY id ORDER BY ts, seq) AS before FROM sensor),
    c AS (
      SELECT *, sum(CASE WHEN before IS NULL OR us - before > {GAP_US} THEN 1 ELSE 0 END) OVER (
        PARTITION BY id ORDER BY us, seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session FROM g)
    SELECT id, min(us) AS session_start, max(us) + {GAP_US} AS session_end,
      count(*) AS n, CAST(sum(vc) AS BIGINT) AS sum_vc
    FROM c GROUP BY id, session"""


@query("q_session", SESSIONS)
def session(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = windows.session_windows(
        sensor(spark, sf_dir), ["id"], "ts", ["seq"], GAP_US, count_and_sum()
    )
    return made.withColumns(
        {c: F.unix_micros(c) for c in ("session_start", "session_end")}
    )


@query(
    "q_window_all",
    f"""WITH {TUMBLED} SELECT window_start, window_start + {SIX} AS window_end,
      count(*) AS n, CAST(sum(vc) AS BIGINT) AS sum_vc
    FROM w GROUP BY window_start""",
)
def window_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_seconds(windows.time_windows(sensor(spark, sf_dir), "ts", WINDOW, count_and_sum()))


@query(
    "q_tumble_parity",
    f"""WITH {TUMBLED} SELECT vc % 2 AS parity, window_start, window_start + {SIX} AS window_end,
      count(*) AS n, min(vc) AS low, max(vc) AS high
    FROM w GROUP BY vc % 2, window_start""",
)
def tumble_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = windows.time_windows(
        sensor(spark, sf_dir),
        "ts",
        WINDOW,
        [F.count(F.lit(1)).alias("n"), F.min("vc").alias("low"), F.max("vc").alias("high")],
        keys=[(F.col("vc") % 2).alias("parity")],
    )
    return in_seconds(made)


@query(
    "q_window_reduce",
    f"""WITH {TUMBLED} SELECT id, window_start, window_start + {SIX} AS window_end,
      arg_min(uid, seq) AS first_uid, CAST(floor(epoch(arg_max(ts, seq))) AS BIGINT) AS last_ts,
      CAST(sum(vc) AS BIGINT) AS vc
    FROM w GROUP BY id, window_start""",
)
def window_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensor(spark, sf_dir).withColumns({"first_uid": F.col("uid"), "last_ts": epoch_s("ts")})
    folds = windows.reduce_aggregates(["first_uid"], ["last_ts"], ["vc"], "seq")
    return in_seconds(windows.time_windows(rows, "ts", WINDOW, folds, keys=["id"]))


@query(
    "q_window_agg",
    f"""WITH {TUMBLED} SELECT id, window_start, window_start + {SIX} AS window_end,
      CAST(CAST(sum(vc) AS BIGINT) AS VARCHAR) AS result
    FROM w GROUP BY id, window_start""",
)
def window_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = F.sum("vc").cast("string").alias("result")
    return in_seconds(
        windows.time_windows(sensor(spark, sf_dir), "ts", WINDOW, [result], keys=["id"])
    )


ELEMENTS = f"""WITH {TUMBLED} SELECT id, window_start, window_start + {SIX} AS window_end, seq, vc,
      row_number() OVER (PARTITION BY id, window_start ORDER BY seq) AS place,
      count(*) OVER (PARTITION BY id, window_start) AS n
    FROM w"""


@query("q_window_process", ELEMENTS)
def window_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = windows.window_elements(sensor(spark, sf_dir), "ts", WINDOW, ["id"], ["seq"])
    return in_seconds(rows).select("id", "window_start", "window_end", "seq", "vc", "place", "n")


@query(
    "q_window_agg_process",
    f"""WITH {TUMBLED} SELECT id,
      strftime(make_timestamp(window_start * 1000000), '%Y-%m-%d %H:%M:%S.%g') AS window_start,
      strftime(make_timestamp((window_start + {SIX}) * 1000000), '%Y-%m-%d %H:%M:%S.%g') AS window_end,
      count(*) AS n, CAST(CAST(sum(vc) AS BIGINT) AS VARCHAR) AS result
    FROM w GROUP BY id, w.window_start""",
)
def window_agg_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = windows.time_windows(
        sensor(spark, sf_dir),
        "ts",
        WINDOW,
        [F.count(F.lit(1)).alias("n"), F.sum("vc").cast("string").alias("result")],
        keys=["id"],
    )
    bounds = {c: project.format_time(F.col(c)) for c in ("window_start", "window_end")}
    return made.withColumns(bounds)


@query(
    "q_count_tumble",
    f"""WITH {SENSOR}, r AS (
      SELECT *, row_number() OVER (PARTITION BY uid ORDER BY seq) AS rn FROM sensor)
    SELECT uid, (rn - 1) // 5 AS firing, count(*) AS n, CAST(sum(vc) AS BIGINT) AS sum_vc
    FROM r GROUP BY uid, (rn - 1) // 5 HAVING count(*) = 5""",
)
def count_tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensor(spark, sf_dir).select("uid", "seq", "vc")
    return windows.count_windows(rows, ["uid"], ["seq"], 5, [F.sum("vc").alias("sum_vc")])


COUNT_SLIDE = f"""WITH {SENSOR}, r AS (
      SELECT uid, row_number() OVER (PARTITION BY uid ORDER BY seq) AS firing,
        count(*) OVER w AS n, CAST(sum(vc) OVER w AS BIGINT) AS total
      FROM sensor
      WINDOW w AS (PARTITION BY uid ORDER BY seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
    SELECT uid, firing, n, total FROM r WHERE firing % 2 = 0"""


@query("q_count_slide", COUNT_SLIDE)
def count_slide(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensor(spark, sf_dir).select("uid", "seq", "vc")
    return windows.sliding_count_sums(rows, ["uid"], ["seq"], 5, 2, "vc")


TOP = f"""WITH {SENSOR}, w AS (
      SELECT vc, unnest([0, 1]) AS back,
        (CAST(floor(epoch(ts)) AS BIGINT) // {THREE}) * {THREE} AS s FROM sensor),
    c AS (SELECT s - back * {THREE} + {SIX} AS window_end, vc, count(*) AS cnt FROM w GROUP BY 1, 2),
    r AS (SELECT *, CAST(row_number() OVER (
        PARTITION BY window_end ORDER BY cnt DESC, vc) AS INT) AS rank FROM c)
    SELECT window_end, vc, cnt, rank FROM r WHERE rank <= """


@query("q_topn_window", f"{TOP} 2")
def topn_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_seconds(
        topn.top_values_per_window(sensor(spark, sf_dir), "ts", "vc", WINDOW, SLIDE, 2),
        "window_end",
    )


@query("q_topn_two_phase", f"{TOP} 3")
def topn_two_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = topn.windowed_counts(sensor(spark, sf_dir), "ts", "vc", WINDOW, SLIDE)
    return in_seconds(topn.rank_counts(counts, "vc", 3), "window_end")


SEEN = f"""{ARRIVING}, seen AS (
      SELECT *, max(ms) OVER (ORDER BY arrival, seq
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m,
        (ms // {WINDOW_MS}) * {WINDOW_MS} AS start_ms FROM arriving),
    classed AS (
      SELECT *, CASE WHEN m IS NULL OR m - {DELAY_MS} < start_ms + {WINDOW_MS} THEN 'on_time'
        WHEN m - {DELAY_MS} - {LATENESS_MS} < start_ms + {WINDOW_MS} THEN 'accepted'
        ELSE 'late' END AS status FROM seen)"""


def classified(spark: SparkSession, sf_dir: str, lateness_ms: int) -> DataFrame:
    return eventtime.classify_lateness(
        out_of_order(sensor(spark, sf_dir)),
        F.unix_millis("ts"),
        ["arrival", "seq"],
        WINDOW_MS,
        DELAY_MS,
        lateness_ms,
    )


@query(
    "q_watermark_bounded",
    f"""WITH {SEEN} SELECT id, start_ms, count(*) AS n, CAST(sum(vc) AS BIGINT) AS sum_vc
    FROM classed WHERE status = 'on_time' GROUP BY id, start_ms""",
)
def watermark_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_time = classified(spark, sf_dir, 0).filter(F.col("status") == "on_time")
    return on_time.groupBy("id", "start_ms").agg(*count_and_sum())


WATERMARKS = f"""WITH {ARRIVING} SELECT seq, arrival,
      max(ms) OVER (ORDER BY arrival, seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - {DELAY_MS} - 1 AS watermark_ms,
      max(ms) OVER (ORDER BY arrival, seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {DELAY_MS} - 1 AS visible_ms
    FROM arriving"""


@query("q_running_watermark", WATERMARKS)
def running_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = out_of_order(sensor(spark, sf_dir)).select("seq", "arrival", "ts")
    seen = eventtime.running_watermark(
        rows, F.unix_millis("ts"), ["arrival", "seq"], DELAY_MS
    )
    return seen.drop("ts")


LATE = f"WITH {SEEN} SELECT id, seq, vc, start_ms, status FROM classed WHERE status <> 'on_time'"


@query("q_late_side_output", LATE)
def late_side_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = classified(spark, sf_dir, LATENESS_MS).filter(F.col("status") != "on_time")
    return late.select("id", "seq", "vc", "start_ms", "status")


FIRINGS = f"""WITH {SEEN}, base AS (
      SELECT id, start_ms, count(*) AS n, CAST(sum(vc) AS BIGINT) AS total
      FROM classed WHERE status = 'on_time' GROUP BY id, start_ms),
    again AS (
      SELECT id, start_ms, row_number() OVER w AS k, CAST(sum(vc) OVER w AS BIGINT) AS more
      FROM classed WHERE status = 'accepted'
      WINDOW w AS (PARTITION BY id, start_ms ORDER BY arrival, seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT id, start_ms, start_ms + {WINDOW_MS} AS end_ms, CAST(0 AS BIGINT) AS firing, n, total
    FROM base
    UNION ALL
    SELECT a.id, a.start_ms, a.start_ms + {WINDOW_MS},
      a.k - CASE WHEN b.n IS NULL THEN 1 ELSE 0 END, a.k + coalesce(b.n, 0),
      a.more + coalesce(b.total, 0)
    FROM again a LEFT JOIN base b ON a.id = b.id AND a.start_ms = b.start_ms"""


@query("q_allowed_lateness", FIRINGS)
def allowed_lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classified(spark, sf_dir, LATENESS_MS)
    return eventtime.window_firings(rows, ["id"], ["arrival", "seq"], "vc")


SOURCES = ["click", "error", "purchase", "signup", "view"]
IDLE_MS = HOUR_MS // 4


def source_oracle() -> str:
    seen = ",\n".join(
        f"max(CASE WHEN id = '{s}' THEN ms END) OVER w AS t_{s},"
        f" max(CASE WHEN id = '{s}' THEN arrival END) OVER w AS at_{s}"
        for s in SOURCES
    )
    active = ", ".join(
        f"CASE WHEN (arrival - at_{s}) * 1000 <= {IDLE_MS} THEN t_{s} END" for s in SOURCES
    )
    return f"""WITH {ARRIVING}, seen AS (
      SELECT seq, arrival, {seen} FROM arriving
      WINDOW w AS (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT seq, max(least({active}) - {DELAY_MS} - 1) OVER (ORDER BY arrival, seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS watermark_ms
    FROM seen"""


@query("q_idle_source_watermark", source_oracle())
def idle_source_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = out_of_order(sensor(spark, sf_dir)).select("seq", "arrival", "id", "ts")
    seen = eventtime.source_watermark(
        rows,
        "id",
        SOURCES,
        F.unix_millis("ts"),
        F.col("arrival") * 1000,
        ["arrival", "seq"],
        DELAY_MS,
        IDLE_MS,
    )
    return seen.select("seq", "watermark_ms")


@query(
    "q_tumble_arrival",
    f"""WITH {ARRIVING} SELECT id, (arrival // {SIX}) * {SIX} AS window_start,
      (arrival // {SIX}) * {SIX} + {SIX} AS window_end,
      count(*) AS n, CAST(sum(vc) AS BIGINT) AS sum_vc
    FROM arriving GROUP BY id, arrival // {SIX}""",
)
def tumble_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows on the time rows reach us, the replayable form of processing time."""
    rows = out_of_order(sensor(spark, sf_dir)).withColumn("arrived", project.event_time("arrival"))
    return in_seconds(
        windows.time_windows(rows, "arrived", WINDOW, count_and_sum(), keys=["id"])
    )


@query(
    "q_slide_arrival",
    f"""WITH {ARRIVING}, w AS (
      SELECT *, unnest([0, 1, 2, 3, 4]) AS back, (arrival // {SIX // 5}) * {SIX // 5} AS s
      FROM arriving)
    SELECT id, s - back * {SIX // 5} AS window_start, s - back * {SIX // 5} + {SIX} AS window_end,
      count(*) AS n, CAST(sum(vc) AS BIGINT) AS sum_vc
    FROM w GROUP BY id, s - back * {SIX // 5}""",
)
def slide_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = out_of_order(sensor(spark, sf_dir)).withColumn("arrived", project.event_time("arrival"))
    return in_seconds(
        windows.time_windows(
            rows, "arrived", WINDOW, count_and_sum(), keys=["id"], slide=f"{SIX // 5} seconds"
        )
    )


@query(
    "q_aggregate_custom",
    f"""WITH {SENSOR} SELECT id, CAST(CAST(sum(vc) AS BIGINT) AS VARCHAR) AS result
    FROM sensor GROUP BY id""",
)
def aggregate_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user-defined accumulator: integers in, a running sum inside, text out."""
    summing = Aggregator(
        create=lambda: (0,),
        add=lambda acc, rows: (acc[0] + int(rows["vc"].sum()),),
        merge=lambda a, b: (a[0] + b[0],),
        result=lambda acc: str(acc[0]),
        accumulator="total bigint",
        output="result string",
    )
    return aggregate_by(sensor(spark, sf_dir).select("id", "vc"), ["id"], summing)


# The queries below cut small keys into chunks, as hot keys are cut at scale.
SMALL_CHUNK = 700


@query("q_session_in_chunks", SESSIONS)
def session_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = windows.session_windows(
        sensor(spark, sf_dir), ["id"], "ts", ["seq"], GAP_US, count_and_sum(), SMALL_CHUNK
    )
    return made.withColumns({c: F.unix_micros(c) for c in ("session_start", "session_end")})


@query("q_running_watermark_in_chunks", WATERMARKS)
def running_watermark_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = out_of_order(sensor(spark, sf_dir)).select("seq", "arrival", "ts")
    order = ["arrival", "seq"]
    seen = eventtime.running_watermark(rows, F.unix_millis("ts"), order, DELAY_MS, SMALL_CHUNK)
    return seen.drop("ts")


@query("q_allowed_lateness_in_chunks", FIRINGS)
def allowed_lateness_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["arrival", "seq"]
    rows = eventtime.classify_lateness(
        out_of_order(sensor(spark, sf_dir)),
        F.unix_millis("ts"),
        order,
        WINDOW_MS,
        DELAY_MS,
        LATENESS_MS,
        SMALL_CHUNK,
    )
    return eventtime.window_firings(rows, ["id"], order, "vc", chunk_rows=2)


@query("q_window_process_in_chunks", ELEMENTS)
def window_process_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = windows.window_elements(
        sensor(spark, sf_dir), "ts", WINDOW, ["id"], ["seq"], chunk_rows=15
    )
    return in_seconds(rows).select("id", "window_start", "window_end", "seq", "vc", "place", "n")
