"""Queries on keyed aggregates and keyed state, in their per-row and final forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import JUMP, SENSOR, TTL_US, epoch_s, query, sensor, table
from millrace.catalog.joins import TOKENS
from millrace.operators import project, running

BY_UID = "(PARTITION BY uid ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
IN_SECONDS = f"{SENSOR}, r AS (SELECT id, uid, seq, CAST(floor(epoch(ts)) AS BIGINT) AS ts, vc FROM sensor)"


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor(spark, sf_dir).withColumn("ts", epoch_s("ts"))


WORDS = f"SELECT doc_id, unnest({TOKENS}) AS word FROM documents"


@query("q_wordcount_batch", f"SELECT word, count(*) AS cnt FROM ({WORDS}) GROUP BY word")
def wordcount_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = project.tokenize(table(spark, sf_dir, "documents").select("text"), "text")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


@query(
    "q_wordcount_running",
    f"""WITH t AS (SELECT conv_id, turn, {TOKENS} AS tokens FROM conversations),
    w AS (SELECT conv_id, turn, unnest(tokens) AS word,
      CAST(generate_subscripts(tokens, 1) - 1 AS INT) AS pos FROM t)
    SELECT conv_id, turn, pos, word,
      count(*) OVER (PARTITION BY word ORDER BY conv_id, turn, pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt
    FROM w""",
)
def wordcount_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    words = project.tokenize(turns, "text")
    return running.running_occurrences(words, ["word"], ["conv_id", "turn", "pos"])


def extreme_oracle(fold: str) -> str:
    return f"""WITH {IN_SECONDS} SELECT uid, seq, first_value(id) OVER w AS id,
      first_value(ts) OVER w AS ts, {fold}(vc) OVER w AS vc
    FROM r WINDOW w AS {BY_UID}"""


@query("q_running_max", extreme_oracle("max"))
def running_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.running_extreme(readings(spark, sf_dir), ["uid"], ["seq"], "vc")


@query("q_running_min", extreme_oracle("min"))
def running_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.running_extreme(readings(spark, sf_dir), ["uid"], ["seq"], "vc", largest=False)


def whole_row_oracle(fold: str, sign: str) -> str:
    best = f"{fold}({{'f': vc, 's': {sign}seq, 'id': id, 'ts': ts}}) OVER w"
    return f"""WITH {IN_SECONDS}, b AS (
      SELECT uid, seq, {best} AS best FROM r WINDOW w AS {BY_UID})
    SELECT uid, seq, best.id AS id, best.ts AS ts, best.f AS vc, {sign}best.s AS row_seq FROM b"""


@query("q_running_maxby", whole_row_oracle("max", "-"))
def running_maxby(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.running_row_of_extreme(readings(spark, sf_dir), ["uid"], ["seq"], "vc")


@query("q_running_minby", whole_row_oracle("min", ""))
def running_minby(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.running_row_of_extreme(
        readings(spark, sf_dir), ["uid"], ["seq"], "vc", largest=False
    )


@query(
    "q_maxby_final",
    f"""WITH {IN_SECONDS}, n AS (
      SELECT *, row_number() OVER (PARTITION BY uid ORDER BY vc DESC, seq) AS place FROM r)
    SELECT uid, id, seq, ts, vc FROM n WHERE place = 1""",
)
def maxby_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.final_row_of_extreme(readings(spark, sf_dir), ["uid"], ["seq"], "vc")


@query(
    "q_minby_final",
    f"""WITH {IN_SECONDS}, n AS (
      SELECT *, row_number() OVER (PARTITION BY uid ORDER BY vc, seq) AS place FROM r)
    SELECT uid, id, seq, ts, vc FROM n WHERE place = 1""",
)
def minby_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.final_row_of_extreme(
        readings(spark, sf_dir), ["uid"], ["seq"], "vc", largest=False
    )


@query(
    "q_running_reduce",
    f"""WITH {IN_SECONDS} SELECT uid, seq, first_value(id) OVER w AS id, ts,
      CAST(sum(vc) OVER w AS BIGINT) AS vc
    FROM r WINDOW w AS {BY_UID}""",
)
def running_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).select("uid", "seq", "id", "ts", "vc")
    return running.running_reduce(rows, ["uid"], ["seq"], first=["id"], summed=["vc"])


@query(
    "q_state_running_sum",
    f"WITH {SENSOR} SELECT uid, seq, CAST(sum(vc) OVER {BY_UID} AS BIGINT) AS total FROM sensor",
)
def state_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = running.running_totals(sensor(spark, sf_dir), ["uid"], ["seq"], F.col("vc"))
    return totals.select("uid", "seq", "total")


@query(
    "q_state_running_sum_by_type",
    f"""WITH {SENSOR} SELECT id, seq, CAST(sum(vc) OVER (PARTITION BY id ORDER BY seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total FROM sensor""",
)
def state_running_sum_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five keys only: each is hot, so the scan cuts them into chunks even at small scale."""
    totals = running.running_totals(
        sensor(spark, sf_dir), ["id"], ["seq"], F.col("vc"), chunk_rows=500
    )
    return totals.select("id", "seq", "total")


RUNNING_AVG = f"""WITH {SENSOR} SELECT uid, seq,
      CAST(CAST(sum(vc) OVER {BY_UID} AS BIGINT) AS DOUBLE) / count(*) OVER {BY_UID} AS mean
    FROM sensor"""


@query("q_state_running_avg", RUNNING_AVG)
def state_running_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = running.running_totals(sensor(spark, sf_dir), ["uid"], ["seq"], F.col("vc"))
    return totals.select("uid", "seq", "mean")


VALUE_COUNTS = f"""WITH {SENSOR} SELECT uid, seq, vc,
      count(*) OVER (PARTITION BY uid, vc ORDER BY seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt
    FROM sensor"""


@query("q_state_value_counts", VALUE_COUNTS)
def state_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensor(spark, sf_dir).select("uid", "seq", "vc")
    return running.running_occurrences(rows, ["uid", "vc"], ["seq"])


def three_of(top: str) -> list[Column]:
    return [F.get(top, F.lit(i)).alias(name) for i, name in enumerate(("first", "second", "third"))]


TOP3 = f"""WITH {SENSOR}, t AS (
      SELECT uid, seq, list_sort(list(vc) OVER {BY_UID}, 'DESC')[1:3] AS top FROM sensor)
    SELECT uid, seq, top[1] AS first, top[2] AS second, top[3] AS third FROM t"""


@query("q_state_top3", TOP3)
def state_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensor(spark, sf_dir).select("uid", "seq", "vc")
    top = running.running_top(rows, ["uid"], ["seq"], "vc", k=3)
    return top.select("uid", "seq", *three_of("top"))


JUMPS = f"""WITH {SENSOR}, p AS (
      SELECT uid, seq, vc, coalesce(lag(vc) OVER (PARTITION BY uid ORDER BY seq), 0) AS last
      FROM sensor)
    SELECT uid, seq, last, vc FROM p WHERE abs(vc - last) > {JUMP}"""


@query("q_state_jump_alert", JUMPS)
def state_jump_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensor(spark, sf_dir).select("uid", "seq", "vc")
    return running.jump_alerts(rows, ["uid"], ["seq"], "vc", JUMP)


FLOOR = 100


@query(
    "q_state_ttl",
    f"""WITH {SENSOR}, g AS (
      SELECT *, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER (PARTITION BY uid ORDER BY seq) AS before
      FROM sensor),
    c AS (
      SELECT *, sum(CASE WHEN before IS NULL OR us - before >= {TTL_US} THEN 1 ELSE 0 END)
        OVER {BY_UID} AS chain FROM g)
    SELECT uid, seq, last_value(CASE WHEN vc > {FLOOR} THEN vc END IGNORE NULLS) OVER (
      PARTITION BY uid, chain ORDER BY seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS state
    FROM c""",
)
def state_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensor(spark, sf_dir).select("uid", "seq", "ts", "vc")
    held = running.value_with_expiry(
        rows,
        ["uid"],
        ["seq"],
        F.when(F.col("vc") > FLOOR, F.col("vc")),
        F.unix_micros("ts"),
        TTL_US,
    )
    return held.select("uid", "seq", "state")


CHANGES = f"""WITH {SENSOR}, t AS (
      SELECT uid, seq, vc, CAST(sum(vc) OVER {BY_UID} AS BIGINT) AS total,
        row_number() OVER (PARTITION BY uid ORDER BY seq) AS n
      FROM sensor)
    SELECT seq, uid, CASE WHEN n = 1 THEN '+I' ELSE '+U' END AS op, total FROM t
    UNION ALL SELECT seq, uid, '-U', total - vc FROM t WHERE n > 1"""


@query("q_changelog_sum", CHANGES)
def changelog_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.sum_changelog(sensor(spark, sf_dir), ["uid"], ["seq"], "vc")


@query("q_state_top3_in_chunks", TOP3)
def state_top3_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensor(spark, sf_dir).select("uid", "seq", "vc")
    top = running.running_top(rows, ["uid"], ["seq"], "vc", k=3, chunk_rows=70)
    return top.select("uid", "seq", *three_of("top"))
