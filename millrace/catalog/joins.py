"""Queries on joins, tables and user-defined functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import (
    ARRIVING,
    DELAY_MS,
    HOUR_S,
    HOUR_US,
    SENSOR,
    WINDOW,
    epoch_s,
    out_of_order,
    query,
    sensor,
    table,
)
from millrace.functions.aggregates import register_functions, top_values, weighted_avg
from millrace.functions.text import java_hash, java_split
from millrace.operators import combine, eventtime


def of_type(rows: DataFrame, kind: str, seq: str, ts: str) -> DataFrame:
    return rows.filter(F.col("id") == kind).select(
        "uid", F.col("seq").alias(seq), F.col("ts").alias(ts)
    )


@query(
    "q_connect_join",
    """SELECT o_orderkey, o_totalprice, l_linenumber, l_partkey
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def connect_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = combine.keyed_connect(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "lineitem"),
        "o_orderkey",
        "l_orderkey",
    )
    return joined.select("o_orderkey", "o_totalprice", "l_linenumber", "l_partkey")


@query(
    "q_window_join",
    f"""WITH {SENSOR}, w AS (
      SELECT *, (CAST(floor(epoch(ts)) AS BIGINT) // {6 * HOUR_S}) * {6 * HOUR_S} AS s FROM sensor)
    SELECT a.uid, a.s AS window_start, a.seq AS left_seq, b.seq AS right_seq
    FROM w a JOIN w b ON a.uid = b.uid AND a.s = b.s
    WHERE a.id = 'purchase' AND b.id = 'click'""",
)
def window_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensor(spark, sf_dir)
    joined = combine.window_join(
        of_type(rows, "purchase", "left_seq", "left_ts"),
        of_type(rows, "click", "right_seq", "right_ts"),
        "uid",
        "left_ts",
        "right_ts",
        WINDOW,
    )
    return joined.select(
        "uid", epoch_s("window_start").alias("window_start"), "left_seq", "right_seq"
    )


INTERVAL_JOIN = f"""WITH {SENSOR}
    SELECT a.uid, a.seq AS left_seq, b.seq AS right_seq
    FROM sensor a JOIN sensor b ON a.uid = b.uid
      AND b.ts BETWEEN a.ts - INTERVAL 2 HOUR AND a.ts + INTERVAL 2 HOUR
    WHERE a.id = 'purchase' AND b.id = 'view'"""


@query("q_interval_join", INTERVAL_JOIN)
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensor(spark, sf_dir)
    joined = combine.interval_join(
        of_type(rows, "purchase", "left_seq", "left_ts"),
        of_type(rows, "view", "right_seq", "right_ts"),
        "uid",
        "left_ts",
        "right_ts",
        -2 * HOUR_US,
        2 * HOUR_US,
    )
    return joined.select("uid", "left_seq", "right_seq")


@query(
    "q_interval_join_late",
    f"""WITH {ARRIVING}, seen AS (
      SELECT *, max(CASE WHEN id = 'purchase' THEN ms END) OVER w AS lm,
        max(CASE WHEN id = 'view' THEN ms END) OVER w AS rm
      FROM arriving WHERE id IN ('purchase', 'view')
      WINDOW w AS (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    t AS (
      SELECT *, coalesce(lm IS NOT NULL AND rm IS NOT NULL
        AND ms < least(lm, rm) - {DELAY_MS} - 1, false) AS late FROM seen)
    SELECT 'joined' AS tag, a.uid, a.seq AS left_id, b.seq AS right_id
    FROM t a JOIN t b ON a.uid = b.uid
      AND b.ts BETWEEN a.ts - INTERVAL 2 HOUR AND a.ts + INTERVAL 2 HOUR
    WHERE a.id = 'purchase' AND b.id = 'view' AND NOT a.late AND NOT b.late
    UNION ALL SELECT 'late_left', uid, seq, NULL FROM t WHERE late AND id = 'purchase'
    UNION ALL SELECT 'late_right', uid, NULL, seq FROM t WHERE late AND id = 'view'""",
)
def interval_join_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = out_of_order(sensor(spark, sf_dir))
    return eventtime.interval_join_with_late(
        rows.filter(F.col("id") == "purchase"),
        rows.filter(F.col("id") == "view"),
        "uid",
        "seq",
        "ts",
        ["arrival", "seq"],
        -2 * HOUR_US,
        2 * HOUR_US,
        DELAY_MS,
    )


THRESHOLD = f"""WITH {SENSOR}, d AS (SELECT * FROM sensor WHERE id <> 'signup'),
    c AS (SELECT seq, vc AS threshold FROM sensor WHERE id = 'signup')
    SELECT d.seq, d.uid, d.vc, coalesce(c.threshold, 0) AS threshold
    FROM d ASOF LEFT JOIN c ON d.seq > c.seq
    WHERE d.vc > coalesce(c.threshold, 0)"""


@query("q_broadcast_threshold", THRESHOLD)
def broadcast_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensor(spark, sf_dir)
    settings = rows.filter(F.col("id") == "signup").select("seq", F.col("vc").alias("threshold"))
    data = rows.filter(F.col("id") != "signup").select("seq", "uid", "vc")
    current = combine.latest_setting(data, settings, "seq", "threshold", 0)
    return current.filter(F.col("vc") > F.col("threshold"))


TOKENS = """CASE WHEN text = '' THEN [''] WHEN rtrim(text, ' ') = '' THEN []
      ELSE string_split(rtrim(text, ' '), ' ') END"""


@query(
    "q_lateral_cross",
    f"""SELECT doc_id, word, CAST(length(word) AS INT) AS length FROM (
      SELECT doc_id, unnest({TOKENS}) AS word FROM documents)""",
)
def lateral_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = combine.lateral_tokens(docs, java_split("text"), "word", "length")
    return words.select("doc_id", "word", "length")


@query(
    "q_lateral_left",
    f"""WITH t AS (SELECT conv_id, turn, {TOKENS} AS tokens FROM (
      SELECT conv_id, turn, CASE WHEN role = 'user' THEN ' ' ELSE text END AS text
      FROM conversations))
    SELECT conv_id, turn, unnest(tokens) AS new_word, CAST(length(unnest(tokens)) AS INT) AS new_length
    FROM t WHERE len(tokens) > 0
    UNION ALL SELECT conv_id, turn, NULL, NULL FROM t WHERE len(tokens) = 0""",
)
def lateral_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    # User turns are blanked to have rows without tokens.
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", " ").otherwise(F.col("text")).alias("text"),
    )
    words = combine.lateral_tokens(turns, java_split("text"), "new_word", "new_length", outer=True)
    return words.select("conv_id", "turn", "new_word", "new_length")


GROUP_SUM = f"""WITH {SENSOR} SELECT uid, CAST(sum(vc) AS BIGINT) AS sum_vc
    FROM sensor WHERE uid > 5 GROUP BY uid"""


@query("q_sql_group_sum", GROUP_SUM)
def sql_group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql("SELECT uid, sum(vc) AS sum_vc FROM {r} WHERE uid > 5 GROUP BY uid", r=sensor(spark, sf_dir))


@query("q_tableapi_group_sum", GROUP_SUM)
def tableapi_group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensor(spark, sf_dir).where(F.col("uid") > 5)
    return rows.groupBy("uid").agg(F.sum("vc").alias("sum_vc")).select("uid", "sum_vc")


@query("q_sql_nested_view", f"SELECT uid, sum_vc FROM ({GROUP_SUM}) AS t WHERE uid > 7")
def sql_nested_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql("SELECT uid, sum_vc FROM {sums} WHERE uid > 7", sums=sql_group_sum(spark, sf_dir))


FOLD = """CASE WHEN s = '' THEN 0 ELSE list_reduce(
      list_transform(string_split(s, ''), lambda z: CAST(ord(z) AS BIGINT)),
      lambda a, x: (a * 31 + x) & 4294967295) END"""


@query(
    "q_udf_java_hash",
    f"""WITH s AS (
      SELECT 'id' AS source, event_id AS row_id, event_type AS s FROM events
      UNION ALL SELECT 'name', c_custkey, c_name FROM customer),
    h AS (
      -- A one-character string has nothing to fold, so its first unit passes through.
      SELECT source, row_id, {FOLD} AS h FROM s
      UNION ALL SELECT 'uid', event_id, xor(user_id, user_id >> 32) & 4294967295 FROM events)
    SELECT source, row_id, CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INT) AS hash
    FROM h""",
)
def udf_java_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensor(spark, sf_dir)
    customers = table(spark, sf_dir, "customer")

    def hashed(df: DataFrame, source: str, row_id: str, column: str) -> DataFrame:
        kind = dict(df.dtypes)[column]
        return df.select(
            F.lit(source).alias("source"),
            F.col(row_id).alias("row_id"),
            java_hash(column, kind).alias("hash"),
        )

    return combine.union_all(
        hashed(rows, "id", "seq", "id"),
        hashed(customers, "name", "c_custkey", "c_name"),
        hashed(rows, "uid", "seq", "uid"),
    )


@query(
    "q_udaf_weighted_avg",
    """WITH s AS (
      SELECT l_returnflag, CAST(round(l_extendedprice * 100) AS BIGINT) AS score,
        CAST(l_quantity AS BIGINT) AS weight FROM lineitem)
    SELECT l_returnflag, CAST(sum(score * weight) AS DOUBLE) / CAST(sum(weight) AS DOUBLE) AS mean
    FROM s GROUP BY l_returnflag""",
)
def udaf_weighted_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("score"),
        F.col("l_quantity").cast("bigint").alias("weight"),
    )
    mean = weighted_avg(F.col("score"), F.col("weight")).alias("mean")
    return scores.groupBy("l_returnflag").agg(mean)


@query(
    "q_udtaf_top2",
    f"""WITH {SENSOR} SELECT value, rank FROM (
      SELECT vc - 245 AS value, CAST(row_number() OVER (ORDER BY vc DESC) AS INT) AS rank
      FROM sensor WHERE vc > 245)
    WHERE rank <= 2""",
)
def udtaf_top2(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = sensor(spark, sf_dir).select((F.col("vc") - 245).alias("value"))
    return top_values(values, "value", 2)


@query(
    "q_udtaf_top2_grouped",
    f"""WITH {SENSOR} SELECT id, value, rank FROM (
      SELECT id, vc - 245 AS value,
        CAST(row_number() OVER (PARTITION BY id ORDER BY vc DESC) AS INT) AS rank
      FROM sensor WHERE vc > 245)
    WHERE rank <= 2""",
)
def udtaf_top2_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = sensor(spark, sf_dir).select("id", (F.col("vc") - 245).alias("value"))
    return top_values(values, "value", 2, keys=["id"])


@query(
    "q_udf_sql_functions",
    f"""WITH s AS (SELECT event_id AS seq, event_type AS s FROM events), h AS (SELECT seq, {FOLD} AS h FROM s)
    SELECT seq, CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INT) AS hash FROM h""",
)
def udf_sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_functions(spark)
    return spark.sql("SELECT seq, java_hash_text(id) AS hash FROM {r}", r=sensor(spark, sf_dir))


@query(
    "q_udaf_sql_weighted_mean",
    f"""WITH {SENSOR} SELECT id, CAST(sum(vc * (uid + 1)) AS DOUBLE) / CAST(sum(uid + 1) AS DOUBLE) AS mean
    FROM sensor GROUP BY id""",
)
def udaf_sql_weighted_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_functions(spark)
    return spark.sql(
        """SELECT id, weighted_mean(sum(vc * (uid + 1)), sum(uid + 1)) AS mean
        FROM {r} GROUP BY id""",
        r=sensor(spark, sf_dir),
    )


@query(
    "q_lateral_udtf",
    f"""SELECT conv_id, turn, word, CAST(length(word) AS INT) AS length FROM (
      SELECT conv_id, turn, unnest({TOKENS}) AS word FROM conversations)""",
)
def lateral_udtf(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_functions(spark)
    return spark.sql(
        "SELECT conv_id, turn, word, length FROM {turns}, LATERAL split_words(text)",
        turns=table(spark, sf_dir, "conversations"),
    )
