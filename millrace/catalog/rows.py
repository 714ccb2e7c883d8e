"""Queries on sources, sinks, row operators, layout, routing and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import HOUR_S, JUMP, SENSOR, WINDOW, epoch_s, query, sensor, table
from millrace.operators import combine, project, route, windows
from millrace.plans import layout
from millrace.plans.scan import OrderedScan, running_count
from millrace.session import scratch_dir
from millrace.sinks.files import write_bucketed
from millrace.sinks.log import keyed_lines
from millrace.sinks.tables import create_sink_table, insert_select
from millrace.sources.generator import generator_table, numbered
from millrace.sources.log import FileLog
from millrace.sources.memory import from_collection
from millrace.sources.records import parse_sensor, to_lines
from millrace.sources.text import read_lines

LINES = (
    f"WITH {SENSOR}"
    + """, lines AS (
  SELECT seq, id, concat_ws(',', id, CAST(floor(epoch(ts)) AS BIGINT), vc) AS value FROM sensor)"""
)


def sensor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_lines(sensor(spark, sf_dir).withColumn("ts", epoch_s("ts")))


@query(
    "q_src_collection",
    f"""WITH {SENSOR}, names(id, label) AS (
      VALUES ('click', 'touch'), ('view', 'touch'), ('purchase', 'sale'))
    SELECT label, count(*) AS n, CAST(sum(vc) AS BIGINT) AS sum_vc
    FROM sensor JOIN names USING (id) GROUP BY label""",
)
def src_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = from_collection(
        spark,
        [("click", "touch"), ("view", "touch"), ("purchase", "sale")],
        "id string, label string",
    )
    return (
        sensor(spark, sf_dir)
        .join(F.broadcast(names), "id")
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("vc").alias("sum_vc"))
    )


@query(
    "q_src_text",
    """SELECT value, count(*) AS n FROM (
      SELECT unnest(string_split(text, chr(10))) AS value FROM documents)
    GROUP BY value""",
)
def src_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "lines")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    return read_lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q_src_datagen",
    """SELECT 'Number:' || CAST(i AS VARCHAR) AS value, o_custkey
    FROM range((SELECT count(*) FROM orders)) AS g(i) JOIN orders ON o_orderkey = i""",
)
def src_datagen(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    made = numbered(spark, orders.count(), "Number:")
    joined = made.join(orders, F.col("index") == F.col("o_orderkey"))
    return joined.select("value", "o_custkey")


@query(
    "q_src_datagen_sql",
    """SELECT o_custkey, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS sum_ts, TRUE AS in_range
    FROM orders GROUP BY o_custkey""",
)
def src_datagen_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generated row per order key, joined to its order in SQL."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    most = orders.agg(F.max("o_orderkey")).first()[0] or 0
    columns = {"id": ("random", 1, 10), "ts": ("sequence", 0, 1 << 40), "vc": ("random", 1, 10)}
    return spark.sql(
        """SELECT o_custkey, count(*) AS n, sum(ts) AS sum_ts,
             bool_and(id BETWEEN 1 AND 10 AND vc BETWEEN 1 AND 10) AS in_range
           FROM {made} JOIN {orders} ON ts = o_orderkey GROUP BY o_custkey""",
        made=generator_table(spark, None, most + 1, columns),
        orders=orders,
    )


@query(
    "q_src_log_latest",
    f"""{LINES}, cut AS (SELECT (min(seq) + max(seq)) // 2 AS cut_seq FROM sensor)
    SELECT 'earliest' AS start, id AS key, value FROM lines
    UNION ALL
    SELECT 'latest', id, value FROM lines, cut WHERE seq > cut_seq""",
)
def src_log_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensor(spark, sf_dir)
    span = rows.agg(F.min("seq"), F.max("seq")).first()
    cut = (span[0] + span[1]) // 2
    lines = rows.select(
        "seq",
        F.col("seq").alias("offset"),
        F.concat_ws(",", "id", epoch_s("ts"), "vc").alias("value"),
    )
    records = lines.withColumn("key", F.split("value", ",")[0])
    log = FileLog(spark)
    log.append(records.filter(F.col("seq") <= cut), 0)
    position = log.position()
    log.append(records.filter(F.col("seq") > cut), 1)
    return combine.union_all(
        log.read().select(F.lit("earliest").alias("start"), "key", "value"),
        log.read(after=position).select(F.lit("latest").alias("start"), "key", "value"),
    )


@query(
    "q_parse_sensor",
    f"WITH {SENSOR} SELECT id, CAST(floor(epoch(ts)) AS BIGINT) AS ts, vc FROM sensor",
)
def parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_sensor(sensor_lines(spark, sf_dir))


@query(
    "q_sink_file_bucketed",
    f"""WITH {SENSOR} SELECT strftime(ts, '%Y-%m-%d %H') AS bucket, count(*) AS n,
      CAST(sum(vc) AS BIGINT) AS sum_vc FROM sensor GROUP BY 1""",
)
def sink_file_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "bucketed")
    rows = sensor(spark, sf_dir)
    write_bucketed(rows, path, "ts", F.concat_ws(",", "id", epoch_s("ts"), "vc"))
    back = spark.read.schema("value string, bucket string").text(path)
    return (
        parse_sensor(back)
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("vc").alias("sum_vc"))
    )


@query("q_sink_keyed_log", f"{LINES} SELECT id AS key, value FROM lines")
def sink_keyed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = FileLog(spark)
    lines = sensor(spark, sf_dir).select(
        F.concat_ws(",", "id", epoch_s("ts"), "vc").alias("value"), F.col("seq").alias("offset")
    )
    log.append(keyed_lines(lines), 0)
    return log.read().select("key", "value")


@query(
    "q_sink_table_insert",
    f"""WITH {SENSOR} SELECT uid, CAST(sum(vc) AS BIGINT) AS sum_vc
    FROM sensor WHERE uid > 5 GROUP BY uid""",
)
def sink_table_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = scratch_dir(spark, "sink")
    name = "sink_" + location.rsplit("-", 1)[-1]
    create_sink_table(spark, name, "uid BIGINT, sum_vc BIGINT", location)
    insert_select(
        spark, name, "SELECT uid, sum(vc) AS sum_vc FROM {r} WHERE uid > 5 GROUP BY uid", r=sensor(spark, sf_dir)
    )
    # The table is external: its files stay when its name goes.
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema("uid BIGINT, sum_vc BIGINT").parquet(location)


@query("q_map_id", f"WITH {SENSOR} SELECT id FROM sensor")
def map_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor(spark, sf_dir).select("id")


@query("q_map_increment", f"WITH {SENSOR} SELECT seq, vc + 1 AS value FROM sensor")
def map_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor(spark, sf_dir).select("seq", (F.col("vc") + 1).alias("value"))


@query("q_filter_id", f"WITH {SENSOR} SELECT seq, id, uid, vc FROM sensor WHERE id = 'click'")
def filter_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.keep_equal(sensor(spark, sf_dir), "id", "click").select("seq", "id", "uid", "vc")


@query("q_sql_filter", f"WITH {SENSOR} SELECT id, seq, vc FROM sensor WHERE vc > 200")
def sql_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql("SELECT id, seq, vc FROM {r} WHERE vc > 200", r=sensor(spark, sf_dir))


@query(
    "q_flatmap_conditional",
    f"""WITH {SENSOR}
    SELECT seq, CAST(0 AS INT) AS pos, CAST(vc AS VARCHAR) AS value FROM sensor WHERE id = 'click'
    UNION ALL
    SELECT seq, 0, CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) FROM sensor WHERE id = 'view'
    UNION ALL
    SELECT seq, 1, CAST(vc AS VARCHAR) FROM sensor WHERE id = 'view'""",
)
def flatmap_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensor(spark, sf_dir).withColumn("ts", epoch_s("ts"))
    return project.values_by_id(rows, "click", "view").select("seq", "pos", "value")


@query(
    "q_connect_comap",
    """SELECT 'left' AS side, CAST(o_orderkey AS VARCHAR) AS value FROM orders
    UNION ALL SELECT 'right', c_name FROM customer""",
)
def connect_comap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine.co_map(
        table(spark, sf_dir, "orders"),
        F.col("o_orderkey").cast("string"),
        table(spark, sf_dir, "customer"),
        F.col("c_name"),
    )


@query(
    "q_format_window_bounds",
    f"""WITH {SENSOR}, w AS (
      SELECT id, (CAST(floor(epoch(ts)) AS BIGINT) // {6 * HOUR_S}) * {6 * HOUR_S} AS s FROM sensor)
    SELECT id, strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S.%g') AS window_start,
      strftime(make_timestamp((s + {6 * HOUR_S}) * 1000000), '%Y-%m-%d %H:%M:%S.%g') AS window_end,
      count(*) AS n
    FROM w GROUP BY id, s""",
)
def format_window_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = windows.time_windows(
        sensor(spark, sf_dir), "ts", WINDOW, [F.count(F.lit(1)).alias("n")], keys=["id"]
    )
    return counts.select(
        "id",
        project.format_time(F.col("window_start")).alias("window_start"),
        project.format_time(F.col("window_end")).alias("window_end"),
        "n",
    )


#: Of the queries whose result names partitions; the others take the session's shuffle partitions.
PARTITIONS = 4


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query(
    "q_part_key",
    f"WITH {SENSOR} SELECT id, CAST(1 AS BIGINT) AS partitions, count(*) AS n FROM sensor GROUP BY id",
)
def part_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = layout.by_key(sensor(spark, sf_dir), "id", partitions(spark)).select(
        "id", F.spark_partition_id().alias("partition")
    )
    per_place = placed.groupBy("id", "partition").agg(F.count(F.lit(1)).alias("n"))
    return per_place.groupBy("id").agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("n").alias("n")
    )


@query("q_part_shuffle", "SELECT true AS spread, count(*) AS n FROM events")
def part_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every partition has rows, none twice its share and a few random ones more."""
    wanted = partitions(spark)
    sizes = layout.partition_sizes(layout.shuffled(sensor(spark, sf_dir), "seq", wanted, seed=7))
    fair = F.max("n") <= 2 * F.sum("n") / wanted + 20
    return sizes.agg(((F.count(F.lit(1)) == wanted) & fair).alias("spread"), F.sum("n").alias("n"))


@query("q_part_rebalance", "SELECT true AS even, count(*) AS n FROM events")
def part_rebalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = partitions(spark)
    sizes = layout.partition_sizes(layout.rebalanced(sensor(spark, sf_dir), wanted))
    # A map task deals its rows in turn from a partition of its own choice on: sizes differ by
    # one for each task at most, and there are fewer tasks than partitions or rows here.
    return sizes.agg(
        ((F.count(F.lit(1)) == wanted) & (F.max("n") - F.min("n") <= F.sum("n") / wanted / 4 + 1)).alias("even"),
        F.sum("n").alias("n"),
    )


@query("q_part_rescale", "SELECT true AS narrowed, count(*) AS n FROM lineitem")
def part_rescale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    wanted = max(1, rows.rdd.getNumPartitions() // 2)
    sizes = layout.partition_sizes(layout.rescaled(rows, wanted))
    return sizes.agg((F.count(F.lit(1)) <= wanted).alias("narrowed"), F.sum("n").alias("n"))


@query(
    "q_part_broadcast",
    f"""SELECT CAST(p AS INT) AS partition, count(*) AS n
    FROM events, range({PARTITIONS}) AS t(p) GROUP BY p""",
)
def part_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.partition_sizes(layout.replicated(sensor(spark, sf_dir), PARTITIONS))


@query(
    "q_part_custom",
    f"""WITH {SENSOR} SELECT CAST(uid % {PARTITIONS} AS INT) AS partition, count(*) AS n
    FROM sensor GROUP BY 1""",
)
def part_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = layout.by_function(sensor(spark, sf_dir), F.col("uid"), PARTITIONS)
    return layout.partition_sizes(placed)


@query(
    "q_partition_count",
    f"""WITH {SENSOR} SELECT seq, CAST(uid % {PARTITIONS} AS INT) AS partition,
      row_number() OVER (PARTITION BY uid % {PARTITIONS} ORDER BY seq) AS count_so_far
    FROM sensor""",
)
def partition_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = layout.by_function(sensor(spark, sf_dir), F.col("uid"), PARTITIONS).select(
        "seq", F.spark_partition_id().alias("partition")
    )
    return OrderedScan(placed, ["partition"], ["seq"]).add(count_so_far=running_count()).result()


@query(
    "q_split_parity",
    f"""WITH {SENSOR}, v AS (SELECT seq, vc - 245 AS value FROM sensor)
    SELECT seq, value, CASE WHEN value % 2 = 0 THEN 'even' ELSE 'odd' END AS tag
    FROM v WHERE value % 2 IN (0, 1)""",
)
def split_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = sensor(spark, sf_dir).select("seq", (F.col("vc") - 245).alias("value"))
    return route.split_parity(values, "value")


@query(
    "q_side_output_route",
    f"""WITH {SENSOR} SELECT seq, vc,
      CASE id WHEN 'click' THEN 'first' WHEN 'view' THEN 'second' ELSE 'main' END AS tag
    FROM sensor""",
)
def side_output_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"first": F.col("id") == "click", "second": F.col("id") == "view"}
    return route.tag_first(sensor(spark, sf_dir), rules, "main").select("seq", "vc", "tag")


@query(
    "q_side_output_files",
    f"""WITH {SENSOR} SELECT tag, count(*) AS n, CAST(sum(vc) AS BIGINT) AS sum_vc FROM (
      SELECT vc, CASE id WHEN 'click' THEN 'first' WHEN 'view' THEN 'second' ELSE 'main' END AS tag
      FROM sensor) GROUP BY tag""",
)
def side_output_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "outputs")
    route.write_outputs(side_output_route(spark, sf_dir), path)
    back = spark.read.schema("seq bigint, vc int, tag string").parquet(path)
    return back.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.sum("vc").alias("sum_vc"))


@query(
    "q_side_output_alert",
    f"""WITH {SENSOR}
    SELECT seq, vc, 'main' AS tag, NULL AS message FROM sensor
    UNION ALL
    SELECT seq, vc, 'warn', 'level ' || CAST(vc AS VARCHAR) || ' of ' || id || ' is above {JUMP}'
    FROM sensor WHERE vc > {JUMP}""",
)
def side_output_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.concat(
        F.lit("level "), F.col("vc").cast("string"), F.lit(" of "), "id", F.lit(f" is above {JUMP}")
    )
    tagged = route.with_alerts(sensor(spark, sf_dir), F.col("vc") > JUMP, message, "main", "warn")
    return tagged.select("seq", "vc", "tag", "message")


@query(
    "q_union",
    """SELECT CAST(o_orderkey AS VARCHAR) AS value FROM orders
    UNION ALL SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem
    UNION ALL SELECT CAST(p_partkey AS VARCHAR) FROM part""",
)
def union(spark: SparkSession, sf_dir: str) -> DataFrame:
    def keys(name: str, column: str) -> DataFrame:
        return table(spark, sf_dir, name).select(F.col(column).cast("string").alias("value"))

    return combine.union_all(
        keys("orders", "o_orderkey"), keys("lineitem", "l_orderkey"), keys("part", "p_partkey")
    )
