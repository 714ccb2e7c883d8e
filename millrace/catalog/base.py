"""Registry of the queries: name, Spark callable and the equivalent SQL for the check."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import configure

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    oracle: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``oracle`` is its SQL on the same tables."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Entry(run, oracle)
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as sensor readings: ``id, uid, ts, vc, seq`` with ``seq`` the arrival order."""
    return sensor_of(table(spark, sf_dir, "events"))


def sensor_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("id"),
        F.col("user_id").alias("uid"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.floor("value").cast("int").alias("vc"),
        F.col("event_id").alias("seq"),
    )


SENSOR = """sensor AS (
  SELECT event_type AS id, user_id AS uid, ts, CAST(floor(value) AS INT) AS vc, event_id AS seq
  FROM events)"""


def out_of_order(rows: DataFrame) -> DataFrame:
    """Adds ``arrival`` (seconds): readings reach us with delays of up to four hours."""
    return rows.withColumn(
        "arrival", F.floor(F.unix_micros("ts") / 1_000_000) + (F.col("seq") * 7919) % 14407
    )


ARRIVING = (
    SENSOR
    + """, arriving AS (
  SELECT *, CAST(floor(epoch(ts)) AS BIGINT) + (seq * 7919) % 14407 AS arrival, epoch_us(ts) // 1000 AS ms
  FROM sensor)"""
)


def epoch_s(column: str) -> Column:
    return F.floor(F.unix_micros(column) / 1_000_000)


# The second-scale constants of the original jobs, scaled to events some minutes apart.
HOUR_S = 3_600
HOUR_MS = 1_000 * HOUR_S
HOUR_US = 1_000 * HOUR_MS
WINDOW = "6 hours"
SLIDE = "3 hours"
WINDOW_MS = 6 * HOUR_MS
GAP_US = HOUR_US // 2
DELAY_MS = 2 * HOUR_MS
LATENESS_MS = HOUR_MS
TTL_US = 12 * HOUR_US
JUMP = 100
