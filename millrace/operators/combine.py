"""Bringing tables together: unions, co-maps and joins in time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.scan import CHUNK_ROWS, OrderedScan, last_value


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of every input, duplicates kept, in no order."""
    return reduce(DataFrame.unionByName, others, first)


def co_map(left: DataFrame, left_value: Column, right: DataFrame, right_value: Column) -> DataFrame:
    """Map two inputs of different types, each by its own expression, into one."""
    return union_all(
        left.select(F.lit("left").alias("side"), left_value.alias("value")),
        right.select(F.lit("right").alias("side"), right_value.alias("value")),
    )


def keyed_connect(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Every pair of rows with equal keys, once, whatever the arrival order.

    Works on two streams too; their state then holds the whole history.
    """
    return left.join(right, F.col(left_key) == F.col(right_key))


def window_join(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, length: str
) -> DataFrame:
    """Pairs with equal key whose times lie in the same tumbling window.

    ``key`` and ``window_start`` appear once; other column names must differ.
    """
    # The join runs on the window itself, which carries the watermark on streams.
    a = left.withColumn("__window", F.window(left_time, length))
    b = right.withColumn("__window", F.window(right_time, length))
    joined = a.join(b, [key, "__window"])
    return joined.withColumn("window_start", F.col("__window.start")).drop("__window")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    lower_us: int,
    upper_us: int,
) -> DataFrame:
    """Pairs with equal key and right time within [left + lower, left + upper].

    Times are bucketed by the interval's width and the join runs on key *and*
    bucket, so a hot key spreads over its buckets and only rows close in time
    meet. A left row's interval touches at most two buckets; a right row is in one,
    hence each pair arises once.
    """
    width = F.lit(max(upper_us - lower_us, 1))
    at_left, at_right = F.unix_micros(F.col(left_time)), F.unix_micros(F.col(right_time))

    def bucket(micros: Column) -> Column:
        return F.floor(micros / width)

    touched = F.sequence(bucket(at_left + lower_us), bucket(at_left + upper_us))
    a = left.withColumn("__bucket", F.explode(touched)).withColumn("__l", at_left)
    b = right.withColumn("__bucket", bucket(at_right)).withColumn("__r", at_right)
    near = F.col("__r").between(F.col("__l") + lower_us, F.col("__l") + upper_us)
    return a.join(b, [key, "__bucket"]).filter(near).drop("__bucket", "__l", "__r")


def latest_setting(
    data: DataFrame,
    settings: DataFrame,
    order: str,
    setting: str,
    default: object,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Each data row with the latest setting that arrived before it, else ``default``.

    Both inputs go through one global running value, so neither is broadcast and
    the settings may grow like the data. Of rows with equal order, data come first: a
    setting counts from the next value on; of equal settings the larger one stays.
    """
    names = data.columns
    both = data.withColumn("__set", F.lit(None).cast(settings.schema[setting].dataType)).unionByName(
        settings.select(order, F.col(setting).alias("__set")).withColumn("__is_set", F.lit(True)),
        allowMissingColumns=True,
    ).withColumn("__side", F.when(F.col("__is_set"), 1).otherwise(0))
    scan = OrderedScan(both, [], [order, "__side", "__set"], chunk_rows).add(__latest=last_value(F.col("__set")))
    return scan.result().filter(F.col("__is_set").isNull()).select(
        *names, F.coalesce("__latest", F.lit(default)).alias(setting)
    )


def lateral_tokens(
    df: DataFrame, tokens: Column, word: str, length: str, outer: bool = False
) -> DataFrame:
    """Lateral join with the tokens of each row; ``outer`` keeps rows without any."""
    generate = F.explode_outer if outer else F.explode
    return df.withColumn(word, generate(tokens)).withColumn(length, F.char_length(F.col(word)))

