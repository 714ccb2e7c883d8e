"""Aggregate and table functions, as expressions and as registered names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def weighted_avg(score: Column, weight: Column) -> Column:
    """``sum(score * weight) / sum(weight)``; null where the weights add up to 0."""
    return F.try_divide(F.sum(score * weight).cast("double"), F.sum(weight).cast("double"))


def top_values(
    df: DataFrame, value: str, n: int = 2, keys: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` largest positive values, as rows ``(keys…, value, rank)``.

    Values at or below zero never appear, equal values take one rank each. Spark
    cuts every map task down to n rows per key before the shuffle, so a hot key
    costs no more than any other.
    """
    rows = df.select(*keys, F.col(value).alias("value")).filter(F.col("value") > 0)
    largest = F.col("value").desc()
    if not keys:
        # A rank over the whole table is not cut down per task, a limit is.
        best = rows.orderBy(largest).limit(n)
        return best.withColumn("rank", F.row_number().over(Window.orderBy(largest)))
    order = Window.partitionBy(*keys).orderBy(largest)
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= n)


def register_functions(spark: SparkSession) -> None:
    """Make the functions callable by name from SQL and ``F.call_function``.

    All are SQL functions over built-in expressions; ``split_words`` is a table
    function for ``LATERAL``. An average weighted by a column reads
    ``weighted_mean(sum(score * weight), sum(weight))``, so its sums stay two-phase.
    """
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")


SQL_FUNCTIONS = {
    "java_hash_text": """(s STRING) RETURNS INT RETURN
        aggregate(
          CASE WHEN s = '' THEN CAST(array() AS ARRAY<STRING>) ELSE split(s, '') END,
          0L,
          (h, c) -> CASE
            WHEN ascii(c) < 65536 THEN pmod(h * 31 + ascii(c), 4294967296L)
            ELSE pmod(
              pmod(h * 31 + 55296 + shiftright(ascii(c) - 65536, 10), 4294967296L) * 31
                + 56320 + ((ascii(c) - 65536) & 1023), 4294967296L) END,
          h -> CAST(CASE WHEN h >= 2147483648L THEN h - 4294967296L ELSE h END AS INT))""",
    "java_hash_long": """(n BIGINT) RETURNS INT RETURN
        CAST(CASE
          WHEN pmod(n ^ shiftrightunsigned(n, 32), 4294967296L) >= 2147483648L
          THEN pmod(n ^ shiftrightunsigned(n, 32), 4294967296L) - 4294967296L
          ELSE pmod(n ^ shiftrightunsigned(n, 32), 4294967296L) END AS INT)""",
    "weighted_mean": """(weighted BIGINT, weight BIGINT) RETURNS DOUBLE RETURN
        try_divide(CAST(weighted AS DOUBLE), CAST(weight AS DOUBLE))""",
    "tokens": """(s STRING) RETURNS ARRAY<STRING> RETURN
        CASE WHEN s = '' THEN array('')
             WHEN rtrim(s) = '' THEN CAST(array() AS ARRAY<STRING>)
             ELSE split(rtrim(s), ' ') END""",
    "split_words": """(s STRING) RETURNS TABLE(word STRING, length INT) RETURN
        SELECT t.w, char_length(t.w) FROM explode(
          CASE WHEN s = '' THEN array('')
               WHEN rtrim(s) = '' THEN CAST(array() AS ARRAY<STRING>)
               ELSE split(rtrim(s), ' ') END) AS t(w)""",
}
