"""Inserting query results into tables and databases."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def create_sink_table(spark: SparkSession, name: str, schema: str, location: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet LOCATION '{location}'")


def qualified(spark: SparkSession, table: str) -> str:
    """A table's full name, which no temporary view can hide."""
    if "." in table:
        return table
    return f"{spark.catalog.currentCatalog()}.{spark.catalog.currentDatabase()}.{table}"


def insert_select(spark: SparkSession, table: str, query: str, **frames: DataFrame) -> None:
    """``INSERT INTO table SELECT …``; names and types must match the table's.

    ``{name}`` in the query stands for the frame given under that name.
    """
    spark.sql(f"INSERT INTO {qualified(spark, table)} {query}", **frames)


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 batch_rows: int = 100) -> dict[str, str]:
    """Options of a JDBC append in batches of ``batch_rows`` statements."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows)}
    if user:
        options["user"] = user
    if password:
        options["password"] = password
    return options


def jdbc_append(options: dict[str, str], attempts: int = 3) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` handler that appends each batch, retrying up to ``attempts`` times.

    At least once: a repeated batch is appended again, as with any plain insert.
    """

    def handle(batch: DataFrame, _: int) -> None:
        for attempt in range(1, attempts + 1):
            try:
                batch.write.format("jdbc").options(**options).mode("append").save()
                return
            except Exception:
                if attempt == attempts:
                    raise

    return handle
