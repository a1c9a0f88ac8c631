"""The given tables, and one SQL text for both engines.

A base query maps given columns to landed values (texts, codes, amounts); Spark nests them into response
documents and runs the library on those, DuckDB works out the expected rows from the same base without nesting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels"]


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is looked up once per path, which saves a job for each further read."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def fill_cores(df: DataFrame) -> DataFrame:
    """A given table dealt out to all cores, for the documents that are made of it once.

    The given files have one row group each, so one task would do all that work. A table whose rows the splits share out
    already stays as it is: row counts of the splits come from the files' footers.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    rows = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    if rows and max(rows) * cores <= 2 * sum(rows):
        return df
    return df.repartition(cores)


def all_within(df: DataFrame, column: str, months: Sequence[str]) -> DataFrame:
    """Rows as they are; one of another month than the report's columns fails the query."""
    known = F.col(column).isNull() | F.col(column).isin(list(months))
    other = F.raise_error(F.concat(F.lit("no column for month "), F.col(column))).cast("string")
    return df.withColumn(column, F.when(known, F.col(column)).otherwise(other))


def run(spark: SparkSession, sf_dir: str, query: str, fact: str | None = None) -> DataFrame:
    """Run a base query; ``{name}`` stands for a given table. ``fact`` names the one the work is on."""
    used = {name: table(spark, sf_dir, name) for name in TABLES if "{" + name + "}" in query}
    if fact:
        used[fact] = fill_cores(used[fact])
    return spark.sql(query, **used)


def duck(query: str) -> str:
    """The same query for DuckDB, where given tables are views by name."""
    return query.format(**{name: name for name in TABLES})


def half_even(units: str) -> str:
    """SQL: a whole number of ten-thousandths rounded half-even to thousandths, as a whole number."""
    return (
        f"(CASE WHEN ({units}) % 10 > 5 OR (({units}) % 10 = 5 AND (({units}) // 10) % 2 = 1) "
        f"THEN ({units}) // 10 + 1 ELSE ({units}) // 10 END)"
    )
