"""Snapshots and report outputs."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cloudtally.operators.pivot import in_report_order


def save_snapshot(df: DataFrame, folder: str, name: str, partition_by: str | None = None) -> str:
    """Write a core table once, so that every report reads it with pruned columns (and months)."""
    path = f"{folder}/{name}"
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return path


def load_snapshot(spark: SparkSession, folder: str, name: str, schema: StructType | None = None) -> DataFrame:
    """A saved table. One without rows by month has no file to tell its columns: give its schema."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder}/{name}")


def save_snapshot_by_month(df: DataFrame, folder: str, name: str, month: str) -> str:
    """Snapshot partitioned by month. Rows are first rebalanced by month: AQE joins small months' partitions and
    splits a large month into several tasks and files of a fair size."""
    return save_snapshot(df.hint("rebalance", F.col(month)), folder, name, month)


def run_stamp(now: dt.datetime) -> str:
    return now.strftime("%Y%m%d_%H%M%S")


def new_run(now: dt.datetime) -> str:
    """Name of a run: its time and a part of its own, so that runs of the same second share no folder."""
    return f"{run_stamp(now)}_{uuid.uuid4().hex[:8]}"


def as_of_text(now: dt.datetime) -> str:
    """Banner of month-to-date reports."""
    return now.strftime("%H:%M UTC on %b %d, %Y")


def write_reports(
    reports: Mapping[str, Callable[[], DataFrame]],
    folder: str,
    now: dt.datetime,
    selected: Iterable[str] | None = None,
    file_format: str = "parquet",
    run: str | None = None,
    rejected: Mapping[str, int] | None = None,
) -> dict[str, str]:
    """Write each selected report as its own dataset under ``<folder>/<report>/run_ts=<run>``.

    A report that is not selected is never built. Pivots are written in key order, totals last. The run's as-of text
    goes to the dataset ``RunInfo`` next to them, with the paths, and with the ``rejected`` landed lines by entity.
    """
    run = run or new_run(now)
    names = list(reports) if selected is None else list(selected)
    unknown = [n for n in names if n not in reports]
    if unknown:
        raise ValueError(f"unknown reports: {', '.join(unknown)}")
    paths = {}
    for name in names:
        path = f"{folder}/{name}/run_ts={run}"
        report = in_report_order(reports[name]())
        writer = report.write.mode("errorifexists")
        if file_format == "csv":
            writer = writer.option("header", "true")
        writer.format(file_format).save(path)
        paths[name] = path
    if paths:
        rows = [(name, path, as_of_text(now), rejected) for name, path in paths.items()]
        schema = "report string, path string, as_of string, rejected map<string,long>"
        info = report.sparkSession.createDataFrame(rows, schema)
        info.coalesce(1).write.mode("append").json(f"{folder}/RunInfo/run_ts={run}")
    return paths
