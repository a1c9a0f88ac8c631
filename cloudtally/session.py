"""Session settings the plans rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: str = "*", shuffle_partitions: int = 8, app: str = "cloudtally") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def demand_ansi(spark: SparkSession) -> None:
    """Raise unless the session is in ANSI mode: without it, a sum of amounts that overflows would be NULL, not an error."""
    if spark.conf.get("spark.sql.ansi.enabled").lower() != "true":
        raise ValueError("amounts need spark.sql.ansi.enabled: without it an overflow is not an error")


def work_folder(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables: ``spark.checkpoint.dir``.

    Only a session on one machine may lack that setting (a test); its tables go to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{tempfile.gettempdir()}/cloudtally-{context.applicationId}"
