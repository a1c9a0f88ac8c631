"""Landed documents: made from the given tables once per application, as a report run finds them on disk.

They are written to the shared work folder, so that each query reads them like landed responses, with the columns and
nested fields it needs.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cloudtally.session import work_folder
from cloudtally.sources.snapshots import save_snapshot

_LANDED: dict[str, StructType] = {}


def landed(spark: SparkSession, sf_dir: str, name: str, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """The documents ``build`` makes; written at the first call of an application, read at every call."""
    application = spark.sparkContext.applicationId
    folder = f"{work_folder(spark)}/cloudtally-landed/{application}/{quote(sf_dir, safe='')}"
    path = f"{folder}/{name}"
    if path not in _LANDED:
        documents = build(spark, sf_dir)
        save_snapshot(documents, folder, name)
        _LANDED[path] = spark.read.parquet(path).schema
    return spark.read.schema(_LANDED[path]).parquet(path)
