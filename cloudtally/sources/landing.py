"""Typed reads of landed API responses: one folder per entity, its page files read as one table.

Responses land as JSON lines. A line that is cut off, or holds a value of the wrong type, fails the read: no record goes
missing. ``load_order`` columns rank repeated records of a key (last one wins).
"""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloudtally import schemas
from cloudtally.functions.text import first_csv_column
from cloudtally.operators.lookup import latest_by_key
from cloudtally.session import work_folder

ENTITIES: dict[str, str] = {
    "invoices": schemas.INVOICES,
    "invoice_items": schemas.INVOICE_ITEMS,
    "account_usage": schemas.ACCOUNT_USAGE,
    "instance_usage": schemas.INSTANCE_USAGE,
    "resources": schemas.RESOURCES,
    "tags": schemas.TAGS,
    "cloud_users": schemas.CLOUD_USERS,
    "user_roles": schemas.USER_ROLES,
    "virtual_servers": schemas.SERVERS,
    "bare_metal_servers": schemas.SERVERS,
    "clusters": schemas.CLUSTERS,
    "workers": schemas.WORKERS,
    "images": schemas.IMAGES,
    "initializations": schemas.INITIALIZATIONS,
    "vpcs": schemas.NETWORKS,
    "subnets": schemas.NETWORKS,
    "network_storage": schemas.NETWORK_STORAGE,
    "account": schemas.ACCOUNT,
    "classic_users": schemas.CLASSIC_USERS,
    "hardware": schemas.HARDWARE,
    "trunks": schemas.TRUNKS,
    "allowed_storage": schemas.ALLOWED_STORAGE,
    "fetch_errors": schemas.FETCH_ERRORS,
}

LOAD_ORDER = ["load_file", "load_offset", "load_row"]
LOAD_PLACE = "load_place"


def _pages(spark: SparkSession, folder: str, entity: str) -> DataFrame | None:
    try:
        return spark.read.schema(ENTITIES[entity]).option("mode", "FAILFAST").json(f"{folder}/{entity}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_entity(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    """All landed pages of an entity. A month, region or whole entity without a file has no rows."""
    pages = _pages(spark, folder, entity)
    return spark.createDataFrame([], ENTITIES[entity]) if pages is None else pages


def load_order(pages: DataFrame) -> DataFrame:
    """A read of page files with the load order of each record: file name, block offset, place in the task's share.

    The place holds for this one read. Name page files so that they sort in load order.
    """
    return pages.select(
        *pages.columns,
        F.col("_metadata.file_path").alias("load_file"),
        F.col("_metadata.file_block_start").alias("load_offset"),
        F.monotonically_increasing_id().alias("load_row"),
    )


def read_in_load_order(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    """The pages with the load order of each record."""
    pages = _pages(spark, folder, entity)
    if pages is None:
        return spark.createDataFrame([], f"{ENTITIES[entity]}, load_file string, load_offset long, load_row long")
    return load_order(pages)


def with_load_place(rows: DataFrame) -> DataFrame:
    """Adds the load order of a written table as one number (``load_place``): rank of the file's name, offset, place.

    The names go through the driver, as many as it lists for a read of the pages, and back to each task. The hint is for
    that side: Spark takes a list from the driver for endless, and would broadcast all records instead.
    """
    files = sorted(r[0] for r in rows.select("load_file").distinct().collect())
    ranks = rows.sparkSession.createDataFrame(list(enumerate(files)), "_rank long, load_file string")
    number = "decimal(38,0)"
    place = F.col("_rank").cast(number) * F.lit(f"1{0:024}").cast("decimal(25,0)")
    place = place + F.col("load_offset").cast(number) * F.lit(10**11).cast("decimal(12,0)") + F.col("load_row")
    return rows.join(F.broadcast(ranks), "load_file").withColumn(LOAD_PLACE, place.cast(number)).drop("_rank")


def read_latest(spark: SparkSession, folder: str, entity: str, key: str, staging: str | None = None) -> DataFrame:
    """One record per key, the one landed last.

    The pages are parsed once into ``staging`` (a folder of the work folder), as two reads follow: keys, then records.
    """
    staging = staging or f"{work_folder(spark)}/cloudtally/latest-{uuid.uuid4().hex}"
    pages = read_in_load_order(spark, folder, entity)
    pages.write.parquet(f"{staging}/{entity}")
    rows = spark.read.schema(pages.schema).parquet(f"{staging}/{entity}")
    return latest_by_key(with_load_place(rows), [key], [LOAD_PLACE]).select(*[c for c in rows.columns if c not in LOAD_ORDER])


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    """Account list: the first column of each line that is not blank."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(first_csv_column(F.col("value")).alias("accountId"))


def bundled_part_descriptions() -> str:
    return (Path(__file__).parent.parent / "data" / "part_descriptions.txt").as_uri()


def parse_part_descriptions(lines: DataFrame) -> DataFrame:
    """``code: description`` lines (``value``, in the order ``load_offset``, ``load_row``); comments are skipped."""
    entry = lines.filter((F.instr("value", ": ") > 0) & ~F.startswith(F.col("value"), F.lit("#")))
    parts = entry.select(
        F.trim(F.substring_index("value", ": ", 1)).alias("part_code"),
        F.trim(F.substr("value", F.instr("value", ": ") + 2)).alias("description"),
        "load_offset",
        "load_row",
    )
    return latest_by_key(parts, ["part_code"], ["load_offset", "load_row"]).drop("load_offset", "load_row")


def read_part_descriptions(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Part code -> description; a code listed twice takes its last description."""
    lines = spark.read.text(path or bundled_part_descriptions())
    return parse_part_descriptions(
        lines.select(
            "value",
            F.col("_metadata.file_block_start").alias("load_offset"),
            F.monotonically_increasing_id().alias("load_row"),
        )
    )
