"""Landed pages kept as Parquet, each page read once.

``<store>/<entity>`` holds an entity's rows: those that grow by the month in partitions by month, those with a key in
versions. ``<store>/_ledger/<entity>`` has a row for each page file that a compaction took in, with its length and time:
a compaction lists the landed pages and reads those alone that the ledger does not have as they are now.

*Months.* New rows are added to their months, and only these months are written again, by dynamic partition overwrite;
other months' files stay as they are. Rows keep their page (``load_file``), so a page that landed anew, or that a run
which died had begun with, replaces its own rows. Items go by the cycle of their invoice; a page with items whose
invoice has not landed yet stays open, and is read again by the next compaction. Rows are shuffled once at most, items to
their invoices: new ones are then put down by month, in as many small files as it takes, and a month's tasks read its own
files, old and new.

*Dimensions.* A version holds one record per key, the one landed last. New pages are merged with the version before, so
history is not reduced again; records that no page has any more stay. Pages count in the order of their names, whenever
they landed. A page that changes makes the dimension anew from all pages.

*Rejects.* A line that is cut off or holds a value of the wrong type goes to ``<store>/_rejects/<entity>`` with its page,
block offset and place; more of them than ``max_rejects`` fail the compaction before it changes anything.

A page counts as taken in when its ledger row says ``done``, written last. One compaction runs at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cloudtally.functions import dates
from cloudtally.operators.lookup import latest_by_key
from cloudtally.sources import folders
from cloudtally.sources.landing import ENTITIES, LOAD_ORDER, LOAD_PLACE, load_order, with_load_place
from cloudtally.sources.runs import leased

CYCLE = "billing_cycle"
#: Entities that grow by the month, and the column of their month.
MONTHLY = {"account_usage": "month", "instance_usage": "month", "invoices": CYCLE, "invoice_items": CYCLE}
#: Entities with a key, which are kept as versions.
KEYED = {
    "resources": ["crn"],
    "tags": ["crn"],
    "cloud_users": ["iam_id"],
    "virtual_servers": ["crn"],
    "bare_metal_servers": ["crn"],
    "clusters": ["id"],
    "workers": ["id"],
    "images": ["id"],
    "initializations": ["id"],
    "vpcs": ["id"],
    "subnets": ["id"],
    "network_storage": ["id"],
    "classic_users": ["accountId", "id"],
    "hardware": ["id"],
    "allowed_storage": ["id"],
}
CORRUPT = "_corrupt_line"
#: Bytes that a month's rows are put into one file for.
FILE_BYTES = 128 << 20
_LEDGER = (
    "page string, length long, modified timestamp, batch long, state string, records long, rejects long, waiting long, "
    "months array<string>"
)


class TooManyRejects(ValueError):
    """More lines could not be read than a compaction may leave out."""


@dataclass(frozen=True)
class Compacted:
    """What a compaction of one entity took in: pages read, records kept, lines rejected, items without an invoice."""

    entity: str
    pages: int
    records: int = 0
    rejects: int = 0
    waiting: int = 0


def ledger(spark: SparkSession, store: str, entity: str) -> DataFrame:
    """The last row of each page."""
    folder = f"{store}/_ledger/{entity}"
    if not folders.exists(spark, folder):
        return spark.createDataFrame([], _LEDGER)
    rows = spark.read.schema(_LEDGER).parquet(folder)
    # Of one batch a page has the row of its beginning and that of its end.
    at = F.col("batch") * 2 + (F.col("state") != "begun").cast("long")
    return latest_by_key(rows.withColumn("at", at), ["page"], ["at"]).drop("at")


def rejects(spark: SparkSession, store: str, entity: str) -> DataFrame:
    """Rejected lines of the pages as they were taken in last: ``load_file``, ``load_offset``, ``load_row``, ``line``."""
    schema = "load_file string, load_offset long, load_row long, line string, batch long"
    folder = f"{store}/_rejects/{entity}"
    if not folders.exists(spark, folder):
        return spark.createDataFrame([], schema).drop("batch")
    known = ledger(spark, store, entity).filter("state != 'begun'").select(F.col("page").alias("load_file"), "batch")
    return spark.read.schema(schema).parquet(folder).join(known, ["load_file", "batch"], "left_semi").drop("batch")


def rejected_lines(spark: SparkSession, store: str, entity: str) -> int:
    """How many lines of an entity's pages are not in the store."""
    return ledger(spark, store, entity).filter("state != 'begun'").agg(F.sum("rejects")).first()[0] or 0


def _landed(spark: SparkSession, landing: str, entity: str) -> DataFrame:
    """``page`` (as rows name it), ``path``, ``length``, ``modified`` of all landed pages; no page is opened."""
    columns = ["page string", "path string", "length long", "modified timestamp"]
    try:
        files = spark.read.format("binaryFile").load(f"{landing}/{entity}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], ", ".join(columns))
        raise
    return files.select(
        F.col("_metadata.file_path").alias("page"),
        "path",
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def _parsed(spark: SparkSession, landing: str, entity: str, paths: Sequence[str]) -> DataFrame:
    """Lines of some pages, with their load order; one that could not be read has its text in ``CORRUPT``."""
    reader = spark.read.schema(f"{ENTITIES[entity]}, {CORRUPT} string").option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("basePath", f"{landing}/{entity}")
    return load_order(reader.json(list(paths)))


class _Batch:
    """The new pages of an entity, parsed once into the work folder, and their way into the store."""

    def __init__(self, spark: SparkSession, landing: str, store: str, entity: str, folder: str, every: bool = False):
        self.spark, self.store, self.entity, self.folder = spark, store, entity, folder
        self.known = ledger(spark, store, entity)
        # The paths of pages that are new since the last compaction: Spark's own listing of a read holds them too.
        listed = _landed(spark, landing, entity)
        done = self.known.filter("state = 'done'").select("page", "length", "modified")
        fresh = listed if every else listed.join(done, ["page", "length", "modified"], "left_anti")
        self.pages = fresh.collect()
        self.number = (self.known.agg(F.max("batch")).first()[0] or 0) + 1
        if self.pages:
            self.fresh = spark.createDataFrame([p.asDict() for p in self.pages], fresh.schema)
            self.old = self.known.join(self.fresh.select("page"), "page", "left_semi").collect()
            lines = _parsed(spark, landing, entity, [p.path for p in self.pages])
            lines.write.parquet(f"{self.folder}/lines")
            self.lines = spark.read.schema(lines.schema).parquet(f"{self.folder}/lines")
            self.records = self.lines.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)

    def refuse(self, most: int) -> int:
        """Write the lines that could not be read; raise if they are too many. Returns their number."""
        bad = self.lines.filter(F.col(CORRUPT).isNotNull()).select(*LOAD_ORDER, F.col(CORRUPT).alias("line"))
        count = bad.count()
        if count:
            folder = f"{self.store}/_rejects/{self.entity}/batch={self.number}"
            bad.write.mode("overwrite").parquet(folder)
            if count > most:
                first = bad.orderBy(*LOAD_ORDER).first()
                raise TooManyRejects(
                    f"{count} lines of {self.entity} could not be read (allowed: {most}); the first is in "
                    f"{first.load_file} after byte {first.load_offset}; all are in {folder}"
                )
        return count

    def note(self, state: str, rows: DataFrame, month: str | None = None, waiting: DataFrame | None = None) -> None:
        """Ledger rows of the batch's pages: what each of them holds, and its state."""
        months = F.collect_set(F.col(month)) if month else F.array().cast("array<string>")
        kept = rows.groupBy(F.col("load_file").alias("page")).agg(F.count("*").alias("records"), months.alias("months"))
        bad = self.lines.filter(F.col(CORRUPT).isNotNull()).groupBy(F.col("load_file").alias("page"))
        out = self.fresh.join(kept, "page", "left").join(bad.agg(F.count("*").alias("rejects")), "page", "left")
        if waiting is None:
            out = out.withColumn("waiting", F.lit(0))
        else:
            open_ = waiting.groupBy(F.col("load_file").alias("page")).agg(F.count("*").alias("waiting"))
            out = out.join(open_, "page", "left")
        zero = F.lit(0).cast("long")
        ended = F.when(F.coalesce("waiting", zero) > 0, "waiting").otherwise(state) if state == "done" else F.lit(state)
        out.select(
            "page",
            "length",
            "modified",
            F.lit(self.number).cast("long").alias("batch"),
            ended.alias("state"),
            *[F.coalesce(c, zero).cast("long").alias(c) for c in ("records", "rejects", "waiting")],
            F.coalesce("months", F.array().cast("array<string>")).alias("months"),
        ).coalesce(1).write.mode("append").parquet(f"{self.store}/_ledger/{self.entity}")


def _with_cycle(rows: DataFrame) -> DataFrame:
    created = dates.local_time(dates.required_instant(F.col("createDate")))
    return rows.withColumn(CYCLE, dates.billing_month(created))


def _by_invoice(spark: SparkSession, store: str) -> Callable[[DataFrame], DataFrame]:
    """Items get the cycle of their invoice; null if it has not landed."""

    def add(rows: DataFrame) -> DataFrame:
        if not folders.exists(spark, f"{store}/invoices"):
            return rows.withColumn(CYCLE, F.lit(None).cast("string"))
        invoices = spark.read.schema(f"id long, {CYCLE} string").parquet(f"{store}/invoices")
        cycles = invoices.groupBy(F.col("id").alias("_invoice")).agg(F.min(CYCLE).alias(CYCLE))
        # Hashed at any size, as there are as many as invoices: items, with all their children, are not sorted.
        return rows.join(cycles.hint("shuffle_hash"), F.col("invoiceId") == F.col("_invoice"), "left").drop("_invoice")

    return add


def _month_by_month(tables: Sequence[tuple[DataFrame, Callable[[DataFrame], DataFrame]]], month: str) -> DataFrame:
    """Rows of tables that lie by month, each with what is done to its rows: each month in tasks of its own, one for
    ``FILE_BYTES`` of files, so that none are shuffled. Two tasks at least: Spark unites tables of one task in one task."""
    files = [t.select(month, "_metadata.file_path", "_metadata.file_size").distinct() for t, _ in tables]
    sizes = reduce(DataFrame.unionAll, files).groupBy(month).agg(F.sum("file_size").alias("size")).collect()
    months = []
    for value, size in sizes:
        own = [pick(t.filter(F.col(month).eqNullSafe(F.lit(value)))) for t, pick in tables]
        months.append(reduce(DataFrame.unionAll, own).coalesce(max(2, -(-size // FILE_BYTES))))
    return reduce(DataFrame.unionAll, months) if months else tables[0][0]


def _add_months(batch: _Batch, month: str, place: Callable[[DataFrame], DataFrame], most: int, open_pages: bool) -> Compacted:
    spark, path = batch.spark, f"{batch.store}/{batch.entity}"
    bad = batch.refuse(most)
    rows = place(batch.records).drop("load_offset", "load_row")
    rows.write.partitionBy(month).parquet(f"{batch.folder}/rows")
    columns = [*[c for c in rows.columns if c != month], month]
    rows = spark.read.schema(rows.select(*columns).schema).parquet(f"{batch.folder}/rows")
    waiting = rows.filter(F.col(month).isNull()) if open_pages else None
    if open_pages:
        rows = rows.filter(F.col(month).isNotNull())
    batch.note("begun", rows, month)
    # One row per month: those that get rows, and those that hold rows of an earlier state of a page.
    held = {m for page in batch.old for m in page.months}
    new = {r[0] for r in rows.select(month).distinct().collect()}
    touched = left = held | new
    tables = [(rows, lambda own: own)]
    if folders.exists(spark, path):
        before = spark.read.schema(rows.schema).parquet(path)
        before = before.filter(F.col(month).isin(sorted(m for m in touched if m is not None)) | (
            F.col(month).isNull() if None in touched else F.lit(False)))
        pages = F.broadcast(batch.fresh.select(F.col("page").alias("load_file")))
        keep = lambda own: own.join(pages, "load_file", "left_anti").select(*columns)
        tables.append((before, keep))
        if held - new:
            left = new | {r[0] for r in keep(before).select(month).distinct().collect()}
    whole = _month_by_month(tables, month)
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path)
    for gone in touched - left:
        folders.delete(spark, f"{path}/{month}={'__HIVE_DEFAULT_PARTITION__' if gone is None else gone}")
    batch.note("done", rows, month, waiting)
    return Compacted(batch.entity, len(batch.pages), rows.count(), bad, waiting.count() if open_pages else 0)


def add_months(spark: SparkSession, landing: str, store: str, entity: str, max_rejects: int = 0) -> Compacted:
    """Take new pages of an entity that grows by the month into its months. Invoices go before their items."""
    with leased(spark, "compaction") as folder:
        batch = _Batch(spark, landing, store, entity, folder)
        if not batch.pages:
            return Compacted(entity, 0)
        items = entity == "invoice_items"
        place = _by_invoice(spark, store) if items else _with_cycle if entity == "invoices" else (lambda rows: rows)
        return _add_months(batch, MONTHLY[entity], place, max_rejects, items)


def merge_dimension(spark: SparkSession, landing: str, store: str, entity: str, max_rejects: int = 0) -> Compacted:
    """Merge new pages of an entity with a key into a new version of it; the one before goes when it is written."""
    with leased(spark, "compaction") as folder:
        batch = _Batch(spark, landing, store, entity, f"{folder}/new")
        if not batch.pages:
            return Compacted(entity, 0)
        changed = any(page.state == "done" for page in batch.old)
        if changed:
            batch = _Batch(spark, landing, store, entity, f"{folder}/all", every=True)
        bad, rows = batch.refuse(max_rejects), batch.records
        now, path = _version(spark, store, entity), f"{store}/{entity}"
        if now and not changed:
            rows = spark.read.schema(rows.schema).parquet(f"{path}/version={now}").unionByName(rows)
        merged = latest_by_key(with_load_place(rows), KEYED[entity], [LOAD_PLACE]).select(*rows.columns)
        merged.write.mode("overwrite").parquet(f"{path}/version={batch.number}")
        batch.note("done", batch.records)
        for name in folders.children(spark, path):
            if name.startswith("version=") and int(name.partition("=")[2]) < now:
                folders.delete(spark, f"{path}/{name}")
        return Compacted(entity, len(batch.pages), batch.records.count(), bad)


def _version(spark: SparkSession, store: str, entity: str) -> int:
    """The last version whose pages are in the ledger; 0 if there is none."""
    return ledger(spark, store, entity).filter("state = 'done'").agg(F.max("batch")).first()[0] or 0


def has_dimension(spark: SparkSession, store: str, entity: str) -> bool:
    """Whether the store keeps a version of an entity."""
    return _version(spark, store, entity) > 0


def read_dimension(spark: SparkSession, store: str, entity: str, load_columns: bool = False) -> DataFrame:
    """One record per key, the one landed last; ``load_columns`` adds where it came from."""
    schema = StructType.fromDDL(ENTITIES[entity])
    for name, kind in zip(LOAD_ORDER, ("string", "long", "long")):
        schema = schema.add(name, kind) if load_columns else schema
    now = _version(spark, store, entity)
    if not now:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{store}/{entity}/version={now}")


def compact(
    spark: SparkSession, landing: str, store: str, max_rejects: int = 0, dimensions: bool = False
) -> dict[str, Compacted]:
    """Take all new pages into the store: the entities by month, and with ``dimensions`` those with a key.

    ``max_rejects`` is how many lines of an entity may be left out; they are kept in the store's rejects.
    """
    out = {}
    for entity in MONTHLY:
        out[entity] = add_months(spark, landing, store, entity, max_rejects)
    for entity in KEYED if dimensions else ():
        out[entity] = merge_dimension(spark, landing, store, entity, max_rejects)
    return out


def read_months(spark: SparkSession, store: str, entity: str, first: str, last: str) -> DataFrame:
    """An entity's rows in the partitions from month ``first`` to ``last`` alone."""
    month = MONTHLY[entity]
    schema = StructType.fromDDL(ENTITIES[entity])
    if month not in schema.names:
        schema = schema.add(month, "string")
    if not folders.exists(spark, f"{store}/{entity}"):
        rows = spark.createDataFrame([], schema)
    else:
        rows = spark.read.schema(schema).parquet(f"{store}/{entity}").filter(F.col(month).between(first, last))
    return rows.drop(CYCLE) if month == CYCLE else rows
