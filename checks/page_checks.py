"""Queries on landed JSON pages: the documents of the other checks as page files, taken into a store in two rounds.

Of each keyed entity an older record lands first, with nothing but its key (resources: with another creator), in pages
that sort before those of the record that counts; some pages of it land in the second round. Entities that grow by the
month land half of their documents in each round. What is read back must give the rows of the check on the documents.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import billing_checks, inventory_checks, usage_checks  # noqa: F401  (their SQL is registered before)
from checks import billing_views as billing
from checks import usage_views as views
from checks.registry import ORACLES, check
from checks.tables import table
from cloudtally.plans import inventory, storage, usage
from cloudtally.plans.invoice_lines import invoice_lines
from cloudtally.plans.invoice_reports import account_detail, classic_users
from cloudtally.session import work_folder
from cloudtally.sources import store
from cloudtally.sources.landing import LOAD_ORDER, read_entity, read_in_load_order, read_latest

DOCUMENTS = {
    "invoices": billing.invoices,
    "invoice_items": billing.items,
    "account_usage": views.account_documents,
    "instance_usage": views.event_documents,
    "resources": views.landed_resources,
    "tags": views.tags,
    "cloud_users": views.user_documents,
    "user_roles": views.role_documents,
    "virtual_servers": lambda spark, sf_dir: views.servers(spark, sf_dir).filter("NOT bare_metal"),
    "bare_metal_servers": lambda spark, sf_dir: views.servers(spark, sf_dir).filter("bare_metal"),
    "clusters": views.cluster_documents,
    "workers": views.worker_documents,
    "images": views.images,
    "initializations": views.initializations,
    "vpcs": views.vpcs,
    "subnets": views.subnets,
    "network_storage": billing.volumes,
    "account": inventory_checks.account_records,
    "classic_users": inventory_checks.user_records,
    "hardware": inventory_checks.hardware,
    "trunks": inventory_checks.trunks,
    "allowed_storage": inventory_checks.allowed_storage,
    "fetch_errors": inventory_checks.errors,
}
PAGES = 3
_TAKEN: set[str] = set()


def _land(spark: SparkSession, documents: DataFrame, folder: str, name: str, grows: bool = False) -> None:
    """Documents (sorted by ``_order``, if they have it) as page files ``<name>-<number>.json.gz``, as many as they have
    tasks if they grow by the month (they are landed in many files), else ``PAGES``."""
    part = f"{work_folder(spark)}/cloudtally-pages/parts-{uuid.uuid4().hex}"
    if "_order" in documents.columns:
        documents = documents.repartitionByRange(PAGES, "_order").sortWithinPartitions("_order").drop("_order")
    elif not grows:
        documents = documents.repartition(PAGES)
    documents.write.option("compression", "gzip").json(part)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(part).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(folder))
    files = sorted(s.getPath().getName() for s in system.listStatus(path(part)) if s.getPath().getName().startswith("part-"))
    for number, file in enumerate(files):
        system.rename(path(f"{part}/{file}"), path(f"{folder}/{name}-{number:04}.json.gz"))


def _rounds(entity: str, documents: DataFrame) -> list[DataFrame]:
    if entity == "resources":
        return [documents.filter("seq = 0").drop("seq"), documents.filter("seq = 1").drop("seq")]
    if entity in store.KEYED:
        keys = store.KEYED[entity]
        return [documents.select(*keys), documents]
    if entity == "user_roles":
        return [documents.withColumnRenamed("seq", "_order")]
    if entity in store.MONTHLY:
        whole = F.pmod(F.xxhash64(documents.columns[0]), F.lit(2))
        return [documents.filter(whole == n) for n in range(2)]
    return [documents]


def landed_pages(spark: SparkSession, sf_dir: str, entity: str, taken: bool = True) -> tuple[str, str]:
    """Landing and store; the entity landed, and taken into the store round by round, once an application."""
    root = f"{work_folder(spark)}/cloudtally-pages/{spark.sparkContext.applicationId}/{uuid.uuid5(uuid.NAMESPACE_URL, sf_dir)}"
    landing, kept = f"{root}/landing", f"{root}/store"
    if f"{root}/{entity}" not in _TAKEN:
        if entity == "invoice_items":
            landed_pages(spark, sf_dir, "invoices")
        for number, documents in enumerate(_rounds(entity, DOCUMENTS[entity](spark, sf_dir))):
            _land(spark, documents, f"{landing}/{entity}", f"round-{number}", entity in store.MONTHLY)
            if entity in store.MONTHLY:
                store.add_months(spark, landing, kept, entity)
            elif entity in store.KEYED:
                store.merge_dimension(spark, landing, kept, entity)
        _TAKEN.add(f"{root}/{entity}")
    return landing, kept


def months(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return store.read_months(spark, landed_pages(spark, sf_dir, entity)[1], entity, "0000-00", "9999-99")


def latest(spark: SparkSession, sf_dir: str, entity: str, load_columns: bool = False) -> DataFrame:
    return store.read_dimension(spark, landed_pages(spark, sf_dir, entity)[1], entity, load_columns)


def records(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return read_entity(spark, landed_pages(spark, sf_dir, entity)[0], entity)


@check("paged_invoice_lines", ORACLES["join_storage_notes"])
def _(spark, sf_dir):
    lines = invoice_lines(
        months(spark, sf_dir, "invoices"), months(spark, sf_dir, "invoice_items"), latest(spark, sf_dir, "network_storage")
    )
    return lines.select("Portal_Invoice_Number", "BillingItemId", "childBillingItemId", "storage_notes")


@check("paged_account_usage", ORACLES["service_usage_detail"])
def _(spark, sf_dir):
    return usage.account_usage(months(spark, sf_dir, "account_usage"))


@check("paged_instance_usage", ORACLES["flatten_instance_usage"])
def _(spark, sf_dir):
    rows = usage.metric_rows(usage.instance_months(months(spark, sf_dir, "instance_usage")))
    return rows.select("instance_id", "month", "service_id", "metric", "quantity", "cost")


@check("paged_resources", ORACLES["latest_by_key"])
def _(spark, sf_dir):
    return latest(spark, sf_dir, "resources").select("crn", "resource_id", "created_by", "state")


@check("reread_resources", ORACLES["latest_by_key"])
def _(spark, sf_dir):
    """All pages at once, without a store."""
    landing, _ = landed_pages(spark, sf_dir, "resources")
    return read_latest(spark, landing, "resources", "crn").select("crn", "resource_id", "created_by", "state")


def paged_users(spark, sf_dir):
    landing, _ = landed_pages(spark, sf_dir, "user_roles")
    roles = read_in_load_order(spark, landing, "user_roles").withColumn("place", F.struct(*LOAD_ORDER))
    return usage.cloud_users(latest(spark, sf_dir, "cloud_users"), roles, "place")


@check("paged_cloud_users", ORACLES["cloud_users"])
def _(spark, sf_dir):
    return paged_users(spark, sf_dir)


@check("paged_instances_detail", ORACLES["instances_detail"])
def _(spark, sf_dir):
    """Tags, servers, images, initialisations, clusters, workers and networks too come from their pages."""
    servers = usage.union_servers(latest(spark, sf_dir, "virtual_servers"), latest(spark, sf_dir, "bare_metal_servers"))
    dimension = usage.instance_dimension(
        latest(spark, sf_dir, "resources"), latest(spark, sf_dir, "tags"), paged_users(spark, sf_dir), servers,
        latest(spark, sf_dir, "images"), latest(spark, sf_dir, "initializations"),
    )
    clusters = usage.named_clusters(latest(spark, sf_dir, "clusters"), latest(spark, sf_dir, "vpcs"))
    workers = usage.named_workers(latest(spark, sf_dir, "workers"), clusters, latest(spark, sf_dir, "subnets"))
    return usage.metric_rows(usage.enriched_instances(months(spark, sf_dir, "instance_usage"), dimension, clusters, workers))


@check("paged_accounts", ORACLES["account_detail"])
def _(spark, sf_dir):
    return account_detail(records(spark, sf_dir, "account"))


@check("paged_classic_users", ORACLES["classic_users"])
def _(spark, sf_dir):
    return classic_users(latest(spark, sf_dir, "classic_users"))


@check("paged_hardware", ORACLES["hardware_components"])
def _(spark, sf_dir):
    return inventory.hardware_components(latest(spark, sf_dir, "hardware"))


@check("paged_trunks", ORACLES["server_report_trunks"])
def _(spark, sf_dir):
    report = inventory.server_report(
        latest(spark, sf_dir, "hardware"), records(spark, sf_dir, "trunks"), latest(spark, sf_dir, "allowed_storage")
    )
    return report.filter("section = 1").select("id", "line", "value")


@check("paged_storage", ORACLES["hardware_storage_nested"])
def _(spark, sf_dir):
    accounts = inventory_checks.accounts(spark, sf_dir)
    return storage.account_records(accounts, latest(spark, sf_dir, "allowed_storage"), records(spark, sf_dir, "fetch_errors"))


@check(
    "rejected_lines",
    """SELECT 'torn' AS kind, 2 * count(*) AS records, count(*) AS lines FROM nation
    UNION ALL SELECT 'mistyped', count(*), count(*) FILTER (n_nationkey % 2 = 0) FROM nation""",
)
def _(spark, sf_dir):
    """Good lines beside torn and mistyped ones: the good ones are records, the others are kept apart, line by line."""
    root = f"{work_folder(spark)}/cloudtally-pages/rejects-{uuid.uuid4().hex}"
    image = """'{"id": "img-', n_nationkey, '", "operating_system": {"name": "', n_name, '"}}'"""
    lines = {
        "images": f"array(concat({image}), substring(concat({image}), 1, 30), replace(concat({image}), 'img', 'other'))",
        "vpcs": """if(n_nationkey % 2 = 0, array(concat('{"id": "v', n_nationkey, '", "name": "n"}'),
          concat('{"id": ["v', n_nationkey, '"], "name": 1, "x": ')), array(concat('{"id": "v', n_nationkey, '"}')))""",
    }
    found = []
    for (entity, text), kind in zip(lines.items(), ("torn", "mistyped")):
        rows = table(spark, sf_dir, "nation").selectExpr(f"explode({text}) AS value")
        rows.write.text(f"{root}/landing/{entity}")
        store.merge_dimension(spark, f"{root}/landing", f"{root}/store", entity, max_rejects=10**6)
        kept = store.read_dimension(spark, f"{root}/store", entity)
        left = store.rejects(spark, f"{root}/store", entity)
        found += [rows.select(F.lit(kind).alias("kind"), F.lit(good).alias("good")) for rows, good in ((kept, True), (left, False))]
    good = F.col("good").cast("long")
    both = reduce(DataFrame.unionAll, found).groupBy("kind")
    return both.agg(F.sum(good).alias("records"), F.sum(1 - good).alias("lines"))
