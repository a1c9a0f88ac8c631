"""Reports on account and instance usage."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudtally.functions.charges import QUANTITY
from cloudtally.operators.partials import Pivot
from cloudtally.operators.pivot import Measure, totals_within
from cloudtally.plans.usage import BARE_METAL, KUBERNETES, VIRTUAL_SERVER, VOLUME

# Fixed values, here and below: key lists and report names are the columns and names of the output.
OBJECT_STORAGE = "Cloud Object Storage"
VOLUME_METRIC = "GIGABYTE_HOURS"
_MONEY_COLUMNS = ["quantity", "cost", "rated_cost"]

_COST = Measure("cost")
_RATED = Measure("rated_cost")
_QUANTITY = Measure("quantity")
_INSTANCES = Measure("instance_count", "distinct", "instance_id")


def _exact(rows: DataFrame) -> DataFrame:
    """Amounts as decimals, so that a sum does not depend on the order of its rows."""
    return rows.withColumns({c: F.col(c).cast(QUANTITY) for c in _MONEY_COLUMNS if c in rows.columns})


def _servers(usage: DataFrame) -> DataFrame:
    return usage.filter(F.col("service_id").isin(VIRTUAL_SERVER, BARE_METAL))


def charges_by_server_month(usage: DataFrame) -> DataFrame:
    """Server charges of each month; a total per month."""
    keys = ["region", "service_name", "instance_role", "instance_name", "instance_id", "instance_profile"]
    return _monthly_totals(_servers(usage), keys)


def charges_by_volume_month(usage: DataFrame) -> DataFrame:
    rows = usage.filter((F.col("service_id") == VOLUME) & (F.col("metric") == VOLUME_METRIC))
    keys = ["region", "service_name", "resource_group_name", "instance_name", "instance_id", "capacity", "iops"]
    return _monthly_totals(rows, keys)


def _monthly_totals(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rated cost and cost by key within each month, with one total row per month."""
    return totals_within(_exact(rows), "month", keys, ["rated_cost", "cost"])


def _of_service(*services: str) -> Callable[[DataFrame], DataFrame]:
    return lambda usage: _exact(usage.filter(F.col("service_id").isin(*services)))


def _sized_volumes(usage: DataFrame) -> DataFrame:
    """Volumes by place and size; an unknown size is the key ''."""
    sizes = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("volume_iops", "volume_capacity")}
    return _exact(usage.filter(F.col("service_id") == VOLUME).withColumns(sizes))


def _object_storage(usage: DataFrame) -> DataFrame:
    return _exact(usage.filter(F.col("service_name") == OBJECT_STORAGE))


_PLACE = ["region", "vpc", "zone", "resource_group_name", "instance_profile"]
#: Reports on account usage by the month.
CLOUD_USAGE = Pivot("Cloud_Usage", _exact, ["resource_name"], [_RATED, _COST], "month")
USAGE = Pivot("UsageSummary", _exact, ["resource_name"], [_COST], "month")
METRIC_PLANS = Pivot("MetricPlanSummary", _exact, ["resource_name", "plan_name", "metric"], [_QUANTITY, _COST], "month")
#: Reports on instance usage by the month.
VIRTUAL_SERVERS = Pivot("VirtualServerSummary", _of_service(VIRTUAL_SERVER), _PLACE, [_INSTANCES, _COST], "month")
BARE_METAL_SERVERS = Pivot("BMServerSummary", _of_service(BARE_METAL), _PLACE, [_INSTANCES, _COST], "month")
SERVER_LIST = Pivot(
    "ServerList", _of_service(VIRTUAL_SERVER, BARE_METAL),
    ["region", "vpc", "instance_name", "instance_id", "instance_profile"], [_COST], "month",
)
SERVERS_BY_USER = Pivot(
    "ServersByUser", _of_service(VIRTUAL_SERVER, BARE_METAL),
    ["created_by_name", "region", "vpc", "instance_name", "service_name", "instance_profile", "provision_date",
     "deprovision_date", "instance_state"], [_COST], "month",
)
VOLUMES = Pivot(
    "VolumesSummary", _sized_volumes, ["region", "zone", "resource_group_name", "volume_iops", "volume_capacity"],
    [_INSTANCES, _COST], "month",
)
BUCKETS = Pivot(
    "COSBuckets", _object_storage, ["region", "resource_group_name", "instance_name", "plan_name", "metric", "unit"],
    [_QUANTITY, _COST], "month",
)
CLUSTERS = Pivot(
    "KubernetesSummary", _of_service(KUBERNETES),
    ["region", "vpc", "cluster_name", "worker_pool", "worker_name", "zone", "worker_flavor", "created_by_name",
     "instance_state"], [_COST], "month",
)
ACCOUNT_PIVOTS = [USAGE, METRIC_PLANS]
INSTANCE_PIVOTS = [VIRTUAL_SERVERS, BARE_METAL_SERVERS, SERVER_LIST, SERVERS_BY_USER, VOLUMES, BUCKETS, CLUSTERS]


def cloud_usage_summary(usage: DataFrame, months: Sequence[str]) -> DataFrame:
    return CLOUD_USAGE.report(usage, months)


def usage_summary(usage: DataFrame, months: Sequence[str]) -> DataFrame:
    return USAGE.report(usage, months)


def metric_plan_summary(usage: DataFrame, months: Sequence[str]) -> DataFrame:
    return METRIC_PLANS.report(usage, months)


def server_list(usage: DataFrame, months: Sequence[str]) -> DataFrame:
    return SERVER_LIST.report(usage, months)


def servers_by_user(usage: DataFrame, months: Sequence[str]) -> DataFrame:
    return SERVERS_BY_USER.report(usage, months)


def object_storage_instances(usage: DataFrame, months: Sequence[str]) -> DataFrame:
    return BUCKETS.report(usage, months)


def virtual_server_summary(usage: DataFrame, months: Sequence[str]) -> DataFrame:
    return VIRTUAL_SERVERS.report(usage, months)


def bare_metal_summary(usage: DataFrame, months: Sequence[str]) -> DataFrame:
    return BARE_METAL_SERVERS.report(usage, months)


def volumes_summary(usage: DataFrame, months: Sequence[str]) -> DataFrame:
    return VOLUMES.report(usage, months)


def kubernetes_summary(usage: DataFrame, months: Sequence[str]) -> DataFrame:
    return CLUSTERS.report(usage, months)


def usage_report_set(
    account: DataFrame, instances: DataFrame, months: Sequence[str], users: DataFrame | None = None
) -> dict[str, Callable[[], DataFrame]]:
    """All usage reports by name, built when asked for."""
    reports: dict[str, Callable[[], DataFrame]] = {
        "ServiceUsageDetail": lambda: account,
        "Instances_Detail": lambda: instances,
        "UsageSummary": lambda: usage_summary(account, months),
        "MetricPlanSummary": lambda: metric_plan_summary(account, months),
        "VirtualServerSummary": lambda: virtual_server_summary(instances, months),
        "BMServerSummary": lambda: bare_metal_summary(instances, months),
        "ServerList": lambda: server_list(instances, months),
        "ServersByUser": lambda: servers_by_user(instances, months),
        "VolumesSummary": lambda: volumes_summary(instances, months),
        "COSBuckets": lambda: object_storage_instances(instances, months),
        "KubernetesSummary": lambda: kubernetes_summary(instances, months),
    }
    if users is not None:
        reports["Users"] = lambda: users
    return reports


def billing_usage_report_set(
    account: DataFrame, instances: DataFrame, months: Sequence[str]
) -> dict[str, Callable[[], DataFrame]]:
    """The usage reports that go with an invoice report, for the months its usage took place."""
    return {
        "Cloud_Usage": lambda: cloud_usage_summary(account, months),
        "VPC_Servers": lambda: charges_by_server_month(instances),
        "VPC_Volumes": lambda: charges_by_volume_month(instances),
    }
