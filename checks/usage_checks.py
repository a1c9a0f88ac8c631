"""Usage queries: flattening, lookups and the reports on usage rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.billing_views import MONTHS
from checks.registry import check, pivot_sql
from checks.tables import all_within, duck, table
from checks.usage_views import (
    ACCOUNT_CTE, EVENT_BASE, INSTANCE_CTE, RESOURCE_BASE, TAG_SQL, USERS_SQL, WEEKS, account_documents,
    billing_instances, clusters, cloud_users, event_documents, images, initializations, instances, landed_resources,
    resources, servers, tags, workers,
)
from cloudtally.functions import nested, text
from cloudtally.operators.lookup import latest_by_key
from cloudtally.plans import usage, usage_reports as reports

INSTANCES = f"WITH {INSTANCE_CTE}"
COST = "CAST(SUM([cost_cents]) AS DOUBLE) / 100"
RATED = "CAST(SUM([rated_cents]) AS DOUBLE) / 100"


# --- account usage --------------------------------------------------------------------------------------------

_ACCOUNT_SQL = f"WITH {ACCOUNT_CTE} SELECT * EXCLUDE (cost_cents, rated_cents, units) FROM account_row"


@check("service_usage_detail", _ACCOUNT_SQL)
def _(spark, sf_dir):
    return usage.account_usage(account_documents(spark, sf_dir))


@check(
    "flatten_account_usage",
    f"WITH {ACCOUNT_CTE} SELECT account_id, month, resource_id, plan_id, metric, quantity, cost FROM account_row",
)
def _(spark, sf_dir):
    rows = usage.account_usage(account_documents(spark, sf_dir))
    return rows.select("account_id", "month", "resource_id", "plan_id", "metric", "quantity", "cost")


@check(
    "discount_price",
    f"WITH {ACCOUNT_CTE} SELECT month, resource_id, metric, discount, price FROM account_row",
)
def _(spark, sf_dir):
    rows = usage.account_usage(account_documents(spark, sf_dir))
    return rows.select("month", "resource_id", "metric", "discount", "price")


_UNITS = "CAST(SUM([units]) AS DOUBLE)"
for _name, _build, _keys, _cells in [
    ("cloud_usage_summary", reports.cloud_usage_summary, ["resource_name"], {"rated_cost": RATED, "cost": COST}),
    ("usage_summary", reports.usage_summary, ["resource_name"], {"cost": COST}),
    ("metric_plan_summary", reports.metric_plan_summary, ["resource_name", "plan_name", "metric"],
     {"quantity": _UNITS, "cost": COST}),
]:

    @check(_name, pivot_sql(ACCOUNT_CTE, "SELECT * FROM account_row", _keys, _cells, "month", MONTHS))
    def _(spark, sf_dir, build=_build):
        return build(all_within(usage.account_usage(account_documents(spark, sf_dir)), "month", MONTHS), MONTHS)


# --- instance usage -------------------------------------------------------------------------------------------

_EVENT_CTE = f"event_doc AS ({duck(EVENT_BASE)})"


@check(
    "flatten_instance_usage",
    f"""WITH {_EVENT_CTE} SELECT instance_id, month, service_id, CASE WHEN m = 0 THEN 'GIGABYTE_HOURS' ELSE 'VCPU_HOURS' END
    AS metric, amount * 4 + m AS quantity, amount * (m + 1) AS cost
    FROM event_doc, (SELECT range AS m FROM range(2)) AS numbers WHERE m < n_metrics""",
)
def _(spark, sf_dir):
    rows = usage.metric_rows(usage.instance_months(event_documents(spark, sf_dir)))
    return rows.select("instance_id", "month", "service_id", "metric", "quantity", "cost")


@check(
    "filter_enrichable",
    f"""WITH {_EVENT_CTE} SELECT instance_id, month, service_id FROM event_doc
    WHERE NOT contains(service_id, 'classic_infrastructure')""",
)
def _(spark, sf_dir):
    rows = usage.instance_months(event_documents(spark, sf_dir))
    return rows.filter(usage.enrichable(F.col("service_id"))).select("instance_id", "month", "service_id")


@check(
    "cluster_worker_split",
    f"""WITH {_EVENT_CTE} SELECT instance_name, split_part(instance_name, '_', 1) AS cluster_id,
    CASE WHEN contains(instance_name, '_') THEN split_part(instance_name, '_', 2) ELSE instance_name END AS worker_name
    FROM event_doc""",
)
def _(spark, sf_dir):
    name = F.col("resource_instance_name")
    return event_documents(spark, sf_dir).select(
        name.alias("instance_name"), text.name_before(name, "_").alias("cluster_id"),
        text.name_after(name, "_").alias("worker_name"),
    )


_LATEST = f"""WITH landed AS ({duck(RESOURCE_BASE)}),
  res AS (SELECT * FROM landed QUALIFY row_number() OVER (PARTITION BY crn ORDER BY seq DESC) = 1)"""


@check("latest_by_key", f"{_LATEST} SELECT crn, kind AS resource_id, created_by, state FROM res")
def _(spark, sf_dir):
    return latest_by_key(landed_resources(spark, sf_dir), ["crn"], ["seq"]).select(
        "crn", "resource_id", "created_by", "state"
    )


@check(
    "user_attribution",
    f"""{_LATEST}, usr AS ({USERS_SQL}) SELECT crn, CASE WHEN firstname IS NOT NULL AND lastname IS NOT NULL
    THEN firstname || ' ' || lastname ELSE '' END AS created_by_name, coalesce(usr.email, '') AS created_by_email
    FROM res LEFT JOIN usr ON iam_id = created_by""",
)
def _(spark, sf_dir):
    rows = usage.with_creator(resources(spark, sf_dir), cloud_users(spark, sf_dir))
    return rows.select("crn", "created_by_name", "created_by_email")


@check("cloud_users", USERS_SQL)
def _(spark, sf_dir):
    return cloud_users(spark, sf_dir)


@check("join_user_role", f"SELECT iam_id, email, role, org, geo, market FROM ({USERS_SQL}) AS u")
def _(spark, sf_dir):
    return cloud_users(spark, sf_dir).select("iam_id", "email", "role", "org", "geo", "market")


@check("role_tag_list", f"SELECT crn, instance_role FROM ({TAG_SQL}) AS t")
def _(spark, sf_dir):
    return tags(spark, sf_dir).select("crn", nested.role_tags(F.col("tags")).alias("instance_role"))


@check(
    "union_servers",
    f"{INSTANCES} SELECT crn, id, metal AS bare_metal, memory FROM srv",
)
def _(spark, sf_dir):
    return servers(spark, sf_dir).select("crn", "id", "bare_metal", "memory")


@check(
    "nvme_raw_storage",
    f"""{INSTANCES} SELECT crn, CAST(CASE WHEN NOT metal THEN CASE WHEN c % 2 = 0 THEN 50 ELSE 0 END
    WHEN c % 4 = 0 THEN 0 WHEN c % 4 = 3 THEN 300 + c % 7 ELSE 100 + c % 7 END AS DOUBLE) AS raw_storage FROM srv""",
)
def _(spark, sf_dir):
    rows = servers(spark, sf_dir)
    return rows.select("crn", nested.nvme_total(F.col("disks")).alias("raw_storage"))


@check(
    "attached_volume_totals",
    f"""{INSTANCES} SELECT srv.crn, CAST(n_volumes - 1 AS INT) AS "numAttachedDataVolumes",
    coalesce(total, 0) AS "totalDataVolumeCapacity" FROM srv LEFT JOIN attach_total AS t ON t.crn = srv.crn
    WHERE c % 7 <> 0""",
)
def _(spark, sf_dir):
    return usage.attached_volume_totals(servers(spark, sf_dir), resources(spark, sf_dir))


@check(
    "join_boot_volume",
    f"""{INSTANCES} SELECT srv.crn, coalesce(capacity, 0) AS "bootVolumeCapacity", coalesce(iops, 0) AS "bootVolumeIops"
    FROM srv LEFT JOIN vol ON vol.crn = srv.boot_crn AND c % 9 <> 0""",
)
def _(spark, sf_dir):
    rows = usage.with_boot_volume(servers(spark, sf_dir), resources(spark, sf_dir))
    return rows.select("crn", "bootVolumeCapacity", "bootVolumeIops")


@check(
    "join_image_os",
    f"""{INSTANCES} SELECT srv.crn, "OSName", "OSVendor" FROM srv LEFT JOIN os ON os.image = srv.image
    AND (metal OR c % 3 <> 1)""",
)
def _(spark, sf_dir):
    rows = usage.with_image_os(
        servers(spark, sf_dir), images(spark, sf_dir), initializations(spark, sf_dir)
    )
    return rows.select("crn", "OSName", "OSVendor")


@check(
    "join_network_names",
    f"""{INSTANCES} SELECT worker_key AS id, worker_vpc AS vpc, worker_subnet AS subnet FROM wrk
    UNION ALL SELECT cluster_key, cluster_vpc, NULL FROM clu""",
)
def _(spark, sf_dir):
    named = clusters(spark, sf_dir).select("id", "vpc", F.lit(None).cast("string").alias("subnet"))
    return workers(spark, sf_dir).select("id", "vpc", "subnet").unionByName(named)


@check(
    "region_from_zone",
    f"{INSTANCES} SELECT crn, 'zone-' || (c % 5) AS region FROM srv",
)
def _(spark, sf_dir):
    return servers(spark, sf_dir).select("crn", text.region_of_zone(F.col("zone.name")).alias("region"))


def _instance_query(name: str, columns: dict[str, str]):
    """A query on some columns of the enriched usage documents; ``columns`` maps a column to its SQL."""
    listed = ", ".join(f'{sql} AS "{column}"' for column, sql in columns.items())

    @check(name, f"{INSTANCES} SELECT {listed} FROM enriched")
    def _(spark, sf_dir):
        return instances(spark, sf_dir).select(*columns)


def _if_known(value: str, default: str = "''") -> str:
    return f"CASE WHEN known THEN coalesce({value}, {default}) ELSE {default} END"


_BASE = {"instance_id": "instance_id", "month": "month", "service_id": "service_id"}
_RESOURCE = {
    "created_at": _if_known("created_at"), "provision_date": _if_known("provision_date"),
    "created_by": _if_known("r_created_by"), "deleted_at": _if_known("deleted_at"),
    "deprovision_date": _if_known("deprovision_date"), "instance_state": _if_known("state"),
    "volume_capacity": "CASE WHEN known AND kind = 'is.volume' THEN capacity END",
    "volume_iops": "CASE WHEN known AND kind = 'is.volume' THEN iops END",
}
_CREATOR = {"created_by_name": _if_known("creator"), "created_by_email": _if_known("creator_email")}
_ON_SERVER = "CASE WHEN known AND has_server THEN {} ELSE {} END"
_SERVER = {
    "instance_profile": "instance_profile", "vpc": "vpc", "zone": "zone",
    "VSI_virtualCPUs": _ON_SERVER.format("CASE WHEN NOT metal THEN c % 8 ELSE 0 END", "0"),
    "VSI_memorySizeMiB": _ON_SERVER.format("server_memory", "0"),
    "VSI_architecture": _ON_SERVER.format("CASE WHEN metal THEN 'x86' ELSE 'amd64' END", "''"),
    "VSI_NumberOfInstStorageDisks": _ON_SERVER.format("CASE WHEN NOT metal AND c % 2 = 0 THEN 1 ELSE 0 END", "0"),
    "BM_numberofCores": _ON_SERVER.format("CASE WHEN metal THEN c % 16 ELSE 0 END", "0"),
    "BM_disks": _ON_SERVER.format(
        "CASE WHEN metal THEN c % 4 ELSE 0 END", "0"),
    "VSI_primaryNetworkSubnet": "subnet", "VSI_primaryNetworkPrimaryIp": "ip",
}
_VOLUMES = {
    "VSI_bootVolumeCapacity": _ON_SERVER.format("coalesce(boot_capacity, 0)", "0"),
    "VSI_bootVolumeIops": _ON_SERVER.format("coalesce(boot_iops, 0)", "0"),
    "VSI_numAttachedDataVolumes": _ON_SERVER.format("CASE WHEN c % 7 <> 0 THEN n_volumes - 1 END", "NULL"),
    "VSI_totalDataVolumeCapacity": _ON_SERVER.format("CASE WHEN c % 7 <> 0 THEN coalesce(data_total, 0) END", "NULL"),
    "OSName": _if_known('"OSName"'), "OSVendor": _if_known('"OSVendor"'),
}
_CLUSTER = {"cluster_id": "cluster_id", "cluster_name": "cluster_name",
            "cluster_workers": "CASE WHEN known THEN cluster_workers END"}
_WORKER = {"worker_name": "worker_name", "worker_location": "worker_location", "worker_flavor": "worker_flavor",
           "worker_pool": "worker_pool"}
_TAGS = {"tags": "coalesce(tags, [])"}

_instance_query("join_resource", _BASE | _RESOURCE)
_instance_query("join_tags", _BASE | _TAGS)
_instance_query("join_server_config", _BASE | _SERVER)
_instance_query("server_attributes", _BASE | _SERVER | _VOLUMES)
_instance_query("join_cluster", _BASE | _CLUSTER | {"vpc": "vpc"})
_instance_query("join_worker", _BASE | _WORKER | {"zone": "zone"})

_OF_METAL = "CASE WHEN metal THEN {} ELSE 0 END"
_DOCUMENT = {
    "account_id": "'account'", "resource_group_id": "''", "pricing_country": "'USA'", "billing_country": "'USA'",
    "currency_code": "'USD'", "plan_id": "plan_id", "plan_name": "plan_id", "billable": "true", "pricing_plan_id": "'pp'",
    "pricing_region": "''", "region": "region", "service_name": "service_name",
    "resource_group_name": "coalesce(group_name, '')", "instance_name": "instance_name",
}
_MORE_RESOURCE = {c: "''" for c in ("updated_at", "updated_by", "deleted_by", "restored_at", "restored_by", "rcLifecycleAction")}
_MORE_RESOURCE |= {"type": _if_known("'resource_instance'")}
_MORE_SERVER = {c: "''" for c in ("VSI_reservation_name", "VSI_dedicated_host", "VSI_gpu_manufacturer", "VSI_gpu_model")}
_MORE_SERVER |= {c: "0" for c in ("VSI_gpu_memory", "VSI_gpu_count", "VSI_totalNetworkBandwidth", "VSI_totalVolumeBandwidth", "BM_bandwidth")}
_MORE_SERVER |= {
    "VSI_numaCount": _ON_SERVER.format("c % 3", "0"),
    "VSI_manufacturer": _ON_SERVER.format("CASE WHEN metal THEN '' ELSE 'intel' END", "''"),
    "VSI_totalBandwidth": _ON_SERVER.format("c % 10", "0"),
    "VSI_bootVolumeCRN": _ON_SERVER.format("CASE WHEN c % 9 <> 0 THEN boot_crn ELSE '' END", "''"),
    "VSI_bootVolumeName": _ON_SERVER.format("CASE WHEN c % 9 <> 0 THEN 'boot' ELSE '' END", "''"),
    "BM_numberofSockets": _ON_SERVER.format(_OF_METAL.format("2"), "0"),
    "BM_ThredsPerCore": _ON_SERVER.format(_OF_METAL.format("2"), "0"),
    "BMnumberofCores": _ON_SERVER.format(_OF_METAL.format("c % 16"), "0"),
    "BMnumberofSockets": _ON_SERVER.format(_OF_METAL.format("2"), "0"),
    "BMthreadsPerCore": _ON_SERVER.format(_OF_METAL.format("2"), "0"),
    "BMRawStorage": _ON_SERVER.format(_OF_METAL.format(
        "CASE c % 4 WHEN 0 THEN 0.0 WHEN 3 THEN 300.0 + c % 7 ELSE 100.0 + c % 7 END"), "0"),
    "lifecycle_state": _ON_SERVER.format("'stable'", "''"), "health_state": _ON_SERVER.format("'ok'", "''"),
    "status": _ON_SERVER.format("'running'", "''"),
    "OSVersion": _if_known("""CASE WHEN "OSName" IS NOT NULL THEN '9' END"""),
}
_MORE_CLUSTER = {
    "cluster_version": "CASE WHEN cluster_name <> '' THEN '1.29' ELSE '' END",
    "cluster_state": "CASE WHEN cluster_name <> '' THEN 'normal' ELSE '' END",
    "cluster_status": "CASE WHEN cluster_name <> '' THEN 'ok' ELSE '' END",
    "worker_state": "CASE WHEN worker_pool <> '' THEN 'deployed' ELSE '' END",
    "worker_health": "CASE WHEN worker_pool <> '' THEN 'normal' ELSE '' END",
    "worker_version": "CASE WHEN worker_pool <> '' THEN '1.29.1' ELSE '' END",
}
_DETAIL = _BASE | _RESOURCE | _CREATOR | _SERVER | _VOLUMES | _CLUSTER | _WORKER | _TAGS
_DETAIL |= _DOCUMENT | _MORE_RESOURCE | _MORE_SERVER | _MORE_CLUSTER
_DETAIL_SQL = ", ".join(f'{sql} AS "{column}"' for column, sql in _DETAIL.items())


@check(
    "instances_detail",
    f"""{INSTANCES} SELECT {_DETAIL_SQL}, CASE WHEN m = 0 THEN 'GIGABYTE_HOURS' ELSE 'VCPU_HOURS' END AS metric,
      CASE WHEN m = 0 THEN 'GB_HOURS' ELSE 'HOURS' END AS unit, amount * 4 + m AS quantity, amount * (m + 1) AS cost,
      amount * 2 AS rated_cost, amount * 4 + m AS rateable_quantity, ['p'] AS price, CAST([] AS STRUCT(discount DOUBLE)[]) AS discount,
      CASE WHEN m = 0 THEN 'GIGABYTE_HOURS' ELSE 'VCPU_HOURS' END AS metric_name,
      CASE WHEN m = 0 THEN 'GB_HOURS' ELSE 'HOURS' END AS unit_name
    FROM enriched, (SELECT range AS m FROM range(2)) AS numbers WHERE m < n_metrics""",
)
def _(spark, sf_dir):
    return usage.metric_rows(instances(spark, sf_dir))


def _usage_report(name, build, keys, cells, where):
    sql = pivot_sql(INSTANCE_CTE, f"SELECT * FROM usage_row WHERE {where}", keys, cells, "month", WEEKS)

    @check(name, sql)
    def _(spark, sf_dir):
        return build(all_within(usage.metric_rows(instances(spark, sf_dir)), "month", WEEKS), WEEKS)


_SERVERS = "service_id IN ('is.instance', 'is.bare-metal-server')"
_COUNTED = {"instance_count": "COUNT(DISTINCT [instance_id])", "cost": COST}
_PLACE = ["region", "vpc", "zone", "resource_group_name", "instance_profile"]

_usage_report("server_list", reports.server_list,
              ["region", "vpc", "instance_name", "instance_id", "instance_profile"], {"cost": COST}, _SERVERS)
_usage_report("object_storage_instances", reports.object_storage_instances,
              ["region", "resource_group_name", "instance_name", "plan_name", "metric", "unit"],
              {"quantity": "CAST(SUM([quantity_cents]) AS DOUBLE) / 100", "cost": COST},
              "service_name = 'Cloud Object Storage'")
_usage_report("virtual_server_summary", reports.virtual_server_summary, _PLACE, _COUNTED, "service_id = 'is.instance'")
_usage_report("bare_metal_summary", reports.bare_metal_summary, _PLACE, _COUNTED, "service_id = 'is.bare-metal-server'")
_usage_report("kubernetes_summary", reports.kubernetes_summary,
              ["region", "vpc", "cluster_name", "worker_pool", "worker_name", "zone", "worker_flavor",
               "created_by_name", "instance_state"], {"cost": COST}, "service_id = 'containers-kubernetes'")


@check(
    "servers_by_user",
    pivot_sql(
        INSTANCE_CTE,
        f"""SELECT * REPLACE (CASE WHEN known THEN provision_date ELSE '' END AS provision_date,
        CASE WHEN known THEN deprovision_date ELSE '' END AS deprovision_date) FROM usage_row WHERE {_SERVERS}""",
        ["created_by_name", "region", "vpc", "instance_name", "service_name", "instance_profile", "provision_date",
         "deprovision_date", "instance_state"], {"cost": COST}, "month", WEEKS,
    ),
)
def _(spark, sf_dir):
    return reports.servers_by_user(usage.metric_rows(instances(spark, sf_dir)), WEEKS)


@check(
    "volumes_summary",
    pivot_sql(
        INSTANCE_CTE,
        """SELECT * REPLACE (coalesce(CAST(volume_iops AS VARCHAR), '') AS volume_iops,
        coalesce(CAST(volume_capacity AS VARCHAR), '') AS volume_capacity) FROM usage_row WHERE service_id = 'is.volume'""",
        ["region", "zone", "resource_group_name", "volume_iops", "volume_capacity"], _COUNTED, "month", WEEKS,
    ),
)
def _(spark, sf_dir):
    return reports.volumes_summary(usage.metric_rows(instances(spark, sf_dir)), WEEKS)


def _monthly_sql(source: str, keys: list[str]) -> str:
    top = f"GROUPING({keys[0]}) = 1"
    labelled = ", ".join(
        f"CASE WHEN {top} THEN '{'Total' if i == 0 else ''}' ELSE {k} END AS {k}" for i, k in enumerate(keys)
    )
    return f"""{INSTANCES}, src AS ({source}) SELECT month, {labelled}, {top} AS is_total,
      CAST(SUM(rated_cents) AS DOUBLE) / 100 AS rated_cost, CAST(SUM(cost_cents) AS DOUBLE) / 100 AS cost
      FROM src GROUP BY GROUPING SETS ((month, {', '.join(keys)}), (month))"""


_ANY_PROFILE = "CASE WHEN kind IN ('is.instance', 'is.bare-metal-server') THEN coalesce(kind_profile, '') ELSE '' END"


@check(
    "charges_by_server_month",
    _monthly_sql(
        f"SELECT * REPLACE (coalesce({_ANY_PROFILE}, '') AS instance_profile) FROM usage_row WHERE {_SERVERS}",
        ["region", "service_name", "instance_role", "instance_name", "instance_id", "instance_profile"],
    ),
)
def _(spark, sf_dir):
    return reports.charges_by_server_month(usage.metric_rows(billing_instances(spark, sf_dir)))


@check(
    "charges_by_volume_month",
    _monthly_sql(
        """SELECT * REPLACE (CASE WHEN kind = 'is.volume' THEN CAST(capacity AS VARCHAR) ELSE '' END AS capacity,
        CASE WHEN kind = 'is.volume' THEN CAST(iops AS VARCHAR) ELSE '' END AS iops) FROM usage_row
        WHERE service_id = 'is.volume' AND metric = 'GIGABYTE_HOURS'""",
        ["region", "service_name", "resource_group_name", "instance_name", "instance_id", "capacity", "iops"],
    ),
)
def _(spark, sf_dir):
    return reports.charges_by_volume_month(usage.metric_rows(billing_instances(spark, sf_dir)))


@check(
    "usage_of_tiny_costs",
    pivot_sql(
        "event AS (SELECT event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM events)",
        "SELECT event_type AS resource_name, '2024-01' AS month, cents FROM event", ["resource_name"],
        {"cost": "CAST(SUM([cents]) AS DOUBLE) / 100000000000"}, "month", ["2024-01"],
    ),
)
def _(spark, sf_dir):
    """Costs of about a billionth each add up exactly."""
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_type as resource_name", "'2024-01' as month",
        "cast(round(value * 100) as bigint) / 100000000000D as cost",
    )
    return reports.usage_summary(rows, ["2024-01"])
