"""Usage documents, resources, servers and clusters made from the given tables; and their expected join in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.landed import landed
from checks.tables import duck, run
from cloudtally.functions.dates import month_list
from cloudtally.operators.lookup import latest_by_key
from cloudtally.plans import usage

# Events span one January: its weeks stand for months.
WEEKS = month_list("2024-01", "2024-05")

EVENT_BASE = """
SELECT event_id, user_id, CAST(event_id % 3 AS INT) AS n_metrics, CAST(value AS DOUBLE) AS amount,
  '2024-0' || CAST(1 + CAST(FLOOR((day(ts) - 1) / 7) AS INT) AS STRING) AS month,
  'crn-' || CAST(user_id AS STRING) AS instance_id,
  CASE event_type WHEN 'view' THEN 'is.instance' WHEN 'click' THEN 'is.bare-metal-server'
    WHEN 'purchase' THEN 'is.volume' WHEN 'signup' THEN 'containers-kubernetes'
    ELSE CASE WHEN event_id % 2 = 0 THEN 'cloud-object-storage' ELSE 'classic_infrastructure.compute' END
    END AS service_id,
  CASE event_type WHEN 'view' THEN 'Virtual Server' WHEN 'click' THEN 'Bare Metal' WHEN 'purchase' THEN 'Block Storage'
    WHEN 'signup' THEN 'Kubernetes Service' ELSE CASE WHEN event_id % 2 = 0 THEN 'Cloud Object Storage'
    ELSE 'Classic' END END AS service_name,
  CASE event_id % 4 WHEN 0 THEN 'containers.kubernetes.cluster' WHEN 1 THEN 'containers.kubernetes.cluster.roks'
    WHEN 2 THEN 'containers.kubernetes.vpc.gen2' ELSE 'containers.kubernetes.vpc.gen2.roks' END AS plan_id,
  CASE WHEN event_id % 4 < 2 OR user_id % 10 = 9 THEN 'cluster' || CAST(user_id % 30 AS STRING)
    ELSE 'cluster' || CAST(user_id % 30 AS STRING) || '_w' || CAST(user_id % 40 AS STRING) END AS instance_name,
  CASE user_id % 3 WHEN 0 THEN 'us-south' WHEN 1 THEN 'eu-de' ELSE '' END AS region,
  CASE WHEN user_id % 7 <> 0 THEN 'group' || CAST(user_id % 4 AS STRING) END AS group_name
FROM {events}
"""

# Metric number m (0 or 1) of a usage document; it exists if m < n_metrics.
METRIC = {
    "metric": "CASE WHEN {m} = 0 THEN 'GIGABYTE_HOURS' ELSE 'VCPU_HOURS' END",
    "unit": "CASE WHEN {m} = 0 THEN 'GB_HOURS' ELSE 'HOURS' END",
    "quantity": "amount * 4 + {m}",
    "cost": "amount * ({m} + 1)",
    "rated_cost": "amount * 2",
}

# Resource of key c: two records are landed for each, the later one names another creator.
RESOURCE_BASE = """
SELECT key, seq, 'crn-' || CAST(key AS STRING) AS crn,
  CASE c % 5 WHEN 0 THEN 'is.instance' WHEN 1 THEN 'is.bare-metal-server' WHEN 2 THEN 'is.volume'
    WHEN 3 THEN 'containers-kubernetes' ELSE 'cloud-object-storage' END AS kind,
  'iam-' || CAST((c + seq * 3) % 120 AS STRING) AS created_by,
  '2023-0' || CAST(1 + c % 9 AS STRING) || '-10T23:30:00-0500' AS created_at,
  '2023-0' || CAST(1 + c % 9 AS STRING) || '-11' AS provision_date,
  CASE WHEN c % 6 = 0 THEN '2024-01-0' || CAST(1 + c % 9 AS STRING) || 'T10:00:00.123Z' END AS deleted_at,
  CASE WHEN c % 6 = 0 THEN '2024-01-0' || CAST(1 + c % 9 AS STRING) ELSE '' END AS deprovision_date,
  CASE WHEN c % 6 = 0 THEN 'removed' ELSE 'active' END AS state,
  CASE WHEN c % 4 = 0 THEN 'zone-' || CAST(c % 3 AS STRING) || '-a' END AS rc_zone,
  CASE WHEN c % 10 < 5 THEN 'bx2-' || CAST(c % 3 AS STRING) END AS kind_profile,
  CASE WHEN c % 7 = 0 THEN 'ext-profile' END AS ext_profile,
  CAST(100 + c % 50 AS DOUBLE) AS capacity, CAST(1000 + c % 5 * 100 AS DOUBLE) AS iops, c
FROM (
  SELECT CAST(c_custkey AS BIGINT) AS c, CAST(c_custkey AS BIGINT) * 2 AS key, 0 AS seq FROM {customer}
  UNION ALL
  SELECT CAST(c_custkey AS BIGINT), CAST(c_custkey AS BIGINT) * 2, 1 FROM {customer}
) AS landed
"""

USER_BASE = """
SELECT 'iam-' || CAST(s_suppkey AS STRING) AS iam_id, s_name AS firstname,
  CASE WHEN s_suppkey % 8 <> 3 THEN 'L' || CAST(s_suppkey AS STRING) END AS lastname, 'ACTIVE' AS state,
  'u' || CAST(s_suppkey % 40 AS STRING) || '@example.com' AS email, '2020' AS added_on FROM {supplier}
"""

ROLE_BASE = """
SELECT 'u' || CAST(n_nationkey % 20 AS STRING) || '@example.com' AS email, n_nationkey AS seq, n_name AS role,
  'org' || CAST(n_regionkey AS STRING) AS org, 'geo' AS geo, 'market' || CAST(n_nationkey AS STRING) AS market
FROM {nation}
"""


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instance usage documents as landed, one per event, with their metrics nested."""
    return landed(spark, sf_dir, "instance_usage", _event_documents)


def _event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run(spark, sf_dir, EVENT_BASE, fact="events")
    metrics = []
    for m in range(2):
        field = {name: text.format(m=m) for name, text in METRIC.items()}
        metrics.append(
            f"struct({field['metric']} AS metric, {field['unit']} AS unit, {field['quantity']} AS quantity, "
            f"{field['quantity']} AS rateable_quantity, {field['cost']} AS cost, {field['rated_cost']} AS rated_cost, "
            f"array('p') AS price, CAST(array() AS array<struct<discount: double>>) AS discounts, "
            f"{field['metric']} AS metric_name, {field['unit']} AS unit_name)"
        )
    return base.selectExpr(
        "'account' AS account_id",
        "instance_id AS resource_instance_id",
        "instance_name AS resource_instance_name",
        "CAST(NULL AS STRING) AS resource_group_id",
        "group_name AS resource_group_name",
        "month",
        "plan_id",
        "plan_id AS plan_name",
        "true AS billable",
        "'pp' AS pricing_plan_id",
        "'USA' AS pricing_country",
        "'USA' AS billing_country",
        "'USD' AS currency_code",
        "CAST(NULL AS STRING) AS pricing_region",
        "region",
        "service_id AS resource_id",
        "service_name AS resource_name",
        f"slice(array({', '.join(metrics)}), 1, n_metrics) AS `usage`",
    )


def landed_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run(spark, sf_dir, RESOURCE_BASE)
    return base.selectExpr(
        "seq",
        "crn",
        "kind AS resource_id",
        "created_at",
        "created_by",
        "deleted_at",
        "CAST(NULL AS STRING) AS updated_at",
        "CAST(NULL AS STRING) AS updated_by",
        "CAST(NULL AS STRING) AS deleted_by",
        "CAST(NULL AS STRING) AS restored_at",
        "CAST(NULL AS STRING) AS restored_by",
        "state",
        "'resource_instance' AS type",
        """struct(ext_profile AS Profile,
          CASE WHEN kind = 'is.instance' THEN named_struct('Profile', kind_profile, 'CPUFamily', 'x86',
            'NumberOfVirtualCPUs', CAST(c % 8 AS STRING), 'MemorySizeMiB', '1024', 'NodeName', 'n', 'NumberOfGPUs', '0',
            'NumberOfInstStorageDisks', '1') END AS VirtualMachineProperties,
          CASE WHEN kind = 'is.bare-metal-server' THEN named_struct('Profile', kind_profile, 'MemorySizeMiB', '2048',
            'NodeName', 'b', 'NumberOfCores', CAST(c % 16 AS STRING), 'NumberOfSockets', '2', 'Bandwidth', '10000',
            'OSName', 'ESX', 'OSVendor', 'V', 'OSVersion', '8') END AS BMServerProperties,
          CASE WHEN kind = 'is.volume' THEN named_struct('Capacity', capacity, 'IOPS', iops) END AS VolumeInfo,
          named_struct('AvailabilityZone', rc_zone, 'Location', named_struct('Region', 'r'), 'LifecycleAction',
            CAST(NULL AS STRING)) AS Resource) AS extensions""",
    )


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by_key(landed_resources(spark, sf_dir), ["crn"], ["seq"]).drop("seq")


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(
        spark, sf_dir,
        """SELECT concat('crn-', c_custkey * 3) AS crn, CASE c_custkey % 3
             WHEN 0 THEN array(concat('role:app', c_custkey % 4), 'env:prod', 'owner-role:a:b')
             WHEN 1 THEN array('env:test') ELSE CAST(array() AS array<string>) END AS tags FROM {customer}""",
    )


TAG_SQL = """SELECT 'crn-' || CAST(c_custkey * 3 AS VARCHAR) AS crn,
  CASE c_custkey % 3 WHEN 0 THEN ['role:app' || (c_custkey % 4), 'env:prod', 'owner-role:a:b'] WHEN 1 THEN ['env:test']
    ELSE [] END AS tags,
  CASE c_custkey % 3 WHEN 0 THEN 'app' || (c_custkey % 4) || ',a' ELSE '' END AS instance_role FROM customer"""


def cloud_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.cloud_users(user_documents(spark, sf_dir), role_documents(spark, sf_dir), "seq")


def user_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, USER_BASE).withColumn("invitedOn", F.lit(None).cast("string"))


def role_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, ROLE_BASE).selectExpr(
        "email", "seq", "role AS `GTM Role`", "org AS OrgName", "geo AS Geo", "market AS Market"
    )


USERS_SQL = f"""SELECT iam_id, firstname, lastname, u.state, u.email, coalesce(r.role, '') AS role,
  coalesce(r.org, '') AS org, coalesce(r.geo, '') AS geo, coalesce(r.market, '') AS market, added_on,
  CAST(NULL AS VARCHAR) AS "invitedOn"
FROM ({duck(USER_BASE)}) AS u LEFT JOIN (
  SELECT * FROM ({duck(ROLE_BASE)}) AS landed QUALIFY row_number() OVER (PARTITION BY email ORDER BY seq) = 1
) AS r ON r.email = u.email"""

_SERVER = """
  c % 5 = 1 AS metal, 'crn-' || CAST(c * 2 AS STRING) AS crn, 'srv-' || CAST(c AS STRING) AS id, c % 64 AS memory, c % 3 AS numa,
  CASE WHEN c % 4 <> 1 THEN 'vpc-' || CAST(c % 6 AS STRING) END AS vpc,
  'zone-' || CAST(c % 5 AS STRING) || '-b' AS zone, 'srv-profile-' || CAST(c % 4 AS STRING) AS profile,
  'img-' || CAST(c % 30 AS STRING) AS image, c % 4 AS n_volumes,
  'crn-' || CAST((c + 2 - c % 5) * 2 AS STRING) AS boot_crn
"""


def servers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A server per customer, virtual or bare metal. Volume i of a server is the resource of the (i+1)th next volume key."""
    base = run(
        spark,
        sf_dir,
        f"SELECT c, {_SERVER} FROM (SELECT CAST(c_custkey AS BIGINT) AS c FROM {{customer}}) AS k",
    )
    attachments = ", ".join(
        f"struct(struct(concat('crn-', (c + 2 - c % 5 + 5 * {i}) * 2) AS crn, 'v{i}' AS name, 'id{i}' AS id) AS volume)"
        for i in range(4)
    )
    common = [
        "crn",
        "id",
        "memory",
        "numa AS numa_count",
        "c % 10 AS bandwidth",
        "CAST(NULL AS BIGINT) AS total_network_bandwidth",
        "CAST(NULL AS BIGINT) AS total_volume_bandwidth",
        "struct(struct('10.0.0.1' AS address) AS primary_ip, struct(concat('sub-', c % 3) AS name) AS subnet)"
        " AS primary_network_interface",
        "CASE WHEN vpc IS NOT NULL THEN struct(vpc AS name) END AS vpc",
        "CAST(NULL AS struct<name: string>) AS dedicated_host",
        "CAST(NULL AS struct<name: string>) AS reservation",
        "CAST(NULL AS struct<manufacturer: string, model: string, memory: bigint, count: bigint>) AS gpu",
        "'stable' AS lifecycle_state",
        "'running' AS status",
        "'ok' AS health_state",
        "struct(zone AS name) AS zone",
        "struct(profile AS name) AS profile",
        "CASE WHEN c % 9 <> 0 THEN struct(struct(boot_crn AS crn, 'boot' AS name) AS volume) END AS boot_volume_attachment",
        f"CASE WHEN c % 7 <> 0 THEN slice(array({attachments}), 1, CAST(n_volumes AS INT)) END AS volume_attachments",
    ]
    virtual = base.filter("NOT metal").selectExpr(
        *common,
        "struct(c % 8 AS count, 'amd64' AS architecture, 'intel' AS manufacturer) AS vcpu",
        "CASE WHEN c % 3 <> 1 THEN struct(image AS id) END AS image",
        "CAST(NULL AS struct<architecture: string, core_count: bigint, socket_count: bigint, threads_per_core: bigint>)"
        " AS cpu",
        "CASE WHEN c % 2 = 0 THEN array(struct('nvme' AS interface_type, 50D AS size)) END AS disks",
    )
    metal = base.filter("metal").selectExpr(
        *common,
        "struct('x86' AS architecture, c % 16 AS core_count, 2L AS socket_count, 2L AS threads_per_core) AS cpu",
        "slice(array(struct('nvme' AS interface_type, 100D + c % 7 AS size), struct('sata' AS interface_type, 10D AS size),"
        " struct('nvme' AS interface_type, 200D AS size)), 1, CAST(c % 4 AS INT)) AS disks",
    )
    return usage.union_servers(virtual, metal)


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, """SELECT concat('img-', n_nationkey) AS id,
      struct(n_name AS name, concat('vendor', n_regionkey) AS vendor, '9' AS version) AS operating_system
      FROM {nation}""")  # fmt: skip


def initializations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, """SELECT concat('srv-', c_custkey) AS id, struct(concat('img-', c_custkey % 30) AS id) AS image
      FROM {customer}""")  # fmt: skip


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "clusters", _clusters)


def _clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.named_clusters(cluster_documents(spark, sf_dir), vpcs(spark, sf_dir))


def cluster_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(
        spark, sf_dir,
        """SELECT concat('cluster', n_nationkey) AS id, n_name AS name, 'us-south' AS region,
             CAST(n_nationkey % 6 AS BIGINT) AS workerCount, '1.29' AS masterKubeVersion, 'normal' AS state,
             'ok' AS status, array(concat('vpc-id-', n_regionkey), 'other') AS vpcs FROM {nation}""",
    )


def vpcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT concat('vpc-id-', r_regionkey) AS id, r_name AS name FROM {region}")


def workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "workers", _workers)


def _workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.named_workers(worker_documents(spark, sf_dir), clusters(spark, sf_dir), subnets(spark, sf_dir))


def worker_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(
        spark, sf_dir,
        """SELECT concat('cluster', s_nationkey) AS cluster, concat('w', s_suppkey) AS id,
             struct('deployed' AS actualState) AS lifecycle, struct('normal' AS state) AS health,
             struct('1.29.1' AS actual) AS kubeVersion, concat('us-south-', s_suppkey % 3) AS location,
             concat('bx2.', s_suppkey % 4) AS flavor, 'default' AS poolName,
             array(struct(concat('sn-', s_suppkey % 25) AS subnetID, concat('10.1.0.', s_suppkey) AS ipAddress))
               AS networkInterfaces FROM {supplier}""",
    )


def subnets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT concat('sn-', n_nationkey) AS id, n_name AS name FROM {nation}")


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instance dimension, written once as in a report run."""
    return landed(spark, sf_dir, "instance_dimension", _dimension)


def _dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.instance_dimension(
        resources(spark, sf_dir), tags(spark, sf_dir), cloud_users(spark, sf_dir), servers(spark, sf_dir),
        images(spark, sf_dir), initializations(spark, sf_dir),
    )


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched usage documents, metrics still nested."""
    return usage.enriched_instances(
        event_documents(spark, sf_dir), dimension(spark, sf_dir), clusters(spark, sf_dir), workers(spark, sf_dir)
    )


def billing_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.billing_instances(event_documents(spark, sf_dir), resources(spark, sf_dir), tags(spark, sf_dir))


def account_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account usage documents as landed, one per order: resources, plans and metrics nested."""
    return landed(spark, sf_dir, "account_usage", _account_documents)


def _account_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run(spark, sf_dir, """SELECT o_orderkey, o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
      substring(CAST(o_orderdate AS STRING), 1, 7) AS month FROM {orders}""", fact="orders")  # fmt: skip

    def metric(r: int, p: int, u: int) -> str:
        discounts = "array(struct(0.25D AS discount), struct(0.5D AS discount))" if u else (
            "CAST(array() AS array<struct<discount: double>>)")
        price = "array('tier1')" if u else "CAST(array() AS array<string>)"
        return (
            f"struct('metric{u}' AS metric, 'unit{u}' AS unit_name, CAST(o_orderkey % 100 + {u} AS DOUBLE) AS quantity, "
            f"1D AS rateable_quantity, CAST(cents * ({r} + {p} + 1) AS DOUBLE) / 100 AS cost, "
            f"CAST(cents * 2 AS DOUBLE) / 100 AS rated_cost, {discounts} AS discounts, {price} AS price)"
        )

    def plan(r: int, p: int) -> str:
        metrics = ", ".join(metric(r, p, u) for u in range(2))
        return (
            f"struct('plan{p}' AS plan_id, 'Plan {p}' AS plan_name, slice(array({metrics}), 1, "
            f"CAST((o_custkey + {p}) % 3 AS INT)) AS `usage`)"
        )

    def resource(r: int) -> str:
        plans = ", ".join(plan(r, p) for p in range(2))
        return (
            f"struct(concat('res', (o_custkey + {r}) % 7) AS resource_id, concat('Resource ', (o_custkey + {r}) % 7) AS "
            f"resource_name, 1D AS billable_cost, 2D AS billable_rated_cost, array({plans}) AS plans)"
        )

    return base.selectExpr(
        "concat('a', o_custkey % 3) AS account_id",
        "month",
        "'USD' AS currency_code",
        "'USA' AS billing_country",
        f"slice(array({', '.join(resource(r) for r in range(3))}), 1, CAST(o_orderkey % 3 + 1 AS INT)) AS resources",
    )


ACCOUNT_CTE = """
account_row AS (
  SELECT 'a' || (o_custkey % 3) AS account_id, strftime(o_orderdate, '%Y-%m') AS month, 'USD' AS currency_code,
    'USA' AS billing_country, 'res' || ((o_custkey + r) % 7) AS resource_id,
    'Resource ' || ((o_custkey + r) % 7) AS resource_name, CAST(1 AS DOUBLE) AS billable_charges,
    CAST(2 AS DOUBLE) AS billable_rated_charges, 'plan' || p AS plan_id, 'Plan ' || p AS plan_name,
    'metric' || u AS metric, 'unit' || u AS unit_name, CAST(o_orderkey % 100 + u AS DOUBLE) AS quantity,
    CAST(1 AS DOUBLE) AS rateable_quantity, CAST(cents * (r + p + 1) AS DOUBLE) / 100 AS cost,
    CAST(cents * 2 AS DOUBLE) / 100 AS rated_cost, CASE WHEN u = 1 THEN 0.25::DOUBLE END AS discount,
    CASE WHEN u = 1 THEN '["tier1"]' ELSE '[]' END AS price,
    cents * (r + p + 1) AS cost_cents, cents * 2 AS rated_cents, CAST(o_orderkey % 100 + u AS BIGINT) AS units
  FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders) AS o,
    (SELECT range AS r FROM range(3)) AS rs, (SELECT range AS p FROM range(2)) AS ps, (SELECT range AS u FROM range(2)) AS us
  WHERE r < o_orderkey % 3 + 1 AND u < (o_custkey + p) % 3
)"""

# Expected enriched documents and metric rows. Each lookup is worked out from the keys alone.
INSTANCE_CTE = f"""
event_doc AS ({duck(EVENT_BASE)}),
landed AS ({duck(RESOURCE_BASE)}),
res AS (SELECT * FROM landed QUALIFY row_number() OVER (PARTITION BY crn ORDER BY seq DESC) = 1),
usr AS ({USERS_SQL}),
tag AS ({TAG_SQL}),
srv AS (SELECT c, {_SERVER} FROM (SELECT CAST(c_custkey AS BIGINT) AS c FROM customer) AS k),
vol AS (SELECT crn, capacity, iops FROM res WHERE kind = 'is.volume'),
attach AS (
  SELECT s.crn, s.boot_crn, s.c, 'crn-' || CAST((s.c + 2 - s.c % 5 + 5 * i) * 2 AS VARCHAR) AS volume_crn
  FROM srv AS s, (SELECT range AS i FROM range(4)) AS numbers WHERE i < s.n_volumes AND s.c % 7 <> 0
),
attach_total AS (
  SELECT a.crn, CAST(SUM(v.capacity) AS DOUBLE) AS total FROM attach AS a JOIN vol AS v ON v.crn = a.volume_crn
  WHERE a.c % 9 = 0 OR a.volume_crn <> a.boot_crn GROUP BY a.crn
),
os AS (SELECT 'img-' || n_nationkey AS image, n_name AS "OSName", 'vendor' || n_regionkey AS "OSVendor" FROM nation),
clu AS (
  SELECT 'cluster' || n_nationkey AS cluster_key, n_name AS cluster_name, n_nationkey % 6 AS cluster_workers,
    r_name AS cluster_vpc FROM nation JOIN region ON r_regionkey = n_regionkey
),
wrk AS (
  SELECT 'w' || s_suppkey AS worker_key, 'us-south-' || (s_suppkey % 3) AS worker_location,
    'bx2.' || (s_suppkey % 4) AS worker_flavor, c.cluster_vpc AS worker_vpc, '10.1.0.' || s_suppkey AS worker_ip,
    n.n_name AS worker_subnet
  FROM supplier JOIN clu AS c ON c.cluster_key = 'cluster' || s_nationkey
    LEFT JOIN nation AS n ON n.n_nationkey = s_suppkey % 25
),
joined AS (
  SELECT e.*, r.crn IS NOT NULL AND NOT contains(e.service_id, 'classic_infrastructure') AS known,
    r.kind, r.created_by AS r_created_by, r.created_at, r.provision_date, r.deleted_at, r.deprovision_date, r.state,
    r.rc_zone, r.ext_profile, r.kind_profile, r.capacity, r.iops, r.c,
    CASE WHEN u.firstname IS NOT NULL AND u.lastname IS NOT NULL THEN u.firstname || ' ' || u.lastname ELSE '' END
      AS creator, coalesce(u.email, '') AS creator_email,
    s.crn IS NOT NULL AS has_server, s.vpc AS server_vpc, s.zone AS server_zone, s.profile AS server_profile,
    s.metal, s.memory AS server_memory, s.n_volumes, s.boot_crn, o."OSName", o."OSVendor", b.capacity AS boot_capacity,
    b.iops AS boot_iops, t.total AS data_total, g.tags, coalesce(g.instance_role, '') AS instance_role
  FROM event_doc AS e
  LEFT JOIN res AS r ON r.crn = e.instance_id
  LEFT JOIN usr AS u ON u.iam_id = r.created_by
  LEFT JOIN srv AS s ON s.crn = r.crn AND r.kind IN ('is.instance', 'is.bare-metal-server')
  LEFT JOIN os AS o ON o.image = s.image AND (s.metal OR s.c % 3 <> 1)
  LEFT JOIN vol AS b ON b.crn = s.boot_crn AND s.c % 9 <> 0
  LEFT JOIN attach_total AS t ON t.crn = s.crn
  LEFT JOIN tag AS g ON g.crn = e.instance_id
),
placed AS (
  SELECT j.*, known AND kind = 'containers-kubernetes' AS kube,
    CASE WHEN known AND kind = 'containers-kubernetes' THEN split_part(instance_name, '_', 1) ELSE '' END AS cluster_id,
    CASE WHEN known AND kind = 'containers-kubernetes' AND contains(plan_id, 'gen2')
      THEN CASE WHEN contains(instance_name, '_') THEN split_part(instance_name, '_', 2) ELSE instance_name END ELSE ''
      END AS worker_name
  FROM joined AS j
),
enriched AS (
  SELECT p.*, coalesce(cl.cluster_name, '') AS cluster_name, cl.cluster_workers, coalesce(w.worker_location, '') AS
    worker_location, coalesce(w.worker_flavor, '') AS worker_flavor,
    CASE WHEN w.worker_key IS NOT NULL THEN 'default' ELSE '' END AS worker_pool,
    CASE WHEN NOT known THEN '' ELSE coalesce(w.worker_vpc, cl.cluster_vpc, server_vpc, '') END AS vpc,
    CASE WHEN NOT known THEN '' ELSE coalesce(w.worker_location, rc_zone, server_zone, '') END AS zone,
    CASE WHEN NOT known THEN '' ELSE coalesce(ext_profile, kind_profile_of_kind, server_profile, '') END AS instance_profile,
    CASE WHEN NOT known THEN '' ELSE coalesce(w.worker_subnet, CASE WHEN has_server THEN 'sub-' || (c % 3) END, '') END
      AS subnet,
    CASE WHEN NOT known THEN '' ELSE coalesce(w.worker_ip, CASE WHEN has_server THEN '10.0.0.1' END, '') END AS ip
  FROM (SELECT *, CASE WHEN kind IN ('is.instance', 'is.bare-metal-server') THEN kind_profile END AS kind_profile_of_kind
    FROM placed) AS p
  LEFT JOIN clu AS cl ON cl.cluster_key = p.cluster_id
  LEFT JOIN wrk AS w ON w.worker_key = p.worker_name
),
usage_row AS (
  SELECT e.*, {", ".join(f"{text.format(m='m')} AS {name}" for name, text in METRIC.items())},
    CASE WHEN known THEN creator ELSE '' END AS created_by_name,
    CASE WHEN known THEN state ELSE '' END AS instance_state,
    CASE WHEN known AND kind = 'is.volume' THEN capacity END AS volume_capacity,
    CASE WHEN known AND kind = 'is.volume' THEN iops END AS volume_iops,
    coalesce(group_name, '') AS resource_group_name, plan_id AS plan_name,
    CAST(round(amount * 100) AS BIGINT) * (m + 1) AS cost_cents, CAST(round(amount * 100) AS BIGINT) * 2 AS rated_cents,
    CAST(round(amount * 100) AS BIGINT) * 4 + m * 100 AS quantity_cents
  FROM (SELECT * EXCLUDE (plan_id), plan_id FROM enriched) AS e, (SELECT range AS m FROM range(2)) AS numbers
  WHERE m < n_metrics
)"""
