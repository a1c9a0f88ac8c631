"""Account and instance usage: flattened documents and their enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudtally.functions import charges, dates, nested, text
from cloudtally.operators.lookup import first_by_key, lookup_join

# Fixed values.
VIRTUAL_SERVER = "is.instance"
BARE_METAL = "is.bare-metal-server"
VOLUME = "is.volume"
KUBERNETES = "containers-kubernetes"
CLUSTER_PLANS = ["containers.kubernetes.cluster.roks", "containers.kubernetes.cluster"]
WORKER_PLANS = ["containers.kubernetes.vpc.gen2.roks", "containers.kubernetes.vpc.gen2"]

BASE_COLUMNS = [
    "account_id", "instance_id", "resource_group_id", "month", "pricing_country", "billing_country", "currency_code",
    "plan_id", "plan_name", "billable", "pricing_plan_id", "pricing_region", "region", "service_id", "service_name",
    "resource_group_name", "instance_name",
]

METRIC_COLUMNS = [
    "metric", "unit", "quantity", "cost", "rated_cost", "rateable_quantity", "price", "discount", "metric_name",
    "unit_name",
]


def account_usage(documents: DataFrame) -> DataFrame:
    """One row per month, resource, plan and metric."""
    resource = documents.select(
        "account_id", "month", "currency_code", "billing_country", F.explode("resources").alias("r")
    )
    plan = resource.select("*", F.explode("r.plans").alias("p")).withColumn("r", F.col("r").dropFields("plans"))
    metric = plan.select("*", F.explode("p.usage").alias("u")).withColumn("p", F.col("p").dropFields("usage"))
    discount, price = charges.discount_and_price(F.col("u.discounts"), F.col("u.price"))
    return metric.select(
        "account_id",
        "month",
        "currency_code",
        "billing_country",
        "r.resource_id",
        "r.resource_name",
        F.col("r.billable_cost").alias("billable_charges"),
        F.col("r.billable_rated_cost").alias("billable_rated_charges"),
        "p.plan_id",
        "p.plan_name",
        "u.metric",
        "u.unit_name",
        "u.quantity",
        "u.rateable_quantity",
        "u.cost",
        "u.rated_cost",
        discount.alias("discount"),
        price.alias("price"),
    )


def instance_months(documents: DataFrame) -> DataFrame:
    """Instance usage documents with the report's column names; ``usage`` stays nested."""
    optional = ["resource_group_id", "pricing_country", "billing_country", "currency_code", "pricing_region",
                "resource_group_name"]
    renamed = documents.withColumnsRenamed(
        {"resource_instance_id": "instance_id", "resource_id": "service_id", "resource_name": "service_name",
         "resource_instance_name": "instance_name"}
    )
    filled = renamed.withColumns({c: F.coalesce(c, F.lit("")) for c in optional})
    return filled.select(*BASE_COLUMNS, "usage")


def metric_rows(instances: DataFrame) -> DataFrame:
    """One row per instance and metric; an instance without usage has none."""
    rest = [c for c in instances.columns if c != "usage"]
    rows = instances.select(*rest, F.explode("usage").alias("u"))
    return rows.select(*rest, *[F.col(f"u.{'discounts' if c == 'discount' else c}").alias(c) for c in METRIC_COLUMNS])


def enrichable(service_id: Column) -> Column:
    return ~F.contains(service_id, F.lit("classic_infrastructure"))


def cloud_users(users: DataFrame, roles: DataFrame, role_order: str) -> DataFrame:
    """Users with the role, organisation, geography and market of the first entry for their email."""
    role = first_by_key(roles, ["email"], [role_order])
    found = lookup_join(
        users, role, "email", "email", {"GTM Role": "role", "OrgName": "org", "Geo": "geo", "Market": "market"},
        spread=["iam_id"],
    )
    return found.select(
        "iam_id", "firstname", "lastname", "state", "email",
        *charges.with_defaults(["role", "org", "geo", "market"]), "added_on", "invitedOn",
    )


def union_servers(virtual: DataFrame, bare_metal: DataFrame) -> DataFrame:
    """All servers; ``bare_metal`` tells the two listings apart."""
    return virtual.withColumn("bare_metal", F.lit(False)).unionByName(
        bare_metal.withColumn("bare_metal", F.lit(True)), allowMissingColumns=True
    )


def named_clusters(clusters: DataFrame, vpcs: DataFrame) -> DataFrame:
    """Clusters with the name of their first network."""
    return lookup_join(
        clusters.withColumn("_vpc", F.get("vpcs", 0)), vpcs, "_vpc", "id", {"name": "vpc"}, spread=["id"]
    ).drop("_vpc")


def named_workers(workers: DataFrame, clusters: DataFrame, subnets: DataFrame) -> DataFrame:
    """Workers with the network of their cluster and the name of their first subnet."""
    placed = lookup_join(workers, clusters, "cluster", "id", ["vpc"], spread=["id"])
    return lookup_join(
        placed.withColumn("_subnet", F.get("networkInterfaces", 0)["subnetID"]),
        subnets, "_subnet", "id", {"name": "subnet"}, spread=["id"],
    ).drop("_subnet")


def volume_sizes(resources: DataFrame) -> DataFrame:
    """Capacity and IOPS of each volume resource, by crn."""
    volume = F.col("extensions.VolumeInfo")
    return resources.filter(volume.isNotNull()).select(
        "crn", volume["Capacity"].alias("Capacity"), volume["IOPS"].alias("IOPS")
    )


def attached_volume_totals(servers: DataFrame, resources: DataFrame) -> DataFrame:
    """Per server: number of data volumes, and their capacity without the boot volume."""
    boot = F.col("boot_volume_attachment.volume.crn")
    volumes = servers.select("crn", boot.alias("_boot"), F.explode("volume_attachments.volume").alias("_volume")).filter(
        ~F.col("_volume.crn").eqNullSafe(F.coalesce("_boot", F.lit("")))
    )
    sized = lookup_join(
        volumes.select(F.col("crn").alias("server"), F.col("_volume.crn").alias("volume")),
        volume_sizes(resources), "volume", "crn", ["Capacity"], spread=["server"],
    )
    totals = sized.groupBy("server").agg(F.sum(F.col("Capacity").cast(charges.QUANTITY)).alias("_capacity"))
    counted = servers.filter(F.col("volume_attachments").isNotNull()).select(
        "crn", (F.size("volume_attachments") - 1).alias("numAttachedDataVolumes")
    )
    return lookup_join(counted, totals, "crn", "server", {"_capacity": "_capacity"}).select(
        "crn",
        "numAttachedDataVolumes",
        F.coalesce(F.col("_capacity").cast("double"), F.lit(0.0)).alias("totalDataVolumeCapacity"),
    )


def with_boot_volume(servers: DataFrame, resources: DataFrame) -> DataFrame:
    """Servers with size and IOPS of their boot volume, 0 if it is not known."""
    found = lookup_join(
        servers.withColumn("_boot", F.col("boot_volume_attachment.volume.crn")),
        volume_sizes(resources), "_boot", "crn", {"Capacity": "_boot_size", "IOPS": "_boot_iops"}, spread=["crn"],
    )
    return found.withColumns(
        {"bootVolumeCapacity": F.coalesce("_boot_size", F.lit(0.0)),
         "bootVolumeIops": F.coalesce("_boot_iops", F.lit(0.0))}
    ).drop("_boot", "_boot_size", "_boot_iops")


def with_image_os(servers: DataFrame, images: DataFrame, initializations: DataFrame) -> DataFrame:
    """Servers with the operating system of their image, which bare metal servers name when initialised."""
    started = lookup_join(
        servers, initializations.select("id", F.col("image.id").alias("image_id")), "id", "id",
        {"image_id": "_started_image"}, spread=["crn"],
    )
    image = F.when(F.col("bare_metal"), F.col("_started_image")).otherwise(F.col("image.id"))
    system = images.select(
        "id",
        *[F.col(f"operating_system.{field}").alias(f"OS{field.capitalize()}") for field in ("name", "vendor", "version")],
    )
    return lookup_join(
        started.withColumn("_image", image), system, "_image", "id", ["OSName", "OSVendor", "OSVersion"], spread=["crn"]
    ).drop("_image", "_started_image")


def with_creator(resources: DataFrame, users: DataFrame) -> DataFrame:
    """Resources with full name and email of their creator, '' if the user is not known."""
    named = users.select(
        "iam_id",
        F.when(
            F.col("firstname").isNotNull() & F.col("lastname").isNotNull(), F.concat_ws(" ", "firstname", "lastname")
        ).alias("created_by_name"),
        F.col("email").alias("created_by_email"),
    )
    found = lookup_join(
        resources, named, "created_by", "iam_id", ["created_by_name", "created_by_email"], spread=["crn"]
    )
    return found.withColumns(
        {c: F.coalesce(c, F.lit("")) for c in ("created_by_name", "created_by_email")}
    )


def resource_attributes(resources: DataFrame) -> DataFrame:
    """Columns every resource record gives; ``profile`` and volume sizes depend on its kind."""
    ext = F.col("extensions")
    kind = F.col("resource_id")
    profile = F.coalesce(
        ext["Profile"],
        F.when(kind == VIRTUAL_SERVER, ext["VirtualMachineProperties"]["Profile"]),
        F.when(kind == BARE_METAL, ext["BMServerProperties"]["Profile"]),
        F.lit(""),
    )
    is_volume = (kind == VOLUME) & ext["VolumeInfo"].isNotNull()
    zero = F.lit(0.0)
    return resources.select(
        "crn",
        kind.alias("_kind"),
        *charges.with_defaults(["created_at"]),
        dates.provision_date(F.col("created_at")).alias("provision_date"),
        *charges.with_defaults(["created_by"]),
        "created_by_name",
        "created_by_email",
        *charges.with_defaults(["updated_at", "updated_by", "deleted_at"]),
        dates.provision_date(F.col("deleted_at")).alias("deprovision_date"),
        *charges.with_defaults(["deleted_by", "restored_at", "restored_by"]),
        F.coalesce("state", F.lit("")).alias("instance_state"),
        *charges.with_defaults(["type"]),
        profile.alias("_profile"),
        F.coalesce(ext["Resource"]["LifecycleAction"], F.lit("")).alias("rcLifecycleAction"),
        F.coalesce(ext["Resource"]["AvailabilityZone"], F.lit("")).alias("_zone"),
        F.when(is_volume, F.coalesce(ext["VolumeInfo"]["Capacity"], zero)).alias("volume_capacity"),
        F.when(is_volume, F.coalesce(ext["VolumeInfo"]["IOPS"], zero)).alias("volume_iops"),
    )


def server_attributes(servers: DataFrame) -> DataFrame:
    """Configuration columns of virtual and bare metal servers by crn."""
    virtual = ~F.col("bare_metal")
    nic = F.col("primary_network_interface")

    def count(column: Column) -> Column:
        return F.coalesce(column, F.lit(0)).cast("long")

    def name(column: Column) -> Column:
        return F.coalesce(column, F.lit(""))

    cores, sockets, threads = F.col("cpu.core_count"), F.col("cpu.socket_count"), F.col("cpu.threads_per_core")
    return servers.select(
        "crn",
        name(F.col("vpc.name")).alias("_server_vpc"),
        name(F.col("zone.name")).alias("_server_zone"),
        name(F.col("profile.name")).alias("_server_profile"),
        name(F.col("reservation.name")).alias("VSI_reservation_name"),
        name(F.col("dedicated_host.name")).alias("VSI_dedicated_host"),
        name(nic["subnet"]["name"]).alias("_server_subnet"),
        name(nic["primary_ip"]["address"]).alias("_server_ip"),
        count(F.col("vcpu.count")).alias("VSI_virtualCPUs"),
        count(F.col("memory")).alias("VSI_memorySizeMiB"),
        count(F.col("numa_count")).alias("VSI_numaCount"),
        name(F.coalesce(F.col("cpu.architecture"), F.col("vcpu.architecture"))).alias("VSI_architecture"),
        name(F.col("vcpu.manufacturer")).alias("VSI_manufacturer"),
        name(F.col("gpu.manufacturer")).alias("VSI_gpu_manufacturer"),
        name(F.col("gpu.model")).alias("VSI_gpu_model"),
        count(F.col("gpu.memory")).alias("VSI_gpu_memory"),
        count(F.col("gpu.count")).alias("VSI_gpu_count"),
        count(F.col("bandwidth")).alias("VSI_totalBandwidth"),
        count(F.col("total_network_bandwidth")).alias("VSI_totalNetworkBandwidth"),
        count(F.col("total_volume_bandwidth")).alias("VSI_totalVolumeBandwidth"),
        F.col("bootVolumeCapacity").alias("VSI_bootVolumeCapacity"),
        F.col("bootVolumeIops").alias("VSI_bootVolumeIops"),
        name(F.col("boot_volume_attachment.volume.crn")).alias("VSI_bootVolumeCRN"),
        name(F.col("boot_volume_attachment.volume.name")).alias("VSI_bootVolumeName"),
        count(F.when(virtual & F.col("disks").isNotNull(), F.size("disks"))).alias("VSI_NumberOfInstStorageDisks"),
        F.col("numAttachedDataVolumes").alias("VSI_numAttachedDataVolumes"),
        F.col("totalDataVolumeCapacity").alias("VSI_totalDataVolumeCapacity"),
        count(cores).alias("BM_numberofCores"),
        count(sockets).alias("BM_numberofSockets"),
        count(threads).alias("BM_ThredsPerCore"),
        F.lit(0).cast("long").alias("BM_bandwidth"),
        count(F.when(~virtual & F.col("disks").isNotNull(), F.size("disks"))).alias("BM_disks"),
        name(F.col("lifecycle_state")).alias("lifecycle_state"),
        name(F.col("health_state")).alias("health_state"),
        name(F.col("status")).alias("status"),
        count(cores).alias("BMnumberofCores"),
        count(sockets).alias("BMnumberofSockets"),
        count(threads).alias("BMthreadsPerCore"),
        F.when(virtual, F.lit(0.0)).otherwise(nested.nvme_total(F.col("disks"))).alias("BMRawStorage"),
        name(F.col("OSName")).alias("OSName"),
        name(F.col("OSVendor")).alias("OSVendor"),
        name(F.col("OSVersion")).alias("OSVersion"),
    )


_COUNT_OF_SERVER = [
    "VSI_virtualCPUs", "VSI_memorySizeMiB", "VSI_numaCount", "VSI_gpu_memory", "VSI_gpu_count", "VSI_totalBandwidth",
    "VSI_totalNetworkBandwidth", "VSI_totalVolumeBandwidth", "VSI_NumberOfInstStorageDisks", "BM_numberofCores",
    "BM_numberofSockets", "BM_ThredsPerCore", "BM_bandwidth", "BM_disks", "BMnumberofCores", "BMnumberofSockets",
    "BMthreadsPerCore",
]
_SIZE_OF_SERVER = ["VSI_bootVolumeCapacity", "VSI_bootVolumeIops", "BMRawStorage"]

ENRICHMENT_COLUMNS = [
    "created_at", "provision_date", "created_by", "created_by_name", "created_by_email", "updated_at", "updated_by",
    "deleted_at", "deprovision_date", "deleted_by", "restored_at", "restored_by", "instance_state", "type",
    "instance_profile", "rcLifecycleAction", "vpc", "zone", "VSI_reservation_name", "VSI_dedicated_host",
    "VSI_primaryNetworkSubnet", "VSI_primaryNetworkPrimaryIp", "VSI_virtualCPUs", "VSI_memorySizeMiB",
    "VSI_numaCount", "VSI_architecture", "VSI_manufacturer", "VSI_gpu_manufacturer", "VSI_gpu_model",
    "VSI_gpu_memory", "VSI_gpu_count", "VSI_totalBandwidth", "VSI_totalNetworkBandwidth", "VSI_totalVolumeBandwidth",
    "VSI_bootVolumeCapacity", "VSI_bootVolumeIops", "VSI_bootVolumeCRN", "VSI_bootVolumeName",
    "VSI_NumberOfInstStorageDisks", "VSI_numAttachedDataVolumes", "VSI_totalDataVolumeCapacity", "BM_numberofCores",
    "BM_numberofSockets", "BM_ThredsPerCore", "BM_bandwidth", "BM_disks", "lifecycle_state", "health_state", "status",
    "BMnumberofCores", "BMnumberofSockets", "BMthreadsPerCore", "BMRawStorage", "OSName", "OSVendor", "OSVersion",
    "volume_capacity", "volume_iops", "cluster_id", "cluster_name", "cluster_workers", "cluster_version",
    "cluster_state", "cluster_status", "worker_name", "worker_state", "worker_health", "worker_version",
    "worker_location", "worker_flavor", "worker_pool", "tags",
]


def instance_dimension(
    resources: DataFrame,
    tags: DataFrame,
    users: DataFrame,
    servers: DataFrame,
    images: DataFrame,
    initializations: DataFrame,
) -> DataFrame:
    """Everything known of an instance, by crn: the lookups by crn are made once per instance, not per usage row.

    All inputs are unique by key. A server counts only with a server's resource record; tags do not need one.
    """
    configured = with_image_os(with_boot_volume(servers, resources), images, initializations)
    volumes = attached_volume_totals(servers, resources)
    configured = lookup_join(
        configured, volumes, "crn", "crn", ["numAttachedDataVolumes", "totalDataVolumeCapacity"]
    )
    config = server_attributes(configured)
    described = resource_attributes(with_creator(resources, users)).withColumn("_known", F.lit(True))
    server_key = F.when(F.col("_kind").isin(VIRTUAL_SERVER, BARE_METAL), F.col("crn"))
    joined = lookup_join(described, config, server_key, "crn", [c for c in config.columns if c != "crn"], spread=["crn"])
    return joined.join(tags.select("crn", "tags"), "crn", "full")


def enriched_instances(
    documents: DataFrame, dimension: DataFrame, clusters: DataFrame, workers: DataFrame
) -> DataFrame:
    """Instance usage documents with all enrichment columns; ``usage`` stays nested.

    One lookup by crn, and for Kubernetes plans one by cluster and one by worker. Classic infrastructure gets
    tags only.
    """
    spread = ["month", "plan_id", "instance_name", "usage"]
    instances = instance_months(documents)
    details = [c for c in dimension.columns if c != "crn"]
    rows = lookup_join(instances, dimension, "instance_id", "crn", details, spread=spread)

    known = enrichable(F.col("service_id")) & F.coalesce("_known", F.lit(False))
    kubernetes = known & (F.col("_kind") == KUBERNETES)
    of_cluster = kubernetes & F.col("plan_id").isin(CLUSTER_PLANS)
    of_worker = kubernetes & F.col("plan_id").isin(WORKER_PLANS)
    name = F.col("instance_name")
    rows = rows.withColumns(
        {
            "_known": known,
            "cluster_id": F.when(of_cluster, name).when(of_worker, text.name_before(name, "_")),
            "worker_name": F.when(of_worker, text.name_after(name, "_")),
        }
    )
    cluster = clusters.select(
        "id",
        F.col("name").alias("cluster_name"),
        F.col("workerCount").alias("cluster_workers"),
        F.col("masterKubeVersion").alias("cluster_version"),
        F.col("state").alias("cluster_state"),
        F.col("status").alias("cluster_status"),
        F.col("vpc").alias("_cluster_vpc"),
    )
    worker = workers.select(
        "id",
        F.col("lifecycle.actualState").alias("worker_state"),
        F.col("health.state").alias("worker_health"),
        F.col("kubeVersion.actual").alias("worker_version"),
        F.col("location").alias("worker_location"),
        F.col("flavor").alias("worker_flavor"),
        F.col("poolName").alias("worker_pool"),
        F.col("vpc").alias("_worker_vpc"),
        F.get("networkInterfaces", 0)["ipAddress"].alias("_worker_ip"),
        F.col("subnet").alias("_worker_subnet"),
    )
    rows = lookup_join(rows, cluster, "cluster_id", "id", [c for c in cluster.columns if c != "id"], spread=spread)
    rows = lookup_join(rows, worker, "worker_name", "id", [c for c in worker.columns if c != "id"], spread=spread)
    return rows.select(*BASE_COLUMNS, *_enrichment(rows), "usage")


def _enrichment(rows: DataFrame) -> list[Column]:
    known = F.col("_known")

    def first_text(*columns: str) -> Column:
        """First value that is neither missing nor ''."""
        found = F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in columns])
        return F.when(known, found)

    special = {
        "instance_profile": first_text("_profile", "_server_profile"),
        "vpc": first_text("_worker_vpc", "_cluster_vpc", "_server_vpc"),
        "zone": first_text("worker_location", "_zone", "_server_zone"),
        "VSI_primaryNetworkSubnet": first_text("_worker_subnet", "_server_subnet"),
        "VSI_primaryNetworkPrimaryIp": first_text("_worker_ip", "_server_ip"),
    }
    # Default of an unknown column; None leaves it NULL.
    defaults = dict.fromkeys(_COUNT_OF_SERVER, "0L") | dict.fromkeys(_SIZE_OF_SERVER, "0D")
    defaults |= dict.fromkeys(
        ["VSI_numAttachedDataVolumes", "VSI_totalDataVolumeCapacity", "volume_capacity", "volume_iops",
         "cluster_workers"]
    )
    out = []
    for name in ENRICHMENT_COLUMNS:
        if name == "tags":
            column = F.coalesce("tags", F.array().cast("array<string>"))
        elif name in special:
            column = F.coalesce(special[name], F.lit(""))
        else:
            default = defaults.get(name, "''")
            column = F.expr(f"CASE WHEN _known THEN coalesce({name}, {default}) ELSE {default} END" if default else
                            f"CASE WHEN _known THEN {name} END")
        out.append(column.alias(name))
    return out


def billing_instances(documents: DataFrame, resources: DataFrame, tags: DataFrame) -> DataFrame:
    """Instance usage as the invoice reports use it: resource record and tags only; ``usage`` stays nested.

    Every resource record counts here, whatever its kind.
    """
    ext = F.col("extensions")
    virtual, metal, volume = ext["VirtualMachineProperties"], ext["BMServerProperties"], ext["VolumeInfo"]

    def by_kind(**fields: str) -> Column:
        of = {"virtual": virtual, "metal": metal}
        picked = None
        for kind in ("virtual", "metal"):
            value = of[kind][fields[kind]] if kind in fields else F.lit(None).cast("string")
            picked = F.when(of[kind].isNotNull(), value) if picked is None else picked.when(of[kind].isNotNull(), value)
        return F.coalesce(picked, F.lit(""))

    no_server = virtual.isNull() & metal.isNull()
    described = resources.select(
        "crn",
        dates.date_text(dates.utc_time(dates.instant(F.col("created_at")))).alias("provision_date"),
        "created_at", "created_by", "updated_at", "updated_by",
        dates.date_text(dates.utc_time(dates.instant(F.col("deleted_at")))).alias("deprovision_date"),
        "deleted_at", "deleted_by", "restored_at", "restored_by",
        F.col("state").alias("instance_state"),
        "type",
        by_kind(virtual="Profile", metal="Profile").alias("instance_profile"),
        by_kind(virtual="CPUFamily").alias("cpu_family"),
        by_kind(virtual="NumberOfVirtualCPUs").alias("numberOfVirtualCPUs"),
        by_kind(virtual="MemorySizeMiB", metal="MemorySizeMiB").alias("MemorySizeMiB"),
        by_kind(virtual="NodeName", metal="NodeName").alias("NodeName"),
        by_kind(virtual="NumberOfGPUs").alias("NumberOfGPUs"),
        by_kind(virtual="NumberOfInstStorageDisks").alias("NumberOfInstStorageDisks"),
        ext["Resource"]["LifecycleAction"].alias("lifecycleAction"),
        by_kind(metal="NumberOfCores").alias("BMnumberofCores"),
        by_kind(metal="NumberOfSockets").alias("BMnumberofSockets"),
        by_kind(metal="Bandwidth").alias("BMbandwidth"),
        by_kind(metal="OSName").alias("OSName"),
        by_kind(metal="OSVendor").alias("OSVendor"),
        by_kind(metal="OSVersion").alias("OSVersion"),
        F.when(no_server, volume["Capacity"]).cast("string").alias("capacity"),
        F.when(no_server, volume["IOPS"]).cast("string").alias("iops"),
        ext["Resource"]["AvailabilityZone"].alias("availability_zone"),
    )
    roles = tags.select("crn", "tags", nested.role_tags(F.col("tags")).alias("instance_role"))
    dimension = described.join(roles, "crn", "full")
    details = [c for c in dimension.columns if c != "crn"]
    rows = lookup_join(
        instance_months(documents), dimension, "instance_id", "crn", details,
        spread=["month", "plan_id", "instance_name", "usage"],
    )
    filled = {c: F.coalesce(c, F.lit("")) for c in details if c != "tags"}
    return rows.withColumns({**filled, "tags": F.coalesce("tags", F.array().cast("array<string>"))})
