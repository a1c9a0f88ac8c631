import pytest
from pyspark.sql import functions as F

from cloudtally.plans import usage, usage_reports as reports
from cloudtally.sources import landing


def metric(name="GIGABYTE_HOURS", cost=1.5, **more):
    return {"metric": name, "unit": "U", "unit_name": "U", "metric_name": name, "quantity": 2, "rateable_quantity": 2,
            "cost": cost, "rated_cost": cost * 2, "price": [], "discounts": []} | more


def instance(crn, kind, metrics, month="2024-01", plan="p", name="n", **more):
    return {"account_id": "a", "resource_instance_id": crn, "resource_instance_name": name, "month": month, "plan_id": plan,
            "plan_name": plan, "billable": True, "pricing_plan_id": "pp", "region": "us-south", "resource_id": kind,
            "resource_name": more.pop("service", kind), "usage": metrics} | more


USAGE = [
    instance("vm", "is.instance", [metric(), metric("VCPU_HOURS", 2.0)]),
    instance("vm", "is.instance", [metric()], "2024-02"),
    instance("metal", "is.bare-metal-server", [metric()]),
    instance("data", "is.volume", [metric()], resource_group_name="g"),
    instance("k", "containers-kubernetes", [metric()], plan="containers.kubernetes.vpc.gen2", name="c1_w1"),
    instance("k", "containers-kubernetes", [metric()], plan="containers.kubernetes.cluster", name="c1"),
    instance("gone", "is.instance", [metric()]),
    instance("vm", "classic_infrastructure.x", [metric()]),
    instance("quiet", "is.volume", []),
    instance("cos", "cloud-object-storage", [metric(cost=0.1)], service="Cloud Object Storage"),
]

RESOURCES = [
    {"crn": "vm", "resource_id": "is.instance", "created_at": "2023-01-01T23:30:00-0500", "created_by": "u1",
     "state": "old", "extensions": {"VirtualMachineProperties": {"Profile": "bx2"}, "Resource": {
         "AvailabilityZone": "us-south-1", "Location": {"Region": "us-south"}}}},
    {"crn": "metal", "resource_id": "is.bare-metal-server", "created_by": "nobody", "deleted_at": "2024-01-03T00:00:00Z",
     "extensions": {"Profile": "own", "BMServerProperties": {"Profile": "bm"}}},
    {"crn": "data", "resource_id": "is.volume", "extensions": {"VolumeInfo": {"Capacity": 100, "IOPS": 3000}}},
    {"crn": "boot", "resource_id": "is.volume", "extensions": {"VolumeInfo": {"Capacity": 250, "IOPS": 1}}},
    {"crn": "k", "resource_id": "containers-kubernetes"},
    {"crn": "quiet", "resource_id": "is.volume"},
]

SERVERS = [
    {"crn": "vm", "id": "i-vm", "vcpu": {"count": 4, "architecture": "amd64", "manufacturer": "intel"}, "memory": 16,
     "vpc": {"name": "vpc1"}, "zone": {"name": "us-south-2"}, "profile": {"name": "fallback"}, "image": {"id": "img"},
     "boot_volume_attachment": {"volume": {"crn": "boot", "name": "b"}},
     "volume_attachments": [{"volume": {"crn": "boot", "name": "b", "id": "1"}},
                            {"volume": {"crn": "data", "name": "d", "id": "2"}},
                            {"volume": {"crn": "unknown", "name": "e", "id": "3"}}],
     "gpu": {"manufacturer": "nv", "model": "m", "memory": 1, "count": 2}},
]

METAL = [{"crn": "metal", "id": "i-metal", "zone": {"name": "eu-de-1"}, "cpu": {"architecture": "x86", "core_count": 8,
          "socket_count": 2, "threads_per_core": 2}, "disks": [{"interface_type": "nvme", "size": 3200},
          {"interface_type": "sata", "size": 960}]}]


@pytest.fixture
def read(spark, land):
    folder = land("instance_usage", USAGE)
    land("resources", RESOURCES)
    land("resources", [RESOURCES[0] | {"state": "new"}], page=2)
    land("tags", [{"crn": "vm", "tags": ["role:app"]}, {"crn": "gone", "tags": ["x"]}])
    land("cloud_users", [{"iam_id": "u1", "firstname": "Ada", "lastname": "L", "email": "a@b", "state": "ACTIVE"}])
    land("user_roles", [{"email": "a@b", "GTM Role": "first"}, {"email": "a@b", "GTM Role": "second"}])
    land("virtual_servers", SERVERS)
    land("bare_metal_servers", METAL)
    land("images", [{"id": "img", "operating_system": {"name": "ubuntu", "vendor": "C", "version": "22"}},
                    {"id": "esx", "operating_system": {"name": "esxi", "vendor": "V", "version": "8"}}])
    land("initializations", [{"id": "i-metal", "image": {"id": "esx"}}])
    land("clusters", [{"id": "c1", "name": "prod", "region": "us-south", "workerCount": 3, "vpcs": ["v1"], "state": "normal"}])
    land("workers", [{"cluster": "c1", "id": "w1", "location": "us-south-3", "flavor": "bx2.4", "poolName": "default",
                      "networkInterfaces": [{"subnetID": "s1", "ipAddress": "10.0.0.5"}]}])
    land("vpcs", [{"id": "v1", "name": "vpc-prod"}])
    land("subnets", [{"id": "s1", "name": "sub-prod"}])
    return lambda name: landing.read_entity(spark, folder, name), lambda name, key: landing.read_latest(
        spark, folder, name, key
    )


@pytest.fixture
def enriched(read):
    every, latest = read
    users = usage.cloud_users(every("cloud_users"), every("user_roles").withColumn("place", F.monotonically_increasing_id()), "place")
    servers = usage.union_servers(every("virtual_servers"), every("bare_metal_servers"))
    dimension = usage.instance_dimension(
        latest("resources", "crn"), latest("tags", "crn"), users, servers, every("images"), every("initializations")
    )
    clusters = usage.named_clusters(latest("clusters", "id"), every("vpcs"))
    workers = usage.named_workers(latest("workers", "id"), clusters, every("subnets"))
    return usage.enriched_instances(every("instance_usage"), dimension, clusters, workers)


def test_enrichment(enriched):
    rows = {(r.instance_id, r.service_id, r.month, r.plan_id): r for r in enriched.collect()}
    assert len(rows) == len(USAGE)
    vm = rows["vm", "is.instance", "2024-01", "p"]
    assert (vm.instance_state, vm.provision_date, vm.created_by_name, vm.created_by_email) == (
        "new", "2023-01-02", "Ada L", "a@b",
    )
    assert (vm.instance_profile, vm.vpc, vm.zone, vm.OSName, vm.VSI_virtualCPUs) == ("bx2", "vpc1", "us-south-1", "ubuntu", 4)
    assert (vm.VSI_bootVolumeCapacity, vm.VSI_numAttachedDataVolumes, vm.VSI_totalDataVolumeCapacity) == (250.0, 2, 100.0)
    assert (vm.VSI_gpu_count, vm.tags, vm.deprovision_date) == (2, ["role:app"], "")
    metal = rows["metal", "is.bare-metal-server", "2024-01", "p"]
    assert (metal.instance_profile, metal.zone, metal.OSName, metal.deprovision_date) == ("own", "eu-de-1", "esxi", "2024-01-03")
    assert (metal.BM_numberofCores, metal.BM_disks, metal.BMRawStorage, metal.VSI_numAttachedDataVolumes) == (8, 2, 3200.0, None)
    volume = rows["data", "is.volume", "2024-01", "p"]
    assert (volume.volume_capacity, volume.volume_iops, volume.resource_group_name) == (100.0, 3000.0, "g")
    worker = rows["k", "containers-kubernetes", "2024-01", "containers.kubernetes.vpc.gen2"]
    assert (worker.cluster_id, worker.cluster_name, worker.worker_name, worker.zone, worker.vpc) == (
        "c1", "prod", "w1", "us-south-3", "vpc-prod",
    )
    assert (worker.VSI_primaryNetworkSubnet, worker.VSI_primaryNetworkPrimaryIp) == ("sub-prod", "10.0.0.5")
    cluster = rows["k", "containers-kubernetes", "2024-01", "containers.kubernetes.cluster"]
    assert (cluster.cluster_id, cluster.cluster_workers, cluster.worker_name, cluster.vpc) == ("c1", 3, "", "vpc-prod")
    gone = rows["gone", "is.instance", "2024-01", "p"]
    assert (gone.instance_state, gone.vpc, gone.VSI_virtualCPUs, gone.tags, gone.volume_capacity) == ("", "", 0, ["x"], None)
    classic = rows["vm", "classic_infrastructure.x", "2024-01", "p"]
    assert (classic.instance_state, classic.instance_profile, classic.tags) == ("", "", ["role:app"])


def test_reports(enriched):
    rows = usage.metric_rows(enriched).cache()
    assert rows.count() == 10
    months = ["2024-01", "2024-02"]
    servers = {r.region + r.instance_profile: r for r in reports.virtual_server_summary(rows, months).collect()}
    total = servers["Total"]
    assert (total["instance_count_2024-01"], total["instance_count_2024-02"], total["instance_count_Total"]) == (2, 1, 2)
    assert total["cost_Total"] == 6.5
    volumes = reports.volumes_summary(rows, months).collect()
    assert sorted((r.region, r.volume_capacity, r.cost_Total) for r in volumes) == [("Total", "", 1.5), ("us-south", "100.0", 1.5)]
    assert {r.worker_name for r in reports.kubernetes_summary(rows, months).collect()} == {"", "w1"}
    users = reports.servers_by_user(rows, months).collect()
    assert {r.created_by_name: r["cost_2024-01"] for r in users} == {"Ada L": 3.5, "": pytest.approx(1.5), "Total": 6.5}
    built = reports.usage_report_set(rows, rows, months)
    assert "COSBuckets" in built and built["COSBuckets"]().count() == 2


def test_billing_instances(read):
    every, latest = read
    rows = usage.metric_rows(usage.billing_instances(every("instance_usage"), latest("resources", "crn"), latest("tags", "crn")))
    servers = reports.charges_by_server_month(rows).collect()
    found = {(r.month, r.instance_id, r.instance_role): (r.cost, r.rated_cost) for r in servers if not r.is_total}
    assert found == {
        ("2024-01", "vm", "app"): (3.5, 7.0), ("2024-02", "vm", "app"): (1.5, 3.0), ("2024-01", "metal", ""): (1.5, 3.0),
        ("2024-01", "gone", ""): (1.5, 3.0),
    }
    assert {r.month: r.cost for r in servers if r.is_total} == {"2024-01": 6.5, "2024-02": 1.5}
    volumes = reports.charges_by_volume_month(rows).collect()
    assert sorted((r.instance_id, r.capacity, r.iops, r.cost) for r in volumes) == [("", "", "", 1.5), ("data", "100.0", "3000.0", 1.5)]


def test_account_usage(spark, land):
    document = {"account_id": "a", "month": "2024-01", "currency_code": "USD", "billing_country": "USA", "resources": [
        {"resource_id": "r", "resource_name": "R", "billable_cost": 1, "billable_rated_cost": 2, "plans": [
            {"plan_id": "p", "plan_name": "P", "usage": [
                metric(discounts=[{"discount": 0.1}, {"discount": 0.2}], price=["t1"]), metric("OTHER")]},
            {"plan_id": "q", "plan_name": "Q", "usage": []}]},
        {"resource_id": "s", "resource_name": "S", "billable_cost": 0, "billable_rated_cost": 0, "plans": []}]}
    rows = usage.account_usage(landing.read_entity(spark, land("account_usage", [document]), "account_usage"))
    assert sorted((r.plan_id, r.metric, r.discount, r.price) for r in rows.collect()) == [
        ("p", "GIGABYTE_HOURS", 0.1, '["t1"]'), ("p", "OTHER", None, "[]"),
    ]
    summary = reports.cloud_usage_summary(rows, ["2024-01"]).collect()
    assert {r.resource_name: (r.rated_cost_Total, r.cost_Total) for r in summary} == {"R": (6.0, 3.0), "Total": (6.0, 3.0)}


def test_no_usage_gives_an_empty_table_with_columns(spark, land):
    rows = usage.account_usage(landing.read_entity(spark, land("account_usage", []), "account_usage"))
    assert rows.collect() == [] and "price" in rows.columns
    assert reports.usage_summary(rows, ["2024-01"]).collect() == []
