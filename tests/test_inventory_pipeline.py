import pytest

from cloudtally.plans import inventory, storage
from cloudtally.sources import landing


def component(name, port, **more):
    return {"name": name, "port": port, "macAddress": f"{name}{port}", "speed": 1000, "status": "ACTIVE",
            "router": {"hostname": "r1"}, "uplinkComponent": {"id": port + 100}} | more


FULL = {
    "id": 1, "fullyQualifiedDomainName": "a.x.com", "networkGatewayMemberFlag": True, "manufacturerSerialNumber": "sn1",
    "provisionDate": "2023-05-01T00:30:00-06:00", "notes": "hello", "datacenter": {"name": "dal10"},
    "motherboard": {"hardwareComponentModel": {"longDescription": "board"}},
    "processors": [{"hardwareComponentModel": {"longDescription": "cpu"}}],
    "softwareComponents": [{"softwareLicense": {"softwareDescription": {"name": "VSphere", "version": "8"}}}],
    "networkVlans": [{"id": 7, "vlanNumber": 700, "fullyQualifiedName": "dal10.700", "name": "front"},
                     {"id": 8, "vlanNumber": 800, "fullyQualifiedName": "dal10.800", "vrfDefinitionId": 5}],
    "frontendNetworkComponents": [component("eth", 1, uplinkComponent={"id": 101, "networkVlanId": 7},
                                            primarySubnet={"networkIdentifier": "150.0.0.0", "cidr": 28})],
    "backendNetworkComponents": [
        component("eth", 0, uplinkComponent={"id": 100, "networkVlanId": 8}, duplexMode={"keyname": "FULL"},
                  primarySubnet={"networkIdentifier": "10.0.0.0", "cidr": 26}),
        component("eth", 2), component("mgmt", 0, ipmiMacAddress="old"), component("mgmt", 0, ipmiMacAddress="ipmi")],
    "activeComponents": [{"modifyDate": "2024-01-01", "hardwareComponentModel": {
        "manufacturer": "Maker", "name": "A very long name of a part", "hardwareGenericComponentModel": {
            "description": "RAM", "hardwareComponentType": {"type": "RAM"}}}}],
}
BARE = {
    "id": 2, "fullyQualifiedDomainName": "b.x.com", "networkGatewayMemberFlag": False, "manufacturerSerialNumber": "sn2",
    "provisionDate": "", "notes": "", "datacenterName": "dal12", "datacenter": {"name": "ignored"},
    "networkVlans": [], "frontendNetworkComponents": [], "backendNetworkComponents": [], "activeComponents": [],
}
TRUNKS = [
    {"componentId": 100, "networkVlan": {"vlanNumber": 20, "fullyQualifiedName": "dal10.20", "name": "twenty"}},
    {"componentId": 100, "networkVlan": {"vlanNumber": 3, "fullyQualifiedName": "dal10.3"}},
    {"componentId": 100, "networkVlan": {"vlanNumber": 3, "fullyQualifiedName": "dal10.3"}},
    {"componentId": 999, "networkVlan": {"vlanNumber": 1, "fullyQualifiedName": "x.1"}},
]


@pytest.fixture
def hardware(spark, land):
    return landing.read_entity(spark, land("hardware", [FULL, BARE]), "hardware")


@pytest.fixture
def trunks(spark, land):
    return landing.read_entity(spark, land("trunks", TRUNKS), "trunks")


def test_hardware_table(hardware, trunks):
    found = {r.id: r for r in inventory.hardware_table(hardware, trunks).collect()}
    full, bare = found[1], found[2]
    assert (full.datacenterName, full.processor, full.motherboard, full.version) == ("dal10", "cpu", "board", "8")
    assert (full.backend_primarySubnet, full.frontend_primarySubnet) == ("10.0.0.0/26", "150.0.0.0/28")
    assert (full.eth0_vlan, full.eth0_vlanName, full.eth0_vrfId, full.eth0_duplexMode) == ("dal10.800", None, 5, "FULL")
    assert (full.eth1_vlan, full.eth1_vlanName, full.eth2_mac, full.eth2_vlan) == ("dal10.700", "front", "eth2", None)
    assert (full.eth0_networkvlanTrunks, full.eth2_networkvlanTrunks, full.eth1_networkvlanTrunks) == ("(3) , (20) twenty", "", None)
    assert (full.mgmt0_mac, bare.mgmt0_mac) == ("ipmi", None)
    assert (bare.datacenterName, bare.operatingSystem, bare.backend_primarySubnet, bare.eth0_mac) == ("dal12", "", None, None)


def test_trunked_vlans(hardware, trunks):
    rows = inventory.trunked_vlans(hardware, trunks)
    assert sorted((r.fullyQualifiedDomainName, r.vlanNumber, r.vlanName, r.interface) for r in rows.collect()) == [
        ("a.x.com", "dal10.20", "twenty", "eth0"), ("a.x.com", "dal10.3", "", "eth0"),
    ]
    counts = inventory.tagged_vlans_by_server(rows).collect()
    assert sorted((r.fullyQualifiedDomainName, r.interface_count) for r in counts) == [("Count", 1), ("a.x.com", 1), ("a.x.com", 1)]


def test_counts(hardware):
    rows = inventory.hardware_report_rows(hardware)
    assert [(r.datacenterName, r.Total_Count) for r in inventory.private_subnet_counts(rows).collect()] == [("Count", 0)]
    months = inventory.provision_month_counts(rows).collect()
    assert sorted((r.provisionMonth, r.operatingSystem, r.Total_Count) for r in months) == [
        ("", "", 1), ("2023-05", "VSphere", 1), ("Count", "", 2),
    ]


def test_server_report(spark, hardware, trunks, land):
    allowed = [{"accountId": "1", "id": 1, "datacenter": {"name": "dal10"}, "allowedNetworkStorage": [
        {"id": 5, "nasType": "NAS", "capacityGb": 100, "serviceResourceBackendIpAddress": "10.1.1.1", "notes": "n"},
        {"id": 6, "nasType": "ISCSI", "capacityGb": 100, "iops": 2}]}]
    volumes = landing.read_entity(spark, land("allowed_storage", allowed), "allowed_storage")
    report = inventory.server_report(hardware, trunks, volumes)
    text = [r.value for r in report.filter("id = 1").orderBy("section", "line").collect()]
    assert text[2:4] == ["Id              : 1", "Hostname        : a.x.com"]
    assert "Gateway Member  : True" in text and "Provision Date  : 2023-05-01T00:30:00-06:00" in text
    assert f"{'RAM':15} {'Maker':15} {'A very long name of ':20} {'RAM':30} {'2024-01-01':25} {'':15}" in text
    trunk = text.index("TAGGED VLANS BY INTERFACE")
    assert text[trunk + 1].split() == ["Interface", "Vlan", "VlanName"]
    assert text[trunk + 3 : trunk + 5] == [f"{'eth0':10} {'dal10.3':16} {'':25}", f"{'eth0':10} {'dal10.20':16} {'twenty':25}"]
    assert f"{'NAS':11} {'10.1.1.1':40} {'100':10} {'':10} {'n':50}" in text
    assert f"{'ISCSI':11} {'':40} {'':10} {'':10} {'':50}" in text
    bare = [r.value for r in report.filter("id = 2").orderBy("section", "line").collect()]
    assert "MGMT NETWORK" in bare and "NETWORK STORAGE ASSOCIATED WITH HARDWARE" not in bare


def storage_record(account, server, volumes=1):
    return {"accountId": account, "id": server, "datacenter": {"name": "dc"}, "softwareComponents": [],
            "allowedNetworkStorage": [{"id": server * 10 + i, "nasType": "NAS", "capacityGb": 500} for i in range(volumes)]}


def test_account_of_many_servers(spark):
    accounts = spark.createDataFrame([("big",)], "accountId string")
    servers = spark.range(5000).selectExpr(
        "'big' as accountId", "id", "named_struct('name', 'dc') as datacenter",
        "array(named_struct('id', id, 'nasType', 'NAS', 'iops', 1D, 'capacityGb', 5L, 'bytesUsed', 0L)) as allowedNetworkStorage",
        "cast(null as array<struct<softwareLicense:struct<softwareDescription:struct<name:string>>>>) as softwareComponents",
    )
    errors = spark.createDataFrame([], "accountId string, error string")
    found = storage.account_records(accounts, servers, errors)
    assert found.count() == 5000 and found.filter("size(storage) = 1 and error is null").count() == 5000


def test_account_records(spark, land, tmp_path):
    listing = tmp_path / "accounts.csv"
    listing.write_text("a1, first\n\n  a2  \na3\na4\n")
    accounts = landing.read_accounts(spark, str(listing))
    assert [r.accountId for r in accounts.collect()] == ["a1", "a2", "a3", "a4"]
    records = [storage_record("a1", i) for i in range(1, 41)] + [storage_record("a2", 50, 0), storage_record("a3", 60)]
    allowed = landing.read_entity(spark, land("allowed_storage", records), "allowed_storage")
    errors = landing.read_entity(spark, land("fetch_errors", [{"accountId": "a3", "error": "denied"}]), "fetch_errors")
    found = storage.account_records(accounts, allowed, errors).collect()
    by_account = {}
    for r in found:
        by_account.setdefault((r.accountId, r.error), []).append(r.hardwareId)
    assert {k: sorted(v, key=str) for k, v in by_account.items()} == {
        ("a1", None): sorted(range(1, 41), key=str), ("a2", None): [None], ("a3", "denied"): [None], ("a4", None): [None],
    }
    volume = next(r for r in found if r.hardwareId == 1).storage[0]
    assert (volume.storageType, volume.iops, volume.bytesUsed) == ("NAS", 0.0, 0)
    assert tuple(storage.account_summary(accounts, errors).first()) == (4, 3, 1)
