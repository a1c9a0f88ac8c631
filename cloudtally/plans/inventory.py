"""Hardware inventory: wide interface table, trunked VLANs, distinct-count pivots and the server report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudtally.functions import dates, nested
from cloudtally.functions.text import fixed_width
from cloudtally.operators.lookup import latest_by_key, lookup_join
from cloudtally.operators.pivot import Measure, pivot_report

# Fixed values.
INTERFACES = [f"eth{n}" for n in range(11)]
MANAGEMENT = "mgmt0"
ATTRIBUTES = ["mac", "primaryIpAddress", "speed", "duplexMode", "status", "vlan", "vlanName", "vrfId", "router",
              "router_ip"]


def _vlan(vlans: Column, vlan_id: Column) -> Column:
    """The server's VLAN with an id; a later entry replaces an earlier one."""
    return F.try_element_at(F.filter(vlans, lambda v: v["id"] == vlan_id), F.lit(-1))


def _attributes(component: Column, vlans: Column, management: bool = False) -> Column:
    """An interface with its VLAN as one flat struct."""
    vlan = _vlan(vlans, component["uplinkComponent"]["networkVlanId"])
    mac, ip = ("ipmiMacAddress", "ipmiIpAddress") if management else ("macAddress", "primaryIpAddress")
    return F.struct(
        nested.interface_name(component).alias("interface"),
        component["uplinkComponent"]["id"].alias("component"),
        component[mac].alias("mac"),
        component[ip].alias("primaryIpAddress"),
        component["speed"].alias("speed"),
        component["duplexMode"]["keyname"].alias("duplexMode"),
        component["status"].alias("status"),
        vlan["fullyQualifiedName"].alias("vlan"),
        vlan["name"].alias("vlanName"),
        vlan["vrfDefinitionId"].alias("vrfId"),
        vlan["vlanNumber"].alias("vlanNumber"),
        component["router"]["hostname"].alias("router"),
        component["router"]["primaryIpAddress"].alias("router_ip"),
    )


def _ethernet(components: str) -> Column:
    return F.filter(components, lambda c: c["name"] == "eth")


def interfaces(hardware: DataFrame) -> DataFrame:
    """Hardware with flat interface lists ``_front``, ``_back`` and the management interface ``_mgmt``."""
    vlans = F.col("networkVlans")
    return hardware.withColumns(
        {
            "_front": F.transform(_ethernet("frontendNetworkComponents"), lambda c: _attributes(c, vlans)),
            "_back": F.transform(_ethernet("backendNetworkComponents"), lambda c: _attributes(c, vlans)),
            "_last_mgmt": nested.last_named(F.col("backendNetworkComponents"), "mgmt"),
        }
    ).withColumn("_mgmt", F.when(F.col("_last_mgmt").isNotNull(), _attributes(F.col("_last_mgmt"), vlans, True)))


def server_fields() -> list[Column]:
    """Columns a server has once."""
    software = nested.first_field(F.col("softwareComponents"), "softwareLicense", "softwareDescription")
    blank = F.lit("")
    return [
        F.coalesce(software["name"], blank).alias("operatingSystem"),
        F.coalesce(software["version"], blank).alias("version"),
        F.coalesce("datacenterName", "datacenter.name").alias("datacenterName"),
        F.coalesce("motherboard.hardwareComponentModel.longDescription", blank).alias("motherboard"),
        F.coalesce(
            nested.first_field(F.col("processors"), "hardwareComponentModel", "longDescription"), blank
        ).alias("processor"),
    ]


def primary_subnets() -> list[Column]:
    """Last subnet of the backend interfaces, and of any frontend one ('' if the server has interfaces without)."""

    def last(components: Column) -> Column:
        with_subnet = F.filter(components, lambda c: c["primarySubnet"].isNotNull())
        return nested.subnet_cidr(F.try_element_at(with_subnet, F.lit(-1))["primarySubnet"])

    front = F.when(
        F.size(_ethernet("frontendNetworkComponents")) > 0,
        F.coalesce(last(F.col("frontendNetworkComponents")), F.lit("")),
    )
    return [
        last(_ethernet("backendNetworkComponents")).alias("backend_primarySubnet"),
        front.alias("frontend_primarySubnet"),
    ]


def distinct_trunks(trunks: DataFrame) -> DataFrame:
    """One row per component and VLAN number, however often its page was landed."""
    flat = trunks.select(
        "componentId",
        "networkVlan.vlanNumber",
        "networkVlan.fullyQualifiedName",
        F.coalesce("networkVlan.name", F.lit("")).alias("name"),
    )
    return latest_by_key(flat, ["componentId", "vlanNumber"], ["fullyQualifiedName", "name"])


def trunk_lists(trunks: DataFrame) -> DataFrame:
    """Trunked VLANs per component as text, by VLAN number.

    The list is bounded: VLAN numbers have 12 bits and each is there once.
    """
    listed = distinct_trunks(trunks).groupBy("componentId").agg(
        F.sort_array(F.collect_list(F.struct("vlanNumber", "name"))).alias("_trunks")
    )
    return listed.select("componentId", nested.trunk_text(F.col("_trunks")).alias("trunks"))


def interface_trunks(hardware: DataFrame, trunks: DataFrame) -> DataFrame:
    """Per server: ``<interface>_networkvlanTrunks``, '' for a backend interface without trunks."""
    uplinks = interfaces(hardware).select("id", F.explode("_back").alias("_b")).select(
        "id", "_b.interface", "_b.component"
    )
    found = lookup_join(uplinks, trunk_lists(trunks), "component", "componentId", ["trunks"], spread=["id"])
    return (
        found.withColumn("trunks", F.coalesce("trunks", F.lit("")))
        .groupBy("id")
        .pivot("interface", INTERFACES)
        .agg(F.max("trunks"))
        .withColumnsRenamed({name: f"{name}_networkvlanTrunks" for name in INTERFACES})
    )


def _with_ethernets(rows: DataFrame) -> DataFrame:
    """Adds each side's ethernet interfaces in the order of ``INTERFACES`` (of equal names the last), found once a row."""

    def found(side: str) -> Column:
        named = F.array(*[F.lit(i) for i in INTERFACES])
        return F.transform(named, lambda i: F.try_element_at(F.filter(F.col(side), lambda c: c["interface"] == i), F.lit(-1)))

    return rows.withColumns({f"{side}_ethernets": found(side) for side in ("_back", "_front")})


def _attribute(interface: str, name: str) -> Column:
    """An attribute of an ethernet interface. A backend interface's value wins over a frontend's."""
    place = INTERFACES.index(interface)
    picked = [F.col(f"{side}_ethernets")[place][name] for side in ("_back", "_front")]
    return F.coalesce(*picked).alias(f"{interface}_{name}")


def _wide_columns() -> list[Column]:
    """One column per interface and attribute, from the interface lists of the row itself."""
    managed = F.col("_mgmt.interface") == MANAGEMENT
    return [_attribute(i, a) for i in INTERFACES for a in ATTRIBUTES] + [
        F.when(managed, F.col(f"_mgmt.{a}")).alias(f"{MANAGEMENT}_{a}") for a in ATTRIBUTES
    ]


def interfaces_wide(hardware: DataFrame) -> DataFrame:
    return _with_ethernets(interfaces(hardware)).select("id", *_wide_columns())


def hardware_table(hardware: DataFrame, trunks: DataFrame) -> DataFrame:
    """One row per server: its fields, subnets, all interfaces and their trunks."""
    servers = _with_ethernets(interfaces(hardware)).select(
        "id", "networkGatewayMemberFlag", "fullyQualifiedDomainName", *server_fields(), "manufacturerSerialNumber",
        "provisionDate", "notes", *primary_subnets(), *_wide_columns(),
    )
    return servers.join(interface_trunks(hardware, trunks), "id", "left")


def hardware_report_rows(hardware: DataFrame) -> DataFrame:
    """The columns the inventory pivots need, without any join."""
    return _with_ethernets(interfaces(hardware)).select(
        "id",
        *server_fields(),
        "provisionDate",
        *primary_subnets(),
        *[_attribute(i, a) for i in ("eth0", "eth1") for a in ("vlan", "vlanName")],
    )


def trunked_vlans(hardware: DataFrame, trunks: DataFrame) -> DataFrame:
    """One row per trunked VLAN of each backend interface."""
    uplinks = interfaces(hardware).select(
        *server_fields(), "fullyQualifiedDomainName", "networkGatewayMemberFlag", F.explode("_back").alias("_b")
    ).select(
        "datacenterName", "fullyQualifiedDomainName", "networkGatewayMemberFlag", "operatingSystem", "version",
        "_b.interface", "_b.component",
    )
    rows = lookup_join(
        distinct_trunks(trunks), uplinks, "componentId", "component",
        ["datacenterName", "fullyQualifiedDomainName", "networkGatewayMemberFlag", "operatingSystem", "version",
         "interface"],
        spread=["vlanNumber"], how="inner",
    )
    return rows.select(
        "datacenterName", F.col("fullyQualifiedName").alias("vlanNumber"), F.col("name").alias("vlanName"),
        "fullyQualifiedDomainName", "networkGatewayMemberFlag", "operatingSystem", "version", "interface",
    )


_SERVERS = [Measure("Total_Count", "distinct", "id")]
_TRUNKED = [Measure("interface_count", "distinct", "interface")]


def _counts(rows: DataFrame, *keys: str) -> DataFrame:
    return pivot_report(rows, keys, _SERVERS, total="Count", total_of_nothing=True)


def private_subnet_counts(rows: DataFrame) -> DataFrame:
    return _counts(rows, "datacenterName", "backend_primarySubnet", "eth0_vlan", "eth0_vlanName")


def public_subnet_counts(rows: DataFrame) -> DataFrame:
    return _counts(rows, "datacenterName", "frontend_primarySubnet", "eth1_vlan", "eth1_vlanName")


def processor_counts(rows: DataFrame) -> DataFrame:
    return _counts(rows, "datacenterName", "processor")


def motherboard_counts(rows: DataFrame) -> DataFrame:
    return _counts(rows, "datacenterName", "motherboard")


def provision_month_counts(rows: DataFrame) -> DataFrame:
    dated = rows.withColumn("provisionMonth", dates.provision_month(F.col("provisionDate")))
    return _counts(dated, "provisionMonth", "motherboard", "processor", "operatingSystem")


def servers_by_os(rows: DataFrame) -> DataFrame:
    return _counts(rows, "operatingSystem", "version")


def _with_flag_text(trunked: DataFrame) -> DataFrame:
    return trunked.withColumn("networkGatewayMemberFlag", F.col("networkGatewayMemberFlag").cast("string"))


def servers_by_trunked_vlan(trunked: DataFrame) -> DataFrame:
    keys = ["datacenterName", "vlanNumber", "vlanName", "fullyQualifiedDomainName", "networkGatewayMemberFlag",
            "operatingSystem", "version"]
    return pivot_report(_with_flag_text(trunked), keys, _TRUNKED, total="Count", total_of_nothing=True)


def tagged_vlans_by_server(trunked: DataFrame) -> DataFrame:
    keys = ["fullyQualifiedDomainName", "operatingSystem", "version", "datacenterName", "vlanNumber", "vlanName"]
    return pivot_report(trunked, keys, _TRUNKED, total="Count", total_of_nothing=True)


def inventory_report_set(hardware: DataFrame, trunks: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """All inventory reports by name, built when asked for."""
    rows = hardware_report_rows(hardware)
    return {
        "HW_Detail": lambda: hardware_table(hardware, trunks),
        "PrivateSubnetPivot": lambda: private_subnet_counts(rows),
        "PublicSubnetPivot": lambda: public_subnet_counts(rows),
        "ProcessorPivot": lambda: processor_counts(rows),
        "MotherboardPivot": lambda: motherboard_counts(rows),
        "ProvisionMonth": lambda: provision_month_counts(rows),
        "ServerByOSPivot": lambda: servers_by_os(rows),
        "trunkedVLAN_Detail": lambda: trunked_vlans(hardware, trunks),
        "ServersByTrunkedVlanPivot": lambda: servers_by_trunked_vlan(trunked_vlans(hardware, trunks)),
        "TaggedVlanByServer": lambda: tagged_vlans_by_server(trunked_vlans(hardware, trunks)),
    }


# Fixed values: (heading, column, width) of the server report's tables.
NETWORK_FORMAT = [
    ("Iface", "interface", 6),
    ("MAC ", "mac", 17),
    ("IpAddress", "primaryIpAddress", 16),
    ("Speed", "speed", 5),
    ("Duplex", "duplexMode", 6),
    ("Status", "status", 8),
    ("Vlan", "vlanNumber", 5),
    ("FQDN", "vlan", 16),
    ("Vlan Name", "vlanName", 20),
    ("Router", "router", 14),
    ("RouterIP", "router_ip", 16),
    ("VRF_ID", "vrfId", 8),
]
COMPONENT_FORMAT = [
    ("Type   ", "devicetype", 15),
    ("Manufacturer", "manufacturer", 15),
    ("Name", "name", 20),
    ("Description", "description", 30),
    ("Modify Date", "modifydate", 25),
    ("Serial Number", "serialnumber", 15),
]
TRUNK_FORMAT = [("Interface", "interface", 10), ("Vlan", "fullyQualifiedName", 16), ("VlanName", "name", 25)]
STORAGE_FORMAT = [
    ("StorageType", "type", 11),
    ("Address", "address", 40),
    ("Gb", "capacity", 10),
    ("IOPS", "iops", 10),
    ("Notes", "notes", 50),
]
RULE = "_" * 114


def component_struct(device: Column) -> Column:
    model = device["hardwareComponentModel"]
    generic = model["hardwareGenericComponentModel"]
    return F.struct(
        generic["hardwareComponentType"]["type"].alias("devicetype"),
        model["manufacturer"].alias("manufacturer"),
        model["name"].alias("name"),
        generic["description"].alias("description"),
        device["modifyDate"].alias("modifydate"),
        device["serialNumber"].alias("serialnumber"),
    )


def hardware_components(hardware: DataFrame) -> DataFrame:
    """One row per active component."""
    return hardware.select("id", F.explode("activeComponents").alias("_d")).select(
        "id", component_struct(F.col("_d")).alias("_c")
    ).select("id", "_c.*")


def storage_struct(volume: Column) -> Column:
    """Address, capacity and IOPS are shown only for a volume with an address."""
    address = volume["serviceResourceBackendIpAddress"]
    return F.struct(
        volume["nasType"].alias("type"),
        address.alias("address"),
        F.when(address.isNotNull(), volume["capacityGb"]).alias("capacity"),
        F.when(address.isNotNull(), F.coalesce(volume["iops"].cast("string"), F.lit(""))).alias("iops"),
        volume["notes"].alias("notes"),
    )


def server_storage_rows(allowed: DataFrame) -> DataFrame:
    """One row per volume a server may use."""
    return allowed.select("id", F.explode("allowedNetworkStorage").alias("_v")).select(
        "id", storage_struct(F.col("_v")).alias("_s")
    ).select("id", "_s.*")


def _line(record: Column, table: list[tuple[str, str, int]]) -> Column:
    return F.concat_ws(" ", *[fixed_width(record[name], width) for _, name, width in table])


def _heading(title: str | None, table: list[tuple[str, str, int]]) -> list[Column]:
    cells = " ".join(heading[:width].ljust(width) for heading, _, width in table)
    underline = " ".join("=" * width for _, _, width in table)
    return [F.lit(text) for text in ([title] if title else []) + [cells, underline]]


def server_report(hardware: DataFrame, trunks: DataFrame, allowed: DataFrame) -> DataFrame:
    """The text report of each server as rows (id, section, line, value); in that order it reads top down."""
    rows = interfaces(hardware)
    first_fields = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("notes", "provisionDate")}
    named = rows.select(
        "id", "fullyQualifiedDomainName", "networkGatewayMemberFlag", "manufacturerSerialNumber", *server_fields(),
        *[column.alias(name) for name, column in first_fields.items()],
        "_front", "_back", "_mgmt", "activeComponents",
    )
    head = [
        ("Id              : ", F.col("id")),
        ("Hostname        : ", F.col("fullyQualifiedDomainName")),
        ("Operating System: ", F.col("operatingSystem")),
        ("OS Version      : ", F.col("version")),
        ("Gateway Member  : ", F.initcap(F.col("networkGatewayMemberFlag").cast("string"))),
        ("Datacenter      : ", F.col("datacenterName")),
        ("Serial #        : ", F.col("manufacturerSerialNumber")),
        ("Provision Date  : ", F.col("provisionDate")),
        ("Notes           : ", F.col("notes")),
    ]

    def table(records: Column, layout) -> Column:
        return F.coalesce(F.transform(records, lambda r: _line(r, layout)), F.array().cast("array<string>"))

    components = F.transform("activeComponents", component_struct)
    management = F.when(F.col("_mgmt").isNotNull(), F.array("_mgmt"))
    blank = F.lit("")
    own_lines = F.concat(
        F.array(F.lit(RULE), blank),
        F.array(*[F.concat(F.lit(label), F.coalesce(value.cast("string"), blank)) for label, value in head]),
        F.array(blank, *_heading(None, COMPONENT_FORMAT)),
        table(components, COMPONENT_FORMAT),
        F.array(F.lit(RULE), blank, *_heading("FRONTEND NETWORK", NETWORK_FORMAT)),
        table(F.col("_front"), NETWORK_FORMAT),
        F.array(blank, *_heading("BACKEND NETWORK INTERFACE(S)", NETWORK_FORMAT)),
        table(F.col("_back"), NETWORK_FORMAT),
        F.array(blank, *_heading("TAGGED VLANS BY INTERFACE", TRUNK_FORMAT)),
    )
    management_lines = F.concat(
        F.array(blank, *_heading("MGMT NETWORK", NETWORK_FORMAT)), table(management, NETWORK_FORMAT), F.array(blank)
    )

    def section(df: DataFrame, number: int, lines: Column) -> DataFrame:
        return df.select("id", F.posexplode(lines).alias("line", "value")).select(
            "id", F.lit(number).alias("section"), F.col("line").cast("long").alias("line"), "value"
        )

    uplinks = named.select("id", F.posexplode("_back").alias("_place", "_b"))
    trunk_rows = lookup_join(
        distinct_trunks(trunks),
        uplinks.select("id", "_place", F.col("_b.interface").alias("interface"), F.col("_b.component").alias("component")),
        "componentId", "component", ["id", "_place", "interface"], spread=["vlanNumber"], how="inner",
    )
    trunk_lines = trunk_rows.select(
        "id",
        F.lit(1).alias("section"),
        (F.col("_place").cast("long") * 10000 + F.col("vlanNumber")).alias("line"),
        _line(F.struct("interface", "fullyQualifiedName", "name"), TRUNK_FORMAT).alias("value"),
    )
    volumes = F.transform("allowedNetworkStorage", storage_struct)
    storage_lines = F.concat(
        F.array(blank, *_heading("NETWORK STORAGE ASSOCIATED WITH HARDWARE", STORAGE_FORMAT)),
        table(volumes, STORAGE_FORMAT),
        F.array(blank),
    )
    with_storage = allowed.filter(F.size("allowedNetworkStorage") > 0)
    return (
        section(named, 0, own_lines)
        .unionByName(trunk_lines)
        .unionByName(section(named, 2, management_lines))
        .unionByName(section(with_storage, 3, storage_lines))
    )
