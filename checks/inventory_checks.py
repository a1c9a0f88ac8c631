"""Hardware and storage queries on servers made from customers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.landed import landed
from checks.registry import check, pivot_sql
from checks.tables import duck, run, table
from cloudtally.functions import nested, text
from cloudtally.plans import inventory, storage
from cloudtally.plans.invoice_reports import account_detail, classic_users
from cloudtally.session import work_folder
from cloudtally.sources import landing

# Server c: frontend eth1, eth3, ... and backend eth0, eth2, ... plus two management entries.
SERVER_BASE = """
SELECT CAST(c_custkey AS BIGINT) AS c, c_nationkey AS nation, CAST(c_custkey % 3 AS INT) AS n_front,
  CAST(c_custkey % 4 AS INT) AS n_back, CAST(c_custkey % 3 AS INT) AS n_mgmt, c_name AS host, c_mktsegment AS segment,
  c_custkey % 2 = 0 AS gateway, 'dc' || CAST(c_nationkey % 8 AS STRING) AS dc,
  CASE WHEN c_custkey % 6 <> 0 THEN 'os' || CAST(c_custkey % 4 AS STRING) END AS os,
  CASE WHEN c_custkey % 5 <> 0 THEN 'cpu' || CAST(c_custkey % 7 AS STRING) END AS cpu,
  CASE WHEN c_custkey % 11 <> 0 THEN 'board' || CAST(c_custkey % 5 AS STRING) END AS board,
  CASE WHEN c_custkey % 10 = 0 THEN '' ELSE '202' || CAST(c_custkey % 4 AS STRING) || '-0' ||
    CAST(1 + c_custkey % 9 AS STRING) || '-20T10:00:00-06:00' END AS provisioned,
  CASE WHEN c_custkey % 4 <> 2 THEN '10.' || CAST(c_nationkey AS STRING) || '.0.0/26' END AS back_net,
  CASE WHEN c_custkey % 3 <> 0 THEN '150.' || CAST(c_nationkey AS STRING) || '.0.0/28' ELSE '' END AS front_net
FROM {customer}
"""


def _component(side: str, position: int) -> str:
    """A frontend (odd ports) or backend (even ports) interface, or a management entry, as SQL."""
    port = {"front": 2 * position + 1, "back": 2 * position, "mgmt": 0}[side]
    name = "mgmt" if side == "mgmt" else "eth"
    vlan = {"front": "nation * 10 + 1", "back": "nation * 10 + 2", "mgmt": "nation * 10 + 3"}[side]
    subnet = {
        "front": "CASE WHEN front_net <> '' THEN struct(concat('150.', nation, '.0.0') AS networkIdentifier, 28 AS cidr) END",
        "back": "CASE WHEN back_net IS NOT NULL THEN struct(concat('10.', nation, '.0.0') AS networkIdentifier, 26 AS cidr) END",
        "mgmt": "CAST(NULL AS struct<networkIdentifier: string, cidr: int>)",
    }[side]
    return (
        f"struct('{name}' AS name, {port} AS port, concat('{side}-mac-', c, '-{position}') AS macAddress, "
        f"CASE WHEN {position} = 0 THEN concat('10.0.', c, '.{port}') END AS primaryIpAddress, 1000 * ({position} + 1) AS speed, "
        f"'ACTIVE' AS status, CASE WHEN c % 2 = 0 THEN struct('FULL' AS keyname) END AS duplexMode, "
        f"struct(concat('router-', nation) AS hostname, CASE WHEN c % 3 = 0 THEN '1.1.1.1' END AS primaryIpAddress) AS router, "
        f"struct(c * 10 + {port} AS id, CASE WHEN c % 13 <> 0 THEN CAST({vlan} AS BIGINT) END AS networkVlanId) "
        f"AS uplinkComponent, {subnet} AS primarySubnet, concat('ipmi-', c, '-{position}') AS ipmiMacAddress, "
        f"CAST(NULL AS STRING) AS ipmiIpAddress)"
    )


def _vlan(number: int, suffix: str) -> str:
    named = f"CASE WHEN nation % 3 <> 0 THEN concat('net{suffix}', nation) END"
    return (
        f"struct(CAST(nation * 10 + {number} AS BIGINT) AS id, CAST(nation * 100 + {number} AS BIGINT) AS vlanNumber, "
        f"concat('{suffix}.', nation) AS fullyQualifiedName, {named} AS name, "
        f"CASE WHEN nation % 4 = 0 THEN 7L END AS vrfDefinitionId)"
    )


def hardware(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Servers with their interfaces, VLANs and components as landed, one per customer."""
    return landed(spark, sf_dir, "hardware", _hardware)


def _hardware(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run(spark, sf_dir, SERVER_BASE, fact="customer")
    front = ", ".join(_component("front", i) for i in range(2))
    back = ", ".join(_component("back", i) for i in range(3))
    mgmt = ", ".join(_component("mgmt", i) for i in range(2))
    vlans = ", ".join([_vlan(1, "old"), _vlan(1, "front"), _vlan(2, "back"), _vlan(3, "mgmt")])
    device = (
        "struct('2024-01-01' AS modifyDate, CASE WHEN c % 2 = {i} THEN concat('sn', c) END AS serialNumber, "
        "struct('maker{i}' AS manufacturer, segment AS name, struct('device {i}' AS description, "
        "struct('TYPE{i}' AS type) AS hardwareComponentType) AS hardwareGenericComponentModel) AS hardwareComponentModel)"
    )
    devices = ", ".join(device.format(i=i) for i in range(2))
    return base.selectExpr(
        "c AS id",
        "host AS fullyQualifiedDomainName",
        "gateway AS networkGatewayMemberFlag",
        "concat('serial', c) AS manufacturerSerialNumber",
        "provisioned AS provisionDate",
        "'n' AS notes",
        "CASE WHEN c % 2 = 0 THEN dc END AS datacenterName",
        "struct(dc AS name) AS datacenter",
        "CASE WHEN board IS NOT NULL THEN struct(struct(board AS longDescription) AS hardwareComponentModel) END AS motherboard",
        "CASE WHEN cpu IS NOT NULL THEN array(struct(struct(cpu AS longDescription) AS hardwareComponentModel),"
        " struct(struct('second' AS longDescription) AS hardwareComponentModel)) END AS processors",
        "CASE WHEN os IS NOT NULL THEN array(struct(struct(struct(os AS name, '1.0' AS version) AS softwareDescription)"
        " AS softwareLicense)) ELSE array() END AS softwareComponents",
        f"array({vlans}) AS networkVlans",
        f"slice(array({front}), 1, n_front) AS frontendNetworkComponents",
        f"concat(slice(array({back}), 1, n_back), slice(array({mgmt}), 1, n_mgmt)) AS backendNetworkComponents",
        f"slice(array({devices}), 1, n_front) AS activeComponents",
    )


def trunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VLANs trunked on the first backend interface of each server; each is landed twice."""
    return run(
        spark, sf_dir,
        """SELECT c_custkey * 10 AS componentId, struct(CAST(1000 + t AS BIGINT) AS vlanNumber,
             concat('trunk.', t) AS fullyQualifiedName, CASE WHEN t % 2 = 0 THEN concat('t', t) END AS name) AS networkVlan
           FROM {customer} LATERAL VIEW explode(sequence(0, c_custkey % 4)) numbers AS t
           LATERAL VIEW explode(array(1, 2)) copies AS copy""",
    )


def allowed_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = (
        "struct(c * 10 + {i} AS id, 'NAS' AS nasType, CAST(100 * ({i} + 1) AS BIGINT) AS capacityGb, "
        "CASE WHEN c % 2 = {i} THEN 2.5D END AS iops, CAST(c * 1000 AS BIGINT) AS bytesUsed, "
        "CASE WHEN c % 3 = {i} THEN concat('10.9.0.', c) END AS serviceResourceBackendIpAddress, "
        "CASE WHEN {i} = 1 THEN 'vol note' END AS notes)"
    )
    volumes = ", ".join(volume.format(i=i) for i in range(3))
    return run(spark, sf_dir, SERVER_BASE).selectExpr(
        "concat('acct', nation) AS accountId",
        "c AS id",
        "host AS hostname",
        "struct(1L AS id, dc AS name) AS datacenter",
        "CASE WHEN os IS NOT NULL THEN array(struct(struct(struct(os AS name) AS softwareDescription) AS softwareLicense)) END"
        " AS softwareComponents",
        f"slice(array({volumes}), 1, n_back) AS allowedNetworkStorage",
    )


def account_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an account list: padded first column, more columns, blank lines."""
    return run(spark, sf_dir, """SELECT explode(array(concat('  acct', n_nationkey, ' , ', n_name), '   '))  AS value
      FROM {nation}""")  # fmt: skip


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = account_lines(spark, sf_dir).filter(F.trim("value") != "")
    return lines.select(text.first_csv_column(F.col("value")).alias("accountId"))


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, """SELECT concat('acct', n_nationkey) AS accountId,
      CASE WHEN n_regionkey = 2 THEN concat('failed ', n_name) END AS error FROM {nation}""").filter("error IS NOT NULL")  # fmt: skip


SERVER_CTE = f"""
hw AS ({duck(SERVER_BASE)}),
server AS (
  SELECT *, coalesce(os, '') AS "operatingSystem", CASE WHEN os IS NULL THEN '' ELSE '1.0' END AS version,
    dc AS "datacenterName", coalesce(board, '') AS motherboard, coalesce(cpu, '') AS processor,
    CASE WHEN n_front > 0 THEN front_net END AS "frontend_primarySubnet",
    CASE WHEN n_back > 0 THEN back_net END AS "backend_primarySubnet",
    CASE WHEN n_front > 0 AND c % 13 <> 0 THEN 'front.' || nation END AS eth1_vlan,
    CASE WHEN n_front > 0 AND c % 13 <> 0 AND nation % 3 <> 0 THEN 'netfront' || nation END AS "eth1_vlanName",
    CASE WHEN n_back > 0 AND c % 13 <> 0 THEN 'back.' || nation END AS eth0_vlan,
    CASE WHEN n_back > 0 AND c % 13 <> 0 AND nation % 3 <> 0 THEN 'netback' || nation END AS "eth0_vlanName",
    c AS id, substring(provisioned, 1, 7) AS "provisionMonth"
  FROM hw
),
iface AS (
  SELECT c, nation, n, CASE side WHEN 'front' THEN 'eth' || (2 * n + 1) WHEN 'back' THEN 'eth' || (2 * n) ELSE 'mgmt0' END
      AS interface, side,
    CASE side WHEN 'mgmt' THEN 'ipmi-' || c || '-' || n ELSE side || '-mac-' || c || '-' || n END AS mac,
    CASE WHEN side <> 'mgmt' AND n = 0 THEN '10.0.' || c || '.' || (CASE side WHEN 'front' THEN 1 ELSE 0 END) END
      AS "primaryIpAddress",
    1000 * (n + 1) AS speed, CASE WHEN c % 2 = 0 THEN 'FULL' END AS "duplexMode", 'ACTIVE' AS status,
    CASE WHEN c % 13 <> 0 THEN side || '.' || nation END AS vlan,
    CASE WHEN c % 13 <> 0 AND nation % 3 <> 0 THEN 'net' || side || nation END AS "vlanName",
    CASE WHEN c % 13 <> 0 AND nation % 4 = 0 THEN 7 END AS "vrfId", 'router-' || nation AS router,
    CASE WHEN c % 3 = 0 THEN '1.1.1.1' END AS router_ip
  FROM hw, (SELECT unnest(['front', 'back', 'mgmt']) AS side) AS sides, (SELECT range AS n FROM range(3)) AS numbers
  WHERE (side = 'front' AND n < n_front AND n < 2) OR (side = 'back' AND n < n_back)
    OR (side = 'mgmt' AND n = least(n_mgmt, 2) - 1)
),
trunk AS (
  SELECT c, 1000 + t AS number, 'trunk.' || t AS fqn, CASE WHEN t % 2 = 0 THEN 't' || t ELSE '' END AS name
  FROM hw, (SELECT range AS t FROM range(4)) AS numbers WHERE t <= c % 4 AND n_back > 0
)"""
SERVERS = f"WITH {SERVER_CTE}"

_SINGLE = ["operatingSystem", "version", "datacenterName", "motherboard", "processor"]


@check("first_element_fields", f"{SERVERS} SELECT id, {', '.join(chr(34) + c + chr(34) for c in _SINGLE)} FROM server")
def _(spark, sf_dir):
    return hardware(spark, sf_dir).select("id", *inventory.server_fields())


@check(
    "subnet_cidr",
    f'{SERVERS} SELECT id, "backend_primarySubnet", "frontend_primarySubnet" FROM server',
)
def _(spark, sf_dir):
    return hardware(spark, sf_dir).select("id", *inventory.primary_subnets())


def _wide_sql(names: list[str], attributes: list[str], key: str = "c AS id") -> str:
    out = [
        f"max(CASE WHEN i.interface = '{name}' THEN i.\"{a}\" END) AS \"{name}_{a}\"" for name in names for a in attributes
    ]
    return f"SELECT hw.c AS id, {', '.join(out)} FROM hw LEFT JOIN iface AS i ON i.c = hw.c GROUP BY hw.c"


_ALL = [*inventory.INTERFACES, inventory.MANAGEMENT]


@check("interfaces_wide", f"{SERVERS} {_wide_sql(_ALL, inventory.ATTRIBUTES)}")
def _(spark, sf_dir):
    return inventory.interfaces_wide(hardware(spark, sf_dir))


@check(
    "join_interface_vlan",
    f"""{SERVERS} SELECT c AS id, interface, vlan, "vlanName", "vrfId" FROM iface WHERE side <> 'mgmt'""",
)
def _(spark, sf_dir):
    rows = inventory.interfaces(hardware(spark, sf_dir))
    both = rows.select("id", F.explode(F.concat("_front", "_back")).alias("i"))
    return both.select("id", "i.interface", "i.vlan", "i.vlanName", "i.vrfId")


@check("mgmt_interface", f"{SERVERS} SELECT c AS id, mac FROM iface WHERE side = 'mgmt'")
def _(spark, sf_dir):
    last = nested.last_named(F.col("backendNetworkComponents"), "mgmt")
    return hardware(spark, sf_dir).select("id", last["ipmiMacAddress"].alias("mac")).filter("mac IS NOT NULL")


@check(
    "trunk_list",
    """SELECT c_custkey * 10 AS "componentId", array_to_string(list_transform(range(c_custkey % 4 + 1),
    lambda t: '(' || (1000 + t) || ') ' || CASE WHEN t % 2 = 0 THEN 't' || t ELSE '' END), ', ') AS trunks FROM customer""",
)
def _(spark, sf_dir):
    return inventory.trunk_lists(trunks(spark, sf_dir))


_TRUNK_SQL = """SELECT s."datacenterName", trunk.fqn AS "vlanNumber", trunk.name AS "vlanName",
  s.host AS "fullyQualifiedDomainName", s.gateway AS "networkGatewayMemberFlag", s."operatingSystem", s.version,
  'eth0' AS interface FROM trunk JOIN server AS s ON s.c = trunk.c"""


@check("trunked_vlan_rows", f"{SERVERS} {_TRUNK_SQL}")
def _(spark, sf_dir):
    return inventory.trunked_vlans(hardware(spark, sf_dir), trunks(spark, sf_dir))


_TRUNK_TEXT = """CASE WHEN n_back > 0 THEN (SELECT string_agg('(' || number || ') ' || name, ', ' ORDER BY number)
  FROM trunk AS t WHERE t.c = s.c) END"""
_DETAIL = ["operatingSystem", "version", "datacenterName", "motherboard", "processor", "backend_primarySubnet",
           "frontend_primarySubnet"]
_TRUNK_COLUMNS = {
    f"eth{n}_networkvlanTrunks": _TRUNK_TEXT if n == 0 else f"CASE WHEN {n % 2} = 0 AND n_back > {n // 2} THEN '' END"
    for n in range(11)
}


@check(
    "hardware_detail",
    f"""{SERVERS}, wide AS ({_wide_sql(_ALL, inventory.ATTRIBUTES)})
    SELECT wide.*, s.gateway AS "networkGatewayMemberFlag", s.host AS "fullyQualifiedDomainName",
      {", ".join('s."' + c + '"' for c in _DETAIL)}, 'serial' || s.c AS "manufacturerSerialNumber",
      provisioned AS "provisionDate", 'n' AS notes, {", ".join(f'{sql} AS "{c}"' for c, sql in _TRUNK_COLUMNS.items())}
    FROM server AS s JOIN wide ON wide.id = s.c""",
)
def _(spark, sf_dir):
    return inventory.hardware_table(hardware(spark, sf_dir), trunks(spark, sf_dir))


_COUNT = {"Total_Count": "COUNT(DISTINCT [id])"}
for _name, _build, _keys in [
    ("private_subnet_counts", inventory.private_subnet_counts,
     ["datacenterName", "backend_primarySubnet", "eth0_vlan", "eth0_vlanName"]),
    ("public_subnet_counts", inventory.public_subnet_counts,
     ["datacenterName", "frontend_primarySubnet", "eth1_vlan", "eth1_vlanName"]),
    ("processor_counts", inventory.processor_counts, ["datacenterName", "processor"]),
    ("motherboard_counts", inventory.motherboard_counts, ["datacenterName", "motherboard"]),
    ("provision_month_counts", inventory.provision_month_counts,
     ["provisionMonth", "motherboard", "processor", "operatingSystem"]),
    ("servers_by_os", inventory.servers_by_os, ["operatingSystem", "version"]),
]:

    @check(_name, pivot_sql(SERVER_CTE, "SELECT * FROM server", _keys, _COUNT, total="Count"))
    def _(spark, sf_dir, build=_build):
        return build(inventory.hardware_report_rows(hardware(spark, sf_dir)))


_FLAGGED = f"SELECT * REPLACE (CAST(\"networkGatewayMemberFlag\" AS VARCHAR) AS \"networkGatewayMemberFlag\") FROM ({_TRUNK_SQL}) AS t"
for _name, _build, _keys in [
    ("servers_by_trunked_vlan", inventory.servers_by_trunked_vlan,
     ["datacenterName", "vlanNumber", "vlanName", "fullyQualifiedDomainName", "networkGatewayMemberFlag",
      "operatingSystem", "version"]),
    ("tagged_vlans_by_server", inventory.tagged_vlans_by_server,
     ["fullyQualifiedDomainName", "operatingSystem", "version", "datacenterName", "vlanNumber", "vlanName"]),
]:

    @check(
        _name,
        pivot_sql(SERVER_CTE, _FLAGGED, _keys, {"interface_count": "COUNT(DISTINCT [interface])"}, total="Count"),
    )
    def _(spark, sf_dir, build=_build):
        return build(inventory.trunked_vlans(hardware(spark, sf_dir), trunks(spark, sf_dir)))


# --- server report --------------------------------------------------------------------------------------------

_DEVICES = """SELECT c AS id, 'TYPE' || i AS devicetype, 'maker' || i AS manufacturer, segment AS name,
  'device ' || i AS description, '2024-01-01' AS modifydate, CASE WHEN c % 2 = i THEN 'sn' || c END AS serialnumber
  FROM hw, (SELECT range AS i FROM range(2)) AS numbers WHERE i < n_front"""


@check("hardware_components", f"{SERVERS} {_DEVICES}")
def _(spark, sf_dir):
    return inventory.hardware_components(hardware(spark, sf_dir))


@check(
    "fixed_width_rows",
    f"""{SERVERS}, device AS ({_DEVICES}) SELECT id, concat_ws(' ', rpad(devicetype[:15], 15, ' '), rpad(manufacturer[:15], 15, ' '),
    rpad(name[:20], 20, ' '), rpad(coalesce(serialnumber, '')[:4], 4, ' ')) AS line FROM device""",
)
def _(spark, sf_dir):
    row = text.fixed_width_row([("devicetype", 15), ("manufacturer", 15), ("name", 20), ("serialnumber", 4)])
    return inventory.hardware_components(hardware(spark, sf_dir)).select("id", row.alias("line"))


_STORED = """SELECT c, i, c * 10 + i AS volume, 'NAS' AS type, CASE WHEN c % 3 = i THEN '10.9.0.' || c END AS address,
  100 * (i + 1) AS size, CASE WHEN c % 2 = i THEN 2.5::DOUBLE END AS iops, CASE WHEN i = 1 THEN 'vol note' END AS notes
  FROM hw, (SELECT range AS i FROM range(3)) AS numbers WHERE i < n_back"""


@check(
    "server_storage_rows",
    f"""{SERVERS}, stored AS ({_STORED}) SELECT c AS id, type, address, CASE WHEN address IS NOT NULL THEN size END AS capacity,
    CASE WHEN address IS NOT NULL THEN coalesce(CAST(iops AS VARCHAR), '') END AS iops, notes FROM stored""",
)
def _(spark, sf_dir):
    return inventory.server_storage_rows(allowed_storage(spark, sf_dir))


def _cells(columns: list[tuple[str, int]]) -> str:
    return "concat_ws(' ', " + ", ".join(
        f"rpad(coalesce(CAST({c} AS VARCHAR), '')[:{w}], {w}, ' ')" for c, w in columns
    ) + ")"


@check(
    "server_report_trunks",
    f"""{SERVERS} SELECT c AS id, number AS line, {_cells([("'eth0'", 10), ("fqn", 16), ("name", 25)])} AS value FROM trunk""",
)
def _(spark, sf_dir):
    report = inventory.server_report(hardware(spark, sf_dir), trunks(spark, sf_dir), allowed_storage(spark, sf_dir))
    return report.filter("section = 1").select("id", "line", "value")


def _headed(heads: list[tuple[str, int]], *before: str) -> str:
    """SQL list: lines before a table, its column heads, and a rule under each."""
    cells = " ".join(name[:width].ljust(width) for name, width in heads)
    return "[" + ", ".join(f"'{line}'" for line in (*before, cells, " ".join("=" * width for _, width in heads))) + "]"


_NETWORK = [("Iface", 6), ("MAC ", 17), ("IpAddress", 16), ("Speed", 5), ("Duplex", 6), ("Status", 8), ("Vlan", 5),
            ("FQDN", 16), ("Vlan Name", 20), ("Router", 14), ("RouterIP", 16), ("VRF_ID", 8)]
_NETWORK_LINE = _cells([("interface", 6), ("mac", 17), ('"primaryIpAddress"', 16), ("speed", 5), ('"duplexMode"', 6),
                        ("status", 8), ("number", 5), ("vlan", 16), ('"vlanName"', 20), ("router", 14), ("router_ip", 16),
                        ('"vrfId"', 8)])
_COMPONENTS = [("Type   ", 15), ("Manufacturer", 15), ("Name", 20), ("Description", 30), ("Modify Date", 25), ("Serial Number", 15)]
_COMPONENT_LINE = _cells([("'TYPE' || i", 15), ("'maker' || i", 15), ("segment", 20), ("'device ' || i", 30),
                          ("'2024-01-01'", 25), ("CASE WHEN c % 2 = i THEN 'sn' || c END", 15)])
_TRUNKS = [("Interface", 10), ("Vlan", 16), ("VlanName", 25)]
_STORES = [("StorageType", 11), ("Address", 40), ("Gb", 10), ("IOPS", 10), ("Notes", 50)]
_STORE_LINE = _cells([("type", 11), ("address", 40), ("CASE WHEN address IS NOT NULL THEN size END", 10),
                      ("CASE WHEN address IS NOT NULL THEN iops END", 10), ("notes", 50)])


@check(
    "server_report",
    f"""{SERVERS}, stored AS ({_STORED}), network AS (
      SELECT c, side, list({_NETWORK_LINE} ORDER BY n) AS lines FROM (SELECT *, CASE WHEN c % 13 <> 0 THEN nation * 100 +
        CASE side WHEN 'front' THEN 1 WHEN 'back' THEN 2 ELSE 3 END END AS number FROM iface) GROUP BY ALL
    ), component AS (
      SELECT c, list({_COMPONENT_LINE} ORDER BY i) AS lines
      FROM hw, (SELECT range AS i FROM range(2)) AS numbers WHERE i < n_front GROUP BY c
    ), store AS (SELECT c, list({_STORE_LINE} ORDER BY i) AS lines FROM stored GROUP BY c
    ), report AS (
      SELECT s.c AS id, 0 AS section, list_concat([repeat('_', 114), '', 'Id              : ' || s.c, 'Hostname        : ' || host,
          'Operating System: ' || "operatingSystem", 'OS Version      : ' || version,
          'Gateway Member  : ' || CASE WHEN gateway THEN 'True' ELSE 'False' END, 'Datacenter      : ' || "datacenterName",
          'Serial #        : serial' || s.c, 'Provision Date  : ' || provisioned, 'Notes           : n'],
        {_headed(_COMPONENTS, "")}, coalesce(component.lines, []),
        [repeat('_', 114)], {_headed(_NETWORK, "", "FRONTEND NETWORK")}, coalesce(front.lines, []),
        {_headed(_NETWORK, "", "BACKEND NETWORK INTERFACE(S)")}, coalesce(back.lines, []),
        {_headed(_TRUNKS, "", "TAGGED VLANS BY INTERFACE")}) AS lines
      FROM server AS s LEFT JOIN component ON component.c = s.c
        LEFT JOIN (FROM network WHERE side = 'front') AS front ON front.c = s.c
        LEFT JOIN (FROM network WHERE side = 'back') AS back ON back.c = s.c
      UNION ALL SELECT s.c, 2, list_concat({_headed(_NETWORK, "", "MGMT NETWORK")}, coalesce(mgmt.lines, []), [''])
      FROM server AS s LEFT JOIN (FROM network WHERE side = 'mgmt') AS mgmt ON mgmt.c = s.c
      UNION ALL SELECT c, 3, list_concat({_headed(_STORES, "", "NETWORK STORAGE ASSOCIATED WITH HARDWARE")}, lines, [''])
      FROM store
    ) SELECT id, section, CAST(generate_subscripts(lines, 1) - 1 AS BIGINT) AS line, unnest(lines) AS value FROM report""",
)
def _(spark, sf_dir):
    """All text but the trunk lines, which have a query of their own."""
    report = inventory.server_report(hardware(spark, sf_dir), trunks(spark, sf_dir), allowed_storage(spark, sf_dir))
    return report.filter("section <> 1")


# --- accounts -------------------------------------------------------------------------------------------------


@check("first_csv_column", """SELECT 'acct' || n_nationkey AS "accountId" FROM nation""")
def _(spark, sf_dir):
    """The account list as a file, with blank lines and further columns, read by the library."""
    lines = table(spark, sf_dir, "nation").selectExpr(
        "explode(array(concat('  acct', n_nationkey, ' , ', n_name), if(n_nationkey % 2 = 0, '', '  '))) as value"
    )
    folder = f"{work_folder(spark)}/cloudtally-accounts/{uuid.uuid4().hex}"
    lines.write.text(folder)
    return landing.read_accounts(spark, folder)


@check(
    "hardware_storage_nested",
    f"""{SERVERS}, stored AS ({_STORED}), servers AS (
      SELECT 'acct' || nation AS account, hw.c, dc, coalesce(os, '') AS os, list({{'storageId': volume,
        'storageType': type, 'iops': coalesce(stored.iops, 0), 'capacityGb': size, 'bytesUsed': hw.c * 1000}} ORDER BY i) AS storage
      FROM hw JOIN stored ON stored.c = hw.c GROUP BY ALL)
    SELECT 'acct' || n_nationkey AS "accountId", CASE WHEN n_regionkey = 2 THEN 'failed ' || n_name END AS error,
      s.c AS "hardwareId", dc AS datacenter, os, storage
    FROM nation LEFT JOIN servers AS s ON account = 'acct' || n_nationkey AND n_regionkey <> 2""",
)
def _(spark, sf_dir):
    return storage.account_records(accounts(spark, sf_dir), allowed_storage(spark, sf_dir), errors(spark, sf_dir))


@check(
    "account_summary",
    """SELECT count(*) AS total, count(*) FILTER (n_regionkey <> 2) AS successful, count(*) FILTER (n_regionkey = 2) AS failed
    FROM nation""",
)
def _(spark, sf_dir):
    return storage.account_summary(accounts(spark, sf_dir), errors(spark, sf_dir))


@check(
    "account_detail",
    """SELECT c_custkey AS id, c_name AS "companyName", 'a@b' AS email, 'x' AS "bluemixAccountId",
    false AS "proofOfConceptAccountFlag", c_mktsegment AS "accountStatus", '2020-01-01' AS "billingInfoCreateDate",
    'USD' AS "billingInfoCurrency", 'brand' AS brand,
    CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'Title of ' || c_name || 'see docs now' END AS "internalNotes",
    CASE WHEN c_custkey % 2 = 0 THEN 'm@b' ELSE '' END AS "masterUserEmail", '' AS "masterUserIamId" FROM customer""",
)
def _(spark, sf_dir):
    return account_detail(account_records(spark, sf_dir))


def account_records(spark, sf_dir):
    return run(
        spark, sf_dir,
        """SELECT c_custkey AS id, c_name AS companyName, 'a@b' AS email, 'x' AS bluemixAccountId,
             false AS proofOfConceptAccountFlag, struct(c_mktsegment AS name) AS accountStatus,
             struct('2020-01-01' AS createDate, struct('USD' AS name) AS currency) AS billingInfo,
             struct('brand' AS name) AS brand,
             CASE WHEN c_custkey % 3 <> 0 THEN array(struct(concat('# Title of **', c_name, '**') AS note),
               struct('see [docs](http://x) `now`' AS note)) END AS internalNotes,
             CASE WHEN c_custkey % 2 = 0 THEN struct('m@b' AS email, CAST(NULL AS STRING) AS iamId) END AS masterUser
           FROM {customer}""",
    )


@check(
    "notes_concat",
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name || ' and ' || c_mktsegment END AS notes
    FROM customer""",
)
def _(spark, sf_dir):
    base = run(
        spark, sf_dir,
        """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 <> 0 THEN array(struct(c_name AS note),
             struct(concat(' and ', c_mktsegment) AS note)) END AS notes FROM {customer}""",
    )
    return base.select("id", nested.joined_notes(F.col("notes")).alias("notes"))


@check(
    "plain_notes",
    """SELECT c_custkey AS id, 'Title of ' || c_name || chr(10) || 'item ' || c_mktsegment || ' and more' || chr(10)
      || 'see docs, pic' || chr(10) || 'quoted now, soft (words) 3 * 4 * 5 snake_case_name' || chr(10) || 'it' || chr(10)
      || 'step ' || c_custkey || chr(10) || chr(10) || 'x = 1' || chr(10) AS plain FROM customer""",
)
def _(spark, sf_dir):
    """Notes put together from plain text and markup; what is expected is the plain text alone."""
    base = run(
        spark, sf_dir,
        r"""SELECT c_custkey AS id, concat('## Title of **', c_name, '**\n- item __', c_mktsegment, '__ and more\n',
             'see [docs](http://x.y/z), ![pic](a.png)\n> quoted `now`, _soft_ (words) 3 * 4 * 5 snake_case_name\n* *it*\n',
             '12. step ', c_custkey, '\n```sh\nx = 1\n```') AS notes FROM {customer}""",
    )
    return base.select("id", text.plain_notes(F.col("notes")).alias("plain"))


@check(
    "classic_users",
    """SELECT 1 AS "accountId", CASE WHEN s_suppkey % 2 = 0 THEN 'co' ELSE '' END AS "companyName", s_suppkey AS id,
    s_name AS "displayName", 'f' AS "fistName", 'l' AS "LastName", 'c' AS "createDate", 'm' AS "modifyDate",
    's' AS "statusDate", 'i' AS "iamId", '' AS email, s_name AS username, 'Active' AS "userStatus",
    false AS "isMasterUserFlag", true AS "managedByOpenConnectFlag",
    CASE WHEN s_suppkey % 3 = 0 THEN 'true' ELSE '' END AS "sslVpnAllowedFlag",
    CASE WHEN s_suppkey % 4 <> 0 THEN 'd0' END AS "lastLoginAttempt",
    CASE WHEN s_suppkey % 4 <> 0 THEN 'ip' || s_suppkey END AS "lastLoginAttemptIpAddress",
    CASE WHEN s_suppkey % 4 <> 0 THEN CASE WHEN s_suppkey % 4 = 1 THEN 'false' ELSE '' END END
      AS "lastLoginAttemptSuccessFlag" FROM supplier""",
)
def _(spark, sf_dir):
    return classic_users(user_records(spark, sf_dir))


def user_records(spark, sf_dir):
    return run(
        spark, sf_dir,
        """SELECT 1 AS accountId, s_suppkey AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'co' END AS companyName,
             s_name AS displayName, 'f' AS firstName, 'l' AS lastName, 'c' AS createDate, 'm' AS modifyDate,
             's' AS statusDate, 'i' AS iamId, CAST(NULL AS STRING) AS email, s_name AS username,
             struct('Active' AS name) AS userStatus, false AS isMasterUserFlag, true AS managedByOpenIdConnectFlag,
             CASE WHEN s_suppkey % 3 = 0 THEN true END AS sslVpnAllowedFlag,
             CASE WHEN s_suppkey % 4 <> 0 THEN array(struct('d0' AS createDate, concat('ip', s_suppkey) AS ipAddress,
               CASE WHEN s_suppkey % 4 = 1 THEN false END AS successFlag),
               struct('d1' AS createDate, 'old' AS ipAddress, true AS successFlag))
             ELSE CAST(array() AS array<struct<createDate: string, ipAddress: string, successFlag: boolean>>)
             END AS loginAttempts FROM {supplier}""",
    )
