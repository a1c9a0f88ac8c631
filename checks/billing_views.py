"""Invoices, items and children made from orders and lineitem; and the expected invoice lines in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from checks.landed import landed
from checks.tables import duck, half_even, run
from cloudtally.functions.dates import month_list
from cloudtally.plans.invoice_lines import invoice_lines

# All cycles the order dates fall in.
MONTHS = month_list("1995-01", "2001-09")

INVOICE_BASE = """
SELECT o_orderkey AS id, o_custkey AS account,
  CASE WHEN o_orderstatus = 'F' THEN 'RECURRING' WHEN o_orderstatus = 'P' THEN 'CREDIT'
       WHEN o_orderpriority = '5-LOW' THEN 'ONE-TIME-CHARGE' ELSE 'NEW' END AS type_code,
  o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 24) AS ts,
  CASE WHEN o_orderkey % 50 = 0 THEN 0 ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS total_cents,
  CASE WHEN o_orderkey % 25 = 0 THEN 0 ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS recurring_cents
FROM {orders}
"""

ITEM_BASE = """
SELECT *,
  CASE kind WHEN 0 THEN 'guest_core' WHEN 1 THEN 'server' WHEN 2 THEN 'storage_as_a_service'
    WHEN 3 THEN 'storage_service_enterprise' WHEN 4 THEN 'performance_storage_iops' WHEN 5 THEN 'guest_storage'
    WHEN 6 THEN 'platform_service' ELSE 'software_license' END AS code,
  CASE kind WHEN 0 THEN 'Computing Instance' WHEN 1 THEN 'Server' WHEN 2 THEN 'Storage As A Service'
    WHEN 3 THEN 'Endurance' WHEN 4 THEN 'Performance' WHEN 5 THEN 'Archive Storage Repository'
    WHEN 6 THEN 'Platform Service' ELSE CASE WHEN supp % 2 = 0 THEN 'Software License' ELSE 'Network Vlan' END
    END AS category,
  CASE kind WHEN 0 THEN 'Virtual Servers and Attached Services' WHEN 1 THEN 'Bare Metal Servers'
    WHEN 2 THEN 'StorageLayer' WHEN 3 THEN 'StorageLayer' WHEN 4 THEN 'StorageLayer' WHEN 6 THEN 'PaaS'
    WHEN 7 THEN CASE WHEN supp % 2 = 0 THEN 'Software' END END AS category_group,
  CASE WHEN kind = 6 THEN 'PaaS' WHEN kind = 7 AND supp % 5 = 1 THEN 'HELP DESK'
    WHEN kind = 5 AND supp % 7 = 3 THEN 'OTHER' ELSE 'IaaS' END AS tax,
  CASE WHEN kind = 6 AND supp % 2 = 0 THEN 'Cloud Object Storage - S3 API'
    WHEN kind = 7 AND supp % 3 = 0 THEN 'VMware vSAN ' || p_name WHEN kind = 7 AND supp % 3 = 1 THEN 'VMware NSX'
    ELSE p_name || chr(10) || 'unit' END AS product,
  CASE WHEN supp % 4 <> 0 THEN 'D' || CAST(p_size AS STRING) END AS d_part,
  CASE WHEN supp % 9 <> 0 THEN s_name END AS host,
  CASE WHEN supp % 4 <> 1 THEN 'example.com' END AS domain,
  CASE WHEN supp % 13 <> 0 THEN n_name END AS place,
  CASE WHEN bill_id % 3 = 0 THEN 'note ' || CAST(supp % 5 AS STRING) END AS note,
  CASE WHEN supp % 11 = 0 THEN NULL WHEN supp % 5 = 0 THEN '0' ELSE CAST(supp % 5 AS STRING) || '.12500' END AS own_rate,
  cents * 100 + ln * 10 + 5 AS fee4,
  CASE WHEN ln > 3 THEN 0 ELSE q * 100 + 50 END AS one_time_cents,
  CASE supp % 5 WHEN 0 THEN '7D' WHEN 1 THEN 'SQ' WHEN 2 THEN 'ZZ' WHEN 3 THEN 'U3' END AS division
FROM (
  SELECT l_orderkey AS invoice_id, l_partkey AS bill_id, l_suppkey AS supp, l_linenumber AS ln,
    CAST(l_quantity AS BIGINT) AS q, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
    CAST(l_partkey % 8 AS INT) AS kind, l_returnflag = 'R' AS hourly, l_linestatus = 'F' AS is_usage,
    CASE WHEN l_linenumber > 4 THEN 4 ELSE l_linenumber - 1 END AS n_children,
    p_name, p_size, s_name, n_name
  FROM {lineitem} JOIN {part} ON p_partkey = l_partkey JOIN {supplier} ON s_suppkey = l_suppkey
    JOIN {nation} ON n_nationkey = s_nationkey
) AS given
"""

# Fields of child number k (0..3) of an item; a child exists if k < n_children.
CHILD = {
    "c_code": """CASE WHEN kind IN (0, 1) THEN CASE {k} WHEN 0 THEN 'os' WHEN 1 THEN 'ram' WHEN 2 THEN 'guest_disk0'
        ELSE 'bandwidth' END
      WHEN kind IN (2, 3, 4) THEN CASE {k} WHEN 0 THEN 'performance_storage_space'
        WHEN 1 THEN CASE WHEN kind = 4 THEN 'performance_storage_iops' ELSE 'storage_tier_level' END
        WHEN 2 THEN 'storage_snapshot_space' ELSE 'replication' END
      WHEN kind = 5 THEN CASE {k} WHEN 0 THEN 'guest_storage_usage' WHEN 1 THEN 'os' WHEN 2 THEN 'ram' ELSE 'other' END
      ELSE 'service' END""",
    "c_text": """CASE WHEN kind IN (2, 3, 4) THEN CASE {k} WHEN 0 THEN 'Storage Space: ' || CAST(q AS STRING) || '.5 GB'
        WHEN 1 THEN 'API Requests: ' || CAST(q AS STRING) || ' calls'
        WHEN 2 THEN 'Snapshot Space: ' || CAST(q AS STRING) || ' GB' ELSE 'Replication for tier: y' END
      WHEN kind = 6 THEN CASE {k} WHEN 0 THEN CASE WHEN supp % 2 = 0
            THEN 'Standard Storage: ' || CAST(q AS STRING) || ',5 GB'
            ELSE 'Usage units - $' || CAST(q AS STRING) || '.25 USD per UNIT' END
        WHEN 1 THEN 'Class A Requests' WHEN 2 THEN 'No mark here' ELSE 'Odd - $free of charge' END
      WHEN kind = 5 AND {k} = 0 THEN 'Image storage ' || CAST(q AS STRING) || ' GB'
      ELSE 'Item ' || CAST({k} AS STRING) || ' of ' || CAST(q AS STRING) END""",
    "c_product": """CASE WHEN kind IN (0, 1) AND {k} = 0 THEN '  ' || p_name || ' '
      WHEN kind IN (0, 1) AND {k} = 1 THEN CAST(p_size AS STRING) || ' GB'
      WHEN kind IN (2, 3, 4) AND {k} = 0 THEN CAST(q AS STRING) || ' GB'
      WHEN kind IN (2, 3, 4) AND {k} = 1 THEN '2 IOPS per GB'
      WHEN kind IN (2, 3, 4) AND {k} = 2 THEN CAST(q AS STRING) || ' GB snapshot'
      WHEN kind = 5 AND {k} = 1 THEN 'Linux' ELSE 'Product ' || CAST({k} AS STRING) END""",
    "c_group": """CASE WHEN kind IN (2, 3, 4) THEN 'StorageLayer'
      WHEN kind = 6 THEN CASE WHEN {k} = 2 OR ({k} = 0 AND supp % 2 = 0) THEN 'StorageLayer' WHEN {k} < 3 THEN 'PaaS' END
      WHEN {k} % 2 = 0 THEN 'Other' END""",
    "c_fee4": "CASE WHEN (supp + {k}) % 3 = 0 THEN 0 ELSE cents * ({k} + 1) END",
    "c_rate": "CASE WHEN {k} < 2 THEN '0.05' END",
    "c_dpart": "CASE WHEN {k} % 2 = 0 THEN 'DC' || CAST({k} AS STRING) END",
    "c_category": "CASE WHEN {k} < 3 THEN 'Cat ' || CAST({k} AS STRING) END",
    "c_part": """CASE WHEN (bill_id + {k}) % 10 = 3 THEN 'D026XZX'
      ELSE ' P' || CAST(bill_id % 50 AS STRING) || ' ' END""",
}


def decimal_text(units: str, digits: int) -> str:
    """SQL: whole units of 10^-digits as a decimal text."""
    size = 10**digits
    return (
        f"CAST(CAST(FLOOR(({units}) / {size}) AS BIGINT) AS STRING) || '.' || "
        f"lpad(CAST(({units}) % {size} AS STRING), {digits}, '0')"
    )


def _invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run(spark, sf_dir, INVOICE_BASE, fact="orders")
    return base.selectExpr(
        "id",
        "account AS accountId",
        "concat(replace(CAST(ts AS STRING), ' ', 'T'), '+0000') AS createDate",
        "type_code AS typeCode",
        f"{decimal_text('total_cents', 2)} AS invoiceTotalAmount",
        f"{decimal_text('recurring_cents', 2)} AS invoiceTotalRecurringAmount",
    )


def _attribute(key: str, value: str) -> str:
    return f"struct(struct('{key}' AS keyName) AS attributeType, {value} AS value)"


def _child(k: int) -> str:
    field = {name: text.format(k=k) for name, text in CHILD.items()}
    attributes = [
        ("BLUEMIX_PART_NUMBER", "'OLD'"),
        ("BLUEMIX_PART_NUMBER", field["c_part"]),
        ("BLUEMIX_SERVICE_PLAN_DIVISION", "division"),
        ("BLUEMIX_SERVICE_PLAN_ID", f"'plan-{k}'"),
        ("BLUEMIX_SERVICE_PLAN_FEATURE_ID", f"'f{k}'"),
    ]
    if k == 0:
        flags = ["IS_PRIVATE_NETWORK_ONLY", "DUAL_PATH_NETWORK", "INELIGIBLE_FOR_ACCOUNT_DISCOUNT"]
        attributes += [(flag, "'1'") for flag in flags]
    # The lambda is interpreted for each entry, so it only sees lists with an entry to leave out.
    listed = f"array({', '.join(_attribute(*a) for a in attributes)})"
    listed = f"IF(({field['c_part']}) IS NOT NULL AND division IS NOT NULL, {listed}, filter({listed}, a -> a.value IS NOT NULL))"
    if k == 2:
        listed = f"CAST(NULL AS array<struct<attributeType: struct<keyName: string>, value: string>>)"
    item_category = f"CASE WHEN {k} < 3 THEN struct({field['c_category']} AS name) END"
    group = f"CASE WHEN {field['c_group']} IS NOT NULL THEN struct({field['c_group']} AS name) END"
    return (
        f"struct(bill_id * 10 + {k} AS billingItemId, {field['c_code']} AS categoryCode, {field['c_text']} AS description, "
        f"{decimal_text(field['c_fee4'], 4)} AS recurringFee, {field['c_rate']} AS hourlyRecurringFee, "
        f"{field['c_dpart']} AS dPart, struct('c' AS name, {group} AS `group`) AS category, "
        f"struct({field['c_product']} AS description, {item_category} AS itemCategory, {listed} AS attributes) AS product)"
    )


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with nested children. Children come from the row itself: no grouping."""
    base = run(spark, sf_dir, ITEM_BASE, fact="lineitem")
    children = f"slice(array({', '.join(_child(k) for k in range(4))}), 1, n_children)"
    own = ", ".join(
        [
            _attribute("BLUEMIX_PART_NUMBER", "'PP'"),
            _attribute("BLUEMIX_SERVICE_PLAN_DIVISION", "coalesce(division, '')"),
            _attribute("BLUEMIX_SERVICE_PLAN_ID", "'parent-plan'"),
        ]
    )
    return base.selectExpr(
        "invoice_id AS invoiceId",
        "bill_id AS billingItemId",
        "code AS categoryCode",
        "struct(category AS name, CASE WHEN category_group IS NOT NULL THEN struct(category_group AS name) END AS `group`)"
        " AS category",
        "hourly AS hourlyFlag",
        "is_usage AS usageChargeFlag",
        "host AS hostName",
        "domain AS domainName",
        "CASE WHEN place IS NOT NULL THEN struct(place AS longName) END AS location",
        "note AS notes",
        "d_part AS dPart",
        f"{decimal_text('fee4', 4)} AS totalRecurringAmount",
        f"{decimal_text('one_time_cents', 2)} AS totalOneTimeAmount",
        "own_rate AS hourlyRecurringFee",
        f"struct(product AS description, struct(tax AS name) AS taxCategory, "
        f"CASE WHEN kind = 6 THEN array({own}) END AS attributes) AS product",
        f"{children} AS children",
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice headers as landed."""
    return landed(spark, sf_dir, "invoices", _invoices)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice items as landed."""
    return landed(spark, sf_dir, "invoice_items", _items)


def volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Network storage volumes as landed: two per billing item, the first by id counts."""
    return run(
        spark,
        sf_dir,
        """SELECT p_partkey AS id, struct(CAST(FLOOR(p_partkey / 2) AS BIGINT) AS id) AS billingItem,
             '2020-01-01' AS createDate, CAST(p_size - 1 AS DOUBLE) AS capacityGb,
             CASE WHEN p_partkey % 4 <> 0 THEN 'NAS' END AS nasType,
             CASE WHEN p_partkey % 5 <> 0 THEN concat('vol%20', p_partkey, '+100%') END AS notes,
             p_brand AS username, p_retailprice AS provisionedIops FROM {part}""",
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part descriptions; each code is listed twice, the last one counts."""
    from cloudtally.sources.landing import parse_part_descriptions

    lines = run(
        spark,
        sf_dir,
        """SELECT concat('P', CAST(FLOOR(p_partkey / 2) * 2 AS BIGINT), ': ', p_name, ' service: ', p_partkey) AS value,
             0 AS load_offset, p_partkey AS load_row FROM {part}""",
    )
    return parse_part_descriptions(lines)


def lines(spark: SparkSession, sf_dir: str, notes: bool = False, children: bool = True, whole: bool = False) -> DataFrame:
    """Invoice lines; storage notes and children only where a query needs them, ``whole`` where it needs all columns."""
    storage = volumes(spark, sf_dir) if notes else None
    return invoice_lines(invoices(spark, sf_dir), items(spark, sf_dir), storage, children=children, whole=whole)


_N = "n_children"
_INVOICE = duck(INVOICE_BASE)
_ITEM = duck(ITEM_BASE)
_CHILD_COLUMNS = ", ".join(f"{text.format(k='k')} AS {name}" for name, text in CHILD.items())

INVOICE_CTE = f"""
base_invoice AS ({_INVOICE}),
inv AS (
  SELECT *, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'US/Central' AS local_ts,
    CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'US/Central' AS DATE) AS day0
  FROM base_invoice WHERE NOT (total_cents = 0 AND recurring_cents = 0)
)"""

ITEM_CTE = f"""
base_item AS ({_ITEM}),
base_child AS (
  SELECT *, {_CHILD_COLUMNS} FROM base_item CROSS JOIN (SELECT CAST(range AS INT) AS k FROM range(4)) AS ks
  WHERE k < n_children
)"""

VOLUME_CTE = """
volume AS (
  SELECT b AS v_bill, CASE WHEN id % 5 = 0 THEN '' ELSE 'vol ' || id || '+100%' END AS v_notes
  FROM (SELECT p_partkey // 2 AS b, min(p_partkey) AS id FROM part GROUP BY 1) AS firsts
)"""

# Expected invoice lines.
LINES_CTE = f"""
{INVOICE_CTE}, {ITEM_CTE}, {VOLUME_CTE},
parent AS (
  SELECT i.*, inv.*,
    CASE WHEN hourly THEN 1 WHEN tax = 'PaaS' THEN 2 WHEN tax = 'IaaS' AND type_code = 'RECURRING'
      AND category = 'Archive Storage Repository' THEN 1 ELSE 0 END AS months_back,
    CASE WHEN hourly THEN 'IaaS Usage' WHEN tax = 'PaaS' THEN 'Platform Service Usage'
      WHEN tax = 'IaaS' AND type_code = 'RECURRING' THEN CASE WHEN category = 'Archive Storage Repository'
        THEN 'IaaS Usage' ELSE 'IaaS Monthly' END
      WHEN tax = 'HELP DESK' THEN 'Support Charges' ELSE '' END AS period_text,
    CASE WHEN hourly AND (coalesce(CAST(own_rate AS DOUBLE), 0) > 0 OR kind = 2)
      THEN CASE WHEN coalesce(CAST(own_rate AS DOUBLE), 0) > 0 THEN (supp % 5) * 1000 + 125 ELSE 0 END
        + 50 * least({_N}, 2) ELSE 0 END AS rate_milli,
    CASE WHEN kind = 2 THEN CASE WHEN hourly THEN 'Hourly' ELSE 'Monthly' END || ' File Storage'
        || CASE WHEN {_N} >= 2 THEN ' Storage Space: ' || q || '.5 GB at 2 IOPS per GB' ELSE '' END
        || CASE WHEN {_N} >= 3 THEN ' with Snapshot Space: ' || q || ' GB' ELSE '' END
      WHEN kind = 3 THEN CASE WHEN {_N} >= 1 THEN q || ' GB' ELSE '' END || ' '
        || CASE WHEN {_N} >= 2 THEN '2 IOPS per GB' ELSE '' END
        || CASE WHEN {_N} >= 3 THEN ' with ' || q || ' GB snapshot' ELSE ' ' END
      WHEN kind = 4 THEN CASE WHEN {_N} >= 1 THEN q || ' GB' ELSE '' END || ' '
        || CASE WHEN {_N} >= 2 THEN '2 IOPS per GB' ELSE '' END
      WHEN kind = 5 AND {_N} >= 1 THEN 'Image storage ' || q || ' GB'
      ELSE replace(product, chr(10), ' ') END AS described,
    CASE WHEN kind IN (0, 1) AND {_N} >= 2 THEN p_size || ' GB' WHEN kind = 5 AND {_N} >= 3 THEN 'Product 2'
      ELSE '' END AS memory,
    CASE WHEN kind IN (0, 1) AND {_N} >= 1 THEN p_name WHEN kind = 5 AND {_N} >= 2 THEN 'Linux' ELSE '' END AS os,
    coalesce(CASE WHEN kind IN (2, 3, 4) THEN v_notes END, '') AS storage_notes
  FROM base_item AS i JOIN inv ON invoice_id = inv.id LEFT JOIN volume ON v_bill = bill_id
),
common AS (
  SELECT *,
    strftime(day0, '%Y-%m-%d') AS Portal_Invoice_Date,
    strftime(local_ts, '%H:%M:%S') || CASE date_diff('hour', ts, local_ts) WHEN -5 THEN '-0500' ELSE '-0600' END
      AS Portal_Invoice_Time,
    strftime(CASE WHEN tax = 'PaaS' OR hourly OR months_back > 0 THEN day0 - to_months(months_back) ELSE day0 END,
      '%Y-%m-%d') AS Service_Date_Start,
    strftime(CASE WHEN period_text = '' AND type_code IN ('CREDIT', 'ONE-TIME-CHARGE') THEN day0
      ELSE last_day(CAST(day0 - to_months(months_back) AS DATE)) END, '%Y-%m-%d') AS Service_Date_End,
    strftime(CASE WHEN day(day0) > 19 THEN day0 + INTERVAL 1 MONTH ELSE day0 END, '%Y-%m') AS billing_month,
    id AS Portal_Invoice_Number, type_code AS Type, bill_id AS BillingItemId,
    CASE WHEN host IS NULL THEN '' WHEN domain IS NULL THEN host ELSE host || '.' || domain END AS hostName,
    coalesce(place, '') AS location, tax AS TaxCategory, coalesce(note, '') AS billing_notes,
    is_usage AS Usage,
    CAST(CASE WHEN rate_milli > 0 THEN round_even((CAST(fee4 AS DOUBLE) / 10000) / (CAST(rate_milli AS DOUBLE) / 1000), 0)
      ELSE 0 END AS BIGINT) AS Hours,
    CAST(rate_milli AS DOUBLE) / 1000 AS HourlyRate,
    CASE WHEN type_code = 'NEW' THEN (CAST(fee4 AS DOUBLE) / 10000) / (day(last_day(day0)) - day(day0) + 1)
      * day(last_day(day0)) ELSE 0 END AS NewEstimatedMonthly,
    CAST(one_time_cents AS DOUBLE) / 100 AS totalOneTimeAmount,
    CAST(total_cents AS DOUBLE) / 100 AS InvoiceTotal, CAST(recurring_cents AS DOUBLE) / 100 AS InvoiceRecurring,
    period_text AS Recurring_Description, {half_even("fee4")} AS fee_milli
  FROM parent
),
line AS (
  SELECT Portal_Invoice_Date, Portal_Invoice_Time, Service_Date_Start, Service_Date_End, billing_month,
    Portal_Invoice_Number, Type, 'Parent' AS RecordType, BillingItemId, hostName, location,
    coalesce(category_group, 'Other') AS Category_Group, category AS Category, TaxCategory,
    coalesce(d_part, '') AS dPart, described AS Description, memory AS Memory, os AS OS, billing_notes, hourly AS Hourly, Usage,
    Hours, HourlyRate, CAST(fee_milli AS DOUBLE) / 1000 AS totalRecurringCharge, NewEstimatedMonthly,
    totalOneTimeAmount, InvoiceTotal, InvoiceRecurring, Recurring_Description,
    CAST(NULL AS BIGINT) AS childBillingItemId, CAST(NULL AS VARCHAR) AS childParentCategory,
    CAST(NULL AS VARCHAR) AS childParentProduct, CAST(NULL AS DOUBLE) AS childUsage,
    CAST(0 AS DOUBLE) AS childTotalRecurringCharge,
    CASE WHEN kind = 6 THEN 'PP' ELSE '' END AS INV_PRODID,
    CASE WHEN kind = 6 THEN coalesce(division, '') ELSE '' END AS INV_DIV,
    CASE WHEN kind = 6 THEN 'parent-plan' ELSE '' END AS PLAN_ID,
    CAST(NULL AS VARCHAR) AS FEATURE_ID, CAST(NULL AS VARCHAR) AS IS_PRIVATE_NETWORK_ONLY,
    CAST(NULL AS VARCHAR) AS DUAL_PATH_NETWORK, CAST(NULL AS VARCHAR) AS INELIGIBLE_FOR_ACCOUNT_DISCOUNT,
    storage_notes, CAST(one_time_cents * 10 + fee_milli AS BIGINT) AS amount_milli
  FROM common
  UNION ALL
  SELECT Portal_Invoice_Date, Portal_Invoice_Time, Service_Date_Start, Service_Date_End, billing_month,
    Portal_Invoice_Number, Type, 'Child', BillingItemId, hostName, location,
    coalesce(c_group, category_group, 'Other'), coalesce(c_category, 'Unknown'), TaxCategory, coalesce(c_dpart, ''),
    CASE WHEN coalesce(c_group, category_group, 'Other') = 'StorageLayer' THEN split_part(c_text, ':', 1)
      ELSE split_part(c_text, '- $', 1) END,
    memory, os, billing_notes, hourly, Usage, Hours, HourlyRate, 0, NewEstimatedMonthly, totalOneTimeAmount,
    InvoiceTotal, InvoiceRecurring, Recurring_Description, bill_id * 10 + k, category, described,
    CASE WHEN kind IN (2, 3, 4) THEN CASE k WHEN 0 THEN q + 0.5 WHEN 3 THEN 0 ELSE q END
      WHEN kind = 6 AND k = 0 THEN CASE WHEN supp % 2 = 0 THEN q + 0.5 ELSE q + 0.25 END END,
    CAST({half_even("c_fee4")} AS DOUBLE) / 1000,
    CASE WHEN k = 2 THEN '' ELSE c_part END, CASE WHEN k = 2 THEN '' ELSE coalesce(division, '') END,
    CASE WHEN k = 2 THEN '' ELSE 'plan-' || k END, CASE WHEN k = 2 THEN '' ELSE 'f' || k END,
    CASE WHEN k = 0 THEN '1' ELSE '' END, CASE WHEN k = 0 THEN '1' ELSE '' END, CASE WHEN k = 0 THEN '1' ELSE '' END,
    storage_notes, CAST(one_time_cents * 10 + {half_even("c_fee4")} AS BIGINT)
  FROM (
    SELECT *, {_CHILD_COLUMNS} FROM common CROSS JOIN (SELECT CAST(range AS INT) AS k FROM range(4)) AS ks
    WHERE k < n_children
  ) AS with_child WHERE c_fee4 > 0
)"""

PART_CTE = """
part_text AS (
  SELECT 'P' || b * 2 AS part_code, arg_max(p_name || ' service: ' || p_partkey, p_partkey) AS description
  FROM (SELECT p_partkey // 2 AS b, p_name, p_partkey FROM part) AS coded GROUP BY b
)"""
