"""Invoice queries: column rules, lookups and the reports on invoice lines."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.billing_views import (
    INVOICE_CTE, ITEM_CTE, LINES_CTE, MONTHS, PART_CTE, invoices, items, lines, parts, volumes,
)
from checks.registry import check, pivot_sql
from checks.tables import all_within, run, table
from cloudtally.functions import charges, dates, nested, text
from cloudtally.operators.lookup import distinct_values
from cloudtally.operators.pivot import Measure, in_report_order, pivot_report
from cloudtally.plans import invoice_reports as reports
from cloudtally.plans.invoice_lines import charged_invoices, network_storage
from cloudtally.session import work_folder

LINES = f"WITH {LINES_CTE}"
MONEY = "CAST(SUM([amount_milli]) AS DOUBLE) / 1000"
RECURRING = "CAST(SUM([recurring_milli]) AS DOUBLE) / 1000"
WITH_RECURRING = "SELECT *, CAST(round(totalRecurringCharge * 1000) AS BIGINT) AS recurring_milli FROM line"


def _local(spark, sf_dir):
    """Invoice id, instant and local time of all invoices."""
    created = dates.instant(F.col("createDate"))
    return invoices(spark, sf_dir).select("*", created.alias("created"), dates.local_time(created).alias("local_ts"))


# --- calendar -------------------------------------------------------------------------------------------------

ALL_INVOICES = INVOICE_CTE.replace("WHERE NOT (total_cents = 0 AND recurring_cents = 0)", "")


@check(
    "billing_month",
    f"""WITH {ALL_INVOICES} SELECT id, strftime(CASE WHEN day(day0) > 19 THEN day0 + INTERVAL 1 MONTH ELSE day0 END,
    '%Y-%m') AS billing_month FROM inv""",
)
def _(spark, sf_dir):
    return _local(spark, sf_dir).select("id", dates.billing_month(F.col("local_ts")).alias("billing_month"))


@check(
    "local_billing_time",
    f"""WITH {ALL_INVOICES} SELECT id, strftime(local_ts, '%Y-%m-%d') AS local_date, strftime(local_ts, '%H:%M:%S') ||
    CASE WHEN date_diff('hour', ts, local_ts) = -5 THEN '-0500' ELSE '-0600' END AS local_clock FROM inv""",
)
def _(spark, sf_dir):
    return _local(spark, sf_dir).select(
        "id",
        dates.date_text(F.col("local_ts")).alias("local_date"),
        dates.local_clock_text(F.col("created")).alias("local_clock"),
    )


@check(
    "invoice_window",
    f"""WITH {ALL_INVOICES}, m AS (SELECT DISTINCT date_trunc('month', day0)::DATE AS first FROM inv)
    SELECT strftime(first, '%Y-%m') AS month,
      epoch(((first - INTERVAL 1 MONTH + INTERVAL 19 DAY)::TIMESTAMP) AT TIME ZONE 'US/Central')::BIGINT AS window_start,
      epoch(((first + INTERVAL 2 MONTH + INTERVAL 19 DAY)::TIMESTAMP) AT TIME ZONE 'US/Central')::BIGINT AS window_end
    FROM m""",
)
def _(spark, sf_dir):
    months = distinct_values(
        _local(spark, sf_dir).select(dates.month_text(F.col("local_ts")).alias("month")), "month"
    )
    start, end = dates.invoice_window(F.col("month"), dates.shift_month(F.col("month"), 2))
    return months.select(
        "month", F.unix_timestamp(start).alias("window_start"), F.unix_timestamp(end).alias("window_end")
    )


@check(
    "filter_invoice_window",
    f"""WITH {ALL_INVOICES} SELECT id, strftime(local_ts, '%Y-%m-%d %H:%M:%S') AS local_time FROM inv
    WHERE local_ts BETWEEN TIMESTAMP '1996-12-20 00:00:00' AND TIMESTAMP '1998-03-20 00:00:00'""",
)
def _(spark, sf_dir):
    first, last = dates.invoice_window("1997-01", "1998-03")
    kept = _local(spark, sf_dir).filter(F.col("created").between(first, last))
    return kept.select("id", F.substring(F.col("local_ts").cast("string"), 1, 19).alias("local_time"))


@check(
    "month_sequence",
    f"""WITH {ALL_INVOICES}, firsts AS (SELECT id, CAST(date_trunc('month', day0) AS DATE) AS first FROM inv)
    SELECT id, strftime(unnest(generate_series(first::TIMESTAMP, (first + INTERVAL 2 MONTH)::TIMESTAMP, INTERVAL 1 MONTH)),
    '%Y-%m') AS month FROM firsts""",
)
def _(spark, sf_dir):
    start = dates.month_text(F.col("local_ts"))
    listed = dates.months_between_texts(start, dates.shift_month(start, 2))
    return _local(spark, sf_dir).select("id", F.explode(listed).alias("month"))


@check(
    "usage_month_shift",
    f"""WITH {ALL_INVOICES} SELECT id, strftime(date_trunc('month', day0) - INTERVAL 2 MONTH, '%Y-%m') AS usage_month
    FROM inv""",
)
def _(spark, sf_dir):
    return _local(spark, sf_dir).select(
        "id", dates.usage_month(dates.month_text(F.col("local_ts"))).alias("usage_month")
    )


@check(
    "provision_dates",
    f"""WITH {ALL_INVOICES} SELECT id, strftime(ts + INTERVAL 6 HOUR, '%Y-%m-%d') AS provision_date,
    CASE WHEN id % 2 = 0 THEN strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%d') ELSE '' END AS deprovision_date FROM inv""",
)
def _(spark, sf_dir):
    local_text = F.replace(F.col("createDate"), F.lit("+0000"), F.lit("-06:00"))
    ended = F.when(F.col("id") % 2 == 0, F.replace(F.col("createDate"), F.lit("+0000"), F.lit("+0200")))
    return invoices(spark, sf_dir).select(
        "id",
        dates.provision_date(local_text).alias("provision_date"),
        dates.provision_date(ended).alias("deprovision_date"),
    )


@check(
    "provision_month",
    f"""WITH {ALL_INVOICES} SELECT id, CASE WHEN id % 10 = 0 THEN '' ELSE strftime(ts, '%Y-%m') END AS provision_month
    FROM inv""",
)
def _(spark, sf_dir):
    when = F.when(F.col("id") % 10 == 0, "").otherwise(F.replace(F.col("createDate"), F.lit("+0000"), F.lit("-0600")))
    return invoices(spark, sf_dir).select("id", dates.provision_month(when).alias("provision_month"))


@check("filter_nonzero_invoices", f"WITH {INVOICE_CTE} SELECT id, type_code FROM inv")
def _(spark, sf_dir):
    return charged_invoices(invoices(spark, sf_dir)).select(
        F.col("Portal_Invoice_Number").alias("id"), F.col("Type").alias("type_code")
    )


# --- items and children ---------------------------------------------------------------------------------------

_ID = "invoice_id, bill_id, ln"
_CHILDREN = f"WITH {ITEM_CTE}"


def _children(spark, sf_dir):
    """All children, charged or not, with their item's ids."""
    return items(spark, sf_dir).select(
        F.col("invoiceId").alias("invoice_id"),
        F.col("billingItemId").alias("bill_id"),
        F.col("category.group.name").alias("parent_group"),
        F.explode("children").alias("c"),
    )


@check("filter_charged_children", f"{_CHILDREN} SELECT invoice_id, bill_id * 10 + k AS child_id FROM base_child WHERE c_fee4 > 0")
def _(spark, sf_dir):
    kept = _children(spark, sf_dir).filter(charges.positive(F.col("c.recurringFee")))
    return kept.select("invoice_id", F.col("c.billingItemId").alias("child_id"))


@check(
    "attributes_to_columns",
    f"""{_CHILDREN} SELECT invoice_id, bill_id * 10 + k AS child_id,
    CASE WHEN k = 2 THEN '' ELSE c_part END AS INV_PRODID, CASE WHEN k = 2 THEN '' ELSE coalesce(division, '') END AS INV_DIV,
    CASE WHEN k = 2 THEN '' ELSE 'plan-' || k END AS PLAN_ID, CASE WHEN k = 2 THEN '' ELSE 'f' || k END AS FEATURE_ID,
    CASE WHEN k = 0 THEN '1' ELSE '' END AS IS_PRIVATE_NETWORK_ONLY, CASE WHEN k = 0 THEN '1' ELSE '' END AS DUAL_PATH_NETWORK,
    CASE WHEN k = 0 THEN '1' ELSE '' END AS INELIGIBLE_FOR_ACCOUNT_DISCOUNT FROM base_child""",
)
def _(spark, sf_dir):
    columns = [
        nested.attribute(F.col("c.product.attributes"), key).alias(name)
        for key, name in nested.CHILD_ATTRIBUTES.items()
    ]
    return _children(spark, sf_dir).select("invoice_id", F.col("c.billingItemId").alias("child_id"), *columns)


@check(
    "first_child_by_code",
    f"""{_CHILDREN} SELECT invoice_id, bill_id,
    CASE WHEN kind IN (0, 1) AND n_children >= 2 THEN p_size || ' GB' WHEN kind = 5 AND n_children >= 3 THEN 'Product 2'
      ELSE '' END AS memory,
    CASE WHEN kind IN (0, 1) AND n_children >= 1 THEN p_name WHEN kind = 5 AND n_children >= 2 THEN 'Linux' ELSE '' END AS os,
    CASE WHEN kind IN (2, 3, 4) AND n_children >= 3 THEN 'Snapshot Space: ' || q || ' GB' ELSE '' END AS snapshot
    FROM base_item""",
)
def _(spark, sf_dir):
    children = F.col("children")
    return items(spark, sf_dir).select(
        F.col("invoiceId").alias("invoice_id"),
        F.col("billingItemId").alias("bill_id"),
        nested.first_child_text(children, "ram", "product").alias("memory"),
        nested.first_child_text(children, "os", "product").alias("os"),
        nested.first_child_text(children, "storage_snapshot_space", "item").alias("snapshot"),
    )


@check(
    "child_fee_sum",
    f"""{_CHILDREN} SELECT invoice_id, bill_id, CAST(5 * least(n_children, 2) AS DOUBLE) / 100 AS child_rate
    FROM base_item""",
)
def _(spark, sf_dir):
    return items(spark, sf_dir).select(
        F.col("invoiceId").alias("invoice_id"),
        F.col("billingItemId").alias("bill_id"),
        charges.child_rate_sum(F.col("children")).cast("double").alias("child_rate"),
    )


@check(
    "parsed_child_usage",
    f"""{_CHILDREN} SELECT invoice_id, bill_id * 10 + k AS child_id,
    CASE WHEN coalesce(c_group, category_group, 'Other') = 'StorageLayer' THEN split_part(c_text, ':', 1)
      ELSE split_part(c_text, '- $', 1) END AS description,
    CAST(CASE WHEN kind IN (2, 3, 4) THEN CASE k WHEN 0 THEN q + 0.5 WHEN 3 THEN 0 ELSE q END
      WHEN kind = 6 AND k = 0 THEN CASE WHEN supp % 2 = 0 THEN q + 0.5 ELSE q + 0.25 END END AS DOUBLE) AS usage
    FROM base_child""",
)
def _(spark, sf_dir):
    group = F.coalesce("c.category.group.name", "parent_group", F.lit("Other"))
    parsed = text.parsed_usage(group, F.col("c.description"))
    return _children(spark, sf_dir).select(
        "invoice_id", F.col("c.billingItemId").alias("child_id"), parsed["description"].alias("description"),
        parsed["usage"].alias("usage"),
    )


def _line_query(name: str, columns: list[str], where: str = ""):
    """A query on some columns of the invoice lines."""
    amounts = {"HourlyRate", "totalRecurringCharge", "totalOneTimeAmount", "childTotalRecurringCharge"}
    picked = ["CAST(amount_milli AS DOUBLE) / 1000 AS totalAmount" if c == "totalAmount" else c for c in columns]

    @check(name, f"{LINES} SELECT {', '.join(picked)} FROM line {where}")
    def _(spark, sf_dir):
        rows = lines(spark, sf_dir, notes="storage_notes" in columns)
        if where:
            rows = rows.filter(where.removeprefix("WHERE "))
        return rows.select(
            *[F.col(c).cast("double").alias(c) if c in amounts | {"totalAmount"} else F.col(c) for c in columns]
        )


_KEY = ["Portal_Invoice_Number", "BillingItemId", "childBillingItemId"]
_line_query("flatten_invoice_lines", [*_KEY, "RecordType", "Category", "Category_Group", "childParentCategory",
                                      "childParentProduct", "totalRecurringCharge", "childTotalRecurringCharge"])
_line_query("service_period", [*_KEY, "Service_Date_Start", "Service_Date_End", "Recurring_Description"])
_line_query("prorated_estimate", [*_KEY, "Type", "NewEstimatedMonthly"])
_line_query("derived_hours", [*_KEY, "Hourly", "Hours", "HourlyRate"])
_line_query("storage_description", [*_KEY, "Category", "Description"], "WHERE RecordType = 'Parent'")
_line_query("host_fqdn", [*_KEY, "hostName"])
_line_query("missing_defaults", [*_KEY, "hostName", "location", "billing_notes", "dPart", "INV_PRODID", "INV_DIV"])
_line_query("rounded_charges", [*_KEY, "HourlyRate", "totalRecurringCharge", "childTotalRecurringCharge"])
_line_query("total_amount", [*_KEY, "totalOneTimeAmount", "totalAmount"])
_line_query("join_storage_notes", [*_KEY, "storage_notes"])


@check("clean_description", f"{_CHILDREN} SELECT invoice_id, bill_id, replace(product, chr(10), ' ') AS description FROM base_item")
def _(spark, sf_dir):
    return items(spark, sf_dir).select(
        F.col("invoiceId").alias("invoice_id"),
        F.col("billingItemId").alias("bill_id"),
        charges.clean_description(F.col("product.description")).alias("description"),
    )


LINE_CATEGORY = """CASE WHEN Category_Group = 'Virtual Servers and Attached Services'
    THEN 'Virtual Servers and Attached Services'
  WHEN Category = 'Software License' THEN 'Software License' || CASE WHEN contains(Description, 'vSAN')
    THEN ' VMware vSAN' WHEN contains(Description, 'NSX') THEN ' VMware NSX' ELSE '' END
  WHEN Category_Group = 'Other' AND Category IN ('Network Vlan', 'Network Message Delivery') THEN 'Network Other'
  ELSE Category END"""


@check(
    "line_item_category",
    f"""{LINES} SELECT Portal_Invoice_Number, BillingItemId, {LINE_CATEGORY} AS lineItemCategory
    FROM line WHERE RecordType = 'Parent'""",
)
def _(spark, sf_dir):
    rows = lines(spark, sf_dir, children=False)
    return rows.select(
        "Portal_Invoice_Number", "BillingItemId",
        charges.parent_line_category(
            F.col("Category_Group"), F.col("Category"), F.col("Description")
        ).alias("lineItemCategory"),
    )


@check(
    "part_description_lookup",
    f"""{LINES}, {PART_CTE} SELECT Portal_Invoice_Number, childBillingItemId,
    coalesce(p.description, line.Description) AS lineItemCategory
    FROM line LEFT JOIN part_text AS p ON trim(INV_PRODID) = part_code WHERE RecordType = 'Child'""",
)
def _(spark, sf_dir):
    rows = lines(spark, sf_dir).filter(F.col("RecordType") == "Child")
    return reports.with_part_description(rows, parts(spark, sf_dir), "Description", hashed=True).select(
        "Portal_Invoice_Number", "childBillingItemId", "lineItemCategory"
    )


@check(
    "iops_tier",
    """SELECT p_partkey AS id, CASE WHEN p_size > 1 THEN round_even(p_retailprice / (p_size - 1), 0) END AS iopsTier
    FROM part""",
)
def _(spark, sf_dir):
    return network_storage(volumes(spark, sf_dir)).select("id", "iopsTier")


@check(
    "decoded_notes",
    """SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'vol ' || p_partkey || '+100%' END AS notes
    FROM part""",
)
def _(spark, sf_dir):
    return network_storage(volumes(spark, sf_dir)).select("id", "notes")


# --- pivots ---------------------------------------------------------------------------------------------------


def _months_report(name, build, source, keys, cells, total="Total", fill=True, **wanted):
    sql = pivot_sql(LINES_CTE, source, keys, cells, "billing_month", MONTHS, total, fill)

    @check(name, sql)
    def _(spark, sf_dir):
        return build(all_within(lines(spark, sf_dir, **wanted), "billing_month", MONTHS), MONTHS)


_PARENTS = "SELECT * FROM line WHERE RecordType = 'Parent'"
_months_report("category_group_summary", reports.category_group_summary, _PARENTS,
               ["Type", "dPart", "Category_Group", "Category"], {"totalAmount": MONEY}, children=False)
_months_report("category_detail", reports.category_detail, _PARENTS,
               ["Type", "Category_Group", "Category", "Description"], {"totalAmount": MONEY}, children=False)
_months_report(
    "object_storage_detail", reports.object_storage_detail,
    """SELECT *, coalesce(CAST(round(childUsage * 100) AS BIGINT), 0) AS usage_cents,
    CAST(round(childTotalRecurringCharge * 1000) AS BIGINT) AS charge_milli FROM line
    WHERE RecordType = 'Child' AND childParentProduct = 'Cloud Object Storage - S3 API'""",
    ["Type", "Category_Group", "childParentProduct", "Category", "Description"],
    {"usageQty": "CAST(SUM([usage_cents]) AS DOUBLE) / 100",
     "totalUsageCharge": "CAST(SUM([charge_milli]) AS DOUBLE) / 1000"}, fill=False,
)
_months_report("storage_pivot", reports.storage_pivot,
               f"""SELECT * FROM ({WITH_RECURRING}) AS r WHERE Category = 'Storage As A Service'
               OR (Category = 'Endurance' AND Type = 'RECURRING')""",
               ["location", "Category", "billing_notes", "storage_notes", "Description"],
               {"TotalRecurring": RECURRING}, total=None, notes=True)


def _server_source(category: str, hourly: bool) -> str:
    negation = "" if hourly else "NOT "
    return f"SELECT * FROM ({WITH_RECURRING}) AS r WHERE Category = '{category}' AND {negation}Hourly"


_QTY = "CAST(SUM([1]) AS BIGINT)"
_months_report("hourly_virtual_servers", reports.hourly_virtual_servers, _server_source("Computing Instance", True),
               ["Description", "OS"],
               {"qty": _QTY, "TotalHours": "CAST(SUM([Hours]) AS BIGINT)", "TotalRecurring": RECURRING}, total=None)
_months_report("monthly_virtual_servers", reports.monthly_virtual_servers, _server_source("Computing Instance", False),
               ["Description", "OS"], {"qty": _QTY, "TotalRecurring": RECURRING}, total=None)
_months_report("hourly_bare_metal", reports.hourly_bare_metal, _server_source("Server", True),
               ["Description", "OS"], {"qty": _QTY, "TotalRecurring": RECURRING}, total=None)
_months_report("monthly_bare_metal", reports.monthly_bare_metal, _server_source("Server", False),
               ["location", "Description", "OS"], {"qty": _QTY, "TotalRecurring": RECURRING}, total=None)


def _sheet_sql(rows: str, label: str, every_month: bool = False) -> str:
    keys = ", ".join(reports.SHEET_KEYS)
    top = "GROUPING(Portal_Invoice_Number) = 1"
    labelled = ", ".join(
        f"CASE WHEN {top} THEN '{label if i == 0 else ''}' ELSE CAST({k} AS VARCHAR) END AS {k}"
        for i, k in enumerate(reports.SHEET_KEYS)
    )
    sheet = f"""SELECT billing_month, {labelled}, {top} AS is_total, CAST(SUM(amount_milli) AS DOUBLE) / 1000 AS totalAmount
      FROM sheet_row GROUP BY GROUPING SETS ((billing_month, {keys}), (billing_month))"""
    if every_month:
        blanks = ", ".join(f"'{label if i == 0 else ''}'" for i, k in enumerate(reports.SHEET_KEYS))
        months = ", ".join(f"('{m}')" for m in MONTHS)
        sheet += f""" UNION ALL SELECT m, {blanks}, true, 0 FROM (VALUES {months}) AS wanted(m)
          WHERE m NOT IN (SELECT billing_month FROM sheet_row)"""
    return f"{LINES}, {PART_CTE}, sheet_row AS ({rows}) {sheet}"


_ON_IAAS = "(coalesce(INV_DIV, '') IN ('7D', 'SQ', '5M', 'U3', 'U6', 'U7') OR coalesce(INV_PRODID, '') = 'D026XZX')"


@check(
    "top_sheet_iaas",
    _sheet_sql(
        f"""SELECT line.*, coalesce(p.description, line.Description) AS lineItemCategory FROM line
        LEFT JOIN part_text AS p ON trim(INV_PRODID) = part_code
        WHERE RecordType = 'Child' AND {_ON_IAAS} AND amount_milli > 0
        UNION ALL SELECT line.*, {LINE_CATEGORY} FROM line
        WHERE RecordType = 'Parent' AND TaxCategory <> 'PaaS' AND amount_milli > 0""",
        "Total",
        every_month=True,
    ),
)
def _(spark, sf_dir):
    return reports.top_sheet_iaas(all_within(lines(spark, sf_dir), "billing_month", MONTHS), parts(spark, sf_dir), MONTHS)


@check(
    "top_sheet_paas",
    _sheet_sql(
        f"""SELECT line.*, coalesce(p.description, childParentProduct) AS lineItemCategory FROM line
        LEFT JOIN part_text AS p ON trim(INV_PRODID) = part_code
        WHERE RecordType = 'Child' AND TaxCategory = 'PaaS' AND NOT {_ON_IAAS}""",
        "All",
    ),
)
def _(spark, sf_dir):
    return reports.top_sheet_paas(all_within(lines(spark, sf_dir), "billing_month", MONTHS), parts(spark, sf_dir), MONTHS)


@check(
    "top_sheet_credit",
    _sheet_sql("SELECT line.*, Category AS lineItemCategory FROM line WHERE Type = 'CREDIT'", "Total"),
)
def _(spark, sf_dir):
    return reports.top_sheet_credit(all_within(lines(spark, sf_dir), "billing_month", MONTHS), MONTHS)


@check(
    "invoice_detail",
    f"{LINES} SELECT * EXCLUDE (amount_milli), CAST(amount_milli AS DOUBLE) / 1000 AS totalAmount FROM line",
)
def _(spark, sf_dir):
    return reports.invoice_detail(lines(spark, sf_dir, notes=True, whole=True))


@check("distinct_months", f"{LINES} SELECT DISTINCT billing_month FROM line")
def _(spark, sf_dir):
    return distinct_values(lines(spark, sf_dir), "billing_month")


_ORDERS = """SELECT o_orderpriority AS priority, o_orderstatus AS status, o_custkey AS customer,
  strftime(o_orderdate, '%Y-%m') AS month, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders"""
_CENTS = "CAST(SUM([cents]) AS DOUBLE) / 100"


def _orders(spark, sf_dir):
    return run(spark, sf_dir, """SELECT o_orderpriority AS priority, o_orderstatus AS status, o_custkey AS customer,
      substring(CAST(o_orderdate AS STRING), 1, 7) AS month, CAST(o_totalprice AS DECIMAL(18, 6)) AS amount
      FROM {orders}""")  # fmt: skip


_KEYS = ["priority", "status"]
_AMOUNT = Measure("amount")
_CUSTOMERS = Measure("customers", "distinct", "customer")
_ROWS = Measure("orders", "rows")
_DISTINCT = "COUNT(DISTINCT [customer])"

_PIVOTS = {
    "pivot_sum_margins": ([_AMOUNT], {"amount": _CENTS}, "Total"),
    "pivot_nunique_margins": ([_CUSTOMERS], {"customers": _DISTINCT}, "Total"),
    "pivot_row_count": ([_ROWS], {"orders": _QTY}, "Total"),
    "pivot_multi_measure": (
        [_ROWS, _CUSTOMERS, _AMOUNT], {"orders": _QTY, "customers": _DISTINCT, "amount": _CENTS}, "Total",
    ),
    "margin_labels": ([_AMOUNT], {"amount": _CENTS}, "All"),
}
for _name, (_measures, _cells, _label) in _PIVOTS.items():

    @check(
        _name,
        pivot_sql("unused AS (SELECT 1)", _ORDERS, _KEYS, _cells, "month", MONTHS, _label),
    )
    def _(spark, sf_dir, measures=_measures, label=_label):
        return pivot_report(_orders(spark, sf_dir), _KEYS, measures, "month", MONTHS, label)


_GROUPED = pivot_sql("unused AS (SELECT 1)", _ORDERS, _KEYS, {"amount": _CENTS, "customers": _DISTINCT}, total="Count")


@check("group_sum_total", _GROUPED)
def _(spark, sf_dir):
    return pivot_report(_orders(spark, sf_dir), _KEYS, [_AMOUNT, _CUSTOMERS], total="Count", total_of_nothing=True)


@check(
    "ordered_with_total",
    f"""SELECT *, row_number() OVER (ORDER BY is_total, {', '.join(_KEYS)}) - 1 AS place
    FROM ({pivot_sql("unused AS (SELECT 1)", _ORDERS, _KEYS, {"amount": _CENTS})})""",
)
def _(spark, sf_dir):
    """The report as written: its place is the row's in the order of its files."""
    report = in_report_order(pivot_report(_orders(spark, sf_dir), _KEYS, [_AMOUNT]))
    folder = f"{work_folder(spark)}/cloudtally-ordered/{uuid.uuid4().hex}"
    report.write.parquet(folder)
    by = Window.orderBy("_metadata.file_name", "_metadata.row_index")
    return spark.read.parquet(folder).withColumn("place", F.row_number().over(by) - 1)


@check(
    "invoices_of_any_amount",
    """SELECT o_orderkey AS "Portal_Invoice_Number", CASE o_orderkey % 3
      WHEN 0 THEN CAST(CAST(round(o_totalprice * 100) AS BIGINT) || '000000000.25' AS DOUBLE)
      WHEN 1 THEN CAST('0.000000' || (1 + o_orderkey % 9) AS DOUBLE) ELSE 0.0 END AS total
    FROM orders WHERE o_orderkey % 3 < 2""",
)
def _(spark, sf_dir):
    """Invoices far above and below ordinary amounts are kept, those of zero are not."""
    amount = """CASE o_orderkey % 3
      WHEN 0 THEN concat(cast(round(o_totalprice * 100) as bigint), '000000000.25')
      WHEN 1 THEN concat('0.000000', 1 + o_orderkey % 9) ELSE '0.00' END"""
    invoices_ = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as id", "'2024-01-05T10:00:00Z' as createDate", "'NEW' as typeCode",
        f"{amount} as invoiceTotalAmount", "'0.00' as invoiceTotalRecurringAmount",
    )
    kept = charged_invoices(invoices_)
    return kept.select("Portal_Invoice_Number", F.col("InvoiceTotal").cast("double").alias("total"))
