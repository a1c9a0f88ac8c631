import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from cloudtally.plans import invoice_reports as reports
from cloudtally.plans.invoice_lines import LINE_COLUMNS, charged_invoices, invoice_lines, network_storage
from cloudtally.sources import landing, snapshots


def attribute(key, value):
    return {"attributeType": {"keyName": key}, "value": value}


def child(number, code, text, fee, group=None, **more):
    category = {"name": "c", "group": {"name": group}} if group else {"name": "c"}
    out = {"billingItemId": number, "categoryCode": code, "description": text, "recurringFee": fee, "category": category,
           "product": {"description": f" {text} product "}}
    out["product"].update(more.pop("product", {}))
    return out | more


INVOICES = [
    {"id": 1, "createDate": "2024-01-20T05:59:59Z", "typeCode": "RECURRING", "invoiceTotalAmount": "100",
     "invoiceTotalRecurringAmount": "100"},
    {"id": 2, "createDate": "2024-01-20T00:00:00-06:00", "typeCode": "NEW", "invoiceTotalAmount": "10",
     "invoiceTotalRecurringAmount": "0"},
    {"id": 3, "createDate": "2024-01-05T00:00:00-06:00", "typeCode": "NEW", "invoiceTotalAmount": "0",
     "invoiceTotalRecurringAmount": "0.00"},
    {"id": 4, "createDate": "2024-01-06T00:00:00-06:00", "typeCode": "CREDIT", "invoiceTotalAmount": "-5",
     "invoiceTotalRecurringAmount": "0"},
]

ITEMS = [
    {"invoiceId": 1, "billingItemId": 11, "categoryCode": "guest_core", "hourlyFlag": True, "usageChargeFlag": False,
     "category": {"name": "Computing Instance", "group": {"name": "Virtual Servers and Attached Services"}},
     "hostName": "web", "domainName": "x.com", "location": {"longName": "Dallas"}, "totalRecurringAmount": "30.0005",
     "totalOneTimeAmount": "0", "hourlyRecurringFee": "0.25",
     "product": {"description": "4 x 2.0 GHz\nCores", "taxCategory": {"name": "IaaS"}},
     "children": [child(111, "os", "Linux", "0", hourlyRecurringFee="0.05"),
                  child(112, "ram", "8 GB", "1.2345", hourlyRecurringFee="0.2")]},
    {"invoiceId": 1, "billingItemId": 12, "categoryCode": "storage_as_a_service", "hourlyFlag": False,
     "usageChargeFlag": False, "category": {"name": "Storage As A Service", "group": {"name": "StorageLayer"}},
     "totalRecurringAmount": "12", "totalOneTimeAmount": "1.5",
     "product": {"description": "File", "taxCategory": {"name": "IaaS"}},
     "children": [child(121, "performance_storage_space", "Storage Space: 12.5 GB", "2", "StorageLayer"),
                  child(122, "storage_tier_level", "API Requests: 300 calls", "3", "StorageLayer")]},
    {"invoiceId": 1, "billingItemId": 13, "categoryCode": "platform", "hourlyFlag": False, "usageChargeFlag": True,
     "category": {"name": "Platform"}, "totalRecurringAmount": "7", "totalOneTimeAmount": "0",
     "product": {"description": "Service", "taxCategory": {"name": "PaaS"}},
     "children": [
         child(131, "s", "Units - $0.5 USD per UNIT", "4", product={
             "itemCategory": {"name": "Metered"},
             "attributes": [attribute("BLUEMIX_PART_NUMBER", " D00YFZX "),
                            attribute("BLUEMIX_SERVICE_PLAN_DIVISION", "7D")]}),
         child(132, "s", "Other units", "3", product={
             "attributes": [attribute("BLUEMIX_SERVICE_PLAN_DIVISION", "ZZ")]})]},
    {"invoiceId": 2, "billingItemId": 21, "categoryCode": "server", "hourlyFlag": False, "usageChargeFlag": False,
     "category": {"name": "Server", "group": {"name": "Servers"}}, "totalRecurringAmount": "12",
     "totalOneTimeAmount": "0", "product": {"description": "Metal", "taxCategory": {"name": "IaaS"}}, "children": []},
    {"invoiceId": 3, "billingItemId": 31, "categoryCode": "server", "hourlyFlag": False,
     "category": {"name": "Server"}, "totalRecurringAmount": "0", "totalOneTimeAmount": "0",
     "product": {"description": "Metal", "taxCategory": {"name": "IaaS"}}},
    {"invoiceId": 4, "billingItemId": 41, "categoryCode": "server", "hourlyFlag": False,
     "category": {"name": "Server"}, "totalRecurringAmount": "0", "totalOneTimeAmount": "-5",
     "product": {"description": "Metal", "taxCategory": {"name": "IaaS"}}},
]

VOLUMES = [
    {"id": 2, "billingItem": {"id": 12}, "notes": "second"},
    {"id": 1, "billingItem": {"id": 12}, "notes": "my%20files+", "capacityGb": 100, "provisionedIops": 250},
    {"id": 3, "capacityGb": 0, "provisionedIops": 10},
]


@pytest.fixture
def lines(spark, land):
    folder = land("invoices", INVOICES[:2])
    land("invoices", INVOICES[2:], page=2)
    land("invoice_items", ITEMS)
    land("network_storage", VOLUMES)
    read = {name: landing.read_entity(spark, folder, name) for name in ("invoices", "invoice_items", "network_storage")}
    return invoice_lines(read["invoices"], read["invoice_items"], read["network_storage"])


def by_id(lines):
    return {(r.BillingItemId, r.childBillingItemId): r for r in lines.collect()}


def test_lines(lines):
    assert lines.columns == LINE_COLUMNS
    found = by_id(lines)
    assert set(found) == {(11, None), (11, 112), (12, None), (12, 121), (12, 122), (13, None), (13, 131), (13, 132),
                          (21, None), (41, None)}
    server = found[11, None]
    assert (server.RecordType, server.billing_month, server.Portal_Invoice_Date) == ("Parent", "2024-01", "2024-01-19")
    assert (server.Portal_Invoice_Time, server.hostName, server.OS) == ("23:59:59-0600", "web.x.com", "Linux product")
    assert (server.Description, float(server.HourlyRate), server.Hours) == ("4 x 2.0 GHz Cores", 0.5, 60)
    assert (str(server.totalRecurringCharge), server.Service_Date_Start) == ("30.000", "2023-12-19")
    assert (server.Service_Date_End, server.Recurring_Description) == ("2023-12-31", "IaaS Usage")
    memory = found[11, 112]
    assert (memory.RecordType, memory.Category, memory.Category_Group) == (
        "Child", "Unknown", "Virtual Servers and Attached Services",
    )
    assert (str(memory.childTotalRecurringCharge), float(memory.totalRecurringCharge)) == ("1.234", 0)
    assert (memory.childParentCategory, memory.childParentProduct) == ("Computing Instance", "4 x 2.0 GHz Cores")
    storage = found[12, None]
    assert storage.Description == "Monthly File Storage Storage Space: 12.5 GB at API Requests: 300 calls product"
    assert (storage.storage_notes, server.storage_notes) == ("my files+", "")
    assert (found[12, 121].childUsage, found[12, 122].childUsage, found[13, 131].childUsage) == (12.5, 300, 0.5)
    assert (found[13, 131].INV_PRODID, found[13, 131].INV_DIV, found[13, 132].INV_PRODID) == (" D00YFZX ", "7D", "")
    assert (found[13, None].Category_Group, found[13, None].Service_Date_Start) == ("Other", "2023-11-19")
    metal = found[21, None]
    assert (metal.billing_month, metal.NewEstimatedMonthly) == ("2024-02", pytest.approx(31.0))


def test_child_repeats_the_one_time_amount_unless_told_not_to(spark, land):
    folder = land("invoices", INVOICES)
    land("invoice_items", ITEMS)
    read = [landing.read_entity(spark, folder, n) for n in ("invoices", "invoice_items")]
    assert float(by_id(invoice_lines(*read))[12, 121].totalAmount) == 3.5
    assert float(by_id(invoice_lines(*read, child_one_time="zero"))[12, 121].totalAmount) == 2
    assert all(child is None for _, child in by_id(invoice_lines(*read, children=False)))
    assert {r.Portal_Invoice_Number for r in invoice_lines(*read, start="2024-02", end="2024-02").collect()} == {2}


def test_network_storage(spark, land):
    found = network_storage(landing.read_entity(spark, land("network_storage", VOLUMES), "network_storage"))
    assert {r.id: (r.notes, r.iopsTier) for r in found.collect()} == {1: ("my files+", 2.0), 2: ("second", None), 3: ("", None)}


def test_sheets(spark, lines):
    parts = landing.read_part_descriptions(spark)
    iaas = reports.top_sheet_iaas(lines, parts, ["2024-01", "2024-02", "2024-03"]).collect()
    amounts = {(r.billing_month, r.lineItemCategory): r.totalAmount for r in iaas if not r.is_total}
    assert amounts == {
        ("2024-01", "Virtual Servers and Attached Services"): 30.0,
        ("2024-01", "Storage As A Service"): 13.5,
        ("2024-01", "Virtual Private Cloud"): 4.0,
        ("2024-02", "Server"): 12.0,
    }
    totals = {r.billing_month: r.totalAmount for r in iaas if r.is_total}
    assert totals == {"2024-01": 47.5, "2024-02": 12.0, "2024-03": 0.0}
    paas = reports.top_sheet_paas(lines, parts, ["2024-01"]).collect()
    assert sorted((r.Portal_Invoice_Number, r.lineItemCategory, r.totalAmount) for r in paas) == [
        ("1", "Service", 3.0), ("All", "", 3.0),
    ]
    credit = reports.top_sheet_credit(lines, ["2024-01"]).collect()
    assert sorted((r.Portal_Invoice_Number, r.totalAmount) for r in credit) == [("4", -5.0), ("Total", -5.0)]


def test_part_descriptions(spark):
    parts = {r.part_code: r.description for r in landing.read_part_descriptions(spark).collect()}
    assert len(parts) == 96
    assert parts["D0932ZX"] == "Software Billing Data Security Broker INSTANCE-HOURS-PER-MONTH"
    assert parts["D1VG4LL"] == "Block Storage for VPC"


def test_a_part_list_that_grows_is_hashed_and_its_rows_are_not_sorted(spark):
    """Many rows share a part, some have none or one that is not listed."""
    parts = spark.createDataFrame([("P1", "one"), ("P2", "two"), ("P3", None)], "part_code string, description string")
    codes = [" P1 ", "P2", "P3", "P4", "", None]
    schema = "Portal_Invoice_Number long, BillingItemId long, childBillingItemId long, INV_PRODID string, own string"
    rows = spark.createDataFrame([(1, i, i, codes[i % 6] if i % 2 else " P1 ", f"own {i}") for i in range(60)], schema)
    texts = {" P1 ": "one", "P2": "two"}
    want = {i: texts.get(codes[i % 6] if i % 2 else " P1 ", f"own {i}") for i in range(60)}
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            found = reports.with_part_description(rows, parts, "own", hashed=True)
            plan = found._jdf.queryExecution().sparkPlan().toString()
            got = {r.BillingItemId: r.lineItemCategory for r in found.collect()}
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "Broadcast" not in plan
        assert got == want


def test_reports_from_a_snapshot(spark, lines, tmp_path):
    folder = str(tmp_path / "out")
    months = ["2024-01", "2024-02"]
    snapshots.save_snapshot_by_month(lines, folder, "lines", "billing_month")
    saved = snapshots.load_snapshot(spark, folder, "lines")
    assert saved.count() == 10
    built = reports.invoice_report_set(saved, landing.read_part_descriptions(spark), months)
    now = dt.datetime(2024, 3, 1, 12, 5)
    paths = snapshots.write_reports(built, folder, now, ["CategoryDetail", "MthlyBaremetalServers", "Detail"])
    assert sorted(paths) == ["CategoryDetail", "Detail", "MthlyBaremetalServers"]
    assert "Detail/run_ts=20240301_120500_" in paths["Detail"]
    detail = spark.read.parquet(f"{folder}/CategoryDetail")
    total = detail.filter("is_total").first()
    assert (total["totalAmount_2024-01"], total["totalAmount_2024-02"], total["totalAmount_Total"]) == (45.5, 12.0, 57.5)
    with pytest.raises(ValueError, match="unknown reports: Nothing"):
        snapshots.write_reports(built, folder, now, ["Nothing"])
    assert snapshots.as_of_text(now) == "12:05 UTC on Mar 01, 2024"


def test_month_filter_prunes_snapshot_partitions(spark, lines, tmp_path):
    snapshots.save_snapshot(lines, str(tmp_path), "lines", "billing_month")
    saved = snapshots.load_snapshot(spark, str(tmp_path), "lines")
    plan = reports.category_detail(saved, ["2024-01"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [billing_month" in plan.replace("isnotnull(", "").replace("#", " ") or (
        "PartitionFilters" in plan and "2024-01" in plan.split("PartitionFilters")[1][:200]
    )


def test_csv_reports(spark, lines, tmp_path):
    built = {"Months": lambda: lines.groupBy("billing_month").agg(F.count("*").alias("n"))}
    path = snapshots.write_reports(built, str(tmp_path), dt.datetime(2024, 1, 1), file_format="csv")["Months"]
    assert spark.read.option("header", "true").csv(path).count() == 2


def test_amounts_of_any_size_stay(spark, land):
    big = INVOICES[0] | {"id": 901, "invoiceTotalAmount": "1234567890123.45", "invoiceTotalRecurringAmount": "0.00"}
    small = INVOICES[0] | {"id": 902, "invoiceTotalAmount": "0.0000004", "invoiceTotalRecurringAmount": "0.00"}
    nothing = INVOICES[0] | {"id": 903, "invoiceTotalAmount": "0.00", "invoiceTotalRecurringAmount": "0"}
    read = landing.read_entity(spark, land("invoices", [big, small, nothing]), "invoices")
    found = {r.Portal_Invoice_Number: float(r.InvoiceTotal) for r in charged_invoices(read).collect()}
    assert found == {901: 1234567890123.45, 902: 0.0000004}


@pytest.mark.parametrize("field, value", [("invoiceTotalAmount", "bad"), ("invoiceTotalAmount", "12,5"), ("createDate", "soon")])
def test_malformed_invoices_fail_the_run(spark, land, field, value):
    read = landing.read_entity(spark, land("invoices", [INVOICES[0] | {field: value}]), "invoices")
    with pytest.raises(Exception, match="not an amount|not a time"):
        charged_invoices(read).collect()


def test_cut_off_lines_and_wrong_types_fail_the_read(spark, land, tmp_path):
    folder = land("invoices", INVOICES[:1])
    (tmp_path / "landing" / "invoices" / "page-0009.json").write_text('{"id": 5, "createDate": "2024-01-')
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.read_entity(spark, folder, "invoices").collect()
    folder = land("invoice_items", [ITEMS[0] | {"invoiceId": "text"}])
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.read_entity(spark, folder, "invoice_items").collect()


def test_lines_meet_their_invoices_as_flat_rows(lines):
    """What is shuffled has the columns in use alone, filters come first, nothing nested moves."""
    plan = lines.filter("RecordType = 'Parent'").select("BillingItemId", "Description")._jdf.queryExecution()
    sides = []

    def walk(node):
        if node.nodeName() == "Join":
            sides.append(node.children().head())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan.optimizedPlan())
    kinds = [s.schema().catalogString() for s in sides]
    assert kinds and not any("array" in k or "totalRecurringAmount" in k or "billing_notes" in k for k in kinds)
    below = sides[-1].toString()
    assert "Generate explode" in below and "Filter" in below.partition("Generate explode")[0]


ODD = [
    ITEMS[0] | {"billingItemId": 91, "hostName": 'a "b"\\ c', "domainName": "", "notes": "ein\nzwei\t\u0001 \u00fc\U0001f600", "dPart": "null",
                "children": [child(911, "x", 'Odd, "text"] \\', "1.50", dPart=""), child(912, "x", "Free", None)]},
    ITEMS[1] | {"billingItemId": 92, "hourlyFlag": None, "location": {"longName": "[1, 2]"}, "children": None,
                "totalRecurringAmount": "123456789012345678.0123456789", "hourlyRecurringFee": "0.1234567891"},
    ITEMS[2] | {"billingItemId": None, "product": {"description": None}},
]


def test_whole_lines_are_those_of_flat_rows(spark, land):
    folder = land("invoices", INVOICES)
    land("invoice_items", ITEMS + ODD)
    land("network_storage", VOLUMES)
    read = [landing.read_entity(spark, folder, n) for n in ("invoices", "invoice_items", "network_storage")]
    whole, flat = invoice_lines(*read, whole=True), invoice_lines(*read)
    assert whole.dtypes == flat.dtypes
    assert sorted(map(str, whole.collect())) == sorted(map(str, flat.collect())) and flat.count() == 16


def test_the_time_of_an_invoice_is_read_only_where_it_is_used(spark, land):
    folder = land("invoices", [INVOICES[0] | {"createDate": None}])
    land("invoice_items", ITEMS)
    lines = invoice_lines(*[landing.read_entity(spark, folder, n) for n in ("invoices", "invoice_items")])
    assert lines.select("BillingItemId", "childBillingItemId").count() == 8
    with pytest.raises(Exception, match="not a time"):
        lines.select("BillingItemId", "Portal_Invoice_Date").collect()


def test_whole_lines_are_shuffled_as_items(spark, land):
    """Their texts in two columns, and the keys of the lookups beside them."""
    folder = land("invoices", INVOICES)
    land("invoice_items", ITEMS)
    plan = invoice_lines(*[landing.read_entity(spark, folder, n) for n in ("invoices", "invoice_items")], whole=True)
    plan = plan._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().head()
    side = plan.children().head()
    assert "Generate" not in side.toString()
    assert set(side.schema().fieldNames()) <= {"_invoice", "BillingItemId", "_item", "children", "storage_notes", "_left_key"}


@pytest.mark.parametrize("fee", ["a lot", "1"])
def test_whole_lines_fail_on_no_amount_only_with_its_invoice(spark, land, fee):
    def read(invoice):
        odd = {"children": [child(911, "x", "Odd", fee)], "totalOneTimeAmount": "1" if fee == "a lot" else "odd"}
        land("invoice_items", [ITEMS[0] | {"invoiceId": invoice, "billingItemId": 91} | odd], page=2)
        return invoice_lines(*[landing.read_entity(spark, folder, n) for n in ("invoices", "invoice_items")], whole=True)

    folder = land("invoices", INVOICES)
    land("invoice_items", ITEMS)
    assert len(read(77).collect()) == 10
    with pytest.raises(Exception, match="not an amount: (a lot|odd)"):
        read(1).collect()


def test_text_that_is_no_amount_fails_only_with_its_invoice(spark, land):
    def read(invoice):
        odd = [child(911, "x", "Odd", "a lot"), child(912, "x", "Fair", "2")]
        item = ITEMS[0] | {"invoiceId": invoice, "billingItemId": 91, "children": odd}
        land("invoice_items", [item], page=2)
        read = [landing.read_entity(spark, folder, n) for n in ("invoices", "invoice_items")]
        return invoice_lines(*read).select("BillingItemId", "childBillingItemId")

    folder = land("invoices", INVOICES)
    land("invoice_items", ITEMS)
    assert len(read(3).collect()) == len(read(77).collect()) == 10
    with pytest.raises(Exception, match="not an amount: a lot"):
        read(1).collect()


@pytest.mark.parametrize("field", ["totalRecurringAmount", "totalOneTimeAmount", "hourlyRecurringFee", "child"])
def test_an_amount_of_an_item_that_is_none_fails_with_its_invoice(spark, land, field):
    def read(invoice):
        odd = {"children": [child(911, "x", "Odd", "1", hourlyRecurringFee="odd")]} if field == "child" else {field: "odd"}
        land("invoice_items", [ITEMS[0] | {"invoiceId": invoice, "billingItemId": 91} | odd], page=2)
        return invoice_lines(*[landing.read_entity(spark, folder, n) for n in ("invoices", "invoice_items")])

    folder = land("invoices", INVOICES)
    land("invoice_items", ITEMS)
    assert len(read(77).collect()) == 10
    with pytest.raises(Exception, match="not an amount: odd"):
        read(1).collect()


def test_amounts_of_an_item_are_read_once_for_all_its_lines(lines):
    plan = lines.select("Hours", "totalRecurringCharge", "totalAmount")._jdf.queryExecution().optimizedPlan().toString()
    above = plan.partition("Generate explode")[0]
    assert "try_cast(totalRecurringAmount" not in above and "try_cast(totalOneTimeAmount" not in above
    assert not any(f"try_cast({n}" in above for n in ("_fee#", "_one_time#", "_own_rate#"))


def test_only_lines_of_storage_are_looked_up(lines):
    plan = lines._jdf.queryExecution().optimizedPlan()
    joins = []

    def walk(node):
        if node.nodeName() == "Join":
            joins.append(node)
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    looked_up = joins[-1].children().head().toString()
    assert re.search(r"Filter .*categoryCode#\d+ IN \(", looked_up.partition("Generate explode")[2])
    assert sorted((r[0], r[1]) for r in lines.select("BillingItemId", "storage_notes").distinct().collect()) == [
        (11, ""), (12, "my files+"), (13, ""), (21, ""), (41, ""),
    ]
