import datetime as dt

import pytest
from test_inventory_pipeline import BARE, FULL, TRUNKS, storage_record
from test_invoice_pipeline import INVOICES, ITEMS, VOLUMES
from test_usage_pipeline import METAL, RESOURCES, SERVERS, USAGE

from cloudtally import programs
from cloudtally.sources import runs
from cloudtally.sources import store as store_module

NOW = dt.datetime(2024, 3, 1, 12, 5)


def test_invoice_analysis(spark, land, tmp_path):
    folder = land("invoices", INVOICES)
    land("invoice_items", ITEMS)
    land("network_storage", VOLUMES)
    land("account", [{"id": 1, "companyName": "co", "internalNotes": [{"note": "**x**"}, {"note": "y"}]}])
    land("classic_users", [{"id": 5, "loginAttempts": []}])
    output = str(tmp_path / "out")
    paths = programs.invoice_analysis(spark, folder, output, "2024-01", "2024-02", NOW, storage_notes=True)
    assert set(paths) >= {"Detail", "TopSheet_IaaS", "StoragePivot", "AccountDetail", "Users"}
    assert spark.read.parquet(f"{output}/StoragePivot").first().storage_notes == "my files+"
    assert spark.read.parquet(f"{output}/AccountDetail").first().internalNotes == "xy"
    assert spark.read.parquet(f"{output}/Users").first().lastLoginAttempt is None


def test_invoice_at_the_end_of_the_window_keeps_its_month(spark, land, tmp_path):
    last = INVOICES[1] | {"createDate": "2024-02-20T00:00:00-06:00"}
    folder = land("invoices", [INVOICES[0], last])
    land("invoice_items", ITEMS)
    output = str(tmp_path / "out")
    programs.invoice_analysis(spark, folder, output, "2024-01", "2024-02", NOW, ["CategoryDetail"])
    total = spark.read.parquet(f"{output}/CategoryDetail").filter("is_total").first()
    assert (total["totalAmount_2024-02"], total["totalAmount_2024-03"]) == (0.0, 12.0)


def test_two_runs_at_one_time_and_default_months(spark, land, tmp_path):
    folder = land("invoices", INVOICES)
    land("invoice_items", ITEMS)
    output = str(tmp_path / "out")
    first, second = (
        programs.invoice_analysis(spark, folder, output, None, None, NOW, ["CategoryDetail"], parents_only=parents, months=2)
        for parents in (False, True)
    )
    assert first["CategoryDetail"] != second["CategoryDetail"]
    rows = spark.read.parquet(first["CategoryDetail"])
    assert {c.rsplit("_", 1)[1] for c in rows.columns if c.startswith("totalAmount")} >= {"2024-01", "2024-02", "Total"}
    flags = [r.is_total for r in rows.collect()]
    assert flags == sorted(flags) and flags[-1]
    info = spark.read.json(f"{output}/RunInfo").collect()
    assert len(info) == 2 and {r.as_of for r in info} == {"12:05 UTC on Mar 01, 2024"}


def test_compacted_landing_gives_the_same_reports(spark, land, tmp_path):
    folder, store = land("invoices", INVOICES), str(tmp_path / "store")
    for entity, records in (("invoice_items", ITEMS), ("instance_usage", USAGE), ("resources", RESOURCES)):
        land(entity, records)
    programs.compact_landing(spark, folder, store)
    plain = programs.invoice_analysis(spark, folder, str(tmp_path / "a"), "2024-01", "2024-02", NOW, ["Detail", "CategoryDetail"])
    pruned = programs.invoice_analysis(
        spark, folder, str(tmp_path / "b"), "2024-01", "2024-02", NOW, ["Detail", "CategoryDetail"], store=store
    )
    for name, path in plain.items():
        rows = sorted(map(str, spark.read.parquet(path).collect()))
        assert rows and rows == sorted(map(str, spark.read.parquet(pruned[name]).collect()))
    plain = programs.usage_report(spark, folder, str(tmp_path / "a"), "2024-01", "2024-02", NOW, ["VirtualServerSummary"])
    pruned = programs.usage_report(spark, folder, str(tmp_path / "b"), "2024-01", "2024-02", NOW, ["VirtualServerSummary"], store=store)
    rows = [sorted(map(str, spark.read.parquet(p["VirtualServerSummary"]).collect())) for p in (plain, pruned)]
    assert rows[0] == rows[1]
    for entity, column in (("invoice_items", "billing_cycle"), ("instance_usage", "month")):
        plan = store_module.read_months(spark, store, entity, "2024-01", "2024-01")._jdf.queryExecution().executedPlan().toString()
        assert f"PartitionFilters: [isnotnull({column}" in plan


def test_usage_programs(spark, land, tmp_path):
    folder = land("instance_usage", USAGE)
    land("resources", RESOURCES)
    land("virtual_servers", SERVERS)
    land("bare_metal_servers", METAL)
    for entity in ("tags", "cloud_users", "user_roles", "images"):  # others were never landed
        land(entity, [])
    output = str(tmp_path / "out")
    paths = programs.usage_report(spark, folder, output, "2024-01", "2024-02", NOW)
    assert set(paths) >= {"Instances_Detail", "VirtualServerSummary", "Users"}
    servers = spark.read.parquet(f"{output}/VirtualServerSummary").filter("is_total").first()
    assert servers["instance_count_Total"] == 2
    programs.invoice_usage(spark, folder, output, "2024-03", "2024-04", NOW, ["VPC_Servers"])
    totals = spark.read.parquet(f"{output}/VPC_Servers").filter("is_total").collect()
    assert {r.month: r.cost for r in totals} == {"2024-01": 6.5, "2024-02": 1.5}


def test_inventory_programs(spark, land, tmp_path):
    folder = land("hardware", [BARE])
    land("hardware", [FULL, BARE], page=2)
    land("trunks", TRUNKS)
    land("allowed_storage", [storage_record("a1", 1)])
    output = str(tmp_path / "out")
    programs.hardware_inventory(spark, folder, output, NOW, ["HW_Detail", "ServerByOSPivot", "ServerReport"])
    assert spark.read.parquet(f"{output}/HW_Detail").count() == 2
    report = [line for f in sorted(tmp_path.glob("out/ServerReport/*/part-*.txt")) for line in f.read_text().splitlines()]
    assert report.index("Hostname        : a.x.com") < report.index("Hostname        : b.x.com")
    assert sum(line.startswith("NAS ") for line in report) == 1
    accounts = tmp_path / "accounts.txt"
    accounts.write_text("a1\na2\n")
    programs.account_storage(spark, folder, str(accounts), output, NOW)
    stored = {r.accountId: r for r in spark.read.json(f"{output}/HardwareStorage").collect()}
    assert stored["a1"].hardwareId == 1 and stored["a2"].hardwareId is None
    assert spark.read.json(f"{output}/AccountSummary").first().total == 2


def kept_files(folder):
    return sorted(p.name for p in folder.rglob("*") if p.is_file()) if folder.exists() else []


def report_rows(spark, paths):
    return {name: sorted(map(str, spark.read.parquet(path).collect())) for name, path in paths.items()}


def test_reports_from_a_saved_run(spark, land, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "work_folder", lambda _: str(tmp_path / "work"))
    folder = land("invoices", INVOICES)
    land("invoice_items", ITEMS)
    land("account", [{"id": 1, "companyName": "co"}])
    land("instance_usage", USAGE)
    land("resources", RESOURCES)
    land("hardware", [BARE, FULL])
    out, keep, nowhere = str(tmp_path / "out"), str(tmp_path / "keep"), str(tmp_path / "nowhere")
    calls = {
        programs.invoice_analysis: ("2024-01", "2024-02"),
        programs.usage_report: ("2024-01", "2024-02"),
        programs.invoice_usage: ("2024-03", "2024-04"),
    }
    for program, months in calls.items():
        first = program(spark, folder, out, *months, NOW, keep=f"{keep}/{program.__name__}")
        (saved,) = runs.saved_runs(spark, f"{keep}/{program.__name__}")
        second = program(spark, nowhere, out, None, None, NOW, saved=saved)
        assert first.keys() == second.keys() and len(first) >= 3
        assert report_rows(spark, first) == report_rows(spark, second)
    names = ["HW_Detail", "ProcessorPivot"]
    first = programs.hardware_inventory(spark, folder, out, NOW, names, keep=f"{keep}/hardware")
    (saved,) = runs.saved_runs(spark, f"{keep}/hardware")
    assert report_rows(spark, first) == report_rows(
        spark, programs.hardware_inventory(spark, nowhere, out, NOW, names, saved=saved)
    )
    assert kept_files(tmp_path / "work") == []
    with pytest.raises(runs.NoSavedRun, match="not of usage_report"):
        programs.usage_report(spark, nowhere, out, None, None, NOW, saved=saved)
    with pytest.raises(runs.NoSavedRun, match="no manifest"):
        programs.usage_report(spark, nowhere, out, None, None, NOW, saved=out)
    rows = spark.read.parquet(f"{saved}/hardware")
    rows.limit(1).write.mode("append").parquet(f"{saved}/hardware")
    with pytest.raises(runs.NoSavedRun, match="3 rows, not 2"):
        programs.hardware_inventory(spark, nowhere, out, NOW, names, saved=saved)


def test_nothing_is_left_of_a_run_and_other_runs_are_untouched(spark, land, tmp_path, monkeypatch):
    work = tmp_path / "work"
    monkeypatch.setattr(runs, "work_folder", lambda _: str(work))
    folder = land("invoices", INVOICES)
    land("invoice_items", ITEMS)
    with runs.leased(spark, "other") as other:
        spark.range(3).write.parquet(f"{other}/table")
        before = kept_files(work)
        programs.invoice_analysis(spark, folder, str(tmp_path / "out"), "2024-01", "2024-02", NOW, ["Detail"])
        with pytest.raises(ValueError, match="unknown"):
            programs.invoice_analysis(spark, folder, str(tmp_path / "out"), "2024-01", "2024-02", NOW, ["Nothing"])
        assert kept_files(work) == before
    assert kept_files(work) == []


def test_sweep(spark, tmp_path, monkeypatch):
    work = tmp_path / "work"
    monkeypatch.setattr(runs, "work_folder", lambda _: str(work))
    root = work / "cloudtally"
    for name in ("alive", "dead", "unknown"):
        spark.range(3).write.parquet(str(root / name / "table"))
    runs.renew(spark, str(root / "alive"))
    plain = runs._clock
    monkeypatch.setattr(runs, "_clock", lambda: plain() - 2 * runs.LEASE)
    runs.renew(spark, str(root / "dead"))
    monkeypatch.setattr(runs, "_clock", plain)
    assert runs.sweep(spark) == ["dead"]
    assert sorted(p.name for p in root.iterdir()) == ["alive", "unknown"]


def test_store_with_dimensions_and_rejects(spark, land, tmp_path):
    folder, store = land("instance_usage", USAGE), str(tmp_path / "store")
    land("resources", RESOURCES)
    land("virtual_servers", SERVERS)
    land("bare_metal_servers", METAL)
    (tmp_path / "landing" / "instance_usage" / "torn.json").write_text('{"month": "2024-01", "usa')
    found = programs.compact_landing(spark, folder, store, max_rejects=1, dimensions=True)
    assert found["instance_usage"].rejects == 1 and found["resources"].pages == 1
    (tmp_path / "landing" / "instance_usage" / "torn.json").unlink()
    names = ["Instances_Detail", "VirtualServerSummary", "BMServerSummary"]
    plain = programs.usage_report(spark, folder, str(tmp_path / "a"), "2024-01", "2024-02", NOW, names)
    stored = programs.usage_report(spark, folder, str(tmp_path / "b"), "2024-01", "2024-02", NOW, names, store=store)
    assert report_rows(spark, plain) == report_rows(spark, stored)
    info = spark.read.json(str(tmp_path / "b" / "RunInfo")).first()
    assert info.rejected.instance_usage == 1 and info.rejected.account_usage == 0


def test_programs_demand_ansi_mode(spark, land, tmp_path):
    folder = land("invoices", INVOICES)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            programs.invoice_analysis(spark, folder, str(tmp_path / "out"), "2024-01", "2024-02", NOW, ["Detail"])
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
