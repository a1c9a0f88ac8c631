import json
import random

import pytest
from test_invoice_pipeline import INVOICES, ITEMS
from test_usage_pipeline import USAGE

from cloudtally.operators.lookup import latest_by_key
from cloudtally.sources import landing, store

RESOURCE = {"resource_id": "r", "state": "active"}


def keyed(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))


def files(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


@pytest.fixture
def opened(monkeypatch):
    """The pages that each parse is asked for."""
    asked, plain = [], store._parsed

    def parsed(spark, folder, entity, paths):
        asked.append(sorted(p.rsplit("/", 1)[1] for p in paths))
        return plain(spark, folder, entity, paths)

    monkeypatch.setattr(store, "_parsed", parsed)
    return asked


def test_one_new_page_is_read_alone_and_old_months_stay(spark, land, tmp_path, opened):
    months = [dict(USAGE[0], month=m) for m in ("2024-01", "2024-02", "2024-03")]
    folder, kept = land("instance_usage", months[:2]), str(tmp_path / "store")
    first = store.add_months(spark, folder, kept, "instance_usage")
    assert (first.pages, first.records) == (1, 2)
    before = files(tmp_path / "store" / "instance_usage")
    assert store.add_months(spark, folder, kept, "instance_usage").pages == 0
    land("instance_usage", [months[1], months[2]], page=2)
    assert store.add_months(spark, folder, kept, "instance_usage").records == 2
    assert opened == [["page-0001.json"], ["page-0002.json"]]
    after = files(tmp_path / "store" / "instance_usage")
    assert {f for f in before if "2024-01" in f} == {f for f in after if "2024-01" in f}
    assert all(after[f] == before[f] for f in before if "2024-01" in f)
    assert not any(f in after for f in before if "2024-02" in f)
    rows = store.read_months(spark, kept, "instance_usage", "2024-01", "2024-12")
    whole = landing.read_entity(spark, folder, "instance_usage")
    assert sorted(map(str, rows.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_months_are_put_together_without_a_shuffle(spark, tmp_path):
    rows = spark.range(0, 600, 1, 4).selectExpr("id", "concat('2024-0', 1 + id % 3) as month")
    for name in ("old", "new"):
        rows.write.partitionBy("month").parquet(f"{tmp_path}/{name}")
    old, new = (spark.read.schema(rows.schema).parquet(f"{tmp_path}/{name}") for name in ("old", "new"))
    found = store._month_by_month([(old, lambda own: own.filter("id >= 300")), (new, lambda own: own)], "month")
    assert "Exchange" not in plan(found)
    tasks = found.selectExpr("month", "spark_partition_id() as task").groupBy("task").agg({"month": "collect_set"}).collect()
    assert len(tasks) >= 3 and all(len(r[1]) == 1 for r in tasks)
    assert sorted(map(tuple, found.select(*rows.columns).collect())) == sorted(
        map(tuple, rows.unionAll(rows.filter("id >= 300")).collect())
    )


def test_items_are_hashed_to_their_invoices(spark, land, tmp_path):
    land("invoices", INVOICES)
    kept = str(tmp_path / "store")
    store.add_months(spark, land("invoice_items", ITEMS), kept, "invoices")
    placed = store._by_invoice(spark, kept)(landing.read_entity(spark, land("invoice_items", ITEMS), "invoice_items"))
    assert "ShuffledHashJoin" in plan(placed) and "SortMergeJoin" not in plan(placed)
    known = {i["id"] for i in INVOICES}
    assert {(r.invoiceId in known, r.billing_cycle is not None) for r in placed.collect()} <= {(True, True), (False, False)}


def test_a_page_that_landed_anew_replaces_its_rows(spark, land, tmp_path):
    folder, kept = land("instance_usage", [dict(USAGE[0], month="2024-01")]), str(tmp_path / "store")
    land("instance_usage", [dict(USAGE[0], month="2024-02")], page=2)
    store.add_months(spark, folder, kept, "instance_usage")
    land("instance_usage", [dict(USAGE[0], month="2024-03"), dict(USAGE[0], month="2024-02")], page=1)
    store.add_months(spark, folder, kept, "instance_usage")
    rows = store.read_months(spark, kept, "instance_usage", "2024-01", "2024-12").groupBy("month").count()
    assert sorted(map(tuple, rows.collect())) == [("2024-02", 2), ("2024-03", 1)]


def test_a_run_that_died_is_taken_up(spark, land, tmp_path, monkeypatch):
    folder, kept = land("instance_usage", [dict(USAGE[0], month="2024-01")] * 3), str(tmp_path / "store")
    plain = store._Batch.note

    def dying(self, state, *args):
        if state == "done":
            raise KeyboardInterrupt
        plain(self, state, *args)

    monkeypatch.setattr(store._Batch, "note", dying)
    with pytest.raises(KeyboardInterrupt):
        store.add_months(spark, folder, kept, "instance_usage")
    monkeypatch.setattr(store._Batch, "note", plain)
    assert store.add_months(spark, folder, kept, "instance_usage").records == 3
    assert store.read_months(spark, kept, "instance_usage", "2024-01", "2024-12").count() == 3


def test_items_wait_for_their_invoice(spark, land, tmp_path):
    folder, kept = land("invoice_items", ITEMS), str(tmp_path / "store")
    found = store.compact(spark, folder, kept)
    assert found["invoice_items"].records == 0 and found["invoice_items"].waiting == len(ITEMS)
    land("invoices", INVOICES)
    found = store.compact(spark, folder, kept)
    known = {i["id"] for i in INVOICES}
    expected = sum(i["invoiceId"] in known for i in ITEMS)
    assert found["invoice_items"].records == expected > 0
    assert store.read_months(spark, kept, "invoice_items", "2000-01", "2100-01").count() == expected


def test_rejects(spark, tmp_path):
    folder, kept = tmp_path / "landing" / "instance_usage", str(tmp_path / "store")
    good = json.dumps(dict(USAGE[0], month="2024-01"))
    keyed(folder, "a.json", [dict(USAGE[0], month="2024-02")])
    (folder / "b.json").write_text(f'{good}\n{{"month": "2024-01", "usage": 7}}\n{good}\n{good[:50]}')
    root = str(tmp_path / "landing")
    with pytest.raises(store.TooManyRejects, match="2 lines of instance_usage"):
        store.add_months(spark, root, kept, "instance_usage")
    assert store.read_months(spark, kept, "instance_usage", "2024-01", "2024-12").count() == 0
    found = store.add_months(spark, root, kept, "instance_usage", max_rejects=2)
    assert (found.pages, found.records, found.rejects) == (2, 3, 2)
    lines = store.rejects(spark, kept, "instance_usage").collect()
    assert {r.line for r in lines} == {'{"month": "2024-01", "usage": 7}', good[:50]}
    assert all(r.load_file.endswith("b.json") and r.load_offset == 0 for r in lines)
    per_page = store.ledger(spark, kept, "instance_usage").select("page", "records", "rejects").collect()
    assert sorted((r.page[-6:], r.records, r.rejects) for r in per_page) == [("a.json", 1, 0), ("b.json", 2, 2)]
    (folder / "b.json").write_text(f"{good}\n{good}\n{good}\n{good}\n")
    assert store.add_months(spark, root, kept, "instance_usage").records == 4
    assert store.rejects(spark, kept, "instance_usage").count() == 0
    assert store.read_months(spark, kept, "instance_usage", "2024-01", "2024-12").count() == 5


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_dimension_equals_full_reduction(spark, tmp_path, seed):
    rng = random.Random(seed)
    folder, kept = tmp_path / "landing" / "resources", str(tmp_path / "store")
    root = str(tmp_path / "landing")
    pages = [
        [RESOURCE | {"crn": f"c{rng.randrange(12)}", "created_by": f"{page}-{i}"} for i in range(rng.randrange(9))]
        for page in range(6)
    ]
    pages[2] += [{"crn": None, "state": "none"}]
    order = rng.sample(range(6), 6)
    for some in (order[:2], order[2:3], order[3:]):
        for page in some:
            keyed(folder, f"page-{page}.json", pages[page])
        store.merge_dimension(spark, root, kept, "resources")
    ranked = landing.read_in_load_order(spark, root, "resources")
    whole = latest_by_key(ranked, ["crn"], landing.LOAD_ORDER).drop(*landing.LOAD_ORDER)
    merged = store.read_dimension(spark, kept, "resources")
    expected = sorted(map(str, whole.select(*merged.columns).collect()))
    assert sorted(map(str, merged.collect())) == expected
    assert sorted(map(str, landing.read_latest(spark, root, "resources", "crn").select(*merged.columns).collect())) == expected
    assert len([p for p in (tmp_path / "store" / "resources").iterdir() if p.name.startswith("version=")]) <= 2


def test_records_stay_and_a_changed_page_counts_anew(spark, tmp_path, opened):
    folder, kept, root = tmp_path / "landing" / "workers", str(tmp_path / "store"), str(tmp_path / "landing")
    keyed(folder, "p1.json", [{"id": "w1", "flavor": "old"}, {"id": "w2", "flavor": "gone"}])
    keyed(folder, "p2.json", [{"id": "w1", "flavor": "new"}])
    store.merge_dimension(spark, root, kept, "workers")
    keyed(folder, "p3.json", [{"id": "w3", "flavor": "x"}])
    store.merge_dimension(spark, root, kept, "workers")
    assert opened[-1] == ["p3.json"]
    rows = {r.id: r.flavor for r in store.read_dimension(spark, kept, "workers").collect()}
    assert rows == {"w1": "new", "w2": "gone", "w3": "x"}
    keyed(folder, "p2.json", [{"id": "w2", "flavor": "back again"}])
    store.merge_dimension(spark, root, kept, "workers")
    rows = {r.id: r.flavor for r in store.read_dimension(spark, kept, "workers").collect()}
    assert rows == {"w1": "old", "w2": "back again", "w3": "x"}


def test_nothing_landed(spark, tmp_path):
    folder, kept = str(tmp_path / "landing"), str(tmp_path / "store")
    assert all(c.pages == 0 for c in store.compact(spark, folder, kept, dimensions=True).values())
    assert store.read_dimension(spark, kept, "resources").collect() == []
    assert store.read_months(spark, kept, "invoices", "2024-01", "2024-02").collect() == []


def test_last_rows_are_found_without_a_sort_before_the_shuffle(spark, tmp_path):
    rows = spark.range(2000).selectExpr("concat('k', id % 70) as key", "id as place", "repeat('x', 20) as value")
    rows.write.parquet(str(tmp_path / "rows"))
    found = latest_by_key(spark.read.parquet(str(tmp_path / "rows")), ["key"], ["place"])
    assert {(r.key, r.place) for r in found.collect()} == {(f"k{i % 70}", i) for i in range(1930, 2000)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_records_are_not_sent_to_the_driver_for_their_order(spark, land):
    """The names of the files are broadcast, the records stay where they are."""
    folder = land("images", [{"id": "a"}, {"id": "b"}])
    land("images", [{"id": "a"}], page=2)
    placed = landing.with_load_place(landing.read_in_load_order(spark, folder, "images"))
    plan = placed._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan
    assert [int(r.load_place) // 10**24 for r in placed.orderBy("load_place").collect()] == [0, 0, 1]
