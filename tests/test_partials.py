import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from test_invoice_pipeline import INVOICES, ITEMS

from cloudtally import programs
from cloudtally.operators import partials
from cloudtally.operators.partials import Pivot
from cloudtally.operators.pivot import Measure

NOW = dt.datetime(2024, 3, 1, 12, 5)
MONTHS = ["2024-01", "2024-02", "2024-03"]
COUNTS = Pivot(
    "Counts", lambda rows: rows, ["place", "kind"],
    [Measure("instances", "distinct", "instance"), Measure("lines", "rows"), Measure("cost")], "month",
)
SHEET = Pivot("Sheet", lambda rows: rows, ["place", "kind"], [Measure("cost")], "month", within=True, empty_months=True)


def lines(spark, seed, months=MONTHS, rows=400):
    rng = random.Random(seed)
    values = [
        (rng.choice(months), rng.choice(["a", "b", "", None]), rng.choice([1, 2, None]),
         rng.choice([None] + [f"i{n}" for n in range(90)]), rng.choice([None, 1, 25, -3]))
        for _ in range(rows)
    ]
    df = spark.createDataFrame(values, "month string, place string, kind int, instance string, cost int")
    return df.withColumn("cost", (F.col("cost") / 100).cast("decimal(28,10)"))


def rows_of(report):
    return sorted(map(str, report.collect()))


@pytest.mark.parametrize("pivot", [COUNTS, SHEET], ids=["counts", "sheet"])
def test_merged_months_equal_the_report_of_all_lines(spark, tmp_path, pivot):
    folder, whole = str(tmp_path), lines(spark, 1)
    for months in (["2024-02"], ["2024-03", "2024-01"]):
        partials.add_months(pivot, whole.filter(F.col("month").isin(months)), months, folder)
    for months in (MONTHS, ["2024-03"], ["2024-01", "2024-02"]):
        merged = partials.merged_report(spark, pivot, months, folder)
        assert rows_of(merged) == rows_of(pivot.report(whole, months))
        assert merged.columns == pivot.report(whole, months).columns


def test_months_reduced_at_once_are_kept_in_rounds(spark, tmp_path):
    whole = lines(spark, 1)
    rows = SHEET.reduced(whole, MONTHS)
    for months in (["2024-02"], ["2024-03", "2024-01"]):
        partials.add_months(SHEET, rows, months, str(tmp_path), reduced=True)
    assert rows_of(partials.merged_report(spark, SHEET, MONTHS, str(tmp_path))) == rows_of(SHEET.report(whole, MONTHS))
    with pytest.raises(ValueError, match="distinct"):
        COUNTS.reduced(whole, MONTHS)


def test_a_merged_sheet_shuffles_its_totals_alone(spark, tmp_path):
    partials.add_months(SHEET, lines(spark, 1), MONTHS, str(tmp_path))
    plan = partials.merged_report(spark, SHEET, MONTHS, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert len(shuffled) == 1 and "place" not in shuffled[0]


def test_a_month_built_again_replaces_its_partials(spark, tmp_path):
    folder, first, second = str(tmp_path), lines(spark, 1), lines(spark, 2, rows=90)
    partials.add_months(COUNTS, first, MONTHS, folder)
    partials.add_months(COUNTS, second.filter("month = '2024-02'"), ["2024-02"], folder)
    now = first.filter("month <> '2024-02'").unionAll(second.filter("month = '2024-02'"))
    assert rows_of(partials.merged_report(spark, COUNTS, MONTHS, folder)) == rows_of(COUNTS.report(now, MONTHS))


def test_months_without_lines(spark, tmp_path):
    folder, whole = str(tmp_path), lines(spark, 3, ["2024-01"])
    partials.add_months(COUNTS, whole, MONTHS, folder)
    partials.add_months(SHEET, whole, MONTHS, folder)
    for pivot in (COUNTS, SHEET):
        assert rows_of(partials.merged_report(spark, pivot, MONTHS, folder)) == rows_of(pivot.report(whole, MONTHS))
    partials.add_months(COUNTS, whole.limit(0), ["2024-01"], folder)
    assert rows_of(partials.merged_report(spark, COUNTS, MONTHS, folder)) == rows_of(COUNTS.report(whole.limit(0), MONTHS))


def test_unknown_months(spark, tmp_path, monkeypatch):
    folder, whole = str(tmp_path), lines(spark, 1)
    partials.add_months(COUNTS, whole, MONTHS[:2], folder)
    with pytest.raises(ValueError, match="no partials of Counts for 2024-03"):
        partials.merged_report(spark, COUNTS, MONTHS, folder)
    monkeypatch.setattr(partials, "reduced_rows", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        partials.add_months(COUNTS, whole, MONTHS[1:2], folder)
    assert partials.kept_months(spark, COUNTS, folder) == MONTHS[:2]


def test_codes_are_dense_and_stay(spark, tmp_path):
    folder = str(tmp_path / "codes")
    first = spark.range(1000).selectExpr("concat('v', id % 300) as v").repartition(5)
    before = {r.value: r.code for r in partials.dictionary(first, "v", folder).collect()}
    assert sorted(before.values()) == list(range(1, 301))
    more = spark.range(400).selectExpr("concat('v', id) as v").unionAll(spark.createDataFrame([(None,)], "v string"))
    after = {r.value: r.code for r in partials.dictionary(more, "v", folder).collect()}
    assert sorted(after.values()) == list(range(1, 401)) and all(after[v] == c for v, c in before.items())


def test_distinct_counts_over_many_buckets(spark, tmp_path):
    """More values than a bitmap has bits; no value is exploded for a total."""
    whole = spark.range(70_000).selectExpr(
        "'2024-01' as month", "concat('p', id % 2) as place", "1 as kind", "concat('i', id) as instance",
        "cast(1 as decimal(28,10)) as cost",
    )
    partials.add_months(COUNTS, whole, ["2024-01"], str(tmp_path))
    kept = spark.read.parquet(str(tmp_path / "Counts"))
    assert kept.count() == 6
    merged = partials.merged_report(spark, COUNTS, ["2024-01"], str(tmp_path)).filter("is_total").first()
    assert merged["instances_Total"] == merged["instances_2024-01"] == merged["lines_Total"] == 70_000


def test_summaries_read_new_months_alone(spark, land, tmp_path, monkeypatch):
    folder = land("invoices", INVOICES)
    land("invoice_items", ITEMS)
    asked, plain = [], programs.invoice_lines

    def lines_of(invoices, items, volumes, start, end):
        asked.append((start, end))
        return plain(invoices, items, volumes, start, end)

    monkeypatch.setattr(programs, "invoice_lines", lines_of)
    kept, out = str(tmp_path / "partials"), str(tmp_path / "out")
    first = programs.invoice_summaries(spark, folder, out, "2024-01", "2024-01", NOW, kept)
    second = programs.invoice_summaries(spark, folder, out, "2024-01", "2024-02", NOW, kept)
    third = programs.invoice_summaries(spark, folder, out, "2024-01", "2024-02", NOW, kept, refresh=["2024-02"])
    assert asked == [("2024-01", "2024-01"), ("2024-02", "2024-02"), ("2024-02", "2024-02")]
    monkeypatch.setattr(programs, "invoice_lines", plain)
    whole = programs.invoice_analysis(spark, folder, out, "2024-01", "2024-02", NOW, list(second))
    assert len(whole) == 11 and first.keys() == second.keys()
    filled = 0
    for name, path in whole.items():
        expected = rows_of(spark.read.parquet(path))
        filled += bool(expected)
        assert rows_of(spark.read.parquet(second[name])) == expected
        assert rows_of(spark.read.parquet(third[name])) == expected
    assert filled > 5
    with pytest.raises(ValueError, match="unknown reports: Detail"):
        programs.invoice_summaries(spark, folder, out, "2024-01", "2024-01", NOW, kept, ["Detail"])


def test_rounds_of_a_merged_query_work_their_rows_out_once(spark):
    from checks.partial_checks import _merged

    calls = []
    pivot = Pivot("Once", lambda lines: calls.append(1) or lines.filter("n > 0"), ["k"], [Measure("n")], "month")
    lines = spark.createDataFrame([("a", 1, "2024-01"), ("a", 2, "2024-02"), ("b", 0, "2024-02")], "k string, n int, month string")
    months = ["2024-01", "2024-02"]
    found = _merged(spark, pivot, lines, months)
    assert len(calls) == 1
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, pivot.report(lines, months).collect()))
