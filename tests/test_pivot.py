import random
from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cloudtally.operators.pivot import Measure, ordered, pivot_report, totals_within

MONTHS = ["2024-01", "2024-02", "2024-03"]
SCHEMA = "a string, b string, month string, id string, amount decimal(18,6)"
MEASURES = [Measure("amount"), Measure("ids", "distinct", "id"), Measure("qty", "rows")]


def sample(seed, size=200):
    pick = random.Random(seed)
    return [
        (pick.choice(["x", "y", ""]), pick.choice(["p", "q"]), pick.choice(MONTHS), f"i{pick.randrange(12)}",
         pick.randrange(1000))
        for _ in range(size)
    ]


def frame(spark, data):
    plain = spark.createDataFrame(data, SCHEMA.replace("decimal(18,6)", "long"))
    return plain.withColumn("amount", (F.col("amount") / 100).cast("decimal(18,6)"))


@pytest.mark.parametrize("seed", range(3))
def test_same_as_pandas(spark, seed):
    data = sample(seed)
    found = pivot_report(frame(spark, data), ["a", "b"], MEASURES, "month", MONTHS).toPandas()
    found = found.set_index(["a", "b"])
    pdf = pd.DataFrame(data, columns=["a", "b", "month", "id", "amount"])
    pdf["amount"] /= 100
    expected = pd.pivot_table(
        pdf.assign(qty=1), index=["a", "b"], columns=["month"], values=["amount", "id", "qty"],
        aggfunc={"amount": "sum", "id": "nunique", "qty": "sum"}, margins=True, margins_name="Total", fill_value=0,
    )
    assert set(found.index) == set(expected.index)
    names = {"amount": "amount", "id": "ids", "qty": "qty"}
    for (measure, month), column in expected.items():
        for key, value in column.items():
            assert found.loc[key, f"{names[measure]}_{month}"] == pytest.approx(value)
    assert list(found[found.is_total].index) == [("Total", "")]


def test_distinct_total_counts_an_id_once(spark):
    data = [("x", "p", "2024-01", "i", 1), ("x", "p", "2024-02", "i", 1), ("y", "p", "2024-01", "i", 1)]
    rows = {r.a: r for r in pivot_report(frame(spark, data), ["a", "b"], MEASURES[1:2], "month", MONTHS).collect()}
    assert (rows["x"]["ids_2024-01"], rows["x"]["ids_2024-02"], rows["x"]["ids_Total"]) == (1, 1, 1)
    assert (rows["Total"]["ids_2024-01"], rows["Total"]["ids_Total"]) == (1, 1)


def test_null_keys_vanish_and_blank_keys_stay(spark):
    data = [(None, "p", "2024-01", "i", 500), ("", "p", "2024-01", "i", 100), ("x", None, "2024-01", "j", 100)]
    rows = pivot_report(frame(spark, data), ["a", "b"], [Measure("amount")], "month", MONTHS).collect()
    assert sorted((r.a, r.amount_Total) for r in rows) == [("", 1.0), ("Total", 1.0)]


def test_months_outside_the_report_are_left_out(spark):
    data = [("x", "p", "2023-12", "i", 500), ("x", "p", "2024-01", "i", 100)]
    rows = pivot_report(frame(spark, data), ["a"], [Measure("amount")], "month", MONTHS).collect()
    assert {r.a: r.amount_Total for r in rows} == {"x": 1.0, "Total": 1.0}


def test_empty_input(spark):
    empty = frame(spark, sample(1)).filter("a = 'none'")
    for month in (None, "month"):
        for measures in (MEASURES[:1], MEASURES):
            found = pivot_report(empty, ["a", "b"], measures, month, MONTHS)
            assert found.collect() == []
            kept = pivot_report(empty, ["a", "b"], measures, month, MONTHS, "Count", total_of_nothing=True).collect()
            assert [(r.a, r.b, r.is_total) for r in kept] == [("Count", "", True)]
            assert all(v == 0 for k, v in kept[0].asDict().items() if k not in ("a", "b", "is_total"))


def test_without_fill_only_groups_without_rows_are_empty(spark):
    data = spark.createDataFrame([("x", "2024-01", None), ("x", "2024-02", 2.0)], "a string, month string, usage double")
    found = pivot_report(data, ["a"], [Measure("usage")], "month", MONTHS, total=None, fill=False).first()
    assert tuple(found) == ("x", 0.0, 2.0, None)


def test_number_keys_and_order(spark):
    data = spark.createDataFrame([(10, 1.5, 1), (9, 2.5, 1)], "n long, size double, v long")
    found = ordered(pivot_report(data, ["n", "size"], [Measure("v")]), ["n", "size"], numeric=["n"]).collect()
    assert [(r.n, r["size"], r.v) for r in found] == [("9", 2.5, 1), ("10", 1.5, 1), ("Total", None, 2)]


def test_totals_within(spark):
    data = sample(5)
    found = totals_within(frame(spark, data), "month", ["a", "b"], ["amount"], "All").collect()
    expected = defaultdict(int)
    for a, b, month, _, amount in data:
        expected[month, a, b] += amount
        expected[month, "All", ""] += amount
    assert {(r.month, r.a, r.b): round(r.amount * 100) for r in found} == dict(expected)


def test_one_read_of_the_rows(spark, tmp_path):
    """Body and totals share one scan; the first shuffle comes after a partial aggregate."""
    frame(spark, sample(2)).write.parquet(str(tmp_path / "t"))
    plan = pivot_report(spark.read.parquet(str(tmp_path / "t")), ["a"], MEASURES, "month", MONTHS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1
    assert "PushedFilters: [IsNotNull(a), " in text


def test_totals_take_one_shuffle(spark, tmp_path):
    frame(spark, sample(3)).write.parquet(str(tmp_path / "t"))
    report = totals_within(spark.read.parquet(str(tmp_path / "t")), "month", ["a", "b"], ["amount"])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("FileScan"), plan.count("Exchange")) == (1, 1)
