import pytest
from pyspark.sql import functions as F

from cloudtally.operators.lookup import SPREAD_SETTING, first_by_key, latest_by_key, lookup_join


@pytest.fixture
def no_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n, None) for n in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def data(spark):
    """A third of the rows have one key, many have none, some have a key that is not known."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50))
    return spark.range(3000).select("id", key.alias("key"))


def dimension(spark):
    return spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(40)], "name string, value int")


def expected(how):
    out = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{i % 50}" if i % 3 == 1 else None
        value = 1 if key == "hot" else i % 50 if key and i % 50 < 40 else None
        if how == "left" or value is not None:
            out.append((i, key, value))
    return sorted(out)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("spread", [None, ["id"]])
def test_small_dimension(spark, how, spread):
    found = lookup_join(data(spark), dimension(spark), "key", "name", {"value": "v"}, spread, how)
    assert sorted(map(tuple, found.collect())) == expected(how)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_large_dimension_spreads_a_hot_key(spark, no_broadcast, how):
    spark.conf.set(SPREAD_SETTING, "5")
    try:
        found = lookup_join(data(spark), dimension(spark), "key", "name", {"value": "v"}, ["id"], how)
    finally:
        spark.conf.unset(SPREAD_SETTING)
    assert sorted(map(tuple, found.collect())) == expected(how)
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_large_dimension_without_copies(spark, no_broadcast):
    found = lookup_join(data(spark), dimension(spark), "key", "name", {"value": "v"}, ["id"])
    assert sorted(map(tuple, found.collect())) == expected("left")
    assert "_copy" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_one_row_per_key(spark):
    rows = [("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only"), (None, 1, "none")]
    df = spark.createDataFrame(rows, "key string, seq int, value string")
    assert sorted(map(tuple, latest_by_key(df, ["key"], ["seq"]).collect())) == [("a", 2, "new"), ("b", 1, "only")]
    assert sorted(map(tuple, first_by_key(df, ["key"], ["seq"]).collect())) == [("a", 1, "old"), ("b", 1, "only")]


def test_keys_of_the_last_rows_are_never_sent_to_the_driver(spark):
    """The table is far below the broadcast limit."""
    rows = spark.range(1000).selectExpr("concat('k', id % 300) AS key", "id AS place", "id * 2 AS value")
    found = latest_by_key(rows, ["key"], ["place"])
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "Broadcast" not in plan
    last = {f"k{i % 300}": (f"k{i % 300}", i, i * 2) for i in range(1000)}
    assert sorted(map(tuple, found.collect())) == sorted(last.values())


def test_hashed_dimension_is_shuffled_at_any_size(spark):
    found = lookup_join(data(spark), dimension(spark), "key", "name", {"value": "v"}, hashed=True)
    assert "ShuffledHashJoin" in found._jdf.queryExecution().sparkPlan().toString()
    assert sorted(map(tuple, found.collect())) == expected("left")


def test_groups_by_the_dimensions_key_need_no_further_shuffle(spark):
    rows = spark.createDataFrame([(i % 7, i) for i in range(50)], "ref long, n long")
    names = spark.createDataFrame([(i, f"d{i}") for i in range(5)], "id long, name string")
    found = lookup_join(rows, names, "ref", "id", ["id", "name"], how="inner", hashed=True).groupBy("id", "name", "n").count()
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    assert sorted(tuple(r) for r in found.collect()) == sorted((i % 7, f"d{i % 7}", i, 1) for i in range(50) if i % 7 < 5)
