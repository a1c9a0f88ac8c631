"""A query of each kind against its SQL on the smallest tables (``compare.py`` runs all of them)."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from checks import page_checks, tables
from compare import TABLES, compare

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = [
    "invoice_detail", "category_detail", "object_storage_detail", "top_sheet_iaas", "storage_pivot", "invoice_window",
    "pivot_multi_measure", "metric_plan_summary", "instances_detail", "volumes_summary", "charges_by_volume_month",
    "hardware_detail", "servers_by_trunked_vlan", "hardware_storage_nested", "plain_notes",
]

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_same_rows_as_sql(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name).startswith("same ")


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.ORACLES)


def test_part_lookup_neither_sorts_lines_nor_sends_the_list_to_the_driver(spark, connection):
    """Its part list grows with the lines, which share a few parts."""
    found = entry.QUERIES["part_description_lookup"](spark, SF_DIR)
    joins = [line for line in found._jdf.queryExecution().sparkPlan().toString().splitlines() if "LeftOuter" in line]
    assert joins and all("ShuffledHashJoin" in join for join in joins)
    assert compare(spark, connection, SF_DIR, "part_description_lookup").startswith("same ")


def test_entry(spark):
    assert entry.entry(spark).filter("is_total").count() == 1


def test_pages_are_compressed_and_dealt_as_the_documents_are(spark, tmp_path):
    documents = spark.range(0, 4000, 1, 6).selectExpr("id", "repeat('text ', 50) AS text")
    page_checks._land(spark, documents, str(tmp_path / "landing"), "page", grows=True)
    pages = sorted(p.name for p in (tmp_path / "landing").iterdir() if p.suffix != ".crc")
    assert pages == [f"page-{i:04}.json.gz" for i in range(6)]
    assert sum((tmp_path / "landing" / p).stat().st_size for p in pages) < 4000 * 50
    read = spark.read.schema("id long, text string").json(str(tmp_path / "landing"))
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, documents.collect()))


def test_tables_that_are_dealt_out_are_not_shuffled(spark):
    def shuffled(splits):
        dealt = tables.fill_cores(spark.range(0, 4000, 1, splits))
        assert dealt.count() == 4000
        return "Repartition" in dealt._jdf.queryExecution().optimizedPlan().toString()

    assert shuffled(1) and not shuffled(4) and not shuffled(9)
