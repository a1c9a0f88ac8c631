import pytest
from pyspark.sql import functions as F

from cloudtally.functions import text


@pytest.mark.parametrize(
    ("group", "words", "description", "usage"),
    [
        ("StorageLayer", "X: 12.5 GB", "X", 12.5),
        ("StorageLayer", "X: 12,5 GB", "X", 12.5),
        ("StorageLayer", "X: 12 GB", "X", None),
        ("StorageLayer", "API Requests: 300 calls", "API Requests", 300.0),
        ("StorageLayer", "Snapshot Space: 20 GB", "Snapshot Space", 20.0),
        ("StorageLayer", "Replication for tier: y", "Replication for tier", 0.0),
        ("StorageLayer", "No mark", "No mark", None),
        ("StorageLayer", "API Requests: none", "API Requests", None),
        ("PaaS", "Name - $0.05 USD per hour", "Name ", 0.05),
        ("PaaS", "Name - $ 12.5 Usage", "Name ", 12.5),
        ("PaaS", "Name: 12.5 GB", "Name: 12.5 GB", None),
        ("PaaS", "Name - $free of charge", "Name ", None),
        (None, "plain", "plain", None),
    ],
)
def test_parsed_usage(spark, group, words, description, usage):
    parsed = text.parsed_usage(F.lit(group).cast("string"), F.lit(words))
    assert tuple(spark.range(1).select(parsed.alias("p")).select("p.*").first()) == (description, usage)


def test_decoded_notes(evaluate):
    notes = [("a%20b+c",), ("100%",), ("%zz%41",), (None,), ("%C3%A9",)]
    assert evaluate("n string", notes, text.decoded_notes(F.col("n"))) == ["a b+c", "100%", "%zzA", "", "é"]


def test_plain_notes(evaluate):
    notes = [
        ("# Title\n* **bold** and *slanted*\n> quoted `code`",),
        ("[docs](http://x) ![logo](y.png) snake_case_name _word_.",),
        ("5 * 3 * 2",),
    ]
    assert evaluate("n string", notes, text.plain_notes(F.col("n"))) == [
        "Title\nbold and slanted\nquoted code", "docs logo snake_case_name word.", "5 * 3 * 2",
    ]


def test_cells_and_names(evaluate):
    assert evaluate("c string", [("abc",), ("a",), (None,)], text.fixed_width(F.col("c"), 2)) == ["ab", "a ", "  "]
    lines = [(" a , b",), ("x",), (" y ",)]
    assert evaluate("c string", lines, text.first_csv_column(F.col("c"))) == ["a", "x", "y"]
    names = [("c1_w_2",), ("alone",)]
    assert evaluate("c string", names, text.name_before(F.col("c"), "_")) == ["c1", "alone"]
    assert evaluate("c string", names, text.name_after(F.col("c"), "_")) == ["w_2", "alone"]
    assert evaluate("c string", [("us-south-1",), ("zone",)], text.region_of_zone(F.col("c"))) == ["us-south", "zone"]
