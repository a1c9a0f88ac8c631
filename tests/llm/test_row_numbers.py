"""Rows keep their identity when the number of cores, and so the packing of splits, changes between two reads."""

import random

import pytest

from cloudtally.llm import common, graph, hidden_markov, line_runs, pfair_mix, simhash_links, suffix_dedup

SETTING = "spark.sql.leafNodeDefaultParallelism"
MODULES = [line_runs, pfair_mix, simhash_links, suffix_dedup, graph, hidden_markov, common]


@pytest.fixture
def table(spark, tmp_path):
    """Twelve files with copies, near copies and ids that repeat or are missing."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(500)]
    lines = [" ".join(rng.choices(words, k=12)) for _ in range(60)]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(3, 9))) for _ in range(150)]
    texts += texts[:40] + [t + " more" for t in texts[40:60]] + [None, ""]
    rows = [(None if i % 50 == 0 else i % 180, t, f"s{i % 3}") for i, t in enumerate(texts)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(12).write.parquet(path)
    return path


@pytest.fixture
def cores(spark, monkeypatch):
    """Returns a switch: with it on, each written table is followed by reads for another number of cores."""
    plain, numbers = common.written, []

    def changing(*args, **options):
        out = plain(*args, **options)
        numbers.append(6 if len(numbers) % 2 == 0 else 2)
        spark.conf.set(SETTING, str(numbers[-1]))
        return out

    def switch(on):
        numbers.clear()
        spark.conf.set(SETTING, "2")
        for module in MODULES:
            if hasattr(module, "written"):
                monkeypatch.setattr(module, "written", changing if on else plain)

    yield switch
    spark.conf.unset(SETTING)


CASES = {
    "lines": lambda docs: line_runs.deduplicated(docs).drop("kept"),
    "bytes": lambda docs: suffix_dedup.deduplicated(docs, ["doc_id"]).drop("kept"),
    "one_of_each": simhash_links.one_of_each,
    "mix": pfair_mix.in_mixed_order,
}


@pytest.mark.parametrize("name", CASES)
def test_any_number_of_cores(spark, table, cores, name):
    results = []
    for on in (False, True):
        cores(on)
        results.append(sorted(map(str, CASES[name](spark.read.parquet(table)).collect())))
    assert results[0] == results[1]
    if name == "mix":
        assert results[1] == sorted(map(str, spark.read.parquet(table).collect()))
