import time
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from cloudtally.llm import pfair_mix


def edf(weights, slots):
    """Slot by slot, with exact weights (fractions that add up to one)."""
    done, out = [0] * len(weights), []
    for slot in range(slots):
        ready = [i for i, w in enumerate(weights) if w and done[i] // w <= slot]
        pick = min(ready, key=lambda i: (-(-(done[i] + 1) // weights[i]), i))
        done[pick] += 1
        out.append(pick)
    return out


def scheduled(spark, weights, blocks=10**6, period=pfair_mix.PERIOD):
    counts = spark.createDataFrame([("1" + k, blocks * pfair_mix.BLOCK_DOCS) for k in weights], "key string, n long")
    row = pfair_mix.shares(counts, weights, period=period)
    return row.first(), pfair_mix.schedule(row).orderBy("slot").collect()


def skewed(n):
    return {f"s{i:03}": w for i, w in enumerate([0.5] + [0.5 / (n - 1)] * (n - 1))}


@pytest.mark.parametrize("weights", [{"a": 0.9, "b": 0.1}, {"a": 0.334} | {f"s{i}": 0.666 / 19 for i in range(19)}, skewed(200)])
def test_less_than_one_block_off_the_target_weight(spark, weights):
    """At each of 10,000 slots."""
    row, rows = scheduled(spark, weights)
    assert row.slots == len(rows) == 10_000
    total, seen = sum(weights.values()), Counter()
    for slot, r in enumerate(rows, 1):
        assert r.slot == slot - 1 and r.unit == seen[r.key]
        seen[r.key] += 1
        assert max(abs(seen["1" + k] - w / total * slot) for k, w in weights.items()) < 1 + 1e-5


def test_schedule_is_earliest_deadline_first(spark):
    row, rows = scheduled(spark, {"a": 5, "b": 3, "c": 3, "d": 0, "e": 1}, period=60)
    exact = [Fraction(w, row.total) for w in row.fine]
    assert [r.key for r in rows] == [row.sources[i] for i in edf(exact, 60)]
    assert {r.key for r in rows} == {"1a", "1b", "1c", "1e"}


def test_a_short_run_has_the_slots_that_it_needs(spark):
    row, rows = scheduled(spark, {"a": 4, "b": 1}, blocks=6)
    assert row.slots == len(rows) == 30
    assert Counter(r.key for r in rows) == {"1a": 24, "1b": 6}


def test_a_weight_below_one_slot_gets_one(spark):
    row, rows = scheduled(spark, {"a": 1, "b": 1e-12}, period=50)
    assert Counter(r.key for r in rows)["1b"] >= 1 and row.slots in (50, 51)


@pytest.mark.parametrize("period", [1, 7, 40])
@pytest.mark.parametrize("sizes", [[90, 70, 30, 1], [400, 11, 11], [17] * 12, [55]])
def test_one_schedule_over_the_whole_run(spark, sizes, period):
    """Stretch by stretch, as slot by slot from the first to the last."""
    counts = spark.createDataFrame([(f"1s{i:02}", n) for i, n in enumerate(sizes)], "key string, n long")
    row = pfair_mix.shares(counts, block_docs=1, period=period)
    rows, row = pfair_mix.schedule(row, whole=True).collect(), row.first()
    assert row.last > row.slots or len(sizes) == 1
    done, want = Counter(), {}
    for slot, i in enumerate(edf([Fraction(w, row.total) for w in row.fine], row.last)):
        if done[i] < sizes[i]:
            want[row.sources[i], done[i]] = slot
        done[i] += 1
    assert {(r.key, r.unit): r.slot for r in rows} == want and len(rows) == sum(sizes)


def test_less_than_one_block_off_the_target_weight_after_the_first_stretch(spark):
    """Weights that no stretch of 10 slots can give by itself."""
    weights = {"a": 0.47, "b": 0.31, "c": 0.22}
    docs = spark.createDataFrame([(i, "abc"[i % 3]) for i in range(1200)], "doc_id long, source string")
    rows = pfair_mix.mixed(docs, ["source"], weights, block_docs=1, period=10).orderBy("slot").collect()
    seen = Counter()
    for r in rows:
        assert r.release <= r.slot < r.deadline
        seen[r.source] += 1
        # All blocks before it have been placed, for as long as no source has run out.
        if r.slot < 800:
            assert sum(seen.values()) == r.slot + 1
            assert all(abs(seen[k] - w * (r.slot + 1)) < 1 + 1e-5 for k, w in weights.items())
    assert seen == {"a": 400, "b": 400, "c": 400}


def test_a_thousand_sources_within_seconds(spark):
    began = time.time()
    row, rows = scheduled(spark, {f"s{i}": 1 + i % 7 for i in range(1000)})
    assert len(rows) == 10_000 and time.time() - began < 60
    seen = Counter(r.key for r in rows)
    assert all(abs(seen[k] - w / row.total * 10_000) < 1 for k, w in zip(row.sources, row.fine))


def test_negative_weights_and_clashing_columns(spark):
    with pytest.raises(ValueError, match="negative"):
        scheduled(spark, {"a": -1})
    with pytest.raises(ValueError, match="block, key"):
        pfair_mix.mixed(spark.range(1), ["key", "Block"])


def test_documents_of_weight_zero_come_last(spark):
    df = spark.createDataFrame([(i, f"s{i % 3}") for i in range(60)], "doc_id long, source string")
    rows = pfair_mix.mixed(df, ["doc_id", "source"], {"s0": 1, "s1": 2, "s2": 0}).collect()
    assert len(rows) == 60 and all((r.slot is None) == (r.source == "s2") for r in rows)
    last = [r.source for r in pfair_mix.in_mixed_order(df, {"s0": 1, "s1": 2, "s2": 0}).collect()][-20:]
    assert set(last) == {"s2"}
    assert pfair_mix.mixed(df, ["doc_id"], {"other": 1}).filter("slot is null").count() == 60


def test_mix_of_uneven_sources(spark):
    docs = [(i, "big" if i % 3 else ("small" if i % 2 else None), f"t{i}") for i in range(500)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").repartition(7)
    rows = pfair_mix.mixed(df, ["doc_id", "source"], {"big": 1, "small": 1, None: 1}, block_docs=4, period=10).collect()
    assert sorted(r.doc_id for r in rows) == list(range(500))
    by_source = defaultdict(list)
    for r in rows:
        assert r.release <= r.slot < r.deadline
        by_source[r.source].append((r.block, r.place))
    for places in by_source.values():
        assert sorted(places) == [(i // 4, i % 4) for i in range(len(places))]
    assert len({(r.source, r.block) for r in rows}) == len({r.slot for r in rows})
    assert pfair_mix.in_mixed_order(df, {"big": 1, "small": 1}).columns == df.columns


def test_order_of_rows(spark, tmp_path):
    docs = [(i, f"s{i % 4}" if i % 8 else "s0") for i in range(2000)]
    df = spark.createDataFrame(docs, "doc_id long, source string")
    df.write.parquet(f"{tmp_path}/in")
    df = spark.read.parquet(f"{tmp_path}/in")
    want = [r.doc_id for r in pfair_mix.mixed(df, ["doc_id"]).orderBy("slot", "place").collect()]
    assert [r.doc_id for r in pfair_mix.in_mixed_order(df).collect()] == want


def test_odd_documents(spark, odd_docs, no_docs):
    docs = odd_docs.selectExpr("*", "if(doc_id > 5, 's', null) as source", "1 as slot", "2 as key")
    rows = pfair_mix.mixed(docs, ["doc_id", "text"]).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in docs.collect())
    assert sorted(r.doc_id or -1 for r in pfair_mix.in_mixed_order(docs).collect()) == sorted(r.doc_id or -1 for r in rows)
    empty = no_docs.selectExpr("*", "'s' as source")
    assert pfair_mix.mixed(empty, ["doc_id"]).count() == 0
    assert pfair_mix.in_mixed_order(empty).count() == 0
