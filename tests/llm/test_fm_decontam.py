import hashlib
import random
import re

import numpy as np
import pytest

from cloudtally.llm import fm_decontam
from cloudtally.llm.queries import op8_fm_decontam

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    """Every window at every place."""
    windows = {}
    for item_id, text in items:
        words = words_of(text)
        size = min(13, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(str(item_id))
    sizes = {len(w) for w in windows}
    out = {}
    for doc_id, text in docs:
        words, hit, found = words_of(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if names := windows.get(tuple(words[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc_id] = (len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words))
    return out


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    got = {r[0]: tuple(r[1:]) for r in op8_fm_decontam(spark, SF_DIR).collect()}
    assert got == brute(docs, items)
    assert any(r[4] for r in got.values())


@pytest.mark.parametrize("seed", range(4))
def test_index(seed):
    """Ranks, search and locate against a scan, on few symbols with long repeats."""
    rng = np.random.default_rng(seed)
    runs = [rng.integers(1, 4, rng.integers(1, 40)) for _ in range(20)]
    runs += [runs[0], np.tile([1, 2], 50), np.tile([1], 70)]
    text = np.concatenate([np.concatenate((r, [0])) for r in runs]).astype(np.int64)
    index = fm_decontam.FMIndex(text, 3)
    for size in (1, 2, 5, 13):
        windows = np.array([text[i : i + size] for i in range(len(text) - size) if text[i : i + size].all()])
        windows = np.unique(windows, axis=0)
        low, high = index.search(windows)
        for w, a, b in zip(windows, low, high):
            places = [i for i in range(len(text) - size + 1) if (text[i : i + size] == w).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == places
    low, high = index.search(np.array([[3] * 60]))
    assert (low == high).all()


def test_blocks_and_odd_documents(spark, odd_docs, no_docs):
    rng = random.Random(3)
    pool = ["alpha", "beta", "gamma", "é1", "x"]
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 20)))) for i in range(12)]
    items += [(3, "the same text the same text"), (99, None), (None, "no id"), (98, "..."), (97, "The SAME-text")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(i, " ".join(rng.choice(pool) for _ in range(200))) for i in range(15)] + [(50, items[5][1] + " ~ " + items[6][1])]
    texts = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs, [i for i in items if i[0] is not None])
    for limit, piece in ((10**6, 10**5), (10**6, 13), (60, 10**5), (25, 14)):
        rows = fm_decontam.judged(texts, bench, block_words=limit, piece_words=piece).collect()
        got = {r.row.doc_id: (r.n_words, r.n_hit, len(r["items"]), r.contaminated) for r in rows}
        assert got == {i: (w[0], w[1], w[2], w[4]) for i, w in want.items()}
    odd = fm_decontam.judged(odd_docs, bench).collect()
    assert len(odd) == odd_docs.count()
    assert {r.row.doc_id for r in odd if r.contaminated} == {5, 7, None}
    assert all(r.n_words == 0 and not r.contaminated for r in odd if not r.row.text)
    assert fm_decontam.judged(no_docs, bench).count() == 0
    assert not any(r.contaminated for r in fm_decontam.judged(texts, bench.limit(0)).collect())


def test_long_items_are_cut_and_blocks_are_bounded(spark):
    words = [f"w{i}" for i in range(5000)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, "few words"), (3, None)], "item_id long, text string")
    packed = fm_decontam.blocks(bench, "item_id", "text", 700, 300).collect()
    sizes = [sum(len(w.split()) for w in r.words) for r in packed]
    assert len(packed) > 5 and max(sizes) <= 700
    windows = {tuple(w.split()[i : i + 13]) for r in packed for w in r.words for i in range(len(w.split()) - 12)}
    assert windows == {tuple(x.encode() for x in words[i : i + 13]) for i in range(4988)}


def test_shards_of_several_batches(spark, monkeypatch):
    """A shard goes on over batches up to its bytes."""
    phrases = fm_decontam.Phrases([("a", b"x y z".split())])
    shard = phrases.shard()
    for text in ("q x y z", "", "x y z x y z", "x y"):
        shard.add(fm_decontam.words_of(text.encode()))
    assert shard.hits() == [([(1, 4)], ["a"]), ([], []), ([(0, 6)], ["a"]), ([], [])]
    monkeypatch.setattr(fm_decontam, "SHARD_BYTES", 50)
    docs = spark.createDataFrame([(i, "lorem x y z ipsum " * (i % 3)) for i in range(40)], "doc_id long, text string")
    bench = spark.createDataFrame([("a", "x y z")], "item_id string, text string")
    rows = fm_decontam.judged(docs, bench).collect()
    assert all(r.n_hit == 3 * (r.row.doc_id % 3) for r in rows)
