import math
import random

import pytest
from pyspark.sql import functions as F

from cloudtally.llm import hard_negatives
from cloudtally.llm.queries import op12_hard_negatives

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, label int, embedding array<float>, anchor_id string, rank string"


def plain(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    """All pairs: rows are ``(id, label, vector)``."""
    def usable(r):
        whole = r[0] is not None and r[1] is not None and r[2] is not None
        return whole and all(x is not None and math.isfinite(x) for x in r[2])

    whole = [(i, k, [math.floor(256 * x) for x in v]) for i, k, v in filter(usable, rows)]
    out = []
    for i, k, v in whole:
        if not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in whole if j != i]
        scored.sort()
        for s, j, _ in [x for x in scored if x[2] == k][:positives]:
            p = -s
            inside = [(n, -t) for t, n, m in scored if m != k and low * p <= -100 * t <= high * p]
            out += [(i, j, r + 1, n, p, t) for r, (n, t) in enumerate(inside[:negatives])]
    return sorted(out)


def got(spark, rows, every=100, **options):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hard_negatives.mined(df, F.col("vec_id") % every == 0, **options).collect())


def test_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in rows]
    result = op12_hard_negatives(spark, SF_DIR)
    assert result.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = plain(rows, lambda i: i % 100 == 0)
    assert sorted(tuple(r) for r in result.collect()) == expected and len(expected) > 20


def test_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SLICE", 4)
    monkeypatch.setattr(hard_negatives, "CHUNK_ROWS", 30)
    rng = random.Random(3)
    rows = [(i, rng.randrange(3), [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)]) for i in range(400)]
    expected = plain(rows, lambda i: i % 20 == 0, 3, 4, 0, 100)
    assert got(spark, rows, 20, positives=3, negatives=4, low=0, high=100, block_rows=7) == expected


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]),
        (100, 1, [1.0, 0.5]),
        (1, 1, [1.0, 0.5]),
        (2, 2, [0.5, 0.5]),
        (3, 2, [0.5, 0.5]),
        (4, 2, [nan, 0.5]),
        (5, 2, [inf, 0.5]),
        (6, 2, [None, 0.5]),
        (7, 2, None),
        (8, None, [0.5, 0.5]),
        (None, 2, [0.5, 0.5]),
        (None, 1, [0.5, 0.5]),
        (9, 2, []),
        (10, 2, [0.5]),
        (11, 2, [0.5, 0.5, 7.0]),
        (12, 2, [0.0, 0.0]),
        (200, 3, [0.0, 0.0]),
        (201, 3, [1.0, 1.0]),
        (300, 4, [0.1, 0.1]),
    ]
    assert got(spark, rows) == plain(rows, lambda i: i % 100 == 0)


def test_repeated_rows(spark):
    rows = [(0, 1, [1.0])] * 2 + [(1, 1, [1.0])] * 3 + [(2, 2, [0.5])] * 3 + [(0, 2, [0.5])]
    assert got(spark, rows) == plain(rows, lambda i: i % 100 == 0)


def test_sums_beyond_floats(spark):
    rows = [(0, 1, [2.0**22, 1.0]), (1, 1, [2.0**22, 1.0]), (2, 2, [2.0**21, 1.0]), (3, 2, [2.0**21, 0.0])]
    result = got(spark, rows)
    assert result == plain(rows, lambda i: i % 100 == 0)
    assert result[0][5] == 2**59 + 2**16


def test_empty(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, 1, [1.0])]) == []


def test_windows_beyond_the_positive():
    with pytest.raises(ValueError, match="percent"):
        hard_negatives.mined(None, None, high=110)


def test_keys_sort_by_anchor_score_kind_id():
    parts = [(-5, 0, 9, 0, 3), (-5, 0, 9, 1, -4), (-5, 0, 9, 1, 2), (-5, 0, -9, 0, 1), (7, 0, 10, 1, 1), (7, 1, 10, 1, 0)]
    keys = []
    for anchor, number, score, kind, row in parts:
        one = [hard_negatives.np.array([x]) for x in (anchor, number, score, row)]
        keys.append(hard_negatives.packed(one[0], one[1], one[2], kind, one[3]).tobytes())
    assert keys == sorted(keys) and [hard_negatives.unpacked(k) for k in keys] == parts
