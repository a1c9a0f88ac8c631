import random

import pytest
import xxhash

from cloudtally.llm import graph, simhash_links
from cloudtally.llm.queries import op3_simhash_links

SF_DIR = "/root/testdata/sf0.001"


def plain(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps):
    """Smallest id reachable, by comparing all pairs."""
    parent = {i: i for i in fps}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in fps:
        for j in fps:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in fps}


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    fps = {i: plain(t) for i, t in docs.items()}
    root = groups(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op3_simhash_links(spark, SF_DIR).collect()}
    assert got == {i: (f"{fps[i]:016x}", root[i]) for i in docs}
    assert len(set(root.values())) < len(docs)


def test_all_links_are_found(spark):
    rng = random.Random(5)
    values = {0, 1, 3, 7, 15, 2**64 - 1, 2**63, 2**63 + 1, 2**63 + 7}
    for _ in range(60):
        value = rng.getrandbits(64)
        values.add(value)
        for _ in range(6):
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                value ^= 1 << bit
            values.add(value)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash_links.links(spark.createDataFrame(signed, "fp long")).collect()]
    want = {frozenset((a, b)) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3}
    assert {frozenset(p) for p in found} == want and len(found) == len(want)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)]
    pairs += [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    rng.shuffle(pairs)
    got = graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    linked = {i for p in pairs if p[0] != p[1] for i in p}
    assert {r.node: r.component for r in got} == {i: find(i) for i in linked} and len(got) == len(linked)


def test_odd_documents(spark, odd_docs, no_docs):
    got = [(r.doc_id, r.component_id) for r in simhash_links.near_duplicates(odd_docs).collect()]
    assert len(got) == odd_docs.count()
    ids = dict(got)
    assert ids[1] == ids[2] == ids[11] == 1 and ids[7] == ids[5] == 5 and ids[3] == 3
    assert simhash_links.near_duplicates(no_docs).count() == 0
    kept = simhash_links.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 3, 5, 8, 9, 10]
    assert simhash_links.one_of_each(no_docs).count() == 0
