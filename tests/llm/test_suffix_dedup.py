import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cloudtally.llm import suffix_dedup
from cloudtally.llm.queries import op6_suffix_dedup

SF_DIR = "/root/testdata/sf0.001"
LENGTH = suffix_dedup.LENGTH


def brute(texts):
    """Mark every byte of every string that occurs twice."""
    raws = [(t or "").encode() for t in texts]
    counts = Counter(r[i : i + LENGTH] for r in raws for i in range(len(r) - LENGTH + 1))
    out = []
    for raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - LENGTH + 1):
            if counts[raw[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int((gone[:-1] & ~np.concatenate(([False], gone[:-1]))[: len(raw)]).sum()) if len(raw) else 0
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("alphabet", [b"ab", b"a", b"the quick"])
def test_suffix_array_and_prefixes(alphabet):
    rng = random.Random(1)
    base = bytes(rng.choice(alphabet) for _ in range(700))
    text = np.frombuffer(base + bytes(rng.choice(alphabet) for _ in range(600)) + base[100:650], np.uint8)
    starts = np.sort(rng.sample(range(len(text) - LENGTH), 900))
    order = suffix_dedup.suffix_array(text, starts)
    raw = text.tobytes()
    keys = [raw[i : i + LENGTH] for i in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == starts.tolist()
    lengths = suffix_dedup.common_prefixes(text, order)

    def shared(a, b):
        n = 0
        while max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
            n += 1
        return n

    assert lengths.tolist() == [0] + [shared(a, b) for a, b in zip(order[:-1].tolist(), order[1:].tolist())]


def planted(rng):
    words = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, shared = text(120), text(70)
    docs = [text(rng.randint(1, 400)) for _ in range(20)]
    docs += [text(30) + passage + text(40) for _ in range(9)] + [docs[3], docs[3], docs[4][:450], docs[5][7:]]
    docs += [passage[:399], passage[3:403], passage[200:], shared + text(5) + shared, "ab" * 700, "a" * 3000, "", None]
    edited = docs[6].split(" ")
    for i in range(0, len(edited), 90):
        edited[i] = "edit"
    return docs + [" ".join(edited), text(10) + " ".join(edited)]


@pytest.mark.parametrize("shard_bytes", [1 << 21, 3000])
def test_planted(spark, tmp_path, shard_bytes):
    docs = planted(random.Random(11))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    df.write.parquet(folder := f"{tmp_path}/docs")
    rows = suffix_dedup.deduplicated(spark.read.parquet(folder), ["doc_id"], shard_bytes=shard_bytes).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in rows}
    assert got == dict(enumerate(brute(docs)))


def edited_pair(rng):
    """Near copies whose edited bytes are neighbours in the order: no other text has them."""
    p, s = ("".join(rng.choice("abcdefgh") for _ in range(n)) for n in (450, 900))
    return p + "1" + s, p + "2" + s


def test_prefixes_after_an_edit():
    raws = [t.encode() for t in edited_pair(random.Random(5))]
    piece, offset, _, repeated = suffix_dedup.repeated_starts(raws, np.array([len(r) - LENGTH + 1 for r in raws]))
    counts = Counter(r[i : i + LENGTH] for r in raws for i in range(len(r) - LENGTH + 1))
    want = [counts[raws[p][i : i + LENGTH]] > 1 for p, i in zip(piece.tolist(), offset.tolist())]
    assert repeated.tolist() == want


def test_copies_with_an_edit(spark, docs):
    texts = edited_pair(random.Random(5))
    rows = suffix_dedup.deduplicated(docs(texts), ["doc_id"]).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in rows}
    assert got == dict(enumerate(brute(texts)))


def test_segments_of_a_long_text(monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(suffix_dedup, "SEGMENT_BYTES", 1000)
    raws = [bytes(rng.choice(b"abc") for _ in range(n)) for n in (5000, 10, 399, 400, 1400, 2399)]
    number, start, count, _ = suffix_dedup.pieces_of(raws)
    covered = [(n, s + i) for n, s, c in zip(number.tolist(), start.tolist(), count.tolist()) for i in range(c)]
    assert sorted(covered) == [(n, i) for n, r in enumerate(raws) for i in range(len(r) - LENGTH + 1)]


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = {r[0]: tuple(r[1:]) for r in op6_suffix_dedup(spark, SF_DIR).collect()}
    assert got == dict(zip([i for i, _ in docs], brute([t for _, t in docs])))


def test_odd_documents(spark, odd_docs, no_docs):
    rows = suffix_dedup.deduplicated(odd_docs, ["doc_id", "n_tokens"]).collect()
    want = Counter(zip([r.doc_id for r in odd_docs.collect()], brute([r.text for r in odd_docs.collect()])))
    got = Counter((r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())) for r in rows)
    assert got == want
    assert suffix_dedup.deduplicated(no_docs, ["doc_id"]).count() == 0


def test_clashing_columns(spark, odd_docs):
    with pytest.raises(ValueError, match="kept, n_bytes"):
        suffix_dedup.deduplicated(odd_docs, ["Kept", "n_bytes"])
