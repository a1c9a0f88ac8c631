import random
import re
import zlib
from collections import Counter

import numpy as np

from cloudtally.llm import spelling_variants as sv
from cloudtally.llm.queries import op13_spelling_variants

SF_DIR = "/root/testdata/sf0.001"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def counts(docs, damage):
    out = Counter()
    for name, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return out


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    at = next((i for i, x in enumerate(a) if x != b[i]), len(a))
    return a[at:] == b[at + 1 :]


def plain(docs, damage=None, length=5, count=3, ratio=2):
    """All pairs of words."""
    n = {w: k for w, k in counts(docs, damage).items() if len(w) >= length and k >= count}
    around = {w: [] for w in n}
    words = sorted(n, key=len)
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if len(b) > len(a) + 1:
                break
            if near(a, b):
                around[a].append(b)
                around[b].append(a)
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    rows = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n[w], len(around[w]), n[form[w]] if form[w] else None))
    return sorted(rows)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    expected = plain(docs, 97)
    assert got(op13_spelling_variants(spark, SF_DIR)) == expected
    assert any(r[1] and r[1] != r[2] for r in expected)


def test_many_shards_and_rounds(spark, docs, monkeypatch):
    monkeypatch.setattr(sv, "PROBES", 100)
    rng = random.Random(1)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 7))) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(40)]
    rows = list(enumerate(texts))
    result = sv.variants(docs(texts), shard_words=20, round_words=60)
    assert got(result) == plain(rows)


def test_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(sv.variants(odd_docs, damage=3, min_count=1, min_length=2)) == plain(rows, 3, 2, 1)


def test_long_words(spark, docs):
    long = "ab" * 20000
    texts = [f"{long} {long}c {'x' + long[1:]} " * 3 + f"{long} " * 9]
    assert got(sv.variants(docs(texts))) == plain([(0, texts[0])])


def test_empty(spark, no_docs, docs):
    assert got(sv.variants(no_docs)) == []
    assert got(sv.variants(docs([None, "", "12 34", "one two"]))) == []


def test_ties_and_case(spark, docs):
    texts = ["Straße straße STRASSE straßen " * 3, "caffee kaffee kafee " * 3 + "kaffee caffee " * 6, "ÉtÉÉÉ étééé " * 3]
    assert got(sv.variants(docs(texts))) == plain(list(enumerate(texts)))


def test_hash_of_an_edit_is_that_of_the_edited_word():
    word, alphabet = b"aabca\xe9\xe9x", np.frombuffer(b"abcx\xe9", np.uint8)
    codes = np.frombuffer(word, np.uint8)[None]

    def hashed(words):
        return {int(sv.word_hashes(np.frombuffer(w, np.uint8)[None])[0]) for w in words}

    shorter = {word[:i] + word[i + 1 :] for i in range(len(word))}
    larger = {word[:i] + bytes([c]) + word[i + 1 :] for i in range(len(word)) for c in alphabet.tolist() if c > word[i]}
    for replaced, expected in ((False, shorter), (True, larger)):
        found = [h for _, hashes in sv.edits(codes, alphabet, replaced) for h in hashes.tolist()]
        assert set(found) == hashed(expected) and len(found) == len(expected)


def test_filters_pass_all_their_words():
    hashes = sv._mixed(np.arange(5000, dtype=np.uint64))
    bits = np.zeros(sv._blocks(2500, 1), np.uint64)
    block, ones = sv._bits(hashes[:2500], len(bits))
    np.bitwise_or.at(bits, block, ones)
    block, ones = sv._bits(hashes, len(bits))
    passed = (bits[block] & ones) == ones
    assert passed[:2500].all() and passed[2500:].mean() < 0.02
