import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from cloudtally.llm import rule_ledger
from cloudtally.llm.queries import op2_rule_ledger

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    """The contract's measures, worked out the long way."""
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated)
    )


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab#|\n \t\x0b\x1c\x85é😀", max_size=60))
def test_measures(text):
    assert rule_ledger.measures(text.encode())[:5] == brute(text)


def check(found, docs):
    rows = {}
    for r in found.collect():
        rows.setdefault(r.doc_id, []).append(tuple(r[1:8]))
    for doc_id, text in docs:
        m = brute(text)
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        kept = not failed and not (10 * m[2] > m[0] and m[2] >= 20)
        assert (*m, failed, kept) in rows[doc_id]
    assert sum(map(len, rows.values())) == len(docs)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    check(op2_rule_ledger(spark, SF_DIR), docs)


def test_odd_documents(spark, odd_docs, no_docs):
    rows = rule_ledger.ledger(odd_docs).collect()
    assert Counter((r.row.doc_id, *r[1:6]) for r in rows) == Counter((r.doc_id, *brute(r.text)) for r in odd_docs.collect())
    assert all(r.fail_bits & 1 for r in rows if r.n_words < 50)
    assert rule_ledger.ledger(no_docs).count() == 0


def test_ablation(spark):
    rows = spark.createDataFrame([(0,), (1,), (1,), (3,), (4,), (5,), (8,), (8,)], "fail_bits long")
    got = {r.rule: tuple(r[1:]) for r in rule_ledger.ablation(rows, rule_ledger.POLICIES["web-1"]).collect()}
    assert got == {
        "few_words": (4, 2, 5, 7),
        "repeated_words": (1, 0, 3, 7),
        "symbols": (2, 1, 4, 7),
    }
    assert rule_ledger.ablation(rows.limit(0), rule_ledger.POLICIES["web-1"]).count() == 0
