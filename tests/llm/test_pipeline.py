"""The pipeline against a plain version of every stage."""

import re
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cloudtally.llm import fm_decontam, pfair_mix
from tests.llm.test_fm_decontam import brute as benchmark_brute
from tests.llm.test_pfair_mix import edf
from tests.llm.test_rule_ledger import brute as measures
from tests.llm.test_simhash_links import groups, plain

SF_DIR = "/root/testdata/sf0.001"


def in_order(folder):
    rows = folder.select("doc_id", "_metadata.file_name", "_metadata.row_index").collect()
    return [r.doc_id for r in sorted(rows, key=lambda r: (r.file_name, r.row_index))]


def plain_mix(docs):
    """Ids in the order of the mix, slot by slot."""
    import hashlib

    sources = {}
    for i, source in docs:
        sources.setdefault("1" + source, []).append(i)
    keys = sorted(sources)
    weights = [len(sources[k]) ** 0.5 for k in keys]
    fine = [round(w / max(weights) * pfair_mix.FINE) for w in weights]
    exact = [Fraction(w, sum(fine)) for w in fine]
    blocks = [-(-len(sources[k]) // pfair_mix.BLOCK_DOCS) for k in keys]
    slots = {}
    for slot, i in enumerate(edf(exact, max(-(-n // w) for n, w in zip(blocks, exact)))):
        slots.setdefault(keys[i], []).append(slot)
    placed = []
    for key in keys:
        ordered = sorted(sources[key], key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))
        for n, i in enumerate(ordered):
            placed.append((slots[key][n // pfair_mix.BLOCK_DOCS], n % pfair_mix.BLOCK_DOCS, i))
    return [i for _, _, i in sorted(placed)]


def test_run_against_plain_stages(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    left = []
    for i, r in docs.items():
        m = measures(r.text)
        if not (m[0] < 50 or 100 * m[4] > 50 * m[0] or (10 * m[2] > m[0] and m[2] >= 20)):
            left.append(i)
    assert 0 < len(left) < len(docs)
    root = groups({i: plain(docs[i].text) for i in left})
    left = [i for i in left if root[i] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    verdict = benchmark_brute([(i, docs[i].text) for i in left], items)
    assert any(v[4] for v in verdict.values())
    left = plain_mix([(i, docs[i].source) for i in left if not verdict[i][4]])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, start = [], 0
    for i in left:
        ids = [*tokenizer.encode(docs[i].text, add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()), key=lambda r: r[1])
    assert got == want


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_documents(spark, odd_docs, no_docs, stage):
    name, function = corpus_pipeline.STAGES[stage]
    docs = odd_docs.selectExpr("*", "if(doc_id > 5, 's', null) as source", "'x' as row", "1 as place", "2L as fp")
    found = function(spark, docs, SF_DIR)
    rows = found.collect()
    if stage < 4:
        assert found.columns == docs.columns
    if name in ("source_mix", "token_files"):
        assert len(rows) == docs.count()
    empty = no_docs.selectExpr("*", "'s' as source")
    assert function(spark, empty, SF_DIR).count() == 0


def test_plain_versions_agree_on_words():
    text = "İı A_b-é 9x"
    assert [w.decode() for w in fm_decontam.words_of(text.encode())] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "İı a_b-é 9x")
