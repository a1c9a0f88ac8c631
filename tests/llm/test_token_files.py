import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cloudtally.llm import token_files
from cloudtally.llm.queries import op1_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.001"


def plain(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


ENCODER = token_files.Encoder(PATH)


def encoded(texts):
    ids, counts = ENCODER.encode([t.encode() for t in texts])
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] if texts else []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab'sé1!., \n\t\x1c\x85  <|endoftext|>", max_size=40), max_size=6))
def test_pieces_give_the_ids_of_whole_texts(texts):
    assert encoded(texts) == plain(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert encoded(texts) == plain(texts)


def test_special_tokens_in_texts():
    """As the library's plain call has them: one id each."""
    mark = "<|endoftext|>"
    texts = [mark, f"a {mark} b", f"word{mark}word", f"a\n{mark}", f"{mark}\nb c", f"a  {mark}  b", f"x,{mark}{mark}. y", f"\t{mark} é"]
    plain_call = Tokenizer.from_file(PATH)
    want = [plain_call.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [plain_call.token_to_id(mark)]
    assert encoded(texts) == want


def expected(docs):
    rows, start = [], 0
    ordered = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for (doc_id, _), ids in zip(ordered, plain([t for _, t in ordered])):
        ids = [*ids, 0]
        rows.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return rows


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_odd_documents(spark, odd_docs, tmp_path, encoding):
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(odd_docs, folder, PATH, encoding=encoding)
    found = token_files.token_digests(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected(docs)
    index = token_files.token_index(spark, folder)
    assert sorted(r.start for r in index.collect()) == sorted(r.start for r in found)
    assert "tokens:array" not in index._jdf.queryExecution().executedPlan().toString()
    files = [f for f in (tmp_path / "tokens").glob("*.parquet") if pq.ParquetFile(f).metadata.num_row_groups]
    ids = [pq.ParquetFile(f).metadata.row_group(0).column(1) for f in files]
    assert all(c.has_offset_index for c in ids)
    assert all(("DELTA_BINARY_PACKED" in c.encodings) == (encoding == "delta") for c in ids)


def test_no_documents(spark, no_docs, tmp_path):
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(no_docs, folder, PATH)
    assert token_files.token_digests(spark, folder).count() == 0


def test_query_is_the_plain_encoding(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert sorted(map(tuple, op1_token_files(spark, SF_DIR).collect())) == expected(docs)


def test_clashing_columns(spark, odd_docs):
    with pytest.raises(ValueError, match="n_tokens"):
        token_files.encoded(odd_docs, PATH, keep=["n_tokens"])
