"""Token ids of documents as Parquet: list columns, page indexes, selective reads.

A token table is a folder of Parquet files in document order. Each row is one document:

====================  ============================================================================
order columns         what documents are sorted by (``doc_id``), ascending over files and in each; more on request
tokens                its ids, the end id last: ``list<int32>``, dictionary or delta encoded
n_tokens              how many
part, part_offset     number of the file, and ids in that file before this document
====================  ============================================================================

Row groups and pages are small and have min/max indexes, so a read of some documents opens the pages that hold them,
and a read of metadata opens no page of ids. ``start`` (ids of all documents before one) is not stored, as it would
need all files before this one to be complete: ``token_index`` adds up one number per file instead.

Null and empty texts have the end id alone. Documents that share an id, or have none (null sorts first), stay rows of
their own, ordered by text. Further columns of the input are not read; kept ones may not have the names above. An empty table gives an empty folder of files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cloudtally.llm.common import bounded_batches, bytes_of

#: Row groups of 16 MB, pages of 64 KB or 200 documents: what a selective read opens at least.
LAYOUT = {
    "compression": "zstd",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(64 << 10),
    "parquet.page.row.count.limit": "200",
}
ENCODINGS = {
    "dictionary": {"parquet.enable.dictionary": "true"},
    "delta": {"parquet.enable.dictionary": "false", "parquet.writer.version": "PARQUET_2_0"},
}
#: Bytes of pieces and ids that a worker keeps, and the longest piece that it keeps.
MEMO_BYTES = 24 << 20
MEMO_PIECE = 64
JOINED_BYTES = 6 << 20

#: White space other than space and line end: the ASCII bytes, and how all other such characters begin in UTF-8.
_RARE_BYTES = b"\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_RARE_STARTS = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
_BESIDE = (b"  ", b"\n ", b" \n")
_MARKS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"


def _rare(text: bytes) -> bool:
    """Whether a text may have white space other than space and line end."""
    return len(text.translate(None, _RARE_BYTES)) < len(text) or any(map(text.__contains__, _RARE_STARTS))


def _cuts_at_spaces(text: bytes) -> bool:
    """Whether every space of a text in UTF-8 stands between two characters that are not white space."""
    return not (text[:1] == b" " or text[-1:] == b" " or any(map(text.__contains__, _BESIDE)) or _rare(text))


def _all_bytes(column: pa.StringArray) -> list[bytes]:
    """A string column without nulls in UTF-8, sliced from its buffer."""
    if not len(column):
        return []
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].tolist()
    raw = data.to_pybytes() if data else b""
    return [raw[a:b] for a, b in zip(at, at[1:])]


def _together(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Batches joined up to some megabytes of text: the larger a batch, the fewer distinct pieces per piece."""
    some, size = [], 0
    for batch in batches:
        if batch.num_rows:
            some.append(batch)
            size += batch.column(text).nbytes
        if size >= JOINED_BYTES:
            yield pa.Table.from_batches(some).combine_chunks().to_batches()[0]
            some, size = [], 0
    if some:
        yield pa.Table.from_batches(some).combine_chunks().to_batches()[0]


def _byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else the next unused."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in prints else next(spare)) for b in range(256)]


class Memo:
    """Pieces and their ids as Arrow and numpy columns, of a bounded number of bytes."""

    def __init__(self):
        self.pieces = pa.array([], pa.string())
        self.ids = np.zeros(0, "<u4")
        self.ends = np.zeros(1, np.int64)

    def ids_at(self, at: np.ndarray) -> list[bytes | None]:
        """Ids of the pieces at these places; None where a place is negative."""
        ends = self.ends
        spans = zip(at.tolist(), ends[at].tolist(), ends[at + 1].tolist())
        return [self.ids[a:b].tobytes() if i >= 0 else None for i, a, b in spans]

    def add(self, pieces: pa.StringArray, ids: list[bytes]) -> None:
        """More pieces; beyond the bound the new ones alone stay, which hold the frequent ones again before long."""
        short = pc.less_equal(pc.binary_length(pieces), MEMO_PIECE)
        some = [i for i, keep in zip(ids, short.to_pylist()) if keep]
        sizes = np.fromiter(map(len, some), np.int64, len(some)) // 4
        pieces, ids = pieces.filter(short), np.frombuffer(b"".join(some), "<u4")
        if self.nbytes + pieces.nbytes + ids.nbytes > MEMO_BYTES:
            self.__init__()
        self.pieces = pa.concat_arrays([self.pieces, pieces])
        self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(sizes)))
        self.ids = np.concatenate((self.ids, ids))

    @property
    def nbytes(self) -> int:
        return self.pieces.nbytes + self.ids.nbytes + self.ends.nbytes


class Encoder:
    """Ids of texts by a byte-level BPE file of the tokenizers library, with a memo of pieces.

    The vocabulary's split pattern always cuts before a single space between two characters that are not white space,
    so a text's ids are those of its pieces in turn. It also cuts where a run of letters ends, and around a line end
    between two such characters; a piece of one or two words goes to the model word by word, any other through the
    whole tokenizer, which gives the string of a special token in a text that token's id.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = dict(enumerate(_byte_letters()))
        self.space = self.letters[32]
        self.tokenize = self.tokenizer.model.tokenize
        self.id_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.line_end = self._ids(["\n"])[0]
        self.marks: dict[str, bytes] = {"": b""}
        self.memo = Memo()

    def _ids(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _word(self, word: str) -> bytes:
        """Ids of a run of letters, with or without a space before it."""
        word = word.encode().decode("latin-1").translate(self.letters)
        return b"".join([self.id_bytes[t.id] for t in self.tokenize(word)])

    def _marked(self, word: str, before: str, known: bytes | None = None) -> bytes | None:
        """Ids of a run of letters with marks after it; None if it is anything else. ``known``: ids of the letters."""
        letters = word.rstrip(_MARKS)
        mark = word[len(letters) :]
        if not letters.isalpha():
            return None
        ids = self.marks.get(mark)
        if ids is None:
            ids = self.marks[mark] = self._ids([mark])[0]
            if len(self.marks) > 10_000:
                self.marks = {"": b""}
        return (known or self._word(before + letters)) + ids

    def _simple(self, piece: bytes, known: bytes | None) -> bytes | None:
        """Ids of a piece of one word, or two on two lines, with the space before it; None if it is not.

        ``known`` has the ids of the piece without the marks at its end.
        """
        id_bytes, tokenize = self.id_bytes, self.tokenize
        if piece.isalpha():  # ASCII letters stand for themselves
            return b"".join([id_bytes[t.id] for t in tokenize(self.space + piece.decode())])
        text = piece.decode()
        if text.isalpha():
            spelled = piece.decode("latin-1").translate(self.letters)
            return b"".join([id_bytes[t.id] for t in tokenize(self.space + spelled)])
        word, line_end, second = text.partition("\n")
        ids = self._marked(word, " ", None if line_end else known)
        if not line_end or ids is None:
            return ids
        more = self._marked(second, "")
        return None if more is None else ids + self.line_end + more

    def _learned(self, pieces: pa.StringArray) -> list[bytes]:
        """Ids of pieces, each with the space before it."""
        bare = pc.utf8_rtrim(pieces, characters=_MARKS)
        at = pc.fill_null(pc.index_in(bare, value_set=self.memo.pieces), -1).to_numpy()
        raw, simple = _all_bytes(pieces), self._simple
        out = [simple(piece, known) for piece, known in zip(raw, self.memo.ids_at(at))]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self._ids([" " + raw[i].decode() for i in rest])):
            out[i] = ids
        return out

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in UTF-8, one after the other, and how many each has.

        Texts are split, and their pieces told apart, as Arrow columns; Python sees each distinct piece of the batch
        once. A text's first piece has no space before it, and a text that cannot be cut at its spaces is one piece.
        """
        plain = [_cuts_at_spaces(text) for text in texts]
        column = pa.array([text if is_plain else b"" for text, is_plain in zip(texts, plain)], pa.binary())
        lists = pc.split_pattern(column.cast(pa.string()), " ")
        begins = lists.offsets.to_numpy()[:-1]
        pieces = lists.values.dictionary_encode()
        which, distinct = pieces.indices.to_numpy().astype(np.int64), pieces.dictionary
        first = _all_bytes(distinct.take(pieces.indices.take(pa.array(begins))))
        heads = [piece if is_plain else text for piece, text, is_plain in zip(first, texts, plain)]
        which[begins] = len(distinct) + np.arange(len(texts))
        used = np.bincount(which, minlength=len(distinct))[: len(distinct)] > 0

        at = pc.fill_null(pc.index_in(distinct, value_set=self.memo.pieces), -1).to_numpy()
        new = used & (at < 0)
        fresh = distinct.filter(pa.array(new))
        learned = self._learned(fresh)
        kept, known = self.memo.ids, self.memo.ends
        found = learned + self._ids([head.decode() for head in heads])
        table = np.concatenate((kept, np.frombuffer(b"".join(found), "<u4")))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = len(kept) + np.cumsum(sizes) - sizes

        # Where the ids of each distinct piece, then of each head, stand in the table; of a piece not used, nowhere.
        places, counts = np.zeros((2, len(distinct) + len(texts)), np.int64)
        old = np.flatnonzero(at >= 0)
        places[old], counts[old] = known[at[old]], known[at[old] + 1] - known[at[old]]
        own = np.concatenate((np.flatnonzero(new), len(distinct) + np.arange(len(texts))))
        places[own], counts[own] = starts, sizes
        self.memo.add(fresh, learned)
        sizes = counts
        sizes, places = sizes[which], places[which]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        values = table[np.repeat(places - ends + sizes, sizes) + np.arange(total)]
        counts = np.add.reduceat(sizes, begins) if len(begins) else sizes
        return values, counts


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One per Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(
    docs: DataFrame,
    tokenizer_path: str,
    order: Sequence[str] = ("doc_id",),
    text: str = "text",
    end_id: int = 0,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Documents in ascending order with their ids; one shuffle, of the texts by range of the order."""
    bounded_batches(docs.sparkSession)
    columns = [*order, *keep]
    clash = {"tokens", "n_tokens", "part", "part_offset", "_text"}.intersection(map(str.lower, columns))
    if clash:
        raise ValueError(f"kept columns with names of the result: {', '.join(sorted(clash))}")
    rows = docs.select(*columns, F.col(text).alias("_text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, "_text")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = _encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for some in _together(batches, len(columns)):
            ids, counts = encoder.encode(bytes_of(some.column(len(columns))))
            ids, counts = np.insert(ids, np.cumsum(counts), end_id), counts + 1
            ends = np.cumsum(counts)
            offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
            values = pa.array(ids.astype(np.uint32, copy=False).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    *some.columns[: len(columns)],
                    pa.ListArray.from_arrays(offsets, values),
                    pa.array(counts),
                    pa.array(np.full(len(counts), part, np.int32)),
                    pa.array(before + ends - counts),
                ],
                names=[*columns, "tokens", "n_tokens", "part", "part_offset"],
            )
            before += int(ends[-1])
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(over, f"{schema}, tokens array<int>, n_tokens long, part int, part_offset long")


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    order: Sequence[str] = ("doc_id",),
    text: str = "text",
    end_id: int = 0,
    keep: Sequence[str] = (),
    encoding: str = "dictionary",
) -> None:
    """Write the token table of ``docs``, with the columns ``keep``."""
    rows = encoded(docs, tokenizer_path, order, text, end_id, keep)
    rows.write.options(**LAYOUT, **ENCODINGS[encoding]).parquet(folder)


def token_index(spark: SparkSession, folder: str) -> DataFrame:
    """All columns but the ids, with ``start``: the ids of all documents before. Reads no page of ids."""
    rows = spark.read.parquet(folder).drop("tokens")
    return _with_start(rows, rows)


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``token_index`` with counts and ``ids_crc32`` worked out from the stored ids."""
    rows = spark.read.parquet(folder)
    columns = [c for c in rows.columns if c not in ("tokens", "n_tokens")]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    bounded_batches(spark)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            at = lists.offsets.to_numpy()
            ids = lists.values.to_numpy().astype("<u4", copy=False)
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            counts = np.diff(at).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(counts), pa.array(np.array(crcs, np.int64))],
                names=[*columns, "n_tokens", "ids_crc32"],
            )

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
    found = rows.select("tokens", *columns).mapInArrow(over, f"{schema}, n_tokens long, ids_crc32 long")
    return _with_start(found, spark.read.parquet(folder))


def _with_start(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Add ``start``. The running sum is over one row per file."""
    before = F.sum("_total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    totals = stored.groupBy("part").agg(F.sum("n_tokens").alias("_total"))
    totals = totals.select("part", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.join(totals, "part").withColumn("start", F.col("_before") + F.col("part_offset")).drop("_before")
