"""Benchmark decontamination with an FM-index per training shard.

Words are runs of ``0-9a-z`` and bytes from 0x80 on (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``), A-Z in lower case. A
window is 13 consecutive words of a benchmark item; an item of fewer words, but not none, is one window. A document
word inside any occurrence of a window is hit; a document is contaminated if 5 % of its words or more are hit.

A shard is some batches of documents, ``SHARD_BYTES`` of text or what a task has left. Its text is the sequence of its words that can take part in an occurrence: runs of
words of the benchmark vocabulary at least as long as the shortest window, each ended by a separator. Its index is

* the suffix array, by prefix doubling; a separator ends every comparison;
* the Burrows-Wheeler transform of it in a wavelet matrix: one bit vector with block ranks per bit of the symbols;
* sampled suffix positions: multiples of ``SAMPLE``, and the starts of runs.

All windows search backward together, one word a step, each step two ranks per level of the wavelet matrix. The rows
found are located by stepping back to a sampled position, and their spans are merged per document.

Benchmark items are cut by Spark into pieces of at most ``PIECE_WORDS`` words, which overlap by a window less one, and
packed into numbered blocks of at most ``BLOCK_WORDS`` words and a piece, written to the shared folder. The driver holds
one block at a time, to broadcast it, and takes it back when the pass of that block over the documents is written; so
neither driver nor tasks hold more, however large the benchmark or an item of it is. Of passes after the first only the
documents with hits are kept, to be joined at the end.

Null and empty texts have no words and no hits, and are clean. Rows that share an id are each judged on their own, and
all columns of a document go along in ``row``. Items with no words never occur, items that share an id count once, and
items without an id are looked for but not listed. An empty benchmark finds nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import bounded_batches, bytes_of, map_batches, numbered, written

WINDOW_WORDS = 13
#: Hit words in percent from which on a document is contaminated.
CONTAMINATED_PERCENT = 5
BLOCK_WORDS = 500_000
PIECE_WORDS = 100_000
SAMPLE = 16
SHARD_BYTES = 16 << 20

_WORD_BYTES = bytes(
    (b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Sorted suffixes of runs of symbols above 0, each ended by a separator 0; separators differ, in text order.

    Prefix doubling. No comparison passes a separator, so as many rounds do as the longest run has binary digits.
    """
    n, ends = len(text), text == 0
    keys = np.where(ends, np.cumsum(ends) - 1, text + ends.sum())
    rank, known = np.empty(n, np.int64), 1
    while True:
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        group = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if group[-1] == n - 1:
            return order
        rank[order] = group
        later = np.zeros(n, np.int64)
        later[: n - known] = rank[known:] + 1
        keys = rank * (n + 1) + later
        known *= 2


class Wavelet:
    """Wavelet matrix: symbols' bits from the highest down, each level stably parted into zeros and ones."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels, self.ones, self.zeros = levels, [], []
        now = symbols
        for level in range(levels - 1, -1, -1):
            bit = (now >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            self.zeros.append(len(now) - int(self.ones[-1][-1]))
            now = np.concatenate((now[bit == 0], now[bit == 1]))

    def rank(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol stands before ``low`` and before ``high``."""
        begin = np.zeros_like(low)
        for level, ones, zeros in zip(range(self.levels - 1, -1, -1), self.ones, self.zeros):
            bit = (symbol >> level) & 1 == 1
            a, b, c = ones[begin], ones[low], ones[high]
            begin = np.where(bit, zeros + a, begin - a)
            low = np.where(bit, zeros + b, low - b)
            high = np.where(bit, zeros + c, high - c)
        return low - begin, high - begin

    def symbol_at(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at these places, and how often each stands before its place."""
        symbol, begin = np.zeros_like(at), np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros):
            bit = ones[at + 1] - ones[at] == 1
            symbol = symbol * 2 + bit
            a, b = ones[begin], ones[at]
            begin = np.where(bit, zeros + a, begin - a)
            at = np.where(bit, zeros + b, at - b)
        return symbol, at - begin


class FMIndex:
    """Backward search over runs of symbols, each ended by a separator 0 that no query has."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.n = len(text)
        suffixes = suffix_array(text)
        transform = text[suffixes - 1].astype(np.int64)
        self.wavelet = Wavelet(transform, max(1, int(symbols).bit_length()))
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols + 1)))).astype(np.int64)
        # Starts of runs are sampled too, so that no step back crosses a separator.
        self.sampled = (suffixes % SAMPLE == 0) | (transform == 0)
        self.sample_rank = np.concatenate(([0], np.cumsum(self.sampled)))
        self.samples = suffixes[self.sampled]

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of equally long windows, one to a line."""
        low = np.zeros(len(windows), np.int64)
        high = np.full(len(windows), self.n, np.int64)
        live = np.arange(len(windows))
        for step in range(windows.shape[1] - 1, -1, -1):
            symbol = windows[live, step]
            first, last = self.wavelet.rank(symbol, low[live], high[live])
            low[live], high[live] = self.before[symbol] + first, self.before[symbol] + last
            live = live[last > first]
            if not len(live):
                break
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: back to a sampled one, counting the steps."""
        out, steps = np.zeros(len(rows), np.int64), 0
        open_, at = np.arange(len(rows)), rows.astype(np.int64)
        while len(open_):
            done = self.sampled[at]
            out[open_[done]] = self.samples[self.sample_rank[at[done]]] + steps
            open_, at = open_[~done], at[~done]
            if len(open_):
                symbol, rank = self.wavelet.symbol_at(at)
                at = self.before[symbol] + rank
                steps += 1
        return out


class Phrases:
    """Windows of benchmark items as symbols, grouped by length; each distinct window once, with its items."""

    def __init__(self, items: Iterable[tuple[object, list[bytes]]], window: int = WINDOW_WORDS):
        self.vocabulary: dict[bytes, int] = {}
        self.ids: list[object] = []
        found: dict[tuple[int, ...], list[int]] = {}
        for item_id, words in items:
            if not words:
                continue
            symbols = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            number, size = len(self.ids), min(window, len(words))
            self.ids.append(item_id)
            for at in range(len(symbols) - size + 1):
                owners = found.setdefault(tuple(symbols[at : at + size]), [])
                if not owners or owners[-1] != number:
                    owners.append(number)
        self.shortest = min(map(len, found), default=0)
        self.by_length: dict[int, tuple[np.ndarray, list[list[int]]]] = {}
        for size in sorted(set(map(len, found))):
            windows = [w for w in found if len(w) == size]
            self.by_length[size] = np.array(windows, np.int64), [found[w] for w in windows]

    def shard(self) -> Shard:
        return Shard(self)


class Shard:
    """The runs of some documents' words that can take part in an occurrence; of the rest only the number is kept."""

    def __init__(self, phrases: Phrases):
        self.phrases = phrases
        self.counts: list[int] = []
        self.pieces: list[np.ndarray] = []
        self.starts: list[int] = []
        self.owner: list[int] = []

    def add(self, words: list[bytes]) -> None:
        """One more document."""
        number, shortest = len(self.counts), self.phrases.shortest
        self.counts.append(len(words))
        if not shortest or len(words) < shortest:
            return
        look = self.phrases.vocabulary.get
        symbols = np.fromiter((look(w, 0) for w in words), np.int64, len(words))
        edge = np.flatnonzero(np.diff(np.concatenate(([0], (symbols > 0).view(np.int8), [0]))))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a >= shortest:
                self.pieces += [symbols[a:b].copy(), np.zeros(1, np.int64)]
                self.starts.append(a)
                self.owner.append(number)

    def hits(self) -> list[tuple[list[tuple[int, int]], list[object]]]:
        """For each document the merged spans of hit words, end exclusive, and the items that occur in it."""
        spans: list[list[tuple[int, int]]] = [[] for _ in self.counts]
        items: list[set[object]] = [set() for _ in self.counts]
        pieces, starts, owner = self.pieces, self.starts, self.owner
        if pieces:
            lengths = np.array([len(p) for p in pieces[::2]]) + 1
            offsets = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            index = FMIndex(np.concatenate(pieces), len(self.phrases.vocabulary))
            for size, (windows, owners) in self.phrases.by_length.items():
                low, high = index.search(windows)
                counts = high - low
                which = np.repeat(np.arange(len(windows)), counts)
                rows = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                at = index.locate(rows)
                piece = np.searchsorted(offsets, at, side="right") - 1
                for w, p, place in zip(which.tolist(), piece.tolist(), (at - offsets[piece]).tolist()):
                    begin = starts[p] + place
                    spans[owner[p]].append((begin, begin + size))
                    items[owner[p]].update(owners[w])
        ids = self.phrases.ids
        return [(merged(s), sorted({ids[i] for i in k}, key=str)) for s, k in zip(spans, items)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _cut(words: list[bytes], most: int, window: int = WINDOW_WORDS) -> Iterator[list[bytes]]:
    """Pieces of at most ``most`` words in which every window of an item lies whole."""
    step = most - window + 1
    for begin in range(0, max(1, len(words) - window + 1), step):
        yield words[begin : begin + most]


def blocks(benchmark: DataFrame, item_id: str, text: str, limit: int, piece_words: int = PIECE_WORDS) -> DataFrame:
    """One row per block: ``ids`` and ``words`` (joined by spaces) of its pieces. A written table."""
    piece_words = max(WINDOW_WORDS, min(piece_words, limit))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, out, sizes = [], [], []
        for name, raw in zip(batch.column(0).to_pylist(), bytes_of(batch.column(1))):
            words = words_of(raw)
            for piece in _cut(words, piece_words) if words else ():
                ids.append(name)
                out.append(b" ".join(piece))
                sizes.append(len(piece))
        columns = [pa.array(ids, pa.string()), pa.array(out, pa.binary()), pa.array(sizes, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["id", "words", "size"])

    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text"))
    pieces = written(map_batches(items, cut, "id string, words binary, size long"))
    total = pieces.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, size = [], [], 0
        for batch in batches:
            for name, piece, count in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if size + count > limit and words:
                    yield _block(ids, words)
                    ids, words, size = [], [], 0
                ids.append(name)
                words.append(piece)
                size += count
        if words:
            yield _block(ids, words)

    packed = pieces.repartition(max(1, -(-total // limit))).mapInArrow(pack, "ids array<string>, words array<binary>")
    return written(packed.withColumn("block", F.monotonically_increasing_id()))


def _block(ids: list[str | None], words: list[bytes]) -> pa.RecordBatch:
    columns = [pa.array([ids], pa.list_(pa.string())), pa.array([words], pa.list_(pa.binary()))]
    return pa.RecordBatch.from_arrays(columns, names=["ids", "words"])


def found_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
    piece_words: int = PIECE_WORDS,
) -> DataFrame:
    """``row``, ``n_words``, ``spans`` (hit words, merged, end exclusive), ``items`` (their ids as sorted strings)."""
    packed = blocks(benchmark, item_id, item_text, block_words, piece_words)
    numbers = [r.block for r in packed.select("block").orderBy("block").collect()]
    row = F.struct("*").alias("row")
    if len(numbers) < 2:
        return _searched(docs.select(row, F.col(text).alias("_text")), packed, numbers, ["row"])
    placed = numbered(docs, row)
    texts = placed.select("place", F.col(f"row.{text}").alias("_text"))
    first, found = None, []
    for number in numbers:
        pass_ = _searched(texts, packed, [number], ["place"])
        if first is None:
            first = written(pass_)
            found.append(first.filter("size(spans) > 0").drop("n_words"))
        else:
            found.append(written(pass_.filter("size(spans) > 0").drop("n_words")))
    hits = reduce(DataFrame.unionAll, found).groupBy("place").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    rows = placed.join(first.select("place", "n_words"), "place").join(hits, "place", "left")
    begun = F.array_sort(F.coalesce("spans", F.array().cast("array<struct<begin:int,end:int>>")))
    empty = F.array().cast("array<string>")
    return rows.select("row", "n_words", _merged_column(begun).alias("spans"), F.coalesce("items", empty).alias("items"))


def _merged_column(spans: Column) -> Column:
    """Sorted spans, those that overlap or touch made one."""

    def add(out: Column, span: Column) -> Column:
        last = F.element_at(out, -1)
        grown = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], span["end"]).alias("end"))
        touching = (F.size(out) > 0) & (F.try_element_at(out, F.lit(-1))["end"] >= span["begin"])
        joined = F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(grown))
        return F.when(touching, joined).otherwise(F.concat(out, F.array(span)))

    return F.aggregate(spans, F.array().cast("array<struct<begin:int,end:int>>"), add)


def _searched(rows: DataFrame, packed: DataFrame, numbers: list[int], keep: list[str]) -> DataFrame:
    """``keep``, ``n_words``, ``spans``, ``items``: what a block's windows (of no block, none) hit in ``_text``.

    The block goes through the driver, which holds no other.
    """
    block = packed.filter(F.col("block").isin(numbers)).first() if numbers else None
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((block.ids, [bytes(w) for w in block.words]) if block else ([], []))
    bounded_batches(spark)
    name, span = uuid.uuid4().hex, "array<struct<begin:int,end:int>>"
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    at = len(keep)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = _prepared(name, shared)
        some, shard, size = [], phrases.shard(), 0

        def judged_shard() -> Iterator[pa.RecordBatch]:
            hits, counts, low = shard.hits(), shard.counts, 0
            for batch in some:
                own = hits[low : low + batch.num_rows]
                columns = [
                    pa.array(counts[low : low + batch.num_rows], pa.int64()),
                    pa.array([[{"begin": a, "end": b} for a, b in s] for s, _ in own], _SPANS),
                    pa.array([[n for n in names if n is not None] for _, names in own], pa.list_(pa.string())),
                ]
                low += batch.num_rows
                yield pa.RecordBatch.from_arrays([*batch.columns[:at], *columns], names=[*keep, "n_words", "spans", "items"])

        for batch in batches:
            if batch.num_rows:
                for raw in bytes_of(batch.column(at)):
                    shard.add(words_of(raw))
                    size += len(raw)
                some.append(batch)
            if size >= SHARD_BYTES:
                yield from judged_shard()
                some, shard, size = [], phrases.shard(), 0
        yield from judged_shard()

    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep)
    return rows.select(*keep, "_text").mapInArrow(over, f"{schema}n_words long, spans {span}, items array<string>")


#: The last block that a worker prepared: of ``BLOCK_WORDS`` words at most.
_PREPARED: dict[str, Phrases] = {}


def _prepared(name: str, shared: Broadcast) -> Phrases:
    if name not in _PREPARED:
        _PREPARED.clear()
        ids, words = shared.value
        _PREPARED[name] = Phrases(zip(ids, (w.split() for w in words)))
    return _PREPARED[name]


_SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))


def judged(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """``found_spans`` with ``n_hit`` and ``contaminated``."""
    rows = found_spans(docs, benchmark, **names)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["begin"])
    rows = rows.withColumn("n_hit", hit)
    over = F.lit(100) * F.col("n_hit") >= F.lit(CONTAMINATED_PERCENT) * F.col("n_words")
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & over)
