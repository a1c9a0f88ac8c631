r"""Spelling variants of a corpus' words by Bloom-guided neighbourhoods.

Words are maximal runs of ``[A-Za-zÀ-ÿ]``, only A-Z in lower case. A run of a document may be damaged first:
if ``damage`` divides the crc32 of ``<id>:<run>``, the run loses the code point at that crc32 modulo its length. The
vocabulary is the words of at least ``MIN_LENGTH`` code points that occur ``MIN_COUNT`` times or more in all texts.

Two words are near if one inserted, deleted or replaced code point makes one the other. A word's form is its near word
of the largest count (ties: the smallest in code point order), if it has at least ``RATIO`` times the word's own count;
following forms to the last one gives its root. Counts grow along the way, so there is always a last one.

*Filters.* Every word has a 64-bit hash by position, so the hash of an edited word follows from the word's own. Bloom
filters of 64-bit blocks hold the words' hashes, a shard for each length, a length of more than ``SHARD_WORDS`` words in
several by hash. Each shard is built by one task. Shards are broadcast in rounds of at most ``ROUND_WORDS`` words (two
bytes each), so the broadcast has a bound whatever the vocabulary.

*Probes.* A round's tasks generate, from each word, all words with one code point less and all with one replaced by a
larger one of the vocabulary's alphabet: each near pair is found once, from its longer or smaller side. Edits are
hashes, probed as arrays; only positives leave the task, as hashes again.

*Exact join.* Positives are joined with the vocabulary by hash, which removes the filters' false positives, and then
with their own word; the two texts are compared code point by code point, so equal hashes decide nothing.

Null and empty texts have no words; a null id counts as an empty one. Repeated rows count as often as they occur. A run
of any length is a word, whose edits are probed in bounded slices. Other columns are not read. An empty table gives no
rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import bounded_batches, bytes_of, map_batches, shared_folder, written

MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
DAMAGE = 97
SHARD_WORDS = 1 << 22
ROUND_WORDS = 1 << 24
#: Bytes of distinct words that a task counts before it passes them on, and edits that it probes at a time.
COUNT_BYTES = 1 << 23
PROBES = 1 << 18

_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_WORDS_A_BLOCK = 4
_BITS = 5


def damaged(run: bytes, prefix: int, damage: int | None) -> bytes:
    """The run as it counts; ``prefix`` is the crc32 of what stands before it."""
    if damage:
        value = crc32(run, prefix)
        if value % damage == 0:
            letters = run.decode()
            at = value % len(letters)
            return (letters[:at] + letters[at + 1 :]).encode()
    return run


def word_counts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", damage: int | None = None, least: int = MIN_LENGTH
) -> DataFrame:
    """``word`` and ``n`` of all words of at least ``least`` code points; counted in tasks before the shuffle."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    bounded_batches(rows.sparkSession)

    def packed(counts: Counter[bytes]) -> pa.RecordBatch:
        kept = [(w, n) for w, n in counts.items() if len(w) >= least and len(w.decode()) >= least]
        words = pa.array([w for w, _ in kept], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        size = 0
        for batch in batches:
            for name, raw in zip(bytes_of(batch.column(0)), bytes_of(batch.column(1))):
                prefix, before = crc32(name + b":"), len(counts)
                for run, n in Counter(_RUN.findall(raw.lower())).items():
                    counts[damaged(run, prefix, damage)] += n
                    if len(counts) > before:
                        before, size = len(counts), size + len(run) + 64
                if size > COUNT_BYTES:
                    yield packed(counts)
                    counts, size = Counter(), 0
        yield packed(counts)

    return rows.mapInArrow(over, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


_LETTERS = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _powers(length: int) -> np.ndarray:
    powers = np.full(max(1, length), _BASE, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def _finished(sums: np.ndarray, length: int) -> np.ndarray:
    return _mixed(sums + np.uint64(length * _BASE % (1 << 64)))


def word_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of words of one length, given as rows of code points."""
    sums = (_LETTERS[codes] * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)
    return _finished(sums, codes.shape[1])


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: the places of its words, and their code points as rows (all are below 256)."""
    sizes = np.array([len(w) for w in words])
    for length in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == length)
        yield at, np.frombuffer(b"".join([words[i] for i in at.tolist()]), np.uint8).reshape(len(at), length)


def _latin(column: pa.Array) -> list[bytes]:
    return [w.encode("latin-1") for w in column.to_pylist()]


def edits(codes: np.ndarray, alphabet: np.ndarray, replaced: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(word, hash)`` of edited words, in slices of bounded size: places of words and the edits' hashes.

    Either code points are replaced by larger ones of the alphabet, or one is deleted (of equal neighbours the first).
    """
    count, length = codes.shape
    powers, width = _powers(length), len(alphabet) if replaced else 1
    step = max(1, PROBES // width)
    for low in range(0, count, step):
        rows = codes[low : low + step]
        terms = _LETTERS[rows] * powers
        ends = np.cumsum(terms, axis=1, dtype=np.uint64)
        sums = ends[:, -1:]
        places = max(1, PROBES // (width * len(rows)))
        for begin in range(0, length, places):
            end = min(begin + places, length)
            cut = slice(begin, end)
            if replaced:
                values = (sums - terms[:, cut])[:, :, None] + _LETTERS[alphabet] * powers[cut][:, None]
                there = alphabet > rows[:, cut, None]
            else:
                values = ends[:, cut] - terms[:, cut] + (sums - ends[:, cut]) * np.uint64(_INVERSE)
                there = np.ones(values.shape, bool)
                inner = max(begin, 1)
                there[:, inner - begin :] = rows[:, inner:end] != rows[:, inner - 1 : end - 1]
            at = np.nonzero(there)
            yield low + at[0], _finished(values[at], length if replaced else length - 1)


def _bits(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each hash, and the bits that it sets there."""
    values = _mixed(hashes ^ np.uint64(_BASE))
    block = ((values >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    bits = np.zeros(len(values), np.uint64)
    for field in range(_BITS):
        bits |= np.uint64(1) << ((values >> np.uint64(6 * field)) & np.uint64(63))
    return block.astype(np.int64), bits


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _blocks(words: int, parts: int) -> int:
    """64-bit blocks of each of a length's shards: 16 bits a word."""
    return -(-words // (parts * _WORDS_A_BLOCK))


def vocabulary(counts: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """``word``, ``n``, ``length``, ``hash`` of the words that occur often enough. A written table."""

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = _latin(batch.column(0))
        hashes, lengths = np.zeros(len(words), np.uint64), np.array([len(w) for w in words], np.int32)
        for at, codes in by_length(words):
            hashes[at] = word_hashes(codes)
        columns = [*batch.columns, pa.array(lengths), pa.array(hashes.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n", "length", "hash"])

    return written(map_batches(counts.filter(F.col("n") >= least), hashed, "word string, n long, length int, hash long"))


def _alphabet(words: DataFrame) -> np.ndarray:
    """The code points of all words, at most 256."""

    def letters(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes = np.unique(np.frombuffer(b"".join(_latin(batch.column(0))), np.uint8))
        return pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int32))], names=["code"])

    found = map_batches(words.select("word"), letters, "code int").distinct()
    return np.array(sorted(r.code for r in found.collect()), np.uint8)


def filters(words: DataFrame, sizes: dict[int, tuple[int, int]]) -> DataFrame:
    """``length``, ``part``, ``bits``: the Bloom filter of each shard; ``sizes`` has a length's words and its parts."""

    def dealt(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        parts = np.array([sizes[n][1] for n in lengths.tolist()], np.uint64)
        part = (((hashes >> np.uint64(32)) * parts) >> np.uint64(32)).astype(np.int32)
        columns = [batch.column(0), pa.array(part), batch.column(1)]
        return pa.RecordBatch.from_arrays(columns, names=["length", "part", "hash"])

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bits = None, np.zeros(0, np.uint64)

        def done() -> pa.RecordBatch:
            columns = pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), pa.array([bits.tobytes()])
            return pa.RecordBatch.from_arrays([*columns], names=["length", "part", "bits"])

        for batch in batches:
            length, part = batch.column(0).to_numpy().astype(np.int64), batch.column(1).to_numpy().astype(np.int64)
            hashes = batch.column(2).to_numpy().view(np.uint64)
            edges = np.flatnonzero(np.diff(length) | np.diff(part)) + 1
            for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(length)]):
                if high > low:
                    shard = int(length[low]), int(part[low])
                    if shard != now:
                        if now:
                            yield done()
                        now, bits = shard, np.zeros(_blocks(*sizes[shard[0]]), np.uint64)
                    block, ones = _bits(hashes[low:high], len(bits))
                    np.bitwise_or.at(bits, block, ones)
        if now:
            yield done()

    rows = map_batches(words.select("length", "hash"), dealt, "length int, part int, hash long")
    rows = rows.repartition("length", "part").sortWithinPartitions("length", "part")
    return written(rows.mapInArrow(built, "length int, part int, bits binary"))


def rounds(sizes: dict[int, tuple[int, int]], most: int) -> list[list[tuple[int, int]]]:
    """Shards ``(length, part)`` in groups whose words are at most ``most``, or one shard."""
    out, words = [], most + 1
    for length, (total, parts) in sorted(sizes.items()):
        for part in range(parts):
            share = -(-total // parts)
            if words + share > most:
                out.append([])
                words = 0
            out[-1].append((length, part))
            words += share
    return out


def _positives(words: DataFrame, alphabet: np.ndarray, shards: dict, sizes: dict[int, tuple[int, int]]) -> DataFrame:
    """``probe``, ``hash``, ``check``: edits that a round's filters let pass, and the word that they come from."""
    lengths = {length for length, _ in shards}
    shared = words.sparkSession.sparkContext.broadcast(shards)

    def passed(hashes: np.ndarray, length: int) -> np.ndarray:
        total, parts = sizes[length]
        part, good = _part(hashes, parts), np.zeros(len(hashes), bool)
        for number in range(parts):
            bits = shared.value.get((length, number))
            if bits is not None:
                at = np.flatnonzero(part == number) if parts > 1 else np.arange(len(hashes))
                block, ones = _bits(hashes[at], len(bits))
                good[at] = (bits[block] & ones) == ones
        return np.flatnonzero(good)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, check = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for at, codes in by_length(_latin(batch.column(0))):
                for length, replaced in ((codes.shape[1], True), (codes.shape[1] - 1, False)):
                    if length not in lengths:
                        continue
                    for word, hashes in edits(codes, alphabet, replaced):
                        good = passed(hashes, length)
                        source = at[word[good]]
                        columns = [hashes[good].view(np.int64), own[source], check[source]]
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["probe", "hash", "check"])

    asked = words.filter(F.col("length").isin(sorted({n + d for n in lengths for d in (0, 1)})))
    asked = asked.select("word", "hash", F.xxhash64("word").alias("check"))
    return asked.mapInArrow(over, "probe long, hash long, check long")


def near_pairs(words: DataFrame, shard_words: int = SHARD_WORDS, round_words: int = ROUND_WORDS) -> DataFrame:
    """Each near pair of a vocabulary once: ``a``, ``a_n``, ``b``, ``b_n``. A written table."""
    spark = words.sparkSession
    bounded_batches(spark)
    # One row per length; lengths are few, as their sum is bounded by the text.
    counted = words.groupBy("length").agg(F.count("*").alias("n")).collect()
    sizes = {r.length: (r.n, -(-r.n // shard_words)) for r in counted}
    alphabet, built, folder = _alphabet(words), filters(words, sizes), shared_folder(spark)
    columns = "probe long, hash long, check long"
    spark.createDataFrame([], columns).write.parquet(folder)
    for shards in rounds(sizes, round_words):
        low, high = shards[0], shards[-1]
        place = F.struct("length", "part")
        part = built.filter(place.between(*(F.struct(*(F.lit(x).cast("int") for x in s)) for s in (low, high))))
        bits = {(r.length, r.part): np.frombuffer(r.bits, np.uint64) for r in part.toLocalIterator()}
        _positives(words, alphabet, bits, sizes).write.mode("append").parquet(folder)
    found = spark.read.schema(columns).parquet(folder)
    other = words.select(F.col("hash").alias("probe"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    own = words.select("hash", F.xxhash64("word").alias("check"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    pairs = found.join(other, "probe").join(own, ["hash", "check"])
    return written(pairs.filter(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of words that have a form: each round doubles the steps taken."""
    now = written(forms.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = written(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further"))
        now = step.select("word", "root")
        if step.filter("further is not null").isEmpty():
            return now


def variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    damage: int | None = None,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    shard_words: int = SHARD_WORDS,
    round_words: int = ROUND_WORDS,
) -> DataFrame:
    """``word``, ``form`` (null: none), ``root``, ``n``, ``n_near``, ``form_n`` of each word of the vocabulary."""
    words = vocabulary(word_counts(docs, doc_id, text, damage, min_length), min_count)
    pairs = near_pairs(words, shard_words, round_words)
    there = pairs.select(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    back = pairs.select(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    near = there.unionAll(back)
    counted = near.groupBy("word").agg(F.count("*").alias("n_near"), F.max("near_n").alias("most"))
    large = near.filter(F.col("near_n") >= ratio * F.col("n")).join(counted, "word").filter("near_n = most")
    forms = written(large.groupBy("word").agg(F.min("near").alias("form"), F.max("near_n").alias("form_n")))
    rows = words.select("word", "n").join(counted.select("word", "n_near"), "word", "left")
    rows = rows.join(forms, "word", "left").join(_roots(forms), "word", "left")
    n_near = F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", n_near, "form_n")
