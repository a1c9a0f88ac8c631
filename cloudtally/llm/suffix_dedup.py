"""Exact substring dedup: every byte covered by a string of ``LENGTH`` (400) bytes that also starts anywhere else goes.

Texts are UTF-8 bytes; matches never cross documents; overlapping occurrences count, also within one document; strings
are judged on the input. Null and empty texts have no bytes; texts shorter than ``LENGTH`` lose none. Rows that repeat
an id, or have none, are documents of their own, and repeated rows are copies of each other. Other columns are not
read. An empty table gives no rows.

*Pieces.* The strings starting at consecutive places mostly share the place of their least ``GRAM``-byte hash (of equal
ones the first). A maximal run of such starts, with its bytes, is a piece. Equal strings have the same least hash, so
only pieces of one hash can share a string: pieces are grouped by it, and a task needs nothing from other groups. A
piece that occurs twice or more as a whole is repeated from end to end, and one copy of it represents it from then on.
Hashes of pieces (no bytes) are counted first, so only pieces whose hash other texts have too are fetched.

*Shards.* These pieces are dealt out by hash, a group of more than ``SHARD_BYTES`` in several parts by digest, and each
partition is cut into shards of about that many bytes with whole parts. In a shard, the suffix array of all pieces'
bytes is refined as by Larsson and Sadakane: suffixes are sorted by eight bytes, then groups of equal ones, and only
those, by the rank of the suffix further on, doubling up to ``LENGTH``. Common prefixes of neighbours follow as by
Kasai: a suffix whose neighbour follows the last one's neighbour shares one byte less; others, and those where the last
one shared none, are compared. A start is repeated if its neighbour shares ``LENGTH`` bytes or more.

*Merging.* A group in several parts is judged once more across shards: each shard gives a 128-bit fingerprint of each of
its distinct strings in such a group, packed by ranges of fingerprints; for each range, binary search tells those that
two shards or more have.

Removed bytes come back to their documents as lists of spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import bounded_batches, bytes_of, map_batches, numbered, written

LENGTH = 400
GRAM = 32
#: Bytes of text that are hashed, and bytes of pieces that are sorted, at a time.
SEGMENT_BYTES = 1 << 20
SHARD_BYTES = 1 << 21

_MULTIPLIERS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
_PLACE_BITS = 24


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """Hashes of all runs of ``GRAM`` (32) bytes, each joined from two halves."""
    now, width = (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0xFF51AFD7ED558CCD), 1
    for multiplier in _MULTIPLIERS:
        now = now[:-width] * np.uint64(multiplier) + (now[width:] ^ (now[width:] >> np.uint64(29)))
        width *= 2
    now ^= now >> np.uint64(32)
    now *= np.uint64(0x9FB21C651E98DF25)
    return now ^ (now >> np.uint64(28))


def least_places(hashes: np.ndarray, window: int) -> np.ndarray:
    """For each run of ``window`` hashes the place of the least (of equal ones the first); fewer than 2**24 hashes."""
    places = np.arange(len(hashes), dtype=np.uint64)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    now, width = (hashes & ~low) | places, 1
    while 2 * width <= window:
        now = np.minimum(now[:-width], now[width:])
        width *= 2
    if width < window:
        now = np.minimum(now[: len(now) - (window - width)], now[window - width :])
    return (now & low).astype(np.int64)


def pieces_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """``(text, start, count, hash)`` of all pieces: number of the text, first start in it, number of starts."""
    out, batch, size = [], [], 0

    def flush() -> None:
        if batch:
            joined = np.frombuffer(b"".join(t for _, _, t in batch), np.uint8)
            sizes = np.array([len(t) for _, _, t in batch])
            begins = np.cumsum(sizes) - sizes
            hashes = gram_hashes(joined)
            least = least_places(hashes, LENGTH - GRAM + 1)
            ends = begins + sizes - LENGTH + 1
            valid = np.zeros(len(joined) + 1, np.int8)
            np.add.at(valid, begins, 1)
            np.add.at(valid, ends, -1)
            starts = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
            places = least[starts]
            new = np.concatenate(([True], (np.diff(places) != 0) | (np.diff(starts) != 1)))
            first = np.flatnonzero(new)
            count = np.diff(np.concatenate((first, [len(starts)])))
            at = starts[first]
            owner = np.searchsorted(begins, at, side="right") - 1
            number = np.array([n for n, _, _ in batch])[owner]
            offset = at - begins[owner] + np.array([o for _, o, _ in batch])[owner]
            out.append((number, offset, count, hashes[places[first]].view(np.int64)))

    for number, text in enumerate(texts):
        for low in range(0, len(text) - LENGTH + 1, SEGMENT_BYTES):
            part = text[low : low + SEGMENT_BYTES + LENGTH - 1]
            if size + len(part) > 2 * SEGMENT_BYTES:
                flush()
                batch, size = [], 0
            batch.append((number, low, part))
            size += len(part)
    flush()
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(columns) for columns in zip(*out))


def suffix_array(text: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """``starts`` in the order of the ``length`` bytes from each; a text is read as if zeros followed it.

    Larsson-Sadakane: ``rank`` is the place of a suffix's group in ``order``; only groups of two or more are sorted on.
    """
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, np.uint8))).astype(np.uint64)
    keys = np.zeros(n, np.uint64)
    for byte in range(8):
        keys = (keys << np.uint64(8)) | padded[byte : n + byte]
    order = np.argsort(keys, kind="stable")
    rank = np.zeros(n + 1, np.int64)
    open_ = np.arange(n)
    ordered, known = keys[order], 8
    while True:
        new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        heads = np.flatnonzero(new)
        sizes = np.diff(np.concatenate((heads, [len(open_)])))
        rank[order[open_]] = np.repeat(open_[heads], sizes) + 1
        if known >= length:
            break
        open_ = open_[np.repeat(sizes > 1, sizes)]
        if not len(open_):
            break
        step = min(known, length - known)
        members = order[open_]
        keys = rank[members] * (n + 1) + rank[np.minimum(members + step, n)]
        by = np.argsort(keys, kind="stable")
        order[open_] = members[by]
        ordered = keys[by]
        known += step
    chosen = np.zeros(n, bool)
    chosen[starts] = True
    return order[chosen[order]]


def _compared(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes that suffixes at ``a`` share with those at ``b``; 0 where ``b`` is negative."""
    n = len(text)
    padded = np.concatenate((text, np.zeros(16, np.uint8)))
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    shared = np.zeros(len(a), np.int64)
    live = np.flatnonzero(b >= 0)
    a, b = a[live], b[live]
    while len(live):
        differ = words[np.minimum(a, n)] != words[np.minimum(b, n)]
        equal = np.where(differ.any(axis=1), differ.argmax(axis=1), 8)
        equal = np.minimum(equal, n - np.maximum(a, b))
        shared[live] += equal
        on = equal == 8
        live, a, b = live[on], a[on] + 8, b[on] + 8
    return shared


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each suffix of ``order`` shares with the one before it; 0 for the first.

    As by Kasai, in text order: if the neighbour of a suffix follows the neighbour of the suffix one byte before, they
    share one byte less, if any are left. Only the others are compared, eight bytes at a time.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    listed = np.sort(order)
    neighbour = before[listed]
    follows = np.zeros(len(listed), bool)
    follows[1:] = (listed[1:] == listed[:-1] + 1) & (neighbour[1:] == neighbour[:-1] + 1) & (neighbour[:-1] >= 0)
    heads = np.flatnonzero(~follows)
    ends = np.concatenate((heads[1:], [len(listed)]))
    all_heads, all_shared = [], []
    while len(heads):
        shared = _compared(text, listed[heads], neighbour[heads])
        all_heads.append(heads)
        all_shared.append(shared)
        # A chain whose bytes are used up, as after an edit, is compared anew: at most once for each first byte.
        heads = heads + shared + 1
        heads, ends = heads[heads < ends], ends[heads < ends]
    lengths = np.zeros(n, np.int64)
    if all_heads:
        heads, shared = np.concatenate(all_heads), np.concatenate(all_shared)
        by = np.argsort(heads, kind="stable")
        heads, shared = heads[by], shared[by]
        sizes = np.diff(np.concatenate((heads, [len(listed)])))
        # What follows a head loses a byte a step.
        lengths[listed] = np.repeat(shared + heads, sizes) - np.arange(len(listed))
    return lengths[order]


def repeated_starts(pieces: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a shard's starts, in the order of their strings: ``(piece, offset, group, repeated)``.

    ``group`` numbers the distinct strings; ``repeated`` tells those that the shard has twice or more.
    """
    text = np.frombuffer(b"".join(pieces), np.uint8)
    begins = np.cumsum([len(p) for p in pieces]) - [len(p) for p in pieces]
    starts = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    order = suffix_array(text, starts)
    equal = common_prefixes(text, order) >= LENGTH
    group = np.cumsum(~equal)
    after = np.concatenate((equal[1:], [False]))
    piece = np.searchsorted(begins, order, side="right") - 1
    return piece, order - begins[piece], group, equal | after


def _found_pieces(rows: DataFrame) -> DataFrame:
    """All pieces: ``place`` of the document, ``start``, ``count``, ``hash`` and two halves of a digest of the bytes."""

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = bytes_of(batch.column(1))
        number, start, count, value = pieces_of(texts)
        digest = xxhash.xxh3_128_digest
        ends = (start + count + LENGTH - 1).tolist()
        digests = b"".join([digest(texts[n][a:b]) for n, a, b in zip(number.tolist(), start.tolist(), ends)])
        halves = np.frombuffer(digests, "<i8").reshape(-1, 2)
        place = batch.column(0).to_numpy()[number] if len(number) else np.zeros(0, np.int64)
        columns = [place, start.astype(np.int64), count.astype(np.int64), value, halves[:, 0], halves[:, 1]]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=_PIECE)

    return map_batches(rows, find, ", ".join(f"{c} long" for c in _PIECE))


_PIECE = ["place", "start", "count", "hash", "digest_a", "digest_b"]
_SPANS = "place long, begin long, end long"


def _with_bytes(docs: DataFrame, pieces: DataFrame) -> DataFrame:
    """``hash``, ``part``, ``large``, ``place``, ``start``, ``count``, ``bytes`` of some pieces."""
    listed = F.collect_list(F.struct("hash", "part", "large", "start", "count")).alias("wanted")
    rows = docs.join(pieces.groupBy("place").agg(listed), "place").select("place", "wanted", "text")
    names = ["hash", "part", "large", "place", "start", "count"]

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, places = bytes_of(batch.column(2)), np.array(batch.column(0).to_pylist(), np.int64)
        lists = batch.column(1)
        owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
        value, part, large, start, count = (lists.flatten().field(i).to_numpy() for i in range(5))
        ends = (start + count + LENGTH - 1).tolist()
        some = [texts[o][a:b] for o, a, b in zip(owner.tolist(), start.tolist(), ends)]
        columns = [pa.array(c) for c in (value, part, large, places[owner], start, count)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(some, pa.binary())], names=[*names, "bytes"])

    return map_batches(rows, cut, ", ".join(f"{n} long" for n in names) + ", bytes binary")


def _sharded(pieces: DataFrame, shard_bytes: int, buckets: int) -> DataFrame:
    """By shard: spans of repeated starts, and strings of groups in several shards, by range of their fingerprints.

    The latter are ``prints``, 16 bytes each, and ``wheres``: place, start, and whether the shard has it twice.
    """
    rows = pieces.repartition("hash", "part").sortWithinPartitions("hash", "part")
    bounded_batches(rows.sparkSession)

    def judge(shard: list[tuple]) -> pa.RecordBatch:
        values, large, places, starts, counts = (np.array(c, np.int64) for c in list(zip(*shard))[:5])
        texts = [s[5] for s in shard]
        piece, offset, group, repeated = repeated_starts(texts, counts)
        at, owner = starts[piece] + offset, places[piece]
        order = np.lexsort((at[repeated], owner[repeated]))
        a, o = at[repeated][order], owner[repeated][order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1] + 1) | (o[1:] != o[:-1])
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:], [len(a)]))[: len(first)] - 1
        spans = [pa.array(c) for c in (o[first], a[first], a[last] + LENGTH)]
        shared = (large[piece] > 0) & np.concatenate(([True], group[1:] != group[:-1]))
        digest = xxhash.xxh3_128_digest
        owners, offsets = piece[shared].tolist(), offset[shared].tolist()
        prints = np.frombuffer(b"".join([digest(texts[p][k : k + LENGTH]) for p, k in zip(owners, offsets)]), "V16")
        bucket = (prints.view(">u4")[::4].astype(np.uint64) * np.uint64(buckets)) >> np.uint64(32)
        wheres = np.stack((owner[shared], at[shared], repeated[shared]), axis=1)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
        some = [(b, order[x:y]) for b, (x, y) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())) if y > x]
        none, empty = pa.nulls(len(some), pa.int64()), pa.nulls(len(first), pa.binary())
        columns = [pa.concat_arrays([c, none]) for c in spans]
        columns.append(pa.concat_arrays([pa.nulls(len(first), pa.int32()), pa.array([b for b, _ in some], pa.int32())]))
        for packed in (prints, wheres):
            columns.append(pa.concat_arrays([empty, pa.array([packed[w].tobytes() for _, w in some], pa.binary())]))
        return pa.RecordBatch.from_arrays(columns, names=["place", "begin", "end", "bucket", "prints", "wheres"])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        size, key = 0, None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(7)]
            for value, part, large, *rest in zip(*columns):
                if size >= shard_bytes and key != (value, part):
                    yield judge(shard)
                    shard, size = [], 0
                key = value, part
                shard.append((value, large, *rest))
                size += len(rest[-1])
        if shard:
            yield judge(shard)

    return rows.mapInArrow(over, _SPANS + ", bucket int, prints binary, wheres binary")


def _across_shards(strings: DataFrame) -> DataFrame:
    """Spans of strings that two shards or more have."""

    def search(parts: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        prints = np.frombuffer(b"".join(p for p, _ in parts), "S16")
        place, begin, repeated = np.frombuffer(b"".join(w for _, w in parts), np.int64).reshape(-1, 3).T
        ordered = np.sort(prints)
        several = np.searchsorted(ordered, prints, side="right") - np.searchsorted(ordered, prints, side="left") > 1
        several &= repeated == 0
        columns = [place[several], begin[several], begin[several] + LENGTH]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["place", "begin", "end"])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for bucket, prints, wheres in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if parts and bucket != now:
                    yield search(parts)
                    parts = []
                now = bucket
                parts.append((prints, wheres))
        if parts:
            yield search(parts)

    rows = strings.select("bucket", "prints", "wheres").repartition("bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(over, _SPANS)


def repeated_spans(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``place``, ``begin``, ``end`` of repeated bytes; spans may overlap. ``docs`` has ``place`` and ``text``."""
    pieces = written(_found_pieces(docs))
    key = ["hash", "digest_a", "digest_b"]
    first = F.min(F.struct("place", "start", "count")).alias("first")
    strings = written(pieces.groupBy(*key).agg(F.count("*").alias("n"), first))
    several = strings.filter("n > 1").select(*key)
    whole = pieces.join(several, key, "left_semi")
    whole = whole.select("place", F.col("start").alias("begin"), (F.col("start") + F.col("count") + LENGTH - 1).alias("end"))
    size = F.sum(F.col("first.count") + (LENGTH - 1))
    groups = strings.groupBy("hash").agg(F.count("*").alias("strings"), F.ceil(size / shard_bytes).alias("parts"))
    groups = groups.filter("strings > 1").select("hash", "parts")
    buckets = groups.filter("parts > 1").agg(F.coalesce(F.sum("parts"), F.lit(0)).alias("n")).first().n
    candidates = strings.join(groups, "hash").select(
        "hash", F.pmod("digest_b", "parts").alias("part"), (F.col("parts") > 1).cast("long").alias("large"), "first.*"
    )
    judged = written(_sharded(_with_bytes(docs, candidates), shard_bytes, max(1, buckets)))
    inside = judged.filter("bucket is null").select("place", "begin", "end")
    return whole.unionAll(inside).unionAll(_across_shards(judged.filter("bucket is not null")))


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that overlap or touch made one."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    new = np.concatenate(([True], begins[1:] > ends[:-1])) if len(begins) else np.zeros(0, bool)
    last = np.concatenate((new[1:], [True])) if len(begins) else new
    return begins[new], ends[last]


def deduplicated(docs: DataFrame, keep: list[str], text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``keep``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the bytes that stay).

    Documents are told apart by a number that is written with their texts. Kept columns of those four names fail.
    """
    clash = {"n_bytes", "n_removed", "n_spans", "kept"}.intersection(c.lower() for c in keep)
    if clash:
        raise ValueError(f"kept columns with names of the result: {', '.join(sorted(clash))}")
    kept = [F.col(c).alias(f"k_{c}") for c in keep]
    placed = numbered(docs, *kept, F.col(text).alias("text"))
    spans = repeated_spans(placed.select("place", "text"), shard_bytes)
    spans = written(spans.distinct().groupBy("place").agg(F.collect_list(F.struct("begin", "end")).alias("spans")))
    rows = placed.join(spans, "place", "left").select("spans", "text", *[f"k_{c}" for c in keep])
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def remove(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, out, numbers = bytes_of(batch.column(1)), [], []
        for raw, spans in zip(texts, batch.column(0)):
            flat = spans.values
            begins, ends = merged(flat.field(0).to_numpy(), flat.field(1).to_numpy()) if flat is not None else ((), ())
            kept, at, removed = [], 0, 0
            for a, b in zip(begins, ends):
                kept.append(raw[at:a])
                removed, at = removed + int(b - a), int(b)
            out.append(b"".join([*kept, raw[at:]]))
            numbers.append((len(raw), removed, len(begins)))
        counts = [pa.array(c, pa.int64()) for c in zip(*numbers)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[2:], *counts, pa.array(out, pa.binary())],
            names=[*keep, "n_bytes", "n_removed", "n_spans", "kept"],
        )

    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep)
    return map_batches(rows, remove, schema + "n_bytes long, n_removed long, n_spans long, kept binary")
