"""Hard-negative mining by a secondary-sort shuffle.

Anchors are a stated set of rows. A row's score is its integer inner product with the anchor; higher scores come first,
ties by smaller id. An anchor's positives are its first rows of the same label; a positive of score ``p`` opens the
window of scores ``s`` with ``low * p <= 100 * s <= high * p``, and its negatives are the first rows of other labels in
that window.

*Blocks.* Anchors are written to files of at most ``ANCHOR_BLOCK`` rows; each file is one block, and a pass over the
rows scores all of them against it, so what is broadcast has a bound whatever the number of anchors. A task scores
chunks of at most ``CHUNK_ROWS`` rows and ``CHUNK_BYTES`` of components. Of a chunk only rows that can still count
leave the task: the first ``positives`` rows of an anchor's label, then the first ``negatives`` rows of each window.

*Secondary sort.* What leaves is one packed key of 29 bytes: anchor (id and number), descending score, kind (positives
before negatives), id. Keys are dealt out by anchor and sorted within partitions by
``repartitionAndSortWithinPartitions``. One iterator goes over a partition's keys: positives open their windows,
negatives are emitted to the open windows they fall into, and a full window closes. It holds an anchor's open windows,
never its rows. The first pass finds the positives in the same way, the second one the negatives.

Rows without an id or a label, and rows whose vector is null or has a component that is null, NaN or infinite, take no
part. Components are scaled and rounded down to longs (beyond a long: the nearest one); sums beyond a long wrap. Of
vectors of unlike lengths the missing components are zero; empty vectors score zero. Rows that repeat an id are rows of
their own, as candidates and as anchors; an anchor is never paired with a row of its own id. Other columns are not read.
An empty table, or one without anchors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import bounded_batches, shared_folder, written

ANCHOR_BLOCK = 16384
CHUNK_ROWS = 16384
CHUNK_BYTES = 1 << 25
#: Anchors that a chunk is scored against at a time.
SLICE = 64

_KEY = np.dtype([("anchor", ">u8"), ("number", ">u4"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
_NONE = np.iinfo(np.int64).min
_PAIR = "number long, anchor_id long, place int, positive_id long, positive_score long"
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _ordered(values: np.ndarray) -> np.ndarray:
    """Longs as unsigned numbers of the same order."""
    return values.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)


def packed(anchor: np.ndarray, number: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> np.ndarray:
    """Keys whose bytes sort by anchor, descending score, kind and id."""
    keys = np.empty(len(ids), _KEY)
    keys["anchor"], keys["number"], keys["kind"] = _ordered(anchor), number, kind
    keys["score"], keys["id"] = ~_ordered(score), _ordered(ids)
    return keys


def unpacked(key: bytes) -> tuple[int, int, int, int, int]:
    """``(anchor, number, score, kind, id)`` of a key."""
    anchor, number, score, kind, row = np.frombuffer(key, _KEY)[0].tolist()
    return anchor - (1 << 63), number, (1 << 63) - 1 - score, kind, row - (1 << 63)


def quantised(lists: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Integer components of all vectors as one array, and each vector's length."""
    lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    scaled = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    whole = np.clip(scaled, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
    whole[scaled >= 2.0**63] = np.iinfo(np.int64).max
    return whole, lengths


def matrix(values: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Vectors as rows of ``width`` components; missing ones are zero."""
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` with all rows of ``b``; by floats where they are exact."""
    most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0))
    if most * max(1, a.shape[1]) < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _usable(vectors: DataFrame, vec_id: str, label: str, embedding: str) -> DataFrame:
    finite = F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    whole = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(embedding).isNotNull() & finite
    columns = F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label")
    return vectors.filter(whole).select(*columns, F.col(embedding).cast("array<double>").alias("vector"))


def _chunks(batches: Iterable[pa.RecordBatch], scale: float) -> Iterator[tuple[np.ndarray, ...]]:
    """``(ids, labels, components, lengths)`` of chunks in the order of ids."""
    parts, rows, size = [], 0, 0

    def joined() -> tuple[np.ndarray, ...]:
        ids, labels, values, lengths = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(ids, kind="stable")
        starts = (np.cumsum(lengths) - lengths)[order]
        moved = np.repeat(starts - (np.cumsum(lengths[order]) - lengths[order]), lengths[order]) + np.arange(len(values))
        return ids[order], labels[order], values[moved], lengths[order]

    for batch in batches:
        values, lengths = quantised(batch.column(2), scale)
        if parts and (rows + batch.num_rows > CHUNK_ROWS or size + values.nbytes > CHUNK_BYTES):
            yield joined()
            parts, rows, size = [], 0, 0
        if batch.num_rows:
            parts.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), values, lengths))
            rows, size = rows + batch.num_rows, size + values.nbytes
    if parts:
        yield joined()


Choice = Callable[[dict[str, np.ndarray], slice, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _keys(rows: DataFrame, block: dict[str, np.ndarray], scale: float, kind: int, choose: Choice) -> DataFrame:
    """Packed keys (``key``) of the anchors and rows that ``choose`` picks from each chunk and slice of a block."""
    shared = rows.sparkSession.sparkContext.broadcast(block)
    bounded_batches(rows.sparkSession)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        for ids, labels, values, lengths in _chunks(batches, scale):
            width = int(max(lengths.max(), anchors["lengths"].max()))
            left = matrix(anchors["values"], anchors["lengths"], width)
            right = matrix(values, lengths, width)
            for low in range(0, len(left), SLICE):
                part = slice(low, low + SLICE)
                scores = products(left[part], right)
                at, row = choose(anchors, part, ids, labels, scores)
                keys = packed(anchors["ids"][part][at], low + at, scores[at, row], kind, ids[row])
                yield _batch(keys)

    return rows.mapInArrow(over, "key binary")


def _batch(keys: np.ndarray) -> pa.RecordBatch:
    flat = pa.py_buffer(keys.tobytes())
    column = pa.FixedSizeBinaryArray.from_buffers(pa.binary(_KEY.itemsize), len(keys), [None, flat])
    return pa.RecordBatch.from_arrays([column.cast(pa.binary())], names=["key"])


def _best_first(scores: np.ndarray, taken: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor the order of its taken rows by score (equal ones as they come), and the ordered scores."""
    masked = np.where(taken, scores, _NONE)
    order = np.argsort(~masked, axis=1, kind="stable")
    return order, np.take_along_axis(masked, order, axis=1)


def _same_label(positives: int) -> Choice:
    """The first rows of an anchor's label."""

    def choose(anchors, part, ids, labels, scores):  # noqa: ANN001, ANN202  (a Choice)
        taken = (anchors["labels"][part][:, None] == labels) & (anchors["ids"][part][:, None] != ids)
        order, _ = _best_first(scores, taken)
        order = order[:, :positives]
        at, place = np.nonzero(np.take_along_axis(taken, order, axis=1))
        return at, order[at, place]

    return choose


def _in_windows(negatives: int) -> Choice:
    """The first rows of other labels in each window of an anchor."""

    def choose(anchors, part, ids, labels, scores):  # noqa: ANN001, ANN202  (a Choice)
        taken = (anchors["labels"][part][:, None] != labels) & (anchors["ids"][part][:, None] != ids)
        order, ordered = _best_first(scores, taken)
        chosen = np.zeros(scores.shape, bool)
        for least, most in zip(anchors["least"][part].T, anchors["most"][part].T):
            places = (ordered > most[:, None]).sum(axis=1)[:, None] + np.arange(negatives)
            there = places < scores.shape[1]
            rows = np.take_along_axis(order, np.where(there, places, 0), axis=1)
            there &= np.take_along_axis(taken, rows, axis=1)
            there &= np.take_along_axis(scores, rows, axis=1) >= least[:, None]
            at, place = np.nonzero(there)
            chosen[at, rows[at, place]] = True
        return np.nonzero(chosen)

    return choose


def _sorted_by_anchor(keys: DataFrame) -> RDD:
    """An RDD of the keys, dealt out by anchor and sorted within partitions."""
    partitions = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = keys.rdd.map(lambda row: (bytes(row[0]), None))
    return pairs.repartitionAndSortWithinPartitions(partitions, lambda key: crc32(key[:12]))


def first_positives(keys: Iterable[bytes], most: int) -> Iterator[tuple]:
    """Of sorted keys, each anchor's first ``most``: ``(number, anchor_id, place, positive_id, positive_score)``."""
    for _, run in groupby(keys, key=lambda k: k[:12]):
        for place, key in zip(range(most), run):
            anchor, number, score, _, row = unpacked(key)
            yield number, anchor, place, row, score


def opened_windows(keys: Iterable[bytes], most: int, low: int, high: int) -> Iterator[tuple]:
    """Of sorted keys, each positive's first ``most`` negatives, as rows of the result."""
    for _, run in groupby(keys, key=lambda k: k[:12]):
        windows: list[list[int]] = []
        for key in run:
            anchor, _, score, kind, row = unpacked(key)
            if kind == 0:
                windows.append([row, score, 0])
                continue
            for window in windows:
                positive, over, rank = window
                if rank < most and low * over <= 100 * score <= high * over:
                    window[2] = rank + 1
                    yield anchor, positive, rank + 1, row, over, score
            # Scores only fall from here on: a window that is full, or whose least score is passed, is done.
            windows = [w for w in windows if w[2] < most and low * w[1] <= 100 * score]


def mined(
    vectors: DataFrame,
    anchors: Column,
    vec_id: str = "vec_id",
    label: str = "label",
    embedding: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
    block_rows: int = ANCHOR_BLOCK,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.

    ``anchors`` is a condition on ``vectors``; ``low`` and ``high`` are percentages of a positive's score, at most 100:
    the rows of a window come after its positive.
    """
    if not 0 <= low <= high <= 100:
        raise ValueError("windows lie between 0 and 100 percent of a positive's score")
    spark = vectors.sparkSession
    rows = _usable(vectors, vec_id, label, embedding)
    asked = _usable(vectors.filter(anchors), vec_id, label, embedding)
    blocks = -(-asked.count() // block_rows)
    folder = shared_folder(spark)
    if not blocks:
        return spark.createDataFrame([], _RESULT)
    listed = written(asked.repartition(blocks), maxRecordsPerFile=str(block_rows))
    for path in sorted(listed.inputFiles()):
        block = _block(spark.read.schema(listed.schema).parquet(path), scale)
        if len(block["ids"]):
            found = _of_block(rows, block, scale, positives, negatives, low, high)
            found.write.mode("append").parquet(folder)
    return spark.read.schema(_RESULT).parquet(folder)


def _block(part: DataFrame, scale: float) -> dict[str, np.ndarray]:
    """One written file of anchors, which holds at most a block's rows."""
    table = part.toArrow()
    values, lengths = quantised(table.column("vector").combine_chunks(), scale)
    ids, labels = table.column("id").to_numpy(), table.column("label").to_numpy()
    return {"ids": ids, "labels": labels, "values": values, "lengths": lengths}


def _of_block(
    rows: DataFrame, block: dict[str, np.ndarray], scale: float, positives: int, negatives: int, low: int, high: int
) -> DataFrame:
    """The result for one block of anchors: a pass for the positives, then one for the negatives."""
    spark, total = rows.sparkSession, len(block["ids"])
    keys = _sorted_by_anchor(_keys(rows, block, scale, 0, _same_label(positives)))
    opened = keys.mapPartitions(lambda run: first_positives((k for k, _ in run), positives))
    opened = written(spark.createDataFrame(opened, _PAIR))
    # A window that no positive opens is empty.
    least, most = np.full((total, positives), 1, np.int64), np.zeros((total, positives), np.int64)
    for number, _, place, _, score in opened.toPandas().itertuples(index=False):
        least[number, place], most[number, place] = -(-low * score // 100), high * score // 100

    def as_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, anchor, row, score = (batch.column(i).to_numpy() for i in range(4))
            yield _batch(packed(anchor, number, score, 0, row))

    first = opened.select("number", "anchor_id", "positive_id", "positive_score").mapInArrow(as_keys, "key binary")
    both = first.unionAll(_keys(rows, block | {"least": least, "most": most}, scale, 1, _in_windows(negatives)))
    found = _sorted_by_anchor(both).mapPartitions(lambda run: opened_windows((k for k, _ in run), negatives, low, high))
    return spark.createDataFrame(found, _RESULT)
