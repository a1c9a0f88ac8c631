"""SimHash near-duplicates: links between fingerprints that differ in few bits.

A text's words are runs of bytes that are not ASCII white space, A-Z in lower case; its shingles are runs of three
words, repeats included (fewer words: the whole sequence; none: fingerprint zero). A fingerprint bit is set if it is
set in over half of the shingles' XXH64 values (seed 42). Null and empty texts have fingerprint zero and link like any
other.

Finding pairs at ``MAX_BITS`` (3) or fewer differing bits without comparing all:

* *Embedding.* The 64 bits are 32 segments of two bits; a fingerprint maps to the vector of its segments' bit counts.
  The Manhattan distance of two such vectors is never more than the number of differing bits.
* *Grid.* Of two halves of 16 segments, one differs by at most one in Manhattan distance. The counts of a half are its
  grid cell. Each fingerprint looks into its own cell, and into those where one count is greater by one (a pair one
  apart is found from the lower side): a range join, with an equality on the cell that Spark can shuffle by.
* *Verify.* Joined pairs are held against the Manhattan distance of the whole vectors, then the exact number of bits.

Only distinct fingerprints take part; documents of one fingerprint are linked through it. Rows with the same id or no
id are rows of their own. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import bytes_of, map_batches, numbered, written
from cloudtally.llm.graph import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a text in UTF-8."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    values = np.array([digest(s, SEED) for s in shingles], np.uint64)
    total, ones = len(values), np.zeros(64, np.int64)
    for low in range(0, total, 1 << 14):
        part = values[low : low + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """The columns ``keep`` and ``fp``, a signed long with the fingerprint's bits."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def compute(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(t, words) for t in bytes_of(batch.column(len(keep)))], np.uint64)
        columns = [*batch.columns[: len(keep)], pa.array(values.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=[*keep, "fp"])

    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep) + "fp long"
    return map_batches(docs.select(*keep, text), compute, schema)


_ODD = 0x5555555555555555


def _counts(fp: Column) -> Column:
    """The embedding: bit counts of 32 segments, each in two bits and unary (0: 00, 1: 01, 2: 11)."""
    other, odd = F.shiftrightunsigned(fp, 1), F.lit(_ODD)
    both = fp.bitwiseAND(other).bitwiseAND(odd)
    return fp.bitwiseOR(other).bitwiseAND(odd).bitwiseOR(F.shiftleft(both, 1))


def _manhattan(a: Column, b: Column) -> Column:
    """Sum of the differences of all segments' counts: in unary, the bits that differ."""
    return F.bit_count(a.bitwiseXOR(b))


def _one_more(cell: Column, segment: int) -> Column:
    """The cell in which a segment's count is greater by one; null if it is two."""
    count = F.shiftrightunsigned(cell, 2 * segment).bitwiseAND(F.lit(3))
    return F.when(count < 3, cell.bitwiseOR(F.shiftleft(count + 1, 2 * segment)))


def links(fps: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of the distinct values ``fp`` at ``MAX_BITS`` or fewer differing bits; each once."""
    half = F.lit((1 << 32) - 1)
    cells = fps.select("fp", _counts(F.col("fp")).alias("v"))
    halves = F.array(F.col("v").bitwiseAND(half), F.shiftrightunsigned("v", 32))
    cells = cells.select("fp", "v", F.posexplode(halves).alias("side", "cell"))
    ups = [_one_more(F.col("cell"), i) for i in range(16)]
    looks = F.filter(F.array(F.col("cell"), *ups), lambda c: c.isNotNull())
    probes = cells.select(
        F.col("fp").alias("p"), F.col("v").alias("w"), "side", F.col("cell").alias("home"), F.explode(looks).alias("cell")
    )
    pairs = cells.join(probes, ["side", "cell"])
    differ = F.col("fp").bitwiseXOR(F.col("p"))
    near = (_manhattan(F.col("v"), F.col("w")) <= MAX_BITS) & (F.bit_count(differ) <= MAX_BITS)
    once = (F.col("home") != F.col("cell")) | (F.col("p") < F.col("fp"))
    found = pairs.filter(once & near)
    return found.select(F.least("fp", "p").alias("a"), F.greatest("fp", "p").alias("b")).distinct()


def linked(
    docs: DataFrame,
    keep: list[str],
    text: str = "text",
    words: int = SHINGLE_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, groups)``: the columns ``keep`` and ``fp`` of each document, and for each ``fp`` its ``root``.

    ``root`` is the same for all fingerprints that links connect. Both are written tables.
    """
    rows = written(fingerprints(docs, keep, text, words))
    distinct = rows.select("fp").distinct()
    connected = components(written(links(distinct)))
    connected = connected.select(F.col("node").alias("fp"), F.col("component").alias("root"))
    groups = distinct.join(connected, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return rows, written(groups)


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
) -> DataFrame:
    """``(doc_id, fp, component_id)``: for each document the smallest id that links reach from it, its own included."""
    rows, groups = linked(docs, [doc_id], text, words)
    first = rows.groupBy("fp").agg(F.min(doc_id).alias("first")).join(groups, "fp")
    least = first.groupBy("root").agg(F.min("first").alias("component_id"))
    named = first.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(F.col(doc_id).alias("doc_id"), "fp", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id (none: last; ties: the first written).

    Rows are told apart by a number that is written with them.
    """
    placed = numbered(docs, F.struct("*").alias("row")).withColumnRenamed("place", "_place")
    flat = placed.select("_place", F.col(f"row.{doc_id}").alias("_id"), F.col(f"row.{text}").alias("_text"))
    rows, groups = linked(flat, ["_place", "_id"], "_text", words)
    order = F.struct(F.col("_id").isNull(), "_id", "_place")
    first = rows.groupBy("fp").agg(F.min(order).alias("first")).join(groups, "fp")
    least = first.groupBy("root").agg(F.min("first").alias("least")).select("root", F.col("least._place").alias("stays"))
    named = groups.join(least, "root").select("fp", "stays")
    dropped = rows.join(named, "fp").filter("_place != stays").select("_place")
    return placed.join(written(dropped), "_place", "left_anti").select("row.*")
