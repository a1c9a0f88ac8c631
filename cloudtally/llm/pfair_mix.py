"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in an order mixed by a digest of their ids, are cut into blocks of ``BLOCK_DOCS``. The j-th block
of a source of target weight w is released at slot ``floor((j - 1) / w)`` and due by ``ceil(j / w)``; earliest deadline
first among released blocks meets every deadline, so after any number of slots each source is less than one block away
from its target weight. Weights are whole numbers of billionths of the largest one, so releases and deadlines are exact.

A run has as many slots as it takes to place all blocks. Its schedule is one, from the first slot to the last, but it is
worked out in stretches of ``PERIOD`` (10,000) slots side by side, or longer ones if a source's turns lie further apart: where
earliest deadline first stands after ``t`` slots follows from the weights alone (``_DONE``), and a fold goes on from
there, slot by slot. A weight below one slot of a stretch counts as one; a weight of zero gets no slot.

Each document keeps one place. When a source runs out, its slots stay empty and the others keep their proportions;
nothing is repeated or dropped: documents of weight zero (given, or by not being given) have null slots and come last.
``weights`` names the null source ``None``.
Without weights a source weighs the square root of its documents.

Numbers within a source come from a table sorted by source and digest and one row of counts per source and part of it,
so a source of any size is spread over many tasks. Null sources and ids count as a source, and as an id, of their own.
Repeated rows stay rows of their own. Columns other than id and source are not read, and kept columns may not have the
names of the result's. An empty table gives no rows. The work is sources times slots, a stretch a task; the slots are
blocks over weight of the source that is placed last, so a source that has most documents and little weight makes many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cloudtally.llm.common import numbered as with_places
from cloudtally.llm.common import written

BLOCK_DOCS = 16
PERIOD = 10_000
#: Tasks that the stretches of a run are spread over, at most.
MOST_TASKS = 10_000
#: The largest weight as a whole number.
FINE = 10**9

#: Whole blocks due by slot ``begin``, of each source; and the blocks that are released before it and due later, one of a
#: source at most, the last one due first.
_DUE = "transform(fine, w -> begin * w div total)"
_OPEN = """
reverse(array_sort(filter(transform(fine, (w, i) -> if(w > 0 and begin * w % total > 0,
    struct(((due[i] + 1) * total + w - 1) div w as due, i as i, due[i] * total div w as free), null)), x -> x is not null)))
"""
#: Slots in which the blocks released before slot ``s`` are more than ``s``: the least of each part between two releases.
_FREES = "array_sort(array_distinct(transform(open, x -> x.free)))"
_LEVELS = """
transform(frees, (free, k) -> array_min(transform(sequence(free + 1, coalesce(get(frees, k + 1), begin)),
    s -> aggregate(fine, -s, (sum, w) -> sum + (s * w + total - 1) div total))))
"""
#: Blocks done by slot ``begin``, of each source: all that are due, and of the open ones those that earliest deadline first has
#: had a slot for. Blocks are not held up by those that are due after them, so that ``t`` slots do the least, over all ``s``
#: up to ``t``, of ``t - s`` and the blocks of that deadline or an earlier one that are released before ``s``. An open block is
#: done if that number falls as it is taken away, after all those that are due later.
_DONE = """
aggregate(open, struct(levels as levels, 0L as least, cast(array() as array<int>) as ahead),
    (state, x) -> transform(array(transform(state.levels, (n, k) -> if(frees[k] >= x.free, n - 1, n))), levels -> struct(
        levels,
        least(state.least, array_min(levels)) as least,
        if(array_min(levels) < state.least, concat(state.ahead, array(x.i)), state.ahead) as ahead))[0],
    state -> transform(due, (n, i) -> if(array_contains(state.ahead, i), n + 1, n)))
"""
#: Earliest deadline first: slot by slot, the released block that is due first (ties: the first source).
_JOB = "struct({n} * total div {w} as free, (({n} + 1) * total + {w} - 1) div {w} as due, {i} as i, {n} as unit, {w} as w)"
_EDF = f"""
aggregate(sequence(begin, begin + slots - 1),
    struct(filter(transform(fine, (w, i) -> if(w > 0, {_JOB.format(n="done[i]", w="w", i="i")}, null)), x -> x is not null) as jobs,
           cast(array() as array<struct<i: int, unit: bigint>>) as picked),
    (state, slot) -> transform(array(array_min(transform(state.jobs, x -> if(x.free <= slot, struct(x.due, x.i, x.unit), null)))),
        pick -> struct(
            transform(state.jobs, x -> if(x.i = pick.i, {_JOB.format(n="(x.unit + 1)", w="x.w", i="x.i")}, x)) as jobs,
            concat(state.picked, array(struct(pick.i, pick.unit))) as picked))[0],
    state -> state.picked)
"""


def _key(source: str) -> F.Column:
    """A source as text that null has of its own."""
    return F.when(F.col(source).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(source).cast("string")))


def shares(
    counts: DataFrame, weights: dict[str | None, float] | None = None, block_docs: int = BLOCK_DOCS, period: int = PERIOD
) -> DataFrame:
    """One row, a written table: ``sources``, their ``blocks`` and weights ``fine`` of ``total``, and ``last``, the slots of the
    run, with ``slots``, those of a stretch. ``counts`` has ``key`` and ``n``."""
    if weights is None:
        weight = F.sqrt("n")
    elif any(w < 0 for w in weights.values()):
        raise ValueError("weights are not negative")
    elif weights:
        named = {"0" if name is None else "1" + name: float(w) for name, w in weights.items()}
        given = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
        weight = F.coalesce(given[F.col("key")], F.lit(0.0))
    else:
        weight = F.lit(1.0)
    blocks = F.expr(f"(n + {block_docs - 1}) div {block_docs}").alias("blocks")
    row = counts.select(F.struct("key", weight.alias("weight"), blocks).alias("s"))
    row = row.agg(F.array_sort(F.collect_list("s")).alias("s")).filter("exists(s, x -> x.weight > 0)")
    row = row.selectExpr("s", "array_max(transform(s, x -> x.weight)) as most")
    row = row.selectExpr("s", f"transform(s, x -> cast(round(x.weight / most * {FINE}) as bigint)) as fine")
    row = row.selectExpr("s", "fine", "aggregate(fine, 0L, (t, x) -> t + x) as total")
    least = f"total div {period} + 1"
    row = row.selectExpr("s", f"transform(fine, (w, i) -> if(s[i].weight > 0, greatest(w, {least}), 0L)) as fine")
    row = row.selectExpr("s", "fine", "aggregate(fine, 0L, (t, x) -> t + x) as total")
    last = "transform(fine, (w, i) -> if(w > 0, (s[i].blocks * cast(total as decimal(38,0)) + w - 1) div w, 0L))"
    each = "transform(fine, w -> if(w > 0, (total + w - 1) div w, 0L))"
    row = row.selectExpr("s", "fine", "total", f"cast(array_max({last}) as bigint) as last", f"array_max({each}) as longest")
    return written(row.selectExpr(
        "transform(s, x -> x.key) as sources", "transform(s, x -> x.blocks) as blocks", "fine", "total", "last",
        f"cast(least(last, greatest({period}L, longest)) as bigint) as slots",
    ))


def schedule(row: DataFrame, whole: bool = False) -> DataFrame:
    """``key``, ``unit`` (number of the source's block, from 0) and ``slot``: of the first stretch, or of the whole run.

    A whole run has the blocks that there are; the first stretch, the slots of sources that have run out as well.
    """
    if whole:
        counted = row.selectExpr("(last + slots - 1) div slots").first()
        rows = row.selectExpr("*", "explode(sequence(0L, last - 1, slots)) as begin")
        rows = rows.repartitionByRange(min(counted[0], MOST_TASKS) if counted else 1, "begin")
        rows = rows.withColumn("slots", F.expr("least(slots, last - begin)"))
    else:
        rows = row.withColumn("begin", F.lit(0).cast("long"))
    for name, value in {"due": _DUE, "open": _OPEN, "frees": _FREES, "levels": _LEVELS, "done": _DONE}.items():
        rows = rows.withColumn(name, F.expr(value))
    picked = rows.selectExpr("sources", "blocks", "begin", f"posexplode({_EDF}) as (at, pick)")
    slots = picked.selectExpr("sources[pick.i] as key", "pick.unit as unit", "begin + at as slot", "blocks[pick.i] as blocks")
    return (slots.filter("unit < blocks") if whole else slots).drop("blocks")


def numbered(docs: DataFrame, keep: list[str], doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """``keep``, ``key`` and ``number``: the document's place in its source, from 0. A written table underneath."""
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(*keep, _key(source).alias("key"), digest.alias("_digest"), F.col(doc_id).alias("_id"))
    rows = rows.repartitionByRange("key", "_digest", "_id").sortWithinPartitions("key", "_digest", "_id")
    rows = written(rows.drop("_digest", "_id").withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("part")
    counts = rows.groupBy("key", part).agg(F.min("_at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("key", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    rows = rows.withColumn("part", part).join(counts, ["key", "part"])
    return rows.withColumn("number", F.col("_at") + F.col("shift")).drop("_at", "part", "shift")


def mixed(
    docs: DataFrame,
    keep: list[str],
    weights: dict[str | None, float] | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    block_docs: int = BLOCK_DOCS,
    period: int = PERIOD,
) -> DataFrame:
    """``keep`` and each document's block and slot; the mix is the order of ``slot`` (nulls last) and ``place``.

    ``block`` counts a source's blocks from 0; ``release`` and ``deadline`` bound its slot: ``release <= slot <
    deadline``; ``place`` is the document's in the block.
    """
    clash = {"block", "place", "release", "deadline", "slot", "key", "number", "unit"}.intersection(map(str.lower, keep))
    if clash:
        raise ValueError(f"kept columns with names of the result: {', '.join(sorted(clash))}")
    rows = numbered(docs, keep, doc_id, source)
    row = shares(rows.groupBy("key").agg(F.count("*").alias("n")), weights, block_docs, period)
    slots = written(schedule(row, whole=True)).withColumnRenamed("unit", "block")
    rows = rows.withColumn("block", F.expr(f"number div {block_docs}")).withColumn("place", F.expr(f"number % {block_docs}"))
    own = row.selectExpr("total", "inline(arrays_zip(sources, fine))").withColumnRenamed("sources", "key").filter("fine > 0")
    rows = rows.join(own, "key", "left").join(slots, ["key", "block"], "left")
    return rows.select(
        *keep,
        "block",
        "place",
        F.expr("block * total div fine").alias("release"),
        F.expr("((block + 1) * total + fine - 1) div fine").alias("deadline"),
        "slot",
    )


def in_mixed_order(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    block_docs: int = BLOCK_DOCS,
    period: int = PERIOD,
) -> DataFrame:
    """``docs`` sorted by the mix: written as files, they hold it in the order of their names.

    Rows are told apart by a number that is written with them.
    """
    placed = with_places(docs, F.struct("*").alias("row")).withColumnRenamed("place", "_place")
    flat = placed.select("_place", F.col(f"row.{doc_id}").alias("_doc"), F.col(f"row.{source}").alias("_source"))
    order = mixed(flat, ["_place"], weights, "_doc", "_source", block_docs, period).select("_place", "slot", "place")
    rows = placed.join(order, "_place")
    by = F.col("slot").asc_nulls_last(), F.col("place")
    return rows.repartitionByRange(*by).sortWithinPartitions(*by).select("row.*")
