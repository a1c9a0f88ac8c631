r"""Line dedup by winnowing: later copies of runs of lines go.

Texts are split at line ends; lines of white space alone (space, tab to carriage return) neither match nor break a run
and always stay. A *window* starts at each line: the shortest run of lines from there that has ``WINDOW`` (3) lines or
``BYTES`` (200) bytes of UTF-8, so one long line is a window, or two.

*Winnow.* In each window in turn, the line of the least hash (of equal ones the last) is a fingerprint of the text. Any
run that two places share, and that holds a window, has the same fingerprint in both: fingerprints are counted over all
texts, and only windows whose fingerprint occurs twice or more go on.

*Join.* Positions of fingerprints are joined, by the hashes of the window around them, with the first place that has
them (least id, then place in the table, then line). The window that stands there is the original; all others match it.

*Extend.* A match goes on both ways as long as the lines before and after are those of the original. Within a run, the
lines next to a window begin or end windows of the same run, but for two lines at either end: these are compared one by
one. All lines of a match go, and lines that touch form one run. So a run goes with all its lines, if it has three lines
or 200 bytes; a line that goes stands at an earlier place too, and the first copy of any line stays.

Texts without a window lose none. Null texts are empty. Rows that repeat an id, or have none (null comes
first), are told apart by a number that is written with their texts; repeated rows count as copies. Other columns
are not read. An empty table gives no rows. All of it is DataFrame code; a window that many texts share is a minimum
that combines before the shuffle and a join that AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import numbered, written

WINDOW = 3
BYTES = 200
_WORD = r"[^\\x20\\x09-\\x0D]"


def _lines(rows: DataFrame) -> DataFrame:
    """Adds ``lines`` and ``filled``: numbers of the lines that are not blank."""
    rows = rows.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    filled = f"filter(transform(lines, (l, i) -> if(l rlike '{_WORD}', i, null)), i -> i is not null)"
    return rows.withColumn("filled", F.expr(filled))


def windows(rows: DataFrame) -> DataFrame:
    """One row per window: ``id``, ``place``, ``at``, ``size`` (lines), its fingerprint (``pick``: hash and line), two
    hashes of its lines, and the hashes of the two lines before (``l1`` next to it) and after."""
    each = "transform(filled, i -> struct(xxhash64(lines[i]) as hash, octet_length(lines[i]) as size))"
    hashed = _lines(rows).select("id", "place", F.expr(each).alias("f"))
    hashed = hashed.select("id", "place", F.col("f.hash").alias("h"), F.col("f.size").alias("c"))
    size = f"""case when c[at] >= {BYTES} then 1 when c[at] + get(c, at + 1) >= {BYTES} then 2
        when at + {WINDOW} <= size(h) then {WINDOW} end"""
    starts = "if(size(h) > 0, sequence(0, size(h) - 1), cast(array() as array<int>))"
    sized = f"filter(transform({starts}, at -> struct(at, {size} as size)), w -> w.size is not null)"
    found = F.expr(f"""
        transform({sized}, w -> struct(
            w.at, w.size,
            array_min(transform(slice(h, w.at + 1, w.size), (x, k) -> struct(x as hash, -(w.at + k) as before))) as pick,
            xxhash64(slice(h, w.at + 1, w.size)) as one,
            hash(slice(h, w.at + 1, w.size)) as two,
            get(h, w.at - 1) as l1, get(h, w.at - 2) as l2,
            get(h, w.at + w.size) as r1, get(h, w.at + w.size + 1) as r2))
    """)
    # A filter on the arrays, which Spark adds before a plain explode, would work them out a second time.
    return hashed.select("id", "place", F.explode_outer(found).alias("w")).filter("w is not null").select("id", "place", "w.*")


def later_runs(rows: DataFrame) -> DataFrame:
    """``place``, ``begin``, ``end`` of matches: windows that stand in an earlier place too, extended both ways."""
    found = written(windows(rows))
    prints = found.select("place", "pick.hash", "pick.before").distinct()
    repeated = prints.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash")
    found = found.withColumn("hash", F.col("pick.hash")).join(repeated, "hash", "left_semi")
    here, key = F.struct("id", "place", "at"), ["hash", "one", "two", "size"]
    around = F.struct("id", "place", "at", "l1", "l2", "r1", "r2")
    first = found.groupBy(*key).agg(F.min(around).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    same = found.join(first, key).filter(~here.eqNullSafe(F.struct("first.id", "first.place", "first.at")))

    def further(side: str) -> F.Column:
        one = F.col(f"{side}1") == F.col(f"first.{side}1")
        return F.when(one & (F.col(f"{side}2") == F.col(f"first.{side}2")), 2).when(one, 1).otherwise(0)

    begin, end = F.col("at") - further("l"), F.col("at") + F.col("size") + further("r")
    return same.select("place", begin.alias("begin"), end.alias("end")).distinct()


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_removed``, ``n_runs``, ``kept`` (the text that stays)."""
    rows = numbered(docs, F.col(doc_id).alias("id"), F.col(text).alias("text"))
    later = later_runs(rows).groupBy("place").agg(F.collect_list(F.struct("begin", "end")).alias("runs"))
    both = _lines(rows.join(later, "place", "left"))
    both = both.withColumn("gone", F.expr("array_distinct(flatten(transform(coalesce(runs, array()), r -> sequence(r.begin, r.end - 1))))"))
    kept = "array_except(sequence(0, size(lines) - 1), transform(gone, p -> filled[p]))"
    return both.selectExpr(
        "id as doc_id",
        "cast(size(lines) as bigint) as n_lines",
        "cast(size(gone) as bigint) as n_removed",
        "cast(size(array_except(gone, transform(gone, p -> p + 1))) as bigint) as n_runs",
        f"array_join(transform({kept}, i -> lines[i]), '\\n') as kept",
    )
