"""Quality rules as a bitmask ledger.

Each document is measured once. A ledger row holds the measurements and ``fail_bits``, one bit per rule that fails.
A policy is a versioned set of rules, that is a mask: applying one, or asking what a rule alone costs, is arithmetic
on the bits of the stored ledger and reads no text.

Words are runs of bytes that are not ASCII white space (space, tab to carriage return). Null text has no words, so it
fails ``few_words``. An empty table gives an empty ledger. Rows that share an id are judged each on its own. All columns
of a document go along in ``row``, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import bytes_of, map_batches, written

SYMBOLS = b"#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters"]


def _repeat_words(words: list[bytes]) -> int:
    """Words in windows of three words that are found twice or more, the first included."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + 3 - max(at, end)
            end = at + 3
    return covered


_DROP_ASCII_SPACE = b" \t\n\r\x0b\x0c"
_CONTINUATION = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))


def _count(text: bytes, members: bytes) -> int:
    return len(text) - len(text.translate(None, members))


def measures(text: bytes) -> tuple[int, ...]:
    """The columns of ``MEASURES`` for one text in UTF-8."""
    words = text.split()
    upper = _count(text, _UPPER)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        len(text.translate(None, _DROP_ASCII_SPACE + _CONTINUATION)),
        _count(text, SYMBOLS),
        len(lines) - len(set(lines)),
        _repeat_words(words),
        len(lines),
        upper,
        upper + _count(text, _LOWER),
    )


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the document as it came) and its measurements: the only pass over texts, with no shuffle."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("_text"))

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = zip(*map(measures, bytes_of(batch.column(1))))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], names=["row", *MEASURES]
        )

    schema = f"row {rows.schema['row'].dataType.simpleString()}, " + ", ".join(f"{m} long" for m in MEASURES)
    return map_batches(rows, measure, schema)


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL condition on the measurements; ``bit`` never changes its meaning."""

    name: str
    bit: int
    fails: str


RULES = [
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > n_words AND n_symbols >= 20"),
    Rule("duplicate_lines", 3, "n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule("upper_case", 4, "n_letters >= 100 AND 100 * n_upper > 60 * n_letters"),
    Rule("word_length", 5, "word_chars > 20 * n_words OR word_chars < 2 * n_words"),
]
#: Policies by version; a version once used is not edited.
POLICIES = {
    "base-1": ["few_words", "repeated_words"],
    "web-1": ["few_words", "repeated_words", "symbols"],
    "web-2": ["few_words", "repeated_words", "symbols", "duplicate_lines", "upper_case", "word_length"],
}


def ledger(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """``row``, measurements and ``fail_bits`` of each document."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in rules]
    return measured(docs, text).withColumn("fail_bits", reduce(Column.bitwiseOR, bits, F.lit(0).cast("long")))


def stored(docs: DataFrame, keep: list[str], rules: list[Rule] = RULES, text: str = "text", folder: str | None = None) -> DataFrame:
    """The ledger without its texts, written to ``folder`` (none given: the shared one): ``row`` holds the columns
    ``keep``. Policies and ablations read it, pruned to their columns, as often as they like."""
    rows = ledger(docs, rules, text)
    row = F.struct(*[F.col(f"row.{c}").alias(c) for c in keep]).alias("row")
    return written(rows.select(row, *MEASURES, "fail_bits"), folder)


def mask_of(policy: list[str], rules: list[Rule] = RULES) -> int:
    bits = {r.name: r.bit for r in rules}
    return sum(1 << bits[name] for name in set(policy))


def failed(policy: list[str], rules: list[Rule] = RULES) -> Column:
    """Whether a ledger row fails any rule of the policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask_of(policy, rules))) != 0


def ablation(rows: DataFrame, policy: list[str], rules: list[Rule] = RULES) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail it alone, and that stay without it.

    The ledger is first counted by its bits under the policy's mask, of which there are at most two to the power of
    the rules, before and after the shuffle; rules are then read off those few rows. ``any_bits`` is the OR of all.
    """
    mask = mask_of(policy, rules)
    own = [r for r in rules if r.name in policy]
    counts = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    listed = [F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in own]
    each = counts.withColumn("r", F.explode(F.array(*listed))).select("bits", "n", "r.*")
    rest = F.col("bits").bitwiseAND(F.lit(mask) - F.col("bit"))
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return each.groupBy("rule").agg(
        total(fails).alias("n_failed"),
        total(fails & (rest == 0)).alias("n_failed_alone"),
        total(rest == 0).alias("n_kept_without"),
        F.bit_or("bits").alias("any_bits"),
    )
