r"""Secrets in texts: fixed patterns, and strings that two character Markov models call random.

*Patterns* (``base_spans``): an assignment of six characters or more to a name for a secret, an access key id, a run of
24 hex digits or more. Matches of one kind are leftmost and do not overlap.

*Models.* Both are chains over the characters ``A-Za-z0-9+/_=-``, one state for all others, trained on labelled samples
of ``SAMPLES`` strings each, the same in every run (``labelled_counts``): random strings over the alphabets of
``RANDOM_ALPHABETS``; and identifiers, which are names, words and paths of ``identifiers.txt`` alone, joined by
``_``, ``-``, ``/`` or capitals, with numbers, dates and versions, and characters that repeat. No text of the corpus
takes part, so undetected secrets do not. Part of the random model is uniform, so strings over other alphabets count as
random too. ``trained(pair_counts(docs))`` gives models of what the patterns find in a corpus and leave of it instead.

*Scan.* A run of ``MIN_CHARS`` (20) of these characters or more that overlaps no pattern match is a span of kind
``random`` if its log-likelihood ratio of the two models is over ``MIN_RATIO`` a character, whatever its characters.
Shorter runs are left to the patterns.

Offsets are code points, end exclusive. Null and empty texts have no spans. Rows that repeat an id, or have none, are
scanned each; all columns of a document go along in ``row``. An empty table gives no rows.
"""

from __future__ import annotations

import random
import re
import string
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import bytes_of, map_batches

KINDS = ["assign", "access", "hex", "random"]
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
_NAMES = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(rb"[0-9a-f]{24,}")
_ASSIGN_CHARS = 6

ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(ALPHABET) + 1
#: Share of the random model that is uniform; how many pairs the characters' own frequencies weigh in each state of the
#: ordinary model, and the count that each character begins with.
UNIFORM, BACK_OFF, PSEUDO = 0.2, 5.0, 0.1
MIN_CHARS = 20
MIN_RATIO = 1.0
SAMPLES = 20_000
SAMPLE_SEED = 4
RANDOM_ALPHABETS = [
    string.digits + "abcdef",
    string.digits + "ABCDEF",
    string.ascii_lowercase,
    string.ascii_uppercase,
    string.ascii_uppercase + "234567",
    string.ascii_lowercase + string.digits,
    string.ascii_letters,
    string.ascii_letters + string.digits,
    string.ascii_letters + string.digits + "+/",
    string.ascii_letters + string.digits + "-_",
]
_RUN = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % MIN_CHARS)

_STATE = np.zeros(256, np.int64)
_STATE[np.frombuffer(ALPHABET, np.uint8)] = np.arange(1, STATES)

Span = tuple[int, int, int]


def base_spans(raw: bytes) -> list[Span]:
    """``(begin, end, kind)`` of the patterns in a text in UTF-8, in bytes, by begin and kind."""
    found = []
    lower = raw.lower()
    if any(name in lower for name in _NAMES):
        found += [(*m.span(), 0) for m in _ASSIGN.finditer(raw) if len(m[2]) >= _ASSIGN_CHARS]
    found += [(*m.span(), 1) for m in _ACCESS.finditer(raw)]
    found += [(*m.span(), 2) for m in _HEX.finditer(raw)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def _pairs(raw: bytes) -> np.ndarray:
    """Counts of neighbouring states; a text begins and ends in state 0."""
    states = np.concatenate(([0], _STATE[np.frombuffer(raw, np.uint8)], [0]))
    return np.bincount(states[:-1] * STATES + states[1:], minlength=STATES * STATES)


def _secret_parts(raw: bytes, spans: list[Span]) -> bytes:
    """What the patterns found, one to a line; of an assignment the value."""
    values = []
    for begin, end, kind in spans:
        values.append(_ASSIGN.fullmatch(raw[begin:end])[2] if kind == 0 else raw[begin:end])
    return b"\n".join(values)


def pair_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Pair counts over all documents: 0 ordinary text, 1 secrets. Shape: 2, states, states."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = np.zeros((2, STATES * STATES), np.int64)
        ordinary, size = [], 0
        for raw in bytes_of(batch.column(0)):
            if spans := base_spans(raw):
                counts[1] += _pairs(_secret_parts(raw, spans))
                at, rest = 0, []
                for begin, end, _ in spans:
                    rest.append(raw[at:begin])
                    at = max(at, end)
                raw = b"\n".join([*rest, raw[at:]])
            ordinary.append(raw)
            size += len(raw)
            if size > 1 << 20:
                counts[0] += _pairs(b"\n".join(ordinary))
                ordinary, size = [], 0
        counts[0] += _pairs(b"\n".join(ordinary))
        label, pair = np.nonzero(counts)
        arrays = [pa.array(label), pa.array(pair), pa.array(counts[label, pair])]
        return pa.RecordBatch.from_arrays(arrays, names=["label", "pair", "n"])

    rows = map_batches(docs.select(text), count, "label long, pair long, n long")
    out = np.zeros((2, STATES * STATES))
    for label, pair, n in rows.groupBy("label", "pair").agg(F.sum("n")).collect():  # 2 * STATES ** 2 rows at most
        out[label, pair] = n
    return out.reshape(2, STATES, STATES)


def identifier_names() -> list[str]:
    """Names, words and paths of the bundled sample."""
    lines = Path(__file__).with_name("identifiers.txt").read_text().splitlines()
    return [line for line in lines if not line.startswith("#")]


def _number(rng: random.Random) -> str:
    year = rng.randint(1990, 2039)
    return rng.choice([
        str(rng.randint(0, 9)),
        str(rng.randint(10, 99)),
        str(rng.randint(100, 99999)),
        str(year),
        f"{year}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}",
        f"v{rng.randint(1, 20)}",
    ])


def identifier(names: list[str], rng: random.Random) -> str:
    """A name alone, several joined by a mark, most of them with a number, or several joined by capitals."""
    kind, parts = rng.random(), [rng.choice(names) for _ in range(rng.randint(2, 4))]
    if kind < 0.5:
        return parts[0]
    if kind < 0.6:
        return "".join(p.strip("_").capitalize() for p in parts)
    if kind < 0.9:
        parts.insert(rng.randint(1, len(parts)), _number(rng))
    return rng.choice("_-/").join(parts)


@lru_cache
def labelled_counts() -> np.ndarray:
    """Pair counts of the labelled samples: 0 identifiers, 1 random strings. Shape: 2, states, states."""
    rng, names = random.Random(SAMPLE_SEED), identifier_names()
    ordinary = [identifier(names, rng) for _ in range(SAMPLES)]
    ordinary += [chr(c) * n for c in ALPHABET for n in range(8, 64, 2)]
    drawn = [rng.choices(RANDOM_ALPHABETS[i % len(RANDOM_ALPHABETS)], k=rng.randint(20, 64)) for i in range(SAMPLES)]
    samples = "\n".join(ordinary), "\n".join(map("".join, drawn))
    return np.array([_pairs(s.encode()) for s in samples], float).reshape(2, STATES, STATES)


@dataclass
class Models:
    """``ratio[a, b]``: log of how much likelier b follows a in a random string than in ordinary ones."""

    ratio: np.ndarray

    def per_character(self, run: bytes) -> float:
        states = np.concatenate(([0], _STATE[np.frombuffer(run, np.uint8)]))
        return float(self.ratio[states[:-1], states[1:]].sum()) / len(run)


def trained(counts: np.ndarray) -> Models:
    alone = counts[0].sum(0) + PSEUDO
    ordinary = counts[0] + BACK_OFF * alone / alone.sum()
    ordinary = ordinary / ordinary.sum(1, keepdims=True)
    totals = counts[1].sum(1, keepdims=True)
    seen = np.divide(counts[1], totals, out=np.full_like(counts[1], 1 / STATES), where=totals > 0)
    return Models(np.log((1 - UNIFORM) * seen + UNIFORM / STATES) - np.log(ordinary))


def random_spans(raw: bytes, base: list[Span], models: Models) -> list[Span]:
    """Spans that the models call random, away from ``base``."""
    out = []
    for match in _RUN.finditer(raw):
        begin, end = match.span()
        run = match[0]
        if any(a < end and begin < b for a, b, _ in base):
            continue
        if models.per_character(run) > MIN_RATIO:
            out.append((begin, end, 3))
    return out


def code_points(raw: bytes, spans: list[Span]) -> list[Span]:
    """Spans in bytes as spans in code points."""
    if not spans or raw.isascii():
        return spans
    before = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    return [(int(before[a]), int(before[b]), kind) for a, b, kind in spans]


def scanned(docs: DataFrame, models: Models | None = None, text: str = "text") -> DataFrame:
    """``row`` and ``spans``: all spans by begin and kind, those of patterns and models alike."""
    models = models or trained(labelled_counts())
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("_text"))
    span = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for raw in bytes_of(batch.column(1)):
            base = base_spans(raw)
            spans = sorted(base + random_spans(raw, base, models), key=lambda s: (s[0], s[2]))
            out.append([{"kind": KINDS[k], "begin": a, "end": b} for a, b, k in code_points(raw, spans)])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, span)], names=["row", "spans"])

    schema = f"row {rows.schema['row'].dataType.simpleString()}, spans array<struct<kind:string,begin:bigint,end:bigint>>"
    return map_batches(rows, scan, schema)


def joined(spans):
    """A column of spans as ``kind:begin:end``, by comma."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")
