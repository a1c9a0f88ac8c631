"""Toxicity by a weighted finite-state pattern grammar over clauses.

*Symbols.* A text in lower case is words and clause breaks (stops, line ends, bars). Each word is one symbol: an insult
or a threat with a weight, a target (whom it is said to), a negation, a verb of report, a quotation mark, or other.

*Grammar.* Five transducers, each a table of arcs from a state and a symbol to a state and a symbol, are composed into
one: the insult transducer passes words of weight on; negation turns an insult within ``REACH`` words after it into a
negated one; reported speech turns all that follows in the clause, or stands in quotation marks, into reported; target
turns an insult that has a target within ``REACH`` words before it into an aimed one, and a target after an insult into
an aim; threat keeps a threat that has a target before or after it, and drops others. A clause break resets all.

*Clauses.* Running the composed table over a clause gives its matched symbols; the clause's score is the sum of their
words' weights times the factor of the symbol (``FACTORS``). Words outside of any match score nothing. A text's
features are its best clause, the sum of its clauses, that sum against its length, and the matches of each kind.

*Learning.* Insults' weights are learned from labelled texts: whole words, and stems of ``STEMS`` code points, whose
documents' log-odds between the labels, less ``SIGMAS`` standard errors, are over ``LEAST``; a word takes its best
entry. A short list of insults of four languages counts as known at ``KNOWN``, where the labels say nothing else. The
features' weights come from a logistic regression, held towards ``PRIOR``, on a quarter of the labelled texts whose
words were learned from the other three quarters. Both are fitted on a bounded sample of labelled rows: ``SAMPLE`` ids
of each label, expected, by a digest of the id, weighted back to all; copies of a text count once. The lexicon holds
``ENTRIES`` entries at most.

Null and empty texts have no symbols and get the score of a text without matches. Rows that repeat an id, or have none,
are rows of their own; an id with several labels has the largest; null labels and labels of no document are not
learned from. Without labels of both kinds the known insults and ``PRIOR`` decide. Only id and text are read, whole. An
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import map_batches, texts_of, written

REACH = 4
STEMS = range(4, 9)
LONGEST = 48
SIGMAS = 2.33
LEAST = 1.0
KNOWN = 3.0
SAMPLE = 10_000
ENTRIES = 20_000
FOLDS = 5

# Ordinary words of English, German, French and Spanish by what they do in a clause.
INSULTS = """idiot idiots moron morons imbecile imbeciles stupid dumb loser losers scum trash garbage pathetic worthless
disgusting clown clowns jerk vermin subhuman filth bastard bitch retard dummkopf trottel abschaum arschloch schwachkopf
crétin crétins abruti connard ordure salaud idiota idiotas imbécil estúpido estúpida basura escoria cabrón""".split()
THREATS = "kill hurt beat destroy shoot stab burn strangle töten umbringen verletzen tuer frapper matar golpear".split()
TARGETS = """you your yours u she him her they them du dich dir ihr euch sie tu te toi vous lui eux vos usted ustedes ti
ellos ellas""".split()
NEGATIONS = "not no never none nobody nicht kein keine nie niemals pas jamais aucun nunca ningún jamás".split()
REPORTS = """said says say told wrote writes claimed claims called calls quoted reported sagte sagt schrieb nannte dit
disait écrit appelé dijo dice escribió llamó""".split()

_TOKEN = re.compile("[^\\W\\d_]+(?:['’][^\\W\\d_]+)?|[.!?;:,|\n\"“”«»]")
_BREAKS = frozenset(".!?;:,|\n")
_QUOTES = frozenset('"“”«»')

#: What a symbol of a matched clause is worth, times the weight of its word.
FACTORS = {"insult": 1.0, "aimed": 1.5, "negated": 0.2, "reported": 0.4, "threatened": 1.5, "aim": 0.0}
SYMBOLS = ("other", "insult", "threat", "target", "negation", "report", "quote", "break")

Arcs = dict[tuple[int, str], tuple[int, str]]
Features = list[float]
#: Weights of the features where labels say nothing: bias, best clause, sum, density, and one for each kind of match.
PRIOR = np.array([-4.0, 0.6, 1.0, 0.5, 0.5, -0.2, -0.2, 0.5])
KINDS = ("aimed", "negated", "reported", "threatened")


@dataclass
class Transducer:
    """States, of which 0 is the first; symbols without an arc stay themselves and keep the state."""

    states: int
    arcs: Arcs = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs.get((state, symbol), (state, symbol))


def composed(first: Transducer, second: Transducer, symbols: Iterable[str]) -> Transducer:
    """What ``second`` makes of ``first``'s output, for these input symbols."""
    out = Transducer(first.states * second.states)
    for a, b, symbol in product(range(first.states), range(second.states), symbols):
        to_a, between = first.step(a, symbol)
        to_b, result = second.step(b, between)
        out.arcs[a * second.states + b, symbol] = (to_a * second.states + to_b, result)
    return out


def insult_transducer() -> Transducer:
    """Words of weight pass; nothing else is a match of its own."""
    return Transducer(1, {(0, s): (0, s) for s in SYMBOLS})


def negation_transducer() -> Transducer:
    """States count the words that a negation still reaches."""
    arcs: Arcs = {}
    for left in range(REACH + 1):
        arcs |= {(left, s): (max(0, left - 1), s) for s in SYMBOLS}
        arcs[left, "negation"] = REACH, "other"
        arcs[left, "break"] = 0, "break"
        if left:
            arcs[left, "insult"] = left - 1, "negated"
            arcs[left, "threat"] = left - 1, "negated"
    return Transducer(REACH + 1, arcs)


def report_transducer() -> Transducer:
    """State 1: reported up to the end of the clause or the closing quotation mark."""
    arcs: Arcs = {(1, s): (1, "reported") for s in ("insult", "threat")}
    arcs |= {(s, "report"): (1, "other") for s in (0, 1)} | {(s, "break"): (0, "break") for s in (0, 1)}
    return Transducer(2, arcs | {(0, "quote"): (1, "other"), (1, "quote"): (0, "other")})


def target_transducer() -> Transducer:
    """States 1 to ``REACH`` count the words that a target still reaches, those above it an insult before it."""
    arcs: Arcs = {}
    for state in range(2 * REACH + 1):
        down = 0 if state in (0, 1, REACH + 1) else state - 1
        arcs |= {(state, s): (down, s) for s in (*SYMBOLS, *FACTORS)}
        arcs[state, "break"] = 0, "break"
        aimed = 0 < state <= REACH
        arcs[state, "insult"] = (down, "aimed") if aimed else (2 * REACH, "insult")
        arcs[state, "threat"] = (down, "threatened") if aimed else (down, "threat")
        arcs[state, "target"] = REACH, "aim" if state > REACH else "target"
    return Transducer(2 * REACH + 1, arcs)


def threat_transducer() -> Transducer:
    """States count the words in which a threat still waits for its target."""
    arcs: Arcs = {}
    for left in range(REACH + 1):
        arcs |= {(left, s): (max(0, left - 1), s) for s in (*SYMBOLS, *FACTORS)}
        arcs[left, "threat"] = REACH, "other"
        arcs[left, "break"] = 0, "break"
        if left:
            arcs[left, "target"] = 0, "threatened"
    return Transducer(REACH + 1, arcs)


def grammar() -> Transducer:
    """The five transducers as one."""
    out = insult_transducer()
    for part in (negation_transducer(), report_transducer(), target_transducer(), threat_transducer()):
        out = composed(out, part, SYMBOLS)
    return out


def entries(word: str) -> list[str]:
    """What a word is looked up by: itself, and its stems (marked by a trailing dash)."""
    own = [word] if len(word) <= LONGEST else []
    return own + [word[:n] + "-" for n in STEMS if len(word) >= n]


@dataclass
class Model:
    """The lexicon's weights, and the weights of the features."""

    lexicon: dict[str, float]
    weights: np.ndarray

    def symbol(self, token: str) -> tuple[str, float]:
        if token in _BREAKS:
            return "break", 0.0
        if token in _QUOTES:
            return "quote", 0.0
        if token in _CLASSES:
            return _CLASSES[token], KNOWN
        if token.endswith(("n't", "n’t")):
            return "negation", 0.0
        weight = max((self.lexicon.get(e, 0.0) for e in entries(token)), default=0.0)
        return ("insult", weight) if weight else ("other", 0.0)

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -30, 30)))


_CLASSES = dict.fromkeys(THREATS, "threat") | dict.fromkeys(TARGETS, "target")
_CLASSES |= dict.fromkeys(NEGATIONS, "negation") | dict.fromkeys(REPORTS, "report")
_TABLE = grammar().arcs


def clause_score(clause: list[tuple[str, float]], matches: Counter[str]) -> float:
    """Score of one clause's symbols; its matches are counted by kind."""
    state, total = 0, 0.0
    for symbol, own in clause:
        state, result = _TABLE[state, symbol]
        if result in FACTORS:
            total += FACTORS[result] * (own or KNOWN)
            matches["aimed" if result == "aim" else result] += 1
    return total


def features_of(texts: list[str], model: Model) -> np.ndarray:
    """One row of features for each text."""
    known: dict[str, tuple[str, float]] = {}
    out = np.zeros((len(texts), len(PRIOR)))
    for row, text in zip(out, texts):
        tokens = _TOKEN.findall(text.lower())
        symbols = []
        for token in tokens:
            if token not in known:
                known[token] = model.symbol(token)
            symbols.append(known[token])
        best, total, low, matches = 0.0, 0.0, 0, Counter()
        hits = [i for i, (s, _) in enumerate(symbols) if s in ("insult", "threat")]
        for hit in hits:
            if hit < low:
                continue
            while hit > low and symbols[hit - 1][0] != "break":
                hit -= 1
            high = hit
            while high < len(symbols) and symbols[high][0] != "break":
                high += 1
            score = clause_score(symbols[hit:high], matches)
            best, total, low = max(best, score), total + score, high
        row[:4] = 1.0, np.log1p(best), np.log1p(total), np.log1p(100 * total / (len(tokens) + 10))
        row[4:] = [np.log1p(matches[kind]) for kind in KINDS]
    return out


def fitted(features: np.ndarray, labels: np.ndarray, weights: np.ndarray, pull: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps, held towards ``PRIOR``."""
    now = PRIOR.copy()
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(features @ now, -30, 30)))
        slope = features.T @ (weights * (chance - labels)) + pull * (now - PRIOR)
        curve = (features * (weights * chance * (1 - chance))[:, None]).T @ features + pull * np.eye(len(now))
        step = np.linalg.solve(curve, slope)
        now = now - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return now


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo ``FOLDS``; null for no id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _sampled(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, sample: int) -> DataFrame:
    """``toxic``, ``fold``, ``weight``, ``text`` of sampled labelled texts; each text once a label. A written table."""
    known = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("id")).agg((F.max(label) > 0).cast("int").alias("toxic"))
    known = known.withColumn("fold", fold(F.col("id"))).filter("fold != 0")
    counts = known.groupBy("toxic").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), F.lit(float(sample)) / F.col("n"))
    chosen = known.join(counts, "toxic").filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20))
    # Two times ``sample`` rows are expected, of a few bytes each.
    chosen = F.broadcast(chosen.select("id", "toxic", "fold", (1 / share).alias("weight")))
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("text")).join(chosen, "id")
    return written(rows.withColumn("digest", F.md5(F.col("text").cast("binary"))).dropDuplicates(["digest", "toxic"]))


def _entry_counts(sample: DataFrame) -> DataFrame:
    """``entry``, and the documents that hold it: toxic and clean ones, of the folds learned from first and of all."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        toxic, folds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        counts: Counter[tuple[str, int, bool]] = Counter()
        for text, label, number in zip(texts_of(batch.column(2)), toxic, folds):
            held = set()
            for word in set(_TOKEN.findall(text.lower())):
                held.update(entries(word))
            counts.update((e, label, number == FOLDS - 1) for e in held)
        columns = [pa.array(c) for c in zip(*((*key, n) for key, n in counts.items()))] if counts else []
        names = ["entry", "toxic", "last", "n"]
        kinds = [pa.string(), pa.int32(), pa.bool_(), pa.int64()]
        columns = [c.cast(k) for c, k in zip(columns, kinds)] or [pa.array([], k) for k in kinds]
        return pa.RecordBatch.from_arrays(columns, names=names)

    rows = map_batches(sample.select("toxic", "fold", "text"), count, "entry string, toxic int, last boolean, n long")

    def total(toxic: int, first_only: bool) -> Column:
        counted = (F.col("toxic") == toxic) & (~F.col("last") if first_only else F.lit(True))
        return F.sum(F.when(counted, F.col("n")).otherwise(0))

    return rows.groupBy("entry").agg(
        total(1, True).alias("toxic_first"),
        total(0, True).alias("clean_first"),
        total(1, False).alias("toxic_all"),
        total(0, False).alias("clean_all"),
    )


def _lexicon(counts: DataFrame, toxic: str, clean: str, totals: tuple[int, int]) -> dict[str, float]:
    """Weights of the entries that tell the labels apart, the surest first, ``ENTRIES`` at most; and known insults."""
    a, b = F.col(toxic) + 0.5, F.col(clean) + 0.5
    odds = F.log(a / (totals[0] + 1)) - F.log(b / (totals[1] + 1))
    sure = odds - SIGMAS * F.sqrt(1 / a + 1 / b)
    rows = counts.select("entry", odds.alias("odds"), sure.alias("sure")).filter(F.col("sure") > LEAST)
    # A bounded lexicon: the sort by (sure, entry) keeps it the same in every run.
    found = {r.entry: r.odds for r in rows.orderBy(F.desc("sure"), "entry").limit(ENTRIES).collect()}
    against = {r.entry for r in counts.filter(F.col("entry").isin(INSULTS) & (odds < 0) & (b > 10)).collect()}
    return {w: KNOWN for w in INSULTS if w not in against} | found


def _with_features(sample: DataFrame, model: Model) -> DataFrame:
    names = [f"x{i}" for i in range(len(PRIOR))]

    def compute(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = features_of(texts_of(batch.column(2)), model)
        columns = [*batch.columns[:2], *(pa.array(c) for c in found.T)]
        return pa.RecordBatch.from_arrays(columns, names=["toxic", "weight", *names])

    schema = "toxic int, weight double, " + ", ".join(f"{n} double" for n in names)
    return map_batches(sample.select("toxic", "weight", "text"), compute, schema)


def learned(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = SAMPLE,
) -> Model:
    """The model of the labelled rows outside of fold 0."""
    rows = _sampled(docs, labels, doc_id, text, label, sample)
    n = {(r.toxic, r.last): r.n for r in rows.groupBy("toxic", (F.col("fold") == FOLDS - 1).alias("last")).agg(
        F.count("*").alias("n")).collect()}
    first = n.get((1, False), 0), n.get((0, False), 0)
    whole = first[0] + n.get((1, True), 0), first[1] + n.get((0, True), 0)
    if not all(whole):
        return Model(dict.fromkeys(INSULTS, KNOWN), PRIOR)
    counts = written(_entry_counts(rows).filter("toxic_all > 0 or clean_all > 10"))
    early = Model(_lexicon(counts, "toxic_first", "clean_first", first), PRIOR)
    # At most the sample's rows of one fold, of a few numbers each.
    held = _with_features(rows.filter(F.col("fold") == FOLDS - 1), early).toPandas().to_numpy(float)
    weights = fitted(held[:, 2:], held[:, 0], held[:, 1] / max(1.0, held[:, 1].min(initial=1.0)))
    return Model(_lexicon(counts, "toxic_all", "clean_all", whole), weights)


def scored(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` (of other names than ``score``) and ``score``, from 0 to 1."""
    if "score" in keep:
        raise ValueError("a kept column may not be called score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def compute(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = shared.value.score(features_of(texts_of(batch.column(len(keep))), shared.value))
        return pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(found)], names=[*keep, "score"])

    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep) + "score double"
    return map_batches(docs.select(*keep, text), compute, schema)


def matches(texts: list[str], model: Model) -> Iterator[list[tuple[str, str]]]:
    """For each text its matched words with their symbols, clause by clause: what a score rests on."""
    for text in texts:
        found, state = [], 0
        for token in _TOKEN.findall(text.lower()):
            state, result = _TABLE[state, model.symbol(token)[0]]
            if result in FACTORS:
                found.append((token, result))
        yield found
