"""Scores of texts by a hidden Markov language model that Baum-Welch trains on the corpus.

A text's tokens are its words (runs of bytes that are not ASCII white space, A-Z in lower case) and one end. The model
is trained on documents whose CRC-32 of the id as text (null: empty) is not a multiple of ``HELD_OUT``.

*Symbols.* The most frequent words of at most ``HEAD_BYTES`` bytes, up to ``HEAD_WORDS``, and the end are symbols of their own;
other words are ``CLASSES`` symbols by their last three bytes, and within its class a word has probability
(c + 0.1) / (n + 0.1 * (v + 1)), n and v being the class's tokens and distinct words. So the head bounds what is
broadcast, carries the words that any join would be skewed by, and the rest of the vocabulary, whatever its size, is
joined as a table.

*Training.* ``STATES`` hidden states. In each of ``ROUNDS`` rounds, tasks run the scaled forward and backward recursions
over whole texts, add up expected counts in blocks of symbols, and blocks are summed over the partitions by a shuffle;
every training token takes part in every round.

*Scores.* The scaled forward recursion over whole texts gives the exact probability of the symbol sequence; the words of
classes add theirs. ``base_score`` is the unigram score: the sum of log10((c + 0.1) / (N + 0.1 * (V + 1))).

Null and empty texts have the end alone. Rows that repeat an id, or have none, are scored each; rows are told apart by
their place, so the table must read alike twice. Other columns are not read. An empty table gives no rows; with no
training documents all counts are zero.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import bounded_batches, bytes_of, map_batches, written

HELD_OUT = 10
HEAD_WORDS = 1 << 17
HEAD_BYTES = 48
#: Words join the head by whole steps of frequency, so many to a doubling.
FREQUENCY_STEPS = 32
CLASSES = 64
STATES = 8
ROUNDS = 4
#: Tokens that the recursions of training run over at a time.
PACKED = 1 << 20
BLOCK = 1024
#: Distinct words that a task counts before it hands them on.
COUNTED_WORDS = 500_000


def tokens_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


@dataclass
class Model:
    """Probabilities as arrays: ``first`` (states), ``moves`` (states x states), ``emits`` (symbols x states)."""

    first: np.ndarray
    moves: np.ndarray
    emits: np.ndarray


def started(symbols: np.ndarray, states: int = STATES) -> Model:
    """A model to begin with: symbol frequencies, tilted at random for each state; states that rarely change."""
    rng = np.random.default_rng(len(symbols))
    weights = (symbols + 0.5)[:, None] * rng.gamma(1.0, 1.0, (len(symbols), states))
    moves = np.full((states, states), 0.02 / max(1, states - 1))
    np.fill_diagonal(moves, 0.98)
    return Model(np.full(states, 1 / states), moves, (weights / weights.sum(0)).astype(np.float32))


def refitted(first: np.ndarray, moves: np.ndarray, emits: np.ndarray, symbols: np.ndarray) -> Model:
    """Probabilities from expected counts, smoothed towards the symbols' own frequencies."""
    prior = (symbols + 0.5) / (symbols + 0.5).sum()
    weights = emits + 20.0 * prior[:, None]
    return Model(
        (first + 1) / (first + 1).sum(),
        (moves + 0.1) / (moves + 0.1).sum(1, keepdims=True),
        (weights / weights.sum(0)).astype(np.float32),
    )


@dataclass
class Packed:
    """Sequences side by side, longest first: symbols time by time, and how many sequences are left at each time."""

    symbols: np.ndarray
    live: np.ndarray


def segments(sequences: list[np.ndarray], size: int = PACKED) -> Iterator[Packed]:
    """Whole sequences packed, those of like length together: ``size`` tokens a block, more if one is longer."""
    ordered = sorted((s for s in sequences if len(s)), key=len, reverse=True)
    lengths = np.array([len(s) for s in ordered], np.int64)
    block = (np.cumsum(lengths) - lengths) // size
    edges = [*np.flatnonzero(np.diff(block, prepend=-1)).tolist(), len(ordered)]
    for low, high in zip(edges, edges[1:]):
        some = lengths[low:high]
        live = np.searchsorted(-some, -np.arange(some[0]), side="left")
        time = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
        symbols = np.empty(len(time), np.int32)
        symbols[(np.cumsum(live) - live)[time] + np.repeat(np.arange(len(some)), some)] = np.concatenate(ordered[low:high])
        yield Packed(symbols, live)


def expected(model: Model, block: Packed, emitted: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Counts of first states and moves, and the log-likelihood, of packed sequences.

    Adds counts of symbols by state to ``emitted``.
    """
    live = block.live.tolist()
    begins = (np.cumsum(block.live) - block.live).tolist()
    moves, first = model.moves.astype(np.float32), model.first.astype(np.float32)
    back, ones = np.ascontiguousarray(moves.T), np.ones(len(first), np.float32)
    seen = model.emits[block.symbols]
    alpha, scale = np.empty_like(seen), np.empty(len(seen), np.float32)
    before = 0
    for a, n in zip(begins, live):
        now = (alpha[before : before + n] @ moves if a else first) * seen[a : a + n]
        total = np.matmul(now, ones, out=scale[a : a + n])
        np.divide(now, total[:, None], out=alpha[a : a + n])
        before = a
    seen /= scale[:, None]
    beta = np.ones_like(seen)
    counted = np.zeros(moves.shape)
    for t in range(len(live) - 1, 0, -1):
        a, n, before = begins[t], live[t], begins[t - 1]
        right = seen[a : a + n] * beta[a : a + n]
        counted += alpha[before : before + n].T @ right
        np.matmul(right, back, out=beta[before : before + n])
    alpha *= beta
    alpha /= (alpha @ ones)[:, None]
    for state in range(len(first)):
        emitted[:, state] += np.bincount(block.symbols, weights=alpha[:, state], minlength=len(emitted))
    return alpha[: live[0]].sum(0).astype(float), counted * moves, float(np.log(scale).sum(dtype=np.float64))


def log10_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Exact log10 probabilities of whole sequences by the scaled forward recursion, longest first, side by side."""
    out = np.zeros(len(sequences))
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    for low in range(0, len(order), 4096):
        some = order[low : low + 4096]
        lengths = np.array([len(sequences[i]) for i in some])
        flat = np.concatenate([sequences[i] for i in some])
        begins = np.cumsum(lengths) - lengths
        emits, moves = model.emits.astype(np.float64), model.moves
        now, total = None, np.zeros(len(some))
        for t in range(int(lengths[0]) if len(lengths) else 0):
            live = int(np.searchsorted(-lengths, -t, side="left"))  # sequences longer than t
            seen = emits[flat[begins[:live] + t]]
            now = seen * model.first if t == 0 else (now[:live] @ moves) * seen
            scale = now.sum(1)
            now /= scale[:, None]
            total[:live] += np.log10(scale)
        out[some] = total
    return out


def held_out(doc_id: str) -> Column:
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % HELD_OUT == 0


def vocabulary(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word`` and ``n``, how often documents have it. Tasks count their words before the shuffle."""

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
        )

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for raw in bytes_of(batch.column(0)):
                counts.update(tokens_of(raw))
                if len(counts) > COUNTED_WORDS:
                    yield batch_of(counts)
                    counts = Counter()
        if counts:
            yield batch_of(counts)

    bounded_batches(docs.sparkSession)
    return docs.select(text).mapInArrow(over, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Words:
    """What training documents have: totals, the head's words and counts, and the classes' tokens and words."""

    documents: int
    tokens: int
    distinct: int
    head: list[bytes]
    counts: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray

    @property
    def symbols(self) -> np.ndarray:
        """Training tokens by symbol: head words, the end, classes."""
        return np.concatenate((self.counts, [self.documents], self.class_tokens)).astype(float)

    @property
    def denominator(self) -> float:
        return self.tokens + 0.1 * (self.distinct + 1)


def counted(words: DataFrame, documents: int, head_words: int = HEAD_WORDS) -> Words:
    """Totals of a vocabulary. The driver gets ``head_words`` rows at most, one for each class and step of frequency."""
    total = words.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    short, step = F.length("word") <= HEAD_BYTES, F.floor(F.log2("n") * FREQUENCY_STEPS)
    steps = words.filter(short).groupBy(step.alias("step")).count().orderBy(F.col("step").desc()).collect()
    least, size = None, 0
    for number, n in steps:
        if size + n > head_words:
            break
        least, size = number, size + n
    in_head = short & (step >= F.lit(least)) if least is not None else F.lit(False)
    head = words.filter(in_head).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    names, counts = head.column("word").to_pylist(), head.column("n").to_numpy().astype(np.int64)
    rest = words.filter(~in_head)
    ending = F.expr("substring(word, greatest(length(word) - 2, 1), 3)")
    by_class = rest.groupBy((F.crc32(ending) % CLASSES).alias("c")).agg(F.sum("n"), F.count("*")).collect()
    tokens, distinct = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for number, n, v in by_class:
        tokens[number], distinct[number] = n, v
    return Words(documents, total.n + documents, total.v + bool(documents), names, counts, tokens, distinct)


def encoded(docs: DataFrame, words: Words, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, ``n_tokens``, ``symbols`` of the whole text, and its words of classes: ``tail`` (word, class, n)."""
    name, shared = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(words.head)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        look, end = _head(name, shared).get, len(shared.value)
        symbols, sizes, tail_sizes = [], [], []
        tail_words, tail_classes, tail_counts = [], [], []
        for raw in bytes_of(batch.column(len(keep))):
            tokens = tokens_of(raw)
            found = list(map(look, tokens))
            if None in found:
                tail = Counter([word for word, symbol in zip(tokens, found) if symbol is None])
                classes = {word: word_class(word) for word in tail}
                found = [end + 1 + classes[w] if s is None else s for w, s in zip(tokens, found)]
                tail_words += tail
                tail_classes += classes.values()
                tail_counts += tail.values()
                tail_sizes.append(len(tail))
            else:
                tail_sizes.append(0)
            found.append(end)
            symbols.append(np.array(found, np.int32))
            sizes.append(len(found))
        columns = (tail_words, pa.binary()), (tail_classes, pa.int32()), (tail_counts, pa.int64())
        fields = [pa.array(values, kind) for values, kind in columns]

        def offsets(counts: list[int]) -> pa.Array:
            return pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))

        return pa.RecordBatch.from_arrays(
            [
                *batch.columns[: len(keep)],
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(offsets(sizes), pa.array(np.concatenate(symbols))),
                pa.ListArray.from_arrays(offsets(tail_sizes), pa.StructArray.from_arrays(fields, ["word", "class", "n"])),
            ],
            names=[*keep, "n_tokens", "symbols", "tail"],
        )

    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep)
    schema += "n_tokens long, symbols array<int>, tail array<struct<word:binary,class:int,n:bigint>>"
    return map_batches(docs.select(*keep, text), encode, schema)


_HEADS: dict[str, dict[bytes, int]] = {}


def _head(name: str, shared: Broadcast) -> dict[bytes, int]:
    """The head's symbols; a worker keeps the last."""
    if name not in _HEADS:
        _HEADS.clear()
        _HEADS[name] = {word: i for i, word in enumerate(shared.value)}
    return _HEADS[name]


def _sequences(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[list[pa.RecordBatch], list[np.ndarray]]]:
    """Batches with the symbols of their rows, together up to some millions of tokens."""
    some, found, size = [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column(column)
        at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        some.append(batch)
        found += [values[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        size += int(at[-1] - at[0])
        if size > 2_000_000:
            yield some, found
            some, found, size = [], [], 0
    if some:
        yield some, found


def _round(rows: DataFrame, model: Model, symbols: np.ndarray) -> Model:
    """One round of Baum-Welch over ``symbols`` of all rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    total, states = len(symbols), len(model.first)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emitted = np.zeros((-(-total // BLOCK) * BLOCK, states))
        rest = np.zeros((states + 1, states))
        for _, found in _sequences(batches, 0):
            for block in segments(found):
                first, moves, _ = expected(shared.value, block, emitted)
                rest[0] += first
                rest[1:] += moves
        numbers, counts = [-1], [rest.astype(np.float32).tobytes()]
        for number in range(len(emitted) // BLOCK):
            part = emitted[number * BLOCK : (number + 1) * BLOCK]
            if part.any():
                numbers.append(number)
                counts.append(part.astype(np.float32).tobytes())
        columns = [pa.array(numbers, pa.int32()), pa.array(counts, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = np.frombuffer(counts, np.float32)
                if number in sums:
                    sums[number] += values
                else:
                    sums[number] = values.astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                names=["block", "counts"],
            )

    schema = "block int, counts binary"
    sums = rows.select("symbols").mapInArrow(count, schema).repartition("block").mapInArrow(add, schema).toArrow()
    emitted = np.zeros((-(-total // BLOCK) * BLOCK, states))
    rest = np.zeros((states + 1, states))
    for number, counts in zip(sums.column(0).to_pylist(), sums.column(1).to_pylist()):
        values = np.frombuffer(counts).reshape(-1, states)
        if number < 0:
            rest = values
        else:
            emitted[number * BLOCK : (number + 1) * BLOCK] = values
    shared.unpersist()
    return refitted(rest[0], rest[1:], emitted[:total], symbols)


def trained(rows: DataFrame, words: Words, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """A model of the sequences ``symbols``."""
    model = started(words.symbols, states)
    for _ in range(rounds):
        model = _round(rows, model, words.symbols)
    return model


def _symbol_scores(rows: DataFrame, model: Model, words: Words, keep: list[str]) -> DataFrame:
    """``keep``, the probability of the symbols, and what head words and the end add to the base score."""
    counts = words.symbols[: len(words.head) + 1]
    base = np.concatenate((np.log10((counts + 0.1) / words.denominator), np.zeros(CLASSES)))
    known = np.concatenate((counts > 0, np.zeros(CLASSES, bool)))
    shared = rows.sparkSession.sparkContext.broadcast((model, base, known))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, base, known = shared.value
        for some, found in _sequences(batches, len(keep)):
            scores = log10_likelihoods(model, found)
            bases = np.array([base[s].sum() for s in found])
            knowns = np.array([known[s].sum() for s in found], np.int64)
            table = pa.Table.from_batches(some).select(list(range(len(keep))))
            for name, values in (("hidden", scores), ("base", bases), ("known", knowns)):
                table = table.append_column(name, pa.array(values))
            yield from table.to_batches()

    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep) + "hidden double, base double, known long"
    return rows.select(*keep, "symbols").mapInArrow(over, schema)


def scored(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    head_words: int = HEAD_WORDS,
    states: int = STATES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    placed = docs.select(
        F.monotonically_increasing_id().alias("place"),
        F.col(doc_id).alias("id"),
        held_out(doc_id).alias("held_out"),
        F.col(text).alias("text"),
    )
    training = placed.filter("not held_out")
    vocabulary_ = written(vocabulary(training))
    words = counted(vocabulary_, training.select("place").count(), head_words)
    rows = written(encoded(placed, words, ["place", "id", "held_out"]))
    model = trained(rows.filter("not held_out"), words, states, rounds)
    scores = _symbol_scores(rows, model, words, ["place", "id", "held_out", "n_tokens"])

    tail = rows.select("place", F.explode("tail").alias("t")).select("place", "t.*")
    seen = tail.join(vocabulary_.withColumnRenamed("n", "c"), "word", "left")
    c = F.coalesce("c", F.lit(0))
    denominators = words.class_tokens + 0.1 * (words.class_words + 1)
    of_class = F.element_at(F.array(*[F.lit(float(d)) for d in denominators]), F.col("class") + 1)
    tail = seen.groupBy("place").agg(
        F.sum(F.col("n") * F.log10((c + 0.1) / F.lit(float(words.denominator)))).alias("tail_base"),
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("n") * F.log10((c + 0.1) / of_class)).alias("tail_score"),
    )
    both = scores.join(tail, "place", "left")
    zero = F.lit(0)
    return both.select(
        F.col("id").alias("doc_id"),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("tail_known", zero)).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", zero)).alias("base_score"),
        (F.col("hidden") + F.coalesce("tail_score", zero)).alias("score"),
    )
