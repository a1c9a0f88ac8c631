import math
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from cloudtally.llm import hidden_markov
from cloudtally.llm.queries import op9_hidden_markov

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base(docs):
    """The contract's columns, worked out the long way."""
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in docs}
    counts = Counter()
    for i, text in docs.items():
        if not held[i]:
            counts.update([*tokens_of(text), None])
    total, distinct = sum(counts.values()), len(counts)
    out = {}
    for i, text in docs.items():
        tokens = [*tokens_of(text), None]
        score = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        out[i] = (held[i], len(tokens), sum(counts[t] > 0 for t in tokens), total, score)
    return out


def a_model(states=3, symbols=5, seed=0):
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (x := rng.random(shape)) / x.sum(-1, keepdims=True)
    return hidden_markov.Model(draw(states), draw(states, states), draw(states, symbols).T.astype(np.float32))


def by_paths(model, symbols):
    """Sum over all paths of hidden states: probability, and expected counts times it."""
    total, first = 0.0, np.zeros(3)
    moves, emits = np.zeros((3, 3)), np.zeros((5, 3))
    for path in product(range(3), repeat=len(symbols)):
        p = model.first[path[0]]
        for t, s in enumerate(symbols):
            p *= model.emits[s, path[t]] * (model.moves[path[t - 1], path[t]] if t else 1)
        total += p
        first[path[0]] += p
        for t, s in enumerate(symbols):
            emits[s, path[t]] += p
            if t:
                moves[path[t - 1], path[t]] += p
    return total, first, moves, emits


def test_recursions_against_all_paths():
    model = a_model()
    sequences = [np.array(s) for s in ([0], [1, 2, 3], [4, 4, 0, 1, 2, 2], [3, 0], [2, 2, 2, 2, 2])]
    paths = [by_paths(model, s) for s in sequences]
    assert hidden_markov.log10_likelihoods(model, sequences) == pytest.approx([math.log10(p[0]) for p in paths], rel=1e-6)
    emitted, first, moves, score = np.zeros((5, 3)), 0, 0, 0
    for block in hidden_markov.segments(sequences):
        a, b, c = hidden_markov.expected(model, block, emitted)
        first, moves, score = first + a, moves + b, score + c
    assert score == pytest.approx(sum(math.log(p[0]) for p in paths), rel=1e-5)
    for got, number in ((first, 1), (moves, 2), (emitted, 3)):
        assert got == pytest.approx(sum(p[number] / p[0] for p in paths), rel=1e-4)


def test_long_texts_are_one_sequence():
    """A text of several thousand tokens has one first state, and all its moves count."""
    model, rng = a_model(), np.random.default_rng(1)
    sequences = [rng.integers(0, 5, n) for n in (3000, 129, 1, 700, 128)]
    first, moves, emits, score = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)), 0.0
    for symbols in sequences:
        alpha, beta = np.zeros((len(symbols), 3)), np.ones((len(symbols), 3))
        for t, s in enumerate(symbols):
            alpha[t] = (alpha[t - 1] @ model.moves if t else model.first) * model.emits[s]
            score += math.log(alpha[t].sum())
            alpha[t] /= alpha[t].sum()
        for t in range(len(symbols) - 1, 0, -1):
            right = model.emits[symbols[t]] * beta[t]
            pair = alpha[t - 1][:, None] * model.moves * right
            moves += pair / pair.sum()
            beta[t - 1] = model.moves @ right
            beta[t - 1] /= beta[t - 1].sum()
        gamma = alpha * beta
        gamma /= gamma.sum(1, keepdims=True)
        first += gamma[0]
        np.add.at(emits, symbols, gamma)
    for size in (100, 1000, hidden_markov.PACKED):
        emitted, found = np.zeros((5, 3)), [0, 0, 0]
        for block in hidden_markov.segments(sequences, size):
            found = [a + b for a, b in zip(found, hidden_markov.expected(model, block, emitted))]
        for got, want in zip((*found, emitted), (first, moves, score, emits)):
            assert got == pytest.approx(want, rel=1e-3)
    assert list(hidden_markov.segments([])) == []


def test_symbols_sum_to_one():
    model = a_model()
    total = sum(10 ** hidden_markov.log10_likelihoods(model, [np.array(s) for s in product(range(5), repeat=4)]))
    assert total == pytest.approx(1, rel=1e-6)


@pytest.mark.parametrize("head", [hidden_markov.HEAD_WORDS, 300])
def test_query(spark, head):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    if head == hidden_markov.HEAD_WORDS:
        rows = op9_hidden_markov(spark, SF_DIR).collect()
    else:
        rows = hidden_markov.scored(spark.read.parquet(f"{SF_DIR}/documents.parquet"), head_words=head).collect()
    want = base(docs)
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4], rel=1e-9)
        assert r.score < 0
    held = [r for r in rows if r.held_out]
    if head == 300:  # the model knows more than the frequencies of words
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_against_a_forward_pass_of_its_own(spark, monkeypatch):
    """End to end: the trained model and the counted words give each score by a plain recursion, word by word."""
    kept = {}
    for name in ("trained", "counted"):
        plain = getattr(hidden_markov, name)
        monkeypatch.setattr(hidden_markov, name, lambda *a, plain=plain, name=name, **o: kept.setdefault(name, plain(*a, **o)))
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = {r.doc_id: r.score for r in hidden_markov.scored(table, head_words=300, rounds=2).collect()}
    model, words = kept["trained"], kept["counted"]
    docs = {r.doc_id: r.text for r in table.collect()}
    counts = Counter(t for i, x in docs.items() if zlib.crc32(str(i).encode()) % 10 for t in tokens_of(x))
    place = {w.decode(): i for i, w in enumerate(words.head)}
    assert 200 < len(place) <= 300 and np.allclose(model.emits.sum(0), 1, atol=1e-3)
    assert np.allclose(model.moves.sum(1), 1) and np.allclose(model.first.sum(), 1)
    for i, text in docs.items():
        score, alpha = 0.0, None
        for token in [*tokens_of(text), None]:
            symbol = place.get(token, len(place)) if token is None or token in place else None
            if symbol is None:
                number = zlib.crc32(token.encode()[-3:]) % hidden_markov.CLASSES
                symbol = len(place) + 1 + number
                share = (counts[token] + 0.1) / (words.class_tokens[number] + 0.1 * (words.class_words[number] + 1))
                score += math.log10(share)
            now = (alpha @ model.moves if alpha is not None else model.first) * model.emits[symbol].astype(float)
            score, alpha = score + math.log10(now.sum()), now / now.sum()
        assert got[i] == pytest.approx(score, rel=1e-6)


def test_odd_documents(spark, odd_docs, no_docs):
    rows = hidden_markov.scored(odd_docs, rounds=1, states=2).collect()
    assert len(rows) == odd_docs.count()
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    assert all(r.n_tokens == len(tokens_of(texts[r.doc_id])) + 1 for r in rows if r.doc_id is not None)
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert hidden_markov.scored(no_docs, rounds=1).count() == 0
    held = hidden_markov.scored(spark.createDataFrame([(None, "all held out")], "doc_id long, text string")).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in held] == [(4, 0, 0)]
