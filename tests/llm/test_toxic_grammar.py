import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cloudtally.llm import toxic_grammar as tg
from cloudtally.llm.queries import op11_toxic_grammar

KNOWN = tg.Model(dict.fromkeys(tg.INSULTS, tg.KNOWN), tg.PRIOR)


def found(text):
    return next(tg.matches([text], KNOWN))


def score(text, model=KNOWN):
    return float(model.score(tg.features_of([text], model))[0])


def test_clauses():
    assert found("What an idiot") == [("idiot", "insult")]
    assert found("you are an idiot") == [("idiot", "aimed")]
    assert found("idiot, you there") == [("idiot", "insult")]
    assert found("idiot that you are") == [("idiot", "insult"), ("you", "aim")]
    assert found("he is not an idiot") == [("idiot", "negated")]
    assert found("he isn't stupid") == [("stupid", "negated")]
    assert found("not far from the old town lives an idiot") == [("idiot", "insult")]
    assert found("no, idiot") == [("idiot", "insult")]
    assert found("the paper called him a clown") == [("clown", "reported")]
    assert found('a "moron" here') == [("moron", "reported")]
    assert found("she said so. A moron") == [("moron", "insult")]
    assert found("we will kill you") == [("kill", "threatened")] or found("we will kill you") == [("you", "threatened")]
    assert found("they hurt") == [("hurt", "threatened")]
    assert found("kill the process") == [] and found("kill time. You know") == []
    assert found("I will not hurt you") == [("hurt", "negated")]


def test_scores_follow_clauses():
    plain, aimed = score("what an idiot"), score("you are an idiot")
    negated, reported = score("he is not an idiot"), score("the paper called it stupid")
    assert score("") < negated < plain < aimed and score("a quiet day") < reported < plain
    assert score("") == score("a quiet day") < 0.1


def test_composition_is_one_after_the_other():
    rng = np.random.default_rng(2)
    parts = [
        tg.insult_transducer(),
        tg.negation_transducer(),
        tg.report_transducer(),
        tg.target_transducer(),
        tg.threat_transducer(),
    ]
    table = tg.grammar().arcs
    states, state = [0] * len(parts), 0
    for symbol in rng.choice(tg.SYMBOLS, 5000).tolist():
        state, together = table[state, symbol]
        for i, part in enumerate(parts):
            states[i], symbol = part.step(states[i], symbol)
        assert symbol == together


def test_regression_finds_weights():
    rng = np.random.default_rng(4)
    x = np.column_stack([np.ones(4000), rng.normal(size=(4000, len(tg.PRIOR) - 1))])
    true = np.array([-1.0, 2.0, 0.5, 0.0, -1.0, 0.0, 1.0, 0.0])
    y = (rng.random(4000) < 1 / (1 + np.exp(-x @ true))).astype(float)
    assert np.abs(tg.fitted(x, y, np.ones(4000)) - true).max() < 0.3
    assert np.abs(tg.fitted(x[:0], y[:0], np.ones(0)) - tg.PRIOR).max() < 1e-6


def held_out(spark, sf_dir):
    rows = op11_toxic_grammar(spark, sf_dir)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    assert rows.schema["predicted"].dataType.simpleString() == "int"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return rows, rows.join(labels, "doc_id").filter("held_out").select("toxic", "score", "predicted").collect()


def test_query_on_held_out_rows(spark):
    rows, held = held_out(spark, "/root/testdata/sf0.1")
    rows = rows.collect()
    assert len(rows) == 10000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    toxic = [r for r in held if r.toxic]
    caught, flagged = sum(r.predicted for r in toxic), sum(r.predicted for r in held)
    assert len(toxic) > 60 and caught >= 0.9 * len(toxic) and caught >= 0.9 * flagged


def test_labels_of_held_out_rows_do_not_count(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn("toxic", F.when(tg.fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = tg.learned(docs, labels), tg.learned(docs, turned)
    assert one.lexicon == two.lexicon and (one.weights == two.weights).all()


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame(
        [(3, None), (3, 1), (1, 0), (7, 0), (7, 1), (None, 1), (99, 1), (8, 0), (2, 0)], "doc_id long, toxic int"
    )
    model = tg.learned(odd_docs, labels)
    rows = tg.scored(odd_docs, model, ["doc_id", "n_tokens", "start"]).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (1, 2)}
    assert len(empty) == 1
    with pytest.raises(ValueError, match="score"):
        tg.scored(odd_docs.withColumnRenamed("start", "score"), model, ["score"])


def test_empty(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = tg.learned(no_docs, labels)
    assert tg.scored(no_docs, model, ["doc_id"]).collect() == []
    assert score("you are an idiot", model) >= 0.5 > score("a quiet day", model)
