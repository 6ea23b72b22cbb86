"""Positive-unlabelled learning: the risk against plain numbers, held-out accuracy, edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from playtide.llm import toxicity
from playtide.llm.common import fold
from tests.llm.conftest import EDGES

FOLDER = "/root/testdata/sf0.1"


def test_held_out_toxic_texts_are_told_apart(spark):
    got = toxicity.op11_toxicity(spark, FOLDER)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").filter("toxic is not null")
    rows = got.filter("held_out").join(labels, "doc_id").select("toxic", "score", "predicted").collect()
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert len(toxic) >= 50 and len(clean) >= 400
    better = np.mean([(a.score > b.score) + 0.5 * (a.score == b.score) for a in toxic for b in clean])
    assert better >= 0.95
    assert np.mean([r.predicted for r in toxic]) >= 0.9 and np.mean([r.predicted for r in clean]) <= 0.02
    assert got.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_hidden_positives_are_not_taken_for_clean():
    """Nine in ten toxic texts are unlabelled; the corrected risk still finds them, a plain classifier calls most clean."""
    rng = np.random.default_rng(0)

    def texts(n, toxic):
        rows = (rng.random((n, 30)) < 0.05).astype(float)
        rows[:, :5] = 0
        if toxic:
            rows[np.arange(n), rng.integers(0, 5, n)] = 1
        return rows

    confirmed = texts(200, True)
    unlabelled = np.concatenate([texts(800, True), texts(1200, False)])
    weights, bias = toxicity.nn_pu(confirmed, unlabelled, 0.4)
    assert np.mean(texts(500, True) @ weights + bias > 0) > 0.95
    assert np.mean(texts(500, False) @ weights + bias > 0) < 0.05


def test_gradient_is_that_of_the_risk(monkeypatch):
    """One tiny step of plain descent lowers the risk, as worked out from its formula, by the squared gradient."""
    rng = np.random.default_rng(1)
    confirmed, unlabelled, prior = rng.random((20, 4)), rng.random((50, 4)), 0.3
    loss = lambda z: np.logaddexp(0, -z)

    def risk(w, b):
        p, u = confirmed @ w + b, unlabelled @ w + b
        return prior * loss(p).mean() + max(0, loss(-u).mean() - prior * loss(-p).mean())

    monkeypatch.setattr(toxicity, "STEP_SIZE", 0.01)
    previous = risk(np.zeros(4), 0.0)
    for rounds in (5, 20, 80):
        monkeypatch.setattr(toxicity, "ROUNDS", rounds)
        now = risk(*toxicity.nn_pu(confirmed, unlabelled, prior))
        assert now < previous
        previous = now


def test_words_and_terms():
    assert toxicity.words(b"Ab, ab 12x\n\xc3\xa9T") == {b"ab", b"x", b"\xc3\xa9t"}
    assert toxicity.word_terms(b"abcde") == [b"abcde ", b"abcd", b"abcde"]
    terms = toxicity.Terms([b"abcd", b"abcde ", b"zz "])
    assert terms.present(b"ABCDE abcdx zz zzz") == {0, 1, 2}


@pytest.mark.parametrize("labelled", [True, False])
def test_edge_rows(spark, make_docs, labelled):
    rows = [*EDGES, *((100 + i, "you idiot " + "word " * (i % 7)) for i in range(60)), *((300 + i, "fine words here " * (1 + i % 5)) for i in range(300))]
    docs = make_docs(rows)
    marks = [(100 + i, 1) for i in range(60)] + [(300 + i, 0) for i in range(300)] + [(100, 0), (None, 1), (1, None), (6, 0)]
    labels = spark.createDataFrame(marks if labelled else [], "doc_id long, toxic int")
    got = toxicity.score(docs, labels, fold(F.col("doc_id")) != 0)
    assert got.columns == docs.columns and got.count() == len(rows)
    scores = got.select("doc_id", "text", "score").collect()
    assert all(0 <= r.score <= 1 for r in scores)
    if labelled:
        assert min(r.score for r in scores if r.doc_id and 100 <= r.doc_id < 160) > 0.5 > max(r.score for r in scores if r.doc_id and r.doc_id >= 300)
        assert len({r.score for r in scores if not r.text}) == 1
    else:
        assert {r.score for r in scores} == {0.0}
    assert toxicity.score(docs.filter("false"), labels, F.lit(True)).count() == 0


def test_sample_is_bounded(spark, make_docs):
    docs = make_docs([(1, f"same id {i}") for i in range(500)]).select(F.col("doc_id").alias("id"), "text")
    assert toxicity._sampled(docs, 40).count() == 40
    assert sorted(toxicity._sampled(docs, 40).collect()) == sorted(toxicity._sampled(docs.union(docs).repartition(7), 40).collect())
    assert toxicity._sampled(docs, 40, docs.filter("false").select("id")).count() == 0
