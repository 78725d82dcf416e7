"""Non-negative PU learning on planted words, and held-out accuracy on the given tables."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from patina.llm import toxicity
from patina.llm.queries import QUERIES, learning_fold, read

SCHEMA = "doc_id long, text string, score string"


def corpus(n=900, seed=2):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdefg") for _ in range(draw.randrange(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [draw.choice(words) for _ in range(draw.randrange(20, 200))]
        toxic = draw.random() < 0.2
        for _ in range(draw.randrange(1, 4) if toxic else 0):
            text.insert(draw.randrange(len(text)), "zyx" + draw.choice(["", "ing", "ers", "ly"]))
        docs.append((i, " ".join(text), "old"))
        if draw.random() < 0.6:
            labels.append((i, int(toxic)))
    return docs, labels, {i for i, t, _ in docs if "zyx" in t}


def test_learns_from_positives_and_unlabelled(spark):
    docs, labels, toxic = corpus()
    docs += [(None, "zyxing", "x"), (5000, None, "x"), (5001, "", "x"), (5002, "ab " * 50_000 + "zyxers", "x"), docs[0]]
    frame = spark.createDataFrame(docs, SCHEMA).repartition(3)
    known = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.train(frame, known, learn_from=learning_fold)
    found = toxicity.score(frame, model)
    assert found.columns == ["doc_id", "text", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == len(docs)
    right = [(r.predicted == 1) == ("zyx" in (r.text or "")) for r in rows]
    assert np.mean(right) > 0.98
    assert all(0 <= r.score <= 1 and (r.score >= 0.5) == bool(r.predicted) for r in rows)
    by_text = {r.text: r.score for r in rows}
    assert by_text[None] == by_text[""]


def test_held_out_labels_never_matter(spark):
    docs, labels, _ = corpus(300)
    frame = spark.createDataFrame(docs, SCHEMA)
    ids = {r.doc_id for r in spark.createDataFrame(docs, SCHEMA).where(~learning_fold(F.col("doc_id"))).collect()}
    assert ids
    flipped = [(i, 1 - y if i in ids else y) for i, y in labels]
    models = [toxicity.train(frame, spark.createDataFrame(x, "doc_id long, toxic int"), learn_from=learning_fold) for x in (labels, flipped)]
    assert np.array_equal(models[0].weights, models[1].weights) and models[0].prior == models[1].prior


def test_risk_is_corrected_for_the_prior():
    draw = np.random.default_rng(0)
    truth = draw.random(4000) < 0.3
    x = np.column_stack([(draw.random(4000) < np.where(truth, 0.9, 0.02)), draw.random(4000) < 0.5]).astype(float)
    positive = x[truth][:300]
    w, b = toxicity.nn_pu_fit(positive, x, 0.3)
    assert np.mean((toxicity.sigmoid(x @ w + b) >= 0.5) == (x[:, 0] == 1)) > 0.99


def test_features_do_not_depend_on_the_batch():
    texts = ["one TWO three", None, "", "é", "a" * 9, "one two THREE"]
    alone = [toxicity.present(pa.array([t], pa.string()))[0].tolist() for t in texts]
    assert [f.tolist() for f in toxicity.present(pa.array(texts))] == alone
    assert alone[0] == alone[5]


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(none, labels)
    assert toxicity.score(none, model).count() == 0
    assert toxicity.score(spark.createDataFrame([(1, "x", "y")], SCHEMA), model).first().score == pytest.approx(0.5)


def test_query_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.1"  # the smaller tables have a few dozen toxic examples
    found = QUERIES["op10_toxicity"](spark, sf)
    assert found.count() == read(spark, sf, "documents").count()
    joined = found.where("held_out").join(read(spark, sf, "labels"), "doc_id").collect()
    assert joined and np.mean([r.predicted == r.toxic for r in joined]) >= 0.95


def test_fit_against_finite_differences():
    """A dense fit with numeric gradients of the corrected risk takes the same steps, on both sides of the correction."""
    draw = np.random.default_rng(3)
    x = draw.random((40, 3)) < 0.5
    for positive, unlabelled, prior in ((x[:15], x, 0.3), (x[:30] * 0 + 1, x * 0, 0.8)):
        positive, unlabelled = positive.astype(float), unlabelled.astype(float)

        def terms(v, p=positive, u=unlabelled, prior=prior):
            zp, zu = p @ v[:-1] + v[-1], u @ v[:-1] + v[-1]
            loss = lambda z: float(np.mean(np.log1p(np.exp(z))))
            return prior * loss(-zp), loss(zu) - prior * loss(zp)

        def risk(v, sign):
            plus, minus = terms(v)
            return (plus + minus if sign else -minus) + 0.5 * 1e-4 * float(v[:-1] @ v[:-1])

        v = np.append(np.zeros(3), np.log(prior / (1 - prior)))
        m1, m2, sides = np.zeros(4), np.zeros(4), []
        for step in range(1, 61):
            sides.append(terms(v)[1] >= 0)
            grad = np.array([(risk(v + e, sides[-1]) - risk(v - e, sides[-1])) / 2e-6 for e in np.eye(4) * 1e-6])
            grad[np.abs(grad) < 1e-8] = 0  # the bias has no slope at first, and steps are scaled to slopes
            m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
            v = v - 0.05 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
            if not sides[-1]:
                break  # a few rounding errors decide the side from here on
        w, b = toxicity.nn_pu_fit(positive, unlabelled, prior, steps=len(sides))
        assert np.allclose(np.append(w, b), v, atol=2e-3) and sides[-1] == (prior == 0.3)
