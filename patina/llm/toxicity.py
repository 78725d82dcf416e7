"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic examples are trusted; every other text is unlabelled, toxic ones
among it. A linear model over the presence of character 5-grams and words minimises an
estimate of the ordinary risk that the class prior corrects: the loss of unlabelled texts
as negatives, less what the toxic ones among them add, and never below zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patina.llm.shared import ship, text_slices
from patina.llm.words import IS_WORD, LOWER, find_words, hash_words, mixed, text_bytes

BITS = 18  # features are hashed to 2**BITS numbers
GRAM = 5  # bytes of a word part, a blank counting as the edge of a word
POSITIVES, UNLABELLED = 2_000, 6_000  # texts that training looks at, at most
FEATURES = 768  # those that tell toxic texts apart best
MIN_TEXTS, MIN_PART = 5, 0.02  # toxic texts, and part of them, that must hold a feature
MIN_SCORE = 4.0  # standard errors between its share of toxic and of unlabelled texts
MIN_SHARE = 0.4  # estimated part of the texts with a feature that is toxic
RESULT = ("score", "predicted")


def feature_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a batch and the text of each, with repeats.

    Features are whole words and all runs of ``GRAM`` bytes of a word with a blank on
    either side; longer words give several.
    """
    raw, at = text_bytes(texts)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = IS_WORD[raw]
    clean = np.where(inside, LOWER[raw], 32).astype(np.uint64)
    n = len(raw) - GRAM + 1
    parts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    if n > 0:
        gram = np.zeros(n, np.uint64)
        for k in range(GRAM):
            gram |= clean[k : n + k] << np.uint64(8 * k)
        whole = np.ones(n, bool)
        for k in range(1, GRAM - 1):
            whole &= inside[k : n + k]
        doc = np.searchsorted(at, np.flatnonzero(whole), "right") - 1
        begins = np.flatnonzero(whole)
        same = begins + GRAM <= at[doc + 1]
        parts[0].append(gram[begins[same]])
        parts[1].append(doc[same])
    starts, ends, doc = find_words(raw, at)
    parts[0].append(hash_words(raw, starts, ends))
    parts[1].append(doc)
    hashes = mixed(np.concatenate(parts[0])) >> np.uint64(64 - BITS)
    return hashes.astype(np.int64), np.concatenate(parts[1])


def present(texts: pa.Array) -> list[np.ndarray]:
    """Distinct hashed features of each text."""
    hashes, doc = feature_hashes(texts)
    pairs = np.unique((doc << BITS) | hashes)
    cuts = np.searchsorted(pairs, np.arange(len(texts) + 1) << BITS)
    return [(pairs[a:b] & ((1 << BITS) - 1)).astype(np.int32) for a, b in zip(cuts, cuts[1:], strict=False)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class ToxicityModel:
    """Weights of the chosen features; ``place`` maps a hashed feature to its number or -1."""

    place: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability that each text is toxic; one without any feature gets the base rate's."""
        hashes, doc = feature_hashes(texts)
        chosen = self.place[hashes]
        hit = chosen >= 0
        pairs = np.unique(doc[hit] * len(self.weights) + chosen[hit])
        owner, feature = np.divmod(pairs, len(self.weights)) if len(pairs) else (pairs, pairs)
        logits = self.bias + np.bincount(owner, self.weights[feature], minlength=len(texts))
        return sigmoid(logits)


def choose_features(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> np.ndarray:
    """Hashed features that toxic texts hold more often than unlabelled ones, best first.

    By Bayes' rule prior * P(feature | toxic) / P(feature) of the texts with a feature are
    toxic; features that are common in all texts are left out by that, for a long text
    holds many of them.
    """
    size = 1 << BITS
    p, u = (np.bincount(np.concatenate([*x, np.zeros(0, np.int32)]), minlength=size) for x in (positive, unlabelled))
    n, m = max(len(positive), 1), max(len(unlabelled), 1)
    both = (p + u) / (n + m)
    error = np.sqrt(both * (1 - both) * (1 / n + 1 / m)) + 1e-9
    special = (p >= max(min(MIN_TEXTS, n), MIN_PART * n)) & (prior * p / n >= MIN_SHARE * u / m)
    score = np.where(special, (p / n - u / m) / error, 0)
    order = np.argsort(-score, kind="stable")[:FEATURES]
    return order[score[order] >= MIN_SCORE]


def nn_pu_fit(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-4
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative PU risk of the logistic loss.

    Risk = prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)]). Where the
    second term falls below zero the model has begun to learn single texts by heart, and
    the step goes the other way on that term.
    """
    width = positive.shape[1]
    forward = lambda x, w: x @ w.astype(x.dtype)  # noqa: E731  no copy of the matrix in another type
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))
    m1, m2 = np.zeros(width + 1), np.zeros(width + 1)
    softplus = lambda x: np.logaddexp(0, x)
    for step in range(1, steps + 1):
        zp, zu = forward(positive, w) + b, forward(unlabelled, w) + b
        sp, su = sigmoid(zp), sigmoid(zu)
        negative_part = softplus(zu).mean() - prior * softplus(zp).mean()
        # Gradients of the mean losses with respect to the logits.
        plus = prior * (sp - 1) / len(zp)
        minus_u, minus_p = su / len(zu), -prior * sp / len(zp)
        if negative_part >= 0:
            gp, gu = plus + minus_p, minus_u
        else:
            gp, gu = -minus_p, -minus_u
        slope = forward(positive.T, gp) + forward(unlabelled.T, gu) + decay * w
        grad = np.append(slope, gp.sum() + gu.sum())
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad * grad
        move = rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - float(move[-1])
    return w, b


def _features_of(docs: DataFrame, ids: DataFrame, key: str, text: str) -> list[tuple[int, np.ndarray]]:
    """(group, features) of the few documents that ``ids`` (id, group) names."""
    chosen = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(ids), "id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "text"):
                found = [f.tolist() for f in present(batch.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("group"), pa.array(found, pa.list_(pa.int32()))], names=["group", "features"]
                )

    # A key that many rows share still gives one text.
    chosen = chosen.groupBy("group", "id").agg(F.max("text").alias("text"))
    rows = chosen.select("group", "text").mapInArrow(extract, "group int, features array<int>").toArrow()
    out = []
    for batch in rows.to_batches():
        flat, at = batch.column("features").flatten().to_numpy(), batch.column("features").offsets.to_numpy()
        parts = np.split(flat, (at[1:-1] - at[0]))
        out += [(g, part.copy()) for g, part in zip(batch.column("group").to_pylist(), parts, strict=True)]
    return out


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
    learn_from=None,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
) -> ToxicityModel:
    """Fit a model on at most ``positives`` toxic and ``unlabelled`` other texts.

    ``labels`` has ``key`` and ``label``; only rows for which ``learn_from`` (a function
    from a key column to a condition) holds are read, and all of them count for the class
    prior. The unlabelled texts are drawn from ``docs`` under the same condition by a hash
    of the key, whatever their labels say. Null keys and labels are left out. Without any
    toxic example the model scores every text with half of one such example.
    """
    ship(docs.sparkSession)
    allowed = (lambda c: F.lit(True)) if learn_from is None else learn_from
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & allowed(F.col("id"))
    )
    total, toxic = known.agg(F.count(F.lit(1)), F.sum(F.when(F.col("label") == 1, 1).otherwise(0))).first()
    prior = min(0.9, max(((toxic or 0) + 0.5) / (total + 1.0), 1e-4))
    drawn = lambda frame, n: frame.orderBy(F.xxhash64("id"), "id").limit(n)
    found = drawn(known.where(F.col("label") == 1).select("id").distinct(), positives)
    others = docs.select(F.col(key).alias("id")).where(F.col("id").isNotNull() & allowed(F.col("id")))
    others = drawn(others.distinct(), unlabelled)
    group = lambda frame, n: frame.withColumn("group", F.lit(n))
    rows = _features_of(docs, group(found, 1).unionByName(group(others, 0)), key, text)
    p, u = ([f for g, f in rows if g == side] for side in (1, 0))
    place = np.full(1 << BITS, -1, np.int32)
    if not p or not u:
        return ToxicityModel(place, np.zeros(1), float(np.log(prior / (1 - prior))), prior)
    features = choose_features(p, u, prior)
    place[features] = np.arange(len(features), dtype=np.int32)

    def matrix(texts: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(texts), max(1, len(features))), np.float32)
        for k, held in enumerate(texts):
            at = place[held]
            out[k, at[at >= 0]] = 1
        return out

    weights, bias = nn_pu_fit(matrix(p), matrix(u), prior)
    return ToxicityModel(place, weights, bias, prior)


def score(
    docs: DataFrame, model: ToxicityModel, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Add score (0 to 1) and predicted (1 if score >= 0.5) to columns ``keep`` of every row.

    The score is a function of the whole text alone. Null text counts as empty and gets
    the score of a text without any feature. Columns of these names are replaced; repeated
    rows stay. The model is a few hundred weights, sent to each task.
    """
    spark = docs.sparkSession
    ship(spark)
    held = [c for c in (docs.columns if keep is None else keep) if c not in RESULT]
    rows = docs.select(*dict.fromkeys([*held, text]))
    schema = T.StructType([rows.schema[c] for c in held]).add("score", "double").add("predicted", "integer")
    sent = spark.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, text):
                scores = sent.value.scores(batch.column(text))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in held), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                    names=[*held, *RESULT],
                )

    return rows.mapInArrow(apply, schema)
