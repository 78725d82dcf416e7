"""Signatures, exact similarity and classes against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from patina.llm import blocks, minhash

SCHEMA = "doc_id long, text string, component string"


def weights(text):
    w = "".join(c.lower() if c.isascii() and c.isalnum() or not c.isascii() else " " for c in text or "").split()
    parts = [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
    return {s: 1 + math.log(n) for s, n in Counter(parts).items()}


def similarity(x, y):
    """The definition, term by term."""
    every = set(x) | set(y)
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in every) for d in set(x) & set(y))


def documents(seed=1, base=12, copies=9):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(base):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(6, 120))]
        if draw.random() < 0.4:
            words += words[:12] * draw.randrange(1, 6)
        for _ in range(copies):
            other = list(words)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3, 6])):
                other[draw.randrange(len(other))] = draw.choice(vocabulary)
            docs.append(draw.choice([" ", ", "]).join(other))
    draw.shuffle(docs)
    return [(i * 3 + 2, t.upper() if i % 5 == 0 else t, "x") for i, t in enumerate(docs)]


def classes(docs, threshold=0.8):
    own = [(k, weights(t)) for k, t, _ in docs if k is not None]
    root = {k: k for k, _ in own}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(own):
        for b, y in own[:i]:
            if x and y and set(x) & set(y) and similarity(x, y) >= threshold - 1e-9:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: find(k) for k, _ in own}


def test_exact_similarity_is_the_definition():
    docs = documents(4, 6, 4)
    shingles, w, owner, _, _ = minhash.weighted_shingles(pa.array([t for _, t, _ in docs]))
    cut = np.searchsorted(owner, np.arange(len(docs) + 1))
    for i in range(len(docs)):
        for j in range(i):
            a, b = slice(cut[i], cut[i + 1]), slice(cut[j], cut[j + 1])
            got = minhash.probability_jaccard(shingles[a], w[a], shingles[b], w[b])
            assert got == pytest.approx(similarity(weights(docs[i][1]), weights(docs[j][1])), abs=1e-9)


def test_registers_estimate_it_without_bias():
    errors = []
    docs = documents(9, 20, 5)
    texts = pa.array([t for _, t, _ in docs])
    shingles, w, owner, _, _ = minhash.weighted_shingles(texts)
    found = minhash.prob_min_hash(shingles, w, owner, len(docs))
    alone = minhash.weighted_shingles(texts.slice(7, 1))
    assert (minhash.prob_min_hash(*alone[:3], 1)[0] == found[7]).all()
    for i in range(len(docs)):
        for j in range(i):
            s = similarity(weights(docs[i][1]), weights(docs[j][1]))
            if s > 0:
                errors.append((found[i] == found[j]).mean() - s)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.06


@pytest.mark.parametrize("small", [False, True])
def test_classes_against_brute_force(spark, monkeypatch, small):
    if small:  # many chunks and slices
        monkeypatch.setattr(blocks, "HOME", 3)
        monkeypatch.setattr(blocks, "SLICE", 2)
        monkeypatch.setattr(minhash, "TIE_HOME", 3)
        monkeypatch.setattr(minhash, "CHUNK", 2)
    docs = documents()
    more = [(900, None, "n"), (901, "", "n"), (902, "?!", "n"), (None, docs[0][1], "n"), (903, "one two", "n"), (904, "One; two", "n"), docs[5], docs[5]]
    found = minhash.near_duplicates(spark.createDataFrame(docs + more, SCHEMA).repartition(4)).collect()
    assert len(found) == len(docs + more)
    wanted = classes(docs + more)
    assert wanted[904] == 903 and len(set(wanted.values())) < len(wanted) - 20
    for r in found:
        assert r.component == wanted.get(r.doc_id)
        assert r.kept == (r.doc_id is None or r.component == r.doc_id)


def test_remaining_links_find_what_the_forest_missed(monkeypatch):
    docs = documents(6, 3, 12)
    texts = [t for _, t, _ in docs]
    shingles, w, owner, _, _ = minhash.weighted_shingles(pa.array(texts))
    low = (minhash.prob_min_hash(shingles, w, owner, len(docs)) & np.uint64(0xFF)).astype(np.uint8)
    cut = np.searchsorted(owner, np.arange(len(docs) + 1))
    table = pa.table(
        {
            "hashes": [shingles[a:b].view(np.int64) for a, b in zip(cut, cut[1:], strict=False)],
            "weights": [w[a:b] if (w[a:b] != 1).any() else w[:0] for a, b in zip(cut, cut[1:], strict=False)],
        }
    )
    sets = minhash._Sets(table)
    maybe = minhash._agreements(low, low) >= minhash.least_estimate(0.8)
    found = minhash._links_across(sets, sets, maybe.copy(), 0.8)
    wanted = np.array([[similarity(weights(a), weights(b)) >= 0.8 - 1e-9 for b in texts] for a in texts])
    assert (found == wanted).all()


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
