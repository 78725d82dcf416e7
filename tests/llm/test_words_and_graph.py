"""Word hashing against a regular expression, block joins and components against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from patina.llm import blocks, words
from patina.llm.components import connected_components

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = ["", None, "One two,three", "ÉCOLE école", "a" * 5000 + " b", "  --  ", "x", "tail word", "word", "İI ı1\x00z"]


def spelled(text):
    return WORD.findall((text or "").encode().lower())


def test_words_are_those_of_the_pattern():
    raw, at = words.text_bytes(pa.array(TEXTS))
    starts, ends, doc = words.find_words(raw, at)
    found = [[] for _ in TEXTS]
    for a, b, d in zip(starts, ends, doc, strict=True):
        found[d].append(bytes(raw[a:b]).lower())
    assert found == [spelled(t) for t in TEXTS]


def test_hashes_depend_on_the_word_alone(monkeypatch):
    monkeypatch.setattr(words, "PIECE", 64)
    raw, at = words.text_bytes(pa.array([*TEXTS, " ".join(f"w{i % 50}" for i in range(500))]))
    starts, ends, _ = words.find_words(raw, at)
    hashes = words.hash_words(raw, starts, ends)
    by_word = {}
    for h, a, b in zip(hashes, starts, ends, strict=True):
        by_word.setdefault(bytes(raw[a:b]).lower(), set()).add(int(h))
    assert all(len(v) == 1 for v in by_word.values())
    assert len(set.union(*by_word.values())) == len(by_word)


def test_sliced_arrays_give_the_same_words():
    whole = pa.array(TEXTS)
    raw, at = words.text_bytes(whole.slice(2, 3))
    assert bytes(raw) == "".join(TEXTS[2:5]).encode() and at[0] == 0


@pytest.mark.parametrize("n, expected", [(0, 0), (1, 1), (4, 1), (5, 1), (6, 2), (9, 5)])
def test_short_texts_are_one_shingle(n, expected):
    h = np.arange(n, dtype=np.uint64)
    found, doc = words.hash_shingles(h, np.zeros(n, np.int64), 1, 5)
    assert len(found) == expected == len(doc)


def test_shingles_do_not_cross_texts():
    one = words.hash_shingles(np.arange(7, dtype=np.uint64), np.array([0] * 7), 1, 5)[0]
    two = words.hash_shingles(np.arange(14, dtype=np.uint64) % 7, np.array([0] * 7 + [1] * 7), 2, 5)
    assert two[0].tolist() == one.tolist() * 2 and two[1].tolist() == [0] * 3 + [1] * 3


def components_of(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {x: find(x) for x in root}


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_components(spark, kind):
    draw = random.Random(3)
    edges = {
        "chain": [(i, i + 1) for i in range(300)],
        "star": [(900, i) for i in range(300)],
        "random": [(draw.randrange(400), draw.randrange(400)) for _ in range(250)] + [(None, 3), (5, None)],
    }[kind]
    found = connected_components(spark.createDataFrame(edges, "u long, v long").repartition(3))
    assert {r.u: r.component for r in found.collect()} == components_of(edges)


def test_no_edges_no_components(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_blocks_meet_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(blocks, "SLICE", 2)
    rows = spark.range(47).select((F.col("id") % 2).alias("g"), "id")
    rows = rows.join(rows.groupBy("g").agg(F.count("id").alias("n")), "g")
    keys = ["g", "block_i", "block_s"]
    placed = blocks.by_block(blocks.into_blocks(rows, "g", "id", "n", home=5), *keys)

    def pairs(batches):
        home = []
        for what, table in blocks.block_events(batches, [*keys, "side"]):
            ids = table.column("id").to_pylist()
            if what == "home":
                home = ids
                found = [(a, b) for a in ids for b in ids if a < b] if table.column("own")[0].as_py() else []
            else:
                found = [(min(a, b), max(a, b)) for a in home for b in ids]
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([p[0] for p in found], pa.int64()), "b": pa.array([p[1] for p in found], pa.int64())}
            )

    found = [tuple(r) for r in placed.mapInArrow(pairs, "a long, b long").collect()]
    wanted = {(a, b) for a in range(47) for b in range(a + 1, 47) if a % 2 == b % 2}
    assert len(found) == len(set(found))
    assert set(found) == wanted
