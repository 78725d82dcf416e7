"""Periodic runs against a search of every start and period."""

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from patina.llm import runs
from patina.llm.queries import op13_periodic_runs, repeat_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=12):
    """Every stretch with period q that no neighbour extends; of equal stretches the least period counts."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                length = j - i + q
                if length >= max(least, 2 * q):
                    smaller = any(
                        all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)
                    )
                    if not smaller:
                        found[i, q] = length
            i = j + 1
    return [(i, length, q) for (i, q), length in sorted(found.items())]


def collapse(words, found):
    gone = {k for i, length, q in found for k in range(i + q, i + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


@given(st.lists(st.sampled_from("ab"), max_size=60))
@settings(max_examples=400, deadline=None)
def test_runs_of_two_words(words):
    assert runs.find_runs(runs.word_ids([w.encode() for w in words])) == brute(words)


@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 12), st.lists(st.sampled_from("abc"), max_size=20), st.integers(1, 6))
@settings(max_examples=400, deadline=None)
def test_runs_around_a_repeat(unit, times, rest, least):
    words = rest[:7] + unit * times + rest[7:]
    ids = runs.word_ids([w.encode() for w in words])
    assert runs.find_runs(ids, 2 * least) == brute(words, 2 * least)
    assert runs.find_runs(ids, 2 * least + 1) == brute(words, 2 * least + 1)


def test_long_repeats_stay_fast():
    n = 200_000
    assert runs.find_runs(np.zeros(n, np.int64)) == [(0, n, 1)]
    words = np.tile(np.arange(1000), 100)
    assert runs.find_runs(np.concatenate([words, words[:500], [2000]])) == [(0, 100_500, 1000)]


def rebuilt(key, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(key).encode())
    if key is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(key, text):
    words = rebuilt(key, text)
    found = brute(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        key,
        len(found),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        sha("".join(f"{i},{length},{q}\n" for i, length, q in found)),
        sha(collapse(words, found)),
    )


def documents():
    pick = random.Random(3)
    rows = []
    for key in range(400):
        words = [pick.choice(["a", "b", "ä ö", "Cat", "x\x1cy", "."]) for _ in range(pick.randrange(90))]
        rows.append((key, pick.choice([" ", "\n", "\t \x0b"]).join(words), "x", 1, 2))
    rows += [(1000, None, "x", 1, 2), (1001, "", "x", 1, 2), (1002, " \n", None, 1, 2), (None, "a b " * 9, "x", 1, 2)]
    rows += [(-5, "one", "x", 1, 2), rows[3], rows[7], (2**40, "la " * 30, "x", None, 2)]
    return rows


SCHEMA = "doc_id long, text string, source string, n_words int, runs int"


def test_query_against_brute_force(spark, tmp_path):
    spark.createDataFrame(documents(), SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = op13_periodic_runs(spark, str(tmp_path))
    got = [tuple(r) for r in found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()]
    assert sorted(got, key=str) == sorted((expected(k, t) for k, t, *_ in documents()), key=str)
    assert sum(r[1] > 0 for r in got) > 20


def test_operator_gives_runs_spans_and_text(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    found = runs.collapse_runs(docs)
    assert found.columns == ["doc_id", "text", "source", "n_words", "runs", "kept", "collapsed"]
    for r in found.collect():
        words = WORD.findall(r.text or "")
        want = brute(words)
        assert r.n_words == len(words) and [(x.start, x.length, x.period) for x in r.runs] == want
        assert r.collapsed == collapse(words, want)
        assert " ".join(w for s in r.kept for w in words[s.first : s.last + 1]) == r.collapsed
    assert spark.createDataFrame([], SCHEMA).transform(runs.collapse_runs).count() == 0


def test_rewritten_texts(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    for r in repeat_words(docs).collect():
        assert r.text is None or WORD.findall(r.text) in [rebuilt(k, t) for k, t, *_ in documents() if k == r.doc_id]
