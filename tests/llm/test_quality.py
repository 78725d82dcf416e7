"""Shapes, grouped posteriors against plain Python, and held-out accuracy."""

import math

import numpy as np
import pyarrow as pa
import pytest

from patina.llm import quality
from patina.llm.queries import QUERIES, learning_fold, read

SCHEMA = "doc_id long, text string, source string, lang string, score int"


def rows():
    out = []
    for i in range(120):
        good = i % 3 != 0 if i % 2 else i % 10 == 0
        text = f"Plain words of text number {i} that go on, and end." if good else "WOW!! $$$ " * (5 + i % 4)
        out.append((i, text, "hot" if i % 2 else f"s{i % 5}", ["en", None][i % 7 == 0], 1))
    return [*out, (None, "text", None, "en", 1), (500, None, "alone", "en", 1), (501, "", "hot", None, 1), (502, "a b " * 60_000, "hot", "en", 1), out[0]]


def model(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    labels = [(i, int(t.startswith("Plain"))) for i, t, *_ in rows()[:120]] + [(None, 1), (3, None)]
    return docs, quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))


def strength(groups):
    k, total = len(groups), sum(n for n, _ in groups)
    mean = sum(g for _, g in groups) / total
    between = sum(n * (g / n - mean) ** 2 for n, g in groups)
    room = total - sum(n * n for n, _ in groups) / total - (k - 1)
    noise = max(mean * (1 - mean), 1e-9)
    rho = (between - noise * (k - 1)) / (noise * room) if room > 0 else 0
    return 1 / min(max(rho, 1e-4), 0.5) - 1


def test_posteriors_against_brute_force(spark):
    docs, fitted = model(spark)
    found = quality.score(docs.repartition(3), fitted, keep=["doc_id", "text", "source", "lang"])
    got = {(r.doc_id, r.text): r for r in found.collect()}
    p = fitted.probabilities(pa.array([r[1] for r in rows()]))
    hosts, paths = {}, {}
    for (_, _, host, path, _), value in zip(rows(), p, strict=True):
        for table, group in ((hosts, host), (paths, (host, path))):
            n, good = table.get(group, (0, 0.0))
            table[group] = (n + 1, good + value)
    a, b = strength(list(hosts.values())), strength(list(paths.values()))
    overall = p.sum() / len(p)
    near = lambda x: min(max(x, quality.TINY), 1 - quality.TINY)
    for (key, text, host, path, _), value in zip(rows(), p, strict=True):
        n, good = hosts[host]
        host_share = near((a * overall + good - value) / (a + n - 1))
        n, good = paths[host, path]
        path_share = near((b * host_share + good - value) / (b + n - 1))
        odds = math.log(value / (1 - value)) - math.log(fitted.base / (1 - fitted.base)) + math.log(path_share / (1 - path_share))
        r = got[key, text]
        assert r.path_share == pytest.approx(path_share) and r.host_share == pytest.approx(host_share)
        assert r.score == pytest.approx(1 / (1 + math.exp(-odds))) and r.keep == (r.score >= 0.5)


def test_classifier_tells_shapes_apart(spark):
    docs, fitted = model(spark)
    p = fitted.probabilities(pa.array([r[1] for r in rows()[:120]]))
    assert np.mean((p >= 0.5) == [r[1].startswith("Plain") for r in rows()[:120]]) == 1


def test_shapes_do_not_depend_on_the_batch():
    texts = ["One two", None, "", "ÉÉ!!", "a a a a"]
    whole = quality.shapes(pa.array(texts))
    alone = [quality.shapes(pa.array([t], pa.string()))[0] for t in texts]
    assert np.allclose(whole, alone) and np.isfinite(whole).all()


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    fitted = quality.train(none, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.score(none, fitted, keep=["doc_id"]).count() == 0
    one = spark.createDataFrame(rows()[:1], SCHEMA)
    assert quality.score(one, fitted, keep=["doc_id"]).first().score == pytest.approx(0.5, abs=0.01)


def test_query_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op5_quality"](spark, sf)
    assert found.count() == read(spark, sf, "documents").count()
    held = found.where(~learning_fold(found["doc_id"])).join(read(spark, sf, "labels"), "doc_id").collect()
    assert held and np.mean([r.keep == bool(r.quality) for r in held]) >= 0.9
