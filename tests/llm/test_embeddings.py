"""The metric range join against all pairs."""

import math

import numpy as np
import pytest

from patina.llm import blocks, embeddings

SCHEMA = "vec_id long, embedding array<float>, n_links string"


def vectors(n=160, dim=8, seed=3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, dim))
    rows = []
    for i in range(n):
        v = centres[draw.integers(12)] + draw.normal(size=dim) * draw.choice([0.02, 0.15, 0.5, 2])
        rows.append((i * 2 + 1, [float(np.float32(x)) for x in v * draw.choice([1e-20, 1, 1e15])], "c"))
    rows += [(1000 + i, rows[3][1], "c") for i in range(6)] + [rows[4], (None, rows[5][1], "c")]
    rows += [(2000, None, "c"), (2001, [0.0] * dim, "c"), (2002, [1.0, None] + [0.0] * (dim - 2), "c"), (2003, [], "c")]
    rows += [(2004, [math.nan] + [1.0] * (dim - 1), "c"), (2005, [math.inf] + [1.0] * (dim - 1), "c")]
    rows += [(2006, [1.0, 2.0, 3.0], "c"), (2007, [2.0, 4.0, 6.0], "c"), (2008, [-0.0, 1.0, 0.0], "c"), (2009, [0.0, 2.0, 0.0], "c")]
    return rows


def expected(rows, cosine):
    def usable(key, v):
        return key is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    unit = [np.array(v) / np.linalg.norm(v) if usable(k, v) else None for k, v, _ in rows]
    links = [0] * len(rows)
    root = {k: k for k, *_ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(unit):
        for j in range(i):
            b = unit[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= cosine:
                links[i] += 1
                links[j] += 1
                low, high = sorted((find(rows[i][0]), find(rows[j][0])))
                root[high] = low
    out = []
    for (key, *_), n in zip(rows, links, strict=True):
        root_key = None if key is None else find(key)
        out.append((key, n, root_key, key is None or key == root_key))
    return sorted(out, key=str)


@pytest.mark.parametrize("cells, home, cosine", [(4096, 2048, 0.95), (20, 2048, 0.95), (15, 4, 0.95), (200, 5, 0.8)])
def test_against_all_pairs(spark, monkeypatch, cells, home, cosine):
    monkeypatch.setattr(embeddings, "CELL_ROWS", cells)
    monkeypatch.setattr(embeddings, "HOME", home)
    monkeypatch.setattr(embeddings, "VISITS", 3 * home)
    rows = vectors()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = embeddings.near_duplicates(frame, cosine=cosine)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = sorted((tuple(r) for r in found.collect()), key=str)
    wanted = expected(rows, cosine)
    assert got == wanted and any(n > 3 for _, n, *_ in wanted)


def test_cells_prune_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL_ROWS", 50)
    draw = np.random.default_rng(1)
    centres = np.eye(16)[:8]
    rows = [(i, [float(x) for x in centres[i % 8] + draw.normal(size=16) * 0.01]) for i in range(400)]
    frame = spark.createDataFrame(rows, "rep long, vector array<double>").selectExpr("rep", "vector", "1L AS copies", "16 AS dim")
    placed = embeddings.assign_cells(frame, embeddings.draw_pivots(frame, 400)).cache()
    copies = embeddings.cell_blocks(placed, math.sqrt(0.1)).where("side = 1").count()
    assert copies < 400 * 3


def test_tables_without_links(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    bad = spark.createDataFrame([(1, None, "x"), (2, [0.0], "x"), (None, [1.0], "x")], SCHEMA)
    assert {tuple(r) for r in embeddings.near_duplicates(bad).collect()} == {(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)}
    assert blocks.HOME == embeddings.HOME


def test_unlike_vectors_under_one_key_share_their_links(spark):
    rows = [(1, [1.0, 0.0], "x"), (1, [0.0, 1.0], "x"), (2, [1.0, 0.01], "x"), (3, [0.01, 1.0], "x"), (4, [-1.0, 0.0], "x")]
    found = embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    got = sorted(tuple(r) for r in found)
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 0, 4, True)]


def test_long_vectors_are_ruled_out_by_their_leading_directions(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL_ROWS", 40)
    monkeypatch.setattr(embeddings, "HOME", 8)
    monkeypatch.setattr(embeddings, "VISITS", 24)
    monkeypatch.setattr(embeddings, "TILE", 5)
    monkeypatch.setattr(embeddings, "AWAY", 30)
    rows = vectors(n=220, dim=64, seed=11)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in embeddings.near_duplicates(frame).collect()), key=str)
    wanted = expected(rows, 0.95)
    assert got == wanted and any(n > 3 for _, n, *_ in wanted)
    assert embeddings.leading_directions({64: np.eye(64)[:5], 8: np.eye(8)}).keys() == {64}


def test_keys_of_text_double_precision_and_negative_zero(spark):
    rows = [("b", [-0.0, 1.0, 0.0]), ("a", [0.0, 1.0, 0.0]), ("c", [0.0, 3.0, 0.1]), ("d", [5.0, 0.0, 0.0]), (None, [0.0, 1.0, 0.0])]
    found = embeddings.near_duplicates(spark.createDataFrame(rows, "name string, v array<double>"), "v", "name").collect()
    wanted = {("a", 2, "a", True), ("b", 2, "a", False), ("c", 2, "a", False), ("d", 0, "d", True), (None, 0, None, True)}
    assert {tuple(r) for r in found} == wanted


def test_vectors_are_written_once_however_many_they_are_compared_with(spark, monkeypatch, tmp_path, capsys):
    monkeypatch.setattr(embeddings, "CELL_ROWS", 50)
    monkeypatch.setattr(embeddings, "HOME", 8)
    monkeypatch.setattr(embeddings, "VISITS", 16)
    even = np.random.default_rng(5).normal(size=(400, 16))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(even)]
    frame = spark.createDataFrame(rows, "rep long, vector array<double>").selectExpr("rep", "vector", "1L AS copies", "16 AS dim")
    embeddings.assign_cells(frame, embeddings.draw_pivots(frame, 400)).write.parquet(str(tmp_path / "chunks"))
    chunks = spark.read.parquet(str(tmp_path / "chunks"))
    pairs = embeddings.cell_blocks(chunks, math.sqrt(0.1) + embeddings.SLACK)
    pairs.explain()
    # Chunks that meet are read again: an exchange would write every vector as often as it is compared.
    assert "Exchange" not in capsys.readouterr().out
    sizes = [len(r.reps) for r in chunks.collect()]
    assert sum(sizes) == 400 and len(sizes) > 20 and max(sizes) < 60
    assert pairs.where("side = 1").count() > 5 * len(sizes)



def test_cells_apart_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL_ROWS", 50)
    draw = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.eye(16)[i % 8] + draw.normal(size=16) * 0.01]) for i in range(400)]
    frame = spark.createDataFrame(rows, "rep long, vector array<double>").selectExpr("rep", "vector", "1L AS copies", "16 AS dim")
    pivots = {16: np.eye(16)[:8]}
    pairs = embeddings.cell_blocks(embeddings.assign_cells(frame, pivots), math.sqrt(0.1) + embeddings.SLACK)
    assert pairs.groupBy("side").count().collect() == [(0, 8)]


def test_trees_join_as_pairs_come():
    draw = np.random.default_rng(2)
    for _ in range(20):
        a, b = draw.integers(60, size=(2, 45))
        root = np.arange(60)
        for part in np.array_split(np.arange(45), 4):
            root = embeddings.unite(root, a[part], b[part])
        wanted = np.arange(60)
        for _ in range(60):
            np.minimum.at(wanted, a, wanted[b])
            np.minimum.at(wanted, b, wanted[a])
        assert (root == wanted).all()
