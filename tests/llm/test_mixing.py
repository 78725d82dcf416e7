"""Targets, taken words and positions against plain Python."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from patina.errors import PatinaError
from patina.llm import mixing

DOCS = [
    *[(i, "w " * (1 + i % 7), "a", 1) for i in range(40)],
    *[(100 + i, "x " * 30, "b", 2) for i in range(9)],
    *[(200 + i, "y\tz\x0bq", None, 3) for i in range(5)],
    (300, None, "c", 4),
    (301, "", "c", 4),
    (None, "one two", "c", 4),
    (302, "same row", "c", 4),
    (302, "same row", "c", 4),
    (303, "long " * 3000, "d", 5),
]
SCHEMA = "doc_id long, text string, source string, size int"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def water(sizes, weights, most=3):
    """Give shares by weight, stop those above their limit, and share the excess again."""
    target, full, left = dict.fromkeys(sizes, 0.0), set(), float(sum(sizes.values()))
    while True:
        open_ = [s for s in sizes if s not in full]
        total = sum(weights[s] for s in open_)
        share = {s: left * weights[s] / total for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            return target | share
        for s in above:
            target[s] = most * sizes[s]
            left -= target[s]
            full.add(s)


@pytest.fixture(scope="module")
def mixed(spark):
    return mixing.mix(spark.createDataFrame(DOCS, SCHEMA).repartition(3)).cache()


def test_targets_follow_the_weights(mixed):
    sizes = {}
    for _, text, source, _ in DOCS:
        sizes[source] = sizes.get(source, 0) + words(text)
    weights = {s: i % 3 + 1 for i, s in enumerate(["a", "b", "c", "d", None])}
    wanted = water(sizes, weights)
    for r in mixed.select("source", "source_size", "target").distinct().collect():
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(wanted[r.source])


def test_taken_is_near_the_target_and_never_over_three_copies(mixed):
    rows = mixed.collect()
    assert len(rows) == len(DOCS)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2
    for r in rows:
        assert r.taken == r.size * len(r.positions) <= 3 * r.size
        assert list(r.positions) == sorted(r.positions) and all(0 <= p <= 1 for p in r.positions)
        assert r.size > 0 or not r.positions


def test_order_within_a_source_is_the_hash_of_the_key(mixed):
    own = [r for r in mixed.collect() if r.source == "a"]
    own.sort(key=lambda r: hashlib.md5(str(r.doc_id).encode()).hexdigest())
    ahead = 0
    for r in own:
        copies = sum(ahead + r.size / 2 + e * r.source_size <= r.target for e in range(3))
        assert r.taken == copies * r.size
        ahead += r.size


@pytest.mark.parametrize("knots", mixing.CURRICULA)
def test_demand_is_inverted(spark, knots):
    area = mixing.integral(knots)
    rows = spark.range(101).select((F.col("id") / 100 * area).alias("x"))
    for r in rows.select("x", mixing.demand_time(F.col("x"), knots).alias("t")).collect():
        done = sum(
            (min(r.t, t1) - t0) * (w0 + w0 + (w1 - w0) * (min(r.t, t1) - t0) / (t1 - t0)) / 2
            for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False)
            if r.t > t0
        )
        assert done == pytest.approx(r.x, abs=1e-9)


def test_training_order_has_a_row_per_copy(mixed):
    ordered = mixing.training_order(mixed)
    assert ordered.columns == ["doc_id", "text", "source", "epoch", "position"]
    rows = ordered.collect()
    assert len(rows) == sum(len(r.positions) for r in mixed.collect())
    assert [r.position for r in rows] == sorted(r.position for r in rows)


def test_small_buckets_change_nothing(spark, mixed, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    again = mixing.mix(spark.createDataFrame(DOCS, SCHEMA))
    key = lambda r: (str(r.doc_id), r.size, r.taken, tuple(r.positions))
    assert sorted(map(key, again.collect())) == sorted(map(key, mixed.collect()))


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    nothing = mixing.mix(spark.createDataFrame([(1, None, "a", 0)], SCHEMA)).first()
    assert (nothing.size, nothing.target, nothing.taken) == (0, 0.0, 0)


@pytest.mark.parametrize("knots", [((0, 1), (0.5, 1)), ((0, -1), (1, 3)), ((0, 0), (1, 0))])
def test_bad_schedules(knots):
    with pytest.raises(PatinaError):
        mixing.integral(knots)
