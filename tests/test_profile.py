"""Profiles against a plain-Python count, on tables small enough to read."""

import hashlib
import json
import math
import random
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from patina import Collection
from patina.errors import PatinaError
from patina.operators import cells, order
from patina.operators import profile as P


@pytest.fixture(autouse=True)
def small_buckets(monkeypatch):
    """Seven rows a bucket and three buckets a group, so every walk crosses edges on several levels."""
    monkeypatch.setattr(order, "BUCKET_ROWS", 7)
    monkeypatch.setattr(order, "FAN", 3)


def table(spark, values, dtype="string", parts=3):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"record_index bigint, v {dtype}")
    return Collection(df.repartition(parts))


def expected_order(values):
    """Plain restatement of the order statistics for one column."""
    seen = [v for v in values if v is not None and v != ""]
    n = len(seen)
    keys = [json.dumps(v) for v in seen]
    count = {k: keys.count(k) for k in keys}
    starts = [k for j, k in enumerate(keys) if j == 0 or keys[j - 1] != k]
    split = sum(1 for k in count if starts.count(k) > 1)
    dup = sum(1 for c in count.values() if c > 1)
    pairs = list(zip(seen, seen[1:]))
    out = {
        "non_null_count": n,
        "distinct_count": len(count),
        "duplicate_value_count": dup,
        "duplicate_occurrence_count": n - len(count),
        "values_split_across_multiple_runs": split if n > 1 else None,
        "increase_ratio": sum(b > a for a, b in pairs) / (n - 1) if n > 1 else None,
        "decrease_ratio": sum(b < a for a, b in pairs) / (n - 1) if n > 1 else None,
    }
    tails = []
    for v in seen:
        m = re.search(r"([0-9]+)$", v) if isinstance(v, str) else None
        if isinstance(v, int):
            tails.append(v)
        elif m:
            tails.append(int(m.group(1)))
    if n > 1 and len(tails) == n:
        steps = [b - a for a, b in zip(tails, tails[1:])]
        out["suffix_plus_one_ratio"] = steps.count(1) / (n - 1)
        out["suffix_minus_one_ratio"] = steps.count(-1) / (n - 1)
    return out


MIXES = [
    ("string", [f"K{j % 5}" for j in range(40)]),
    ("string", [None, "", "a", "a", None, "b", "", "a"] * 6),
    ("string", [f"row-{j}" for j in range(30)]),
    ("int", [j // 3 for j in range(50)]),
    ("int", [5, None, None, None, None, None, None, None, None, None, None, 5, 6, 4]),
    ("double", [1.5, -2.0, 1.5, 7.0, 7.0, None, 3.25] * 4),
]


@pytest.mark.parametrize("dtype,values", MIXES)
@pytest.mark.parametrize("parts", [1, 32])
def test_order_statistics(spark, dtype, values, parts):
    c = table(spark, values, dtype, parts)
    got = P.order_profile(P.value_table(c)).head().asDict()
    for key, want in expected_order(values).items():
        assert got[key] == pytest.approx(want) if want is not None else got[key] is None, key


def classes(spark, values, dtype="string"):
    r = P.order_profile(P.value_table(table(spark, values, dtype))).head()
    return r["cardinality_class"], r["layout_class"], r["sequence_class"]


def test_classes_at_their_edges(spark):
    assert classes(spark, ["x"] * 100) == ("repeated", "grouped", "constant")
    assert classes(spark, list(range(100)), "int") == ("unique", "unique", "sequential_ascending")
    assert classes(spark, [f"A{j:03d}" for j in range(100, 0, -1)])[2] == "sequential_descending"
    assert classes(spark, [j * j for j in range(100)], "int")[2] == "monotonic_ascending"
    assert classes(spark, [-j * j for j in range(100)], "int")[2] == "monotonic_descending"
    assert classes(spark, [j % 10 for j in range(100)], "int")[:2] == ("repeated", "interleaved")
    assert classes(spark, [j // 10 for j in range(100)], "int")[:2] == ("repeated", "grouped")
    # 10 values in pairs; one of ten split: 0.1 is still grouped, two of ten is mixed.
    def pairs(cut):
        return [v for v in range(10) for _ in range(2)] + list(range(cut))
    assert classes(spark, pairs(1), "int")[1] == "grouped"
    assert classes(spark, pairs(2), "int")[1] == "mixed"
    assert classes(spark, pairs(8), "int")[1] == "interleaved"


def test_booleans_dates_and_empty_columns_have_no_sequence(spark):
    assert classes(spark, [True, False, True], "boolean")[2] == "not_applicable"
    dates = spark.createDataFrame([(j, f"2024-01-0{j + 1}") for j in range(5)], "record_index bigint, t string")
    c = Collection(dates.select("record_index", F.to_timestamp_ntz("t").alias("t")))
    assert P.order_profile(P.value_table(c)).head()["sequence_class"] == "not_applicable"
    none = table(spark, [None, "", None])
    got = P.with_empty_profiles(P.order_profile(P.value_table(none)), ["/v"]).head()
    assert (got["cardinality_class"], got["layout_class"], got["unique_ratio"]) == ("empty", "not_applicable", 0.0)


def quantile(ordered, p):
    at = (len(ordered) - 1) * p
    lo = int(at)
    hi = min(lo + 1, len(ordered) - 1)
    return ordered[lo] * (1 - (at - lo)) + ordered[hi] * (at - lo)


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [7.5] * 30 + [1.25, 900.0], [((j * 7919) % 1009) / 8 for j in range(5000)]])
def test_quantiles_are_exact(spark, values):
    c = table(spark, values, "double")
    got = P.numeric_distribution(c).head()
    for name, p in P.QUANTILES.items():
        assert got[name] == quantile(sorted(values), p), name


def test_numeric_text_follows_float_literals(spark):
    good = ["1", " 2.5 ", "-3e2", "1_0", ".5", "6."]
    got = P.numeric_distribution(table(spark, good)).head()
    assert (got["min"], got["max"], got["n"]) == (-300.0, 10.0, 6)
    for bad in ("1d", "2f", "0x10", "1__0", "", "abc", "1,5"):
        rows = P.numeric_distribution(table(spark, [*good, bad])).collect()
        assert len(rows) == (1 if bad == "" else 0), bad
    flags = P.numeric_distribution(table(spark, [True, False], "boolean"))
    assert flags.collect() == []


def test_patterns_lengths_and_ranges(spark):
    values = [" a@b.co ", "HTTP://x", "2024-02-03", "2024-02-03T10:11", "12", "+1.5", "x" * 400 + "@q.z", "", None]
    c = table(spark, values)
    got = {r["pattern"]: r["n"] for r in P.pattern_counts(P.value_table(c, ordered=False)).collect()}
    assert got == {"email": 2, "url": 1, "iso_date": 1, "iso_datetime": 1, "integer_text": 1, "decimal_text": 1}
    row = P.field_counts(c).head()
    assert (row["min_length"], row["max_length"]) == (2, 404)
    assert (row["null_or_empty_count"], row["physical_types"]) == (2, {"null": 1, "string": 8})
    days = table(spark, ["2024-03-01", " 2023-01-09 ", "", None])
    assert P.temporal_range(days).head().asDict() == {"path": "/v", "min": "2023-01-09", "max": "2024-03-01"}
    assert P.temporal_range(table(spark, ["2024-03-01", "soon"])).collect() == []


def test_samples_and_top_values_keep_whole_texts(spark):
    long = "z" * 5000
    values = [long, "b", "a", "b", long, long, None, "c"]
    c = table(spark, values)
    vt = P.value_table(c)
    top = P.restore_long_values(c, P.top_values(vt)).orderBy("rank").collect()
    assert [(r["value"], r["count"]) for r in top] == [(long, 3), ("b", 2), ("a", 1), ("c", 1)]
    first = P.restore_long_values(c, P.sample_values(vt, 2)).orderBy("rank").collect()
    assert [r["value"] for r in first] == [long, "b"]
    assert P.sample_values(vt, 0).collect() == []


def test_whole_profile_of_nested_rows(spark):
    rows = [Row(record_index=j, id=f"N{j:02d}", **{"a/b": Row(x=j % 3, y=None if j % 2 else "t")}) for j in range(20)]
    c = Collection(spark.createDataFrame(rows, "record_index bigint, id string, `a/b` struct<x:int,y:string>"))
    got = {r["path"]: r for r in P.profile_fields(c).collect()}
    assert sorted(got) == ["/a~1b/x", "/a~1b/y", "/id"]
    assert got["/a~1b/y"]["physical_types"] == {"null": 10, "string": 10}
    assert got["/a~1b/x"]["numeric_distribution"]["median"] == 1.0
    assert got["/id"]["representation"]["sequence_class"] == "sequential_ascending"
    assert [v["count"] for v in got["/a~1b/x"]["most_frequent"]] == [7, 7, 6]
    assert got["/id"]["most_frequent"] is not None  # 20 values, at most 50
    assert got["/id"]["sample_values"] == ["N00", "N01", "N02", "N03", "N04"]


def test_repetition(spark):
    c = table(spark, ["a", "b", "a", "a", None, None])
    r = P.record_repetition(c).head()
    assert tuple(r) == (3, 3, 2)


def test_numbering_survives_hot_leading_keys(spark):
    rows = [(1 if j % 3 else j, j, f"t{j}") for j in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, j bigint, t string").repartition(9)
    got = order.with_record_index(df, ["k", "j"], bucket_rows=100).collect()
    want = {r: n for n, r in enumerate(sorted((k, j) for k, j, _ in rows))}
    assert all(r["record_index"] == want[(r["k"], r["j"])] for r in got)


@pytest.mark.parametrize("k", [1, 7, 50, 240])
def test_stride_sample_positions(spark, k):
    df = spark.range(0, 500).select(F.col("id").alias("record_index"), (F.col("id") % 3).alias("g"))
    keep = [j for j in range(500) if j % 3 == 1]
    got = order.stride_sample(df, k, F.col("g") == 1).orderBy("sample_no").collect()
    assert [r["record_index"] for r in got] == [keep[j * len(keep) // k] for j in range(k)]
    few = order.stride_sample(df.where("record_index < 3"), 7).orderBy("sample_no").collect()
    assert [r["record_index"] for r in few] == [j * 3 // 7 for j in range(7)]
    with pytest.raises(ValueError):
        order.stride_sample(df.where("record_index < 0"), 5)


def test_nan_and_infinity_do_not_break_quantiles(spark):
    c = table(spark, [1.0, math.inf, 2.0], "double")
    got = P.numeric_distribution(c).head()
    assert got["max"] == math.inf and got["min"] == 1.0


def test_long_texts_keep_their_order_statistics(spark):
    values = ["x" * 300 + f"{j:03d}" for j in range(30)]
    got = P.order_profile(P.value_table(table(spark, values))).head()
    assert got["sequence_class"] == "sequential_ascending"
    assert got["trailing_integer_parse_ratio"] == 1.0


def test_numbering_by_awkward_keys(spark):
    import datetime as dt

    rows = [
        (None if j % 50 == 0 else f"it's \\ {j % 40} \"q\"", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=j), float("nan") if j % 9 == 0 else j / 3, j)
        for j in range(900)
    ]
    df = spark.createDataFrame(rows, "s string, t timestamp_ntz, d double, j bigint").repartition(5)
    got = order.with_record_index(df, ["s", "d", "t"], bucket_rows=40)
    ranked = got.orderBy("s", "d", "t").select("record_index").collect()
    assert [r[0] for r in ranked] == list(range(900))


def test_long_texts_keep_their_numbers_and_stay_apart(spark):
    long = "0" * 300 + "2"
    fake = "sha256:" + hashlib.sha256(long.encode()).hexdigest()
    rows = [(0, "1.5", long), (1, long, fake), (2, "3", "x")]
    coll = Collection(spark.createDataFrame(rows, "record_index bigint, n string, t string"))
    vt = P.value_table(coll, ["/n", "/t"], ordered=False).cache()
    assert {r["path"]: (r["min"], r["max"]) for r in P.numeric_distribution(coll, ["/n", "/t"]).collect()} == {"/n": (1.5, 3.0)}
    assert vt.where("path = '/t'").count() == 3


def test_trailing_digits_of_any_length(spark):
    start = 10**39 - 4
    rows = [(k, f"id{start + k:045d}", f"id{start - k}") for k in range(9)]
    coll = Collection(spark.createDataFrame(rows, "record_index bigint, up string, down string"))
    found = {r["path"]: r for r in P.order_profile(P.value_table(coll, ["/up", "/down"])).collect()}
    assert found["/up"]["suffix_plus_one_ratio"] == found["/down"]["suffix_minus_one_ratio"] == 1.0
    assert found["/up"]["suffix_increase_ratio"] == found["/down"]["suffix_decrease_ratio"] == 1.0


def test_objects_are_walked_to_the_bottom(spark):
    deep = '{"leaf": 7}'
    for k in range(14):
        deep = '{"k%d": %s}' % (k, deep)
    df = spark.createDataFrame([(0, '{"top": 1, "deep": %s}' % deep)], "record_index bigint, j string")
    coll = Collection(df.select("record_index", F.parse_json("j").alias("record")))
    paths = cells.variant_leaf_paths(coll)
    assert paths[1] == "/top" and paths[0].endswith("/leaf") and paths[0].count("/") == 16


def test_quantiles_of_bunched_numbers(spark, monkeypatch):
    """Refined by value and by magnitude down to ranges of a few rows."""
    monkeypatch.setattr(P, "RANGE_ROWS", 3)
    pick = random.Random(4)
    huge = [pick.choice([1, -1]) * 10 ** pick.uniform(-300, 300) for _ in range(400)] + [0.0, 5e-324, 1e-323, 1.7e308, -1.7e308]
    same = [7.25] * 300 + [7.250000000000001] * 5 + [-1e300, 1e300]
    ends = [-math.inf] * 60 + [1.0, 2.0, 3.0] + [math.inf] * 50
    for values in (huge, same, ends, [3.5], [1.0, 2.0]):
        got = P.numeric_distribution(table(spark, values, "double")).head()
        ranked, n = sorted(values), len(values)
        for name, p in P.QUANTILES.items():
            place = (n - 1) * p
            k, share = int(place), place - int(place)
            low, high = ranked[k], ranked[min(k + 1, n - 1)]
            assert got[name] == (low if p in (0.0, 1.0) else low * (1 - share) + high * share) or math.isnan(got[name])


def test_order_statistics_of_many_small_buckets(spark, monkeypatch):
    """10^5 buckets of one row, combined in levels, give the statistics of one bucket."""
    n = 100_000
    df = spark.range(n).select(
        F.col("id").alias("record_index"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("v"), (F.col("id") % 7).cast("string"))).alias("a"),
        F.col("id").alias("b"),
        F.when(F.col("id") % 9999 == 5, F.lit(1.5)).alias("c"),
    )
    monkeypatch.setattr(order, "BUCKET_ROWS", n)
    want = {r["path"]: r for r in P.order_profile(P.value_table(Collection(df))).collect()}
    monkeypatch.setattr(order, "BUCKET_ROWS", 1)
    monkeypatch.setattr(order, "FAN", 50)
    got = {r["path"]: r for r in P.order_profile(P.value_table(Collection(df))).collect()}
    assert got == want and got["/b"]["sequence_class"] == "sequential_ascending"
    sizes = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 5).alias("size"))
    offsets = {r.k: r.offset for r in order.running_offsets(sizes, "k", "size", 1000).collect()}
    assert offsets == {k: sum(i % 5 for i in range(k)) for k in range(1000)}


def test_an_order_key_must_be_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, t string")
    with pytest.raises(PatinaError, match="not unique"):
        order.with_record_index(df, ["k"])
    assert [r.record_index for r in order.with_record_index(df, ["k", "t"]).orderBy("k", "t").collect()] == [0, 1, 2]
