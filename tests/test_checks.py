"""Single checks, equality kinds, sampling guarantees, catalogue and headers."""

import hashlib
import json
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patina import Collection
from patina.errors import PatinaError
from patina.functions import pointers as ptr
from patina.functions import values as V
from patina.operators import audit, catalog, cells, compare, corrupt, headers, order, validate
from patina.plans import report as R


def table(spark, rows, schema, **meta):
    rows = [(j, *r) for j, r in enumerate(rows)]
    return Collection(spark.createDataFrame(rows, "record_index bigint, " + schema), "", meta)


# ---------------------------------------------------------------- pointers and equality


def test_pointers_escape_and_resolve(spark):
    for name in ("Date/Time", "a~b", "x.y", "# of", "tick`s"):
        assert ptr.split(ptr.join(name, "z")) == [name, "z"]
        df = spark.createDataFrame([Row(**{name: Row(z=[1, 2])})])
        assert ptr.leaf_paths(df.schema) == [ptr.join(name, "z")]
        p = ptr.join(name, "z", "1")
        assert df.select(ptr.get_path(df.schema, p)).head()[0] == 2
        out = ptr.set_path(df, p, F.lit(9).cast("bigint"))
        assert out.select(ptr.get_path(out.schema, ptr.join(name, "z"))).head()[0] == [1, 9]
        assert ptr.has_path(df.schema, p) and not ptr.has_path(df.schema, ptr.join(name, "q"))
        with pytest.raises(PatinaError):
            ptr.get_path(df.schema, ptr.join(name, "q"))
    assert ptr.is_protected("/a/b", ["/a"]) and not ptr.is_protected("/ab", ["/a"])
    flag = ptr.is_protected_col(F.lit("/a/b"), F.array(F.lit("/a")))
    assert spark.range(1).select(flag).head()[0]


def test_structural_paths_enter_arrays():
    schema = T._parse_datatype_string("a struct<b: array<struct<c: int>>, e: struct<>>, d: map<string, int>")
    assert ptr.leaf_paths(schema) == ["/a/b", "/a/e", "/d"]
    assert ptr.structural_paths(schema) == ["/a", "/a/b", "/a/b/*/c", "/a/e", "/d"]


def test_four_equalities_differ(spark):
    one = spark.range(1)
    d, i = T.DoubleType(), T.LongType()

    def ask(col):
        return one.select(col).head()[0]

    assert ask(V.same(F.lit(1), F.lit(1.0), i))
    assert ask(V.value_key(F.lit(1), i) == V.value_key(F.lit(1.0), d)) is False
    assert ask(V.same(F.lit(float("nan")), F.lit(float("nan")), d))
    assert ask(V.same_tolerant(F.lit(float("nan")), F.lit(float("nan")), d, d)) is False
    assert ask(V.same_tolerant(F.lit(1.0), F.lit(1.0 + 1e-13), d, d))
    assert ask(V.same_tolerant(F.lit(1.0), F.lit(1.0 + 1e-9), d, d)) is False
    assert ask(V.same_tolerant(F.lit(float("inf")), F.lit(5.0), d, d)) is False
    assert ask(V.same_tolerant(F.lit(float("inf")), F.lit(float("inf")), d, d))
    assert ask(V.same_tolerant(F.lit(None).cast("double"), F.lit(5.0), d, d)) is False
    a = table(spark, [(1,)], "x int")
    b = table(spark, [(1.0,)], "x double")
    fps = [c.df.select(V.fingerprint(c.schema)).head()[0] for c in (a, b)]
    assert fps[0] != fps[1]


def test_fingerprint_ignores_key_order(spark):
    a = spark.sql("SELECT named_struct('p', 1, 'q', 2) AS s, 'x' AS t")
    b = spark.sql("SELECT 'x' AS t, named_struct('q', 2, 'p', 1) AS s")
    assert a.select(V.fingerprint(a.schema)).head()[0] == b.select(V.fingerprint(b.schema)).head()[0]


# ---------------------------------------------------------------- constraints


def test_each_field_rule_counts(spark):
    c = table(spark, [("a1", 5.0, "7"), ("b", None, "x"), ("", -1.0, "7")], "k string, n double, t string")
    fields = [
        {"path": "/k", "physical_type": "string", "pattern": "[a-z][0-9]", "unique": True},
        {"path": "/n", "physical_type": "integer", "minimum": 0, "maximum": 4},
        {"path": "/t", "minimum": 1, "allowed_values": ["7"], "unique": True},
        {"path": "/zz", "nullable": True},
    ]
    got = {(r["path"], r["rule"]): r["failed"] for r in validate.field_constraints(c, fields).collect()}
    assert got == {
        ("/k", "null_or_empty"): 1, ("/k", "type"): 0, ("/k", "pattern"): 1, ("/k", "unique"): 0,
        ("/n", "null_or_empty"): 1, ("/n", "type"): 2, ("/n", "not_numeric"): 0, ("/n", "minimum"): 1, ("/n", "maximum"): 1,
        ("/t", "null_or_empty"): 0, ("/t", "allowed_values"): 1, ("/t", "not_numeric"): 1, ("/t", "minimum"): 0, ("/t", "unique"): 1,
        ("/zz", "missing"): 3,
    }


def test_machine_rules_null_and_coercion(spark):
    c = table(spark, [("10", "9"), ("", "9"), ("x", "9")], "a string, b string")
    rule = {"name": "r", "kind": "comparison", "left": "/a", "right": "/b", "operator": ">"}
    cases = [({}, 2), ({"coerce": "number"}, 2), ({"coerce": "number", "allow_null": True}, 1), ({"coerce": "date"}, 3), ({"operator": "~"}, 3)]
    for extra, failed in cases:
        assert validate.machine_rules(c, [{**rule, **extra}]).head()["failed"] == failed, extra


# ---------------------------------------------------------------- sampling


def keys(spark, n=2000):
    return spark.range(n).select(F.lit("t").alias("record_path"), F.col("id").alias("record_index"))


@pytest.mark.parametrize("k", [0, 1, 37, 1999, 2000])
def test_sample_size_is_exact_and_repeatable(spark, k):
    one = {r["record_index"] for r in corrupt.sample_records(keys(spark), k, 5).rows.collect()}
    two = {r["record_index"] for r in corrupt.sample_records(keys(spark).repartition(17), k, 5).rows.collect()}
    assert len(one) == k and one == two


def test_sample_test_covers_the_sample_and_asks_no_more_than_there_is(spark):
    pick = corrupt.sample_records(keys(spark), 100, 5)
    chosen = {r["record_index"] for r in pick.rows.collect()}
    covered = {r["record_index"] for r in keys(spark).where(pick.maybe).collect()}
    assert chosen <= covered and len(covered) < 150
    with pytest.raises(PatinaError):
        corrupt.sample_records(keys(spark), 2001, 5)


@pytest.mark.parametrize("n,count", [(0, 0), (1, 0), (19, 0), (20, 1), (100, 5)])
def test_target_count_is_floored(n, count):
    assert corrupt.Rate.read(0.05).of(n) == count
    assert corrupt.Rate.read("0.02").of(10**12 + 7) == (10**12 + 7) * 2 // 100
    for bad in (0.051, -0.01, True, "x", "1/20", None, float("inf")):
        with pytest.raises(PatinaError):
            corrupt.Rate.read(bad)


def test_weights_steer_the_error_types(spark):
    c = Collection(spark.range(20000).select(F.col("id").alias("record_index"), F.lit("x").alias("v"), F.lit("y").alias("w")))
    errors = [corrupt.ErrorType("rare", 1.0, ("/v",)), corrupt.ErrorType("often", 3.0, ("/v", "/w"))]
    plan = corrupt.corruption_plan([c], errors, 0.05, 9)
    rows = plan.targets.collect()
    n = Counter(r["error_type"] for r in rows)
    assert len(rows) == 1000 and 0.2 < n["rare"] / 1000 < 0.3
    f = Counter(r["suggested_field"] for r in rows if r["error_type"] == "often")
    assert 0.4 < f["/w"] / n["often"] < 0.6
    order = [r["patch_id"] for r in sorted(rows, key=lambda r: r["global_record_index"])]
    assert order == [f"dirty-{k:06d}" for k in range(1, 1001)]


def test_fewer_targets_than_collections(spark):
    def small(name):
        df = spark.range(20).select(F.col("id").alias("record_index"), F.lit("x").alias("v"))
        return Collection(df, name)

    parts = [small(n) for n in ("a", "b", "c")]
    plan = corrupt.corruption_plan(parts, [corrupt.ErrorType("e", 1.0, ("/v",))], 0.035, 3, coverage="all_eligible_when_feasible")
    got = [r["record_path"] for r in plan.targets.collect()]
    assert plan.target_count == 2 and len(set(got)) == 2 and not plan.fully_coverable
    protected = corrupt.corruption_plan(parts, [corrupt.ErrorType("e", 1.0, ("/v",))], 0.05, 3, {"a": ["/v"]}, "all_eligible_when_feasible")
    assert {r["record_path"] for r in protected.targets.collect()} == {"b", "c"}


def test_delimited_patches_are_text(spark):
    c = table(spark, [("1", "a")] * 40, "n string, t string", format="csv", columns=["n", "t"])
    plan = corrupt.corruption_plan([c], [corrupt.ErrorType("missing_value", 1.0, ("/t",))], 0.05, 3)
    patches = corrupt.derive_patches(plan, c, {"missing_value": F.lit(None).cast("string")}, {"missing_value": "gone"})
    dirty = corrupt.apply_patches(c, patches, maybe=plan.maybe)
    assert Counter(r["t"] for r in dirty.df.collect()) == {"a": 38, "": 2}
    change = corrupt.build_manifest(c, patches).head()["changes"][0]
    assert (change["clean_value"], change["dirty_value"]) == ("a", "")
    man = corrupt.build_manifest(c, patches)
    assert validate.manifest_evidence(man, c, dirty).count() == 0
    bad = patches.withColumn("changes", F.transform("changes", lambda x: x.withField("value", F.lit('{"a":1}'))))
    assert "nested_value" in {r["rule"] for r in corrupt.patch_violations(plan, bad, [c]).collect()}


# ---------------------------------------------------------------- comparisons


def test_overlap_counts_rows_but_distinct_identifiers(spark):
    s = table(spark, [("a",), ("a",), ("b",), (None,)], "k string")
    c = table(spark, [("a",), ("a",), ("a",), ("c",), (None,)], "k string")
    assert compare.row_overlap(s, c).head()[0] == 4
    assert compare.identifier_overlap(s, c, ["/k"]).head()["overlap_count"] == 1
    assert compare.identifier_overlap(s, c, []).collect() == []


def test_content_equality_minds_order_and_length(spark):
    a = table(spark, [("a",), ("b",)], "k string")
    def equal(b):
        return compare.content_equal(a, b).head()["equal"]

    assert equal(a)
    assert not equal(table(spark, [("b",), ("a",)], "k string"))
    assert not equal(table(spark, [("a",), ("b",), ("c",)], "k string"))
    assert not equal(table(spark, [("a",), ("b",)], "other string"))


def test_changed_paths_report_whole_arrays_and_lost_keys(spark):
    a = table(spark, [((1, [1, 2]),)], "s struct<x:int,y:array<int>>")
    b = table(spark, [((1, [1, 3]),)], "s struct<x:int,y:array<int>>")
    assert cells.changed_paths(a, b).head()["paths"] == ["/s/y"]
    gone = table(spark, [((1,),)], "s struct<x:int>")
    assert cells.changed_paths(a, gone).head()["paths"] == ["/s/y"]


def test_variant_structure_ignores_values(spark):
    rows = ['{"a":{"b":1},"c":[{"d":1},{"d":2}]}', '{"a":{"b":"x"},"c":[]}', '{"c":null}']
    df = spark.createDataFrame(list(enumerate(rows)), "record_index bigint, j string")
    c = Collection(df.select("record_index", F.parse_json("j").alias("record")))
    got = {r["record_index"]: r["structure"] for r in cells.variant_structures(c).collect()}
    assert got == {0: ["/a", "/a/b", "/c", "/c/*/d"], 1: ["/a", "/a/b", "/c"], 2: ["/c"]}
    assert cells.variant_leaf_paths(c) == ["/a/b", "/c"]


def test_bad_novelty_contracts():
    for bad in (
        dict(minimum_changed=0.4), dict(high_similarity=1.0), dict(maximum_high_similarity=0.6), dict(minimum_changed=True),
        dict(exemptions={"/a": " "}), dict(exemptions={"a": "x"}),
    ):
        assert compare.NoveltyContract(**bad).violations(), bad
    assert compare.NoveltyContract().violations() == []


# ---------------------------------------------------------------- catalogue


def entries(spark):
    rows = [
        ("a", "climate", "Toronto International A", "2023", "toronto", "Ontario", "a.csv"),
        ("b", "climate", "Vancouver International A", "2023", "vancouver", "British Columbia", "b.csv"),
        ("c", "transport", "January trips", "2023-01", "", "", "c.parquet"),
    ]
    return spark.createDataFrame(rows, "id string, site string, title string, period string, station string, province string, filename string")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_catalogue_filters(spark):
    cat = entries(spark)
    assert ids(catalog.catalog_filter(cat, site="climate", province="", station="")) == ["a", "b"]
    assert ids(catalog.catalog_filter(cat, site="climate", province="Ontario")) == ["a"]
    assert ids(cat.where(catalog.name_search("title", " INTERNATIONAL "))) == ["a", "b"]
    assert ids(cat.where(catalog.name_search("title", "international", "begins"))) == []
    assert ids(cat.where(catalog.name_search("title", "van", "begins"))) == ["b"]
    assert ids(cat.where(catalog.keyword_search(["title", "period"], "airplane travel JSON", "Airplane"))) == ["a", "b", "c"]
    assert ids(catalog.catalog_lookup(cat, "climate", "a")) == ["a"]
    assert ids(catalog.catalog_lookup(cat, "transport", "a")) == []
    assert [catalog.page_limit(n) for n in (10, 25, 50, 7, None)] == [10, 25, 50, 25, 25]
    asked = spark.createDataFrame([("a.csv",), ("secret",)], "filename string")
    assert [r[0] for r in catalog.known_files(asked, cat).collect()] == ["a.csv"]


def test_file_scores(spark):
    want = spark.createDataFrame([("x", 3, "aa"), ("y", 3, "bb"), ("z", 3, "cc")], "filename string, bytes bigint, sha256 string")
    for rows, score in (
        ([("none", 1, "q")], 0.0),
        ([("x", 3, "aa"), ("y", 3, "bX"), ("z", 4, "cc")], 1 / 3),
        ([("x", 3, "aa"), ("y", 3, "bb"), ("z", 3, "cc")], 1.0),
    ):
        got = spark.createDataFrame(rows, "filename string, bytes bigint, sha256 string")
        assert catalog.overall_score(catalog.check_files(want, got)).head()[0] == pytest.approx(score)


def test_release_gate(spark):
    ok = spark.createDataFrame([("a", True, True)], "id string, audit_passed boolean, validation_passed boolean")
    no = spark.createDataFrame([("a", True, False)], "id string, audit_passed boolean, validation_passed boolean")
    digests = spark.createDataFrame([("f", "11")], "filename string, sha256 string")
    stale = spark.createDataFrame([("f", "12")], "filename string, sha256 string")
    catalog.release_gate(ok, digests, digests)
    for approved, audited in ((no, digests), (ok, stale)):
        with pytest.raises(PatinaError):
            catalog.release_gate(approved, audited, digests)
    assert catalog.overwritten_releases(digests, stale).count() == 1
    assert catalog.overwritten_releases(digests, digests).count() == 0


def test_header_rows(spark):
    def row(f, no, cells_):
        return (f, no, [None if c is None else str(c) for c in cells_], [isinstance(c, str) for c in cells_])

    grid = [
        row("plain", 1, ["id", "name", "n"]), row("plain", 2, [1, "x", 3]),
        row("titled", 2, ["Report 2023", None, None]), row("titled", 4, ["id", "name", "n"]), row("titled", 5, ["a", "b", "a"]),
        row("notes", 1, ["a", "b"]), row("notes", 2, ["x", "y", "z"]),
        row("tie", 1, ["T"]), row("tie", 3, ["a", "b"]), row("tie", 4, ["c", "d"]),
        row("late", 1, ["x"]), row("late", 60, ["a", "b", "c"]),
    ]
    df = spark.createDataFrame(grid, "file string, row_no int, cells array<string>, is_text array<boolean>")
    got = {r["file"]: r["header_row"] for r in headers.detect_header_rows(df).collect()}
    assert got == {"plain": 1, "titled": 4, "notes": 1, "tie": 3, "late": 1}


def test_foreign_patches_are_refused_where_they_are_applied(spark):
    clean = Collection(spark.range(10).select(F.col("id").alias("record_index"), F.col("id").alias("a")))
    schema = (
        "patch_id string, record_path string, record_index bigint, error_type string, explanation string, "
        "changes array<struct<path:string,value:string>>"
    )
    good = ("p0", "", 3, "e", "why", [("/a", "7")])
    other = ("p1", "elsewhere", 99, "e", "why", [("/zz", "7")])
    for bad, fields, maybe in (
        (("p2", "", 99, "e", "why", [("/a", "7")]), ["/a"], None),
        (("p2", "", 4, "e", "why", [("/a", "7"), ("/zz", "7")]), None, None),
        (("p2", "", 4, "e", "why", [("/a", "7")]), [], None),
        (("p2", "", 4, "e", "why", [("/a", "7")]), ["/a"], F.col("record_index") < 4),
    ):
        patches = spark.createDataFrame([good, other, bad], schema)
        for use in (corrupt.apply_patches, corrupt.build_manifest):
            with pytest.raises(PatinaError, match="foreign"):
                use(clean, patches, fields, maybe)
    patches = spark.createDataFrame([good, other], schema)
    dirty = corrupt.apply_patches(clean, patches, ["/a"], F.col("record_index") < 4)
    assert sorted(r.a for r in dirty.df.collect()) == [0, 1, 2, 4, 5, 6, 7, 7, 8, 9]
    assert corrupt.build_manifest(clean, patches, ["/a"]).count() == 1


def test_evidence_shows_the_first_violations_and_counts_all(spark, monkeypatch):
    monkeypatch.setattr(order, "BUCKET_ROWS", 10)
    monkeypatch.setattr(order, "FAN", 3)
    coll = table(spark, [(k if k % 2 else -k,) for k in range(200)], "n int")
    broken = validate.field_violations(coll, [{"path": "/n", "minimum": 0}])
    row = audit.first_broken(broken, 200, also=["path", "rule"]).head()
    bad = [k for k in range(2, 200, 2)]
    assert row["violations"] == len(bad) and [e["record_index"] for e in row["first"]] == bad[:25]
    by_rule = audit.first_broken(broken, 200, 3, by=["rule"]).collect()
    assert [(r["rule"], r["violations"], [e["record_index"] for e in r["first"]]) for r in by_rule] == [("minimum", len(bad), bad[:3])]
    none = audit.first_broken(validate.field_violations(coll, []), 200).head()
    assert none["violations"] == 0 and none["first"] == []
    report = R.Report(spark)
    report.add_broken("x", broken, 200, ["path", "rule"])
    seen = report.checks().head()
    assert seen["status"] == "failed" and json.loads(seen["evidence"])["violations"] == len(bad)
    assert len(json.loads(seen["evidence"])["first"]) == 25


def test_a_changed_type_is_a_change_and_no_error(spark):
    a = table(spark, [(1, 2), (None, 3)], "n int, m int")
    b = table(spark, [("N/A", 2.0), (None, 3.5)], "n string, m double")
    got = {r["record_index"]: r["paths"] for r in cells.changed_paths(a, b).collect()}
    assert got == {0: ["/n"], 1: ["/m"]}


def test_digests_of_records_are_worked_out_once(spark):
    c = Collection(spark.createDataFrame([(0, "a", 1.0), (1, None, None)], "record_index long, s string, x double"))
    digest = c.df.select(V.fingerprint(c.schema).alias("fp"))
    assert not digest.schema["fp"].nullable
    assert [r.fp for r in digest.orderBy("fp").collect()] == sorted(
        hashlib.sha256(t.encode()).hexdigest() for t in ('{"s":"a","x":1.0}', '{"s":null,"x":null}')
    )
    for df in (compare.row_overlap(c, c), validate.dirty_keys([c], {"": c})):
        # A filter for nulls would repeat the digest below the shuffle.
        assert "isnotnull(sha2" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_a_plan_does_not_look_for_its_records_again(spark):
    c = Collection(spark.range(400).selectExpr("id AS record_index", "id AS x"))
    plan = corrupt.corruption_plan([c], [corrupt.ErrorType("range_violation", 1.0, ("/x",))], "0.05", 3)
    assert "Range (" not in plan.targets._jdf.queryExecution().optimizedPlan().toString()
    assert plan.targets.select("record_index").distinct().count() == 20


def test_edge_rows_are_the_first_and_last_values_of_buckets(spark):
    rows = [(k, k // 10, None if k % 4 else k, "x" if 12 <= k < 18 else None) for k in range(35)]
    df = spark.createDataFrame(rows, "record_index long, __bucket long, a long, b string")
    got = order.edge_rows(df, ["a", "b"], 4)
    want = set()
    for j in (2, 3):
        for b in range(4):
            held = [r[0] for r in rows if r[1] == b and r[j] is not None]
            want |= {min(held), max(held)} if held else set()
    assert sorted(r.record_index for r in got.collect()) == sorted(want)
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
