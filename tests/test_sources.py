"""Readers and writers, on files written by the tests."""

import csv
import gzip
import hashlib
import io
import itertools
import json
import random

import pytest
from pyspark import TaskContext
from pyspark.sql import Row
from pyspark.sql import functions as F

from patina import Collection
from patina.errors import PatinaError
from patina.operators import order
from patina.sources import collections as C
from patina.sources import lines as L
from patina.sources import readers as R
from patina.sources import writers as W
from patina.sources.digests import part_hasher
from queries import QUERIES, io_queries


def numbered(spark, rows, schema=None):
    df = spark.createDataFrame(rows, schema) if schema else spark.createDataFrame(rows)
    return Collection(df)


def test_delimited_cells_are_text_and_round_trip(spark, tmp_path):
    p = tmp_path / "a.csv"
    text = '﻿id,Date/Time,note\n1,,"said ""hi"""\n2,"",  padded  \n3,x,"two\nlines"\n'
    p.write_bytes(text.encode("utf-8"))
    c = R.read_delimited(spark, str(p), order_by=["id"])
    rows = c.df.orderBy("record_index").collect()
    assert c.meta["columns"] == ["id", "Date/Time", "note"]
    assert [r["note"] for r in rows] == ['said "hi"', "  padded  ", "two\nlines"]
    assert [r["Date/Time"] for r in rows] == ["", "", "x"]
    out = str(tmp_path / "out")
    W.write_delimited(c, out)
    again = R.read_delimited(spark, out, order_by=["id"])
    assert again.df.orderBy("record_index").collect() == rows


def test_rows_longer_than_the_header_are_refused(spark, tmp_path):
    for name, text, n in (
        ("long", 'a,b\n1,2,3\n1,"x\ny"\n', 1),
        ("empty", 'a,b\n1,2,\n1,2,,\n"x\ny",2,"z, ""q"\n1\n', 3),
        ("one", "a\n1\n1,2\n", 1),
    ):
        p = tmp_path / f"{name}.csv"
        p.write_text(text)
        with pytest.raises(PatinaError, match=f"{n} rows have more cells"):
            R.read_delimited(spark, str(p), order_by=["a"])
    short = tmp_path / "short.csv"
    short.write_text('a,b,c\n1\n2,"x\ny"\n3,,\n')
    rows = R.read_delimited(spark, str(short), order_by=["a"]).df.orderBy("a").collect()
    assert [(r.a, r.b, r.c) for r in rows] == [("1", "", ""), ("2", "x\ny", ""), ("3", "", "")]


def test_release_catalogue_has_bytes_and_digests(spark, tmp_path):
    for k, name in enumerate(io_queries.FILES):
        rows = spark.range(k + 1).withColumnRenamed("id", f"{name}_key").coalesce(1)
        rows.write.parquet(str(tmp_path / f"dir_{name}"))
        part = next((tmp_path / f"dir_{name}").glob("part-*.parquet"))
        (tmp_path / f"{name}.parquet").write_bytes(part.read_bytes())
    got = {r.filename: r for r in QUERIES["file_catalog"](spark, str(tmp_path)).collect()}
    assert len(got) == len(io_queries.FILES)
    for k, name in enumerate(io_queries.FILES):
        r, held = got[f"{name}.parquet"], (tmp_path / f"{name}.parquet").read_bytes()
        assert (r.bytes, r.sha256) == (len(held), hashlib.sha256(held).hexdigest())
        assert (r.id, r.site, r.title, r.format, r.rows) == (name, "tpch", name, "PARQUET", k + 1)
        assert (r.period, r.station, r.province, r["columns"]) == (None, "", "", [f"{name}_key"])


@pytest.fixture
def small_splits(spark):
    """Splits of a few dozen bytes, so that small files are read by many tasks."""
    settings = {"spark.sql.files.maxPartitionBytes": "96", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def delimited_file(rng, rows, quoted, end):
    """Rows of three cells as CSV text; cells hold what ``quoted`` allows."""
    words = ["a", "", "bb c", 'x "y', '5" z', "7", " d ", "é"]
    hard = ["q,r", 'say ""hi""', "l1\nl2", "\n\n", 'o,""\n,""', "\r\nw", "", ",", '""']
    out = []
    for _ in range(rows):
        cells = [f'"{rng.choice(hard)}"' if quoted and rng.random() < 0.3 else rng.choice(words) for _ in range(3)]
        out.append(",".join(cells) + end)
        if rng.random() < 0.1:
            out.append(end)  # a blank row
    return "".join(out)


@pytest.mark.parametrize(("quoted", "end"), [(False, "\n"), (False, "\r\n"), (True, "\n"), (True, "\r\n")])
def test_delimited_rows_keep_the_order_of_many_files_and_splits(spark, tmp_path, small_splits, quoted, end):
    rng = random.Random(f"{quoted}{end}")
    want = []
    for k in range(5):
        text = f"a,b,c{end}" + delimited_file(rng, (0, 1, 12, 3, 20)[k], quoted, end)
        if k == 3:
            text = "\ufeff" + text.rstrip("\r\n")
        (tmp_path / f"part-{k}.csv").write_bytes(text.encode())
        rows = csv.reader(io.StringIO(text.removeprefix("\ufeff"), newline=""))
        want += [tuple(r) for r in list(rows)[1:] if r]
    c = R.read_delimited(spark, str(tmp_path))
    got = c.df.orderBy("record_index").collect()
    assert [r.record_index for r in got] == list(range(len(want)))
    assert [(r.a, r.b, r.c) for r in got] == want
    assert L.has_open_lines(L.text_lines(spark, str(tmp_path)), ",") == quoted


def test_quoted_breaks_across_buckets_and_levels(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(order, "BUCKET_ROWS", 4)
    monkeypatch.setattr(order, "FAN", 3)
    rng = random.Random(5)
    text = "a,b,c\n" + delimited_file(rng, 20, True, "\n") + '"' + "z\n" * 30 + '",1,2\n'
    (tmp_path / "one.csv").write_text(text)
    want = [tuple(r) for r in csv.reader(io.StringIO(text, newline="")) if r][1:]
    got = R.read_delimited(spark, str(tmp_path)).df.orderBy("record_index").collect()
    assert [(r.record_index, r.a, r.b, r.c) for r in got] == [(k, *r) for k, r in enumerate(want)]


def test_records_of_several_lines_are_joined_once(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    c = R.read_delimited(spark, str(tmp_path))
    plan = c.df._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "record_no" in plan  # what later jobs read is stored
    assert [tuple(r) for r in c.df.orderBy("record_index").collect()] == [("1", "x\ny", 0), ("2", "z", 1)]


def test_quote_ends_against_a_state_machine(spark):
    def ends(line, inside):
        start = not inside
        k = 0
        while k < len(line):
            ch = line[k]
            if inside and ch == '"' and line[k + 1 : k + 2] == '"':
                k += 1
            elif inside and ch == '"':
                inside = False
            elif not inside and ch == '"' and start:
                inside, start = True, False
                k += 1
                continue
            start = not inside and ch == ";"
            k += 1
        return inside

    texts = ["".join(t) for n in range(6) for t in itertools.product('";x', repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "line string")
    outside, inside = L.quote_ends(F.col("line"), ";")
    for t, o, i in df.select("line", outside, inside).collect():
        assert (o, i) == (ends(t, False), ends(t, True)), t


def test_folders_with_unlike_headers_or_endless_quotes_are_refused(spark, tmp_path):
    for name, texts, message in (
        ("swapped", ["a,b\n1,2\n", "b,a\n1,2\n"], "headers differ"),
        ("endless", ["a,b\n1,2\n", 'a,b\n1,"2\n3,4\n'], "never ends"),
        ("empty", ["", "\n"], "no header"),
    ):
        (tmp_path / name).mkdir()
        for k, text in enumerate(texts):
            (tmp_path / name / f"{k}.csv").write_text(text)
        with pytest.raises(PatinaError, match=message):
            R.read_delimited(spark, str(tmp_path / name))
    (tmp_path / "bare").mkdir()
    for k in range(2):
        (tmp_path / "bare" / f"{k}.csv").write_text("a,b\n")
    assert R.read_delimited(spark, str(tmp_path / "bare")).df.collect() == []


def test_other_encodings(spark, tmp_path):
    for encoding in ("UTF-8", "ISO-8859-1", "UTF-16"):
        p = tmp_path / f"{encoding}.csv"
        p.write_bytes('n,é\n1,"ü\nö"\n\n2,ß\n'.encode(encoding))
        c = R.read_delimited(spark, str(p), encoding=encoding)
        assert [tuple(r) for r in c.df.orderBy("record_index").collect()] == [("1", "ü\nö", 0), ("2", "ß", 1)]


def test_jsonl_keeps_file_order_types_and_missing_keys(spark, tmp_path, small_splits):
    rng, want = random.Random(3), []
    for k in range(4):
        rows = [rng.choice(['{"a": 1}', '{"a": "x", "b": [1]}', "{}", '{"a": null}', '{"a": 1.5}']) for _ in range((9, 0, 1, 14)[k])]
        (tmp_path / f"{k}.jsonl").write_text("\n \n".join(rows))
        want += [json.dumps(json.loads(r), separators=(",", ":")) for r in rows]
    c = R.read_jsonl(spark, str(tmp_path), variant=True)
    assert c.is_variant
    got = c.df.orderBy("record_index").select("record_index", F.to_json("record")).collect()
    assert [tuple(r) for r in got] == list(enumerate(want))
    typed = R.read_jsonl(spark, str(tmp_path))
    assert typed.count() == len(want) and typed.data_columns == ["a", "b"]


def test_json_documents_follow_each_other(spark, tmp_path):
    roots, boxes = tmp_path / "roots", tmp_path / "boxes"
    roots.mkdir(), boxes.mkdir()
    for k, n in enumerate((2, 0, 3, 1)):
        items = [{"k": 10 * k + j, "VOID": {"OBJECT": None}} for j in range(n)]
        (roots / f"{k}.json").write_text(json.dumps(items))
        (boxes / f"{k}.json").write_text(json.dumps({"meta": k, "rows": items}))
    want = [(0, 0), (1, 1), (2, 20), (3, 21), (4, 22), (5, 30)]
    for path, at in ((roots, None), (boxes, "/rows")):
        for variant in (False, True):
            c = R.read_json(spark, str(path), at, variant)
            k = F.variant_get("record", "$.k", "int") if variant else F.col("k")
            assert [tuple(r) for r in c.df.select("record_index", k).orderBy("record_index").collect()] == want
    assert R.read_json(spark, str(roots)).paths == ["/VOID/OBJECT", "/k"]
    with pytest.raises(PatinaError, match="several containers"):
        C.select_collection(spark.createDataFrame([Row(xs=[Row(a=1)]), Row(xs=[Row(a=2)])]))
    (roots / "z.json").write_text("{}")
    with pytest.raises(PatinaError, match="arrays"):
        R.read_json(spark, str(roots))


def test_large_files_are_hashed_in_blocks(spark, tmp_path):
    for name, size in (("s p.bin", 1), ("b.bin", 999), ("c.bin", 1000), ("d.bin", 1001), ("e.bin", 70_000)):
        (tmp_path / name).write_bytes(random.Random(name).randbytes(size))
    got = {r.filename: r for r in R.file_digests(spark, str(tmp_path), read_whole=1000, block=64).collect()}
    assert len(got) == 5
    for name, r in got.items():
        held = (tmp_path / name).read_bytes()
        assert (r.bytes, r.sha256) == (len(held), hashlib.sha256(held).hexdigest())


def test_large_files_are_hashed_in_parts(spark, tmp_path, monkeypatch):
    """No task reads more than one part of one file, whatever its length, and files end in different turns."""
    sizes = {"a.bin": 1001, "b.bin": 2000, "c.bin": 2001, "d.bin": 6000, "e.bin": 6063, "f.bin": 9999, "g.bin": 9999, "h.bin": 999}
    (tmp_path / "in").mkdir()
    for name, size in sizes.items():
        (tmp_path / "in" / name).write_bytes(random.Random(name).randbytes(size))
    (tmp_path / "in" / "z.gz").write_bytes(gzip.compress(random.Random(1).randbytes(3000)))
    log, real = str(tmp_path / "log"), R.part_hasher

    def logged(block):
        able, hash_part = real(block)

        def noted(path, length, at, stop, state):
            with open(log, "a") as out:
                out.write(f"{TaskContext.get().taskAttemptId()} {path} {at} {stop}\n")
            return hash_part(path, length, at, stop, state)

        return able, noted

    monkeypatch.setattr(R, "part_hasher", logged)
    monkeypatch.setattr(R, "STAGED_TURNS", 3)
    got = R.file_digests(spark, str(tmp_path / "in"), read_whole=1000, block=300, part=1000).collect()
    assert len(got) == len(sizes) + 1
    for r in got:
        held = (tmp_path / "in" / r.filename).read_bytes()
        assert (r.bytes, r.sha256) == (len(held), hashlib.sha256(held).hexdigest())
    reads = [line.split() for line in open(log)]
    spans = {}
    for task, path, at, stop in reads:
        assert int(stop) - int(at) <= 1000
        spans.setdefault(path[-5:], []).append((int(at), int(stop)))
    assert len({r[0] for r in reads}) == len(reads)
    assert len(spans["f.bin"]) == 10 and "h.bin" not in spans
    for name, size in sizes.items():
        if size > 1000:
            assert sorted(spans[name]) == [(k, min(k + 1000, size)) for k in range(0, size, 1000)]


def test_a_part_needs_no_earlier_bytes(tmp_path):
    able, hash_part = part_hasher(64)
    p, held = tmp_path / "f", random.Random(5).randbytes(1000)
    for cut in (1, 63, 64, 65, 128, 999):
        p.write_bytes(held)
        state, none = hash_part(f"file:{p}", 1000, 0, cut, None)
        assert none is None
        p.write_bytes(bytes(cut) + held[cut:])
        assert hash_part(f"file:{p}", 1000, cut, 1000, state) == (None, hashlib.sha256(held).hexdigest())
    assert able(f"file:{p}") == (True, True)
    assert able(f"file:{p}.gone") == able("nowhere://f") == (False, False)
    with pytest.raises(EOFError):
        hash_part(f"file:{p}", 1001, 0, 1001, None)


@pytest.mark.parametrize("opens", [False, True])
def test_files_are_hashed_where_parts_cannot_be(spark, tmp_path, monkeypatch, opens):
    """Stores that only Spark opens: one value a file. A library without a state to hand on: one task a file."""
    held = random.Random(9).randbytes(5000)
    (tmp_path / "f.bin").write_bytes(held)
    real = R.part_hasher

    def hindered(block):
        hash_part = real(block)[1]

        def whole(path, length, at, stop, state):
            assert opens and (at, stop) == (0, length)
            return hash_part(path, length, at, stop, state)

        return (lambda path: (opens, False)), whole

    monkeypatch.setattr(R, "part_hasher", hindered)
    row = R.file_digests(spark, str(tmp_path), read_whole=1000, block=300, part=1000).head()
    assert (row["filename"], row["bytes"], row["sha256"]) == ("f.bin", 5000, hashlib.sha256(held).hexdigest())


def test_bad_headers_are_refused(spark, tmp_path):
    for name, text in {"dup": "a,a\n1,2\n", "gap": "a,,c\n1,2,3\n"}.items():
        p = tmp_path / f"{name}.csv"
        p.write_text(text)
        with pytest.raises(PatinaError):
            R.read_delimited(spark, str(p), order_by=["a"])


def test_jsonl_rejects_non_objects(spark, tmp_path):
    good = tmp_path / "g.jsonl"
    good.write_text('{"a": 2, "b": null}\n\n{"a": 1, "b": "x"}\n')
    c = R.read_jsonl(spark, str(good), order_by=["a"])
    assert [r["b"] for r in c.df.orderBy("record_index").collect()] == ["x", None]
    bad = tmp_path / "b.jsonl"
    bad.write_text('{"a": 1}\n[1]\nnope\n')
    with pytest.raises(PatinaError, match="2 lines"):
        R.read_jsonl(spark, str(bad), order_by=["a"])


def test_json_root_array_keeps_positions(spark, tmp_path):
    p = tmp_path / "r.json"
    p.write_text('[{"k": "c", "n": {"x": 1}}, {"k": "a", "n": {"x": 2}}, {"k": "b", "n": {"x": 3}}]')
    c = R.read_json(spark, str(p))
    assert [r["k"] for r in c.df.orderBy("record_index").collect()] == ["c", "a", "b"]
    assert c.paths == ["/k", "/n/x"]


def test_most_records_then_shallowest_is_selected(spark, tmp_path):
    p = tmp_path / "d.json"
    p.write_text(
        '{"meta": {"v": 1}, "deep": {"rows": [{"a": 1}, {"a": 2}]}, "top": [{"b": 1}, {"b": 2}], "few": [{"c": 1}]}'
    )
    c = R.read_json(spark, str(p))
    assert c.record_path == "/top"
    assert [r["b"] for r in c.df.orderBy("record_index").collect()] == [1, 2]
    d = R.read_json(spark, str(p), "/deep/rows")
    assert d.count() == 2
    with pytest.raises(PatinaError):
        R.read_json(spark, str(p), "/meta")


def test_slots_and_depth_have_no_bound(spark):
    schema = "few array<struct<a:int>>, grid array<array<struct<b:int>>>, cube array<array<array<struct<c:int>>>>"
    deep = "struct<rows:array<struct<d:int>>>"
    for k in range(14):
        deep = f"struct<l{k}:{deep}>"
    at = Row(rows=[Row(d=1)] * 4)
    for k in range(14):
        at = Row(**{f"l{k}": at})
    grid = [None, *[[]] * 22, [Row(b=1)], *[[]] * 10, [Row(b=k) for k in range(9)]]
    cube = [[], None, [None, *[[]] * 30, [Row(c=1)] * 3]]
    df = spark.createDataFrame([([Row(a=1)] * 2, grid, cube, at)], f"{schema}, deep {deep}")
    found = [(r[0], r[1]) for r in C.discover_collections(df).collect()]
    path = "/deep" + "".join(f"/l{k}" for k in reversed(range(14))) + "/rows"
    assert found == [("/few", 2), ("/grid/23", 1), ("/grid/34", 9), ("/cube/2/31", 3), (path, 4)]
    chosen = C.select_collection(df)
    assert chosen.record_path == "/grid/34" and chosen.count() == 9


def test_discovery_lists_object_arrays_with_counts(spark):
    df = spark.createDataFrame(
        [Row(x=1, xs=[Row(a=1), Row(a=2)], plain=[1, 2], inner=Row(ys=[Row(b=1)]))]
    )
    found = {r[0]: r[1] for r in C.discover_collections(df).collect()}
    assert found == {"/xs": 2, "/inner/ys": 1}
    lone = spark.createDataFrame([Row(a=1)])
    assert C.discover_collections(lone).collect()[0][0] == ""


def test_variant_records_tell_missing_from_null(spark, tmp_path):
    p = tmp_path / "v.json"
    p.write_text('[{"a":1},{"a":1.0},{"a":null},{},{"a":"1"}]')
    c = R.read_json(spark, str(p), variant=True)
    from patina.operators.cells import variant_cells

    got = {(r.record_index, r.physical_type) for r in variant_cells(c).collect()}
    assert got == {(0, "integer"), (1, "number"), (2, "null"), (4, "string")}


def test_parquet_index_spans_files(spark, tmp_path):
    out = str(tmp_path / "p")
    spark.range(0, 1000, 1, 7).write.parquet(out)
    c = R.read_parquet(spark, out)
    got = c.df.agg(F.min("record_index"), F.max("record_index"), F.countDistinct("record_index")).head()
    assert tuple(got) == (0, 999, 1000)


def test_writers_guard_their_input_and_types(spark, tmp_path):
    out = str(tmp_path / "p")
    spark.range(5).write.parquet(out)
    c = R.read_parquet(spark, out)
    with pytest.raises(PatinaError):
        W.write_parquet(c, out)
    bad = c.with_df(c.df.withColumn("id", F.lit("not a number")))
    with pytest.raises(Exception):
        W.write_parquet(bad, str(tmp_path / "q"), c.schema)
    nested = numbered(spark, [Row(a=Row(b=1), record_index=0)])
    with pytest.raises(PatinaError):
        W.write_delimited(nested, str(tmp_path / "n"))


def test_read_any_and_digests(spark, tmp_path):
    p = tmp_path / "one.json"
    p.write_text('[{"a": 1}]')
    assert R.read_any(spark, str(p)).count() == 1
    bare = tmp_path / "bare"
    bare.write_text('[{"a": 1}, {"a": 2}]')
    assert R.read_any(spark, str(bare)).count() == 2
    import hashlib

    row = R.file_digests(spark, str(p)).head()
    assert row["bytes"] == 10
    assert row["sha256"] == hashlib.sha256(b'[{"a": 1}]').hexdigest()
    pinned = spark.createDataFrame([("one.json", "0" * 64)], "filename string, sha256 string")
    assert R.snapshot_audit(R.file_digests(spark, str(p)), pinned).head()["status"] == "drifted"


def test_write_collections_makes_a_directory_each(spark, tmp_path):
    a = numbered(spark, [Row(x=1, record_index=0)])
    a.record_path, a.meta = "/a", {"format": "jsonl"}
    b = numbered(spark, [Row(y=None, record_index=0)], "y int, record_index bigint")
    b.record_path, b.meta = "/b", {"format": "jsonl"}
    W.write_collections([a, b], str(tmp_path / "box"))
    text = spark.read.text(str(tmp_path / "box" / "b")).collect()[0][0]
    assert text == '{"y":null}'
