"""Archives are written and read back; headers alone decide what is read."""

import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from patina.errors import PatinaError
from patina.llm import warc

BIG, OTHER = "é<p>" * 400, "x" * 1000
ROWS = [
    (1, "http://a/1", BIG, "k"), (5, "http://a/5\r\nWARC-Type: bad", BIG, None), (3, None, BIG, "k"), (7, "u%0Ay%zz", "short", "k"),
    (8, "", "short", "k"), (9, "http://b", None, "k"), (10, "http://b", "", "k"), (11, "x", OTHER, "k"), (11, "x", OTHER, "k"),
    (12, "y", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40, "k"), (None, "z", BIG, "k"), (2, "w", OTHER, "k"), (13, "n", "\r\n\r\n", "k"),
]
SCHEMA = "page_id long, url string, html string, record_type string"


@pytest.fixture(scope="module")
def archives(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warc") / "out")
    warc.write_pages(spark.createDataFrame(ROWS, SCHEMA).repartition(3), folder)
    return folder


def test_round_trip(spark, archives):
    found = warc.read_warc(spark, archives).collect()
    assert len(found) == len(ROWS)
    by = {}
    for r in found:
        by.setdefault(r.record_id, []).append(r)
    for page, url, html, _ in ROWS:
        r = by[f"<urn:page:{'' if page is None else page}>"][0]
        payload = (html or "").encode()
        assert r.payload_digest == hashlib.sha1(payload).hexdigest()
        assert int(r.http_headers["content-length"]) == len(payload)
        assert bytes(r.payload) == (payload if r.record_type == "response" else b"")
        assert (r.target_uri is None) == (url is None)
    kinds = {k: {(r.record_type, r.refers_to) for r in v} for k, v in by.items()}
    five = ("revisit", "<urn:page:5>")
    assert kinds["<urn:page:1>"] == kinds["<urn:page:3>"] == kinds["<urn:page:>"] == {five}
    assert kinds["<urn:page:2>"] == {("revisit", "<urn:page:11>")}
    for name in ("5", "7", "8", "9", "10", "11", "12", "13"):
        assert kinds[f"<urn:page:{name}>"] == {("response", None)}
    assert by["<urn:page:5>"][0].target_uri == "http://a/5%0D%0AWARC-Type: bad"


def test_page_keys(spark, archives):
    found = warc.read_warc(spark, archives, payloads=False)
    keys = [r.k for r in found.select(warc.page_key(F.col("record_id")).alias("k")).collect()]
    assert sorted(map(str, keys)) == sorted(str(r[0]) for r in ROWS)
    assert found.where(F.col("payload").isNotNull()).count() == 0


def test_filters_are_pushed_into_the_reader(spark, archives):
    some = warc.read_warc(spark, archives).where((F.col("record_type") == "revisit") & (F.col("offset") >= 0))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("PushedFilters", "").replace("ReadFilters", "") or "revisit" not in plan.split("BatchScan")[0]
    assert {r.record_type for r in some.collect()} == {"revisit"}
    ids = ["<urn:page:7>", "<urn:page:13>"]
    assert warc.read_warc(spark, archives).where(F.col("record_id").isin(ids)).count() == 2


class Guarded(io.BytesIO):
    """Counts the bytes of bodies that are decoded, which a skip reads in one piece."""


def test_unwanted_payloads_are_skipped():
    def record(kind, body):
        return (
            f"WARC/1.1\r\nWARC-Type: {kind}\r\nContent-Type: application/http\r\nContent-Length: {len(body)}\r\n\r\n".encode()
            + body
            + b"\r\n\r\n"
        )

    broken = b"HTTP/1.1 200 OK\r\nno colon here \xff\xff\r\n\r\n" + b"\x00" * 10
    stream = io.BytesIO(record("request", broken) + record("response", b"HTTP/1.1 200 OK\r\n\r\nhi"))
    rows = list(warc.read_records(stream, lambda h: h["warc-type"] == "response", True))
    assert [(r[1], r[9]) for r in rows] == [("response", b"hi")]


def test_damaged_archives_are_refused():
    with pytest.raises(PatinaError):
        list(warc.read_records(io.BytesIO(b"no archive\r\n"), lambda h: True, True))
    cut = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\nshort"
    with pytest.raises(PatinaError):
        list(warc.read_records(io.BytesIO(cut), lambda h: True, True))


def test_archives_are_gzip_text_of_records(archives):
    import glob

    texts = [gzip.open(f).read() for f in glob.glob(f"{archives}/part-*.gz")]
    assert all(t.startswith(b"WARC/1.1\r\n") and t.endswith(b"\r\n\r\n") for t in texts if t)
    assert sum(t.count(b"WARC-Record-ID: ") for t in texts) == len(ROWS)


def test_empty_table(spark, tmp_path):
    warc.write_pages(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert warc.read_warc(spark, str(tmp_path / "none")).count() == 0
