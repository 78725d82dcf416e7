"""WARC archives: written by Spark's text writer, read by a Python data source.

The writer makes one record per row; a record ends with two line ends, which is exactly
the text writer's line separator, so every store that Spark writes to and its commit
protocol serve. Archives are compressed as one gzip stream each. The reader plans one partition per file, reads headers first, and skips
the payload of every record that a pushed filter or an option rules out.
"""

from __future__ import annotations

import gzip

import io
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition

from patina.errors import PatinaError
from patina.llm.shared import broadcast_below, ship, stored

REVISIT_FROM = 1000  # bytes; shorter payloads are stored each time
BATCH_BYTES = 4_000_000
BROADCAST_DIGESTS = 100_000  # digests of repeated payloads, about 60 bytes each
LINE = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, "
    "payload_digest string, headers map<string,string>, http_headers map<string,string>, "
    "content_length bigint, payload binary, file string, offset bigint"
)
# Columns that a header gives, and so can be tested before a payload is read.
HEADER_OF = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}


def header_safe(value: Column) -> Column:
    """A header value without line ends or other control characters, percent-encoded."""
    for code in (0x25, *range(0x20), 0x7F):
        wanted = chr(code) if code != 0x25 else "%(?=[01][0-9A-F]|7F|25)"
        if code == 0x25:
            value = F.regexp_replace(value, wanted, "%25")
        else:
            value = F.replace(value, F.lit(wanted), F.lit(f"%{code:02X}"))
    return value


def with_revisits(pages: DataFrame, key: str, payload: str, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Add digest, payload_length, record_type and refers_to to every page.

    Among pages with one payload of at least ``revisit_from`` bytes that with the largest
    key is the response and the others revisit it; repeated rows with that key are all
    responses, and so are pages whose payload only pages without a key share. Only the
    digests of repeated payloads are joined, one row each. They are stored and counted
    first, and where they are few the pages need no shuffle.
    """
    rows = pages.withColumn("digest", F.sha1(payload)).withColumn(
        "payload_length", F.octet_length(payload).cast("bigint")
    )
    shared = (
        rows.where(F.col("payload_length") >= revisit_from)
        .groupBy("digest", "payload_length")
        .agg(F.max(key).alias("first"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .drop("n")
    )
    shared = broadcast_below(stored(shared), BROADCAST_DIGESTS)
    joined = rows.join(shared, ["digest", "payload_length"], "left")
    revisits = F.col("first").isNotNull() & ~F.col(key).eqNullSafe(F.col("first"))
    return joined.select(
        *pages.columns,
        "digest",
        "payload_length",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("first")).alias("refers_to"),
    )


def record_id(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def page_key(identifier: Column) -> Column:
    """The page number in a record id; null where there is none."""
    return F.regexp_extract(identifier, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")


def write_pages(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
    revisit_from: int = REVISIT_FROM,
) -> None:
    """Write one WARC record per row: a response, or a revisit of an equal payload.

    The payload is the html in UTF-8, null counting as empty, behind an HTTP header that
    gives its length; a revisit keeps that header alone. Control characters of a url are
    percent-encoded and a null url has no header. Other columns are not written. An empty
    table gives archives without records.
    """
    rows = pages.select(
        F.col(key).alias("key"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"),
    )
    rows = with_revisits(rows, "key", "payload", revisit_from)
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.col("payload_length").cast("string"),
        F.lit(LINE + LINE),
    )
    revisit = F.col("record_type") == "revisit"
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_length"))
    headers = F.concat_ws(
        LINE,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("key"))),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), header_safe(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("refers_to")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    )
    body = F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload"))
    record = F.concat(
        headers.cast("binary"), F.lit(LINE + LINE).cast("binary"), http.cast("binary"), body
    ).cast("string")
    rows.select(record.alias("value")).write.option("lineSep", LINE + LINE).text(folder, compression="gzip")


@dataclass
class WarcFile(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder = options.get("path")
        if not self.folder:
            raise PatinaError("load() needs the folder of the archives")
        self.payloads = options.get("payloads", "true").lower() != "false"
        self.wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take equality tests on header columns; leave the rest to Spark."""
        for test in filters:
            name = test.attribute[0] if len(getattr(test, "attribute", ())) == 1 else None
            if name in HEADER_OF and isinstance(test, EqualTo | EqualNullSafe):
                self.wanted.append((name, frozenset([test.value])))
            elif name in HEADER_OF and isinstance(test, In):
                self.wanted.append((name, frozenset(test.value)))
            else:
                yield test

    def partitions(self) -> list[WarcFile]:
        """One partition per archive; archives end where the writer's task ended."""
        system, root = pafs.FileSystem.from_uri(self.folder) if "://" in self.folder or self.folder.startswith(
            "file:"
        ) else (pafs.LocalFileSystem(), self.folder)
        found = system.get_file_info(pafs.FileSelector(root, recursive=True))
        return [
            WarcFile(f.path)
            for f in sorted(found, key=lambda f: f.path)
            if f.is_file and f.size and not f.base_name.startswith(("_", "."))
        ]

    def read(self, partition: WarcFile) -> Iterator[pa.RecordBatch]:
        uri = "://" in self.folder or self.folder.startswith("file:")
        system = pafs.FileSystem.from_uri(self.folder)[0] if uri else pafs.LocalFileSystem()
        rows, size = [], 0
        with system.open_input_stream(partition.path, compression=None, buffer_size=1 << 20) as raw:
            stream = io.BufferedReader(_Readable(raw), 1 << 20)
            if partition.path.endswith(".gz"):
                stream = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 20)
            for row in read_records(stream, self._accepts, self.payloads):
                rows.append((*row, partition.path))
                size += len(row[9] or b"") + 500
                if size >= BATCH_BYTES:
                    yield _as_batch(rows)
                    rows, size = [], 0
        if rows:
            yield _as_batch(rows)

    def _accepts(self, headers: dict[str, str]) -> bool:
        values = header_columns(headers)
        return all(values[name] in allowed for name, allowed in self.wanted)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``; option payloads=false reads headers only."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(self.options)


class _Readable(io.RawIOBase):
    """A pyarrow stream as one that Python can buffer."""

    def __init__(self, inner: pa.NativeFile):
        self.inner = inner

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.inner.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


def _header_lines(stream: BinaryIO) -> dict[str, str]:
    """Named fields up to the empty line; names in lower case."""
    fields: dict[str, str] = {}
    while line := stream.readline():
        line = line.rstrip(b"\r\n")
        if not line:
            break
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def header_columns(headers: dict[str, str]) -> dict[str, str | None]:
    """The columns that a record's header gives; digests without their algorithm."""
    values = {name: headers.get(field) for name, field in HEADER_OF.items()}
    if values["payload_digest"]:
        values["payload_digest"] = values["payload_digest"].rpartition(":")[2]
    return values


def read_records(stream: BinaryIO, accepts, payloads: bool) -> Iterator[tuple]:
    """Records whose header is accepted; bodies of the others are skipped unread."""
    place = 0
    while line := stream.readline():
        at = place
        place += len(line)
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise PatinaError(f"no WARC record at byte {at}")
        start = _Counted(stream)
        headers = _header_lines(start)
        length = int(headers.get("content-length", 0))
        place += start.count + length
        if not accepts(headers):
            _skip(stream, length)
            continue
        http, rest = {}, length
        if headers.get("content-type", "").startswith("application/http"):
            body = _Counted(stream, length)
            body.readline()
            http = _header_lines(body)
            rest = length - body.count
        payload = None
        if payloads:
            payload = stream.read(rest)
            if len(payload) < rest:
                raise PatinaError(f"the record at byte {at} is cut off")
        else:
            _skip(stream, rest)
        v = header_columns(headers)
        yield (
            v["record_id"], v["record_type"], v["target_uri"], v["date"], v["refers_to"],
            v["payload_digest"], headers, http, length, payload, at,
        )


class _Counted:
    """Lines of a stream, never beyond ``most`` bytes, and how many bytes they took."""

    def __init__(self, stream: BinaryIO, most: int | None = None):
        self.stream, self.most, self.count = stream, most, 0

    def readline(self) -> bytes:
        line = self.stream.readline() if self.most is None else self.stream.readline(self.most - self.count)
        self.count += len(line)
        return line


def _skip(stream: BinaryIO, n: int) -> None:
    while n > 0:
        got = len(stream.read(min(n, 1 << 20)))
        if not got:
            raise PatinaError("an archive is cut off")
        n -= got


_TYPES = [pa.string()] * 6 + [pa.map_(pa.string(), pa.string())] * 2 + [pa.int64(), pa.binary(), pa.string(), pa.int64()]
_NAMES = [f.split()[0] for f in SCHEMA.replace("map<string,string>", "map").split(", ")]


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows as read_records gives them, with the file behind; offset and file change places."""
    columns = list(zip(*rows, strict=True))
    columns = [*columns[:10], columns[11], columns[10]]
    columns[6], columns[7] = ([list(m.items()) for m in c] for c in columns[6:8])
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of all archives under ``folder``; equality filters on headers are pushed down."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payloads", str(payloads).lower()).load(folder)


