"""Readers that give every table a dense ``record_index``.

Parquet keeps Spark's own row positions. Lines of text are numbered from the places of
their splits (``sources.lines``), records of JSON documents by document and place in it.
An order key may be named instead.
"""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patina.collection import INDEX, RECORD, Collection
from patina.errors import PatinaError
from patina.functions.pointers import quoted
from patina.operators import order
from patina.operators.stage import stage
from patina.sources import lines as L
from patina.sources.collections import explode_documents
from patina.sources.digests import part_hasher

PROBE = "\x01patina\x01"  # a cell that no file holds
READ_WHOLE = 128 << 20  # files of more bytes are hashed in parts
READ_WHOLE_AT_MOST = 1 << 30  # the same where only Spark can open files
HASH_PART = 256 << 20  # bytes of a file that one task hashes
HASH_BLOCK = 8 << 20
STAGED_TURNS = 32  # parts of a file after which the states are stored, to keep plans short


def header_names(spark: SparkSession, text: str, sep: str = ",") -> list[str | None]:
    """Cells of a header row, as written; Spark's own reader would rename duplicates."""
    schema = F.schema_of_csv(F.lit(text), {"sep": sep, "escape": '"'})
    ddl = spark.range(1).select(schema).head()[0]
    width = ddl.count(": ")
    cells = ", ".join(f"c{j} STRING" for j in range(width))
    parsed = spark.range(1).select(F.from_csv(F.lit(text), F.lit(cells), {"sep": sep, "escape": '"'}).alias("r"))
    return list(parsed.select("r.*").head())


def check_header(names: list[str | None]) -> None:
    if any(n is None or n == "" for n in names):
        raise PatinaError("a header cell is empty")
    seen: set[str] = set()
    for n in names:
        if n in seen:
            raise PatinaError(f"duplicate header name {n!r}")
        seen.add(n)


def _one_header(rows: DataFrame, place: str, text: str, path: str) -> str:
    """The header text that all files share; ``place`` orders the rows of a file."""
    first = rows.groupBy("file").agg(F.min_by(text, place).alias("header"))
    found = first.groupBy("header").agg(F.min("file").alias("file")).orderBy("file").limit(2).collect()
    if not found:
        raise PatinaError(f"{path}: no header row")
    if len(found) > 1:
        raise PatinaError(f"headers differ: {found[0]['file']} and {found[1]['file']}")
    return found[0]["header"]


def _cells(record: Column, width: int, sep: str) -> Column:
    """Struct of ``width`` cells and one more. The probe stands behind the last cell."""
    ddl = ", ".join(f"c{j} STRING" for j in range(width + 1))
    return F.from_csv(F.concat(record, F.lit(sep + PROBE)), F.lit(ddl), {"sep": sep, "escape": '"'})


def _count_long(records: DataFrame, width: int, sep: str) -> int:
    """Records with more cells than the header. Only those with enough separators are parsed."""
    seps = F.length("record") - F.length(F.replace("record", F.lit(sep), F.lit("")))

    def unprobed(r: Column) -> Column:
        probes = [F.coalesce(r[f"c{j}"] == PROBE, F.lit(False)) for j in range(width + 1)]
        return ~F.exists(F.array(*probes), lambda hit: hit)

    # A lambda's argument is worked out once; a filter over a column of cells would parse a record for each cell.
    parsed = F.array(_cells(F.col("record"), width, sep))
    return records.where((seps >= width * len(sep)) & F.exists(parsed, unprobed)).count()


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    order_by: list[str] | None = None,
    encoding: str = "UTF-8",
) -> Collection:
    """CSV or TSV with a header. Every cell is text; an absent cell is ``""``.

    Rows keep the order of the file, files of a folder follow in path order; ``order_by``
    numbers by a unique key instead. Blank rows are passed over, line breaks inside quotes kept. All
    files must share one header. A row with more cells than that is an error, and so is a quoted
    cell without an end. Files are split between tasks also where cells hold line breaks.
    """
    lines = L.text_lines(spark, path, encoding)
    bare = F.regexp_replace("line", r"\r\z", "")
    if L.has_open_lines(lines, sep):
        records = L.join_lines(lines, sep)
        header = _one_header(records.where("header"), "record_no", "record", path)
        numbered = L.number_records(records)
    else:
        records = lines.select("file", "block", bare.alias("record")).where("record <> ''")
        place = F.struct("block", F.monotonically_increasing_id().alias("seq")).alias("place")
        header = _one_header(records.select("file", place, "record"), "place", "record", path)
        numbered = L.number_lines(records, header=True)
    names = header_names(spark, header, sep)
    check_header(names)
    long_rows = _count_long(numbered, len(names), sep)
    if long_rows:
        raise PatinaError(f"{path}: {long_rows} rows have more cells than the header")
    cells = numbered.select(INDEX, _cells(F.col("record"), len(names), sep).alias("r"))
    held = [F.col(f"r.c{j}") for j in range(len(names))]
    kept = [F.when(c == PROBE, "").otherwise(F.coalesce(c, F.lit(""))).alias(n) for c, n in zip(held, names)]
    df = cells.select(*kept, INDEX)
    if order_by:
        df = order.with_record_index(df.drop(INDEX), order_by)
    kind = "tsv" if sep == "\t" else "csv"
    return Collection(df, "", {"format": kind, "delimiter": sep, "columns": names, "source": path})


def read_jsonl(
    spark: SparkSession,
    path: str,
    order_by: list[str] | None = None,
    schema: T.StructType | None = None,
    variant: bool = False,
) -> Collection:
    """One JSON object per non-blank line; a line that is not an object is an error.

    Rows keep the order of the file, files of a folder follow in path order; ``order_by``
    numbers by a unique key instead. ``variant=True`` keeps each record as a VARIANT column
    ``record``, so that types may differ and a missing key is no null; else without a
    ``schema`` one type is inferred per column.
    """
    lines = L.text_lines(spark, path).where(F.trim(F.col("line"), F.lit(" \t\r")) != "")
    parsed = F.try_parse_json("line")
    kind = F.schema_of_variant(parsed)
    bad = lines.where(~F.coalesce(kind.startswith("OBJECT<"), F.lit(False))).count()
    if bad:
        raise PatinaError(f"{path}: {bad} lines are not JSON objects")
    numbered = L.number_lines(lines)
    if variant:
        df = numbered.select(F.parse_json("line").alias(RECORD), INDEX)
    else:
        wanted = schema if schema is not None else spark.read.json(path).schema
        df = numbered.select(F.from_json("line", wanted).alias("r"), INDEX).select("r.*", INDEX)
    if order_by:
        df = order.with_record_index(df.drop(INDEX), order_by)
    return Collection(df, "", {"format": "jsonl", "source": path})


def read_json(
    spark: SparkSession, path: str, record_path: str | None = None, variant: bool = False
) -> Collection:
    """JSON documents, one file each, and one collection selected from them.

    Records are numbered document after document (in path order), in the order of their
    array. A document is one value and must fit a task; write large tables as JSON Lines.
    ``variant=True`` keeps each record as a VARIANT column ``record``, which tells a
    missing key from a null and allows types to differ between records.
    """
    docs = spark.read.option("wholetext", True).text(path).select(
        F.regexp_replace("value", "^﻿", "").alias("value"),
        F.col("_metadata.file_path").alias("file"),
    )
    return explode_documents(docs, record_path, variant)


def read_parquet(spark: SparkSession, path: str) -> Collection:
    df = spark.read.parquet(path)
    return Collection(order.file_index(df), "", {"format": "parquet", "columns": df.columns})


def detect_format(path: str) -> str:
    """Format by extension."""
    known = {
        ".csv": "csv",
        ".tsv": "tsv",
        ".tab": "tsv",
        ".json": "json",
        ".jsonl": "jsonl",
        ".ndjson": "jsonl",
        ".parquet": "parquet",
        ".pq": "parquet",
    }
    suffix = PurePosixPath(path).suffix.lower()
    if suffix in known:
        return known[suffix]
    raise PatinaError(f"unknown format: {path}")


def read_any(spark: SparkSession, path: str, **options) -> Collection:
    """Pick the reader by extension; a file without one is tried as JSON."""
    suffix = PurePosixPath(path).suffix
    kind = detect_format(path) if suffix else _sniff(spark, path)
    if kind == "csv":
        return read_delimited(spark, path, **options)
    if kind == "tsv":
        return read_delimited(spark, path, sep="\t", **options)
    if kind == "json":
        return read_json(spark, path, **options)
    if kind == "jsonl":
        return read_jsonl(spark, path, **options)
    return read_parquet(spark, path)


def _sniff(spark: SparkSession, path: str) -> str:
    first = spark.read.text(path).where(F.trim("value") != "").limit(1).collect()
    text = first[0][0].lstrip("﻿ \t") if first else ""
    if text[:1] in "[{" and text:
        whole = spark.range(1).select(F.try_parse_json(F.lit(text)).isNotNull()).head()[0]
        return "jsonl" if whole and text.startswith("{") else "json"
    raise PatinaError(f"unknown format: {path}")


def file_digests(
    spark: SparkSession,
    paths: str | list[str],
    read_whole: int = READ_WHOLE,
    block: int = HASH_BLOCK,
    part: int = HASH_PART,
) -> DataFrame:
    """(path, filename, bytes, sha256) of every file, hashed where it is read.

    Files of up to ``read_whole`` bytes are read by Spark as one value. Larger ones (the
    listing alone tells) are hashed ``part`` bytes a task, ``block`` bytes at a time: SHA-256 is one chain, so
    the tasks of a file follow each other, and hand on its state. Files go side by side.
    Spark's file scans pass over files of no bytes, so those have no row.
    """
    files = spark.read.format("binaryFile").load(paths)
    name = F.regexp_extract("path", r"([^/]+)$", 1).alias("filename")
    small = files.where(F.col("length") <= read_whole)
    digests = small.select("path", name, F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > read_whole).select("path", "length")
    able, hash_part = part_hasher(block)

    def tried(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                opens, resumes = able(row["path"])
                yield pa.RecordBatch.from_pydict({"opens": [opens], "resumes": [resumes]})

    found = large.limit(1).mapInArrow(tried, "opens boolean, resumes boolean").head()
    if found is None:
        return digests
    if not found["opens"] and read_whole < READ_WHOLE_AT_MOST:  # a store that only Spark knows
        return file_digests(spark, paths, READ_WHOLE_AT_MOST, block, part)
    if not found["resumes"]:
        part = large.agg(F.max("length")).head()[0]
    streamed = _hashed_in_parts(large, part, hash_part)
    return digests.unionByName(streamed.select("path", name, F.col("length").alias("bytes"), "sha256"))


def _hashed_in_parts(large: DataFrame, part: int, hash_part) -> DataFrame:
    """Add ``sha256`` to (path, length). Each turn is a shuffle, then a task for each file that has bytes left."""
    parts = F.ceil(F.col("length") / F.lit(part)).cast("bigint")
    sizes = {r["parts"]: r["count"] for r in large.groupBy(parts.alias("parts")).count().collect()}
    turns, spread = max(sizes), order.bucket_count(max(sizes.values()))
    # Files of most parts come first, so that in each turn the files with bytes left have the lowest numbers.
    bucket = (F.lit(turns) - parts) * spread + F.pmod(F.xxhash64("path"), F.lit(spread))
    files = order.number_within(large, bucket, turns * spread, ["path"], "lane")
    hashed = files.select(
        "path", "length", "lane", F.lit(None).cast("binary").alias("state"), F.lit(None).cast("string").alias("sha256")
    )

    def turn(at: int):
        def advanced(batches):
            import pyarrow as pa

            for batch in batches:
                rows = batch.to_pylist()
                for row in rows:
                    if row["sha256"] is None:
                        stop = min(at + part, row["length"])
                        row["state"], row["sha256"] = hash_part(row["path"], row["length"], at, stop, row["state"])
                yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

        return advanced

    for k in range(turns):
        if k and k % STAGED_TURNS == 0:
            hashed = stage(hashed)
        left = sum(n for p, n in sizes.items() if p > k)
        hashed = hashed.repartitionById(left, F.col("lane").cast("int")).mapInArrow(turn(k * part), hashed.schema)
    return hashed.select("path", "length", "sha256")


def snapshot_audit(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Check files against pinned digests: each row says empty, drifted or ok."""
    pinned = expected.select(F.col("filename"), F.col("sha256").alias("pinned"))
    return files.join(pinned, "filename", "left").select(
        "filename",
        "bytes",
        "sha256",
        F.when(F.col("bytes") == 0, "empty")
        .when(F.col("pinned").isNotNull() & (F.col("pinned") != F.col("sha256")), "drifted")
        .otherwise("ok")
        .alias("status"),
    )


__all__ = [
    "INDEX",
    "check_header",
    "detect_format",
    "file_digests",
    "header_names",
    "read_any",
    "read_delimited",
    "read_json",
    "read_jsonl",
    "read_parquet",
    "snapshot_audit",
]
