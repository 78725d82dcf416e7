"""Lines of text files in the order of the files.

A text scan says which file and which split of it a line comes from, and a task meets the
lines of a split in order. So one small row per split (its first line and its size) is
enough to number all lines: splits are put in (path, start) order and their sizes added up
in levels. Neither files nor splits are ever sorted, or read, as a whole.

Where quoted cells hold line breaks, a record is several lines. What a line does to "inside
quotes or not" is one of four functions, so the state before any line is a running sum and a
last value, which ``operators.order`` gives in buckets: one file is still read by many tasks.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patina.collection import INDEX
from patina.errors import PatinaError
from patina.operators import order
from patina.operators.stage import stage, stored

BROADCAST_SPLITS = 100_000  # places of this many splits stay under 30 MB
LINE_ENCODINGS = ("UTF-8", "US-ASCII", "ISO-8859-1")  # fixed values: a line feed is the one byte 0A
BOM = "﻿"


def text_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(file, block, line) of every line, blank ones too, staged once in the order of the scan.

    Lines end at a line feed; a carriage return before it stays. A byte order mark at the start of
    a file goes. Encodings whose line feed is not one byte are read a file a task.
    """
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    if encoding.upper() in LINE_ENCODINGS:
        raw = spark.read.option("lineSep", "\n").text(path)
        line = F.col("value")
        if encoding.upper() != "UTF-8":
            line = F.decode(line.cast("binary"), encoding)
        lines = raw.select(file.alias("file"), block.alias("block"), line.alias("line"))
    else:
        text = F.ltrim(F.decode("content", encoding), F.lit(BOM))
        whole = spark.read.format("binaryFile").load(path).select(file.alias("file"), text.alias("text"))
        ended = F.regexp_replace("text", r"\n\z", "")  # a line feed ends the last line, it starts none
        lines = whole.where("text <> ''").select(
            "file", F.lit(0).cast("bigint").alias("block"), F.explode(F.split(ended, "\n", -1)).alias("line")
        )
    return stage(lines)


def split_places(rows: DataFrame, header: bool = False) -> DataFrame:
    """One row per split: where its rows start in the whole, and the first of its own ids.

    ``rows`` has ``__seq`` from ``monotonically_increasing_id``. With ``header`` the first row
    of each file is not counted; in the split that holds it, it comes at place -1.
    """
    splits = rows.groupBy("file", "block").agg(F.min("__seq").alias("__first"), F.count(F.lit(1)).alias("__size"))
    if header:
        firsts = splits.groupBy("file").agg(F.min("block").alias("__top"))
        held = (F.col("block") == F.col("__top")).cast("bigint")
        splits = splits.join(firsts, "file").select(
            "file", "block", held.alias("__header"), (F.col("__first") + held).alias("__first"), (F.col("__size") - held).alias("__size")
        )
    else:
        splits = splits.withColumn("__header", F.lit(0).cast("bigint"))
    placed = order.with_record_index(stage(splits), ["file", "block"], check=False)
    n = placed.count()
    started = order.with_running_start(placed, "__size", "__start", n)
    started = started.select("file", "block", "__first", "__start", "__header")
    return F.broadcast(started) if n <= BROADCAST_SPLITS else started


def number_lines(lines: DataFrame, header: bool = False) -> DataFrame:
    """Add ``record_index``: lines in file order, files in path order.

    ``lines`` must come from ``text_lines`` by filters and column expressions alone, for its
    order inside a split is the order of the scan. With ``header`` the first line of each
    file is dropped.
    """
    rows = lines.withColumn("__seq", F.monotonically_increasing_id())
    local = F.col("__seq") - F.col("__first")
    placed = rows.join(split_places(rows, header), ["file", "block"]).withColumn(INDEX, F.col("__start") + local)
    if header:
        placed = placed.where((F.col("__header") == 0) | (local >= 0))
    return placed.drop("__seq", "__first", "__start", "__header")


# ---------------------------------------------------------------- quoted line breaks


def _opens(line: Column, sep: str) -> Column:
    """Whether a line that starts outside quotes ends inside; doubled quotes are gone already."""
    start = f"(^|{re.escape(sep)})\""
    return F.regexp_replace(line, start + '[^"]*+"', "$1").rlike(start)


def quote_ends(line: Column, sep: str) -> tuple[Column, Column]:
    """Whether ``line`` ends inside quotes: when it starts outside, and when it starts inside.

    A quote opens a cell only as its first character; elsewhere in an unquoted cell it is text.
    """
    single = F.replace(line, F.lit('""'), F.lit(""))
    after = F.regexp_replace(single, '^[^"]*+"', "x")
    return _opens(single, sep), ~F.contains(single, F.lit('"')) | _opens(after, sep)


def has_open_lines(lines: DataFrame, sep: str) -> bool:
    """Whether any line, taken as a whole record, ends inside quotes."""
    return lines.where(quote_ends(F.col("line"), sep)[0]).limit(1).count() > 0


def _with_last(df: DataFrame, value: str, rows: int, name: str) -> DataFrame:
    """Add ``name``: the last non-null ``value`` on an earlier row of the whole table."""
    buckets = order.bucket_count(rows)
    keyed = df.withColumn("__bucket", order.index_bucket())
    at = F.when(F.col(value).isNotNull(), F.col(INDEX))
    edges = keyed.groupBy("__bucket").agg(F.max_by(value, at).alias("__edge"))
    edges = order.last_before(edges, "__bucket", ["__edge"], buckets)
    if buckets <= order.BROADCAST_BUCKETS:
        edges = F.broadcast(edges)
    inside = order.previous_present([value])[0]
    return (
        keyed.withColumn("__inside", inside)
        .join(edges, "__bucket")
        .withColumn(name, F.coalesce("__inside", "__edge"))
        .drop("__bucket", "__inside", "__edge")
    )


def join_lines(lines: DataFrame, sep: str) -> DataFrame:
    """(file, record_no, rank, header, record) of delimited text whose quoted cells may hold line breaks.

    ``record_no`` counts the records that are not blank, over all files; ``header`` marks the first of
    each file, and ``rank`` is the place of the file, from 1. A file whose last quoted cell never ends is an
    error. States and numbers are found on narrow rows, texts join them once and are stored once, for
    several jobs read them. Only lines of records that have several are grouped, and a group is one record.
    """
    numbered = number_lines(lines)
    outside, inside = quote_ends(F.col("line"), sep)
    tops = numbered.groupBy("file").agg(F.min(INDEX).alias("__top"), F.max(INDEX).alias("__bottom"))
    rows = numbered.join(tops, "file").select(
        "file", INDEX, outside.cast("int").alias("__out"), inside.cast("int").alias("__in"),
        (F.col(INDEX) == F.col("__top")).alias("__is_top"), (F.col(INDEX) == F.col("__bottom")).alias("__is_bottom"),
        F.col("line").isin("", "\r").alias("__blank"),
    )
    rows = stage(rows)
    n = rows.count()
    # A file starts outside, so its first line is a constant too.
    constant = F.col("__is_top") | (F.col("__out") == F.col("__in"))
    swaps = (~constant & (F.col("__out") > F.col("__in"))).cast("bigint")
    rows = order.with_running_start(rows.withColumn("__swap", swaps), "__swap", "__swaps", n)
    parity = ((F.col("__swaps") + F.col("__swap")) % 2).cast("int")
    rows = rows.withColumn("__set", F.when(constant, F.col("__out").bitwiseXOR(parity)))
    rows = _with_last(rows, "__set", n, "__last")
    state = F.col("__last").bitwiseXOR((F.col("__swaps") % 2).cast("int"))
    rows = rows.withColumn("__before", F.when(F.col("__is_top"), 0).otherwise(state))
    rows = rows.withColumn("__after", F.when(F.col("__before") == 0, F.col("__out")).otherwise(F.col("__in")))
    # A blank line is a record of its own where it starts outside quotes, and part of one inside.
    rows = rows.where((F.col("__before") == 1) | ~F.col("__blank"))
    rows = rows.withColumn("__starts", (F.col("__before") == 0).cast("bigint"))
    rows = stage(rows.select("file", INDEX, "__before", "__after", "__is_bottom", "__starts"))
    endless = rows.where(F.col("__is_bottom") & (F.col("__after") == 1)).select("file").limit(1).collect()
    if endless:
        raise PatinaError(f"{endless[0][0]}: a quoted cell never ends")
    rows = order.with_running_start(rows, "__starts", "__earlier", n)
    number = (F.col("__earlier") + F.col("__starts") - 1).alias("record_no")
    whole = ((F.col("__before") == 0) & (F.col("__after") == 0)).alias("__whole")
    texts = rows.select(INDEX, number, whole).join(numbered.select("file", INDEX, "line"), INDEX)
    several = texts.where("NOT __whole").groupBy("file", "record_no").agg(F.collect_list(F.struct(INDEX, "line")).alias("held"))
    joined = F.array_join(F.transform(F.sort_array("held"), lambda x: x["line"]), "\n")
    records = texts.where("__whole").select("file", "record_no", F.col("line").alias("record")).unionByName(
        several.select("file", "record_no", joined.alias("record"))
    )
    records = stored(records.select("file", "record_no", F.regexp_replace("record", r"\r\z", "").alias("record")))
    firsts = records.groupBy("file").agg(F.min("record_no").alias("__first"))
    # Ranks go through one partition: one row a file.
    ranked = firsts.select("file", "__first", F.row_number().over(Window.orderBy("__first")).cast("bigint").alias("rank"))
    placed = records.join(ranked, "file").withColumn("header", F.col("record_no") == F.col("__first"))
    return placed.select("file", "record_no", "rank", "header", "record")


def number_records(records: DataFrame) -> DataFrame:
    """(record_index, record) of ``join_lines``, without the first record of each file."""
    return records.where("NOT header").select((F.col("record_no") - F.col("rank")).alias(INDEX), "record")
