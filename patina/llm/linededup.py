"""Dropping lines that too many pages of one site share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patina.llm.shared import stored

RATIO = 0.1  # a line on more than this part of its host's pages is boilerplate
MIN_PAGES = 3  # and on so many at least: two copies of a page share all lines without being boilerplate
BROADCAST_LINES = 200_000  # boilerplate lines, 16 bytes each
RESULT = ("n_lines", "n_dropped")


def line_key(line: Column) -> Column:
    """128 bits that stand for a line without the spaces around it."""
    bare = F.trim(line)
    return F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(1), bare).alias("b"))


def boilerplate(docs: DataFrame, text: str, host: str, ratio: float, min_pages: int) -> DataFrame:
    """(host, line key) of every line on more than ``ratio`` of the host's pages."""
    lines = F.array_distinct(F.transform(F.split(text, "\n"), lambda line: F.trim(line)))
    pages = (
        docs.select(F.col(host).alias("host"), F.explode(lines).alias("line"))
        .where(F.col("line") != "")
        .select("host", line_key(F.col("line")).alias("key"))
        .groupBy("host", "key.a", "key.b")
        .agg(F.count(F.lit(1)).alias("pages"))
        .where(F.col("pages") >= min_pages)
    )
    totals = docs.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("total"))
    return (
        pages.alias("p")
        .join(totals.alias("t"), F.col("p.host").eqNullSafe(F.col("t.host")))
        .where(F.col("pages") / F.col("total") > F.lit(ratio))
        .select("p.host", F.struct("a", "b").alias("key"))
    )


def drop_boilerplate(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """Take boilerplate lines out of every page; all other lines stay as they are.

    A page holds a line once however often it repeats it. A line's site-relative
    frequency is the number of the host's pages that hold it over all pages of the host,
    pages with null or empty text included. Adds n_lines and n_dropped, which replace
    columns of these names.

    Lines end at \\n and are compared without spaces around them; blank lines are kept. A
    null host is a host of its own. Null text stays null with no lines; a page whose lines
    all go has empty text. Every page stays, repeated rows too.

    Counting moves two hashes a line after adding up in each task. A host has at most
    (its mean lines a page / ratio) boilerplate lines, so they travel as one array a host.
    """
    found = stored(boilerplate(docs, text, host, ratio, min_pages))
    by_host = found.groupBy("host").agg(F.collect_list("key").alias("bad"))
    if found.count() <= BROADCAST_LINES:
        by_host = F.broadcast(by_host)
    kept = [c for c in docs.columns if c not in RESULT]
    rows = docs.select(F.struct(*kept).alias("row"), F.col(host).alias("host"), F.split(text, "\n").alias("lines"))
    left = F.when(F.col("bad").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda line: ~F.array_contains("bad", line_key(line)))
    )
    cleaned = (
        rows.alias("r")
        .join(by_host.alias("b"), F.col("r.host").eqNullSafe(F.col("b.host")), "left")
        .select("row", "lines", left.alias("left"))
    )
    count = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint")
    return cleaned.select(
        *[F.array_join("left", "\n").alias(text) if c == text else F.col("row")[c].alias(c) for c in kept],
        F.when(F.col("lines").isNull(), 0).otherwise(count("lines")).cast("bigint").alias("n_lines"),
        F.when(F.col("lines").isNull(), 0).otherwise(count("lines") - count("left")).cast("bigint").alias("n_dropped"),
    )
