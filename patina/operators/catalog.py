"""Releases: catalogue rows, searching them, and scoring delivered files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patina.collection import INDEX, Collection
from patina.errors import PatinaError
from patina.functions.pointers import dotted, get_path, type_at
from patina.functions import values as V

# Page sizes a listing offers, and the size it falls back to.
PAGE_SIZES = (10, 25, 50)
DEFAULT_PAGE = 25


def page_limit(asked) -> int:
    return asked if asked in PAGE_SIZES else DEFAULT_PAGE


def equal_or_any(column: str, value: str | None) -> Column:
    """Equality filter where an empty value means no filter."""
    return F.lit(True) if not value else F.col(column) == value


def catalog_filter(catalog: DataFrame, **wanted: str | None) -> DataFrame:
    """Keep rows equal to every non-empty argument."""
    out = catalog
    for column, value in wanted.items():
        if value:
            out = out.where(F.col(column) == value)
    return out


def name_search(column: str | Column, query: str, mode: str = "contains") -> Column:
    """Case-blind ``contains`` or ``begins`` test; an empty query matches everything."""
    name = F.lower(F.col(column) if isinstance(column, str) else column)
    needle = F.lower(F.lit(query.strip()))
    return name.startswith(needle) if mode == "begins" else name.contains(needle)


def keyword_search(columns: Sequence[str], keywords: str, query: str) -> Column:
    """Case-blind search over several columns plus fixed keywords."""
    text = F.lower(F.concat_ws(" ", *[F.col(c) for c in columns], F.lit(keywords)))
    return text.contains(F.lower(F.lit(query.strip())))


def listing(catalog: DataFrame, limit=None, order_by: Sequence[str] = ("id",)) -> DataFrame:
    """One page of the catalogue. The page is the feature: 10, 25 or 50 rows."""
    return catalog.orderBy(*order_by).limit(page_limit(limit))


def catalog_lookup(catalog: DataFrame, site: str, dataset_id: str) -> DataFrame:
    """The entry with this id on this site; nothing when either differs."""
    return catalog.where((F.col("id") == dataset_id) & (F.col("site") == site)).limit(1)


def known_files(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Requests for files the catalogue lists."""
    return requests.join(catalog.select("filename").distinct(), "filename", "left_semi")


# ---------------------------------------------------------------- scoring


def check_files(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Score 1 for each expected file that is there, once, with the same bytes and digest.

    Several files of one name in different folders are told from each other by no expectation, so
    they score only if all of them are as expected.
    """
    got = actual.groupBy("filename").agg(
        F.min("bytes").alias("__bytes"), F.max("bytes").alias("__most"), F.min("sha256").alias("__sha"), F.max("sha256").alias("__last")
    )
    alike = (F.col("__bytes") == F.col("__most")) & (F.col("__sha") == F.col("__last"))
    same = alike & (F.col("bytes") == F.col("__bytes")) & (F.col("sha256") == F.col("__sha"))
    return expected.join(got, "filename", "left").select(
        *[F.col(c) for c in expected.columns],
        F.when(same, 1).otherwise(0).alias("score"),
    )


def overall_score(scored: DataFrame) -> DataFrame:
    """Mean file score, every file with equal credit."""
    return scored.agg(F.coalesce(F.avg("score"), F.lit(0.0)).alias("overall_score"))


def task_expectations(tasks: DataFrame, catalog: DataFrame) -> DataFrame:
    """(task, id, filename, bytes, sha256): the catalogue facts behind each task's key list."""
    wanted = tasks.select("task", F.posexplode("keys").alias("position", "id"))
    return wanted.join(catalog.select("id", "filename", "bytes", "sha256"), "id").select(
        "task", "position", "id", "filename", "bytes", "sha256"
    )


# ---------------------------------------------------------------- building


def build_catalog(
    datasets: Sequence[tuple[str, Collection, dict]], digests: DataFrame
) -> DataFrame:
    """One row per released file: description, row count, ordered columns, bytes, digest.

    ``datasets`` are (filename, collection, description); ``digests`` comes from the file
    reader. Counts and schemas are per file, so the loop is as long as the release.
    """
    rows = []
    for filename, coll, about in datasets:
        nested = any(isinstance(f.dataType, T.StructType) for f in coll.schema.fields)
        columns = [dotted(p) for p in _ordered_leaves(coll.schema)] if nested else coll.data_columns
        rows.append((filename, about.get("id"), about.get("site"), about.get("title"),
                     about.get("period"), about.get("station", ""), about.get("province", ""),
                     about.get("format"), coll.count(), f"{about.get('base', '')}{filename}", columns))
    schema = (
        "filename string, id string, site string, title string, period string, station string, "
        "province string, format string, rows bigint, url string, columns array<string>"
    )
    facts = digests.sparkSession.createDataFrame(rows, schema)
    return facts.join(digests.select("filename", "bytes", "sha256"), "filename", "left")


def _ordered_leaves(schema: T.StructType, base: str = "") -> list[str]:
    from patina.functions.pointers import escape

    out = []
    for f in schema.fields:
        path = base + "/" + escape(f.name)
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            out += _ordered_leaves(f.dataType, path)
        else:
            out.append(path)
    return out


def field_dictionary(coll: Collection, descriptions: dict[str, str] | None = None) -> DataFrame:
    """(path, type, description, example): the example is the first record's value."""
    rows = []
    for p in coll.paths:
        dtype = type_at(coll.schema, p)
        rows.append(
            F.struct(
                F.lit(p).alias("path"),
                F.lit(V.type_tag(dtype)).alias("type"),
                F.lit((descriptions or {}).get(p)).cast("string").alias("description"),
                V.json_safe(get_path(coll.schema, p), dtype).alias("example"),
            )
        )
    first = coll.df.where(F.col(INDEX) == 0)
    return first.select(F.explode(F.array(*rows)).alias("f")).select("f.*")


def stale_artifacts(audited: DataFrame, digests: DataFrame) -> DataFrame:
    """Audited (filename, sha256) pairs whose file is gone or has changed since."""
    now = digests.select("filename", F.col("sha256").alias("now"))
    return audited.join(now, "filename", "left").where(~F.col("sha256").eqNullSafe(F.col("now")))


def release_gate(approved: DataFrame, audited: DataFrame, digests: DataFrame) -> None:
    """Raise unless every dataset passed audit and validation and no artifact is stale."""
    refused = approved.where(~(F.col("audit_passed") & F.col("validation_passed"))).limit(5).collect()
    if refused:
        raise PatinaError(f"unapproved dataset: {refused[0]['id']}")
    stale = stale_artifacts(audited, digests).limit(5).collect()
    if stale:
        raise PatinaError(f"stale audit: {stale[0]['filename']}")


def overwritten_releases(published: DataFrame, incoming: DataFrame) -> DataFrame:
    """Files already published under a name whose new content differs."""
    new = incoming.select("filename", F.col("sha256").alias("incoming_sha256"))
    return published.join(new, "filename").where(F.col("sha256") != F.col("incoming_sha256"))
