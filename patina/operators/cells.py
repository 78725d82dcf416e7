"""Cells: every value of every record by path, and what differs between two tables."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patina.collection import INDEX, RECORD, Collection
from patina.functions import values as V
from patina.functions import variants as X
from patina.functions.pointers import get_path, has_path, sql_ref, sql_text, type_at

CELL_SCHEMA = (
    "record_path string, record_index bigint, path string, physical_type string, "
    "value_key string, value_str string, value_num double"
)


def to_cells(coll: Collection, paths: Sequence[str] | None = None) -> DataFrame:
    """Long form of a typed collection: one row per (record, path), nulls included."""
    made = []
    for p in paths if paths is not None else coll.paths:
        dtype, col = type_at(coll.schema, p), get_path(coll.schema, p)
        made.append(
            F.struct(
                F.lit(p).alias("path"),
                V.physical_type(col, dtype).alias("physical_type"),
                V.value_key(col, dtype).alias("value_key"),
                V.json_safe(col, dtype).alias("value_str"),
                V.parse_float(col, dtype).alias("value_num"),
            )
        )
    cells = coll.df.select(INDEX, F.explode(F.array(*made)).alias("c"))
    return cells.select(F.lit(coll.record_path).alias("record_path"), INDEX, "c.*")


def _variant_places(coll: Collection, column: str, arrays: bool) -> DataFrame:
    """(record_index, path, v, kind) of every place in VARIANT records, level by level.

    One aggregate finds how deep objects are nested. Arrays are entered (as ``/*``) only on
    request; types that arrays mix hide what is in them, so then levels go on until one is empty.
    """
    spark = coll.df.sparkSession
    level = coll.df.select(INDEX, F.lit("").alias("path"), F.col(column).alias("v"), X.shape(F.col(column)).alias("kind"))
    levels = itertools.count() if arrays else range(coll.df.agg(F.max(X.depth(F.col(column)))).head()[0] or 0)
    token = F.replace(F.replace("key", F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
    found: list[DataFrame] = []
    for _ in levels:
        opened = F.col("kind").startswith("OBJECT<")
        open_rows = level.where(opened | F.col("kind").startswith("ARRAY<") if arrays else opened)
        if arrays and open_rows.isEmpty():
            break
        inside = open_rows.withColumnRenamed("v", "__parent")
        down = inside.lateralJoin(spark.tvf.variant_explode(F.col("__parent").outer())).where("value IS NOT NULL")
        level = down.select(
            INDEX,
            F.concat("path", F.lit("/"), F.when(F.col("key").isNull(), F.lit("*")).otherwise(token)).alias("path"),
            F.col("value").alias("v"),
            X.shape(F.col("value")).alias("kind"),
        )
        found.append(level)
    if not found:
        return level.where(F.lit(False))
    return functools.reduce(DataFrame.unionByName, found)


def variant_nodes(coll: Collection, column: str = RECORD) -> DataFrame:
    """(record_index, path, tag, text, num, json, leaf) of every place in VARIANT records.

    Explicit nulls have a row, missing keys have none. Objects are places too; a leaf is
    anything but an object with keys, and arrays are not entered.
    """
    places = _variant_places(coll, column, arrays=False)
    tag = X.tag(F.col("kind"))
    text = X.scalar_text(F.col("v"), tag)
    return places.select(
        INDEX,
        "path",
        tag.alias("tag"),
        text.alias("text"),
        X.number(text, tag).alias("num"),
        F.to_json("v").alias("json"),
        (~F.col("kind").startswith("OBJECT<") | (F.col("kind") == "OBJECT<>")).alias("leaf"),
    )


def variant_cells(coll: Collection, column: str = RECORD, structural: bool = False) -> DataFrame:
    """Cells of VARIANT records: explicit nulls appear, missing keys do not.

    Objects are opened, arrays are leaves and so are empty objects. ``structural=True``
    lists every key on the way down and also enters arrays (as ``/*``), without values.
    """
    if structural:
        places = _variant_places(coll, column, arrays=True)
        return places.where(~F.col("path").endswith("/*")).select(INDEX, "path").distinct()
    return variant_nodes(coll, column).where("leaf").select(
        F.lit(coll.record_path).alias("record_path"),
        INDEX,
        "path",
        F.col("tag").alias("physical_type"),
        F.concat("tag", F.lit(":"), "json").alias("value_key"),
        F.col("text").alias("value_str"),
        F.col("num").alias("value_num"),
    )


def variant_leaf_paths(coll: Collection, column: str = RECORD) -> list[str]:
    """Sorted union of leaf paths over VARIANT records."""
    return sorted(r[0] for r in variant_cells(coll, column).select("path").distinct().collect())


def variant_structures(coll: Collection, column: str = RECORD) -> DataFrame:
    """(record_index, structure): the sorted field-name paths of each VARIANT record."""
    names = variant_cells(coll, column, structural=True)
    return names.groupBy(INDEX).agg(F.sort_array(F.collect_set("path")).alias("structure"))


def align(left: Collection, right: Collection, columns: Sequence[str] | None = None) -> DataFrame:
    """Pair records by position: struct columns ``a`` and ``b``; stops at the shorter table.

    The join key is unique on both sides, so it cannot skew.
    """
    names_l = list(columns) if columns is not None else left.data_columns
    names_r = list(columns) if columns is not None else right.data_columns
    a = left.df.select(INDEX, F.struct(*[F.col(f"`{c}`") for c in names_l]).alias("a"))
    b = right.df.select(INDEX, F.struct(*[F.col(f"`{c}`") for c in names_r]).alias("b"))
    return a.join(b, INDEX)


def changed_path_array(clean: Collection, dirty: Collection, a: str = "a", b: str = "b") -> Column:
    """Array of leaf paths whose values differ between the paired records."""
    shared = [p for p in clean.paths if has_path(dirty.schema, p)]
    only = [p for p in clean.paths if p not in shared] + [
        p for p in dirty.paths if not has_path(clean.schema, p)
    ]
    tests = []
    for p in shared:
        t, u = type_at(clean.schema, p), type_at(dirty.schema, p)
        x, y = get_path(clean.schema, p, a), get_path(dirty.schema, p, b)
        if t != u and not (V.is_numeric(t) and V.is_numeric(u)):
            # Other types are never cast to compare them: type-tagged texts differ unless both are null.
            tests.append(F.when(~V.value_key(x, t).eqNullSafe(V.value_key(y, u)), F.lit(p)))
        elif isinstance(t, V.T.MapType):
            tests.append(F.when(~V.same(x, y, t), F.lit(p)))
        else:
            sa, sb = sql_ref(clean.schema, p, a), sql_ref(dirty.schema, p, b)
            tests.append(F.expr(f"CASE WHEN NOT ({sa} <=> {sb}) THEN {sql_text(p)} END"))
    tests += [F.lit(p) for p in only]
    return F.array_compact(F.array(*tests))


def changed_paths(clean: Collection, dirty: Collection) -> DataFrame:
    """(record_index, paths) of records that differ, by null-safe value equality."""
    pairs = align(clean, dirty).select(INDEX, changed_path_array(clean, dirty).alias("paths"))
    return pairs.where(F.size("paths") > 0)


def variant_changed_paths(clean: Collection, dirty: Collection, column: str = RECORD) -> DataFrame:
    """``changed_paths`` for VARIANT records; a key on one side only is a change."""
    a = variant_cells(clean, column).select(INDEX, "path", F.col("value_key").alias("ka"), F.col("value_num").alias("na"), F.col("physical_type").alias("ta"))
    b = variant_cells(dirty, column).select(INDEX, "path", F.col("value_key").alias("kb"), F.col("value_num").alias("nb"), F.col("physical_type").alias("tb"))
    numbers = F.col("ta").isin("integer", "number") & F.col("tb").isin("integer", "number")
    equal = F.when(numbers, F.col("na") == F.col("nb")).otherwise(F.col("ka").eqNullSafe(F.col("kb")))
    diff = a.join(b, [INDEX, "path"], "full_outer").where(~F.coalesce(equal, F.lit(False)))
    return diff.groupBy(INDEX).agg(F.sort_array(F.collect_set("path")).alias("paths"))
