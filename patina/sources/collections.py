"""Finding and selecting the logical tables inside nested containers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patina.collection import INDEX, Collection
from patina.errors import PatinaError
from patina.functions.pointers import escape, get_path, split, type_at
from patina.operators import order


def _object_arrays(dtype: T.DataType, base: str = ""):
    """(pointer, levels) of each array that holds objects below ``levels`` further arrays."""
    if isinstance(dtype, T.ArrayType):
        levels, inner = 0, dtype.elementType
        while isinstance(inner, T.ArrayType):
            levels, inner = levels + 1, inner.elementType
        if isinstance(inner, T.StructType):
            yield base, levels
    elif isinstance(dtype, T.StructType):
        for f in dtype.fields:
            yield from _object_arrays(f.dataType, base + "/" + escape(f.name))


def _slot_sizes(df: DataFrame, column: Column, base: str, levels: int, place: int) -> DataFrame:
    """Counts of the object arrays in the slots of an array of arrays, however many it has."""
    held = df.select(F.lit(base).alias("record_path"), F.array().cast("array<int>").alias("slots"), column.alias("items"))
    for _ in range(levels):
        held = held.select("record_path", "slots", F.posexplode("items").alias("slot", "items")).select(
            F.concat_ws("/", "record_path", F.col("slot").cast("string")).alias("record_path"),
            F.concat("slots", F.array("slot")).alias("slots"),
            "items",
        )
    count = F.sum(F.coalesce(F.size("items"), F.lit(0)).cast("bigint")).alias("record_count")
    return held.groupBy("record_path", "slots").agg(count).select(
        "record_path", "record_count", F.lit(place).alias("place"), "slots"
    )


def discover_collections(df: DataFrame) -> DataFrame:
    """(record_path, record_count) of every non-empty array of objects in a container.

    ``df`` holds containers, one document a row (usually just one). The candidates
    come from the schema, to its bottom; one aggregate counts their records. Slots of
    arrays of arrays come from the data, one aggregate for each such array.
    """
    schema = T.StructType([f for f in df.schema.fields if f.name != INDEX])
    paths = list(_object_arrays(schema))
    if not paths:
        n = df.count()
        return df.sparkSession.createDataFrame([("", n)], "record_path string, record_count bigint")
    sizes = [
        F.sum(F.coalesce(F.size(get_path(schema, p)), F.lit(0)).cast("bigint")).alias(f"n{j}")
        for j, (p, levels) in enumerate(paths)
        if not levels
    ]
    rows = [
        F.struct(F.lit(p).alias("record_path"), F.col(f"n{j}").alias("record_count"), F.lit(j).alias("place"))
        for j, (p, levels) in enumerate(paths)
        if not levels
    ]
    parts = [_slot_sizes(df, get_path(schema, p), p, levels, j) for j, (p, levels) in enumerate(paths) if levels]
    if rows:
        flat = df.agg(*sizes).select(F.explode(F.array(*rows)).alias("c")).select("c.*")
        parts.append(flat.withColumn("slots", F.array().cast("array<int>")))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    found = found.where(F.col("record_count") > 0)
    if len(parts) > 1 or not rows:
        found = found.orderBy("place", "slots")
    return found.select("record_path", "record_count")


def select_collection(df: DataFrame, record_path: str | None = None) -> Collection:
    """Records of one collection; ``record_index`` is the position in its array.

    A table of several containers must have its own ``record_index``: records are then
    numbered container after container; without one they would share numbers, which is refused.
    Without a path: the collection with most records, the shallowest if they tie. A
    container without any array of objects is itself the single record.
    """
    if INDEX not in df.columns and df.limit(2).count() > 1:
        raise PatinaError(f"a table of several containers needs a {INDEX}")
    if record_path is None:
        found = discover_collections(df).collect()  # one row per collection
        best = max(found, key=lambda r: (r[1], -r[0].count("/"))) if found else None
        record_path = best[0] if best else ""
    if record_path == "":
        one = df if INDEX in df.columns else df.withColumn(INDEX, F.lit(0).cast("bigint"))
        return Collection(one, "", {"format": "json"})
    dtype = type_at(df.schema, record_path)
    if not (isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)):
        raise PatinaError(f"{record_path!r} is not an array of objects")
    records = get_path(df.schema, record_path)
    if INDEX in df.columns:
        sized = df.select(INDEX, records.alias("__records"))
        sized = sized.withColumn("__count", F.coalesce(F.size("__records"), F.lit(0)))
        containers = (df.agg(F.max(INDEX)).head()[0] or 0) + 1
        placed = order.with_running_start(sized, "__count", "__start", containers)
    else:
        placed = df.select(records.alias("__records"), F.lit(0).alias("__start"))
    exploded = placed.select("__start", F.posexplode("__records").alias("pos", "rec"))
    index = (F.col("__start") + F.col("pos")).cast("bigint").alias(INDEX)
    return Collection(exploded.select("rec.*", index), record_path, {"format": "json"})


def explode_documents(docs: DataFrame, record_path: str | None, variant: bool) -> Collection:
    """Turn whole JSON documents (columns ``file`` and ``value``) into one collection.

    Records are numbered document after document, in the order of ``file``.
    """
    parsed = docs.select("file", F.parse_json("value").alias("v"))
    roots = parsed.select(F.schema_of_variant("v").startswith("ARRAY<").alias("array")).distinct().collect()
    if len(roots) > 1:
        raise PatinaError("some documents are arrays, others are not")
    if roots and roots[0]["array"] and record_path in (None, ""):
        rows = _exploded(parsed, F.col("v"))
        if variant:
            return Collection(rows, "", {"format": "json"})
        schema = rows.agg(F.schema_of_variant_agg("record")).head()[0]
        if not schema.startswith("OBJECT<"):
            raise PatinaError("the root array does not hold objects")
        return Collection(_typed(rows, schema), "", {"format": "json"})
    if variant:
        tokens = split(record_path or "")
        at = "$" + "".join(f'["{t}"]' for t in tokens)
        return Collection(_exploded(parsed, F.variant_get("v", at, "variant")), record_path or "", {"format": "json"})
    schema = parsed.agg(F.schema_of_variant_agg("v")).head()[0]
    places = order.with_record_index(parsed.select("file"), ["file"])
    placed = parsed.join(places, "file").select(F.col("v").alias("record"), INDEX)
    return select_collection(_typed(placed, schema), record_path)


def _exploded(docs: DataFrame, array: Column) -> DataFrame:
    """Items of a VARIANT array in each document, numbered document after document."""
    held = docs.select("file", array.alias("__items"))
    sizes = held.select("file", F.coalesce(F.size(F.col("__items").cast("array<variant>")), F.lit(0)).alias("__size"))
    placed = order.with_record_index(sizes, ["file"])
    starts = order.with_running_start(placed, "__size", "__start", placed.count()).select("file", "__start")
    items = docs.sparkSession.tvf.variant_explode(F.col("__items").outer())
    found = held.join(starts, "file").lateralJoin(items)
    return found.select(F.col("value").alias("record"), (F.col("__start") + F.col("pos")).cast("bigint").alias(INDEX))


def struct_type(variant_schema: str) -> str:
    """DDL of the struct type for a schema that Spark gave for VARIANT values. Names are never read as types."""

    def word(found: re.Match) -> str:
        text, colon = found.group(1), found.group(2)
        if colon:
            return (text if text.startswith("`") else f"`{text}`") + colon
        return {"OBJECT": "STRUCT", "VOID": "STRING"}.get(text, text)

    return re.sub(r"(`(?:[^`]|``)*`|\w+)(:?)", word, variant_schema)


def _typed(rows: DataFrame, variant_schema: str) -> DataFrame:
    """Cast VARIANT records to the one struct type all of them fit."""
    text = rows.select(F.from_json(F.to_json("record"), F.lit(struct_type(variant_schema))).alias("r"), INDEX)
    return text.select("r.*", INDEX)
