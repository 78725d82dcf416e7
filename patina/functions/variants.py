"""Places in VARIANT records: reading them, telling missing from null, rewriting them.

A missing place is SQL NULL; an explicit null is a VARIANT that holds null. Nothing here
leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patina.errors import PatinaError
from patina.functions import values as V
from patina.functions.pointers import split


def _step(token: str) -> str:
    """One object key as a step of a variant path."""
    if "'" not in token:
        return f"['{token}']"
    if '"' not in token:
        return f'["{token}"]'
    raise PatinaError(f"a key with both kinds of quotes cannot be read from a VARIANT: {token!r}")


def value_at(record: Column, pointer: str) -> Column:
    """The VARIANT at ``pointer``, SQL NULL where the record has no such place.

    A token of digits is a key in an object and a slot in an array.
    """
    here, steps = record, ""
    for token in split(pointer):
        if not token.isdigit():
            steps += _step(token)
            continue
        parent = F.variant_get(here, "$" + steps, "variant") if steps else here
        here = F.coalesce(
            F.variant_get(parent, f"$[{int(token)}]", "variant"), F.variant_get(parent, "$" + _step(token), "variant")
        )
        steps = ""
    return F.variant_get(here, "$" + steps, "variant") if steps else here


def shape(value: Column) -> Column:
    """Spark's text for the type of a VARIANT, NULL for a missing place."""
    return F.schema_of_variant(value)


def tag(schema_text: Column) -> Column:
    """Physical type name from ``shape``."""
    return (
        F.when(schema_text == "VOID", "null")
        .when(schema_text == "BOOLEAN", "boolean")
        .when(schema_text == "BIGINT", "integer")
        .when(schema_text.startswith("DECIMAL") | (schema_text == "DOUBLE") | (schema_text == "FLOAT"), "number")
        .when(schema_text == "STRING", "string")
        .when(schema_text.startswith("ARRAY<"), "array")
        .when(schema_text.isNotNull(), "object")
    )


def scalar_text(value: Column, kind: Column) -> Column:
    """Text of a value: strings as they are, null as NULL, all else as JSON."""
    return F.when(kind == "string", F.variant_get(value, "$", "string")).when(kind != "null", F.to_json(value))


def number(text: Column, kind: Column) -> Column:
    """The double behind a number, or behind a string that reads as one."""
    return F.when(kind.isin("integer", "number"), text.try_cast("double")).when(
        kind == "string", V.parse_float(text, T.StringType())
    )


def names(schema_text: Column) -> Column:
    """``shape`` without scalars and without arrays and objects that hold no keys: which keys a value has, at any depth."""
    bare = F.regexp_replace(schema_text, r"(?<=: |ARRAY<|^)(?!OBJECT<|ARRAY<)[A-Z]+(\([0-9,]+\))?", "")
    levels = F.sequence(F.lit(0), F.regexp_count(bare, F.lit("<")))
    return F.reduce(levels, bare, lambda text, _: F.regexp_replace(text, "(OBJECT|ARRAY)<>", ""))


def depth(value: Column) -> Column:
    """How many objects and arrays are nested in each other, at most."""
    marks = F.regexp_extract_all(F.regexp_replace(shape(value), "`[^`]*`", ""), F.lit("[<>]"), F.lit(0))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def walk(at: Column, mark: Column) -> Column:
        now = at["now"] + F.when(mark == "<", 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(at["most"], now).alias("most"))

    return F.reduce(marks, start, walk, lambda at: at["most"])


def put_at(record: Column, pointer: str, new: Column) -> Column:
    """``record`` with ``new`` in place of the value at ``pointer``; as it was where there is no such place.

    Objects and arrays on the way are opened and built again; key order is Spark's own.
    """
    return _rebuilt(record, split(pointer), new)


def _rebuilt(value: Column, tokens: list[str], new: Column) -> Column:
    if not tokens:
        return new
    token, rest = tokens[0], tokens[1:]
    kind = shape(value)

    def keyed(key: Column, old: Column) -> Column:
        return F.when(key == token, _rebuilt(old, rest, new)).otherwise(old)

    entries = F.try_variant_get(value, "$", "map<string,variant>")
    out = F.when(kind.startswith("OBJECT<"), F.to_variant_object(F.transform_values(entries, keyed)))
    if token.isdigit():
        slots = F.try_variant_get(value, "$", "array<variant>")

        def placed(old: Column, at: Column) -> Column:
            return F.when(at == int(token), _rebuilt(old, rest, new)).otherwise(old)

        out = out.when(kind.startswith("ARRAY<"), F.to_variant_object(F.transform(slots, placed)))
    return out.otherwise(value)
