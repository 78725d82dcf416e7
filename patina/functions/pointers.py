"""JSON Pointers (RFC 6901) over Spark schemas.

A pointer is resolved against the schema on the driver and becomes an ordinary
nested column reference, so Catalyst can prune to the one leaf it reads.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patina.errors import PatinaError


def escape(token: str) -> str:
    return token.replace("~", "~0").replace("/", "~1")


def unescape(token: str) -> str:
    return token.replace("~1", "/").replace("~0", "~")


def split(pointer: str) -> list[str]:
    if pointer == "":
        return []
    if not pointer.startswith("/"):
        raise PatinaError(f"not a JSON Pointer: {pointer!r}")
    return [unescape(part) for part in pointer[1:].split("/")]


def join(*tokens: str) -> str:
    return "".join("/" + escape(t) for t in tokens)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def dotted(pointer: str) -> str:
    """Display form of a pointer: names joined with dots."""
    return ".".join(split(pointer))


def is_protected(path: str, protected: set[str] | list[str]) -> bool:
    """True when ``path`` is, or lies below, a protected path."""
    return any(path == p or path.startswith(p + "/") for p in protected)


def is_protected_col(path: Column, protected: Column) -> Column:
    """``is_protected`` for paths that are data: ``protected`` is an array column."""
    return F.exists(protected, lambda p: (path == p) | path.startswith(F.concat(p, F.lit("/"))))


def _walk(dtype: T.DataType, base: str, into_arrays: bool) -> Iterator[tuple[str, bool]]:
    """Yield (pointer, is_leaf) for everything below ``dtype``."""
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            path = base + "/" + escape(f.name)
            inner = f.dataType
            is_leaf = not (isinstance(inner, T.StructType) and inner.fields)
            yield path, is_leaf
            yield from _walk(inner, path, into_arrays)
    elif into_arrays and isinstance(dtype, T.ArrayType):
        yield from _walk(dtype.elementType, base + "/*", into_arrays)


def leaf_paths(schema: T.StructType) -> list[str]:
    """Sorted pointers of scalars, arrays (never entered) and empty objects."""
    return sorted(p for p, leaf in _walk(schema, "", False) if leaf)


def structural_paths(schema: T.StructType) -> list[str]:
    """Sorted pointers of every object key, arrays entered as ``/*``."""
    return sorted({p for p, _ in _walk(schema, "", True)})


def places_pattern(schema: T.StructType) -> str:
    """A regular expression for the pointers of all places that records of a schema can have."""

    def below(dtype: T.DataType) -> str:
        if isinstance(dtype, T.StructType) and dtype.fields:
            names = "|".join(f"\\Q{escape(f.name)}\\E{below(f.dataType)}" for f in dtype.fields)
            return f"(?:/(?:{names}))?"
        if isinstance(dtype, T.ArrayType):
            return f"(?:/[0-9]+{below(dtype.elementType)})?"
        if isinstance(dtype, T.MapType):
            return f"(?:/[^/]+{below(dtype.valueType)})?"
        return ""

    return rf"\A{below(schema)}\z"


def _child(dtype: T.DataType, token: str, pointer: str) -> tuple[T.DataType, str | int]:
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            if f.name == token:
                return f.dataType, token
    elif isinstance(dtype, T.ArrayType) and token.isdigit():
        return dtype.elementType, int(token)
    elif isinstance(dtype, T.MapType):
        return dtype.valueType, token
    raise PatinaError(f"no value at {pointer!r}")


def type_at(schema: T.StructType, pointer: str) -> T.DataType:
    dtype: T.DataType = schema
    for token in split(pointer):
        dtype, _ = _child(dtype, token, pointer)
    return dtype


def has_path(schema: T.StructType, pointer: str) -> bool:
    try:
        type_at(schema, pointer)
    except PatinaError:
        return False
    return True


def sql_ref(schema: T.StructType, pointer: str, prefix: str | None = None) -> str:
    """SQL text of the value at ``pointer``; raises when the schema has no such place.

    ``prefix`` is the DataFrame alias or struct column the record lives under.
    """
    tokens = split(pointer)
    if not tokens:
        raise PatinaError("the root record is not a column")
    dtype, _ = _child(schema, tokens[0], pointer)
    text = (f"{prefix}." if prefix else "") + quoted(tokens[0])
    for token in tokens[1:]:
        inner, key = _child(dtype, token, pointer)
        if isinstance(dtype, T.ArrayType):
            text = f"get({text}, {key})"
        elif isinstance(dtype, T.MapType):
            text = f"try_element_at({text}, {sql_text(token)})"
        else:
            text = f"{text}.{quoted(token)}"
        dtype = inner
    return text


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def get_path(schema: T.StructType, pointer: str, prefix: str | None = None) -> Column:
    """Column at ``pointer``; raises when the schema has no such place."""
    return F.expr(sql_ref(schema, pointer, prefix))


Edit = Callable[[Column], Column]


def _rebuilt(col: Column, dtype: T.DataType, edits: dict[tuple[str, ...], Edit], pointer: str) -> Column:
    """``col`` with every edit below it applied, opening each struct and array once."""
    if () in edits:
        return edits[()](col)
    below: dict[str, dict] = {}
    for tokens, edit in edits.items():
        below.setdefault(tokens[0], {})[tokens[1:]] = edit
    if isinstance(dtype, T.StructType):
        out = col
        for name, inner in below.items():
            child, _ = _child(dtype, name, pointer)
            out = out.withField(quoted(name), _rebuilt(col.getField(name), child, inner, pointer))
        return out
    keys = {name: _child(dtype, name, pointer) for name in below}

    def change(value: Column, place: Column) -> Column:
        out = None
        for name, inner in below.items():
            child, key = keys[name]
            new, here = _rebuilt(value, child, inner, pointer), place == F.lit(key)
            out = F.when(here, new) if out is None else out.when(here, new)
        return out.otherwise(value)

    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda value, place: change(value, place))
    return F.transform_values(col, lambda place, value: change(value, place))


def edit_paths(df: DataFrame, edits: Mapping[str, Edit]) -> DataFrame:
    """Rewrite several places at once; each edit sees the value before any of them.

    Every struct on the way is rebuilt once, so plans grow with the number of edits.
    """
    by_column: dict[str, dict[tuple[str, ...], Edit]] = {}
    for pointer, edit in edits.items():
        type_at(df.schema, pointer)  # raises when there is no such place
        name, *rest = split(pointer)
        by_column.setdefault(name, {})[tuple(rest)] = edit
    return df.withColumns(
        {
            name: _rebuilt(F.col(quoted(name)), df.schema[name].dataType, inner, join(name))
            for name, inner in by_column.items()
        }
    )


def edit_path(df: DataFrame, pointer: str, edit: Edit) -> DataFrame:
    """Rewrite the value at ``pointer`` with ``edit(old)``; the place must exist."""
    return edit_paths(df, {pointer: edit})


def set_paths(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Replace the values at several places; raises when one does not exist."""
    return edit_paths(df, {p: (lambda _old, v=v: v) for p, v in values.items()})


def set_path(df: DataFrame, pointer: str, value: Column) -> DataFrame:
    """Replace the value at ``pointer``; raises when the place does not exist."""
    return set_paths(df, {pointer: value})
