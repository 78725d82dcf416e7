"""How a value is named, rendered, recognised and compared."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patina.functions.pointers import quoted, sql_text

# The recognised text patterns, tried on trimmed non-empty strings.
PATTERNS = {
    "email": r"^[^\s@]+@[^\s@]+\.[^\s@]+$",
    "url": r"(?i)^https?://",
    "uuid": r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$",
    "iso_date": r"^\d{4}-\d{2}-\d{2}$",
    "iso_datetime": r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}",
    "integer_text": r"^[+-]?\d+$",
    "decimal_text": r"^[+-]?(?:\d+\.\d*|\d*\.\d+)$",
}

# Characters a trim removes: every Unicode space, not only U+0020.
SPACES = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# A decimal float literal, as text may spell it: digit groups may be joined by
# underscores, Java's type suffixes (1d, 1f) and hex floats are not numbers.
_DIGITS = r"\d(?:_?\d)*"
FLOAT_TEXT = (
    rf"(?i)^[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    r"|inf(?:inity)?|nan)$"
)

REL_TOL = 1e-12
ABS_TOL = 1e-12

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)


def type_tag(dtype: T.DataType) -> str:
    """Physical type name of non-null values of a Spark type."""
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, _INTEGERS):
        return "integer"
    if isinstance(dtype, _FLOATS):
        return "number"
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return "string"
    if isinstance(dtype, T.ArrayType):
        return "array"
    if isinstance(dtype, (T.StructType, T.MapType)):
        return "object"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(dtype, T.DateType):
        return "date"
    if isinstance(dtype, T.DecimalType):
        return "Decimal"
    if isinstance(dtype, T.BinaryType):
        return "bytes"
    if isinstance(dtype, T.NullType):
        return "null"
    return dtype.typeName()


def physical_type(col: Column, dtype: T.DataType) -> Column:
    return F.when(col.isNull(), F.lit("null")).otherwise(F.lit(type_tag(dtype)))


def is_text(dtype: T.DataType) -> bool:
    return type_tag(dtype) == "string"


def is_numeric(dtype: T.DataType) -> bool:
    """Numbers that order and compare as floats; booleans and decimals do not."""
    return isinstance(dtype, _INTEGERS + _FLOATS)


def present(col: Column, dtype: T.DataType) -> Column:
    """Neither null nor the empty string. Zero, false and blanks are present."""
    return (col.isNotNull() & (col != "")) if is_text(dtype) else col.isNotNull()


def trimmed(col: Column) -> Column:
    return F.btrim(col, F.lit(SPACES))


def comparable(col: Column, dtype: T.DataType) -> Column:
    """A form of ``col`` that Spark can group and compare: maps become entry lists."""
    if isinstance(dtype, T.MapType):
        return F.array_sort(F.map_entries(col))
    return col


def as_text(col: Column, dtype: T.DataType) -> Column:
    """Canonical text of a value; null stays null.

    Scalars print as Spark casts them, bytes as hex, nested values as JSON with
    their keys in order. Floats are widened first so equal values share a text.
    """
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, T.FloatType):
        return col.cast("double").cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.lower(F.hex(col))
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(sorted_keys(col, dtype), {"ignoreNullFields": "false"})
    if isinstance(dtype, T.VariantType):
        return F.to_json(col)
    return col.cast("string")


def json_safe(col: Column, dtype: T.DataType) -> Column:
    """JSON-ready text: ISO date-times, hex bytes, everything else ``as_text``."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        seconds = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(col, "SSSSSS")
        return F.when(micros == "000000", seconds).otherwise(
            F.concat(seconds, F.lit("."), micros)
        )
    return as_text(col, dtype)


def value_key(col: Column, dtype: T.DataType) -> Column:
    """Type-tagged text, so 1, 1.0 and "1" are three keys."""
    return F.concat(F.lit(type_tag(dtype) + ":"), as_text(col, dtype))


def sorted_keys(col: Column, dtype: T.DataType) -> Column:
    """Rebuild nested structs with their fields in name order, maps as sorted entries."""
    if isinstance(dtype, T.StructType):
        fields = sorted(dtype.fields, key=lambda f: f.name)
        if not fields:
            return col
        built = F.struct(
            *[sorted_keys(col.getField(f.name), f.dataType).alias(f.name) for f in fields]
        )
        return F.when(col.isNotNull(), built)
    if isinstance(dtype, T.ArrayType):
        if isinstance(dtype.elementType, (T.StructType, T.ArrayType, T.MapType)):
            return F.transform(col, lambda x: sorted_keys(x, dtype.elementType))
        return col
    if isinstance(dtype, T.MapType):
        return F.array_sort(F.map_entries(col))
    return col


def fingerprint(schema: T.StructType) -> Column:
    """SHA-256 over the record's compact JSON with sorted keys and explicit nulls."""
    fields = sorted(schema.fields, key=lambda f: f.name)
    record = F.struct(
        *[sorted_keys(F.col(quoted(f.name)), f.dataType).alias(f.name) for f in fields]
    )
    # Never null, and said so: a sum, a filter or a join would else work the digest out twice to see that.
    return F.coalesce(F.sha2(F.to_json(record, {"ignoreNullFields": "false"}), 256), F.lit(""))


def same(a: Column, b: Column, dtype: T.DataType) -> Column:
    """Null-safe value equality; numbers compare across widths, NaN equals NaN."""
    return comparable(a, dtype).eqNullSafe(comparable(b, dtype))


def same_tolerant(a: Column, b: Column, a_type: T.DataType, b_type: T.DataType) -> Column:
    """Numbers within 1e-12 relative or absolute; anything else by its text."""
    if is_numeric(a_type) and is_numeric(b_type):
        x, y = a.cast("double"), b.cast("double")
        size = F.greatest(F.abs(x), F.abs(y))
        infinite = size == F.lit(float("inf"))
        near = F.abs(x - y) <= F.greatest(F.lit(REL_TOL) * size, F.lit(ABS_TOL))
        return (
            F.when(x.isNull() | y.isNull(), x.isNull() & y.isNull())
            .when(F.isnan(x) | F.isnan(y), F.lit(False))
            .when(infinite, x == y)
            .otherwise(near)
        )
    if type_tag(a_type) != type_tag(b_type):
        return a.isNull() & b.isNull()
    return json_safe(a, a_type).eqNullSafe(json_safe(b, b_type))


def parse_float(col: Column, dtype: T.DataType) -> Column:
    """The value as a double where a float literal can be read from it, else null."""
    if is_numeric(dtype) or isinstance(dtype, T.DecimalType):
        return col.cast("double")
    if not is_text(dtype):
        return F.lit(None).cast("double")
    text = trimmed(col)
    plain = F.regexp_replace(text, "_", "")
    return F.when(
        text.rlike(FLOAT_TEXT),
        F.when(F.lower(plain).endswith("nan"), F.lit(float("nan"))).otherwise(
            plain.try_cast("double")
        ),
    )


def _rlike(name: str) -> str:
    """Pattern text with Unicode digit and space classes."""
    body = PATTERNS[name]
    return body if body.startswith("(?i)") else "(?U)" + body


def matches(text: Column, name: str) -> Column:
    """Does already trimmed text look like an email, url, uuid, date or number?"""
    return text.rlike(_rlike(name))


def pattern_flags(col: Column) -> dict[str, Column]:
    """One boolean per recognised pattern, on the trimmed value."""
    text = trimmed(col)
    return {name: F.coalesce((col != "") & matches(text, name), F.lit(False)) for name in PATTERNS}


def trailing_integer(col: Column, dtype: T.DataType) -> Column:
    """Integers themselves, or the digits a string ends in; otherwise null."""
    if isinstance(dtype, _INTEGERS):
        return col.cast("decimal(38,0)")
    if is_text(dtype):
        digits = F.regexp_extract(col, r"([0-9]+)\n?\z", 1)
        return F.when(digits != "", digits.try_cast("decimal(38,0)"))
    return F.lit(None).cast("decimal(38,0)")


def full_match(text: Column, pattern: str) -> Column:
    return text.rlike(rf"\A(?:{pattern})\z")

