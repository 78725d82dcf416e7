"""Writers that keep header order and refuse to write over their input."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from patina.collection import INDEX, Collection
from patina.errors import PatinaError
from patina.functions.pointers import quoted


def _guard(coll: Collection, path: str) -> None:
    target = path.rstrip("/").removeprefix("file:")
    # Staged tables no longer know their files, so readers note the path.
    for source in [*coll.df.inputFiles(), *filter(None, [coll.meta.get("source")])]:
        plain = source.removeprefix("file://").removeprefix("file:")
        if plain == target or plain.startswith(target + "/"):
            raise PatinaError(f"refusing to overwrite the input {path}")


def _columns(coll: Collection) -> list[str]:
    want = coll.meta.get("columns") or coll.data_columns
    extra = [c for c in coll.data_columns if c not in want]
    missing = [c for c in want if c not in coll.data_columns]
    if extra or missing:
        raise PatinaError(f"columns differ from the source header: extra {extra}, missing {missing}")
    return list(want)


def write_delimited(coll: Collection, path: str, sep: str | None = None) -> None:
    """CSV or TSV part files, rows in record order, blanks kept as they are."""
    _guard(coll, path)
    names = _columns(coll)
    nested = [
        f.name
        for f in coll.schema.fields
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType))
    ]
    if nested:
        raise PatinaError(f"delimited text cannot hold nested columns: {nested}")
    out = coll.df.orderBy(INDEX).select(*[F.col(quoted(n)) for n in names])
    (
        out.write.mode("errorifexists")
        .option("header", True)
        .option("sep", sep or coll.meta.get("delimiter", ","))
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_jsonl(coll: Collection, path: str) -> None:
    """One compact object per line, nulls written out, rows in record order."""
    _guard(coll, path)
    names = coll.data_columns
    out = coll.df.orderBy(INDEX)
    if len(names) == 1 and isinstance(coll.df.schema[names[0]].dataType, T.VariantType):
        out.select(F.to_json(names[0])).write.mode("errorifexists").text(path)
        return
    out.select(*[F.col(quoted(n)) for n in names]).write.mode("errorifexists").option(
        "ignoreNullFields", False
    ).json(path)


write_json = write_jsonl  # arrays are written as JSON Lines, so writers work in parallel


def write_parquet(coll: Collection, path: str, schema: T.StructType | None = None) -> None:
    """Parquet with the source's types: a value that does not fit its type fails."""
    _guard(coll, path)
    wanted = schema or coll.schema
    columns = [F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in wanted.fields]
    coll.df.orderBy(INDEX).select(*columns).write.mode("errorifexists").parquet(path)


def write_collections(collections: list[Collection], path: str) -> None:
    """Several collections of one container: a sub-directory each, in one format."""
    if not collections:
        raise PatinaError("at least one collection is required")
    formats = {c.meta.get("format", "parquet") for c in collections}
    containers = {c.meta.get("container", "") for c in collections}
    if len(formats) != 1 or len(containers) != 1:
        raise PatinaError("collections must share one container and one format")
    kind = formats.pop()
    write = {"csv": write_delimited, "tsv": write_delimited, "json": write_json, "jsonl": write_jsonl}
    for coll in collections:
        folder = coll.record_path.strip("/").replace("/", "~1").replace(":", "_") or "root"
        write.get(kind, write_parquet)(coll, f"{path.rstrip('/')}/{folder}")


def write_report(df, path: str) -> None:
    """A small sidecar as one JSON Lines file."""
    df.coalesce(1).write.mode("errorifexists").option("ignoreNullFields", False).json(path)
