"""Helpers the corpus operators share: shipping code, shared storage, batches of text."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from patina.errors import PatinaError

TEXT_BYTES = 2_000_000  # text that one step of a Python task holds in working arrays
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="patina-code-"), "patina_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def shared_folder(spark: SparkSession) -> str:
    """A new folder name in the storage that driver and executors share.

    That is ``spark.checkpoint.dir``; a temporary folder stands in for it only where the
    session runs in one process and names none, as tests do.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise PatinaError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="patina-shared-")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to shared storage and read it back.

    The files survive lost executors, and later readers prune columns.
    """
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def row_ranges(sizes, most: int = TEXT_BYTES) -> Iterator[tuple[int, int]]:
    """Split rows of these byte sizes into runs of at most ``most`` bytes, one row at least."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch that hold about ``TEXT_BYTES`` of ``column`` each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for start, end in row_ranges(sizes):
        yield batch.slice(start, end - start)


def broadcast_below(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast of ``df`` if counting shows at most ``rows`` rows; else leave it.

    Beyond the bound Spark joins by shuffle and splits hot keys at run time.
    """
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
