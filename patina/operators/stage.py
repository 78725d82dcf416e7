"""Cutting lineage where several jobs read one costly result."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from patina.errors import PatinaError


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only in a one-process session without one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not named and not spark.sparkContext.master.startswith("local"):
        raise PatinaError("set spark.checkpoint.dir to a folder that all executors share")
    folder = named or tempfile.mkdtemp(prefix="patina-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and read it back.

    The files outlive lost executors, so later jobs do not recompute the plan.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder, for files that later jobs read back."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4()}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder: compressed, and later readers take only the columns they need.

    Unlike ``stage`` it keeps neither partitions nor the order of rows.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
