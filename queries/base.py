"""Registry and table loading shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from patina import Collection
from patina.operators import order
from patina.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# lineitem has no unique key pair; these six columns together are unique.
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that must give the same rows."""

    def keep(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> Collection:
    """A table with its file position as record index (equal to its key where it has one)."""
    return Collection(order.file_index(read(spark, sf_dir, name)), name, {"format": "parquet"})
