"""A named table whose row order is data."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from patina.errors import PatinaError
from patina.functions.pointers import leaf_paths

INDEX = "record_index"
RECORD = "record"  # the column of VARIANT records


@dataclass
class Collection:
    """One logical table: a DataFrame with a dense, zero-based ``record_index``.

    ``record_path`` names the table inside its container (``""`` for the root).
    ``meta`` holds what the reader knew: format, delimiter, header order.
    """

    df: DataFrame
    record_path: str = ""
    meta: dict[str, Any] = field(default_factory=dict)
    rows: int | None = None

    def __post_init__(self) -> None:
        if INDEX not in self.df.columns:
            raise PatinaError(
                f"collection {self.record_path!r} has no {INDEX}; number it with "
                "operators.order.with_record_index first"
            )

    @property
    def data_columns(self) -> list[str]:
        return [c for c in self.df.columns if c != INDEX]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([f for f in self.df.schema.fields if f.name != INDEX])

    @property
    def is_variant(self) -> bool:
        """Whether each record is one VARIANT, so that keys may be missing and types differ."""
        fields = self.schema.fields
        return len(fields) == 1 and fields[0].name == RECORD and isinstance(fields[0].dataType, T.VariantType)

    @property
    def paths(self) -> list[str]:
        return leaf_paths(self.schema)

    def count(self) -> int:
        """Row count, asked of Spark once and remembered."""
        if self.rows is None:
            self.rows = self.df.count()
        return self.rows

    def with_df(self, df: DataFrame, rows: int | None = None) -> Collection:
        return Collection(df, self.record_path, dict(self.meta), rows)
