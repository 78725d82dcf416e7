"""The structure report: fields, repetition and representation of every collection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patina.collection import Collection
from patina.operators import order, profile


@dataclass
class StructureReport:
    """Results of inspecting one container, each keyed by ``record_path``."""

    fields: DataFrame
    repetition: DataFrame
    representation: DataFrame
    samples: dict[str, DataFrame]
    record_counts: dict[str, int]

    @property
    def coverage_required(self) -> bool:
        return len(self.record_counts) > 1


def inspect(
    collections: Sequence[Collection], sample_records: int = 5, sample_values: int = 5
) -> StructureReport:
    """Profile every collection. All parts are lazy but the row counts."""
    fields = profile.profile_collections(collections, sample_values)
    repetition = representation = None
    for c in collections:
        path = F.lit(c.record_path).alias("record_path")
        rep = profile.record_repetition(c).select(path, "*")
        mine = fields.where(F.col("record_path") == c.record_path).select("path", "representation.*")
        shape = profile.representation_summary(mine).select(path, "*")
        repetition = rep if repetition is None else repetition.unionByName(rep)
        representation = shape if representation is None else representation.unionByName(shape)
    return StructureReport(
        fields,
        repetition,
        representation,
        {c.record_path: order.head(c.df, sample_records) for c in collections},
        {c.record_path: c.count() for c in collections},
    )
