"""Finding the header row of loosely laid out grids, many grids in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patina.functions import values as V

SCANNED_ROWS = 50
TEXT_SHARE = 0.9


def detect_header_rows(grid: DataFrame, scanned: int = SCANNED_ROWS) -> DataFrame:
    """(file, header_row) from ``grid(file, row_no, cells, is_text)``, rows numbered from 1.

    Among the first ``scanned`` rows: the first non-empty row, unless a later row is the densest
    one that is nearly all unique text and at least twice as dense. Reduced per task
    with min_by and max_by, so a grid's rows are never gathered.
    """
    near = grid.where(F.col("row_no") <= scanned)
    rows = near.select(
        "file",
        "row_no",
        F.size(F.filter("cells", lambda c: c != "")).alias("dense"),
        F.filter("cells", lambda c, k: F.get("is_text", k) & (c != "")).alias("texts"),
    ).where(F.col("dense") > 0)
    # Names are only spelled out and compared on rows that are text enough.
    texty = F.size("texts") / F.col("dense") >= TEXT_SHARE
    names = F.filter(
        F.transform("texts", lambda c: F.lower(V.trimmed(c))), lambda t: t != ""
    )
    rows = rows.select("file", "row_no", "dense", texty.alias("texty"), F.when(texty, names).alias("names"))
    candidate = F.col("texty") & (F.size("names") == F.size(F.array_distinct("names")))
    best = F.when(candidate, F.struct(F.col("dense"), (-F.col("row_no")).alias("up")))
    picked = rows.groupBy("file").agg(
        F.min("row_no").alias("first_row"),
        F.min_by("dense", "row_no").alias("first_dense"),
        F.max(best).alias("best"),
    )
    best_row = -F.col("best.up")
    good = (best_row == F.col("first_row")) | (
        F.col("best.dense") >= F.greatest(F.lit(2), F.col("first_dense") * 2)
    )
    return picked.select(
        "file", F.when(F.coalesce(good, F.lit(False)), best_row).otherwise(F.col("first_row")).alias("header_row")
    )
