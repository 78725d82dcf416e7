"""Comparing whole tables: overlap, key sets, content equality and novelty."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patina.collection import INDEX, Collection
from patina.errors import PatinaError
from patina.functions import values as V
from patina.functions.pointers import get_path, has_path, sql_text, type_at
from patina.operators.cells import align, changed_path_array
from patina.operators.corrupt import table_digest


def fingerprint_counts(coll: Collection) -> DataFrame:
    """(fp, n): copies collapse before the shuffle, so a row repeated a billion times is one row."""
    return coll.df.select(V.fingerprint(coll.schema).alias("fp")).groupBy("fp").agg(F.count(F.lit(1)).alias("n"))


def row_overlap(source: Collection, clean: Collection) -> DataFrame:
    """How many clean rows, repeats counted, are equal to some source row."""
    seen = fingerprint_counts(source).select("fp")
    both = fingerprint_counts(clean).join(seen, "fp", "left_semi")
    return both.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("overlap_count"))


def _present_keys(coll: Collection, paths: Sequence[str]) -> DataFrame:
    made = []
    for p in paths:
        if not has_path(coll.schema, p):
            continue
        dtype, col = type_at(coll.schema, p), get_path(coll.schema, p)
        made.append(
            F.when(
                V.present(col, dtype),
                F.struct(F.lit(p).alias("path"), V.value_key(col, dtype).alias("value_key")),
            )
        )
    if not made:
        return coll.df.sparkSession.createDataFrame([], "path string, value_key string")
    return coll.df.select(F.explode(F.array(*made)).alias("k")).where("k IS NOT NULL").select("k.*")


def identifier_overlap(source: Collection, clean: Collection, paths: Sequence[str]) -> DataFrame:
    """(path, overlap_count): distinct present values a path has in both tables."""
    if not paths:
        return source.df.sparkSession.createDataFrame([], "path string, overlap_count bigint")
    shared = _present_keys(source, paths).distinct().join(
        _present_keys(clean, paths).distinct(), ["path", "value_key"], "left_semi"
    )
    counts = shared.groupBy("path").agg(F.count(F.lit(1)).alias("overlap_count"))
    listed = F.explode(F.expr(f"array({', '.join(sql_text(p) for p in paths)})"))
    every = source.df.sparkSession.range(1).select(listed.alias("path"))
    return every.join(counts, "path", "left").select(
        "path", F.coalesce("overlap_count", F.lit(0)).alias("overlap_count")
    )


def set_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), list(keys), "left_anti")


def set_equality(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: are the key sets equal, and how many keys are on one side only."""
    a = left.select(*keys).distinct().withColumn("__l", F.lit(1))
    b = right.select(*keys).distinct().withColumn("__r", F.lit(1))
    both = a.join(b, list(keys), "full_outer")
    return both.agg(
        F.count_if(F.col("__r").isNull()).alias("only_left"),
        F.count_if(F.col("__l").isNull()).alias("only_right"),
    ).withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def content_equal(left: Collection, right: Collection) -> DataFrame:
    """One row: do both hold the same records in the same order? Counts and digests of each side.

    Both digests are plain aggregates, so nothing is joined but two rows.
    """
    a = table_digest(left).select(F.col("record_count").alias("left_count"), F.col("digest").alias("left_digest"))
    b = table_digest(right).select(F.col("record_count").alias("right_count"), F.col("digest").alias("right_digest"))
    equal = (F.col("left_count") == F.col("right_count")) & (F.col("left_digest") == F.col("right_digest"))
    same_paths = sorted(left.paths) == sorted(right.paths)
    return a.crossJoin(F.broadcast(b)).withColumn("equal", equal & F.lit(same_paths))


def untargeted_unchanged(clean: Collection, dirty: Collection, targets: DataFrame) -> DataFrame:
    """One row: how many records outside the target set differ."""
    rest = align(clean, dirty).join(targets.select(INDEX).distinct(), INDEX, "left_anti")
    differs = F.size(changed_path_array(clean, dirty)) > 0
    return rest.agg(
        F.count(F.lit(1)).alias("untargeted_count"), F.count_if(differs).alias("changed_count")
    ).withColumn("unchanged", F.col("changed_count") == 0)


# ---------------------------------------------------------------- novelty


@dataclass
class NoveltyContract:
    """How much of the clean table must differ from the source."""

    minimum_changed: float = 0.5
    high_similarity: float = 0.9
    maximum_high_similarity: float = 0.1
    exemptions: dict[str, str] = field(default_factory=dict)  # path -> reason

    def violations(self) -> list[str]:
        """Names of the entries that break ``NOVELTY_RULES``."""
        return [name for name, ok in NOVELTY_RULES.items() if not ok(getattr(self, name))]


def _in(value, lo: float, hi: float) -> bool:
    return not isinstance(value, bool) and isinstance(value, int | float) and lo <= value <= hi


def _explained(exemptions: dict) -> bool:
    return all(str(path).startswith("/") and str(reason or "").strip() for path, reason in exemptions.items())


# What each entry of a novelty contract has to satisfy.
NOVELTY_RULES = {
    "exemptions": _explained,
    "minimum_changed": lambda v: _in(v, 0.5, 1.0),
    "high_similarity": lambda v: _in(v, 0.8, 1.0) and v < 1.0,
    "maximum_high_similarity": lambda v: _in(v, 0.0, 0.5),
}


def _novelty_flags(
    source: Collection, clean: Collection, exempt: Iterable[str]
) -> tuple[list[str], list[Column], list[Column]]:
    """Per compared path: is the cell comparable, and is it equal?"""
    skip = set(exempt)
    paths, comparable, equal = [], [], []
    for p in source.paths:
        if p in skip or not has_path(clean.schema, p):
            continue
        ta, tb = type_at(source.schema, p), type_at(clean.schema, p)
        x, y = get_path(source.schema, p, "a"), get_path(clean.schema, p, "b")
        paths.append(p)
        comparable.append(V.present(x, ta) | V.present(y, tb))
        equal.append(V.same_tolerant(x, y, ta, tb))
    return paths, comparable, equal


def _novelty_rows(source: Collection, clean: Collection, exempt: Iterable[str]):
    paths, comparable, equal = _novelty_flags(source, clean, exempt)
    pairs = align(source, clean).select(
        INDEX,
        *[c.cast("int").alias(f"c{j}") for j, c in enumerate(comparable)],
        *[(c & e).cast("int").alias(f"e{j}") for j, (c, e) in enumerate(zip(comparable, equal))],
    )
    return paths, pairs


def novelty(source: Collection, clean: Collection, contract: NoveltyContract) -> DataFrame:
    """One row of novelty figures over position-aligned records, with ``passed``."""
    bad = contract.violations()
    if bad:
        raise PatinaError("; ".join(bad))
    paths, pairs = _novelty_rows(source, clean, contract.exemptions)
    cells = " + ".join(f"c{j}" for j in range(len(paths))) or "0"
    same = " + ".join(f"e{j}" for j in range(len(paths))) or "0"
    rows = pairs.selectExpr(f"{cells} AS cells", f"{same} AS same")
    evaluated = F.col("cells") > 0
    high = evaluated & (F.col("same") / F.nullif(F.col("cells"), F.lit(0)) >= contract.high_similarity)
    sums = rows.agg(
        F.coalesce(F.sum("cells"), F.lit(0)).alias("comparable_value_count"),
        F.coalesce(F.sum(F.col("cells") - F.col("same")), F.lit(0)).alias("changed_value_count"),
        F.count_if(evaluated).alias("evaluated_record_count"),
        F.count_if(evaluated & (F.col("cells") == F.col("same"))).alias("exact_aligned_record_count"),
        F.count_if(F.coalesce(high, F.lit(False))).alias("high_similarity_record_count"),
    )
    figures = sums.withColumn(
        "changed_value_ratio",
        F.coalesce(F.try_divide("changed_value_count", "comparable_value_count"), F.lit(0.0)),
    ).withColumn(
        "high_similarity_record_ratio",
        F.coalesce(F.try_divide("high_similarity_record_count", "evaluated_record_count"), F.lit(1.0)),
    )
    return figures.withColumn(
        "passed",
        (F.col("comparable_value_count") > 0)
        & (F.col("changed_value_ratio") >= contract.minimum_changed)
        & (F.col("high_similarity_record_ratio") <= contract.maximum_high_similarity),
    )


def novelty_by_field(source: Collection, clean: Collection, exempt: Iterable[str] = ()) -> DataFrame:
    """(path, comparable, changed, changed_ratio) for paths with a comparable cell."""
    paths, pairs = _novelty_rows(source, clean, exempt)
    sums = pairs.agg(
        *[F.expr(f"sum(c{j}) AS c{j}") for j in range(len(paths))],
        *[F.expr(f"sum(e{j}) AS e{j}") for j in range(len(paths))],
    )
    rows = ", ".join(
        f"struct({sql_text(p)} AS path, c{j} AS comparable, c{j} - e{j} AS changed)"
        for j, p in enumerate(paths)
    )
    listed = sums.selectExpr(f"inline(array({rows}))").where("comparable > 0")
    return listed.withColumn("changed_ratio", F.col("changed") / F.col("comparable"))
