"""Audits: named row rules, patch efficacy, and before/after evidence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patina.collection import INDEX, Collection
from patina.functions import values as V
from patina.functions.pointers import get_path, sql_text, type_at
from patina.operators import order

EVIDENCE_LIMIT = 25


def audit(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, checked, failed) for every named predicate; null counts as a failure.

    All rules are one aggregate over one scan.
    """
    aggs = [
        F.count_if(~F.coalesce(test, F.lit(False))).alias(f"f{j}") for j, test in enumerate(rules.values())
    ]
    rows = ", ".join(
        f"struct({sql_text(name)} AS rule, n AS checked, f{j} AS failed)" for j, name in enumerate(rules)
    )
    return df.agg(F.count(F.lit(1)).alias("n"), *aggs).selectExpr(f"inline(array({rows}))")


def failures(df: DataFrame, rules: Mapping[str, Column], keys: Sequence[str] = (INDEX,)) -> DataFrame:
    """(keys..., rule) for every broken rule of every row."""
    broken = F.array(*[F.when(~F.coalesce(t, F.lit(False)), F.lit(name)) for name, t in rules.items()])
    return df.select(*keys, F.explode(broken).alias("rule")).where("rule IS NOT NULL")


def first_failures(found: DataFrame, limit: int = EVIDENCE_LIMIT) -> DataFrame:
    """The first ``limit`` failures of each rule by position, for showing.

    A rank filter, so every task prunes to ``limit`` rows a rule before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy("rule").orderBy(INDEX))
    return found.withColumn("rank", rank).where(F.col("rank") <= limit)


def first_broken(
    broken: DataFrame, rows: int, limit: int = EVIDENCE_LIMIT, by: Sequence[str] = (), also: Sequence[str] = ()
) -> DataFrame:
    """How many rows ``broken`` has (per ``by`` group), and its ``limit`` smallest record indices with columns ``also``.

    Counts and examples come from one job. Both add up: a bucket of records gives its own, and
    neighbouring buckets are combined in levels, so no task holds more than one bucket's
    failures or ``limit`` examples of ``order.FAN`` buckets. Gives violations and first, an
    array of structs; without ``by`` exactly one row.
    """

    def combined(frame: DataFrame, keys: Sequence[str | Column], n: Column, first: Column) -> DataFrame:
        return frame.groupBy(*keys).agg(n.alias("violations"), F.slice(F.sort_array(first), 1, limit).alias("first"))

    example = F.struct(INDEX, *also)
    level = combined(broken, [*by, order.index_bucket().alias("__bucket")], F.count(F.lit(1)), F.collect_list(example))
    buckets = order.bucket_count(rows)
    merged = F.sum("violations"), F.flatten(F.collect_list("first"))
    while buckets > order.FAN:
        level = combined(level, [*by, F.floor(F.col("__bucket") / order.FAN).alias("__bucket")], *merged)
        buckets = order.bucket_count(buckets, order.FAN)
    last = combined(level, by, *merged)
    return last if by else last.withColumn("violations", F.coalesce("violations", F.lit(0)))


def failing_records(df: DataFrame, rules: Mapping[str, Column], keys: Sequence[str] = (INDEX,)) -> DataFrame:
    """Keys of rows that break any rule."""
    ok = F.lit(True)
    for test in rules.values():
        ok = ok & F.coalesce(test, F.lit(False))
    return df.where(~ok).select(*keys)


def patch_efficacy(dirty: Collection, targets: DataFrame, rule: Column) -> DataFrame:
    """(patch_id, record_index, passed): does the dirty record really break its rule?"""
    wanted = targets.select("patch_id", INDEX)
    marked = dirty.df.select(INDEX, F.coalesce(~rule, F.lit(True)).alias("passed"))
    return wanted.join(marked, INDEX).select("patch_id", INDEX, "passed")


def numeric_evidence(source: Collection, clean: Collection, paths: Sequence[str]) -> DataFrame:
    """(path, side, min, max, mean): present numbers of both tables, mean to 3 decimals.

    Sums are decimal, so the mean does not depend on how rows were partitioned.
    """
    parts = []
    for side, coll in (("source", source), ("clean", clean)):
        aggs, rows = [], []
        for j, p in enumerate(paths):
            x = V.parse_float(get_path(coll.schema, p), type_at(coll.schema, p))
            aggs += [
                F.min(x).alias(f"lo{j}"),
                F.max(x).alias(f"hi{j}"),
                F.sum(x.cast("decimal(28,6)")).alias(f"s{j}"),
                F.count(x).alias(f"n{j}"),
            ]
            rows.append(
                f"struct({sql_text(p)} AS path, '{side}' AS side, lo{j} AS min, hi{j} AS max,"
                f" round(CAST(try_divide(s{j}, n{j}) AS DOUBLE), 3) AS mean)"
            )
        parts.append(coll.df.agg(*aggs).selectExpr(f"inline(array({', '.join(rows)}))"))
    return parts[0].unionByName(parts[1])


def residual_range(df: DataFrame, residual: Column) -> DataFrame:
    """Smallest and largest difference between a stated total and its parts."""
    return df.agg(F.min(residual).alias("min_residual"), F.max(residual).alias("max_residual"))


def composite_key_count(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """How many distinct key combinations occur; copies collapse before the shuffle."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    distinct = df.select(*[c.alias(f"k{j}") for j, c in enumerate(cols)]).distinct()
    return distinct.agg(F.count(F.lit(1)).alias("key_count"))


def grand_totals(source: Collection, clean: Collection, value: Column) -> DataFrame:
    """(side, total): the same sum over both tables, exact to 4 decimals."""
    parts = [
        c.df.agg(F.sum(value.cast("decimal(28,4)")).alias("total")).select(
            F.lit(side).alias("side"), F.col("total").cast("double").alias("total")
        )
        for side, c in (("source", source), ("clean", clean))
    ]
    return parts[0].unionByName(parts[1])


def error_type_counts(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("error_type").agg(F.count(F.lit(1)).alias("count"))


def dirty_summary(manifest: DataFrame, record_count: int | Column) -> DataFrame:
    """Dirty records, dirty cells and the actual rate (0 for an empty table)."""
    total = F.lit(record_count).cast("bigint") if isinstance(record_count, int) else record_count
    return manifest.agg(
        F.count(F.lit(1)).alias("dirty_record_count"),
        F.coalesce(F.sum(F.size("changes")), F.lit(0)).cast("bigint").alias("dirty_cell_count"),
    ).withColumn(
        "actual_dirty_record_rate", F.coalesce(F.try_divide(F.col("dirty_record_count"), total), F.lit(0.0))
    )
