"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight that changes over training time t in [0, 1], given as straight
lines between knots. The integral of that schedule is the source's weight in the mix, so
it fixes how many words the source must give in all; its running integral is the demand
for words up to time t. Documents of a source are laid end to end in a repeatable random
order; the copy whose middle word is the n-th of its source belongs where the demand
reaches n. Inverting the demand gives that position, and the training order is a range
sort by position. Everything is DataFrame work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patina.errors import PatinaError
from patina.llm.shared import broadcast_below, stored

WORD = r"[^\x20\x09-\x0D]+"
Knots = Sequence[tuple[float, float]]

# Integrals 1, 2 and 3: the first source fades, the second grows, the third is steady.
CURRICULA: tuple[Knots, ...] = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (0.5, 2.0), (1.0, 3.0)),
    ((0.0, 3.0), (1.0, 3.0)),
)
BUCKET_ROWS = 5_000  # documents that one window task lays end to end
BROADCAST_ROWS = 100_000  # sources or buckets, a few numbers each
FIRST = "__first_position"
RESULT = ("size", "source_size", "target", "taken", "positions")


def integral(knots: Knots) -> float:
    """Area under straight lines between ``knots``, which must span [0, 1]."""
    times = [t for t, _ in knots]
    if times[0] != 0 or times[-1] != 1 or times != sorted(set(times)):
        raise PatinaError("schedule knots must rise from time 0 to time 1")
    if min(w for _, w in knots) < 0:
        raise PatinaError("schedule weights must not be negative")
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False))
    if area <= 0:
        raise PatinaError("a schedule must ask for some words")
    return area


def demand_time(words: Column, knots: Knots) -> Column:
    """When the running integral of the schedule reaches ``words``."""
    found, area = None, 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        below, slope = words - F.lit(area), (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * below))
        here = F.lit(t0) + F.coalesce(F.try_divide(2 * below, F.lit(w0) + root), F.lit(0.0))
        area += (t1 - t0) * (w0 + w1) / 2
        inside = words <= F.lit(area)
        found = F.when(inside, here) if found is None else found.when(inside, here)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), found.otherwise(F.lit(1.0))))


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def numbered_sources(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``number``, from 0 in code point order of the source, null last.

    Sorted into ranges and numbered within each; of the ranges only row counts are compared.
    """
    spread = sizes.repartitionByRange(F.col("source").asc_nulls_last()).select("*", F.spark_partition_id().alias("part"))
    spread = stored(spread)
    counts = spread.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = counts.select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return spread.withColumn("row", within).join(F.broadcast(starts), "part").select(
        *sizes.columns, (F.col("start") + F.col("row") - 1).alias("number")
    )


def source_targets(sizes: DataFrame, curricula: Sequence[Knots], most: int) -> DataFrame:
    """Words each source gives: one row per source of ``sizes`` (source, source_size).

    Sources in code point order, null last, take the curricula in turn. They share the
    sum of all sizes by weight; a source gives at most ``most`` times its size, and what
    it cannot give is shared again by weight. The level that the others reach rises from
    round to round, each an aggregate over the sources, until no more of them run out.
    """
    weights = F.array(*[F.lit(float(integral(c))) for c in curricula])
    ranked = stored(
        numbered_sources(sizes)
        .withColumn("curriculum", (F.col("number") % len(curricula)).cast("int"))
        .withColumn("weight", F.element_at(weights, F.col("curriculum") + 1))
        .withColumn("most", F.col("source_size") * F.lit(most))
        .withColumn("full_at", F.col("most") / F.col("weight"))
    )
    total = ranked.agg(F.sum("source_size")).first()[0]
    level, stopped = float("-inf"), -1
    while True:
        full = F.col("full_at") < F.lit(level)
        n, given, weight = ranked.agg(
            F.count_if(full), F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if n == stopped or not weight:
            break
        level, stopped = (total - (given or 0)) / weight, n
    return ranked.select(
        "source",
        "source_size",
        "curriculum",
        "weight",
        F.when(F.col("full_at") < F.lit(level), F.col("most").cast("double"))
        .otherwise(F.lit(level) * F.col("weight"))
        .alias("target"),
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    curricula: Sequence[Knots] = CURRICULA,
    most: int = 3,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Decide how often and when each document is trained on.

    Returns the columns ``keep`` of ``docs`` (all by default) with size (its words), source_size, target (words its
    source is to give), taken (words of all its copies) and positions (training time of
    each copy, rising). Columns of ``docs`` with these names are replaced. A source's
    taken words miss its target by at most half of one document. No copy is a part of a
    document, and none has more than ``most`` copies.

    Null text and text without words have size 0 and no copies; a null source is a source
    of its own, ordered last. Documents of a source are ordered by a hash of ``key``, then
    size, so reruns agree; repeated rows are documents of their own. Rows that share one
    key are laid end to end by one task, which may spill. An empty table gives no rows.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in RESULT]
    order = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    rows = docs.select(
        F.struct(*kept).alias("row"),
        F.col(source).alias("source"),
        word_count(text).alias("size"),
        order.alias("order"),
    )
    counts = broadcast_below(docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n")), BROADCAST_ROWS)
    # The first 32 bits of the hash, spread over so many buckets that each has BUCKET_ROWS.
    place = F.conv(F.substring("order", 1, 8), 16, 10).cast("bigint")
    parts = F.ceil(F.col("n") / F.lit(BUCKET_ROWS)).cast("bigint")

    def bucketed(frame: DataFrame) -> DataFrame:
        joined = frame.alias("f").join(counts.alias("c"), F.col("f.source").eqNullSafe(F.col("c.source")))
        bucket = F.floor(place * parts / F.lit(float(1 << 32))).cast("bigint")
        return joined.select("f.*", bucket.alias("bucket"))

    buckets = (
        bucketed(rows.select("source", "size", "order"))
        .groupBy("source", "bucket")
        .agg(F.sum("size").alias("bucket_size"))
    )
    sizes = buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select(
        "source", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("start")
    )
    targets = source_targets(sizes, curricula, most)
    plan = (
        starts.alias("s")
        .join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
        .select("s.source", "bucket", "start", "source_size", "curriculum", "weight", "target")
    )
    plan = broadcast_below(stored(plan), BROADCAST_ROWS)
    within = Window.partitionBy("source", "bucket").orderBy("order", "size")
    laid = bucketed(rows).withColumn(
        "ahead", F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    joined = laid.alias("l").join(
        plan.alias("p"),
        F.col("l.source").eqNullSafe(F.col("p.source")) & (F.col("l.bucket") == F.col("p.bucket")),
    )
    middle = F.col("start") + F.col("ahead") + F.col("size") / 2
    middles = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda e: middle + e * F.col("source_size")),
        lambda m: (F.col("size") > 0) & (m <= F.col("target")),
    )

    def times(knots: Knots) -> Column:
        in_schedule = F.col("weight") / F.col("target")  # the schedule's own unit for a word
        return F.transform("middles", lambda m: demand_time(m * in_schedule, knots))

    positions = times(curricula[0])
    for number, knots in enumerate(curricula[1:], 1):
        positions = F.when(F.col("curriculum") == number, times(knots)).otherwise(positions)
    return (
        joined.withColumn("middles", middles)
        .select("row", "size", "source_size", "target", F.size("middles").alias("copies"), positions.alias("positions"))
        .select("row.*", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "positions")
    )


def training_order(mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per copy, range-sorted by ``position``; ``epoch`` counts copies of a document.

    Replaces positions and the other columns that ``mix`` added.
    """
    rows = mixed.select(
        *[c for c in mixed.columns if c not in (*RESULT, "epoch", "position")],
        F.posexplode("positions").alias("epoch", "position"),
    )
    return rows.repartitionByRange("position", key).sortWithinPartitions("position", key)


def document_order(mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``mixed``, range-sorted by the position of their first copy, those without copies last."""
    first = F.try_element_at("positions", F.lit(1))
    rows = stored(mixed.select("*", first.alias(FIRST)))
    order = [F.col(FIRST).asc_nulls_last(), F.col(key).asc_nulls_last()]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*mixed.columns)
