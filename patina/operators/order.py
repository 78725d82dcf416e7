"""Positions: numbering rows, walking them in order, sampling by stride.

Nothing here sorts a table in one task. Rows are cut into buckets of a row budget, work
is done inside each bucket, and a bucket's summary (its size, or its first and last
values) is one small row. Summaries merge: they are combined in levels of at most ``FAN``
neighbours, so that what a task holds depends neither on the rows nor on the buckets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patina.collection import INDEX, Collection
from patina.errors import PatinaError
from patina.functions.pointers import quoted
from patina.operators.stage import stage

BUCKET_ROWS = 32_768
FAN = 8192  # neighbouring summaries that one task combines
BROADCAST_BUCKETS = 1_000_000  # offsets of this many buckets stay under 30 MB
BROADCAST_FILES = 100_000  # offsets of this many files stay under 20 MB


def index_bucket(index: Column | None = None, rows: int | None = None) -> Column:
    """Number of the bucket of ``rows`` (``BUCKET_ROWS``) consecutive records."""
    col = F.col(INDEX) if index is None else index
    return F.floor(col / F.lit(rows or BUCKET_ROWS)).cast("bigint")


def bucket_count(rows: int, bucket_rows: int | None = None) -> int:
    return max(1, math.ceil(rows / (bucket_rows or BUCKET_ROWS)))


def running_offsets(counts: DataFrame, bucket: str, size: str, buckets: int, by: list[str] | None = None):
    """Add ``offset``: the sum of ``size`` over earlier buckets (of the same ``by`` group).

    Takes one row per bucket, numbered below ``buckets``. A group of ``FAN`` neighbours is
    summed in one task; the sums of the groups before it come from the level above.
    """
    keys = by or []

    def before(*parts: str) -> Column:
        window = Window.partitionBy(*parts).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(size).over(window), F.lit(0))

    if buckets <= FAN:
        return counts.withColumn("offset", before(*keys))
    up = bucket + "_up"
    level = counts.withColumn(up, F.floor(F.col(bucket) / F.lit(FAN)).cast("bigint"))
    ups = level.groupBy(*keys, up).agg(F.sum(size).alias("__sum"))
    ups = running_offsets(ups, up, "__sum", bucket_count(buckets, FAN), by)
    ups = ups.select(*keys, up, F.col("offset").alias("__ahead"))
    within = level.withColumn("offset", before(*keys, up))
    return within.join(ups, [*keys, up]).select(*counts.columns, (F.col("offset") + F.col("__ahead")).alias("offset"))


def last_before(edges: DataFrame, bucket: str, names: list[str], buckets: int, by: list[str] | None = None) -> DataFrame:
    """``by``, ``bucket`` and, for each of ``names``, its last non-null value in earlier buckets.

    Takes one row per bucket (of a ``by`` group) and works in levels as ``running_offsets`` does.
    """
    keys = by or []

    def before(*parts: str) -> list[Column]:
        window = Window.partitionBy(*parts).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
        return [F.last(n, ignorenulls=True).over(window).alias(n) for n in names]

    if buckets <= FAN:
        return edges.select(*keys, bucket, *before(*keys))
    up = bucket + "_up"
    level = edges.withColumn(up, F.floor(F.col(bucket) / F.lit(FAN)).cast("bigint"))
    lasts = [F.max_by(n, F.when(F.col(n).isNotNull(), F.col(bucket))).alias(n) for n in names]
    ups = last_before(level.groupBy(*keys, up).agg(*lasts), up, names, bucket_count(buckets, FAN), by)
    within = level.select(*keys, up, bucket, *before(*keys, up)).alias("w")
    joined = within.join(ups.alias("u"), [*keys, up])
    both = [F.coalesce(F.col(f"w.{n}"), F.col(f"u.{n}")).alias(n) for n in names]
    return joined.select(*[F.col(f"w.{k}") for k in [*keys, bucket]], *both)


def number_within(
    df: DataFrame,
    bucket: Column,
    buckets: int,
    order_by: list[str],
    number: str,
    by: list[str] | None = None,
    total: str | None = None,
) -> DataFrame:
    """Zero-based dense number in (bucket, order) sequence, restarting per ``by`` group.

    ``bucket`` must rise with the order and be below ``buckets``. A hot
    group is spread over its buckets, so no task numbers more than one of them.
    ``total`` also adds the row count of the group, which the bucket counts give for free.
    """
    keyed = df.withColumn("__bucket", bucket)
    keys = ["__bucket"]
    if by:
        # One struct key: never null itself, and null fields inside it compare equal.
        keyed = keyed.withColumn("__by", F.struct(*by))
        keys = ["__by", "__bucket"]
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
    offsets = running_offsets(counts, "__bucket", "__size", buckets, keys[:-1])
    if total:
        totals = counts.groupBy(*keys[:-1]).agg(F.sum("__size").alias(total))
        offsets = offsets.join(totals, keys[:-1]) if by else offsets.crossJoin(F.broadcast(totals))
    offsets = offsets.drop("__size")
    if not by and buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by)) - 1
    return (
        keyed.withColumn("__local", local)
        .join(offsets, keys)
        .withColumn(number, (F.col("offset") + F.col("__local")).cast("bigint"))
        .drop("__local", "offset", *keys)
    )


def with_running_start(df: DataFrame, size: str, start: str, rows: int) -> DataFrame:
    """Add ``start``: the sum of ``size`` over all rows of lower record index."""
    buckets = bucket_count(rows)
    keyed = df.withColumn("__bucket", index_bucket())
    before = Window.partitionBy("__bucket").orderBy(INDEX).rowsBetween(Window.unboundedPreceding, -1)
    sums = keyed.groupBy("__bucket").agg(F.sum(size).alias("__size"))
    offsets = running_offsets(sums, "__bucket", "__size", buckets).drop("__size")
    if buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    return (
        keyed.withColumn("__local", F.coalesce(F.sum(size).over(before), F.lit(0)))
        .join(offsets, "__bucket")
        .withColumn(start, F.col("offset") + F.col("__local"))
        .drop("__bucket", "__local", "offset")
    )


def numbered(df: DataFrame, order_by: list[str], record_path: str = "") -> Collection:
    """``with_record_index`` as a collection."""
    return Collection(with_record_index(df, order_by), record_path)


def with_record_index(
    df: DataFrame, order_by: list[str], bucket_rows: int | None = None, check: bool = True
) -> DataFrame:
    """Number rows 0..n-1 by a unique order key (nulls first), without a one-partition sort.

    The table is sorted into ranges of about ``bucket_rows`` rows, as many as it takes, and
    staged once: ranges come from a sample, so they must not be drawn again. A row's place
    in its range is known where it is written, and only range sizes are added up. Keys
    that are not unique are an error, for their rows have no order; ``check=False`` saves
    the shuffle of keys that this takes.
    """
    if not order_by:
        raise PatinaError("an order key is required; a DataFrame has no row order of its own")
    buckets = bucket_count(df.count(), bucket_rows)
    keys = [F.col(quoted(c)).asc_nulls_first() for c in order_by]
    place = F.monotonically_increasing_id()  # range in the upper bits, place in the range in the lower 33
    ranged = df.repartitionByRange(buckets, *keys) if buckets > 1 else df.repartition(1)
    staged = stage(ranged.sortWithinPartitions(*keys).withColumn("__place", place))
    if check and staged.groupBy(*[quoted(c) for c in order_by]).count().where("count > 1").limit(1).count():
        raise PatinaError(f"the order key {order_by} is not unique")
    bucket = F.shiftrightunsigned("__place", 33)
    local = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = staged.groupBy(bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__size"))
    offsets = running_offsets(sizes, "__bucket", "__size", buckets).drop("__size")
    if buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    return (
        staged.withColumn("__bucket", bucket)
        .join(offsets, "__bucket")
        .withColumn(INDEX, F.col("offset") + local)
        .drop("__bucket", "__place", "offset")
    )


def file_index(df: DataFrame) -> DataFrame:
    """Record index of a file scan: files in path order, rows in file order.

    One pass over the Parquet row positions gives each file's size; no data moves.
    """
    located = df.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.row_index").alias("__row"),
    )
    sizes = located.groupBy("__file").agg((F.max("__row") + 1).alias("__size"))
    files = len(df.inputFiles())
    if files <= 1:
        return located.withColumn(INDEX, F.col("__row")).drop("__file", "__row")
    # The running sum needs path order, so it goes through one partition: one row a file.
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__file", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("offset"))
    if files <= BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    return (
        located.join(offsets, "__file")
        .withColumn(INDEX, F.col("offset") + F.col("__row"))
        .drop("__file", "__row", "offset")
    )


def head(df: DataFrame, n: int = 5) -> DataFrame:
    return df.orderBy(INDEX).limit(n)


def stride_sample(df: DataFrame, k: int, condition: Column | None = None, rows: int | None = None):
    """``k`` rows at positions ``j * n // k`` among the rows that pass ``condition``.

    Adds ``sample_no`` (0..k-1). With fewer than ``k`` rows some repeat; with none it
    is an error. Counts per bucket say which buckets hold a wanted position, and only
    rows of those buckets are numbered.
    """
    if k <= 0:
        raise PatinaError("the sample size must be positive")
    kept = df if condition is None else df.where(condition)
    if rows is None:
        rows = (df.agg(F.max(INDEX)).head()[0] or 0) + 1
    bucket = index_bucket()
    counts = kept.groupBy(bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__size"))
    totals = counts.agg(F.sum("__size")).head()[0]
    if not totals:
        raise PatinaError("no rows to sample from")
    n = int(totals)
    first = F.expr(f"(offset * {k}L + {n - 1}L) div {n}L")
    last = F.expr(f"((offset + __size) * {k}L + {n - 1}L) div {n}L - 1L")
    wanted = (
        running_offsets(counts, "__bucket", "__size", bucket_count(rows))
        .withColumn("__first", first)
        .withColumn("__last", last)
        .where(F.col("__first") <= F.col("__last"))
        .withColumn("sample_no", F.explode(F.sequence("__first", "__last")))
        .withColumn("__local", F.expr(f"(sample_no * {n}L) div {k}L - offset"))
        .select("__bucket", "sample_no", "__local")
    )
    rows_of = kept.withColumn("__bucket", bucket).join(
        wanted.select("__bucket").distinct(), "__bucket", "left_semi"
    )
    order = Window.partitionBy("__bucket").orderBy(INDEX)
    local = rows_of.withColumn("__local", (F.row_number().over(order) - 1).cast("bigint"))
    return local.join(wanted, ["__bucket", "__local"]).drop("__bucket", "__local")


def previous_present(values: list[str], bucket: str = "__bucket") -> list[Column]:
    """For each column, its last non-null value on an earlier row of the same bucket."""
    window = (
        Window.partitionBy(bucket)
        .orderBy(INDEX)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return [F.last(v, ignorenulls=True).over(window) for v in values]


def edge_rows(df: DataFrame, values: list[str], buckets: int, bucket: str = "__bucket") -> DataFrame:
    """The rows that ``bucket_edges`` looks at: those with a column's first or last non-null value in their bucket.

    Their indices come from a hash table of a row a bucket, so no task sorts its rows to find them.
    """
    ends, hit = [], F.lit(False)
    for v in values:
        at = F.when(F.col(v).isNotNull(), F.col(INDEX))
        ends += [F.min(at).alias(f"__{v}_lo"), F.max(at).alias(f"__{v}_hi")]
        hit = hit | (F.col(INDEX) == F.col(f"__{v}_lo")) | (F.col(INDEX) == F.col(f"__{v}_hi"))
    places = df.groupBy(bucket).agg(*ends)
    if buckets * len(ends) <= BROADCAST_BUCKETS:
        places = F.broadcast(places)
    return df.join(places, bucket).where(hit).select(*df.columns)


def bucket_edges(df: DataFrame, values: list[str], buckets: int, bucket: str = "__bucket") -> DataFrame:
    """One row per bucket: each column's first non-null value, and the last one before it."""
    aggs = []
    for v in values:
        at = F.when(F.col(v).isNotNull(), F.col(INDEX))
        aggs.append(F.min_by(v, at).alias(f"{v}_first"))
        aggs.append(F.max_by(v, at).alias(v))
    edges = df.groupBy(bucket).agg(*aggs)
    earlier = last_before(edges.select(bucket, *values), bucket, values, buckets)
    earlier = earlier.select(bucket, *[F.col(v).alias(f"{v}_prev") for v in values])
    firsts = edges.select(bucket, *[F.col(f"{v}_first").alias(v) for v in values])
    return firsts.join(earlier, bucket).drop(bucket)
