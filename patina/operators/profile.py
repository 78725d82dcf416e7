"""Field profiles: what a column holds and how its values lie in row order.

Shape of the job. One aggregate gives counts and lengths. For everything that
depends on values, rows are walked once in bucketed order, cells are reduced to a
*value table* of one row per (path, distinct value) with partial aggregation, and
all further statistics come from that table. A value held by a third of all rows
is one row of it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patina.collection import INDEX, Collection
from patina.functions import values as V
from patina.functions.pointers import get_path, sql_ref, sql_text, type_at
from patina.operators import order
from patina.operators.cells import variant_nodes
from patina.operators.stage import stage

QUANTILES = {"min": 0.0, "p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "max": 1.0}
LONG_TEXT = 256  # longer values are grouped by their SHA-256 instead of themselves
TOP_VALUES = 20
FEW_VALUES = 50
SPLIT_INTERLEAVED = 0.8
SPLIT_GROUPED = 0.1
STEP_SHARE = 0.9
MONOTONE_SHARE = 0.98
SLICES = 1024  # parts that a round cuts a range of numbers into
RANGE_ROWS = 100_000  # rows of a range that one task sorts
WALK_GROUPS = 8  # paths' buckets of records that one task walks
WALK_TASKS = 64  # smaller tables are walked a bucket a task, up to this many


def _paths(coll: Collection, paths: Sequence[str] | None) -> list[str]:
    return list(paths) if paths is not None else coll.paths


# ---------------------------------------------------------------- field counts


def field_counts(coll: Collection, paths: Sequence[str] | None = None) -> DataFrame:
    """Per path: row, null and null-or-empty counts, type counts, text length range.

    One aggregate over one scan; nothing is exploded or shuffled but the result row.
    """
    chosen = _paths(coll, paths)
    aggs, rows = ["count(1) AS n"], []
    for j, path in enumerate(chosen):
        dtype = type_at(coll.schema, path)
        ref, tag = sql_ref(coll.schema, path), V.type_tag(dtype)
        text = V.is_text(dtype)
        filled = f"{ref} IS NOT NULL" + (f" AND {ref} <> ''" if text else "")
        aggs += [f"count({ref}) AS some_{j}", f"count_if({filled}) AS present_{j}"]
        lengths = "CAST(NULL AS INT) AS min_length, CAST(NULL AS INT) AS max_length"
        if text:
            size = f"CASE WHEN {ref} <> '' THEN length({ref}) END"
            aggs += [f"min({size}) AS min_{j}", f"max({size}) AS max_{j}"]
            lengths = f"min_{j} AS min_length, max_{j} AS max_length"
        some = f", {sql_text(tag)}, some_{j}" if tag != "null" else ""
        rows.append(
            f"struct({sql_text(path)} AS path, '{tag}' AS type_tag, n AS record_count,"
            f" map('null', n - some_{j}{some}) AS types, n - present_{j} AS null_or_empty_count,"
            f" present_{j} AS present_count, {lengths})"
        )
    one_row = coll.df.agg(*[F.expr(a) for a in aggs])
    listed = one_row.selectExpr(f"inline(array({', '.join(rows)}))")
    return listed.select(
        "path",
        "type_tag",
        "record_count",
        F.expr("map_from_entries(array_sort(map_entries(map_filter(types, (k, v) -> v > 0))))").alias(
            "physical_types"
        ),
        F.lit(0).cast("bigint").alias("missing_key_count"),
        "null_or_empty_count",
        "present_count",
        "min_length",
        "max_length",
    )


def temporal_range(coll: Collection, paths: Sequence[str] | None = None) -> DataFrame:
    """Text min and max where every non-empty string is an ISO date, or date-time."""
    chosen = [p for p in _paths(coll, paths) if V.is_text(type_at(coll.schema, p))]
    if not chosen:
        return coll.df.sparkSession.createDataFrame([], "path string, min string, max string")
    aggs, rows = [], []
    for j, path in enumerate(chosen):
        col = get_path(coll.schema, path)
        text = F.when(col != "", V.trimmed(col))
        date, stamp = V.matches(text, "iso_date"), V.matches(text, "iso_datetime")
        aggs += [
            F.count(text).alias(f"n_{j}"),
            F.count_if(date).alias(f"d_{j}"),
            F.count_if(stamp).alias(f"t_{j}"),
            F.min(F.when(date | stamp, text)).alias(f"lo_{j}"),
            F.max(F.when(date | stamp, text)).alias(f"hi_{j}"),
        ]
        rows.append(
            f"struct({sql_text(path)} AS path, n_{j} AS n, d_{j} AS dates, t_{j} AS stamps,"
            f" lo_{j} AS min, hi_{j} AS max)"
        )
    listed = coll.df.agg(*aggs).selectExpr(f"inline(array({', '.join(rows)}))")
    return listed.where("n > 0 AND (n = dates OR n = stamps)").select("path", "min", "max")


# ---------------------------------------------------------------- value table


# A pair is a present value (cur) and the present value before it in row order (prev).
# Text keys decide equality, as canonical texts are unique per value of one type.
_PAIRS = {
    "adjacent_equal": "cur.text = prev.text",
    "inc": "CASE WHEN is_text THEN cur.text > prev.text ELSE cur.num > prev.num END",
    "dec": "CASE WHEN is_text THEN cur.text < prev.text ELSE cur.num < prev.num END",
    "eq": "CASE WHEN is_text THEN cur.text = prev.text ELSE cur.num = prev.num END",
    "s_inc": "CASE WHEN is_int THEN cur.whole > prev.whole ELSE cur.suffix > prev.suffix END",
    "s_dec": "CASE WHEN is_int THEN cur.whole < prev.whole ELSE cur.suffix < prev.suffix END",
    "s_eq": "CASE WHEN is_int THEN cur.whole = prev.whole ELSE cur.suffix = prev.suffix END",
    "s_plus": "CASE WHEN is_int THEN try_subtract(cur.whole, 1L) = prev.whole ELSE cur.suffix.digits = prev.next END",
    "s_minus": "CASE WHEN is_int THEN try_subtract(prev.whole, 1L) = cur.whole ELSE prev.suffix.digits = cur.next END",
}
_SAME_KIND = "cur.text = prev.text AND cur.kind = prev.kind"
_DIGITS = r"regexp_extract({text}, r'([0-9]+)\n?\z', 1)"
_SUFFIX = "struct<size:int,digits:string>"


def _known(df: DataFrame, names: Sequence[str], dtypes: Sequence[T.DataType]) -> DataFrame:
    """Each column as a struct of all that its order statistics compare, worked out once a value.

    Text, number, whole number, the digits that a text ends in (of any length and without
    leading zeros, after their count, so that such structs compare as numbers do) and the
    digits of the next integer. Steps are columns of their own, so none is spelled out twice.
    """
    text, digits, kept, made = {}, {}, {}, {}
    for n, t in zip(names, dtypes, strict=True):
        tag = V.type_tag(t)
        text[f"{n}_t"] = V.as_text(F.col(n), t)
        if tag == "string":
            digits[f"{n}_d"] = F.expr(_DIGITS.format(text=f"{n}_t"))
            bare = f"CASE WHEN {n}_d = '' THEN NULL WHEN ltrim('0', {n}_d) = '' THEN '0' ELSE ltrim('0', {n}_d) END"
            kept[f"{n}_b"] = F.expr(bare)
            suffix = f"CASE WHEN {n}_b IS NOT NULL THEN named_struct('size', length({n}_b), 'digits', {n}_b) END"
            follows = _next(f"{n}_b")
        else:
            suffix, follows = f"CAST(NULL AS {_SUFFIX})", "CAST(NULL AS STRING)"
        number = f"CAST({n} AS DOUBLE)" if V.is_numeric(t) else "CAST(NULL AS DOUBLE)"
        whole = f"CAST({n} AS BIGINT)" if tag == "integer" else "CAST(NULL AS BIGINT)"
        made[n] = F.expr(
            f"CASE WHEN {n} IS NOT NULL THEN named_struct('text', {n}_t, 'num', {number}, 'whole', {whole},"
            f" 'suffix', {suffix}, 'next', {follows}) END"
        )
    stepped = df.withColumns(text).withColumns(digits).withColumns(kept).withColumns(made)
    return stepped.select(*df.columns)


def _next(digits: str) -> str:
    """The digits of the next integer: trailing nines turn to zeros and carry one."""
    kept = f"rtrim('9', {digits})"
    zeros = f"repeat('0', length({digits}) - length({kept}))"
    raised = (
        f"CASE WHEN {kept} = '' THEN '1' ELSE concat(left({kept}, length({kept}) - 1),"
        f" CAST(CAST(right({kept}, 1) AS INT) + 1 AS STRING)) END"
    )
    return f"concat({raised}, {zeros})"


def _cells(df: DataFrame, dtypes: list[T.DataType], edge: bool, walked: bool = True) -> DataFrame:
    """Long form of present values with how each relates to the one before it.

    ``edge`` rows carry no occurrence of their own: they only join the last value of
    one bucket to the first of the next. Without ``walked`` no value has one before it.
    """
    made = []
    for j, dtype in enumerate(dtypes):
        tag = V.type_tag(dtype)
        made.append(
            F.when(
                F.col(f"v{j}").isNotNull(),
                F.struct(
                    F.lit(j).alias("path_no"),
                    F.lit(tag == "string").alias("is_text"),
                    F.lit(tag == "integer").alias("is_int"),
                    F.col(f"v{j}").alias("cur"),
                    F.col(f"v{j}_prev").alias("prev"),
                ),
            )
        )
    index = F.lit(None).cast("bigint") if edge else F.col(INDEX)
    cells = df.select(index.alias("at"), F.explode(F.array(*made)).alias("c")).where("c IS NOT NULL").select("at", "c.*")
    return paired(cells, edge, walked)


def paired(cells: DataFrame, edge: bool = False, walked: bool = True, same: str = _PAIRS["adjacent_equal"]) -> DataFrame:
    """Countable rows from cells: at, path_no (or path), is_text, is_int, cur and prev as ``_known`` makes them."""
    pairs = [
        f"CASE WHEN {test} THEN 1 ELSE 0 END AS {name}" if walked else f"0 AS {name}"
        for name, test in {**_PAIRS, "adjacent_equal": same}.items()
    ]
    runs = f"CASE WHEN {same} THEN -1 ELSE 0 END" if edge else f"CASE WHEN {same} THEN 0 ELSE 1 END"
    long = f"length(cur.text) > {LONG_TEXT}"
    bits = F.lit(0)
    if not edge:
        for k, hit in enumerate(V.pattern_flags(F.col("cur.text")).values()):
            bits = bits + F.when(hit, 1 << k).otherwise(0)
    keys = [c for c in cells.columns if c not in ("at", "is_text", "is_int", "cur", "prev")]
    return cells.select(
        *keys,
        F.expr(f"CASE WHEN {long} THEN concat('sha256:', sha2(cur.text, 256)) ELSE cur.text END").alias("value"),
        F.expr(long).alias("is_long"),
        F.when(F.expr(f"is_text AND {long}"), V.parse_float(F.col("cur.text"), T.StringType())).alias("long_number"),
        F.lit(0 if edge else 1).alias("n"),
        F.col("at").alias("first_index"),
        F.expr(runs).alias("runs"),
        F.expr(f"CASE WHEN {long} THEN length(cur.text) END").alias("length"),
        F.when(F.expr(f"is_text AND {long}"), bits).otherwise(0).alias("pattern_bits"),
        F.expr(f"CASE WHEN (cur.suffix IS NOT NULL OR cur.whole IS NOT NULL) AND {long} THEN 1 ELSE 0 END").alias(
            "long_suffix"
        ),
        *[F.expr(p) for p in pairs],
    )


def by_value(long: DataFrame, *keys: str) -> DataFrame:
    """Add up ``paired`` rows of equal values; the sums of parts add up too."""
    # A short value that looks like a digest is not the long value of that digest.
    return long.groupBy(*keys, "value", "is_long").agg(
        F.expr("sum(n) AS n"),
        F.expr("min(first_index) AS first_index"),
        F.expr("sum(runs) AS runs"),
        F.expr("max(length) AS length"),
        F.expr("max(long_number) AS long_number"),
        F.expr("max(pattern_bits) AS pattern_bits"),
        F.expr("max(long_suffix) AS long_suffix"),
        *[F.expr(f"sum({s}) AS {s}") for s in _PAIRS],
    )


def value_table(coll: Collection, paths: Sequence[str] | None = None, ordered: bool = True) -> DataFrame:
    """One row per (path, distinct present value).

    Columns: path, type_tag, value, n, first_index, runs, length, pattern_bits, long_suffix
    long_number and the adjacent-pair counts. Texts over LONG_TEXT characters are represented
    by a digest; their length, number, patterns and trailing digits are taken before. ``ordered=False`` skips the walk in row
    order, which saves the one shuffle of whole rows when no order statistic is wanted.

    The walk is over buckets of a fixed row budget. What one bucket adds is a sum over its
    pairs; its first and last values meet those of its neighbours in levels (``order``).
    """
    chosen = _paths(coll, paths)
    dtypes = [type_at(coll.schema, p) for p in chosen]
    names = [f"v{j}" for j in range(len(chosen))]
    picked = []
    for p, t, n in zip(chosen, dtypes, names):
        ref = sql_ref(coll.schema, p)
        picked.append(F.expr(f"nullif({ref}, '')" if V.is_text(t) else ref).alias(n))
    raw, before = coll.df.select(INDEX, *picked), [f"{n}_prev" for n in names]
    if ordered:
        # Values are walked as they are; what they are compared by is worked out behind the shuffle.
        raw = raw.withColumn("__bucket", order.index_bucket())
        walked = raw.select(INDEX, *names, *[c.alias(p) for c, p in zip(order.previous_present(names), before)])
        buckets = order.bucket_count(coll.count())
        edges = order.bucket_edges(stage(order.edge_rows(raw, names, buckets)), names, buckets)
        long, meets = (_known(df, names + before, dtypes * 2) for df in (walked, edges))
        long = _cells(long, dtypes, edge=False).unionByName(_cells(meets, dtypes, edge=True))
    else:
        rows = _known(raw, names, dtypes)
        nulls = {p: F.lit(None).cast(rows.schema[n].dataType) for n, p in zip(names, before)}
        long = _cells(rows.withColumns(nulls), dtypes, edge=False, walked=False)
    grouped = by_value(long, "path_no")
    path_names = ", ".join(sql_text(p) for p in chosen)
    tags = ", ".join(sql_text(V.type_tag(t)) for t in dtypes)
    return grouped.select(
        F.expr(f"get(array({path_names}), path_no)").alias("path"),
        F.expr(f"get(array({tags}), path_no)").alias("type_tag"),
        *[c for c in grouped.columns if c not in ("path_no", "is_long")],
    )


def pattern_counts(vt: DataFrame) -> DataFrame:
    """(path, pattern, n): recognised patterns that occur at all.

    Each distinct value is matched once and weighted by how often it occurs.
    """
    short = V.pattern_flags(F.col("value"))
    hits = F.filter(
        F.array(
            *[
                F.when(
                    F.col("length").isNull(), F.when(flag, F.lit(name))
                ).when(F.col("pattern_bits").bitwiseAND(1 << k) != 0, F.lit(name))
                for k, (name, flag) in enumerate(short.items())
            ]
        ),
        lambda x: x.isNotNull(),
    )
    found = vt.where(F.col("type_tag") == "string").select("path", "n", F.explode(hits).alias("pattern"))
    return found.groupBy("path", "pattern").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- order profile


def order_profile(vt: DataFrame) -> DataFrame:
    """Cardinality, layout and sequence class per path, from an ordered value table."""
    digits = F.when(F.col("length").isNull(), F.col("value").rlike(r"[0-9]\n?\z")).otherwise(
        F.col("long_suffix") == 1
    )
    parses = (F.col("type_tag") == "integer") | ((F.col("type_tag") == "string") & digits)
    # First by type, whose sums need no sort, then the few rows of a path.
    by_type = vt.groupBy("path", "type_tag").agg(
        F.sum("n").alias("non_null_count"),
        F.count(F.lit(1)).alias("distinct_count"),
        F.count_if(F.col("n") > 1).alias("duplicate_value_count"),
        F.sum(F.col("n") - 1).alias("duplicate_occurrence_count"),
        F.count_if(F.col("runs") > 1).alias("values_split_across_multiple_runs"),
        F.sum(F.when(parses, F.col("n")).otherwise(0)).alias("suffix_n"),
        *[F.expr(f"sum({s}) AS {s}") for s in _PAIRS],
    )
    sums = by_type.groupBy("path").agg(
        F.min("type_tag").alias("low_tag"),
        F.max("type_tag").alias("high_tag"),
        *[F.sum(c).alias(c) for c in by_type.columns[2:]],
    )
    pairs = "(CASE WHEN non_null_count > 1 THEN non_null_count - 1 END)"
    # Values order where all are text or all are numbers.
    ordered = "(low_tag = 'string' AND high_tag = 'string' OR low_tag IN ('integer', 'number') AND high_tag IN ('integer', 'number'))"
    suffixed = "suffix_n = non_null_count"
    base = sums.selectExpr(
        "path",
        "non_null_count",
        "distinct_count",
        "distinct_count / non_null_count AS unique_ratio",
        "duplicate_value_count",
        "duplicate_occurrence_count",
        "CASE WHEN distinct_count = non_null_count THEN 'unique' ELSE 'repeated' END AS cardinality_class",
        f"adjacent_equal / {pairs} AS adjacent_equal_ratio",
        "CASE WHEN non_null_count > 1 THEN values_split_across_multiple_runs END"
        " AS values_split_across_multiple_runs",
        "CASE WHEN non_null_count > 1 AND duplicate_value_count > 0 THEN"
        " values_split_across_multiple_runs / duplicate_value_count END AS repeated_values_split_ratio",
        f"CASE WHEN {ordered} THEN inc / {pairs} END AS increase_ratio",
        f"CASE WHEN {ordered} THEN dec / {pairs} END AS decrease_ratio",
        f"CASE WHEN {ordered} THEN eq / {pairs} END AS equal_ratio",
        "suffix_n / non_null_count AS trailing_integer_parse_ratio",
        f"CASE WHEN {suffixed} THEN s_inc / {pairs} END AS suffix_increase_ratio",
        f"CASE WHEN {suffixed} THEN s_dec / {pairs} END AS suffix_decrease_ratio",
        f"CASE WHEN {suffixed} THEN s_eq / {pairs} END AS suffix_equal_ratio",
        f"CASE WHEN {suffixed} THEN s_plus / {pairs} END AS suffix_plus_one_ratio",
        f"CASE WHEN {suffixed} THEN s_minus / {pairs} END AS suffix_minus_one_ratio",
    )
    return base.withColumn("layout_class", _layout_class()).withColumn(
        "sequence_class", _sequence_class()
    )


def _layout_class() -> Column:
    split = F.col("repeated_values_split_ratio")
    return (
        F.when(F.col("duplicate_value_count") == 0, "unique")
        .when(split >= SPLIT_INTERLEAVED, "interleaved")
        .when(split <= SPLIT_GROUPED, "grouped")
        .otherwise("mixed")
    )


def _sequence_class() -> Column:
    inc, dec, eq = (F.col(f"{k}_ratio") for k in ("increase", "decrease", "equal"))
    s_inc, s_dec, s_eq = (F.col(f"suffix_{k}_ratio") for k in ("increase", "decrease", "equal"))
    plus = F.coalesce(F.col("suffix_plus_one_ratio"), F.lit(0.0))
    minus = F.coalesce(F.col("suffix_minus_one_ratio"), F.lit(0.0))
    by_value = (
        F.when(F.col("distinct_count") == 1, "constant")
        .when((plus >= STEP_SHARE) & (inc + eq >= MONOTONE_SHARE), "sequential_ascending")
        .when((minus >= STEP_SHARE) & (dec + eq >= MONOTONE_SHARE), "sequential_descending")
        .when((inc + eq >= MONOTONE_SHARE) & (inc > 0), "monotonic_ascending")
        .when((dec + eq >= MONOTONE_SHARE) & (dec > 0), "monotonic_descending")
        .otherwise("non_monotonic")
    )
    by_suffix = (
        F.when(plus >= STEP_SHARE, "sequential_ascending")
        .when(minus >= STEP_SHARE, "sequential_descending")
        .when(s_inc + s_eq >= MONOTONE_SHARE, "monotonic_ascending")
        .when(s_dec + s_eq >= MONOTONE_SHARE, "monotonic_descending")
        .otherwise("non_monotonic")
    )
    return (
        F.when(inc.isNotNull(), by_value)
        .when(s_inc.isNotNull(), by_suffix)
        .otherwise("not_applicable")
    )


def with_empty_profiles(profile: DataFrame, paths: Sequence[str] | DataFrame) -> DataFrame:
    """Add the row that a path without any present value gets."""
    spark = profile.sparkSession
    every = paths if isinstance(paths, DataFrame) else spark.createDataFrame([(p,) for p in paths], "path string")
    joined = every.join(profile, "path", "left")
    defaults = {
        "non_null_count": F.lit(0).cast("bigint"),
        "distinct_count": F.lit(0).cast("bigint"),
        "unique_ratio": F.lit(0.0),
        "duplicate_value_count": F.lit(0).cast("bigint"),
        "duplicate_occurrence_count": F.lit(0).cast("bigint"),
        "cardinality_class": F.lit("empty"),
        "layout_class": F.lit("not_applicable"),
        "sequence_class": F.lit("not_applicable"),
    }
    return joined.select(
        *[F.coalesce(F.col(c), defaults[c]).alias(c) if c in defaults else F.col(c) for c in joined.columns]
    )


def representation_summary(profile: DataFrame) -> DataFrame:
    """(kind, class, paths): which fields share a sequence, layout or cardinality class."""
    kinds = ["sequence_class", "layout_class", "cardinality_class"]
    long = profile.select(
        "path",
        F.explode(
            F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("class")) for k in kinds])
        ).alias("k"),
    )
    return long.groupBy("k.kind", "k.class").agg(F.sort_array(F.collect_set("path")).alias("paths"))


# ---------------------------------------------------------------- values


def top_values(vt: DataFrame, k: int = TOP_VALUES) -> DataFrame:
    """Most frequent values per path; ties go to the value seen first.

    A path is listed when it has few distinct values or any value repeats. The rank
    filter lets Spark prune to ``k`` rows a path in every task before it shuffles.
    """
    totals = vt.groupBy("path").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct_count"), F.max("n").alias("top_n")
    )
    rank = F.row_number().over(
        Window.partitionBy("path").orderBy(F.col("n").desc(), F.col("first_index"))
    )
    ranked = vt.select("path", "value", "n", "first_index").withColumn("rank", rank).where(F.col("rank") <= k)
    return (
        ranked.join(F.broadcast(totals), "path")  # one row per path
        .where((F.col("distinct_count") <= FEW_VALUES) | (F.col("top_n") > 1))
        .select(
            "path",
            "rank",
            "value",
            "first_index",
            F.col("n").alias("count"),
            (F.col("n") / F.col("total")).alias("ratio"),
        )
    )


def sample_values(vt: DataFrame, k: int = 5) -> DataFrame:
    """The first ``k`` distinct present values per path, in row order."""
    rank = F.row_number().over(Window.partitionBy("path").orderBy("first_index"))
    return (
        vt.select("path", "value", "first_index")
        .withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("path", "rank", "value", "first_index")
    )


def restore_long_values(coll: Collection, picked: DataFrame) -> DataFrame:
    """Put the full text back where a picked value was grouped by its digest."""
    paths = [p for p in coll.paths if V.type_tag(type_at(coll.schema, p)) in ("string", "array", "object", "bytes")]
    if not paths:
        return picked
    full = F.coalesce(
        *[F.when(F.col("path") == p, V.as_text(get_path(coll.schema, p), type_at(coll.schema, p))) for p in paths]
    )
    return _restored(picked, coll.df, [INDEX], full)


def _restored(picked: DataFrame, texts: DataFrame, keys: Sequence[str], full: Column) -> DataFrame:
    """``picked`` with long values looked up in ``texts`` by their first index and, of its columns, ``keys``.

    ``picked`` is a ranked list, so what is asked for is a few rows a path and is sent to the texts.
    """
    asked = picked.where(F.col("value").startswith("sha256:")).select("path", F.col("first_index").alias(INDEX))
    found = texts.join(F.broadcast(asked), list(keys)).select("path", F.col(INDEX).alias("first_index"), full.alias("__full"))
    found = found.where(F.length("__full") > LONG_TEXT)
    back = picked.join(F.broadcast(found), ["path", "first_index"], "left")
    return back.withColumn("value", F.coalesce("__full", "value")).select(*picked.columns)


# ---------------------------------------------------------------- quantiles


def numeric_cells(coll: Collection, paths: Sequence[str] | None = None) -> DataFrame:
    """(path, present, num): the double behind each present value that reads as one, else null."""
    made = []
    for p in _paths(coll, paths):
        dtype, col = type_at(coll.schema, p), get_path(coll.schema, p)
        if V.is_text(dtype):
            col = F.nullif(col, F.lit(""))
        elif not (V.is_numeric(dtype) or isinstance(dtype, T.DecimalType)):
            continue
        made.append(F.struct(F.lit(p).alias("path"), col.isNotNull().alias("present"), V.parse_float(col, dtype).alias("num")))
    if not made:
        return coll.df.sparkSession.createDataFrame([], "path string, present boolean, num double")
    return coll.df.select(F.explode(F.array(*made)).alias("c")).select("c.*").where("present")


@dataclass
class _Range:
    """Numbers of one path from ``lo`` to ``hi``: how many come before them, and which ranks are wanted."""

    path: str
    lo: float
    hi: float
    offset: int
    size: int
    ranks: list[int]


# Slices of a range, rising with the number: by value, and by magnitude where values bunch.
_SLICES = {
    "value": f"least({SLICES - 1}, CAST(floor((num / 2 - lo / 2) / (hi / 2 - lo / 2) * {SLICES}) AS INT))",
    "magnitude": f"CASE WHEN num < 0 THEN {SLICES // 2 - 1} - CAST(floor((log2(-num) + 1075) / 2100 * {SLICES // 2 - 1}) AS INT)"
    f" WHEN num = 0 THEN {SLICES // 2}"
    f" ELSE {SLICES // 2 + 1} + CAST(floor((log2(num) + 1075) / 2100 * {SLICES // 2 - 1}) AS INT) END",
}


def numeric_distribution(coll: Collection, paths: Sequence[str] | None = None) -> DataFrame:
    """Exact min, linear-interpolated quantiles and max of numeric paths.

    A path counts when every present value reads as a float; see ``distribution``.
    """
    return distribution(numeric_cells(coll, paths))


def distribution(cells: DataFrame) -> DataFrame:
    """Exact quantiles of ``cells`` (path, num), for paths whose every cell has a number.

    Numbers stay doubles and no task ever holds a column. Each round counts the slices of
    those ranges that hold a wanted rank and keeps only the slices that do, until what is
    left of a range is at most ``RANGE_ROWS`` rows, which one task sorts. Ranges that
    hardly shrink are cut by magnitude next time. The driver holds the ranges of at most
    14 ranks a path. Infinite numbers and NaN lie at the ends and are only counted.
    """
    finite = "abs(num) < double('inf')"
    totals = cells.groupBy("path").agg(
        F.expr("count(1) AS n"),
        F.expr("count(num) AS parsed"),
        F.expr("count_if(num = double('-inf')) AS below"),
        F.expr("count_if(num = double('inf')) AS above"),
        F.expr(f"count_if({finite}) AS inside"),
        F.expr(f"min(CASE WHEN {finite} THEN num END) AS lo"),
        F.expr(f"max(CASE WHEN {finite} THEN num END) AS hi"),
    )
    found: dict[str, dict[int, float]] = {}
    total: dict[str, int] = {}
    ranges: list[_Range] = []
    for r in totals.where("n = parsed").collect():
        total[r.path] = r.n
        places = {int(math.floor((r.n - 1) * p)) for p in QUANTILES.values()}
        ranks = sorted({min(k + step, r.n - 1) for k in places for step in (0, 1)})
        ends = {k: -math.inf for k in ranks if k < r.below}
        ends |= {k: math.inf if k < r.below + r.inside + r.above else math.nan for k in ranks if k >= r.below + r.inside}
        found[r.path] = ends
        if r.inside:
            ranges.append(_Range(r.path, r.lo, r.hi, r.below, r.inside, [k for k in ranks if k not in ends]))
    by, last = "value", math.inf
    while ranges := _unsettled(ranges, found):
        size = max(r.size for r in ranges)
        by = ("magnitude" if by == "value" else "value") if size > last / 4 else by
        last = size
        ranges = _refined(cells, ranges, by, found)
    rows = []
    for path, at in sorted(found.items()):
        n, values = total[path], []
        for p in QUANTILES.values():
            place = (n - 1) * p
            k, share = int(math.floor(place)), place - math.floor(place)
            low, high = at[k], at[min(k + 1, n - 1)]
            # The ends are values themselves: interpolating an infinite one would give NaN.
            values.append(low if p in (0.0, 1.0) else low * (1 - share) + high * share)
        rows.append((path, n, *values))
    schema = "path string, n bigint, " + ", ".join(f"{q} double" for q in QUANTILES)
    return cells.sparkSession.createDataFrame(rows, schema)


def _unsettled(ranges: list[_Range], found: dict[str, dict[int, float]]) -> list[_Range]:
    """Ranges that still hold several numbers and a wanted rank; the others' ranks are noted."""
    for r in ranges:
        if r.lo == r.hi:
            found[r.path] |= dict.fromkeys(r.ranks, r.lo)
    return [r for r in ranges if r.lo < r.hi and r.ranks]


def _refined(cells: DataFrame, ranges: list[_Range], by: str, found: dict[str, dict[int, float]]) -> list[_Range]:
    """One round: note the ranks that lie in small ranges, and cut the others."""
    fields = "no int, path string, lo double, hi double, offset bigint, small boolean, ranks array<bigint>"
    # Halves of neighbouring tiny numbers may be equal: such a range is small whatever it holds.
    small = [r.size <= RANGE_ROWS or r.lo / 2 == r.hi / 2 for r in ranges]
    rows = [(k, r.path, r.lo, r.hi, r.offset, s, r.ranks) for k, (r, s) in enumerate(zip(ranges, small, strict=True))]
    wanted = F.broadcast(cells.sparkSession.createDataFrame(rows, fields))  # at most 14 a path
    inside = cells.join(wanted, "path").where("num BETWEEN lo AND hi")
    part = F.expr(f"CASE WHEN small THEN -1 ELSE {_SLICES[by]} END").alias("part")
    counted = (
        inside.select("no", "num", "small", part)
        .groupBy("no", "part", F.when(F.col("small"), F.col("num")).alias("value"))
        .agg(F.expr("count(1) AS size"), F.expr("min(num) AS lo"), F.expr("max(num) AS hi"))
    )
    upto = Window.partitionBy("no").orderBy("part", "value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    places = (
        counted.withColumn("stop", F.sum("size").over(upto))
        .join(wanted.select("no", "offset", "ranks"), "no")
        .selectExpr("no", "size", "lo", "hi", "offset + stop - size AS start", "ranks")
        .selectExpr("*", "filter(ranks, k -> k >= start AND k < start + size) AS held")
        .where("size(held) > 0")
    )
    return [_Range(ranges[r.no].path, r.lo, r.hi, r.start, r.size, list(r.held)) for r in places.collect()]


# ---------------------------------------------------------------- repetition


def record_repetition(coll: Collection) -> DataFrame:
    """Distinct rows, surplus copies, and how many row values have copies."""
    groups = coll.df.select(V.fingerprint(coll.schema).alias("fp")).groupBy("fp").count()
    return groups.agg(
        F.count(F.lit(1)).alias("unique_record_count"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("exact_duplicate_occurrence_count"),
        F.count_if(F.col("count") > 1).alias("duplicated_record_value_count"),
    )


# ---------------------------------------------------------------- whole profile


def profile_fields(
    coll: Collection, paths: Sequence[str] | None = None, sample_limit: int = 5
) -> DataFrame:
    """The full field profile, one row per path, of typed or VARIANT records."""
    if coll.is_variant:
        return profile_variants(coll, sample_limit)
    chosen = _paths(coll, paths)
    vt = stage(value_table(coll, chosen))  # read by five aggregates
    return _whole_profile(
        field_counts(coll, chosen),
        vt,
        numeric_distribution(coll, chosen),
        temporal_range(coll, chosen),
        lambda picked: restore_long_values(coll, picked),
        sample_limit,
    )


def _whole_profile(
    counts: DataFrame,
    vt: DataFrame,
    nums: DataFrame,
    times: DataFrame,
    restore: Callable[[DataFrame], DataFrame],
    sample_limit: int,
) -> DataFrame:
    shape = order_profile(vt)
    rep_cols = [c for c in shape.columns if c != "path"]
    rep = with_empty_profiles(shape, counts.select("path")).select("path", F.struct(*rep_cols).alias("representation"))
    tops = restore(top_values(vt)).groupBy("path").agg(
        F.sort_array(F.collect_list(F.struct("rank", "value", "count", "ratio"))).alias("most_frequent")
    )
    samples = restore(sample_values(vt, sample_limit)).groupBy("path").agg(
        F.sort_array(F.collect_list(F.struct("rank", "value"))).alias("s")
    ).select("path", F.transform("s", lambda x: x.value).alias("sample_values"))
    pats = pattern_counts(vt).groupBy("path").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("pattern", "n")))).alias(
            "recognized_patterns"
        )
    )
    nums = nums.select("path", F.struct(*[c for c in nums.columns if c not in ("path", "n")]).alias("numeric_distribution"))
    times = times.select("path", F.struct("min", "max").alias("temporal_lexical_range"))
    out = counts
    for part in (rep, tops, samples, pats, nums, times):
        out = out.join(part, "path", "left")  # a row per path each
    return out.withColumn(
        "non_null_unique_count", F.col("representation.distinct_count")
    ).withColumn("sample_values", F.coalesce("sample_values", F.array().cast("array<string>")))


# ---------------------------------------------------------------- VARIANT records


def variant_counts(nodes: DataFrame, records: int) -> DataFrame:
    """``field_counts`` of VARIANT records, one row for each path that is a leaf somewhere.

    ``missing_key_count`` counts records without the place, ``physical_types`` explicit nulls
    too; an object is a value of a path that is a leaf in other records.
    """
    text = F.when(F.col("tag") == "string", F.nullif(F.col("text"), F.lit("")))
    gap = (F.col("tag") == "null") | ((F.col("tag") == "string") & (F.col("text") == ""))
    by_type = nodes.groupBy("path", "tag").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(gap).alias("gaps"),
        F.count_if(F.col("leaf")).alias("leaves"),
        F.min(F.length(text)).alias("min_length"),
        F.max(F.length(text)).alias("max_length"),
    )
    types = F.map_from_entries(F.sort_array(F.collect_list(F.struct("tag", "n"))))
    only = F.when(F.count(F.when(F.col("tag") != "null", 1)) == 1, F.max(F.when(F.col("tag") != "null", F.col("tag"))))
    return (
        by_type.groupBy("path")
        .agg(
            F.sum("leaves").alias("leaves"),
            only.alias("type_tag"),
            F.lit(records).cast("bigint").alias("record_count"),
            types.alias("physical_types"),
            (F.lit(records) - F.sum("n")).cast("bigint").alias("missing_key_count"),
            F.sum("gaps").alias("null_or_empty_count"),
            (F.sum("n") - F.sum("gaps")).alias("present_count"),
            F.min("min_length").alias("min_length"),
            F.max("max_length").alias("max_length"),
        )
        .where("leaves > 0")
        .drop("leaves")
    )


def _variant_known(cells: DataFrame) -> DataFrame:
    """Cells as ``paired`` takes them: ``cur`` and ``prev`` (tag, text, num) become all that they are compared by."""
    tag, made = F.col("cur.tag"), {}
    for side in ("cur", "prev"):
        digits = F.when(F.col(f"{side}.tag") == "string", F.nullif(F.regexp_extract(f"{side}.text", r"([0-9]+)\n?\z", 1), F.lit("")))
        cells = cells.withColumn(f"{side}_d", digits)
        bare = f"CASE WHEN {side}_d IS NOT NULL AND ltrim('0', {side}_d) = '' THEN '0' ELSE ltrim('0', {side}_d) END"
        cells = cells.withColumn(f"{side}_b", F.expr(bare))
        made[side] = F.expr(
            f"named_struct('text', {side}.text, 'kind', {side}.tag, 'num', CASE WHEN {side}.tag IN ('integer', 'number') THEN {side}.num END,"
            f" 'whole', CASE WHEN {side}.tag = 'integer' THEN try_cast({side}.text AS BIGINT) END, 'suffix',"
            f" CASE WHEN {side}_b IS NOT NULL THEN named_struct('size', length({side}_b), 'digits', {side}_b) END, 'next', {_next(f'{side}_b')})"
        ).alias(side)
    kinds = tag.alias("type_tag"), (tag == "string").alias("is_text"), (tag == "integer").alias("is_int")
    return cells.select("at", "path", *kinds, made["cur"], made["prev"])


def variant_value_table(nodes: DataFrame, records: int) -> DataFrame:
    """The ordered value table of present VARIANT values: see ``value_table``.

    Values of different types differ. Cells are walked by path and bucket of records; where a path
    mixes whole numbers and texts, steps between the two count neither as rise nor as fall.
    """
    some = nodes.where((F.col("tag") != "null") & ~((F.col("tag") == "string") & (F.col("text") == "")))
    rows = some.select("path", INDEX, "tag", "text", "num", order.index_bucket().alias("__bucket"))
    value = F.struct("tag", "text", "num")
    # Places of edges come from a hash table, so that no task sorts its cells to find them.
    places = stage(rows.groupBy("path", "__bucket").agg(F.min(INDEX).alias("__lo"), F.max(INDEX).alias("__hi")))
    groups = places.count()
    # As many tasks as it takes, so that what one sorts does not grow with the table.
    tasks = max(min(groups, WALK_TASKS), math.ceil(groups / WALK_GROUPS), 1)
    before = F.lag(value).over(Window.partitionBy("path", "__bucket").orderBy(INDEX))
    walked = rows.repartition(tasks, "path", "__bucket").select(F.col(INDEX).alias("at"), "path", value.alias("cur"), before.alias("prev"))
    if groups <= order.BROADCAST_BUCKETS // 2:
        places = F.broadcast(places)
    at_edge = (F.col(INDEX) == F.col("__lo")) | (F.col(INDEX) == F.col("__hi"))
    ends = stage(rows.join(places, ["path", "__bucket"]).where(at_edge).select(*rows.columns))
    edges = ends.groupBy("path", "__bucket").agg(F.min_by(value, INDEX).alias("first"), F.max_by(value, INDEX).alias("prev"))
    lasts = order.last_before(edges.select("path", "__bucket", "prev"), "__bucket", ["prev"], order.bucket_count(records), ["path"])
    meets = edges.select("path", "__bucket", "first").join(lasts, ["path", "__bucket"])
    meets = meets.select(F.lit(None).cast("bigint").alias("at"), "path", F.col("first").alias("cur"), "prev")
    walked, meets = _variant_known(walked), _variant_known(meets)
    long = paired(walked, same=_SAME_KIND).unionByName(paired(meets, edge=True, same=_SAME_KIND))
    return by_value(long, "path", "type_tag").drop("is_long")


def profile_variants(coll: Collection, sample_limit: int = 5) -> DataFrame:
    """The field profile of VARIANT records; missing keys are told from nulls."""
    nodes = stage(variant_nodes(coll))
    records = coll.count()
    counts = stage(variant_counts(nodes, records))
    held = nodes.join(counts.select("path"), "path", "left_semi")
    vt = stage(variant_value_table(held, records))
    present = held.where((F.col("tag") != "null") & ~((F.col("tag") == "string") & (F.col("text") == "")))
    text = F.when(F.col("tag") == "string", V.trimmed(F.col("text")))
    date, stamp = V.matches(F.col("text"), "iso_date"), V.matches(F.col("text"), "iso_datetime")
    # Only paths of dates alone have a range, so others are not sorted for their least and greatest text.
    texts = present.where("tag = 'string'").select("path", text.alias("text"))
    shares = texts.groupBy("path").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(date).alias("dates"), F.count_if(stamp).alias("stamps")
    )
    dated = stage(shares.where("n = dates OR n = stamps").select("path"))
    if dated.count() <= order.BROADCAST_FILES:
        dated = F.broadcast(dated)
    times = texts.join(dated, "path").groupBy("path").agg(F.min("text").alias("min"), F.max("text").alias("max"))
    return _whole_profile(
        counts,
        vt,
        distribution(present.select("path", "num")),
        times,
        lambda picked: _restored(picked, held, ["path", INDEX], F.col("text")),
        sample_limit,
    )


def profile_collections(collections: Sequence[Collection], sample_limit: int = 5) -> DataFrame:
    """Field profiles of several collections, keyed by ``record_path``."""
    parts = [
        profile_fields(c, sample_limit=sample_limit).withColumn("record_path", F.lit(c.record_path))
        for c in collections
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
