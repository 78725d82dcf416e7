"""Nested airport-month statistics: integer blends, rebuilt totals, residual checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patina.collection import INDEX, Collection
from patina.functions.pointers import get_path, join, set_paths, type_at
from patina.operators import synthesize as S

# Fixed names of the nested schema.
GROUPS = ("# of Delays", "Flights", "Minutes Delayed")
STATS = "Statistics"
ROSTER = join(STATS, "Carriers", "Names")
ROSTER_SIZE = join(STATS, "Carriers", "Total")
MAX_RESIDUAL = 7


def in_year(year: int) -> Column:
    """Nested equality filter, pushed to a Parquet scan as a nested field filter."""
    return F.col("Time.Year") == year


def stratum() -> Column:
    """Airport and quarter."""
    return F.struct(F.col("Airport.Code").alias("code"), F.floor((F.col("Time.Month") - 1) / 3).alias("quarter"))


def members(schema: T.StructType, group: str) -> tuple[list[str], bool]:
    """Names counted in a group, and whether it has a Total."""
    names = type_at(schema, join(STATS, group)).names
    return [n for n in names if n != "Total"], "Total" in names


def recombine_airports(source: Collection, seed: int) -> Collection:
    """Clean records: two distinct donors of the airport's quarter, blended per count."""
    S.require_pairs(source, stratum())
    rows = S.stratum_donor(source, stratum(), seed, ("a", "b"), [STATS], distinct_pair=True)
    w = S.blend_weight(seed, 0.25, 0.75)
    donors = T.StructType([source.df.schema[STATS]])
    values = {}
    for group in GROUPS:
        names, has_total = members(source.schema, group)
        blended = []
        for n in names:
            p = join(STATS, group, n)
            a, b = get_path(donors, p, "donor_a"), get_path(donors, p, "donor_b")
            blended.append(F.bround(S.blend(w, a, b), 0).cast(type_at(source.schema, p)))
            values[p] = blended[-1]
        if has_total:
            p = join(STATS, group, "Total")
            values[p] = reduce(lambda x, y: x + y, blended).cast(type_at(source.schema, p))
    roster = get_path(donors, ROSTER, "donor_a")
    values[ROSTER] = roster
    values[ROSTER_SIZE] = S.list_length(roster).cast(type_at(source.schema, ROSTER_SIZE))
    rows = set_paths(rows, values)
    return source.with_df(rows.select(*source.df.columns), source.rows)


def group_sum(schema: T.StructType, group: str) -> Column:
    names, _ = members(schema, group)
    return reduce(lambda x, y: x + y, [get_path(schema, join(STATS, group, n)) for n in names])


def residual(schema: T.StructType) -> Column:
    """Delays by cause minus flights delayed."""
    return group_sum(schema, "# of Delays") - get_path(schema, join(STATS, "Flights", "Delayed"))


def airport_rules(schema: T.StructType) -> dict[str, Column]:
    """Named rules a clean record satisfies on its own."""
    rules = {
        "residual": F.abs(residual(schema)) <= MAX_RESIDUAL,
        "roster_size": get_path(schema, ROSTER_SIZE) == S.list_length(get_path(schema, ROSTER)),
    }
    for group in GROUPS:
        names, has_total = members(schema, group)
        every = [*names, *(["Total"] if has_total else [])]
        rules[f"counts:{group}"] = reduce(
            lambda x, y: x & y, [get_path(schema, join(STATS, group, n)) >= 0 for n in every]
        )
        if has_total:
            rules[f"total:{group}"] = get_path(schema, join(STATS, group, "Total")) == group_sum(schema, group)
    return rules


def unseen_rosters(source: Collection, clean: Collection) -> DataFrame:
    """Clean records whose roster no source record of the stratum has."""
    key = [F.struct(stratum().alias("key")).alias("stratum"), get_path(source.schema, ROSTER).alias("roster")]
    seen = source.df.select(*key).distinct()
    wanted = clean.df.select(INDEX, *key)
    # Rosters repeat within a stratum: reduce to distinct pairs before testing them.
    unseen = wanted.select("stratum", "roster").distinct().join(seen, ["stratum", "roster"], "left_anti")
    return wanted.join(unseen, ["stratum", "roster"], "left_semi").select(INDEX)


def moved_keys(source: Collection, clean: Collection) -> DataFrame:
    """Positions whose airport or month differs between source and clean."""
    a = source.df.select(INDEX, F.struct("Airport", "Time").alias("a"))
    b = clean.df.select(INDEX, F.struct("Airport", "Time").alias("b"))
    return a.join(b, INDEX).where(~F.col("a").eqNullSafe(F.col("b"))).select(INDEX)


def leaf_support(source: Collection, clean: Collection) -> DataFrame:
    """(record_index, column) of counts outside their stratum's observed range."""
    flat = {}
    for group in GROUPS:
        for n in members(source.schema, group)[0]:
            flat[f"{group}/{n}"] = get_path(source.schema, join(STATS, group, n))
    s = source.with_df(source.df.withColumns(flat), source.rows)
    c = clean.with_df(clean.df.withColumns(flat), clean.rows)
    return S.conditional_support(s, c, stratum(), list(flat))
