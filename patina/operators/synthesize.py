"""Clean data by recombination: donors from the same stratum, blends, derived columns.

Donors are found by ordinal. Every row of a stratum gets a number, every row draws two
numbers, and an equi-join on (stratum, number) fetches the donors. Draws are uniform, so
the join keys are spread evenly even when one stratum holds a third of the table; the
numbering itself is split into index buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patina.collection import INDEX, Collection
from patina.errors import PatinaError
from patina.functions import draws
from patina.operators import order
from patina.operators.stage import stage

LOOKUP_SALT = 32


def stratum_ordinals(coll: Collection, stratum: Column) -> DataFrame:
    """Add ``stratum`` (a struct), ``ordinal`` (zero-based in the stratum) and ``stratum_size``."""
    keyed = coll.df.withColumn("stratum", F.struct(stratum.alias("key")))
    buckets = order.bucket_count(coll.count())
    return order.number_within(keyed, order.index_bucket(), buckets, [INDEX], "ordinal", by=["stratum"], total="stratum_size")


def salted_lookup(rows: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of rows to one lookup row per key, safe for a key with most rows.

    The lookup is repeated LOOKUP_SALT times and rows spread over the copies, so the
    largest key splits into that many tasks. When Spark measures the lookup small
    enough it broadcasts it at run time and the salt costs nothing.
    """
    copies = lookup.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(LOOKUP_SALT - 1))))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(F.col(INDEX)), F.lit(LOOKUP_SALT)).cast("int"))
    return salted.join(copies, [*keys, "__salt"], "left").drop("__salt")


def donor_draws(
    numbered: DataFrame, seed: int, tags: Sequence[str], distinct_pair: bool = False
) -> DataFrame:
    """Draw one ordinal per tag (column ``draw_<tag>``) within each row's stratum.

    Draws are with replacement. ``distinct_pair`` makes the second of two tags differ
    from the first; a stratum of one row then draws null.
    """
    n = F.col("stratum_size")
    cols: dict[str, Column] = {}
    for j, tag in enumerate(tags):
        u = draws.draw(seed, tag, F.col(INDEX))
        if distinct_pair and j == 1:
            first = draws.draw(seed, tags[0], F.col(INDEX)) % n
            cols[f"draw_{tag}"] = F.when(n > 1, (first + 1 + u % F.nullif(n - 1, F.lit(0))) % n)
        else:
            cols[f"draw_{tag}"] = F.when(n > 1, u % n) if distinct_pair else u % n
    return numbered.withColumns(cols)


def attach_donors(
    drawn: DataFrame, pool: DataFrame, tags: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Fetch the drawn rows of ``pool`` (it has stratum, ordinal) as structs ``donor_<tag>``.

    Requests of all tags are one narrow table of keys that meets the donors' columns once; what
    they find goes back to the rows by index. Whole rows take part in that last join alone.
    """
    requests = drawn.select(
        INDEX,
        "stratum",
        F.explode(F.array(*[F.struct(F.lit(t).alias("tag"), F.col(f"draw_{t}").alias("ordinal")) for t in tags])).alias("r"),
    ).select(INDEX, "stratum", "r.*")
    donors = pool.select("stratum", "ordinal", F.struct(*[F.col(f"`{c}`") for c in columns]).alias("donor"))
    found = requests.join(donors, ["stratum", "ordinal"])
    one = lambda t: F.first(F.when(F.col("tag") == t, F.col("donor")), ignorenulls=True)
    back = found.groupBy(INDEX).agg(*[one(t).alias(f"donor_{t}") for t in tags])
    rows = drawn.drop("stratum", "ordinal", "stratum_size", *[f"draw_{t}" for t in tags])
    return rows.join(back, INDEX, "left")


def stratum_donor(
    coll: Collection,
    stratum: Column,
    seed: int,
    tags: Sequence[str] = ("a", "b"),
    columns: Sequence[str] | None = None,
    distinct_pair: bool = False,
) -> DataFrame:
    """The collection's rows with a random same-stratum donor struct per tag."""
    names = list(columns) if columns is not None else coll.data_columns
    # Read once for the rows and once per tag, and numbering shuffles the table.
    numbered = stage(stratum_ordinals(coll, stratum))
    drawn = donor_draws(numbered, seed, tags, distinct_pair)
    return attach_donors(drawn, numbered, tags, names)


def lonely_strata(coll: Collection, stratum: Column) -> DataFrame:
    """Strata of one row, which cannot give two distinct donors."""
    sizes = coll.df.groupBy(F.struct(stratum.alias("key")).alias("stratum")).agg(
        F.count(F.lit(1)).alias("stratum_size"), F.min(INDEX).alias(INDEX)
    )
    return sizes.where(F.col("stratum_size") == 1).select(INDEX, F.lit("single_row_stratum").alias("rule"))


def require_pairs(coll: Collection, stratum: Column) -> None:
    alone = lonely_strata(coll, stratum).limit(5).collect()
    if alone:
        raise PatinaError(f"strata with one row, for example at record {alone[0][0]}")


def blend(weight: Column, a: Column, b: Column) -> Column:
    """Convex combination of two donors' numbers."""
    return weight * a + (F.lit(1.0) - weight) * b


def blend_weight(seed: int, lo: float, hi: float) -> Column:
    """One weight per row, shared by every blended column of that row."""
    return draws.draw_between(lo, hi, seed, "weight", F.col(INDEX))


def convex_blend(
    df: DataFrame,
    columns: Mapping[str, str],
    seed: int,
    lo: float = 0.25,
    hi: float = 0.75,
    a: str = "donor_a",
    b: str = "donor_b",
) -> DataFrame:
    """Blend columns of two donors with one weight a row.

    ``columns`` maps a name to how it is stored: ``money`` (2 decimals), ``integer``
    (half-even) or ``text`` (1 decimal, empty when a donor is empty).
    """
    w = blend_weight(seed, lo, hi)
    new = {}
    for name, kind in columns.items():
        x, y = F.col(a).getField(name), F.col(b).getField(name)
        if kind == "money":
            new[name] = F.round(blend(w, x, y), 2)
        elif kind == "integer":
            new[name] = F.bround(blend(w, x, y), 0).cast(df.schema[name].dataType)
        elif kind == "text":
            mixed = blend(w, x.try_cast("double"), y.try_cast("double"))
            new[name] = F.when((x != "") & (y != ""), F.format_string("%.1f", mixed)).otherwise("")
        else:
            raise PatinaError(f"unknown blend kind {kind!r}")
    return df.withColumns(new)


def copy_jointly(df: DataFrame, columns: Sequence[str], donor: str) -> DataFrame:
    """Take several columns from the same donor, so their joint values were observed."""
    return df.withColumns({c: F.col(donor).getField(c) for c in columns})


def capped_ratio(base: Column, part: Column, whole: Column, cap: Column) -> Column:
    """``base`` times an observed part/whole ratio, 2 decimals, at most ``cap``."""
    return F.least(F.round(base * (part / F.greatest(whole, F.lit(1.0))), 2), cap)


def component_total(parts: Sequence[Column], scale: int = 2) -> Column:
    """Sum of components, nulls as zero."""
    total = F.lit(0.0)
    for p in parts:
        total = total + F.coalesce(p.cast("double"), F.lit(0.0))
    return F.round(total, scale)


def list_length(names: Column) -> Column:
    """How many comma-separated names a roster holds."""
    return F.size(F.split(names, ","))


def conditional_support(
    source: Collection, clean: Collection, stratum: Column, columns: Sequence[str]
) -> DataFrame:
    """(record_index, column) of clean values outside their stratum's source range."""
    bounds = source.df.groupBy(F.struct(stratum.alias("key")).alias("stratum")).agg(
        *[F.min(F.col(f"`{c}`")).alias(f"__lo{j}") for j, c in enumerate(columns)],
        *[F.max(F.col(f"`{c}`")).alias(f"__hi{j}") for j, c in enumerate(columns)],
    )
    rows = clean.df.withColumn("stratum", F.struct(stratum.alias("key")))
    rows = rows.select(INDEX, "stratum", *[F.col(f"`{c}`") for c in columns])
    joined = salted_lookup(rows, bounds, ["stratum"])
    outside = [
        F.when(
            ~F.coalesce(F.col(f"`{c}`").between(F.col(f"__lo{j}"), F.col(f"__hi{j}")), F.lit(False)),
            F.lit(c),
        )
        for j, c in enumerate(columns)
    ]
    return joined.select(INDEX, F.explode(F.array_compact(F.array(*outside))).alias("column"))
