"""Daily climate tables: text measurements recombined within month, flags and snow state."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patina.collection import INDEX, Collection
from patina.functions.pointers import quoted
from patina.operators import synthesize as S

# Fixed column names of the daily climate schema.
MAX, MIN, MEAN = "Max Temp (°C)", "Min Temp (°C)", "Mean Temp (°C)"
HEAT, COOL = "Heat Deg Days (°C)", "Cool Deg Days (°C)"
RAIN, SNOW, PRECIP = "Total Rain (mm)", "Total Snow (cm)", "Total Precip (mm)"
DEPTH = "Snow on Grnd (cm)"
GUST = ("Dir of Max Gust (10s deg)", "Spd of Max Gust (km/h)")
BASE_TEMPERATURE = 18.0


def number(name: str) -> Column:
    return F.col(quoted(name)).try_cast("double")


def flags(columns: list[str]) -> list[str]:
    return [c for c in columns if c.endswith("Flag")]


def stratum(columns: list[str]) -> Column:
    """Month, every quality flag, and whether it snowed."""
    snowy = F.coalesce(number(SNOW) > 0, F.lit(False)).alias("snowy")
    return F.struct(F.col("Month"), *[F.col(quoted(f)).alias(f"flag{j}") for j, f in enumerate(flags(columns))], snowy)


def degree_days(df):
    """Mean temperature and degree days as text, empty where a bound is empty."""
    mean = F.round((number(MAX) + number(MIN)) / 2, 1)
    both = (F.col(quoted(MAX)) != "") & (F.col(quoted(MIN)) != "")

    def text(x: Column) -> Column:
        return F.when(both, F.format_string("%.1f", x)).otherwise("")

    return df.withColumns(
        {
            MEAN: text(mean),
            HEAT: text(F.greatest(F.lit(BASE_TEMPERATURE) - mean, F.lit(0.0))),
            COOL: text(F.greatest(mean - F.lit(BASE_TEMPERATURE), F.lit(0.0))),
        }
    )


def recombine_days(source: Collection, seed: int) -> Collection:
    """Clean days: the calendar and flags stay, measurements come from two similar days."""
    blended = [MAX, MIN, RAIN, SNOW, PRECIP]
    copied = [*GUST, DEPTH]
    rows = S.stratum_donor(source, stratum(source.data_columns), seed, ("a", "b"), [*blended, *copied])
    rows = S.convex_blend(rows, dict.fromkeys(blended, "text"), seed, 0.2, 0.8)
    rows = degree_days(S.copy_jointly(rows, copied, "donor_a"))
    return source.with_df(rows.select(*[F.col(quoted(c)) for c in source.df.columns]), source.rows)


def _heat() -> Column:
    return F.greatest(F.lit(BASE_TEMPERATURE) - number(MEAN), F.lit(0.0))


def day_rules() -> dict[str, Column]:
    """Named rules a clean day satisfies on its own."""
    measured = F.col(quoted(MEAN)) != ""

    def if_measured(test: Column) -> Column:
        return F.when(measured, test).otherwise(True)

    cool = F.greatest(number(MEAN) - F.lit(BASE_TEMPERATURE), F.lit(0.0))
    wet = F.lit(True)
    for c in (RAIN, SNOW, PRECIP, DEPTH):
        wet = wet & ((F.col(quoted(c)) == "") | (number(c) >= 0))
    date = F.concat_ws("-", "Year", "Month", "Day")
    return {
        "bounds": if_measured((number(MIN) <= number(MEAN)) & (number(MEAN) <= number(MAX))),
        "midpoint": if_measured(F.abs(number(MEAN) - (number(MIN) + number(MAX)) / 2) <= 0.051),
        "heat": if_measured(F.abs(number(HEAT) - _heat()) < 0.011),
        "cool": if_measured(F.abs(number(COOL) - cool) < 0.011),
        "precipitation": wet,
        "date": F.col("`Date/Time`") == date,
    }


def moved_flags(source: Collection, clean: Collection):
    """Days whose quality flags differ from the source day at the same position."""
    names = flags(source.data_columns)
    a = source.df.select(INDEX, F.struct(*[F.col(quoted(f)).alias(f"f{j}") for j, f in enumerate(names)]).alias("a"))
    b = clean.df.select(INDEX, F.struct(*[F.col(quoted(f)).alias(f"f{j}") for j, f in enumerate(names)]).alias("b"))
    return a.join(b, INDEX).where(~F.col("a").eqNullSafe(F.col("b"))).select(INDEX)


def heat_holds() -> Column:
    """The rule a corrupted degree-day value must break."""
    return F.abs(number(HEAT) - _heat()) <= 0.01
