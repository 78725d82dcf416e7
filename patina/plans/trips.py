"""Taxi trips: eligibility, recombined clean trips, and their audit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patina.collection import INDEX, Collection
from patina.functions import draws
from patina.operators import synthesize as S

# Fixed column names of the trip schema.
PICKUP = "lpep_pickup_datetime"
DROPOFF = "lpep_dropoff_datetime"
FEES = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "ehail_fee",
)
CARD = 1
TAGS = ("a", "b", "riders", "tip")


def trip_eligibility(month: str) -> Column:
    """Plain comparisons, so the range parts reach the Parquet scan.

    ``month`` is ``yyyy-MM``; it becomes a half-open time range instead of formatted text.
    """
    start = F.to_timestamp_ntz(F.lit(month + "-01"))
    end = F.expr(f"to_timestamp_ntz(add_months(DATE'{month}-01', 1))")
    return (
        (F.col(PICKUP) >= start)
        & (F.col(PICKUP) < end)
        & (F.col(DROPOFF) >= F.col(PICKUP))
        & (F.col("trip_distance") > 0)
        & (F.col("trip_distance") < 100)
        & (F.col("fare_amount") > 0)
        & (F.col("fare_amount") < 500)
        & (F.col("PULocationID") != 0)
        & (F.col("DOLocationID") != 0)
    )


def hour_band(col: Column) -> Column:
    return F.floor(F.hour(col) / 6)


def _seconds(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(1e6)


def total(fees: tuple[str, ...] = FEES) -> Column:
    return S.component_total([F.col(f) for f in fees])


def recombine_trips(source: Collection, seed: int) -> Collection:
    """Clean trips: same slots and categories, measurements mixed from same-stratum trips."""
    kind = F.struct("RatecodeID", "trip_type")
    fee_kind = F.struct("RatecodeID", "trip_type", "VendorID", hour_band(F.col(PICKUP)).alias("band"))
    columns = [PICKUP, DROPOFF, "trip_distance", "fare_amount", "tip_amount", "passenger_count"]
    mixed = S.stratum_donor(source, kind, seed, TAGS, columns)
    fees = S.stratum_donor(source, fee_kind, seed, ("fee",), ["extra", "mta_tax"]).select(INDEX, "donor_fee")
    rows = mixed.join(fees, INDEX)
    cap = source.df.agg(F.max("tip_amount")).head()[0]  # one number
    w = S.blend_weight(seed, 0.25, 0.75)
    rows = S.convex_blend(rows, {"trip_distance": "money", "fare_amount": "money"}, seed)
    a, b, tip = F.col("donor_a"), F.col("donor_b"), F.col("donor_tip")
    stay = S.blend(w, _seconds(a[PICKUP], a[DROPOFF]), _seconds(b[PICKUP], b[DROPOFF]))
    second = (draws.draw(seed, "second", F.col(INDEX)) % 60).cast("int")
    minute = F.date_trunc("minute", F.col(PICKUP)).cast(source.df.schema[PICKUP].dataType)
    paid = S.capped_ratio(F.col("fare_amount"), tip["tip_amount"], tip["fare_amount"], F.lit(cap))
    rows = (
        rows.withColumn(PICKUP, F.timestamp_add("SECOND", second, minute))
        .withColumn(
            DROPOFF,
            F.timestamp_add("SECOND", F.greatest(F.lit(1), F.bround(stay, 0)).cast("int"), F.col(PICKUP)),
        )
        .withColumn("passenger_count", F.col("donor_riders")["passenger_count"])
        .withColumn("tip_amount", F.when(F.col("payment_type") == CARD, paid).otherwise(0.0))
    )
    rows = S.copy_jointly(rows, ["extra", "mta_tax"], "donor_fee").withColumn("total_amount", total())
    return source.with_df(rows.select(*source.df.columns), source.rows)


def trip_rules(month: str) -> dict[str, Column]:
    """Named rules a clean trip satisfies."""
    parts = F.lit(0.0)
    for f in FEES:
        parts = parts + F.coalesce(F.col(f).cast("double"), F.lit(0.0))
    return {
        "chronology": F.col(DROPOFF) >= F.col(PICKUP),
        "distance": F.col("trip_distance") > 0,
        "tip": F.col("tip_amount") >= 0,
        "total": F.abs(F.col("total_amount") - parts) < 0.011,
        "month": F.date_format(PICKUP, "yyyy-MM") == month,
        "cash_tip": (F.col("payment_type") == CARD) | (F.col("tip_amount") == 0),
    }


def total_holds() -> Column:
    """The rule a corrupted total must break."""
    parts = F.lit(0.0)
    for f in FEES:
        parts = parts + F.coalesce(F.col(f).cast("double"), F.lit(0.0))
    return F.abs(F.col("total_amount") - parts) <= 0.01
