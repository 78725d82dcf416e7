"""Taxi, climate and airport recipes on synthetic rows of their schemas."""

import datetime as dt
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from patina import Collection
from patina.errors import PatinaError
from patina.operators import audit, cells, corrupt
from patina.operators import synthesize as S
from patina.plans import airports, climate, trips


def taxi(spark, n=60):
    rng = random.Random(3)
    rows = []
    for j in range(n):
        start = dt.datetime(2023, 1, 1 + j % 28, rng.randrange(24), rng.randrange(60), 7)
        fare = round(rng.uniform(4, 60), 2)
        rows.append(
            Row(
                record_index=j,
                VendorID=1 + j % 2,
                lpep_pickup_datetime=start,
                lpep_dropoff_datetime=start + dt.timedelta(seconds=rng.randrange(60, 4000)),
                RatecodeID=1.0 + j % 2,
                trip_type=1.0 if j % 5 else None,
                passenger_count=float(1 + j % 4) if j % 7 else None,
                trip_distance=round(rng.uniform(0.5, 20), 2),
                fare_amount=fare,
                extra=0.5,
                mta_tax=0.5,
                tip_amount=round(fare / 6, 2) if j % 3 else 0.0,
                tolls_amount=0.0,
                ehail_fee=None,
                improvement_surcharge=1.0,
                congestion_surcharge=2.75 if j % 4 == 0 else None,
                total_amount=0.0,
                payment_type=1.0 if j % 3 else 2.0,
                PULocationID=10 + j,
                DOLocationID=20 if j % 11 else 0,
            )
        )
    schema = (
        "record_index bigint, VendorID bigint, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
        "RatecodeID double, trip_type double, passenger_count double, trip_distance double, fare_amount double, "
        "extra double, mta_tax double, tip_amount double, tolls_amount double, ehail_fee double, "
        "improvement_surcharge double, congestion_surcharge double, total_amount double, payment_type double, "
        "PULocationID bigint, DOLocationID bigint"
    )
    return Collection(spark.createDataFrame(rows, schema), "", {"format": "parquet"})


def test_trips_keep_their_rules_and_a_short_total_breaks_them(spark):
    source = taxi(spark)
    assert source.df.where(trips.trip_eligibility("2023-01")).count() == sum(1 for j in range(60) if j % 11)
    clean = trips.recombine_trips(source, 4100)
    assert clean.df.count() == 60
    assert {r["rule"]: r["failed"] for r in audit.audit(clean.df, trips.trip_rules("2023-01")).collect()} == dict.fromkeys(
        ["chronology", "distance", "tip", "total", "month", "cash_tip"], 0
    )
    again = trips.recombine_trips(source.with_df(source.df.repartition(13)), 4100)
    assert cells.changed_paths(clean, again).count() == 0
    dirty = clean.with_df(clean.df.withColumn("total_amount", F.col("total_amount") - F.col("improvement_surcharge")))
    targets = clean.df.where("record_index < 4").select(F.lit("p").alias("patch_id"), "record_index")
    assert all(r["passed"] for r in audit.patch_efficacy(dirty, targets, trips.total_holds()).collect())
    assert not any(r["passed"] for r in audit.patch_efficacy(clean, targets, trips.total_holds()).collect())


def days(spark, n=59):
    rows = []
    for j in range(n):
        day = dt.date(2023, 1, 1) + dt.timedelta(days=j)
        row = {
            "Date/Time": f"{day.year}-{day.month:02d}-{day.day:02d}", "Year": str(day.year), "Month": f"{day.month:02d}", "Day": f"{day.day:02d}",
            climate.MAX: "" if j % 9 == 0 else f"{(j % 13) - 2.5:.1f}", "Max Temp Flag": "M" if j % 9 == 0 else "",
            climate.MIN: f"{(j % 13) - 8.5:.1f}", climate.MEAN: "", climate.HEAT: "", climate.COOL: "",
            climate.RAIN: f"{j % 4}.2", climate.SNOW: "1.5" if j % 5 == 0 else "0.0", climate.PRECIP: f"{j % 4}.2",
            climate.DEPTH: "3" if j % 5 == 0 else "", climate.GUST[0]: str(j % 36), climate.GUST[1]: str(30 + j),
        }
        rows.append(Row(**{k: v for k, v in row.items()}, record_index=j))
    names = [*row]
    schema = ", ".join(f"`{k}` string" for k in names) + ", record_index bigint"
    return Collection(spark.createDataFrame(rows, schema), "", {"format": "csv", "columns": names})


def test_days_stay_within_their_rules(spark):
    source = days(spark)
    clean = climate.recombine_days(source, 4103)
    assert {r["failed"] for r in audit.audit(clean.df, climate.day_rules()).collect()} == {0}
    assert climate.moved_flags(source, clean).count() == 0
    rows = {r["record_index"]: r for r in clean.df.collect()}
    assert rows[0][climate.MAX] == "" and rows[0][climate.HEAT] == ""
    pairs = {(r[climate.GUST[0]], r[climate.GUST[1]]) for r in source.df.collect()}
    assert {(r[climate.GUST[0]], r[climate.GUST[1]]) for r in rows.values()} <= pairs
    bent = clean.with_df(clean.df.withColumn(climate.HEAT, F.lit("99.9")))
    targets = clean.df.where("record_index in (1, 2)").select(F.lit("p").alias("patch_id"), "record_index")
    assert all(r["passed"] for r in audit.patch_efficacy(bent, targets, climate.heat_holds()).collect())


def flights(spark, per=3, airports_n=5):
    rng = random.Random(5)
    rows = []
    for month in range(1, 13):
        for a in range(airports_n):
            causes = {n: rng.randrange(5, 60) for n in ("Carrier", "Late Aircraft", "National Aviation System", "Security", "Weather")}
            fl = {"Cancelled": rng.randrange(9), "Delayed": sum(causes.values()), "Diverted": 2, "On Time": rng.randrange(500, 900)}
            mins = {n: 11 * c for n, c in causes.items()}
            names = ",".join(f"C{k}" for k in range(2 + (a + month) % 3))
            rows.append(
                (
                    len(rows),
                    (f"A{a}", f"Airport {a}"),
                    (f"2015/{month:02d}", month, str(month), 2015),
                    (
                        tuple(causes.values()),
                        (names, len(names.split(","))),
                        (*fl.values(), sum(fl.values())),
                        (*mins.values(), sum(mins.values())),
                    ),
                )
            )
    ints = "Carrier: int, `Late Aircraft`: int, `National Aviation System`: int, Security: int, Weather: int"
    schema = (
        "record_index bigint, Airport struct<Code: string, Name: string>, "
        "Time struct<Label: string, Month: int, `Month Name`: string, Year: int>, "
        f"Statistics struct<`# of Delays`: struct<{ints}>, Carriers: struct<Names: string, Total: int>, "
        "Flights: struct<Cancelled: int, Delayed: int, Diverted: int, `On Time`: int, Total: int>, "
        f"`Minutes Delayed`: struct<{ints}, Total: int>>"
    )
    return Collection(spark.createDataFrame(rows, schema), "", {"format": "json"})


def test_airport_months_recombine_inside_their_quarter(spark):
    source = flights(spark)
    clean = airports.recombine_airports(source, 4105)
    assert clean.schema == source.schema
    assert {r["failed"] for r in audit.audit(clean.df, airports.airport_rules(clean.schema)).collect()} == {0}
    assert airports.unseen_rosters(source, clean).count() == 0
    assert airports.moved_keys(source, clean).count() == 0
    assert airports.leaf_support(source, clean).count() == 0
    keys = audit.composite_key_count(clean.df, [F.col("Airport.Code"), F.col("Time.Label")])
    assert keys.head()[0] == 60
    assert source.df.where(airports.in_year(2014)).count() == 0
    lone = source.with_df(source.df.where("record_index = 0"), 1)
    with pytest.raises(PatinaError):
        airports.recombine_airports(lone, 1)


def test_nested_patches_change_one_leaf(spark):
    clean = flights(spark)
    error = corrupt.ErrorType("aggregation_mismatch", 1.0, ("/Statistics/Flights/Total",), None, "Totals add up.")
    plan = corrupt.corruption_plan([clean], [error], 0.05, 4105)
    assert plan.target_count == 3
    short = corrupt.omit_component(F.col("Statistics.Flights.Total"), F.col("Statistics.Flights.On Time"))
    patches = corrupt.derive_patches(plan, clean, {"aggregation_mismatch": short}, {})
    corrupt.require_valid(corrupt.patch_violations(plan, patches, [clean]))
    dirty = corrupt.apply_patches(clean, patches)
    changed = cells.changed_paths(clean, dirty).collect()
    assert [r["paths"] for r in changed] == [["/Statistics/Flights/Total"]] * 3
    assert dirty.schema == clean.schema


def test_donors_are_distinct_uniform_and_of_the_same_stratum(spark, monkeypatch):
    from patina.operators import order

    monkeypatch.setattr(order, "BUCKET_ROWS", 64)
    # One stratum holds most rows; another has nulls in its key.
    rows = [(j, None if j % 10 == 0 else ("hot" if j % 5 else f"s{j % 7}")) for j in range(1500)]
    c = Collection(spark.createDataFrame(rows, "record_index bigint, k string"))
    got = S.stratum_donor(c, F.col("k"), 1, ("a", "b"), ["record_index", "k"], distinct_pair=True).collect()
    assert len(got) == 1500
    assert all(r["donor_a"]["k"] == r["k"] == r["donor_b"]["k"] for r in got)
    assert all(r["donor_a"]["record_index"] != r["donor_b"]["record_index"] for r in got)
    hot = [r["donor_a"]["record_index"] for r in got if r["k"] == "hot"]
    assert len(set(hot)) > len(hot) * 0.5


def test_text_helpers(spark):
    df = spark.createDataFrame([("8.2",), ("11.57",), ("77",)], "v string")
    got = [r[0] for r in df.select(corrupt.swap_digits(F.col("v"))).collect()]
    assert got == ["2.8", "15.17", "77"]
    assert spark.range(1).select(corrupt.scale_by(F.lit(14.5), 10)).head()[0] == 145.0
    assert spark.range(1).select(F.round(corrupt.omit_component(F.lit(14.77), F.lit(1.0)), 2)).head()[0] == 13.77
