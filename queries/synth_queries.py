"""Clean generation: donors, blends, derived columns, and the three domain recipes."""

from __future__ import annotations

from pyspark.sql import functions as F

from patina import Collection
from patina.operators import audit
from patina.operators import synthesize as S
from patina.plans import airports, climate, trips
from queries.base import query, read, table

SEED = 4105
SPAN = 16**12


def hexdraw(tag: str, i: str = "i") -> str:
    return f"('0x' || substr(md5('{SEED}:{tag}:' || {i}), 1, 12))::BIGINT"


def unit(tag: str, i: str = "i") -> str:
    return f"({hexdraw(tag, i)} / {SPAN}.0::DOUBLE)"


POOL_SQL = """pool AS (SELECT o_orderkey AS i, *, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderkey) - 1 AS ord,
  count(*) OVER (PARTITION BY o_orderpriority, o_orderstatus) AS n FROM orders)"""

PAIR_SQL = f"""drawn AS (SELECT *, {hexdraw("a")} % n AS da,
  CASE WHEN n > 1 THEN ({hexdraw("a")} % n + 1 + {hexdraw("b")} % (n - 1)) % n END AS db FROM pool),
pairs AS (SELECT d.*, a.i AS ia, b.i AS ib, a.o_totalprice AS pa, b.o_totalprice AS pb, a.o_custkey AS ca, b.o_custkey AS cb,
  0.25::DOUBLE + 0.5::DOUBLE * {unit("weight", "d.i")} AS w FROM drawn d
  JOIN pool a ON a.o_orderpriority = d.o_orderpriority AND a.o_orderstatus = d.o_orderstatus AND a.ord = d.da
  JOIN pool b ON b.o_orderpriority = d.o_orderpriority AND b.o_orderstatus = d.o_orderstatus AND b.ord = d.db)"""


def kind():
    return F.struct("o_orderpriority", "o_orderstatus")


@query(
    "stratum_ordinals",
    f"WITH {POOL_SQL} SELECT o_orderkey, ord AS ordinal, n AS stratum_size FROM pool",
)
def stratum_ordinals(spark, sf_dir):
    return S.stratum_ordinals(table(spark, sf_dir, "orders"), kind()).select(
        "o_orderkey", "ordinal", "stratum_size"
    )


@query(
    "donor_pairs",
    f"WITH {POOL_SQL}, {PAIR_SQL} SELECT o_orderkey, ia AS donor_a, ib AS donor_b FROM pairs",
)
def donor_pairs(spark, sf_dir):
    """Two distinct donors a row, from the same priority and status."""
    orders = table(spark, sf_dir, "orders")
    got = S.stratum_donor(orders, kind(), SEED, ("a", "b"), ["o_orderkey"], distinct_pair=True)
    return got.select("o_orderkey", F.col("donor_a.o_orderkey").alias("donor_a"), F.col("donor_b.o_orderkey").alias("donor_b"))


@query(
    "donor_blend",
    f"""WITH {POOL_SQL}, {PAIR_SQL} SELECT o_orderkey, CAST(round_even(w * ca + (1.0::DOUBLE - w) * cb, 0) AS BIGINT) AS o_custkey,
  round((w * pa + (1.0::DOUBLE - w) * pb) * 1e6, 0) / 1e6 AS price_6dp, o_orderstatus FROM pairs""",
)
def donor_blend(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rows = S.stratum_donor(orders, kind(), SEED, ("a", "b"), ["o_custkey", "o_totalprice"], distinct_pair=True)
    w = S.blend_weight(SEED, 0.25, 0.75)
    mixed = S.blend(w, F.col("donor_a.o_totalprice"), F.col("donor_b.o_totalprice"))
    rows = S.convex_blend(rows, {"o_custkey": "integer"}, SEED)
    return rows.select("o_orderkey", "o_custkey", (F.round(mixed * 1e6, 0) / 1e6).alias("price_6dp"), "o_orderstatus")


@query(
    "donor_joint_copy",
    f"""WITH {POOL_SQL}, d AS (SELECT *, {hexdraw("c")} % n AS dc FROM pool)
SELECT d.o_orderkey, c.o_custkey, strftime(c.o_orderdate, '%Y-%m-%d') AS o_orderdate FROM d
JOIN pool c ON c.o_orderpriority = d.o_orderpriority AND c.o_orderstatus = d.o_orderstatus AND c.ord = d.dc""",
)
def donor_joint_copy(spark, sf_dir):
    """Customer and date together from one donor, drawn with replacement."""
    orders = table(spark, sf_dir, "orders")
    rows = S.stratum_donor(orders, kind(), SEED, ("c",), ["o_custkey", "o_orderdate"])
    rows = S.copy_jointly(rows, ["o_custkey", "o_orderdate"], "donor_c")
    return rows.select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))


@query(
    "lonely_strata",
    """SELECT min(o_orderkey) AS record_index, 'single_row_stratum' AS rule FROM orders
GROUP BY o_custkey, o_orderpriority HAVING count(*) = 1""",
)
def lonely_strata(spark, sf_dir):
    return S.lonely_strata(table(spark, sf_dir, "orders"), F.struct("o_custkey", "o_orderpriority"))


@query(
    "derived_totals",
    f"""SELECT {", ".join(["l_orderkey", "l_linenumber", "l_partkey"])},
  round(l_quantity + nullif(l_discount, 0.05::DOUBLE) + l_tax, 2) IS NULL AS never,
  CAST(round((0.0::DOUBLE + l_quantity + coalesce(nullif(l_discount, 0.05::DOUBLE), 0) + l_tax) * 100) AS BIGINT) AS total_cents
FROM lineitem""",
)
def derived_totals(spark, sf_dir):
    df = read(spark, sf_dir, "lineitem")
    some = F.nullif(F.col("l_discount"), F.lit(0.05))
    total = S.component_total([F.col("l_quantity"), some, F.col("l_tax")])
    return df.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (F.col("l_quantity") + some + F.col("l_tax")).isNull().alias("never"),
        F.round(total * 100, 0).cast("bigint").alias("total_cents"),
    )


@query(
    "ratio_capped",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(100 * least(
  l_quantity * (l_tax / greatest(l_discount, 1.0::DOUBLE)), (SELECT max(l_discount) FROM lineitem) * 20)) AS BIGINT) AS tip_cents FROM lineitem""",
)
def ratio_capped(spark, sf_dir):
    df = read(spark, sf_dir, "lineitem")
    cap = df.agg(F.max("l_discount")).head()[0] * 20  # one number
    tip = S.capped_ratio(F.col("l_quantity"), F.col("l_tax"), F.col("l_discount"), F.lit(cap))
    return df.select("l_orderkey", "l_linenumber", "l_partkey", F.round(tip * 100, 0).cast("bigint").alias("tip_cents"))


@query(
    "list_length",
    "SELECT doc_id, len(string_split(text, ',')) AS names FROM documents",
)
def list_length(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", S.list_length(F.col("text")).cast("bigint").alias("names"))


@query(
    "conditional_support",
    """WITH b AS (SELECT o_orderpriority, min(o_totalprice) AS lo, max(o_totalprice) AS hi, min(o_custkey) AS clo, max(o_custkey) AS chi
  FROM orders GROUP BY o_orderpriority), c AS (SELECT o_orderkey AS i, o_orderpriority, o_totalprice * 1.01::DOUBLE AS p, o_custkey + 3 AS k FROM orders)
SELECT i AS record_index, 'o_totalprice' AS "column" FROM c JOIN b USING (o_orderpriority) WHERE NOT p BETWEEN lo AND hi
UNION ALL SELECT i, 'o_custkey' FROM c JOIN b USING (o_orderpriority) WHERE NOT k BETWEEN clo AND chi""",
)
def conditional_support(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    clean = orders.df.withColumn("o_totalprice", F.col("o_totalprice") * 1.01).withColumn("o_custkey", F.col("o_custkey") + 3)
    return S.conditional_support(
        orders, orders.with_df(clean), F.col("o_orderpriority"), ["o_totalprice", "o_custkey"]
    )


# ---------------------------------------------------------------- domain recipes

MONTH = "2024-01"


def trip_table(spark, sf_dir) -> Collection:
    """Events read as taxi trips, in the trip schema."""
    events = table(spark, sf_dir, "events")
    ride = F.col("value")
    kinds = F.crc32("event_type")
    df = events.df.select(
        "record_index",
        (F.col("user_id") % 2 + 1).alias("VendorID"),
        F.col("ts").alias(trips.PICKUP),
        F.timestamp_add("SECOND", (F.abs(ride) * 60 + 1).cast("int"), F.col("ts")).alias(trips.DROPOFF),
        F.lit("N").alias("store_and_fwd_flag"),
        (kinds % 3 + 1).cast("double").alias("RatecodeID"),
        (F.col("user_id") % 260 + 1).alias("PULocationID"),
        (F.col("user_id") % 255 + 2).alias("DOLocationID"),
        F.nullif(F.col("user_id") % 6, F.lit(0)).cast("double").alias("passenger_count"),
        F.round(F.abs(ride) / 7 + 0.1, 2).alias("trip_distance"),
        F.round(F.abs(ride) + 3, 2).alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.round(F.abs(ride) / 9, 2).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(None).cast("double").alias("ehail_fee"),
        F.lit(1.0).alias("improvement_surcharge"),
        F.lit(0.0).alias("total_amount"),
        (F.col("event_id") % 2 + 1).cast("double").alias("payment_type"),
        (kinds % 2 + 1).cast("double").alias("trip_type"),
        F.when(F.col("user_id") % 3 == 0, 2.75).alias("congestion_surcharge"),
    )
    return events.with_df(df, events.count())


@query("trip_eligibility", f"""SELECT date_trunc('hour', ts) AS hour, count(*) AS trips FROM events
  WHERE ts >= TIMESTAMP '{MONTH}-01' AND ts < TIMESTAMP '2024-02-01' AND round(abs(value) / 7 + 0.1, 2) < 100
    AND round(abs(value) + 3, 2) < 500 GROUP BY ALL""".replace("date_trunc('hour', ts) AS hour", "strftime(ts, '%Y-%m-%d %H') AS hour"))
def trip_eligibility(spark, sf_dir):
    kept = trip_table(spark, sf_dir).df.where(trips.trip_eligibility(MONTH))
    hour = F.date_format(trips.PICKUP, "yyyy-MM-dd HH").alias("hour")
    return kept.groupBy(hour).agg(F.count(F.lit(1)).alias("trips"))


@query("trip_audit", f"""SELECT unnest(['chronology', 'distance', 'tip', 'total', 'cash_tip']) AS rule, n AS checked, 0::BIGINT AS failed
  FROM (SELECT count(*) AS n FROM events)""")
def trip_audit(spark, sf_dir):
    """Recombined trips break none of the trip rules."""
    clean = trips.recombine_trips(trip_table(spark, sf_dir), SEED)
    rules = trips.trip_rules(MONTH)
    rules.pop("month")  # the events span more than one month
    return audit.audit(clean.df, rules)


CRC_SQL = """xor(4294967295, list_reduce(list_transform(string_split(event_type, ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda v, k: xor(v >> 1, (v & 1) * 3988292384)), 4294967295))"""

TRIPS_SQL = f"""t AS MATERIALIZED (SELECT event_id AS i, kinds % 3 + 1 AS rate, kinds % 2 + 1 AS kind, user_id % 2 + 1 AS vendor, ts AS pickup,
    CAST(trunc(abs(value) * 60 + 1) AS BIGINT) AS stay, CAST(nullif(user_id % 6, 0) AS DOUBLE) AS riders,
    round(abs(value) / 7 + 0.1, 2) AS distance, round(abs(value) + 3, 2) AS fare, round(abs(value) / 9, 2) AS tip,
    event_id % 2 + 1 AS payment, CASE WHEN user_id % 3 = 0 THEN 2.75 END AS surcharge
  FROM (SELECT *, {CRC_SQL} AS kinds FROM events)),
pool AS MATERIALIZED (SELECT *, rate || '/' || kind || '/' AS stratum, stratum || (row_number() OVER (PARTITION BY rate, kind ORDER BY i) - 1) AS spot,
  count(*) OVER (PARTITION BY rate, kind) AS n FROM t),
drawn AS MATERIALIZED (SELECT *, stratum || ({hexdraw("a")} % n) AS da, stratum || ({hexdraw("b")} % n) AS db,
  stratum || ({hexdraw("riders")} % n) AS dr, stratum || ({hexdraw("tip")} % n) AS dt,
  0.25::DOUBLE + 0.5::DOUBLE * {unit("weight")} AS w, {hexdraw("second")} % 60 AS sec FROM pool),
mixed AS (SELECT d.i, d.payment, d.surcharge, date_trunc('minute', d.pickup) + to_seconds(d.sec) AS pickup, r.riders,
    round(w * a.distance + (1.0::DOUBLE - w) * b.distance, 2) AS distance, round(w * a.fare + (1.0::DOUBLE - w) * b.fare, 2) AS fare,
    CAST(greatest(1, round_even(w * a.stay + (1.0::DOUBLE - w) * b.stay, 0)) AS BIGINT) AS stay, p.tip / greatest(p.fare, 1.0::DOUBLE) AS share
  FROM drawn d JOIN pool a ON a.spot = d.da JOIN pool b ON b.spot = d.db JOIN pool r ON r.spot = d.dr JOIN pool p ON p.spot = d.dt),
tipped AS (SELECT *, CASE WHEN payment = 1 THEN least(round(fare * share, 2), (SELECT max(tip) FROM t)) ELSE 0 END AS paid FROM mixed)"""


@query(
    "recombined_trips",
    f"""WITH {TRIPS_SQL} SELECT i AS record_index, strftime(pickup, '%Y-%m-%d %H:%M:%S') AS pickup, stay AS seconds, riders AS passenger_count,
  CAST(round(distance * 100) AS BIGINT) AS distance, CAST(round(fare * 100) AS BIGINT) AS fare, CAST(round(paid * 100) AS BIGINT) AS tip,
  CAST(round((fare + 0.5 + 0.5 + paid + 1.0 + coalesce(surcharge, 0)) * 100) AS BIGINT) AS total FROM tipped""",
)
def recombined_trips(spark, sf_dir):
    """Every recombined value of the taxi recipe: times, riders, and amounts in cents."""
    clean = trips.recombine_trips(trip_table(spark, sf_dir), SEED).df
    cents = lambda c: F.round(F.col(c) * 100, 0).cast("bigint")
    seconds = F.unix_micros(F.col(trips.DROPOFF).cast("timestamp")) - F.unix_micros(F.col(trips.PICKUP).cast("timestamp"))
    return clean.select(
        "record_index",
        F.date_format(trips.PICKUP, "yyyy-MM-dd HH:mm:ss").alias("pickup"),
        (seconds / 1_000_000).cast("bigint").alias("seconds"),
        "passenger_count",
        cents("trip_distance").alias("distance"),
        cents("fare_amount").alias("fare"),
        cents("tip_amount").alias("tip"),
        cents("total_amount").alias("total"),
    )


def day_table(spark, sf_dir) -> Collection:
    """Orders read as daily climate rows (all text), in the climate schema."""
    orders = table(spark, sf_dir, "orders")
    cold = F.col("o_totalprice") / 12000 - 18
    snowy = F.col("o_orderstatus") == "F"
    rainy = F.round(F.col("o_custkey") % 40 / 3, 1)

    def one(x):
        return F.format_string("%.1f", x)

    df = orders.df.select(
        "record_index",
        F.date_format("o_orderdate", "yyyy-M-d").alias("Date/Time"),
        F.date_format("o_orderdate", "yyyy").alias("Year"),
        F.date_format("o_orderdate", "M").alias("Month"),
        F.date_format("o_orderdate", "d").alias("Day"),
        F.when(F.col("o_custkey") % 50 == 0, "").otherwise(one(cold + 6)).alias(climate.MAX),
        F.when(F.col("o_custkey") % 50 == 0, "M").otherwise("").alias("Max Temp Flag"),
        one(cold).alias(climate.MIN),
        F.lit("").alias(climate.MEAN),
        F.lit("").alias(climate.HEAT),
        F.lit("").alias(climate.COOL),
        one(rainy).alias(climate.RAIN),
        F.when(snowy, one(rainy)).otherwise("0.0").alias(climate.SNOW),
        one(rainy).alias(climate.PRECIP),
        F.when(snowy, "4").otherwise("").alias(climate.DEPTH),
        F.lit("12").alias(climate.GUST[0]),
        F.lit("45").alias(climate.GUST[1]),
    )
    return orders.with_df(df, orders.count())


@query("climate_audit", """SELECT unnest(['bounds', 'midpoint', 'heat', 'cool', 'precipitation', 'date', 'flags']) AS rule,
  n AS checked, 0::BIGINT AS failed FROM (SELECT count(*) AS n FROM orders)""")
def climate_audit(spark, sf_dir):
    """Recombined days break none of the climate rules and keep every flag in place."""
    source = day_table(spark, sf_dir)
    clean = climate.recombine_days(source, SEED)
    moved = climate.moved_flags(source, clean).agg(
        F.lit("flags").alias("rule"),
        F.lit(source.count()).cast("bigint").alias("checked"),
        F.count(F.lit(1)).alias("failed"),
    )
    return audit.audit(clean.df, climate.day_rules()).unionByName(moved)


# Python's 0.8 - 0.2 is not 0.6; texts are rounded half up on their shortest decimal form.
DAYS_SQL = f"""d AS MATERIALIZED (SELECT i, month(day) || '/' || gap || '/' || (snow > 0) || '/' AS stratum, low, snow, rain, depth,
    CASE WHEN NOT gap THEN CAST(printf('%.1f', cold + 6) AS DOUBLE) END AS high
  FROM (SELECT *, CASE WHEN status = 'F' THEN rain ELSE 0 END AS snow, CASE WHEN status = 'F' THEN '4' ELSE '' END AS depth
    FROM (SELECT o_orderkey AS i, o_orderdate AS day, o_orderstatus AS status, o_custkey % 50 = 0 AS gap, o_totalprice / 12000 - 18 AS cold,
      CAST(printf('%.1f', cold) AS DOUBLE) AS low, round(o_custkey % 40 / 3, 1) AS rain FROM orders))),
pool AS MATERIALIZED (SELECT *, stratum || (row_number() OVER (PARTITION BY stratum ORDER BY i) - 1) AS spot, count(*) OVER (PARTITION BY stratum) AS n FROM d),
drawn AS MATERIALIZED (SELECT i, stratum || ({hexdraw("a")} % n) AS da, stratum || ({hexdraw("b")} % n) AS db,
  0.2::DOUBLE + {0.8 - 0.2!r}::DOUBLE * {unit("weight")} AS w FROM pool),
mixed AS (SELECT d.i, a.depth, {", ".join(f"CAST(printf('%.1f', w * a.{c} + (1.0::DOUBLE - w) * b.{c}) AS DOUBLE) AS {c}" for c in ("high", "low", "rain", "snow"))}
  FROM drawn d JOIN pool a ON a.spot = d.da JOIN pool b ON b.spot = d.db),
means AS (SELECT *, CAST(round(CAST(CAST((high + low) / 2 AS VARCHAR) AS DECIMAL(38, 18)), 1) AS DOUBLE) AS mean FROM mixed)"""
TENTHS = {"high": climate.MAX, "low": climate.MIN, "mean": climate.MEAN, "heat": climate.HEAT, "cool": climate.COOL, "rain": climate.RAIN, "snow": climate.SNOW}


@query(
    "recombined_days",
    f"""WITH {DAYS_SQL} SELECT i AS record_index, depth, {", ".join(f"CAST(round({x} * 10) AS BIGINT) AS {n}" for n, x in {
        **{n: n for n in TENTHS}, "heat": "CASE WHEN mean IS NOT NULL THEN greatest(18 - mean, 0) END", "cool": "CASE WHEN mean IS NOT NULL THEN greatest(mean - 18, 0) END"
    }.items())} FROM means""",
)
def recombined_days(spark, sf_dir):
    """Every recombined value of the climate recipe, in tenths."""
    clean = climate.recombine_days(day_table(spark, sf_dir), SEED).df
    tenths = [F.round(climate.number(c) * 10, 0).cast("bigint").alias(n) for n, c in TENTHS.items()]
    return clean.select("record_index", F.col(f"`{climate.DEPTH}`").alias("depth"), *tenths)


def airport_table(spark, sf_dir) -> Collection:
    """Orders read as nested airport-month statistics, one record an order."""
    orders = table(spark, sf_dir, "orders")
    k, price = F.col("o_custkey"), F.col("o_totalprice")

    def count(shift: int, span: int):
        return (F.floor(price / (10 + shift)) % span).cast("int")

    causes = {"Carrier": 40, "Late Aircraft": 50, "National Aviation System": 30, "Security": 3, "Weather": 9}
    delays = {n: count(j, span) for j, (n, span) in enumerate(causes.items())}
    delayed = sum(list(delays.values())[1:], list(delays.values())[0])
    flights = {"Cancelled": count(7, 20), "Delayed": delayed, "Diverted": count(8, 5), "On Time": count(9, 900)}
    minutes = {n: (c * 11).cast("int") for n, c in delays.items()}

    def group(parts, total=True):
        whole = sum(list(parts.values())[1:], list(parts.values())[0])
        cols = [c.alias(n) for n, c in parts.items()]
        return F.struct(*cols, *([whole.alias("Total")] if total else []))

    names = F.concat_ws(",", F.lit("Acme"), F.when(k % 2 == 0, F.lit("Borealis")), F.col("o_orderpriority"))
    df = orders.df.select(
        "record_index",
        F.struct((k % 29).cast("string").alias("Code"), F.lit("x").alias("Name")).alias("Airport"),
        F.struct(
            F.date_format("o_orderdate", "yyyy/MM").alias("Label"),
            F.month("o_orderdate").alias("Month"),
            F.date_format("o_orderdate", "MMMM").alias("Month Name"),
            F.year("o_orderdate").alias("Year"),
        ).alias("Time"),
        F.struct(
            group(delays, total=False).alias("# of Delays"),
            F.struct(names.alias("Names"), F.size(F.split(names, ",")).alias("Total")).alias("Carriers"),
            group(flights).alias("Flights"),
            group(minutes).alias("Minutes Delayed"),
        ).alias("Statistics"),
    )
    return orders.with_df(df, orders.count())


@query("nested_filter", "SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1")
def nested_filter(spark, sf_dir):
    rows = airport_table(spark, sf_dir).df.where(airports.in_year(1997))
    return rows.groupBy(F.col("Time.Month").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("airport_audit", """SELECT unnest(['residual', 'roster_size', 'counts:# of Delays', 'counts:Flights', 'total:Flights',
  'counts:Minutes Delayed', 'total:Minutes Delayed', 'roster_seen', 'keys', 'support']) AS rule, n AS checked, 0::BIGINT AS failed
  FROM (SELECT count(*) AS n FROM orders)""")
def airport_audit(spark, sf_dir):
    """Recombined nested records break no rule and stay inside their stratum's range."""
    source = airport_table(spark, sf_dir)
    clean = airports.recombine_airports(source, SEED)
    checked = F.lit(source.count()).cast("bigint").alias("checked")

    def none(rule: str, found):
        return found.agg(F.lit(rule).alias("rule"), checked, F.count(F.lit(1)).alias("failed"))

    return (
        audit.audit(clean.df, airports.airport_rules(clean.schema))
        .unionByName(none("roster_seen", airports.unseen_rosters(source, clean)))
        .unionByName(none("keys", airports.moved_keys(source, clean)))
        .unionByName(none("support", airports.leaf_support(source, clean)))
    )
