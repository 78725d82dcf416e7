"""Profiles: counts, quantiles, patterns, frequent values, order in the file."""

from __future__ import annotations

from pyspark.sql import functions as F

from patina import Collection
from patina.functions.values import PATTERNS
from patina.operators import order
from patina.operators import profile as P
from queries.base import LINE_KEY, query, read, table


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------- counts and lengths

CUSTOMER_GAPS = """g AS (SELECT c_custkey,
    CASE WHEN c_nationkey = 3 THEN '' ELSE c_name END AS c_name,
    nullif(c_mktsegment, 'BUILDING') AS c_mktsegment,
    CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer)"""


def gapped_customer(spark, sf_dir) -> Collection:
    c = table(spark, sf_dir, "customer")
    return c.with_df(
        c.df.withColumn("c_name", F.when(F.col("c_nationkey") == 3, "").otherwise(F.col("c_name")))
        .withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
        .withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    )


def counts_sql(col: str, tag: str) -> str:
    text = tag == "string"
    full = f"{col} IS NOT NULL" + (f" AND {col} <> ''" if text else "")
    size = f"CASE WHEN {col} <> '' THEN length({col}) END" if text else "NULL"
    return f"""SELECT '/{col}' AS path, count(*) AS record_count,
    CAST(count(*) - count({col}) AS BIGINT) AS null_count, count({col}) AS {tag}_count,
    CAST(count(*) - count(*) FILTER (WHERE {full}) AS BIGINT) AS null_or_empty_count,
    CAST(min({size}) AS INTEGER) AS min_length, CAST(max({size}) AS INTEGER) AS max_length FROM g"""


def counts_query_sql() -> str:
    cols = {"c_custkey": "integer", "c_name": "string", "c_acctbal": "number", "c_mktsegment": "string"}
    parts = []
    for c, tag in cols.items():
        parts.append(
            counts_sql(c, tag).replace(f"AS {tag}_count", "AS typed_count").replace(
                "SELECT ", f"SELECT '{tag}' AS type_tag, ", 1
            )
        )
    return f"WITH {CUSTOMER_GAPS}\n" + union(parts)


@query("profile_types_nulls", counts_query_sql())
def profile_types_nulls(spark, sf_dir):
    c = gapped_customer(spark, sf_dir)
    got = P.field_counts(c, ["/c_custkey", "/c_name", "/c_acctbal", "/c_mktsegment"])
    none = F.lit(0).cast("bigint")
    return got.select(
        "type_tag",
        "path",
        "record_count",
        F.coalesce(F.try_element_at("physical_types", F.lit("null")), none).alias("null_count"),
        F.coalesce(F.try_element_at("physical_types", F.col("type_tag")), none).alias("typed_count"),
        "null_or_empty_count",
        "min_length",
        "max_length",
    )


# ---------------------------------------------------------------- quantiles

NUMERIC_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey"]


def quantile_sql(tab: str, col: str) -> str:
    parts = ", ".join(
        f"l[CAST(floor((n - 1) * {p}::DOUBLE) AS BIGINT) + 1] * (1 - ((n - 1) * {p}::DOUBLE - floor((n - 1) * {p}::DOUBLE)))"
        f" + l[least(CAST(floor((n - 1) * {p}::DOUBLE) AS BIGINT) + 2, n)] * ((n - 1) * {p}::DOUBLE - floor((n - 1) * {p}::DOUBLE))"
        f" AS {name}"
        for name, p in P.QUANTILES.items()
    )
    return f"""SELECT '/{col}' AS path, n, {parts} FROM (
    SELECT list_sort(list({col}::DOUBLE)) AS l, count({col}) AS n FROM {tab})"""


@query("profile_numeric", union([quantile_sql("lineitem", c) for c in NUMERIC_COLUMNS]))
def profile_numeric(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem")
    return P.numeric_distribution(c, ["/" + n for n in NUMERIC_COLUMNS])


# ---------------------------------------------------------------- patterns and ranges

RE2 = PATTERNS  # plain enough for both engines

TEXTS_SQL = {
    "url": "SELECT url AS v FROM pages",
    "day": "SELECT strftime(o_orderdate, '%Y-%m-%d') AS v FROM orders",
    "price": "SELECT CAST(o_totalprice AS VARCHAR) AS v FROM orders",
    "custkey": "SELECT ' ' || CAST(o_custkey AS VARCHAR) || ' ' AS v FROM orders",
    "stamp": "SELECT strftime(ts, '%Y-%m-%dT%H:%M') AS v FROM events",
    "mail": "SELECT 'u' || CAST(user_id AS VARCHAR) || '@' || event_type || '.org' AS v FROM events",
    "props": "SELECT props AS v FROM events",
    "uuid": """SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-4' || substr(h, 14, 3) || '-a'
        || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS v FROM (SELECT md5(url) AS h FROM pages)""",
}


def pattern_texts(spark, sf_dir) -> list[Collection]:
    orders, events, pages = (table(spark, sf_dir, t) for t in ("orders", "events", "pages"))
    h = F.md5("url")
    uuid = F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("4"), F.substring(h, 14, 3)),
        F.concat(F.lit("a"), F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )
    return [
        pages.with_df(pages.df.select("record_index", "url", uuid.alias("uuid"))),
        orders.with_df(
            orders.df.select(
                "record_index",
                F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
                F.format_string("%.2f", "o_totalprice").alias("price"),
                F.concat(F.lit(" "), F.col("o_custkey"), F.lit(" ")).alias("custkey"),
            )
        ),
        events.with_df(
            events.df.select(
                "record_index",
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("stamp"),
                F.concat(F.lit("u"), F.col("user_id"), F.lit("@"), F.col("event_type"), F.lit(".org")).alias("mail"),
                "props",
            )
        ),
    ]


PATTERN_SQL = (
    "WITH t AS ("
    + union([f"SELECT '/{n}' AS path, v FROM ({sql})" for n, sql in TEXTS_SQL.items()])
    + ")\n"
    + union(
        [
            f"SELECT path, '{n}' AS pattern, count(*) AS n FROM t WHERE regexp_matches(trim(v), '{rx}') GROUP BY path"
            for n, rx in RE2.items()
        ]
    )
)


@query("pattern_counts", PATTERN_SQL)
def pattern_counts(spark, sf_dir):
    out = None
    for c in pattern_texts(spark, sf_dir):
        one = P.pattern_counts(P.value_table(c, ordered=False))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "temporal_range",
    "WITH t AS ("
    + union([f"SELECT '/{n}' AS path, v FROM ({sql})" for n, sql in TEXTS_SQL.items()])
    + f""") SELECT path, min(trim(v)) AS "min", max(trim(v)) AS "max" FROM t WHERE v <> '' GROUP BY path
    HAVING count(*) = count(*) FILTER (WHERE regexp_matches(trim(v), '{RE2["iso_date"]}'))
        OR count(*) = count(*) FILTER (WHERE regexp_matches(trim(v), '{RE2["iso_datetime"]}'))""",
)
def temporal_range(spark, sf_dir):
    out = None
    for c in pattern_texts(spark, sf_dir):
        one = P.temporal_range(c)
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- frequent and first values


def grouped_sql(tab: str, key: str, cols: list[str]) -> str:
    return "g AS (" + union(
        [
            f"SELECT '/{c}' AS path, CAST({c} AS VARCHAR) AS value, count(*) AS n, min({key}) AS first_index"
            f" FROM {tab} GROUP BY {c}"
            for c in cols
        ]
    ) + ")"


TOP_SQL = f"""WITH {grouped_sql("part", "p_partkey", ["p_type", "p_brand", "p_name", "p_partkey", "p_size"])},
t AS (SELECT *, sum(n) OVER (PARTITION BY path) AS total, count(*) OVER (PARTITION BY path) AS d,
    max(n) OVER (PARTITION BY path) AS top_n,
    row_number() OVER (PARTITION BY path ORDER BY n DESC, first_index) AS rk FROM g)
SELECT path, CAST(rk AS INTEGER) AS "rank", value, first_index, n AS "count", n / total AS ratio
FROM t WHERE rk <= 20 AND (d <= 50 OR top_n > 1)"""


@query("top_values", TOP_SQL)
def top_values(spark, sf_dir):
    c = table(spark, sf_dir, "part")
    paths = ["/p_type", "/p_brand", "/p_name", "/p_partkey", "/p_size"]
    vt = P.value_table(c, paths, ordered=False)
    return P.restore_long_values(c, P.top_values(vt))


SAMPLE_SQL = f"""WITH {grouped_sql("events", "event_id", ["event_type", "user_id", "props"])},
t AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY first_index) AS rk FROM g)
SELECT path, CAST(rk AS INTEGER) AS "rank", value, first_index FROM t WHERE rk <= 5"""


@query("sample_values", SAMPLE_SQL)
def sample_values(spark, sf_dir):
    c = table(spark, sf_dir, "events")
    vt = P.value_table(c, ["/event_type", "/user_id", "/props"], ordered=False)
    return P.restore_long_values(c, P.sample_values(vt))


LONG_SQL = f"""WITH {grouped_sql("documents", "doc_id", ["text"])},
t AS (SELECT *, sum(n) OVER () AS total, row_number() OVER (ORDER BY n DESC, first_index) AS rk FROM g)
SELECT path, CAST(rk AS INTEGER) AS "rank", value, first_index, n AS "count", n / total AS ratio FROM t WHERE rk <= 20"""


@query("top_texts", LONG_SQL)
def top_texts(spark, sf_dir):
    """Most repeated whole texts; long ones travel as digests and come back whole."""
    c = table(spark, sf_dir, "documents")
    return P.restore_long_values(c, P.top_values(P.value_table(c, ["/text"], ordered=False)))


@query(
    "record_repetition",
    """WITH g AS (SELECT text, lang, count(*) AS n FROM documents GROUP BY text, lang)
SELECT count(*) AS unique_record_count, CAST(sum(n - 1) AS BIGINT) AS exact_duplicate_occurrence_count,
    count(*) FILTER (WHERE n > 1) AS duplicated_record_value_count FROM g""",
)
def record_repetition(spark, sf_dir):
    c = table(spark, sf_dir, "documents")
    return P.record_repetition(c.with_df(c.df.select("record_index", "text", "lang")))


# ---------------------------------------------------------------- order in the file

ORDERED = {
    "events": ("event_id", {"event_id": "int", "ts": "other", "user_id": "int", "event_type": "text", "value": "num", "props": "text"}),
    "orders": ("o_orderkey", {"o_custkey": "int", "o_orderstatus": "text", "o_totalprice": "num", "o_orderdate": "other", "o_orderpriority": "text"}),
    "part": ("p_partkey", {"p_partkey": "int", "p_brand": "text", "p_type": "text", "p_size": "int", "p_retailprice": "num"}),
    "documents": ("doc_id", {"doc_id": "int", "lang": "text", "source": "text", "n_chars": "int"}),
}


def order_sql(tab: str, key: str, col: str, kind: str, source: str | None = None) -> str:
    """One row of order statistics for a column."""
    value = f"nullif({col}, '')" if kind == "text" else col
    cmp = "v" if kind == "text" else "v::DOUBLE" if kind in ("int", "num") else "NULL::DOUBLE"
    sfx = (
        "v::HUGEINT" if kind == "int"
        else "TRY_CAST(nullif(regexp_extract(v, '([0-9]+)$', 1), '') AS HUGEINT)" if kind == "text"
        else "NULL::HUGEINT"
    )
    inc, dec, eq = "inc / pairs", "dec / pairs", "eq / pairs"
    if kind == "other":
        inc = dec = eq = "NULL::DOUBLE"
    return f"""SELECT '{tab}' AS record_path, '/{col}' AS path, n AS non_null_count, d AS distinct_count,
    d / n AS unique_ratio, dup AS duplicate_value_count, n - d AS duplicate_occurrence_count,
    CASE WHEN d = n THEN 'unique' ELSE 'repeated' END AS cardinality_class,
    same / pairs AS adjacent_equal_ratio, CASE WHEN n > 1 THEN split END AS values_split_across_multiple_runs,
    CASE WHEN n > 1 AND dup > 0 THEN split / dup END AS repeated_values_split_ratio,
    {inc} AS increase_ratio, {dec} AS decrease_ratio, {eq} AS equal_ratio,
    sn / n AS trailing_integer_parse_ratio,
    CASE WHEN sn = n THEN s_inc / pairs END AS suffix_increase_ratio,
    CASE WHEN sn = n THEN s_dec / pairs END AS suffix_decrease_ratio,
    CASE WHEN sn = n THEN s_eq / pairs END AS suffix_equal_ratio,
    CASE WHEN sn = n THEN s_plus / pairs END AS suffix_plus_one_ratio,
    CASE WHEN sn = n THEN s_minus / pairs END AS suffix_minus_one_ratio
FROM (
  SELECT a.*, CASE WHEN a.n > 1 THEN a.n - 1 END AS pairs, b.* FROM (
    SELECT count(*) AS n, count(*) FILTER (WHERE v = pv) AS same,
      count(*) FILTER (WHERE c > pc) AS inc, count(*) FILTER (WHERE c < pc) AS dec, count(*) FILTER (WHERE c = pc) AS eq,
      count(s) AS sn, count(*) FILTER (WHERE s > ps) AS s_inc, count(*) FILTER (WHERE s < ps) AS s_dec,
      count(*) FILTER (WHERE s = ps) AS s_eq, count(*) FILTER (WHERE s - ps = 1) AS s_plus,
      count(*) FILTER (WHERE s - ps = -1) AS s_minus
    FROM (SELECT v, c, s, lag(v) OVER o AS pv, lag(c) OVER o AS pc, lag(s) OVER o AS ps
      FROM (SELECT i, v, {cmp} AS c, {sfx} AS s FROM (SELECT {key} AS i, {value} AS v FROM {source or tab}) WHERE v IS NOT NULL)
      WINDOW o AS (ORDER BY i))
  ) a, (
    SELECT count(*) AS d, count(*) FILTER (WHERE m > 1) AS dup, count(*) FILTER (WHERE runs > 1) AS split
    FROM (SELECT v, count(*) AS m, count(*) FILTER (WHERE pv IS NULL OR pv <> v) AS runs
      FROM (SELECT v, lag(v) OVER (ORDER BY i) AS pv FROM (SELECT {key} AS i, {value} AS v FROM {source or tab}) WHERE v IS NOT NULL)
      GROUP BY v)
  ) b)"""


CLASSES_SQL = """CASE WHEN duplicate_value_count = 0 THEN 'unique' WHEN repeated_values_split_ratio >= 0.8 THEN 'interleaved'
    WHEN repeated_values_split_ratio <= 0.1 THEN 'grouped' ELSE 'mixed' END AS layout_class,
  CASE WHEN increase_ratio IS NOT NULL THEN
    CASE WHEN distinct_count = 1 THEN 'constant'
      WHEN coalesce(suffix_plus_one_ratio, 0) >= 0.9 AND increase_ratio + equal_ratio >= 0.98 THEN 'sequential_ascending'
      WHEN coalesce(suffix_minus_one_ratio, 0) >= 0.9 AND decrease_ratio + equal_ratio >= 0.98 THEN 'sequential_descending'
      WHEN increase_ratio + equal_ratio >= 0.98 AND increase_ratio > 0 THEN 'monotonic_ascending'
      WHEN decrease_ratio + equal_ratio >= 0.98 AND decrease_ratio > 0 THEN 'monotonic_descending'
      ELSE 'non_monotonic' END
    WHEN suffix_increase_ratio IS NOT NULL THEN
    CASE WHEN suffix_plus_one_ratio >= 0.9 THEN 'sequential_ascending'
      WHEN suffix_minus_one_ratio >= 0.9 THEN 'sequential_descending'
      WHEN suffix_increase_ratio + suffix_equal_ratio >= 0.98 THEN 'monotonic_ascending'
      WHEN suffix_decrease_ratio + suffix_equal_ratio >= 0.98 THEN 'monotonic_descending'
      ELSE 'non_monotonic' END
    ELSE 'not_applicable' END AS sequence_class"""


def order_profile_sql(tables) -> str:
    return "o AS (" + union(
        [order_sql(t, key, c, kind) for t, (key, cols) in tables.items() for c, kind in cols.items()]
    ) + f"), r AS (SELECT *, {CLASSES_SQL} FROM o)"


def order_profiles(spark, sf_dir, tables=ORDERED):
    out = None
    for name, (_key, cols) in tables.items():
        c = table(spark, sf_dir, name)
        one = P.order_profile(P.value_table(c, ["/" + x for x in cols])).withColumn("record_path", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query("order_profile", f"WITH {order_profile_sql(ORDERED)} SELECT * FROM r")
def order_profile(spark, sf_dir):
    return order_profiles(spark, sf_dir)


@query(
    "representation_summary",
    f"""WITH {order_profile_sql({"part": ORDERED["part"]})}
SELECT kind, class, string_agg(path, ',' ORDER BY path) AS paths FROM (
  SELECT 'sequence_class' AS kind, sequence_class AS class, path FROM r UNION ALL
  SELECT 'layout_class', layout_class, path FROM r UNION ALL
  SELECT 'cardinality_class', cardinality_class, path FROM r) GROUP BY kind, class""",
)
def representation_summary(spark, sf_dir):
    c = table(spark, sf_dir, "part")
    profile = P.order_profile(P.value_table(c, ["/" + x for x in ORDERED["part"][1]]))
    return P.representation_summary(profile).withColumn("paths", F.concat_ws(",", "paths"))


LINE_ORDER = ", ".join(LINE_KEY)
LINE_NUMBERED = f"(SELECT row_number() OVER (ORDER BY {LINE_ORDER}) - 1 AS i, * FROM lineitem)"
LINE_COLS = {"l_orderkey": "int", "l_linenumber": "int", "l_returnflag": "text", "l_extendedprice": "num"}


@query(
    "order_profile_by_key",
    f"WITH o AS ({union([order_sql('lineitem', 'i', c, k, LINE_NUMBERED) for c, k in LINE_COLS.items()])}), "
    f"r AS (SELECT *, {CLASSES_SQL} FROM o) SELECT * FROM r",
)
def order_profile_by_key(spark, sf_dir):
    """Row order from a composite key instead of the file."""
    c = order.numbered(read(spark, sf_dir, "lineitem"), LINE_KEY, "lineitem")
    return P.order_profile(P.value_table(c, ["/" + x for x in LINE_COLS])).withColumn(
        "record_path", F.lit("lineitem")
    )


@query(
    "record_index",
    f"SELECT row_number() OVER (ORDER BY {LINE_ORDER}) - 1 AS record_index, {LINE_ORDER} FROM lineitem",
)
def record_index(spark, sf_dir):
    df = order.with_record_index(read(spark, sf_dir, "lineitem"), LINE_KEY)
    return df.select("record_index", *LINE_KEY)


@query(
    "stride_sample",
    """WITH f AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS pos, count(*) OVER () AS n
  FROM events WHERE event_type = 'click' AND value > 1),
k AS (SELECT unnest(range(0, 240)) AS sample_no)
SELECT sample_no, event_id, user_id, value FROM k JOIN f ON f.pos = (k.sample_no * f.n) // 240""",
)
def stride_sample(spark, sf_dir):
    c = table(spark, sf_dir, "events")
    kept = (F.col("event_type") == "click") & (F.col("value") > 1)
    got = order.stride_sample(c.df, 240, kept, c.count())
    return got.select("sample_no", "event_id", "user_id", "value")


@query("head", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 5")
def head(spark, sf_dir):
    return order.head(table(spark, sf_dir, "events").df).select("event_id", "event_type")


@query(
    "collection_profile",
    union(
        [
            f"""SELECT '{t}' AS record_path, '/{c}' AS path, count(*) AS record_count, count(DISTINCT {c}) AS distinct_count,
  {f"CAST(min(length({c})) AS INTEGER)" if k == "text" else "NULL::INTEGER"} AS min_length FROM {t}"""
            for t, cols in {
                "customer": {"c_custkey": "int", "c_name": "text", "c_nationkey": "int", "c_acctbal": "num", "c_mktsegment": "text"},
                "supplier": {"s_suppkey": "int", "s_name": "text", "s_nationkey": "int", "s_acctbal": "num"},
                "nation": {"n_nationkey": "int", "n_name": "text", "n_regionkey": "int"},
            }.items()
            for c, k in cols.items()
        ]
    ),
)
def collection_profile(spark, sf_dir):
    parts = [table(spark, sf_dir, t) for t in ("customer", "supplier", "nation")]
    got = P.profile_collections(parts)
    return got.select(
        "record_path", "path", "record_count", F.col("non_null_unique_count").alias("distinct_count"), "min_length"
    )
