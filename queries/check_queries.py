"""Declared constraints, comparisons between versions, audits and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from patina import Collection
from patina.functions import values as V
from patina.operators import audit, compare, corrupt, validate
from patina.plans import evidence as E
from patina.plans import report as R
from patina.plans import spec as S
from queries import corrupt_queries as C
from queries.base import query, read, table
from queries.profile_queries import CLASSES_SQL, order_sql, union

# ---------------------------------------------------------------- fields and rules

LINE_FIELDS = [
    {"path": "/l_quantity", "physical_type": "number", "minimum": 2, "maximum": 49},
    {"path": "/l_returnflag", "physical_type": ["string"], "allowed_values": ["A", "N"]},
    {"path": "/l_linestatus", "physical_type": "integer", "pattern": "[FO]"},
    {"path": "/l_shipdate", "physical_type": "datetime", "nullable": True},
    {"path": "/l_discount", "allowed_values": [0, 0.01, 0.02, 0.05, 0.1]},
    {"path": "/l_orderkey", "unique": True},
    {"path": "/l_comment", "nullable": True},
]


@query(
    "field_constraints",
    union(
        [
            f"SELECT '{p}' AS path, '{r}' AS rule, count(*) FILTER (WHERE {bad}) AS failed FROM lineitem"
            for p, r, bad in [
                ("/l_quantity", "null_or_empty", "l_quantity IS NULL"),
                ("/l_quantity", "type", "false"),
                ("/l_quantity", "not_numeric", "false"),
                ("/l_quantity", "minimum", "l_quantity < 2"),
                ("/l_quantity", "maximum", "l_quantity > 49"),
                ("/l_returnflag", "null_or_empty", "l_returnflag IS NULL OR l_returnflag = ''"),
                ("/l_returnflag", "type", "false"),
                ("/l_returnflag", "allowed_values", "l_returnflag NOT IN ('A', 'N')"),
                ("/l_linestatus", "null_or_empty", "l_linestatus IS NULL OR l_linestatus = ''"),
                ("/l_linestatus", "type", "true"),
                ("/l_linestatus", "pattern", "NOT regexp_full_match(l_linestatus, '[FO]')"),
                ("/l_shipdate", "type", "false"),
                ("/l_discount", "null_or_empty", "l_discount IS NULL"),
                ("/l_discount", "allowed_values", "l_discount NOT IN (0::DOUBLE, 0.01::DOUBLE, 0.02::DOUBLE, 0.05::DOUBLE, 0.1::DOUBLE)"),
                ("/l_orderkey", "null_or_empty", "l_orderkey IS NULL"),
                ("/l_comment", "missing", "true"),
            ]
        ]
        + ["SELECT '/l_orderkey', 'unique', count(*) - count(DISTINCT l_orderkey) FROM lineitem"]
    ),
)
def field_constraints(spark, sf_dir):
    return validate.field_constraints(table(spark, sf_dir, "lineitem"), LINE_FIELDS)


@query(
    "field_violations",
    """SELECT o_orderkey AS record_index, unnest(list_filter([
  CASE WHEN o_totalprice < 1500 THEN '/o_totalprice minimum' END,
  CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN '/o_orderstatus allowed_values' END,
  CASE WHEN NOT regexp_full_match(o_orderpriority, '[1-3]-[A-Z]+') THEN '/o_orderpriority pattern' END],
  lambda x: x IS NOT NULL)) AS broken FROM orders""",
)
def field_violations(spark, sf_dir):
    fields = [
        {"path": "/o_totalprice", "minimum": 1500},
        {"path": "/o_orderstatus", "allowed_values": ["F", "O"]},
        {"path": "/o_orderpriority", "pattern": "[1-3]-[A-Z]+"},
    ]
    got = validate.field_violations(table(spark, sf_dir, "orders"), fields)
    return got.select("record_index", F.concat_ws(" ", "path", "rule").alias("broken"))


def shipped(spark, sf_dir) -> Collection:
    """Line items with their order; orders are joined on their unique key."""
    lines = table(spark, sf_dir, "lineitem")
    orders = read(spark, sf_dir, "orders")
    joined = lines.df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return Collection(joined, "shipped", {"format": "parquet"})


RULES = [
    {"name": "ship after order", "kind": "comparison", "left": "/l_shipdate", "operator": ">=", "right": "/o_orderdate"},
    {"name": "tax below discount", "kind": "comparison", "left": "/l_tax", "operator": "<", "right": "/l_discount", "coerce": "number"},
    {"name": "flag is status", "kind": "comparison", "left": "/l_returnflag", "operator": "==", "right": "/l_linestatus"},
    {"name": "numbers in text", "kind": "comparison", "left": "/l_returnflag", "operator": "!=", "right": "/l_tax", "coerce": "number"},
    {"name": "key order as text", "kind": "comparison", "left": "/l_partkey", "operator": "<=", "right": "/l_suppkey"},
]


@query(
    "machine_rules",
    "WITH j AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey)\n"
    + union(
        [
            f"SELECT '{n}' AS rule, count(*) AS checked, count(*) FILTER (WHERE NOT ({t})) AS failed FROM j"
            for n, t in [
                ("ship after order", "l_shipdate >= o_orderdate"),
                ("tax below discount", "l_tax < l_discount"),
                ("flag is status", "l_returnflag = l_linestatus"),
                ("numbers in text", "TRY_CAST(l_returnflag AS DOUBLE) IS NOT NULL AND TRY_CAST(l_returnflag AS DOUBLE) <> l_tax"),
                ("key order as text", "CAST(l_partkey AS VARCHAR) <= CAST(l_suppkey AS VARCHAR)"),
            ]
        ]
    ),
)
def machine_rules(spark, sf_dir):
    return validate.machine_rules(shipped(spark, sf_dir), RULES)


# ---------------------------------------------------------------- representation

# The clean table swaps columns around so that every policy has something to say.
REP_COLS = {"a": ("int", "o_orderkey", "n - 1 - o_orderkey"), "b": ("text", "o_orderpriority", "o_orderstatus"),
            "c": ("int", "o_orderkey", "o_orderkey // 4"), "d": ("num", "o_totalprice", "o_totalprice"),
            "e": ("text", "o_orderstatus", "'x'")}
REP_POLICIES = [
    {"path": "/a"},
    {"path": "/b", "cardinality": "unique", "sequence_policy": "constant", "max_adjacent_equal_ratio": 0.3},
    {"path": "/c", "record_layout": "interleaved"},
    {"path": "/d", "sequence_policy": "preserve", "record_layout": "preserve"},
    {"path": "/e", "cardinality": "repeated", "sequence_policy": "non_sequential", "record_layout": "mixed"},
]


def _rep_sql() -> str:
    src = "(SELECT o_orderkey AS i, " + ", ".join(f"{s} AS {c}" for c, (_, s, _c) in REP_COLS.items()) + " FROM orders)"
    cln = "(SELECT o_orderkey AS i, " + ", ".join(f"{k} AS {c}" for c, (_, _s, k) in REP_COLS.items()) + (
        " FROM (SELECT *, count(*) OVER () AS n FROM orders))"
    )
    rows = [order_sql(t, "i", c, k, q) for t, q in (("s", src), ("c", cln)) for c, (k, _s, _c) in REP_COLS.items()]
    card = "s.cardinality_class, c.cardinality_class"
    seq, lay = "s.sequence_class, c.sequence_class", "s.layout_class, c.layout_class"
    tests = [
        ("/a", "cardinality_class", card, "s.cardinality_class <> c.cardinality_class"),
        ("/a", "sequence_class", seq, "s.sequence_class <> 'not_applicable' AND s.sequence_class <> c.sequence_class"),
        ("/a", "layout_class", lay, "s.layout_class NOT IN ('unique', 'not_applicable') AND s.layout_class <> c.layout_class"),
        ("/b", "must_be_unique", card, "c.duplicate_occurrence_count <> 0"),
        ("/b", "sequence_class", seq, "c.sequence_class <> 'constant'"),
        ("/b", "layout_class", lay, "s.layout_class NOT IN ('unique', 'not_applicable') AND s.layout_class <> c.layout_class"),
        ("/b", "adjacent_equal_ratio", "CAST(s.adjacent_equal_ratio AS VARCHAR), CAST(c.adjacent_equal_ratio AS VARCHAR)", "c.adjacent_equal_ratio > 0.3"),
        ("/c", "cardinality_class", card, "s.cardinality_class <> c.cardinality_class"),
        ("/c", "sequence_class", seq, "s.sequence_class <> 'not_applicable' AND s.sequence_class <> c.sequence_class"),
        ("/c", "layout_class", lay, "c.layout_class <> 'interleaved'"),
        ("/d", "cardinality_class", card, "s.cardinality_class <> c.cardinality_class"),
        ("/e", "must_repeat", card, "c.duplicate_occurrence_count = 0"),
        ("/e", "sequence_class", seq, "c.sequence_class <> 'non_monotonic'"),
        ("/e", "layout_class", lay, "c.layout_class <> 'mixed'"),
    ]
    parts = [
        f"SELECT '{p}' AS path, '{r}' AS rule, {cls.split(', ')[0]} AS source_class, {cls.split(', ')[1]} AS clean_class"
        f" FROM r s JOIN r c ON s.path = c.path AND s.record_path = 's' AND c.record_path = 'c' WHERE s.path = '{p}' AND {t}"
        for p, r, cls, t in tests
    ]
    return f"WITH o AS ({union(rows)}), r AS (SELECT *, {CLASSES_SQL} FROM o)\n" + union(parts)


@query("representation_match", _rep_sql())
def representation_match(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    n = orders.count()

    def version(which: int) -> Collection:
        cols = [
            F.expr(spec[which].replace("//", "div").replace("n - 1", f"{n}L - 1")).alias(c)
            for c, spec in REP_COLS.items()
        ]
        return orders.with_df(orders.df.select("record_index", *cols), n)

    return validate.representation_match(version(1), version(2), REP_POLICIES)


# ---------------------------------------------------------------- novelty and overlap

NOVELTY_SOURCE = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS o_orderpriority FROM orders"
NOVELTY_CLEAN = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE o_custkey + 1 END AS o_custkey, o_orderstatus,
  CASE WHEN o_orderstatus = 'O' THEN o_totalprice * (1 + 1e-13) ELSE o_totalprice + 1.5 END AS o_totalprice,
  CASE WHEN o_orderstatus = 'P' THEN o_orderdate ELSE o_orderdate + INTERVAL 1 DAY END AS o_orderdate,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN '' ELSE o_orderpriority END AS o_orderpriority FROM orders"""

NOVELTY_FLAGS = f"""f AS (SELECT
  1 AS c_cust, (s.o_custkey = c.o_custkey)::INT AS e_cust, 1 AS c_price,
  (abs(s.o_totalprice - c.o_totalprice) <= greatest(1e-12 * greatest(abs(s.o_totalprice), abs(c.o_totalprice)), 1e-12))::INT AS e_price,
  1 AS c_date, (s.o_orderdate = c.o_orderdate)::INT AS e_date,
  (s.o_orderpriority <> '' OR coalesce(c.o_orderpriority, '') <> '')::INT AS c_prio,
  (s.o_orderpriority <> '' AND s.o_orderpriority IS NOT DISTINCT FROM c.o_orderpriority)::INT AS e_prio
  FROM ({NOVELTY_SOURCE}) s JOIN ({NOVELTY_CLEAN}) c USING (o_orderkey))"""


def novelty_pair(spark, sf_dir) -> tuple[Collection, Collection]:
    orders = table(spark, sf_dir, "orders")
    source = orders.df.withColumn(
        "o_orderpriority", F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority"))
    )
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    clean = orders.df.select(
        "record_index",
        "o_orderkey",
        F.when(status == "F", F.col("o_custkey")).otherwise(F.col("o_custkey") + 1).alias("o_custkey"),
        "o_orderstatus",
        F.when(status == "O", price * (F.lit(1) + F.lit(1e-13))).otherwise(price + 1.5).alias("o_totalprice"),
        F.when(status == "P", F.col("o_orderdate")).otherwise(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("o_orderdate"),
        F.when(F.col("o_orderpriority") == "5-LOW", None)
        .when(F.col("o_orderpriority") == "1-URGENT", "")
        .otherwise(F.col("o_orderpriority"))
        .alias("o_orderpriority"),
    )
    return orders.with_df(source), orders.with_df(clean)


CONTRACT = compare.NoveltyContract(0.5, 0.8, 0.1, {"/o_orderkey": "a key", "/o_orderstatus": "a closed list"})


@query(
    "novelty",
    f"""WITH {NOVELTY_FLAGS}, r AS (SELECT c_cust + c_price + c_date + c_prio AS cells, e_cust + e_price + e_date + e_prio AS same FROM f),
a AS (SELECT CAST(sum(cells) AS BIGINT) AS comparable_value_count, CAST(sum(cells - same) AS BIGINT) AS changed_value_count,
  count(*) FILTER (WHERE cells > 0) AS evaluated_record_count, count(*) FILTER (WHERE cells > 0 AND cells = same) AS exact_aligned_record_count,
  count(*) FILTER (WHERE cells > 0 AND same / cells >= 0.8) AS high_similarity_record_count FROM r)
SELECT *, changed_value_count / comparable_value_count AS changed_value_ratio,
  high_similarity_record_count / evaluated_record_count AS high_similarity_record_ratio,
  changed_value_count / comparable_value_count >= 0.5 AND high_similarity_record_count / evaluated_record_count <= 0.1 AS passed FROM a""",
)
def novelty(spark, sf_dir):
    return compare.novelty(*novelty_pair(spark, sf_dir), CONTRACT)


@query(
    "novelty_by_field",
    f"WITH {NOVELTY_FLAGS} "
    + union(
        [
            f"SELECT '/{p}' AS path, CAST(sum(c_{k}) AS BIGINT) AS comparable, CAST(sum(c_{k} - e_{k}) AS BIGINT) AS changed,"
            f" sum(c_{k} - e_{k}) / sum(c_{k}) AS changed_ratio FROM f"
            for p, k in [("o_custkey", "cust"), ("o_totalprice", "price"), ("o_orderdate", "date"), ("o_orderpriority", "prio")]
        ]
    ),
)
def novelty_by_field(spark, sf_dir):
    return compare.novelty_by_field(*novelty_pair(spark, sf_dir), CONTRACT.exemptions)


@query(
    "row_overlap",
    """WITH s AS (SELECT DISTINCT lang, source, n_chars FROM documents), c AS (SELECT lang, source, n_chars + 1 AS n_chars FROM documents)
SELECT count(*) AS overlap_count FROM c WHERE (lang, source, n_chars) IN (SELECT (lang, source, n_chars) FROM s)""",
)
def row_overlap(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    source = docs.with_df(docs.df.select("record_index", "lang", "source", "n_chars"))
    clean = docs.with_df(docs.df.select("record_index", "lang", "source", (F.col("n_chars") + 1).alias("n_chars")))
    return compare.row_overlap(source, clean)


@query(
    "text_overlap",
    """SELECT count(*) AS overlap_count FROM (SELECT text FROM documents) WHERE text IN
  (SELECT text FROM benchmark UNION SELECT text FROM conversations)""",
)
def text_overlap(spark, sf_dir):
    """Whole document texts that also occur in another table."""
    docs = table(spark, sf_dir, "documents")
    other = read(spark, sf_dir, "benchmark").select("text").unionByName(
        read(spark, sf_dir, "conversations").select("text")
    )
    source = Collection(other.withColumn("record_index", F.lit(0).cast("bigint")))
    return compare.row_overlap(source, docs.with_df(docs.df.select("record_index", "text")))


@query(
    "identifier_overlap",
    """SELECT '/order' AS path, count(*) AS overlap_count FROM (SELECT l_orderkey FROM lineitem INTERSECT SELECT o_orderkey FROM orders)
UNION ALL SELECT '/party', count(*) FROM (SELECT l_suppkey FROM lineitem INTERSECT SELECT o_custkey FROM orders)""",
)
def identifier_overlap(spark, sf_dir):
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    source = lines.with_df(lines.df.select("record_index", F.col("l_orderkey").alias("order"), F.col("l_suppkey").alias("party")))
    clean = orders.with_df(orders.df.select("record_index", F.col("o_orderkey").alias("order"), F.col("o_custkey").alias("party")))
    return compare.identifier_overlap(source, clean, ["/order", "/party"])


@query(
    "set_equality",
    """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT DISTINCT c_custkey AS k FROM customer)
SELECT count(*) FILTER (WHERE b.k IS NULL) AS only_left, count(*) FILTER (WHERE a.k IS NULL) AS only_right,
  count(*) FILTER (WHERE b.k IS NULL OR a.k IS NULL) = 0 AS equal FROM a FULL JOIN b ON a.k = b.k""",
)
def set_equality(spark, sf_dir):
    left = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    right = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return compare.set_equality(left, right, ["k"])


@query("set_difference", "SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45")
def set_difference(spark, sf_dir):
    left = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"))
    right = read(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("k"))
    return compare.set_difference(left, right, ["k"])


@query(
    "content_equal",
    """SELECT 'same' AS pair, (SELECT count(*) FROM customer a JOIN customer b USING (c_custkey)) = (SELECT count(*) FROM customer) AS equal
UNION ALL SELECT 'upper', count(*) FILTER (WHERE c_mktsegment <> lower(c_mktsegment)) = 0 FROM customer
UNION ALL SELECT 'turned', false""",
)
def content_equal(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    lower = c.with_df(c.df.withColumn("c_mktsegment", F.lower("c_mktsegment")))
    turned = c.with_df(c.df.withColumn("record_index", F.lit(c.count() - 1) - F.col("record_index")))
    pairs = {"same": c, "upper": lower, "turned": turned}
    verdicts = [compare.content_equal(c, other).select(F.lit(name).alias("pair"), "equal") for name, other in pairs.items()]
    return verdicts[0].unionByName(verdicts[1]).unionByName(verdicts[2])


@query(
    "equalities",
    """SELECT count(*) FILTER (WHERE l_extendedprice = l_extendedprice * (1 + 1e-13)) AS exact,
  count(*) FILTER (WHERE abs(l_extendedprice - l_extendedprice * (1 + 1e-13)) <= greatest(1e-12 * greatest(abs(l_extendedprice), abs(l_extendedprice * (1 + 1e-13))), 1e-12)) AS tolerant,
  count(*) FILTER (WHERE l_quantity = l_linenumber) AS across_types,
  0::BIGINT AS across_types_by_key FROM lineitem""",
)
def equalities(spark, sf_dir):
    """One pair of columns under exact, tolerant, numeric and type-tagged equality."""
    df = read(spark, sf_dir, "lineitem")
    types = {f.name: f.dataType for f in df.schema.fields}
    price = F.col("l_extendedprice")
    near, t = price * (F.lit(1) + F.lit(1e-13)), types["l_extendedprice"]
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    by_key = V.value_key(q, types["l_quantity"]) == V.value_key(n, types["l_linenumber"])
    return df.agg(
        F.count_if(V.same(price, near, t)).alias("exact"),
        F.count_if(V.same_tolerant(price, near, t, t)).alias("tolerant"),
        F.count_if(V.same(q, n, types["l_quantity"])).alias("across_types"),
        F.count_if(by_key).alias("across_types_by_key"),
    )


# ---------------------------------------------------------------- audits

AUDIT_RULES = {
    "ship_after_order": "l_shipdate >= o_orderdate",
    "discount_range": "l_discount BETWEEN 0 AND 0.08",
    "price_per_unit": "abs(l_extendedprice / l_quantity) < 2500",
    "open_is_new": "l_linestatus <> 'O' OR l_returnflag = 'N'",
}


@query(
    "audit_rules",
    "WITH j AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey)\n"
    + union(
        [
            f"SELECT '{n}' AS rule, count(*) AS checked, count(*) FILTER (WHERE NOT ({t})) AS failed FROM j"
            for n, t in AUDIT_RULES.items()
        ]
        + ["SELECT 'n_chars', count(*), count(*) FILTER (WHERE n_chars <> length(text)) FROM documents"]
    ),
)
def audit_rules(spark, sf_dir):
    lines = audit.audit(shipped(spark, sf_dir).df, {n: F.expr(t) for n, t in AUDIT_RULES.items()})
    docs = audit.audit(read(spark, sf_dir, "documents"), {"n_chars": F.col("n_chars") == F.length("text")})
    return lines.unionByName(docs)


@query(
    "audit_failures",
    "SELECT o_orderkey AS record_index, 'price' AS rule FROM orders WHERE NOT o_totalprice BETWEEN 1500 AND 450000"
    " UNION ALL SELECT o_orderkey, 'status' FROM orders WHERE o_orderstatus = 'P'",
)
def audit_failures(spark, sf_dir):
    rules = {"price": F.col("o_totalprice").between(1500, 450000), "status": F.col("o_orderstatus") != "P"}
    return audit.failures(table(spark, sf_dir, "orders").df, rules)


@query(
    "first_failures",
    """WITH f AS (SELECT o_orderkey AS record_index, 'price' AS rule FROM orders WHERE NOT o_totalprice BETWEEN 1500 AND 450000
  UNION ALL SELECT o_orderkey, 'status' FROM orders WHERE o_orderstatus = 'P')
SELECT record_index, rule, CAST(rk AS INTEGER) AS "rank" FROM (
  SELECT *, row_number() OVER (PARTITION BY rule ORDER BY record_index) AS rk FROM f) WHERE rk <= 25""",
)
def first_failures(spark, sf_dir):
    return audit.first_failures(audit_failures(spark, sf_dir))


@query(
    "numeric_evidence",
    union(
        [
            f"SELECT '/{c}' AS path, '{side}' AS side, min({e}) AS \"min\", max({e}) AS \"max\","
            f" round(CAST(sum(CAST({e} AS DECIMAL(28,6))) AS DOUBLE) / count(*), 3) AS mean FROM orders"
            for side in ("source", "clean")
            for c, e in (
                ("o_totalprice", "o_totalprice" if side == "source" else "(o_totalprice + 1.5)"),
                ("o_custkey", "CAST(o_custkey AS DOUBLE)" if side == "source" else "CAST(o_custkey + 1 AS DOUBLE)"),
            )
        ]
    ),
)
def numeric_evidence(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    clean = orders.df.withColumn("o_totalprice", F.col("o_totalprice") + 1.5).withColumn("o_custkey", F.col("o_custkey") + 1)
    return audit.numeric_evidence(orders, orders.with_df(clean), ["/o_totalprice", "/o_custkey"])


@query(
    "grand_totals",
    """SELECT 'source' AS side, CAST(sum(CAST(l_extendedprice AS DECIMAL(28,4))) AS DOUBLE) AS total FROM lineitem
UNION ALL SELECT 'clean', CAST(sum(CAST(l_extendedprice * 2 AS DECIMAL(28,4))) AS DOUBLE) FROM lineitem""",
)
def grand_totals(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    double = lines.with_df(lines.df.withColumn("l_extendedprice", F.col("l_extendedprice") * 2))
    return audit.grand_totals(lines, double, F.col("l_extendedprice"))


@query(
    "residual_range",
    """SELECT CAST(min(r) AS DOUBLE) AS min_residual, CAST(max(r) AS DOUBLE) AS max_residual FROM (SELECT
  CAST(o_totalprice AS DECIMAL(18,2)) - coalesce(s, 0) AS r FROM orders LEFT JOIN
  (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)""",
)
def residual_range(spark, sf_dir):
    parts = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("s")
    )
    rows = read(spark, sf_dir, "orders").join(parts, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    gap = F.col("o_totalprice").cast("decimal(18,2)") - F.coalesce(F.col("s"), F.lit(0))
    return audit.residual_range(rows, gap.cast("double"))


@query(
    "composite_key",
    "SELECT count(*) AS key_count FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)",
)
def composite_key(spark, sf_dir):
    return audit.composite_key_count(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "eligibility_filter",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1997-05-01' AND o_orderdate < TIMESTAMP '1997-06-01'
  AND o_totalprice > 0 AND o_totalprice < 400000 AND o_custkey <> 0""",
)
def eligibility_filter(spark, sf_dir):
    """Month and range filters in a form the Parquet scan can apply."""
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("1997-05-01", "1997-06-01"))
    day, price = F.col("o_orderdate"), F.col("o_totalprice")
    kept = (day >= start) & (day < end) & (price > 0) & (price < 400000) & (F.col("o_custkey") != 0)
    return read(spark, sf_dir, "orders").where(kept).select("o_orderkey", "o_totalprice")


# ---------------------------------------------------------------- report


@query(
    "check_report",
    f"""WITH {C.PLAN_CTE},
changed AS (SELECT c.o_orderkey FROM orders c JOIN dirty d USING (o_orderkey) WHERE (c.o_orderpriority, c.o_orderstatus, c.o_totalprice)
  IS DISTINCT FROM (d.o_orderpriority, d.o_orderstatus, d.o_totalprice))
SELECT 'exact_dirty_record_count' AS name, CASE WHEN (SELECT count(*) FROM changed) =
    (SELECT CAST(floor(count(*) * {C.RATE}) AS BIGINT) FROM orders) THEN 'passed' ELSE 'failed' END AS status, 'error' AS severity
UNION ALL SELECT 'declared_clean_field_constraints', CASE WHEN count(*) FILTER (WHERE o_totalprice < 0 OR o_orderstatus = '') = 0
    THEN 'passed' ELSE 'failed' END, 'error' FROM orders
UNION ALL SELECT 'dirty_field_constraints', CASE WHEN count(*) FILTER (WHERE o_totalprice < 0 OR o_orderstatus = '') = 0
    THEN 'passed' ELSE 'warning' END, 'warning' FROM dirty
UNION ALL SELECT 'declared_clean_machine_rules', CASE WHEN count(*) FILTER (WHERE o_custkey > o_orderkey) = 0
    THEN 'passed' ELSE 'failed' END, 'error' FROM orders
UNION ALL SELECT 'source_row_overlap_policy', CASE WHEN count(*) = 0 THEN 'passed' ELSE 'failed' END, 'error'
  FROM (SELECT * FROM orders INTERSECT SELECT * FROM dirty)""",
)
def check_report(spark, sf_dir):
    """Named checks over the corrupted orders, as one report table."""
    orders, plan, _, dirty = C.orders_dirty(spark, sf_dir)
    fields = [{"path": "/o_totalprice", "minimum": 0}, {"path": "/o_orderstatus", "nullable": False}]
    rule = {"name": "keys", "kind": "comparison", "left": "/o_custkey", "operator": "<=", "right": "/o_orderkey", "coerce": "number"}
    report = R.Report(spark)
    keys = validate.dirty_keys([orders], {"orders": dirty})
    counted = keys.agg(F.count(F.lit(1)).alias("actual")).withColumn("expected", F.lit(plan.target_count))
    report.add("exact_dirty_record_count", counted, F.col("actual") == F.col("expected"))
    report.add_none("declared_clean_field_constraints", validate.field_constraints(orders, fields), F.col("failed"))
    worse = validate.field_constraints(dirty, fields).agg(F.sum("failed").alias("violations"))
    report.add("dirty_field_constraints", worse, F.col("violations") == 0, "warning")
    report.add_none("declared_clean_machine_rules", validate.machine_rules(orders, [rule]), F.col("failed"))
    report.add("source_row_overlap_policy", compare.row_overlap(orders, dirty), F.col("overlap_count") == 0)
    return report.checks().drop("evidence")


def order_spec(n: int) -> dict:
    """A version-4 specification for the orders table."""
    return {
        "version": 4,
        "source": {
            "physical_format": "parquet",
            "collections": [
                {"record_path": "orders", "record_count": n, "role": "orders", "handling": "generate"},
                {"record_path": "nation", "record_count": 25, "role": "legend", "handling": "preserve_reference", "reason": "A closed list."},
                {"record_path": "region", "record_count": 6, "role": "legend", "handling": "preserve_reference", "reason": "A closed list."},
            ],
        },
        "generation": {
            "record_count": n,
            "random_seed": C.SEED,
            "source_model": {
                "dimensions": [
                    {
                        "name": "orders", "scope": "dataset", "paths": [], "evidence": "Whole table.", "constraint_kind": "hard",
                        "generation_strategy": ["recombine_conditionally"], "generation_rule": "Shift values, keep keys.",
                    }
                ]
            },
            "collections": [
                {
                    "record_path": "orders", "record_count": n,
                    "primary_identifiers": ["/o_orderkey"], "protected_fields": C.PROTECTED["orders"],
                    "fields": [
                        {"path": "/o_orderkey", "physical_type": "integer", "unique": True},
                        {"path": "/o_totalprice", "physical_type": "number", "minimum": 0},
                    ],
                    "machine_rules": [],
                    "representation": {
                        "generation_mode": "direct",
                        "record_order": {"policy": "match_source", "generation_guidance": "Keep key order."},
                        "field_profiles": [{"path": "/o_orderkey", "direct_generation_guidance": "Keep keys."}],
                    },
                    "novelty": {
                        "minimum_changed_value_ratio": 0.5, "high_similarity_threshold": 0.9,
                        "maximum_high_similarity_record_ratio": 0.5,
                        "exemptions": [{"path": "/o_orderkey", "reason": "a key"}, {"path": "/o_orderstatus", "reason": "a closed list"}, {"path": "/o_orderpriority", "reason": "a closed list"}],
                    },
                }
            ],
        },
        "dirty_policy": {
            "unit": "record", "max_rate": 0.05, "selected_rate": float(C.RATE), "rationale": "A moderate share.",
            "error_types": [
                {"name": e.name, "weight": e.weight, "eligible_fields": list(e.eligible_fields), "constraint_violated": e.constraint_violated}
                for e in C.ORDER_ERRORS
            ],
        },
        "quality": {"source_row_overlap_policy": "reject", "source_identifier_overlap_policy": "allow"},
    }


def shifted_orders(orders: Collection) -> Collection:
    """An earlier version of orders, of which the table itself is the clean one."""
    return orders.with_df(
        orders.df.withColumn("o_custkey", F.col("o_custkey") + 1)
        .withColumn("o_totalprice", F.col("o_totalprice") + 10)
        .withColumn("o_orderdate", F.col("o_orderdate") - F.expr("INTERVAL 3 DAYS"))
    )


def checked_world(spark, sf_dir) -> tuple:
    """Source, clean and dirty tables with a manifest and a header that is wrong about one digest.

    Nation is preserved, region comes out in another order and with another count than declared.
    """
    orders, plan, dirty, manifest = C.orders_manifest(spark, sf_dir)
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    turned = region.with_df(region.df.withColumn("record_index", F.lit(region.count() - 1) - F.col("record_index")))
    header = corrupt.manifest_header(manifest, [orders], [dirty])
    header["dirty_digest"] = {"orders": "0"}
    kept = {"nation": nation, "region": region}
    return (
        {"orders": shifted_orders(orders), **kept},
        {"orders": orders, **kept},
        {"orders": dirty, "nation": nation, "region": turned},
        order_spec(orders.count()),
        manifest,
        header,
    )


def report_sql() -> str:
    """Every check of the report decided again from the tables; what only the spec decides is plain."""
    n = "(SELECT count(*) FROM orders)"
    checks = {
        "all_collections_declared": "true",
        "collection_paths_preserved": "true",
        "physical_format_preserved": "true",
        "declared_physical_format": "true",
        **{
            f"{name}:{t}": test
            for t in ("orders", "nation", "region")
            for name, test in {
                "structure_preserved": "true",
                "source_clean_field_names_preserved": "true",
                "clean_dirty_field_names_preserved": f"(SELECT count(*) FROM {'dirty' if t == 'orders' else t}) = (SELECT count(*) FROM {t})",
                "source_record_count": f"(SELECT count(*) FROM {t}) = {n if t == 'orders' else {'nation': 25, 'region': 6}[t]}",
            }.items()
        },
        "generated_record_count:orders": f"(SELECT count(*) FROM dirty) = {n}",
        "generated_record_count_total": f"(SELECT count(*) FROM dirty) = {n}",
        "declared_source_model": "true",
        "declared_clean_field_constraints:orders": f"(SELECT count(*) FILTER (WHERE o_totalprice < 0 OR o_totalprice IS NULL) = 0"
        f" AND count(DISTINCT o_orderkey) = {n} FROM orders)",
        "declared_clean_machine_rules:orders": "true",
        "representation_profile_declared:orders": "true",
        "direct_representation_generation_declared:orders": "true",
        "declared_representation_constraints:orders": f"(SELECT count(DISTINCT e.o_orderkey) = {n} FROM earlier e JOIN orders USING (o_orderkey))",
        "substantive_content_novelty:orders": "(SELECT avg(changed) >= 0.5 AND avg(CAST(changed <= 0.1 AS INT)) <= 0.5 FROM moved)",
        "explicit_preservation:nation": "(SELECT count(*) = 0 FROM (SELECT * FROM nation EXCEPT SELECT * FROM nation))",
        "explicit_preservation:region": "(SELECT count(*) = 1 FROM region)",
        "dirty_rate_policy": f"{C.RATE} <= 0.05",
        "exact_dirty_record_count": f"(SELECT count(*) FROM changed) = CAST(floor({n} * {C.RATE}) AS BIGINT)",
        "manifest_dirty_records": "(SELECT count(*) FILTER (WHERE p.record_index IS NULL OR c.o_orderkey IS NULL) = 0"
        " FROM changed c FULL JOIN plan p ON c.o_orderkey = p.record_index)",
        "dirty_collection_coverage": "(SELECT count(*) > 0 FROM changed)",
        "contextual_error_types": "(SELECT count(*) FILTER (WHERE error_type NOT IN ('missing_value', 'range_violation', 'text_noise')) = 0 FROM plan)",
        "manifest_change_evidence": "(SELECT count(*) FILTER (WHERE c.o_orderkey IS NULL OR suggested_field IN ('/o_orderkey', '/o_custkey')) = 0"
        " FROM plan LEFT JOIN changed c ON c.o_orderkey = record_index)",
        "manifest_summary_counts": "(SELECT count(*) FROM plan) = (SELECT sum(fields) FROM changed)",
        "manifest_rate": f"abs((SELECT count(*) FROM plan) / {n} - (SELECT count(*) FROM changed) / {n}) <= 1e-9",
        "manifest_hashes:clean:orders": "true",
        "manifest_hashes:dirty:orders": "(SELECT count(*) = 0 FROM dirty)",
        "source_row_overlap_policy": "(SELECT count(*) = 0 FROM (SELECT * FROM earlier INTERSECT SELECT * FROM orders))",
        "source_identifier_overlap_policy": "true",
    }
    rows = union([f"SELECT '{name}' AS name, {test} AS ok" for name, test in checks.items()])
    return f"""WITH {C.PLAN_CTE},
earlier AS (SELECT * REPLACE (o_custkey + 1 AS o_custkey, o_totalprice + 10 AS o_totalprice, o_orderdate - INTERVAL 3 DAY AS o_orderdate) FROM orders),
moved AS (SELECT ((e.o_custkey <> o.o_custkey)::INT + (e.o_totalprice <> o.o_totalprice)::INT + (e.o_orderdate <> o.o_orderdate)::INT) / 3 AS changed
  FROM earlier e JOIN orders o USING (o_orderkey)),
changed AS (SELECT o_orderkey, (o.o_orderpriority <> d.o_orderpriority)::INT + (o.o_orderstatus <> d.o_orderstatus)::INT
  + (o.o_totalprice <> d.o_totalprice)::INT AS fields FROM orders o JOIN dirty d USING (o_orderkey) WHERE fields > 0)
SELECT name, CASE WHEN ok THEN 'passed' ELSE 'failed' END AS status, 'error' AS severity FROM ({rows})"""


EVIDENCE_RULES = {
    "price": "o_totalprice BETWEEN 1500 AND 450000",
    "status": "o_orderstatus <> 'P'",
    "key": "o_orderkey >= 0",
}
UNBROKEN = "o_totalprice >= 0 AND o_orderstatus <> '' AND o_orderpriority <> '' AND o_orderpriority NOT LIKE '% '"


def evidence_sql() -> str:
    def row(section: str, name: str, figure: str, value: str, table: str = "orders", examples: str = "''") -> str:
        return f"SELECT '{section}' AS section, '{name}' AS name, '{figure}' AS figure, CAST({value} AS DOUBLE) AS value, {examples} AS examples FROM {table}"

    rows = []
    for name, test in EVIDENCE_RULES.items():
        first = f"(SELECT coalesce(string_agg(k, ',' ORDER BY k), '') FROM (SELECT o_orderkey AS k FROM orders WHERE NOT ({test}) ORDER BY k LIMIT 25))"
        rows += [row("clean_rules", name, "checked", "count(*)", examples=first)]
        rows += [row("clean_rules", name, "failed", f"count(*) FILTER (WHERE NOT ({test}))", examples=first)]
    for side, table in (("source", "earlier"), ("clean", "orders")):
        mean = "round(CAST(sum(CAST(o_totalprice AS DECIMAL(28,6))) AS DOUBLE) / count(*), 3)"
        for figure, value in (("min", "min(o_totalprice)"), ("max", "max(o_totalprice)"), ("mean", mean)):
            rows.append(row("numeric", f"/o_totalprice {side}", figure, value, table))
    rows += [
        row("patches", "efficacy", "patches", "count(*)", "plan"),
        row("patches", "efficacy", "passed", f"count(*) FILTER (WHERE NOT ({UNBROKEN}))", "(SELECT d.* FROM plan JOIN dirty d ON d.o_orderkey = record_index)"),
        row("untargeted", "records", "compared", "(SELECT count(*) FROM orders) - count(*)", "plan"),
        row("untargeted", "records", "changed", "count(*) FILTER (WHERE p.record_index IS NULL)", "changed LEFT JOIN plan p ON p.record_index = changed.o_orderkey"),
        row("novelty", "aligned records", "changed_value_ratio", "avg(changed)", "moved"),
        row("novelty", "aligned records", "high_similarity_record_ratio", "avg(CAST(changed <= 0.1 AS INT))", "moved"),
        row("overlap", "rows", "overlap_count", "count(*)", "(SELECT * FROM earlier INTERSECT SELECT * FROM orders)"),
        row("validation", "checks", "errors", "count(*) FILTER (WHERE status = 'failed')", "report"),
        row("validation", "checks", "warnings", "count(*) FILTER (WHERE status = 'warning')", "report"),
    ]
    ctes, last = report_sql().rsplit("\nSELECT name, CASE WHEN ok", 1)
    return f"{ctes},\nreport AS (SELECT name, CASE WHEN ok{last})\n" + union(rows)


@query("evidence_report", evidence_sql())
def evidence_report(spark, sf_dir):
    """All evidence about the corrupted orders and the earlier version that they come from."""
    world = checked_world(spark, sf_dir)
    source, clean, dirty, spec, manifest, _ = world
    contract = S.novelty_contract(spec["generation"]["collections"][0]["novelty"])
    rules = {name: F.expr(test) for name, test in EVIDENCE_RULES.items()}
    report = E.evidence_report(
        source["orders"], clean["orders"], dirty["orders"], manifest, rules, ["/o_totalprice"], F.expr(UNBROKEN), contract,
        R.validate_collections(*world),
    )
    return report.withColumn("examples", F.array_join("examples", ","))


@query("validation_report", report_sql())
def validation_report(spark, sf_dir):
    """The whole report, header and preserved tables included."""
    return R.validate_collections(*checked_world(spark, sf_dir)).drop("evidence")
