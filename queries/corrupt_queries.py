"""Corruption: plans, patches, manifests, and what they change."""

from __future__ import annotations

from pyspark.sql import functions as F

from patina.operators import audit, cells, compare, corrupt, validate
from patina.operators.stage import stage
from patina.functions import values as V
from queries.base import query, table

SEED = 4105
RATE = "0.02"
SPAN = 16**12

ORDER_ERRORS = [
    corrupt.ErrorType("missing_value", 1.0, ("/o_orderstatus", "/o_orderpriority"), None, "A required value is blank."),
    corrupt.ErrorType("range_violation", 2.0, ("/o_totalprice",), None, "A price is not negative."),
    corrupt.ErrorType("text_noise", 1.0, ("/o_orderpriority", "/o_orderkey"), None, "Text has no stray blanks."),
]
PROTECTED = {"orders": ["/o_orderkey", "/o_custkey"]}
EXPLANATIONS = {
    "missing_value": "The value was blanked.",
    "range_violation": "The sign was flipped.",
    "text_noise": "Blanks were added.",
}


def recipes():
    return {
        "missing_value": F.lit(""),
        "range_violation": -F.col("o_totalprice"),
        "text_noise": F.concat(F.col("o_orderpriority"), F.lit("  ")),
    }


def orders_plan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    plan = corrupt.corruption_plan([orders], ORDER_ERRORS, RATE, SEED, PROTECTED)
    return orders, plan


def orders_patches(spark, sf_dir):
    orders, plan = orders_plan(spark, sf_dir)
    return orders, plan, corrupt.derive_patches(plan, orders, recipes(), EXPLANATIONS)


def orders_dirty(spark, sf_dir):
    orders, plan, patches = orders_patches(spark, sf_dir)
    fields = plan.fields("orders")
    return orders, plan, patches, corrupt.apply_patches(orders, patches, fields, plan.maybe)


def orders_manifest(spark, sf_dir):
    """Plan, dirty table and manifest; the manifest is staged, as several jobs read it."""
    orders, plan, patches, dirty = orders_dirty(spark, sf_dir)
    manifest = corrupt.build_manifest(orders, patches, plan.fields("orders"), plan.maybe)
    return orders, plan, dirty, stage(manifest)


def hexdraw(tag: str, path: str = "'orders'", i: str = "i") -> str:
    return f"('0x' || substr(md5('{SEED}:{tag}:' || {path} || ':' || {i}), 1, 12))::BIGINT"


PLAN_CTE = f"""keyed AS (SELECT o_orderkey AS i, md5('{SEED}:select:orders:' || o_orderkey) AS h, * FROM orders),
ranked AS (SELECT *, row_number() OVER (ORDER BY h, i) AS rk, CAST(floor(count(*) OVER () * {RATE}) AS BIGINT) AS k FROM keyed),
typed AS (SELECT *, {hexdraw("type")} / {SPAN}.0::DOUBLE * 4.0::DOUBLE AS mark, {hexdraw("field")} AS fd
  FROM ranked WHERE rk <= k),
plan AS (SELECT 'dirty-' || lpad(CAST(row_number() OVER (ORDER BY i) AS VARCHAR), 6, '0') AS patch_id,
  'orders' AS record_path, i AS record_index, i AS global_record_index,
  CASE WHEN mark <= 1 THEN 'missing_value' WHEN mark <= 3 THEN 'range_violation' ELSE 'text_noise' END AS error_type,
  CASE WHEN mark <= 1 THEN CASE WHEN fd % 2 = 0 THEN '/o_orderstatus' ELSE '/o_orderpriority' END
    WHEN mark <= 3 THEN '/o_totalprice' ELSE '/o_orderpriority' END AS suggested_field,
  CASE WHEN mark <= 1 THEN '/o_orderstatus,/o_orderpriority' WHEN mark <= 3 THEN '/o_totalprice'
    ELSE '/o_orderpriority' END AS eligible_fields,
  CASE WHEN mark <= 1 THEN 'A required value is blank.' WHEN mark <= 3 THEN 'A price is not negative.'
    ELSE 'Text has no stray blanks.' END AS constraint_violated, o_orderstatus, o_totalprice, o_orderpriority
  FROM typed),
dirty AS (SELECT o.o_orderkey, o.o_custkey,
  CASE WHEN p.error_type = 'missing_value' AND p.suggested_field = '/o_orderstatus' THEN '' ELSE o.o_orderstatus END AS o_orderstatus,
  CASE WHEN p.error_type = 'range_violation' THEN -o.o_totalprice ELSE o.o_totalprice END AS o_totalprice, o.o_orderdate,
  CASE WHEN p.error_type = 'missing_value' AND p.suggested_field = '/o_orderpriority' THEN ''
    WHEN p.error_type = 'text_noise' THEN o.o_orderpriority || '  ' ELSE o.o_orderpriority END AS o_orderpriority
  FROM orders o LEFT JOIN plan p ON o.o_orderkey = p.record_index)"""


@query(
    "corruption_plan",
    f"""WITH {PLAN_CTE} SELECT patch_id, record_path, record_index, global_record_index, error_type, suggested_field,
eligible_fields, constraint_violated FROM plan""",
)
def corruption_plan(spark, sf_dir):
    _, plan = orders_plan(spark, sf_dir)
    return plan.targets.withColumn("eligible_fields", F.concat_ws(",", "eligible_fields"))


@query(
    "plan_header",
    f"""WITH {PLAN_CTE} SELECT (SELECT count(*) FROM orders) AS record_count,
  CAST(floor((SELECT count(*) FROM orders) * {RATE}) AS BIGINT) AS target_count,
  count(*) AS planned, count(DISTINCT record_index) AS distinct_records,
  min(patch_id) AS first_id, max(patch_id) AS last_id FROM plan""",
)
def plan_header(spark, sf_dir):
    _, plan = orders_plan(spark, sf_dir)
    return plan.targets.agg(
        F.lit(plan.record_count).cast("bigint").alias("record_count"),
        F.lit(plan.target_count).cast("bigint").alias("target_count"),
        F.count(F.lit(1)).alias("planned"),
        F.countDistinct("record_index").alias("distinct_records"),
        F.min("patch_id").alias("first_id"),
        F.max("patch_id").alias("last_id"),
    )


# ---------------------------------------------------------------- several collections

COVERED = {"nation": "n_nationkey", "supplier": "s_suppkey", "part": "p_partkey", "customer": "c_custkey"}
COVER_ERRORS = [
    corrupt.ErrorType("text_noise", 1.0, ("/n_name", "/s_name", "/p_name", "/c_name")),
    corrupt.ErrorType("range_violation", 3.0, ("/s_acctbal", "/p_retailprice", "/p_size", "/c_acctbal"), ("supplier", "part", "customer")),
    corrupt.ErrorType("referential_inconsistency", 1.5, ("/s_nationkey", "/c_nationkey"), ("supplier", "customer")),
]
COVER_PROTECTED = {"part": ["/p_size"], "customer": ["/c_nationkey"]}


def cover_plan(spark, sf_dir):
    parts = [table(spark, sf_dir, t) for t in COVERED]
    return parts, corrupt.corruption_plan(
        parts, COVER_ERRORS, RATE, SEED, COVER_PROTECTED, "all_eligible_when_feasible"
    )


# What each collection may get: (error, cumulative weight, fields).
ALLOWED = {
    "nation": [("text_noise", 1.0, ["/n_name"])],
    "supplier": [
        ("text_noise", 1.0, ["/s_name"]),
        ("range_violation", 4.0, ["/s_acctbal"]),
        ("referential_inconsistency", 5.5, ["/s_nationkey"]),
    ],
    "part": [("text_noise", 1.0, ["/p_name"]), ("range_violation", 4.0, ["/p_retailprice"])],
    "customer": [("text_noise", 1.0, ["/c_name"]), ("range_violation", 4.0, ["/c_acctbal"])],
}


def cover_cte() -> str:
    keys, offset = [], "0"
    for t, k in COVERED.items():
        keys.append(f"SELECT '{t}' AS p, {k} AS i, {k} + {offset} AS g FROM {t}")
        offset += f" + (SELECT count(*) FROM {t})"
    pick = {"type": [], "field": []}
    for p, errors in ALLOWED.items():
        for name, upto, fields in errors:
            pick["type"].append(f"WHEN p = '{p}' AND mark * {errors[-1][1]}::DOUBLE <= {upto} THEN '{name}'")
            pick["field"].append(f"WHEN p = '{p}' AND mark * {errors[-1][1]}::DOUBLE <= {upto} THEN '{fields[0]}'")
    return f"""keys AS ({" UNION ALL ".join(keys)}),
total AS (SELECT CAST(floor(count(*) * {RATE}) AS BIGINT) AS k FROM keys),
first AS (SELECT p, i, g FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY md5('{SEED}:reserve:' || p || ':' || i), i) AS rn
  FROM keys) WHERE rn = 1),
rest AS (SELECT p, i, g, row_number() OVER (ORDER BY md5('{SEED}:select:' || p || ':' || i), p, i) AS rn
  FROM keys WHERE (p, i) NOT IN (SELECT (p, i) FROM first)),
chosen AS (SELECT p, i, g FROM first UNION ALL SELECT p, i, g FROM rest WHERE rn <= (SELECT k FROM total) - (SELECT count(*) FROM first)),
marked AS (SELECT *, {hexdraw("type", "p")} / {SPAN}.0::DOUBLE AS mark FROM chosen),
plan AS (SELECT 'dirty-' || lpad(CAST(row_number() OVER (ORDER BY g) AS VARCHAR), 6, '0') AS patch_id, p AS record_path,
  i AS record_index, g AS global_record_index, CASE {" ".join(pick["type"])} END AS error_type,
  CASE {" ".join(pick["field"])} END AS suggested_field FROM marked)"""


@query("coverage_plan", f"WITH {cover_cte()} SELECT * FROM plan")
def coverage_plan(spark, sf_dir):
    _, plan = cover_plan(spark, sf_dir)
    return plan.targets.drop("eligible_fields", "constraint_violated")


@query(
    "error_type_counts",
    f"WITH {cover_cte()} SELECT error_type, count(*) AS \"count\" FROM plan GROUP BY error_type",
)
def error_type_counts(spark, sf_dir):
    return audit.error_type_counts(cover_plan(spark, sf_dir)[1].targets)


@query(
    "dirty_coverage",
    f"""WITH {cover_cte()} SELECT count(DISTINCT record_path) AS covered, 4::BIGINT AS eligible,
  count(DISTINCT record_path) AS covered_eligible, count(DISTINCT record_path) = 4 AS passed FROM plan""",
)
def dirty_coverage(spark, sf_dir):
    parts, plan = cover_plan(spark, sf_dir)
    eligible = validate.eligible_collections(parts, COVER_ERRORS, COVER_PROTECTED)
    return validate.dirty_coverage(plan.targets, eligible, plan.target_count, plan.coverage_mode)


# ---------------------------------------------------------------- applying

def date_text():
    return F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")



@query(
    "apply_patches",
    f"""WITH {PLAN_CTE} SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM dirty""",
)
def apply_patches(spark, sf_dir):
    *_, dirty = orders_dirty(spark, sf_dir)
    return dirty.df.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", date_text(), "o_orderpriority"
    )


MANIFEST_CTE = """manifest AS (SELECT patch_id, record_path, record_index, error_type,
  CASE error_type WHEN 'missing_value' THEN 'The value was blanked.' WHEN 'range_violation' THEN 'The sign was flipped.'
    ELSE 'Blanks were added.' END AS explanation, suggested_field AS path,
  CASE suggested_field WHEN '/o_orderstatus' THEN o_orderstatus WHEN '/o_orderpriority' THEN o_orderpriority END AS clean_text,
  CASE suggested_field WHEN '/o_totalprice' THEN o_totalprice END AS clean_number,
  CASE error_type WHEN 'missing_value' THEN '' WHEN 'text_noise' THEN o_orderpriority || '  ' END AS dirty_text,
  CASE suggested_field WHEN '/o_totalprice' THEN -o_totalprice END AS dirty_number FROM plan)"""


@query("manifest", f"WITH {PLAN_CTE}, {MANIFEST_CTE} SELECT * FROM manifest")
def manifest(spark, sf_dir):
    orders, plan, patches = orders_patches(spark, sf_dir)
    made = corrupt.build_manifest(orders, patches, plan.fields("orders"), plan.maybe)
    rows = made.select("*", F.explode("changes").alias("c")).select("*", "c.*").drop("changes", "c")
    price = F.col("path") == "/o_totalprice"

    def split(value: str, side: str):
        return [
            F.when(~price, F.col(value)).alias(f"{side}_text"),
            F.when(price, F.col(value)).cast("double").alias(f"{side}_number"),
        ]

    return rows.select(
        "patch_id", "record_path", "record_index", "error_type", "explanation", "path",
        *split("clean_value", "clean"), *split("dirty_value", "dirty"),
    )


@query(
    "patch_violations",
    f"""WITH {PLAN_CTE} SELECT patch_id, 'missing_patch' AS rule FROM plan WHERE record_index % 7 = 0
UNION ALL SELECT patch_id, 'changed_record_index' FROM plan WHERE record_index % 7 = 1
UNION ALL SELECT patch_id, 'empty_explanation' FROM plan WHERE record_index % 7 = 2
UNION ALL SELECT patch_id || 'x', 'unknown_patch' FROM plan WHERE record_index % 7 = 3
UNION ALL SELECT patch_id, 'missing_patch' FROM plan WHERE record_index % 7 = 3
UNION ALL SELECT patch_id, unnest(['protected_path', 'ineligible_path']) FROM plan WHERE record_index % 7 = 4
UNION ALL SELECT patch_id, 'no_change' FROM plan WHERE record_index % 7 = 5
UNION ALL SELECT patch_id, 'duplicate_patch' FROM plan WHERE record_index % 7 = 6""",
)
def patch_violations(spark, sf_dir):
    """Every patch damaged in one of seven ways, by its record."""
    orders, plan, patches = orders_patches(spark, sf_dir)
    way = F.col("record_index") % 7
    before = F.create_map(
        F.lit("/o_orderstatus"), F.col("o_orderstatus"),
        F.lit("/o_orderpriority"), F.col("o_orderpriority"),
        F.lit("/o_totalprice"), F.col("o_totalprice").cast("string"),
    )
    clean = orders.df.select(F.col("record_index").alias("__i"), before.alias("__before"))
    # A small shift that stays inside the table, so only the index is wrong.
    moved = F.when(F.col("record_index") > 0, F.col("record_index") - 1).otherwise(F.col("record_index") + 1)
    damaged = (
        patches.where(way != 0)
        .join(clean, F.col("record_index") == F.col("__i"))
        .withColumn("__way", way)
        .withColumn("explanation", F.when(F.col("__way") == 2, " ").otherwise(F.col("explanation")))
        .withColumn("patch_id", F.when(F.col("__way") == 3, F.concat("patch_id", F.lit("x"))).otherwise(F.col("patch_id")))
        .withColumn(
            "changes",
            F.transform(
                "changes",
                lambda c: F.when(F.col("__way") == 4, F.struct(F.lit("/o_custkey").alias("path"), F.lit("-1").alias("value")))
                .when(F.col("__way") == 5, F.struct(c.path.alias("path"), F.try_element_at("__before", c.path).alias("value")))
                # A moved patch must still change its new record.
                .when(F.col("__way") == 1, F.struct(c.path.alias("path"), F.when(c.path == "/o_totalprice", "-0.5").otherwise("?").alias("value")))
                .otherwise(c),
            ),
        )
        .withColumn("record_index", F.when(F.col("__way") == 1, moved).otherwise(F.col("record_index")))
    )
    twice = damaged.where(F.col("__way") == 6)
    every = damaged.unionByName(twice).select(*patches.columns)
    return corrupt.patch_violations(plan, every, [orders])


# ---------------------------------------------------------------- what changed


@query(
    "detect_changes",
    f"""WITH {PLAN_CTE} SELECT c.o_orderkey AS record_index, concat_ws(',',
  CASE WHEN c.o_orderpriority IS DISTINCT FROM d.o_orderpriority THEN '/o_orderpriority' END,
  CASE WHEN c.o_orderstatus IS DISTINCT FROM d.o_orderstatus THEN '/o_orderstatus' END,
  CASE WHEN c.o_totalprice IS DISTINCT FROM d.o_totalprice THEN '/o_totalprice' END) AS paths
FROM orders c JOIN dirty d USING (o_orderkey)
WHERE c.o_orderpriority IS DISTINCT FROM d.o_orderpriority OR c.o_orderstatus IS DISTINCT FROM d.o_orderstatus
  OR c.o_totalprice IS DISTINCT FROM d.o_totalprice""",
)
def detect_changes(spark, sf_dir):
    orders, _, _, dirty = orders_dirty(spark, sf_dir)
    return cells.changed_paths(orders, dirty).withColumn("paths", F.concat_ws(",", "paths"))


@query(
    "dirty_record_count",
    f"""WITH {PLAN_CTE} SELECT CAST(floor((SELECT count(*) FROM orders) * {RATE}) AS BIGINT) AS expected, count(*) AS actual
FROM orders c JOIN dirty d USING (o_orderkey) WHERE (c.o_orderpriority, c.o_orderstatus, c.o_totalprice)
  IS DISTINCT FROM (d.o_orderpriority, d.o_orderstatus, d.o_totalprice)""",
)
def dirty_record_count(spark, sf_dir):
    orders, plan, _, dirty = orders_dirty(spark, sf_dir)
    keys = validate.dirty_keys([orders], {"orders": dirty})
    return keys.agg(
        F.lit(plan.target_count).cast("bigint").alias("expected"), F.count(F.lit(1)).alias("actual")
    )


@query(
    "manifest_keys",
    f"""WITH {PLAN_CTE}, m AS (SELECT record_index FROM plan WHERE record_index % 5 <> 0 UNION ALL
  SELECT record_index FROM plan WHERE record_index % 5 = 1 UNION ALL
  SELECT o_orderkey FROM orders WHERE o_orderkey % 1000 = 0 AND o_orderkey NOT IN (SELECT record_index FROM plan)),
k AS (SELECT record_index, count(*) AS n FROM m GROUP BY record_index)
SELECT count(*) FILTER (WHERE k.n > 1) AS repeated, count(*) FILTER (WHERE p.record_index IS NULL) AS not_dirty,
  count(*) FILTER (WHERE k.record_index IS NULL) AS not_listed, false AS passed
FROM k FULL JOIN plan p ON k.record_index = p.record_index""",
)
def manifest_keys(spark, sf_dir):
    """A manifest that lists some records twice, some clean ones, and leaves some out."""
    orders, _, dirty, manifest = orders_manifest(spark, sf_dir)
    listed = manifest.select("record_path", "record_index")
    fifth = F.col("record_index") % 5
    others = (
        orders.df.where(F.col("record_index") % 1000 == 0)
        .join(listed, "record_index", "left_anti")
        .select(F.lit("orders").alias("record_path"), "record_index")
    )
    bent = listed.where(fifth != 0).unionByName(listed.where(fifth == 1)).unionByName(others)
    return validate.manifest_keys(bent, validate.dirty_keys([orders], {"orders": dirty}))


@query(
    "manifest_evidence",
    f"""WITH {PLAN_CTE} SELECT record_index, suggested_field AS path, 'clean_value' AS rule FROM plan WHERE record_index % 4 = 0
UNION ALL SELECT record_index, suggested_field, 'dirty_value' FROM plan WHERE record_index % 4 = 1
UNION ALL SELECT record_index, '', 'changed_paths' FROM plan WHERE record_index % 4 = 2
UNION ALL SELECT record_index, '/o_orderkey', 'protected_path' FROM plan WHERE record_index % 4 = 2""",
)
def manifest_evidence(spark, sf_dir):
    """A manifest tampered with in three ways, by its record."""
    orders, _, dirty, manifest = orders_manifest(spark, sf_dir)
    way = F.col("record_index") % 4
    key = F.col("record_index").cast("string")
    bent = manifest.withColumn(
        "changes",
        F.transform(
            "changes",
            lambda c: F.when(way == 0, c.withField("clean_value", F.lit("?")))
            .when(way == 1, c.withField("dirty_value", F.lit("?")))
            .otherwise(c),
        ),
    ).withColumn(
        "changes",
        F.when(
            way == 2,
            F.concat(
                "changes",
                F.array(F.struct(F.lit("/o_orderkey").alias("path"), key.alias("clean_value"), key.alias("dirty_value"))),
            ),
        ).otherwise(F.col("changes")),
    )
    return validate.manifest_evidence(bent, orders, dirty, PROTECTED["orders"])


@query(
    "dirty_summary",
    f"""WITH {PLAN_CTE} SELECT count(*) AS dirty_record_count, count(*) AS dirty_cell_count,
  count(*) / (SELECT count(*) FROM orders) AS actual_dirty_record_rate FROM plan""",
)
def dirty_summary(spark, sf_dir):
    orders, plan, patches = orders_patches(spark, sf_dir)
    return audit.dirty_summary(
        corrupt.build_manifest(orders, patches, plan.fields("orders"), plan.maybe), orders.count()
    )


@query(
    "untargeted_unchanged",
    f"""WITH {PLAN_CTE} SELECT count(*) AS untargeted_count, 0::BIGINT AS changed_count, true AS unchanged
FROM orders WHERE o_orderkey NOT IN (SELECT record_index FROM plan)""",
)
def untargeted_unchanged(spark, sf_dir):
    orders, plan, _, dirty = orders_dirty(spark, sf_dir)
    return compare.untargeted_unchanged(orders, dirty, plan.targets)


@query(
    "patch_efficacy",
    f"""WITH {PLAN_CTE} SELECT patch_id, record_index, NOT (d.o_totalprice >= 0 AND d.o_orderstatus <> ''
  AND d.o_orderpriority <> '' AND d.o_orderpriority = rtrim(d.o_orderpriority)) AS passed
FROM plan JOIN dirty d ON d.o_orderkey = plan.record_index""",
)
def patch_efficacy(spark, sf_dir):
    _, plan, _, dirty = orders_dirty(spark, sf_dir)
    holds = (
        (F.col("o_totalprice") >= 0)
        & (F.col("o_orderstatus") != "")
        & (F.col("o_orderpriority") != "")
        & (F.col("o_orderpriority") == V.trimmed(F.col("o_orderpriority")))
    )
    return audit.patch_efficacy(dirty, plan.targets, holds)


@query(
    "expected_before",
    f"""WITH {PLAN_CTE} SELECT patch_id, record_index, suggested_field AS path FROM plan
WHERE suggested_field <> '/o_totalprice' AND record_index % 3 = 0""",
)
def expected_before(spark, sf_dir):
    """Reviewed clean values that no longer hold stop a patch; here every third is stale."""
    orders, _, _, manifest = orders_manifest(spark, sf_dir)
    stale = (F.col("record_index") % 3 == 0) & (F.col("path") != "/o_totalprice")
    reviewed = manifest.select("patch_id", "record_index", F.explode("changes").alias("c")).select(
        "patch_id", "record_index", "c.path", "c.clean_value"
    )
    reviewed = reviewed.withColumn("clean_value", F.when(stale, "?").otherwise(F.col("clean_value")))
    return corrupt.stale_reviews(reviewed, orders)


@query(
    "table_digest",
    """SELECT count(*) AS record_count, CAST(sum(('0x' || substr(sha256(n_nationkey || ':' || sha256('{"n_name":"' || n_name || '","n_nationkey":'
  || n_nationkey || ',"n_regionkey":' || n_regionkey || '}')), 1, 15))::BIGINT::HUGEINT) AS VARCHAR) AS digest FROM nation""",
)
def table_digest(spark, sf_dir):
    return corrupt.table_digest(table(spark, sf_dir, "nation"))


