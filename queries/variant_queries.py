"""VARIANT records whose keys may be missing: profile, constraints, plan, patches and manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patina import Collection
from patina.operators import cells, corrupt, validate
from patina.operators import profile as P
from queries.base import query, table
from queries.corrupt_queries import RATE, SEED, SPAN

# The same text in both engines: null, empty and missing values, and types that differ by record.
RECORD_SQL = """CASE event_id % 6
  WHEN 0 THEN '{"kind":"' || event_type || '","n":' || user_id || ',"geo":{"cell":' || (event_id % 9) || '}}'
  WHEN 1 THEN '{"kind":"","n":null}'
  WHEN 2 THEN '{"n":"' || user_id || '","geo":null}'
  WHEN 3 THEN '{"kind":null,"geo":{"cell":"c' || (event_id % 4) || '","on":true}}'
  WHEN 4 THEN '{"kind":"' || event_type || '","geo":{}}'
  ELSE '{}' END"""

CELLS_CTE = """cells AS (
  SELECT '/kind' AS path, event_id AS i, CASE WHEN event_id % 6 = 3 THEN 'null' ELSE 'string' END AS tag,
    CASE event_id % 6 WHEN 1 THEN '' WHEN 3 THEN NULL ELSE event_type END AS text FROM events WHERE event_id % 6 IN (0, 1, 3, 4)
  UNION ALL SELECT '/n', event_id, CASE event_id % 6 WHEN 0 THEN 'integer' WHEN 1 THEN 'null' ELSE 'string' END,
    CASE WHEN event_id % 6 <> 1 THEN CAST(user_id AS VARCHAR) END FROM events WHERE event_id % 6 < 3
  UNION ALL SELECT '/geo', event_id, CASE WHEN event_id % 6 = 2 THEN 'null' ELSE 'object' END,
    CASE event_id % 6 WHEN 0 THEN 'cell' || event_id % 9 WHEN 3 THEN 'c' || event_id % 4 WHEN 4 THEN 'no keys' END
    FROM events WHERE event_id % 6 IN (0, 2, 3, 4)
  UNION ALL SELECT '/geo/cell', event_id, CASE WHEN event_id % 6 = 0 THEN 'integer' ELSE 'string' END,
    CASE WHEN event_id % 6 = 0 THEN CAST(event_id % 9 AS VARCHAR) ELSE 'c' || event_id % 4 END FROM events WHERE event_id % 6 IN (0, 3)
  UNION ALL SELECT '/geo/on', event_id, 'boolean', 'true' FROM events WHERE event_id % 6 = 3)"""


def records(spark, sf_dir) -> Collection:
    events = table(spark, sf_dir, "events")
    made = events.df.select("record_index", F.parse_json(F.expr(RECORD_SQL)).alias("record"))
    return Collection(made, "events", {"format": "json"}, events.count())


@query(
    "variant_profile",
    f"""WITH {CELLS_CTE},
filled AS (SELECT *, tag || ':' || text AS k, lag(tag || ':' || text) OVER (PARTITION BY path ORDER BY i) AS before
  FROM cells WHERE tag <> 'null' AND NOT (tag = 'string' AND text = '')),
shape AS (SELECT path, count(*) AS present_count, count(DISTINCT k) AS non_null_unique_count,
  CASE WHEN count(*) > 1 THEN count(*) FILTER (WHERE k = before) / (count(*) - 1) END AS adjacent_equal_ratio,
  min(length(text)) FILTER (WHERE tag = 'string') AS min_length, max(length(text)) FILTER (WHERE tag = 'string') AS max_length
  FROM filled GROUP BY path),
types AS (SELECT path, string_agg(tag || '=' || n, ',' ORDER BY tag) AS types, CAST(sum(n) AS BIGINT) AS seen FROM
  (SELECT path, tag, count(*) AS n FROM cells GROUP BY path, tag) GROUP BY path)
SELECT path, types, (SELECT count(*) FROM events) AS record_count, (SELECT count(*) FROM events) - seen AS missing_key_count,
  seen - present_count AS null_or_empty_count, present_count, non_null_unique_count, adjacent_equal_ratio,
  CAST(min_length AS INTEGER) AS min_length, CAST(max_length AS INTEGER) AS max_length FROM shape JOIN types USING (path)""",
)
def variant_profile(spark, sf_dir) -> DataFrame:
    got = P.profile_fields(records(spark, sf_dir))
    types = F.transform(F.map_entries("physical_types"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return got.select(
        "path",
        F.array_join(F.array_sort(types), ",").alias("types"),
        "record_count",
        "missing_key_count",
        "null_or_empty_count",
        "present_count",
        "non_null_unique_count",
        F.col("representation.adjacent_equal_ratio").alias("adjacent_equal_ratio"),
        "min_length",
        "max_length",
    )


FIELDS = [
    {"path": "/kind", "physical_type": "string", "allowed_values": ["click", "view"]},
    {"path": "/n", "physical_type": "integer", "nullable": True, "minimum": 10, "maximum": 60, "unique": True},
    {"path": "/geo/cell", "physical_type": ["integer", "string"], "pattern": "[0-6]|c[01]"},
    {"path": "/geo", "nullable": True, "physical_type": "object"},
]


def _field_sql() -> str:
    def rule(path: str, name: str, bad: str, absent: bool = False) -> str:
        counted = "(SELECT count(*) FROM events) - count(*)" if absent else f"count(*) FILTER (WHERE {bad})"
        return f"SELECT '{path}' AS path, '{name}' AS rule, {counted} AS failed FROM cells WHERE path = '{path}'"

    full, gap = "tag <> 'null' AND NOT (tag = 'string' AND text = '')", "tag = 'null' OR (tag = 'string' AND text = '')"
    parts = [rule(f["path"], "missing", "", absent=True) for f in FIELDS]
    parts += [rule(p, "null_or_empty", gap) for p in ("/kind", "/geo/cell")]
    parts += [
        rule("/kind", "type", "false"),
        rule("/n", "type", f"{full} AND tag <> 'integer'"),
        rule("/geo/cell", "type", "false"),
        rule("/geo", "type", "false"),
        rule("/kind", "allowed_values", f"{full} AND text NOT IN ('click', 'view')"),
        rule("/geo/cell", "pattern", f"{full} AND NOT regexp_full_match(text, '[0-6]|c[01]')"),
        rule("/n", "not_numeric", "false"),
        rule("/n", "minimum", f"{full} AND CAST(text AS DOUBLE) < 10"),
        rule("/n", "maximum", f"{full} AND CAST(text AS DOUBLE) > 60"),
        f"SELECT '/n', 'unique', count(*) - count(DISTINCT tag || ':' || text) FROM cells WHERE path = '/n' AND {full}",
    ]
    # CASE keeps the number tests off the texts of other paths.
    return f"WITH {CELLS_CTE}\n" + "\nUNION ALL ".join(parts).replace("CAST(text AS DOUBLE)", "TRY_CAST(text AS DOUBLE)")


@query("variant_constraints", _field_sql())
def variant_constraints(spark, sf_dir) -> DataFrame:
    return validate.field_constraints(records(spark, sf_dir), FIELDS)


ERRORS = [
    corrupt.ErrorType("missing_value", 1.0, ("/kind", "/n"), None, "A value is given."),
    corrupt.ErrorType("format_violation", 2.0, ("/geo/cell", "/nowhere"), ("events",), "A cell is a scalar."),
    corrupt.ErrorType("text_noise", 4.0, ("/geo/on",), None, "Protected, so never chosen."),
]
RECIPES = {
    "missing_value": lambda old: F.parse_json(F.lit('"(blank)"')),
    "format_violation": lambda old: F.parse_json(F.concat(F.lit("["), F.to_json(old), F.lit("]"))),
    "text_noise": lambda old: old,
}


def _draw(tag: str) -> str:
    return f"('0x' || substr(md5('{SEED}:{tag}:events:' || i), 1, 12))::BIGINT"


PLANNED_CTE = f"""keyed AS (SELECT event_id AS i, event_id % 6 AS m, md5('{SEED}:select:events:' || event_id) AS h, * FROM events),
ranked AS (SELECT *, row_number() OVER (ORDER BY h, i) AS rk FROM keyed WHERE m <> 5),
typed AS (SELECT *, {_draw("field")} AS fd, m IN (0, 3) AND {_draw("type")} / {SPAN}.0::DOUBLE * 3.0::DOUBLE > 1 AS format
  FROM ranked WHERE rk <= (SELECT CAST(floor(count(*) * {RATE}) AS BIGINT) FROM events)),
planned AS (SELECT *, CASE WHEN format THEN '/geo/cell' WHEN m IN (0, 1) THEN CASE WHEN fd % 2 = 0 THEN '/kind' ELSE '/n' END
  WHEN m = 2 THEN '/n' ELSE '/kind' END AS path FROM typed),
old AS (SELECT *, CASE WHEN path = '/geo/cell' THEN CASE m WHEN 0 THEN CAST(i % 9 AS VARCHAR) ELSE '"c' || i % 4 || '"' END
  WHEN path = '/n' THEN CASE m WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN 'null' ELSE '"' || user_id || '"' END
  ELSE CASE m WHEN 1 THEN '""' WHEN 3 THEN 'null' ELSE '"' || event_type || '"' END END AS clean_value,
  'dirty-' || lpad(CAST(row_number() OVER (ORDER BY i) AS VARCHAR), 6, '0') AS patch_id FROM planned)"""


def planned(spark, sf_dir) -> tuple:
    clean = records(spark, sf_dir)
    plan = corrupt.corruption_plan([clean], ERRORS, RATE, SEED, {"events": ["/geo/on"]})
    return clean, plan, corrupt.derive_patches(plan, clean, RECIPES, {})


@query(
    "variant_corruption",
    f"""WITH {PLANNED_CTE}
SELECT patch_id, i AS record_index,
  CASE WHEN format THEN 'format_violation' ELSE 'missing_value' END AS error_type, path, clean_value,
  CASE WHEN format THEN '[' || clean_value || ']' ELSE '"(blank)"' END AS dirty_value, path AS changed FROM old""",
)
def variant_corruption(spark, sf_dir) -> DataFrame:
    """Plan, patch and manifest of records that have different keys, beside what a comparison of the tables finds."""
    clean, plan, patches = planned(spark, sf_dir)
    fields = plan.fields("events")
    dirty = corrupt.apply_patches(clean, patches, fields, plan.maybe)
    manifest = corrupt.build_manifest(clean, patches, fields, plan.maybe)
    found = cells.variant_changed_paths(clean, dirty).select("record_index", F.concat_ws(",", "paths").alias("changed"))
    change = F.get("changes", F.lit(0))
    return manifest.join(found, "record_index", "full_outer").select(
        "patch_id",
        "record_index",
        "error_type",
        change["path"].alias("path"),
        change["clean_value"].alias("clean_value"),
        change["dirty_value"].alias("dirty_value"),
        "changed",
    )


@query(
    "variant_violations",
    f"""WITH {PLANNED_CTE}
SELECT patch_id, CASE i % 4 WHEN 1 THEN 'renamed_nested_field' WHEN 2 THEN 'value_type' ELSE 'no_change' END AS rule FROM old WHERE i % 4 <> 0
UNION ALL SELECT patch_id, 'ineligible_path' FROM old WHERE i % 4 = 0 AND path <> '/geo/cell'
UNION ALL SELECT patch_id, 'unknown_path' FROM old WHERE i % 4 = 0 AND path <> '/geo/cell' AND m NOT IN (0, 3)
UNION ALL SELECT NULL, 'stale_plan'""",
)
def variant_violations(spark, sf_dir) -> DataFrame:
    """Patches that add keys, aren't JSON, change nothing or go to a place the record lacks, for a table that has changed."""
    clean, plan, patches = planned(spark, sf_dir)
    plan.digests = {"events": "of an earlier table"}
    way = F.col("record_index") % 4
    before = corrupt.build_manifest(clean, patches, plan.fields("events"), plan.maybe).select(
        "patch_id", F.get("changes", F.lit(0))["clean_value"].alias("__old")
    )

    def bent(change):
        value = (
            F.when(way == 1, '{"new key":1}').when(way == 2, "{not JSON").when(way == 3, F.col("__old")).otherwise(change["value"])
        )
        return F.struct(F.when(way == 0, "/geo/cell").otherwise(change["path"]).alias("path"), value.alias("value"))

    changed = patches.join(before, "patch_id").withColumn("changes", F.transform("changes", bent)).drop("__old")
    return corrupt.patch_violations(plan, changed, [clean])
