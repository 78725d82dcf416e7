"""Collections in containers, cells, headers, catalogues and file checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from patina import Collection
from patina.functions import pointers as ptr
from patina.functions import values as V
from patina.operators import catalog, cells, headers
from patina.operators.stage import shared_folder
from patina.sources import collections as C
from patina.sources import readers, writers
from queries.base import query, read, table
from queries.profile_queries import union

# ---------------------------------------------------------------- containers


def container(spark, sf_dir):
    """Documents as nested records: an array of line objects, and one of long-word objects.

    Arrays are built inside each row, so nothing is gathered across rows.
    """
    lines = F.transform(F.split("text", "\n", -1), lambda x, k: F.struct(k.alias("no"), x.alias("line")))
    words = F.filter(F.split("text", " ", -1), lambda w: F.length(w) > 9)
    long = F.transform(words, lambda w: F.struct(F.length(w).alias("chars")))
    return read(spark, sf_dir, "documents").select(
        "doc_id", lines.alias("lines"), F.struct(F.col("lang"), long.alias("long")).alias("extra")
    )


LINES_SQL = """l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
  unnest(range(0, len(string_split(text, chr(10))))) AS k FROM documents)"""


@query(
    "collections",
    f"""WITH {LINES_SQL} SELECT '/lines' AS record_path, count(*) AS record_count FROM l
UNION ALL SELECT '/extra/long', CAST(sum(len(list_filter(string_split(text, ' '), lambda w: length(w) > 9))) AS BIGINT) FROM documents""",
)
def collections(spark, sf_dir):
    return C.discover_collections(container(spark, sf_dir))


@query(
    "select_collection",
    f"""WITH {LINES_SQL} SELECT row_number() OVER (ORDER BY doc_id, k) - 1 AS record_index, CAST(k AS INTEGER) AS no, line FROM l""",
)
def select_collection(spark, sf_dir):
    """One collection of every document, numbered document after document."""
    docs = container(spark, sf_dir).withColumn("record_index", F.col("doc_id"))
    return C.select_collection(docs, "/lines").df


@query(
    "largest_collection",
    """WITH n AS (SELECT sum(len(list_filter(string_split(text, ' '), lambda w: length(w) > 9))) AS long,
  sum(len(string_split(text, chr(10)))) AS lines FROM documents)
SELECT CASE WHEN long > lines THEN '/extra/long' ELSE '/lines' END AS record_path, CAST(greatest(long, lines) AS BIGINT) AS records FROM n""",
)
def largest_collection(spark, sf_dir):
    """Without a path, the collection with most records is selected."""
    got = C.select_collection(container(spark, sf_dir).withColumn("record_index", F.col("doc_id")))
    return got.df.agg(F.lit(got.record_path).alias("record_path"), F.count(F.lit(1)).alias("records"))


# ---------------------------------------------------------------- text files


@query(
    "csv_records",
    """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS record_index, CAST(doc_id AS VARCHAR) AS doc_id, coalesce(lang, '') AS lang,
  CAST(length(coalesce(text, '')) AS INTEGER) AS chars, sha256(coalesce(text, '')) AS text_sha256 FROM documents""",
)
def csv_records(spark, sf_dir):
    """Whole documents, line breaks in their cells, written as CSV files and read back in file order."""
    path = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    names = ["doc_id", "text", "lang"]
    writers.write_delimited(Collection(docs.df.select(*names, "record_index"), "", {"columns": names}), path)
    back = readers.read_delimited(spark, path).df
    return back.select(
        "record_index", "doc_id", "lang", F.length("text").alias("chars"), F.sha2("text", 256).alias("text_sha256")
    )


@query(
    "tsv_records",
    """SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS record_index, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
  o_orderstatus, o_orderpriority FROM orders""",
)
def tsv_records(spark, sf_dir):
    """A TSV folder without a unique key named: rows are numbered by files and splits."""
    path = shared_folder(spark)
    orders = table(spark, sf_dir, "orders")
    names = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    writers.write_delimited(Collection(orders.df.select(*names, "record_index"), "", {"columns": names}), path, "\t")
    return readers.read_delimited(spark, path, sep="\t").df


@query(
    "jsonl_records",
    """SELECT row_number() OVER (ORDER BY event_id) - 1 AS record_index, event_id % 5 <> 3 AS has_a,
  CASE event_id % 5 WHEN 0 THEN 'BIGINT' WHEN 1 THEN 'DECIMAL' WHEN 2 THEN 'VOID' WHEN 4 THEN 'OBJECT' END AS type_of_a,
  CASE event_id % 5 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN user_id || '.5' WHEN 2 THEN 'null'
    WHEN 4 THEN '{"b":"' || event_type || '","c":[1]}' END AS a FROM events""",
)
def jsonl_records(spark, sf_dir):
    """Records of differing types and absent keys, written as JSON Lines and read back in file order."""
    path = shared_folder(spark)
    base = table(spark, sf_dir, "events").df.select("record_index", F.parse_json(F.expr(MIXED_SQL)).alias("record"))
    writers.write_jsonl(Collection(base), path)
    at = F.variant_get("record", "$.a", "variant")
    back = readers.read_jsonl(spark, path, variant=True).df
    kind = F.regexp_extract(F.schema_of_variant(at), "^[A-Z]+", 0)
    return back.select(
        "record_index", at.isNotNull().alias("has_a"), kind.alias("type_of_a"), F.to_json(at).alias("a")
    )


# ---------------------------------------------------------------- cells


@query(
    "leaf_cells",
    """SELECT event_id AS record_index, '/k' AS path, 'integer' AS physical_type, json_extract_string(props, '$.k') AS value_str,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value_num FROM events""",
)
def leaf_cells(spark, sf_dir):
    """Cells of JSON text parsed as VARIANT, found level by level."""
    events = table(spark, sf_dir, "events")
    c = Collection(events.df.select("record_index", F.parse_json("props").alias("record")))
    return cells.variant_cells(c).drop("record_path", "value_key")


MIXED_SQL = """CASE WHEN event_id % 5 = 0 THEN '{"a":' || user_id || '}' WHEN event_id % 5 = 1 THEN '{"a":' || user_id || '.5}'
  WHEN event_id % 5 = 2 THEN '{"a":null}' WHEN event_id % 5 = 3 THEN '{}' ELSE '{"a":{"b":"' || event_type || '","c":[1]}}' END"""


@query(
    "variant_types",
    """SELECT path, physical_type, count(*) AS n FROM (
  SELECT '/a' AS path, CASE event_id % 5 WHEN 0 THEN 'integer' WHEN 1 THEN 'number' ELSE 'null' END AS physical_type FROM events WHERE event_id % 5 < 3
  UNION ALL SELECT '/a/b', 'string' FROM events WHERE event_id % 5 = 4
  UNION ALL SELECT '/a/c', 'array' FROM events WHERE event_id % 5 = 4) GROUP BY path, physical_type""",
)
def variant_types(spark, sf_dir):
    """Types per path where they differ by record and keys may be missing."""
    c = Collection(
        table(spark, sf_dir, "events").df.select("record_index", F.parse_json(F.expr(MIXED_SQL)).alias("record"))
    )
    return cells.variant_cells(c).groupBy("path", "physical_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "variant_changes",
    """SELECT event_id AS record_index, CASE event_id % 5 WHEN 4 THEN '/a,/a/b,/a/c' ELSE '/a' END AS paths FROM events
  WHERE event_id % 5 IN (1, 3, 4)""",
)
def variant_changes(spark, sf_dir):
    """Changed paths where a value, a type or the presence of a key differs."""
    base = table(spark, sf_dir, "events").df
    before = base.select("record_index", F.parse_json(F.expr(MIXED_SQL)).alias("record"))
    other = """CASE WHEN event_id % 5 = 0 THEN '{"a":' || user_id || '.0}' WHEN event_id % 5 = 1 THEN '{"a":' || user_id || '.25}'
      ELSE '{"a":null}' END"""
    after = base.select("record_index", F.parse_json(F.expr(other)).alias("record"))
    got = cells.variant_changed_paths(Collection(before), Collection(after))
    return got.withColumn("paths", F.concat_ws(",", "paths"))


@query(
    "to_cells",
    union(
        [
            f"SELECT c_custkey AS record_index, '/{c}' AS path, '{t}' AS physical_type, {n} AS value_num FROM customer"
            for c, t, n in [
                ("c_custkey", "integer", "c_custkey::DOUBLE"),
                ("c_name", "string", "NULL::DOUBLE"),
                ("c_nationkey", "integer", "c_nationkey::DOUBLE"),
                ("c_acctbal", "number", "c_acctbal"),
                ("c_mktsegment", "string", "NULL::DOUBLE"),
            ]
        ]
    ),
)
def to_cells(spark, sf_dir):
    return cells.to_cells(table(spark, sf_dir, "customer")).drop("record_path", "value_key", "value_str")


@query(
    "set_path",
    """SELECT doc_id, 'first: ' || string_split(text, chr(10))[1] AS first_line, CAST(len(string_split(text, chr(10))) AS BIGINT) AS lines FROM documents""",
)
def set_path(spark, sf_dir):
    """Edit one slot of a nested array and read it back by pointer."""
    df = container(spark, sf_dir)
    edited = ptr.edit_path(df, "/lines/0/line", lambda old: F.concat(F.lit("first: "), old))
    got = ptr.get_path(edited.schema, "/lines/0/line")
    return edited.select("doc_id", got.alias("first_line"), F.size("lines").cast("bigint").alias("lines"))


# ---------------------------------------------------------------- headers


@query(
    "header_rows",
    """WITH lines AS (SELECT doc_id AS file, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS row_no FROM documents),
cells AS (SELECT file, row_no, unnest(string_split(line, ' ')) AS cell FROM lines WHERE row_no <= 50),
rows_ AS (SELECT file, row_no, count(*) AS dense, count(*) FILTER (WHERE NOT regexp_full_match(cell, '[0-9.]+')) AS texts,
  count(*) FILTER (WHERE NOT regexp_full_match(cell, '[0-9.]+') AND trim(cell, ' ' || chr(9) || chr(13)) <> '') AS names,
  count(DISTINCT lower(trim(cell, ' ' || chr(9) || chr(13)))) FILTER (WHERE NOT regexp_full_match(cell, '[0-9.]+') AND trim(cell, ' ' || chr(9) || chr(13)) <> '') AS uniq
  FROM cells WHERE cell <> '' GROUP BY file, row_no),
f AS (SELECT file, min(row_no) AS first_row, arg_min(dense, row_no) AS first_dense FROM rows_ GROUP BY file),
b AS (SELECT file, row_no, dense FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY dense DESC, row_no) AS rk
  FROM rows_ WHERE texts / dense >= 0.9 AND names = uniq) WHERE rk = 1)
SELECT f.file, CAST(CASE WHEN b.row_no = first_row OR b.dense >= greatest(2, first_dense * 2) THEN b.row_no ELSE first_row END AS INTEGER) AS header_row
FROM f LEFT JOIN b USING (file)""",
)
def header_rows(spark, sf_dir):
    """Every document read as a grid: lines are rows, words are cells."""
    lines = read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file"), F.posexplode(F.slice(F.split("text", "\n", headers.SCANNED_ROWS + 1), 1, headers.SCANNED_ROWS)).alias("pos", "line")
    )
    words = F.split("line", " ", -1)
    grid = lines.select(
        "file",
        (F.col("pos") + 1).alias("row_no"),
        words.alias("cells"),
        F.transform(words, lambda w: ~w.rlike(r"\A[0-9.]+\z")).alias("is_text"),
    )
    return headers.detect_header_rows(grid)


# ---------------------------------------------------------------- catalogue

CATALOG_SQL = """c AS (SELECT 'p' || page_id AS id, regexp_extract(url, '//([^/]+)', 1) AS site, url AS title,
  CASE WHEN url LIKE '%?page%' THEN 'paged' ELSE 'plain' END AS period, sha256(html) AS sha256, length(html) AS bytes,
  'f' || page_id || '.html' AS filename FROM pages)"""


def page_catalog(spark, sf_dir):
    """Pages as catalogue entries."""
    return read(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), "page_id").alias("id"),
        F.regexp_extract("url", "//([^/]+)", 1).alias("site"),
        F.col("url").alias("title"),
        F.when(F.col("url").contains("?page"), "paged").otherwise("plain").alias("period"),
        F.sha2("html", 256).alias("sha256"),
        F.length("html").cast("bigint").alias("bytes"),
        F.concat(F.lit("f"), F.col("page_id"), F.lit(".html")).alias("filename"),
    )


@query(
    "catalog_search",
    f"""WITH {CATALOG_SQL} SELECT id, site, title FROM c WHERE period = 'paged' AND contains(lower(title), 'the')
ORDER BY id LIMIT 10""",
)
def catalog_search(spark, sf_dir):
    found = catalog.catalog_filter(page_catalog(spark, sf_dir), period="paged", site="")
    return catalog.listing(found.where(catalog.name_search("title", "THE ")), 10).select("id", "site", "title")


@query(
    "catalog_begins",
    f"WITH {CATALOG_SQL} SELECT id, title FROM c WHERE starts_with(lower(title), 'http://th') ORDER BY id LIMIT 25",
)
def catalog_begins(spark, sf_dir):
    found = page_catalog(spark, sf_dir).where(catalog.name_search("title", "HTTP://th", "begins"))
    return catalog.listing(found, 999).select("id", "title")


@query(
    "keyword_search",
    f"WITH {CATALOG_SQL} SELECT id FROM c WHERE contains(lower(title || ' ' || period || ' web archive'), 'plain web')",
)
def keyword_search(spark, sf_dir):
    hit = catalog.keyword_search(["title", "period"], "web archive", "Plain WEB")
    return page_catalog(spark, sf_dir).where(hit).select("id")


@query(
    "catalog_lookup",
    f"WITH {CATALOG_SQL} SELECT id, title FROM c WHERE id = 'p7' AND site = (SELECT site FROM c WHERE id = 'p7')",
)
def catalog_lookup(spark, sf_dir):
    entries = page_catalog(spark, sf_dir)
    site = entries.where(F.col("id") == "p7").head()["site"]
    hit = catalog.catalog_lookup(entries, site, "p7")
    miss = catalog.catalog_lookup(entries, site + "x", "p7")
    return hit.unionByName(miss).select("id", "title")


@query(
    "known_files",
    f"WITH {CATALOG_SQL} SELECT doc_id, 'f' || doc_id || '.html' AS filename FROM documents WHERE 'f' || doc_id || '.html' IN (SELECT filename FROM c)",
)
def known_files(spark, sf_dir):
    asked = read(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("f"), F.col("doc_id"), F.lit(".html")).alias("filename")
    )
    return catalog.known_files(asked, page_catalog(spark, sf_dir)).select("doc_id", "filename")


ACTUAL_SQL = """a AS (SELECT 'f' || page_id || '.html' AS filename, length(x) AS bytes, sha256(x) AS sha256 FROM (
  SELECT page_id, CASE WHEN page_id % 5 = 1 THEN html || ' ' WHEN page_id % 5 = 2 THEN replace(html, 'e', '3') ELSE html END AS x FROM pages) WHERE page_id % 5 <> 0)"""


def delivered(spark, sf_dir):
    """Delivered files: some absent, some longer, some changed, the rest right."""
    way = F.col("page_id") % 5
    body = F.when(way == 1, F.concat("html", F.lit(" "))).when(way == 2, F.replace("html", F.lit("e"), F.lit("3"))).otherwise(F.col("html"))
    return (
        read(spark, sf_dir, "pages")
        .where(way != 0)
        .select(
            F.concat(F.lit("f"), F.col("page_id"), F.lit(".html")).alias("filename"),
            F.length(body).cast("bigint").alias("bytes"),
            F.sha2(body, 256).alias("sha256"),
        )
    )


@query(
    "check_files",
    f"""WITH {CATALOG_SQL}, {ACTUAL_SQL} SELECT c.id, CASE WHEN c.bytes = a.bytes AND c.sha256 = a.sha256 THEN 1 ELSE 0 END AS score
FROM c LEFT JOIN a USING (filename)""",
)
def check_files(spark, sf_dir):
    return catalog.check_files(page_catalog(spark, sf_dir), delivered(spark, sf_dir)).select("id", "score")


@query(
    "overall_score",
    f"""WITH {CATALOG_SQL}, {ACTUAL_SQL} SELECT avg(CASE WHEN c.bytes = a.bytes AND c.sha256 = a.sha256 THEN 1.0::DOUBLE ELSE 0 END) AS overall_score
FROM c LEFT JOIN a USING (filename)""",
)
def overall_score(spark, sf_dir):
    return catalog.overall_score(catalog.check_files(page_catalog(spark, sf_dir), delivered(spark, sf_dir)))


@query(
    "stale_artifacts",
    f"""WITH {CATALOG_SQL}, {ACTUAL_SQL} SELECT c.filename FROM c LEFT JOIN a USING (filename) WHERE c.sha256 IS DISTINCT FROM a.sha256""",
)
def stale_artifacts(spark, sf_dir):
    return catalog.stale_artifacts(page_catalog(spark, sf_dir), delivered(spark, sf_dir)).select("filename")


@query(
    "overwritten_releases",
    f"""WITH {CATALOG_SQL}, {ACTUAL_SQL} SELECT c.filename, a.sha256 AS incoming_sha256 FROM c JOIN a USING (filename) WHERE c.sha256 <> a.sha256""",
)
def overwritten_releases(spark, sf_dir):
    got = catalog.overwritten_releases(page_catalog(spark, sf_dir), delivered(spark, sf_dir))
    return got.select("filename", "incoming_sha256")


@query(
    "snapshot_audit",
    f"""WITH {CATALOG_SQL}, {ACTUAL_SQL} SELECT a.filename, a.bytes, CASE WHEN a.bytes = 0 THEN 'empty'
  WHEN c.sha256 <> a.sha256 THEN 'drifted' ELSE 'ok' END AS status FROM a LEFT JOIN c USING (filename)""",
)
def snapshot_audit(spark, sf_dir):
    got = readers.snapshot_audit(delivered(spark, sf_dir), page_catalog(spark, sf_dir))
    return got.select("filename", "bytes", "status")


@query(
    "task_expectations",
    f"""WITH {CATALOG_SQL}, t AS (SELECT doc_id AS task, unnest(range(0, n_chars % 4 + 1)) AS position, doc_id, n_chars FROM documents)
SELECT task, CAST(position AS INTEGER) AS position, id, filename, bytes, sha256 FROM t JOIN c ON c.id = 'p' || (doc_id * 7 + position * 13) % 250""",
)
def task_expectations(spark, sf_dir):
    """Each document stands for a task with a short list of catalogue keys."""
    keys = F.expr("transform(sequence(0L, n_chars % 4), k -> concat('p', (doc_id * 7 + k * 13) % 250))")
    tasks = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("task"), keys.alias("keys"))
    return catalog.task_expectations(tasks, page_catalog(spark, sf_dir))


@query(
    "field_dictionary",
    """SELECT '/c_custkey' AS path, 'integer' AS type, CAST(c_custkey AS VARCHAR) AS example FROM customer WHERE c_custkey = 0
UNION ALL SELECT '/c_name', 'string', c_name FROM customer WHERE c_custkey = 0
UNION ALL SELECT '/c_nationkey', 'integer', CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_custkey = 0
UNION ALL SELECT '/c_acctbal', 'number', CAST(c_acctbal AS VARCHAR) FROM customer WHERE c_custkey = 0
UNION ALL SELECT '/c_mktsegment', 'string', c_mktsegment FROM customer WHERE c_custkey = 0""",
)
def field_dictionary(spark, sf_dir):
    return catalog.field_dictionary(table(spark, sf_dir, "customer")).drop("description")


FILES = ("nation", "customer", "orders", "lineitem")


@query("file_catalog")
def file_catalog(spark, sf_dir):
    """All catalogue columns but the url; no SQL gives bytes and digests, tests/test_sources.py checks them."""
    sets = [
        (f"{n}.parquet", table(spark, sf_dir, n), {"id": n, "site": "tpch", "title": n, "format": "PARQUET"})
        for n in FILES
    ]
    digests = readers.file_digests(spark, [f"{sf_dir}/{n}.parquet" for n in FILES])
    return catalog.build_catalog(sets, digests).drop("url").withColumn("rows", F.col("rows").cast("bigint"))


@query(
    "file_scores",
    """SELECT filename, CASE WHEN filename = 'orders.parquet' THEN 0 ELSE 1 END AS score
FROM (SELECT DISTINCT table_name || '.parquet' AS filename FROM duckdb_columns() WHERE table_name IN ('nation', 'customer', 'orders'))""",
)
def file_scores(spark, sf_dir):
    """The given files scored against expectations, one of which is tampered with."""
    names = ["nation", "customer", "orders"]
    actual = readers.file_digests(spark, [f"{sf_dir}/{n}.parquet" for n in names])
    wrong = F.when(F.col("filename") == "orders.parquet", F.reverse("sha256")).otherwise(F.col("sha256"))
    expected = actual.select("filename", "bytes", wrong.alias("sha256"))
    return catalog.check_files(expected, actual).select("filename", "score")


@query(
    "json_safe",
    """SELECT event_id, CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts,
  lower(hex(encode(event_type))) AS raw FROM events""",
)
def json_safe(spark, sf_dir):
    """Date-times as ISO text and bytes as hex."""
    df = read(spark, sf_dir, "events")
    return df.select(
        "event_id",
        V.json_safe(F.col("ts"), df.schema["ts"].dataType).alias("ts"),
        V.json_safe(F.encode("event_type", "utf-8"), T.BinaryType()).alias("raw"),
    )
