"""The corpus operators over the given tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patina.llm import (
    chat,
    decontaminate,
    embeddings,
    html,
    licenses,
    linededup,
    minhash,
    mixing,
    prefix_trie,
    quality,
    runs,
    toxicity,
    warc,
)
from patina.llm.license_templates import TEMPLATES
from patina.llm.shared import shared_folder
from patina.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that must give the same rows."""

    def keep(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(configure(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 3 * source_size AS most, 3 * source_size / weight AS full_at,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER ahead, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER ahead, 0)) AS level
  FROM sources
  WINDOW ahead AS (ORDER BY 3 * source_size / weight, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, weight, CASE WHEN level > full_at THEN CAST(most AS DOUBLE)
    ELSE weight * max(CASE WHEN level <= full_at THEN level END) OVER () END AS target
  FROM levels),
laid AS (
  SELECT s.*, t.source_size, t.target, t.weight, coalesce(sum(size) OVER (
      PARTITION BY s.source ORDER BY place, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS middle
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT *, list_filter([CAST(middle AS DOUBLE), middle + source_size, middle + 2 * source_size],
                        lambda m: size > 0 AND m <= target) AS middles FROM laid),
times AS (
  SELECT *, list_transform(list_transform(middles, lambda m: m * (weight / target)), lambda w: CASE
    WHEN weight = 1 THEN CASE WHEN w <= 1 THEN 2 * w / (1.5 + sqrt(greatest(0, 2.25 - 2 * w))) ELSE 1 END
    WHEN weight = 2 THEN CASE WHEN w <= 0.75 THEN 2 * w / (1.0 + sqrt(1.0 + 4 * w))
      WHEN w <= 2 THEN 0.5 + 2 * (w - 0.75) / (2.0 + sqrt(4.0 + 4 * (w - 0.75))) ELSE 1 END
    ELSE CASE WHEN w <= 3 THEN 2 * w / 6.0 ELSE 1 END END) AS positions FROM copies)
SELECT doc_id, size, source_size, target, size * len(middles) AS taken,
       array_to_string(list_transform(positions, lambda p: CAST(floor(least(1.0, p) * 1000000) AS BIGINT)), ',') AS positions
FROM times
"""


@query("op2_mix_sources", MIX_SQL)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range-sorted by the first training position; positions are in millionths of the training time."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, keep=["doc_id"])
    millionths = F.transform("positions", lambda p: F.floor(p * 1_000_000).cast("string"))
    return mixing.document_order(mixed).withColumn("positions", F.array_join(millionths, ","))


LINES_SQL = """
WITH pages AS (
  SELECT doc_id, coalesce(source, '') AS host, string_split(text, chr(10)) AS lines FROM documents),
held AS (
  SELECT host, line, count(*) AS n
  FROM (SELECT host, unnest(list_distinct(list_transform(lines, lambda x: trim(x)))) AS line FROM pages)
  WHERE line <> '' GROUP BY host, line),
bad AS (
  SELECT host, list(line) AS bad_lines
  FROM held JOIN (SELECT host, count(*) AS total FROM pages GROUP BY host) USING (host)
  WHERE n >= 3 AND n / total > 0.1 GROUP BY host),
left_lines AS (
  SELECT doc_id, lines, CASE WHEN bad_lines IS NULL THEN lines
    ELSE list_filter(lines, lambda x: NOT list_contains(bad_lines, trim(x))) END AS kept
  FROM pages LEFT JOIN bad USING (host))
SELECT doc_id, array_to_string(kept, chr(10)) AS text, CAST(len(lines) AS BIGINT) AS n_lines,
       CAST(len(lines) - len(kept) AS BIGINT) AS n_dropped
FROM left_lines
"""


@query("op8_line_dedup", LINES_SQL)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return linededup.drop_boilerplate(docs).select("doc_id", "text", "n_lines", "n_dropped")


def add_control_conversation(messages: DataFrame) -> DataFrame:
    """The table and conversation -1, whose two turns consist of control strings."""
    said = "</s>[INST] ok [/INST]"
    more = messages.sparkSession.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string"
    )
    return messages.select("conv_id", "turn", "role", "text").unionByName(more)


CHAT_SQL = r"""
WITH messages AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marks AS (
  SELECT *, CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 19 + len(role) END AS around,
    len(regexp_extract_all(text, '[<\[]\\*(?:<SYS>>|</SYS>>|/?INST\]|/?s>|/?ROLE\]|END\])')) AS escapes
  FROM messages)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(len(text) + around + escapes) AS BIGINT) AS formatted_chars
FROM marks GROUP BY conv_id
"""


@query("op4_chat_format", CHAT_SQL)
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = add_control_conversation(read(spark, sf_dir, "conversations"))
    chats = chat.read_back(chat.format_chats(messages))
    whole = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return chats.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


WARC_SQL = """
WITH held AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM held)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM firsts
"""


@query("op6_warc", WARC_SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of responses are measured again as read; a revisit's are told by its headers."""
    folder = shared_folder(spark)
    warc.write_pages(read(spark, sf_dir, "pages"), folder)
    records = warc.read_warc(spark, folder)
    responses = records.where(F.col("record_type") == "response").select(
        "record_id",
        "record_type",
        "refers_to",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
    )
    revisits = warc.read_warc(spark, folder, payloads=False).where(F.col("record_type") == "revisit").select(
        "record_id",
        "record_type",
        "refers_to",
        F.col("http_headers")["content-length"].cast("bigint").alias("payload_bytes"),
        "payload_digest",
    )
    return responses.unionByName(revisits).select(
        warc.page_key(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_key(F.col("refers_to")).alias("refers_to"),
    )


LEAKS_SQL = r"""
WITH upper_lower AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item, list_slice(words, i, i + 9) AS part
  FROM (SELECT item, words, unnest(range(1, greatest(2, len(words) - 8))) AS i FROM items WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT len(part) AS n FROM windows),
places AS (
  SELECT doc_id, n, i, list_slice(words, i, i + n - 1) AS part
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM upper_lower, sizes WHERE len(words) >= n)),
found AS (SELECT doc_id, item, i, n FROM places JOIN windows USING (part)),
hits AS (
  SELECT doc_id, count(DISTINCT w) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM upper_lower LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op7_decontaminate", LEAKS_SQL)
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_passages(docs, read(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op9_html_text")
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract_main_text(pages).withColumn("n_chars", F.length("text").cast("bigint"))


def learning_fold(key: Column) -> Column:
    """Rows whose labels may be learnt from; the others are held out."""
    return F.crc32(key.cast("string").cast("binary")) % 5 != 0


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), learn_from=learning_fold)
    scored = toxicity.score(docs, model, keep=["doc_id"])
    held_out = ~learning_fold(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources are the hosts here, and languages the paths within them."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    model = quality.train(docs, read(spark, sf_dir, "labels"), learn_from=learning_fold)
    return quality.score(docs, model, keep=["doc_id"])


@query("op3_minhash")
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs)


VECTORS_SQL = """
WITH RECURSIVE held AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM held a, held b
  WHERE a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON vec_id = least.a LEFT JOIN counts ON vec_id = counts.a
"""


@query("op1_embedding_dedup", VECTORS_SQL)
def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


TRIE_SQL = """
WITH own AS (
  SELECT conv_id, list(struct_pack(id := sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')),
                                   chars := length(coalesce(text, '')))
                       ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
marked AS (
  SELECT *, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda v, k: xor(v >> 1, (v & 1) * 3988292384)),
    4294967295)) % 6 AS h FROM own),
rebuilt AS (
  SELECT m.conv_id, list_concat(coalesce(b.turns[1:m.h], []), m.turns[m.h + 1:]) AS turns
  FROM marked m LEFT JOIN own b ON b.conv_id = m.base),
members AS (
  SELECT conv_id, depth, list_transform(turns[1:depth], lambda t: t.id) AS node, len(turns) = depth AS ends,
         coalesce(turns[depth].chars, 0) AS chars
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt)),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY node, depth),
children AS (
  SELECT p.node, p.depth, count(c.node) AS n_children
  FROM nodes p LEFT JOIN nodes c ON c.depth = p.depth + 1 AND c.node[1:p.depth] = p.node GROUP BY p.node, p.depth),
subtrees AS (
  SELECT top, tops_depth, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * chars) AS BIGINT) AS saved_tokens
  FROM (SELECT n.*, c.n_children, unnest(range(0, n.depth + 1)) AS tops_depth, n.node[1:tops_depth] AS top
        FROM nodes n JOIN children c USING (node, depth)) GROUP BY top, tops_depth)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, c.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN children c USING (node, depth) JOIN subtrees s ON s.top = n.node AND s.tops_depth = n.depth
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]
"""


@query("op11_prefix_trie", TRIE_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = read(spark, sf_dir, "conversations")
    own = prefix_trie.turn_sequences(messages, "conv_id", "turn", "role", "text")
    return prefix_trie.prefix_trie(prefix_trie.share_openings(own))


def template_pattern(items: list) -> str:
    """A regular expression for what a parsed license template accepts, each word after one space."""
    parts = []
    for item in items:
        if isinstance(item, bytes):
            parts.append(" " + item.decode())
        elif isinstance(item, tuple):
            parts.append(f"(?: [^ ]+){{{item[0]},{item[1]}}}")
        else:
            parts.append(f"(?:{template_pattern(item)})?")
    return "".join(parts)


LICENSES_SQL = r"""
WITH patterns(label, pattern) AS (VALUES
  PATTERNS),
cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
places AS (
  SELECT doc_id, words,
    list_filter(range(len(words)), lambda i: words[i + 1] = 'mit' AND words[i + 2] = 'license') AS mit,
    list_filter(range(len(words)), lambda i: words[i + 1] = 'apache' AND words[i + 2] = 'license') AS apache,
    list_filter(range(len(words)), lambda i: words[i + 1] = 'general' AND words[i + 2] = 'public' AND words[i + 3] = 'license') AS gpl
  FROM cut),
labelled AS (
  SELECT *, list_concat(mit, apache, gpl) AS base, list_filter([CASE WHEN len(apache) > 0 THEN 'apache' END,
      CASE WHEN len(gpl) > 0 THEN 'gpl' END, CASE WHEN len(mit) > 0 THEN 'mit' END], lambda x: x IS NOT NULL) AS base_labels,
    (SELECT coalesce(list(label), []) FROM patterns
     WHERE regexp_matches(' ' || array_to_string(words, ' ') || ' ', pattern)) AS accepted
  FROM places)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(base) AS BIGINT) AS n_base,
  CAST(list_min(base) AS BIGINT) AS first_word, CAST(list_max(base) AS BIGINT) AS last_word,
  array_to_string(base_labels, ',') AS base_labels,
  array_to_string(list_sort(list_concat(base_labels, accepted)), ',') AS labels,
  CASE WHEN len(accepted) > 0 THEN 1.0 WHEN len(base) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM labelled
"""


def licenses_sql() -> str:
    patterns: dict[str, list[str]] = {}
    for label, markup in TEMPLATES:
        patterns.setdefault(label, []).append(template_pattern(licenses.parse(markup)) + " ")
    rows = ",\n  ".join(f"('{label}', '{'|'.join(found)}')" for label, found in patterns.items())
    return LICENSES_SQL.replace("PATTERNS", rows)


@query("op12_license_scan", licenses_sql())
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score: 1 where a template accepts, one half where only a phrase occurs, else 0."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.find_licenses(docs, keep=["doc_id"])
    base = F.array_distinct(F.transform("phrases", lambda p: p["label"]))
    accepted = F.array_distinct(F.transform("matches", lambda m: m["label"]))
    places = F.transform("phrases", lambda p: p["first_word"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("bigint").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, accepted)), ",").alias("labels"),
        F.when(F.size("matches") > 0, 1.0).when(F.size("phrases") > 0, 0.5).otherwise(0.0).alias("score"),
    )


def repeat_words(docs: DataFrame) -> DataFrame:
    """Texts of which a tenth, by a hash of the id, repeat themselves from some word to their end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size("words").cast("bigint")
    split = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words).alias("words"))
    placed = split.select("*", n.alias("n"), F.when(n > 0, F.col("g") % n).alias("a"))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("bigint")
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    again = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), lambda i: F.element_at("words", (place(i) + 1).cast("int"))
    )
    text = F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text"))
    return placed.select("*", period.alias("p")).select("doc_id", text.alias("text"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = repeat_words(read(spark, sf_dir, "documents").select("doc_id", "text"))
    found = runs.collapse_runs(docs, keep=["doc_id"])
    # The greatest: longest, then first, then of least period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.l div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
