"""Queries that turn documents into sections, windows and identified chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweir.functions import formats
from docweir.operators import assembly, sections
from docweir.plans.fixtures import frame
from docweir.plans.registry import query
from docweir.plans.text import NEWLINE_SQL, TEXTS_SQL, texts
from docweir.sources import views

LINES_SQL = TEXTS_SQL + f""", ln AS (SELECT source_id, i - 1 AS pos, ls[i] AS line FROM (SELECT source_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT source_id, regexp_split_to_array(content, {NEWLINE_SQL}) AS ls FROM texts)))
"""
_HEAD = f"regexp_matches(line, '^(#{{1,6}})\\s+(.+)$')"
_LEVEL = f"len(regexp_extract(line, '^(#{{1,6}})\\s+(.+)$', 1))"
_TITLE = f"regexp_extract(line, '^(#{{1,6}})\\s+(.+)$', 2)"


def lines(spark, sf_dir):
    return sections.document_lines(texts(spark, sf_dir))


@query("line_counts", LINES_SQL + "SELECT source_id, count(*) AS lines, count(*) FILTER (trim(line, ' ') <> '') AS live FROM ln GROUP BY source_id")
def line_counts(spark, sf_dir):
    return lines(spark, sf_dir).groupBy("source_id").agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.trim("line") != "").alias("live"))


TWIN_LINES_SQL = TEXTS_SQL + f""", {views.TWINS_SQL}, tx AS (SELECT provider, source_id, content FROM tw UNION ALL SELECT 'FIXTURE', source_id, content FROM fx_texts),
ln AS (SELECT provider, source_id, i - 1 AS pos, ls[i] AS line FROM (SELECT provider, source_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT provider, source_id, regexp_split_to_array(content, {NEWLINE_SQL}) AS ls FROM tx)))"""


@query("section_spans", TWIN_LINES_SQL + r""", e AS (SELECT provider, source_id, max(pos) AS fin FROM ln GROUP BY ALL), h AS (SELECT *, lead(pos) OVER w AS nxt, row_number() OVER w AS section FROM ln WHERE regexp_matches(line, '^#{1,6}\s+.+$') WINDOW w AS (PARTITION BY provider, source_id ORDER BY pos))
SELECT provider, source_id, section, len(regexp_extract(line, '^(#{1,6})\s+(.+)$', 1)) AS level, regexp_extract(line, '^(#{1,6})\s+(.+)$', 2) AS title, pos AS first, coalesce(nxt - 1, fin) AS last FROM h JOIN e USING (provider, source_id)""")
def section_spans(spark, sf_dir):
    """Sections of every document, and of other providers' documents that have the same ids."""
    t = views.twin_documents(spark, sf_dir).select("provider", "source_id", "content").unionByName(frame(spark, "fx_texts").select(F.lit("FIXTURE").alias("provider"), "source_id", "content"))
    key = ["provider", "source_id"]
    return sections.spans(sections.document_lines(t, key), key)


@query("heading_paths", LINES_SQL + f""", m AS (SELECT *, CASE WHEN {_HEAD} THEN {_LEVEL} END AS level, {_TITLE} AS title FROM ln),
t AS (SELECT source_id, pos, {', '.join(f"max(pos) FILTER (level = {k}) OVER w AS p{k}, arg_max(title, pos) FILTER (level = {k}) OVER w AS t{k}" for k in range(1, 5))} FROM m WINDOW w AS (PARTITION BY source_id ORDER BY pos ROWS UNBOUNDED PRECEDING))
SELECT source_id, pos, concat_ws(' > ', t1, CASE WHEN p2 > coalesce(p1, -1) THEN t2 END, CASE WHEN p3 > greatest(coalesce(p1, -1), coalesce(p2, -1)) THEN t3 END, CASE WHEN p4 > greatest(coalesce(p1, -1), coalesce(p2, -1), coalesce(p3, -1)) THEN t4 END) AS path FROM t""")
def heading_paths(spark, sf_dir):
    return sections.heading_paths(lines(spark, sf_dir))


_TABLE, _STEP, _LIVE = r"regexp_matches(line, '^\s*\|')", r"regexp_matches(line, '^\s*\d+\.\s+\S')", "trim(line, ' ') <> ''"
_SECTION = r"regexp_matches(line, '^(#{2,4})\s+(.+?)\s*$')"
CATEGORY_SQL = LINES_SQL + rf""", d AS (SELECT source_id, CASE WHEN count(*) FILTER ({_TABLE}) / greatest(count(*) FILTER ({_LIVE}), 1) >= 0.28 THEN 'registry-table' ELSE 'narrative' END AS dflt FROM ln GROUP BY source_id),
s AS (SELECT *, count(*) FILTER ({_SECTION}) OVER (PARTITION BY source_id ORDER BY pos) AS section FROM ln),
g AS (SELECT source_id, section, arg_min(line, pos) AS heading, count(*) FILTER (NOT {_SECTION} AND {_TABLE}) AS tables, count(*) FILTER (NOT {_SECTION} AND {_STEP}) AS steps, greatest(count(*) FILTER (NOT {_SECTION} AND {_LIVE}), 1) AS total FROM s WHERE section > 0 GROUP BY source_id, section),
n AS (SELECT *, regexp_extract(heading, '^(#{{2,4}})\s+(.+?)\s*$', 2) AS title FROM g),
k AS (SELECT source_id, section, title, CASE WHEN regexp_matches(heading, '^#{{3}}\s+`([A-Z][A-Z0-9_]*)`\s+[—-]\s+id\s+\d+,\s+version\s+[\d.]+\s*$') OR regexp_matches(heading, '^#{{2,4}}\s+[\d.]+\s+`([A-Z][A-Z0-9_]*)`\s+\(id\s+(\d+)\)') THEN 'entity-contract'
 WHEN regexp_matches(title, '(?i)\b(?:registry|matrix|inventory|catalog\w*|map|ownership|reference table)\b') THEN 'registry-table'
 WHEN regexp_matches(title, '(?i)\b(?:how to use|reading order|volume map|master index|corpus guide|what this volume|document metadata|scope and audience|index)\b') THEN 'index'
 WHEN regexp_matches(title, '(?i)\b(?:glossar\w*|vocabular\w*|terminolog\w*|definitions?)\b') THEN 'glossary' WHEN tables / total >= 0.28 THEN 'registry-table'
 WHEN steps / total >= 0.08 OR (regexp_matches(title, '(?i)\b(?:flow|lifecycle|workflow|process|walkthrough|end.to.end)\b') AND steps >= 3) THEN 'workflow' ELSE dflt END AS category, tables, steps, total FROM n JOIN d USING (source_id))
"""


@query("section_categories", CATEGORY_SQL + "SELECT * FROM k")
def section_categories(spark, sf_dir):
    return sections.classified(lines(spark, sf_dir))


@query("section_totals", CATEGORY_SQL + "SELECT coalesce(source_id, 'CORPUS') AS source_id, category, count(*) AS sections FROM k GROUP BY GROUPING SETS ((source_id, category), (category))")
def section_totals(spark, sf_dir):
    k = sections.classified(lines(spark, sf_dir))
    grouped = k.groupingSets([("source_id", "category"), ("category",)], "source_id", "category").agg(F.count(F.lit(1)).alias("sections"), F.grouping("source_id").alias("all"))
    return grouped.select(F.when(F.col("all") == 1, "CORPUS").otherwise(F.col("source_id")).alias("source_id"), "category", "sections")


@query("workflow_steps", LINES_SQL + f""", s AS (SELECT *, count(*) FILTER (regexp_matches(line, '^#{{1,4}}\\s+.*?\\[([A-Z][A-Z0-9]*-\\d+)\\].*$')) OVER (PARTITION BY source_id ORDER BY pos) AS section FROM ln)
SELECT source_id, section, regexp_extract(arg_min(line, pos), '^#{{1,4}}\\s+.*?\\[([A-Z][A-Z0-9]*-\\d+)\\].*$', 1) AS flow_id, count(*) FILTER (regexp_matches(line, '^\\s*\\d+[.)]\\s+\\S')) AS steps FROM s WHERE section > 0 GROUP BY source_id, section""")
def workflow_steps(spark, sf_dir):
    return sections.workflows(lines(spark, sf_dir))


_C = sections.CONTRACT


@query("entity_contract_headings", LINES_SQL + f"SELECT source_id, pos, regexp_extract(line, '{_C}', 1) AS entity_key, coalesce(nullif(regexp_extract(line, '{_C}', 2), ''), nullif(regexp_extract(line, '{_C}', 4), '')) AS entity_id, regexp_replace(nullif(regexp_extract(line, '{_C}', 3), ''), '[.,;]+$', '') AS entity_version FROM ln WHERE regexp_matches(line, '{_C}')")
def entity_contract_headings(spark, sf_dir):
    return sections.contracts(lines(spark, sf_dir))


ISLANDS_SQL = LINES_SQL + """, r AS (SELECT *, len(line) - len(replace(line, '|', '')) >= 2 AS is_row FROM ln), t AS (SELECT *, coalesce(is_row <> lag(is_row) OVER (PARTITION BY source_id ORDER BY pos), true) AS turned FROM r),
i AS (SELECT *, CAST(count(*) FILTER (turned) OVER (PARTITION BY source_id ORDER BY pos) AS BIGINT) AS island FROM t),
b AS (SELECT source_id, island, min(pos) AS first, count(*) AS rows, bool_and(is_row) AND count(*) > 1 AS is_table FROM i GROUP BY source_id, island)
"""


@query("table_islands", ISLANDS_SQL + "SELECT * FROM b")
def table_islands(spark, sf_dir):
    return sections.islands(lines(spark, sf_dir))


@query("table_captions", ISLANDS_SQL + f""", n AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY first) AS n FROM b WHERE is_table)
SELECT source_id, island, coalesce((SELECT arg_max({_TITLE}, pos) FROM ln WHERE ln.source_id = n.source_id AND ln.pos <= n.first AND {_HEAD}), 'table-' || n) AS caption FROM n""")
def table_captions(spark, sf_dir):
    return sections.captions(lines(spark, sf_dir))


@query("glossary_entries", LINES_SQL + f"SELECT source_id, pos, trim(regexp_extract(line, '^\\s*([^:]{{2,80}}):\\s+(.+)$', 1), ' ') AS term FROM ln WHERE regexp_matches(line, '^\\s*([^:]{{2,80}}):\\s+(.+)$') AND NOT {_HEAD}")
def glossary_entries(spark, sf_dir):
    return sections.terms(lines(spark, sf_dir))


@query("line_packing", LINES_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + """, c AS (SELECT source_id, pos, CAST(len(regexp_extract_all(line, '\\S+')) AS BIGINT) AS n FROM ln),
w(source_id, pos, win, lines, tokens) AS (SELECT source_id, pos, CAST(0 AS INTEGER), CAST(1 AS BIGINT), n FROM c WHERE pos = 0
 UNION ALL SELECT c.source_id, c.pos, CASE WHEN w.tokens + c.n > 120 THEN win + 1 ELSE win END, CASE WHEN w.tokens + c.n > 120 THEN 1 ELSE w.lines + 1 END, CASE WHEN w.tokens + c.n > 120 THEN c.n ELSE w.tokens + c.n END FROM w JOIN c ON c.source_id = w.source_id AND c.pos = w.pos + 1)
SELECT source_id, win AS "window", max(lines) AS lines, max(tokens) AS tokens FROM w GROUP BY source_id, win""")
def line_packing(spark, sf_dir):
    return sections.packed_lines(texts(spark, sf_dir), 120)


CHUNKS_SQL = views.BASE_SQL + f""", {views.TWINS_SQL}, pl AS (SELECT s.*, i - 1 AS ordinal, trim(ls[i], ' ') AS body FROM (SELECT tw.*, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT *, regexp_split_to_array(content, {NEWLINE_SQL}) AS ls FROM tw) tw) s WHERE trim(ls[i], ' ') <> ''),
ch AS (SELECT *, sha256(body) AS digest, sha256(project_id || '|' || provider || '|' || source_id || '|' || version || '|' || ordinal || '|' || sha256(body) || '|' || chunker_version) AS plain_id,
  sha256(project_id || '|JIRA|' || source_id || '|' || ('line:' || ordinal) || '|' || sha256(body) || '|jira-v2') AS jira_id FROM pl),
k AS (SELECT *, CASE WHEN provider = 'JIRA' THEN jira_id ELSE plain_id END AS chunk_id, row_number() OVER (PARTITION BY project_id, provider, source_id, digest ORDER BY ordinal) AS nth FROM ch)
"""


def _chunks(spark, sf_dir):
    s = views.twin_documents(spark, sf_dir)
    rows = s.select("*", F.posexplode(formats.lines(F.col("content"))).alias("ordinal", "line")).withColumn("body", F.trim("line")).where("body <> ''")
    return assembly.identified(rows.withColumns({"locator": F.concat(F.lit("line:"), "ordinal"), "ordinal": F.col("ordinal").cast("long")}))


@query("chunk_ids", CHUNKS_SQL + "SELECT provider, source_id, ordinal, chunk_id, digest FROM k")
def chunk_ids(spark, sf_dir):
    return _chunks(spark, sf_dir).select("provider", "source_id", "ordinal", "chunk_id", "digest")


@query("chunk_dedupe", CHUNKS_SQL + "SELECT provider, source_id, ordinal, digest FROM k WHERE nth = 1")
def chunk_dedupe(spark, sf_dir):
    return assembly.first_bodies(_chunks(spark, sf_dir)).select("provider", "source_id", "ordinal", "digest")


@query("chunk_id_conflicts", CHUNKS_SQL + "SELECT chunk_id, count(*) AS copies FROM k WHERE nth = 1 GROUP BY chunk_id HAVING count(*) > 1")
def chunk_id_conflicts(spark, sf_dir):
    return assembly.conflicts(assembly.first_bodies(_chunks(spark, sf_dir)))


@query("shared_entities", TEXTS_SQL + """, e AS (SELECT source_id, list_distinct(list_transform(regexp_extract_all(content, '([A-Z][A-Z0-9]{1,30})_[A-Z0-9_]{2,}', 1), lambda x: lower(x))) AS es FROM texts) SELECT source_id, len(es) AS entities, len(es) > 1 AS shared FROM e WHERE len(es) > 0""")
def shared_entities(spark, sf_dir):
    found = F.array_distinct(F.transform(F.regexp_extract_all("content", F.lit("([A-Z][A-Z0-9]{1,30})_[A-Z0-9_]{2,}"), F.lit(1)), lambda x: F.lower(x)))
    e = texts(spark, sf_dir).select("source_id", found.alias("es")).where(F.size("es") > 0)
    return e.select("source_id", F.size("es").cast("long").alias("entities"), (F.size("es") > 1).alias("shared"))


@query("flat_metadata", views.BASE_SQL + """, f AS (SELECT source_id, doc_id, title, path, scope, coalesce(space_key, '') AS lang, substr(version, 1, 6) AS v FROM src)
SELECT source_id, '["' || title || '","' || path || '"]' AS structure_path, title AS structure_root, path AS structure_leaf, CAST(CASE WHEN doc_id % 4 = 0 THEN 0 ELSE doc_id % 40 END AS INTEGER) AS page_number,
 CASE doc_id % 3 WHEN 0 THEN '[]' WHEN 1 THEN '["table"]' ELSE '["image","table"]' END AS visual_types, ['', 'table', 'image'][doc_id % 3 + 1] AS visual_type,
 CASE doc_id % 5 WHEN 0 THEN '[]' ELSE '["' || v || '"]' END AS visual_asset_ids, CASE doc_id % 5 WHEN 0 THEN '' ELSE v END AS visual_asset_id,
 'a_key=' || CASE WHEN doc_id % 6 = 0 THEN scope ELSE lang END || CASE WHEN doc_id % 6 = 0 THEN '' ELSE ';n=' || doc_id END AS extra, CASE WHEN doc_id % 13 = 0 THEN 'reserved key: source_url' END AS failure FROM f""")
def flat_metadata(spark, sf_dir):
    """Pages, pictures and metadata of every document as scalars: keys that become the same, hidden ones, nulls, and a reserved one."""
    s, i = views.source_documents(spark, sf_dir), F.col("doc_id")
    none = F.array().cast("array<string>")
    given = F.create_map(
        F.lit("a key"), "scope", F.lit("_hidden"), F.lit("x"), F.when(i % 6 == 0, "other").otherwise("a-key"), F.when(i % 6 != 0, F.coalesce("space_key", F.lit(""))), F.lit("n"), F.when(i % 6 != 0, i.cast("string")),
        F.when(i % 13 == 0, "source url").otherwise("_none"), F.lit("y"),
    )
    rows = s.withColumns({
        "structure_path": F.array("title", F.lit(""), "path"), "page": F.when(i % 4 != 0, (i % 40).cast("int")), "metadata": given,
        "visual_types": F.when(i % 3 == 1, F.array(F.lit("table"))).when(i % 3 == 2, F.array(F.lit("image"), F.lit("table"))), "visual_asset_ids": F.when(i % 5 == 0, none).otherwise(F.array(F.substring("version", 1, 6))),
    })
    flat = assembly.flattened(rows)
    extra = F.array_join(F.transform(F.array_sort(F.map_entries("extra")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return flat.select("source_id", "structure_path", "structure_root", "structure_leaf", "page_number", "visual_types", "visual_type", "visual_asset_ids", "visual_asset_id", extra.alias("extra"), "failure")


@query("reserved_metadata_keys", """WITH r AS (SELECT doc_id, ['provider', 'title', substr(coalesce(text, ''), 1, 70), '_' || coalesce(lang, ''), coalesce(source, '') || ' key', '', 'embedding text', 'schema-version'][doc_id % 8 + 1] AS raw FROM documents), k AS (SELECT doc_id, raw, substr(regexp_replace(raw, '[^A-Za-z0-9_]', '_', 'g'), 1, 64) AS key FROM r)
SELECT doc_id, key, CASE WHEN key IN ('embedding_text', 'canonical_chunk_id', 'project_id', 'access_policy_id', 'provider', 'source_id', 'source_type', 'source_version', 'title', 'reference', 'source_url', 'chunk_ordinal', 'content_hash', 'structure_hash', 'parent_id', 'record_kind', 'schema_version', 'embedding_model') THEN 'reserved'
 WHEN key = '' OR starts_with(key, '_') THEN 'dropped' ELSE 'kept' END AS outcome FROM k""")
def reserved_metadata_keys(spark, sf_dir):
    """Keys of each document's metadata: reserved ones, ones that become reserved, its own first words, and hidden ones."""
    own = F.array(F.lit("provider"), F.lit("title"), F.substring(F.coalesce("text", F.lit("")), 1, 70), F.concat(F.lit("_"), F.coalesce("lang", F.lit(""))), F.concat(F.coalesce("source", F.lit("")), F.lit(" key")), F.lit(""), F.lit("embedding text"), F.lit("schema-version"))
    rows = views.table(spark, sf_dir, "documents").select("doc_id", F.element_at(own, (F.col("doc_id") % 8 + 1).cast("int")).alias("raw"))
    return rows.select("doc_id", assembly.safe_key(F.col("raw")).alias("key"), assembly.key_outcome(F.col("raw")).alias("outcome"))


@query("page_headings", "SELECT page_id, regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1) AS heading, CAST(len(regexp_extract_all(html, '<p[ >]')) AS BIGINT) AS paragraphs, CAST(len(regexp_extract_all(html, '<li[ >]')) AS BIGINT) AS items FROM pages")
def page_headings(spark, sf_dir):
    p = views.table(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("html", "<h1[^>]*>(.*?)</h1>", 1).alias("heading"), F.regexp_count("html", F.lit("<p[ >]")).cast("long").alias("paragraphs"), F.regexp_count("html", F.lit("<li[ >]")).cast("long").alias("items"))


@query("page_text", "SELECT page_id, sha256(trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'), ' ')) AS digest FROM pages")
def page_text(spark, sf_dir):
    bare = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " "), "<[^>]+>", " ")
    return views.table(spark, sf_dir, "pages").select("page_id", F.sha2(F.trim(F.regexp_replace(bare, r"\s+", " ")), 256).alias("digest"))


@query("html_chunks")
def html_chunks(spark, sf_dir):
    from docweir.operators.chunkers import html_chunks as run

    return run(views.table(spark, sf_dir, "pages").select(F.concat(F.lit("page:"), "page_id").alias("source_id"), F.col("html").alias("content"))).withColumn("path", F.concat_ws(" > ", "path"))


@query("chunked_documents")
def chunked_documents(spark, sf_dir):
    from docweir.operators.chunkers import chunk_documents

    twins = views.twin_documents(spark, sf_dir).select("provider", "source_id", "title", F.lit("").alias("declared"), F.array().cast("array<string>").alias("labels"), "content")
    t = twins.unionByName(frame(spark, "fx_texts").withColumn("provider", F.lit("FIXTURE")))
    found = chunk_documents(formats.with_category(formats.with_format(t)).select("provider", "source_id", "title", "kind", "category", "content"))
    return found.withColumn("path", F.concat_ws(" > ", "path"))


@query("token_windows")
def token_windows(spark, sf_dir):
    """Windows of every document by a public tokenizer's tokens."""
    import public_tokenizers

    from docweir.operators.token_windows import window_documents

    found = window_documents(views.twin_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("provider", "source_id", "ordinal", F.concat_ws(" > ", "path").alias("path"), "start", "end", "tokens", "total", F.sha2("content", 256).alias("digest"))


@query("assembled_chunks")
def assembled_chunks(spark, sf_dir):
    """Every document cut, and its chunks as they would be stored."""
    from docweir.operators.chunkers import chunk_documents

    s = views.twin_documents(spark, sf_dir)
    key = ["project_id", "provider", "source_id"]
    t = formats.with_category(formats.with_format(s.select(*key, "title", F.lit("").alias("declared"), "labels", "content")))
    chunks = chunk_documents(t.select(*key, "title", "kind", "category", "content"))
    docs = s.withColumns({"reference": F.col("path"), "repository": F.col("scope")}).select("project_id", "provider", "source_id", "version", "chunker_version", "title", "reference", "source_type", "path", "repository")
    out = assembly.assembled(chunks, docs.withColumnRenamed("path", "document_path"))
    return out.select("provider", "source_id", "ordinal", "chunk_id", "content_hash", "structure_hash", "locator", "profile", "tokens", F.sha2("embedding_text", 256).alias("embedding_digest"))


@query("metadata_merge", views.BASE_SQL + """, m AS (SELECT source_id, map {'title': title, 'path': path, 'lang': lower(space_key)} AS a, map {'title': CASE WHEN doc_id % 2 = 0 THEN 'own ' || doc_id END, 'kind': source_type} AS b FROM src)
SELECT source_id, CASE WHEN b['title'] IS NOT NULL THEN b['title'] ELSE a['title'] END AS title, a['path'] AS path, a['lang'] AS lang, b['kind'] AS kind, CAST(3 + (a['lang'] IS NOT NULL)::INT AS INTEGER) AS entries FROM m""")
def metadata_merge(spark, sf_dir):
    s = views.source_documents(spark, sf_dir)
    of = lambda **v: F.create_map(*(x for k, c in v.items() for x in (F.lit(k), c)))
    base = of(title=F.col("title"), path=F.col("path"), lang=F.lower("space_key"))
    own = of(title=F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("own "), "doc_id")), kind=F.col("source_type"))
    m = s.select("source_id", assembly.merged(base, own).alias("m"))
    return m.select("source_id", *(F.try_element_at("m", F.lit(k)).alias(k) for k in ("title", "path", "lang", "kind")), F.size("m").alias("entries"))
