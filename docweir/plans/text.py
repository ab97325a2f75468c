"""Queries over texts: format, category, entity, language, identifiers, paths, links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweir.functions import formats, paths, text
from docweir.operators import visuals
from docweir.plans.fixtures import cte, frame
from docweir.plans.registry import query
from docweir.sources import views

TEXTS_SQL = f"""WITH {views.SOURCES_SQL}, {cte("fx_texts")},
texts AS (SELECT source_id, title, '' AS declared, CAST([] AS VARCHAR[]) AS labels, content FROM src UNION ALL SELECT * FROM fx_texts)"""
NEWLINE_SQL = "'\\r\\n|\\r|\\n'"
STRIP_SQL = "regexp_replace(regexp_replace({}, '^[\\s\\x{{0b}}]+', ''), '[\\s\\x{{0b}}]+$', '')"


def strip_sql(value: str) -> str:
    return STRIP_SQL.format(value)


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scanned documents and the fixture texts."""
    s = views.source_documents(spark, sf_dir).select("source_id", "title", F.lit("").alias("declared"), F.array().cast("array<string>").alias("labels"), "content")
    return s.unionByName(frame(spark, "fx_texts"))


def _agree_sql(delimiter: str) -> str:
    counts = f"list_transform(list_filter(sample, lambda x: trim(x, ' ') <> ''), lambda x: len(x) - len(replace(x, {delimiter}, '')))"
    return f"(SELECT CASE WHEN c[1] >= 1 THEN coalesce(nullif(list_position(list_transform(c, lambda x: x <> c[1]), true), 0) - 1, len(c)) ELSE 0 END FROM (SELECT {counts} AS c))"


FORMAT_SQL = TEXTS_SQL + f""", b AS (SELECT source_id, declared, {strip_sql('content')} AS body FROM texts),
l AS (SELECT *, regexp_split_to_array(body, {NEWLINE_SQL}) AS ls FROM b), s AS (SELECT *, ls[1:200] AS sample FROM l),
n AS (SELECT *, {_agree_sql("','")} AS comma, {_agree_sql("chr(9)")} AS tab, {_agree_sql("';'")} AS semicolon,
  len(list_filter(sample, lambda x: len(x) - len(replace(x, '|', '')) >= 2)) AS pipes, len(list_filter(sample, lambda x: regexp_matches(x, '^\\s*(?:\\[?\\d{{4}}-\\d{{2}}-\\d{{2}}[T ]\\d{{2}}:\\d{{2}}|\\d{{2}}:\\d{{2}}:\\d{{2}}|(?:TRACE|DEBUG|INFO|WARN|WARNING|ERROR|FATAL)\\b)'))) AS logs,
  len(list_filter(sample, lambda x: regexp_matches(x, '^\\s*(?:package |import |from \\S+ import |#include|using |def |class |func |public |private |internal |fun |val |var |const |let |async def )'))) AS code FROM s)
SELECT source_id, k[1] AS kind, k[2] AS reason FROM (SELECT source_id, CASE WHEN declared <> '' THEN [declared, 'declared'] WHEN body = '' THEN ['prose', 'empty']
 WHEN regexp_matches(body, '^[\\{{\\[]') AND regexp_matches(body, '[\\}}\\]]$') AND json_valid(body) THEN ['json', 'parses as JSON']
 WHEN comma >= 3 THEN ['csv', comma || ' leading lines agree'] WHEN tab >= 3 THEN ['csv', tab || ' leading lines agree'] WHEN semicolon >= 3 THEN ['csv', semicolon || ' leading lines agree']
 WHEN len(list_filter(sample, lambda x: regexp_matches(x, '^\\s*\\|.*\\|\\s*$'))) > 0 AND pipes >= 3 THEN ['markdown', pipes || ' pipe rows']
 WHEN len(list_filter(ls, lambda x: regexp_matches(x, '^ {{0,3}}#{{1,6}} \\S') OR regexp_matches(x, '^ {{0,3}}```'))) > 0 THEN ['markdown', 'headings or fences']
 WHEN regexp_matches(body, '(?i)<(p|div|table|h[1-6]|ul|ol|span|section)\\b[^>]*>') THEN ['html', 'block tags'] WHEN logs >= greatest(3, len(sample) // 2) THEN ['log', logs || ' log lines']
 WHEN code >= 3 THEN ['code', code || ' code lines'] ELSE ['prose', 'no markers'] END AS k FROM n)"""


@query("format_detect", FORMAT_SQL)
def format_detect(spark, sf_dir):
    return formats.with_format(texts(spark, sf_dir)).select("source_id", "kind", "reason")


@query("declared_format", views.BASE_SQL + f""" SELECT source_id, CASE {paths.suffix_sql('path')} WHEN '.md' THEN 'markdown' WHEN '.csv' THEN 'csv' END AS declared FROM src""")
def declared_format(spark, sf_dir):
    return views.source_documents(spark, sf_dir).select("source_id", formats.declared_format(paths.suffix(F.col("path")), F.lit("text/plain")).alias("declared"))


CATEGORY_SQL = TEXTS_SQL + f""", n AS (SELECT *, replace(lower(title), '_', ' ') AS name, substr(content, 1, 80000) AS sample FROM texts),
r AS (SELECT *, regexp_split_to_array(sample, {NEWLINE_SQL}) AS ls FROM n),
c AS (SELECT *, len(list_filter(ls, lambda x: len(x) - len(replace(x, '|', '')) >= 3)) AS piped, len(list_filter(ls, lambda x: len(regexp_extract_all(x, '\\S+')) >= 8)) AS prose,
  coalesce(substr(list_min(list_filter(list_transform(labels, lambda x: lower(trim(x))), lambda x: starts_with(x, 'pi-category:'))), 13), '') AS label FROM r),
t AS (SELECT *, CASE WHEN contains(name, 'bot-rag-00') THEN 'index' WHEN contains(name, 'bot-rag-02') THEN 'workflow' WHEN regexp_matches(name, 'bot-rag-0[134]') THEN 'narrative'
  WHEN regexp_matches(name, '\\b(master index|corpus guide|navigation index)\\b') THEN 'index' WHEN regexp_matches(name, '\\b(glossary|terms and definitions)\\b') THEN 'glossary'
  WHEN regexp_matches(name, '\\b(workflow|business flow|end to end)\\b') OR regexp_matches(sample, '(?i)\\[(?:BOT)?FLOW-\\d+\\]') THEN 'workflow'
  WHEN len(list_filter(ls, lambda x: regexp_matches(x, '(?i)^#{{2,4}}\\s+`?[A-Z][A-Z0-9_]+`?\\s+[-—].*\\bid\\s+\\d+.*\\bversion\\b'))) > 0 OR contains(name, 'event and integration contract') THEN 'entity-contract'
  WHEN piped >= 20 AND piped > prose THEN 'registry-table' ELSE 'narrative' END AS structure FROM c)
SELECT source_id, CASE WHEN label <> '' THEN label ELSE structure END AS category, CASE WHEN label <> '' THEN 'label' WHEN structure <> 'narrative' THEN 'structure' ELSE 'no markers' END AS reason,
 CASE WHEN label <> '' AND structure <> 'narrative' AND structure <> label THEN 'structure says ' || structure ELSE '' END AS warning FROM t"""


@query("category_detect", CATEGORY_SQL)
def category_detect(spark, sf_dir):
    found = formats.with_category(texts(spark, sf_dir))
    return found.select("source_id", "category", F.col("category_reason").alias("reason"), F.col("category_warning").alias("warning"))


_STOP = "(" + ", ".join(f"'{w}'" for w in formats.STOP_ENTITIES) + ")"


@query("entity_detect", TEXTS_SQL + f""", e AS (SELECT source_id,
 regexp_replace(coalesce(substr(list_min(list_filter(list_transform(labels, lambda x: lower(trim(x))), lambda x: starts_with(x, 'pi-entity:'))), 11), ''), '[^a-z0-9_-]+', '', 'g') AS label,
 lower(regexp_extract(title, '(?i)^\\s*([A-Za-z][A-Za-z0-9]{{1,30}})(?:[-_:]+|\\s+RAG[-_ ]*\\d+\\b)', 1)) AS titled, lower(regexp_extract(substr(content, 1, 8000), '\\b([A-Z][A-Z0-9]{{1,30}})_[A-Z0-9_]{{2,}}\\b', 1)) AS inside FROM texts)
SELECT source_id, CASE WHEN label <> '' THEN label WHEN titled <> '' AND titled NOT IN {_STOP} THEN titled WHEN inside <> '' AND inside NOT IN {_STOP} THEN inside ELSE '' END AS entity,
 CASE WHEN label <> '' THEN 'label' WHEN titled <> '' AND titled NOT IN {_STOP} THEN 'title prefix' WHEN inside <> '' AND inside NOT IN {_STOP} THEN 'identifier prefix' ELSE 'none' END AS reason FROM e""")
def entity_detect(spark, sf_dir):
    found = texts(spark, sf_dir).select("source_id", formats.detect_entity(F.col("title"), F.col("content"), F.col("labels")).alias("e"))
    return found.select("source_id", "e.entity", "e.reason")


def _words(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


@query("language_detect", TEXTS_SQL + f""", w AS (SELECT source_id, lower(content) AS low, regexp_extract_all(lower(content), '[a-záéíóúñ]+') AS ws FROM texts),
n AS (SELECT *, len(list_filter(ws, lambda x: list_contains({_words(formats.SPANISH)}, x))) AS es, len(list_filter(ws, lambda x: list_contains({_words(formats.ENGLISH)}, x))) AS en FROM w)
SELECT source_id, CASE WHEN es > en THEN 'es' WHEN en > es THEN 'en' WHEN regexp_matches(low, '[áéíóúñ¿¡]') THEN 'mixed' ELSE 'und' END AS language FROM n""")
def language_detect(spark, sf_dir):
    return texts(spark, sf_dir).select("source_id", formats.detect_language(F.col("content")).alias("language"))


IDENTIFIERS_SQL = "list_sort(list_distinct(list_filter(regexp_split_to_array({}, '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+'), lambda x: regexp_full_match(x, '[A-Z][A-Z0-9_]{{2,}}'))))"


@query("identifiers_per_doc", TEXTS_SQL + f" SELECT source_id, array_to_string({IDENTIFIERS_SQL.format('content')}, ',') AS identifiers FROM texts")
def identifiers_per_doc(spark, sf_dir):
    return texts(spark, sf_dir).select("source_id", F.concat_ws(",", text.identifiers(F.col("content"))).alias("identifiers"))


@query("keywords_top32", TEXTS_SQL + f""", k AS (SELECT source_id, regexp_extract_all(title || chr(10) || content, '[A-Za-z0-9][A-Za-z0-9_./:#-]{{2,}}') AS ks FROM texts),
u AS (SELECT source_id, i, ks[i] AS kw, row_number() OVER (PARTITION BY source_id, lower(ks[i]) ORDER BY i) AS nth FROM (SELECT source_id, ks, unnest(range(1, len(ks) + 1)) AS i FROM k)),
f AS (SELECT source_id, kw, i, row_number() OVER (PARTITION BY source_id ORDER BY i) AS place FROM u WHERE nth = 1)
SELECT source_id, string_agg(kw, ' ' ORDER BY i) AS keywords FROM f WHERE place <= 32 GROUP BY source_id""")
def keywords_top32(spark, sf_dir):
    found = text.with_keywords(texts(spark, sf_dir), [F.col("title"), F.col("content")])
    return found.select("source_id", F.concat_ws(" ", "keywords").alias("keywords"))


@query("code_symbols", TEXTS_SQL + f""", k AS (SELECT source_id, regexp_extract_all(content, '(?m)^\\s*(?:async\\s+)?(?:(?:public|private|protected|internal|open|abstract|sealed|data|enum|annotation|value|inline|tailrec|suspend|operator|infix|override|actual|expect|final|external)\\s+)*(?:class|interface|object|def|fun|function)\\s+([A-Za-z_][A-Za-z0-9_]*)', 1) AS ks FROM texts),
u AS (SELECT source_id, min(i) AS i, kw FROM (SELECT source_id, i, ks[i] AS kw FROM (SELECT source_id, ks, unnest(range(1, len(ks) + 1)) AS i FROM k)) GROUP BY source_id, kw)
SELECT source_id, string_agg(kw, ',' ORDER BY i) AS symbols FROM u GROUP BY source_id""")
def code_symbols(spark, sf_dir):
    return texts(spark, sf_dir).select("source_id", F.concat_ws(",", text.code_symbols(F.col("content"))).alias("symbols")).where("symbols <> ''")


@query("clean_text", TEXTS_SQL + f" SELECT source_id, sha256({strip_sql('regexp_replace(content, ' + chr(39) + '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]' + chr(39) + ', ' + chr(39) * 2 + ', ' + chr(39) + 'g' + chr(39) + ')')}) AS digest FROM texts")
def clean_text(spark, sf_dir):
    return texts(spark, sf_dir).select("source_id", F.sha2(formats.clean(F.col("content")), 256).alias("digest"))


@query("empty_body_guard", TEXTS_SQL + f" SELECT source_id, 'EMPTY_BODY' AS reason_code FROM texts WHERE {strip_sql('content')} = ''")
def empty_body_guard(spark, sf_dir):
    return texts(spark, sf_dir).where(formats.stripped(F.col("content")) == "").select("source_id", F.lit("EMPTY_BODY").alias("reason_code"))


@query("passage_prefix", TEXTS_SQL + " SELECT source_id, sha256('passage: ' || regexp_replace(regexp_replace(content, '(?i)^(?:\\s*passage:\\s*)+', ''), '^ +', '')) AS digest FROM texts")
def passage_prefix(spark, sf_dir):
    return texts(spark, sf_dir).select("source_id", F.sha2(text.passage(F.col("content")), 256).alias("digest"))


@query("excerpts", TEXTS_SQL + ", c AS (SELECT source_id, trim(regexp_replace(content, '\\s+', ' ', 'g'), ' ') AS t FROM texts) SELECT source_id, CASE WHEN len(t) > 110 THEN substr(t, 1, 110) || '…' ELSE t END AS excerpt FROM c")
def excerpts(spark, sf_dir):
    return texts(spark, sf_dir).select("source_id", text.excerpt(F.col("content")).alias("excerpt"))


@query("token_counts", TEXTS_SQL + " SELECT source_id, CAST(len(regexp_extract_all(content, '\\S+')) AS BIGINT) AS tokens, CAST(len(content) AS BIGINT) AS characters FROM texts")
def token_counts(spark, sf_dir):
    return texts(spark, sf_dir).select("source_id", F.regexp_count("content", F.lit(r"\S+")).cast("long").alias("tokens"), F.length("content").cast("long").alias("characters"))


@query("collection_names", f"WITH {cte('fx_projects')} SELECT project_id, substr(regexp_replace(regexp_replace(lower(trim('Team Docs! ' || owner)), '[^a-z0-9_-]+', '-', 'g'), '^[-_]+|[-_]+$', '', 'g'), 1, 48) || '-' || substr(regexp_replace(regexp_replace(lower(trim(project_id)), '[^a-z0-9_-]+', '-', 'g'), '^[-_]+|[-_]+$', '', 'g'), 1, 32) || '-' || substr(sha256(project_id), 1, 12) AS collection FROM fx_projects")
def collection_names(spark, sf_dir):
    return frame(spark, "fx_projects", sf_dir).select("project_id", text.collection_name(F.concat(F.lit("Team Docs! "), "owner"), F.col("project_id")).alias("collection"))


#: Globs, and what each lets through in SQL, by a path without its outer slashes (p) and its parts (ps).
GLOBS = {
    "**/project-documentation/**": "list_contains(ps, 'project-documentation')", "**/*.docx": "ends_with(p, '.docx')", "*.kt": "len(ps) = 1 AND ends_with(p, '.kt')", "src/**/*.kt": "ps[1] = 'src' AND len(ps) > 1 AND ends_with(p, '.kt')",
    "a/?/c.txt": "len(ps) = 3 AND ps[1] = 'a' AND len(ps[2]) = 1 AND ps[3] = 'c.txt'", "docs/*.md": "len(ps) = 2 AND ps[1] = 'docs' AND ends_with(p, '.md')", "docs/**": "ps[1] = 'docs'", "a.b.*": "len(ps) = 1 AND starts_with(p, 'a.b.')",
}


@query("glob_filter", f"WITH {cte('fx_globs')}, g AS (SELECT path, trim(path, '/') AS p FROM fx_globs), s AS (SELECT path, p, string_split(p, '/') AS ps FROM g) " + " UNION ALL ".join(f"SELECT path, '{glob}' AS pattern, {hit} AS matched FROM s" for glob, hit in GLOBS.items()))
def glob_filter(spark, sf_dir):
    """A path of each document against every glob."""
    found = F.array(*(F.struct(F.lit(g).alias("pattern"), paths.matches_glob(F.col("path"), g).alias("matched")) for g in GLOBS))
    return frame(spark, "fx_globs", sf_dir).select("path", F.inline(found))


#: What the kinds of files are, stated anew: the last part of a path, and its extension.
KIND_SQL = """, nm AS (SELECT *, list_extract(string_split(path, '/'), -1) AS name FROM {0}), ex AS (SELECT *, CASE WHEN contains(substr(name, 2), '.') AND NOT ends_with(name, '.') THEN '.' || lower(list_extract(string_split(name, '.'), -1)) ELSE '' END AS suffix FROM nm),
kd AS (SELECT *, CASE WHEN suffix IN ('.zip', '.7z', '.rar', '.tar', '.gz', '.jar', '.iso', '.dmg', '.exe', '.dll', '.com', '.bat', '.cmd', '.msi', '.scr', '.vbs', '.jsm', '.docm', '.xlsm', '.pptm') THEN 'blocked' WHEN suffix IN ('.pdf', '.docx', '.pptx', '.xlsx') THEN 'binary'
 WHEN suffix IN ('.md', '.markdown', '.txt', '.csv', '.html', '.htm', '.xml', '.yaml', '.yml', '.sql', '.py', '.js', '.ts', '.tsx', '.java', '.kt', '.kts') THEN 'text' WHEN suffix IN ('.png', '.jpg', '.jpeg', '.webp') THEN 'visual' ELSE 'other' END AS kind FROM ex)"""


@query("path_guard", f"WITH {cte('fx_paths')}{KIND_SQL.format('fx_paths')}" + r""", n AS (SELECT *, string_split(replace(lower(path), '\', '/'), '/') AS parts FROM kd)
SELECT path, kind, starts_with(parts[-1], '.env') OR regexp_matches(parts[-1], '\.(pem|key|p12|pfx)$') OR list_has_any(parts, ['node_modules', 'vendor', '.gradle', 'build', 'dist', 'secrets']) AS sensitive FROM n""")
def path_guard(spark, sf_dir):
    return frame(spark, "fx_paths", sf_dir).select("path", paths.kind_of_file(F.col("path")).alias("kind"), paths.is_sensitive(F.col("path")).alias("sensitive"))


@query("file_kinds", views.BASE_SQL + KIND_SQL.format("src") + " SELECT kind, suffix, count(*) AS files FROM kd GROUP BY 1, 2")
def file_kinds(spark, sf_dir):
    return views.source_documents(spark, sf_dir).groupBy(paths.kind_of_file(F.col("path")).alias("kind"), paths.suffix(F.col("path")).alias("suffix")).agg(F.count(F.lit(1)).alias("files"))


@query("link_kinds", """WITH u AS (SELECT doc_id, ['https://github.com/acme/' || source || '/issues/' || doc_id, 'https://github.com/acme/' || source || '/pull/' || doc_id, 'https://github.com/acme/' || source || '/commit/' || substr(sha256(text), 1, 12), 'https://github.com/acme/' || source,
 'https://example.org/acme/' || source || '/pull/' || doc_id, '/wiki/spaces/' || lang || '/' || doc_id, '/download/' || source || '.png', 'page:' || doc_id, 'page:' || lang][doc_id % 9 + 1] AS url FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL)
SELECT doc_id, url, ['GITHUB_ISSUE', 'GITHUB_PR', 'GITHUB_COMMIT', 'REMOTE_LINK', 'REMOTE_LINK', 'REMOTE_LINK', 'REMOTE_LINK', 'REMOTE_LINK', 'REMOTE_LINK'][doc_id % 9 + 1] AS kind,
 CASE WHEN doc_id % 9 < 5 THEN url WHEN doc_id % 9 = 5 THEN 'https://site' || url ELSE 'https://site/wiki' || url END AS resolved, CASE WHEN doc_id % 9 = 7 THEN CAST(doc_id AS INTEGER) END AS page FROM u""")
def link_kinds(spark, sf_dir):
    d = views.table(spark, sf_dir, "documents").where("text is not null and lang is not null and source is not null")
    hub = lambda *rest: F.concat(F.lit("https://github.com/acme/"), "source", *rest)
    urls = F.array(
        hub(F.lit("/issues/"), F.col("doc_id")), hub(F.lit("/pull/"), F.col("doc_id")), hub(F.lit("/commit/"), F.substring(F.sha2("text", 256), 1, 12)), hub(), F.concat(F.lit("https://example.org/acme/"), "source", F.lit("/pull/"), "doc_id"),
        F.concat(F.lit("/wiki/spaces/"), "lang", F.lit("/"), "doc_id"), F.concat(F.lit("/download/"), "source", F.lit(".png")), F.concat(F.lit("page:"), "doc_id"), F.concat(F.lit("page:"), "lang"),
    )
    url = F.col("url")
    rows = d.select("doc_id", F.element_at(urls, (F.col("doc_id") % 9 + 1).cast("int")).alias("url"))
    return rows.select("doc_id", "url", text.link_kind(url).alias("kind"), text.absolute_link(F.lit("https://site"), url).alias("resolved"), text.page_of(url).alias("page"))


@query("image_targets", TEXTS_SQL + f""", t AS (SELECT source_id, unnest(regexp_extract_all(content, '!\\[[^\\]]*\\]\\(([^)]+)\\)', 1)) AS target FROM texts)
SELECT source_id, target, target = '' OR regexp_matches(lower(target), '^(http://|https://|data:|file:|javascript:)') OR starts_with(target, '/') OR list_contains(string_split(target, '/'), '..') OR ends_with(lower(target), '.svg') AS unsafe FROM t""")
def image_targets(spark, sf_dir):
    t = texts(spark, sf_dir).select("source_id", F.explode(F.regexp_extract_all("content", F.lit(text.MARKDOWN_IMAGE), F.lit(1))).alias("target"))
    return t.withColumn("unsafe", text.unsafe_target(F.col("target")))


@query("diagram_edges", TEXTS_SQL + f""", d AS (SELECT source_id, array_to_string(regexp_extract_all(content, '(?is)```\\s*mermaid\\s*\\n(.*?)```', 1), chr(10)) AS d FROM texts),
e AS (SELECT source_id, unnest(range(len(a))) AS i, a, la, b, lb FROM (SELECT source_id, {', '.join(f"regexp_extract_all(d, '([A-Za-z][\\w-]*)(?:\\s*\\[([^\\]]+)\\])?\\s*(?:-->|==>|-\\.->)\\s*([A-Za-z][\\w-]*)(?:\\s*\\[([^\\]]+)\\])?', {n}) AS {c}" for n, c in ((1, 'a'), (2, 'la'), (3, 'b'), (4, 'lb')))} FROM d WHERE d <> ''))
SELECT source_id, CAST(i AS INTEGER) AS ordinal, a[i + 1] AS from_node, nullif(la[i + 1], '') AS from_label, b[i + 1] AS to_node, nullif(lb[i + 1], '') AS to_label FROM e WHERE i < 30""")
def diagram_edges(spark, sf_dir):
    return visuals.diagram_edges(texts(spark, sf_dir))


def _diagrams(spark, sf_dir):
    """A diagram of each document, of as many nodes as its number says: each node leads to its double, the one behind that, and the third next."""
    d, n = views.table(spark, sf_dir, "documents"), (F.col("doc_id") % 8 + 3).cast("int")
    nodes = F.sequence(F.lit(1), n)
    lines = F.flatten(F.transform(nodes, lambda k: F.transform(F.filter(F.array(k * 2, k * 2 + 1, k + 3), lambda t: t <= n), lambda t: F.concat(F.lit("n"), k, F.lit(" --> n"), t))))
    return d.select(F.concat(F.lit("doc:"), "doc_id").alias("source_id"), F.concat(F.lit("```mermaid\ngraph TD\n"), F.array_join(lines, "\n"), F.lit("\n```")).alias("content"))


@query("diagram_layers", """WITH RECURSIVE k AS (SELECT doc_id, doc_id % 8 + 3 AS n, unnest(range(1, doc_id % 8 + 4)) AS a FROM documents),
e AS (SELECT DISTINCT doc_id, a, b FROM (SELECT doc_id, n, a, unnest([a * 2, a * 2 + 1, a + 3]) AS b FROM k) WHERE b <= n),
w(doc_id, node, depth) AS (SELECT DISTINCT doc_id, a, 0 FROM e WHERE NOT EXISTS (SELECT 1 FROM e AS f WHERE f.doc_id = e.doc_id AND f.b = e.a) UNION SELECT e.doc_id, e.b, depth + 1 FROM w JOIN e ON e.doc_id = w.doc_id AND e.a = w.node)
SELECT 'doc:' || doc_id AS source_id, 'n' || node AS node, CAST(max(depth) AS INTEGER) AS layer FROM w GROUP BY doc_id, node""")
def diagram_layers(spark, sf_dir):
    from docweir.operators.drawings import drawn

    return drawn(_diagrams(spark, sf_dir)).select("source_id", F.explode("layers").alias("node", "layer"))


_SYMBOL_SQL = f"regexp_extract_all(content, '(?m)^\\s*(?:async\\s+)?(?:(?:public|private|protected|internal|open|abstract|sealed|data|enum|annotation|value|inline|tailrec|suspend|operator|infix|override|actual|expect|final|external)\\s+)*(?:class|interface|object|def|fun|function)\\s+([A-Za-z_][A-Za-z0-9_]*)', 1)"


@query("searchable_metadata", views.BASE_SQL + f""", i AS (SELECT *, 'KEY-' || doc_id AS issue_key, list_filter(list_distinct_ordered, lambda x: x <> '') AS symbols FROM (SELECT *, list_transform(list_filter(list_zip(ss, range(len(ss))), lambda z: list_position(ss, z[1]) = z[2] + 1), lambda z: z[1]) AS list_distinct_ordered FROM (SELECT *, {_SYMBOL_SQL} AS ss FROM src))),
w AS (SELECT *, concat_ws(chr(10), title, source_type, path, scope, 'main', issue_key, array_to_string(symbols, chr(10)), CASE WHEN provider = 'JIRA' THEN '' ELSE content END) AS joined FROM i),
k AS (SELECT source_id, j, ks[j] AS kw, row_number() OVER (PARTITION BY source_id, lower(ks[j]) ORDER BY j) AS nth FROM (SELECT source_id, ks, unnest(range(1, len(ks) + 1)) AS j FROM (SELECT source_id, regexp_extract_all(joined, '[A-Za-z0-9][A-Za-z0-9_./:#-]{{2,}}') AS ks FROM w WHERE provider <> 'JIRA'))),
f AS (SELECT source_id, string_agg(kw, ' ' ORDER BY j) AS kws FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY j) AS place FROM k WHERE nth = 1) WHERE place <= 32 GROUP BY source_id)
SELECT source_id, scope AS repository, 'main' AS branch, path, list_extract(string_split(path, '/'), -1) AS file_name, issue_key, '' AS project_key, '' AS symbol, array_to_string(symbols, ',') AS symbols, coalesce(kws, '') AS important_kwd,
 source_type AS chunk_kind, CAST(len(content) AS BIGINT) AS chunk_char_count, CAST(len(regexp_extract_all(content, '\\S+')) AS BIGINT) AS chunk_token_count FROM w LEFT JOIN f USING (source_id)""")
def searchable_metadata(spark, sf_dir):
    s = views.source_documents(spark, sf_dir).withColumns({"repository": F.col("scope"), "branch": F.lit("main"), "issue_key": F.concat(F.lit("KEY-"), "doc_id"), "kind": F.col("source_type")})
    out = text.with_searchable(s).select("source_id", "searchable.*")
    return out.withColumns({"symbols": F.concat_ws(",", "symbols"), "important_kwd": F.concat_ws(" ", "important_kwd")})


@query("glossary_terms", TEXTS_SQL + f""", l AS (SELECT source_id, unnest(regexp_split_to_array(content, {NEWLINE_SQL})) AS line FROM texts)
SELECT source_id, regexp_extract(trim(line, ' '), '(?i)^([\\w][\\w /-]{{1,50}})\\s+(?:means|significa|se define como)\\s+(.{{10,}})$', 1) AS term, regexp_extract(trim(line, ' '), '(?i)^([\\w][\\w /-]{{1,50}})\\s+(?:means|significa|se define como)\\s+(.{{10,}})$', 2) AS meaning FROM l WHERE regexp_matches(trim(line, ' '), '(?i)^([\\w][\\w /-]{{1,50}})\\s+(?:means|significa|se define como)\\s+(.{{10,}})$')""")
def glossary_terms(spark, sf_dir):
    l = texts(spark, sf_dir).select("source_id", F.explode(formats.lines(F.col("content"))).alias("line")).withColumn("line", F.trim("line"))
    return l.where(F.col("line").rlike(text.GLOSSARY)).select("source_id", F.regexp_extract("line", text.GLOSSARY, 1).alias("term"), F.regexp_extract("line", text.GLOSSARY, 2).alias("meaning"))


@query("metadata_context", views.BASE_SQL + """ SELECT source_id, concat_ws(chr(10), 'PATH: ' || path, 'FILE: ' || list_extract(string_split(path, '/'), -1), CASE WHEN provider = 'JIRA' THEN 'ISSUE: ' || space_key END) AS context FROM src""")
def metadata_context(spark, sf_dir):
    fields = {"PATH": F.col("path"), "FILE": F.element_at(F.split("path", "/"), -1), "ISSUE": F.when(F.col("provider") == "JIRA", F.col("space_key"))}
    return views.source_documents(spark, sf_dir).select("source_id", text.metadata_context(fields).alias("context"))


_N = "len(regexp_extract_all({}, '\\S+'))"


@query("embedding_text_fit", views.BASE_SQL + f""", p AS (SELECT source_id, 'passage: ' || title AS req, 'SOURCE TYPE: ' || source_type AS o1, 'REFERENCE: ' || path AS o2, 'LOCATION: source' AS o3, content FROM src),
v AS (SELECT source_id, concat_ws(chr(10), req, o1, o2, o3, nullif(content, '')) AS a, concat_ws(chr(10), req, o1, o2, nullif(content, '')) AS b, concat_ws(chr(10), req, o1, nullif(content, '')) AS c, concat_ws(chr(10), req, nullif(content, '')) AS d FROM p)
SELECT source_id, sha256(CASE WHEN {_N.format('a')} <= 300 THEN a WHEN {_N.format('b')} <= 300 THEN b WHEN {_N.format('c')} <= 300 THEN c ELSE d END) AS digest FROM v""")
def embedding_text_fit(spark, sf_dir):
    s = views.source_documents(spark, sf_dir)
    optional = [F.concat(F.lit("SOURCE TYPE: "), "source_type"), F.concat(F.lit("REFERENCE: "), "path"), F.lit("LOCATION: source")]
    return s.select("source_id", F.sha2(text.fitted(F.concat(F.lit("passage: "), "title"), optional, F.col("content"), 300), 256).alias("digest"))
