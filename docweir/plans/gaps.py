"""Queries of references, leases, and smaller projections."""

from __future__ import annotations

import io
import re
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweir.functions import ooxml, paths, richtext, text
from docweir.functions.batches import per_row
from docweir.operators import audits, generation, issues, references, routing
from docweir.plans.fixtures import cte, frame
from docweir.plans.quality import STORED_SQL, stored
from docweir.plans.registry import query
from docweir.shared import work_dir
from docweir.sources import local, views


LEASES_SQL = """WITH l AS (SELECT 'user:' || user_id AS scope, arg_max(event_type, ts) AS owner, max(ts) + INTERVAL 2 DAY AS expires_at FROM events WHERE event_id % 3 = 0 GROUP BY user_id),
r AS (SELECT event_id, 'user:' || user_id AS scope, event_type AS requester, ts AS asked_at FROM events WHERE event_id % 3 = 1),
j AS (SELECT r.*, owner, expires_at FROM r LEFT JOIN l USING (scope)),
w AS (SELECT scope, asked_at AS first_at, requester AS first_by FROM (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY asked_at, requester) AS n FROM j WHERE owner IS NULL OR owner = requester OR expires_at <= asked_at) WHERE n = 1),
d AS (SELECT j.*, CASE WHEN first_by IS NULL OR requester <> first_by OR asked_at < first_at THEN 'held' WHEN asked_at > first_at THEN 'renewed' WHEN owner IS NULL THEN 'granted' WHEN owner = requester THEN 'renewed' ELSE 'taken over' END AS decision FROM j LEFT JOIN w USING (scope))
"""


def _lease_requests(spark, sf_dir):
    """Leases that a third of the events left behind, and another third that asks."""
    e = views.table(spark, sf_dir, "events").withColumn("scope", F.concat(F.lit("user:"), "user_id"))
    held = e.where("event_id % 3 = 0").groupBy("scope").agg(F.max_by("event_type", "ts").alias("owner"), (F.max("ts") + F.expr("INTERVAL 2 DAYS")).alias("expires_at"))
    return held, e.where("event_id % 3 = 1").select("event_id", "scope", F.col("event_type").alias("requester"), F.col("ts").alias("asked_at"))


@query("lease_decisions", LEASES_SQL + "SELECT event_id, scope, requester, asked_at, decision FROM d")
def lease_decisions(spark, sf_dir):
    from docweir.streaming.leases import decide

    return decide(*_lease_requests(spark, sf_dir))


@query("lease_table", LEASES_SQL + """, g AS (SELECT scope, requester AS owner, max(asked_at) + INTERVAL 900 SECOND AS expires_at FROM d WHERE decision <> 'held' GROUP BY ALL)
SELECT scope, owner, expires_at FROM g UNION ALL SELECT scope, owner, expires_at FROM l WHERE scope NOT IN (SELECT scope FROM g)""")
def lease_table(spark, sf_dir):
    """What a store holds after leases were acquired by comparing and swapping, and the same batch came again."""
    from docweir.shared import work_dir
    from docweir.streaming import ingest

    held, requests = _lease_requests(spark, sf_dir)
    store = ingest.Store(spark, work_dir(spark, "leases"))
    store.leases.replace(held, 0, "before")
    ingest.acquire(store, requests, 0, "here")
    ingest.acquire(store, requests, 0, "here")
    return store.leases.read()


@query("pinned_references", """WITH d AS (SELECT doc_id, coalesce(source, 'none') AS source, sha256(coalesce(text, '')) AS digest, coalesce(n_chars, 0) * 100 AS size FROM documents),
c AS (SELECT doc_id, source, 'src/f' || doc_id || '.md' AS path, doc_id AS target FROM d UNION ALL SELECT doc_id, source, 'src/../f' || doc_id || '.md', NULL FROM d WHERE doc_id % 4 = 1)
SELECT CASE WHEN c.doc_id % 11 = 3 THEN 'OTHER' ELSE 'DEMO' END AS project_id, 'doc:' || c.doc_id AS source_id, 'acme/' || c.source AS repository, path,
 CASE WHEN target IS NULL THEN 'invalid path' WHEN c.doc_id % 3 = 0 THEN 'not pinned' WHEN c.doc_id % 11 = 3 THEN 'another project''s' WHEN c.doc_id % 7 = 1 THEN 'unavailable' WHEN size > 4000000 THEN 'too large' WHEN c.doc_id % 5 = 2 THEN 'content differs' END AS reason FROM c JOIN d USING (doc_id)""")
def pinned_references(spark, sf_dir):
    """Every document cites itself in a repository; some pins, files or contents are missing or differ."""
    d, i = views.table(spark, sf_dir, "documents").withColumn("source", F.coalesce("source", F.lit("none"))), F.col("doc_id")
    sha, digest, repository = F.repeat(F.lit("0a"), 20), F.sha2(F.coalesce("text", F.lit("")), 256), F.concat(F.lit("acme/"), "source")
    path = F.concat(F.lit("src/f"), i, F.lit(".md"))
    link = lambda p: F.concat(F.lit("see https://github.com/"), repository, F.lit("/blob/"), sha, F.lit("/"), p, F.lit(" "))
    docs = d.select(F.when(i % 11 == 3, "OTHER").otherwise("DEMO").alias("project_id"), F.concat(F.lit("doc:"), i).alias("source_id"), F.concat(link(path), link(path), F.when(i % 4 == 1, link(F.concat(F.lit("src/../f"), i, F.lit(".md")))).otherwise("")).alias("content"))
    pins = d.where(i % 3 != 0).select(F.lit("DEMO").alias("project_id"), repository.alias("repository"), sha.alias("sha"), path.alias("path"), digest.alias("digest"))
    files = d.where(i % 7 != 1).select(repository.alias("repository"), path.alias("path"), F.when(i % 5 == 2, F.sha2(digest, 256)).otherwise(digest).alias("digest"), (F.coalesce("n_chars", F.lit(0)) * 100).alias("size"))
    return references.pinned(docs, pins, files)


@query("linked_versions", views.BASE_SQL + """, s AS (SELECT source_id, version, list_sort(CASE doc_id % 3 WHEN 0 THEN [] WHEN 1 THEN [content_hash] ELSE [version, content_hash, scope] END) AS shas FROM src)
SELECT source_id, CASE WHEN len(shas) > 0 THEN sha256(version || '|' || array_to_string(shas, '|')) ELSE version END AS version FROM s""")
def linked_versions(spark, sf_dir):
    """Versions of documents that change with their linked pictures."""
    s = views.source_documents(spark, sf_dir)
    shas = F.when(F.col("doc_id") % 3 == 0, F.array().cast("array<string>")).when(F.col("doc_id") % 3 == 1, F.array("content_hash")).otherwise(F.array("version", "content_hash", "scope"))
    return s.select("source_id", references.linked_version(F.col("version"), shas).alias("version"))


@query("jira_storage_ids", STORED_SQL + "SELECT source_id, ordinal, CASE WHEN provider = 'JIRA' THEN sha256(chunk_id || '|' || version) ELSE sha256(project_id || '|' || provider || '|' || source_id || '|' || ordinal) END AS storage_id FROM sx")
def jira_storage_ids(spark, sf_dir):
    """Records are known by source and ordinal, those of issues by chunk and version."""
    return stored(spark, sf_dir).select("source_id", "ordinal", F.when(F.col("provider") == "JIRA", generation.jira_storage_id()).otherwise(generation.storage_id()).alias("storage_id"))


@query("jira_audit", STORED_SQL + """, j AS (SELECT * FROM sx WHERE provider = 'JIRA'),
n AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY ordinal) > 1 OR NOT starts_with(embedding_text, 'passage: ') OR NOT ends_with(embedding_text, body) OR tokens > 512 OR access_policy_id = '' OR issue_key IS NULL AS bad FROM j)
SELECT doc_category AS kind, language, count(*) AS chunks, count(DISTINCT source_id) AS issues, min(tokens) AS least, median(tokens) AS median, max(tokens) AS most, count(*) FILTER (bad) AS defects, count(*) FILTER (bad) = 0 AS passed FROM n GROUP BY doc_category, language""")
def jira_audit(spark, sf_dir):
    j = stored(spark, sf_dir).where("provider = 'JIRA'").withColumn("kind", F.col("doc_category"))
    return audits.summary(j, ["kind", "language"])


@query("linked_images", """WITH d AS (SELECT 'doc:' || doc_id AS source_id, doc_id, coalesce(source, 'none') AS folder FROM documents)
SELECT source_id, folder || '/img/' || doc_id || '.png' AS image, CASE WHEN doc_id % 3 = 0 THEN sha256(CAST(doc_id AS VARCHAR)) END AS sha FROM d
UNION ALL SELECT source_id, 'shared/' || doc_id % 7 || '.JPG', CASE WHEN doc_id % 7 = 2 THEN 'seven' END FROM d WHERE doc_id % 2 = 1""")
def linked_images(spark, sf_dir):
    """Pictures of each document: one of its own beside it, some named from the folder above, one that climbs out, and one that is remote."""
    d = views.table(spark, sf_dir, "documents").select("doc_id", F.coalesce("source", F.lit("none")).alias("folder"))
    climbs = F.when(F.col("doc_id") % 2 == 1, F.concat(F.lit("![s](./x/./"), F.col("doc_id") % 7, F.lit(".JPG)"))).otherwise("")
    content = F.concat(F.lit("![a](img/"), "doc_id", F.lit(".png) ![b](http://x/b.png) ![c](../../up.png) ![d](d.svg) "))
    own = d.select(F.concat(F.lit("doc:"), "doc_id").alias("source_id"), F.concat("folder", F.lit("/page.md")).alias("path"), content.alias("content"))
    shared = d.select(F.concat(F.lit("doc:"), "doc_id").alias("source_id"), F.lit("index.md").alias("path"), F.replace(climbs, F.lit("./x/./"), F.lit("./shared/./")).alias("content"))
    listing = d.where("doc_id % 3 = 0").select(F.concat("folder", F.lit("/img/"), "doc_id", F.lit(".png")).alias("path"), F.sha2(F.col("doc_id").cast("string"), 256).alias("sha"))
    return references.linked_images(own.unionByName(shared), listing.unionByName(spark.createDataFrame([("shared/2.JPG", "seven")], "path string, sha string")))


@query("blob_text", "SELECT 'b' || doc_id AS name, CASE doc_id % 5 WHEN 3 THEN NULL WHEN 4 THEN '' ELSE coalesce(text, '') END AS text FROM documents")
def blob_text(spark, sf_dir):
    """Every document as the base64 lines that a repository delivers; some aren't UTF-8, some are empty."""
    d = views.table(spark, sf_dir, "documents")
    body = F.coalesce("text", F.lit("")).cast("binary")
    bad = F.concat(F.unhex(F.lit("FFFE")), body)
    k = F.col("doc_id") % 5
    lines = F.regexp_replace(F.base64(F.when(k == 3, bad).when(k == 4, F.lit(b"")).otherwise(body)), "(.{60})", "$1\n")
    return d.select(F.concat(F.lit("b"), "doc_id").alias("name"), text.blob(lines).alias("text"))


@query("effective_chunkers", views.BASE_SQL + f" SELECT provider, CASE WHEN provider = 'JIRA' THEN chunker_version || '.jira-context-v3' ELSE chunker_version END AS chunker, count(*) AS sources FROM src GROUP BY 1, 2")
def effective_chunkers(spark, sf_dir):
    return views.source_documents(spark, sf_dir).groupBy("provider", routing.effective_chunker(F.col("chunker_version"), F.col("provider")).alias("chunker")).agg(F.count(F.lit(1)).alias("sources"))


@query("staging_rows", STORED_SQL + "SELECT chunk_id, provider FROM sx WHERE provider <> 'JIRA' AND source_type <> 'SYSTEM'")
def staging_rows(spark, sf_dir):
    """A copy of what is stored of all providers but one, with fingerprints before and after."""
    rows = stored(spark, sf_dir).where("provider <> 'JIRA' and source_type <> 'SYSTEM'").select("chunk_id", "provider", "body", "version")
    return audits.cloned(rows, f"{work_dir(spark, 'staging')}/rows", "chunk_id", ["provider", "body", "version"]).select("chunk_id", "provider")


@query("obsolete_policies", STORED_SQL + ", old AS (SELECT unnest(['project:DEMO', 'department:DEMO:GONE']) AS access_policy_id) SELECT access_policy_id FROM old EXCEPT SELECT access_policy_id FROM sx WHERE access_policy_id <> ''")
def obsolete_policies(spark, sf_dir):
    old = spark.createDataFrame([("project:DEMO",), ("department:DEMO:GONE",)], "access_policy_id string")
    return old.join(stored(spark, sf_dir).where("access_policy_id <> ''").select("access_policy_id").distinct(), "access_policy_id", "left_anti")


@query("finding_examples", STORED_SQL + ", n AS (SELECT provider, chunk_id, row_number() OVER (PARTITION BY provider ORDER BY chunk_id) AS nth FROM sx WHERE tokens > 512) SELECT provider, chunk_id FROM n WHERE nth <= 3")
def finding_examples(spark, sf_dir):
    from pyspark.sql import Window as W

    nth = F.row_number().over(W.partitionBy("provider").orderBy("chunk_id"))
    return stored(spark, sf_dir).where("tokens > 512").withColumn("nth", nth).where("nth <= 3").select("provider", "chunk_id")


@query("canary_summary", STORED_SQL + "SELECT source_type AS kind, count(*) AS chunks, min(len(body)) AS least, max(len(body)) AS most, median(len(body)) AS median, count(*) FILTER (len(body) < 3) AS noise FROM sx GROUP BY source_type")
def canary_summary(spark, sf_dir):
    return audits.kinds(stored(spark, sf_dir), "source_type", r"(?s)^.{0,2}$").drop("sources")


@query("changed_pages", views.BASE_SQL + """, p AS (SELECT source_id, 'page' AS kind, updated_at FROM src WHERE provider = 'CONFLUENCE'), a AS (SELECT 'attachment:' || source_id AS source_id, 'attachment' AS kind, updated_at + INTERVAL 3 HOUR AS updated_at FROM src WHERE provider = 'CONFLUENCE' AND doc_id % 4 = 0)
SELECT source_id, kind FROM (SELECT * FROM p UNION ALL SELECT * FROM a) WHERE updated_at IS NULL OR updated_at >= TIMESTAMP '2024-01-01 09:00:00'""")
def changed_pages(spark, sf_dir):
    """Attachments are looked at on their own time, whether or not their page changed."""
    s = views.source_documents(spark, sf_dir).where("provider = 'CONFLUENCE'")
    pages = s.select("source_id", F.lit("page").alias("kind"), "updated_at")
    attached = s.where("doc_id % 4 = 0").select(F.concat(F.lit("attachment:"), "source_id").alias("source_id"), F.lit("attachment").alias("kind"), (F.col("updated_at") + F.expr("INTERVAL 3 HOURS")).alias("updated_at"))
    both = pages.unionByName(attached)
    return both.where(paths.changed_since(F.col("updated_at"), F.lit("2024-01-01 09:00:00").cast("timestamp"))).select("source_id", "kind")


@query("issue_states", f"""WITH {cte('fx_issues')}, j AS (SELECT issue_key, CAST(fields_json AS JSON) AS f FROM fx_issues) SELECT issue_key, f->>'$.parent.key' AS parent_key, f->>'$.parent.id' AS parent_id, TRY_CAST(f->>'$.parent.id' AS BIGINT) AS parent_number, CAST(json_array_length(f->'$.subtasks') AS INTEGER) AS subtasks FROM j""")
def issue_states(spark, sf_dir):
    get = lambda path: F.get_json_object("fields_json", path)
    return frame(spark, "fx_issues", sf_dir).select("issue_key", get("$.parent.key").alias("parent_key"), get("$.parent.id").alias("parent_id"), get("$.parent.id").try_cast("long").alias("parent_number"), F.json_array_length(get("$.subtasks")).alias("subtasks"))


def _searchable(spark, sf_dir):
    s = views.source_documents(spark, sf_dir).withColumns({"repository": F.col("scope"), "issue_key": F.when(F.col("provider") == "JIRA", F.concat(F.lit("KEY-"), "doc_id")), "content": F.lit("")})
    return text.with_searchable(s.select("source_id", "provider", "path", "repository", "issue_key", "content"))


_RECORDS_SQL = """, r AS (SELECT source_id, list_filter([{'n': 'repository', 'v': scope}, {'n': 'path', 'v': path}, {'n': 'file_name', 'v': list_extract(string_split(path, '/'), -1)}, {'n': 'issue_key', 'v': 'KEY-' || doc_id}], lambda x: x.v <> '') AS rs FROM src WHERE provider = 'JIRA')"""


@query("length_prefixed_context", views.BASE_SQL + _RECORDS_SQL + " SELECT source_id, array_to_string(list_transform(rs, lambda x: x.n || ' ' || strlen(x.v) || chr(10) || x.v || chr(10)), '') AS context FROM r")
def length_prefixed_context(spark, sf_dir):
    """Values are framed by their byte counts, so that none can break out of its frame."""
    return _searchable(spark, sf_dir).where("provider = 'JIRA'").select("source_id", text.framed_context(F.col("searchable")).alias("context"))


@query("ordered_enrichment", views.BASE_SQL + _RECORDS_SQL + " SELECT source_id, array_to_string(list_transform(rs, lambda x: x.v), '|') AS enrichment FROM r")
def ordered_enrichment(spark, sf_dir):
    return _searchable(spark, sf_dir).where("provider = 'JIRA'").select("source_id", F.concat_ws("|", text.enrichment(F.col("searchable"))).alias("enrichment"))


@query("low_information_code", f"""WITH {cte('fx_code')}, c AS (SELECT name, body FROM fx_code UNION ALL SELECT 'doc:' || doc_id, coalesce(text, '') FROM documents),
l AS (SELECT name, body, list_filter(list_transform(regexp_split_to_array(body, '\\r\\n|\\n|\\r'), lambda x: trim(x, ' ' || chr(9))), lambda x: x <> '') AS ls FROM c)
SELECT name, len(list_filter(ls, lambda x: NOT regexp_matches(x, '^(@|package |import |//|/\\*|\\*)'))) = 0 OR (len(body) < 48 AND len(regexp_extract_all(body, '[A-Za-z_]\\w*')) <= 3) AS low FROM l""")
def low_information_code(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select(F.concat(F.lit("doc:"), "doc_id").alias("name"), F.coalesce("text", F.lit("")).alias("body"))
    return frame(spark, "fx_code", sf_dir).unionByName(docs).select("name", text.low_information_code(F.col("body")).alias("low"))


@query("torn_reads", views.BASE_SQL + " SELECT source_id AS issue_key, CASE WHEN doc_id % 13 = 0 THEN 'not read' ELSE 'changed meanwhile' END AS fault FROM src WHERE provider = 'JIRA' AND updated_at IS NOT NULL AND (doc_id % 13 = 0 OR doc_id % 11 = 0)")
def torn_reads(spark, sf_dir):
    s = views.source_documents(spark, sf_dir).where("provider = 'JIRA' and updated_at is not null")
    read = s.where("doc_id % 13 <> 0").select(F.col("source_id").alias("issue_key"), (F.col("updated_at") + F.expr("make_interval(0, 0, 0, 0, CASE WHEN doc_id % 11 = 0 THEN 1 ELSE 0 END)")).alias("updated"))
    return issues.torn_reads(s.select(F.col("source_id").alias("issue_key"), F.col("updated_at").alias("updated")), read)


@query("image_sizes", f"WITH {cte('fx_images')} SELECT name, width >= 64 AND height >= 64 AND width * height >= 16384 AS meaningful FROM fx_images")
def image_sizes(spark, sf_dir):
    return frame(spark, "fx_images", sf_dir).select("name", references.is_meaningful(F.col("width"), F.col("height")).alias("meaningful"))


@query("prose_files", views.BASE_SQL + ", f AS (SELECT scope, path FROM src WHERE provider = 'GITHUB' UNION ALL SELECT scope, replace(path, '.csv', '.RST') FROM src WHERE provider = 'GITHUB' AND path LIKE '%.csv') SELECT scope, count(*) FILTER (regexp_matches(lower(path), '\\.(md|markdown|txt|rst|adoc|docx|pdf)$')) AS passed_over, count(*) AS files FROM f GROUP BY scope")
def prose_files(spark, sf_dir):
    s = views.source_documents(spark, sf_dir).where("provider = 'GITHUB'").select("scope", "path")
    s = s.unionByName(s.where(F.col("path").endswith(".csv")).withColumn("path", F.replace("path", F.lit(".csv"), F.lit(".RST"))))
    return s.groupBy("scope").agg(F.count_if(local.is_prose(F.col("path"))).alias("passed_over"), F.count(F.lit(1)).alias("files"))


@query("job_payloads", views.BASE_SQL + """ SELECT scope, '{"job_id":"' || scope || '","project_id":"' || min(project_id) || '"}' AS payload FROM src GROUP BY scope""")
def job_payloads(spark, sf_dir):
    s = views.source_documents(spark, sf_dir).groupBy("scope").agg(F.min("project_id").alias("project_id"))
    return s.select("scope", F.to_json(F.struct(F.col("scope").alias("job_id"), "project_id")).alias("payload"))


@query("manifest_truncation", views.BASE_SQL + " SELECT source_id, substr(repeat(title, 90), 1, 1000) AS title, substr(repeat(source_url, 60), 1, 1500) AS source_url, substr(repeat(version, 50), 1, 500) AS version FROM src")
def manifest_truncation(spark, sf_dir):
    s = views.source_documents(spark, sf_dir).select("source_id", F.repeat("title", 90).alias("title"), F.repeat("source_url", 60).alias("source_url"), F.repeat("version", 50).alias("version"))
    return routing.truncated(s)


@query("office_containers", """SELECT doc_id, CASE doc_id % 6 WHEN 1 THEN 'MIME_MISMATCH' WHEN 2 THEN 'MIME_MISMATCH' WHEN 4 THEN 'MACRO_CONTENT' WHEN 5 THEN 'MIME_MISMATCH' END AS reason_code FROM documents""")
def office_containers(spark, sf_dir):
    """Every document, with its whole text, as a Word body: as it is, under another Office name, cut off, under a name that isn't looked into, with macros, and no container at all."""
    s, k = views.source_documents(spark, sf_dir), F.col("doc_id") % 6
    suffix = F.when(k == 1, ".pptx").when(k == 3, ".txt").otherwise(".docx")
    body = _docx(F.coalesce("title", F.lit("")), F.regexp_replace("content", _NOT_XML, " "), F.coalesce("scope", F.lit("")), F.coalesce("space_key", F.lit("")), k == 4)
    rows = s.select("doc_id", suffix.alias("suffix"), F.when(k == 5, F.col("content").cast("binary")).when(k == 2, F.substring(body, 1, F.length(body) - 30)).otherwise(body).alias("body"))
    return rows.select("doc_id", richtext.container_reason("body", "suffix").alias("reason_code"))


@query("parsed_payloads", """SELECT 'doc:' || doc_id AS source_id, CAST(0 AS INTEGER) AS ordinal, CASE doc_id % 3 WHEN 0 THEN 'body' ELSE '' END AS locator, coalesce(text, '') AS text, CASE doc_id % 3 WHEN 1 THEN 'ValueError: ' || doc_id WHEN 2 THEN 'no parser' END AS warning FROM documents""")
def parsed_payloads(spark, sf_dir):
    """Every document's bytes through a parser that knows some kinds, fails at others, and has nothing to say of the rest."""

    def parser(body: bytes, path: str) -> list[tuple[str, str]] | None:
        number, kind = path.split(".")
        if kind == "bad":
            raise ValueError(number)
        return [("body", body.decode())] if kind == "ok" else None

    path = F.concat("doc_id", F.element_at(F.array(F.lit(".ok"), F.lit(".bad"), F.lit(".odd")), (F.col("doc_id") % 3 + 1).cast("int")))
    return references.parsed(views.source_documents(spark, sf_dir).select("source_id", path.alias("path"), F.col("content").cast("binary").alias("content_bytes")), parser)


def _word_body(head: str, body: str, source: str, lang: str, macros: bool) -> bytes:
    """A Word body: a heading, a paragraph for each line, and a table."""
    head, body, *cells = (escape(v) for v in (head, body, source, lang))
    par = lambda t, style="": f"<w:p><w:pPr><w:pStyle w:val='{style}'/></w:pPr><w:r><w:t xml:space='preserve'>{t}</w:t></w:r></w:p>"
    rows = "".join(f"<w:tc>{par(c)}</w:tc>" for c in cells)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        space = "xmlns:w='http://schemas.openxmlformats.org/wordprocessingml/2006/main'"
        archive.writestr("word/document.xml", f"<w:document {space}><w:body>{par(head, 'Top')}{''.join(map(par, re.split(chr(10) + '|' + chr(13), body)))}<w:tbl><w:tr>{rows}</w:tr></w:tbl></w:body></w:document>")
        archive.writestr("word/styles.xml", f"<w:styles {space}><w:style w:styleId='Top'><w:name w:val='heading 1'/></w:style></w:styles>")
        if macros:
            archive.writestr("word/vbaProject.bin", b"")
    return out.getvalue()


_docx = per_row(_word_body, T.BinaryType())

#: What XML can't hold in a text.
_NOT_XML = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x{fffe}\x{ffff}]"

#: White space of any kind, and what XML can't hold.
_SPACE = r"[\x{00}-\x{20}\x{7f}-\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{fffe}\x{ffff}]+"


@query("office_bodies", views.BASE_SQL + f""" SELECT source_id, sha256(regexp_replace('#' || title || content || '|' || scope || '|' || coalesce(space_key, '') || '||---|---|', '{_SPACE}', '', 'g')) AS digest FROM src""")
def office_bodies(spark, sf_dir):
    """Every document as a Word body, read back: heading, paragraphs and cells."""
    s = views.source_documents(spark, sf_dir)
    text = F.regexp_replace("content", _NOT_XML, " ")
    rows = s.select("source_id", F.lit("x.docx").alias("path"), _docx("title", text, "scope", F.coalesce("space_key", F.lit("")), F.lit(False)).alias("content_bytes"))
    read = references.parsed(rows, ooxml.read).groupBy("source_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "text"))), lambda r: r["text"]), "").alias("text"))
    return read.select("source_id", F.sha2(F.regexp_replace("text", _SPACE, ""), 256).alias("digest"))


def _raw_issues(spark, sf_dir):
    """The fixture's issues as JSON, and a comment of each with a conversation's first words."""
    rows = frame(spark, "fx_issues", sf_dir)
    return rows.select(F.concat(F.lit('{"key":"'), "issue_key", F.lit('","fields":'), "fields_json", F.lit(',"comments":[{"id":"c1","body":"seen","created":"2024"},{"id":"c2","body":"hidden","visibility":{"type":"role"}}]}')).alias("raw"))


@query("issue_windows")
def issue_windows(spark, sf_dir):
    from docweir.operators.issue_documents import issue_windows as run

    return run(_raw_issues(spark, sf_dir))


@query("issue_sections", f"""WITH {cte('fx_issues')}, j AS (SELECT issue_key, CAST(fields_json AS JSON) AS f FROM fx_issues), l AS (SELECT issue_key, unnest(CAST(f->'$.issuelinks' AS JSON[])) AS l FROM j)
SELECT issue_key, 'CURRENT' AS kind, 'current' AS locator FROM j UNION ALL SELECT issue_key, 'COMMENT', 'comment:c1' FROM j
UNION ALL SELECT issue_key, 'RELATIONSHIP', 'parent' FROM j WHERE json_type(f->'$.parent') = 'OBJECT'
UNION ALL SELECT issue_key, 'RELATIONSHIP', 'subtask:' || coalesce(s->>'$.id', s->>'$.key') FROM (SELECT issue_key, unnest(CAST(f->'$.subtasks' AS JSON[])) AS s FROM j)
UNION ALL SELECT issue_key, 'RELATIONSHIP', 'link:' || (l->>'$.id') || ':inward' FROM l WHERE (l->'$.inwardIssue') IS NOT NULL
UNION ALL SELECT issue_key, 'RELATIONSHIP', 'link:' || (l->>'$.id') || ':outward' FROM l WHERE (l->'$.outwardIssue') IS NOT NULL
UNION ALL SELECT issue_key, 'RELATIONSHIP', 'link:' || (l->>'$.id') FROM l WHERE (l->'$.inwardIssue') IS NULL AND (l->'$.outwardIssue') IS NULL""")
def issue_sections(spark, sf_dir):
    from docweir.operators.issue_documents import sections

    return sections(_raw_issues(spark, sf_dir)).select("issue_key", "kind", "locator")
