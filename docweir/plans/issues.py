"""Queries over issues, pages and what connectors deliver."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweir.functions import paths, richtext, text
from docweir.operators import issues, wiki
from docweir.plans.fixtures import cte, frame
from docweir.plans.registry import query
from docweir.sources import views

I, E = "fx_issues", "fx_events"


@query("relationship_edges", f"""WITH {cte(I)}, j AS (SELECT issue_key, CAST(fields_json AS JSON) AS f FROM fx_issues),
l AS (SELECT issue_key, unnest(CAST(f->'$.issuelinks' AS JSON[])) AS l FROM j)
SELECT issue_key, 'parent' AS locator, 'parent' AS relationship, f->>'$.parent.key' AS related_key FROM j WHERE json_type(f->'$.parent') = 'OBJECT'
UNION ALL SELECT issue_key, 'subtask:' || coalesce(s->>'$.id', s->>'$.key'), 'subtask', s->>'$.key' FROM (SELECT issue_key, unnest(CAST(f->'$.subtasks' AS JSON[])) AS s FROM j)
UNION ALL SELECT issue_key, 'link:' || (l->>'$.id') || ':inward', coalesce(l->>'$.type.inward', l->>'$.type.name', 'inward'), l->>'$.inwardIssue.key' FROM l WHERE (l->'$.inwardIssue') IS NOT NULL
UNION ALL SELECT issue_key, 'link:' || (l->>'$.id') || ':outward', coalesce(l->>'$.type.outward', l->>'$.type.name', 'outward'), l->>'$.outwardIssue.key' FROM l WHERE (l->'$.outwardIssue') IS NOT NULL
UNION ALL SELECT issue_key, 'link:' || (l->>'$.id'), coalesce(l->>'$.type.name', 'link'), NULL FROM l WHERE (l->'$.inwardIssue') IS NULL AND (l->'$.outwardIssue') IS NULL""")
def relationship_edges(spark, sf_dir):
    return issues.relationships(frame(spark, I, sf_dir))


@query("restricted_counts", f"""WITH {cte(I, E)}, h AS (SELECT issue_key, count(*) AS held FROM fx_events WHERE visibility IS NOT NULL GROUP BY issue_key)
SELECT project_key, count(*) AS issues, count(*) FILTER (security IS NOT NULL) AS restricted_issues, CAST(coalesce(sum(held), 0) AS BIGINT) AS restricted_events FROM fx_issues LEFT JOIN h USING (issue_key) GROUP BY project_key""")
def restricted_counts(spark, sf_dir):
    return issues.restricted_counts(frame(spark, I, sf_dir), frame(spark, E, sf_dir))


@query("attachment_sizes", f"""WITH {cte(I)}, a AS (SELECT issue_key, unnest(CAST(CAST(attachments_json AS JSON) AS JSON[])) AS a FROM fx_issues)
SELECT issue_key, a->>'$.id' AS attachment_id, CASE WHEN TRY_CAST(a->>'$.size' AS BIGINT) IS NULL THEN 'unknown size' WHEN TRY_CAST(a->>'$.size' AS BIGINT) > 26214400 THEN 'too large' ELSE 'read' END AS outcome FROM a""")
def attachment_sizes(spark, sf_dir):
    return issues.attachments(frame(spark, I, sf_dir))


@query("jira_richness_topk", f"""WITH {cte(I, E)} SELECT issue_key FROM fx_issues i ORDER BY coalesce(attachments_json, '[]') <> '[]' DESC, EXISTS (SELECT 1 FROM fx_events e WHERE e.issue_key = i.issue_key AND kind = 'COMMENT') DESC, (CAST(fields_json AS JSON)->>'$.parent.key') IS NOT NULL DESC, issue_key DESC LIMIT 3""")
def jira_richness_topk(spark, sf_dir):
    return issues.richest(frame(spark, I, sf_dir), frame(spark, E, sf_dir), 3).select("issue_key")


@query("issue_timelines", f"""WITH {cte(I, E)} SELECT issue_key, count(event_id) AS events, coalesce(string_agg(concat_ws(' ', kind, event_id, body), '; ' ORDER BY created, event_id), '') AS timeline FROM fx_issues LEFT JOIN (SELECT * FROM fx_events WHERE visibility IS NULL) USING (issue_key) GROUP BY issue_key""")
def issue_timelines(spark, sf_dir):
    return issues.timelines(frame(spark, I, sf_dir), frame(spark, E, sf_dir))


@query("issue_scan_order", f"WITH {cte(I)} SELECT issue_key, row_number() OVER (ORDER BY updated, issue_key) AS place FROM fx_issues WHERE project_key = 'SHOP' AND updated >= '2024-01-02 00:00'")
def issue_scan_order(spark, sf_dir):
    from pyspark.sql import Window as W

    rows = frame(spark, I, sf_dir).where("project_key = 'SHOP' and updated >= '2024-01-02 00:00'")
    return rows.select("issue_key", F.row_number().over(W.partitionBy("project_key").orderBy("updated", "issue_key")).cast("long").alias("place"))


@query("custom_field_names", f"WITH {cte('fx_custom', 'fx_names')} SELECT issue_key, field_id, value, coalesce(name, field_id) AS name FROM fx_custom LEFT JOIN fx_names USING (field_id)")
def custom_field_names(spark, sf_dir):
    return issues.custom_fields(frame(spark, "fx_custom", sf_dir), frame(spark, "fx_names")).select("issue_key", "field_id", "value", "name")


@query("page_faults", f"""WITH {cte('fx_listing')}, r AS (SELECT listing, min(total) AS lo, max(total) AS hi, count(*) AS rows, count(DISTINCT item_id) AS items FROM fx_listing GROUP BY listing)
SELECT listing, rows, items, CASE WHEN lo <> hi THEN 'total changed' WHEN items <> rows THEN 'repeated id' WHEN rows <> hi THEN 'incomplete' END AS fault FROM r""")
def page_faults(spark, sf_dir):
    return issues.page_faults(frame(spark, "fx_listing", sf_dir))


@query("wanted_keys_missing", f"WITH {cte(I, 'fx_wanted')} SELECT issue_key FROM fx_wanted EXCEPT SELECT issue_key FROM fx_issues")
def wanted_keys_missing(spark, sf_dir):
    return frame(spark, "fx_wanted", sf_dir).select("issue_key").exceptAll(frame(spark, I, sf_dir).select("issue_key"))


@query("section_kinds", """WITH h AS (SELECT doc_id, '## ' || ['Acceptance', 'Criterios de aceptación', 'Requirements', 'Requisitos', 'Notes'][doc_id % 5 + 1] || ' ' || substr(coalesce(text, ''), 1, 30) AS heading FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(heading, '(?i)acceptance|aceptaci[oó]n') THEN 'ACCEPTANCE' WHEN regexp_matches(heading, '(?i)requirement|requisito') THEN 'REQUIREMENTS' ELSE 'DESCRIPTION' END AS kind FROM h""")
def section_kinds(spark, sf_dir):
    names = F.array(*map(F.lit, ("Acceptance", "Criterios de aceptación", "Requirements", "Requisitos", "Notes")))
    d = views.table(spark, sf_dir, "documents")
    heading = F.concat(F.lit("## "), F.element_at(names, (F.col("doc_id") % 5 + 1).cast("int")), F.lit(" "), F.substring(F.coalesce("text", F.lit("")), 1, 30))
    return d.select("doc_id", text.section_kind(heading).alias("kind"))


@query("iso_times", """SELECT event_id, CASE event_id % 5 WHEN 1 THEN strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M') WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M') END AS minute FROM events""")
def iso_times(spark, sf_dir):
    """Times of events as services write them: in UTC, in another zone, without a zone, and not at all."""
    e, k = views.table(spark, sf_dir, "events"), F.col("event_id") % 5
    form = lambda pattern: F.date_format("ts", pattern)
    raw = F.when(k == 0, form("yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, form("yyyy-MM-dd'T'HH:mm:ss'+02:00'")).when(k == 2, form("yyyy-MM-dd HH:mm:ss")).when(k == 3, F.concat(F.lit("not "), "event_type"))
    return e.select("event_id", paths.jql_minute(paths.iso_time(raw)).alias("minute"))


@query("bound_assets", f"""WITH {cte('fx_elements', 'fx_assets')} SELECT e.source_id, e.ordinal, a.asset_id FROM fx_elements e JOIN fx_assets a ON e.source_id = a.source_id AND (a.page = e.page OR (a.page IS NULL AND e.ordinal = 0))""")
def bound_assets(spark, sf_dir):
    return issues.bound_assets(frame(spark, "fx_elements", sf_dir), frame(spark, "fx_assets", sf_dir))


@query("page_labels", f"WITH {cte('fx_labels')} SELECT page_id, array_to_string(list_sort(list_distinct(list(trim(label)) FILTER (trim(label) <> ''))), ',') AS labels FROM fx_labels GROUP BY page_id")
def page_labels(spark, sf_dir):
    return wiki.page_labels(frame(spark, "fx_labels", sf_dir)).withColumn("labels", F.concat_ws(",", "labels"))


@query("job_messages", """SELECT doc_id, ['ok', 'wrong fields', 'wrong fields', 'not an object', 'not an object'][doc_id % 5 + 1] AS verdict FROM documents""")
def job_messages(spark, sf_dir):
    """A message for each document: whole, without a field, with one more, a list, and its bare text."""
    from docweir.streaming.gates import job_verdict

    d, k = views.table(spark, sf_dir, "documents"), F.col("doc_id") % 5
    fields = [F.col("doc_id").cast("string").alias("job_id"), F.lit("full").alias("mode"), F.coalesce("source", F.lit("")).alias("project_id"), F.lit("JIRA").alias("provider"), F.lit("7").alias("pull_request"), F.coalesce("lang", F.lit("")).alias("repository"), F.lit("2024").alias("requested_at")]
    raw = F.when(k == 0, F.to_json(F.struct(*fields))).when(k == 1, F.to_json(F.struct(*fields[1:]))).when(k == 2, F.to_json(F.struct(*fields, F.lit("x").alias("extra")))).when(k == 3, F.to_json(F.array("doc_id"))).otherwise(F.concat(F.lit("job "), F.coalesce("text", F.lit(""))))
    return d.select("doc_id", job_verdict(raw).alias("verdict"))


@query("provider_request", """WITH k AS (SELECT source, list_distinct(list(['CONFLUENCE', 'JIRA', 'GITHUB'][doc_id % 3 + 1])) AS known FROM documents GROUP BY source),
a AS (SELECT doc_id, source, CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN ['JIRA', 'LOCAL'] WHEN 2 THEN ['GITHUB', upper(coalesce(lang, 'none')), 'JIRA', 'GITHUB'] ELSE [] END AS asked FROM documents)
SELECT doc_id, array_to_string(list_sort(CASE WHEN asked IS NULL THEN known ELSE list_distinct(list_filter(asked, lambda x: list_contains(known, x))) END), ',') AS providers FROM a JOIN k ON k.source IS NOT DISTINCT FROM a.source""")
def provider_request(spark, sf_dir):
    """Every document asks its source for some providers, or for all; it gets those that the source has."""
    s = views.source_documents(spark, sf_dir)
    known = s.groupBy(F.col("scope").alias("_scope")).agg(F.collect_set("provider").alias("known"))
    k = F.col("doc_id") % 4
    asked = F.when(k == 1, F.array(F.lit("jira"), F.lit("LOCAL"))).when(k == 2, F.array(F.lit("GITHUB"), F.coalesce("space_key", F.lit("NONE")), F.lit("JIRA"), F.lit("GITHUB"))).when(k == 3, F.array().cast("array<string>"))
    joined = s.withColumn("asked", asked).join(known, F.col("scope").eqNullSafe(F.col("_scope")))
    return joined.select("doc_id", F.concat_ws(",", F.array_sort(issues.granted_providers(F.col("asked"), F.col("known")))).alias("providers"))


@query("conversation_turns", "SELECT role, count(*) AS turns, count(DISTINCT conv_id) AS conversations, CAST(sum(len(text)) AS BIGINT) AS characters FROM conversations GROUP BY role")
def conversation_turns(spark, sf_dir):
    c = views.table(spark, sf_dir, "conversations")
    return c.groupBy("role").agg(F.count(F.lit(1)).alias("turns"), F.countDistinct("conv_id").alias("conversations"), F.sum(F.length("text")).alias("characters"))


@query("event_counters", "SELECT event_type, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, count(*) AS events FROM events GROUP BY 1, 2")
def event_counters(spark, sf_dir):
    e = views.table(spark, sf_dir, "events")
    return e.groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias("events"))


#: White space as Python strips it, and what each document's rich text must be read as.
_SPACE = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
TREES_SQL = f"""WITH t AS (SELECT 'd' || doc_id AS id, doc_id, doc_id % 13 = 5 AS broken, coalesce(text, '') AS t, coalesce(source, 'none') AS s, coalesce(lang, 'none') AS l, repeat('#', greatest(1, CAST(doc_id % 7 AS INTEGER))) || ' ' AS h FROM documents),
r AS (SELECT id, doc_id, s, CASE WHEN NOT broken THEN h || s || chr(10) || chr(10) || regexp_replace(t, '^{_SPACE}', '') || '[here](https://example.org/' || doc_id || ')' || chr(10) || chr(10) || s || ' | ' || l || ' |' || chr(10) || chr(10) || '- ' || l || chr(10) || chr(10)
  || '```sql' || chr(10) || s || chr(10) || '```' || chr(10) || chr(10) || 'by @' || l || chr(10) || chr(10) || 'https://example.org/' || doc_id || chr(10) || chr(10) END AS text,
 CASE WHEN NOT broken THEN h || s || chr(10) || trim(regexp_replace(t || ' here', '{_SPACE}', ' ', 'g'), ' ') || chr(10) || s || ' | ' || l || chr(10) || '- ' || l || chr(10) || s || chr(10) || 'by' END AS markdown FROM t)
"""


def _trees(spark, sf_dir):
    """Every document as a rich-text tree: a heading, its whole text and a link, a table, a list, code, a mention and a card. Some are broken."""

    def quoted(c):
        return F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")

    def node(kind, *content, attrs=None):
        inner = F.concat(F.lit('"content":['), F.concat_ws(",", *content), F.lit("]"))
        return F.concat(F.lit(f'{{"type":"{kind}",'), *([F.lit('"attrs":'), attrs, F.lit(",")] if attrs is not None else []), inner, F.lit("}"))

    def words(c, link=None):
        return F.concat(F.lit('{"type":"text","text":'), quoted(c), *([F.lit(',"marks":[{"type":"strong"},{"type":"link","attrs":{"href":'), quoted(link), F.lit("}}]")] if link is not None else []), F.lit("}"))

    d = F.col("doc_id")
    t, s, lang, url = F.coalesce("text", F.lit("")), F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.concat(F.lit("https://example.org/"), d)
    level, paragraph = F.concat(F.lit('{"level":'), d % 7, F.lit("}")), lambda *c: node("paragraph", *c)
    mention = F.concat(F.lit('{"type":"mention","attrs":{"id":"7","text":'), quoted(F.concat(F.lit("@"), lang)), F.lit("}}"))
    card = F.concat(F.lit('{"type":"inlineCard","attrs":{"url":'), quoted(url), F.lit("}}"))
    row = node("tableRow", node("tableHeader", paragraph(words(s))), node("tableCell", paragraph(words(lang))))
    tree = node(
        "doc", node("heading", words(s), attrs=level), paragraph(words(t), words(F.lit("here"), url)), node("table", row), node("bulletList", node("listItem", paragraph(words(lang)))),
        node("codeBlock", words(s), attrs=F.lit('{"language":"sql"}')), paragraph(words(F.lit("by ")), mention), paragraph(card),
    )
    storage = F.when(d % 3 == 0, F.concat(F.lit(" <p>"), s, F.lit("</p>"))).when(d % 3 == 1, "  ")
    return views.table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), d).alias("id"), storage.alias("storage"), F.when(d % 13 == 5, "broken").otherwise(tree).alias("adf"))


@query("adf_text", TREES_SQL + "SELECT id, text FROM r")
def adf_text(spark, sf_dir):
    return _trees(spark, sf_dir).select("id", richtext.rich_text("adf").alias("text"))


@query("adf_markdown", TREES_SQL + "SELECT id, markdown AS text FROM r")
def adf_markdown(spark, sf_dir):
    return _trees(spark, sf_dir).select("id", richtext.rich_markdown("adf").alias("text"))


@query("live_bodies", TREES_SQL + "SELECT id, CASE WHEN doc_id % 3 = 0 THEN '<p>' || s || '</p>' ELSE markdown END AS body FROM r")
def live_bodies(spark, sf_dir):
    """An empty stored body is read from the rich-text tree instead."""
    return _trees(spark, sf_dir).select("id", richtext.live_body(F.col("storage"), F.col("adf")).alias("body"))


@query("canonical_json", """SELECT event_id, CASE WHEN event_id % 9 <> 4 THEN '{"a":[1,{"y":null,"z":"' || event_type || '"}],"k":' || (props->>'$.k') || ',"é":"' || user_id || CASE event_id % 3 WHEN 0 THEN chr(92) || 'n' WHEN 1 THEN ' / ' ELSE chr(92) || '"' END || '"}' END AS canonical FROM events""")
def canonical_json(spark, sf_dir):
    """Properties of events within more fields, in another order, with spaces and escapes; some are cut off."""
    e = views.table(spark, sf_dir, "events")
    tail = F.element_at(F.array(F.lit("\\u000a"), F.lit(" \\/ "), F.lit("\\u0022")), (F.col("event_id") % 3 + 1).cast("int"))
    inner = F.regexp_replace("props", r"^\{|\}$", "")
    raw = F.concat(F.lit('{ "\\u00e9" : "'), "user_id", tail, F.lit('",'), inner, F.lit(',\n "a": [1, {"z": "'), "event_type", F.lit('", "y":null}]'), F.when(F.col("event_id") % 9 == 4, "").otherwise(" }"))
    return e.select("event_id", richtext.canonical_json(raw).alias("canonical"))


@query("generated_scan", f"WITH {cte('fx_metadata')} SELECT id, reason_code FROM fx_metadata")
def generated_scan(spark, sf_dir):
    return frame(spark, "fx_metadata", sf_dir).select("id", richtext.metadata_reason("metadata").alias("reason_code"))


@query("heading_digests", views.BASE_SQL + """ SELECT source_id, 'section:' || substr(sha256(CASE doc_id % 3 WHEN 0 THEN '["' || title || '","' || scope || '"]' WHEN 1 THEN '["Caf' || chr(233) || ' ' || lower(space_key) || '"]' ELSE '[]' END), 1, 12) AS locator FROM src""")
def heading_digests(spark, sf_dir):
    """Heading paths with spaces and parts of their own, with a composed letter's two spellings, and without any words."""
    s, k = views.source_documents(spark, sf_dir), F.col("doc_id") % 3
    cafe = F.when(F.col("doc_id") % 2 == 0, "Caf\u00e9").otherwise("Cafe\u0301")
    parts = F.when(k == 0, F.array(F.concat(F.lit(" "), F.regexp_replace("title", " ", " \t "), F.lit("\n")), F.lit(" "), F.lit(None).cast("string"), F.col("scope"))).when(k == 1, F.array(F.concat(cafe, F.lit("  "), F.lower("space_key")))).otherwise(F.array(F.lit("  ")))
    return s.select("source_id", F.concat(F.lit("section:"), richtext.heading_digest(parts)).alias("locator"))
