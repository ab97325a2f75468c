"""Queries of what a scan decides, commits, and leaves behind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweir.functions import paths, signatures
from docweir.operators import access, generation, routing
from docweir.plans.fixtures import cte, frame
from docweir.plans.registry import query
from docweir.sources import views

RUN = "run-2"
PROJECT = views.PROJECT

MATCHES = """r.provider = s.provider AND CASE r.match_field
  WHEN 'TITLE' THEN starts_with(coalesce(s.title, ''), r.prefix) WHEN 'SPACE_KEY' THEN starts_with(coalesce(s.space_key, ''), r.prefix)
  WHEN 'PATH' THEN starts_with(coalesce(s.path, ''), r.prefix) ELSE len(list_filter(coalesce(s.labels, []), lambda x: starts_with(x, r.prefix))) > 0 END"""
POLICY = f"coalesce((SELECT arg_min(r.access_policy_id, r.ordinal) FROM fx_rules r WHERE {MATCHES}), 'project:DEMO')"
ROUTED_SQL = f"""{views.BASE_SQL}, {cte("fx_rules")},
pol AS (SELECT s.*, {POLICY} AS access_policy_id FROM src s),
j AS (SELECT p.*, m.source_id IS NOT NULL AS seen, coalesce(m.deleted, false) AS gone, m.version AS m_version, m.content_hash AS m_hash, m.parser_version AS m_parser,
        m.chunker_version AS m_chunker, m.embedding_profile AS m_profile, m.schema_version AS m_schema, m.access_policy_id AS m_policy
      FROM pol p LEFT JOIN man m USING (project_id, provider, scope, source_id)),
routed AS (SELECT *, CASE WHEN deleted AND seen AND NOT gone THEN 'source deleted' WHEN deleted THEN 'already absent' WHEN NOT seen THEN 'new source' WHEN gone THEN 'tombstoned'
     WHEN version IS DISTINCT FROM m_version THEN 'version changed' WHEN content_hash IS DISTINCT FROM m_hash THEN 'content_hash changed'
     WHEN parser_version IS DISTINCT FROM m_parser THEN 'parser_version changed' WHEN chunker_version IS DISTINCT FROM m_chunker THEN 'chunker_version changed'
     WHEN embedding_profile IS DISTINCT FROM m_profile THEN 'embedding_profile changed' WHEN schema_version IS DISTINCT FROM m_schema THEN 'schema_version changed'
     WHEN access_policy_id IS DISTINCT FROM m_policy THEN 'access_policy_id changed' ELSE 'unchanged' END AS reason FROM j),
r AS (SELECT *, CASE WHEN reason = 'source deleted' THEN 'DELETE' WHEN reason IN ('already absent', 'unchanged') THEN 'SKIP' ELSE 'INDEX' END AS operation FROM routed)
"""


def with_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.resolve_policy(views.source_documents(spark, sf_dir), frame(spark, "fx_rules"), PROJECT)


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.route(with_policy(spark, sf_dir), views.manifest(spark, sf_dir))


@query("inspect_route", ROUTED_SQL + "SELECT source_id, operation, reason FROM r")
def inspect_route(spark, sf_dir):
    return routed(spark, sf_dir).select("source_id", "operation", "reason")


@query("scan_counters", ROUTED_SQL + """SELECT provider, scope, count(*) AS discovered, count(*) FILTER (operation = 'INDEX') AS indexed, count(*) FILTER (operation = 'SKIP') AS unchanged,
 count(*) FILTER (operation = 'DELETE') AS deleted, CAST(coalesce(sum(chunk_count) FILTER (operation = 'INDEX'), 0) AS BIGINT) AS chunks FROM r GROUP BY provider, scope""")
def scan_counters(spark, sf_dir):
    return routing.scope_counters(routed(spark, sf_dir), ["provider", "scope"])


@query("operation_summary", ROUTED_SQL + "SELECT provider, operation, reason, count(*) AS documents FROM r GROUP BY provider, operation, reason")
def operation_summary(spark, sf_dir):
    return routed(spark, sf_dir).groupBy("provider", "operation", "reason").agg(F.count(F.lit(1)).alias("documents"))


@query("forced_route", ROUTED_SQL + "SELECT source_id, CASE WHEN deleted AND seen AND NOT gone THEN 'DELETE' WHEN deleted THEN 'SKIP' ELSE 'INDEX' END AS operation FROM r")
def forced_route(spark, sf_dir):
    return routing.route(with_policy(spark, sf_dir), views.manifest(spark, sf_dir), force=True).select("source_id", "operation")


@query("fast_skip", ROUTED_SQL + "SELECT source_id, path FROM r WHERE provider = 'GITHUB' AND NOT (seen AND NOT gone AND version = m_version AND access_policy_id = m_policy)")
def fast_skip(spark, sf_dir):
    listing = with_policy(spark, sf_dir).where("provider = 'GITHUB'").select(*routing.KEY, "path", "version", "access_policy_id")
    return routing.fast_skip(listing, views.manifest(spark, sf_dir)).select("source_id", "path")


@query("stale_manifests", views.BASE_SQL + " SELECT m.source_id, m.last_seen_run FROM man m ANTI JOIN src s USING (project_id, provider, scope, source_id) WHERE NOT m.deleted")
def stale_manifests(spark, sf_dir):
    return routing.stale(views.manifest(spark, sf_dir), views.source_documents(spark, sf_dir)).select("source_id", "last_seen_run")


@query("stale_floor_guard", views.BASE_SQL + """ SELECT m.provider, m.scope, m.source_id FROM man m ANTI JOIN src s USING (project_id, provider, scope, source_id)
 WHERE NOT m.deleted AND m.provider <> 'JIRA' AND (SELECT count(*) FROM src s WHERE s.provider = m.provider AND s.scope = m.scope) >= 15""")
def stale_floor_guard(spark, sf_dir):
    return routing.guarded_stale(views.manifest(spark, sf_dir), views.source_documents(spark, sf_dir), floor=15).select("provider", "scope", "source_id")


@query("tombstones", views.BASE_SQL + f""" SELECT source_id, true AS deleted, 'e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855' AS content_hash, CAST(0 AS BIGINT) AS chunk_count, 'run-2' AS last_seen_run, title
 FROM (SELECT m.* FROM man m ANTI JOIN src s USING (project_id, provider, scope, source_id) WHERE NOT m.deleted)""")
def tombstone_rows(spark, sf_dir):
    m = views.manifest(spark, sf_dir)
    gone = routing.stale(m, views.source_documents(spark, sf_dir))
    return routing.tombstones(m, gone, RUN).select("source_id", "deleted", "content_hash", "chunk_count", "last_seen_run", "title")


@query("manifest_commit", ROUTED_SQL + f""", k AS (SELECT * FROM man)
SELECT coalesce(k.source_id, r.source_id) AS source_id, CASE WHEN operation = 'INDEX' THEN r.version ELSE k.version END AS version,
 CASE WHEN operation = 'INDEX' THEN r.content_hash WHEN operation = 'DELETE' THEN 'e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855' ELSE k.content_hash END AS content_hash,
 CASE WHEN operation = 'INDEX' THEN r.chunk_count WHEN operation = 'DELETE' THEN 0 ELSE k.chunk_count END AS chunk_count,
 CASE WHEN operation = 'INDEX' THEN false WHEN operation = 'DELETE' THEN true ELSE k.deleted END AS deleted,
 CASE WHEN operation IS NOT NULL THEN 'run-2' ELSE k.last_seen_run END AS last_seen_run,
 CASE WHEN operation = 'INDEX' THEN r.access_policy_id ELSE k.access_policy_id END AS access_policy_id
FROM k FULL JOIN r ON k.provider = r.provider AND k.scope = r.scope AND k.source_id = r.source_id WHERE k.source_id IS NOT NULL OR operation = 'INDEX'""")
def manifest_commit(spark, sf_dir):
    out = routing.commit(views.manifest(spark, sf_dir), routed(spark, sf_dir), RUN)
    return out.select("source_id", "version", "content_hash", "chunk_count", "deleted", "last_seen_run", "access_policy_id")


@query("manifest_keys", views.BASE_SQL + " SELECT source_id, sha256(project_id || '|' || provider || '|' || scope) AS partition_key, sha256(source_id) AS row_key FROM man")
def manifest_keys(spark, sf_dir):
    m = views.manifest(spark, sf_dir)
    return m.select("source_id", F.sha2(F.concat_ws("|", "project_id", F.upper("provider"), "scope"), 256).alias("partition_key"), F.sha2("source_id", 256).alias("row_key"))


@query("purge_scope", views.BASE_SQL + " SELECT source_id FROM man WHERE NOT (provider = 'GITHUB' AND scope = 'src1')")
def purge_scope(spark, sf_dir):
    return generation.purge(views.manifest(spark, sf_dir), provider="GITHUB", scope="src1").select("source_id")


@query("purge_provider_plan", views.BASE_SQL + " SELECT provider, count(*) AS sources, count(*) FILTER (NOT deleted) AS live, CAST(sum(chunk_count) AS BIGINT) AS chunks FROM man GROUP BY provider")
def purge_provider_plan(spark, sf_dir):
    m = views.manifest(spark, sf_dir)
    return m.groupBy("provider").agg(F.count(F.lit(1)).alias("sources"), F.count_if(~F.col("deleted")).alias("live"), F.sum("chunk_count").alias("chunks"))


@query("recovered_scopes", views.BASE_SQL + " SELECT provider, scope, count(*) AS sources FROM man GROUP BY provider, scope")
def recovered_scopes(spark, sf_dir):
    return generation.recovered_scopes(views.manifest(spark, sf_dir), PROJECT)


@query("access_policy_first_match", f"{views.BASE_SQL}, {cte('fx_rules')} SELECT s.source_id, {POLICY} AS access_policy_id FROM src s")
def access_policy_first_match(spark, sf_dir):
    return with_policy(spark, sf_dir).select("source_id", "access_policy_id")


@query("access_policy_labels", f"WITH {cte('fx_rules', 'fx_labelled')} SELECT s.source_id, {POLICY} AS access_policy_id FROM fx_labelled s")
def access_policy_labels(spark, sf_dir):
    return access.resolve_policy(frame(spark, "fx_labelled", sf_dir), frame(spark, "fx_rules"), PROJECT).select("source_id", "access_policy_id")


@query("access_rule_validation", """WITH r AS (SELECT doc_id AS ordinal, ['CONFLUENCE', 'JIRA', 'GITHUB', 'DROPBOX'][doc_id % 4 + 1] AS provider, ['TITLE', 'SPACE_KEY', 'LABEL', 'PATH', 'AUTHOR'][doc_id % 5 + 1] AS match_field, CASE WHEN doc_id % 7 = 0 THEN '' ELSE source END AS prefix,
 ['project:DEMO', 'department:DEMO:' || upper(coalesce(lang, 'XX')), 'department:OTHER:HR', 'department:DEMO:h r', 'project:' || source, 'department:DEMO:A'][doc_id % 6 + 1] AS policy FROM documents WHERE source IS NOT NULL)
SELECT ordinal, CASE WHEN provider = 'DROPBOX' THEN 'unsupported provider' WHEN match_field = 'AUTHOR' THEN 'unsupported match field' WHEN prefix = '' THEN 'empty prefix' WHEN ordinal % 6 > 1 AND policy <> 'project:DEMO' THEN 'policy of another project' END AS error FROM r""")
def access_rule_validation(spark, sf_dir):
    """A rule for each document, wrong in its provider, field, prefix or policy, or not at all."""
    d, i = views.table(spark, sf_dir, "documents").where("source is not null"), F.col("doc_id")
    pick = lambda values, n: F.element_at(F.array(*(v if not isinstance(v, str) else F.lit(v) for v in values)), (i % n + 1).cast("int"))
    policies = ("project:DEMO", F.concat(F.lit("department:DEMO:"), F.upper(F.coalesce("lang", F.lit("XX")))), "department:OTHER:HR", "department:DEMO:h r", F.concat(F.lit("project:"), "source"), "department:DEMO:A")
    rules = d.select(i.alias("ordinal"), pick(("CONFLUENCE", "JIRA", "GITHUB", "DROPBOX"), 4).alias("provider"), pick(("TITLE", "SPACE_KEY", "LABEL", "PATH", "AUTHOR"), 5).alias("match_field"), F.when(i % 7 == 0, "").otherwise(F.col("source")).alias("prefix"), pick(policies, 6).alias("access_policy_id"))
    return access.rule_errors(rules, PROJECT).select("ordinal", "error")


@query("root_page_tree", f"""WITH RECURSIVE {cte('fx_pages', 'fx_roots')},
walk(page_id, depth, seen) AS (SELECT page_id, 0, [page_id] FROM fx_pages WHERE page_id IN (SELECT root_id FROM fx_roots)
 UNION ALL SELECT p.page_id, depth + 1, list_append(seen, p.page_id) FROM fx_pages p JOIN walk w ON p.parent_id = w.page_id WHERE NOT list_contains(seen, p.page_id))
SELECT page_id, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY page_id""")
def root_page_tree(spark, sf_dir):
    return routing.roots_subtree(frame(spark, "fx_pages", sf_dir), frame(spark, "fx_roots", sf_dir))


@query("rename_fanout", f"""WITH {cte('fx_changes')}, k AS (SELECT * FROM fx_changes WHERE status IN ('added', 'modified', 'removed', 'renamed')),
f AS (SELECT number, previous_path AS path, 'DELETE' AS operation, 'renamed away' AS reason FROM k WHERE status = 'renamed' AND previous_path IS NOT NULL
 UNION ALL SELECT number, path, CASE WHEN status = 'removed' THEN 'DELETE' WHEN has_content THEN 'INDEX' ELSE 'SKIP' END, CASE WHEN status = 'removed' THEN 'removed' WHEN has_content THEN status ELSE 'no content' END FROM k)
SELECT * FROM f WHERE {paths.indexable_sql('path')}""")
def rename_fanout(spark, sf_dir):
    return routing.changes_to_operations(frame(spark, "fx_changes", sf_dir), paths.is_indexable(F.col("path")))


@query("ledger_latest", f"WITH {cte('fx_ledger')} SELECT arg_max(sequence, sequence) AS sequence, source_id, arg_max(status, sequence) AS status, arg_max(source_version, sequence) AS source_version FROM fx_ledger GROUP BY source_id")
def ledger_latest(spark, sf_dir):
    return routing.latest(frame(spark, "fx_ledger", sf_dir), "source_id", "sequence")


@query("ledger_summary", f"WITH {cte('fx_ledger')}, l AS (SELECT source_id, arg_max(status, sequence) AS status FROM fx_ledger GROUP BY source_id) SELECT status, count(*) AS sources, status = 'started' AS unfinished FROM l GROUP BY status")
def ledger_summary(spark, sf_dir):
    return routing.latest(frame(spark, "fx_ledger", sf_dir), "source_id", "sequence").groupBy("status").agg(F.count(F.lit(1)).alias("sources")).withColumn("unfinished", F.col("status") == "started")


@query("ledger_resume", f"""WITH {cte('fx_ledger', 'fx_current')}, l AS (SELECT source_id, arg_max(status, sequence) AS last_status, arg_max(source_version, sequence) AS v FROM fx_ledger GROUP BY source_id)
SELECT c.source_id, c.source_version, l.last_status, CASE WHEN l.last_status IN ('indexed', 'unchanged', 'excluded') AND l.v = c.source_version THEN 'skip' ELSE 'run' END AS decision FROM fx_current c LEFT JOIN l USING (source_id)""")
def ledger_resume(spark, sf_dir):
    return routing.resumable(frame(spark, "fx_ledger", sf_dir), frame(spark, "fx_current", sf_dir))


@query("failure_budget", views.BASE_SQL + """ SELECT provider, scope, count(*) AS documents, count(*) FILTER (doc_id % 23 = 0) AS failures, count(*) FILTER (doc_id % 23 = 0) >= 5 AS aborted,
 count(*) FILTER (doc_id % 23 = 0) = 0 AS commit_cursor FROM src GROUP BY provider, scope""")
def failure_budget(spark, sf_dir):
    return routing.failure_budget(views.source_documents(spark, sf_dir).withColumn("failed", F.col("doc_id") % 23 == 0), ["provider", "scope"])


@query("incremental_filter", views.BASE_SQL + " SELECT source_id FROM src WHERE updated_at IS NULL OR updated_at >= TIMESTAMP '2024-01-01 05:00:00'")
def incremental_filter(spark, sf_dir):
    return views.source_documents(spark, sf_dir).where(paths.changed_since(F.col("updated_at"), F.lit("2024-01-01 05:00:00").cast("timestamp"))).select("source_id")


@query("cursor_overlap_read", views.BASE_SQL + """, cur AS (SELECT provider, scope, max(updated_at) - INTERVAL 200 MINUTE AS cursor FROM src GROUP BY provider, scope)
SELECT s.source_id FROM src s JOIN cur USING (provider, scope) WHERE s.updated_at IS NULL OR cursor IS NULL OR s.updated_at >= cursor - INTERVAL 5 MINUTE""")
def cursor_overlap_read(spark, sf_dir):
    docs = views.source_documents(spark, sf_dir)
    cursors = docs.groupBy("provider", "scope").agg((F.max("updated_at") - F.expr("INTERVAL 200 MINUTES")).alias("cursor"))
    joined = docs.join(cursors, ["provider", "scope"])
    return joined.where(F.col("cursor").isNull() | paths.changed_since(F.col("updated_at"), F.col("cursor") - F.expr("INTERVAL 5 MINUTES"))).select("source_id")


@query("scan_scopes", f"""WITH {cte('fx_projects')}, s AS (SELECT project_id, 'GITHUB' AS provider, owner || '/' || repository || '|' || unnest(CASE WHEN len(branches) = 0 THEN ['main'] ELSE branches END) AS scope FROM fx_projects
 UNION ALL SELECT project_id, 'JIRA', jira_site || '|' || jira_key FROM fx_projects WHERE jira_site IS NOT NULL)
SELECT project_id, provider, array_to_string(list_sort(list_distinct(list(scope))), ',') AS scopes FROM s GROUP BY project_id, provider""")
def scan_scopes(spark, sf_dir):
    return generation.scopes(frame(spark, "fx_projects", sf_dir)).groupBy("project_id", "provider").agg(F.concat_ws(",", F.array_sort(F.collect_set("scope"))).alias("scopes"))


@query("project_lookup", f"""WITH {cte('fx_projects')}, r AS (SELECT doc_id, ['acme-' || coalesce(lang, 'none'), 'bad owner', '-x', 'acme-' || coalesce(lang, 'none')][doc_id % 4 + 1] AS owner, coalesce(source, 'none') || CASE WHEN doc_id % 9 = 2 THEN '/' ELSE '.' END || doc_id % 25 AS repository FROM documents),
v AS (SELECT *, regexp_full_match(owner, '[A-Za-z0-9](?:[A-Za-z0-9-]{{0,37}}[A-Za-z0-9])?') AND regexp_full_match(repository, '[A-Za-z0-9_.-]{{1,100}}') AS valid FROM r),
p AS (SELECT owner, repository, min(project_id) AS project_id FROM fx_projects WHERE owner <> 'bad owner' AND NOT contains(repository, '/') GROUP BY ALL)
SELECT v.doc_id, v.owner, v.repository, p.project_id, v.valid FROM v LEFT JOIN p ON p.owner = v.owner AND p.repository = v.repository""")
def project_lookup(spark, sf_dir):
    """Every document asks for the project of a repository, as an event would; some repositories no project has, some several."""
    d, owner = F.col("doc_id"), F.concat(F.lit("acme-"), F.coalesce("lang", F.lit("none")))
    asked = views.table(spark, sf_dir, "documents").select(
        "doc_id", F.when(d % 4 == 1, "bad owner").when(d % 4 == 2, "-x").otherwise(owner).alias("owner"),
        F.concat(F.coalesce("source", F.lit("none")), F.when(d % 9 == 2, "/").otherwise("."), d % 25).alias("repository"),
    )
    return routing.by_repository(asked, frame(spark, "fx_projects", sf_dir))


#: The secret of the query's deliveries. The SQL has the key's block under both masks as bytes.
SECRET = b"a shared secret"
WEBHOOKS_SQL = """WITH b AS (SELECT doc_id, CASE WHEN doc_id % 8 = 3 THEN 'push' ELSE 'pull_request' END AS event, '{"action":"' || CASE WHEN doc_id % 6 = 1 THEN 'opened' ELSE 'closed' END || '","pull_request":{"merged":' || CASE WHEN doc_id % 10 = 4 THEN 'false' ELSE 'true' END || CASE WHEN doc_id % 9 = 2 THEN '' ELSE ',"number":' || doc_id END
 || ',"base":{"ref":"' || CASE WHEN doc_id % 7 = 5 THEN 'dev' ELSE 'main' END || '"}},"repository":{"full_name":"acme/' || source || '"},"digest":"' || sha256(coalesce(text, '')) || '","text":' || CAST(to_json(coalesce(lang, '')) AS VARCHAR) || '}' AS body FROM documents),
h AS (SELECT *, sha256(unhex('3D7C2F343D2E39387C2F393F2E39285C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C5C') || unhex(sha256(unhex('5716455E574453521645535544534236363636363636363636363636363636363636363636363636363636363636363636363636363636363636363636363636') || encode(body)))) AS signature FROM b)
"""


def _webhooks(spark, sf_dir):
    """A delivery of each document, some with a header that another body has."""
    d, i = views.table(spark, sf_dir, "documents"), F.col("doc_id")
    body = F.concat(
        F.lit('{"action":"'), F.when(i % 6 == 1, "opened").otherwise("closed"), F.lit('","pull_request":{"merged":'), F.when(i % 10 == 4, "false").otherwise("true"), F.when(i % 9 == 2, "").otherwise(F.concat(F.lit(',"number":'), i)),
        F.lit(',"base":{"ref":"'), F.when(i % 7 == 5, "dev").otherwise("main"), F.lit('"}},"repository":{"full_name":"acme/'), "source", F.lit('"},"digest":"'), F.sha2(F.coalesce("text", F.lit("")), 256), F.lit('","text":"'), F.coalesce("lang", F.lit("")), F.lit('"}'),
    )
    rows = d.select("doc_id", F.when(i % 8 == 3, "push").otherwise("pull_request").alias("event"), body.alias("body"), F.lit(True).alias("mapped"), F.lit(True).alias("enabled"), F.lit("main").alias("base"))
    signature = signatures.hmac_sha256(F.col("body").cast("binary"), SECRET)
    return rows.withColumn("header", F.when(i % 5 == 0, F.concat(F.lit("sha256="), F.sha2("body", 256))).when(i % 13 != 0, F.concat(F.lit("sha256="), signature)))


@query("webhook_signatures", WEBHOOKS_SQL + "SELECT doc_id, signature FROM h")
def webhook_signatures(spark, sf_dir):
    return _webhooks(spark, sf_dir).select("doc_id", signatures.hmac_sha256(F.col("body").cast("binary"), SECRET).alias("signature"))


@query("webhook_admission", WEBHOOKS_SQL + """, r AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 OR doc_id % 13 = 0 THEN 'bad signature' WHEN event <> 'pull_request' THEN 'ignored event' WHEN doc_id % 6 = 1 OR doc_id % 10 = 4 THEN 'not merged' WHEN doc_id % 7 = 5 THEN 'other branch' WHEN doc_id % 9 = 2 THEN 'missing ids' ELSE 'accepted' END AS reason FROM h)
SELECT doc_id, reason = 'accepted' AS accepted, reason FROM r""")
def webhook_admission(spark, sf_dir):
    from docweir.streaming.gates import admission, verified

    return admission(verified(_webhooks(spark, sf_dir), SECRET)).select("doc_id", "accepted", "reason")


@query("dead_letters", f"WITH {cte('fx_queue')} SELECT message_id, CASE WHEN ok THEN 'complete' WHEN deliveries >= 5 THEN 'dead-letter' ELSE 'abandon' END AS outcome FROM fx_queue")
def dead_letters(spark, sf_dir):
    from docweir.streaming.gates import settlement

    return settlement(frame(spark, "fx_queue", sf_dir)).select("message_id", "outcome")


GENERATION_SQL = views.BASE_SQL + """, held AS (SELECT doc_id, project_id, provider, source_id, chunk_count FROM src WHERE doc_id % 5 <> 0 UNION ALL SELECT doc_id, project_id, 'OTHER', source_id, chunk_count FROM src WHERE doc_id % 6 = 1),
old AS (SELECT sha256(project_id || '|' || provider || '|' || source_id || '|' || i) AS storage_id, provider, source_id, i AS ordinal FROM (SELECT *, unnest(range(chunk_count + doc_id % 3)) AS i FROM held)),
new AS (SELECT sha256(project_id || '|' || provider || '|' || source_id || '|' || i) AS storage_id, provider, source_id, i AS ordinal FROM (SELECT *, unnest(range(CASE WHEN deleted THEN 0 ELSE chunk_count END)) AS i FROM src WHERE doc_id % 4 <> 0)),
touched AS (SELECT provider, source_id FROM src WHERE doc_id % 4 <> 0)
"""


def _generations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Some sources are held under the same id by another provider, too; it isn't touched."""
    s = views.source_documents(spark, sf_dir)
    rows = lambda df, n: generation.storage_rows(df.withColumn("_n", n))
    held = s.where(F.col("doc_id") % 5 != 0).unionByName(s.where(F.col("doc_id") % 6 == 1).withColumn("provider", F.lit("OTHER")))
    old = rows(held, F.col("chunk_count") + F.col("doc_id") % 3)
    touched = s.where(F.col("doc_id") % 4 != 0)
    return old, rows(touched, F.when(F.col("deleted"), 0).otherwise(F.col("chunk_count"))), touched.select("project_id", "provider", "source_id")


@query("storage_ids", views.BASE_SQL + " SELECT source_id, i AS ordinal, sha256(project_id || '|' || provider || '|' || source_id || '|' || i) AS storage_id FROM (SELECT *, unnest(range(chunk_count)) AS i FROM src)")
def storage_ids(spark, sf_dir):
    return generation.storage_rows(views.source_documents(spark, sf_dir).withColumn("_n", F.col("chunk_count"))).select("source_id", "ordinal", "storage_id")


@query("generation_obsolete_ids", GENERATION_SQL + "SELECT storage_id FROM old WHERE (provider, source_id) IN (SELECT provider, source_id FROM touched) EXCEPT SELECT storage_id FROM new")
def generation_obsolete_ids(spark, sf_dir):
    return generation.obsolete(*_generations(spark, sf_dir)).select("storage_id")


@query("generation_final_state", GENERATION_SQL + "SELECT provider, source_id, count(*) AS chunks, max(ordinal) AS last_ordinal FROM (SELECT * FROM old ANTI JOIN touched USING (provider, source_id) UNION ALL BY NAME SELECT * FROM new) GROUP BY provider, source_id")
def generation_final_state(spark, sf_dir):
    return generation.replaced(*_generations(spark, sf_dir)).groupBy("provider", "source_id").agg(F.count(F.lit(1)).alias("chunks"), F.max("ordinal").alias("last_ordinal"))


@query("generation_verify", GENERATION_SQL + "SELECT count(*) AS expected, count(*) FILTER (f.storage_id IS NOT NULL) AS written FROM new n LEFT JOIN (SELECT storage_id FROM old ANTI JOIN touched USING (provider, source_id) UNION ALL SELECT storage_id FROM new) f USING (storage_id)")
def generation_verify(spark, sf_dir):
    old, new, touched = _generations(spark, sf_dir)
    return generation.verified(new, generation.replaced(old, new, touched))
