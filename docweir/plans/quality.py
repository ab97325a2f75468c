"""Queries about what is stored: security, vocabulary, audits, gates, vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweir.functions import security
from docweir.operators import audits, visuals, vocabulary
from docweir.plans.fixtures import cte, frame
from docweir.plans.registry import query
from docweir.plans.text import TEXTS_SQL, texts
from docweir.sources import views

_SECRET_SQL = " OR ".join("regexp_matches(content, '" + p.replace("'", "''") + "')" for p in security.SECRETS)


@query("secret_patterns", TEXTS_SQL + f" SELECT source_id FROM texts WHERE {_SECRET_SQL}")
def secret_patterns(spark, sf_dir):
    return texts(spark, sf_dir).where(security.has_secret(F.col("content"))).select("source_id")


# DuckDB's patterns can't look ahead: what stands behind a citation is tested for itself.
CANDIDATES_SQL = TEXTS_SQL + r""", ci AS (SELECT source_id, content, list_filter(list_distinct(regexp_extract_all(content, 'https://github\.com/[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+/blob/[0-9a-f]{40}/[A-Za-z0-9_./-]+(?:#L[0-9]+(?:-L[0-9]+)?)?')),
   lambda c: regexp_matches(content, regexp_escape(c) || '(?:$|[\s)>\]])') AND NOT list_has_any(string_split(c, '/'), ['.', '..'])) AS cs FROM texts),
ap AS (SELECT source_id, list_reduce(list_prepend(content, cs), lambda t, c: replace(t, c, replace(c, '/', ' '))) AS content FROM ci),
w AS (SELECT DISTINCT source_id, unnest(regexp_extract_all(content, '\b[A-Za-z0-9+/=_-]{40,200}\b')) AS word FROM ap),
e AS (SELECT source_id, word, (SELECT -sum(p * log2(p)) FROM (SELECT count(*) / len(word) AS p FROM (SELECT unnest(string_split(word, '')) AS c) GROUP BY c)) AS bits FROM w)"""


@query("entropy_candidates", CANDIDATES_SQL + " SELECT source_id, word, round(bits, 6) AS bits, bits >= 4.7 AND regexp_matches(word, '[0-9]') AS flagged FROM e")
def entropy_candidates(spark, sf_dir):
    w = texts(spark, sf_dir).select("source_id", F.explode(security.candidates(F.col("content"))).alias("word")).distinct()
    bits = security.entropy(F.col("word"))
    return w.select("source_id", "word", F.round(bits, 6).alias("bits"), ((bits >= security.LEAST_ENTROPY) & F.col("word").rlike("[0-9]")).alias("flagged"))


@query("quarantine_reasons", CANDIDATES_SQL + f""", f AS (SELECT DISTINCT source_id FROM e WHERE bits >= 4.7 AND regexp_matches(word, '[0-9]')),
q AS (SELECT t.source_id, CASE WHEN t.title LIKE 'Guide%' THEN 'x.zip' ELSE 'x.md' END AS path, ({_SECRET_SQL}) OR t.source_id IN (SELECT source_id FROM f) AS sensitive FROM texts t)
SELECT source_id, sensitive, CASE WHEN path = 'x.zip' THEN 'BLOCKED_FILE_TYPE' WHEN sensitive THEN 'POTENTIAL_SECRET' END AS reason_code FROM q""")
def quarantine_reasons(spark, sf_dir):
    t = texts(spark, sf_dir).select("source_id", F.lit("CONFLUENCE").alias("provider"), F.when(F.col("title").startswith("Guide"), "x.zip").otherwise("x.md").alias("path"), "content", F.lit(None).cast("binary").alias("content_bytes"))
    return security.quarantine(t, binary=False).select("source_id", "sensitive", "reason_code")


@query("binary_bodies", CANDIDATES_SQL + """, f AS (SELECT DISTINCT source_id FROM e WHERE bits >= 4.7 AND regexp_matches(word, '[0-9]')),
q AS (SELECT s.doc_id, s.source_id, s.source_id IN (SELECT source_id FROM f) OR s.doc_id % 5 = 2 OR regexp_matches(content, '-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----') OR regexp_matches(content, '(?i)(?:api[_-]?key|client[_-]?secret|password)\\s*[:=]\\s*[\\x27\\x22]?[A-Za-z0-9_./+=-]{16,}')
 OR regexp_matches(content, '\\bgh[opsu]_[A-Za-z0-9]{30,}\\b') OR regexp_matches(content, '\\bAKIA[0-9A-Z]{16}\\b') AS sensitive, s.provider FROM src s)
SELECT source_id, sensitive, CASE WHEN doc_id % 4 = 1 THEN 'MIME_MISMATCH' WHEN sensitive THEN 'POTENTIAL_SECRET' END AS reason_code FROM q""")
def binary_bodies(spark, sf_dir):
    """Every text within bytes that aren't text: behind a PDF's header, before binary tails; some with a key that such a byte divides, and some as the wrong type."""
    s = views.source_documents(spark, sf_dir)
    key = F.when(F.col("doc_id") % 5 == 2, F.concat(F.lit(b"\nAKIA"), F.unhex(F.lit("FF")), F.lit(b"ABCDEFGHIJKLMNOP\n"))).otherwise(F.lit(b""))
    body = F.concat(F.lit(b"%PDF-1.7\n"), F.unhex(F.lit("FFFE90")), F.lit(b"\n"), F.col("content").cast("binary"), F.lit(b"\n"), key, F.unhex(F.lit("C328A0A1F0288CBC")))
    path = F.when(F.col("doc_id") % 4 == 1, "x.xlsx").otherwise("x.pdf")
    rows = s.select("source_id", F.lit("CONFLUENCE").alias("provider"), path.alias("path"), F.lit("").alias("content"), body.alias("content_bytes"))
    return security.quarantine(rows).select("source_id", "sensitive", "reason_code")


@query("issue_metadata_secrets", views.BASE_SQL + """ SELECT source_id, CASE WHEN provider = 'JIRA' AND doc_id % 5 = 1 THEN 'POTENTIAL_SECRET' END AS reason_code FROM src""")
def issue_metadata_secrets(spark, sf_dir):
    """Fields of issues, some with a credential inside JSON inside a field; other providers' fields aren't looked at."""
    s = views.source_documents(spark, sf_dir)
    inner = F.when(F.col("doc_id") % 5 == 1, F.to_json(F.struct(F.concat(F.lit("abcdefghijklmnop"), "doc_id").alias("password")))).otherwise(F.col("title"))
    meta = F.to_json(F.struct("title", "path", F.struct(inner.alias("note"), F.array("scope", "space_key").alias("tags")).alias("fields")))
    rows = s.select("source_id", "provider", F.lit("x.md").alias("path"), F.lit("").alias("content"), F.lit(None).cast("binary").alias("content_bytes"), meta.alias("metadata"))
    return security.quarantine(rows, binary=False).select("source_id", "reason_code")


@query("payload_signatures", f"WITH {cte('fx_payloads')} SELECT path, reason_code FROM fx_payloads")
def payload_signatures(spark, sf_dir):
    p = frame(spark, "fx_payloads", sf_dir).select(F.col("path"), F.lit("JIRA").alias("provider"), F.lit("").alias("content"), F.unhex("payload").alias("content_bytes"))
    return security.quarantine(p).select("path", "reason_code")


STORED_SQL = views.BASE_SQL + """, st AS (SELECT doc_id, project_id, provider, source_id, source_type, title, path, source_url, version, schema_version, i AS ordinal,
  ['project:DEMO', 'department:DEMO:HR', ''][doc_id % 3 + 1] AS access_policy_id, ['nova', 'Atlas ', '', 'zeta'][doc_id % 4 + 1] AS entity, ['narrative', 'index', 'glossary'][doc_id % 3 + 1] AS doc_category, lower(space_key) AS language,
  sha256(source_id || '|' || i) AS chunk_id, ['alpha beta', 'Alpha  Beta', title, 'x'][(doc_id + i) % 4 + 1] AS body, (tokens * (i + 3)) % 700 AS tokens, CASE WHEN doc_id % 9 = 0 THEN '' ELSE title END AS structure_path,
  CASE WHEN doc_id % 6 = 0 THEN NULL ELSE 'KEY-' || doc_id END AS issue_key, ['Open', 'Done'][doc_id % 2 + 1] AS status, CASE doc_id % 3 WHEN 0 THEN '["red","blue"]' WHEN 1 THEN 'plain' END AS labels_json, 'l' || i AS locator, 'cloud' AS cloud_id
 FROM (SELECT *, unnest(range(chunk_count)) AS i FROM src)),
sx AS (SELECT *, CASE WHEN doc_id % 8 = 0 THEN body ELSE 'passage: ' || title || chr(10) || body END AS embedding_text FROM st)
"""


def stored(spark, sf_dir):
    """What an earlier run might have stored. STORED_SQL says the same."""
    pick = lambda values, at: F.element_at(F.array(*[v if not isinstance(v, str) else F.lit(v) for v in values]), (at + 1).cast("int"))
    s = views.source_documents(spark, sf_dir).withColumn("ordinal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunk_count") - 1)))
    d, i = F.col("doc_id"), F.col("ordinal")
    s = s.withColumns({
        "access_policy_id": pick(["project:DEMO", "department:DEMO:HR", ""], d % 3), "entity": pick(["nova", "Atlas ", "", "zeta"], d % 4), "doc_category": pick(["narrative", "index", "glossary"], d % 3),
        "language": F.lower("space_key"), "chunk_id": F.sha2(F.concat_ws("|", "source_id", i.cast("string")), 256), "body": pick(["alpha beta", "Alpha  Beta", F.col("title"), "x"], (d + i) % 4),
        "tokens": (F.col("tokens") * (i + 3)) % 700, "structure_path": F.when(d % 9 == 0, "").otherwise(F.col("title")), "issue_key": F.when(d % 6 != 0, F.concat(F.lit("KEY-"), d)),
        "status": pick(["Open", "Done"], d % 2), "labels_json": F.when(d % 3 == 0, '["red","blue"]').when(d % 3 == 1, "plain"), "locator": F.concat(F.lit("l"), i), "cloud_id": F.lit("cloud"),
    })
    return s.withColumn("embedding_text", F.when(d % 8 == 0, F.col("body")).otherwise(F.concat(F.lit("passage: "), "title", F.lit("\n"), "body")))




def _observed_sql(column: str, upper: bool = False) -> str:
    value = f"upper(trim({column}))" if upper else f"trim({column})"
    return f"array_to_string(list_transform(list_sort(list_distinct(list([lower({value}), {value}]) FILTER (trim({column}) <> ''))), lambda x: x[2]), ',')"


@query("vocabulary_by_policy", STORED_SQL + f"SELECT access_policy_id, {_observed_sql('entity')} AS entities, {_observed_sql('doc_category')} AS categories, {_observed_sql('provider', True)} AS providers, {_observed_sql('language')} AS languages FROM sx WHERE access_policy_id <> '' GROUP BY access_policy_id")
def vocabulary_by_policy(spark, sf_dir):
    v = vocabulary.by_policy(stored(spark, sf_dir))
    return v.select("access_policy_id", *(F.concat_ws(",", c).alias(c) for c in ("entities", "categories", "providers", "languages")))


@query("vocabulary_types", STORED_SQL + "SELECT access_policy_id, upper(trim(source_type)) AS source_type, count(*) AS chunks, count(*) >= 5 AS listed FROM sx GROUP BY 1, 2")
def vocabulary_types(spark, sf_dir):
    return vocabulary.type_counts(stored(spark, sf_dir))


@query("vocabulary_stats", STORED_SQL + """, n AS (SELECT access_policy_id, source_id, count(*) AS n FROM sx GROUP BY 1, 2), a AS (SELECT access_policy_id, count(*) AS sources, CAST(sum(n) AS BIGINT) AS chunks, median(n) AS median_chunks FROM n GROUP BY 1)
SELECT *, CASE WHEN median_chunks >= 20 THEN 25 WHEN median_chunks >= 8 THEN 12 ELSE 3 END AS cap FROM a""")
def vocabulary_stats(spark, sf_dir):
    return vocabulary.stats(stored(spark, sf_dir))


@query("vocabulary_extensions", STORED_SQL + "SELECT DISTINCT access_policy_id, lower(regexp_extract(n, '[^/](\\.[^./]+)$', 1)) AS extension FROM (SELECT access_policy_id, unnest([path, title]) AS n FROM sx WHERE upper(source_type) = 'CODE') WHERE regexp_extract(n, '[^/](\\.[^./]+)$', 1) <> ''")
def vocabulary_extensions(spark, sf_dir):
    return vocabulary.code_extensions(stored(spark, sf_dir))


@query("vocabulary_terms", STORED_SQL + """SELECT DISTINCT access_policy_id, term FROM (SELECT access_policy_id, unnest(list_concat([issue_key, status], CASE WHEN labels_json IS NULL THEN [] WHEN json_valid(labels_json) THEN CAST(labels_json AS JSON)::VARCHAR[] ELSE [labels_json] END)) AS term FROM sx WHERE provider = 'JIRA') WHERE term <> ''""")
def vocabulary_terms(spark, sf_dir):
    return vocabulary.terms(stored(spark, sf_dir))


@query("chunk_audit_lengths", STORED_SQL + """, r AS (SELECT provider, tokens, row_number() OVER (PARTITION BY provider ORDER BY tokens) AS k, count(*) OVER (PARTITION BY provider) AS n FROM sx),
p AS (SELECT *, 0.95 * (n + 1) AS place, greatest(1, least(CAST(floor(0.95 * (n + 1)) AS BIGINT), n - 1)) AS low FROM r)
SELECT provider, count(*) AS chunks, min(tokens) AS least, median(tokens) AS median, round(CAST(sum(CASE WHEN k = low THEN tokens * (1 - (place - floor(place))) WHEN k = low + 1 THEN tokens * (place - floor(place)) END) AS DOUBLE), 6) AS p95, max(tokens) AS most, round(avg(tokens), 6) AS mean FROM p GROUP BY provider""")
def chunk_audit_lengths(spark, sf_dir):
    return audits.lengths(stored(spark, sf_dir), ["provider"])


@query("chunk_audit_findings", STORED_SQL + """SELECT provider, count(*) AS chunks, count(*) FILTER (tokens > 512) AS truncated, count(*) FILTER (tokens < 8) AS fragments,
 count(*) FILTER (NOT starts_with(embedding_text, 'passage: ') OR len(regexp_extract_all(embedding_text, '(?i)\\bpassage:\\s*')) <> 1) AS bad_prefix, count(*) FILTER (structure_path = '') AS contextless FROM sx GROUP BY provider""")
def chunk_audit_findings(spark, sf_dir):
    return audits.findings(stored(spark, sf_dir))


@query("mixed_schemas", views.BASE_SQL + " SELECT provider, schema_version, count(*) AS sources FROM man GROUP BY provider, schema_version")
def mixed_schemas(spark, sf_dir):
    return views.manifest(spark, sf_dir).groupBy("provider", "schema_version").agg(F.count(F.lit(1)).alias("sources"))


@query("duplicate_bodies", STORED_SQL + "SELECT sha256(lower(trim(regexp_replace(body, '\\s+', ' ', 'g'), ' '))) AS digest, count(*) AS copies, count(*) - 1 AS extra FROM sx GROUP BY 1 HAVING count(*) > 1")
def duplicate_bodies(spark, sf_dir):
    return audits.duplicate_bodies(stored(spark, sf_dir))


@query("duplicate_documents", "SELECT sha256(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'), ' '))) AS digest, count(*) AS copies, count(*) - 1 AS extra FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_documents(spark, sf_dir):
    return audits.duplicate_bodies(views.table(spark, sf_dir, "documents").select(F.col("text").alias("body")))


@query("jira_defects", STORED_SQL + """, j AS (SELECT * FROM sx WHERE provider = 'JIRA' UNION ALL SELECT * FROM sx WHERE provider = 'JIRA' AND doc_id % 50 = 1),
n AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY ordinal) AS nth FROM j)
SELECT * FROM (SELECT chunk_id, ordinal, concat_ws(',', CASE WHEN nth > 1 THEN 'duplicate_identity' END, CASE WHEN NOT starts_with(embedding_text, 'passage: ') THEN 'missing_passage_prefix' END, CASE WHEN NOT ends_with(embedding_text, body) THEN 'body_not_fully_embedded' END,
 CASE WHEN tokens > 512 THEN 'embedding_overflow' END, CASE WHEN access_policy_id = '' THEN 'missing_access_policy_id' END, CASE WHEN issue_key IS NULL THEN 'missing_issue_key' END) AS reasons FROM n) WHERE reasons <> ''""")
def jira_defects(spark, sf_dir):
    j = stored(spark, sf_dir).where("provider = 'JIRA'")
    both = j.unionByName(j.where(F.col("doc_id") % 50 == 1))
    return audits.defects(both).select("chunk_id", "ordinal", F.concat_ws(",", "reasons").alias("reasons"))


@query("promotion_gates", """WITH s AS (SELECT count(text) / count(*) AS source_completeness, count(lang) / count(*) AS gold_resolution, count(*) FILTER (n_chars > 200) / count(*) AS candidate_recall, count(*) FILTER (doc_id % 10 <> 3) / count(*) AS final_evidence_recall, count(*) FILTER (doc_id % 50 <> 3) / count(*) AS citation_correctness,
 CAST(0 AS DOUBLE) AS cross_project_leakage, CAST(count(*) FILTER (doc_id % 40 = 7) AS DOUBLE) AS access_policy_leakage, count(*) FILTER (doc_id % 30 = 1) / count(*) AS non_jira_regression, CAST(count(*) AS DOUBLE) AS evaluation_case_count FROM documents),
v AS (UNPIVOT s ON COLUMNS(*) INTO NAME metric VALUE value),
g AS (SELECT * FROM (VALUES ('source_completeness', 'at_least', 1.0::DOUBLE), ('gold_resolution', 'at_least', 1.0::DOUBLE), ('exact_key_status_accuracy', 'at_least', 1.0::DOUBLE), ('candidate_recall', 'at_least', 0.9::DOUBLE), ('final_evidence_recall', 'at_least', 0.85::DOUBLE), ('citation_correctness', 'at_least', 0.95::DOUBLE), ('grounded_answer_accuracy', 'at_least', 0.9::DOUBLE),
 ('cross_project_leakage', 'zero', 0.0::DOUBLE), ('access_policy_leakage', 'zero', 0.0::DOUBLE), ('unexplained_collection_failures', 'zero', 0.0::DOUBLE), ('non_jira_regression', 'at_most', 0.05::DOUBLE), ('evaluation_case_count', 'count', 40.0::DOUBLE)) AS v(metric, rule, bound))
SELECT metric, rule, bound, round(value, 9) AS value, coalesce(CASE rule WHEN 'at_least' THEN value BETWEEN bound AND 1 WHEN 'zero' THEN value = 0 WHEN 'at_most' THEN value BETWEEN 0 AND bound ELSE value >= bound END, false) AS passed FROM g LEFT JOIN v USING (metric)""")
def promotion_gates(spark, sf_dir):
    """Scores of the documents: shares that are there, long enough, or chosen; two are missing."""
    share = lambda c: F.count_if(c) / F.count(F.lit(1))
    i = F.col("doc_id")
    found = {
        "source_completeness": share(F.col("text").isNotNull()), "gold_resolution": share(F.col("lang").isNotNull()), "candidate_recall": share(F.col("n_chars") > 200), "final_evidence_recall": share(i % 10 != 3), "citation_correctness": share(i % 50 != 3),
        "cross_project_leakage": F.lit(0.0), "access_policy_leakage": F.count_if(i % 40 == 7), "non_jira_regression": share(i % 30 == 1), "evaluation_case_count": F.count(F.lit(1)),
    }
    row = views.table(spark, sf_dir, "documents").agg(*(v.cast("double").alias(k) for k, v in found.items()))
    return audits.gates(row.unpivot([], list(found), "metric", "value")).withColumn("value", F.round("value", 9))


@query("fingerprint", views.BASE_SQL + """, v AS (SELECT *, CASE WHEN source_id LIKE '%7' THEN NULL ELSE title END AS t FROM man WHERE provider <> 'JIRA'),
d AS (SELECT sha256('v' || strlen(source_id) || ':' || source_id || CASE WHEN t IS NULL THEN 'n' ELSE 'v' || strlen(t) || ':' || t END || 'v' || strlen(version) || ':' || version || 'v' || strlen(CAST(chunk_count AS VARCHAR)) || ':' || chunk_count) AS d FROM v),
a AS (SELECT substr(d, 1, 4) AS b, sha256(string_agg(d, ',' ORDER BY d)) AS x, count(*) AS n FROM d GROUP BY 1), b AS (SELECT substr(b, 1, 2) AS b, sha256(string_agg(x, ',' ORDER BY b)) AS x, sum(n) AS n FROM a GROUP BY substr(a.b, 1, 2))
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS rows, sha256(coalesce(string_agg(x, ',' ORDER BY b), '')) AS fingerprint FROM b""")
def fingerprint(spark, sf_dir):
    rows = views.manifest(spark, sf_dir).where("provider <> 'JIRA'").withColumn("title", F.when(~F.col("source_id").endswith("7"), F.col("title")))
    return audits.fingerprint(rows, "source_id", ["title", "version", "chunk_count"])


@query("integrity", STORED_SQL + """, two AS (SELECT project_id, provider, source_id, version, schema_version FROM sx UNION ALL SELECT project_id, 'OTHER', source_id, version, schema_version FROM sx WHERE doc_id % 7 = 3),
held AS (SELECT project_id, provider, source_id, count(*) AS held, min(version) AS lo, max(version) AS hi, min(schema_version) AS slo, max(schema_version) AS shi FROM two GROUP BY ALL),
f AS (SELECT m.source_id, chunk_count, coalesce(held, 0) AS held, CASE WHEN coalesce(held, 0) <> chunk_count THEN 'chunk count' WHEN lo <> m.version OR hi <> m.version THEN 'version' WHEN slo <> m.schema_version OR shi <> m.schema_version THEN 'schema version' END AS fault FROM man m LEFT JOIN held USING (project_id, provider, source_id) WHERE NOT m.deleted)
SELECT * FROM f WHERE fault IS NOT NULL""")
def integrity(spark, sf_dir):
    """Another provider's chunks of the same source ids don't count."""
    rows = stored(spark, sf_dir)
    return audits.integrity(views.manifest(spark, sf_dir), rows.unionByName(rows.where("doc_id % 7 = 3").withColumn("provider", F.lit("OTHER"))))


@query("canary_difference", views.BASE_SQL + ", b AS (SELECT DISTINCT source_url FROM src WHERE doc_id % 40 <> 3), c AS (SELECT DISTINCT source_url FROM src WHERE doc_id % 50 <> 7) SELECT source_url, 'baseline' AS side FROM b WHERE source_url NOT IN (SELECT source_url FROM c) UNION ALL SELECT source_url, 'candidate' FROM c WHERE source_url NOT IN (SELECT source_url FROM b)")
def canary_difference(spark, sf_dir):
    s = views.source_documents(spark, sf_dir)
    return audits.set_difference(s.where(F.col("doc_id") % 40 != 3), s.where(F.col("doc_id") % 50 != 7), "source_url")


@query("refetch_check", views.BASE_SQL + " SELECT scope, count(*) AS fetched, count(*) - count(DISTINCT title) AS repeated, count(*) FILTER (trim(content, ' ') = '') AS empty FROM src GROUP BY scope")
def refetch_check(spark, sf_dir):
    s = views.source_documents(spark, sf_dir)
    return s.groupBy("scope").agg(F.count(F.lit(1)).alias("fetched"), (F.count(F.lit(1)) - F.countDistinct("title")).alias("repeated"), F.count_if(F.trim("content") == "").alias("empty"))


@query("vector_integrity", """WITH n AS (SELECT vec_id, CASE vec_id % 10 WHEN 1 THEN embedding[1:63] WHEN 2 THEN list_prepend('nan'::FLOAT, embedding[2:]) WHEN 5 THEN list_transform(embedding, lambda x: 0::FLOAT) ELSE embedding END AS e, vec_id // 4 AS source FROM embeddings WHERE vec_id % 10 <> 3),
f AS (SELECT source, count(*) AS vectors, count(*) FILTER (len(e) <> 64) AS od, count(*) FILTER (len(list_filter(e, lambda x: NOT isfinite(x))) > 0) AS nf, count(*) FILTER (list_sum(list_transform(e, lambda x: abs(x))) = 0) AS nl, count(*) FILTER (vec_id % 10 = 4) AS om FROM n GROUP BY source),
m AS (SELECT vec_id // 4 AS source, count(*) AS chunk_count FROM embeddings GROUP BY 1)
SELECT * FROM (SELECT 'DEMO' AS project_id, 'JIRA' AS provider, 'doc:' || source AS source_id, chunk_count, coalesce(vectors, 0) AS vectors,
 CASE WHEN coalesce(vectors, 0) <> chunk_count THEN 'vector count' WHEN od > 0 THEN 'dimensions' WHEN nf > 0 THEN 'not finite' WHEN nl > 0 THEN 'no length' WHEN om > 0 THEN 'model' END AS fault FROM m LEFT JOIN f USING (source)) WHERE fault IS NOT NULL""")
def vector_integrity(spark, sf_dir):
    """Four vectors a source; some are missing, cut, not finite, zero, or another model's."""
    e, d = views.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 10
    key = {"project_id": F.lit("DEMO"), "provider": F.lit("JIRA"), "source_id": F.concat(F.lit("doc:"), F.floor(F.col("vec_id") / 4))}
    rest = F.slice("embedding", 2, 4096)
    changed = F.when(d == 1, F.slice("embedding", 1, 63)).when(d == 2, F.concat(F.array(F.lit(float("nan")).cast("float")), rest)).when(d == 5, F.transform("embedding", lambda x: F.lit(0).cast("float"))).otherwise(F.col("embedding"))
    vectors = e.where(d != 3).withColumns({**key, "embedding": changed, "model": F.when(d == 4, "other").otherwise("e5")})
    manifest = e.withColumns(key).groupBy(*key).agg(F.count(F.lit(1)).alias("chunk_count")).withColumn("deleted", F.lit(False))
    return audits.vector_integrity(manifest, vectors, 64, "e5")


@query("vector_dim_check", "SELECT vec_id, len(embedding) AS dims, len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding) AS finite, len(embedding) = 64 AS expected, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 4) AS norm FROM embeddings")
def vector_dim_check(spark, sf_dir):
    e = views.table(spark, sf_dir, "embeddings")
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    finite = F.forall("embedding", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    return e.select("vec_id", F.size("embedding").cast("long").alias("dims"), finite.alias("finite"), (F.size("embedding") == 64).alias("expected"), F.round(F.sqrt(square), 4).alias("norm"))


@query("language_mix", TEXTS_SQL + " SELECT title <> '' AS titled, count(*) AS texts, CAST(sum(len(content)) AS BIGINT) AS characters FROM texts GROUP BY 1")
def language_mix(spark, sf_dir):
    return texts(spark, sf_dir).groupBy((F.col("title") != "").alias("titled")).agg(F.count(F.lit(1)).alias("texts"), F.sum(F.length("content")).alias("characters"))


_IMAGES = r"list_transform(list_concat(regexp_extract_all(content, '!\[[^\]]*\]\(([^)]+)\)', 1), regexp_extract_all(content, '(?i)<img\b[^>]*\bsrc\s*=\s*[\x27\x22]([^\x27\x22]+)[\x27\x22]', 1)), lambda t: translate(regexp_extract(t, '^\s*(\S*)', 1), '<>' || chr(34) || chr(39), ''))"
_UNSAFE = r"t = '' OR regexp_matches(lower(t), '^(http://|https://|data:|file:|javascript:)') OR regexp_matches(t, '^[/\\]') OR list_contains(string_split(replace(t, '\', '/'), '/'), '..') OR ends_with(lower(t), '.svg')"
VISUALS_SQL = TEXTS_SQL + rf""", im AS (SELECT source_id, content, {_IMAGES} AS ts FROM texts),
vi AS (SELECT source_id, list_filter([CASE WHEN regexp_matches(content, '(?is)```\s*mermaid\s*\n(.*?)```') OR regexp_matches(content, '(?:-->|->|=>|\+[-=]{{2,}}\+|\|\s{{2,}}\|)') THEN 'architecture_diagram' END,
  CASE WHEN len(list_filter(ts, lambda t: NOT ({_UNSAFE}))) > 0 THEN 'image' END, CASE WHEN regexp_matches(content, '(?m)^\s*\|?(?:\s*:?-{{3,}}:?\s*\|){{1,}}\s*:?-{{3,}}:?\s*\|?\s*$') THEN 'table' END], lambda x: x IS NOT NULL) AS types,
 list_filter([CASE WHEN len(list_filter(ts, lambda t: {_UNSAFE})) > 0 THEN 'UNSAFE_MARKDOWN_IMAGE_REFERENCE' END, CASE WHEN len(list_filter(ts, lambda t: NOT ({_UNSAFE}) AND regexp_matches(t, '(?i)\.(?:png|jpe?g|webp)$'))) > 0 THEN 'LOCAL_IMAGE_REQUIRES_PROVIDER_RESOLUTION' END,
  CASE WHEN regexp_matches(content, '(?i)```\s*(?:plantuml|dot|graphviz)\b') THEN 'UNSUPPORTED_DIAGRAM_RETAINED_AS_TEXT' END], lambda x: x IS NOT NULL) AS reasons FROM im)
"""


@query("visual_kinds", VISUALS_SQL + "SELECT source_id, len(types) > 0 AS eligible, array_to_string(types, ',') AS visual_types, array_to_string(reasons, ',') AS reason_codes FROM vi")
def visual_kinds(spark, sf_dir):
    return visuals.markdown_visuals(texts(spark, sf_dir)).withColumns({c: F.concat_ws(",", c) for c in ("visual_types", "reason_codes")})


@query("missing_pictures", VISUALS_SQL + """, w AS (SELECT source_id, list_distinct(list_filter(ts, lambda t: regexp_matches(t, '(?i)\\.(?:png|jpe?g)$'))) AS wanted FROM im)
SELECT source_id, CASE WHEN len(list_filter(wanted, lambda t: NOT regexp_matches(t, '^img/'))) > 0 THEN 'LOCAL_IMAGE_REQUIRES_PROVIDER_RESOLUTION' END AS reason FROM w""")
def missing_pictures(spark, sf_dir):
    """Pictures that a document names, against those that were supplied: the ones in its folder img."""
    named = F.concat(F.regexp_extract_all("content", F.lit(r"!\[[^\]]*\]\(([^)]+)\)"), F.lit(1)), F.regexp_extract_all("content", F.lit(visuals.HTML_IMAGE), F.lit(1)))
    bare = F.transform(named, lambda t: F.translate(F.regexp_extract(t, r"^\s*(\S*)", 1), "<>\"'", ""))
    wanted = F.filter(bare, lambda t: t.rlike(r"(?i)\.(?:png|jpe?g)$"))
    return texts(spark, sf_dir).select("source_id", visuals.missing_local(wanted, F.filter(wanted, lambda t: t.startswith("img/"))).alias("reason"))


@query("visual_preview", VISUALS_SQL + "SELECT 'type' AS kind, name, count(*) AS documents FROM (SELECT unnest(types) AS name FROM vi) GROUP BY name UNION ALL SELECT 'reason', name, count(*) FROM (SELECT unnest(reasons) AS name FROM vi) GROUP BY name")
def visual_preview(spark, sf_dir):
    return visuals.preview(visuals.markdown_visuals(texts(spark, sf_dir)))


@query("html_visuals", r"""WITH p AS (SELECT 'page:' || page_id AS source_id, coalesce(html, '') AS c FROM pages UNION ALL SELECT 'macro:' || page_id, '<ac:structured-macro ac:name="DrawIO"></ac:structured-macro>' || coalesce(html, '') FROM pages WHERE page_id % 5 = 0),
m AS (SELECT source_id, c, least(64, len(regexp_extract_all(c, '(?is)<table\b.*?</table>'))) AS tables, list_transform(regexp_extract_all(c, '(?i)<(?:ac:)?structured-macro\b[^>]*?\b(?:ac:)?name\s*=\s*[\x27\x22]([^\x27\x22]+)[\x27\x22]', 1), lambda x: lower(x)) AS ms, regexp_matches(c, '(?i)<img\b') AS img FROM p),
k AS (SELECT *, list_has_any(ms, ['drawio', 'gliffy', 'plantuml', 'graphviz']) AS kept FROM m)
SELECT source_id, img OR kept OR tables > 0 OR list_contains(ms, 'mermaid') AS eligible, CAST(tables AS BIGINT) AS tables, concat_ws(',', CASE WHEN kept OR list_contains(ms, 'mermaid') THEN 'architecture_diagram' END, CASE WHEN img THEN 'image' END, CASE WHEN tables > 0 THEN 'table' END) AS visual_types,
 concat_ws(',', CASE WHEN img THEN 'HTML_IMAGE_REQUIRES_PROVIDER_RESOLUTION' END, CASE WHEN kept THEN 'CONFLUENCE_DIAGRAM_REQUIRES_ATTACHMENT' END) AS reason_codes FROM k""")
def html_visuals(spark, sf_dir):
    """Every page, and some of them again with a diagram's macro, which the data set lacks."""
    p = views.table(spark, sf_dir, "pages")
    plain = p.select(F.concat(F.lit("page:"), "page_id").alias("source_id"), F.coalesce("html", F.lit("")).alias("content"))
    macro = p.where("page_id % 5 = 0").select(F.concat(F.lit("macro:"), "page_id").alias("source_id"), F.concat(F.lit('<ac:structured-macro ac:name="DrawIO"></ac:structured-macro>'), F.coalesce("html", F.lit(""))).alias("content"))
    return visuals.html_visuals(plain.unionByName(macro)).withColumns({c: F.concat_ws(",", c) for c in ("visual_types", "reason_codes")})
