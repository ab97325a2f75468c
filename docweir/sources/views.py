"""The data set's documents seen as a scan of sources, and a synthetic manifest of an earlier run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROJECT = "DEMO"
STAMPS = {"parser_version": "p1", "chunker_version": "c1", "embedding_profile": "e5", "schema_version": "s1"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data set."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as what a scan delivers. SOURCES_SQL says the same."""
    return as_sources(table(spark, sf_dir, "documents"))


def as_sources(d: DataFrame) -> DataFrame:
    """Rows of documents, of a table or a stream, with a source's columns."""
    provider = F.element_at(F.array(*map(F.lit, ("CONFLUENCE", "JIRA", "GITHUB"))), (F.col("doc_id") % 3 + 1).cast("int"))
    prefix = F.element_at(F.array(*map(F.lit, ("HR-Handbook ", "FIN-Report ", "Note ", "Guide ", "HR-Policy "))), (F.col("doc_id") % 5 + 1).cast("int"))
    suffix = F.element_at(F.array(*map(F.lit, (".md", ".txt", ".py", ".csv"))), (F.col("doc_id") % 4 + 1).cast("int"))
    text = F.coalesce("text", F.lit(""))
    out = d.select(
        "doc_id", F.lit(PROJECT).alias("project_id"), provider.alias("provider"), F.col("source").alias("scope"), F.concat(F.lit("doc:"), F.col("doc_id")).alias("source_id"),
        F.concat(prefix, F.col("doc_id")).alias("title"), F.concat("source", F.lit("/doc-"), "doc_id", suffix).alias("path"),
        F.upper("lang").alias("space_key"), F.array(F.concat(F.lit("team-"), "lang"), F.col("source")).alias("labels"),
        F.concat(F.lit("https://example.org/"), "doc_id").alias("source_url"), text.alias("content"), F.sha2(text, 256).alias("content_hash"),
        F.substring(F.sha2(text, 256), 1, 12).alias("version"), (F.col("doc_id") % 29 == 0).alias("deleted"),
        F.when(F.col("doc_id") % 17 != 0, F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60)).alias("updated_at"),
        F.regexp_count(text, F.lit(r"\S+")).cast("long").alias("tokens"),
    )
    kind = F.when(F.col("provider") == "JIRA", "ISSUE").when(F.col("provider") == "CONFLUENCE", "PAGE").when(F.col("path").endswith(".py"), "CODE").otherwise("FILE")
    chunks = F.greatest(F.lit(1), F.ceil(F.col("tokens") / 420)).cast("long")
    return out.withColumns({"source_type": kind, "chunk_count": chunks} | {k: F.lit(v) for k, v in STAMPS.items()})


SOURCES_SQL = """src AS (
SELECT *, CASE WHEN provider = 'JIRA' THEN 'ISSUE' WHEN provider = 'CONFLUENCE' THEN 'PAGE' WHEN ends_with(path, '.py') THEN 'CODE' ELSE 'FILE' END AS source_type,
       greatest(1, CAST(ceil(tokens / 420.0) AS BIGINT)) AS chunk_count, 'p1' AS parser_version, 'c1' AS chunker_version, 'e5' AS embedding_profile, 's1' AS schema_version
FROM (SELECT doc_id, 'DEMO' AS project_id, ['CONFLUENCE', 'JIRA', 'GITHUB'][doc_id % 3 + 1] AS provider, source AS scope, 'doc:' || doc_id AS source_id,
       ['HR-Handbook ', 'FIN-Report ', 'Note ', 'Guide ', 'HR-Policy '][doc_id % 5 + 1] || doc_id AS title,
       source || '/doc-' || doc_id || ['.md', '.txt', '.py', '.csv'][doc_id % 4 + 1] AS path, upper(lang) AS space_key, ['team-' || lang, source] AS labels,
       'https://example.org/' || doc_id AS source_url, coalesce(text, '') AS content, sha256(coalesce(text, '')) AS content_hash,
       substr(sha256(coalesce(text, '')), 1, 12) AS version, doc_id % 29 = 0 AS deleted,
       CASE WHEN doc_id % 17 <> 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id * 60) END AS updated_at,
       CAST(len(regexp_extract_all(coalesce(text, ''), '\\S+')) AS BIGINT) AS tokens
     FROM documents))"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an earlier run might have left: some sources absent, changed or tombstoned, and some that are gone now. MANIFEST_SQL says the same."""
    s = source_documents(spark, sf_dir)
    columns = ["project_id", "provider", "scope", "source_id", "source_type", "title", "source_url", "version", "content_hash", "chunk_count", "last_seen_run", "deleted", *STAMPS, "access_policy_id"]
    known = s.where(F.col("doc_id") % 10 != 0).withColumns({
        "version": F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("old-"), "version")).otherwise(F.col("version")),
        "schema_version": F.when(F.col("doc_id") % 19 == 0, "s0").otherwise(F.col("schema_version")),
        "deleted": F.col("doc_id") % 11 == 0, "last_seen_run": F.lit("run-1"), "access_policy_id": F.lit(f"project:{PROJECT}"),
    })
    gone = s.where(F.col("doc_id") % 13 == 0).withColumns({"source_id": F.concat(F.lit("doc:"), F.col("doc_id") + 1_000_000), "deleted": F.col("doc_id") % 2 == 0, "last_seen_run": F.lit("run-0"), "access_policy_id": F.lit(f"project:{PROJECT}")})
    return known.select(*columns).unionByName(gone.select(*columns))


MANIFEST_SQL = """man AS (
SELECT project_id, provider, scope, source_id, source_type, title, source_url, CASE WHEN doc_id % 7 = 0 THEN 'old-' || version ELSE version END AS version, content_hash,
       chunk_count, 'run-1' AS last_seen_run, doc_id % 11 = 0 AS deleted, parser_version, chunker_version, embedding_profile,
       CASE WHEN doc_id % 19 = 0 THEN 's0' ELSE schema_version END AS schema_version, 'project:DEMO' AS access_policy_id
FROM src WHERE doc_id % 10 <> 0
UNION ALL
SELECT project_id, provider, scope, 'doc:' || (doc_id + 1000000), source_type, title, source_url, version, content_hash, chunk_count, 'run-0', doc_id % 2 = 0,
       parser_version, chunker_version, embedding_profile, schema_version, 'project:DEMO'
FROM src WHERE doc_id % 13 = 0)"""

def twin_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source_documents, and for some of them a source of another provider that has the same id. TWINS_SQL says the same."""
    s = source_documents(spark, sf_dir)
    twins = s.where(F.col("doc_id") % 7 == 3).withColumns({"provider": F.lit("LOCAL"), "content": F.concat(F.lit("# Twin\n"), "content", F.lit("\n## Its own end\nsame\nsame"))})
    return s.unionByName(twins)


TWINS_SQL = """tw AS (SELECT * FROM src UNION ALL SELECT * REPLACE ('LOCAL' AS provider, '# Twin' || chr(10) || content || chr(10) || '## Its own end' || chr(10) || 'same' || chr(10) || 'same' AS content) FROM src WHERE doc_id % 7 = 3)"""

BASE_SQL = f"WITH {SOURCES_SQL},\n{MANIFEST_SQL}"
