"""Replacing what is stored of a source: upsert the new ids, verify them, drop what is obsolete."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweir.schemas import SOURCE


def storage_rows(sources: DataFrame) -> DataFrame:
    """One row per stored chunk of sources that hold _n chunks each, with its deterministic id."""
    rows = sources.where(F.col("_n") > 0).withColumn("ordinal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n").cast("long") - 1)))
    return rows.select(*SOURCE, "ordinal", storage_id().alias("storage_id"))


def storage_id():
    """The id of a chunk's record; a Jira record is keyed by chunk and version instead."""
    return F.sha2(F.concat_ws("|", "project_id", "provider", "source_id", F.col("ordinal").cast("string")), 256)


def jira_storage_id():
    return F.sha2(F.concat_ws("|", "chunk_id", "version"), 256)


def obsolete(old: DataFrame, new: DataFrame, touched: DataFrame) -> DataFrame:
    """Stored rows of touched sources (project_id, provider, source_id) that the new generation doesn't hold."""
    return old.join(touched, SOURCE, "left_semi").join(new.select("storage_id"), "storage_id", "left_anti")


def replaced(old: DataFrame, new: DataFrame, touched: DataFrame) -> DataFrame:
    """What is stored after the sources in touched were replaced by new; a source without new rows is gone."""
    return old.join(touched, SOURCE, "left_anti").unionByName(new)


def verified(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """How many expected ids there are, and how many are stored. Only if they agree may obsolete rows go."""
    marked = expected.select("storage_id").join(stored.select("storage_id").distinct().withColumn("_there", F.lit(True)), "storage_id", "left")
    return marked.agg(F.count(F.lit(1)).alias("expected"), F.count("_there").alias("written"))


def purge(rows: DataFrame, provider: str, scope: str | None = None) -> DataFrame:
    """rows without a provider, or without one of its scopes."""
    gone = F.col("provider") == provider
    return rows.where(~(gone & (F.col("scope") == scope) if scope is not None else gone))


def purge_plan(manifest: DataFrame, chunks: DataFrame, scopes: DataFrame, project: str, provider: str) -> DataFrame:
    """What purging a provider of a project takes, a row a scope: scope, sources, chunks, forgotten.

    All of its stored chunks go; those whose source has no manifest row are counted under a null
    scope. Manifest rows go in scopes (project_id, provider, scope) that are configured (forgotten):
    what a scan can't find again keeps its state. A source that is in several scopes counts in the least.
    """
    mine = (F.col("project_id") == project) & (F.col("provider") == provider)
    known = manifest.where(mine).groupBy("source_id").agg(F.min("scope").alias("scope"), F.lit(1).alias("_known"))
    held = chunks.where(mine).groupBy("source_id").agg(F.count(F.lit(1)).alias("_chunks"))
    found = known.join(held, "source_id", "full").groupBy("scope").agg(F.count("_known").alias("sources"), F.coalesce(F.sum("_chunks"), F.lit(0)).alias("chunks"))
    return found.join(scopes.where(mine).select("scope", F.lit(True).alias("_configured")).distinct(), "scope", "left").select("scope", "sources", "chunks", F.coalesce("_configured", F.lit(False)).alias("forgotten"))


def recovered_scopes(manifest: DataFrame, project: str) -> DataFrame:
    """(provider, scope, sources) under which a project has written manifests, for a configuration that was lost."""
    named = manifest.where((F.col("project_id") == project) & (F.col("provider") != "") & (F.col("scope") != ""))
    return named.groupBy(F.upper("provider").alias("provider"), "scope").agg(F.count(F.lit(1)).alias("sources"))


def scopes(projects: DataFrame) -> DataFrame:
    """(project_id, provider, scope) of every project: repositories by branch (main where none is named) and Jira projects."""
    branches = F.when(F.size("branches") == 0, F.array(F.lit("main"))).otherwise(F.col("branches"))
    code = projects.select("project_id", F.lit("GITHUB").alias("provider"), F.explode(branches).alias("branch"), "owner", "repository")
    code = code.select("project_id", "provider", F.concat(F.concat_ws("/", "owner", "repository"), F.lit("|"), "branch").alias("scope"))
    jira = projects.where("jira_site is not null").select("project_id", F.lit("JIRA").alias("provider"), F.concat_ws("|", "jira_site", "jira_key").alias("scope"))
    return code.unionByName(jira)
