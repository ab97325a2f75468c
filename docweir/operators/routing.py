"""What a scan does with each document: compare with the manifest, route, and commit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docweir.schemas import KEY
from docweir.shared import stored

#: A document is unchanged while all of these agree with its manifest.
FENCES = ("version", "content_hash", "parser_version", "chunker_version", "embedding_profile", "schema_version", "access_policy_id")
#: Most characters that a manifest stores of each.
LIMITS = {"title": 1000, "source_url": 1500, "version": 500}
EMPTY_HASH = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
#: Chunker versions of Jira sources carry this, since their chunks hold more context.
JIRA_SUFFIX = ".jira-context-v3"


def effective_chunker(base: Column, provider: Column) -> Column:
    """The chunker version that a document is compared by."""
    return F.when(provider == "JIRA", F.concat(base, F.lit(JIRA_SUFFIX))).otherwise(base)


def route(docs: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """docs with operation (INDEX, DELETE, SKIP) and reason: a left join on the source's key.

    docs carry the fences' current values. A deleted document is deleted while its manifest lives;
    any other is skipped only if every fence agrees, null-safely.
    """
    known = manifest.select(*KEY, F.lit(True).alias("_known"), F.col("deleted").alias("_gone"), *(F.col(f).alias(f"_{f}") for f in FENCES))
    joined = docs.join(known, KEY, "left")
    seen = F.coalesce("_known", F.lit(False))
    live = seen & ~F.coalesce("_gone", F.lit(False))
    changed = F.coalesce(*(F.when(~F.col(f).eqNullSafe(F.col(f"_{f}")), f"{f} changed") for f in FENCES))
    reason = (
        F.when(F.col("deleted") & live, "source deleted")
        .when(F.col("deleted"), "already absent")
        .when(F.lit(force), "forced")
        .when(~seen, "new source")
        .when(~live, "tombstoned")
        .otherwise(F.coalesce(changed, F.lit("unchanged")))
    )
    operation = F.when(reason == "source deleted", "DELETE").when(reason.isin("already absent", "unchanged"), "SKIP").otherwise("INDEX")
    return joined.select(*docs.columns, operation.alias("operation"), reason.alias("reason"))


def fast_skip(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """The listed sources whose body must be read: version or policy differ, or nothing live is known. Bodies aren't touched."""
    known = manifest.where(~F.col("deleted")).select(*KEY, F.col("version").alias("_version"), F.col("access_policy_id").alias("_policy"))
    same = F.col("version").eqNullSafe(F.col("_version")) & F.col("access_policy_id").eqNullSafe(F.col("_policy"))
    return listing.join(known, KEY, "left").where(~(same & F.col("_version").isNotNull())).select(*listing.columns)


def stale(manifest: DataFrame, scan: DataFrame) -> DataFrame:
    """Live manifests whose source the scan didn't see: a left anti join."""
    return manifest.where(~F.col("deleted")).join(scan.select(*KEY), KEY, "left_anti")


def guarded_stale(manifest: DataFrame, scan: DataFrame, floor: int = 1) -> DataFrame:
    """What may be deleted: stale rows of scopes where the scan saw at least `floor` sources, and never of Jira."""
    scope = KEY[:-1]
    seen = scan.groupBy(*scope).agg(F.count(F.lit(1)).alias("_seen")).where(F.col("_seen") >= floor)
    return stale(manifest, scan).where(F.col("provider") != "JIRA").join(seen.select(*scope), scope, "left_semi")


def tombstones(manifest: DataFrame, gone: DataFrame, run: str) -> DataFrame:
    """Manifests of the sources in gone, marked deleted."""
    marked = manifest.join(gone.select(*KEY), KEY, "left_semi")
    return marked.withColumns({"deleted": F.lit(True), "content_hash": F.lit(EMPTY_HASH), "chunk_count": F.lit(0).cast("long"), "last_seen_run": F.lit(run)})


def truncated(rows: DataFrame) -> DataFrame:
    """Manifest rows with the long texts cut to what is stored."""
    return rows.withColumns({c: F.substring(c, 1, n) for c, n in LIMITS.items()})


def commit(manifest: DataFrame, routed: DataFrame, run: str) -> DataFrame:
    """The manifest after a scan: indexed sources replaced, deleted ones tombstoned, skipped ones touched, others as they were.

    routed has the manifest's columns, and operation. Each side is keyed, so one full outer join decides.
    """
    columns = manifest.columns
    new = truncated(routed.select(*[c for c in columns if c not in ("last_seen_run", "deleted")], "operation")).withColumnsRenamed({c: f"_{c}" for c in columns if c not in KEY})
    joined = manifest.withColumn("_old", F.lit(True)).join(new, KEY, "full")
    index, delete, skip = (F.col("operation").eqNullSafe(x) for x in ("INDEX", "DELETE", "SKIP"))
    old = F.coalesce("_old", F.lit(False))
    out = {}
    for c in columns:
        if c == "deleted":
            out[c] = F.when(index, False).when(delete, True).otherwise(F.col(c))
        elif c == "last_seen_run":
            out[c] = F.when(index | delete | skip, F.lit(run)).otherwise(F.col(c))
        elif c == "content_hash":
            out[c] = F.when(index, F.col(f"_{c}")).when(delete, EMPTY_HASH).otherwise(F.col(c))
        elif c == "chunk_count":
            out[c] = F.when(index, F.col(f"_{c}")).when(delete, F.lit(0).cast("long")).otherwise(F.col(c))
        elif c not in KEY:
            out[c] = F.when(index, F.col(f"_{c}")).otherwise(F.col(c))
    return joined.where(old | index).select(*KEY, *(e.alias(c) for c, e in out.items())).select(*columns)


def scope_counters(routed: DataFrame, by: list[str]) -> DataFrame:
    """Counts of outcomes by scope, as a run reports them. Columns failed, excluded and visual (assets) count where there are any."""
    is_ = lambda op: F.count_if(F.col("operation") == op)
    return routed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("discovered"), is_("INDEX").alias("indexed"), is_("SKIP").alias("unchanged"), is_("DELETE").alias("deleted"),
        F.coalesce(F.sum(F.when(F.col("operation") == "INDEX", F.col("chunk_count"))), F.lit(0)).alias("chunks"),
        *(F.count_if(c).alias(c) for c in ("failed", "excluded") if c in routed.columns), *(F.coalesce(F.sum("visual"), F.lit(0)).alias("visual") for c in ("visual",) if c in routed.columns),
    )


def failure_budget(outcomes: DataFrame, by: list[str], budget: int = 5) -> DataFrame:
    """Per scope: failures, whether it is aborted, and whether its cursor may move (no failure at all)."""
    counted = outcomes.groupBy(*by).agg(F.count(F.lit(1)).alias("documents"), F.count_if("failed").alias("failures"))
    return counted.withColumns({"aborted": F.col("failures") >= budget, "commit_cursor": F.col("failures") == 0})


def changes_to_operations(changes: DataFrame, indexable: Column) -> DataFrame:
    """A change feed (path, status, previous_path, has_content) as (path, operation, reason).

    A rename is two rows: the old path goes, the new one is indexed. Statuses that aren't known and paths that can't be indexed are left out.
    """
    known = changes.where(F.col("status").isin("added", "modified", "removed", "renamed"))
    gone = known.where("status = 'renamed' and previous_path is not null").select(*[c for c in changes.columns if c not in ("path", "status", "previous_path", "has_content")], F.col("previous_path").alias("path"), F.lit("DELETE").alias("operation"), F.lit("renamed away").alias("reason"))
    operation = F.when(F.col("status") == "removed", "DELETE").when(F.col("has_content"), "INDEX").otherwise("SKIP")
    reason = F.when(F.col("status") == "removed", "removed").when(F.col("has_content"), F.col("status")).otherwise("no content")
    here = known.select(*[c for c in changes.columns if c not in ("path", "status", "previous_path", "has_content")], "path", operation.alias("operation"), reason.alias("reason"))
    return gone.unionByName(here).where(indexable)


def latest(events: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """The last event of each key."""
    last = events.groupBy(*([key] if isinstance(key, str) else key)).agg(F.max_by(F.struct(*events.columns), F.col(order)).alias("_last"))
    return last.select("_last.*")


def resumable(ledger: DataFrame, current: DataFrame, contract: str | None = None) -> DataFrame:
    """current sources with what a resumed run does: skip those whose last event finished the same version.

    A source is told by project, provider and id as far as both tables know them. Where contract is
    given, events of runs with another contract (settings, code, models) count for nothing.
    """
    key = [c for c in ("project_id", "provider", "source_id") if c in ledger.columns and c in current.columns]
    if contract is not None:
        ledger = ledger.where(F.col("contract").eqNullSafe(contract))
    done = latest(ledger, key, "sequence").select(*key, F.col("status").alias("last_status"), F.col("source_version").alias("_version"))
    joined = current.join(done, key, "left")
    finished = F.col("last_status").isin("indexed", "unchanged", "excluded") & (F.col("source_version") == F.col("_version"))
    return joined.select(*key, "source_version", "last_status", F.when(finished, "skip").otherwise("run").alias("decision"))


def roots_subtree(pages: DataFrame, roots: DataFrame | list[str]) -> DataFrame:
    """Pages (page_id, parent_id) at or below the roots (a list, or root_id), each with its depth below the nearest; cycles do no harm.

    Ancestors are doubled: a round knows every page's ancestor 1, 2, 4, ... steps up and the nearest
    root on the way, so rounds are as many as the depth has binary digits. Each is stored.
    """
    pages = stored(pages.select("page_id", "parent_id"))
    most = pages.count()
    if isinstance(roots, list):
        roots = pages.sparkSession.createDataFrame([(r,) for r in roots], "root_id string")
    known = roots.select(F.col("root_id").alias("page_id"), F.lit(0).alias("depth")).distinct()
    hit = pages.select("page_id").distinct().join(known, "page_id", "left")
    up, step = pages.where("parent_id is not null").select("page_id", F.col("parent_id").alias("above")).distinct(), 1
    while True:
        over = up.join(hit.where("depth is not null").select(F.col("page_id").alias("above"), "depth"), "above").groupBy("page_id").agg((F.min("depth") + step).alias("_far"))
        hit = stored(hit.join(over, "page_id", "left").select("page_id", F.least("depth", "_far").cast("int").alias("depth")))
        step *= 2
        if step > most:
            break
        up = stored(up.join(up.select(F.col("page_id").alias("above"), F.col("above").alias("_next")), "above").select("page_id", F.col("_next").alias("above")).distinct())
        if up.isEmpty():
            break
    return hit.where("depth is not null")


# What an owner and a repository may be called.
OWNER, REPOSITORY = r"^[A-Za-z0-9](?:[A-Za-z0-9-]{0,37}[A-Za-z0-9])?$", r"^[A-Za-z0-9_.-]{1,100}$"


def by_repository(requests: DataFrame, projects: DataFrame) -> DataFrame:
    """requests (owner, repository) with the project that the repository belongs to, or null; names that can't be one's find none."""
    valid = F.col("owner").rlike(OWNER) & F.col("repository").rlike(REPOSITORY)
    known = projects.where(valid).groupBy("owner", "repository").agg(F.min("project_id").alias("project_id"))
    return requests.join(known, ["owner", "repository"], "left").select(*requests.columns, "project_id", F.coalesce(valid, F.lit(False)).alias("valid"))


def numbered(df: DataFrame, by: list[str], order: list[Column | str], name: str = "ordinal") -> DataFrame:
    """df with a number from 0 in each group."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)) - 1)
