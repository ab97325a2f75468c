"""Chunks from elements: identities, one body per source, flat metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docweir.functions import formats, text
from docweir.schemas import SOURCE

# Keys that a source's metadata can't set.
RESERVED = (
    "embedding_text", "canonical_chunk_id", "project_id", "access_policy_id", "provider", "source_id", "source_type", "source_version", "title", "reference", "source_url", "chunk_ordinal",
    "content_hash", "structure_hash", "parent_id", "record_kind", "schema_version", "embedding_model",
)


def identified(rows: DataFrame) -> DataFrame:
    """rows (project_id, provider, source_id, version, ordinal, body, locator, chunker_version) with digest and chunk_id.

    A Jira chunk is known by where it stands and what it says; any other by version and ordinal too.
    """
    rows = rows.withColumn("digest", F.sha2("body", 256))
    jira = F.concat_ws("|", "project_id", F.lit("JIRA"), "source_id", "locator", "digest", F.lit("jira-v2"))
    plain = F.concat_ws("|", "project_id", "provider", "source_id", "version", F.col("ordinal").cast("string"), "digest", "chunker_version")
    return rows.withColumn("chunk_id", F.sha2(F.when(F.col("provider") == "JIRA", jira).otherwise(plain), 256))


def first_bodies(chunks: DataFrame, identity: list[str] | None = None) -> DataFrame:
    """The first chunk, by ordinal, of each body in a source (project_id, provider, source_id). identity tells further bodies apart (a Jira chunk's kind and event)."""
    nth = F.row_number().over(W.partitionBy(*SOURCE, "digest", *(identity or [])).orderBy("ordinal"))
    return chunks.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def conflicts(chunks: DataFrame) -> DataFrame:
    """Ids that more than one chunk has; a sound run has none."""
    return chunks.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def safe_key(key: Column) -> Column:
    return F.substring(F.regexp_replace(key, "[^A-Za-z0-9_]", "_"), 1, 64)


def key_outcome(key: Column) -> Column:
    """What becomes of a metadata key: reserved (an error), dropped, or kept."""
    safe = safe_key(key)
    return F.when(safe.isin(*RESERVED), "reserved").when((safe == "") | safe.startswith("_"), "dropped").otherwise("kept")


def flattened(chunks: DataFrame) -> DataFrame:
    """chunks with what a store that takes only scalars needs of them.

    structure_path (an array) becomes JSON, with its first and last parts beside it; so do visual_types
    and visual_asset_ids where chunks have them, with the first of each; page_number is 0 where there is
    no page. metadata (a map of JSON or plain values), where there is one, becomes extra: its keys made
    safe, of two that become the same the last counts, nulls and hidden keys dropped. A key that is
    reserved is the chunk's failure, and only its own.
    """
    path = F.filter("structure_path", lambda x: x != "")
    out = {
        "structure_root": F.coalesce(F.try_element_at(path, F.lit(1)), F.lit("")), "structure_leaf": F.coalesce(F.try_element_at(path, F.lit(-1)), F.lit("")),
        "structure_path": F.to_json(path), "page_number": F.coalesce("page", F.lit(0)),
    }
    for several, one in (("visual_types", "visual_type"), ("visual_asset_ids", "visual_asset_id")):
        if several in chunks.columns:
            given = F.coalesce(F.col(several), F.array().cast("array<string>"))
            out |= {one: F.coalesce(F.try_element_at(given, F.lit(1)), F.lit("")), several: F.to_json(given)}
    if "metadata" in chunks.columns:
        pairs = F.transform(F.map_entries(F.coalesce("metadata", F.create_map().cast("map<string,string>"))), lambda e: F.struct(safe_key(e["key"]).alias("k"), e["value"].alias("v"), key_outcome(e["key"]).alias("o")))
        kept = F.filter(pairs, lambda e: (e["o"] == "kept") & e["v"].isNotNull())
        last = F.filter(kept, lambda e, i: ~F.array_contains(F.transform(F.slice(kept, i + 2, F.greatest(F.size(kept) - i - 1, F.lit(0))), lambda x: x["k"]), e["k"]))
        reserved = F.filter(pairs, lambda e: e["o"] == "reserved")
        out |= {"extra": F.map_from_entries(F.transform(last, lambda e: F.struct(e["k"], e["v"]))), "failure": F.concat(F.lit("reserved key: "), F.try_element_at(reserved, F.lit(1))["k"])}
    return chunks.withColumns(out)


def merged(*maps: Column) -> Column:
    """Maps in one: of a key that comes again the last value counts, and nulls count for nothing."""

    def both(one: Column, two: Column) -> Column:
        return F.map_concat(F.map_filter(one, lambda k, v: ~F.map_contains_key(two, k)), two)

    return reduce(both, (F.map_filter(F.coalesce(m, F.create_map().cast("map<string,string>")), lambda k, v: v.isNotNull()) for m in maps))


def assembled(chunks: DataFrame, docs: DataFrame, limit: int = 512) -> DataFrame:
    """Chunks as they are stored: identity, digests, embedding text and searchable fields.

    chunks are what chunk_documents makes of docs with their whole key (project_id, provider,
    source_id), without failures; docs have the key, version, chunker_version, title and, as far as
    they are known, what with_searchable looks at. Of equal bodies in a source the first stays; both are
    shuffled by their source once. A chunk whose values can't be framed has a failure and no embedding
    text; its source must not be stored.
    """
    keep = [c for c in docs.columns if c not in chunks.columns or c in SOURCE]
    rows = chunks.where("failure is null").drop("failure").join(docs.select(*keep), SOURCE)
    rows = rows.where(formats.says_something(F.col("content"))).withColumn("body", formats.clean(F.col("content"))).withColumns({"ordinal": F.col("ordinal").cast("long"), "kind": F.col("profile"), "heading_path": F.col("path")})
    rows = first_bodies(identified(rows))
    rows = rows.withColumn("structure_hash", F.sha2(F.to_json(F.struct("heading_path", "locator", "profile")), 256))
    rows = text.with_searchable(rows.drop("path"), "body", "heading_path")
    is_jira = F.col("provider") == "JIRA"
    required = F.concat(F.lit("passage: "), F.concat_ws(" > ", "title", "heading_path"))
    optional = [F.concat(F.lit("LOCATION: "), F.coalesce("locator", F.lit("source"))), F.when(is_jira, text.framed_context(F.col("searchable"))).otherwise(text.labelled_context(F.col("searchable")))]
    rows = rows.withColumn("failure", F.when(is_jira, text.framed_failure(F.col("searchable"))))
    rows = rows.withColumn("embedding_text", F.when(F.col("failure").isNull(), text.fitted(required, optional, F.col("body"), limit, F.col("searchable.chunk_token_count"))))
    return rows.select("project_id", "provider", "source_id", "version", "ordinal", "chunk_id", F.col("digest").alias("content_hash"), "structure_hash", "heading_path", "locator", "profile", "tokens", "body", "embedding_text", "searchable", "failure")
