"""Audits of stored chunks, and the gates that a candidate must pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from docweir.functions import security, text
from docweir.schemas import SOURCE

LIMIT = 512
# Least scores, and counts that must be zero.
THRESHOLDS = {
    "source_completeness": 1.0, "gold_resolution": 1.0, "exact_key_status_accuracy": 1.0, "candidate_recall": 0.90, "final_evidence_recall": 0.85, "citation_correctness": 0.95,
    "grounded_answer_accuracy": 0.90,
}
ZERO = ("cross_project_leakage", "access_policy_leakage", "unexplained_collection_failures")
REQUIRED = ("project_id", "access_policy_id", "source_id", "source_url", "issue_key", "locator", "cloud_id")


def lengths(chunks: DataFrame, by: list[str]) -> DataFrame:
    """Least, median, 95th percentile (by rank 0.95 * (n + 1), between neighbours), most and mean of tokens."""
    counted = chunks.groupBy(*by, "tokens").agg(F.count(F.lit(1)).alias("c"))  # as many rows as there are lengths
    group = W.partitionBy(*by)
    counted = counted.withColumns({"n": F.sum("c").over(group), "upto": F.sum("c").over(group.orderBy("tokens"))})
    place = 0.95 * (F.col("n") + 1)
    low = F.greatest(F.lit(1), F.least(F.floor(place), F.col("n") - 1))
    at = lambda rank: F.min(F.when(F.col("upto") >= rank, F.col("tokens")))
    out = counted.groupBy(*by, "n").agg(
        F.min("tokens").alias("least"), F.percentile("tokens", 0.5, F.col("c")).alias("median"), at(low).alias("lo"), at(low + 1).alias("hi"), F.max("tokens").alias("most"), F.sum(F.col("tokens") * F.col("c")).alias("all")
    )
    part = place - F.floor(place)
    return out.select(*by, F.col("n").alias("chunks"), "least", "median", F.round(F.col("lo") * (1 - part) + F.coalesce("hi", "lo") * part, 6).alias("p95"), "most", F.round(F.col("all") / F.col("n"), 6).alias("mean"))


def findings(chunks: DataFrame, least_tokens: int = 8) -> DataFrame:
    """Per provider: how many chunks are truncated, fragments, without one passage prefix, or without a structure path."""
    prefixes = F.regexp_count("embedding_text", F.lit(r"(?i)\bpassage:\s*"))
    return chunks.groupBy("provider").agg(
        F.count(F.lit(1)).alias("chunks"), F.count_if(F.col("tokens") > LIMIT).alias("truncated"), F.count_if(F.col("tokens") < least_tokens).alias("fragments"),
        F.count_if(~F.col("embedding_text").startswith(text.PASSAGE) | (prefixes != 1)).alias("bad_prefix"), F.count_if(F.coalesce("structure_path", F.lit("")) == "").alias("contextless"),
    )


def duplicate_bodies(chunks: DataFrame) -> DataFrame:
    """Bodies that more than one chunk has, white space and case aside."""
    body = F.lower(text.collapsed(F.col("body")))
    return chunks.where(body != "").groupBy(F.sha2(body, 256).alias("digest")).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").withColumn("extra", F.col("copies") - 1)


def defects(chunks: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """(chunk_id, reasons) of chunks with anything wrong; a chunk's second row with its id is a duplicate."""
    nth = F.row_number().over(W.partitionBy("chunk_id").orderBy("ordinal"))
    reasons = F.array_compact(F.array(
        F.when(F.col("_nth") > 1, "duplicate_identity"), F.when(~F.col("embedding_text").startswith(text.PASSAGE), "missing_passage_prefix"),
        F.when(~F.col("embedding_text").endswith(F.col("body")), "body_not_fully_embedded"), F.when(F.col("tokens") > LIMIT, "embedding_overflow"),
        *(F.when(F.coalesce(F.col(c), F.lit("")) == "", f"missing_{c}") for c in required), F.when(F.trim("body") == "", "empty_chunk"),
    ))
    return chunks.withColumn("_nth", nth).select("chunk_id", "ordinal", reasons.alias("reasons")).where(F.size("reasons") > 0)


def summary(chunks: DataFrame, by: list[str], required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Per group: chunks, issues, least, median and most tokens, how many chunks have defects, and whether none has."""
    bad = defects(chunks, required).groupBy("chunk_id", "ordinal").agg(F.count(F.lit(1)).alias("_bad"))
    rows = chunks.join(bad, ["chunk_id", "ordinal"], "left")
    out = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("chunks"), F.countDistinct("source_id").alias("issues"), F.min("tokens").alias("least"), F.median("tokens").alias("median"), F.max("tokens").alias("most"), F.count("_bad").alias("defects"),
    )
    return out.withColumn("passed", F.col("defects") == 0)


def gates(scores: DataFrame) -> DataFrame:
    """Every gate with passed; a score that is missing has failed."""
    rows = [(m, "at_least", t) for m, t in THRESHOLDS.items()] + [(m, "zero", 0.0) for m in ZERO] + [("non_jira_regression", "at_most", 0.05), ("evaluation_case_count", "count", 40.0)]
    table = scores.sparkSession.createDataFrame(rows, "metric string, rule string, bound double")
    joined = table.join(scores, "metric", "left")
    value, bound = F.col("value"), F.col("bound")
    passed = (
        F.when(F.col("rule") == "at_least", value.between(bound, 1)).when(F.col("rule") == "zero", value == 0).when(F.col("rule") == "at_most", value.between(0, bound)).otherwise(value >= bound)
    )
    return joined.select("metric", "rule", "bound", "value", F.coalesce(passed, F.lit(False)).alias("passed"))


def fingerprint(rows: DataFrame, key: str, payload: list[str]) -> DataFrame:
    """One digest of all rows, regardless of their order.

    Values are led by their lengths, and nulls have a mark of their own, so no two rows look alike. Rows are digested; the sorted digests that begin alike are digested together, first by four
    digits, then by two, then all, so that no row of the tree holds more than about a 65,536th of the rows. Every row's whole digest is in it: none can be lost, doubled or changed unseen,
    nor rows be chosen that make up for others.
    """
    framed = lambda c: F.when(F.col(c).isNull(), "n").otherwise(F.concat(F.lit("v"), F.octet_length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")))
    digest = F.sha2(F.concat(*map(framed, [key, *payload])), 256)
    level = rows.select(digest.alias("d"), digest.alias("x"), F.lit(1).cast("long").alias("n"))
    inside = F.sha2(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("d", "x"))), lambda s: s["x"])), 256)
    for digits in (4, 2):
        level = level.groupBy(F.substring("d", 1, digits).alias("d")).agg(inside.alias("x"), F.sum("n").alias("n"))
    return level.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), inside.alias("fingerprint"))


class Changed(RuntimeError):
    """Rows that were copied aren't what they were when the copy began, or the copy isn't what they are."""


def cloned(rows: DataFrame, where: str, key: str, payload: list[str]) -> DataFrame:
    """A copy of rows at where, read from there. What is copied is fingerprinted before and after, and so is the copy; where they differ, that is a Changed."""
    before = fingerprint(rows, key, payload).head()
    rows.write.parquet(where)
    copy = rows.sparkSession.read.schema(rows.schema).parquet(where)
    if not before == fingerprint(copy, key, payload).head() == fingerprint(rows, key, payload).head():
        raise Changed(f"{where} isn't a copy of what was to be copied")
    return copy


def integrity(manifest: DataFrame, stored: DataFrame) -> DataFrame:
    """Live manifests whose stored chunks (by project, provider and source) don't agree in number, version or schema."""
    held = stored.groupBy(*SOURCE).agg(F.count(F.lit(1)).alias("held"), F.min("version").alias("_low"), F.max("version").alias("_high"), F.min("schema_version").alias("_slow"), F.max("schema_version").alias("_shigh"))
    joined = manifest.where(~F.col("deleted")).join(held, SOURCE, "left")
    fault = (
        F.when(F.coalesce("held", F.lit(0)) != F.col("chunk_count"), "chunk count")
        .when((F.col("_low") != F.col("version")) | (F.col("_high") != F.col("version")), "version")
        .when((F.col("_slow") != F.col("schema_version")) | (F.col("_shigh") != F.col("schema_version")), "schema version")
    )
    return joined.select("source_id", "chunk_count", F.coalesce("held", F.lit(0)).cast("long").alias("held"), fault.alias("fault")).where("fault is not null")


def vector_facts(vectors: DataFrame, dims: int, vector: str = "embedding") -> DataFrame:
    """Per source (project_id, provider, source_id): vectors, and how many have other dimensions, entries that aren't finite, or no length; least and greatest model."""
    v = F.col(vector)
    finite = v.isNotNull() & F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    square = F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    bad = lambda c: F.count_if(F.coalesce(c, F.lit(True)))
    return vectors.groupBy(*SOURCE).agg(
        F.count(F.lit(1)).alias("vectors"), bad(F.size(v) != dims).alias("other_dims"), bad(~finite).alias("not_finite"), bad(finite & (square == 0)).alias("no_length"), F.min("model").alias("_low_model"), F.max("model").alias("_high_model"),
    )


def vector_integrity(manifest: DataFrame, vectors: DataFrame, dims: int, model: str) -> DataFrame:
    """Live manifests (chunk_count) whose vectors aren't as many, of such dimensions, finite, of some length, and of one model; one aggregate a source."""
    joined = manifest.where(~F.col("deleted")).join(vector_facts(vectors, dims), SOURCE, "left")
    fault = (
        F.when(F.coalesce("vectors", F.lit(0)) != F.col("chunk_count"), "vector count").when(F.col("other_dims") > 0, "dimensions").when(F.col("not_finite") > 0, "not finite")
        .when(F.col("no_length") > 0, "no length").when((F.col("_low_model") != model) | (F.col("_high_model") != model), "model")
    )
    return joined.select(*SOURCE, "chunk_count", F.coalesce("vectors", F.lit(0)).cast("long").alias("vectors"), fault.alias("fault")).where("fault is not null")


def kinds(chunks: DataFrame, kind: str = "kind", noise: str | None = None) -> DataFrame:
    """Per kind of chunk (source_id, body): sources, chunks, least, median and most characters, and how many hold what a transport leaves behind (noise, a pattern)."""
    n = F.length("body").cast("long")
    noisy = F.count_if(F.col("body").rlike(noise)) if noise else F.lit(0).cast("long")
    return chunks.groupBy(F.col(kind).alias("kind")).agg(F.countDistinct("source_id").alias("sources"), F.count(F.lit(1)).alias("chunks"), F.min(n).alias("least"), F.median(n).alias("median"), F.max(n).alias("most"), noisy.alias("noise"))


def secret_findings(chunks: DataFrame, fields: list[str]) -> DataFrame:
    """(chunk_id, field, explicit, entropy) of every field of a chunk, its maps' values included, in which a credential shows; the values stay where they are."""

    def values(field: str) -> Column:
        if not isinstance(chunks.schema[field].dataType, T.MapType):
            return F.array(F.struct(F.lit(field).alias("field"), F.col(field).alias("value")))
        entries = F.map_entries(F.coalesce(field, F.create_map().cast("map<string,string>")))
        return F.transform(entries, lambda e: F.struct(F.concat(F.lit(f"{field}."), e["key"]).alias("field"), e["value"].alias("value")))

    rows = chunks.select("chunk_id", F.explode(F.concat(*map(values, fields))).alias("p")).select("chunk_id", "p.field", F.coalesce("p.value", F.lit("")).alias("value"))
    found = rows.select("chunk_id", "field", F.coalesce(security.has_secret(F.col("value")), F.lit(False)).alias("explicit"), F.coalesce(security.high_entropy(F.col("value")), F.lit(False)).alias("entropy"))
    return found.where("explicit or entropy")


def set_difference(one: DataFrame, two: DataFrame, column: str) -> DataFrame:
    """Values that only one side has, and which."""
    a, b = one.select(column).distinct(), two.select(column).distinct()
    return a.exceptAll(b).withColumn("side", F.lit("baseline")).unionByName(b.exceptAll(a).withColumn("side", F.lit("candidate")))
