"""What a policy's stored chunks talk about: observed values, counts, and a recommended cap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweir.functions import paths

LEAST_TYPE_COUNT = 5


def observed(column: str, upper: bool = False) -> Column:
    """Distinct values, sorted regardless of case; blanks are left out."""
    value = F.nullif(F.trim(column), F.lit(""))
    value = F.upper(value) if upper else value
    pairs = F.collect_set(F.when(value.isNotNull(), F.struct(F.lower(value).alias("folded"), value.alias("value"))))
    return F.transform(F.array_sort(pairs), lambda x: x["value"])


def by_policy(chunks: DataFrame) -> DataFrame:
    """Observed values of chunks (access_policy_id, entity, doc_category, provider, language), by policy; blank policies are left out."""
    return chunks.where(F.coalesce("access_policy_id", F.lit("")) != "").groupBy("access_policy_id").agg(
        observed("entity").alias("entities"), observed("doc_category").alias("categories"), observed("provider", upper=True).alias("providers"), observed("language").alias("languages")
    )


def type_counts(chunks: DataFrame) -> DataFrame:
    """Chunks of each source type by policy, and whether it is often enough to be listed."""
    kind = F.upper(F.trim("source_type"))
    counted = chunks.where(kind != "").groupBy("access_policy_id", kind.alias("source_type")).agg(F.count(F.lit(1)).alias("chunks"))
    return counted.withColumn("listed", F.col("chunks") >= LEAST_TYPE_COUNT)


def stats(chunks: DataFrame) -> DataFrame:
    """Sources, chunks, the median chunks of a source, and the cap that follows, by policy."""
    sources = chunks.groupBy("access_policy_id", "source_id").agg(F.count(F.lit(1)).alias("n"))
    out = sources.groupBy("access_policy_id").agg(F.count(F.lit(1)).alias("sources"), F.sum("n").alias("chunks"), F.median("n").alias("median_chunks"))
    return out.withColumn("cap", F.when(F.col("median_chunks") >= 20, 25).when(F.col("median_chunks") >= 8, 12).otherwise(3))


def code_extensions(chunks: DataFrame) -> DataFrame:
    """Extensions of the paths and titles of code, by policy."""
    both = chunks.where(F.upper("source_type") == "CODE").select("access_policy_id", F.explode(F.array("path", "title")).alias("name"))
    return both.select("access_policy_id", paths.suffix(F.col("name")).alias("extension")).where("extension <> ''").distinct()


def terms(chunks: DataFrame) -> DataFrame:
    """Distinct terms of Jira chunks: scalar fields, and labels that are a JSON list or one plain value."""
    jira = chunks.where("provider = 'JIRA'")
    listed = F.coalesce(F.from_json("labels_json", "array<string>"), F.array("labels_json"))
    both = F.concat(F.array("issue_key", "status"), F.when(F.col("labels_json").isNotNull(), listed).otherwise(F.array().cast("array<string>")))
    return jira.select("access_policy_id", F.explode(both).alias("term")).where("term <> ''").distinct()
