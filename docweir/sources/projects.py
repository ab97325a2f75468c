"""Project configuration: JSON payloads decoded with defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAYLOAD = "project_id string, collection string, schedule struct<enabled:boolean,branch:string>, embedding struct<model:string,dimensions:int>, batch int, rules array<struct<provider:string,prefix:string>>"
# Dimensions that embeddings may have.
DIMENSIONS = (384, 768, 1024)


def decoded(payloads: DataFrame, raw: str = "payload") -> DataFrame:
    """payloads with the decoded fields, defaults where they are absent, and what is wrong with them."""
    p = payloads.withColumn("p", F.from_json(raw, PAYLOAD))
    dims, batch = F.coalesce("p.embedding.dimensions", F.lit(1024)), F.coalesce("p.batch", F.lit(16))
    out = p.select(
        F.col("p.project_id").alias("project_id"), F.coalesce("p.collection", F.lit("documents")).alias("collection"), F.coalesce("p.schedule.enabled", F.lit(True)).alias("enabled"),
        F.coalesce("p.schedule.branch", F.lit("main")).alias("branch"), dims.alias("dimensions"), batch.alias("batch"), F.coalesce(F.size("p.rules"), F.lit(0)).alias("rules"),
    )
    return out.withColumn("fault", fault())


def fault() -> Column:
    return F.when(F.col("project_id").isNull(), "no project").when(~F.col("dimensions").isin(*DIMENSIONS), "dimensions").when(~F.col("batch").between(1, 64), "batch")
