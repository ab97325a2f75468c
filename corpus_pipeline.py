"""A training corpus from raw documents: language, exact copies, near copies, mixture, packed sequences."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweir.llm import exact_dedup, language_id, mixing, near_dedup, packing
from docweir.llm.common import bitmap_of, nameless, read, remove, shared_dir, with_bit

#: A text that is out of place in every learned profile by more than this is in none of the languages.
LEAST_SCORE = 0.05


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters (null and empty ones, too), and those that are out of place in every learned language.

    Where no language can be learned, only the former go. An empty table gives no rows.
    """
    profiles = language_id.fitted(docs)
    if not profiles:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    plain, names = nameless(docs)  # a column of docs may have the name of a verdict
    judged = language_id.predict(plain, profiles, names["text"])
    return judged.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("lang_score") >= LEAST_SCORE)).select(*plain.columns).toDF(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts: the one with the largest id; null texts are empty, rows that repeat are one."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of near copies, by shingles of five words.

    Rows that share an id go only together. Only rows that a fixed-size bitmap of dropped ids
    suspects are shuffled.
    """
    verdicts = near_dedup.near_duplicates(docs).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    dropped = verdicts.where(~F.col("kept")).select(F.col("doc_id").alias("_dw_id"))
    plain, names = nameless(docs)
    own = F.col(names["doc_id"])
    marked = with_bit(plain, own, bitmap_of(dropped, F.col("_dw_id")), "_dw_open")
    passed = marked.where(~F.col("_dw_open")).drop("_dw_open")
    suspects = marked.where("_dw_open").drop("_dw_open")
    return passed.unionByName(suspects.join(dropped, own.eqNullSafe(F.col("_dw_id")), "left_anti")).toDF(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: what it takes of the words, over the words, rounded to whole copies.

    Documents without words (null, empty, blank) aren't taken. Rows that share an id are taken as
    often as all of them together are; null ids are one id. An empty table gives no rows.
    """
    taken = mixing.mix(docs).groupBy("doc_id").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    copies = taken.where("size > 0").select(F.col("doc_id").alias("_dw_id"), F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("_dw_copies")).where("_dw_copies > 0")
    plain, names = nameless(docs)
    joined = plain.join(copies, F.col(names["doc_id"]).eqNullSafe(F.col("_dw_id")))
    return joined.withColumn("_dw_copy", F.explode(F.sequence(F.lit(1), F.col("_dw_copies")))).select(*plain.columns).toDF(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: the pieces of every row and where they stand; ids may be null or repeat, null texts are empty."""
    return packing.pack(docs)


STAGES = [("language id", language), ("exact dedup", exact), ("near dedup", near), ("mixing", mixed), ("packing", packed)]

#: Language profiles, MinHash components and the packing can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; what one returns is written as Parquet in the shared folder and read by the next, and then removed."""
    docs = read(spark, sf_dir, "documents")
    where = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{where}/{k}")
        docs = spark.read.parquet(f"{where}/{k}")
        if k:
            remove(spark, f"{where}/{k - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
