"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docweir.llm.common import ascii_lower, bitmap_of, bits_for, checkpointed, nameless, read, with_bit

#: Characters of the text that the second level hashes.
PREFIX_CHARS = 64


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def _first_levels(text_col: str, prefix_chars: int) -> dict[str, Column]:
    """Byte length and prefix hash; null text counts as empty."""
    return {"_dw_len": F.octet_length(_text(text_col)), "_dw_prefix": F.xxhash64(ascii_lower(F.substring(_text(text_col), 1, prefix_chars)))}


def _full_hash(text_col: str) -> Column:
    return F.sha2(ascii_lower(_text(text_col)), 256)


def _judged(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int, hash_all: bool) -> DataFrame:
    narrow = docs.select(F.col(id_col).alias("_dw_id"), F.col(text_col).alias("_dw_text")).withColumns(_first_levels("_dw_text", prefix_chars))
    key = F.struct("_dw_len", "_dw_prefix")
    # Level one: lengths that occur once are out. Level two counts prefixes within the other lengths only.
    first = checkpointed(narrow.select("_dw_len", "_dw_prefix"))
    bits = bits_for(first.count() // 4)
    alike = first.groupBy("_dw_len").agg(F.count(F.lit(1)).alias("_dw_n")).where("_dw_n > 1")
    left = with_bit(first, F.col("_dw_len"), bitmap_of(alike, F.col("_dw_len")), "_dw_open").where("_dw_open")
    sizes = left.groupBy("_dw_len", "_dw_prefix").agg(F.count(F.lit(1)).alias("_dw_n")).where("_dw_n > 1")
    marked = with_bit(narrow, key, bitmap_of(sizes, key, bits), "_dw_open", bits)
    full = _full_hash("_dw_text") if hash_all else F.when(F.col("_dw_open"), _full_hash("_dw_text"))
    marked = checkpointed(marked.select("_dw_id", "_dw_len", "_dw_prefix", "_dw_open", full.alias("full_hash")))
    closed = marked.where(~F.col("_dw_open")).select("*", F.col("_dw_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    live = marked.where("_dw_open")
    facts = live.groupBy("_dw_len", "_dw_prefix", "full_hash").agg(F.max("_dw_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # The join's key is made after the aggregation: both sides are then shuffled by the join itself,
    # and the rows of a hot group can be split at run time.
    at = F.xxhash64("_dw_len", "_dw_prefix", "full_hash").alias("_dw_at")
    facts = facts.select(at, F.col("full_hash").alias("_dw_full"), F.col("_dw_len").alias("_dw_l"), F.col("_dw_prefix").alias("_dw_p"), "keep_id", "group_size")
    joined = live.select("*", at).join(facts, "_dw_at").where("full_hash = _dw_full and _dw_len = _dw_l and _dw_prefix = _dw_p").drop("_dw_at", "_dw_full", "_dw_l", "_dw_p")
    nth = F.row_number().over(W.partitionBy("_dw_id", "full_hash").orderBy("_dw_len"))
    return closed.unionByName(joined.withColumn("kept", F.col("_dw_id").eqNullSafe(F.col("keep_id")) & (nth == 1)))


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS, hash_all: bool = False) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, full_hash.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row with the
    largest id stays. Rows of one group that share the largest id are one document: one of them is
    kept. A null id ranks lowest; where a group has only null ids, keep_id is null and one row stays.
    An empty table gives no rows. Other columns, whatever their names, are left alone.

    Pass one reads length and prefix of every text, since a columnar scan has decoded the text by
    then, and stores just these. Level one counts lengths; level two counts prefix hashes of the rows
    whose length another row has; both are combined before the shuffle. What survives is kept as a
    bitmap of bounded size, so pass two hashes a full text, which is level three, only where its bit
    is set, and shuffles no text. full_hash is null elsewhere, unless hash_all asks for it everywhere;
    groups are made of survivors alone in either case.
    """
    found = _judged(docs, id_col, text_col, prefix_chars, hash_all)
    return found.select(F.col("_dw_id").alias(id_col), "keep_id", "group_size", "kept", "full_hash")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """docs without the copies, all columns kept.

    Only rows of a group of copies (or whose bit collides with one's) are shuffled; all others pass
    straight through, their full text unhashed.
    """
    given = docs.columns
    docs, names = nameless(docs)
    id_col, text_col = names[id_col], names[text_col]
    groups = checkpointed(_judged(docs, id_col, text_col, prefix_chars, False).where("group_size > 1"))
    key = F.struct("_dw_len", "_dw_prefix")
    bits = bits_for(groups.count())
    marked = with_bit(docs.withColumns(_first_levels(text_col, prefix_chars)), key, bitmap_of(groups, key, bits), "_dw_open", bits)
    alone = marked.where(~F.col("_dw_open")).select(*docs.columns)
    copied = marked.where("_dw_open").withColumn("_dw_hash", _full_hash(text_col)).select(*docs.columns, "_dw_hash")
    facts = groups.select(F.col("full_hash").alias("_dw_full"), F.col("keep_id").alias("_dw_keep")).distinct()
    # With a second key that the window lacks, the join has a shuffle of its own and can split a hot group.
    facts = facts.withColumn("_dw_of", F.xxhash64("_dw_full"))
    stays = F.col("_dw_full").isNull() | F.col(id_col).eqNullSafe(F.col("_dw_keep"))
    nth = F.row_number().over(W.partitionBy(id_col, "_dw_hash").orderBy(id_col))
    met = copied.withColumn("_dw_at", F.xxhash64("_dw_hash")).join(facts, (F.col("_dw_at") == F.col("_dw_of")) & (F.col("_dw_hash") == F.col("_dw_full")), "left")
    won = met.where(stays).withColumn("_dw_nth", nth).where("_dw_nth = 1")
    return alone.unionByName(won.select(*docs.columns)).toDF(*given)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row of its group that stays."""
    found = verdicts(read(spark, sf_dir, "documents"), hash_all=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("full_hash").alias("text_sha256"))


SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
h AS (SELECT doc_id, sha256(t) AS text_sha256 FROM d)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       coalesce(doc_id = max(doc_id) OVER w, true) AS kept, text_sha256
FROM h WINDOW w AS (PARTITION BY text_sha256)
"""
