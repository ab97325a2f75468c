"""Contiguous shards of equal bytes from a global prefix sum of document sizes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweir.llm.common import checkpointed, read

#: Shards of the registered query, and bytes that each document takes besides its text.
SHARDS, OVERHEAD = 24, 8


def cut_points(total: int, shards: int) -> np.ndarray:
    """Twice the places where shards 1, 2, ... begin among total bytes, rounded up: what is at or beyond cut k is in shard k + 1 or later."""
    return np.array([-(-2 * total * k // shards) for k in range(1, shards)], np.int64)


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", overhead: int = OVERHEAD) -> DataFrame:
    """One row per row of docs: id, size, text_crc32, shard, slot.

    Documents stand in the order of id (nulls first), then CRC-32 and size, so the result depends
    neither on the partitioning nor on the run; rows equal in all three are interchangeable. A
    document goes where the middle of its bytes falls among equal cuts of the total, so shards are
    contiguous and each is within one document of the target. slot counts from 0 in each shard. A
    null text has no bytes and the CRC-32 of an empty one. A document larger than a target can leave
    a shard empty. An empty table gives no rows. Other columns are not read.

    Only (id, size, crc) is sorted. The driver sees one total per partition and one row per shard.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"))
    narrow = checkpointed(narrow)
    keys = ("id", "crc", "size")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = checkpointed(narrow.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id()))

    totals = sorted(ordered.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect())
    before: dict[int, tuple[int, int]] = {}
    total = count = 0
    for part, size, rows in totals:
        before[part] = (total, count)
        total, count = total + size, count + rows

    # Twice a document's middle, in bytes, is compared with twice the cuts; Python's integers have no bound.
    if 2 * total >= 1 << 63:
        raise ValueError(f"{total} bytes are more than 64-bit prefix sums hold")
    cuts = cut_points(total, shards)
    schema = f"id {dict(narrow.dtypes)['id']}, size long, crc long, shard int, place long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[int, tuple[int, int]] = {}
        for batch in batches:
            part, size = batch.column("part").to_numpy(), batch.column("size").to_numpy()
            shard, index = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                start, first = at.get(part[lo], before[part[lo]])
                ends = start + np.cumsum(size[lo:hi])
                shard[lo:hi] = np.searchsorted(cuts, 2 * ends - size[lo:hi], "right")
                index[lo:hi] = first + np.arange(hi - lo)
                at[part[lo]] = (int(ends[-1]), first + hi - lo)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("size"), batch.column("crc"), pa.array(shard, pa.int32()), pa.array(index)], names=["id", "size", "crc", "shard", "place"])

    placed = ordered.mapInArrow(place, schema)
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))  # a row for each shard at most
    joined = placed.join(F.broadcast(first), "shard")
    return joined.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("place") - F.col("first")).alias("slot"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    out = shard_by_bytes(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: CRC-32 byte by byte, by a table made of its polynomial; sizes are summed and cut by window functions.
SQL = """
WITH t AS (SELECT list(c ORDER BY i) AS tb FROM (SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), list_transform(range(8), lambda k: k)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i))),
h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
b AS (SELECT doc_id, CAST(len(x) // 2 + 8 AS BIGINT) AS size, list_transform(range(1, len(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT)) AS bs FROM h),
c AS (SELECT doc_id, size, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bs), lambda c, v: xor(c >> 8, tb[(xor(c, v) & 255) + 1])), 4294967295) AS BIGINT) AS text_crc32 FROM b, t),
p AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) AS ends, sum(size) OVER () AS total FROM c),
s AS (SELECT *, CAST((2 * ends - size) * 24 // (2 * total) AS INTEGER) AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s
"""
