"""What several of the corpus operators share: checkpoints, fixed-size bitmaps, text rules."""

from __future__ import annotations

import ctypes
import gc
import string
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a survivor bitmap: 4 MiB, or what keeps it sparse for more keys, up to 128 MiB, so broadcasting it is bounded.
BITMAP_BITS, MOST_BITS = 1 << 25, 1 << 30
_PAGE_BITS = 32768  # of bitmap_construct_agg


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data set, by Spark's reader only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one is made only where none is configured and all run on one machine."""
    context = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        if context._jsc.sc().getCheckpointDir().isDefined():
            return context._jsc.sc().getCheckpointDir().get()
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="docweir-checkpoint-")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(where)
    return where


def qualified(spark: SparkSession, where: str) -> str:
    """A folder's full URI: a bare path lies in the cluster's default file system, not on each machine's own disk."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    full = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    return f"file://{full.removeprefix('file:')}" if full.startswith("file:/") and not full.startswith("file://") else full


def remove(spark: SparkSession, *where: str) -> None:
    """Deletes folders or files that were written on the way, where they are."""
    for name in where:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of df, written once to the shared folder and read from there ever after."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def collect_garbage(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of steps that nothing refers to any more; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. Texts that are all ASCII take the byte-wise built-in."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def id_crc(doc_id: Column) -> Column:
    """CRC-32 of the id's decimal text, by which labelled rows are held out."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def bits_for(keys: int) -> int:
    """Bits of a bitmap that so many keys leave sparse, as far as the bound allows."""
    return min(MOST_BITS, max(BITMAP_BITS, 1 << (16 * keys).bit_length()))


def bitmap_of(keys: DataFrame, key: Column, bits: int = BITMAP_BITS) -> DataFrame:
    """Fixed-size bitmap of hashed keys: at most bits / 32768 rows of 4 KiB (page, bitmap)."""
    at = F.pmod(F.xxhash64(key), F.lit(bits))
    return (
        keys.select(at.alias("at"))
        .select((F.col("at") / _PAGE_BITS).cast("long").alias("page"), (F.col("at") % _PAGE_BITS).alias("bit"))
        .groupBy("page")
        .agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    )


def with_bit(df: DataFrame, key: Column, bitmap: DataFrame, name: str, bits: int = BITMAP_BITS) -> DataFrame:
    """df with a boolean column: whether the key's bit is set. True may be a chance collision, false never is.

    The bitmap is broadcast; bits bounds it. A full bitmap only means that nothing is ruled out.
    """
    at = F.pmod(F.xxhash64(key), F.lit(bits))
    columns = df.columns
    paged = df.withColumns({"_dw_page": (at / _PAGE_BITS).cast("long"), "_dw_bit": (at % _PAGE_BITS).cast("int")})
    joined = paged.join(F.broadcast(bitmap.withColumnRenamed("page", "_dw_page")), "_dw_page", "left")
    byte = F.conv(F.hex(F.substring("bitmap", F.floor(F.col("_dw_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), F.col("_dw_bit") % 8).cast("int")) != 0, F.lit(False))
    return joined.select(*columns, is_set.alias(name))


def nameless(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with its columns named by place, so that no name of its own can clash, and the new name of each."""
    names = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


Batches = Iterator[pa.RecordBatch]


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """run, and then what it freed goes back to the system: workers are reused, and each would keep its peak."""

    def whole(batches: Batches) -> Batches:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass

    return whole
