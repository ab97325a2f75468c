"""Training-order materialisation: a keyed permutation deals sequences to fixed-stride shards of token ids."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweir.llm.common import qualified, read, remove, shared_dir, tidy
from docweir.llm.tokens import default_path, encoder

#: Tokens of a sequence, the id that ends a document, and the permutation's key.
LENGTH, END, KEY = 256, 50256, 0x5EED
ROUNDS = 6
#: Bytes of a shard, about; a task holds one.
SHARD_BYTES = 64 << 20
#: Bytes of ids that a task gathers before it sends them on, by shard.
GATHER = 16 << 20
#: Level by which ids are compressed on their way.
LEVEL = 6


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + np.uint64(key & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def permute(index: np.ndarray, size: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """A keyed bijection of 0 .. size - 1: a balanced Feistel network over the next even number of bits.

    What lands at size or beyond goes through the network again until it lands inside (cycle-walking),
    less than four times on average.
    """
    if not 0 < size <= 1 << 62:
        raise ValueError(f"a permutation of {size} places can't be made; 1 to 2^62 can")
    half = np.uint64(max(1, ((size - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    out = np.asarray(index, np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for r in range(rounds):
            left, right = right, left ^ (_mix(right, key * (r + 1) + r) & mask)
        out[todo] = left << half | right
        todo = todo[out[todo] >= np.uint64(size)]
    return out.astype(np.int64)


def stored_ids(docs: DataFrame, id_col: str, text_col: str, path: str, end: int) -> DataFrame:
    """Rows (part, id, start, ids) of each document's ids and the end id: part is the task, start how many ids it made before."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, made = encoder(path), TaskContext.get().partitionId(), 0
        kind = id_type(encode.size, end)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                start, payload = [], []
                for text in batch.column(1).to_pylist():
                    ids = np.append(encode(text or ""), np.uint32(end)).astype(kind)
                    start.append(made)
                    payload.append(ids.tobytes())
                    made += len(ids)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), batch.column(0), pa.array(start, pa.int64()), pa.array(payload, pa.binary())], names=["part", "id", "start", "ids"])

    return narrow.mapInArrow(tidy(run), f"part int, id {dict(narrow.dtypes)['id']}, start long, ids binary")


def id_type(size: int, end: int) -> np.dtype:
    """What stores an id of a vocabulary of size ids, and the end id: 16 bits where they hold all."""
    return np.dtype("<u2") if max(size - 1, end) <= 0xFFFF else np.dtype("<u4")


def dealt(stored: DataFrame, before: dict[int, int], size: int, per_shard: int, length: int, width: int, key: int) -> DataFrame:
    """Rows (shard, ids, payload): stored ids, cut into sequences, by the shard that the permutation of the sequences' numbers assigns.

    The ids of a task are one stream, cut every length ids; its sequence j has number before[task] + j.
    A document's part in a sequence is a piece. Pieces that a task sends to the same shard are
    compressed together, GATHER bytes of ids at a time at most besides one document's: steps from
    place to place, offsets in the sequence, sizes, and numbers of pieces, as 32 bits, and then the ids.
    """
    kind = dict(stored.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        held: list[tuple] = []
        waiting = 0

        def flush() -> Iterator[pa.RecordBatch]:
            owners = pa.concat_arrays([h[0] for h in held])
            slot, offset, sizes, piece = np.concatenate([h[1] for h in held], axis=1)
            body = [x for h in held for x in h[2]]
            shard = slot // per_shard
            order = np.lexsort((offset, slot))
            edges = [0, *(np.flatnonzero(np.diff(shard[order])) + 1).tolist(), len(order)]
            for lo, hi in zip(edges, edges[1:]):
                some = order[lo:hi]
                numbers = [np.diff(slot[some], prepend=shard[some[0]] * per_shard), offset[some], sizes[some], piece[some]]
                payload = b"".join([*(x.astype("<u4").tobytes() for x in numbers), *(body[k] for k in some.tolist())])
                own = pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), owners.take(pa.array(some)))
                yield pa.RecordBatch.from_arrays([pa.array([int(shard[some[0]])], pa.int64()), own, pa.array([packer.compress(payload)], pa.binary())], names=["shard", "ids", "payload"])

        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                which, rows, body = [], [], []
                for i, (part, start, raw) in enumerate(zip(batch.column("part").to_pylist(), batch.column("start").to_pylist(), batch.column("ids"))):
                    raw = memoryview(raw.as_buffer())
                    stop = start + len(raw) // width
                    cuts = [start, *range((start // length + 1) * length, stop, length), stop]
                    for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                        which.append(i)
                        rows.append((before[part] + lo // length, lo % length, hi - lo, k))
                        body.append(bytes(raw[width * (lo - start) : width * (hi - start)]))
                numbers = np.array(rows, np.int64).T
                numbers[0] = permute(numbers[0], size, key)
                held.append((batch.column("id").take(pa.array(which, pa.int64())), numbers, body))
                waiting += sum(map(len, body))
                if waiting >= GATHER:
                    yield from flush()
                    held, waiting = [], 0
        if held:
            yield from flush()

    return stored.mapInArrow(tidy(run), f"shard long, ids array<{kind}>, payload binary")


def _filesystem(where: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(where)


def read_shard(where: str, file: str, length: int = LENGTH, start: int = 0, width: int = 2) -> Iterator[np.ndarray]:
    """The sequences of a shard's file in training order, from place start on: one seek, then sequential reading."""
    system, folder = _filesystem(where)
    stride = width * (length + 1)
    with system.open_input_file(f"{folder}/{file}") as source:
        source.seek(start * stride)
        while block := source.read(stride * 1024):
            table = np.frombuffer(block, f"<u{width}").reshape(-1, length + 1)
            for row in table:
                yield row[1 : 1 + int(row[0])]


def _write(rows: DataFrame, where: str, size: int, per_shard: int, length: int, width: int) -> DataFrame:
    """Writes each shard in the order of its slots, reads the file back, and returns what it holds.

    Every try writes a file of its own name, and only the one that the manifest names counts; so
    neither a second try nor a lost executor can disturb what another reads.
    """
    stride = width * (length + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _filesystem(where)
        system.create_dir(folder, recursive=True)
        unpacker = zstandard.ZstdDecompressor()
        now, table, facts = None, None, []

        def close() -> Iterator[pa.RecordBatch]:
            name = f"shard-{now:08d}-{uuid.uuid4().hex}.bin"
            with system.open_output_stream(f"{folder}/{name}") as out:
                out.write(table)
            owners, numbers = pa.concat_arrays([f[0] for f in facts]), np.concatenate([f[1] for f in facts], axis=1)
            order = np.lexsort((numbers[1], numbers[0]))
            owners, (places, offsets, sizes, pieces) = owners.take(pa.array(order)), numbers[:, order]
            with system.open_input_file(f"{folder}/{name}") as source:
                back = np.frombuffer(source.read(), f"<u{width}").reshape(-1, length + 1)
            crcs = [zlib.crc32(back[p, 1 + o : 1 + o + n].astype("<u4").tobytes()) if o + n <= back[p, 0] else None for p, o, n in zip(places.tolist(), offsets.tolist(), sizes.tolist())]
            for lo in range(0, len(order), 8192):
                part = slice(lo, lo + 8192)
                n = len(places[part])
                columns = [owners.slice(lo, n), pa.array(pieces[part], pa.int32()), pa.array([now] * n, pa.int64()), pa.array([name] * n), pa.array(places[part]), pa.array(offsets[part], pa.int32()), pa.array(sizes[part]), pa.array(crcs[part], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "piece", "shard", "file", "place", "offset", "length", "ids_crc32"])

        for batch in batches:
            for i, shard in enumerate(batch.column("shard").to_pylist()):
                if shard != now:
                    if now is not None:
                        yield from close()
                    now, facts = shard, []
                    table = np.zeros((min(per_shard, size - shard * per_shard), length + 1), f"<u{width}")
                owners, payload = batch.column("ids")[i].values, unpacker.decompress(batch.column("payload")[i].as_py())
                numbers = np.frombuffer(payload, "<u4", 4 * len(owners)).astype(np.int64).reshape(4, -1)
                numbers[0] = np.cumsum(numbers[0])
                places, offsets, sizes, _ = numbers
                ids = np.frombuffer(payload, f"<u{width}", offset=16 * len(owners))
                ahead = places * (length + 1) + 1 + offsets - (np.cumsum(sizes) - sizes)
                table.reshape(-1)[np.repeat(ahead, sizes) + np.arange(len(ids))] = ids
                np.maximum.at(table[:, 0], places, (offsets + sizes).astype(table.dtype))
                facts.append((owners, numbers))
        if now is not None:
            yield from close()

    kind = dict(rows.dtypes)["ids"].removeprefix("array<").removesuffix(">")
    return rows.mapInArrow(tidy(run), f"id {kind}, piece int, shard long, file string, place long, offset int, length long, ids_crc32 long")


def materialise(docs: DataFrame, where: str | None = None, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, path: str | None = None, end: int = END, key: int = KEY, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes all documents as sequences in training order; one row per piece: id, piece, length, shard, file, place, offset, byte_offset, slot, ids_crc32.

    The documents that a task reads, each closed by the end id, are one stream of ids, cut into
    sequences of length ids; only a task's last one may be shorter. A document's part in a sequence is
    a piece. Sequences are numbered from 0 to N - 1: by task, from per-task totals, and in it in turn.
    A sequence's slot is the keyed permutation of its number over 0 .. N - 1; a shard takes an equal
    range of slots, and a sequence stands in its shard at place * stride bytes, led by its length. The
    order depends on the key and on how the rows are read, not on retries. Ids may be of any type,
    null or repeated. A null text is empty, which is the end id alone. Vocabularies that 16 bits don't
    hold are stored in 32. An empty table writes nothing. Other columns are not read.

    N must be known before any slot is, so ids are made once and stored compressed (where-ids), and
    one shuffle carries them, compressed again, to their shards. where is a folder that all executors
    reach, by Spark and by pyarrow; what was written is kept beside it in where-manifest, which names
    the files that count. Others, which tries that failed have left, are removed, and so is where-ids.
    """
    spark = docs.sparkSession
    path = path or default_path()
    where = qualified(spark, where or f"{shared_dir(spark)}/training-order-{uuid.uuid4().hex}")
    width = id_type(encoder(path).size, end).itemsize
    stored_ids(docs, id_col, text_col, path, end).write.mode("overwrite").options(**{"compression": "zstd", "parquet.compression.codec.zstd.level": str(LEVEL), "parquet.page.size": str(GATHER // 2)}).parquet(f"{where}-ids")
    stored = spark.read.parquet(f"{where}-ids")
    # One row for each task that read a part of the table.
    last = F.ceil(F.max(F.col("start") + F.octet_length("ids") / width) / length).cast("long").alias("n")
    before, size = {}, 0
    for part, n in sorted(stored.groupBy("part").agg(last).collect()):
        before[part] = size
        size += n
    per_shard = max(1, min(shard_bytes // (width * (length + 1)), -(-size // int(spark.conf.get("spark.sql.shuffle.partitions")))))
    shards = max(1, -(-size // per_shard))
    routed = dealt(stored, before, max(1, size), per_shard, length, width, key).repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard")
    _write(routed, where, size, per_shard, length, width).write.mode("overwrite").parquet(f"{where}-manifest")
    out = spark.read.parquet(f"{where}-manifest")
    remove(spark, f"{where}-ids", *(f"{where}/{name}" for name in left_over(out, where)))
    return out.select(F.col("id").alias(id_col), "piece", "length", "shard", "file", "place", "offset", (F.col("place") * (width * (length + 1))).alias("byte_offset"), (F.col("shard") * per_shard + F.col("place")).alias("slot"), "ids_crc32")


def left_over(written: DataFrame, where: str) -> list[str]:
    """Files of a folder that no row of its manifest names, which tries that failed have left; one name a shard is compared."""
    from pyarrow import fs

    system, folder = _filesystem(where)
    counted = {r[0] for r in written.select("file").distinct().collect()}
    return sorted(x.base_name for x in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if x.base_name not in counted)


def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document, written to shards of sequences in training order and read back."""
    return materialise(read(spark, sf_dir, "documents"))
