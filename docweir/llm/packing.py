"""Best-fit packing by a grouping genetic algorithm on islands with elite migration."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docweir.llm.common import checkpointed, read, tidy
from docweir.llm.tokens import default_path, encoder

CAPACITY, END = 1024, 2
#: Items of a block, which is what one ring of islands packs.
BLOCK = 1 << 15
ISLANDS, POPULATION, GENERATIONS = 2, 5, 10
#: Bins less full than this are dissolved once and their items packed anew together.
REPACK = 0.985
#: Most packings in turn, by which sequences are numbered; each has fewer blocks than the one before.
LEVELS = 64


def best_fit(order: np.ndarray, sizes: np.ndarray, bins: np.ndarray, room: list[int], capacity: int) -> None:
    """Puts the items of order, in turn, where the least room is left; opens bins as needed. Changes bins and room.

    Bins stand in one list for each amount of room; a bit for each list that isn't empty finds the
    tightest fit at once.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for b, free in enumerate(room):
        if free:
            by_room[free].append(b)
            mask |= 1 << free
    for item in order.tolist():
        size = int(sizes[item])
        above = mask >> size
        if above:
            free = size + (above & -above).bit_length() - 1
            b = by_room[free].pop()
            if not by_room[free]:
                mask ^= 1 << free
        else:
            free, b = capacity, len(room)
            room.append(capacity)
        bins[item] = b
        room[b] = free = free - size
        if free:
            by_room[free].append(b)
            mask |= 1 << free


def pair_fit(sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """A packing of whole bins: each is opened by the largest item left, and closed by the one or the two items that fill it exactly.

    Which pair is chance. Where none does, the largest item that fits goes in, and the search goes on.
    """
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    for item in rng.permutation(len(sizes)).tolist():
        stacks[int(sizes[item])].append(item)
    count = np.bincount(sizes, minlength=capacity + 1)
    bins, b = np.empty(len(sizes), np.int64), -1

    def put(size: int) -> int:
        count[size] -= 1
        bins[stacks[size].pop()] = b
        return size

    for largest in np.flatnonzero(count)[::-1].tolist():
        while count[largest]:
            b += 1
            room = capacity - put(largest)
            while room:
                if count[room]:
                    room -= put(room)
                    break
                half = room // 2
                pairs = (count[1 : half + 1] > 0) & (count[room - half : room][::-1] > 0)
                if 2 * half == room and half and count[half] < 2:
                    pairs[half - 1] = False
                found = np.flatnonzero(pairs)
                if len(found):
                    one = int(found[rng.integers(len(found))]) + 1
                    put(one), put(room - one)
                    break
                fits = np.flatnonzero(count[: room + 1])
                if not len(fits):
                    break
                room -= put(int(fits[-1]))
    return bins


def fitness(bins: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[int, float]:
    """More is better: fewer bins first, then the mean square of how full they are."""
    fill = np.bincount(bins, sizes) / capacity
    return -len(fill), float(np.mean(fill * fill))


def _refit(bins: np.ndarray, loose: np.ndarray, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """bins with the loose items taken out, bins renumbered, and the loose ones best-fitted, largest first."""
    fixed = ~loose
    out = np.empty(len(bins), np.int64)
    _, out[fixed] = np.unique(bins[fixed], return_inverse=True)
    count = int(out[fixed].max(initial=-1)) + 1
    room = (capacity - np.bincount(out[fixed], sizes[fixed], count)).astype(np.int64).tolist()
    items = np.flatnonzero(loose)
    best_fit(items[np.lexsort((rng.random(len(items)), -sizes[items]))], sizes, out, room, capacity)
    return out


def crossover(one: np.ndarray, two: np.ndarray, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Injects whole well-filled bins of two into one. Bins of one that hold any of their items go; what else those held is best-fitted."""
    fill = np.bincount(two, sizes)
    chosen = (fill >= np.quantile(fill, 0.5)) & (rng.random(len(fill)) < 0.5)
    injected = chosen[two]
    broken = np.zeros(int(one.max()) + 1, bool)
    broken[one[injected]] = True
    child = np.where(injected, two + len(broken), one)
    return _refit(child, broken[one] & ~injected, sizes, capacity, rng)


def mutate(one: np.ndarray, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Dissolves the emptiest bins and a few others, and best-fits their items."""
    fill = np.bincount(one, sizes)
    chosen = (fill <= np.quantile(fill, 0.02)) | (rng.random(len(fill)) < 0.03)
    return _refit(one, chosen[one], sizes, capacity, rng)


def evolve(sizes: np.ndarray, seeds: list[np.ndarray], capacity: int, rng: np.random.Generator, population: int = POPULATION, generations: int = GENERATIONS) -> np.ndarray:
    """The best packing that a small steady-state population finds, from seeds (packings), best fits in random orders and pair fits.

    It ends early at the bound that no packing can beat. The first individual is best fit by
    decreasing size, so the result is never worse than that. Pair fits bring bins that are full, which
    crossover spreads; what it displaces is best-fitted.
    """
    bound = -(-int(sizes.sum()) // capacity)
    people = list(seeds)
    noise = 0.0
    while len(people) < population:
        if (len(people) - len(seeds)) % 2:
            bins = pair_fit(sizes, capacity, rng)
        else:
            bins, room = np.empty(len(sizes), np.int64), []
            best_fit(np.argsort(-sizes * (1 + noise * rng.random(len(sizes))), kind="stable"), sizes, bins, room, capacity)
            noise = noise * 1.5 + 0.05
        people.append(bins)
        if int(bins.max(initial=-1)) + 1 == bound:
            break
    scored = sorted(((fitness(p, sizes, capacity), i, p) for i, p in enumerate(people)), key=lambda x: x[:2], reverse=True)
    born = len(people)
    for _ in range(generations):
        if -scored[0][0][0] <= bound or len(scored) < 2:
            break
        for _ in range(population // 2 + 1):
            a, b = sorted(rng.choice(len(scored), 2, replace=False))  # the fitter one gives the bins
            child = crossover(scored[b][2], scored[a][2], sizes, capacity, rng)
            if rng.random() < 0.5:
                child = mutate(child, sizes, capacity, rng)
            scored.append((fitness(child, sizes, capacity), born, child))
            born += 1
        scored = sorted(scored, key=lambda x: x[:2], reverse=True)[:population]
    return scored[0][2]


def _epoch(rows: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """Each island's elite after an epoch. rows: block, island, sizes, and, from the second epoch on, migrants."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, island, raw, seeds in zip(*(batch.column(i).to_pylist() for i in range(4))):
                sizes = np.frombuffer(raw, "<i4").astype(np.int64)
                rng = np.random.default_rng([block, island, epoch])
                best = evolve(sizes, [np.frombuffer(s, "<i4").astype(np.int64) for s in seeds or []], capacity, rng)
                count, square = fitness(best, sizes, capacity)
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([island], pa.int32()), pa.array([raw], pa.binary()), pa.array([best.astype("<i4").tobytes()], pa.binary()), pa.array([count - 1 + square], pa.float64())], names=["block", "island", "sizes", "elite", "fit"])

    return rows.select("block", "island", "sizes", "seeds").mapInArrow(tidy(run), "block long, island int, sizes binary, elite binary, fit double")


def _pack_blocks(items: DataFrame, capacity: int, islands: int, spark: SparkSession, level: int) -> tuple[DataFrame, int]:
    """items (length, and columns that only pass through) with block, bin, offset, fill; and how many blocks there are.

    Items are dealt to blocks by a hash of their level. Every block is packed by a ring of islands; after the first
    epoch each island's elite moves to the next one, and after the second the fittest of all is taken.
    """
    count = items.count()
    blocks = -(-count // BLOCK) or 1
    parts = min(blocks * islands, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    columns = items.columns
    dealt = items.withColumn("block", F.pmod(F.xxhash64(F.lit(3 + level), *columns), F.lit(blocks)))
    dealt = checkpointed(dealt.withColumn("nth", F.row_number().over(W.partitionBy("block").orderBy(F.desc("length"), *columns)) - 1))

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("nth")
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "sizes": pa.array([table.column("length").to_numpy().astype("<i4").tobytes()], pa.binary())})

    gathered = dealt.select("block", "nth", "length").groupBy("block").applyInArrow(gather, "block long, sizes binary")
    rings = gathered.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1)))).withColumn("seeds", F.lit(None).cast("array<binary>"))
    first = _epoch(rings.repartition(parts, "block", "island"), capacity, 1)
    moved = first.withColumn("to", F.explode(F.array(F.col("island"), (F.col("island") + 1) % islands))) if islands > 1 else first.withColumn("to", F.col("island"))
    met = moved.groupBy("block", "to").agg(F.first("sizes").alias("sizes"), F.array_sort(F.collect_list("elite")).alias("seeds")).withColumnRenamed("to", "island")
    second = _epoch(met, capacity, 2)
    best = second.groupBy("block").agg(F.max_by(F.struct("sizes", "elite"), F.struct("fit", "elite")).alias("x")).select("block", "x.sizes", "x.elite")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw, elite in zip(*(batch.column(i).to_pylist() for i in range(3))):
                sizes, bins = np.frombuffer(raw, "<i4").astype(np.int64), np.frombuffer(elite, "<i4").astype(np.int64)
                order = np.argsort(bins, kind="stable")
                ahead = np.cumsum(sizes[order]) - sizes[order]
                starts = np.append(True, bins[order][1:] != bins[order][:-1])
                offset = np.empty(len(bins), np.int64)
                offset[order] = ahead - np.maximum.accumulate(np.where(starts, ahead, 0))
                fill = np.bincount(bins, sizes).astype(np.int64)[bins]
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(bins), pa.int64()), pa.array(np.arange(len(bins)), pa.int32()), pa.array(bins), pa.array(offset), pa.array(fill)], names=["block", "nth", "bin", "offset", "fill"])

    placed = best.mapInArrow(tidy(place), "block long, nth int, bin long, offset long, fill long")
    return dealt.join(placed, ["block", "nth"]).drop("nth"), blocks


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, path: str | None = None, end: int = END) -> DataFrame:
    """Pieces of every document: id, piece, start, length, ids_crc32.

    A document is its ids and the end id; a null text has the end id only. One longer than capacity
    is cut from the back into pieces of capacity, so only the first may be shorter.
    """
    path = path or default_path()
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows, which = [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    ids = np.append(encode(text or ""), np.uint32(end)).astype("<u4")
                    first = len(ids) % capacity or capacity
                    edges = [0, *range(first, len(ids) + 1, capacity)]
                    for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
                        which.append(i)
                        rows.append((k, lo, hi - lo, zlib.crc32(ids[lo:hi].tobytes())))
                piece, start, length, crc = zip(*rows)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["id", "piece", "start", "length", "ids_crc32"])

    return narrow.mapInArrow(tidy(run), f"id {dict(narrow.dtypes)['id']}, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, path: str | None = None, end: int = END, islands: int = ISLANDS) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Pieces as long as a sequence take one each. All others are packed block by block; then the bins
    that are left less full than REPACK are dissolved and their pieces packed together, and after
    that the emptiest bin of every block, until one block holds them or no bin is saved. Ids may be
    null or repeat; every row's pieces are placed. An empty table gives no rows. Other columns are
    not read. Numbers of sequences are negative for whole ones.
    """
    spark = docs.sparkSession
    pieces = checkpointed(cut(docs, id_col, text_col, capacity, path, end))
    numbered = pieces.withColumn("row", F.monotonically_increasing_id())  # pieces are stored, so a row keeps its number
    whole = numbered.where(F.col("length") == capacity).select(*pieces.columns, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = numbered.where(F.col("length") < capacity)
    number = lambda level: F.col("block") * (LEVELS * BLOCK * 8) + F.col("bin") * LEVELS + level
    settled = lambda some, level: some.select(*pieces.columns, number(level).alias("sequence_id"), "offset")
    first = checkpointed(_pack_blocks(short, capacity, islands, spark, 0)[0])
    full = F.col("fill") >= REPACK * capacity
    out = whole.unionByName(settled(first.where(full), 0))
    packed, blocks = _pack_blocks(first.where(~full).select(*short.columns), capacity, islands, spark, 1)
    level = 1
    if blocks > 1:
        packed = checkpointed(packed)
    while blocks > 1 and level + 1 < LEVELS:
        emptiest = packed.where(~full).groupBy("block").agg(F.min(F.struct("fill", "bin")).alias("least")).select("block", "least.bin", F.lit(True).alias("open"))
        marked = checkpointed(packed.join(emptiest, ["block", "bin"], "left"))
        again, fewer = _pack_blocks(marked.where("open").select(*short.columns), capacity, islands, spark, level + 1)
        again = checkpointed(again)
        if fewer >= blocks or again.select("block", "bin").distinct().count() >= emptiest.count():
            break
        out = out.unionByName(settled(marked.where("open is null"), level))
        packed, blocks, level = again, fewer, level + 1
    return out.unionByName(settled(packed, level)).withColumnRenamed("id", id_col)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return pack(read(spark, sf_dir, "documents"))
