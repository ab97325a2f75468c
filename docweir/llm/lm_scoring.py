"""Language-model scores of texts by a weighted backoff automaton.

The model's n-grams are the states of an automaton; each has arcs to longer n-grams and one failure arc, to its longest
proper suffix, that costs the smoothing's backoff weight. One traversal of a text from left to right carries the state and
adds up log-probabilities. The model grows with the corpus, so no task holds it: a block of texts asks for the n-grams
that it contains, tasks that each own a range of keys count them over all blocks, and the block gets back the counts of
exactly that part of the automaton that its texts can reach.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweir.llm.common import checkpointed, collect_garbage, id_crc, read, remove, shared_dir, tidy

#: Tokens of the longest n-gram, and by order from 2 on the pseudo-counts that its lower order is worth.
ORDER, PRIOR = 3, (100.0, 30.0)
#: Bytes of text in a block, about; a task holds one. Keys that a counting task owns, about.
BLOCK, OWNED = 8 << 20, 1 << 20
MOST_SLICES = 1 << 16
#: Tokens that one lane of the traversal reads.
LANE = 1024
#: What isn't a word, since it is white space: the begin of a text and its end.
START_WORD, END_WORD = b" ", b"\n"
_START = np.uint64(xxhash.xxh64_intdigest(START_WORD))
_LEVEL = 3


class Grams(NamedTuple):
    """The n-grams of one order in a block: distinct keys in order, which of them ends at each position, and a position of each."""

    keys: np.ndarray
    at: np.ndarray
    where: np.ndarray


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def grams_of(hashes: np.ndarray, begins: np.ndarray, order: int) -> list[Grams]:
    """The n-grams of orders 1 to order that end at each position of some texts, each of which begins with the start sign.

    A key is made of that of the n-gram's history and its last token. Positions whose n-gram would
    reach over the start have number -1.
    """
    depth = np.arange(len(hashes)) - np.repeat(begins, np.diff(np.append(begins, len(hashes))))
    keys, out = hashes, []
    for k in range(1, order + 1):
        if k > 1:
            keys = _mix(np.concatenate([np.zeros(1, np.uint64), keys[:-1]]) * np.uint64(0xC2B2AE3D27D4EB4F) + hashes + np.uint64(k))
        inside = np.flatnonzero(depth >= k - 1)
        found, first, number = np.unique(keys[inside], return_index=True, return_inverse=True)
        at = np.full(len(hashes), -1, np.int32)
        at[inside] = number
        out.append(Grams(found, at, inside[first]))
    return out


class Automaton(NamedTuple):
    """By order: whether the n-gram is a state, the log10 weight of the arc into it, and that of the failure arc out of it."""

    known: list[np.ndarray]
    arcs: list[np.ndarray]
    failures: list[np.ndarray]


def smoothed(grams: list[Grams], counts: list[np.ndarray], tokens: int, types: int, prior: tuple[float, ...] = PRIOR) -> Automaton:
    """The part of the automaton that some texts reach, from the training counts of their n-grams.

    A token alone has probability (c + 1) / (tokens + types + 1). After a history h of any length, it
    has (c(h, token) + m p) / (c(h) + m), where p is its probability after the history without its
    first token, and m is the order's prior. That is p times the failure weight m / (c(h) + m) where
    c(h, token) is 0. So all tokens, with one for all unknown ones, sum up to 1 after any history.
    """
    p = (counts[0] + 1) / (tokens + types + 1)
    known, arcs, failures = [counts[0] > 0], [np.log10(p)], []
    for k in range(1, len(grams)):
        here = grams[k].where
        history = counts[k - 1][grams[k - 1].at[here - 1]]
        m = prior[k - 1]
        p = (counts[k] + m * p[grams[k - 1].at[here]]) / (history + m)
        known.append(counts[k] > 0)
        arcs.append(np.log10(p))
        failures.append(np.log10(m / (counts[k - 1] + m)))
    return Automaton(known, arcs, failures)


def traversed(model: Automaton, grams: list[Grams], begins: np.ndarray, lane: int = LANE) -> np.ndarray:
    """Each token's log10 probability by one traversal of every text; 0 at the start signs.

    Texts are read side by side, one token of each at a time. The state is the longest n-gram that
    was just read, below the highest order; where it has no arc for the token, its failure arc leads to
    the next shorter one, down to the empty one, which reads anything. A long text is read in lanes. Each
    begins as many tokens early as a state holds, from the empty state, and so is in the true one by
    the time that its own tokens come.
    """
    order = len(grams)
    ends = np.append(begins[1:], len(grams[0].at))
    first = [np.arange(b + 1, e, lane) for b, e in zip(begins.tolist(), ends.tolist())]
    text = np.repeat(np.arange(len(begins)), [len(f) for f in first])
    own = np.concatenate([np.empty(0, np.int64), *first]).astype(np.int64)
    stop = np.minimum(own + lane, ends[text])
    at = np.maximum(own - (order - 1), begins[text] + 1)
    longest = np.argsort(at - stop, kind="stable")
    own, stop, at = own[longest], stop[longest], at[longest]
    state = (at == begins[text[longest]] + 1).astype(np.int64) * (order > 1)  # the start sign is a state of its own
    out = np.zeros(len(grams[0].at))
    live = len(at)
    lengths = stop - at
    for step in range(int(lengths.max(initial=0))):
        live = int(np.searchsorted(-lengths[:live], -step, "left"))  # lanes are sorted by falling length
        here, depth = at[:live] + step, state[:live]
        total = np.zeros(live)
        for k in range(order - 1, 0, -1):  # a state of k tokens, an arc to one of k + 1
            on = np.flatnonzero(depth == k)
            i = here[on]
            lost = ~model.known[k][grams[k].at[i]]
            total[on] += np.where(lost, model.failures[k - 1][grams[k - 1].at[i - 1]], model.arcs[k][grams[k].at[i]])
            depth[on] = np.where(lost, k - 1, -(k + 1))
        root = np.flatnonzero(depth == 0)
        number = grams[0].at[here[root]]
        total[root] += model.arcs[0][number]
        depth[root] = np.where(model.known[0][number], -1, 0)
        state[:live] = np.minimum(-depth, order - 1)
        ours = here >= own[:live]
        out[here[ours]] = total[ours]
    return out


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes; numbers of most sets are small, so most planes are empty."""
    planes = np.ascontiguousarray(numbers.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=_LEVEL).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def _blocks(docs: DataFrame, block: int) -> DataFrame:
    """Rows (id, held, text) as blocks: (block, ids, held, begins, words, tokens, size, trained).

    words are the sorted 64-bit digests of a block's words, tokens their numbers, with a start sign
    before each text and an end behind it.
    """
    kind = dict(docs.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        names: dict[bytes, int] = {}
        ids, held, found, size = [], [], [], 0

        def close() -> pa.RecordBatch:
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in names], np.uint64)
            words, number = np.unique(hashes, return_inverse=True)
            lengths = np.array([len(f) for f in found])
            tokens = number[np.concatenate(found)]
            trained = int((lengths - 1)[~np.array(held)].sum())
            arrays = [pa.array([part << 32 | seq]), pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), pa.concat_arrays(ids)), pa.array([held], pa.list_(pa.bool_()))]
            arrays += [pa.array([packed(x)]) for x in (np.cumsum(lengths) - lengths, np.diff(words, prepend=np.uint64(0)), tokens)]
            return pa.RecordBatch.from_arrays([*arrays, pa.array([len(tokens)]), pa.array([trained])], names=["block", "ids", "held", "begins", "words", "tokens", "size", "trained"])

        for batch in batches:
            for i, (out, text) in enumerate(zip(batch.column("held").to_pylist(), batch.column("text"))):
                raw = (text.as_py() or "").encode()
                split = [START_WORD, *raw.lower().split(), END_WORD]
                found.append(np.fromiter((names.setdefault(w, len(names)) for w in split), np.int64, len(split)))
                ids.append(batch.column("id").slice(i, 1))
                held.append(out)
                size += len(raw) + 64
                if size >= block:
                    yield close()
                    names, seq = {}, seq + 1
                    ids, held, found, size = [], [], [], 0
        if held:
            yield close()

    schema = f"block long, ids array<{kind}>, held array<boolean>, begins binary, words binary, tokens binary, size long, trained long"
    return docs.select("id", "held", "text").mapInArrow(tidy(run), schema)


class Read(NamedTuple):
    """A block as its tasks use it."""

    number: int
    begins: np.ndarray
    trained: np.ndarray
    grams: list[Grams]


def _read_block(batch: pa.RecordBatch, i: int, order: int) -> Read:
    field = lambda name: unpacked(batch.column(name)[i].as_py())
    words, begins = np.cumsum(field("words"), dtype=np.uint64), field("begins").astype(np.int64)
    hashes = words[field("tokens").astype(np.int64)]
    trained = np.repeat(~np.array(batch.column("held")[i].as_py(), bool), np.diff(np.append(begins, len(hashes))))
    return Read(batch.column("block")[i].as_py(), begins, trained, grams_of(hashes, begins, order))


def _own_counts(block: Read, k: int) -> np.ndarray:
    """How often a block's training texts have each of its n-grams of order k + 1."""
    at = block.grams[k].at
    return np.bincount(at[at >= 0], block.trained[at >= 0], len(block.grams[k].keys))


def _shared_parts(grams: list[Grams], k: int, shared: np.ndarray) -> np.ndarray:
    """Which n-grams of order k + 1 have both their first and their last k tokens in several blocks; no other can be in several itself."""
    here = grams[k].where
    return shared[grams[k - 1].at[here - 1]] & shared[grams[k - 1].at[here]]


def _answered(block: Read, replies: list[dict], slices: int, upto: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """By order up to upto: counts over all blocks of a block's n-grams, and whether each is in several blocks.

    What wasn't asked for is in this block alone, so its own count is the whole.
    """
    parts: list[list[tuple[int, bytes]]] = [[] for _ in range(upto)]
    for reply in replies:
        parts[reply["slice"] // slices].append((reply["slice"], reply["totals"]))
    counts, several, shared = [], [], np.empty(0, bool)
    for k, part in enumerate(parts):
        mask = _shared_parts(block.grams, k, shared) if k > 1 else np.ones(len(block.grams[k].keys), bool)
        found = np.concatenate([unpacked(t) for _, t in sorted(part)]).astype(np.int64) if part else np.empty(0, np.int64)
        total = _own_counts(block, k)
        total[mask] = found >> 1
        shared = np.zeros(len(mask), bool)
        shared[mask] = found & 1 == 1
        counts.append(total)
        several.append(shared)
    return counts, several


def _slice_edges(keys: np.ndarray, slices: int) -> np.ndarray:
    """Where each slice begins among sorted keys: slices are equal ranges of keys."""
    bits = np.uint64(64 - (slices.bit_length() - 1))
    inner = np.arange(1, slices, dtype=np.uint64) << bits if slices > 1 else np.empty(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, inner), [len(keys)]]).astype(np.int64)


_BODY = ("block", "held", "begins", "words", "tokens")


def _asked(blocks: DataFrame, orders: range, slices: int) -> DataFrame:
    """Rows (slice, block, keys, counts): distinct n-grams of each block, of some orders, and how often its training texts have them.

    From order 3 on, blocks have the replies to the orders below, and an n-gram of which the first or
    the last tokens are in no other block isn't asked for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = _read_block(batch, i, orders[-1])
                for order in orders:
                    keys, counts = block.grams[order - 1].keys, _own_counts(block, order - 1)
                    if order > 2:
                        _, shared = _answered(block, batch.column("replies")[i].as_py(), slices, order - 1)
                        mask = _shared_parts(block.grams, order - 1, shared[-1])
                        keys, counts = keys[mask], counts[mask]
                    edges = _slice_edges(keys, slices)
                    full = np.flatnonzero(np.diff(edges)).tolist()
                    if not full:
                        continue
                    rows = [(packed(np.diff(keys[edges[s] : edges[s + 1]], prepend=np.uint64(0))), packed(counts[edges[s] : edges[s + 1]])) for s in full]
                    arrays = [pa.array([(order - 1) * slices + s for s in full], pa.int32()), pa.array([block.number] * len(full), pa.int64()), *(pa.array(x, pa.binary()) for x in zip(*rows))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["slice", "block", "keys", "counts"])

    return blocks.mapInArrow(tidy(run), "slice int, block long, keys binary, counts binary")


def _counted(asked: DataFrame) -> DataFrame:
    """Rows (slice, block, totals, types): of the n-grams that a block asked for, in its order, twice the count over all blocks, plus 1 where others asked, too.

    types, beside one row a slice, is how many of the slice's n-grams training texts have, without the start sign.
    """

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, keys, counts = [], [], []
        for batch in batches:
            number += batch.column("block").to_pylist()
            keys += [np.cumsum(unpacked(x.as_py()), dtype=np.uint64) for x in batch.column("keys")]
            counts += [unpacked(x.as_py()) for x in batch.column("counts")]
        sizes = [len(x) for x in keys]
        found, at, blocks = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        totals = np.bincount(at, np.concatenate(counts), len(found)).astype(np.int64)
        types = int((totals > 0).sum()) - int((totals[found == _START] > 0).sum())
        answer = (totals << 1 | (blocks > 1))[at]
        lo = 0
        for i, (block, size) in enumerate(zip(number, sizes)):
            arrays = [pa.array([key[0].as_py()], pa.int32()), pa.array([block], pa.int64()), pa.array([packed(answer[lo : lo + size])]), pa.array([0 if i else types], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["slice", "block", "totals", "types"])
            lo += size

    return asked.groupBy("slice").applyInArrow(run, "slice int, block long, totals binary, types long")


def score(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, prior: tuple[float, ...] = PRIOR, block: int = BLOCK) -> DataFrame:
    """One row per row of docs: id, held_out, n_tokens, n_known, train_tokens, base_score, score; learned where held isn't true.

    Tokens are the words of a text, with A-Z lower-cased, and one end. base_score is the sum of
    log10((c + 1) / (N + V + 1)) by the counts of tokens alone; score is the log10 probability of the
    whole text by the automaton of n-grams of up to order tokens, with a prior for each order from 2
    on. A null text is empty, which is the end alone. Rows that repeat, or share an id, or whose id is
    null, each count and each return. Without training texts every token has probability 1. An empty
    table gives no rows. Other columns are not read; held is made of columns of docs.

    Nothing is pruned from the model or capped. Texts are read once and stored as numbers of words, in a
    table in buckets of blocks, so that only n-grams and their counts are shuffled, packed by block
    and range of keys: one and two tokens first, then each longer order, as far as an n-gram can be in
    several blocks. A document's block is in one task, so a very long text needs the memory that its
    own n-grams need. The keys are 64-bit digests. Rows between blocks and ranges number blocks x
    ranges: on very large tables give a larger block.
    """
    if len(prior) != order - 1:
        raise ValueError(f"a model of order {order} has {order - 1} priors")
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).alias("id"), F.coalesce(held, F.lit(False)).alias("held"), F.col(text_col).alias("text"))
    kind = dict(narrow.dtypes)["id"]
    name = f"lm_blocks_{uuid.uuid4().hex}"
    where = f"{shared_dir(spark).rstrip('/')}/{name}"
    _blocks(narrow, block).write.format("parquet").option("path", where).option("compression", "none").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").saveAsTable(name)
    blocks = spark.table(name)
    known = blocks.agg(F.sum("size").alias("size"), F.sum("trained").alias("trained")).head()
    size, trained = known["size"] or 0, known["trained"] or 0
    slices = min(MOST_SLICES, 1 << (size // OWNED).bit_length())
    told = checkpointed(_counted(_asked(blocks.select(*_BODY), range(1, min(order, 2) + 1), slices)))
    collect_garbage(spark)  # the shuffled keys
    types = told.where(F.col("slice") < slices).agg(F.sum("types")).head()[0] or 0

    def with_replies(replies: DataFrame, *columns: str) -> DataFrame:
        by_block = replies.groupBy("block").agg(F.collect_list(F.struct("slice", "totals")).alias("replies"))  # as many as a block has n-grams
        return blocks.select(*columns).join(by_block, "block")

    for k in range(3, order + 1):
        more = _counted(_asked(with_replies(told, *_BODY), range(k, k + 1), slices))
        told = told.unionByName(checkpointed(more))
        collect_garbage(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = _read_block(batch, i, order)
                counts, _ = _answered(one, batch.column("replies")[i].as_py(), slices, order)
                model = smoothed(one.grams, counts, trained, types, prior)
                ends = np.append(one.begins[1:], len(one.trained))
                sums = lambda x: np.add.reduceat(x, one.begins)
                numbers = one.grams[0].at
                single, there = model.arcs[0][numbers], model.known[0][numbers].astype(np.int64)
                single[one.begins], there[one.begins] = 0, 0
                n = len(one.begins)
                owners, out = batch.column("ids")[i].values, batch.column("held")[i].values
                found = [pa.array(ends - one.begins - 1), pa.array(sums(there)), pa.array(np.full(n, trained)), pa.array(sums(single)), pa.array(sums(traversed(model, one.grams, one.begins)))]
                yield pa.RecordBatch.from_arrays([owners, out, *found], names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = checkpointed(with_replies(told, *_BODY, "ids").select(*_BODY, "ids", "replies").mapInArrow(tidy(run), schema))
    spark.sql(f"DROP TABLE {name}")
    remove(spark, where)
    return scored.withColumnRenamed("id", id_col)


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log-probability of every document."""
    return score(read(spark, sf_dir, "documents"), id_crc(F.col("doc_id")) % 7 == 2)
