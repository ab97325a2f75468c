"""Near duplicates: MinHash bands propose pairs, sequential Bayesian verification prunes them, full sets confirm them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweir.llm.common import bitmap_of, checkpointed, read, tidy, with_bit
from docweir.llm.components import components

#: Least similarity of linked documents, in per cent.
PERCENT = 80
#: 32 bands of 4 of the 128 hashes: a pair at 0.8 meets in none with probability 5e-8.
HASHES, BANDS = 128, 32
#: Orders by which buckets choose their pivots.
TURNS = 4
#: Chance that a pair at the threshold is pruned by its signature.
MISS = 1e-5
#: Hashes that are compared at a time.
BATCH = 16
#: Members up to which all pairs of a bucket are compared in one task; larger ones are compared by blocks of BLOCK.
SMALL, BLOCK = 96, 512
#: Bytes of full sets that one side of a comparison with a whole component holds, besides one set.
SIDE_BYTES = 1 << 20
_MEMO = 300_000
#: Pairs whose signatures are compared at a time.
_PAIRS = 1 << 16


class _Words(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z lower-cased: what bytes.lower and bytes.split do."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(found: list[bytes], width: int, memo: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of width words; of the whole sequence where it is shorter."""
    if not found:
        return np.empty(0, np.uint64)
    x = np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))
    span = min(width, len(x))
    out = np.full(len(x) - span + 1, span, np.uint64)
    for i in range(span):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + x[i : i + len(out)]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(out ^ (out >> np.uint64(32)))


@cache
def _hashes() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def signature(found: np.ndarray) -> bytes:
    """128 MinHashes of 16 bits each."""
    a, b = _hashes()
    x = found.astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(least, (x[at : at + 1024, None] * a + b).min(axis=0), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype("<u2").tobytes()


@cache
def least_matches(percent: int = PERCENT, miss: float = MISS, total: int = HASHES, batch: int = BATCH) -> tuple[int, ...]:
    """Fewest matches after each batch with which a pair stays.

    With an even prior and k of n hashes equal, the similarity has a Beta(k + 1, n - k + 1) posterior;
    it is above t with the probability that a Binomial(n + 1, t) is at most k.
    """
    t, out = percent / 100, []
    for n in range(batch, total + 1, batch):
        mass, k = 0.0, -1
        while mass < miss:
            k += 1
            mass += comb(n + 1, k) * t**k * (1 - t) ** (n + 1 - k)
        out.append(k)
    return tuple(out)


def plausible(sig: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int = PERCENT, miss: float = MISS) -> np.ndarray:
    """Which pairs (x, y) of rows of sig (16-bit hashes) stay after all batches; a pair is compared no further once pruned."""
    keep = np.zeros(len(x), bool)
    for at in range(0, len(x), _PAIRS):
        one, two = x[at : at + _PAIRS], y[at : at + _PAIRS]
        alive, matches = np.arange(len(one)), np.zeros(len(one), np.int64)
        for i, least in enumerate(least_matches(percent, miss)):
            part = slice(i * BATCH, (i + 1) * BATCH)
            matches[alive] += (sig[one[alive], part] == sig[two[alive], part]).sum(axis=1)
            alive = alive[matches[alive] >= least]
        keep[at + alive] = True
    return keep


def _fits(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Sizes alone allow the similarity."""
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def _matrix(column: pa.Array, width: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def signed(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """id, digest of the word sequence, n_shingles and signature of each row; no digest where there are no words."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Words()
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                digests, sizes, signatures = [], [], []
                for text in batch.column(1).to_pylist():
                    found = words(text)
                    unique = shingles(found, width, memo)
                    digests.append(xxhash.xxh3_128_digest(b" ".join(found)) if found else None)
                    sizes.append(len(unique))
                    signatures.append(signature(unique) if found else None)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary())], names=["id", "digest", "n", "sig"])

    return narrow.mapInArrow(tidy(run), f"id {dict(narrow.dtypes)['id']}, digest binary, n long, sig binary")


#: What is known of a node, and what its two ends are called in a table of pairs.
_ENDS = ["a", "b", "da", "ra", "db", "rb"]


def _pruned(pairs: DataFrame, nodes: DataFrame, percent: int, miss: float) -> DataFrame:
    """Pairs (a, b), with digest and root of either, that sizes and signatures leave plausible."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}"), F.col("digest").alias(f"d{x}"), F.col("root").alias(f"r{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = _fits(batch.column("na").to_numpy(), batch.column("nb").to_numpy(), percent)
                sig, rows = np.concatenate([_matrix(batch.column(c), HASHES, "<u2") for c in ("sa", "sb")]), np.arange(batch.num_rows)
                keep &= plausible(sig, rows, rows + batch.num_rows, percent, miss)
                yield batch.select(_ENDS).filter(pa.array(keep))

    root = dict(nodes.dtypes)["root"]
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(tidy(run), f"a long, b long, da binary, ra {root}, db binary, rb {root}")


class Texts(NamedTuple):
    """Where full sets come from: a table's id and text columns, and the width of shingles."""

    docs: DataFrame
    id_col: str
    text_col: str
    width: int


def _sets(texts: Texts, wanted: DataFrame) -> DataFrame:
    """Shingle sets (id, digest, full) of the rows whose ids are roots in wanted, from a second reading of those texts only.

    A fixed-size bitmap of the roots lets other texts go before they leave the scan; some that aren't
    wanted pass. A row that repeats is read once a task.
    """
    narrow = texts.docs.select(F.col(texts.id_col).alias("id"), F.col(texts.text_col).alias("text"))
    chosen = with_bit(narrow, F.col("id"), bitmap_of(wanted, F.col("root")), "_dw_open").where("_dw_open").drop("_dw_open")
    width = texts.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, seen = _Words(), set()
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                which, digests, sets = [], [], []
                for i, (own, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                    found = words(text)
                    digest = xxhash.xxh3_128_digest(b" ".join(found))
                    if (own, digest) in seen or not found:
                        continue
                    if len(seen) >= _MEMO:
                        seen.clear()
                    seen.add((own, digest))
                    which.append(i)
                    digests.append(digest)
                    sets.append(shingles(found, width, memo).tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which, pa.int64())), pa.array(digests, pa.binary()), pa.array(sets, pa.binary())], names=["id", "digest", "full"])

    return chosen.mapInArrow(tidy(run), f"id {dict(narrow.dtypes)['id']}, digest binary, full binary")


def _with_set(rows: DataFrame, sets: DataFrame, digest: str, root: str, name: str) -> DataFrame:
    """rows with the full set of the node that digest and root tell; both sides are shuffled by this join, which can split a hot node."""
    own = sets.select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), F.col("full").alias(name))
    return rows.join(own, (F.col(digest) == F.col("_digest")) & F.col(root).eqNullSafe(F.col("_id"))).drop(digest, root, "_id", "_digest")


def _similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * shared >= percent * (len(one) + len(two) - shared)


def _confirmed(pairs: DataFrame, texts: Texts, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough; pairs have the ends' digests and roots, too."""
    sets = _sets(texts, pairs.select(F.col("ra").alias("root")).union(pairs.select("rb")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                keep = [_similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in zip(batch.column("fa"), batch.column("fb"))]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = _with_set(_with_set(pairs.select(_ENDS), sets, "da", "ra", "fa"), sets, "db", "rb", "fb")
    return both.mapInArrow(tidy(run), "a long, b long")


def _ordered(one: Column, two: Column) -> list[Column]:
    return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")]


def _within(groups: DataFrame, percent: int, miss: float) -> DataFrame:
    """Plausible pairs of nodes with different labels inside groups (key, i, j): the labels as a and b, and the nodes' digests and roots.

    Rows are (key, band, i, j, side, node, label, pivot, n, sig, digest, root). Where i = j all pairs
    are compared, else those of either side; ones with the pivot have been. A group holds two blocks
    at most. A pair that also meets in an earlier band is left to that band's bucket, which compares
    it just so, so no pair comes twice.
    """
    root = dict(groups.dtypes)["root"]

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, label, n, side = (table.column(c).to_numpy() for c in ("node", "label", "n", "side"))
        sig = _matrix(table.column("sig").combine_chunks(), HASHES, "<u2")
        x, y = np.triu_indices(len(node), 1)
        keep = (label[x] != label[y]) & _fits(n[x], n[y], percent)
        if key[1].as_py() != key[2].as_py():
            keep &= side[x] != side[y]
        pivot = node == table.column("pivot")[0].as_py()
        keep &= ~(pivot[x] | pivot[y])
        x, y = x[keep], y[keep]
        keep = plausible(sig, x, y, percent, miss)
        x, y = x[keep], y[keep]
        band, rows = int(table.column("band")[0].as_py()), HASHES // BANDS
        met = (sig[x, : band * rows] == sig[y, : band * rows]).reshape(len(x), band, rows).all(axis=2).any(axis=1)
        x, y = pa.array(x[~met]), pa.array(y[~met])
        ends = [table.column("label").take(x), table.column("label").take(y), *(table.column(c).take(end) for end in (x, y) for c in ("digest", "root"))]
        return pa.table(dict(zip(_ENDS, ends)))

    return groups.groupBy("key", "i", "j").applyInArrow(run, f"a long, b long, da binary, ra {root}, db binary, rb {root}")


def _against(loose: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between labels: of nodes, and of a whole component whose members are similar to them by full sets.

    loose has rows (label, i, j, side, own, digest, root): side 0 are nodes with another label (own),
    side 1 members of the component; chunk i of the former meets chunk j of the latter.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        own, side = table.column("own").to_numpy(), table.column("side").to_numpy()
        full = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("full").combine_chunks()]
        members, linked = np.flatnonzero(side == 1), []
        if len(members):
            sizes = np.array([len(full[m]) for m in members])
            pool, owner = np.concatenate([full[m] for m in members]), np.repeat(np.arange(len(members)), sizes)
            for u in np.flatnonzero(side == 0):
                at = np.minimum(np.searchsorted(full[u], pool), len(full[u]) - 1)
                shared = np.bincount(owner[full[u][at] == pool], minlength=len(members))
                if (100 * shared >= percent * (sizes + len(full[u]) - shared)).any():
                    linked.append(own[u])
        linked = np.unique(np.array(linked, np.int64))
        return pa.table({"a": pa.array(linked), "b": pa.array(np.full(len(linked), key[0].as_py(), np.int64))})

    return _with_set(loose, sets, "digest", "root", "full").groupBy("label", "i", "j").applyInArrow(run, "a long, b long")


def _outsiders(pairs: DataFrame, labels: DataFrame, nodes: DataFrame, texts: Texts, percent: int) -> DataFrame:
    """Links (a, b) between labels: of outsiders (node, own label, label of the component that they are outside of), and of that component.

    Either side is cut into chunks of about SIDE_BYTES of full sets.
    """
    # Both sides of a join by label are shuffled by the join itself, so a large component is split at run time.
    keyed = lambda df: df.withColumn("at", F.xxhash64("label"))
    facts = lambda df: keyed(df).withColumnRenamed("label", "_label")
    size = nodes.select(F.col("node").alias("_node"), "n", "digest", "root")
    known = lambda df: df.join(size, F.col("node") == F.col("_node")).drop("_node")
    chunks = lambda name: F.ceil(F.sum("n") * 8 / SIDE_BYTES).cast("int").alias(name)
    outer = checkpointed(known(pairs))
    wanted = outer.groupBy("label").agg(chunks("is"))
    inner = checkpointed(known(keyed(labels).join(facts(wanted), "at").where("label = _label").select("node", "label", "is")))
    counts = facts(checkpointed(inner.groupBy("label", "is").agg(chunks("js"))))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    left = keyed(outer).join(counts, "at").where("label = _label").select("label", place("is").alias("i"), spread("js").alias("j"), F.lit(0).alias("side"), "own", "digest", "root")
    right = keyed(inner).join(counts.drop("is"), "at").where("label = _label").select("label", spread("is").alias("i"), place("js").alias("j"), F.lit(1).alias("side"), F.col("label").alias("own"), "digest", "root")
    return _against(left.unionByName(right), _sets(texts, outer.select("root").union(inner.select("root"))), percent)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id, kept.

    Rows are linked where 100 * shared >= percent * united shingles of width words; components take
    the smallest id that is reachable. Rows with the same word sequence are one node, however many.
    Rows without words (null, empty, white space) are linked with nothing. A row is kept where its id
    is its component's: rows that repeat an id and text share their verdict, and a component of null
    ids only has a null component_id and is kept. An empty table gives no rows.

    1. Buckets of equal bands are stars: each member meets one pivot, another in every bucket. Pairs
       go through the signatures in batches, are pruned once the posterior leaves them less than
       `miss`, and the rest are confirmed on full sets. That gives components.
    2. A bucket that holds several of them is looked at again. In a small one, all pairs between
       components go the same way. In a large one, the members outside its largest component (all of
       them, where no two are linked) are compared with each other by blocks, and on full sets with
       that whole component, in chunks. So no pair of different components that shares a bucket goes
       uncompared, no group is in one task, and the pairs of one component are never listed.
    """
    texts = Texts(docs, id_col, text_col, width)
    rows = checkpointed(signed(docs, id_col, text_col, width))
    known = rows.where(F.col("digest").isNotNull())
    nodes = known.groupBy("digest").agg(F.min("id").alias("root"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    nodes = checkpointed(nodes.withColumn("node", F.monotonically_increasing_id()))
    size = HASHES * 2 // BANDS
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring("sig", b * size + 1, F.lit(size))))
    members = nodes.select("node", F.posexplode(keys).alias("band", "key"))
    # A pivot is the least id after its bits are turned in a way that every TURNS-th part of the bands
    # has in common: a large group meets a few pivots, not one for each band.
    turn = F.xxhash64(F.lit(7), F.col("band") % TURNS).bitwiseAND(F.lit((1 << 62) - 1))
    facts = members.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("band").alias("band"), F.min(F.col("node").bitwiseXOR(turn)).alias("turned")).where("m > 1")
    # A bitmap of the shared keys keeps most members that are alone in their bucket out of the join.
    open_ = with_bit(members, F.col("key"), bitmap_of(facts, F.col("key")), "_open").where("_open").select("node", "key", F.xxhash64("key").alias("at"))
    facts = facts.select(F.xxhash64("key").alias("at"), F.col("key").alias("_key"), "band", "m", F.col("turned").bitwiseXOR(turn).alias("pivot"))
    shared = checkpointed(open_.join(facts, "at").where("key = _key").select("key", "band", "node", "m", "pivot"))

    stars = shared.where("node != pivot").select(*_ordered(F.col("node"), F.col("pivot"))).distinct()
    tried = checkpointed(_pruned(stars, nodes, percent, miss))
    labels = components(_confirmed(tried, texts, percent))

    of = shared.where("m > 2").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    parts = of.groupBy("key", "m", "label").agg(F.count(F.lit(1)).alias("c"))
    mixed = parts.groupBy("key", "m").agg(F.count(F.lit(1)).alias("parts"), F.max("c").alias("most"), F.max_by("label", F.struct("c", "label")).alias("main")).where("parts > 1")
    # Where no two members are linked, no component stands out: none is left out of the blocks.
    linked = F.col("most") > 1
    mixed = mixed.select(F.xxhash64("key").alias("at"), F.col("key").alias("_key"), F.when(linked, F.col("main")).alias("main"), F.when(linked, F.col("most")).otherwise(0).alias("most"))
    again = checkpointed(of.withColumn("at", F.xxhash64("key")).join(mixed, "at").where("key = _key").select("key", "band", "node", "m", "pivot", "label", "main", "most"))
    columns = ["key", "band", "pivot", "i", "j", "side", "node", "label"]
    small = again.where(F.col("m") <= SMALL).withColumns({c: F.lit(0) for c in ("i", "j", "side")}).select(*columns)
    large = again.where((F.col("m") > SMALL) & ~F.col("label").eqNullSafe(F.col("main")))
    count = F.ceil((F.col("m") - F.col("most")) / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    large = large.withColumn("blocks", count).withColumn("own", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocked = large.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("int")}).select(*columns)
    more = checkpointed(_within(small.unionByName(blocked).join(nodes, "node"), percent, miss))
    pairs = again.where((F.col("m") > SMALL) & (F.col("label") != F.col("main"))).select("node", F.col("label").alias("own"), F.col("main").alias("label")).distinct()
    found = [_confirmed(more, texts, percent)] if more.limit(1).count() else []
    if pairs.limit(1).count():
        found.append(_outsiders(pairs, labels, nodes, texts, percent))
    if found:
        # Labels are joined by what was found between them. A label is a node's own number, or its component's least.
        joined = components(reduce(DataFrame.unionByName, found))
        renamed = labels.join(joined.select(F.col("node").alias("label"), F.col("label").alias("_to")), "label", "left").select("node", F.coalesce("_to", "label").alias("label"))
        labels = checkpointed(renamed.unionByName(joined.join(labels.select("node"), "node", "left_anti")))

    roots = nodes.join(labels, "node", "left").select("digest", "root", F.coalesce("label", "node").alias("label"))
    least = roots.groupBy("label").agg(F.min("root").alias("component_id"))
    least = least.select(F.xxhash64("label").alias("at"), F.col("label").alias("_label"), "component_id")
    named = roots.withColumn("at", F.xxhash64("label")).join(least, "at").where("label = _label").select(F.col("digest").alias("_digest"), "component_id")
    whole = known.join(named, F.col("digest") == F.col("_digest")).select("id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where(F.col("digest").isNull()).select("id", F.lit(0).cast("long").alias("n_shingles"), F.col("id").alias("component_id"))
    out = whole.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
    return out.withColumnRenamed("id", id_col)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share at least 80 % of their two-word shingles."""
    return near_duplicates(read(spark, sf_dir, "documents"), width=2)


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) < 2 THEN ws ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS sh FROM w),
z AS (SELECT doc_id, len(sh) AS n FROM s),
u AS (SELECT doc_id, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM z UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.seen)
SELECT z.doc_id, CAST(n AS BIGINT) AS n_shingles, min(seen) AS component_id, z.doc_id = min(seen) AS kept FROM z JOIN r USING (doc_id) GROUP BY z.doc_id, n
"""
