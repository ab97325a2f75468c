from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from docweir.llm import packing, tokens, training_order
from tests.llm.conftest import ROWS

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def slow():
    return Tokenizer.from_file(PATH)


def test_ids_are_those_of_tokenizers(slow, spark, small):
    encode = tokens.encoder(PATH)
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()] + [r[1] or "" for r in ROWS] + ["a<|endoftext|>b", "  \n\n x", "ẞß İi"]
    for text in texts:
        assert encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 1_000_000, "a" + "\n" * 800_000 + " b", ("word " * 30_000 + "\t" * 250_000) * 2, "x" * 300_000, "!" * 300_000, " " * 99_999 + "x"], ids=["blanks", "lines", "tabs", "letters", "marks", "just short"])
def test_long_runs_have_the_same_ids(slow, text):
    assert tokens.encoder(PATH)(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_long_runs_are_packed(spark, edge):
    text = "a" + " " * 1_000_000 + "b"
    rows = packing.pack(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert sum(r.length for r in rows) == len(tokens.encoder(PATH)(text)) + 1


def expected(slow, capacity):
    out = Counter()
    for r in ROWS:
        ids = np.array([*slow.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % capacity or capacity
        edges = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            out[r[0], k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    return out


def test_every_piece_is_packed_once(slow, edge):
    rows = packing.pack(edge).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected(slow, 1024)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= 1024
    assert len(bins) <= math.ceil(sum(r.length for r in rows) / 1024) + 1


def test_best_fit_takes_the_tightest_place():
    sizes = np.array([6, 5, 4, 3, 2])
    bins, room = np.empty(5, np.int64), []
    packing.best_fit(np.arange(5), sizes, bins, room, 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and room == [0, 0]


def test_crossover_and_mutation_keep_every_item():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 101, 300)
    one, two = (packing._refit(np.zeros(300, np.int64), np.ones(300, bool), sizes, 100, np.random.default_rng(s)) for s in (1, 2))
    for child in (packing.crossover(one, two, sizes, 100, rng), packing.mutate(one, sizes, 100, rng)):
        assert np.bincount(child, sizes).max() <= 100 and set(child) == set(range(child.max() + 1))


def test_evolution_is_never_worse_than_best_fit_and_reaches_small_optima():
    sizes = np.array([7, 6, 5, 5, 4, 3, 3, 3, 2, 2])  # 40: four bins of ten
    best = packing.evolve(sizes, [], 10, np.random.default_rng(0), population=8, generations=40)
    assert best.max() + 1 == 4
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 60, 400)
    bins, room = np.empty(400, np.int64), []
    packing.best_fit(np.argsort(-sizes, kind="stable"), sizes, bins, room, 100)
    assert packing.evolve(sizes, [], 100, rng).max() + 1 <= len(room)


def test_partly_filled_bins_of_all_blocks_are_merged(spark, edge, monkeypatch):
    """Three pieces fill a bin to 88 %, so every block packs as before and keeps a bin of one or two."""
    monkeypatch.setattr(packing, "BLOCK", 16)
    given = spark.range(200).selectExpr("id", "0 AS piece", "0L AS start", "300L AS length", "0L AS ids_crc32")
    monkeypatch.setattr(packing, "cut", lambda *_: given)
    bins = defaultdict(list)
    for r in packing.pack(edge).collect():
        bins[r.sequence_id].append((r.doc_id, r.offset))
    assert sorted(i for b in bins.values() for i, _ in b) == list(range(200)) and len(bins) == 67
    assert all(sorted(o for _, o in b) == [0, 300, 600][: len(b)] for b in bins.values())


def test_empty_packing(nothing):
    assert packing.pack(nothing).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000, 12_345])
def test_permutation_is_a_bijection(size):
    got = training_order.permute(np.arange(size), size)
    assert sorted(got) == list(range(size))
    if size > 60:
        assert (got != training_order.permute(np.arange(size), size, key=1)).any()


def test_permutation_bounds():
    top = 1 << 62
    assert all(0 <= x < top for x in training_order.permute(np.array([0, top - 1], np.uint64), top))
    with pytest.raises(ValueError):
        training_order.permute(np.array([0]), 0)


def ids_of(slow, text, end=50256):
    return [*slow.encode(text or "", add_special_tokens=False).ids, end]


def stored(where, rows, length, width=2):
    """The ids of every slot and of every document's pieces, read back from the shards' files."""
    slots, pieces, files = {}, [], defaultdict(list)
    for r in rows:
        files[r.shard, r.file].append(r)
    assert len(files) == len({shard for shard, _ in files})
    for (_, file), found in files.items():
        ids = [x.tolist() for x in training_order.read_shard(where, file, length, 0, width)]
        assert {r.place for r in found} == set(range(len(ids)))
        assert [x.tolist() for x in training_order.read_shard(where, file, length, 2, width)] == ids[2:]
        for r in found:
            part = ids[r.place][r.offset : r.offset + r.length]
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes()) and r.byte_offset == r.place * width * (length + 1) and r.length == len(part)
            slots[r.slot] = tuple(ids[r.place])
            pieces.append((r.doc_id, r.piece, tuple(part)))
        spans = sorted((r.place, r.offset, r.length) for r in found)
        assert all(b[1] == (a[1] + a[2] if a[0] == b[0] else 0) for a, b in zip(spans, spans[1:])) and sum(n for *_, n in spans) == sum(map(len, ids))
    return slots, pieces


def test_every_slot_is_the_permutation_of_a_number(slow, edge, tmp_path):
    where = f"file://{tmp_path}/order"
    rows = training_order.materialise(edge.coalesce(1), where, length=64).collect()
    stream = [i for r in ROWS for i in ids_of(slow, r[1])]
    given = [tuple(stream[a : a + 64]) for a in range(0, len(stream), 64)]
    slots, pieces = stored(where, rows, 64)
    assert slots == dict(zip(training_order.permute(np.arange(len(given)), len(given)).tolist(), given)) and len({r.shard for r in rows}) == 4
    whole = defaultdict(list)
    for doc_id, _, ids in sorted((p for p in pieces if p[0] in (6, 7, 13)), key=lambda p: p[1]):
        whole[doc_id] += ids
    assert {r[0]: ids_of(slow, r[1]) for r in ROWS if r[0] in (6, 7, 13)} == whole
    assert {p.name for p in (tmp_path / "order").iterdir() if p.suffix != ".crc"} == {r.file for r in rows} and not (tmp_path / "order-ids").exists()


def test_any_ids_and_many_tasks(slow, spark, tmp_path):
    rows = [(None if i % 50 == 0 else "hot" if i % 3 else f"id-{i}", f"text number {i} " * (i % 40)) for i in range(400)]
    where = f"file://{tmp_path}/order"
    got = training_order.materialise(spark.createDataFrame(rows, "doc_id string, text string").repartition(7), where, length=32, shard_bytes=4096).collect()
    slots, pieces = stored(where, got, 32)
    assert sorted(slots) == list(range(len(slots))) and sum(len(x) < 32 for x in slots.values()) <= 7
    assert Counter(p[0] for p in pieces if not p[1]) == Counter(r[0] for r in rows)
    assert Counter(i for *_, ids in pieces for i in ids) == Counter(i for r in rows for i in ids_of(slow, r[1]))
    counts = Counter(r.shard for r in {(r.shard, r.place): r for r in got}.values())
    assert all(n == 4096 // 66 for shard, n in counts.items() if shard < max(counts))


def test_files_of_failed_tries_go(edge, tmp_path):
    where = f"file://{tmp_path}/order"
    key = lambda rows: {(r.slot, r.offset, r.doc_id, r.piece, r.ids_crc32) for r in rows}
    one = training_order.materialise(edge, where, length=64).collect()
    (tmp_path / "order" / "shard-00000000-failed.bin").write_bytes(b"half")
    two = training_order.materialise(edge, where, length=64).collect()
    assert key(one) == key(two)
    assert {p.name for p in (tmp_path / "order").iterdir() if p.suffix != ".crc"} == {r.file for r in two}


def test_empty_order(nothing, tmp_path):
    assert training_order.materialise(nothing, f"file://{tmp_path}/none").count() == 0


def test_random_lengths_fill_well():
    rng = random.Random(5)
    sizes = np.array([rng.randint(1, 1023) for _ in range(2048)])
    best = packing.evolve(sizes, [], 1024, np.random.default_rng(0))
    assert best.max() + 1 <= math.ceil(sizes.sum() / 1024) * 1.01 + 1


def test_ids_over_16_bits_take_32(spark, tmp_path):
    from tokenizers.models import WordLevel

    path = f"{tmp_path}/large.json"
    Tokenizer(WordLevel({"[UNK]": 0, "most": 65_535, "over": 65_536}, unk_token="[UNK]")).save(path)
    where = f"file://{tmp_path}/wide"
    rows = training_order.materialise(spark.createDataFrame([(1, "most"), (2, "over")], "doc_id long, text string"), where, path=path, end=70_000).collect()
    assert sorted(stored(where, rows, training_order.LENGTH, 4)[1]) == [(1, 0, (65_535, 70_000)), (2, 0, (65_536, 70_000))]


def test_pair_fits_fill_bins():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 1024, 20_000)
    bins = packing.pair_fit(sizes, 1024, rng)
    fill = np.bincount(bins, sizes)
    assert fill.max() <= 1024 and len(np.unique(bins)) == len(fill) and (fill == 1024).mean() > 0.85


def test_evolution_saves_bins_over_best_fit():
    """Many large items: best fit by size leaves gaps that whole bins of pair fits don't."""
    rng = np.random.default_rng(5)
    sizes = rng.integers(200, 700, 6000)
    bins, room = np.empty(len(sizes), np.int64), []
    packing.best_fit(np.argsort(-sizes, kind="stable"), sizes, bins, room, 1024)
    assert packing.evolve(sizes, [], 1024, np.random.default_rng(0)).max() + 1 < len(room)
