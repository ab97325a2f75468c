from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from docweir.llm import mixing, sharding
from tests.llm.conftest import ROWS, row


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def by_rounds(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, target, full = share * sum(sizes.values()), {}, set()
    while True:
        left = goal - sum(repeats * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        target = {s: repeats * sizes[s] if s in full else left * weight[s] / free for s in names}
        over = {s for s in names if s not in full and target[s] > repeats * sizes[s] + 1e-9}
        if not over:
            return target
        full |= over


def check(rows, found, tolerance=1.0):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r[1])
    want = by_rounds(sizes)
    source = {(r[0], size(r[1])): r[3] for r in rows}  # in these tests, an id and a size tell the source
    assert Counter((r.doc_id, r.size) for r in found) == Counter((r[0], size(r[1])) for r in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in found)
    taken = Counter()
    for name, total in sizes.items():
        mine = [r for r in found if source[r.doc_id, r.size] == name]
        assert all(abs(r.target - want[name]) < 1e-6 * max(1, want[name]) and r.source_size == total for r in mine)
        taken[name] = sum(r.taken for r in mine)
        assert abs(taken[name] - want[name]) <= tolerance, name


def test_targets_and_takes(spark, edge):
    rows = [row(i, "w " * (i % 40), source=f"s{i % 7}" if i % 11 else None) for i in range(700)] + [row(1000 + i, "big " * 300, source="s0") for i in range(40)]
    found = mixing.mix(spark.createDataFrame(rows, edge.schema)).collect()
    check(rows, found)


def test_awkward_rows(edge):
    check(ROWS, mixing.mix(edge).collect())


def test_reruns_agree(edge):
    one, two = (sorted(map(tuple, mixing.mix(df).collect()), key=repr) for df in (edge, edge.repartition(3)))
    assert one == two


def test_a_source_larger_than_all_others(spark, edge):
    rows = [row(i, "a b c d", source="hot") for i in range(600)] + [row(1000 + i, "a b", source=f"c{i}") for i in range(30)]
    check(rows, mixing.mix(spark.createDataFrame(rows, edge.schema), block_words=16).collect())


def test_nothing_to_mix(spark, edge, nothing):
    assert mixing.mix(nothing).count() == 0
    blank = spark.createDataFrame([row(1, None), row(2, "  ")], edge.schema)
    assert [(r.size, r.taken) for r in mixing.mix(blank).collect()] == [(0, 0), (0, 0)]


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_shards_are_contiguous_and_even(edge, shards):
    found = sharding.shard_by_bytes(edge, shards).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in ROWS)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == want
    groups = defaultdict(list)
    for r in found:
        groups[r.shard].append(r)
    order = []
    for shard in sorted(groups):
        groups[shard].sort(key=lambda r: r.slot)
        assert [r.slot for r in groups[shard]] == list(range(len(groups[shard])))
        order += [(r.doc_id is not None, r.doc_id or 0, r.text_crc32) for r in groups[shard]]
    assert order == sorted(order)
    total, most = sum(r.size for r in found), max(r.size for r in found)
    assert all(sum(r.size for r in g) <= total / shards + most for g in groups.values())


def test_many_small_documents(spark, edge, nothing):
    rows = [row(i % 500, "t" * (i % 97)) for i in range(3000)]
    found = sharding.shard_by_bytes(spark.createDataFrame(rows, edge.schema)).collect()
    per = Counter()
    for r in found:
        per[r.shard] += r.size
    assert len(per) == 24 and max(per.values()) - min(per.values()) <= 2 * (97 + 8)
    assert sharding.shard_by_bytes(nothing).count() == 0


def test_slots_are_those_of_the_schedule(spark, edge, monkeypatch):
    """Blocks are played where the golden ratio's points say; another step plays them at other times, and takes the same words."""
    rows = [row(i, "w " * (5 + i % 60), source=f"s{i % 5}") for i in range(900)]
    docs = spark.createDataFrame(rows, edge.schema)
    found = mixing.mix(docs, block_words=64).collect()
    check(rows, found)
    sizes, want = Counter(), {}
    for r in rows:
        sizes[r[3]] += size(r[1])
    want = by_rounds(sizes)
    need = {s: -(-round(t) // 64) for s, t in want.items()}
    total, edges = sum(want.values()), np.cumsum([want[s] for s in sorted(want)])
    lanes = np.searchsorted(np.floor(edges / total * mixing.POINTS)[:-1], np.arange(sum(need.values())) * mixing.STEP % mixing.POINTS, "right")
    drawn = Counter(lanes.tolist())
    assert all(abs(drawn[i] - need[s]) <= 4 for i, s in enumerate(sorted(want)))  # the discrepancy
    source = {r[0]: int(r[3][1:]) for r in rows}
    played = [r for r in found if r.first_slot is not None and r.first_slot < len(lanes)]
    assert len(played) > 800 and all(lanes[r.first_slot] == source[r.doc_id] for r in played)
    assert all((r.slots > 0) == (r.taken > 0) == (r.first_slot is not None) for r in found)
    monkeypatch.setattr(mixing, "STEP", 1_000_000_007)
    other = {r.doc_id: r for r in mixing.mix(docs, block_words=64).collect()}
    assert all(other[r.doc_id].taken == r.taken for r in found) and sum(other[r.doc_id].first_slot != r.first_slot for r in found) > 400


def test_mixing_equals_sql_over_whole_tables(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    columns = ["doc_id", "size", "source_size", "target", "taken", "first_slot", "slots"]
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({mixing.SQL})").fetchall()
    got = mixing.op5_mixing(spark, small).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want) and sum(r.taken for r in got) > 0


def test_shards_equal_sql_over_whole_tables(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    columns = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({sharding.SQL})").fetchall()
    assert sorted(map(tuple, sharding.op9_sharding(spark, small).select(*columns).collect())) == sorted(want)


def test_cuts_hold_for_any_size():
    total, shards = 10**14, 100_000
    cuts = sharding.cut_points(total, shards)
    for middle in (0, 1, 2 * total - 1, total, 2 * 123_456_789_012, 2 * total // shards, 2 * total // shards - 1):
        assert np.searchsorted(cuts, middle, "right") == middle * shards // (2 * total)
    for total, shards in ((7, 3), (1000, 24), (999, 7), (5, 9)):
        cuts = sharding.cut_points(total, shards)
        assert [int(np.searchsorted(cuts, m, "right")) for m in range(2 * total)] == [m * shards // (2 * total) for m in range(2 * total)]
