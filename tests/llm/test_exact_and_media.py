from __future__ import annotations

import hashlib
import os
import random
import string
import zlib
from collections import defaultdict

import pytest

from docweir.llm import exact_dedup, ogg
from tests.llm.conftest import ROWS, row


def normal(text):
    return (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[normal(r[1])].append(r[0])
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        first = True
        for i in ids:
            kept = i == keep and first
            first = first and not kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_verdicts_equal_brute_force(edge):
    found = exact_dedup.verdicts(edge, hash_all=True).collect()
    assert sorted(map(tuple, found), key=repr) == brute(ROWS)


def test_full_hash_is_only_made_for_survivors(edge):
    found = exact_dedup.verdicts(edge, prefix_chars=2).collect()
    assert all(r.full_hash is None for r in found if r.doc_id in (6, 7, 13))
    assert all(r.full_hash for r in found if r.group_size > 1)


def test_deduplicate_keeps_one_of_each_text_and_all_columns(edge):
    kept = exact_dedup.deduplicate(edge)
    assert kept.columns == edge.columns
    rows = kept.collect()
    assert sorted(normal(r.text) for r in rows) == sorted({normal(r[1]) for r in ROWS})
    assert all(r._dw_open == "e" for r in rows)
    assert {r.doc_id for r in rows if normal(r.text) == "one"} == {15}


def test_large_groups_and_random_rows(spark, edge):
    rng = random.Random(3)
    rows = [row(i, rng.choice(["Copy", "copy", "cOpY"]) if i % 3 == 0 else "".join(rng.choice("aAbB") for _ in range(rng.randint(0, 6)))) for i in range(900)]
    found = exact_dedup.verdicts(spark.createDataFrame(rows, edge.schema), hash_all=True).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)


def test_empty_tables(nothing):
    assert exact_dedup.verdicts(nothing).count() == 0
    assert exact_dedup.deduplicate(nothing).count() == 0
    assert ogg.read_media(ogg.store_media(nothing)).count() == 0


def bitwise_crc(data):
    crc = 0
    for byte in data:
        crc ^= byte << 24
        for _ in range(8):
            crc = (crc << 1 ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


@pytest.mark.parametrize("size", [0, 1, 27, 300])
def test_page_crc_is_the_bitwise_one(size):
    data = os.urandom(size)
    assert ogg.page_crc(data) == bitwise_crc(data)


@pytest.mark.parametrize("size", [0, 1, 575, 576, 577, 48_960, 48_961, 300_000])
def test_payload_round_trip(size):
    payload = ogg.pad(os.urandom(size))
    assert len(payload) % 576 == 0 and len(payload) > 0
    found = ogg.demux(ogg.mux(payload))
    assert found["payload"] == payload and found["bad_pages"] == 0
    assert found["seconds"] == len(payload) / ogg.RATE


def test_packets_continue_over_pages_and_carry_times():
    data = [(os.urandom(n), 1000 * (i + 1)) for i, n in enumerate((10, 70_000, 255, 510, 0, 3))]
    stream = b"".join(ogg.paginate(data, 9, 255))
    found = list(ogg.packets(list(ogg.pages(stream)), {9: 1000}))
    assert [p.data for p in found] == [d for d, _ in data]
    assert [p.end for p in found] == [e for _, e in data]
    assert any(p.flags & ogg.CONTINUED for p in ogg.pages(stream))


def test_streams_are_told_apart_and_damage_is_found():
    one, two = (ogg.paginate([(b"head", 0)] + [(bytes([k]) * 600, 600 * i) for i in range(1, 300)], k) for k in (1, 2))
    mixed = b"".join(page for pair in zip(one, two) for page in pair)
    found = list(ogg.packets(list(ogg.pages(mixed))))
    assert {p.serial for p in found} == {1, 2} and all(set(p.data) == {p.serial} for p in found if p.number)
    broken = bytearray(mixed)
    broken[len(one[0]) + len(two[0]) + 500] ^= 1
    pages = list(ogg.pages(bytes(broken)))
    assert sum(not p.ok for p in pages) >= 1
    left = [p for p in ogg.packets(pages) if p.number]
    assert 0 < len(left) < len(found) - 2 and all(len(p.data) == 600 for p in left)
    assert list(ogg.pages(b"no capture pattern")) == [] and ogg.demux(b"")["payload"] == b""


def test_media_columns(edge):
    found = {(r.doc_id, r.payload_sha256): r for r in ogg.read_media(ogg.store_media(edge)).collect()}
    assert len(found) == len({(r[0], r[1]) for r in ROWS}) and sum(1 for _ in found)
    for r in ROWS:
        text = (r[1] or "").encode()
        payload = ogg.pad(text)
        got = found[r[0], hashlib.sha256(payload).hexdigest()]
        assert (got.n_bytes, got.payload_bytes, got.tail_crc32, got.bad_pages) == (len(text), len(payload), zlib.crc32(payload[-32:]), 0)
        assert got.media_sha256 == hashlib.sha256(ogg.mux(payload)).hexdigest()


def test_packet_table(edge):
    rows = ogg.ogg_packets(ogg.store_media(edge.where("doc_id = 6"))).collect()
    assert b"".join(r.data for r in sorted(rows, key=lambda r: r.end_granule) if r.number).startswith(b"word0x0 word1x1")


def test_granules_of_any_packet():
    """The end of every packet on the shared clock, the short last one and those before it on its page included."""
    payload = os.urandom(576 * 500 + 100)
    found = list(ogg.pages(ogg.mux(payload)))
    known = ogg.heads(found)
    ends = {}
    for p in ogg.packets(found, ogg.clocks(known)):
        if p.number:
            start = ((p.number - 1) * 2 + known[p.serial][3]) * 576
            assert p.end == min(start + 576, len(payload)) and p.data == payload[start : start + 576]
            ends[p.end] = len(p.data)
    assert len(ends) == 501 and ends[len(payload)] == 100


def test_packet_table_has_a_granule_for_every_packet(edge):
    rows = ogg.ogg_packets(ogg.store_media(edge.where("doc_id = 6"))).collect()
    assert len(rows) > 300 and all(r.end_granule >= 0 for r in rows)
    timed = sorted((r.end_granule, r.n_bytes) for r in rows if r.number)
    assert [e - n for e, n in timed] == [576 * i for i in range(len(timed))]


def test_lengths_that_occur_once_leave_before_prefixes_do(spark, edge):
    """Three texts of one length, two of them equal, one with another prefix, and one of a length of its own."""
    rows = [row(1, "same text"), row(2, "SAME text"), row(3, "else text"), row(4, "a length of its own"), row(5, "same tex!")]
    found = {r.doc_id: r for r in exact_dedup.verdicts(spark.createDataFrame(rows, edge.schema), prefix_chars=8).collect()}
    assert {i for i, r in found.items() if r.full_hash} == {1, 2, 5}
    assert [(i, r.keep_id, r.group_size, r.kept) for i, r in sorted(found.items())] == [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 4, 1, True), (5, 5, 1, True)]
