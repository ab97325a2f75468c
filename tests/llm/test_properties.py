from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from docweir.llm import licences, near_dedup, ogg, packing, training_order

SIZES = st.lists(st.integers(1, 50), min_size=1, max_size=80).map(np.array)


@given(st.binary(max_size=5000), st.integers(3, 255))
@settings(deadline=None)
def test_any_payload_comes_back(data, segments):
    payload = ogg.pad(data)
    found = ogg.demux(ogg.mux(payload, segments=segments))
    assert found["payload"] == payload and not found["bad_pages"]


@given(st.lists(st.binary(max_size=1500), min_size=1, max_size=8), st.integers(1, 255))
@settings(deadline=None)
def test_any_packets_come_back(data, segments):
    stream = b"".join(ogg.paginate([(d, i) for i, d in enumerate(data)], 5, segments))
    assert [p.data for p in ogg.packets(list(ogg.pages(stream)))] == data


@given(st.binary(max_size=400))
@settings(deadline=None)
def test_noise_is_no_stream(data):
    assert all(not p.ok or p.lacing for p in ogg.pages(data + b"OggS" + data))
    assert ogg.demux(data)["payload"] == b""


@given(st.integers(1, 1 << 40), st.integers(0, 1 << 32), st.lists(st.integers(0, (1 << 40) - 1), max_size=50, unique=True))
def test_points_stay_apart(size, key, index):
    inside = np.array([i for i in index if i < size], np.uint64)
    got = training_order.permute(inside, size, key)
    assert len(set(got.tolist())) == len(inside) and all(0 <= x < size for x in got)


@given(SIZES, st.integers(0, 1000))
@settings(deadline=None, max_examples=50)
def test_packings_hold_every_item(sizes, seed):
    best = packing.evolve(sizes, [], 50, np.random.default_rng(seed), population=4, generations=3)
    assert np.bincount(best, sizes).max() <= 50 and set(best.tolist()) == set(range(best.max() + 1))
    assert best.max() + 1 >= -(-int(sizes.sum()) // 50)


@given(st.text(max_size=60), st.integers(1, 5))
def test_shingle_counts(text, width):
    words = near_dedup.words(text)
    want = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set()
    assert len(near_dedup.shingles(words, width, near_dedup._Words())) == len(want)


@given(st.lists(st.integers(0, 9), min_size=1, max_size=60).map(lambda x: np.array(x, np.uint64)), st.integers(1, 6))
def test_every_window_has_its_least_hash(hashes, window):
    marks = licences.winnow(hashes, window)
    for i in range(max(1, len(hashes) - window + 1)):
        part = hashes[i : i + window]
        assert any(i <= m < i + window and hashes[m] == part.min() for m in marks)
