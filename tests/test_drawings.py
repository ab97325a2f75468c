from __future__ import annotations

import random
import struct
import zlib

import numpy as np
from pyspark.sql import functions as F

from docweir.operators import drawings, references


def read_png(data):
    """Width, height, pixels and texts, each chunk's checksum compared."""
    assert data[:8] == b"\x89PNG\r\n\x1a\n"
    at, body, texts, size = 8, b"", {}, None
    while at < len(data):
        (n,), kind = struct.unpack(">I", data[at : at + 4]), data[at + 4 : at + 8]
        part = data[at + 8 : at + 8 + n]
        assert struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0] == zlib.crc32(kind + part)
        if kind == b"IHDR":
            size = struct.unpack(">IIBBBBB", part)
            assert size[2:] == (8, 0, 0, 0, 0)
        elif kind == b"iTXt":
            key, _, rest = part.partition(b"\0")
            texts[key.decode()] = rest[4:].decode()
        body += part if kind == b"IDAT" else b""
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(body), np.uint8).reshape(size[1], size[0] + 1)
    assert not lines[:, 0].any()
    return lines[:, 1:], texts


def test_layers_are_longest_paths():
    rng = random.Random(3)
    for _ in range(50):
        n = rng.randint(2, 9)
        edges = [(str(a), str(b)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.4]
        if not edges:
            continue
        below = lambda b: 1 + max((below(a) for a, c in edges if c == b), default=-1)
        assert drawings.layers(edges) == {x: below(x) for e in edges for x in e}


def test_cycles_and_loops_are_cut():
    assert drawings.without_cycles([("a", "b"), ("b", "c"), ("c", "a"), ("a", "a"), ("a", "b")]) == [("a", "b"), ("b", "c")]
    assert drawings.layers([("a", "b"), ("b", "a")]) == {"a": 0, "b": 1} and drawings.layers([("a", "a")]) == {"a": 0}
    assert drawings.ordered([], {}) == []


def test_order_takes_crossings_away():
    edges = [("a", "z"), ("b", "y"), ("c", "x"), ("a", "p"), ("b", "q")]
    level = drawings.layers(edges)
    first = [[n for n, k in level.items() if k == row] for row in range(2)]
    rows = drawings.ordered(edges, {n: level[n] for n in ("a", "b", "c", "x", "y", "z", "q", "p")})
    assert drawings.crossings(edges, rows) == 0 and sorted(rows[0]) == sorted(first[0])


def test_pictures_are_whole(spark):
    rows = spark.createDataFrame([("a", "```mermaid\ngraph TD\nA[Start] --> B[Énd]\nB --> C\nC --> A\n```"), ("b", "no diagram"), ("c", None)], "source_id string, content string")
    found = drawings.drawn(rows).collect()
    assert [(r.source_id, r.nodes, r.edges, r.layers) for r in found] == [("a", 3, 3, {"A": 0, "B": 1, "C": 2})]
    pixels, texts = read_png(bytes(found[0].image))
    (bw, bh), (gw, gh) = drawings.BOX, drawings.GAP
    assert pixels.shape == (3 * (bh + gh) + gh, bw + 2 * gw) and texts["Description"] == "A -> B\nB -> C\nC -> A"
    assert all(not pixels[gh + k * (bh + gh), gw : gw + bw].any() for k in range(3))  # the upper side of each box
    wide = drawings.raster([("a", str(i)) for i in range(200)], [["a"], [str(i) for i in range(200)]])
    assert max(wide.shape) <= drawings.MOST_SIDE and (wide == 0).any()


def test_pinned_files(spark):
    sha = "0a" * 20
    link = lambda p: f"https://github.com/o/r/blob/{sha}/{p}"
    docs = spark.createDataFrame([("P", "d", " ".join(link(p) for p in ("ok", "gone", "big", "other", "../up", "theirs", "unknown"))), ("P", "e", None)], "project_id string, source_id string, content string")
    pins = spark.createDataFrame([("Q" if p == "theirs" else "P", "o/r", sha, p, "h") for p in ("ok", "gone", "big", "other", "theirs")] + [("Q", "o/r", sha, "ok", "x")], "project_id string, repository string, sha string, path string, digest string")
    files = spark.createDataFrame([("o/r", "ok", "h", 1), ("o/r", "big", "h", 4_000_001), ("o/r", "other", "x", 1), ("o/r", "theirs", "h", 1), ("o/r", "unknown", "h", 1)], "repository string, path string, digest string, size long")
    found = {r.path: r.reason for r in references.pinned(docs, pins, files).collect()}
    assert found == {"ok": None, "gone": "unavailable", "big": "too large", "other": "content differs", "../up": "invalid path", "theirs": "another project's", "unknown": "not pinned"}


def test_diagrams_are_drawn_in_as_many_tasks_as_shuffles_have(spark):
    docs = spark.range(200).select(F.concat(F.lit("d"), "id").alias("source_id"), F.lit("```mermaid\na --> b\n```").alias("content"))
    drawn = drawings.drawn(docs).select("nodes", F.spark_partition_id().alias("task")).collect()
    assert len(drawn) == 200 and len({r.task for r in drawn}) > 1


def test_points_of_lines_are_those_of_each_line_alone():
    lines = np.array([(0, 0, 96, 0), (5, 7, 5, 7), (10, 3, 2, 51), (1.5, 2, 40, 9.25)])
    for scale in (1.0, 0.37):
        xs, ys = drawings._points(lines, scale)
        each = [np.rint(np.linspace(a[:2], a[2:], int(max(abs(a[2:] - a[:2]))) + 1) * scale) for a in lines]
        assert np.array_equal(np.stack([xs, ys], 1), np.concatenate(each))
