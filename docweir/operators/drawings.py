"""Drawings of diagrams: layers by longest paths, order within layers by barycentres, and a raster written as PNG."""

from __future__ import annotations

import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweir.operators import visuals

#: Pixels of a box, of the gap between boxes, and most pixels of a side; what is larger is drawn to scale.
BOX, GAP, MOST_SIDE = (96, 40), (24, 40), 4096
#: Times that the layers are put in order, down and up.
SWEEPS = 4
Edge = tuple[str, str]


def without_cycles(edges: list[Edge]) -> list[Edge]:
    """Edges in their order, each once, without those that would close a cycle with edges before them, and without loops."""
    below: dict[str, list[str]] = defaultdict(list)
    kept: list[Edge] = []
    for a, b in dict.fromkeys(edges):
        todo, met = [b], {b}
        while todo and a not in met:
            fresh = [x for x in below[todo.pop()] if x not in met]
            met.update(fresh)
            todo += fresh
        if a not in met:
            below[a].append(b)
            kept.append((a, b))
    return kept


def layers(edges: list[Edge]) -> dict[str, int]:
    """Each node's layer: the number of edges on the longest path to it. Cycles are cut at the edges that close them."""
    dag = without_cycles(edges)
    nodes = list(dict.fromkeys(x for e in edges for x in e))
    out = dict.fromkeys(nodes, 0)
    waiting = {n: sum(b == n for _, b in dag) for n in nodes}
    below: dict[str, list[str]] = defaultdict(list)
    for a, b in dag:
        below[a].append(b)
    ready = [n for n in nodes if not waiting[n]]
    while ready:
        a = ready.pop()
        for b in below[a]:
            out[b] = max(out[b], out[a] + 1)
            waiting[b] -= 1
            if not waiting[b]:
                ready.append(b)
    return out


def ordered(edges: list[Edge], level: dict[str, int]) -> list[list[str]]:
    """The nodes of each layer, from left to right: by the mean place of their neighbours in the layer beside, swept down and up."""
    rows: list[list[str]] = [[] for _ in range(max(level.values(), default=-1) + 1)]
    for n, k in level.items():
        rows[k].append(n)
    above, below = defaultdict(list), defaultdict(list)
    for a, b in dict.fromkeys(edges):
        if level[a] != level[b]:
            top, low = (a, b) if level[a] < level[b] else (b, a)
            below[top].append(low)
            above[low].append(top)
    for sweep in range(SWEEPS):
        down = sweep % 2 == 0
        near = above if down else below
        place = {n: i for row in rows for i, n in enumerate(row)}
        for row in rows if down else reversed(rows):
            means = {n: sum(place[m] for m in near[n]) / len(near[n]) if near[n] else place[n] for n in row}
            row.sort(key=means.__getitem__)
            place.update((n, i) for i, n in enumerate(row))
    return rows


def crossings(edges: list[Edge], rows: list[list[str]]) -> int:
    """How many pairs of edges between neighbouring layers cross."""
    at = {n: (k, i) for k, row in enumerate(rows) for i, n in enumerate(row)}
    spans = defaultdict(list)
    for a, b in dict.fromkeys(edges):
        (ka, ia), (kb, ib) = sorted((at[a], at[b]))
        if kb == ka + 1:
            spans[ka].append((ia, ib))
    return sum((a < c and b > d) or (a > c and b < d) for found in spans.values() for i, (a, b) in enumerate(found) for c, d in found[:i])


def _points(lines: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Columns and rows of the pixels of lines (x0, y0, x1, y1), all lines at once: as many steps as a line's longer side has pixels before it is drawn to scale."""
    way = lines[:, 2:] - lines[:, :2]
    steps = np.abs(way).max(axis=1).astype(int)
    which = np.repeat(np.arange(len(lines)), steps + 1)
    ends = np.cumsum(steps + 1)
    at = np.arange(ends[-1]) - np.repeat(ends - steps - 1, steps + 1)
    xy = at[:, None] * (way / np.maximum(steps, 1)[:, None])[which] + lines[which, :2]
    drawn_to = steps > 0
    xy[ends[drawn_to] - 1] = lines[drawn_to, 2:]
    xy = np.rint(xy * scale).astype(int)
    return xy[:, 0], xy[:, 1]


def raster(edges: list[Edge], rows: list[list[str]]) -> np.ndarray:
    """A grey picture: a box for each node, and a line with a thick end for each edge."""
    (bw, bh), (gw, gh) = BOX, GAP
    wide = max(map(len, rows), default=0)
    width, height = wide * (bw + gw) + gw, len(rows) * (bh + gh) + gh
    scale = min(1.0, MOST_SIDE / max(width, height, 1))
    image = np.full((max(1, int(height * scale)), max(1, int(width * scale))), 255, np.uint8)

    def corner(k: int, i: int) -> tuple[float, float]:
        return gw + (wide - len(rows[k])) * (bw + gw) / 2 + i * (bw + gw), gh + k * (bh + gh)

    places = {n: corner(k, i) for k, row in enumerate(rows) for i, n in enumerate(row)}
    lines = [a for x, y in places.values() for a in ((x, y, x + bw, y), (x, y + bh, x + bw, y + bh), (x, y, x, y + bh), (x + bw, y, x + bw, y + bh))]
    heads = []
    for a, b in dict.fromkeys(edges):
        (xa, ya), (xb, yb) = places[a], places[b]
        down = yb >= ya
        start, end = (xa + bw / 2, ya + bh * down), (xb + bw / 2, yb + bh * (not down))
        lines.append((*start, *end))
        heads.append((end[0], end[1] - (6 if down else -6), *end))
    side, most = image.shape
    for part, size in ((lines, 0), (heads, 2)):
        if part:
            xs, ys = _points(np.array(part, float), scale)
            xs, ys = np.minimum(np.maximum(xs, 0), most - 1), np.minimum(np.maximum(ys, 0), side - 1)
            for dx in range(-size, size + 1):
                image[ys, np.minimum(np.maximum(xs + dx, 0), most - 1)] = 0
    return image


def png(image: np.ndarray, **texts: str) -> bytes:
    """A grey picture as PNG: chunks with their lengths and checksums; texts are stored with it."""

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    height, width = image.shape
    lines = np.zeros((height, width + 1), np.uint8)  # each line is led by its filter: none
    lines[:, 1:] = image
    packer = zlib.compressobj(6, strategy=zlib.Z_RLE)  # drawings are runs of white: a third of the time of a search for matches, and a quarter more bytes
    told = [chunk(b"iTXt", k.encode("latin-1") + b"\0\0\0\0\0" + v.encode()) for k, v in texts.items()]
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + b"".join(told) + chunk(b"IDAT", packer.compress(lines.tobytes()) + packer.flush()) + chunk(b"IEND", b"")


def drawn(docs: DataFrame, most: int = 30) -> DataFrame:
    """(source_id, nodes, edges, crossings, layers map, image) of the Mermaid diagrams of docs (source_id, content); those without an edge have no row.

    A diagram has at most `most` edges, so each is a small task of its own, and they are drawn in Arrow batches.
    Edges are few bytes beside the work that they make: they are dealt to as many tasks as shuffles have,
    which adaptive execution doesn't put together by their bytes.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = visuals.diagram_edges(docs, most).repartition(parts, "source_id").groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", "from_node", "to_node"))).alias("edges"))
    kind = dict(found.dtypes)["source_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # pictures are large beside their edges
                part = batch.slice(at, 64)
                out = []
                for found_edges in part.column("edges").to_pylist():
                    edges = [(e["from_node"], e["to_node"]) for e in found_edges]
                    level = layers(edges)
                    rows = ordered(edges, level)
                    told = "\n".join(f"{a} -> {b}" for a, b in edges)
                    out.append((len(level), len(set(edges)), crossings(edges, rows), list(level.items()), png(raster(edges, rows), Description=told)))
                kinds = (pa.int32(), pa.int32(), pa.int32(), pa.map_(pa.string(), pa.int32()), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("source_id"), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names=["source_id", "nodes", "edges", "crossings", "layers", "image"])

    return found.mapInArrow(run, f"source_id {kind}, nodes int, edges int, crossings int, layers map<string,int>, image binary")
