"""Ogg containers as media columns: pages, packets, logical streams, timestamps.

The layout is the public one of RFC 3533. The codec inside is raw 8-bit PCM in packets of a fixed
number of samples, dealt over several logical streams that share one clock.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from docweir.llm.common import read, tidy

MAGIC = b"DWPCM8\x00\x01"
CONTINUED, FIRST, LAST = 1, 2, 4
RATE = 8000
SAMPLES = 576
STREAMS = 2
#: Segments that a page is filled to; 255 is the most. Below it, packets run on over page ends.
PAGE_SEGMENTS = 254
_HEAD = struct.Struct("<4sBBqIIIB")
_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def page_crc(page: bytes) -> int:
    """CRC-32 of a page whose checksum field is zero: polynomial 0x04c11db7, most significant bit first, from 0.

    zlib's CRC has the same polynomial with the bits reversed, so bytes go in and the sum comes out reversed.
    """
    mirrored = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(mirrored.to_bytes(4, "little").translate(_REVERSED), "big")


class Page(NamedTuple):
    """A page as found; ok is whether version, length and checksum are right."""

    offset: int
    flags: int
    granule: int
    serial: int
    sequence: int
    lacing: bytes
    body: bytes
    ok: bool


class Packet(NamedTuple):
    """A packet of a logical stream; end is the clock at its end in samples, -1 where unknown."""

    serial: int
    number: int
    data: bytes
    end: int


def build_page(flags: int, granule: int, serial: int, sequence: int, lacing: bytes, body: bytes) -> bytes:
    """The bytes of a page, checksum included."""
    page = bytearray(_HEAD.pack(b"OggS", 0, flags, granule, serial, sequence, 0, len(lacing)))
    page += lacing
    page += body
    page[22:26] = page_crc(bytes(page)).to_bytes(4, "little")
    return bytes(page)


def paginate(packets: list[tuple[bytes, int]], serial: int, segments: int = PAGE_SEGMENTS) -> list[bytes]:
    """The pages of one logical stream; packets are (data, clock at its end). The first has a page of its own."""
    pages: list[bytes] = []
    lacing, body, granule, flags = bytearray(), bytearray(), -1, FIRST

    def close(last: bool) -> None:
        nonlocal lacing, body, granule, flags
        pages.append(build_page(flags | (LAST if last else 0), granule, serial, len(pages), bytes(lacing), bytes(body)))
        lacing, body, granule = bytearray(), bytearray(), -1

    for i, (data, end) in enumerate(packets):
        laces = b"\xff" * (len(data) // 255) + bytes([len(data) % 255])
        at = 0
        while laces:
            if len(lacing) == segments:
                close(False)
                flags = CONTINUED if at else 0
            room = laces[: segments - len(lacing)]
            size = sum(room)
            lacing += room
            body += data[at : at + size]
            at, laces = at + size, laces[len(room) :]
        granule = end
        if i == 0 or i == len(packets) - 1:
            close(i == len(packets) - 1)
            flags = 0
    return pages


def mux(payload: bytes, samples: int = SAMPLES, streams: int = STREAMS, rate: int = RATE, segments: int = PAGE_SEGMENTS) -> bytes:
    """payload as 8-bit PCM: packet k goes to logical stream k mod streams; pages are interleaved by the clock."""
    queues = []
    for s in range(streams):
        head = MAGIC + struct.pack("<IHHH", rate, samples, streams, s)
        packets = [(head, 0)]
        packets += [(payload[i : i + samples], min(i + samples, len(payload))) for i in range(s * samples, len(payload), streams * samples)]
        queues.append(paginate(packets, s + 1, segments))
    out = [q[0] for q in queues]  # all first pages come before any other
    out += [page for row in range(1, max(map(len, queues))) for q in queues for page in q[row : row + 1]]
    return b"".join(out)


def pages(media: bytes) -> Iterator[Page]:
    """The pages of a physical stream; a damaged one has ok false, and search goes on at the next capture pattern."""
    at = media.find(b"OggS")
    while at >= 0:
        if at + _HEAD.size > len(media):
            return
        _, version, flags, granule, serial, sequence, crc, count = _HEAD.unpack_from(media, at)
        lacing = media[at + _HEAD.size : at + _HEAD.size + count]
        start = at + _HEAD.size + count
        end = start + sum(lacing)
        whole = media[at:end]
        ok = version == 0 and len(lacing) == count and end <= len(media) and page_crc(whole[:22] + b"\0\0\0\0" + whole[26:]) == crc
        yield Page(at, flags, granule, serial, sequence, lacing, media[start:end], ok)
        at = media.find(b"OggS", end if ok else at + 4)


Clock = int | Callable[[bytes], int]


def packets(found: list[Page], spacing: dict[int, Clock] | None = None) -> Iterator[Packet]:
    """Packets of every logical stream, in the order in which they end.

    A page that is damaged, or missing by its sequence number, ends the packet that ran over it; what
    continues it later is dropped. Only the last packet that ends on a page has the page's granule
    position; those before it are counted back by what the clock moves in a packet, which is
    spacing[serial], a number or a function of the packet, or have -1 where that isn't known.
    """
    rest: dict[int, bytearray | None] = {}
    expected: dict[int, int] = {}
    numbers: dict[int, int] = {}
    for page in found:
        if not page.ok:
            continue
        partial = rest.get(page.serial)
        if page.sequence != expected.get(page.serial, page.sequence) or not page.flags & CONTINUED:
            partial = None
        lost = partial is None and bool(page.flags & CONTINUED)
        expected[page.serial] = page.sequence + 1
        done, at, start = [], 0, 0
        for lace in page.lacing:
            at += lace
            if lace < 255:
                data = bytes((partial or b"")) + page.body[start:at]
                if not lost:
                    done.append(data)
                partial, lost, start = None, False, at
        rest[page.serial] = (bytearray(partial or b"") + page.body[start:at]) if page.lacing and page.lacing[-1] == 255 and not lost else None
        step, ends = (spacing or {}).get(page.serial), [page.granule] * len(done)
        for i in range(len(done) - 1, 0, -1):
            ends[i - 1] = -1 if step is None or ends[i] < 0 else ends[i] - (step(done[i]) if callable(step) else step)
        for data, end in zip(done, ends):
            yield Packet(page.serial, numbers.setdefault(page.serial, 0), data, end)
            numbers[page.serial] += 1


def heads(found: list[Page]) -> dict[int, tuple[int, int, int, int]]:
    """(rate, samples of a packet, streams, own place among them) of the logical streams whose codec is the one of mux, by serial."""
    own = len(MAGIC)
    return {p.serial: struct.unpack_from("<IHHH", p.body, own) for p in found if p.ok and p.flags & FIRST and p.body[:own] == MAGIC and len(p.body) >= own + 10}


def clocks(known: dict[int, tuple[int, int, int, int]]) -> dict[int, Clock]:
    """What the clock moves from one packet's end to the next one's: its own samples, and a packet of each other stream."""

    def clock(samples: int, streams: int) -> Clock:
        return lambda data: len(data) + (streams - 1) * samples

    return {serial: clock(samples, streams) for serial, (_, samples, streams, _) in known.items()}


def demux(media: bytes) -> dict:
    """What a container holds: payload in clock order, pages, packets, streams, seconds, and how many pages are bad."""
    found = list(pages(media))
    known = heads(found)
    timed, counts = [], dict.fromkeys(known, 0)
    for p in packets([p for p in found if p.serial in known], clocks(known)):
        if p.number == 0:
            continue
        counts[p.serial] += 1
        _, samples, streams, lane = known[p.serial]
        # Only the very last packet is short; the clock at the end of all others is a whole number of packets.
        start = (p.end - len(p.data)) if p.end >= 0 else ((p.number - 1) * streams + lane) * samples
        timed.append((start, p.data))
    timed.sort(key=lambda x: x[0])
    rate = next((h[0] for h in known.values()), RATE)
    end = max((s + len(d) for s, d in timed), default=0)
    return {"payload": b"".join(d for _, d in timed), "pages": len(found), "bad_pages": sum(not p.ok for p in found), "packets": counts, "seconds": end / rate}


def pad(text: bytes, unit: int = SAMPLES) -> bytes:
    """text and bytes 255, up to a positive multiple of unit."""
    return text + b"\xff" * (unit - len(text) % unit if len(text) % unit or not text else 0)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def store_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_bytes, media (the container that holds the padded UTF-8 text).

    A null text is stored as an empty one, which is one packet of padding. Other columns are not read.
    """
    narrow = docs.select(id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array([mux(pad(t)) for t in texts], pa.binary())], names=[id_col, "n_bytes", "media"])

    return narrow.mapInArrow(tidy(run), f"`{id_col}` {dict(narrow.dtypes)[id_col]}, n_bytes long, media binary")


def feature(found: dict) -> str:
    """Features of what was read back, as text: layout, duration, level, loudness, crossings of the middle."""
    x = np.frombuffer(found["payload"], np.uint8).astype(np.float64) - 128
    high = x >= 0
    crossings = int(np.count_nonzero(high[1:] != high[:-1]))
    rms = float(np.sqrt(np.mean(x * x))) if len(x) else 0.0
    lanes = ",".join(str(n) for _, n in sorted(found["packets"].items()))
    return f"pages={found['pages']};bad={found['bad_pages']};packets={lanes};seconds={found['seconds']:.4f};mean={x.mean() if len(x) else 0.0:.4f};rms={rms:.4f};crossings={crossings}"


def read_media(stored: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Digests and features of stored containers. A null or unreadable container has an empty payload."""
    kind = dict(stored.dtypes)[id_col]
    narrow = stored.select(id_col, "n_bytes", media_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = []
            for media in batch.column(2).to_pylist():
                media = media or b""
                found = demux(media)
                payload = found["payload"]
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature(found), found["bad_pages"]))
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "bad_pages"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=[id_col, "n_bytes", *names])

    return narrow.mapInArrow(tidy(run), f"`{id_col}` {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, bad_pages long")


def ogg_packets(stored: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """One row per packet of any Ogg container: id, serial, number, n_bytes, end_granule, data.

    end_granule is the clock at a packet's end, derived from its page's granule position and, for
    packets before the last of a page, from the lengths of those behind it. In a stream of another
    codec, whose clock isn't known, only the last packet of a page has one, and others have -1.
    Damaged pages are left out, and packets that ran over them; null containers have no packets.
    """
    kind = dict(stored.dtypes)[id_col]

    def table(media: bytes) -> Iterator[Packet]:
        found = list(pages(media))
        return packets(found, clocks(heads(found)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 16):
            rows = [(i, p.serial, p.number, len(p.data), p.end, p.data) for i, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if m for p in table(m)]
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = (batch.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[id_col, "serial", "number", "n_bytes", "end_granule", "data"])

    return stored.select(id_col, media_col).mapInArrow(run, f"`{id_col}` {kind}, serial long, number long, n_bytes long, end_granule long, data binary")


def op1_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as an Ogg container, read back and digested."""
    return read_media(store_media(read(spark, sf_dir, "documents")))
