"""Windows of documents by tokens: one encoding a document, cuts found in prefix sums, rows whole, headings and prefix within the limit."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docweir.functions import tokens
from docweir.operators.chunkers import _slices, is_separator
from docweir.schemas import SOURCE

# Budgets in tokens, what a window is led by, and the encoder's positions with the two that it adds itself.
BUDGET, OVERLAP, LIMIT, ADDED, PREFIX = 420, 40, 512, 2, "passage: "
#: A text's tokens as the places where they end. A token may begin with the white space before its word, so its end tells what it belongs to.
Encoder = Callable[[list[str]], list[np.ndarray]]


def encoder_of(path: str) -> Encoder:
    """An encoder by a public tokenizer's vocabulary file."""
    return _Ends(tokens.encoder(path))


class _Ends:
    """The ends of texts' tokens, by an encoder that may also know where tokens of parts add up."""

    def __init__(self, known: tokens.Encoder) -> None:
        self.known, self.additive = known, known.additive

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [self.known.ends(t) for t in texts]


class Section(NamedTuple):
    """A heading's path, and where its text lies, the heading's own line included."""

    path: tuple[str, ...]
    start: int
    end: int


class Atoms(NamedTuple):
    """What isn't cut: words, and rows of tables. Where they lie, how good the gap behind each is, and each row's header (start, end), or -1."""

    starts: np.ndarray
    ends: np.ndarray
    gaps: np.ndarray
    heads: np.ndarray


def _lines(text: str) -> list[tuple[int, int]]:
    edges = [0, *(m.end() for m in re.finditer(r"\r\n|\n|\r", text))]
    return [(a, b) for a, b in zip(edges, [*edges[1:], len(text)]) if b > a]


def sections(title: str, text: str) -> list[Section]:
    """Sections under h1 to h4; those without a heading above are under the title. Lines within fences are no headings."""
    path: list[tuple[int, str]] = []
    out, start, fenced = [], 0, False
    for a, b in _lines(text):
        line = text[a:b]
        fenced ^= line.lstrip().startswith("```")
        head = None if fenced else re.match(r"^ {0,3}(#{1,4})\s+(.+?)\s*#*\s*$", line)
        if head:
            out.append(Section(tuple(t for _, t in path) or (title,), start, a))
            path, start = [p for p in path if p[0] < len(head[1])] + [(len(head[1]), head[2])], a
    out.append(Section(tuple(t for _, t in path) or (title,), start, len(text)))
    return [s for s in out if text[s.start : s.end].strip()]


def tokens_between(stops: np.ndarray, a, b):
    """How many tokens end behind a and up to b, by two places in the sorted ends."""
    return np.searchsorted(stops, b, "right") - np.searchsorted(stops, a, "right")


def _gaps(text: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How good a place to cut each gap is (chunkers._break, for all gaps at once), and behind the last unit."""
    if not len(starts):
        return np.empty(0, np.int64)
    low = int(starts[0])
    codes = np.frombuffer(text[low : int(ends[-1])].encode("utf-32-le", "surrogatepass"), np.uint32)
    lines = np.concatenate([[0], np.cumsum(codes == ord("\n"))])
    between = lines[starts[1:] - low] - lines[ends[:-1] - low]
    last = codes[ends[:-1] - low - 1]
    ends_well = np.where(np.isin(last, [ord(c) for c in ".;:!?"]), 2, np.where(last == ord(","), 1, 0))
    return np.append(np.where(between > 1, 4, np.where(between == 1, 3, ends_well)), 5)


def _cells(text: str, a: int, b: int, stops: np.ndarray, room: int) -> Iterator[tuple[int, int]]:
    """The cells of a row that is too long for a window, each with the pipe before it; a cell that is too long as well is its words."""
    for m in re.finditer(r"\|?[^|]*", text[a:b]):
        x, y = a + m.start(), a + m.start() + len(m[0].rstrip())
        if y > x:
            yield from [(x, y)] if tokens_between(stops, x, y) <= room else ((x + w.start(), x + w.end()) for w in re.finditer(r"\S+", text[x:y]))


_WORD = re.compile(r"\S+")


def _columns(spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    both = np.array(spans, np.int64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def atoms(text: str, section: Section, stops: np.ndarray, room: int) -> Atoms:
    """A section's words; a table's rows are whole where they fit with their header, else their cells."""
    spans: list[tuple[int, int]] = []
    heads: list[tuple[int, int]] = []
    if "|" not in text[section.start : section.end]:
        spans = [(m.start(), m.end()) for m in _WORD.finditer(text, section.start, section.end)]
        starts, ends = _columns(spans)
        return Atoms(starts, ends, _gaps(text, starts, ends), np.full((len(spans), 2), -1, np.int64))
    rows = [(section.start + a, section.start + b) for a, b in _lines(text[section.start : section.end])]
    at = 0
    while at < len(rows):
        last = at
        while last < len(rows) and text.count("|", *rows[last]) >= 2:
            last += 1
        if last - at < 2:
            last = at + 1
            spans += [(m.start(), m.end()) for m in _WORD.finditer(text, *rows[at])]
        else:
            top = at + (2 if is_separator(text[slice(*rows[at + 1])]) else 1)
            head = (rows[at][0], rows[top - 1][1])
            for i in range(at, last):
                heads += [(-1, -1)] * (len(spans) - len(heads))
                a, b = rows[i][0], rows[i][0] + len(text[slice(*rows[i])].rstrip())
                own = (-1, -1) if i < top else head
                fits = tokens_between(stops, a, b) + (tokens_between(stops, *head) if i >= top else 0) <= room
                spans += [(a, b)] if fits else _cells(text, a, b, stops, room // 2)
                heads += [own] * (len(spans) - len(heads))
        at = last
    heads += [(-1, -1)] * (len(spans) - len(heads))
    starts, ends = _columns(spans)
    return Atoms(starts, ends, _gaps(text, starts, ends), np.array(heads, np.int64).reshape(-1, 2))


def cut(text: str, units: Atoms, stops: np.ndarray, budget: int, overlap: int) -> Iterator[tuple[int, int, int, int]]:
    """Windows (first atom, last atom, start, end): as long as the budget allows, ended at the best gap in their second half.

    A window stops with up to overlap tokens of the one before, but not within a table, where its
    header is repeated instead. An atom over the budget alone is cut between its tokens.
    """
    first, last = (np.searchsorted(stops, x, "right") for x in (units.starts, units.ends))
    at, n = 0, len(units.starts)
    while at < n:
        head = units.heads[at]
        room = budget - (int(tokens_between(stops, *head)) if head[0] >= 0 else 0)
        end = int(np.searchsorted(last, first[at] + max(room, 1), "right")) - 1
        if end < at:
            a, b = int(units.starts[at]), int(units.ends[at])
            cuts = [a, *stops[first[at] + budget - 1 : last[at] - 1 : budget].tolist(), b]
            yield from ((at, at, x, y) for x, y in zip(cuts, cuts[1:]))
            at += 1
            continue
        if end < n - 1:
            low = min(end, max(at, int(np.searchsorted(last, first[at] + room // 2))))
            gaps = units.gaps[low : end + 1]
            end = low + len(gaps) - 1 - int(np.argmax(gaps[::-1]))
        yield at, end, int(units.starts[at]), int(units.ends[end])
        back = end + 1
        if end < n - 1 and units.heads[end + 1][0] < 0:
            back = max(at + 1, int(np.searchsorted(first, last[end] - overlap)))
            while back <= end and units.heads[back][0] >= 0:
                back += 1
        at = min(back, end + 1)


class Window(NamedTuple):
    """A window: its section's path, where it lies in the text, its own tokens, all tokens with what leads it, and its content with a repeated header."""

    path: tuple[str, ...]
    start: int
    end: int
    tokens: int
    total: int
    content: str


def led(path: tuple[str, ...], content: str) -> str:
    """What is embedded: prefix, heading path, content."""
    return f"{PREFIX}{' > '.join(path)}\n{content}"


def _counted(text: str, units: Atoms, stops: np.ndarray, encode: Encoder, path: tuple[str, ...], batch: list[tuple[int, int, int, int]], shown: list[str], plain: bool) -> tuple[list[int], list[int]]:
    """Tokens of each window's content, and of all that is embedded.

    Where tokens add up (plain), a window of whole words has those of its first word, and of the text
    behind that word as it was encoded; what leads it ends in a line end, and has tokens of its own. Others are encoded.
    """
    words = [plain and s[:1].strip() != "" and units.heads[i][0] < 0 and a == units.starts[i] and b == units.ends[j] and _whole_words(text, a, b) for (i, j, a, b), s in zip(batch, shown)]
    firsts = [_WORD.match(text, a).end() for (_, _, a, _), known in zip(batch, words) if known]
    heads = iter(encode([text[a:e] for (_, _, a, _), e in zip([w for w, known in zip(batch, words) if known], firsts)]))
    rest = iter(encode([s for s, known in zip(shown, words) if not known]))
    ends = iter(firsts)
    own = [len(next(heads)) + int(tokens_between(stops, next(ends), b)) if known else len(next(rest)) for (_, _, _, b), known in zip(batch, words)]
    if plain and all(s[:1].strip() for s in shown):
        lead = len(encode([led(path, "x")])[0]) - 1
        return own, [lead + n + ADDED for n in own]
    return own, [len(x) + ADDED for x in encode([led(path, s) for s in shown])]


def _whole_words(text: str, a: int, b: int) -> bool:
    """Whether a part begins and ends at white space, or where the text does."""
    return (a == 0 or text[a - 1].isspace()) and (b == len(text) or text[b].isspace())


def windows_of(title: str, text: str, encode: Encoder, budget: int = BUDGET, overlap: int = OVERLAP, limit: int = LIMIT) -> list[Window]:
    """The windows of a text. Each, with prefix and heading path, has at most limit tokens, the encoder's own two counted.

    A text is encoded once, to find the cuts; tokens at a cut can join otherwise than they did within
    the text, so windows are encoded once more as they will be embedded, and one that is over is
    halved until it fits.
    """
    stops = encode([text])[0]
    parts = sections(title, text)
    additive = getattr(encode, "additive", None)
    plain = additive is not None and additive(text) and additive(title)
    leads = dict.fromkeys(s.path for s in parts)
    size = dict(zip(leads, (len(x) for x in encode([led(p, "") for p in leads]))))
    out: list[Window] = []
    for section in parts:
        room = min(budget, limit - ADDED - size[section.path])
        path = section.path
        if room < limit // 4:  # a heading path that leaves little room isn't repeated whole
            path, room = (section.path[-1][:64],), min(budget, limit // 2)
        units = atoms(text, section, stops, room)
        todo = list(cut(text, units, stops, room, min(overlap, room // 4)))[::-1]
        while todo:
            batch, todo = todo[::-1], []
            shown = []
            for i, _, a, b in batch:
                head = units.heads[i] if len(units.heads) else (-1, -1)
                shown.append((text[head[0] : head[1]].rstrip() + "\n" if head[0] >= 0 else "") + text[a:b])
            own, sizes = _counted(text, units, stops, encode, path, batch, shown, plain)
            again: list[tuple[int, int, int, int]] = []
            for (i, j, a, b), content, total, tokens in zip(batch, shown, sizes, own):
                if total <= limit or b - a < 2:
                    out.append(Window(path, a, b, tokens, total, content))
                elif i < j:
                    middle = (i + j) // 2
                    again += [(i, middle, a, int(units.ends[middle])), (middle + 1, j, int(units.starts[middle + 1]), b)]
                else:
                    again += [(i, i, a, (a + b) // 2), (i, i, (a + b) // 2, b)]
            todo = again[::-1]
    return sorted(out, key=lambda w: (w.start, w.end))


_KINDS = (pa.int32(), pa.list_(pa.string()), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string())
_NAMES = ("ordinal", "path", "start", "end", "tokens", "total", "content")


def window_documents(docs: DataFrame, path: str, budget: int = BUDGET, overlap: int = OVERLAP, limit: int = LIMIT) -> DataFrame:
    """Windows of docs (key, title, content) by the tokenizer file at path, which every worker can open.

    One row per window: the key (project_id, provider, source_id, as far as docs have them), ordinal,
    path, start, end (characters), tokens, total, content. Null and blank texts have none.
    """
    keys = [c for c in SOURCE if c in docs.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_of(path)
        for whole in batches:
            for batch in _slices(whole):
                rows: list[tuple] = []
                for i, (title, text) in enumerate(zip(*(c.to_pylist() for c in batch.columns[len(keys) :]))):
                    rows += [(i, n, list(w.path), *w[1:]) for n, w in enumerate(windows_of(title or "", text or "", encode, budget, overlap, limit))]
                which, *columns = zip(*rows) if rows else [()] * 8
                owners = [c.take(pa.array(which, pa.int64())) for c in batch.columns[: len(keys)]]
                yield pa.RecordBatch.from_arrays([*owners, *(pa.array(c, k) for c, k in zip(columns, _KINDS))], names=[*keys, *_NAMES])

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "ordinal int, path array<string>, start long, end long, tokens int, total int, content string"])
    return docs.select(*keys, "title", "content").mapInArrow(run, schema)
