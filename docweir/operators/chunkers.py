"""Chunkers for shapes that need a sequential reader: HTML, code, prose windows, wide tables.

They run as Arrow batches, a document at a time. Budgets are in words; what no chunk may exceed is a
limit in tokens, by any counter. What holds for every chunk: no table row is split unless it alone is
over the limit, a table's header is repeated, a heading ends no chunk that has other text, and no
word is lost.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from itertools import chain, groupby

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from docweir.functions.text import CODE_WORD, FEW_CHARACTERS, FEW_WORDS, FRAMING
from docweir.schemas import SOURCE

# Budgets in tokens.
PROSE, CODE, TABLE, OVERLAP, LIMIT, INDEX = 420, 350, 300, 40, 512, 160
Element = tuple[str, list[str], str, str]  # text, heading path, locator, kind


def words(text: str) -> int:
    return len(text.split())


def _break(text: str, end: int, start: int) -> int:
    """How good a place to cut the gap between two words is: blank line, line end, sentence end, comma, or none."""
    lines = text.count("\n", end, start)
    return 4 if lines > 1 else 3 if lines else 2 if text[end - 1] in ".;:!?" else 1 if text[end - 1] == "," else 0


_HEADING_LINE = re.compile(r"(?m)^ {0,3}#{1,6}[ \t].*$")


def prose_windows(text: str, budget: int = PROSE, overlap: int = OVERLAP) -> list[str]:
    """Windows of at most budget words that end, where they can, at a paragraph, line or sentence end, and behind no heading.

    Each begins with up to overlap words (a quarter of the budget at most) of the one before.
    """
    marks = [m.span() for m in re.finditer(r"\S+", text)]
    if len(marks) <= budget:
        return [text.strip()] if marks else []
    starts = [a for a, _ in marks]
    heads = [(bisect_right(starts, m.start() - 1), bisect_right(starts, m.end() - 1)) for m in _HEADING_LINE.finditer(text)] if "#" in text else []
    under = {k: first for first, last in heads for k in range(first + 1, last + 1)}  # cuts in or just behind a heading, and where it begins
    overlap = min(overlap, budget // 4)
    out, at = [], 0
    while True:
        end = min(at + budget, len(marks))
        if end < len(marks):
            places = range(at + max(overlap + 1, budget // 2) + 1, end + 1)
            good = 0
            for k in reversed(places):  # the last of the best
                if k not in under and (value := _break(text, marks[k - 1][1], marks[k][0])) > good:
                    good, end = value, k
                    if good == 4:
                        break
            first = end
            while first in under:
                first = under[first]
            end = first if first > at + overlap else end
        out.append(text[marks[at][0] : marks[end - 1][1]])
        if end == len(marks):
            return out
        at = max(at + 1, end - overlap)


class Indivisible(ValueError):
    """A word alone has more tokens than a chunk may have."""


def fitting(text: str, limit: int = LIMIT, count: Callable[[str], int] = words) -> list[str]:
    """text, or as few runs of its words as it takes for each to have at most limit tokens by count.

    The longest run that fits is found by halving, so a counter that isn't quite additive does no harm.
    """
    if count(text) <= limit:
        return [text]
    marks = [m.span() for m in re.finditer(r"\S+", text)]
    out, at = [], 0
    while at < len(marks):
        low, high = at, len(marks) + 1  # the run up to low fits, the one up to high doesn't
        while high - low > 1:
            middle = (low + high) // 2
            if count(text[marks[at][0] : marks[middle - 1][1]]) <= limit:
                low = middle
            else:
                high = middle
        if low == at:
            raise Indivisible(f"a word of {marks[at][1] - marks[at][0]} characters is over the limit of {limit} tokens")
        out.append(text[marks[at][0] : marks[low - 1][1]])
        at = low
    return out


def packed(costs: list[int], budget: int) -> list[tuple[int, int]]:
    """Consecutive runs (start, end) of at most budget; an item over it is a run of its own."""
    cuts, size = [0], 0
    for i, cost in enumerate(costs):
        if i > cuts[-1] and size + cost > budget:
            cuts.append(i)
            size = 0
        size += cost
    return [(a, b) for a, b in zip(cuts, [*cuts[1:], len(costs)]) if b > a]


def cells(row: str) -> list[str]:
    """What stands between the pipes of a row."""
    return re.split(r"\s*\|\s*", re.sub(r"^\s*\|*\s*|\s*\|*\s*$", "", row))


def is_separator(row: str) -> bool:
    """A row of dashes, colons and pipes alone."""
    return "-" in row and re.fullmatch(r"[\s|:-]+", row) is not None


def wide_row(header: list[str], row: str, budget: int) -> list[str]:
    """A row that is over the budget alone, as groups of columns, each under its own headers."""
    values = cells(row)
    labels = cells(header[0]) if header else []
    labels += [f"column {n}" for n in range(len(labels) + 1, len(values) + 1)]
    values += [""] * (len(labels) - len(values))  # headers without a value stay
    runs = packed([words(x) + words(y) + 1 for x, y in zip(labels, values)], budget)
    return ["\n".join(" | ".join(part[a:b]) for part in (labels, values)) for a, b in runs]


def table_windows(rows: list[str], budget: int = TABLE, limit: int = LIMIT) -> list[str]:
    """Whole rows under their header, at most budget words a window; a row over the limit is split by columns."""
    top = 2 if len(rows) > 1 and is_separator(rows[1]) else 1
    header, body = rows[:top], rows[top:]
    if not body:
        return ["\n".join(header)] if header else []
    own = words("\n".join(header))
    out: list[str] = []
    for over, group in groupby(body, key=lambda r: own + words(r) > limit and len(cells(r)) > 1):
        part = list(group)
        if over:
            out += [w for r in part for w in wide_row(header, r, budget)]
        else:
            out += ["\n".join([*header, *part[a:b]]) for a, b in packed([words(r) for r in part], budget - own)]
    return out


def line_windows(text: str, budget: int) -> list[str]:
    """Whole lines in turn; one over the budget stands alone."""
    rows = text.splitlines()
    windows = ("\n".join(rows[a:b]).strip("\n") for a, b in packed([words(r) for r in rows], budget))
    return [w for w in windows if w.strip()]


def blocks(text: str) -> list[tuple[bool, list[str]]]:
    """Runs of table rows (two pipes or more, two rows or more) and of other lines."""
    runs = [list(g) for _, g in groupby(text.splitlines(), key=lambda r: r.count("|") >= 2)]
    out: list[tuple[bool, list[str]]] = []
    for table, group in groupby(runs, key=lambda r: len(r) > 1 and r[0].count("|") >= 2):
        out += [(True, r) for r in group] if table else [(False, list(chain.from_iterable(group)))]
    return out


def section_windows(text: str, budget: int = PROSE, overlap: int = OVERLAP) -> list[str]:
    """Tables by rows, all else as prose."""
    return [w for table, rows in blocks(text) for w in (table_windows(rows, min(budget, TABLE)) if table else prose_windows("\n".join(rows), budget, overlap))]


def markdown(title: str, text: str, budget: int = PROSE, overlap: int = OVERLAP) -> Iterator[Element]:
    """Sections under h1 to h4, headings kept with their text, then windows."""
    path: list[tuple[int, str]] = []
    body: list[str] = []

    def flush() -> Iterator[Element]:
        for k, window in enumerate(section_windows("\n".join(body), budget, overlap)):
            yield window, [t for _, t in path] or [title], f"section:{k}", "section"

    fenced = False
    for line in text.splitlines():
        fenced ^= line.lstrip().startswith("```")
        head = None if fenced else re.match(r"^ {0,3}(#{1,4})\s+(.+?)\s*#*$", line)
        if head:
            yield from flush()
            body = []
            path = [p for p in path if p[0] < len(head[1])] + [(len(head[1]), head[2])]
        body.append(line)
    yield from flush()


_DECLARATION = re.compile(r"^\s*(?:@\w+\s*)*(?:export\s+|async\s+|public\s+|private\s+|protected\s+|internal\s+|static\s+|abstract\s+|open\s+|override\s+)*(?:class|interface|object|def|fun|func|function|enum|struct)\s+([A-Za-z_]\w*)")


def _says_little(part: str) -> bool:
    """What text.low_information_code says of a column."""
    lines = [x for x in map(str.strip, part.splitlines()) if x]
    return all(x.startswith(FRAMING) for x in lines) or len(part) < FEW_CHARACTERS and len(re.findall(CODE_WORD, part)) <= FEW_WORDS


def code(title: str, text: str, budget: int = CODE) -> Iterator[Element]:
    """Declarations with what follows them; pieces that say nothing alone stand before the next one, or behind the last, within the budget."""
    parts: list[list[str]] = [[]]
    for line in text.splitlines():
        if _DECLARATION.match(line) and len(line) - len(line.lstrip()) <= 4 and any(x.strip() for x in parts[-1]):
            parts.append([])
        parts[-1].append(line)
    pieces = [p for p in ("\n".join(p).strip("\n") for p in parts) if p.strip()]
    runs = [list(g) for _, g in groupby(pieces, key=lambda p: _says_little(p.strip()))]
    merged: list[str] = []
    waiting: list[str] = []
    for run in runs:
        if _says_little(run[0].strip()):
            waiting = run
            continue
        joined = "\n".join([*waiting, run[0]])
        merged += [joined, *run[1:]] if words(joined) <= budget else [*waiting, *run]
        waiting = []
    if waiting:
        tail = "\n".join(waiting)
        if merged and words(merged[-1]) + words(tail) <= budget:
            merged[-1] += "\n" + tail
        else:
            merged.append(tail)
    for part in merged:
        for k, window in enumerate(line_windows(part, budget)):
            names = [m[1] for line in window.splitlines() if (m := _DECLARATION.match(line))][:2]
            yield window, [title, *names], f"lines:{k}", "code"


class TooLong(ValueError):
    """A run of steps that belongs together is longer than a chunk may be."""


def workflow(title: str, text: str) -> Iterator[Element]:
    """What stands before the flows, then one chunk for each.

    One over the budget is cut before nested headings, never inside a run of steps; each part is led
    by the flow's heading.
    """
    heads = list(re.finditer(r"(?im)^(#{1,4})\s+.*?\[([A-Z][A-Z0-9]*-\d+)\].*$", text))
    if heads and text[: heads[0].start()].strip():
        for window in section_windows(text[: heads[0].start()].strip(), PROSE, 0):
            yield window, [title], "workflow-support", "workflow-support"
    for head, after in zip(heads, [*heads[1:], None]):
        flow, lead = head[2].upper(), head[0].strip()
        body = text[head.end() : after.start() if after else len(text)].strip()
        whole = f"{lead}\n{body}".strip()
        if words(whole) <= PROSE:
            yield whole, [lead.lstrip("# ")], flow, "workflow"
            continue
        deeper = min(len(head[1]) + 1, 6)
        part = 0
        for piece in filter(str.strip, re.split(rf"(?m)^(?=#{{{deeper},6}}\s)", body)):
            nested = re.match(r"#{1,6}\s+(.+)", piece)
            path = [lead.lstrip("# "), *([nested[1].strip()] if nested else [])]
            room = max(64, PROSE - words(lead))
            fits = words(lead) + words(piece) <= PROSE
            if not fits and re.search(r"(?m)^\s*\d+[.)]\s", piece):
                raise TooLong(f"the steps of {flow} are over the limit")
            for window in [piece.strip()] if fits else section_windows(piece, room, 0):
                part += 1
                yield f"{lead}\n{window}", path, f"{flow}:part:{part}", "workflow"


def contract(title: str, text: str) -> Iterator[Element]:
    """Each entity under its heading; a large one as groups of rows that repeat heading and header."""
    heads = list(re.finditer(r"(?im)^#{2,4}\s+(?:[\d.]+\s+)?`?([A-Z][A-Z0-9_]+)`?\s+(?:[-—]\s+id\s+\d+\s*,\s*version\s+[^\s#]+\s*$|\(id\s+\d+\))", text))
    if heads and text[: heads[0].start()].strip():
        for window in section_windows(text[: heads[0].start()].strip(), PROSE, 0):
            yield window, [title], "contract-support", "entity-contract-support"
    for head, after in zip(heads, [*heads[1:], None]):
        body = text[head.end() : after.start() if after else len(text)].strip()
        whole = f"{head[0].strip()}\n{body}".strip()
        windows = [whole] if words(whole) <= PROSE else [f"{head[0].strip()}\n{w}" for w in section_windows(body, PROSE - words(head[0]), 0)]
        for window in windows:
            yield window, [head[1]], head[1], "entity-contract"


def registry(title: str, text: str) -> Iterator[Element]:
    """Prose, then groups of rows with their keys, then one chunk that lists the keys of each table."""
    runs = blocks(text)
    for table, rows in runs:
        if not table:
            for window in prose_windows("\n".join(rows)):
                yield window, [title], "registry:prose", "registry-prose"
    caption, n = "", 0
    for table, rows in runs:
        if not table:
            caption = next((r.lstrip("# ").strip() for r in reversed(rows) if re.match(r"^#{1,6}\s", r)), caption)
            continue
        n += 1
        name = caption or f"table-{n}"
        for k, window in enumerate(table_windows(rows)):
            yield window, [title, name], f"rows:{n}:{k}", "registry-table"
        top = 2 if len(rows) > 1 and is_separator(rows[1]) else 1
        keys = list(dict.fromkeys(c[0] for r in rows[top:] if (c := cells(r)) and c[0]))
        for window in prose_windows(f"{name} keys: " + ", ".join(keys), PROSE, 0):
            yield window, [title, name], f"keys:{n}", "registry-keys"


def glossary(title: str, text: str) -> Iterator[Element]:
    """A chunk a term: headings, or else `term: definition` lines. What belongs to no term is in support windows."""
    heads = list(re.finditer(r"(?m)^#{2,4}\s+([^\n]+)$", text))
    if heads:
        lead = text[: heads[0].start()].strip()
        for window in section_windows(lead, PROSE, 0) if lead else ():
            yield window, [title], "glossary-support", "glossary-support"
        for head, after in zip(heads, [*heads[1:], None]):
            section = text[head.start() : after.start() if after else len(text)].strip()
            for window in section_windows(section, PROSE, 0):
                yield window, [head[1].strip()], "term", "glossary"
        return
    entries = [(line, re.match(r"^\s*([^:]{2,80}):\s+(.+)$", line)) for line in text.splitlines()]
    if any(term for _, term in entries):
        rest = "\n".join(line for line, term in entries if not term).strip()
        for window in section_windows(rest, PROSE, 0) if rest else ():
            yield window, [title], "glossary-support", "glossary-support"
        for line, term in entries:
            if term:
                yield line.strip(), [term[1].strip()], "term", "glossary"


class _Table:
    """An open table: its rows, the open cell's text, and the place among the blocks where it belongs."""

    def __init__(self) -> None:
        self.rows: list[list[str]] = []
        self.cell: list[str] | None = None
        self.place: int | None = None


class _Reader(HTMLParser):
    """Blocks of an HTML text: headings, tables as pipe rows, lists, preformatted text, paragraphs.

    Optional end tags may be missing. A table inside another is a block after it; text of a table
    outside of its cells is a paragraph.
    """

    _BLOCKS = {"p", "div", "section", "article", "blockquote", "br", "header", "footer", "main", "body", "html", "nav", "aside"}
    _PARTS = {"tr", "td", "th", "caption", "thead", "tbody", "tfoot"}
    _SILENT = {"script", "style", "template", "noscript"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[tuple[str, str]] = []
        self.text: list[str] = []
        self.tables: list[_Table] = []  # open ones, the innermost last
        self.lists: list[list] = []
        self.pre = self.silent = 0

    def flush(self, kind: str = "p") -> None:
        raw = "".join(self.text)
        value = raw.strip("\n") if kind == "pre" else " ".join(raw.split())
        if value:
            self.out.append((kind, value))
        self.text = []

    def end_cell(self) -> None:
        """Stores the innermost table's open cell, if any."""
        table = self.tables[-1]
        if table.cell is not None:
            table.rows[-1].append(" ".join("".join(table.cell).split()).replace("|", "/"))
            table.cell = None

    def end_table(self) -> None:
        self.end_cell()
        self.flush()
        table = self.tables.pop()
        rows = [r for r in table.rows if any(r)]
        if rows:
            lines = ["| " + " | ".join(r) + " |" for r in rows]
            lines.insert(1, "| " + " | ".join("---" for _ in rows[0]) + " |")
            self.out.insert(table.place, ("table", "\n".join(lines)))

    def finish(self) -> None:
        """Emits what is open at the end of the text."""
        self.close()
        while self.tables:
            self.end_table()
        self.flush()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self._SILENT:
            self.silent += 1
        elif tag == "table":
            self.flush()
            self.tables.append(_Table())
        elif self.tables and tag in self._PARTS:
            self.end_cell()
            self.flush()
            table = self.tables[-1]
            if tag == "tr":
                table.rows.append([])
            elif tag in ("td", "th"):
                table.rows = table.rows or [[]]
                table.cell = []
                table.place = len(self.out) if table.place is None else table.place
        elif self.tables and self.tables[-1].cell is not None:
            pass
        elif re.fullmatch("h[1-6]", tag) or tag in self._BLOCKS:
            self.flush()
        elif tag in ("ul", "ol"):
            self.flush()
            self.lists.append([tag, 0])
        elif tag == "li":
            self.flush()
            if self.lists:
                self.lists[-1][1] += 1
        elif tag == "pre":
            self.flush()
            self.pre += 1
        elif tag == "code" and not self.pre:
            self.text.append("`")

    def handle_endtag(self, tag: str) -> None:
        if tag in self._SILENT:
            self.silent = max(0, self.silent - 1)
        elif self.tables and tag == "table":
            self.end_table()
        elif self.tables and tag in self._PARTS:
            self.end_cell()
            self.flush()
        elif self.tables and self.tables[-1].cell is not None:
            pass
        elif re.fullmatch("h[1-6]", tag):
            self.flush(tag)
        elif tag in ("ul", "ol"):
            self.flush()
            if self.lists:
                self.lists.pop()
        elif tag == "li":
            mark = f"{self.lists[-1][1]}. " if self.lists and self.lists[-1][0] == "ol" else "- "
            value = " ".join("".join(self.text).split())
            self.text = []
            if value:
                self.out.append(("li", mark + value))
        elif tag == "pre":
            self.flush("pre")
            self.pre = max(0, self.pre - 1)
        elif tag == "code" and not self.pre:
            self.text.append("`")
        elif tag in self._BLOCKS:
            self.flush()

    def handle_data(self, data: str) -> None:
        if self.silent:
            return
        if self.tables and self.tables[-1].cell is not None:
            self.tables[-1].cell.append(data + " ")
        else:
            self.text.append(data)


def html_markdown(text: str) -> str:
    """An HTML text as Markdown-like blocks: what the section reader understands."""
    reader = _Reader()
    reader.feed(text)
    reader.finish()
    parts: list[str] = []
    last = ""
    for kind, value in reader.out:
        line = f"{'#' * int(kind[1])} {value}" if re.fullmatch("h[1-6]", kind) else f"```\n{value}\n```" if kind == "pre" else value
        parts.append(("\n" if kind == last == "li" else "\n\n") + line if parts else line)
        last = kind
    return "".join(parts)


def route(title: str, kind: str, category: str, text: str) -> Iterator[Element]:
    """The chunks of a document, by format and then, for prose formats, by category; a profile that finds nothing falls through."""
    if kind == "html":
        text, kind = html_markdown(text), "markdown"
    if kind == "markdown":
        profile: dict[str, Callable[[str, str], Iterator[Element]]] = {"entity-contract": contract, "registry-table": registry, "workflow": workflow, "glossary": glossary}
        if category in profile and (found := list(profile[category](title, text))):
            return iter(found)
    if category == "index" and kind in ("markdown", "prose"):
        return markdown(title, text, INDEX, 0)
    if kind == "csv":
        return ((w, [title], f"rows:{k}", "table") for k, w in enumerate(table_windows([r for r in text.splitlines() if r.strip()])))
    if kind in ("json", "log"):
        return ((w, [title], f"lines:{k}", kind) for k, w in enumerate(line_windows(text, PROSE)))
    if kind == "code":
        return code(title, text)
    return markdown(title, text)


_NAMES = ["ordinal", "path", "locator", "profile", "tokens", "content", "failure"]
_SCHEMA = "ordinal int, path array<string>, locator string, profile string, tokens long, content string, failure string"
_KINDS = (pa.int32(), pa.list_(pa.string()), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
#: Rows and characters of documents that are cut before their chunks are handed on.
_ROWS, _CHARACTERS = 256, 8 << 20


def _emit(keys: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
    """rows are the number of a document among keys, and what is told of its chunk."""
    which, *columns = list(zip(*rows)) if rows else [[]] * (len(_NAMES) + 1)
    owners = [c.take(pa.array(which, pa.int64())) for c in keys.columns]
    return pa.RecordBatch.from_arrays([*owners, *(pa.array(c, k) for c, k in zip(columns, _KINDS))], names=[*keys.schema.names, *_NAMES])


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of bounded rows and text; a longer text is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_pylist()
    at = size = 0
    for i, n in enumerate(sizes):
        if i > at and (size + n > _CHARACTERS or i - at == _ROWS):
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += n
    if batch.num_rows:
        yield batch.slice(at)


def chunks_of(title: str, kind: str, category: str, text: str, limit: int = LIMIT, count: Callable[[str], int] = words) -> list[tuple[str, list[str], str, str, int]]:
    """The chunks of a document and their tokens by count, none of more than limit. A blank one is an error, as it would pass for indexed."""
    if not text.strip():
        raise ValueError("EMPTY_BODY")
    out = []
    for body, path, locator, profile in route(title, kind, category, text):
        tokens = count(body)
        if tokens > limit:
            out += [(window, path, locator, profile, count(window)) for window in fitting(body, limit, count)]
        elif body.strip():
            out.append((body, path, locator, profile, tokens))
    return out


def chunk_documents(docs: DataFrame, limit: int = LIMIT, counter: Callable[[], Callable[[str], int]] | None = None) -> DataFrame:
    """Chunks of docs (source_id, title, kind, category, content): their key, ordinal, path, locator, profile, tokens, content, failure.

    The key is project_id, provider and source_id, as far as docs have them: an id is a source's only
    within its provider. counter makes a function that counts a text's tokens, in each worker;
    without it words are counted. A document that can't be cut (blank, steps or a word over the limit)
    is one row with its failure, and fails alone.
    """
    keys = [c for c in SOURCE if c in docs.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter() if counter else words
        for whole in batches:
            for batch in _slices(whole):
                rows: list[tuple] = []
                for i, (title, kind, category, text) in enumerate(zip(*(c.to_pylist() for c in batch.columns[len(keys) :]))):
                    try:
                        found = chunks_of(title or "", kind or "prose", category or "narrative", text or "", limit, count)
                    except ValueError as error:
                        rows.append((i, 0, None, None, None, None, None, str(error) if str(error) == "EMPTY_BODY" else f"{type(error).__name__}: {error}"[:200]))
                        continue
                    rows += [(i, n, path, locator, profile, tokens, body, None) for n, (body, path, locator, profile, tokens) in enumerate(found)]
                yield _emit(batch.select(keys), rows)

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), _SCHEMA])
    return docs.select(*keys, "title", "kind", "category", "content").mapInArrow(run, schema)


def html_chunks(docs: DataFrame) -> DataFrame:
    """Chunks of HTML documents (source_id, content)."""
    from pyspark.sql import functions as F

    keys = [c for c in SOURCE if c in docs.columns]
    return chunk_documents(docs.select(*keys, F.lit("").alias("title"), F.lit("html").alias("kind"), F.lit("narrative").alias("category"), "content"))
