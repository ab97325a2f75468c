"""Text of Office bodies: the parts of a zip container, read as Markdown with a locator for each element."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

#: Bytes that one part, and all parts of a body together, may have when unpacked.
MOST_PART, MOST_ALL = 64 << 20, 256 << 20
#: Columns and rows of a sheet, as the format has them; an area that is merged is filled as far as its sheet's rows go.
MOST_COLUMNS = 16_384
Element = tuple[str, str]  # locator, text


class Refused(ValueError):
    """A container that isn't what it says, or unpacks to more than is read."""


def _tag(node: ElementTree.Element) -> str:
    return node.tag.rpartition("}")[2]


def _attr(node: ElementTree.Element | None, name: str, default: str = "") -> str:
    """An attribute by its local name, whatever its namespace."""
    return default if node is None else next((v for k, v in node.attrib.items() if k.rpartition("}")[2] == name), default)


def _all(node: ElementTree.Element | None, name: str) -> list[ElementTree.Element]:
    return [] if node is None else [x for x in node.iter() if _tag(x) == name]


def _child(node: ElementTree.Element | None, *names: str) -> ElementTree.Element | None:
    for name in names:
        node = None if node is None else next((x for x in node if _tag(x) == name), None)
    return node


class Package:
    """A container's parts and the relationships among them."""

    def __init__(self, body: bytes) -> None:
        try:
            self.archive = zipfile.ZipFile(io.BytesIO(body))
        except zipfile.BadZipFile as error:
            raise Refused("not a zip container") from error
        self.sizes = {i.filename: i.file_size for i in self.archive.infolist()}
        self.left = MOST_ALL

    def xml(self, name: str) -> ElementTree.Element | None:
        """A part's tree, or None where there is no such part."""
        if name not in self.sizes:
            return None
        with self.archive.open(name) as file:
            raw = file.read(min(MOST_PART, self.left) + 1)
        if len(raw) > min(MOST_PART, self.left):
            raise Refused(f"{name} unpacks to too much")
        self.left -= len(raw)
        if b"<!DOCTYPE" in raw[:4096]:
            raise Refused(f"{name} declares a document type")
        try:
            return ElementTree.fromstring(raw)
        except ElementTree.ParseError as error:
            raise Refused(f"{name} isn't XML") from error

    def related(self, name: str) -> dict[str, tuple[str, str]]:
        """What a part refers to: id to (last part of the type, target within the container)."""
        folder, base = posixpath.split(name)
        out = {}
        for r in _all(self.xml(f"{folder}/_rels/{base}.rels"), "Relationship"):
            target = _attr(r, "Target")
            out[_attr(r, "Id")] = (_attr(r, "Type").rpartition("/")[2], target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target)))
        return out


def table(rows: list[list[str]]) -> str:
    """Rows as Markdown, all as wide as the widest."""
    width = max(map(len, rows), default=0)
    lines = ["| " + " | ".join([*(" ".join(c.split()).replace("|", "/") for c in r), *[""] * (width - len(r))]) + " |" for r in rows]
    return "\n".join([*lines[:1], "| " + " | ".join(["---"] * width) + " |", *lines[1:]]) if lines else ""


def _run_text(node: ElementTree.Element) -> str:
    """The text of a paragraph's runs, with tabs and breaks; what was deleted under revision isn't text."""
    return "".join({"t": x.text or "", "tab": "\t", "br": "\n", "cr": "\n", "noBreakHyphen": "-"}.get(_tag(x), "") for x in node.iter())


def _levels(styles: ElementTree.Element | None) -> dict[str, int]:
    """Styles that are headings, and their levels: by outline level or name, or those of the style that they are based on."""
    own, based = {}, {}
    for style in _all(styles, "style"):
        name, outline = _attr(_child(style, "name"), "val"), _attr(_child(style, "pPr", "outlineLvl"), "val")
        named = re.fullmatch(r"(?i)heading\s*([1-9])", name)
        key = _attr(style, "styleId")
        based[key] = _attr(_child(style, "basedOn"), "val")
        level = int(outline) + 1 if outline.isdigit() and int(outline) < 9 else int(named[1]) if named else 1 if name.lower() == "title" else 0
        if level:
            own[key] = level
    out = {}
    for key in based:
        at, met = key, set()
        while at and at not in own and at not in met:
            met.add(at)
            at = based.get(at, "")
        if at in own:
            out[key] = own[at]
    return out


def _grid(rows: list[ElementTree.Element], cells: str = "tc") -> list[list[str]]:
    """A table's cells as text. One that spans columns is followed by empty ones; one that goes on from above repeats what stands there."""
    out: list[list[str]] = []
    for row in rows:
        line: list[str] = []
        for cell in (c for c in row if _tag(c) == cells):
            props = _child(cell, "tcPr")
            merge = _child(props, "vMerge")
            going_on = (merge is not None and _attr(merge, "val", "continue") == "continue") or _attr(cell, "vMerge") in ("1", "true")
            if going_on and out and len(line) < len(out[-1]):
                line.append(out[-1][len(line)])
            else:
                line.append(" ".join(_run_text(p) for p in _all(cell, "p")))
            span = _attr(_child(props, "gridSpan"), "val") or _attr(cell, "gridSpan") or "1"
            if _attr(cell, "hMerge") not in ("1", "true"):
                line += [""] * (min(int(span), MOST_COLUMNS) - 1 if span.isdigit() and cells == "tc" and _child(props, "gridSpan") is not None else 0)
        out.append(line)
    return out


def _document(package: Package) -> Iterator[Element]:
    body = _child(package.xml("word/document.xml"), "body")
    if body is None:
        raise Refused("no word/document.xml")
    levels, n = _levels(package.xml("word/styles.xml")), 0
    todo = [iter(body)]
    while todo:
        node = next(todo[-1], None)
        if node is None:
            todo.pop()
            continue
        kind = _tag(node)
        if kind in ("sdt", "sdtContent", "customXml", "ins", "smartTag"):
            todo.append(iter(node))
        elif kind == "tbl":
            n += 1
            yield f"block:{n}", table(_grid([r for r in node if _tag(r) == "tr"]))
        elif kind == "p" and (text := _run_text(node).strip()):
            n += 1
            props = _child(node, "pPr")
            level = levels.get(_attr(_child(props, "pStyle"), "val"), 0)
            mark = "#" * min(level, 6) + " " if level else "- " if _child(props, "numPr") is not None else ""
            yield f"block:{n}", mark + (" ".join(text.split()) if mark else text)


def _slides(package: Package) -> Iterator[Element]:
    known = package.related("ppt/presentation.xml")
    for n, entry in enumerate(_all(package.xml("ppt/presentation.xml"), "sldId"), 1):
        name = known.get(next((v for k, v in entry.attrib.items() if k.endswith("}id")), ""), ("", ""))[1]
        slide = package.xml(name)
        parts = []
        for shape in (x for x in (slide.iter() if slide is not None else ()) if _tag(x) in ("sp", "graphicFrame")):
            role = _attr(_child(shape, "nvSpPr", "nvPr", "ph"), "type")
            lines = [t for p in _all(_child(shape, "txBody"), "p") if (t := _run_text(p).strip())]
            if role in ("title", "ctrTitle") and lines:
                parts.insert(0, "# " + " ".join(" ".join(lines).split()))
            elif lines:
                parts.append("\n".join(lines))
            parts += [table(_grid([r for r in t if _tag(r) == "tr"])) for t in _all(shape, "tbl")]
        for kind, target in package.related(name).values() if name else ():
            if kind == "notesSlide" and (notes := package.xml(target)) is not None:
                said = [t for s in _all(notes, "sp") if _attr(_child(s, "nvSpPr", "nvPr", "ph"), "type") == "body" for p in _all(s, "p") if (t := _run_text(p).strip())]
                parts += ["Notes: " + "\n".join(said)] if said else []
        if parts:
            yield f"slide:{n}", "\n\n".join(parts)


def _place(reference: str) -> tuple[int, int]:
    """Row and column, from 0, of a cell's name."""
    found = re.fullmatch(r"([A-Z]{1,3})([0-9]{1,7})", reference)
    if not found:
        raise Refused(f"{reference!r} is no cell")
    column = 0
    for letter in found[1]:
        column = 26 * column + ord(letter) - 64
    return int(found[2]) - 1, column - 1


def _sheets(package: Package) -> Iterator[Element]:
    strings = ["".join(t.text or "" for t in _all(s, "t")) for s in _all(package.xml("xl/sharedStrings.xml"), "si")]
    known = package.related("xl/workbook.xml")
    for entry in _all(package.xml("xl/workbook.xml"), "sheet"):
        sheet = package.xml(known.get(next((v for k, v in entry.attrib.items() if k.endswith("}id")), ""), ("", ""))[1])
        found: dict[int, dict[int, str]] = {}
        for at, row in enumerate(_all(sheet, "row")):
            number = int(_attr(row, "r") or at + 1) - 1
            for k, cell in enumerate(_all(row, "c")):
                column = _place(_attr(cell, "r"))[1] if _attr(cell, "r") else k
                kind, value = _attr(cell, "t"), _child(cell, "v")
                text = "" if value is None else value.text or ""
                if kind == "s":
                    text = strings[int(text)] if text.isdigit() and int(text) < len(strings) else ""
                elif kind == "inlineStr":
                    text = "".join(t.text or "" for t in _all(cell, "t"))
                elif kind == "b":
                    text = "TRUE" if text == "1" else "FALSE"
                if text:
                    found.setdefault(number, {})[column] = text
        for area in _all(sheet, "mergeCell"):
            first, _, last = _attr(area, "ref").partition(":")
            (top, left), (bottom, right) = _place(first), _place(last or first)
            value = found.get(top, {}).get(left)
            if value:
                for r in [r for r in found if top <= r <= bottom] + [top]:
                    found.setdefault(r, {}).update(dict.fromkeys(range(left, min(right, MOST_COLUMNS) + 1), value))
        if found:
            # Columns that no row uses are left out, so a lone cell far right makes no wide table.
            used = sorted({c for row in found.values() for c in row})
            yield f"sheet:{_attr(entry, 'name')}", table([[found[r].get(c, "") for c in used] for r in sorted(found)])


_READERS = {".docx": _document, ".pptx": _slides, ".xlsx": _sheets}


def read(body: bytes, path: str) -> list[Element]:
    """(locator, Markdown) of a document's blocks, a presentation's slides or a workbook's sheets, by the path's suffix."""
    reader = _READERS.get(posixpath.splitext(path)[1].lower())
    if reader is None:
        raise Refused("no reader for this type")
    return list(reader(Package(body)))
