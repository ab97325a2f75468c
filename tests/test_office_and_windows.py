from __future__ import annotations

import base64
import io
import zipfile
import zlib

import numpy as np
import pytest

from docweir.functions import ooxml
from docweir.operators import references, token_windows

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def packed(**parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, value in parts.items():
            archive.writestr(name, value)
    return out.getvalue()


def rels(**targets):
    return "<Relationships xmlns='http://schemas.openxmlformats.org/package/2006/relationships'>" + "".join(f"<Relationship Id='{k}' Type='x/{t}' Target='{v}'/>" for k, (t, v) in targets.items()) + "</Relationships>"


def escaped(text):
    return text.replace("&", "&amp;").replace("<", "&lt;")


def docx(blocks, styles=""):
    return packed(**{"word/document.xml": f"<w:document {W}><w:body>{blocks}</w:body></w:document>", "word/styles.xml": f"<w:styles {W}>{styles}</w:styles>"})


def par(text, style="", extra=""):
    return f"<w:p><w:pPr><w:pStyle w:val='{style}'/>{extra}</w:pPr><w:r><w:t xml:space='preserve'>{escaped(text)}</w:t></w:r></w:p>"


def test_documents_with_headings_lists_and_merged_cells():
    styles = "<w:style w:styleId='H1'><w:name w:val='heading 1'/></w:style><w:style w:styleId='Mine'><w:name w:val='mine'/><w:basedOn w:val='H1'/></w:style><w:style w:styleId='Out'><w:name w:val='x'/><w:pPr><w:outlineLvl w:val='2'/></w:pPr></w:style><w:style w:styleId='Loop'><w:basedOn w:val='Loop'/></w:style>"
    cell = lambda t, props="": f"<w:tc><w:tcPr>{props}</w:tcPr>{par(t)}</w:tc>"
    rows = f"<w:tr>{cell('a')}{cell('b')}{cell('c')}</w:tr><w:tr>{cell('down', '<w:vMerge w:val=\"restart\"/>')}{cell('wide', '<w:gridSpan w:val=\"2\"/>')}</w:tr><w:tr>{cell('', '<w:vMerge/>')}{cell('1|2')}{cell('3')}</w:tr>"
    body = docx(par("Title & more", "H1") + par("Based", "Mine") + par("Third", "Out") + par("plain  text", "Loop") + par("item", "", "<w:numPr/>") + par("  ") + f"<w:tbl>{rows}</w:tbl><w:sdt><w:sdtContent>{par('inside')}</w:sdtContent></w:sdt><w:p><w:r><w:t>a</w:t><w:tab/><w:t>b</w:t><w:br/><w:t>c</w:t></w:r><w:del><w:r><w:delText>gone</w:delText></w:r></w:del></w:p>", styles)
    found = ooxml.read(body, "x.docx")
    assert [t for _, t in found] == ["# Title & more", "# Based", "### Third", "plain  text", "- item", "| a | b | c |\n| --- | --- | --- |\n| down | wide |  |\n| down | 1/2 | 3 |", "inside", "a\tb\nc"]
    assert [loc for loc, _ in found] == [f"block:{i}" for i in range(1, 9)]


def test_slides_come_in_the_order_of_the_presentation():
    a, p = 'xmlns:a="urn:a"', 'xmlns:p="urn:p"'
    sp = lambda text, kind="": f"<p:sp><p:nvSpPr><p:nvPr><p:ph type='{kind}'/></p:nvPr></p:nvSpPr><p:txBody>{''.join(f'<a:p><a:r><a:t>{t}</a:t></a:r></a:p>' for t in text)}</p:txBody></p:sp>"
    slide = lambda shapes: f"<p:sld {a} {p}>{shapes}</p:sld>"
    grid = "<p:graphicFrame><a:tbl><a:tr><a:tc><a:txBody><a:p><a:r><a:t>k</a:t></a:r></a:p></a:txBody></a:tc><a:tc/></a:tr></a:tbl></p:graphicFrame>"
    body = packed(**{
        "ppt/presentation.xml": f"<p:presentation {p} xmlns:r='{REL}'><p:sldIdLst><p:sldId id='1' r:id='r2'/><p:sldId id='2' r:id='r1'/><p:sldId id='3' r:id='r9'/></p:sldIdLst></p:presentation>", "ppt/_rels/presentation.xml.rels": rels(r1=("slide", "slides/slide1.xml"), r2=("slide", "/ppt/slides/slide2.xml")),
        "ppt/slides/slide1.xml": slide(sp(["body"]) + sp(["The", "title"], "title") + grid), "ppt/slides/slide2.xml": slide(sp(["first"])), "ppt/slides/_rels/slide1.xml.rels": rels(n=("notesSlide", "../notes/n1.xml")), "ppt/notes/n1.xml": slide(sp(["say this"], "body") + sp(["7"], "sldNum")),
    })
    assert ooxml.read(body, "x.PPTX") == [("slide:1", "first"), ("slide:2", "# The title\n\nbody\n\n| k |  |\n| --- | --- |\n\nNotes: say this")]


def test_sheets_with_shared_strings_and_merged_areas():
    s = 'xmlns="urn:s"'
    sheet = f"<worksheet {s}><sheetData><row r='1'><c r='A1' t='s'><v>0</v></c><c r='C1' t='inlineStr'><is><t>in</t></is></c></row><row r='3'><c r='A3'><v>4.5</v></c><c r='C3' t='b'><v>1</v></c><c r='XFD3' t='s'><v>1</v></c></row><row r='4'><c r='A4' t='s'><v>99</v></c></row></sheetData><mergeCells><mergeCell ref='A1:B3'/></mergeCells></worksheet>"
    body = packed(**{"xl/workbook.xml": f"<workbook {s} xmlns:r='{REL}'><sheets><sheet name='Data 1' r:id='a'/><sheet name='None' r:id='b'/></sheets></workbook>", "xl/_rels/workbook.xml.rels": rels(a=("worksheet", "worksheets/s1.xml")), "xl/worksheets/s1.xml": sheet, "xl/sharedStrings.xml": f"<sst {s}><si><t>one</t></si><si><r><t>fa</t></r><r><t>r</t></r></si></sst>"})
    assert ooxml.read(body, "x.xlsx") == [("sheet:Data 1", "| one | one | in |  |\n| --- | --- | --- | --- |\n| one | one | TRUE | far |")]


def test_containers_that_are_refused_fail_alone(spark, monkeypatch):
    monkeypatch.setattr(ooxml, "MOST_PART", 1000)
    bomb = docx(par("x" * 100_000))
    typed = packed(**{"word/document.xml": "<!DOCTYPE a [<!ENTITY b 'c'>]><w/>"})
    for body, path in ((b"junk", "a.docx"), (bomb, "a.docx"), (typed, "a.docx"), (packed(x="y"), "a.docx"), (packed(**{"word/document.xml": "<open>"}), "a.docx"), (b"", "a.pdf")):
        with pytest.raises(ooxml.Refused):
            ooxml.read(body, path)
    rows = spark.createDataFrame([("a", "a.docx", bytearray(docx(par("fine")))), ("b", "b.docx", bytearray(b"plain words"))], "source_id string, path string, content_bytes binary")
    found = {r.source_id: (r.locator, r.text, r.warning) for r in references.parsed(rows, ooxml.read).collect()}
    assert found == {"a": ("block:1", "fine", None), "b": ("", "plain words", "Refused: not a zip container")}


def test_office_containers_hold_whole_texts(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from docweir.functions import richtext
    from docweir.plans import gaps

    text = "first < line\nsecond & line\r\n" + "".join(f"word{i} " for i in range(5000)) + "\x01last\x00 \ufffe one"
    rows = [(i, None if i == 6 else f"{text} {i}", None if i == 7 else "en", None if i == 9 else "web") for i in range(12)] + [(None, text, "en", "web")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    reasons = [None, "MIME_MISMATCH", "MIME_MISMATCH", None, "MACRO_CONTENT", "MIME_MISMATCH"]
    assert dict(gaps.office_containers(spark, str(tmp_path)).collect()) == dict(enumerate(reasons * 2)) | {None: None}
    monkeypatch.setattr(richtext, "container_reason", lambda body, suffix: F.col(body))
    bodies = dict(gaps.office_containers(spark, str(tmp_path)).collect())
    assert [bytes(bodies[i]).decode() for i in (5, 11)] == [f"{text} 5", f"{text} 11"]
    for i in (2, 8):  # without their last 30 bytes, which are the container's list of parts
        assert f"word4999  last    one {i}</w:t>".encode() in zlib.decompressobj(-15).decompress(bytes(bodies[i])[47:])
    for i in (0, 1, 3, 4, 6, 7, 9, 10):
        found = [t for _, t in ooxml.read(bytes(bodies[i]), "x.docx")]
        whole = "" if i == 6 else f"{text} {i}".translate(dict.fromkeys(map(ord, "\x00\x01\ufffe"), " "))
        assert found[0].split()[-1] == str(i) and " ".join(" ".join(found[1:-1]).split()) == " ".join(whole.split())


@pytest.fixture(scope="module")
def other():
    """The same vocabulary by another library."""
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


ENCODE = token_windows.encoder_of(PATH)


def test_windows_of_whole_tables(spark, small, other):
    docs = spark.read.parquet(f"{small}/documents.parquet").selectExpr("concat('doc:', doc_id) AS source_id", "concat('Title ', doc_id) AS title", "text AS content")
    texts = {r.source_id: r.content or "" for r in docs.collect()}
    rows = token_windows.window_documents(docs, PATH).orderBy("source_id", "ordinal").collect()
    covered = {k: np.zeros(len(t), bool) for k, t in texts.items()}
    for r in rows:
        assert r.tokens == len(other.encode_ordinary(r.content)) and r.total == len(other.encode_ordinary(token_windows.led(tuple(r.path), r.content))) + 2 <= 512
        assert r.content.endswith(texts[r.source_id][r.start : r.end])
        covered[r.source_id][r.start : r.end] = True
    for k, text in texts.items():
        assert not "".join(c for c, there in zip(text, covered[k]) if not there).strip(), k


def test_windows_overlap_by_tokens_and_end_well(other):
    text = "\n".join(f"Sentence number {i} says a little about nothing in particular." for i in range(200))
    found = token_windows.windows_of("T", text, ENCODE, budget=100, overlap=20)
    assert all(w.tokens <= 101 for w in found) and all(text[w.end - 1] == "." for w in found)
    for one, two in zip(found, found[1:]):
        assert two.start <= one.end and len(other.encode_ordinary(text[two.start : one.end])) <= 21 and two.start > one.start


def test_rows_stay_whole_under_their_header():
    rows = ["| id | name |", "|---|---|", *(f"| {i} | entry number {i} |" for i in range(120))]
    text = "# Registry\nIntro.\n" + "\n".join(rows) + "\n\nAfter the table."
    found = token_windows.windows_of("T", text, ENCODE, budget=120, overlap=20)
    lines = [line for w in found for line in w.content.splitlines()]
    assert all(line in [*rows, "# Registry", "Intro.", "", "After the table."] for line in lines)
    assert all(lines.count(r) == 1 for r in rows[2:]) and all(w.content.startswith("| id | name |\n|---|---|\n") for w in found[1:] if "| entry" in w.content)
    assert {w.path for w in found} == {("Registry",)}


def test_long_words_rows_and_headings(other):
    word = "".join(chr(97 + i * 7 % 26) for i in range(5000))
    found = token_windows.windows_of("T", f"before {word} after", ENCODE, budget=100, overlap=0)
    assert "".join(w.content for w in found).replace(" ", "") == f"before{word}after" and all(w.total <= 512 for w in found)
    row = "| " + " | ".join(f"value {i}" for i in range(600)) + " |"
    found = token_windows.windows_of("T", f"| a | b |\n|---|---|\n{row}", ENCODE)
    assert all(w.total <= 512 for w in found) and all(f"value {i}" in " ".join(w.content for w in found) for i in range(600))
    found = token_windows.windows_of("T", f"# {'heading ' * 600}\nbody", ENCODE)
    assert all(w.total <= 512 for w in found) and "body" in found[-1].content
    assert token_windows.windows_of("T", " \n ", ENCODE) == [] and token_windows.windows_of("", "x", ENCODE)[0].path == ("",)
    emoji = token_windows.windows_of("T", "👩‍👩‍👧 " * 400, ENCODE)
    assert all(w.total <= 512 and w.tokens == len(other.encode_ordinary(w.content)) for w in emoji)


def test_ends_of_tokens_by_the_fast_engine_are_those_of_tokenizers():
    import tokenizers

    from docweir.functions import tokens

    slow, fast = tokenizers.Tokenizer.from_file(PATH), tokens.encoder(PATH)
    assert fast._fast is not None and fast._slow is None
    for text in ["", " \n\t ", "It's  a probe:\n\n don't", "naïve façade €9 日本語   x", "👩‍👩‍👧 " * 40, "a<|endoftext|> b", "x\x1cy\x85z " * 9, "| é | 日 |\r\n" * 30]:
        assert fast.ends(text).tolist() == [b for _, b in slow.encode(text, add_special_tokens=False).offsets]


def test_windows_tokens_are_sums_where_words_are_whole():
    asked = []

    def counted(texts):
        asked.append(sum(map(len, texts)))
        return ENCODE(texts)

    counted.additive = ENCODE.additive
    plain = lambda texts: ENCODE(texts)  # noqa: E731  (says nothing of sums)
    for text in ["It's 'so  naïve, isn't it?\n\n 日本 x1 y. " * 200, "a\x1cb !\x1d! c<|endoftext|> d " * 200, "| a | b |\n|-|-|\n" + "| 'll c | d é |\n" * 300 + "# h \n" + "w" * 9000]:
        assert token_windows.windows_of("T ", text, ENCODE) == token_windows.windows_of("T ", text, plain)
    text = "some plain words, of which there are many. " * 500
    token_windows.windows_of("T", text, counted)
    assert sum(asked) < 1.2 * len(text)
