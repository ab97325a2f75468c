"""Column functions over texts: identifiers, keywords, symbols, prefixes, links."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
KEYWORD = r"[A-Za-z0-9][A-Za-z0-9_./:#-]{2,}"
IDENTIFIER = "^[A-Z][A-Z0-9_]{2,}$"
MODIFIERS = "public|private|protected|internal|open|abstract|sealed|data|enum|annotation|value|inline|tailrec|suspend|operator|infix|override|actual|expect|final|external"
SYMBOL = rf"(?m)^\s*(?:async\s+)?(?:(?:{MODIFIERS})\s+)*(?:class|interface|object|def|fun|function)\s+([A-Za-z_][A-Za-z0-9_]*)"
PASSAGE = "passage: "
MARKDOWN_IMAGE = r"!\[[^\]]*\]\(([^)]+)\)"
MERMAID_EDGE = r"([A-Za-z][\w-]*)(?:\s*\[([^\]]+)\])?\s*(?:-->|==>|-\.->)\s*([A-Za-z][\w-]*)(?:\s*\[([^\]]+)\])?"
GLOSSARY = r"(?i)^([\w][\w /-]{1,50})\s+(?:means|significa|se define como)\s+(.{10,})$"
MOST_KEYWORDS = 32


def identifiers(text: Column) -> Column:
    """Sorted distinct upper-case identifiers; words are what letters, marks, digits and underscores make."""
    return F.array_sort(F.array_distinct(F.filter(F.split(text, r"[^\p{L}\p{M}\p{N}_]+"), lambda x: x.rlike(IDENTIFIER))))


def _once(value: Column, function: Callable[[Column], Column]) -> Column:
    """function of a value that is computed once, however often function looks at it."""
    return F.element_at(F.transform(F.array(value), function), 1)


def first_spellings(tokens: Column, most: int) -> Column:
    """The first `most` distinct tokens regardless of case, in the order and spelling in which they come first."""
    given = F.struct(tokens.alias("spelled"), F.transform(tokens, lambda t: F.lower(t)).alias("folded"))
    return _once(given, lambda g: F.transform(F.slice(F.array_distinct(g["folded"]), 1, most), lambda k: F.element_at(g["spelled"], F.array_position(g["folded"], k).cast("int"))))


def with_keywords(df: DataFrame, values: list[Column], name: str = "keywords", most: int = MOST_KEYWORDS) -> DataFrame:
    """df with the first keywords of the values in turn.

    The first few tokens nearly always hold enough; only where they don't is the rest gone through.
    Each step is a column of its own, so it is computed once a row.
    """
    ahead = 4 * most
    df = df.withColumn("_tokens", F.regexp_extract_all(F.concat_ws("\n", *values), F.lit(f"({KEYWORD})"), F.lit(1)))
    df = df.withColumn("_short", first_spellings(F.slice("_tokens", 1, ahead), most))
    enough = (F.size("_tokens") <= ahead) | (F.size("_short") >= most)
    return df.withColumn(name, F.when(enough, F.col("_short")).otherwise(first_spellings(F.col("_tokens"), most))).drop("_tokens", "_short")


def code_symbols(text: Column) -> Column:
    """Names that declarations begin with, in the order in which they come first."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(SYMBOL), F.lit(1)))


# How lines begin that only frame code, and what is too short to say anything.
FRAMING = ("@", "package ", "import ", "//", "/*", "*", "*/")
FEW_CHARACTERS, FEW_WORDS, CODE_WORD = 48, 3, r"[A-Za-z_]\w*"


def low_information_code(text: Column) -> Column:
    """Whether a piece of code says nothing alone: blank, nothing but framing lines, or a few short words."""
    lines = F.filter(F.transform(F.split(text, r"\r\n|\n|\r"), lambda x: F.trim(x, F.lit(" \t"))), lambda x: x != "")

    def frames(line: Column) -> Column:
        found = F.lit(False)
        for start in FRAMING:
            found = found | line.startswith(start)
        return found

    short = (F.length(text) < FEW_CHARACTERS) & (F.regexp_count(text, F.lit(CODE_WORD)) <= FEW_WORDS)
    return F.forall(lines, frames) | short


def with_searchable(df: DataFrame, content: str = "content", heading_path: str | None = None) -> DataFrame:
    """df with `searchable`, the fields by which a chunk is found; what df lacks is empty.

    Looks at title, reference, source_type, path, repository, branch, issue_key, project_key, symbol,
    symbols, kind, locator and provider. Jira chunks have no generated keywords: fragments of issues
    side by side could look like credentials.
    """
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")
    path = F.coalesce(F.nullif(own("path"), F.lit("")), own("title"))
    given = F.col("symbols") if "symbols" in df.columns else F.array().cast("array<string>")
    symbols = F.array_distinct(F.filter(F.concat(F.array(own("symbol")), F.coalesce(given, F.array().cast("array<string>")), code_symbols(F.col(content))), lambda x: x != ""))
    headings = F.concat_ws("\n", heading_path) if heading_path else F.lit("")
    df = df.withColumns({"_path": path, "_symbols": symbols})
    inputs = [own(c) for c in ("title", "reference", "source_type")] + [F.col("_path")] + [own(c) for c in ("repository", "branch", "issue_key", "project_key")]
    is_jira = F.upper(own("provider")) == "JIRA"
    df = with_keywords(df, [*inputs, headings, own("locator"), F.concat_ws("\n", "_symbols"), F.when(~is_jira, F.col(content)).otherwise("")], "_keywords")
    fields = {c: own(c) for c in ("repository", "branch", "issue_key", "project_key", "symbol")}
    fields |= {
        "path": F.col("_path"), "file_name": F.element_at(F.split("_path", "/"), -1), "symbols": F.col("_symbols"), "important_kwd": F.when(is_jira, F.array().cast("array<string>")).otherwise(F.col("_keywords")),
        "chunk_kind": own("kind"), "chunk_char_count": F.length(content).cast("long"), "chunk_token_count": F.regexp_count(content, F.lit(r"\S+")).cast("long"),
    }
    return df.withColumn("searchable", F.struct(*(v.alias(k) for k, v in fields.items()))).drop("_path", "_symbols", "_keywords")


# Fields that enrich a chunk, in order, and the labels under which they are shown.
ENRICHMENT = ("repository", "branch", "path", "file_name", "issue_key", "symbols", "important_kwd")
LABELS = {"REPOSITORY": "repository", "BRANCH": "branch", "PATH": "path", "FILE": "file_name", "ISSUE": "issue_key", "SYMBOLS": "symbols", "KEYWORDS": "important_kwd"}
MOST_VALUE, MOST_CONTEXT, MOST_RECORDS = 65_536, 262_144, 2_048


def _flat(searchable: Column) -> Column:
    """(name, value) of every enrichment field, lists taken apart, empty ones left out."""

    def named(name: str) -> Column:
        items = searchable[name] if name in ("symbols", "important_kwd") else F.array(searchable[name])
        return F.transform(items, lambda v: F.struct(F.lit(name).alias("name"), v.alias("value")))

    return F.filter(F.concat(*map(named, ENRICHMENT)), lambda r: F.coalesce(r["value"], F.lit("")) != "")


def enrichment(searchable: Column) -> Column:
    """The values that enrich a chunk, in the order of their fields."""
    return F.transform(_flat(searchable), lambda r: r["value"])


def framed_context(searchable: Column) -> Column:
    """name, byte count, value of every enrichment value, so that none can break out of its frame; null where framed_failure says why not."""
    records = _flat(searchable)
    lines = F.transform(records, lambda r: F.concat(r["name"], F.lit(" "), F.octet_length(r["value"]).cast("string"), F.lit("\n"), r["value"], F.lit("\n")))
    return F.when(framed_failure(searchable).isNull(), F.array_join(lines, ""))


def framed_failure(searchable: Column) -> Column:
    """Why a chunk's values can't be framed (control characters, too many or too large values), or null. It is that chunk's failure alone."""
    records = _flat(searchable)
    # A frame is the name, its value's size, and three separators.
    size = F.aggregate(records, F.lit(0).cast("long"), lambda n, r: n + F.octet_length(r["value"]) + F.octet_length(r["name"]) + F.length(F.octet_length(r["value"]).cast("string")) + 3)
    over = F.exists(records, lambda r: F.octet_length(r["value"]) > MOST_VALUE) | (size > MOST_CONTEXT) | (F.size(records) > MOST_RECORDS)
    control = F.exists(records, lambda r: r["value"].rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]"))
    return F.when(control, "a value has control characters").when(over, "a chunk's context is too large")


def labelled_context(searchable: Column) -> Column:
    """LABEL: value lines of the enrichment fields that have a value; lists are joined by commas."""
    shown = {label: F.array_join(F.filter(searchable[c], lambda x: x != ""), ", ") if c in ("symbols", "important_kwd") else searchable[c] for label, c in LABELS.items()}
    return metadata_context(shown)


def next_link(origin: Column, link: Column) -> Column:
    """Where a listing goes on, or null at its end."""
    given = F.nullif(link, F.lit(""))
    return F.when(given.startswith("http"), given).otherwise(F.concat(origin, F.when(given.startswith("/"), given).otherwise(F.concat(F.lit("/"), given))))


def page_url(site: Column, web_ui: Column, page_id: Column) -> Column:
    """Where a wiki page is read: its own link, or a view by its id."""
    root = F.rtrim(site, F.lit("/"))
    return F.when(F.coalesce(web_ui, F.lit("")) != "", F.concat(root, F.lit("/wiki"), web_ui)).otherwise(F.concat(root, F.lit("/wiki/pages/viewpage.action?pageId="), page_id))


def passage(text: Column) -> Column:
    """text with exactly one passage prefix."""
    return F.concat(F.lit(PASSAGE), F.ltrim(F.regexp_replace(text, r"(?i)^(?:\s*passage:\s*)+", "")))


def collapsed(text: Column) -> Column:
    """White space as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def excerpt(text: Column, most: int = 110) -> Column:
    short = collapsed(text)
    return F.when(F.length(short) > most, F.concat(F.substring(short, 1, most), F.lit("…"))).otherwise(short)


def slug(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(value)), "[^a-z0-9_-]+", "-"), "^[-_]+|[-_]+$", "")


def collection_name(base: Column, project: Column) -> Column:
    """The physical name of a project's collection: slugs, and a digest that keeps projects apart."""
    return F.concat_ws("-", F.substring(slug(base), 1, 48), F.substring(slug(project), 1, 32), F.substring(F.sha2(project, 256), 1, 12))


def link_kind(url: Column) -> Column:
    host, path = F.try_parse_url(url, F.lit("HOST")), F.try_parse_url(url, F.lit("PATH"))
    on = F.coalesce(host, F.lit("")) == "github.com"
    return (
        F.when(on & path.rlike("/[^/]+/[^/]+/issues/[^/]+"), "GITHUB_ISSUE")
        .when(on & path.rlike("/[^/]+/[^/]+/pull/[^/]+"), "GITHUB_PR")
        .when(on & path.rlike("/[^/]+/[^/]+/commit/[^/]+"), "GITHUB_COMMIT")
        .otherwise("REMOTE_LINK")
    )


def absolute_link(origin: Column, link: Column) -> Column:
    """A wiki link against the site root, one segment below the origin."""
    return F.when(link.startswith("http"), link).when(link.startswith("/wiki/"), F.concat(origin, link)).otherwise(F.concat(origin, F.lit("/wiki"), link))


def page_of(locator: Column) -> Column:
    """The number in a page locator, or null."""
    return F.regexp_extract(locator, r"^page:(\d+)$", 1).try_cast("int")


def section_kind(heading: Column) -> Column:
    return F.when(heading.rlike("(?i)acceptance|aceptaci[oó]n"), "ACCEPTANCE").when(heading.rlike("(?i)requirement|requisito"), "REQUIREMENTS").otherwise("DESCRIPTION")


def blob(body: Column) -> Column:
    """The text of a base64 body, lines and all; null where it isn't UTF-8."""
    return F.try_validate_utf8(F.unbase64(body).cast("string"))


def unsafe_target(target: Column) -> Column:
    """Image targets that are remote, absolute, outside the tree, or vector graphics."""
    low = F.lower(target)
    return (target == "") | low.rlike("^(http://|https://|data:|file:|javascript:)") | target.rlike(r"^[/\\]") | F.array_contains(F.split(F.replace(target, F.lit("\\"), F.lit("/")), "/"), "..") | low.endswith(".svg")


def metadata_context(fields: dict[str, Column]) -> Column:
    """LABEL: value lines of the fields that have a value."""
    return F.concat_ws("\n", *(F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{label}: "), value)) for label, value in fields.items()))


def fitted(required: Column, optional: list[Column], body: Column, limit: int, body_words: Column | None = None) -> Column:
    """An embedding text of at most limit words: optional lines go, from the last, until it fits; the body is never cut. body_words are the body's, where they are known."""
    last = len(optional) + 2

    def chosen(s: Column) -> Column:
        # Parts are lines of their own, so a text has as many words as its parts together.
        text = lambda n: F.array_join(F.filter(F.concat(F.slice(s["parts"], 1, n + 1), F.slice(s["parts"], last, 1)), lambda x: x != ""), "\n")
        out = text(0)
        for n in range(1, last - 1):
            out = F.when(sum((F.element_at(s["words"], k) for k in range(1, n + 2)), F.element_at(s["words"], last)) <= limit, text(n)).otherwise(out)
        return out

    count = lambda x: F.coalesce(F.regexp_count(x, F.lit(r"\S+")), F.lit(0)).cast("long")
    own = count(body) if body_words is None else body_words
    counted = lambda p: F.struct(p.alias("parts"), F.concat(F.transform(F.slice(p, 1, last - 1), count), F.array(own)).alias("words"))
    return _once(F.array(required, *optional, body), lambda p: _once(counted(p), chosen))
