"""What a text is: its format, category, entity and language, each with the reason for the decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lines and characters that are looked at, which is part of what the decisions mean.
SAMPLE_LINES, SAMPLE_CHARS, STRUCTURE_CHARS = 200, 80_000, 8_000
LEAST_ROWS = 3

# Patterns and words that the decisions rest on.
NEWLINE = r"\r\n|\r|\n"
HEADING = r"^ {0,3}#{1,6} \S"
FENCE = r"^ {0,3}```"
PIPE_ROW = r"^\s*\|.*\|\s*$"
HTML_TAG = r"(?i)<(p|div|table|h[1-6]|ul|ol|span|section)\b[^>]*>"
LOG_LINE = r"^\s*(?:\[?\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}|\d{2}:\d{2}:\d{2}|(?:TRACE|DEBUG|INFO|WARN|WARNING|ERROR|FATAL)\b)"
CODE_LINE = r"^\s*(?:package |import |from \S+ import |#include|using |def |class |func |public |private |internal |fun |val |var |const |let |async def )"
TITLE_ENTITY = r"(?i)^\s*([A-Za-z][A-Za-z0-9]{1,30})(?:[-_:]+|\s+RAG[-_ ]*\d+\b)"
STRUCTURE_ENTITY = r"\b([A-Z][A-Z0-9]{1,30})_[A-Z0-9_]{2,}\b"
FLOW_TAG = r"(?i)\[(?:BOT)?FLOW-\d+\]"
CONTRACT_HEADING = r"(?i)^#{2,4}\s+`?[A-Z][A-Z0-9_]+`?\s+[-—].*\bid\s+\d+.*\bversion\b"
STOP_ENTITIES = ("about", "api", "credit", "event", "final", "funds", "http", "items", "json", "local", "login", "master", "not", "project", "sql", "example", "workflow")
SPANISH = ("el", "la", "los", "las", "de", "del", "que", "para", "con", "como", "se")
ENGLISH = ("the", "a", "of", "that", "for", "with", "how", "is")


def stripped(text: Column) -> Column:
    """Without white space at either end, of any script."""
    # Few texts have any, which their first and last bytes tell; only those, and those with other scripts there, are searched.
    raw = text.cast("binary")
    ends = F.concat(F.substring(raw, 1, 1), F.substring(raw, -1, 1)).cast("string")
    return F.when(ends.rlike(r"[^\x00-\x08\x0e-\x1f\x21-\x7f]"), F.regexp_replace(text, r"(?U)^\s+|\s+$", "")).otherwise(text)


def clean(text: Column) -> Column:
    """Without control characters (but tab and line ends) and white space at either end."""
    return stripped(F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", ""))


def says_something(text: Column) -> Column:
    """Whether anything is left of a cleaned text, told by the first such character."""
    return text.rlike(r"(?U)[^\s\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")


def _occurrences(text: Column, mark: str) -> Column:
    """How often an ASCII character occurs."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))


def lines(text: Column) -> Column:
    return F.split(text, NEWLINE)


def declared_format(suffix: Column, mime: Column) -> Column:
    """The format that an extension or MIME type settles, or null."""
    return (
        F.when(suffix.isin(".md", ".markdown") | (mime == "text/markdown"), "markdown")
        .when(suffix.isin(".csv", ".tsv") | mime.isin("text/csv", "text/tab-separated-values"), "csv")
        .when(suffix.isin(".htm", ".html") | (mime == "text/html"), "html")
        .when(suffix.isin(".json", ".xml", ".yaml", ".yml"), "json")
        .when(suffix == ".log", "log")
    )


def _agreeing(sample: Column, delimiter: str) -> Column:
    """Leading lines (blank ones left out) that hold the same number of delimiters as the first, if it holds any. The sample begins with a line that isn't blank."""
    counts = F.transform(F.filter(sample, lambda x: F.trim(x) != ""), lambda x: _occurrences(x, delimiter))
    start = F.struct(F.lit(-1).alias("first"), F.lit(0).alias("run"), F.lit(True).alias("open"))

    def add(acc: Column, n: Column) -> Column:
        goes_on = acc["open"] & ((acc["first"] < 0) | (acc["first"] == n))
        return F.struct(F.when(acc["first"] < 0, n).otherwise(acc["first"]).alias("first"), F.when(goes_on, acc["run"] + 1).otherwise(acc["run"]).alias("run"), goes_on.alias("open"))

    run = F.aggregate(counts, start, add, lambda acc: F.when(acc["first"] >= 1, acc["run"]).otherwise(0))
    return F.when(F.try_element_at(sample, F.lit(1)).contains(delimiter), run).otherwise(0)


def with_format(df: DataFrame, text: str = "content", declared: str = "declared") -> DataFrame:
    """df with kind and reason: what was declared, else the first shape that there is evidence of.

    Lines, counts and the decision are steps of their own, so each is computed once a row.
    """
    columns = df.columns
    df = df.withColumn("_body", stripped(F.col(text)))
    df = df.withColumn("_lines", lines(F.col("_body")))
    df = df.withColumn("_sample", F.slice("_lines", 1, SAMPLE_LINES))
    sample, body = F.col("_sample"), F.col("_body")
    count = lambda pattern: F.size(F.filter(sample, lambda x: x.rlike(pattern)))
    df = df.withColumns({
        "_comma": _agreeing(sample, ","), "_tab": _agreeing(sample, "\t"), "_semicolon": _agreeing(sample, ";"), "_log": count(LOG_LINE), "_code": count(CODE_LINE),
        "_pipes": F.when(F.col("_body").contains("|"), F.size(F.filter(sample, lambda x: _occurrences(x, "|") >= 2))).otherwise(0),
    })
    delimited = F.coalesce(*(F.when(F.col(c) >= LEAST_ROWS, F.col(c)) for c in ("_comma", "_tab", "_semicolon")))
    n = lambda number, what: F.concat(number.cast("string"), F.lit(what))
    json = body.rlike(r"^[\{\[]") & body.rlike(r"[\}\]]$") & F.try_parse_json(body).isNotNull()
    many_logs = F.col("_log") >= F.greatest(F.lit(LEAST_ROWS), F.floor(F.size(sample) / 2))
    reason = (
        F.when(F.coalesce(F.col(declared), F.lit("")) != "", "declared")
        .when(body == "", "empty")
        .when(json, "parses as JSON")
        .when(delimited.isNotNull(), n(delimited, " leading lines agree"))
        .when((F.col("_pipes") >= LEAST_ROWS) & F.exists(sample, lambda x: x.rlike(PIPE_ROW)), n(F.col("_pipes"), " pipe rows"))
        .when(F.exists("_lines", lambda x: x.rlike(HEADING) | x.rlike(FENCE)), "headings or fences")
        .when(body.rlike(HTML_TAG), "block tags")
        .when(many_logs, n(F.col("_log"), " log lines"))
        .when(F.col("_code") >= LEAST_ROWS, n(F.col("_code"), " code lines"))
        .otherwise("no markers")
    )
    df = df.withColumn("reason", reason)
    found = F.col("reason")
    kind = (
        F.when(found == "declared", F.col(declared)).when(found == "parses as JSON", "json").when(found.endswith("agree"), "csv").when(found.isin("headings or fences") | found.endswith("pipe rows"), "markdown")
        .when(found == "block tags", "html").when(found.endswith("log lines"), "log").when(found.endswith("code lines"), "code").otherwise("prose")
    )
    return df.select(*columns, kind.alias("kind"), "reason")


def _label(labels: Column, prefix: str) -> Column:
    """The rest of the least label that begins with the prefix, or empty."""
    lowered = F.transform(F.coalesce(labels, F.array().cast("array<string>")), lambda x: F.lower(F.trim(x)))
    return F.coalesce(F.substring(F.array_min(F.filter(lowered, lambda x: x.startswith(prefix))), len(prefix) + 1, 10_000), F.lit(""))


def structural_category(title: Column, text: Column) -> Column:
    name = F.replace(F.lower(title), F.lit("_"), F.lit(" "))
    sample = F.when(F.octet_length(text) > SAMPLE_CHARS, F.substring(text, 1, SAMPLE_CHARS)).otherwise(text)
    rows = lines(sample)
    piped = F.size(F.filter(rows, lambda x: _occurrences(x, "|") >= 3))
    prose = F.size(F.filter(rows, lambda x: F.regexp_count(x, F.lit(r"\S+")) >= 8))
    # What a search of the whole sample rules out isn't looked for line by line.
    contract = sample.contains("##") & F.exists(rows, lambda x: x.rlike(CONTRACT_HEADING)) | name.contains("event and integration contract")
    return (
        F.when(name.contains("bot-rag-00"), "index")
        .when(name.contains("bot-rag-02"), "workflow")
        .when(name.rlike("bot-rag-0[134]"), "narrative")
        .when(name.rlike(r"\b(master index|corpus guide|navigation index)\b"), "index")
        .when(name.rlike(r"\b(glossary|terms and definitions)\b"), "glossary")
        .when(name.rlike(r"\b(workflow|business flow|end to end)\b") | (sample.contains("[") & sample.rlike(FLOW_TAG)), "workflow")
        .when(contract, "entity-contract")
        .when((_occurrences(sample, "|") >= 60) & (piped >= 20) & (piped > prose), "registry-table")
        .otherwise("narrative")
    )


def with_category(df: DataFrame, title: str = "title", text: str = "content", labels: str = "labels") -> DataFrame:
    """df with category, category_reason and category_warning: a label wins over structure, and a disagreement is told."""
    df = df.withColumns({"_label": _label(F.col(labels), "pi-category:"), "_structure": structural_category(F.col(title), F.col(text))})
    label, structure = F.col("_label"), F.col("_structure")
    return df.withColumns({
        "category": F.when(label != "", label).otherwise(structure),
        "category_reason": F.when(label != "", "label").when(structure != "narrative", "structure").otherwise("no markers"),
        "category_warning": F.when((label != "") & (structure != "narrative") & (structure != label), F.concat(F.lit("structure says "), structure)).otherwise(""),
    }).drop("_label", "_structure")


def normal_entity(value: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(value)), "[^a-z0-9_-]+", "")


def detect_entity(title: Column, text: Column, labels: Column) -> Column:
    """struct(entity, reason): from a label, the title's prefix, or an identifier's prefix; stop words are none."""
    label = normal_entity(_label(labels, "pi-entity:"))
    titled = normal_entity(F.regexp_extract(title, TITLE_ENTITY, 1))
    inner = normal_entity(F.regexp_extract(F.substring(text, 1, STRUCTURE_CHARS), STRUCTURE_ENTITY, 1))
    made = lambda entity, reason: F.struct(entity.alias("entity"), F.lit(reason).alias("reason"))
    usable = lambda x: (x != "") & ~x.isin(*STOP_ENTITIES)
    return F.when(label != "", made(label, "label")).when(usable(titled), made(titled, "title prefix")).when(usable(inner), made(inner, "identifier prefix")).otherwise(made(F.lit(""), "none"))


def detect_language(text: Column) -> Column:
    """es or en by function words; on a tie mixed where there are accents, else und."""
    low = F.lower(text)
    letter = "[a-záéíóúñ]"
    spanish, english = (F.regexp_count(low, F.lit(f"(?<!{letter})(?:{'|'.join(words)})(?!{letter})")) for words in (SPANISH, ENGLISH))
    return F.when(spanish > english, "es").when(english > spanish, "en").when(low.rlike("[áéíóúñ¿¡]"), "mixed").otherwise("und")
