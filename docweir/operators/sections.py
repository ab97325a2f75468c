"""Documents as lines, sections and tables: set-based structure, one window per document."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docweir.functions import formats

# What headings, rows, steps and titles look like.
HEADING = r"^(#{1,6})\s+(.+)$"
TABLE_ROW = r"^\s*\|"
STEP = r"^\s*\d+[.)]\s+\S"
FLOW_HEADING = r"^#{1,4}\s+.*?\[([A-Z][A-Z0-9]*-\d+)\].*$"
CONTRACT = r"(?i)^#{2,4}\s+(?:[\d.]+\s+)?`?([A-Z][A-Z0-9_]+)`?\s+(?:[-—]\s+id\s+(\d+)\s*,\s*version\s+([^\s#]+)\s*$|\(id\s+(\d+)\))"
TERM_LINE = r"^\s*([^:]{2,80}):\s+(.+)$"
NAVIGATION = r"(?i)\b(?:how to use|reading order|volume map|master index|corpus guide|what this volume|document metadata|scope and audience|index)\b"
GLOSSARY = r"(?i)\b(?:glossar\w*|vocabular\w*|terminolog\w*|definitions?)\b"
REGISTRY = r"(?i)\b(?:registry|matrix|inventory|catalog\w*|map|ownership|reference table)\b"
WORKFLOW = r"(?i)\b(?:flow|lifecycle|workflow|process|walkthrough|end.to.end)\b"
# What the classification of a corpus takes for a section, and for a contract's heading; reading is more lenient.
CLASSIFIED = r"^(#{2,4})\s+(.+?)\s*$"
OWN_CONTRACT = r"^#{3}\s+`([A-Z][A-Z0-9_]*)`\s+[—-]\s+id\s+\d+,\s+version\s+[\d.]+\s*$"
NUMBERED_CONTRACT = r"^#{2,4}\s+[\d.]+\s+`([A-Z][A-Z0-9_]*)`\s+\(id\s+(\d+)\)"
#: Parts of a section's live lines from which tables or steps rule it.
TABLE_PART, STEP_PART = 0.28, 0.08


Key = str | list[str]  #: What tells documents apart: a column, or several.


def _key(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def document_lines(docs: DataFrame, key: Key = "source_id", text: str = "content") -> DataFrame:
    """(key, pos, line) of every line, pos from 0."""
    return docs.select(*_key(key), F.posexplode(formats.lines(F.col(text))).alias("pos", "line")).withColumn("pos", F.col("pos").cast("long"))


def by_document(key: Key = "source_id"):
    return W.partitionBy(*_key(key)).orderBy("pos")


def sections(lines: DataFrame, key: Key = "source_id", heading: str = HEADING) -> DataFrame:
    """lines with section: how many headings there are up to and with each line. 0 is what comes before the first."""
    return lines.withColumn("section", F.count_if(F.col("line").rlike(heading)).over(by_document(key)))


def spans(lines: DataFrame, key: Key = "source_id") -> DataFrame:
    """(key, section, level, title, first, last): each heading's section runs to the line before the next one."""
    ends = lines.groupBy(*_key(key)).agg(F.max("pos").alias("end"))
    heads = lines.where(F.col("line").rlike(HEADING))
    heads = heads.withColumn("next", F.lead("pos").over(by_document(key))).withColumn("section", F.row_number().over(by_document(key)).cast("long"))
    out = heads.join(ends, key).withColumn("last", F.coalesce(F.col("next") - 1, F.col("end")))
    return out.select(*_key(key), "section", F.length(F.regexp_extract("line", HEADING, 1)).cast("long").alias("level"), F.regexp_extract("line", HEADING, 2).alias("title"), F.col("pos").alias("first"), "last")


def heading_paths(lines: DataFrame, key: Key = "source_id", depth: int = 4) -> DataFrame:
    """(key, pos, path): the headings above each line, down to depth; a heading ends the deeper ones before it."""
    marked = lines.withColumn("level", F.when(F.col("line").rlike(HEADING), F.length(F.regexp_extract("line", HEADING, 1))))
    titles = F.regexp_extract("line", HEADING, 2)
    seen = by_document(key).rowsBetween(W.unboundedPreceding, 0)
    for k in range(1, depth + 1):
        marked = marked.withColumn(f"t{k}", F.last(F.when(F.col("level") == k, F.struct("pos", titles.alias("title"))), ignorenulls=True).over(seen))
    parts, floor = [], F.lit(-1)
    for k in range(1, depth + 1):
        here = F.col(f"t{k}")
        parts.append(F.when(here.isNotNull() & (here["pos"] > floor), here["title"]))
        floor = F.greatest(floor, F.coalesce(here["pos"], F.lit(-1)))
    return marked.select(*_key(key), "pos", F.concat_ws(" > ", *parts).alias("path"))


def classified(lines: DataFrame, key: Key = "source_id") -> DataFrame:
    """(key, section, title, category, tables, steps, total) of every section under h2 to h4, from its heading, title, and what its lines are."""
    table, step, live = F.col("line").rlike(TABLE_ROW), F.col("line").rlike(r"^\s*\d+\.\s+\S"), F.trim("line") != ""
    default = lines.groupBy(*_key(key)).agg(F.when(F.count_if(table) / F.greatest(F.count_if(live), F.lit(1)) >= TABLE_PART, "registry-table").otherwise("narrative").alias("default"))
    parts = sections(lines, key, CLASSIFIED).where("section > 0")
    body = ~F.col("line").rlike(CLASSIFIED)
    grouped = parts.groupBy(*_key(key), "section").agg(
        F.min_by("line", "pos").alias("heading"), F.count_if(body & table).alias("tables"), F.count_if(body & step).alias("steps"), F.greatest(F.count_if(body & live), F.lit(1)).alias("total")
    )
    title = F.regexp_extract("heading", CLASSIFIED, 2)
    category = (
        F.when(F.col("heading").rlike(OWN_CONTRACT) | F.col("heading").rlike(NUMBERED_CONTRACT), "entity-contract").when(title.rlike(REGISTRY), "registry-table").when(title.rlike(NAVIGATION), "index").when(title.rlike(GLOSSARY), "glossary")
        .when(F.col("tables") / F.col("total") >= TABLE_PART, "registry-table")
        .when((F.col("steps") / F.col("total") >= STEP_PART) | (title.rlike(WORKFLOW) & (F.col("steps") >= 3)), "workflow")
        .otherwise(F.col("default"))
    )
    return grouped.join(default, key).select(*_key(key), "section", title.alias("title"), category.alias("category"), "tables", "steps", "total")


def workflows(lines: DataFrame, key: Key = "source_id") -> DataFrame:
    """(key, section, flow_id, steps): sections that a flow tag heads, and their numbered steps."""
    marked = sections(lines, key, FLOW_HEADING).where("section > 0")
    grouped = marked.groupBy(*_key(key), "section").agg(F.min_by("line", "pos").alias("heading"), F.count_if(F.col("line").rlike(STEP)).alias("steps"))
    return grouped.select(*_key(key), "section", F.regexp_extract("heading", FLOW_HEADING, 1).alias("flow_id"), "steps")


def contracts(lines: DataFrame, key: Key = "source_id") -> DataFrame:
    """(key, pos, entity_key, entity_id, entity_version) of contract headings; a heading in parentheses has no version."""
    part = lambda n: F.nullif(F.regexp_extract("line", CONTRACT, n), F.lit(""))
    return lines.where(F.col("line").rlike(CONTRACT)).select(*_key(key), "pos", part(1).alias("entity_key"), F.coalesce(part(2), part(4)).alias("entity_id"), F.regexp_replace(part(3), "[.,;]+$", "").alias("entity_version"))


def islands(lines: DataFrame, key: Key = "source_id") -> DataFrame:
    """(key, island, first, rows, is_table): runs of lines with two pipes or more, and of others; a lone row is no table."""
    is_row = F.length("line") - F.length(F.replace("line", F.lit("|"), F.lit(""))) >= 2
    marked = lines.withColumn("is_row", is_row)
    turned = F.coalesce(F.col("is_row") != F.lag("is_row").over(by_document(key)), F.lit(True)).cast("int")
    numbered = marked.withColumn("turned", turned).withColumn("island", F.sum("turned").over(by_document(key)))
    runs = numbered.groupBy(*_key(key), "island").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("rows"), F.bool_and("is_row").alias("is_row"))
    return runs.select(*_key(key), "island", "first", "rows", (F.col("is_row") & (F.col("rows") > 1)).alias("is_table"))


def captions(lines: DataFrame, key: Key = "source_id") -> DataFrame:
    """(key, island, caption): of each table, the nearest heading before it, else table-n."""
    tables = islands(lines, key).where("is_table").withColumn("n", F.row_number().over(W.partitionBy(*_key(key)).orderBy("first")))
    seen = by_document(key).rowsBetween(W.unboundedPreceding, 0)
    heads = lines.withColumn("caption", F.last(F.nullif(F.regexp_extract("line", HEADING, 2), F.lit("")), ignorenulls=True).over(seen)).select(*_key(key), F.col("pos").alias("first"), "caption")
    return tables.join(heads, [*_key(key), "first"]).select(*_key(key), "island", F.coalesce("caption", F.concat(F.lit("table-"), F.col("n"))).alias("caption"))


def terms(lines: DataFrame, key: Key = "source_id") -> DataFrame:
    """(key, pos, term) of glossary entries written as `term: definition`."""
    return lines.where(F.col("line").rlike(TERM_LINE) & ~F.col("line").rlike(HEADING)).select(*_key(key), "pos", F.trim(F.regexp_extract("line", TERM_LINE, 1)).alias("term"))


def _windows(counts: list[int], budget: int) -> list[dict[str, int]]:
    done, lines, tokens = [], 0, 0
    for n in counts:
        if lines and tokens + n > budget:
            done.append({"lines": lines, "tokens": tokens})
            lines = tokens = 0
        lines, tokens = lines + 1, tokens + n
    return [*done, {"lines": lines, "tokens": tokens}]


def packed_lines(docs: DataFrame, budget: int, key: Key = "source_id", text: str = "content") -> DataFrame:
    """(key, window, lines, tokens): whole lines packed in turn into windows of at most budget words; a longer line stands alone.

    The accumulator starts anew with each window, which no frame can say. A fold by `aggregate` copies
    its finished windows at each line, so the lines' counts, and no text, are folded in Arrow batches.
    """
    counts = F.transform(formats.lines(F.col(text)), lambda x: F.regexp_count(x, F.lit(r"\S+")).cast("long"))

    @F.pandas_udf("array<struct<lines:bigint,tokens:bigint>>")
    def packed(series: pd.Series) -> pd.Series:
        return series.map(lambda found: None if found is None else _windows(found.tolist(), budget))

    windows = packed(counts)
    return docs.select(*_key(key), F.posexplode(windows).alias("window", "w")).select(*_key(key), "window", F.col("w.lines").alias("lines"), F.col("w.tokens").alias("tokens"))
