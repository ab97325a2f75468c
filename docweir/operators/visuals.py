"""What documents show besides text: tables, pictures, diagrams, found by pattern; nothing is fetched or drawn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweir.functions import text
from docweir.operators import references, sections

# Patterns of what can be told, and most assets of a document.
TABLE_SEPARATOR = r"(?m)^\s*\|?(?:\s*:?-{3,}:?\s*\|){1,}\s*:?-{3,}:?\s*\|?\s*$"
HTML_IMAGE = r"(?i)<img\b[^>]*\bsrc\s*=\s*['\x22]([^'\x22]+)['\x22]"
MERMAID = r"(?is)```\s*mermaid\s*\n(.*?)```"
ASCII_DIAGRAM = r"(?:-->|->|=>|\+[-=]{2,}\+|\|\s{2,}\|)"
UNSUPPORTED = r"(?i)```\s*(?:plantuml|dot|graphviz)\b"
HTML_TABLE, HTML_PICTURE = r"(?is)<table\b.*?</table>", r"(?i)<img\b"
MACRO = r"(?i)<(?:ac:)?structured-macro\b[^>]*?\b(?:ac:)?name\s*=\s*['\x22]([^'\x22]+)['\x22]"
RASTER_END = r"(?i)\.(?:png|jpe?g|webp)$"
MOST_ASSETS = 64
DECORATIVE = ("logo", "icon", "signature", "decorative")


def _named(pairs: list[tuple[Column, str]]) -> Column:
    """The names whose condition holds, in order."""
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in pairs)))


def markdown_visuals(docs: DataFrame) -> DataFrame:
    """(source_id, eligible, visual_types, reason_codes) of Markdown documents (source_id, content).

    Pictures that lie elsewhere are never fetched: ones of the repository need its provider, others aren't safe.
    """
    c = F.coalesce("content", F.lit(""))
    found = F.concat(F.regexp_extract_all(c, F.lit(text.MARKDOWN_IMAGE), F.lit(1)), F.regexp_extract_all(c, F.lit(HTML_IMAGE), F.lit(1)))
    targets = F.transform(found, lambda t: F.translate(F.regexp_extract(t, r"^\s*(\S*)", 1), "<>\"'", ""))
    unsafe = F.exists(targets, text.unsafe_target)
    local = F.exists(targets, lambda t: ~text.unsafe_target(t) & t.rlike(RASTER_END))
    diagram = c.rlike(MERMAID) | c.rlike(ASCII_DIAGRAM)
    types = _named([(diagram, "architecture_diagram"), (F.exists(targets, lambda t: ~text.unsafe_target(t)), "image"), (c.rlike(TABLE_SEPARATOR), "table")])
    reasons = _named([(unsafe, "UNSAFE_MARKDOWN_IMAGE_REFERENCE"), (local, "LOCAL_IMAGE_REQUIRES_PROVIDER_RESOLUTION"), (c.rlike(UNSUPPORTED), "UNSUPPORTED_DIAGRAM_RETAINED_AS_TEXT")])
    return docs.select("source_id", (F.size(types) > 0).alias("eligible"), types.alias("visual_types"), reasons.alias("reason_codes"))


def html_visuals(docs: DataFrame, most: int = MOST_ASSETS) -> DataFrame:
    """(source_id, eligible, tables, visual_types, reason_codes) of HTML documents: tables up to a limit, pictures, diagram macros."""
    c = F.coalesce("content", F.lit(""))
    tables = F.least(F.regexp_count(c, F.lit(HTML_TABLE)), F.lit(most))
    macros = F.transform(F.regexp_extract_all(c, F.lit(MACRO), F.lit(1)), lambda m: F.lower(m))
    kept = F.exists(macros, lambda m: m.isin("drawio", "gliffy", "plantuml", "graphviz"))
    picture = c.rlike(HTML_PICTURE)
    types = _named([(kept | F.array_contains(macros, "mermaid"), "architecture_diagram"), (picture, "image"), (tables > 0, "table")])
    reasons = _named([(picture, "HTML_IMAGE_REQUIRES_PROVIDER_RESOLUTION"), (kept, "CONFLUENCE_DIAGRAM_REQUIRES_ATTACHMENT")])
    return docs.select("source_id", (F.size(types) > 0).alias("eligible"), tables.cast("long").alias("tables"), types.alias("visual_types"), reasons.alias("reason_codes"))


def picture_type(label: Column) -> Column:
    """What a converter's label makes of a picture."""
    has = lambda *terms: F.lower(label).rlike("|".join(terms))
    return (
        F.when(has("diagram", "flow", "architecture", "network", "sequence"), "architecture_diagram").when(has("chart", "plot", "graph"), "chart").when(has("logo"), "logo")
        .when(has("signature"), "signature").when(has("decorative", "background"), "decorative").otherwise("image")
    )


def converted_visuals(items: DataFrame, most_pages: int = 500, most: int = MOST_ASSETS) -> DataFrame:
    """items of converted documents (source_id, ordinal, is_table, label, page, width, height) with asset_type and outcome.

    Ornaments and pages beyond the limit are left out, pictures must be large enough, and a document
    keeps its first assets up to the limit.
    """
    from pyspark.sql import Window as W

    kind = F.when(F.col("is_table"), "table").otherwise(picture_type(F.coalesce("label", F.lit(""))))
    items = items.withColumn("asset_type", kind)
    early = (
        F.when(F.col("asset_type").isin(*DECORATIVE), "DECORATIVE").when(F.col("page") > most_pages, "VISUAL_PAGE_LIMIT_REACHED")
        .when(~references.is_meaningful(F.coalesce("width", F.lit(0)), F.coalesce("height", F.lit(0))), "TOO_SMALL")
    )
    kept = F.sum(F.col("_early").isNull().cast("int")).over(W.partitionBy("source_id").orderBy("ordinal").rowsBetween(W.unboundedPreceding, 0))
    items = items.withColumn("_early", early).withColumn("_kept", kept)
    return items.withColumn("outcome", F.coalesce("_early", F.when(F.col("_kept") > most, "VISUAL_ASSET_LIMIT_REACHED").otherwise("KEPT"))).drop("_early", "_kept")


def missing_local(expected: Column, supplied: Column) -> Column:
    """The reason code where pictures that a document links to weren't supplied, or null."""
    return F.when(F.size(F.array_except(expected, supplied)) > 0, "LOCAL_IMAGE_REQUIRES_PROVIDER_RESOLUTION")


def first_tables(lines: DataFrame, key: str = "source_id") -> DataFrame:
    """(key, text) of the first table of each document's lines."""
    first = sections.islands(lines, key).where("is_table").groupBy(key).agg(F.min(F.struct("first", "rows")).alias("t")).select(key, "t.first", "t.rows")
    rows = lines.join(first, key).where("pos >= first and pos < first + rows")
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("l")).select(key, F.concat_ws("\n", F.transform("l", lambda x: x["line"])).alias("text"))


def diagram_edges(docs: DataFrame, most: int = 30) -> DataFrame:
    """(source_id, ordinal, from_node, from_label, to_node, to_label) of the first edges of each document's Mermaid diagrams."""
    inside = F.concat_ws("\n", F.regexp_extract_all("content", F.lit(MERMAID), F.lit(1)))
    part = lambda n: F.regexp_extract_all("d", F.lit(text.MERMAID_EDGE), F.lit(n))
    edges = F.arrays_zip(part(1).alias("a"), part(2).alias("la"), part(3).alias("b"), part(4).alias("lb"))
    rows = docs.select("source_id", inside.alias("d")).where("d <> ''").select("source_id", F.posexplode(F.slice(edges, 1, most)).alias("ordinal", "e"))
    blank = lambda c: F.nullif(F.coalesce(F.col(c), F.lit("")), F.lit(""))
    return rows.select("source_id", "ordinal", F.col("e.a").alias("from_node"), blank("e.la").alias("from_label"), F.col("e.b").alias("to_node"), blank("e.lb").alias("to_label"))


def preview(found: DataFrame) -> DataFrame:
    """How many documents show something of each type, and how many nothing can be done about."""
    kinds = found.select("source_id", F.explode("visual_types").alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("documents")).withColumn("kind", F.lit("type"))
    codes = found.select("source_id", F.explode("reason_codes").alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("documents")).withColumn("kind", F.lit("reason"))
    return kinds.unionByName(codes).select("kind", "name", "documents")
