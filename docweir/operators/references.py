"""References between documents and repositories: linked images, pinned files, binary bodies."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweir.functions import paths, text
from docweir.functions.batches import slices

# Fixed values.
RASTER = (".png", ".jpg", ".jpeg", ".webp")
BLOB = r"https://github\.com/([A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+)/blob/([0-9a-f]{40})/([A-Za-z0-9_./-]+)"
LEAST_SIDE, LEAST_AREA = 64, 16_384


def local_targets(docs: DataFrame) -> DataFrame:
    """(source_id, path, target) of the safe image targets in docs (source_id, path, content)."""
    found = F.regexp_extract_all("content", F.lit(text.MARKDOWN_IMAGE), F.lit(1))
    rows = docs.select("source_id", "path", F.explode(F.array_distinct(found)).alias("target"))
    rows = rows.withColumn("target", F.regexp_replace(F.trim("target"), r"\s.*$", ""))
    return rows.where(~text.unsafe_target(F.col("target")))


def resolved(path: Column, target: Column) -> Column:
    """The target against the folder of the document; null where it climbs out or isn't a raster image."""
    out = paths.beside(path, target)
    return F.when(paths.suffix(out).isin(*RASTER), out)


def linked_images(docs: DataFrame, listing: DataFrame) -> DataFrame:
    """Resolved image links of docs, with the sha of the listed file, or null where the listing lacks it."""
    links = local_targets(docs).select("source_id", resolved(F.col("path"), F.col("target")).alias("image")).where("image is not null").distinct()
    return links.join(listing.select(F.col("path").alias("image"), "sha"), "image", "left").select("source_id", "image", "sha")


def linked_version(version, shas):
    """A version that also changes with the linked images; without any it stays as it is."""
    return F.when(F.size(shas) > 0, F.sha2(F.concat_ws("|", version, F.concat_ws("|", F.array_sort(shas))), 256)).otherwise(version)


#: Bytes that a pinned file may have.
MOST_PINNED = 4_000_000


def pinned(docs: DataFrame, pins: DataFrame, files: DataFrame) -> DataFrame:
    """Repository references in docs (project_id, source_id, content) against pins and the files that are there: one row each, with reason (null: verified).

    pins are approved: project_id, repository, sha, path, digest. files are what is under the approved
    roots now: repository, path, digest, size. Reasons are tested in order and the first counts: the
    path climbs, the pin belongs to another project, nothing is pinned, the file isn't there, it is too
    large, or its content differs from what was pinned. Both joins are by repository and path, so each
    document's text is read once.
    """
    matches = F.arrays_zip(*(F.regexp_extract_all("content", F.lit(BLOB), F.lit(i)).alias(n) for i, n in ((1, "repository"), (2, "sha"), (3, "path"))))
    refs = docs.select("project_id", "source_id", F.explode(matches).alias("m")).select("project_id", "source_id", "m.repository", "m.sha", "m.path").distinct()
    owned = pins.select("repository", "sha", "path", F.col("project_id").alias("_project"), F.col("digest").alias("_expected")).groupBy("repository", "sha", "path").agg(F.collect_set(F.struct("_project", "_expected")).alias("_pins"))
    there = files.select("repository", "path", F.col("digest").alias("_digest"), F.col("size").alias("_size"))
    joined = refs.join(owned, ["repository", "sha", "path"], "left").join(there, ["repository", "path"], "left")
    own = F.filter("_pins", lambda p: p["_project"] == F.col("project_id"))
    climbs = F.exists(F.split("path", "/"), lambda part: part.isin("", ".", ".."))
    reason = (
        F.when(climbs, "invalid path").when(F.col("_pins").isNull(), "not pinned").when(F.size(own) == 0, "another project's").when(F.col("_digest").isNull(), "unavailable")
        .when(F.col("_size") > MOST_PINNED, "too large").when(~F.exists(own, lambda p: p["_expected"] == F.col("_digest")), "content differs")
    )
    return joined.select("project_id", "source_id", "repository", "path", reason.alias("reason"))


def is_meaningful(width, height):
    """Large enough not to be an ornament."""
    return (width >= LEAST_SIDE) & (height >= LEAST_SIDE) & (width * height >= LEAST_AREA)


def parsed(docs: DataFrame, parser: Callable[[bytes, str], list[tuple[str, str]]] | None = None) -> DataFrame:
    """(source_id, ordinal, locator, text, warning) of binary bodies (source_id, path, content_bytes).

    parser gives (locator, text) elements of a body; by default, or where it fails, the body is read
    as UTF-8 text and the warning says why. One body's failure is its own.
    """

    def read(source: str, path: str, body: bytes | None) -> list[tuple]:
        body, warning, elements = body or b"", None, None
        if parser is not None:
            try:
                elements = parser(body, path)
            except Exception as error:  # noqa: BLE001  (whatever a parser raises is that document's failure)
                warning = f"{type(error).__name__}: {error}"[:200]
        if elements is None:
            elements, warning = [("", body.decode("utf-8", "ignore"))], warning or "no parser"
        return [(source, i, locator, value, warning) for i, (locator, value) in enumerate(elements)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string())
        for batch in batches:
            for at, n in slices(batch.columns):
                rows = [r for body in zip(*(c.to_pylist() for c in batch.slice(at, n).columns)) for r in read(*body)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds)], names=["source_id", "ordinal", "locator", "text", "warning"])

    return docs.select(F.col("source_id").cast("string").alias("source_id"), "path", "content_bytes").mapInArrow(run, "source_id string, ordinal int, locator string, text string, warning string")
