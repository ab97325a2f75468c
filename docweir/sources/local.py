"""A directory tree as source documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweir.functions import formats, paths

MOST_BYTES = 1_000_000
# Code and build configuration that a local scan reads, prose that it leaves to the wiki, and folders that it doesn't walk.
SOURCE = (
    ".kt", ".kts", ".java", ".py", ".js", ".jsx", ".ts", ".tsx", ".go", ".rs", ".swift", ".m", ".mm", ".c", ".h", ".cc", ".cpp", ".hpp", ".cs", ".rb", ".php", ".sh", ".bash", ".zsh", ".sql",
    ".gradle", ".toml", ".yaml", ".yml", ".json", ".xml", ".properties", ".proto", ".graphql", ".tf",
)
PROSE = (".md", ".markdown", ".txt", ".rst", ".adoc", ".docx", ".pdf")
SKIPPED = (
    ".git", ".gradle", ".idea", ".venv", "venv", "env", "__pycache__", "node_modules", "build", "out", "dist", ".dart_tool", ".kotlin", "DerivedData", ".mypy_cache", ".pytest_cache",
    ".ruff_cache", ".terraform",
)
EXCLUDED = ("**/project-documentation/**", "**/config/detekt/**")


def is_walked(path: Column, excludes: tuple[str, ...] = EXCLUDED) -> Column:
    """Paths below no skipped folder and in no excluded glob."""
    allowed = ~F.exists(F.split(path, "/"), lambda p: p.isin(*SKIPPED))
    for pattern in excludes:
        allowed = allowed & ~paths.matches_glob(path, pattern)
    return allowed


def is_source(path: Column) -> Column:
    return paths.suffix(path).isin(*SOURCE)


def is_prose(path: Column) -> Column:
    """Files that a caller might expect, and that a local scan refuses on purpose."""
    return paths.suffix(path).isin(*PROSE)


def _files(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = F.regexp_replace(F.lit(root.rstrip("/") + "/"), "^file:/*", "/")
    return files.withColumn("path", F.expr("regexp_replace(path, '^file:/*', '/')")).withColumn("path", F.substr("path", F.length(base) + 1))


def scan_tree(spark: SparkSession, root: str, excludes: tuple[str, ...] = EXCLUDED, most_bytes: int = MOST_BYTES, name: str = "tree", branch: str = "main") -> DataFrame:
    """Readable source files under root: source_id, path, version, content, content_hash.

    Files that are too large, of a type that isn't read, in a skipped folder, excluded, not UTF-8 or
    blank are left out. What can be told from the listing is filtered before any file is opened.
    """
    return readable(_files(spark, root), excludes, most_bytes, name, branch)


def readable(files: DataFrame, excludes: tuple[str, ...] = EXCLUDED, most_bytes: int = MOST_BYTES, name: str = "tree", branch: str = "main") -> DataFrame:
    """What a scan takes of files (path, length, content as bytes)."""
    files = files.where((F.col("length") <= most_bytes) & is_source(F.col("path")) & is_walked(F.col("path"), excludes))
    text = F.try_validate_utf8(F.col("content").cast("string"))
    read = files.select("path", text.alias("content"), F.sha2("content", 256).alias("content_hash"))
    kept = read.where(F.col("content").isNotNull() & (formats.stripped(F.col("content")) != ""))
    return kept.select(F.concat(F.lit(f"local:{name}:{branch}:"), "path").alias("source_id"), "path", F.col("content_hash").alias("version"), "content", "content_hash")


def passed_over(spark: SparkSession, root: str, excludes: tuple[str, ...] = EXCLUDED) -> DataFrame:
    """How many prose files a scan of root passes over, by suffix; none is opened."""
    return prose_counts(_files(spark, root), excludes)


def prose_counts(files: DataFrame, excludes: tuple[str, ...] = EXCLUDED) -> DataFrame:
    """How many of files (path) are prose that is passed over, by suffix."""
    files = files.where(is_prose(F.col("path")) & is_walked(F.col("path"), excludes))
    return files.groupBy(paths.suffix(F.col("path")).alias("suffix")).agg(F.count(F.lit(1)).alias("files"))


class Truncated(RuntimeError):
    """A listing that says of itself that it isn't whole."""


def repository_files(listing: DataFrame, include: tuple[str, ...] = (), exclude: tuple[str, ...] = (), most_bytes: int = MOST_BYTES) -> DataFrame:
    """What is read of a repository's tree (path, type, size, truncated): blobs of a type that is read or looked at, small and allowed.

    A tree that was cut off is refused: what it lacks would be taken for deleted.
    """
    if listing.where("truncated").limit(1).count():
        raise Truncated("the repository's tree was cut off")
    kind = paths.kind_of_file(F.col("path"))
    return listing.where((F.col("type") == "blob") & (F.col("size") <= most_bytes) & kind.isin("text", "binary", "visual") & paths.is_allowed(F.col("path"), include, exclude)).withColumn("kind", kind)


def checksum_inventory(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes, sha256) of every file under root: what a run's contract or a model's files consist of."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = F.regexp_replace(F.lit(root.rstrip("/") + "/"), "^file:/*", "/")
    path = F.regexp_replace("path", "^file:/*", "/")
    return files.select(F.substr(path, F.length(base) + 1).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def inventory_faults(found: DataFrame, expected: DataFrame) -> DataFrame:
    """Files that are missing, unexpected, or of another checksum than expected (path, sha256)."""
    joined = found.select("path", F.col("sha256").alias("_found")).join(expected.select("path", F.col("sha256").alias("_expected")), "path", "full")
    fault = F.when(F.col("_found").isNull(), "missing").when(F.col("_expected").isNull(), "unexpected").when(F.col("_found") != F.col("_expected"), "changed")
    return joined.select("path", fault.alias("fault")).where("fault is not null")
