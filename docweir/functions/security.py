"""What must not be stored: blocked types, wrong signatures, credentials. Every finding has a reason code."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweir.functions import paths

# Patterns of credentials, and what a file begins with.
SECRETS = (
    r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
    r"(?i)(?:api[_-]?key|client[_-]?secret|password)\s*[:=]\s*['\x22]?[A-Za-z0-9_./+=-]{16,}",
    r"\bgh[opsu]_[A-Za-z0-9]{30,}\b",
    r"\bAKIA[0-9A-Z]{16}\b",
)
CANDIDATE = r"\b[A-Za-z0-9+/=_-]{40,200}\b"
CITATION = r"https://github\.com/[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+/blob/[0-9a-f]{40}/[A-Za-z0-9_./-]+(?:#L[0-9]+(?:-L[0-9]+)?)?(?=$|[\s)>\]])"
LEAST_ENTROPY = 4.7
SAMPLE = 2_000_000
MOST_BYTES = 25 * 1024 * 1024
SIGNATURES = {".pdf": b"%PDF-", ".docx": b"PK\x03\x04", ".pptx": b"PK\x03\x04", ".xlsx": b"PK\x03\x04"}
OFFICE = (".docx", ".pptx", ".xlsx")
EXECUTABLE = (b"MZ", b"\x7fELF")
ENCRYPTED = b"/Encrypt"
PNG, JPEG, RIFF, WEBP = b"\x89PNG\r\n\x1a\n", b"\xff\xd8\xff", b"RIFF", b"WEBP"


def has_secret(text: Column) -> Column:
    """Whether an explicit credential pattern occurs in the sampled text."""
    sample = F.substring(text, 1, SAMPLE)
    found = sample.rlike(SECRETS[0])
    for pattern in SECRETS[1:]:
        found = found | sample.rlike(pattern)
    return found


def entropy(word: Column) -> Column:
    """Shannon entropy of a word's characters, in bits."""
    n = F.length(word)
    letters = F.filter(F.split(word, ""), lambda c: c != "")
    parts = F.transform(F.array_distinct(letters), lambda c: (n - F.length(F.replace(word, c, F.lit("")))) / n)
    return F.aggregate(parts, F.lit(0.0), lambda total, p: total - p * F.log2(p))


def apart(text: Column) -> Column:
    """text with immutable source citations taken apart at their slashes; one that climbs out of its tree stays whole."""
    between, cited = F.split(text, CITATION, -1), F.regexp_extract_all(text, F.lit(f"({CITATION})"), F.lit(1))
    climbs = lambda c: F.exists(F.split(c, "/"), lambda part: part.isin(".", ".."))
    opened = F.transform(cited, lambda c: F.when(climbs(c), c).otherwise(F.replace(c, F.lit("/"), F.lit(" "))))
    joined = F.array_join(F.transform(F.arrays_zip(between.alias("b"), opened.alias("c")), lambda x: F.concat(x["b"], F.coalesce(x["c"], F.lit("")))), "")
    return F.when(text.contains("/blob/"), joined).otherwise(text)


def candidates(text: Column) -> Column:
    """Words long enough to be a token, with immutable source citations taken apart first."""
    return F.regexp_extract_all(apart(F.substring(text, 1, SAMPLE)), F.lit(f"({CANDIDATE})"), F.lit(1))


def high_entropy(text: Column) -> Column:
    return F.exists(candidates(text), lambda w: w.rlike("[0-9]") & (entropy(w) >= LEAST_ENTROPY))


def signature_reason(suffix: Column, payload: Column) -> Column:
    """What a binary payload shows against its extension, or null."""
    wrong = F.lit(False)
    for extension, magic in SIGNATURES.items():
        wrong = wrong | ((suffix == extension) & ~F.startswith(payload, F.lit(magic)))
    executable = F.startswith(payload, F.lit(EXECUTABLE[0])) | F.startswith(payload, F.lit(EXECUTABLE[1]))
    locked = (suffix == ".pdf") & F.contains(payload, F.lit(ENCRYPTED))
    return F.when(wrong, "MIME_MISMATCH").when(executable, "EXECUTABLE_CONTENT").when(locked, "PASSWORD_PROTECTED")


def is_raster(payload: Column) -> Column:
    """PNG, JPEG or WebP, by how it begins."""
    webp = F.startswith(payload, F.lit(RIFF)) & (F.substring(payload, 9, 4) == F.lit(WEBP))
    return F.startswith(payload, F.lit(PNG)) | F.startswith(payload, F.lit(JPEG)) | webp


def visuals_reason(visuals: Column, most_bytes: int = MOST_BYTES) -> Column:
    """What is wrong with any of a document's linked pictures (an array of their bytes), or null."""
    return F.when(F.exists(visuals, lambda v: F.octet_length(v) > most_bytes), "FILE_TOO_LARGE").when(F.exists(visuals, lambda v: ~is_raster(v)), "MIME_MISMATCH")


def sampled(payload: Column) -> Column:
    """The first bytes of a payload as text; bytes that aren't UTF-8 are left out, so what stands on both sides of them meets."""
    return F.replace(F.make_valid_utf8(F.substring(payload, 1, SAMPLE).cast("string")), F.lit("\ufffd"), F.lit(""))


def quarantine(docs: DataFrame, most_bytes: int = MOST_BYTES, binary: bool = True, scanner: Callable[[bytes], bool] | None = None) -> DataFrame:
    """docs (provider, path, content, content_bytes) with reason_code (null: clean) and sensitive.

    Reasons are tested in order and the first counts. A local source with credentials is marked
    sensitive, and not quarantined. Bodies may be any bytes: what isn't text is passed over. Three more
    columns are looked at where docs have them: visuals (bytes of linked pictures), unverified (a Jira
    document cites a reference that isn't pinned), and metadata (JSON; every key and value of a Jira
    document is scanned, and too much nesting refused). scanner tells whether bytes hold malware.
    Without binary bodies (binary=False) and metadata no Python runs.
    """
    from docweir.functions import richtext

    suffix, payload, columns = paths.suffix(F.col("path")), F.col("content_bytes"), docs.columns
    text = F.coalesce(F.when(payload.isNotNull(), sampled(payload)), F.col("content"))
    outside = F.col("provider") != "LOCAL"
    unverified = (F.col("provider") == "JIRA") & F.coalesce("unverified", F.lit(False)) if "unverified" in columns else F.lit(False)
    found = {"_secret": F.coalesce(has_secret(text), F.lit(False)), "_dense": F.coalesce(high_entropy(text), F.lit(False)), "_malware": F.lit(False), "_office": F.lit(None).cast("string"), "_fields": F.lit(None).cast("string")}
    if "metadata" in columns:
        found["_fields"] = richtext.values_reason(F.when(F.col("provider") == "JIRA", F.col("metadata")))
    if binary:
        found["_office"] = richtext.container_reason(F.when(suffix.isin(*OFFICE), payload), suffix)
    if scanner is not None:
        found["_malware"] = F.coalesce(richtext.scanned(scanner)(payload), F.lit(False))
        if "visuals" in columns:
            found["_malware"] = found["_malware"] | F.coalesce(richtext.any_scanned(scanner)("visuals"), F.lit(False))
    docs = docs.withColumns(found).withColumn("sensitive", F.col("_secret") | F.col("_dense") | F.coalesce(F.col("_fields") == "POTENTIAL_SECRET", F.lit(False)))
    signature = F.when(payload.isNotNull(), signature_reason(suffix, payload))
    reason = F.coalesce(
        F.when(suffix.isin(*paths.BLOCKED), "BLOCKED_FILE_TYPE"),
        F.when(F.octet_length(payload) > most_bytes, "FILE_TOO_LARGE"),
        F.when(signature == "MIME_MISMATCH", signature),
        F.when(payload.isNotNull(), F.col("_office")),
        signature,
        F.when(F.col("_malware"), "MALWARE_DETECTED"),
        F.when(F.col("_secret") & outside, "POTENTIAL_SECRET"),
        F.when(unverified, "UNVERIFIED_SOURCE_REFERENCE"),
        F.when(F.col("_dense") & outside, "POTENTIAL_SECRET"),
        F.col("_fields"),
        visuals_reason(F.col("visuals"), most_bytes) if "visuals" in columns else F.lit(None).cast("string"),
    )
    return docs.withColumn("reason_code", reason).drop(*found)
