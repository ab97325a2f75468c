"""Column functions over paths, URLs and times."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which files are read, which are looked at only as pictures, which are never read.
INDEXABLE = (".java", ".js", ".kt", ".kts", ".md", ".markdown", ".txt", ".csv", ".html", ".htm", ".pdf", ".docx", ".pptx", ".xlsx", ".py", ".sql", ".ts", ".tsx", ".xml", ".yaml", ".yml")
VISUAL = (".png", ".jpg", ".jpeg", ".webp")
BINARY = (".pdf", ".docx", ".pptx", ".xlsx")
BLOCKED = (".7z", ".bat", ".cmd", ".com", ".dll", ".dmg", ".docm", ".exe", ".gz", ".iso", ".jar", ".jsm", ".msi", ".pptm", ".rar", ".scr", ".tar", ".vbs", ".xlsm", ".zip")

_SUFFIX = r"[^/](\.[^./]+)$"


def suffix(path: Column) -> Column:
    """The last extension, lower-cased; of a name that only begins with a dot, none."""
    return F.lower(F.regexp_extract(path, _SUFFIX, 1))


def suffix_sql(path: str) -> str:
    return f"lower(regexp_extract({path}, '[^/](\\.[^./]+)$', 1))"


def beside(path: Column, target: Column) -> Column:
    """target against the folder of path, without empty, `.` and `..` parts; null where it climbs out of the tree."""
    parts = F.split(F.concat(F.regexp_extract(path, "(?s)^(.*/)?", 0), target), "/")

    def step(at: Column, part: Column) -> Column:
        up = F.when(F.size(at) > 0, F.slice(at, 1, F.greatest(F.size(at) - 1, F.lit(0))))
        return F.when(part.isin("", "."), at).when(part == "..", up).otherwise(F.concat(at, F.array(part)))

    walked = F.aggregate(parts, F.array().cast("array<string>"), step)
    return F.when(walked.isNotNull(), F.array_join(walked, "/"))


def is_indexable(path: Column) -> Column:
    return suffix(path).isin(*INDEXABLE)


def _names(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def indexable_sql(path: str) -> str:
    return f"{suffix_sql(path)} IN {_names(INDEXABLE)}"


def kind_of_file(path: Column) -> Column:
    """blocked, binary, text, visual or other, by extension."""
    s = suffix(path)
    return F.when(s.isin(*BLOCKED), "blocked").when(s.isin(*BINARY), "binary").when(s.isin(*INDEXABLE), "text").when(s.isin(*VISUAL), "visual").otherwise("other")


def kind_of_file_sql(path: str) -> str:
    s = suffix_sql(path)
    return f"CASE WHEN {s} IN {_names(BLOCKED)} THEN 'blocked' WHEN {s} IN {_names(BINARY)} THEN 'binary' WHEN {s} IN {_names(INDEXABLE)} THEN 'text' WHEN {s} IN {_names(VISUAL)} THEN 'visual' ELSE 'other' END"


def glob_regex(pattern: str) -> str:
    """A regular expression for a path glob: ** spans directories, * and ? don't.

    A leading **/ may match nothing, and a trailing /** also matches the directory itself.
    """
    body, ahead, behind = pattern.strip(), "", ""
    if body.startswith("**/"):
        body, ahead = body[3:], "(?:[^/]+/)*"
    if body.endswith("/**"):
        body, behind = body[:-3], "(?:/.*)?"
    pieces = {"**/": "(?:[^/]+/)*", "**": ".*", "*": "[^/]*", "?": "[^/]"}
    middle = re.sub(r"\*\*/|\*\*|\*|\?|[^*?]+", lambda m: pieces.get(m[0]) or re.escape(m[0]), body)
    return f"^{ahead}{middle}{behind}$"


def matches_glob(path: Column, pattern: str) -> Column:
    return F.trim(path, F.lit("/")).rlike(glob_regex(pattern))


# Directories that are never read, wherever they stand in a path, and what files of secrets end with.
CLOSED_DIRS = ("node_modules", "vendor", ".gradle", "build", "dist", "secrets")
CLOSED_ENDS = (".pem", ".key", ".p12", ".pfx")


def is_sensitive(path: Column) -> Column:
    """Paths that are never read: .env files, keys, and what is in a closed directory, by either kind of slash."""
    parts = F.split(F.translate(F.lower(path), "\\", "/"), "/")
    name = F.element_at(parts, -1)
    ends = F.lit(False)
    for end in CLOSED_ENDS:
        ends = ends | name.endswith(end)
    return name.startswith(".env") | ends | F.exists(parts, lambda p: p.isin(*CLOSED_DIRS))


def is_allowed(path: Column, include: tuple[str, ...] = (), exclude: tuple[str, ...] = ()) -> Column:
    """Paths that a repository's configuration lets through: not sensitive, in an included glob if there are any, and in no excluded one."""
    wanted, refused = F.lit(not include), F.lit(False)
    for pattern in include:
        wanted = wanted | matches_glob(path, pattern)
    for pattern in exclude:
        refused = refused | matches_glob(path, pattern)
    return ~is_sensitive(path) & wanted & ~refused


def changed_since(updated: Column, threshold: Column) -> Column:
    """Not before the threshold; what has no time is taken as changed, and so is everything without a threshold."""
    return updated.isNull() | threshold.isNull() | (updated >= threshold)


def iso_time(value: Column) -> Column:
    """ISO 8601 to a timestamp; without a zone it is UTC (the session's zone), and what can't be read is null."""
    return F.try_to_timestamp(value)


def jql_minute(value: Column) -> Column:
    """A time as search queries write it: UTC, seconds cut off."""
    return F.date_format(value, "yyyy-MM-dd HH:mm")


def search(project: Column, since: Column) -> Column:
    """The search for a project's issues since a time (null: all), in a stable order. Quotes and backslashes are escaped."""
    quoted = F.regexp_replace(project, r'(["\\\\])', r"\\$1")
    when = F.when(since.isNull(), "").otherwise(F.concat(F.lit(' AND updated >= "'), jql_minute(since), F.lit('"')))
    return F.concat(F.lit('project = "'), quoted, F.lit('"'), when, F.lit(" ORDER BY updated ASC, key ASC"))
