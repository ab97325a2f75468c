"""Access policies: the first rule, by ordinal, whose prefix one of a document's values starts with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What rules may name.
PROVIDERS = ("CONFLUENCE", "JIRA", "GITHUB")
MATCH_FIELDS = ("TITLE", "SPACE_KEY", "LABEL", "PATH")
#: Rules are configuration, so their number is small; more than this is refused rather than broadcast.
MOST_RULES = 10_000


def resolve_policy(docs: DataFrame, rules: DataFrame, project_id: str) -> DataFrame:
    """docs (provider, title, space_key, path, labels array) with access_policy_id; unmatched ones are the project's.

    A document is not held against the rules: its values' beginnings, of each length that a prefix has,
    are looked up. A set of all prefixes tells most beginnings apart at once, and only what is in it
    is looked for among the rules. Nothing is shuffled or joined, work for a document grows with the
    number of different lengths, and the plan stays as deep as it is however many rules there are.
    """
    found = rules.orderBy("ordinal").limit(MOST_RULES + 1).collect()
    if len(found) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} access rules")
    first: dict[str, tuple[int, str]] = {}
    lengths: dict[str, set[int]] = {}
    for place, rule in enumerate(found):
        if None not in (rule["provider"], rule["prefix"]) and rule["match_field"] in MATCH_FIELDS:
            first.setdefault(f"{rule['provider']}|{rule['match_field']}|{rule['prefix']}", (place, rule["access_policy_id"]))
            lengths.setdefault(rule["match_field"], set()).add(len(rule["prefix"]))
    project = F.lit(f"project:{project_id}")
    if not first:
        return docs.withColumn("access_policy_id", project)

    def beginnings(field: str, value: Column) -> Column:
        """A value's beginnings as keys; of one that is shorter than a length, the value itself."""
        key = F.concat("provider", F.lit(f"|{field}|"))
        return F.transform(F.array(*map(F.lit, sorted(lengths[field]))), lambda n: F.concat(key, F.substr(value, F.lit(1), n)))

    values = {"TITLE": "title", "SPACE_KEY": "space_key", "PATH": "path"}
    lists = [beginnings(f, F.coalesce(c, F.lit(""))) for f, c in values.items() if f in lengths]
    if "LABEL" in lengths:
        labels = F.coalesce("labels", F.array().cast("array<string>"))
        lists.append(F.flatten(F.transform(labels, lambda x: beginnings("LABEL", x))))
    known = F.filter(F.concat(*lists), lambda k: k.isin(*first))
    table = F.map_from_arrays(F.array(*map(F.lit, first)), F.array(*(F.struct(F.lit(n).alias("place"), F.lit(p).alias("policy")) for n, p in first.values())))
    least = F.array_min(F.transform(known, lambda k: F.try_element_at(table, k)))
    return docs.withColumn("access_policy_id", F.when(F.size(known) > 0, F.coalesce(least["policy"], project)).otherwise(project))


def rule_errors(rules: DataFrame, project_id: str) -> DataFrame:
    """rules with error: the first thing wrong with each, or null."""
    department = f"department:{project_id}:"
    own = (F.col("access_policy_id") == f"project:{project_id}") | F.col("access_policy_id").rlike(f"^{department}[A-Z0-9_]{{2,64}}$")
    error = (
        F.when(~F.col("provider").isin(*PROVIDERS), "unsupported provider")
        .when(~F.col("match_field").isin(*MATCH_FIELDS), "unsupported match field")
        .when(F.coalesce("prefix", F.lit("")) == "", "empty prefix")
        .when(~own, "policy of another project")
    )
    return rules.withColumn("error", error)
