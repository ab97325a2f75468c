"""Wiki pages as a connector hands them on: which are within the roots, which changed, and which were read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweir.functions import formats, paths
from docweir.operators import routing


def page_labels(labels: DataFrame) -> DataFrame:
    """(page_id, labels) of (page_id, label): trimmed, distinct and in order; blank ones don't count."""
    own = F.nullif(F.trim("label"), F.lit(""))
    return labels.groupBy("page_id").agg(F.array_sort(F.collect_set(own)).alias("labels"))


def changed(pages: DataFrame, attachments: DataFrame, labels: DataFrame, roots: DataFrame | list[str], since: Column) -> DataFrame:
    """(page_id, source_id, kind, labels) of what is to be read: pages below the roots that changed since a time, and their attachments.

    pages have page_id, parent_id, updated_at; attachments have attachment_id, page_id, updated_at. An
    attachment is looked at on its own time, whether or not its page changed. What has no time counts
    as changed. Pages are known to the roots by the tree, so nothing is walked page by page.
    """
    inside = routing.roots_subtree(pages, roots).select("page_id")
    now = paths.changed_since(F.col("updated_at"), since)
    known = pages.where(now).join(inside, "page_id", "left_semi").join(page_labels(labels), "page_id", "left")
    read = known.select("page_id", F.col("page_id").alias("source_id"), F.lit("page").alias("kind"), F.coalesce("labels", F.array().cast("array<string>")).alias("labels"))
    files = attachments.where(now).join(inside, "page_id", "left_semi")
    return read.unionByName(files.select("page_id", F.concat(F.lit("attachment:"), "attachment_id").alias("source_id"), F.lit("attachment").alias("kind"), F.array().cast("array<string>").alias("labels")))


def refetched(configured: DataFrame, fetched: DataFrame) -> DataFrame:
    """(page_id, fault) of every configured page (page_id), after a second fetch (page_id asked for, returned_id, body); null: it is there.

    A page that was asked for more than once, or that comes back as another or without a body, is a
    fault; so is one that doesn't come back. Of several answers for a page the worst counts.
    """
    asked = configured.groupBy("page_id").agg(F.count(F.lit(1)).alias("_asked"))
    body = F.coalesce(formats.stripped(F.col("body")), F.lit(""))
    answers = fetched.groupBy("page_id").agg(F.bool_or(~F.col("page_id").eqNullSafe(F.col("returned_id"))).alias("_other"), F.bool_or(body == "").alias("_empty"))
    fault = F.when(F.col("_asked") > 1, "configured twice").when(F.col("_other").isNull(), "not fetched").when(F.col("_other"), "another page").when(F.col("_empty"), "empty body")
    return asked.join(answers, "page_id", "left").select("page_id", fault.alias("fault"))
