"""Issues and their children as tables: restricted rows, sections, relationships, richness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweir.functions import text

MOST_ATTACHMENT = 25 * 1024 * 1024
_RELATED = "struct<id:string,key:string,self:string,fields:struct<summary:string,issuetype:struct<name:string>,status:struct<name:string>>>"
FIELDS = f"parent {_RELATED}, subtasks array<{_RELATED}>, issuelinks array<struct<id:string,type:struct<name:string,inward:string,outward:string>,inwardIssue:{_RELATED},outwardIssue:{_RELATED}>>"


def visible(events: DataFrame) -> DataFrame:
    """Events without a visibility restriction."""
    return events.where("visibility is null")


def restricted_counts(issues: DataFrame, events: DataFrame) -> DataFrame:
    """Per project: issues, and how many issues and events are held back as restricted."""
    held = events.where("visibility is not null").groupBy("issue_key").agg(F.count(F.lit(1)).alias("held"))
    joined = issues.join(held, "issue_key", "left")
    return joined.groupBy("project_key").agg(F.count(F.lit(1)).alias("issues"), F.count_if(F.col("security").isNotNull()).alias("restricted_issues"), F.coalesce(F.sum("held"), F.lit(0)).alias("restricted_events"))


def attachments(issues: DataFrame, most: int = MOST_ATTACHMENT) -> DataFrame:
    """(issue_key, attachment_id, outcome): an attachment without a whole-number size, or above the limit, is excluded."""
    rows = issues.select("issue_key", F.explode(F.from_json("attachments_json", "array<struct<id:string,size:string>>")).alias("a"))
    size = F.col("a.size").try_cast("long")
    return rows.select("issue_key", F.col("a.id").alias("attachment_id"), F.when(size.isNull(), "unknown size").when(size > most, "too large").otherwise("read").alias("outcome"))


def relationships(issues: DataFrame) -> DataFrame:
    """(issue_key, locator, relationship, related_key): parent, subtasks, and either end of links.

    A link that has neither end is kept with its type's name, so nothing is lost.
    """
    f = issues.select("issue_key", F.from_json("fields_json", FIELDS).alias("f"))
    parent = f.where("f.parent is not null").select("issue_key", F.lit("parent").alias("locator"), F.lit("parent").alias("relationship"), F.col("f.parent.key").alias("related_key"))
    subtasks = f.select("issue_key", F.explode("f.subtasks").alias("s")).select("issue_key", F.concat(F.lit("subtask:"), F.coalesce("s.id", "s.key")).alias("locator"), F.lit("subtask").alias("relationship"), F.col("s.key").alias("related_key"))
    links = f.select("issue_key", F.explode("f.issuelinks").alias("l"))
    parts = [parent, subtasks]
    for direction in ("inward", "outward"):
        end = F.col(f"l.{direction}Issue")
        parts.append(links.where(end.isNotNull()).select("issue_key", F.concat(F.lit("link:"), "l.id", F.lit(f":{direction}")).alias("locator"), F.coalesce(f"l.type.{direction}", "l.type.name", F.lit(direction)).alias("relationship"), end["key"].alias("related_key")))
    bare = links.where("l.inwardIssue is null and l.outwardIssue is null")
    parts.append(bare.select("issue_key", F.concat(F.lit("link:"), "l.id").alias("locator"), F.coalesce("l.type.name", F.lit("link")).alias("relationship"), F.lit(None).cast("string").alias("related_key")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def richest(issues: DataFrame, events: DataFrame, most: int) -> DataFrame:
    """The issues with most to show: attachments, then comments, then a parent, then the later key."""
    comments = events.where("kind = 'COMMENT'").select("issue_key").distinct().withColumn("_c", F.lit(True))
    joined = issues.join(comments, "issue_key", "left").withColumns({
        "has_attachment": F.coalesce("attachments_json", F.lit("[]")) != "[]", "has_comment": F.coalesce("_c", F.lit(False)), "has_parent": F.get_json_object("fields_json", "$.parent.key").isNotNull(),
    })
    return joined.orderBy(F.desc("has_attachment"), F.desc("has_comment"), F.desc("has_parent"), F.desc("issue_key")).limit(most)


def timelines(issues: DataFrame, events: DataFrame) -> DataFrame:
    """issues with their visible events in order, as one text: what an issue's history says."""
    shown = visible(events).groupBy("issue_key").agg(F.array_sort(F.collect_list(F.struct("created", "event_id", "kind", "body"))).alias("e"))
    lines = F.transform("e", lambda x: F.concat_ws(" ", x["kind"], x["event_id"], x["body"]))
    return issues.join(shown, "issue_key", "left").select("issue_key", F.coalesce(F.size("e"), F.lit(0)).cast("long").alias("events"), F.coalesce(F.concat_ws("; ", lines), F.lit("")).alias("timeline"))


def custom_fields(values: DataFrame, names: DataFrame) -> DataFrame:
    """Custom field values with their display names; an unnamed field goes by its id."""
    return values.join(names, "field_id", "left").withColumn("name", F.coalesce("name", "field_id"))


def granted_providers(asked: Column, known: Column) -> Column:
    """The providers that a run reads: those asked for that the project has, in any case of letters, once each; null asks for all."""
    return F.when(asked.isNull(), known).otherwise(F.array_intersect(F.transform(asked, F.upper), known))


def page_faults(pages: DataFrame) -> DataFrame:
    """What breaks the promises of a paged listing: totals that move, ids that repeat, rows that are missing."""
    rows = pages.groupBy("listing").agg(F.min("total").alias("low"), F.max("total").alias("high"), F.count(F.lit(1)).alias("rows"), F.countDistinct("item_id").alias("items"))
    fault = F.when(F.col("low") != F.col("high"), "total changed").when(F.col("items") != F.col("rows"), "repeated id").when(F.col("rows") != F.col("high"), "incomplete")
    return rows.select("listing", "rows", "items", fault.alias("fault"))


def bound_assets(elements: DataFrame, assets: DataFrame) -> DataFrame:
    """Elements with the assets of their page; assets without a page belong to the first element.

    Two equal joins, so neither side is compared with all of the other.
    """
    paged = elements.where("page is not null").join(assets.where("page is not null"), ["source_id", "page"]).select("source_id", "ordinal", "asset_id")
    loose = elements.where("ordinal = 0").join(assets.where("page is null").drop("page"), "source_id").select("source_id", "ordinal", "asset_id")
    return paged.unionByName(loose)


def torn_reads(listing: DataFrame, details: DataFrame) -> DataFrame:
    """Issues (issue_key, updated) that changed between being listed and being read, or that weren't read at all: they must be read again."""
    read = details.select("issue_key", F.col("updated").alias("_read"))
    joined = listing.join(read, "issue_key", "left")
    return joined.where(~F.col("updated").eqNullSafe(F.col("_read"))).select("issue_key", F.when(F.col("_read").isNull(), "not read").otherwise("changed meanwhile").alias("fault"))


def wiki_attachments(items: DataFrame, site: str, most: int = MOST_ATTACHMENT) -> DataFrame:
    """Attachments of wiki pages (listing, item as JSON) as documents without their bodies: source_id, title, version, media_type, page_id, size, download, outcome.

    A known size above the limit, and a missing link, exclude one; an unknown size is looked at again when the body has come.
    """
    at = lambda *paths: F.coalesce(*(F.get_json_object("item", p) for p in paths))
    size = F.coalesce(at("$.fileSize").try_cast("long"), at("$.extensions.fileSize").try_cast("long"))
    link = at("$.downloadLink", "$._links.download")
    own = at("$.id")
    return items.select(
        F.concat(F.lit("attachment:"), own).alias("source_id"), F.coalesce(at("$.title"), own).alias("title"), at("$.version.number", "$.version.createdAt", "$.version.when", "$.id").alias("version"),
        F.coalesce(at("$.metadata.mediaType", "$.mediaType"), F.lit("application/octet-stream")).alias("media_type"), F.coalesce(at("$.pageId", "$.container.id"), F.lit("")).alias("page_id"),
        size.alias("size"), F.when(F.coalesce(link, F.lit("")) != "", text.absolute_link(F.lit(site), link)).alias("download"),
        F.when(size > most, "too large").when(F.coalesce(link, F.lit("")) == "", "no link").otherwise("read").alias("outcome"),
    )


def downloaded(attachments: DataFrame, bodies: DataFrame, most: int = MOST_ATTACHMENT) -> DataFrame:
    """Attachments to be read with their bodies (source_id, content_bytes), but for ones that turn out too large."""
    wanted = attachments.where("outcome = 'read'").join(bodies, "source_id")
    return wanted.where(F.octet_length("content_bytes") <= most).withColumn("size", F.coalesce("size", F.octet_length("content_bytes").cast("long")))
