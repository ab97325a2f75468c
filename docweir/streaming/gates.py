"""Gates of event-driven ingestion: what is admitted, and how a message is settled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweir.functions import signatures

# The fields of a message, all of them and no others.
JOB_FIELDS = ("job_id", "mode", "project_id", "provider", "pull_request", "repository", "requested_at")
#: A message that failed on so many deliveries is put aside.
MOST_DELIVERIES = 5


#: Bytes that a webhook's body may have.
MOST_BODY = 1_048_576


def verified(events: DataFrame, secret: bytes, most: int = MOST_BODY) -> DataFrame:
    """Deliveries (header, body) with signature_ok, and what their JSON says of a merge: event stays, action, merged, branch, number, repository."""
    get = lambda path: F.get_json_object("body", path)
    raw = F.col("body").cast("binary")
    return events.withColumns({
        "signature_ok": (F.octet_length(raw) <= most) & signatures.is_signed(F.col("header"), raw, secret), "action": get("$.action"), "merged": F.coalesce(get("$.pull_request.merged") == "true", F.lit(False)),
        "branch": get("$.pull_request.base.ref"), "number": get("$.pull_request.number").try_cast("int"), "repository": get("$.repository.full_name"),
    })


def admission(events: DataFrame) -> DataFrame:
    """Merge events with accepted and the first reason against each. Works on streams as on tables."""
    reason = (
        F.when(~F.col("signature_ok"), "bad signature")
        .when(F.col("event") != "pull_request", "ignored event")
        .when(~F.coalesce((F.col("action") == "closed") & F.col("merged"), F.lit(False)), "not merged")
        .when(~F.col("mapped"), "unmapped repository")
        .when(~F.col("enabled"), "schedule disabled")
        .when(F.col("branch") != F.col("base"), "other branch")
        .when(F.col("number").isNull(), "missing ids")
        .otherwise("accepted")
    )
    return events.withColumn("reason", reason).withColumn("accepted", F.col("reason") == "accepted")


def settlement(messages: DataFrame, most: int = MOST_DELIVERIES) -> DataFrame:
    """Messages (deliveries, ok) with outcome: complete, dead-letter, or abandon, which delivers them again."""
    outcome = F.when(F.col("ok"), "complete").when(F.col("deliveries") >= most, "dead-letter").otherwise("abandon")
    return messages.withColumn("outcome", outcome)


def job_verdict(raw: Column) -> Column:
    """ok, or what is wrong with a queue message."""
    keys = F.json_object_keys(raw)
    exact = F.array_sort(keys) == F.array(*map(F.lit, JOB_FIELDS))
    return F.when(keys.isNull(), "not an object").when(~exact, "wrong fields").otherwise("ok")


def retry_wait(attempt: Column, header: Column, now: Column, most: float = 30.0, longest: float = 60.0) -> Column:
    """Seconds to wait before the next attempt, or null where the service asks for more than longest.

    The header holds seconds or a date; without one that can be read, the wait doubles with each attempt.
    """
    date = F.try_to_timestamp(F.regexp_replace(header, r"^[A-Za-z]{3}, | GMT$", ""), F.lit("dd MMM yyyy HH:mm:ss"))
    asked = F.coalesce(header.try_cast("double"), (F.unix_micros(date) - F.unix_micros(now)) / 1e6)
    return F.when(asked.isNull(), F.least(F.lit(most), F.pow(F.lit(2.0), attempt))).when(asked <= longest, F.greatest(F.lit(0.0), asked))
