"""Leases of scopes: one writer at a time, and takeover once a lease has run out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HELD = "held"


def decide(leases: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests (scope, requester, asked_at) with decision: granted, renewed, taken over, or held by another.

    Of all that ask for a scope at once, one gets it: the first by asked_at, then by name, to whom it
    is free (nobody has it, it is the requester's own, or it has run out by then). What the same
    requester asks for later in the batch renews it; all others have to ask again.
    """
    lease = leases.select("scope", F.col("owner").alias("_owner"), F.col("expires_at").alias("_expires"))
    joined = requests.join(lease, "scope", "left")
    free = F.col("_owner").isNull() | (F.col("_owner") == F.col("requester")) | (F.col("_expires") <= F.col("asked_at"))
    first = joined.where(free).groupBy("scope").agg(F.min(F.struct("asked_at", "requester")).alias("_first"))
    both = joined.join(first, "scope", "left")
    won = (F.col("_first.requester") == F.col("requester")) & (F.col("asked_at") >= F.col("_first.asked_at"))
    decision = (
        F.when(~F.coalesce(won, F.lit(False)), HELD).when(F.col("asked_at") > F.col("_first.asked_at"), "renewed")
        .when(F.col("_owner").isNull(), "granted").when(F.col("_owner") == F.col("requester"), "renewed").otherwise("taken over")
    )
    return both.select(*requests.columns, decision.alias("decision"))


def granted(leases: DataFrame, decisions: DataFrame, seconds: int = 900) -> DataFrame:
    """The leases after decisions: what was granted, renewed or taken over runs on from its last request; others stay."""
    won = decisions.where(F.col("decision") != HELD).groupBy("scope", F.col("requester").alias("owner")).agg(F.max("asked_at").alias("asked_at"))
    new = won.select("scope", "owner", (F.col("asked_at") + F.make_interval(secs=F.lit(seconds))).alias("expires_at"))
    return leases.join(new.select("scope"), "scope", "left_anti").select("scope", "owner", "expires_at").unionByName(new)


def released(leases: DataFrame, owners: DataFrame) -> DataFrame:
    """The leases without those that their owners (scope, owner) give back; another's lease stays."""
    return leases.join(owners.select("scope", "owner").distinct(), ["scope", "owner"], "left_anti").select("scope", "owner", "expires_at")
