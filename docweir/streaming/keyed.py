"""Keyed state in streams: one value for each key, kept by the engine's state store, with timers that clear what has run out."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: What keeps state that a processor declares.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> None:
    """Streams with processors need a state store that has columns for each of their values."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


class LeaseKeeper(StatefulProcessor):
    """Requests for a scope's lease, answered one after the other, in the order of asked_at within a batch.

    The lease is the key's value. Decisions compare request times, and so are the same whenever the
    stream runs; a timer removes a lease once the watermark says that nothing older than its end can come.
    """

    def __init__(self, seconds: int = 900) -> None:
        self.micros = seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lease = handle.getValueState("lease", "owner string, expires long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        asked = pd.concat(list(rows)).sort_values(["asked", "request_id"], kind="stable")
        owner, expires = self.lease.get() if self.lease.exists() else (None, 0)
        decisions = []
        for requester, at in zip(asked["requester"], asked["asked"].tolist()):
            if owner is None or owner == requester or expires <= at:
                decisions.append("granted" if owner is None else "renewed" if owner == requester else "taken over")
                owner, expires = requester, at + self.micros
            else:
                decisions.append("held")
        self.lease.update((owner, expires))
        self._remind(timerValues, expires)
        yield pd.DataFrame({"request_id": asked["request_id"], "scope": key[0], "requester": asked["requester"], "decision": decisions})

    def _remind(self, timerValues, expires: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(max(-(-expires // 1000), timerValues.getCurrentWatermarkInMs() + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.lease.clear()
        return iter(())

    def close(self) -> None:
        pass


def lease_stream(requests: DataFrame, seconds: int = 900, delay: str = "60 days") -> DataFrame:
    """A stream of requests (request_id, scope, requester, asked_at) with their decisions; the scope's lease is state.

    What comes later than the delay isn't answered.
    """
    rows = requests.withWatermark("asked_at", delay).selectExpr("request_id", "scope", "requester", "asked_at", "unix_micros(asked_at) AS asked")
    kinds = dict(rows.dtypes)
    return rows.groupBy("scope").transformWithStateInPandas(LeaseKeeper(seconds), f"request_id {kinds['request_id']}, scope {kinds['scope']}, requester string, decision string", "Append", "EventTime")


class ManifestKeeper(StatefulProcessor):
    """What is known of a source is the key's value: its version and whether it is deleted. Every scan of it gets its operation.

    Keys are many and have few rows each, so they are rows and no data frames, and a key's state is asked for once.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("manifest", "version string, deleted boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        provider, source_id = key
        version, deleted = self.known.get() or (None, True)
        out = []
        for scanned, now, gone in sorted(((r.scanned, r.version, r.deleted) for r in rows), key=lambda r: r[0]):
            out.append(Row(provider=provider, source_id=source_id, scanned=scanned, operation=("SKIP" if deleted else "DELETE") if gone else "INDEX" if deleted or version != now else "SKIP"))
            version, deleted = now, gone
        self.known.update((version, deleted))
        yield from out

    def close(self) -> None:
        pass


def manifest_stream(scans: DataFrame) -> DataFrame:
    """A stream of scans (provider, source_id, version, deleted, scanned long) with operation: INDEX, DELETE or SKIP; the last version of a source is state."""
    rows = scans.select("provider", "source_id", "version", "deleted", "scanned")
    return rows.groupBy("provider", "source_id").transformWithState(ManifestKeeper(), "provider string, source_id string, scanned long, operation string", "Append", "none")
