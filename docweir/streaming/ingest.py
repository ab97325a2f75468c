"""Ingestion of document streams: each micro-batch is routed, stored and committed like a scan."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docweir import schemas
from docweir.operators import generation, routing, vocabulary
from docweir.shared import stored
from docweir.sources import queue
from docweir.sources.tables import StateTable
from docweir.streaming import gates, leases, metrics

#: Files of a micro-batch, so that a backlog is taken in steps.
MOST_FILES = 256


class Store:
    """Where results and state are kept. Chunks are written before manifests, so a crash repeats work and loses none."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        table = lambda name, schema, keys: StateTable(spark, f"{path}/{name}", schema, keys)
        self.chunks = table("chunks", schemas.CHUNKS, schemas.SOURCE)
        self.manifest = table("manifest", schemas.MANIFEST, schemas.KEY)
        self.cursors = table("cursors", schemas.CURSOR, schemas.KEY[:-1])
        self.quarantine = table("quarantine", schemas.QUARANTINE, schemas.KEY)
        self.leases = table("leases", schemas.LEASE, ["scope"])
        self.dead = table("dead", schemas.DEAD_LETTER, ["message_id"])
        self.vocabulary = table("vocabulary", schemas.VOCABULARY, ["access_policy_id"])


def _upsert(table: StateTable, rows: DataFrame, token: int, writer: str) -> bool:
    return table.rewrite(rows, lambda old: old.join(rows.select(*table.keys), table.keys, "left_anti").unionByName(rows), token, writer)


class Incomplete(RuntimeError):
    """Not all chunks of a generation were found where they had been written; the one before still counts."""


def _whole(new: DataFrame) -> Callable[[DataFrame], None]:
    """A check that all of new is found in what was written."""

    def check(written: DataFrame) -> None:
        facts = generation.verified(new, written).head()
        if facts["expected"] != facts["written"]:
            raise Incomplete(f"{facts['written']} of {facts['expected']} chunks were written")

    return check


def apply(store: Store, docs: DataFrame, token: int, run: str, writer: str = "", meter: metrics.Meter | None = None) -> None:
    """Routes docs against the manifest, replaces the chunks of what changed, then commits. A token that its writer has applied is passed over.

    Routing and commit are about the same state of the manifest: where another writer has changed it
    in between, that is a Conflict, and the batch is to be applied again. Chunks are looked for where
    they were written before the old ones go.

    docs have the manifest's columns and the fences' current values, one row per source; of a source
    that comes more than once in a batch the row that was updated last counts. Only buckets that hold
    one of the batch's sources are read and written.
    """
    state = store.manifest.state()
    if state["tokens"].get(writer, -1) >= token:
        return
    order = F.struct(*(F.col(c) for c in ("updated_at", "version") if c in docs.columns))
    one = docs.groupBy(*routing.KEY).agg(F.max_by(F.struct(*docs.columns), order).alias("d")).select("d.*").persist()
    routed = routing.route(one, store.manifest.near(one, state)).persist()
    try:
        touched = routed.where("operation <> 'SKIP'")
        rows = touched.withColumn("_n", F.when(F.col("operation") == "INDEX", F.col("chunk_count")).otherwise(0))
        new, sources = generation.storage_rows(rows), touched.select(*schemas.SOURCE).distinct()
        store.chunks.rewrite(sources, lambda old: generation.replaced(old, new, sources), None, writer, check=_whole(new))
        store.manifest.rewrite(one, lambda old: routing.commit(old, meter.observed(routed) if meter else routed, run), token, writer, state)
    finally:
        routed.unpersist()
        one.unpersist()


def advance(store: Store, outcomes: DataFrame, token: int, writer: str = "") -> None:
    """Stores the cursor of every scope (project_id, provider, scope) whose documents (updated_at, failed) all went well.

    A scope with a failure keeps its cursor, so that the next run reads it again; a cursor never goes back.
    """
    scope = schemas.KEY[:-1]
    seen = outcomes.groupBy(*scope).agg(F.max("updated_at").alias("cursor"), F.count_if("failed").alias("failures")).where("failures = 0 and cursor is not null").drop("failures")
    seen = seen.persist()
    try:
        store.cursors.rewrite(seen, lambda old: old.unionByName(seen).groupBy(*scope).agg(F.max("cursor").alias("cursor")), token, writer)
    finally:
        seen.unpersist()


def put_aside(store: Store, judged: DataFrame, token: int, run: str, writer: str = "") -> DataFrame:
    """Stores why documents with a reason_code are quarantined; returns the others, which go on."""
    bad = judged.where("reason_code is not null").select(*schemas.KEY, "reason_code", F.lit(run).alias("recorded_run")).dropDuplicates(schemas.KEY)
    _upsert(store.quarantine, bad, token, writer)
    return judged.where("reason_code is null")


def acquire(store: Store, requests: DataFrame, token: int, writer: str = "", seconds: int = 900) -> DataFrame:
    """Decides on requests (scope, requester, asked_at) for leases, and stores what is granted; returns requests with decision.

    What is stored is compared with what was decided on: of two processes that read the same state,
    one gets a Conflict, and asks again. A token that was seen is answered from what is stored.
    """
    state = store.leases.state()
    held = store.leases.near(requests, state)
    if state["tokens"].get(writer, -1) >= token:
        mine = (F.col("owner") == F.col("requester")) & (F.col("asked_at") < F.col("expires_at"))
        answer = F.when(F.coalesce(mine, F.lit(False)), "renewed").otherwise(leases.HELD)
        return requests.join(held, "scope", "left").select(*requests.columns, answer.alias("decision"))
    decisions = leases.decide(held, requests)
    store.leases.rewrite(requests, lambda old: leases.granted(old, decisions, seconds), token, writer, state)
    return decisions


def release(store: Store, owners: DataFrame, token: int, writer: str = "") -> bool:
    """Gives leases (scope, owner) back; one that is another's by now stays."""
    return store.leases.rewrite(owners, lambda old: leases.released(old, owners), token, writer)


def publish_vocabulary(store: Store, chunks: DataFrame, token: int, run: str, writer: str = "") -> bool:
    """Stores what stored chunks talk about, a row a policy; policies that no chunk has any longer go.

    A policy whose values are as they were keeps the run that recorded them.
    """
    state = store.vocabulary.state()
    found = stored(vocabulary.by_policy(chunks))
    known = store.vocabulary.read()
    values = [c for c in schemas.VOCABULARY.fieldNames() if c not in ("access_policy_id", "recorded_run")]

    def change(old: DataFrame) -> DataFrame:
        before = old.select("access_policy_id", F.struct(*values).alias("_values"), F.col("recorded_run").alias("_run"))
        same = F.struct(*values).eqNullSafe(F.col("_values"))
        return found.join(before, "access_policy_id", "left").withColumn("recorded_run", F.when(same, F.col("_run")).otherwise(F.lit(run))).drop("_values", "_run")

    keys = found.select("access_policy_id").unionByName(known.select("access_policy_id")).distinct()
    return store.vocabulary.rewrite(keys, change, token, writer, state)


def purge(store: Store, scopes: DataFrame, project: str, provider: str, execute: bool = False, writer: str = "") -> DataFrame:
    """The plan of purging a provider of a project (generation.purge_plan); only with execute, what it says is done.

    Chunks go before manifests: a crash between leaves manifests that the next purge finds, and no
    chunk that a search could still deliver. Doing it twice changes nothing. Another writer's change
    in the meantime is a Conflict.
    """
    mine = (F.col("project_id") == project) & (F.col("provider") == provider)
    plan = stored(generation.purge_plan(store.manifest.read(), store.chunks.read(), scopes, project, provider))
    if execute:
        sources = stored(store.chunks.read().where(mine).select(*schemas.SOURCE).distinct())
        store.chunks.rewrite(sources, lambda old: old.join(sources, schemas.SOURCE, "left_anti"), None, writer)
        known = store.manifest.read().where(mine).join(scopes, schemas.KEY[:-1], "left_semi")
        keys = stored(known.select(*schemas.KEY).distinct())
        store.manifest.rewrite(keys, lambda old: old.join(keys, schemas.KEY, "left_anti"), None, writer)
    return plan


def settle(store: Store, messages: DataFrame, token: int, run: str, writer: str = "") -> DataFrame:
    """Stores messages (message_id, project_id, deliveries, ok) that failed too often; returns those that are delivered again."""
    again, aside = dead_letter(messages, gates.settlement(messages))
    _upsert(store.dead, aside.select("message_id", "project_id", "deliveries", F.lit(run).alias("recorded_run")).dropDuplicates(["message_id"]), token, writer)
    return again


def consume(messages: DataFrame, source: queue.Queue, store: Store, handle: Callable[[DataFrame], DataFrame], checkpoint: str, run: str) -> StreamingQuery:
    """A stream of a queue's messages: handle gives them an outcome each (ok), and they are settled.

    What failed is sent again with one more delivery, or put aside after too many. All of it happens
    before the batch counts as done, and doing it twice changes nothing, so a crash at any point
    repeats a batch and loses no message.
    """
    spark = messages.sparkSession

    def batch(rows: DataFrame, number: int) -> None:
        writer = writer_of(spark, checkpoint)
        done = stored(handle(rows))
        again = settle(store, done.withColumn("project_id", F.coalesce(F.get_json_object("body", "$.project_id"), F.lit(""))), number, run, writer)
        source.send(again.select("message_id", (F.col("deliveries") + 1).cast("int").alias("deliveries"), "body"), f"{writer}.{number}".replace("-", ""))

    return messages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).start()


def documents(spark: SparkSession, path: str, schema: T.StructType, most_files: int = MOST_FILES) -> DataFrame:
    """A stream of the Parquet files at path, at most most_files a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).option("recursiveFileLookup", "true").parquet(path)


def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """What tells a stream from any other: the id that its checkpoint holds. Batches are numbered anew in each checkpoint."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def start(stream: DataFrame, store: Store, checkpoint: str, run: str) -> StreamingQuery:
    """A stream of documents into a store, as far as there is input; it takes up where the checkpoint says."""
    spark = stream.sparkSession

    def batch(docs: DataFrame, number: int) -> None:
        apply(store, docs, number, run, writer_of(spark, checkpoint))

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dead_letter(messages: DataFrame, settled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages that are delivered again, and those put aside."""
    joined = messages.join(settled.select("message_id", "deliveries", "outcome").distinct(), ["message_id", "deliveries"])
    return joined.where("outcome = 'abandon'"), joined.where("outcome = 'dead-letter'")


def distinct_events(events: DataFrame, delay: str = "1 day", key: str = "event_id") -> DataFrame:
    """A stream of events (ts) without repeats that come within the delay of the first; what is later than the delay is left out by what follows."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def event_counts(events: DataFrame, delay: str = "1 day", width: str = "1 hour") -> DataFrame:
    """Counts of distinct events (event_id, ts, event_type) in tumbling windows, each emitted once, when its window can get no more."""
    windows = distinct_events(events, delay).groupBy(F.window("ts", width).alias("w"), "event_type")
    return windows.agg(F.count(F.lit(1)).alias("events")).select(F.col("w.start").alias("start"), "event_type", "events")


def late_events(events: DataFrame, delay: str = "5 minutes", width: str = "1 hour") -> DataFrame:
    """Counts of events (ts, event_type) in tumbling windows; what comes later than the delay after a window has closed isn't counted in a stream."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("events")).select(F.col("w.start").alias("start"), "event_type", "events")
