"""Queries that run a stream, or decode what drives one, and return what it leaves."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweir.operators import access, generation
from docweir.plans.fixtures import cte, frame
from docweir.plans.registry import query
from docweir.plans.routing import POLICY, ROUTED_SQL, routed
from docweir.shared import qualified, work_dir
from docweir.sources import generations, projects, queue, views
from docweir.streaming import ingest, keyed, metrics


def _stored(spark, sf_dir):
    """Runs documents through a stream into an empty store."""
    where = work_dir(spark, "ingest")
    store = ingest.Store(spark, f"{where}/store")
    schema = views.table(spark, sf_dir, "documents").schema
    # As a pattern, the path may be one file or a folder of files.
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]")
    docs = access.resolve_policy(views.as_sources(stream), frame(spark, "fx_rules"), views.PROJECT)
    ingest.start(docs.drop("doc_id"), store, f"{where}/checkpoint", "run-1").awaitTermination()
    return store


@query("stream_manifest", f"{views.BASE_SQL}, {cte('fx_rules')} SELECT source_id, version, chunk_count, deleted, {POLICY} AS access_policy_id FROM src s WHERE NOT deleted")
def stream_manifest(spark, sf_dir):
    return _stored(spark, sf_dir).manifest.read().select("source_id", "version", "chunk_count", "deleted", "access_policy_id")


@query("stream_chunks", views.BASE_SQL + " SELECT source_id, count(*) AS chunks, min(sha256(project_id || '|' || provider || '|' || source_id || '|' || i)) AS least_id FROM (SELECT *, unnest(range(chunk_count)) AS i FROM src WHERE NOT deleted) GROUP BY source_id")
def stream_chunks(spark, sf_dir):
    return _stored(spark, sf_dir).chunks.read().groupBy("source_id").agg(F.count(F.lit(1)).alias("chunks"), F.min("storage_id").alias("least_id"))


def _purgeable(spark, sf_dir):
    """Manifests of an earlier run, chunks of all documents (some have no manifest row), and all scopes but one as configured."""
    chunks = generation.storage_rows(views.source_documents(spark, sf_dir).withColumn("_n", F.col("chunk_count")))
    manifest = views.manifest(spark, sf_dir)
    return manifest, chunks, manifest.where("scope <> 'src1'").select("project_id", "provider", "scope").distinct()


@query("purge_plan", views.BASE_SQL + """, m AS (SELECT source_id, scope FROM man WHERE provider = 'GITHUB'), c AS (SELECT source_id, chunk_count AS n FROM src WHERE provider = 'GITHUB')
SELECT scope, count(scope) AS sources, CAST(coalesce(sum(n), 0) AS BIGINT) AS chunks, coalesce(scope <> 'src1', false) AS forgotten FROM m FULL JOIN c USING (source_id) GROUP BY scope""")
def purge_plan(spark, sf_dir):
    return generation.purge_plan(*_purgeable(spark, sf_dir), views.PROJECT, "GITHUB")


@query("purged_store", views.BASE_SQL + """ SELECT 'manifest' AS kept, provider, scope, count(*) AS n FROM man WHERE provider <> 'GITHUB' OR scope = 'src1' GROUP BY provider, scope
UNION ALL SELECT 'chunks', provider, NULL, CAST(sum(chunk_count) AS BIGINT) FROM src WHERE provider <> 'GITHUB' GROUP BY provider""")
def purged_store(spark, sf_dir):
    """What a store holds after a provider was purged."""
    manifest, chunks, configured = _purgeable(spark, sf_dir)
    store = ingest.Store(spark, work_dir(spark, "purge"))
    store.manifest.replace(manifest, 0)
    store.chunks.replace(chunks, 0)
    ingest.purge(store, configured, views.PROJECT, "GITHUB", execute=True)
    kept = store.manifest.read().groupBy("provider", "scope").agg(F.count(F.lit(1)).alias("n")).select(F.lit("manifest").alias("kept"), "provider", "scope", "n")
    return kept.unionByName(store.chunks.read().groupBy("provider").agg(F.count(F.lit(1)).alias("n")).select(F.lit("chunks").alias("kept"), "provider", F.lit(None).cast("string").alias("scope"), "n"))


def _in_parts(spark, sf_dir, parts, run):
    """Writes parts of a table one after the other into a folder, and runs a stream over it after each: every part is a batch, and every run a restart."""
    where = work_dir(spark, "stream")
    for k, part in enumerate(parts):
        part.write.parquet(f"{where}/in/part-{k}")
        query = run(ingest.documents(spark, f"{where}/in", part.schema), f"{where}/checkpoint", f"{where}/out")
        query.awaitTermination()
    return spark.read.parquet(f"{where}/out")


def _to_files(stream, checkpoint, out):
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


@query("lease_stream", """WITH RECURSIVE r AS (SELECT event_id, 'user:' || user_id AS scope, event_type AS requester, epoch_us(ts) AS asked, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 2, ts, event_id) AS k FROM events),
f(event_id, scope, requester, k, owner, expires, decision) AS (SELECT event_id, scope, requester, k, requester, asked + 86400000000, 'granted' FROM r WHERE k = 1
 UNION ALL SELECT r.event_id, r.scope, r.requester, r.k, CASE WHEN owner = r.requester OR expires <= asked THEN r.requester ELSE owner END, CASE WHEN owner = r.requester OR expires <= asked THEN asked + 86400000000 ELSE expires END,
  CASE WHEN owner = r.requester THEN 'renewed' WHEN expires <= asked THEN 'taken over' ELSE 'held' END FROM f JOIN r ON r.scope = f.scope AND r.k = f.k + 1)
SELECT event_id AS request_id, scope, requester, decision FROM f""")
def lease_stream(spark, sf_dir):
    """Events as requests for their user's lease of a day; the stream stops and starts again halfway."""
    keyed.prepare(spark)
    e = views.table(spark, sf_dir, "events").select(F.col("event_id").alias("request_id"), F.concat(F.lit("user:"), "user_id").alias("scope"), F.col("event_type").alias("requester"), F.col("ts").cast("timestamp").alias("asked_at"))
    parts = [e.where(F.col("request_id") % 2 == k) for k in (0, 1)]
    return _in_parts(spark, sf_dir, parts, lambda s, checkpoint, out: _to_files(keyed.lease_stream(s, 86_400), checkpoint, out))


@query("manifest_stream", views.BASE_SQL + """ SELECT provider, source_id, CAST(0 AS BIGINT) AS scanned, CASE WHEN deleted THEN 'SKIP' ELSE 'INDEX' END AS operation FROM src
UNION ALL SELECT provider, source_id, 1, CASE WHEN doc_id % 5 = 0 THEN CASE WHEN deleted THEN 'SKIP' ELSE 'DELETE' END WHEN deleted OR doc_id % 7 = 0 THEN 'INDEX' ELSE 'SKIP' END FROM src WHERE doc_id % 3 <> 1""")
def manifest_stream(spark, sf_dir):
    """Two scans of all documents, the second without some, and with some changed, deleted or back; what is known of each is keyed state."""
    keyed.prepare(spark)
    s = views.source_documents(spark, sf_dir).select("doc_id", "provider", "source_id", "version", "deleted", F.lit(0).cast("long").alias("scanned"))
    again = s.where("doc_id % 3 <> 1").withColumns({"version": F.when(F.col("doc_id") % 7 == 0, F.concat("version", F.lit("+"))).otherwise(F.col("version")), "deleted": F.col("doc_id") % 5 == 0, "scanned": F.lit(1).cast("long")})
    return _in_parts(spark, sf_dir, [s, again], lambda st, checkpoint, out: _to_files(keyed.manifest_stream(st), checkpoint, out))


@query("late_event_windows", """SELECT CAST(time_bucket(INTERVAL 1 HOUR, ts) AS TIMESTAMP) AS start, event_type, count(*) AS events FROM events WHERE NOT (event_id % 10 = 0 AND ts < TIMESTAMP '2024-01-10 00:00:00')
GROUP BY 1, 2 HAVING time_bucket(INTERVAL 1 HOUR, min(ts)) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)""")
def late_event_windows(spark, sf_dir):
    """Events in three batches: some of the first ten days come last and are too late, some of the fifteenth come again and count once."""
    e = views.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    day = lambda n: F.lit(f"2024-01-{n} 00:00:00").cast("timestamp")
    late = (F.col("event_id") % 10 == 0) & (F.col("ts") < day(10))
    again = (F.col("ts") >= day(15)) & (F.col("ts") < day(16))
    parts = [e.where(~late & (F.col("ts") < day(16))), e.where((F.col("ts") >= day(16)) & (F.col("ts") < day(24))).unionByName(e.where(again)), e.where((F.col("ts") >= day(24)) | late)]
    return _in_parts(spark, sf_dir, parts, lambda s, checkpoint, out: _to_files(ingest.event_counts(s), checkpoint, out)).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("queue_settlements", """SELECT 'job:' || doc_id AS message_id, CASE doc_id % 10 WHEN 3 THEN 'dead-letter' ELSE 'complete' END AS outcome, CAST(CASE doc_id % 10 WHEN 3 THEN 5 WHEN 5 THEN 3 ELSE 1 END AS INTEGER) AS deliveries FROM documents""")
def queue_settlements(spark, sf_dir):
    """A message for each document. Some fail twice, some always: those are put aside at their fifth delivery."""
    where = work_dir(spark, "queue")
    source, store = queue.Queue(qualified(spark, f"{where}/queue")), ingest.Store(spark, f"{where}/store")
    d = views.table(spark, sf_dir, "documents").select("doc_id", "source")
    source.send(d.select(F.concat(F.lit("job:"), "doc_id").alias("message_id"), F.lit(1).cast("int").alias("deliveries"), F.to_json(F.struct(F.col("source").alias("project_id"), "doc_id")).alias("body")), "first")

    def handle(rows):
        digit = F.get_json_object("body", "$.doc_id").cast("long") % 10
        done = rows.withColumn("ok", (digit != 3) & ~((digit == 5) & (F.col("deliveries") < 3)))
        done.where("ok").select("message_id", "deliveries").write.mode("append").parquet(f"{where}/done")
        return done

    query = ingest.consume(queue.stream(spark, source.folder, 100_000), source, store, handle, f"{where}/checkpoint", "run-1")
    try:
        query.processAllAvailable()  # what is sent again meanwhile, too
    finally:
        query.stop()
    done = spark.read.parquet(f"{where}/done").select("message_id", F.lit("complete").alias("outcome"), "deliveries")
    return done.unionByName(store.dead.read().select("message_id", F.lit("dead-letter").alias("outcome"), "deliveries"))


@query("observed_counters", ROUTED_SQL + """, c AS (SELECT provider, operation, count(*) AS documents, CAST(coalesce(sum(chunk_count) FILTER (operation = 'INDEX'), 0) AS BIGINT) AS chunks FROM r GROUP BY ALL)
SELECT 'documents|' || provider || '|' || operation AS counter, documents AS value FROM c UNION ALL SELECT 'chunks|' || provider || '|INDEX', chunks FROM c WHERE operation = 'INDEX' AND chunks > 0""")
def observed_counters(spark, sf_dir):
    """Counters of a scan, taken as its rows pass on their way to a store; no second scan."""
    meter = metrics.Meter()
    meter.observed(routed(spark, sf_dir)).select("source_id", "operation").write.parquet(f"{work_dir(spark, 'observed')}/routed")
    return spark.createDataFrame([(k, int(v)) for k, v in meter.close().items()], "counter string, value long")


@query("chunk_generations", views.BASE_SQL + " SELECT source_id, count(*) AS chunks, min(sha256(project_id || '|' || provider || '|' || source_id || '|' || i)) AS least_id FROM (SELECT *, unnest(range(chunk_count)) AS i FROM src WHERE NOT deleted) GROUP BY source_id")
def chunk_generations(spark, sf_dir):
    """A generation of all chunks replaces one of some, in two phases."""
    where = qualified(spark, work_dir(spark, "generations"))
    rows = generation.storage_rows(views.source_documents(spark, sf_dir).where("not deleted").withColumn("_n", F.col("chunk_count")))
    generations.replace(rows.where("ordinal = 0"), where)
    generations.replace(rows, where, rows.count())
    stored = generations.Generations(where).read(spark, rows.schema)
    return stored.groupBy("source_id").agg(F.count(F.lit(1)).alias("chunks"), F.min("storage_id").alias("least_id"))


@query("event_windows", "SELECT CAST(time_bucket(INTERVAL 1 HOUR, ts) AS TIMESTAMP) AS start, event_type, count(*) AS events FROM events GROUP BY 1, 2")
def event_windows(spark, sf_dir):
    return ingest.late_events(views.table(spark, sf_dir, "events"))


@query("project_configs", """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 9 <> 0 THEN 'p' || doc_id END AS project_id, coalesce(CASE WHEN doc_id % 2 = 0 THEN source END, 'documents') AS collection, doc_id % 5 <> 1 AS enabled, coalesce(CASE WHEN doc_id % 3 = 1 THEN lang END, 'main') AS branch,
 [384, 768, 1024, 64, 1024][doc_id % 5 + 1] AS dimensions, CASE WHEN doc_id % 4 = 3 THEN 16 ELSE doc_id % 90 END AS batch, doc_id % 3 AS rules FROM documents)
SELECT project_id, collection, enabled, branch, CAST(dimensions AS INTEGER) AS dimensions, CAST(batch AS INTEGER) AS batch, CAST(rules AS INTEGER) AS rules, CASE WHEN project_id IS NULL THEN 'no project' WHEN dimensions = 64 THEN 'dimensions' WHEN batch NOT BETWEEN 1 AND 64 THEN 'batch' END AS fault FROM d""")
def project_configs(spark, sf_dir):
    """A configuration for each document, with fields left out, and values that aren't allowed."""
    d, i = views.table(spark, sf_dir, "documents"), F.col("doc_id")
    rule = F.struct(F.lit("JIRA").alias("provider"), F.col("source").alias("prefix"))
    fields = F.struct(
        F.when(i % 9 != 0, F.concat(F.lit("p"), i)).alias("project_id"), F.when(i % 2 == 0, F.col("source")).alias("collection"), F.struct(F.when(i % 5 == 1, F.lit(False)).alias("enabled"), F.when(i % 3 == 1, F.col("lang")).alias("branch")).alias("schedule"),
        F.struct(F.lit("e5").alias("model"), F.element_at(F.array(*map(F.lit, (384, 768, 1024, 64))), F.when(i % 5 < 4, i % 5 + 1).cast("int")).alias("dimensions")).alias("embedding"), F.when(i % 4 != 3, i % 90).alias("batch"), F.when(i % 3 > 0, F.array_repeat(rule, (i % 3).cast("int"))).alias("rules"),
    )
    return projects.decoded(d.select(F.to_json(fields).alias("payload")))
