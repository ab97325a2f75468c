"""Schemas of the state tables, and their keys."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _B, _I, _TS = T.StringType(), T.BooleanType(), T.LongType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


#: What tells a source apart in manifests, and in stored chunks, which don't know of scopes.
KEY = ["project_id", "provider", "scope", "source_id"]
SOURCE = ["project_id", "provider", "source_id"]
#: What is known of a source after its last run; key: KEY.
MANIFEST = _struct(
    project_id=_S, provider=_S, scope=_S, source_id=_S, source_type=_S, title=_S, source_url=_S, version=_S, content_hash=_S, chunk_count=_I,
    last_seen_run=_S, deleted=_B, parser_version=_S, chunker_version=_S, embedding_profile=_S, schema_version=_S, access_policy_id=_S,
)
#: Stored chunks; key: SOURCE.
CHUNKS = _struct(project_id=_S, provider=_S, source_id=_S, ordinal=_I, storage_id=_S)
#: State that must never share keys with manifests has tables of its own.
CURSOR = _struct(project_id=_S, provider=_S, scope=_S, cursor=_TS)
LEASE = _struct(scope=_S, owner=_S, expires_at=_TS)
QUARANTINE = _struct(project_id=_S, provider=_S, scope=_S, source_id=_S, reason_code=_S, recorded_run=_S)
VOCABULARY = _struct(access_policy_id=_S, entities=T.ArrayType(_S), categories=T.ArrayType(_S), providers=T.ArrayType(_S), languages=T.ArrayType(_S), recorded_run=_S)
DEAD_LETTER = _struct(message_id=_S, project_id=_S, deliveries=T.IntegerType(), recorded_run=_S)
