from __future__ import annotations

import json

import pytest

from docweir import config
from docweir.operators import issue_documents as docs
from docweir.operators import references
from docweir.plans.fixtures import frame
from docweir.streaming import gates, leases

ISSUE = {
    "key": "SHOP-1",
    "fields": {
        "summary": "Broken", "status": {"id": "3", "name": "Open", "self": "x", "statusCategory": {"key": "new", "colorName": "red"}}, "assignee": {"displayName": "Ada", "avatarUrls": {}}, "labels": ["a"], "duedate": None,
        "components": [{"id": "1", "name": "web", "self": "y"}, "odd"], "customfield_2": {"b": 1, "a": 2}, "customfield_1": None,
        "description": {"type": "doc", "content": [{"type": "paragraph", "content": [{"type": "text", "text": "Folio means a record of a stay"}]}, {"type": "heading", "attrs": {"level": 2}, "content": [{"type": "text", "text": "Acceptance"}]}, {"type": "paragraph", "content": [{"type": "text", "text": "works"}]}]},
        "parent": {"id": "9", "key": "SHOP-9", "fields": {"summary": "Epic"}}, "issuelinks": [{"id": "l1", "type": {"name": "Odd"}}],
    },
    "comments": [{"id": "c1", "body": "seen " * 700, "author": {"displayName": "Bo"}, "created": "2024"}, {"id": "c2", "body": "hidden", "visibility": {"value": "admins"}}],
    "worklogs": [{"id": "w1", "started": "2024", "timeSpent": "2h"}],
}


def given(spark, *issues):
    return spark.createDataFrame([(json.dumps(i) if isinstance(i, dict) else i,) for i in issues], "raw string")


def test_sections(spark):
    found = docs.sections(given(spark, ISSUE), {"customfield_2": "Shade"}).orderBy("pos", "part").collect()
    assert [(r.kind, r.locator) for r in found] == [
        ("CURRENT", "current"), ("DESCRIPTION", "description:intro"), ("ACCEPTANCE", "description:1"), ("GLOSSARY", "glossary:0"), ("RELATIONSHIP", "parent"), ("RELATIONSHIP", "link:l1"),
        ("CUSTOM_FIELD", "customfield_2"), ("COMMENT", "comment:c1"), ("WORKLOG", "worklog:w1"),
    ]
    texts, facts = {r.locator: r.text for r in found}, {r.locator: r.facts for r in found}
    title, label, state = texts["current"].split("\n", 2)
    assert (title, label) == ("SHOP-1: Broken", "Current issue fields:")
    assert json.loads(state) == {"status": {"id": "3", "name": "Open", "statusCategory": {"key": "new"}}, "assignee": {"displayName": "Ada"}, "labels": ["a"], "components": [{"id": "1", "name": "web"}]}
    assert texts["customfield_2"] == 'Shade (customfield_2): {"a":2,"b":1}' and "hidden" not in str(found)
    assert texts["description:1"].startswith("## Acceptance") and texts["glossary:0"] == "Folio means a record of a stay" and facts["glossary:0"] == {"glossary_term": "Folio"}
    assert json.loads(texts["parent"]) == {"relationship": "parent", "issue_id": "9", "issue_key": "SHOP-9", "summary": "Epic"}
    assert json.loads(texts["link:l1"]) == ISSUE["fields"]["issuelinks"][0] == json.loads(facts["link:l1"]["original_relationship"])
    assert texts["comment:c1"].startswith("COMMENT c1; author: Bo; created: 2024; updated: \nseen seen") and facts["comment:c1"]["event_author"] == "Bo"
    assert texts["worklog:w1"] == 'WORKLOG w1; author: ; created: 2024; updated: \n\n{"started":"2024","timeSpent":"2h","timeSpentSeconds":null}'


def test_relations_of_every_shape(spark):
    fields = {
        "subtasks": [{"key": "A-2"}, {"id": "7", "self": "u", "fields": {"status": {"name": "Done"}, "issuetype": {"name": "Task"}}}],
        "issuelinks": [{"id": "1", "type": {"name": "Blocks", "inward": "is blocked by"}, "inwardIssue": {"key": "A-3"}, "outwardIssue": {"key": "A-4"}}],
    }
    found = {r.locator: json.loads(r.text) for r in docs.sections(given(spark, {"key": "A-1", "fields": fields})).where("kind = 'RELATIONSHIP'").collect()}
    assert found == {
        "subtask:A-2": {"relationship": "subtask", "issue_key": "A-2"}, "subtask:7": {"relationship": "subtask", "issue_id": "7", "source_url": "u", "related_issue_status": "Done", "issue_type": "Task"},
        "link:1:inward": {"relationship": "is blocked by", "direction": "inward", "link_id": "1", "issue_key": "A-3"}, "link:1:outward": {"relationship": "Blocks", "direction": "outward", "link_id": "1", "issue_key": "A-4"},
    }


def test_version_follows_content(spark):
    version = lambda issue: docs.issue_documents(docs.sections(given(spark, issue))).first()
    one = version(ISSUE)
    assert one.version.startswith("jira-v2:") and one.failure is None and one.content.startswith("## CURRENT [current]\nSHOP-1: Broken")
    other = json.loads(json.dumps(ISSUE))
    other["comments"][1]["body"] = "still hidden"
    assert version(other).version == one.version
    other["fields"]["labels"] = ["b"]
    assert version(other).version != one.version


def test_windows_and_failures(spark):
    large = json.loads(json.dumps(ISSUE))
    large["fields"]["labels"] = ["x" * 70_000]
    rows = given(spark, ISSUE, "not json", None, large, {"key": "A-1", "fields": {"subtasks": [{}]}}, {"fields": {}}, {"key": "A-2"}, {"key": "A-3", "fields": {}, "comments": [{"body": "x"}]})
    found = docs.issue_windows(rows).collect()
    good = sorted((r for r in found if r.failure is None), key=lambda r: r.ordinal)
    assert {r.issue_key for r in good} == {"SHOP-1"} and [r.ordinal for r in good] == list(range(len(good)))
    comments = [r for r in good if r.kind == "COMMENT"]
    assert len(comments) > 2 and all(len(r.text.split()) <= docs.SHORT for r in comments) and [r.locator for r in comments][:2] == ["comment:c1:1", "comment:c1:2"]
    assert sorted(r.failure for r in found if r.failure) == ["NOT_JSON", "NOT_JSON", "NO_FIELDS", "NO_IDENTITY", "NO_IDENTITY", "NO_KEY", "STATE_TOO_LARGE"]
    assert docs.issue_windows(rows.limit(0)).count() == 0


def test_metadata_of_issues(spark):
    row = docs.issue_metadata(given(spark, ISSUE, "junk")).collect()
    assert len(row) == 1 and (row[0].issue_key, row[0].status, row[0].status_category_key, row[0].assignee, row[0].labels, row[0].parent_issue_key, row[0].components, row[0].priority) == ("SHOP-1", "Open", "new", "Ada", ["a"], "SHOP-9", ["web"], "")


def test_settings_are_refused_together():
    assert config.Settings().embedding_batch == 16
    with pytest.raises(ValueError, match="dimensions.*batch.*overlap"):
        config.Settings(embedding_dimensions=64, embedding_batch=0, overlap_tokens=500)


@pytest.mark.parametrize("keys", [[], ["a-1"], ["A-1", "B-2"], [f"AB-{i}" for i in range(11)]])
def test_targeted_keys(keys):
    assert config.targeted_keys(["AB-1", "AB-2"]) == ["AB-1", "AB-2"]
    with pytest.raises(ValueError):
        config.targeted_keys(keys)


def test_signatures_and_delays(spark):
    from pyspark.sql import functions as F

    header = "sha256=" + __import__("hmac").new(b"k", b"body", "sha256").hexdigest()
    assert config.signed_by(b"k", b"body", header) and not config.signed_by(b"k", b"other", header) and not config.signed_by(b"k", b"body", None)
    asked = spark.createDataFrame([(3, None), (9, "junk"), (0, "12"), (0, "61"), (0, "Mon, 01 Jan 2024 00:00:20 GMT"), (1, "Sun, 31 Dec 2023 23:00:00 GMT"), (1, "Tue, 02 Jan 2024 00:00:00 GMT")], "attempt int, header string")
    waits = asked.select(gates.retry_wait(F.col("attempt"), F.col("header"), F.lit("2024-01-01 00:00:00").cast("timestamp"))).collect()
    assert [r[0] for r in waits] == [8, 30, 12, None, 20, 0, None]


def test_leases_move_on(spark):
    from pyspark.sql import functions as F

    held = spark.createDataFrame([("s1", "w1", "2024-01-01 10:00:00"), ("s2", "w2", "2024-01-01 12:00:00"), ("s3", "w9", "2024-01-01 12:00:00")], "scope string, owner string, expires_at string").withColumn("expires_at", F.col("expires_at").cast("timestamp"))
    asked = spark.createDataFrame([("s1", "w5"), ("s2", "w5"), ("s3", "w9"), ("s4", "w5")], "scope string, requester string").withColumn("asked_at", F.lit("2024-01-01 11:00:00").cast("timestamp"))
    after = {r.scope: (r.owner, str(r.expires_at)) for r in leases.granted(held, leases.decide(held, asked)).collect()}
    assert after == {"s1": ("w5", "2024-01-01 11:15:00"), "s2": ("w2", "2024-01-01 12:00:00"), "s3": ("w9", "2024-01-01 11:15:00"), "s4": ("w5", "2024-01-01 11:15:00")}


def test_a_failing_parser_fails_one_document(spark):
    def parser(body, path):
        if path == "b":
            raise RuntimeError("cannot")
        return [("page:1", body.decode().upper())]

    rows = spark.createDataFrame([("1", "a", bytearray(b"x")), ("2", "b", bytearray(b"y")), ("3", "c", None)], "source_id string, path string, content_bytes binary")
    found = {r.source_id: (r.text, r.warning) for r in references.parsed(rows, parser).collect()}
    assert found == {"1": ("X", None), "2": ("y", "RuntimeError: cannot"), "3": ("", None)}
