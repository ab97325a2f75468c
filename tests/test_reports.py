from __future__ import annotations

import json

import pytest

from docweir import reports
from docweir.sources import local


def test_report_is_whole_or_absent(tmp_path):
    path = tmp_path / "out" / "report.json"
    reports.write_report(path, {"b": 1, "a": "é"})
    assert json.loads(path.read_text()) == {"a": "é", "b": 1}
    with pytest.raises(TypeError):
        reports.write_report(path, {"a": object()})
    assert json.loads(path.read_text())["b"] == 1 and [p.name for p in path.parent.iterdir()] == ["report.json"]


def test_contract_digest():
    assert reports.contract(a=1, b=[2])["digest"] == reports.contract(b=[2], a=1)["digest"] != reports.contract(a=2, b=[2])["digest"]


def test_chain_shows_the_first_change():
    events = reports.chained([{"n": i} for i in range(5)])
    assert reports.first_broken(events) is None
    events[2]["n"] = 9
    assert reports.first_broken(events) == 2 and reports.first_broken([]) is None


def test_inventory(spark, tmp_path):
    for name, body in {"a.bin": b"x", "d/b.bin": b"y", "c.bin": b"z"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(body)
    found = local.checksum_inventory(spark, str(tmp_path))
    assert {(r.path, r.bytes) for r in found.collect()} == {("a.bin", 1), ("d/b.bin", 1), ("c.bin", 1)}
    expected = spark.createDataFrame([(r.path, "0" if r.path == "a.bin" else r.sha256) for r in found.where("path <> 'c.bin'").collect()] + [("gone", "1")], "path string, sha256 string")
    assert {(r.path, r.fault) for r in local.inventory_faults(found, expected).collect()} == {("a.bin", "changed"), ("c.bin", "unexpected"), ("gone", "missing")}
