from __future__ import annotations

import ast
import sys
from pathlib import Path

import __spark_entry__
from docweir.plans.catalog import QUERIES, SQL

ROOT = Path(__file__).resolve().parents[1]


def test_entry_gives_rows(spark):
    found = __spark_entry__.entry(spark)
    assert found.columns == ["provider", "operation", "reason", "documents"] and found.count() > 3


def test_every_sql_has_its_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries()) and set(SQL) <= set(QUERIES)


def test_the_rest_never_imports_the_corpus_operators():
    for path in [*(ROOT / "docweir").rglob("*.py"), ROOT / "bench.py"]:
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") or n == "corpus_pipeline" for n in names), path


def test_entry_imports_without_them(monkeypatch):
    import builtins
    import importlib

    real = builtins.__import__

    def without(name, globals=None, locals=None, fromlist=(), level=0):
        if name.startswith("docweir.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name, name=name)
        return real(name, globals, locals, fromlist, level)

    monkeypatch.setattr(builtins, "__import__", without)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    alone = importlib.import_module("__spark_entry__")
    assert set(alone.queries()) == set(QUERIES) and set(alone.oracle_sql()) == set(SQL)
