from __future__ import annotations

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweir.functions import richtext
from docweir.functions.paths import glob_regex
from docweir.operators import chunkers

WORDS = st.lists(st.sampled_from(["a", "bb.", "c,", "d\n", "e\n\n", "f;"]), max_size=300).map(" ".join)


@given(st.lists(st.integers(0, 30), max_size=60), st.integers(1, 40))
def test_packed_runs_are_greedy(costs, budget):
    runs = chunkers.packed(costs, budget)
    assert [i for a, b in runs for i in range(a, b)] == list(range(len(costs)))
    for (a, b), after in zip(runs, [*runs[1:], None]):
        assert b - a == 1 or sum(costs[a:b]) <= budget
        assert after is None or sum(costs[a : b + 1]) > budget


@given(WORDS, st.integers(4, 50))
@settings(max_examples=60, deadline=None)
def test_windows_without_overlap_are_the_text(text, budget):
    windows = chunkers.prose_windows(text, budget, 0)
    assert " ".join(windows).split() == text.split() and all(chunkers.words(w) <= budget for w in windows)


@given(WORDS, st.integers(8, 50), st.integers(0, 20))
@settings(max_examples=60, deadline=None)
def test_overlapping_windows_go_forward_and_reach_the_end(text, budget, overlap):
    windows = chunkers.prose_windows(text, budget, overlap)
    assert len(windows) <= len(text.split()) + 1 and (not windows or windows[-1].split()[-1:] == text.split()[-1:])


@given(st.lists(st.lists(st.text("abc ", max_size=6), min_size=2, max_size=5), min_size=1, max_size=12), st.integers(3, 30))
@settings(max_examples=60, deadline=None)
def test_table_windows_keep_every_row(rows, budget):
    lines = ["| h1 | h2 |", "|---|---|", *("| " + " | ".join(r) + " |" for r in rows)]
    windows = chunkers.table_windows(lines, budget)
    assert [r for w in windows for r in w.split("\n")[2:]] == lines[2:] and all(w.startswith("\n".join(lines[:2])) for w in windows)


@given(st.text("ab|\n", max_size=80))
def test_blocks_keep_every_line(text):
    assert [row for _, rows in chunkers.blocks(text) for row in rows] == text.splitlines()
    assert all(len(rows) > 1 and all(r.count("|") >= 2 for r in rows) for table, rows in chunkers.blocks(text) if table)


@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=5), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(max_size=3), x, max_size=4), max_leaves=20))
def test_canonical_json_reads_back(value):
    text = richtext.canonical(value)
    assert json.loads(text) == value and richtext.canonical(json.loads(text)) == text


@given(st.lists(st.text("aB3dE5fG7hI9jK1lM2nO4pQ6rS8tU0vW3xY5zA7bC9 .", max_size=60), max_size=12))
def test_spans_lie_in_runs_and_reach_borders(parts):
    text, borders = "".join(parts), {sum(len(p) for p in parts[:i]) for i in range(len(parts) + 1)}
    for a, b in richtext.spans(text, [len(p) for p in parts]):
        assert b - a >= 40 and not set(text[a:b]) & set(" .")
        assert a in borders or a == 0 or text[a - 1] in " ." and b in borders | {len(text)} or text[b] in " ."
    whole = any(richtext.dense(text[a:b]) for a in borders for b in borders if a < b and b - a <= 200)
    assert not whole or richtext.dealt(parts)


@given(st.text("ab/*?.", max_size=12))
def test_globs_always_compile(pattern):
    import re

    re.compile(glob_regex(pattern))


@given(st.text(max_size=200))
@settings(deadline=None)
def test_html_never_fails(text):
    assert isinstance(chunkers.html_markdown(f"<p>{text}</p>"), str)


def test_rows_are_python_objects_a_few_at_a_time():
    import pyarrow as pa

    from docweir.functions import batches

    wide, small = pa.array(["x" * n for n in (10, 3_000_000, 0, 600_000, 600_000, *[5] * 300)]), pa.array([None] * 305, pa.int32())
    parts = batches.slices([wide, small])
    assert [at for at, _ in parts] == [0, *(at + n for at, n in parts)][:-1] and sum(n for _, n in parts) == 305
    assert all(n == 1 or (n <= batches.MOST_ROWS and wide.slice(at, n).nbytes <= batches.MOST_BYTES) for at, n in parts)
    assert batches.slices([wide.slice(0, 0)]) == []


def test_functions_of_rows_keep_order_and_nulls(spark):
    from docweir.functions import batches, richtext

    joined = batches.per_row(lambda a, b: None if a is None else f"{a}{'' if b is None else len(b)}", T.StringType())
    rows = spark.range(1000).select("id", joined(F.when(F.col("id") % 7 != 0, F.col("id")), F.when(F.col("id") % 3 != 0, F.encode(F.col("id").cast("string"), "utf-8"))).alias("v"))
    assert [r.v for r in rows.orderBy("id").collect()] == [None if i % 7 == 0 else f"{i}{len(str(i)) if i % 3 else ''}" for i in range(1000)]
    assert spark.range(0).select(joined("id", F.lit(b"x"))).collect() == []
    assert spark.range(1).select(richtext.rich_text(F.lit(None).cast("string")), richtext.heading_digest(F.lit(None).cast("array<string>"))).first()[:2] == (None, None)
