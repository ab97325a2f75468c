"""Documents that hold every awkward case at once."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, size string, kept string, block string, _dw_open string"
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))


def row(doc_id, text, lang="en", source="s1"):
    return (doc_id, text, lang, source, None, "a", "b", "c", "d", "e")


ROWS = [
    row(1, "Hello there, general reader of these words."), row(2, "hello there, GENERAL reader of these words."), row(3, None, None, None), row(4, ""), row(5, "   \n\t "), row(6, LONG), row(7, LONG + " end"),
    row(8, "one"), row(8, "one"), row(None, "a text without an id", None, "s2"), row(None, None), row(9, "Été à Noël, ÀÉ stays."), row(10, "été à noël, Àé stays."), row(11, "12345 67890 !!!"), row(-4, "negative id"),
    row(12, "one"), row(13, "x" * 5000), row(14, "日本語のテキスト です"), row(15, "One"),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
