from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweir.llm import lm_scoring
from tests.llm.conftest import LONG, ROWS


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def plain(rows, prior, order):
    """The same model by dictionaries: recursion over histories in place of an automaton."""
    counts, texts = [Counter() for _ in range(order)], []
    for doc_id, text in rows:
        x = ["<begin>", *(text or "").encode().lower().split(), "<end>"]
        texts.append((doc_id, x))
        if not held(doc_id):
            for p in range(len(x)):
                for k in range(min(order, p + 1)):
                    counts[k][tuple(x[p - k : p + 1])] += 1
    single = {t: c for (t,), c in counts[0].items() if t != "<begin>"}
    tokens, types = sum(single.values()), len(single)

    def p(history, token):
        if not history:
            return (single.get(token, 0) + 1) / (tokens + types + 1)
        m = prior[len(history) - 1]
        return (counts[len(history)][(*history, token)] + m * p(history[1:], token)) / (counts[len(history) - 1][history] + m)

    for doc_id, x in texts:
        base = sum(math.log10(p((), t)) for t in x[1:])
        whole = sum(math.log10(p(tuple(x[max(0, i - order + 1) : i]), x[i])) for i in range(1, len(x)))
        yield doc_id, held(doc_id), len(x) - 1, sum(t in single for t in x[1:]), tokens, base, whole


def same(found, expected):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    found, expected = sorted(map(tuple, found), key=key), sorted(expected, key=key)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    assert np.allclose([r[5:] for r in found], [r[5:] for r in expected], rtol=1e-10, atol=1e-12)


def held_column():
    return lm_scoring.id_crc(F.col("doc_id")) % 7 == 2


def test_the_query_equals_a_model_of_dictionaries(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    same(lm_scoring.op12_lm_scoring(spark, small).collect(), plain(rows, lm_scoring.PRIOR, lm_scoring.ORDER))


@pytest.mark.parametrize("order, prior", [(1, ()), (2, (5.0,)), (3, (5.0, 1.0)), (4, (9.0, 3.0, 0.5))])
def test_orders_blocks_and_lanes(spark, edge, monkeypatch, order, prior):
    monkeypatch.setattr(lm_scoring, "LANE", 50)
    monkeypatch.setattr(lm_scoring, "OWNED", 1000)
    found = lm_scoring.score(edge, held_column(), order=order, prior=prior, block=40_000)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    same(found.collect(), plain([(r[0], r[1]) for r in ROWS], prior, order))


def test_probabilities_sum_up_to_one():
    texts = [b"a b a c".split(), b"b b a".split(), b"c".split()]
    words = sorted({w for t in texts for w in t} | {lm_scoring.END_WORD})
    digest = lambda w: lm_scoring.xxhash.xxh64_intdigest(w)
    for history in ([], [b"a"], [b"a", b"b"], [b"b", b"b"], [b"c", b"unheard"]):
        total = 0.0
        for last in [*words, b"unknown"]:
            asked = [*texts, [*history, last]]
            hashes = np.array([digest(w) for t in asked for w in (lm_scoring.START_WORD, *t, lm_scoring.END_WORD)], np.uint64)
            begins = np.cumsum([0, *(len(t) + 2 for t in asked[:-1])])
            grams = lm_scoring.grams_of(hashes, begins, 3)
            trained = np.arange(len(hashes)) < begins[-1]
            counts = [np.bincount(g.at[g.at >= 0], trained[g.at >= 0], len(g.keys)) for g in grams]
            model = lm_scoring.smoothed(grams, counts, int(trained.sum()) - 3, len(words), (4.0, 2.0))
            total += 10 ** lm_scoring.traversed(model, grams, begins)[begins[-1] + 1 + len(history)]
        assert total == pytest.approx(1)


def test_whole_numbers_survive_packing():
    rng = np.random.default_rng(1)
    for x in (np.empty(0, np.uint64), rng.integers(0, 1 << 63, 100).astype(np.uint64), np.arange(5, dtype=np.uint64) << np.uint64(61)):
        assert (lm_scoring.unpacked(lm_scoring.packed(x)) == x).all()


def test_awkward_tables(spark, edge, nothing):
    assert lm_scoring.score(nothing, held_column()).count() == 0
    untrained = lm_scoring.score(edge, F.lit(True)).collect()
    assert all(r.train_tokens == r.n_known == 0 and r.base_score == r.score == 0 for r in untrained) and len(untrained) == len(ROWS)
    all_of_it = lm_scoring.score(edge, F.lit(None).cast("boolean")).collect()
    assert not any(r.held_out for r in all_of_it) and max(r.n_tokens for r in all_of_it) == len(LONG.split()) + 2
    with pytest.raises(ValueError, match="order 3 has 2 priors"):
        lm_scoring.score(edge, held_column(), prior=(1.0,))
