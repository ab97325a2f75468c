from __future__ import annotations

from decimal import Decimal

import numpy as np
import pytest

from docweir.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, component string, n string, whitened string, node string"


def rows_of(vectors, first=0):
    return [(first + i, v, 0, "a", "b", "c", "d") for i, v in enumerate(vectors)]


def plain(vectors, components=8):
    """Eigenvectors of the covariance at once; whitened values, shares, exact deviations."""
    x = np.floor(1024 * np.array(vectors, np.float32).astype(float)).astype(int) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return centred @ vectors[:, :components] / np.sqrt(values[:components]), values[:components] / values.sum(), [sum(int(v) ** 2 for v in n * r - sums) for r in x.astype(object)]


def test_the_query_equals_one_decomposition(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet").orderBy("vec_id").collect()
    white, shares, deviation = plain([r.embedding for r in table])
    found = whitening.op11_whitening(spark, small).orderBy("vec_id", "component").collect()
    assert len(found) == 8 * len(table) and {r.n for r in found} == {len(table)}
    got = np.array([r.whitened for r in found]).reshape(-1, 8)
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got - white * signs).max() < 1e-8
    assert np.allclose([r.explained for r in found[:8]], shares, rtol=1e-10) and [r.deviation for r in found[::8]] == deviation
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


def test_summaries_merge_in_any_order_without_loss():
    rng = np.random.default_rng(3)
    x = rng.integers(90_000, 110_000, (500, 6)) + np.arange(500)[:, None] * 40
    whole = whitening.summarised(x)
    parts = [whitening.summarised(p) for p in np.array_split(x, [1, 3, 200, 204, 480])]
    left = parts[0]
    for p in parts[1:]:
        left = whitening.merged(left, p)
    right = whitening.merged(whitening.merged(parts[3], parts[5]), whitening.merged(whitening.merged(parts[1], parts[0]), whitening.merged(parts[4], parts[2])))
    for other in (left, right):
        assert other.n == whole.n and (other.sums == whole.sums).all()
        assert np.allclose(other.factor.T @ other.factor, whole.factor.T @ whole.factor, rtol=1e-12)
        assert np.allclose(np.linalg.svd(other.factor)[1], np.linalg.svd(whole.factor)[1], rtol=1e-12)


def test_a_tree_of_several_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "ROWS", 7)
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(150, 5)).astype(np.float32).tolist()
    white, shares, _ = plain(vectors, 5)
    found = whitening.whiten(spark.createDataFrame(rows_of(vectors), SCHEMA).repartition(9)).orderBy("vec_id", "component").collect()
    got = np.array([r.whitened for r in found]).reshape(-1, 5)
    assert np.abs(np.abs(got) - np.abs(white)).max() < 1e-8 and np.allclose([r.explained for r in found[:5]], shares)


def test_awkward_rows(spark):
    rng = np.random.default_rng(5)
    good = rng.normal(size=(40, 4)).astype(np.float32).tolist()
    bad = [None, [], [None, 1.0, 2.0, 3.0], [float("nan"), 1.0, 2.0, 3.0], [float("inf"), 1.0, 2.0, 3.0], [1.0, 2.0], [1e30, 1.0, 1.0, 1.0]]
    table = [*rows_of(good), *rows_of(bad, 100), *rows_of([good[0], good[0]], 200), (None, good[1], 0, "", "", "", "")]
    found = whitening.whiten(spark.createDataFrame(table, SCHEMA)).collect()
    white, _, deviation = plain([*good, good[0], good[0], good[1]])
    assert len(found) == 4 * 43 and {r.vec_id for r in found} == {*range(40), 200, 201, None}
    one = {(r.vec_id, r.component): r for r in found}
    assert one[200, 1].whitened == pytest.approx(one[0, 1].whitened) and one[None, 2].whitened == pytest.approx(one[1, 2].whitened)
    assert one[3, 1].deviation == Decimal(deviation[3]) and abs(one[3, 1].whitened) == pytest.approx(abs(white[3, 0]))


def test_directions_that_the_data_lack_and_tables_without_rows(spark):
    flat = [[float(i), 2.0 * i, 5.0] for i in range(20)]
    found = whitening.whiten(spark.createDataFrame(rows_of(flat), SCHEMA)).collect()
    assert {r.component for r in found} == {1} and found[0].explained == pytest.approx(1)
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for table in ([], rows_of([None, [float("nan")]]), rows_of([[1.0, 2.0]] * 5)):
        out = whitening.whiten(spark.createDataFrame(table, SCHEMA))
        assert out.columns == columns and out.count() == 0


def test_deviations_beyond_64_bits_are_exact(spark):
    vectors = [[3e7, 0.0], [-3e7, 1.0]] * 300 + [[3e7, 5.0]]
    found = whitening.whiten(spark.createDataFrame(rows_of(vectors), SCHEMA)).where("component = 1").orderBy("vec_id").collect()
    assert [int(r.deviation) for r in found] == plain(vectors)[2] and int(found[0].deviation) > 1 << 63
