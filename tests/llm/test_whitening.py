"""Whitening against the full eigendecomposition, exact deviations, and awkward spectra."""

import numpy as np
import pytest
from pyspark.sql import types as T

from emberline.llm import whitening as wh

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("vec_id", T.LongType()), ("embedding", T.ArrayType(T.FloatType())), ("v", T.StringType()), ("i", T.StringType()), ("component", T.IntegerType()))])


def brute(vectors, k):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    deviation = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, s)) for row in x]
    z = x - s / n
    value, vector = np.linalg.eigh(z.T @ z / n)
    value, vector = value[::-1][:k], vector[:, ::-1][:, :k]
    return deviation, z @ vector / np.sqrt(value), value / np.trace(z.T @ z / n)


def frame(spark, pairs, n=3):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "x", "y", 7) for i, v in pairs], SCHEMA).repartition(n)


def check(rows, vectors, k):
    deviation, white, explained = brute(vectors, k)
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(got) == len(rows) == len(vectors) * k
    sign = {j: np.sign(sum(got[i, j + 1].whitened * white[i, j] for i in range(len(vectors)))) for j in range(k)}
    for (i, c), r in got.items():
        assert r.n == len(vectors) and r.deviation == deviation[i]
        assert abs(r.whitened * sign[c - 1] - white[i, c - 1]) < 1e-8
        assert abs(r.explained / explained[c - 1] - 1) < 1e-10 and r.identity_error < 1e-8


@pytest.mark.parametrize("d", [1, 5, 24, 64])
def test_equals_eigendecomposition(spark, d):
    rng = np.random.default_rng(d)
    vectors = (rng.standard_normal((200, d)) * np.linspace(3, 0.5, d) + rng.standard_normal(d)).astype(np.float32).tolist()
    check(wh.whitened(frame(spark, enumerate(vectors))).collect(), vectors, min(8, d))


def test_rows_that_are_left_out(spark):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((40, 6)).astype(np.float32).tolist()
    odd = [(100, None), (101, []), (102, [1.0] * 5), (103, [None] + [1.0] * 5), (104, [float("nan")] + [1.0] * 5), (105, [float("inf")] + [1.0] * 5), (106, [3e38] * 6), (107, [1.0] * 7)]
    found = wh.whitened(frame(spark, [*enumerate(vectors), *odd]), components=3)
    check(found.collect(), vectors, 3)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_repeated_and_null_ids_and_copies(spark):
    rng = np.random.default_rng(2)
    vectors = [*rng.standard_normal((10, 4)).tolist()] + [[0.25] * 4] * 300
    ids = [None, 1, 1, *range(2, 309)]
    rows = wh.whitened(frame(spark, zip(ids, vectors)), components=2).collect()
    assert len(rows) == 2 * 310 and sum(r.vec_id is None for r in rows) == 2 and sum(r.vec_id == 1 for r in rows) == 4


def test_nothing_to_whiten(spark):
    assert wh.whitened(frame(spark, [(1, [1.0, 2.0])]).limit(0)).count() == 0
    assert wh.whitened(frame(spark, [(1, None), (2, [])])).count() == 0
    assert wh.whitened(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    rows = wh.whitened(frame(spark, [(i, [float(i), 5.0, -float(i)]) for i in range(9)])).collect()
    assert {r.component for r in rows} == {1} and abs(rows[0].explained - 1) < 1e-12


def matrix(value, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(value), len(value))))[0]
    return q @ np.diag(value) @ q.T


@pytest.mark.parametrize("value,block,most", [([5.0] * 30 + [1.0] * 30, 4, 40), ([9.0] * 3 + [0.0] * 57, 4, 40), (list(np.geomspace(1e6, 1, 120)), 8, 4), (list(range(1, 201)), 8, 6)])
def test_lanczos_on_awkward_spectra(value, block, most):
    a, passes = matrix(value), []
    got, vector = wh.lanczos(lambda v: passes.append(1) or a @ v, len(value), 6, block, most)
    want = np.sort(value)[::-1][:6]
    assert np.allclose(got, want, rtol=1e-10, atol=1e-9 * want[0])
    assert np.abs(vector.T @ vector - np.eye(6)).max() < 1e-12
    assert np.linalg.norm(a @ vector - vector * got, axis=0).max() < 1e-9 * want[0]


def test_lanczos_stops_early_on_a_falling_spectrum():
    a, passes = matrix(list(np.geomspace(1e4, 1e-4, 400))), []
    wh.lanczos(lambda v: passes.append(1) or a @ v, 400, 8, 16, 40)
    assert len(passes) < 12


@pytest.mark.parametrize("size", [10, 1 << 20, 1 << 35])
def test_deviations_are_exact(size):
    rng = np.random.default_rng(size)
    x = rng.integers(-size, size, (7, 5)) + wh.SHIFT
    for n in (7, 10**6, 10**10):
        sums = x.sum(axis=0) * (n // 7) + rng.integers(0, 5, 5)
        d, square = wh.deviations(x, n, sums)
        want = [[n * int(v) - int(s) for v, s in zip(row, sums)] for row in x]
        assert square == [sum(v * v for v in row) for row in want] and d.tolist() == [[float(v) for v in row] for row in want]
