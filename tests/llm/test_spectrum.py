import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyworks.llm import spectrum as sp


def orthogonal(rng, n):
    return np.linalg.qr(rng.standard_normal((n, n)))[0]


def test_counts_against_eigenvalues():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 20):
        for _ in range(20):
            a = rng.standard_normal((n, n))
            a = a + a.T
            values = np.linalg.eigvalsh(a)
            for s in [*rng.uniform(-5, 5, 5), values.mean()]:
                assert sp.eigenvalues_above(a, s) == (values > s).sum()
    swap = np.array([[0.0, 1.0], [1.0, 0.0]])  # no pivot on the diagonal
    assert [sp.eigenvalues_above(swap, s) for s in (-2, 0, 2)] == [2, 1, 0]
    assert sp.eigenvalues_above(np.zeros((3, 3)), 0.0) == 0


@pytest.mark.parametrize(
    "values",
    [
        [9.0, 5.0, 4.0, 1.0, 0.5],
        [1e6, 1e6 - 1e-3, 3.0, 2.0, 1e-1],  # close
        [7.0, 7.0, 7.0, 2.0, 2.0],  # equal
        [3.0, 2.0, 0.0, 0.0, 0.0],  # no full rank
        [0.0] * 5,
        [4.0],
    ],
)
def test_leading_against_the_library(values):
    rng = np.random.default_rng(2)
    q = orthogonal(rng, len(values))
    a = q @ np.diag(values) @ q.T
    found, u = sp.leading(a, 4)
    want = [v for v in values if v > 0][:4]
    assert np.allclose(found, want, rtol=0, atol=1e-13 * max(values)) and u.shape == (len(values), len(want))
    assert np.abs(u.T @ u - np.eye(len(want))).max(initial=0) < 1e-12
    assert np.abs(a @ u - u * found).max(initial=0) <= 1e-13 * max(values)
    assert all(c[np.abs(c).argmax()] > 0 for c in u.T)


def by_library(vectors, k):
    x = np.floor(1024 * np.array(vectors, np.float64)) + 100_000
    n, s = len(x), [sum(int(v) for v in c) for c in x.T]
    centred = x - np.array([t / n for t in s])
    values, u = np.linalg.eigh(centred.T @ centred / n)
    values, u = values[::-1][:k], u[:, ::-1][:, :k]
    deviation = [sum((n * int(v) - t) ** 2 for v, t in zip(r, s)) for r in x]
    return deviation, centred @ u / np.sqrt(values), values / centred.var(axis=0).sum()


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def test_against_the_library(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((400, 12)) * np.geomspace(1, 0.01, 12)).astype(np.float32).tolist()
    vectors += [vectors[0]] * 30
    bad = [None, [], [1.0] * 11, [float("nan")] * 12, [math.inf] + [0.0] * 11, [None] + [0.0] * 11]
    rows = [(i, v, i % 3) for i, v in enumerate(vectors + bad)]
    docs = table(spark, rows).repartition(3).withColumn("n", F.lit(1)).withColumn("component", F.lit("x"))
    got = sorted(sp.whitened(docs).collect(), key=lambda r: (r.vec_id, r.component))
    deviation, want, explained = by_library(vectors, 8)
    assert [(r.vec_id, r.component) for r in got] == [(i, c) for i in range(430) for c in range(1, 9)]
    assert {r.n for r in got} == {430} and [int(r.deviation) for r in got[::8]] == deviation
    values = np.array([r.whitened for r in got]).reshape(430, 8)
    signs = np.sign((values * want).sum(axis=0))
    assert np.abs(values - want * signs).max() < 1e-9
    assert np.allclose([r.explained for r in got[:8]], explained, rtol=1e-10)
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9
    assert np.abs(values.T @ values / 430 - np.eye(8)).max() < 1e-9


def test_few_equal_and_null_rows(spark):
    one = table(spark, [(1, [0.5, 0.25], 0)])
    assert sp.whitened(one).collect() == [] and sp.whitened(one.unionByName(one)).collect() == []
    rows = sp.whitened(table(spark, [(None, [0.0, 0.0], None), (None, [1.0, 1.0], None)], "double")).collect()
    assert [(r.vec_id, r.component, r.n, round(r.explained, 12)) for r in rows] == [(None, 1, 2, 1.0)] * 2
    assert sorted(r.whitened for r in rows) == pytest.approx([-1, 1]) and {int(r.deviation) for r in rows} == {2 * 1024**2}


def test_exact_deviations_of_large_numbers():
    x = np.array([[1 << 39, -(1 << 39)], [5, 7]], np.int64)
    n, sums = 10**9, [123456789012345678, -987654321098765432]
    want = [sum((n * int(v) - s) ** 2 for v, s in zip(r, sums)) for r in x]
    got = sp.deviations(x, n, sums)
    assert [None if w >= 10**38 else w for w in want] == [None if g is None else int(g) for g in got]
    small = np.array([[3, 4], [5, 6]], np.int64)
    assert [int(d) for d in sp.deviations(small, 2, [8, 10])] == [(6 - 8) ** 2 + (8 - 10) ** 2, (10 - 8) ** 2 + (12 - 10) ** 2]


def test_empty_table(spark):
    assert sp.whitened(table(spark, [])).collect() == [] and sp.whitened(table(spark, [(1, None, 0), (2, [], 0)])).collect() == []
