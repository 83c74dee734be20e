"""Whitening against numpy, and its steps against exact results."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlore.llm import whitening as w


def table(spark, vectors):
    return spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<float>").repartition(3)


def plain(vectors):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)) + 1_000_000
    values, axes = np.linalg.eigh(np.cov(x.T, bias=True).reshape(x.shape[1], x.shape[1]))
    return x, values[::-1], axes[:, ::-1]


@pytest.mark.parametrize("n,d", [(50, 3), (400, 40), (5, 8), (30, 1)])
def test_components_are_those_of_numpy(spark, n, d):
    own = np.random.RandomState(n + d)
    vectors = (own.randn(n, d) @ own.randn(d, d)).tolist()
    found = w.whiten(table(spark, vectors)).orderBy("vec_id", "component").toPandas()
    x, values, axes = plain(vectors)
    k = min(32, d, n - 1)
    assert len(found) == n * k and found["component"].tolist() == list(range(1, k + 1)) * n
    expected = (x - x.mean(0)) @ axes[:, :k] / np.sqrt(values[:k])
    got = found["whitened"].to_numpy().reshape(n, k)
    assert np.abs(got * np.sign((got * expected).sum(0)) - expected).max() < 1e-7
    assert np.allclose(found["explained"][:k], values[:k] / values.sum(), rtol=1e-9)
    assert found["identity_error"].nunique() == 1 and found["identity_error"][0] < 1e-9
    sums = x.astype(int).sum(0)
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    assert found["deviation"].tolist() == [v for v in exact for _ in range(k)]


def test_equal_variances_give_an_orthonormal_basis(spark):
    # Three dimensions of exactly the same variance, and one of another.
    vectors = [[float(s if i == j else 0) for i in range(3)] + [float(t)] for j in range(3) for s in (1, -1) for t in (2, -2)]
    found = w.whitened_vectors(table(spark, vectors)).collect()
    values = np.array([r["values"] for r in found])
    assert values.shape == (12, 4) and found[0].identity_error < 1e-9
    assert np.abs(values.T @ values / 12 - np.eye(4)).max() < 1e-9


def test_odd_rows(spark):
    bad = [None, [], [1.0, None], [float("nan"), 1.0], [float("inf"), 0.0], [1.0, 2.0, 3.0], [1e30, 0.0]]
    good = [[0.5, 1.0], [0.25, -1.0], [0.5, 1.0], [2.0, 3.0]]
    rows = table(spark, bad + good).withColumns({x: F.lit("x") for x in ("vector", "n", "values", "at", "_at")})
    rows = rows.withColumn("vec_id", F.when(F.col("vec_id") != 8, F.col("vec_id")))
    found = w.whiten(rows).toPandas()
    assert sorted(found["vec_id"].fillna(-1).tolist()) == [-1, -1, 7, 7, 9, 9, 10, 10]
    assert set(found["n"]) == {4} and found["identity_error"][0] < 1e-9
    assert w.whiten(rows.where("false")).count() == 0
    same = table(spark, [[1.0, 2.0]] * 5)
    assert w.whiten(same).count() == 0
    assert {tuple(r) for r in w.whitened_vectors(same).select("n", "deviation").collect()} == {(5, 0)}


def test_large_entries_stay_exact(spark):
    vectors = [[float(2**30), 1.0], [-float(2**30), 2.0], [3.0, float(2**29)]]
    found = w.whitened_vectors(table(spark, vectors)).orderBy("vec_id").collect()
    x = [[int(64 * v) for v in row] for row in vectors]
    sums = [sum(c) for c in zip(*x)]
    exact = [sum((3 * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert [r.deviation for r in found] == [v if v < 2**63 else None for v in exact]
    assert found[0].identity_error < 1e-9


def test_polynomial_modulo_a_prime():
    own = np.random.RandomState(3)
    for size in (1, 2, 5, 12):
        m = own.randint(-9, 9, (size, size))
        m[0] = 0  # no pivot in the first column, once
        roots = np.round(np.poly(m)).astype(int)[::-1]
        p = 2_147_483_647
        assert w.polynomial_modulo(m, p) == [int(c) % p for c in roots]


def test_roots_are_isolated_and_counted():
    # (x - 3)^2 (x - 7) x (x + 1): the roots above 0 are 7, 3, 3.
    poly = np.round(np.poly([3, 3, 7, 0, -1])).astype(int)[::-1].tolist()
    found = w.largest_roots(poly, 5)
    assert [(round(r / 2**w._BITS, 12), n) for r, n in found] == [(7.0, 1), (3.0, 2)]
    assert w.largest_roots([0, 0, 1], 2) == []
    near = np.array([1, -(10**9) * 2 - 1, 10**18 + 10**9], dtype=object)[::-1].tolist()  # 10**9 and 10**9 + 1
    assert [round(r / 2**w._BITS, 3) for r, _ in w.largest_roots(near, 2)] == [10**9 + 1, 10**9]


def test_primes():
    found = w.primes_below(1 << 31, 200)
    assert max(found) < 2**31 and len(set(found)) == len(found) and np.log2(np.array(found, float)).sum() > 200
