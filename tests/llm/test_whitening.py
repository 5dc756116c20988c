import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetspark.llm import queries, whitening


def spectrum(values, seed=1):
    """A symmetric matrix with these eigenvalues."""
    turn, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return turn @ np.diag(values) @ turn.T


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 2, 40),
        np.array([5.0] * 3 + [4.0] * 3 + [1e-9] * 30),
        np.concatenate(([1e12, 1e6], np.geomspace(1e3, 1e-3, 30))),
        np.array([3.0, 2.0, 1.0]),
        np.array([2.0]),
        np.zeros(12),
    ],
)
def test_leading_eigenpairs(values):
    matrix, products = spectrum(values), []
    got, vectors = whitening.leading_eigenpairs(lambda w: products.append(1) or matrix @ w, len(values), 8)
    want, k = np.sort(np.linalg.eigvalsh(matrix))[::-1], min(8, len(values))
    assert len(got) == k and np.abs(got - want[:k]).max() <= 1e-13 * max(1, want[0])
    assert np.linalg.norm(matrix @ vectors - vectors * got, axis=0).max() <= 1e-13 * max(1, want[0]) * np.sqrt(len(values))
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13


def test_a_large_operator_takes_few_products_and_a_small_subspace():
    values = np.concatenate((np.linspace(20, 10, 10), np.linspace(5, 0, 490)))
    matrix, columns = spectrum(values), []
    got, _ = whitening.leading_eigenpairs(lambda w: columns.append(w.shape[1]) or matrix @ w, 500, 8)
    assert np.abs(got - values[:8]).max() < 1e-11 and len(columns) < 90 and max(columns) <= 10


def test_minres_solves_each_column():
    rng = np.random.default_rng(2)
    a, b = spectrum(np.linspace(-3, 9, 15)), rng.standard_normal((15, 3))
    shifts = np.array([0.1, -7.0, 12.5])
    x = whitening.minres(lambda v: a @ v - v * shifts, b, 60, 1e-13)
    assert np.abs(a @ x - x * shifts - b).max() < 1e-9


def brute(rows, components=8):
    """All by whole numbers and a dense solver: id, component, n, deviation, |whitened|, explained."""
    x = [[int(np.floor(1024 * np.float64(c))) + 100_000 for c in v] for _, v in rows]
    n, s = len(x), [sum(c) for c in zip(*x)]
    d = np.array([[n * c - t for c, t in zip(r, s)] for r in x], dtype=object)
    y = d.astype(float) / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    deviation = (d**2).sum(1)
    return [(i, k + 1, n, int(deviation[r]), abs(y[r] @ u[:, k]) / np.sqrt(e[k]), e[k] / e.sum()) for r, (i, _) in enumerate(rows) for k in range(min(components, len(e)))]


def held(got, want):
    got = sorted((r["vec_id"], r["component"], r["n"], int(r["deviation"]), abs(r["whitened"]), r["explained"], r["identity_error"]) for r in got)
    want = sorted(want)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], rtol=0, atol=1e-8) and np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-10)
    assert len({g[6] for g in got}) == 1 and got[0][6] < 1e-9


def test_the_query_against_whole_numbers(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    held(queries.op11_whitening(spark, sf_dir).collect(), brute(rows))


def vectors(n, dim, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, [float(c) for c in rng.normal(0, 1 + 9 * (dim - np.arange(dim)))]) for i in range(n)]


def test_unusual_rows(spark):
    good = vectors(60, 5) + [(7, vectors(60, 5)[7][1])]
    nan, inf = float("nan"), float("inf")
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [nan, 1.0, 1.0, 1.0, 1.0]), (104, [1.0, inf, 1.0, 1.0, 1.0]), (105, [1.0, 2.0]), (None, None)]
    docs = spark.createDataFrame([(i, v, 1.0, "x") for i, v in good + odd], "vec_id long, embedding array<double>, whitened double, n string").repartition(5)
    fitted = whitening.fit(docs, components=3)
    held(whitening.whiten(docs, fitted).collect(), [w for w in brute(good) if w[1] <= 3])
    assert fitted.values.shape == (3,)


def test_large_numbers_stay_exact(spark):
    rows = [(i, [1e6 * c for c in v]) for i, v in vectors(300, 4)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(docs, whitening.fit(docs)).collect()
    assert max(r["deviation"] for r in got) > 1 << 63
    held(got, brute(rows))


def test_tables_without_spread(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, [])] * 3):
        docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        assert whitening.whiten(docs, whitening.fit(docs)).count() == 0
    flat = spark.createDataFrame([(i, [float(i), 5.0, -float(i)]) for i in range(20)], "vec_id long, embedding array<float>")
    got = whitening.whiten(flat, whitening.fit(flat)).agg(F.max("component"), F.min("explained"), F.count("*")).first()
    assert got[0] == 1 and abs(got[1] - 1) < 1e-12 and got[2] == 20
