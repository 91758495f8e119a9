import numpy as np
import pytest

from starfold.llm.whitening import above, inertia, leading, whiten

SCHEMA = "vec_id long, embedding array<double>, x int, component string, at int, label int"


@pytest.fixture
def table(spark):
    def make(*rows):
        return spark.createDataFrame([(i, v, 1, "c", 2, 3) for i, v in rows], SCHEMA)

    return make


def symmetric(size, seed, values=None):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    values = np.random.default_rng(seed + 1).uniform(0, 9, size) if values is None else np.array(values, float)
    return (q * values) @ q.T


@pytest.mark.parametrize("size", [1, 2, 5, 40])
def test_inertia_counts_eigenvalues(size):
    matrix = symmetric(size, size) - 4 * np.eye(size)
    values = np.linalg.eigvalsh(matrix)
    assert inertia(matrix) == ((values > 0).sum(), 0, (values < 0).sum())
    for shift in (-2.0, 0.5, 3.0):
        assert above(matrix, shift) == (values > shift).sum()


def test_inertia_with_an_empty_diagonal():
    assert inertia(np.array([[0.0, 2], [2, 0]])) == (1, 0, 1)
    assert inertia(np.zeros((3, 3))) == (0, 3, 0)


@pytest.mark.parametrize("size", [1, 3, 17, 64])
def test_leading_eigenpairs(size):
    matrix = symmetric(size, 10 + size)
    values, vectors = np.linalg.eigh(matrix)
    found = leading(matrix)
    assert len(found) == min(4, size)
    for k, (value, vector) in enumerate(found):
        assert abs(value - values[-1 - k]) < 1e-13 * values[-1]
        assert abs(abs(vector @ vectors[:, -1 - k]) - 1) < 1e-10


def test_equal_near_and_zero_eigenvalues():
    matrix = symmetric(8, 3, [5, 5, 5, 5 - 1e-9, 1, 1, 0, 0])
    found = leading(matrix)
    axes = np.array([v for _, v in found])
    assert np.allclose([value for value, _ in found], [5, 5, 5, 5 - 1e-9], rtol=0, atol=1e-13 * 8)
    assert np.allclose(axes @ axes.T, np.eye(4), atol=1e-12)
    assert len(leading(symmetric(6, 4, [3, 2, 0, 0, 0, 0]))) == 2
    assert leading(np.zeros((5, 5))) == []


def brute(vectors):
    x = np.array([np.floor(np.array(v) * 256) for v in vectors]).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    whitened = (x - sums / n) @ axes[:, ::-1][:, :4] / np.sqrt(values[::-1][:4])
    return n, ((n * x - sums) ** 2).sum(axis=1), whitened, values[::-1][:4] / values.sum()


def test_whitened_rows_against_numpy(table):
    rng = np.random.default_rng(5)
    vectors = (rng.standard_normal((300, 6)) * [4, 3, 2, 1, 0.5, 0.2]).tolist()
    vectors += vectors[:100] + [vectors[0]] * 50
    rows = whiten(table(*enumerate(vectors))).toPandas().sort_values(["vec_id", "component"])
    n, deviation, whitened, explained = brute(vectors)
    assert len(rows) == 4 * len(vectors) and set(rows.n) == {n} == {300}
    assert rows.identity_error.nunique() == 1 and rows.identity_error.iloc[0] < 1e-12
    assert (rows.deviation.to_numpy().reshape(-1, 4) == deviation[:, None]).all()
    assert np.allclose(rows.explained.to_numpy().reshape(-1, 4), explained, rtol=1e-12)
    got = rows.whitened.to_numpy().reshape(-1, 4)
    assert np.allclose(got * np.sign((got * whitened).sum(axis=0)), whitened, atol=1e-10)


def test_unusable_rows_and_other_lengths_are_left_out(table):
    good = [(i, [float(i % 3), float(i % 2)]) for i in range(6)]
    bad = [(10, None), (11, [1.0, None]), (12, [float("nan"), 0.0]), (13, [float("-inf"), 0.0]), (14, []), (15, [1.0])]
    rows = whiten(table(*good, *bad, (None, [0.0, 0.0]))).collect()
    assert {r.vec_id for r in rows} == {*range(6), None}
    assert {r.component for r in rows} == {1, 2} and {r.n for r in rows} == {6}


def test_tables_without_variance_are_empty(table):
    assert whiten(table()).collect() == []
    assert whiten(table((1, None))).collect() == []
    assert whiten(table((1, [1.0, 2.0]), (2, [1.0, 2.0]))).collect() == []


def test_deviation_beyond_a_long_keeps_its_digits(table):
    rows = whiten(table((1, [2.0**50, 0.0]), (2, [0.0, 0.0]), (3, [0.0, 1.0]))).where("component = 1").collect()
    x, sums = {1: (2**58, 0), 2: (0, 0), 3: (0, 256)}, (2**58, 256)
    for r in rows:
        exact = sum((3 * a - s) ** 2 for a, s in zip(x[r.vec_id], sums))
        assert r.deviation_digits == str(exact) and r.deviation is None
