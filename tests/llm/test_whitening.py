from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.whitening import leading_pairs, minres, whiten

CLASHING = "1 AS ids, 2 AS x, 3 AS component, 4 AS n, 5 AS width, 6 AS whitened, 7 AS deviation".split(", ")
NAN, INF = float("nan"), float("inf")


def run(spark, rows, **settings):
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", *CLASHING)
    return whiten(table, **settings).toPandas()


def check(got, rows, components, scale=64, shift=1_000_000):
    """Against exact sums in Python and a dense eigensolver."""
    x = np.array([[int(np.floor(scale * float(np.float32(c)))) + shift for c in v] for _, v in rows], dtype=object)
    n, d = x.shape
    sums = [sum(col) for col in x.T]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    z = np.array([[float(Fraction(int(n * a - s), n)) for a, s in zip(row, sums, strict=True)] for row in x])
    cov = z.T @ z / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, d)
    assert len(got) == n * k and (got["n"] == n).all()
    assert sorted(zip(got["vec_id"], got["deviation"], strict=True)) == sorted(
        (i, v) for (i, _), v in zip(rows, deviations, strict=True) for _ in range(k)
    )
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in rows]].to_numpy()
    for j in range(k):
        share = got.loc[got["component"] == j + 1, "explained"].unique()
        assert len(share) == 1 and share[0] == pytest.approx(values[j] / np.trace(cov), rel=1e-9)
        want = z @ vectors[:, j] / np.sqrt(values[j])
        assert min(np.abs(table[:, j] - want).max(), np.abs(table[:, j] + want).max()) < 1e-6
    errors = got["identity_error"].unique()
    assert len(errors) == 1 and errors[0] < 1e-9
    assert np.abs(table.T @ table / n - np.eye(k)).max() == pytest.approx(errors[0], abs=1e-12)


def test_same_as_a_dense_solver(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_NUMBERS", 400)
    monkeypatch.setattr(whitening, "OUTPUT_ROWS", 100)
    rng = np.random.default_rng(5)
    scales = np.linspace(3, 0.2, 20)
    rows = [(i, [float(v) for v in rng.normal(50, 1, 20) * scales]) for i in range(500)]
    check(run(spark, rows, components=6), rows, 6)


def test_fewer_dimensions_than_components(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(v) for v in rng.normal(0, 2, 3) * [1, 2, 3]]) for i in range(40)]
    check(run(spark, rows), rows, 32)


def test_odd_rows(spark):
    good = [(1, [0.5, -1.0]), (2, [3.0, 4.0]), (3, [5.5, -9.0]), (9, [1.0, 1.0])]
    odd = [(4, None), (5, [NAN, 1.0]), (6, [INF, 1.0]), (7, [None, 1.0]), (8, []), (10, [1.0]), (11, [1.0, 2.0, 3.0])]
    check(run(spark, good + odd), good, 2)
    got = run(spark, [*good, (1, [0.5, -1.0]), (None, [7.0, 7.0])])
    assert len(got) == 12 and (got["n"] == 6).all() and got["vec_id"].isna().sum() == 2
    assert (got["vec_id"] == 1).sum() == 4


def test_no_variance_gives_no_rows(spark):
    assert run(spark, []).empty
    assert run(spark, [(1, None), (2, [NAN])]).empty
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]).empty
    # one direction only
    got = run(spark, [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)])
    assert set(got["component"]) == {1} and got["explained"].iloc[0] == pytest.approx(1.0)


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(10_000_000 * (i % 7)), float(i)]) for i in range(2000)]
    got = run(spark, rows)
    x = [[64 * int(c) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = {i: sum((2000 * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for i, v in enumerate(x)}
    for i, v in zip(got["vec_id"], got["deviation"], strict=True):
        assert v == want[i] if want[i] < 1 << 63 else v is None or np.isnan(v)


@pytest.mark.parametrize("equal", [False, True])
def test_leading_pairs_of_a_large_matrix(equal):
    """Restarts and locking: 300 dimensions, a space of at most 72 directions; also with repeated eigenvalues."""
    rng = np.random.default_rng(7)
    values = np.concatenate([[50.0] * 3 if equal else [60.0, 50.0, 45.0], np.linspace(20, 1, 297)])
    turn = np.linalg.qr(rng.standard_normal((300, 300)))[0]
    matrix = (turn * values) @ turn.T
    got = leading_pairs(lambda u: matrix @ u, 300, 10)
    assert got.values == pytest.approx(values[:10], rel=1e-12)
    assert np.abs(matrix @ got.vectors - got.vectors * got.values).max() < 1e-10
    assert np.abs(got.vectors.T @ got.vectors - np.eye(10)).max() < 1e-12


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(8)
    turn = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    matrix = (turn * np.concatenate([np.linspace(-3, -1, 10), np.linspace(1, 5, 20)])) @ turn.T
    right = rng.standard_normal((30, 4))
    right[:, 3] = 0
    got = minres(lambda v: matrix @ v, right, 30, 1e-12)
    assert np.abs(matrix @ got - right).max() < 1e-8
