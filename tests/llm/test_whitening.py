"""Whitening against the covariance matrix and its eigenvectors."""

from __future__ import annotations

import math

import numpy as np
import pytest

from sluicegate.llm.whitening import bidiagonal, by_component, dqds, spectrum, whiten

CLASHING = "vec_id long, embedding array<double>, n string, id string, vector string, part long, blob string"


def vectors(spark, rows, parts=4):
    full = [(i, v, "x", "y", "z", 7, "b") for i, v in rows]
    return spark.createDataFrame(full, CLASHING).repartition(parts)


def exact(rows):
    """Numbers, sums and deviations as Python integers."""
    numbers = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    n, sums = len(numbers), [sum(column) for column in zip(*numbers, strict=True)]
    return numbers, sums, [sum((n * x - s) ** 2 for x, s in zip(row, sums, strict=True)) for row in numbers]


def matrices():
    random = np.random.default_rng(3)
    yield "random", random.standard_normal((40, 40))
    yield "graded", random.standard_normal((30, 30)) * 10.0 ** -np.arange(30)
    yield "few rows", random.standard_normal((5, 24))
    yield "equal values", np.linalg.qr(random.standard_normal((20, 20)))[0] * 3
    yield "clusters", np.linalg.qr(random.standard_normal((24, 24)))[0] * np.repeat([5, 5 + 1e-9, 2, 1], 6) @ np.linalg.qr(random.standard_normal((24, 24)))[0]
    yield "zeros", np.diag([3.0, 0, 2, 0, 0, 1])
    yield "constant columns", np.hstack([random.standard_normal((10, 3)), np.zeros((10, 4))])
    yield "one", np.array([[7.0]])
    yield "large", random.standard_normal((150, 150)) + 4


@pytest.mark.parametrize(("name", "matrix"), [pytest.param(n, m, id=n) for n, m in matrices()])
def test_spectrum(name, matrix):
    found = spectrum(np.linalg.qr(matrix, mode="r"), 12)
    true = np.linalg.svd(matrix, compute_uv=False) ** 2
    true = true[true > 1e-26 * true[0]][:12]
    assert len(found.squares) == len(true)
    assert np.allclose(found.squares, true, rtol=1e-10, atol=1e-14 * true[0])
    assert np.abs(found.vectors.T @ found.vectors - np.eye(len(true))).max() < 1e-12
    gram = matrix.T @ matrix
    assert np.abs(gram @ found.vectors - found.vectors * found.squares).max() < 1e-12 * true[0] * len(gram)


def test_dqds_keeps_small_values():
    """Singular values of a graded bidiagonal matrix to nearly full relative accuracy."""
    a, b = 10.0 ** -np.arange(0, 16, 1.0), 10.0 ** -np.arange(0.5, 15, 1.0)
    found = np.sqrt(dqds(a, b))
    # One-sided: the product of all singular values is that of the diagonal.
    assert abs(np.log(found).sum() - np.log(a).sum()) < 1e-13
    assert np.all(np.diff(found) < 0)


def test_bidiagonal_form():
    matrix = np.random.default_rng(1).standard_normal((9, 9))
    a, b, right = bidiagonal(matrix)
    form = np.diag(a) + np.diag(b, 1)
    assert np.allclose(form.T @ form, right.T @ matrix.T @ matrix @ right)


@pytest.mark.parametrize(("count", "parts"), [(700, 3), (300, 150)])
def test_whitened_rows(spark, count, parts):
    random = np.random.default_rng(count)
    data = random.standard_normal((count, 40)) @ random.standard_normal((40, 40)) / 6
    rows = [(i, row.tolist()) for i, row in enumerate(data)]
    found = by_component(whiten(vectors(spark, rows, parts))).toPandas()
    numbers, sums, deviations = exact(rows)
    centred = np.array(numbers, float) - np.array(sums) / count
    values, axes = np.linalg.eigh(centred.T @ centred / count)
    values, axes = values[::-1][:32], axes[:, ::-1][:, :32]
    assert len(found) == count * 32
    assert found.n.eq(count).all() and found.identity_error.max() < 1e-9 and found.identity_error.nunique() == 1
    table = found.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    true = centred @ axes / np.sqrt(values)
    signs = np.sign((table * true).sum(axis=0))
    assert np.abs(table - true * signs).max() < 1e-8
    assert np.abs(np.cov(table.T, bias=True) - np.eye(32)).max() < 1e-9
    shares = found.groupby("component").explained.first().to_numpy()
    assert np.allclose(shares, values / np.square(centred).sum() * count, rtol=1e-10)
    assert found.groupby("vec_id").deviation.first().tolist() == deviations


def test_rows_without_numbers_take_no_part(spark):
    rows = [(i, [float(i % 7), float(i * i % 11), 2.0]) for i in range(40)]
    odd = [(100, None), (101, []), (102, [1.0, None, 1.0]), (103, [1.0, math.nan, 1.0]), (104, [math.inf, 1.0, 1.0]), (105, [1e300, 1.0, 1.0])]
    again = [(3, rows[3][1]), (None, rows[4][1])]
    found = by_component(whiten(vectors(spark, rows + odd + again))).toPandas()
    assert len(found) == 42 * 2  # the third dimension has no variance
    assert set(found.vec_id.dropna()) == set(range(40)) and found.n.eq(42).all()
    deviations = sorted(exact(rows + again)[2])
    assert sorted(found[found.component == 1].deviation) == deviations
    assert found.identity_error.max() < 1e-12


def test_exact_deviation_of_large_numbers(spark):
    rows = [(1, [2.0**40, 0.0]), (2, [-(2.0**39), 5.0]), (3, [1.5, 2.0**41])]
    whole = whiten(vectors(spark, rows))
    found = {row.id: int(row.deviation) for row in whole.collect()}
    assert found == dict(zip([1, 2, 3], exact(rows)[2], strict=True))
    assert {row.deviation for row in by_component(whole).collect()} == {None}


def test_no_variance_and_no_rows(spark):
    assert whiten(vectors(spark, [])).count() == 0
    one = whiten(vectors(spark, [(1, [0.5, 0.25])])).first()
    assert (one.n, int(one.deviation), one.whitened, one.explained, one.identity_error) == (1, 0, [], [], None)
    equal = whiten(vectors(spark, [(i, [0.5, 0.25]) for i in range(9)]))
    assert by_component(equal).count() == 0
    with pytest.raises(ValueError, match=r"\[1, 2\]"):
        whiten(vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])]))
