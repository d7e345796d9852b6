"""Exact components against numpy, small determinants and the given tables."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from foyer.llm import charpoly, queries, whitening


def whole(rows):
    return np.floor(np.array(rows, float) * 64).astype(int) + 1_000_000


def expected(rows):
    x = whole(rows)
    n = len(x)
    total = x.sum(0)
    off = x - total / n
    values, vectors = np.linalg.eigh(off.T @ off / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return n, ((n * x - total) ** 2).sum(1), values, off @ vectors / np.sqrt(np.maximum(values, 1e-300))


def table(spark, tmp_path, rows, **extra):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    found = queries.op13_embedding_whitening(spark, sf_dir).toPandas()
    n, deviation, values, wanted = expected([r.embedding for r in rows])
    got = found.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert got.shape == (len(rows), 32) and (found.n == n).all()
    wanted = wanted[:, :32] * np.sign((wanted[:, :32] * got).sum(0))
    assert np.abs(got - wanted).max() < 1e-8
    first = found[found.component == 1].sort_values("vec_id")
    assert first.deviation.tolist() == deviation.tolist()
    shares = found[found.vec_id == rows[0].vec_id].sort_values("component").explained
    assert np.allclose(shares, values[:32] / values.sum(), rtol=1e-12)
    assert found.identity_error.nunique() == 1 and found.identity_error.max() < 1e-9


def test_left_out_rows_ties_and_repeats(spark, tmp_path):
    good = [[1.0, 2.0, 0.5], [1.0, 2.0, 0.5], [-3.0, 0.25, 9.0], [0.0, -1.0, 4.0], [7.0, 0.0, 0.0]]
    rows = [(i, v, None) for i, v in enumerate(good)]
    rows += [(None, [2.0, 2.0, 2.0], 1), (3, [5.0, 5.5, 1.0], 2)]  # A null and a repeated id stay.
    good = [v for _, v, _ in rows]
    rows += [(90, None, 0), (91, [1.0, None, 2.0], 0), (92, [1.0, float("nan"), 2.0], 0), (93, [], 0)]
    rows += [(94, [math.inf, 1.0, 2.0], 0), (95, [-math.inf, 1.0, 2.0], 0), (96, [1.0, 2.0], 0), (97, [1e30, 1.0, 1.0], 0)]
    found = queries.op13_embedding_whitening(spark, table(spark, tmp_path, rows)).collect()
    n, deviation, values, _ = expected(good)
    assert len(found) == 3 * n and {r.vec_id for r in found} == {0, 1, 2, 3, 4, None}
    assert sorted(r.deviation for r in found if r.component == 1) == sorted(deviation.tolist())
    assert np.allclose(sorted({r.explained for r in found})[::-1], values / values.sum(), rtol=1e-12)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 0)], [(i, [1.0, 2.0], 0) for i in range(5)], [(1, None, 0)]])
def test_no_variance_has_no_component(spark, tmp_path, rows):
    assert queries.op13_embedding_whitening(spark, table(spark, tmp_path, rows)).count() == 0


def test_equal_variances_and_missing_rank(spark, tmp_path):
    rows = [(2 * i + (s > 0), [s * (i % 3 == k) * 1.0 for k in range(3)] + [0.0, 2.0], 0) for i in range(6) for s in (1, -1)]
    found = queries.op13_embedding_whitening(spark, table(spark, tmp_path, rows)).toPandas()
    assert sorted(found.component.unique()) == [1, 2, 3] and np.allclose(found.explained, 1 / 3)
    w = found.sort_values(["vec_id", "component"]).whitened.to_numpy().reshape(-1, 3)
    assert np.abs(w.T @ w / len(w) - np.eye(3)).max() < 1e-12 and found.identity_error.max() < 1e-12


def test_large_entries_stay_exact(spark, tmp_path):
    rows = [(i, [2.0**40 * (i % 5), 2.0**41 + i, -1.0 * i], 0) for i in range(40)]
    frame = whitening.usable(spark.read.parquet(f"{table(spark, tmp_path, rows)}/embeddings.parquet"))
    model = whitening.fit(frame)
    x = [[math.floor(64 * np.float32(c).item()) + 1_000_000 for c in v] for _, v, _ in rows]
    assert list(model.sums) == [sum(column) for column in zip(*x, strict=True)]
    want = [sum((40 * a - s) ** 2 for a, s in zip(row, model.sums, strict=True)) for row in x]
    got = whitening.whitened(frame, model, keep=["vec_id"]).orderBy("vec_id").collect()
    assert [int(r.deviation) for r in got] == want
    assert whitening.identity_error(frame, model) < 1e-6


def test_kept_columns_of_the_same_names(spark, tmp_path):
    path = table(spark, tmp_path, [(i, [1.0 * i, i * i % 7.0], i) for i in range(9)])
    rows = whitening.usable(spark.read.parquet(f"{path}/embeddings.parquet"))
    rows = rows.withColumnsRenamed({"vec_id": "whitened", "label": "deviation"})
    found = whitening.whitened(rows, whitening.fit(rows), keep=["whitened", "deviation"])
    assert found.columns == ["whitened", "deviation", "deviation_", "whitened_"]
    assert sorted(r.whitened for r in found.collect()) == list(range(9))


def determinant(rows):
    if not rows:
        return 1
    return sum((-1) ** j * rows[0][j] * determinant([r[:j] + r[j + 1 :] for r in rows[1:]]) for j in range(len(rows)))


def polynomial(matrix):
    primes = charpoly.primes_for(matrix)
    return charpoly.from_remainders(primes, [charpoly.polynomial_modulo(matrix, p) for p in primes])


@pytest.mark.parametrize("d", [1, 2, 3, 5])
def test_polynomial_is_exact(d):
    draw = np.random.default_rng(d)
    y = draw.integers(-10**6, 10**6, (d + 2, d)).astype(object)
    matrix = (y.T @ y).tolist()
    found = polynomial(matrix)
    for x in range(-2, 3):
        shifted = [[x * (i == j) - matrix[i][j] for j in range(d)] for i in range(d)]
        assert sum(c * x**k for k, c in enumerate(found)) == determinant(shifted)


def test_roots_are_counted_and_parted():
    # (x - 3)^2 (x - 10) (x - 10 - 1 / 2^70 ...) cannot be whole; use near whole roots of large size.
    roots = [0, 0, 7, 10**18, 10**18, 10**18 + 1, 5 * 10**20]
    matrix = [[roots[i] * (i == j) for j in range(len(roots))] for i in range(len(roots))]
    bits, found = charpoly.top_roots(polynomial(matrix), 10, [])
    assert [(Fraction(r, 1 << bits), k) for r, k in found] == [
        (5 * 10**20, 1), (10**18 + 1, 1), (10**18, 2), (7, 1)
    ]
    assert charpoly.top_roots(polynomial(matrix), 2, [float(r) for r in roots])[1] == found[:2]


def test_vectors_of_close_roots():
    # Roots that agree in 15 digits: a plain solver in doubles mixes their vectors.
    matrix = [[10**15 + 1, 1, 0], [1, 10**15, 0], [0, 0, 3]]
    bits, found = charpoly.top_roots(polynomial(matrix), 3, [])
    assert [times for _, times in found] == [1, 1, 1]
    golden = (1 + 5**0.5) / 2
    first = next(iter(charpoly.eigenvectors(matrix, bits, found[0][0], 1)))
    size = math.hypot(golden, 1)
    assert np.allclose(first, [golden / size, 1 / size, 0], atol=1e-15)


def test_primes():
    found = charpoly.primes_for([[10**30, 0], [0, 10**30]])
    assert all(p < 1 << 31 and all(p % q for q in (2, 3, 5, 7, 11, 13, 46337)) for p in found)
    assert math.prod(found) > 2 * 10**60
