"""Whitening against NumPy's eigenvectors, and exact sums against Python integers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from assayflow.llm import whitening
from assayflow.llm.queries import QUERIES


def brute(vectors, wanted=4):
    """(vec_id -> (deviation, whitened up to sign)), n, explained, of (vec_id, list) rows."""
    usable = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    rows = [(i, [math.floor(256 * float(c)) + 0 for c in v]) for i, v in usable]
    fit = sorted({tuple(x) for _, x in rows})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    centred = np.array([[float(Fraction(n * x[k] - sums[k], n)) for k in range(d)] for x in fit])
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    values, parts = values[::-1][:wanted], parts[:, ::-1][:, :wanted]
    out = []
    for i, x in rows:
        apart = [n * x[k] - sums[k] for k in range(d)]
        out.append((i, sum(a * a for a in apart), np.array([a / n for a in apart]) @ parts / np.sqrt(values)))
    return out, n, values / np.trace(centred.T @ centred / n)


def compare(found, vectors):
    want, n, explained = brute(vectors)
    k = len(explained)
    rows = sorted((r.asDict() for r in found.collect()), key=lambda r: (r["vec_id"], r["deviation"], r["component"]))
    assert len(rows) == len(want) * k
    assert {r["n"] for r in rows} == {n}
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9
    got = np.array([r["whitened"] for r in rows]).reshape(-1, k)
    want.sort(key=lambda w: w[:2])
    assert [(rows[at]["vec_id"], rows[at]["deviation"]) for at in range(0, len(rows), k)] == [w[:2] for w in want]
    plain = np.array([w[2] for w in want])
    signs = np.sign((got * plain).sum(axis=0))
    np.testing.assert_allclose(got, plain * signs, rtol=1e-7, atol=1e-8)
    for component in range(k):
        assert {r["component"] for r in rows} == set(range(1, k + 1))
        np.testing.assert_allclose([r["explained"] for r in rows if r["component"] == component + 1], explained[component], rtol=1e-9)


def frame(spark, rows, kind="double"):
    full = [(i, v, 3, 1.0, 2) for i, v in rows]
    return spark.createDataFrame(full, f"vec_id long, embedding array<{kind}>, label int, whitened double, x int")


def test_all_embeddings(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    compare(QUERIES["op12_embedding_whitening"](spark, sf_dir), rows)


def test_nulls_repeats_offsets_and_other_lengths(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 7)) * [9, 5, 3, 2, 1, 0.5, 0.2] + 4000
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(100 + i, rows[0][1]) for i in range(200)]
    rows += [(7, rows[9][1]), (7, rows[3][1])]
    dropped = [(1000, None), (1001, [None] * 7), (1002, [math.nan, *[0.0] * 6]), (1003, [math.inf] * 7), (1004, [1.0, 2.0]), (1005, [])]
    compare(whitening.whiten(frame(spark, rows + dropped)), rows)
    anonymous = whitening.whiten(frame(spark, [(None, v) for _, v in rows[:60]]))
    assert anonymous.where("vec_id is null").count() == 240


def test_nothing_that_varies_gives_no_rows(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None)])).count() == 0
    assert whitening.whiten(frame(spark, [(1, []), (2, [])])).count() == 0
    assert whitening.whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    # One direction varies, so there is one component.
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)])).collect()
    assert {r.component for r in line} == {1} and len(line) == 9
    assert line[0].explained == pytest.approx(1)


def test_huge_entries_are_exact_or_null(spark):
    rows = [(0, [1e15, -1e15]), (1, [3e8, 5.0]), (2, [0.0, 1e3])]
    want, *_ = brute(rows)
    got = {r.vec_id: r.deviation for r in whitening.whiten(frame(spark, rows)).collect()}
    assert got == {i: (s if s < 2**63 else None) for i, s, _ in want}
    whitening.whiten(frame(spark, [(0, [1e300, 1.0]), (1, [-1e300, 2.0]), (2, [0.0, 0.0])])).collect()


def test_exact_products_at_every_size():
    rng = np.random.default_rng(0)
    for bits in (3, 20, 30, 50):
        y = rng.integers(-(2**bits), 2**bits, (40, 3))
        assert (whitening.exact_products(y) == y.astype(object).T.dot(y.astype(object))).all()
    assert (whitening.exact_products(np.zeros((0, 2), np.int64)) == 0).all()
    for value in (0, 5, -5, 2**100, -(2**125)):
        assert whitening._whole(whitening._parts(value)) == value


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * values) @ q.T


@pytest.mark.parametrize("seed", range(8))
def test_inertia_counts_eigenvalues_above_a_shift(seed):
    rng = np.random.default_rng(seed)
    values = np.sort(rng.standard_normal(12))
    matrix = symmetric(values, seed)
    for shift in [*((values[1:] + values[:-1]) / 2), -9, 9]:
        assert whitening.inertia(matrix, shift) == ((values > shift).sum(), 0)
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == (1, 0)
    assert whitening.inertia(np.diag([1.0, 0.0, 0.0, -1.0]), 0.0) == (1, 2)


@pytest.mark.parametrize(
    "values",
    [
        [9, 5, 3, 2, 1, 0.5],
        [9, 9, 9, 2, 2, 0.5],
        [1, 1 - 1e-9, 1 - 2e-9, 1 - 3e-9, 0.1],
        [1e-200, 1e-201, 1e-202, 1e-203, 1e-204],
        [1e8, 1.0, 1e-1, 1e-2],
        [4, 0, 0, 0],
        [3],
        [1] * 30,
        list(np.linspace(2, 1, 40)),
    ],
)
def test_leading_components_are_certified(values):
    matrix = symmetric(np.array(values, float), 5)
    found, vectors = whitening.leading_components(matrix)
    want = sorted(values, reverse=True)[:4]
    want = [v for v in want if v > whitening.LEAST_SHARE * sum(values)]
    np.testing.assert_allclose(found, want, rtol=1e-9, atol=1e-14 * max(values))
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(want)), atol=1e-9)
    np.testing.assert_allclose(matrix @ vectors, vectors * found, atol=1e-13 * max(values) * len(values))
