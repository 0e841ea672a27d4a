"""Inertia counts, leading eigenvalues and whitened vectors against numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.llm import whitening


def symmetric(rng, n, values=None):
    if values is None:
        a = rng.standard_normal((n, n))
        return a + a.T
    q = np.linalg.qr(rng.standard_normal((n, n)))[0]
    m = (q * np.array(values)) @ q.T
    return (m + m.T) / 2


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 14), st.integers(0, 10**6), st.booleans())
def test_inertia_counts_signs(n, seed, zero_diagonal):
    rng = np.random.default_rng(seed)
    a = symmetric(rng, n)
    if zero_diagonal:
        np.fill_diagonal(a, 0)
    e = np.linalg.eigvalsh(a)
    if np.abs(e).min() > 1e-9:
        assert whitening.inertia(a) == ((e > 0).sum(), (e < 0).sum(), 0)


def test_inertia_of_zero():
    assert whitening.inertia(np.zeros((3, 3))) == (0, 0, 3)


@pytest.mark.parametrize(
    "values",
    [
        list(range(1, 21)),
        [1e6, 1e6 - 1e-3, 5, 1e-3, 1e-9, 0, 0, 0],
        [7.0] * 6 + [1.0] * 6,
        [1 + 1e-12 * k for k in range(10)],
        [3.0],
        [0.0] * 5,
        [2.0, -2.0, 1.0, -1.0],
    ],
)
def test_leading_eigenvalues(values):
    rng = np.random.default_rng(len(values))
    m = symmetric(rng, len(values), values)
    k = min(8, len(values))
    found = whitening.leading(m, k)
    size = np.abs(values).max() + 1e-300
    assert np.abs(found.values - np.sort(values)[::-1][:k]).max() <= 1e-12 * size
    assert np.abs(found.vectors.T @ found.vectors - np.eye(k)).max() < 1e-12
    assert np.abs(m @ found.vectors - found.vectors * found.values).max() <= 1e-11 * size
    assert all(over < n <= upto for n, (over, upto) in enumerate(found.counts, 1))


def expected(rows, k):
    """By exact fractions and numpy's eigenvalues."""
    good = [
        (i, [math.floor(1024 * float(c)) + 100_000 for c in v])
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    x = [v for _, v in good]
    n, d = len(x), len(x[0])
    s = [sum(v[j] for v in x) for j in range(d)]
    centred = [[Fraction(n * v[j] - s[j], n) for j in range(d)] for v in x]
    f = np.array([[float(c) for c in v] for v in centred])
    cov = np.array([[float(sum(a[i] * a[j] for a in centred) / n) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    deviations = [sum((n * v[j] - s[j]) ** 2 for j in range(d)) for v in x]
    return [i for i, _ in good], n, deviations, f @ u / np.sqrt(e), e / np.trace(cov)


def check(spark, rows, k=8, parts=3):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(parts)
    out = whitening.whiten(df, k).collect()
    ids, n, deviations, white, explained = expected(rows, k)
    assert len(out) == len(ids) * white.shape[1]
    by = {(r.vec_id, r.component): r for r in out}
    for j in range(white.shape[1]):
        got = np.array([by[i, j + 1].whitened for i in ids])
        sign = np.sign(got @ white[:, j])
        assert np.abs(got * sign - white[:, j]).max() < 1e-9
        assert abs(by[ids[0], j + 1].explained / explained[j] - 1) < 1e-12
    assert [int(by[i, 1].deviation) for i in ids] == deviations
    assert {r.n for r in out} == {n} and max(r.identity_error for r in out) < 1e-9


def test_against_numpy(spark):
    rng = np.random.default_rng(0)
    x = (rng.standard_normal((300, 12)) * np.linspace(1, 3, 12) + 5).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1001, None), (1002, [None] + [0.1] * 11), (1003, [math.nan] * 12), (1004, [math.inf] * 12)]
    check(spark, rows)


def test_fewer_dimensions_than_components(spark):
    rng = np.random.default_rng(1)
    check(spark, [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((50, 3)).astype(np.float32))])


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(2)
    x = (rng.standard_normal((40, 4)) * 3e7).astype(np.float32)
    check(spark, [(i, v.tolist()) for i, v in enumerate(x)])


def test_smallest_table(shipped):
    from clickloom.llm.queries import QUERIES

    out = QUERIES["op12_whitening"](shipped, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in shipped.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(out.dtypes)["deviation"] == "bigint"
    ids, n, deviations, white, explained = expected(rows, 8)
    found = {(r.vec_id, r.component): r for r in out.collect()}
    assert len(found) == 8 * n and [found[i, 3].deviation for i in ids] == deviations
    for j in range(8):
        got = np.array([found[i, j + 1].whitened for i in ids])
        assert np.abs(np.abs(got) - np.abs(white[:, j])).max() < 1e-8
        assert abs(found[ids[0], j + 1].explained / explained[j] - 1) < 1e-10


def test_edges(spark):
    kind = "vec_id long, embedding array<float>, component string, n string"
    make = lambda rows: spark.createDataFrame(rows, kind)
    assert whitening.whiten(make([])).collect() == []
    assert whitening.whiten(make([(1, None, "a", "b"), (2, [], "a", "b")])).collect() == []
    one = whitening.whiten(make([(None, [1.0, 2.0], "a", "b")] * 3)).collect()
    assert len(one) == 6 and all(
        r.vec_id is None and r.n == 3 and r.deviation == 0 and r.whitened is None
        and r.explained is None and r.identity_error is None for r in one
    )
    # One direction only: the second component has no variance; a third length takes no part.
    line = whitening.whiten(make([(i, [float(i), 0.0], "", "") for i in range(5)] + [(9, [1.0], "", "")]))
    rows = line.collect()
    assert len(rows) == 10 and {r.whitened is None for r in rows if r.component == 2} == {True}
    first = [r for r in rows if r.component == 1]
    assert all(r.explained == 1.0 and r.identity_error < 1e-12 for r in first)
    assert spark.range(1).select(whitening.as_long(F.lit(10).cast("decimal(38,0)") * 10**18)).first()[0] is None


def test_the_deal_of_rows_changes_no_integer(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    fine = whitening.usable(rows)
    a = whitening.fit(fine.repartition(1), 64)
    b = whitening.fit(fine.repartition(7), 64)
    assert a.n == b.n and a.left == b.left and (a.values == b.values).all() and (a.vectors == b.vectors).all()
