"""Rank-one updates against a dense solver, and the whole operator against one."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstone.llm import whitening
from tillstone.llm.whitening import Spectrum, Whitening, rank_one


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 20), st.integers(0, 2**32 - 1), st.sampled_from(["any", "ties", "zeros", "close", "scaled"]), st.floats(1e-6, 1e6))
def test_rank_one_update_as_a_dense_solver(k, seed, kind, rho):
    rng = np.random.default_rng(seed)
    d, z = np.sort(rng.random(k) * 10), rng.normal(size=k)
    if kind == "ties":
        d = np.sort(rng.integers(0, 3, k).astype(float))
    elif kind == "zeros":
        z[rng.random(k) < 0.5] = 0
    elif kind == "close":
        d = np.sort(np.round(d) + rng.random(k) * 1e-13)
    elif kind == "scaled":
        d, z = np.sort(10.0 ** rng.integers(-12, 6, k)), z * 10.0 ** rng.integers(-8, 3, k)
    q = np.linalg.qr(rng.normal(size=(k, k)))[0]
    values, vectors = rank_one(d, q, z, rho)
    whole = q @ (np.diag(d) + rho * np.outer(z, z)) @ q.T
    scale = np.abs(whole).max()
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.abs(vectors @ np.diag(values) @ vectors.T - whole).max() < 1e-12 * k * scale
    assert (np.diff(values) >= 0).all()


def test_spectra_combine():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(90, 6)) * [900, 300, 300, 20, 1, 0]) + 100_000
    parts = [Spectrum(6) for _ in range(4)]
    for i, v in enumerate(x):
        parts[i % 3].add(v)  # the last part stays empty
    for other in parts[1:]:
        parts[0].combine(other)
    scatter = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    assert np.allclose(parts[0].vectors @ np.diag(parts[0].values) @ parts[0].vectors.T, scatter, atol=1e-9 * scatter.max())


def brute(rows, components=8):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in kept], dtype=object)
    n, s = len(x), x.sum(axis=0)
    centred = (x * n - s).astype(float) / n
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return [i for i, _ in kept], n, [int(d) for d in ((n * x - s) ** 2).sum(axis=1)], centred @ axes / np.sqrt(values), values / np.trace(cov)


@pytest.mark.parametrize("parts", [1, 5, 20])
def test_whitened_as_a_dense_solver(spark, parts):
    rng = np.random.default_rng(parts)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(150, 12)) * np.linspace(0.05, 1, 12))]
    rows += [(7, rows[7][1])] * 60 + [(900, None), (901, [None] * 12), (902, [math.nan] + [0.0] * 11), (903, [math.inf] * 12), (None, rows[3][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(parts).withColumns({"n": F.lit("x"), "part": F.lit(1)})
    ids, n, deviation, want, explained = brute(rows)
    got = whitening.op12(table).collect()
    assert len(got) == 8 * n and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-10
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    turn = {}
    for i, vec_id in enumerate(ids):
        for c in range(1, 9):
            r = by_id[vec_id][c]
            turn.setdefault(c, np.sign(r.whitened * want[i][c - 1]))
            assert r.deviation == deviation[i]
            assert abs(r.whitened - turn[c] * want[i][c - 1]) < 1e-8
            assert abs(r.explained - explained[c - 1]) < 1e-9


def test_tables_without_components(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.op12(spark.createDataFrame([], schema)).collect() == []
    assert whitening.op12(spark.createDataFrame([(1, None), (2, [])], schema)).collect() == []
    assert whitening.op12(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).collect() == []


def test_few_dimensions_other_lengths_and_large_entries(spark):
    rows = [(1, [0.0, 1.0]), (2, [1.0, 3.0]), (3, [2.0, 2.0]), (4, [1.0]), (5, []), (6, [1.0, 2.0, 3.0])]
    got = whitening.op12(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.component) for r in got) == [(i, c) for i in (1, 2, 3) for c in (1, 2)]
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whitening.op12(huge).collect() if r.vec_id < 3} == {None}


def test_line_of_points_has_one_component(spark):
    rows = [(i, [float(i), 2.0 * i, -1.0 * i]) for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), Whitening(width=2)).collect()
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-12
