"""Whitening against eigenvectors of the covariance, and the solver on awkward matrices."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mastlight.llm import whitening as w
from mastlight.llm.common import prepare
from mastlight.llm.queries import llm_queries

FOLDER = "/root/testdata/sf0.001"


def brute(vectors, components=4):
    """By key: deviation, whitened and explained, up to the sign of a component; keys are distinct."""
    x = {k: np.floor(256 * np.array(v, float)).astype(int) for k, v in vectors.items()}
    fitted = np.unique(np.array(list(x.values())), axis=0)
    n, s = len(fitted), fitted.sum(0)
    centred = (n * fitted - s) / n
    values, found = np.linalg.eigh(centred.T @ centred / n)
    values, found = values[::-1][:components], found.T[::-1][:components]
    out = {}
    for k, v in x.items():
        d = n * v - s
        out[k] = (n, int((d * d).sum()), (d / n) @ found.T / np.sqrt(values), values / np.trace(centred.T @ centred / n))
    return out


def compare(rows, wanted, components=4):
    signs = {}
    for r in rows:
        n, deviation, white, explained = wanted[r.vec_id]
        i = r.component - 1
        sign = signs.setdefault(i, 1 if abs(r.whitened) < 1e-9 or r.whitened * white[i] > 0 else -1)
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened - sign * white[i]) < 1e-8 and abs(r.explained / explained[i] - 1) < 1e-10
        assert r.identity_error < 1e-10
    assert len(rows) == components * len(wanted)


def test_whitening_equals_eigenvectors(spark):
    prepare(spark)
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = llm_queries()["op13_whitening"](spark, FOLDER).collect()
    compare(rows, brute({r.vec_id: r.embedding for r in table.collect()}))


def test_repeated_odd_and_short_vectors(spark):
    prepare(spark)
    rng = np.random.default_rng(5)
    vectors = {i: (rng.normal(size=5) * [9, 5, 3, 1, 0.5] * 100).tolist() for i in range(400)} | {i: [1.0, 2.0, 3.0, 4.0, 5.0] for i in range(400, 700)}
    rows = [*vectors.items(), (900, None), (901, [float("nan")] * 5), (902, [None] * 5), (903, []), (904, [float("inf")] * 5),
            (None, vectors[0]), (905, [1.0, 2.0]), (906, [1.0, 2.0]), (907, [7.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n", F.lit("x")).withColumn("size", F.lit("x"))
    got = w.whitened_components(frame.repartition(7)).collect()
    compare([r for r in got if r.vec_id is not None and r.vec_id < 700], brute(vectors))
    assert sum(r.vec_id is None for r in got) == 4
    alone = {(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got if (r.vec_id or 0) >= 900}
    assert alone == {(k, c, 1, 0, None, None, 0.0) for k, c in ((905, 1), (905, 2), (906, 1), (906, 2), (907, 1))}
    assert w.whitened_components(frame.limit(0)).count() == 0
    assert w.whitened_components(frame.where("embedding IS NULL")).count() == 0


def test_triangles_of_many_tasks_are_stacked(spark):
    prepare(spark)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 3)) @ rng.normal(size=(3, 3)) * 99
    whole = np.floor(x).astype(int)
    rows = spark.createDataFrame([(v,) for v in whole.tolist()], "x array<long>").repartition(40)
    triangle = w._triangles(rows, w._sums(rows))[3]
    centred = whole - whole.mean(0)
    assert np.allclose(triangle.T @ triangle, centred.T @ centred, rtol=1e-9)


def test_equal_variances_and_entries_that_are_large(spark):
    prepare(spark)
    axes = np.concatenate([np.eye(4), -np.eye(4)]) * 3
    rows = spark.createDataFrame(list(enumerate(axes.tolist())), "vec_id long, embedding array<double>")
    got = w.whitened_components(rows).collect()
    assert len(got) == 32 and all(r.identity_error < 1e-12 and abs(r.explained - 0.25) < 1e-12 for r in got)
    large = spark.createDataFrame([(1, [2.0**60, 0.0]), (2, [0.0, 1.0]), (3, [-(2.0**50), 5.0])], "vec_id long, embedding array<double>")
    got = w.whitened_components(large).collect()
    assert len(got) == 6 and all(r.identity_error < 1e-4 for r in got) and all(r.deviation is None for r in got if r.vec_id == 1)


@pytest.mark.parametrize("n", [1, 2, 3, 8, 40])
def test_solver_on_awkward_matrices(n):
    rng = np.random.default_rng(n)
    turned = np.linalg.qr(rng.normal(size=(n, n)))[0]
    cases = [rng.normal(size=(n, n)), np.eye(n), np.zeros((n, n)), np.ones((n, n)), np.triu(rng.normal(size=(n, n))),
             np.diag(np.repeat(np.arange(1.0, n + 1), 2)[:n]) @ turned, np.eye(n) + 1e-9 * rng.normal(size=(n, n)),
             rng.normal(size=(n, n)) * (np.arange(n) % 2), np.diag(10.0 ** -np.arange(n)) @ turned, rng.normal(size=(n, n)) * 1e-200]
    for a in cases:
        values, vectors = w.leading_vectors(a, 4)
        wanted = np.linalg.svd(a, compute_uv=False)
        scale = max(wanted[0], 1e-300)
        assert np.abs(values - wanted).max() <= 1e-13 * scale
        assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() < 1e-12
        for value, x in zip(values, vectors):
            assert np.linalg.norm((a / scale).T @ (a / scale @ x) - (value / scale) ** 2 * x) < 1e-12


def test_small_values_of_a_bidiagonal_matrix_keep_their_digits():
    diagonal, above = 10.0 ** -np.arange(0, 24, 2.0), 10.0 ** -np.arange(1, 23, 2.0)
    found = w.dqds(diagonal, above)
    # The product of all singular values is that of the diagonal: with the smallest lost in rounding it would not be.
    assert abs(math.fsum(np.log(found)) - math.fsum(np.log(diagonal))) < 1e-12
