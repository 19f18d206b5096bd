"""Nearest neighbours against brute force: exact with factor one, recall otherwise."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mastlight.llm import neighbours as nn
from mastlight.llm.common import prepare
from mastlight.llm.queries import llm_queries

FOLDER = "/root/testdata/sf0.01"


def brute(vectors, queries, k):
    """(query, rank, key, score) by plain sums; vectors is a list of (key, vector)."""
    ids, x = np.array([k for k, _ in vectors]), np.array([v for _, v in vectors], float)
    out = {}
    for q in queries:
        for own in {tuple(v) for i, v in vectors if i == q}:
            score = (np.array(own) * x).sum(1)
            order = [i for i in np.lexsort([ids, -score]) if ids[i] != q][:k]
            out[q, own] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_query_recall_and_scores(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    vectors = [(r.vec_id, r.embedding) for r in table]
    wanted = {q: rows for (q, _), rows in brute(vectors, [r.vec_id for r in table if r.vec_id % 20 == 0], 20).items()}
    got = found(llm_queries()["op12_neighbours"](spark, FOLDER).collect())
    assert got.keys() == wanted.keys() and all(len(rows) == 20 for rows in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits >= 0.97 * 20 * len(wanted)
    x = dict(vectors)
    for q, rows in got.items():
        assert all(abs(s - np.dot(x[q], x[i])) < 1e-12 for i, s in rows) and rows == sorted(rows, key=lambda r: (-r[1], r[0]))


def test_factor_one_is_exact_over_many_regions_and_shards(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(nn, "SHARD_BYTES", 3000)  # dozens of regions; the crowded one has several shards
    monkeypatch.setattr(nn, "TOGETHER", 16)
    monkeypatch.setattr(nn, "REGIONS", 12)
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(8, 6)) * [1, 5, 1, 2, 1, 9]
    vectors = [(i, (centers[i % 8] + 0.3 * rng.normal(size=6)).round(2).tolist()) for i in range(700)]
    vectors += [(i, [1.0, 0.5, 0.0, -1.0, 0.0, 2.0]) for i in range(700, 1000)]  # a third of all rows
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = found(nn.nearest(frame, F.col("vec_id") % 20 == 0, 5, factor=1).collect())
    wanted = brute(vectors, range(0, 1000, 20), 5)
    assert got == {q: rows for (q, _), rows in wanted.items()}
    relaxed = found(nn.nearest(frame, F.col("vec_id") % 20 == 0, 5, factor=2.0).collect())
    hits = sum(len({i for i, _ in relaxed[q]} & {i for i, _ in rows}) for (q, _), rows in wanted.items())
    assert hits >= 0.9 * sum(map(len, wanted.values())) and all(len(relaxed[q]) == 5 for q, _ in wanted)


def test_odd_vectors(spark):
    prepare(spark)
    rows = [(20, [1.0, 2.0]), (20, [1.0, 2.0]), (21, [1.0, 2.0]), (22, [-3.0, 0.0]), (40, [2.0, 1.0]), (40, [0.0, 5.0]), (60, None), (80, [0.0, 0.0]),
            (100, [float("nan"), 1.0]), (120, [None, 1.0]), (140, []), (160, [float("inf"), 1.0]), (None, [9.0, 9.0]), (180, [1.0, 1.0, 1.0]), (23, [0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit("x")).withColumn("q", F.lit("x"))
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in nn.nearest(frame, F.col("vec_id") % 20 == 0, 3, factor=1).collect())
    assert got == [
        (20, 1, 40, 10.0), (20, 2, 21, 5.0), (20, 3, 40, 4.0),
        (40, 1, 20, 4.0), (40, 1, 20, 10.0), (40, 2, 21, 4.0), (40, 2, 21, 10.0), (40, 3, 22, -6.0), (40, 3, 22, 0.0)]
    assert nn.nearest(frame.limit(0), F.lit(True), 3).count() == 0
    assert nn.nearest(frame, F.lit(False), 3).count() == 0
    with pytest.raises(ValueError):
        nn.nearest(frame, F.lit(True), 3, factor=0.5)


def test_tree_bounds_hold_and_pruning_saves_work():
    rng = np.random.default_rng(9)
    points = np.concatenate([rng.normal(size=(900, 3)) + c for c in ([0, 0, 0], [40, 0, 0], [0, 40, 0])])
    shard = nn.Shard(np.arange(len(points)), points, float(np.sqrt((points**2).sum(1).max())), leaf=64)
    queries = points[::90] * 1.01
    far = np.sqrt(((points[:, None] - queries) ** 2).sum(2) + (shard.extra[:, None]) ** 2)
    to_points = shard.tree.to_points(queries, np.zeros(len(queries)))
    for rows, bounds in zip(shard.tree.leaves, shard.tree.bounds):
        assert (bounds.least(to_points) <= far[rows].min(0) + 1e-9).all()
    assert sorted(np.concatenate(shard.tree.leaves).tolist()) == list(range(len(points)))
    own = np.full(len(queries), -1)
    q, ids, score = shard.search(own, queries, np.full(len(queries), -np.inf), 4, 1.0)
    for i in range(len(queries)):
        exact = (queries[i] * points).sum(1)
        assert ids[q == i].tolist() == np.lexsort([np.arange(len(points)), -exact])[:4].tolist()
    assert shard.visited < 0.6 * len(points) * len(queries)
