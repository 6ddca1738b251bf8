import math
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from docketry.llm import ann
from docketry.llm.ann import Graph, nearest


def rows_of(x, start=0):
    return [(start + i, [float(v) for v in r], 1) for i, r in enumerate(x.astype(np.float32))]


def brute(rows, k=20):
    ok = sorted({(i, tuple(np.float32(v) for v in x)) for i, x, _ in rows if i is not None and x and all(v is not None and math.isfinite(v) for v in x) and any(x)})
    out = {}
    for i, x in ok:
        if i % 20 == 0:
            out.setdefault(i, []).append(sorted((-float(np.dot(np.asarray(x, float), np.asarray(y, float))), j) for j, y in ok if len(y) == len(x) and (j, y) != (i, x))[:k])
    return out


def test_exact_on_small_and_odd_tables(spark):
    rng = np.random.default_rng(1)
    rows = rows_of(rng.normal(size=(15, 6)))
    rows += [(100, None, 1), (120, [0.0] * 6, 1), (140, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (160, [float("nan")] + [1.0] * 5, 1), (None, [1.0] * 6, 1), (180, [1.0, 2.0], 1), (181, [2.0, 2.0], 1), (200, [], 1)]
    rows += [rows[0], rows[0]] + [(40 + i, rows[3][1], 1) for i in range(30)]
    got = defaultdict(list)
    for r in sorted(nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")).collect(), key=lambda r: r["rank"]):
        got[r.query_id].append((-r.score, r.vec_id))
    want = brute(rows)
    assert set(got) == {i for i, w in want.items() if w[0]}
    for i, found in got.items():
        assert [v for _, v in found] == [v for _, v in want[i][0]]
        assert np.allclose([s for s, _ in found], [s for s, _ in want[i][0]], rtol=1e-12, atol=1e-12)


def test_recall_over_shards(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 24)) * 2
    x = centres[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 24))
    x *= rng.uniform(0.5, 2, (3000, 1))
    rows = rows_of(x)
    got = defaultdict(set)
    for r in nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), shard_size=700).collect():
        got[r.query_id].add(r.vec_id)
    want = brute(rows)
    hits = [len(got[i] & {v for _, v in w[0]}) / 20 for i, w in want.items()]
    assert all(len(v) == 20 for v in got.values()) and np.mean(hits) >= 0.95


def recall(spark, x, **settings):
    """Share of the true 20 nearest found, over the queries."""
    got = defaultdict(set)
    for r in nearest(spark.createDataFrame(rows_of(x), "vec_id long, embedding array<float>, label int"), **settings).collect():
        got[r.query_id].add(r.vec_id)
    near = x.astype(np.float32).astype(float)
    scores = near[::20] @ near.T
    scores[np.arange(len(scores)), np.arange(0, len(x), 20)] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :20]
    return np.mean([len(got[20 * k] & set(b.tolist())) / 20 for k, b in enumerate(best)])


def test_recall_on_vectors_of_any_length(spark):
    """Gaussian vectors as they come: no clusters, and lengths that decide much of the order. One shard, and six of them."""
    x = np.random.default_rng(3).normal(size=(6000, 64))
    assert recall(spark, x) >= 0.9
    assert recall(spark, x, shard_size=1000, block=100) >= 0.95


def test_work_does_not_grow_with_queries_times_shards(spark):
    """Sixty shards of clustered vectors: a query visits a few parts, as many as a sample's exact answers ask for, and finds its answers."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 32))[rng.integers(0, 60, 12000)] * 2 + rng.normal(size=(12000, 32))
    assert recall(spark, x, shard_size=200) >= 0.9
    nodes = spark.createDataFrame(rows_of(x), "vec_id long, vector array<float>, dim int").withColumns({"dim": F.size("vector"), "h": F.xxhash64("vector")})
    centres = ann.fit_centres(nodes, 200, 5)
    placed = nodes.mapInArrow(ann.dealt(centres), "vec_id long, vector array<float>, dim int, h long, part int")
    asked = nodes.where("vec_id % 20 = 0").selectExpr("vec_id as query_id", "vector", "dim", "vec_id as query")
    visits = ann.visits_of(placed, asked, centres, 20)
    assert len(centres[32][0]) == 60 and ann.FEW <= visits[32] <= 30
    assert asked.mapInArrow(ann.routed(centres, visits), "query_id long, vector array<float>, dim int, query long, part int, nth int").count() == 600 * visits[32]


def test_recall_over_many_parts_without_clusters(spark):
    x = np.random.default_rng(5).normal(size=(6000, 64))
    assert recall(spark, x, shard_size=200, block=50) >= 0.9
    assert recall(spark, x / np.linalg.norm(x, axis=1, keepdims=True), shard_size=200) >= 0.9


def test_degree_and_edges():
    g = Graph(np.random.default_rng(0).normal(size=(500, 8)).astype(np.float32), 16, 32, 1.2, 1)
    assert g.near.shape == (500, 16) and (g.near < 500).all() and (g.near != np.arange(500)[:, None]).all()


def test_empty(spark):
    assert nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
