import hashlib
import math

import numpy as np

from riskmart.llm import kmeans


def brute(rows, clusters=8, rounds=10):
    """(vec_id, cluster, distance) per kept row, and the centroids, in plain Python integers."""
    kept = []
    for r in rows:
        v = r.embedding
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((r.vec_id, [math.floor(1024 * x) for x in v]))
    drawn = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [v for _, v in drawn[:clusters]]
    distance = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    nearest = lambda v: min((distance(v, c), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(m) for x in zip(*m)] if m else c for c, m in zip(centroids, members)]
    return [(i, *nearest(v)[::-1]) for i, v in kept], centroids


def assert_same(found, rows):
    want, centroids = brute(rows)
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in found), key=key) == sorted(want, key=key)
    for r in found:
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()
        assert r.cluster_inertia == sum(d for _, k, d in want if k == r.cluster)
        assert r.inertia == sum(d for *_, d in want)


def test_embeddings(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert_same(kmeans.clusters(vectors).collect(), vectors.collect())


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    some = [[float(x) for x in rng.normal(size=64)] for _ in range(30)]
    rows = [(i, v, "x", 1) for i, v in enumerate(some)]
    rows += [(3, some[3], None, 1), (3, some[3], None, 1), (None, some[0], "x", 1), (40, None, "x", 1), (41, [], "x", 1)]
    rows += [(42, some[0][:63], "x", 1), (43, some[0] + [0.0], "x", 1), (44, some[0][:63] + [None], "x", 1)]
    rows += [(45, some[0][:63] + [float("nan")], "x", 1), (46, some[0][:63] + [float("-inf")], "x", 1)]
    rows += [(47, [1000.0] * 64, "x", 1), (48, [-0.0004] * 64, "x", 1)]
    schema = "vec_id long, embedding array<double>, cluster string, distance int"
    vectors = spark.createDataFrame(rows, schema)
    found = kmeans.clusters(vectors).collect()
    assert len(found) == 35
    assert_same(found, vectors.collect())
    empty = kmeans.clusters(vectors.limit(0))
    assert empty.count() == 0 and empty.columns == kmeans.clusters(vectors).columns


def test_fewer_vectors_than_clusters_and_ties(spark):
    same = [0.5] * 64
    vectors = spark.createDataFrame([(1, same), (2, same), (2, same)], "vec_id long, embedding array<float>")
    found = kmeans.clusters(vectors).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in found} == {(0, 0, 0)}
    assert_same(found, vectors.collect())


def test_components_beyond_bounds_do_not_overflow(spark):
    vectors = spark.createDataFrame([(1, [1e300] * 64), (2, [-1e300] * 64), (3, [0.0] * 64)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in kmeans.clusters(vectors, clusters=1).collect()}
    assert all(r.distance == 64 * kmeans.MOST**2 for i, r in found.items() if i != 3)
    assert found[3].inertia is None or found[3].inertia == 2 * 64 * kmeans.MOST**2


def test_no_python_and_partial_sums(spark, sf_dir):
    vectors = kmeans.integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    near = kmeans.nearest(vectors["vector"], [[0] * 64, [1] * 64])
    plan = vectors.groupBy(near["cluster"]).count()._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "partial_count" in plan
