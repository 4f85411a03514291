"""Centroid clustering of integer vectors in JVM expressions.

Distances of a vector to all centroids are ``zip_with`` and ``aggregate`` over literal centroid arrays; ``array_min`` of
(distance, number) structs chooses the cluster; each round is one aggregate of component sums by cluster, which is
combined before the shuffle, so that only a row per cluster and task moves. The driver holds the centroids alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
#: Scaled components are held within these bounds, so that a squared distance always fits into a long.
MOST = 1 << 27

Centroids = list[list[int]]


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, vector) of the rows of ``vectors(vec_id, embedding)`` with ``dimensions`` finite components, each
    scaled and rounded down. Other rows (null vectors and components included) are left out."""
    values = F.col("embedding").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    scaled = F.transform(values, lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(float(MOST))), F.lit(-float(MOST)))))
    kept = vectors.where((F.size(values) == dimensions) & F.forall(values, finite))
    return kept.select("vec_id", scaled.alias("vector"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> Centroids:
    """The vectors with the smallest sha256 of ``seed:vec_id`` (a null id counts as empty text; ties by components)."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [list(r.vector) for r in vectors.select(draw.alias("draw"), "vector").orderBy("draw", "vector").limit(clusters).collect()]


def nearest(vector: Column, centroids: Centroids) -> Column:
    """struct(distance, cluster): the least squared distance and the smallest number that has it."""
    square = lambda x, y: (x - y) * (x - y)
    distances = [
        F.aggregate(F.zip_with(vector, _longs(c), square), F.lit(0).cast("long"), lambda total, d: total + d) for c in centroids
    ]
    return F.array_min(F.array(*(F.struct(d.alias("distance"), F.lit(k).alias("cluster")) for k, d in enumerate(distances))))


def _longs(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")  # one literal, not a call for each value


def next_centroids(vectors: DataFrame, centroids: Centroids) -> Centroids:
    """Each centroid moved to the floor of its vectors' mean, component by component; empty ones stay."""
    sums = [F.expr(f"sum(vector[{i}]) AS s{i}") for i in range(len(centroids[0]))]
    assigned = vectors.select(nearest(F.col("vector"), centroids)["cluster"].alias("cluster"), "vector")
    moved = list(centroids)
    for row in assigned.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():  # one row per cluster
        moved[row.cluster] = [row[f"s{i}"] // row.n for i in range(len(sums))]
    return moved


def fit(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> Centroids:
    """Centroids after ``rounds`` rounds. Once a round moves none, all later ones would repeat it and are left out."""
    centroids = first_centroids(vectors, clusters, seed)
    for _ in range(rounds if centroids else 0):
        moved = next_centroids(vectors, centroids)
        if moved == centroids:
            break
        centroids = moved
    return centroids


def clusters(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """One row per kept row of ``vectors``: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors with 64 finite components (null for one, too few or too many: left out). Repeated rows count each;
    fewer kept vectors than clusters give as many clusters as vectors; ties go to the smaller number; other columns
    are ignored; an empty table gives an empty result. Components beyond 131,072 in size count as that. Inertias are
    exact, null where beyond a long.
    """
    kept = materialize(integer_vectors(vectors), "integer-vectors")
    centroids = fit(kept, clusters, rounds, seed)
    if not centroids:
        empty = "CAST(0 AS INT) AS cluster, 0L AS distance, 0L AS cluster_inertia, 0L AS inertia, '' AS centroid_sha256"
        return kept.selectExpr("vec_id", *empty.split(", "))
    assigned = kept.select("vec_id", nearest(F.col("vector"), centroids).alias("near"))
    assigned = materialize(assigned.select("vec_id", "near.cluster", "near.distance"), "assigned")
    halves = [  # two sums of 32 bits each, so that no sum of distances overflows
        F.sum(F.shiftright("distance", 32)).alias("high"),
        F.sum(F.col("distance").bitwiseAND(0xFFFFFFFF)).alias("low"),
    ]
    inertia = {r.cluster: (r.high << 32) + r.low for r in assigned.groupBy("cluster").agg(*halves).collect()}
    as_long = lambda n: F.lit(n if n < 1 << 63 else None).cast("long")
    by_cluster = lambda values: F.get(F.array(*values), F.col("cluster"))
    numbers = range(len(centroids))
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        by_cluster([as_long(inertia.get(k, 0)) for k in numbers]).alias("cluster_inertia"),
        as_long(sum(inertia.values())).alias("inertia"),
        by_cluster([F.sha2(F.lit(",".join(map(str, centroids[k]))), 256) for k in numbers]).alias("centroid_sha256"),
    )
