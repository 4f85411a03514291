import numpy as np
from pyspark.sql import functions as F
import pytest

from riskmart.llm import embedding

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def brute(rows, cosine):
    usable = {}
    for at, (_, vector, label, _) in enumerate(rows):
        if label is None or vector is None or not vector or any(x is None or not np.isfinite(x) for x in vector):
            continue
        v = np.array(vector, float)
        if np.abs(v).max() > 0:
            usable[at] = v / np.linalg.norm(v)
    alike = lambda a, b: a != b and rows[a][2] == rows[b][2] and len(usable[a]) == len(usable[b])
    near = {at: {o for o in usable if alike(at, o) and usable[o] @ usable[at] >= cosine} for at in usable}
    out = []
    for at, row in enumerate(rows):
        seen, todo = {at}, [at]
        while todo:
            for other in near.get(todo.pop(), ()):
                if other not in seen:
                    seen.add(other)
                    todo.append(other)
        ids = [rows[o][0] for o in seen if rows[o][0] is not None]
        out.append((row[0], len(near.get(at, ())), min(ids) if ids else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("slots", [embedding.SLOT_POINTS, 30])
def test_links_and_components(spark, monkeypatch, slots):
    monkeypatch.setattr(embedding, "SLOT_POINTS", slots)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 64))
    rows = []
    for i in range(150):
        v = centres[i % 12] + rng.normal(size=64) * rng.choice([0.05, 0.1, 0.15, 0.2])
        rows.append((i, [float(np.float32(x)) for x in v * rng.uniform(0.1, 10)], int(i % 2), "x"))
    rows += [(200 + i, rows[i][1], rows[i][2], "x") for i in range(10)]
    rows += [(300, None, 1, "x"), (301, [0.0] * 64, 1, "x"), (302, [float("nan")] * 64, 1, "x"), (303, rows[0][1], None, "x")]
    rows += [(304, [None] * 64, 0, "x"), (305, [], 0, "x"), (306, [1.0, 2.0], 0, "x"), (1, rows[1][1], 1, "x")]
    found = embedding.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == brute(rows, 0.98)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


@pytest.mark.parametrize("slots", [embedding.SLOT_POINTS, 5])
def test_every_length_is_searched(spark, monkeypatch, slots):
    monkeypatch.setattr(embedding, "SLOT_POINTS", slots)
    rng = np.random.default_rng(7)
    rows = []
    for dims in (1, 2, 3, 8, 9, 20, 64):
        centres = rng.normal(size=(4, dims))
        for i in range(24):
            v = centres[i % 4] + rng.normal(size=dims) * rng.choice([0.0, 0.05, 0.1, 0.2])
            rows.append((1000 * dims + i, [float(np.float32(x)) for x in v], int(i % 2), "x"))
    rows += [(1, [1.0] * 5, 0, "x"), (2, [1.0] * 5, 0, "x"), (3, [1.0] * 6, 0, "x")]
    found = embedding.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == brute(rows, 0.98)


def test_empty_table(spark):
    assert embedding.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_labels_of_any_type(spark):
    near = [1.0, 0.0, 0.0, 0.001]
    for kind, labels in (("double", [1.2, 1.7, 1.2, None, 1.7]), ("string", ["a", "b", "a", None, "b"]), ("boolean", [True, False, True, None, False])):
        rows = [(i, near, label) for i, label in enumerate(labels)]
        vectors = spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")
        moved = vectors.withColumn("embedding", F.transform("embedding", lambda x: x + F.col("vec_id") * 1e-6))
        found = {r.vec_id: (r.n_links, r.component_id) for r in embedding.near_duplicates(moved).collect()}
        assert found == {0: (1, 0), 2: (1, 0), 1: (1, 1), 4: (1, 1), 3: (0, 3)}
