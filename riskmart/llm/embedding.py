"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors with cosine of at least ``COSINE`` lie within squared distance D = 2 (1 - COSINE). After a random
rotation they are split into low-dimensional blocks; if all blocks were further apart than D / blocks, so would be
the whole, hence a near pair is near in some block. Each block is range-joined under that budget: points fall
into cells of its first two coordinates, and a cell meets itself and its neighbours. Candidates of all blocks
are united and checked exactly on the original vectors.

Equal vectors are joined once. A cell's points are dealt into ``slots`` on either side, each pair of slots being a
task of its own, so no cell is gathered in one place. The length of a vector counts as part of its label: each length
has its own rotation, blocks and budget in the same join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, materialize

COSINE = 0.98
BLOCK_DIMS = 8
#: Points of one label that one side of a task is meant to hold at most, were all in one cell.
SLOT_POINTS = 20_000
SEED = 11
#: Added to the budget, so that rounding in the rotation loses no pair; the exact check follows.
SLACK = 1e-9
ROWS_AT_A_TIME = 1024


@lru_cache(maxsize=16)
def rotation(dims: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _budget(dims: int, cosine: float) -> float:
    """The share of a block of vectors of this length."""
    return 2 * (1 - cosine) / math.ceil(dims / BLOCK_DIMS)


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        lengths = pc.list_value_length(batch.column("unit")).to_numpy(zero_copy_only=False)
        for dims in np.unique(lengths):
            yield int(dims), batch.take(pa.array(np.flatnonzero(lengths == dims)))


def _points(slots: int, cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dims, batch in _by_length(batches):
            turn, n_blocks = rotation(dims), math.ceil(dims / BLOCK_DIMS)
            with_cells = 2 * math.sqrt(_budget(dims, cosine) + SLACK)
            ids = batch.column("rep").to_numpy(zero_copy_only=False)
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            vectors = batch.column("unit").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) @ turn
            for block in range(n_blocks):
                part = vectors[:, block * BLOCK_DIMS : (block + 1) * BLOCK_DIMS]
                cells = np.floor(part[:, :2] / with_cells).astype(np.int64)
                if part.shape[1] == 1:
                    cells = np.hstack([cells, np.zeros((len(cells), 1), np.int64)])
                packed = [row.tobytes() for row in np.ascontiguousarray(part)]
                # a point is home in its cell, and a guest in half of the cells around (the other half meets it at home)
                for guest, (dx, dy) in enumerate(((0, 0), (1, 0), (-1, 1), (0, 1), (1, 1))):
                    for slot in range(slots):
                        n = len(ids)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(labels, pa.int64()), pa.array(np.full(n, dims), pa.int32()), pa.array(np.full(n, block), pa.int32()),
                                pa.array(cells[:, 0] + dx), pa.array(cells[:, 1] + dy), pa.array(np.full(n, slot), pa.int32()),
                                pa.array(np.full(n, guest > 0)), pa.array(ids, pa.int64()), pa.array(packed, pa.binary()),
                            ],
                            ["label", "dims", "block", "x", "y", "slot", "guest", "rep", "part"],
                        )

    return run


def _near(cosine: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Pairs of one cell within the block's budget: home with home, and home with guests."""
        budget = _budget(int(rows["dims"].iloc[0]), cosine)
        parts = np.frombuffer(b"".join(rows["part"]), np.float64).reshape(len(rows), -1)
        ids, guest = rows["rep"].to_numpy(), rows["guest"].to_numpy()
        mine = rows["own"].to_numpy()  # home rows of this task's left side
        left, found_a, found_b = np.flatnonzero(mine & ~guest), [], []
        squares = (parts**2).sum(axis=1)
        for at in range(0, len(left), ROWS_AT_A_TIME):
            rows_now = left[at : at + ROWS_AT_A_TIME]
            apart = squares[rows_now][:, None] + squares[None, :] - 2 * parts[rows_now] @ parts.T
            i, j = np.nonzero(apart <= budget + SLACK)
            a, b = ids[rows_now[i]], ids[j]
            keep = (a < b) | (guest[j] & (a != b))
            found_a.append(np.minimum(a, b)[keep])
            found_b.append(np.maximum(a, b)[keep])
        a = np.concatenate(found_a) if found_a else np.zeros(0, np.int64)
        b = np.concatenate(found_b) if found_b else np.zeros(0, np.int64)
        return pd.DataFrame({"a": a, "b": b}).drop_duplicates()

    return run


def links(units: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Pairs (a, b), a < b, of rows of ``units(rep, label, unit)`` with equal labels and lengths and cosine >= ``cosine``.

    Labels may be of any type: their hashes deal the points out, and candidates are compared by the labels themselves."""
    largest = units.groupBy("label", F.size("unit")).count().agg(F.max("count")).first()[0] or 0
    slots = max(1, math.ceil(largest / SLOT_POINTS))
    schema = "label long, dims int, block int, x long, y long, slot int, guest boolean, rep long, part binary"
    points = units.select("rep", F.xxhash64("label").alias("label"), "unit").mapInArrow(
        _points(slots, cosine), schema
    )
    # a task is a cell and a pair of slots: home points of the left slot against all points of the right one
    own_slot = F.pmod(F.xxhash64("rep"), F.lit(slots)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("right")
    as_left = points.where(~F.col("guest") & (F.col("slot") == own_slot)).select("*", other).withColumn("own", F.lit(True))
    as_right = points.select("*", own_slot.alias("right")).withColumn("own", F.lit(False))
    if slots == 1:  # both sides are the same rows
        tasks = points.withColumn("right", F.lit(0)).withColumn("own", ~F.col("guest"))
    else:
        tasks = as_left.unionByName(as_right)
    keys = ["label", "dims", "block", "x", "y", "slot", "right"]
    near = tasks.groupBy(*keys).applyInPandas(_near(cosine), "a long, b long").where("a != b").distinct()
    left = units.select(F.col("rep").alias("a"), F.col("unit").alias("u"), F.col("label").alias("of_a"))
    right = units.select(F.col("rep").alias("b"), F.col("unit").alias("v"), F.col("label").alias("of_b"))
    product = F.aggregate(F.zip_with("u", "v", lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    same_label = F.col("of_a") == F.col("of_b")
    return near.join(left, "a").join(right, "b").where(same_label & (product >= cosine)).select("a", "b")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per row of ``vectors(vec_id, embedding, label)``: vec_id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null and their cosine in double precision is at least
    ``cosine``; vectors of different lengths have no cosine. Null, empty and zero vectors, and vectors with null
    or non-finite components link with nothing. Other columns are ignored; an empty table gives an empty result.
    """
    as_double = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", as_double.alias("e"))
    square = F.aggregate("e", F.lit(0.0), lambda s, x: s + x * x)  # null if a component is
    finite = ~F.exists("e", lambda x: F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    whole = F.col("label").isNotNull() & (F.size("e") > 0) & finite
    rows = rows.select("vec_id", "label", F.when(whole, F.col("e")).alias("e"), F.when(whole, square).alias("square"))
    # a square that under- or overflows is taken after scaling by the largest component
    top = F.array_max(F.transform("e", lambda x: F.abs(x)))
    scaled = F.transform("e", lambda x: x / F.col("top"))
    rows = rows.withColumn("top", top).withColumn("e", F.when(F.col("square").isNotNull() & (F.col("top") > 0), scaled))
    norm = F.sqrt(F.aggregate("e", F.lit(0.0), lambda s, x: s + x * x))
    rows = rows.withColumn("norm", norm).select(
        "vec_id", "label", F.transform("e", lambda x: x / F.col("norm")).alias("unit")
    )
    rows = materialize(rows.withColumn("row_id", F.monotonically_increasing_id()), "unit-vectors")
    usable = rows.where("unit is not null")

    same = usable.groupBy("label", "unit").agg(
        F.min("row_id").alias("rep"), F.min("vec_id").alias("least"), F.count("*").alias("copies")
    )
    same = materialize(same, "distinct-vectors")
    pairs = materialize(links(same.select("rep", "label", "unit"), cosine), "links")
    sides = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("rep"), F.col("b").alias("o")), F.struct(F.col("b").alias("rep"), F.col("a").alias("o")))).alias("s")).select("s.*")
    others = sides.join(same.select(F.col("rep").alias("o"), "copies"), "o").groupBy("rep").agg(F.sum("copies").alias("near"))
    roots = components(pairs).withColumnRenamed("node", "rep")
    nodes = same.select("rep", "label", "unit", "least", "copies").join(others, "rep", "left").join(roots, "rep", "left")
    nodes = materialize(nodes.withColumn("root", F.coalesce("root", "rep")), "nodes")
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    told = nodes.join(least, "root").select(
        "label", "unit", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    found = rows.join(told, ["label", "unit"], "left")
    component = F.coalesce("component_id", "vec_id")
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
