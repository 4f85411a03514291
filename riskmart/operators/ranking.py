"""Exact order statistics without a single-task window over raw rows.

Ties are first collapsed to one row per (group, value) with map-side partial sums. The
collapsed rows are range-partitioned by (group, value), so that a group of any size spreads
over all tasks, in value order. A window then runs inside each (group, range) piece, and a
second one over the pieces, of which there are at most as many as shuffle partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = "_piece"


def usable(score: Column) -> Column:
    return score.isNotNull() & ~F.isnan(score)


def tied_counts(rows: DataFrame, keys: list[str], score: str, label: str) -> DataFrame:
    """One row per (keys, score): row count, positives and negatives. Rows whose score is
    NULL or NaN keep their place in ``rows`` but rank nowhere."""
    value = F.col(score).cast("double")
    ranked = usable(value)
    return rows.groupBy(*keys, F.when(ranked, value).alias("score")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(ranked & (F.col(label) == 1), 1)).alias("pos"),
        F.count(F.when(ranked & (F.col(label) == 0), 1)).alias("neg"),
    )


def in_pieces(
    counts: DataFrame, keys: list[str], order: str, descending: bool = False, pieces: int | None = None
) -> DataFrame:
    """Range-partition by (keys, order); ``_piece`` numbers the ranges in that order. A given number of ``pieces`` is
    kept by the adaptive planner, so that all readers of the shuffle see the same ones."""
    direction = F.col(order).desc() if descending else F.col(order).asc()
    columns = [*map(F.col, keys), direction]
    ranged = counts.repartitionByRange(*columns) if pieces is None else counts.repartitionByRange(pieces, *columns)
    return ranged.withColumn(PIECE, F.spark_partition_id())


def rank_sum(
    counts: DataFrame, keys: list[str], carry: dict[str, Column] | None = None
) -> DataFrame:
    """Per group: positives, negatives and the tie-aware rank sum
    ``sum_s pos_s * (neg_below_s + neg_s / 2)``; ``carry`` adds sums over the collapsed rows.

    A single linear plan: pieces are built once and never joined back.
    """
    carry = carry or {}
    below = (
        Window.partitionBy(*keys, PIECE).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    )
    pieces = in_pieces(counts, keys, "score").withColumn(
        "below", F.coalesce(F.sum("neg").over(below), F.lit(0)).cast("double")
    )
    per_piece = pieces.groupBy(*keys, PIECE).agg(
        F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2.0)).alias("inner_sum"),
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        *[F.sum(c).alias(name) for name, c in carry.items()],
    )
    earlier = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("neg").over(earlier), F.lit(0)).cast("double")
    return (
        per_piece.withColumn("offset", offset)
        .groupBy(*keys)
        .agg(
            F.sum(F.col("inner_sum") + F.col("pos") * F.col("offset")).alias("rank_sum"),
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
            *[F.sum(name).alias(name) for name in carry],
        )
    )


def auc_from_rank_sum() -> Column:
    """AUC; NULL when a group has one class only."""
    pairs = F.col("pos").cast("double") * F.col("neg").cast("double")
    return F.when(pairs > 0, F.col("rank_sum") / pairs)


def running_totals(
    counts: DataFrame, keys: list[str], order: str, measures: list[str], descending: bool = False
) -> DataFrame:
    """Keys, order and measures and, for each measure, ``<m>_to`` (inclusive running total in the group) and
    ``<m>_all`` (group total).

    A prefix sum: rows are summed inside each range piece, the pieces' sums are added up, and each piece is shifted by
    the sums before it. Rows and sums come from one shuffle, which the planner reuses, so the input is read once and
    nothing is written. Range bounds are sampled, so a plan without the reuse could see other pieces: a row beyond
    the sums of its piece is an error, never a wrong total. Every total is checked by all measures: a reader of few
    totals still reads all measures on both sides, else the two shuffles would have other columns and not be one.
    """
    spark = counts.sparkSession
    counts = counts.select(*keys, order, *measures)
    pieces = in_pieces(counts, keys, order, descending, int(spark.conf.get("spark.sql.shuffle.partitions")))
    per_piece = pieces.groupBy(*keys, PIECE).agg(*[F.sum(m).alias(m) for m in measures])
    earlier = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = per_piece.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col(PIECE).alias("_k_piece"),
        *[F.col(m).alias(f"{m}_piece") for m in measures],
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"{m}_before") for m in measures],
        *[F.sum(m).over(whole).alias(f"{m}_all") for m in measures],
    )
    direction = F.col(order).desc() if descending else F.col(order).asc()
    inside = (
        Window.partitionBy(*keys, PIECE).orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    )
    local = pieces.select("*", *[F.sum(m).over(inside).alias(f"{m}_in") for m in measures])
    match = local[PIECE] == offsets["_k_piece"]
    for k in keys:
        match &= local[k].eqNullSafe(offsets[f"_k_{k}"])
    joined = local.join(offsets, match, "left")

    # Null where the piece has no sums.
    same = reduce(lambda a, b: a & b, [F.col(f"{m}_in") <= F.col(f"{m}_piece") for m in measures])

    def checked(total: Column) -> Column:
        return F.when(same, total).otherwise(
            F.raise_error(F.lit("the range pieces of a ranking differ; is spark.sql.exchange.reuse off?")).cast("long")
        )

    return joined.select(
        *[local[c] for c in counts.columns],
        *[checked(F.col(f"{m}_before") + F.col(f"{m}_in")).alias(f"{m}_to") for m in measures],
        *[checked(F.col(f"{m}_all")).alias(f"{m}_all") for m in measures],
    )


def percentiles(
    totals: DataFrame, keys: list[str], value: str, measure: str, probabilities: list[float], beside: list[str] | None = None
) -> DataFrame:
    """Exact percentiles with linear interpolation, from running totals of ``measure``.

    Result: keys, ``position`` (index into ``probabilities``) and ``percentile``. A plan that also reads the totals of
    other measures names them in ``beside``: they are kept to the end here, so that both parts have one shuffle.
    """
    last = F.col(f"{measure}_all").cast("double") - 1.0
    wanted = []
    for i, p in enumerate(probabilities):
        rank = F.lit(float(p)) * last
        low = F.floor(rank)
        wanted.append((i, low, F.lit(True), rank - low))
        wanted.append((i, F.ceil(rank), F.lit(False), rank - low))
    targets = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"), r.cast("long").alias("rank"), w.alias("is_low"), t.alias("weight")
            )
            for i, r, w, t in wanted
        ]
    )
    start = F.col(f"{measure}_to") - F.col(measure)
    end = F.col(f"{measure}_to")
    # Few values carry a wanted rank: a plain condition drops the others before any array is built.
    carries_rank = reduce(lambda a, b: a | b, [(r >= start) & (r < end) for _, r, _, _ in wanted])
    hits = F.filter(targets, lambda t: (t["rank"] >= start) & (t["rank"] < end))
    kept = reduce(lambda a, b: a & b, [F.col(f"{m}_to") >= 0 for m in beside or []], F.col(measure) > 0)
    found = totals.where(kept & carries_rank).select(
        *keys, F.col(value).alias("_v"), F.inline(hits)
    )
    ends = found.groupBy(*keys, "position").agg(
        F.max(F.when(F.col("is_low"), F.col("_v"))).alias("a"),
        F.max(F.when(~F.col("is_low"), F.col("_v"))).alias("b"),
        F.max("weight").alias("t"),
    )
    a, b, t = F.col("a"), F.col("b"), F.col("t")
    # Interpolate from the nearer end, so that a whole rank gives the value itself.
    return ends.select(
        *keys, "position", F.when(t < 0.5, a + (b - a) * t).otherwise(b - (b - a) * (1.0 - t)).alias("percentile")
    )
