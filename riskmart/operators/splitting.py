"""Random splits that depend on the row key alone, never on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_order(key: list[str], seed: int) -> Column:
    return F.xxhash64(*[F.col(k) for k in key], F.lit(seed))


def random_split(rows: DataFrame, key: list[str], train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """Add ``part`` train / test by the first 32 bits of the key's md5: no shuffle at all, and any engine that has md5
    finds the same parts. Null keys count as empty text."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts).cast("binary"))
    position = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return rows.withColumn("part", F.when(position < round(train_share * 2**32), "train").otherwise("test"))


def number_in_strata(
    rows: DataFrame, strata: list[str], key: list[str], seed: int, pieces: int | None = None
) -> DataFrame:
    """Add ``number`` (1, 2, ... inside the stratum, in hash order) and ``stratum_rows``.

    The hash is uniform, so its top bits cut every stratum into equal pieces however large it
    is. Rows are numbered inside a piece, and the pieces' row counts shift them; the piece is a
    function of the key, so both passes agree. The numbers do not depend on ``pieces``.
    """
    spark = rows.sparkSession
    wanted = pieces or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, (wanted - 1).bit_length())
    keyed = rows.withColumn("_hash", hash_order(key, seed)).withColumn(
        "_piece", F.shiftright(F.col("_hash"), 64 - bits)
    )
    counts = keyed.groupBy(*strata, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*strata).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(s).alias(f"_k_{s}") for s in strata],
        F.col("_piece").alias("_k_piece"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*strata)).alias("stratum_rows"),
    )
    inside = Window.partitionBy(*strata, "_piece").orderBy("_hash", *key)
    local = keyed.withColumn("_in", F.row_number().over(inside))
    match = local["_piece"] == offsets["_k_piece"]
    for s in strata:
        match &= local[s].eqNullSafe(offsets[f"_k_{s}"])
    return local.join(offsets, match).select(
        *[F.col(f"`{c}`") for c in rows.columns],
        (F.col("_before") + F.col("_in")).alias("number"),
        "stratum_rows",
    )


def stratified_folds(
    rows: DataFrame, label: str, key: list[str], folds: int = 5, seed: int = 42
) -> DataFrame:
    """Add ``fold`` 0..folds-1; within a label the folds differ by one row at most."""
    numbered = number_in_strata(rows, [label], key, seed)
    return numbered.withColumn("fold", ((F.col("number") - 1) % folds).cast("int")).drop(
        "number", "stratum_rows"
    )


def stratified_split(
    rows: DataFrame, label: str, key: list[str], test_share: float = 0.2, seed: int = 88
) -> DataFrame:
    """Add ``part``; the test part holds ``round(share * n)`` rows of each label."""
    numbered = number_in_strata(rows, [label], key, seed)
    is_test = F.col("number") <= F.floor(F.col("stratum_rows") * F.lit(test_share) + 0.5)
    return numbered.withColumn("part", F.when(is_test, "test").otherwise("train")).drop(
        "number", "stratum_rows"
    )


def class_counts(rows: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class, ``scale_pos_weight`` = n0 / n1 and the two balanced weights."""
    counts = rows.agg(
        F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")
    )
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    return counts.select(
        "n0",
        "n1",
        F.try_divide(n0, n1).alias("scale_pos_weight"),
        F.try_divide(n0 + n1, n0 * 2).alias("weight_0"),
        F.try_divide(n0 + n1, n1 * 2).alias("weight_1"),
    )
