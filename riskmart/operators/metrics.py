"""Classification metrics for any number of groups in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import auc_from_rank_sum, rank_sum, running_totals, tied_counts, usable


def gini(auc: Column) -> Column:
    return F.lit(2.0) * auc - 1.0


def hard_class(score: Column, threshold: float = 0.5) -> Column:
    return F.when(score > threshold, 1).otherwise(0)


def _ratio(numerator: Column, denominator: Column) -> Column:
    """A rate; 0 when its denominator is 0."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def rates(tp: str = "tp", fp: str = "fp", tn: str = "tn", fn: str = "fn") -> list[Column]:
    """Accuracy, precision, recall and F1 of confusion counts."""
    tp, fp, tn, fn = (F.col(c) for c in (tp, fp, tn, fn))
    return [
        _ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def confusion(rows: DataFrame, keys: list[str], predicted: Column, actual: Column) -> DataFrame:
    """Counts of the four outcomes per group; one pass, partial sums before the shuffle."""
    return rows.groupBy(*keys).agg(
        F.count_if((predicted == 1) & (actual == 1)).alias("tp"),
        F.count_if((predicted == 1) & (actual == 0)).alias("fp"),
        F.count_if((predicted == 0) & (actual == 0)).alias("tn"),
        F.count_if((predicted == 0) & (actual == 1)).alias("fn"),
    )


def balanced_score(tp: str = "tp", fp: str = "fp", tn: str = "tn", fn: str = "fn") -> Column:
    """AUC of hard labels, ``(TPR + TNR) / 2``; NULL when a class is absent."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in (tp, fp, tn, fn))
    return (F.try_divide(tp, tp + fn) + F.try_divide(tn, tn + fp)) / 2.0


def roc_auc(rows: DataFrame, keys: list[str], score: str, label: str) -> DataFrame:
    """Tie-aware ROC-AUC per group; lazy, exact and safe for a group of any size."""
    ranked = rank_sum(tied_counts(rows, keys, score, label), keys)
    return ranked.select(*keys, "pos", "neg", auc_from_rank_sum().alias("auc"))


def average_precision(rows: DataFrame, keys: list[str], score: str, label: str) -> DataFrame:
    """Average precision (step sum over distinct scores) per group."""
    return evaluate(rows, keys, score, label).select(*keys, "pr_auc")


def evaluate(
    rows: DataFrame, keys: list[str], score: str, label: str, threshold: float = 0.5
) -> DataFrame:
    """All metrics per group from one table of tied counts, scores descending."""
    known = rows.where(usable(F.col(score).cast("double")) & F.col(label).isNotNull())
    counts = tied_counts(known, keys, score, label)
    totals = running_totals(counts, keys, "score", ["pos", "neg"], descending=True)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    all_pos, all_neg = F.col("pos_all").cast("double"), F.col("neg_all").cast("double")
    below = all_neg - F.col("neg_to")
    precision = F.col("pos_to") / (F.col("pos_to") + F.col("neg_to"))
    positive = F.col("score") > threshold
    grouped = totals.groupBy(*keys).agg(
        F.sum(pos * (below + neg / 2.0)).alias("rank_sum"),
        # No positives at all: every recall step is empty and the sum is 0.
        F.coalesce(F.sum(F.try_divide(pos, all_pos) * precision), F.lit(0.0)).alias("pr_auc"),
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        F.sum(F.when(positive, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(positive, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~positive, F.col("neg")).otherwise(0)).alias("tn"),
        F.sum(F.when(~positive, F.col("pos")).otherwise(0)).alias("fn"),
    )
    scored = grouped.withColumn("auc_roc", auc_from_rank_sum())
    return scored.select(
        *keys,
        (F.col("pos") + F.col("neg")).alias("rows"),
        "auc_roc",
        gini(F.col("auc_roc")).alias("gini"),
        "pr_auc",
        *rates(),
        balanced_score().alias("balanced"),
    )
