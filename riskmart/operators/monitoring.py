"""Monthly model monitoring: all models and all months in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Thresholds
from ..functions import stability as st
from . import drift
from .metrics import gini
from .ranking import auc_from_rank_sum, rank_sum, tied_counts

MODEL, MONTH = "model_algorithm", "snapshot_month"


def monitor(
    scored: DataFrame,
    model: str = MODEL,
    month: str = MONTH,
    score: str = "model_predictions",
    label: str = "label",
    bins: int = 10,
) -> DataFrame:
    """Per model and month: rows, AUC, GINI and PSI against the model's first month.

    The rows are read once. They collapse to one row per (model, month, score); AUC and the
    score histogram are both sums over those.
    """
    keys = [model, month]
    bin_column = st.score_bin(F.col("score"), bins)
    carry = {"row_count": F.col("rows")}
    carry |= {f"bin_{i}": F.when(bin_column == i, F.col("rows")).otherwise(0) for i in range(bins)}
    sums = rank_sum(tied_counts(scored, keys, score, label), keys, carry)
    monthly = sums.select(
        *keys,
        "row_count",
        auc_from_rank_sum().alias("auc"),
        F.array(*[F.col(f"bin_{i}") for i in range(bins)]).alias("counts"),
    )
    compared = drift.against_first(monthly, [model], month)
    return compared.select(
        *keys, "row_count", "auc", gini(F.col("auc")).alias("gini"), "psi"
    )


def health_status(auc: Column, psi: Column, limits: Thresholds = Thresholds()) -> Column:
    """critical / warning / healthy; a NULL metric raises nothing. All comparisons are strict."""
    return (
        F.when((auc < limits.auc) | (psi > limits.psi_critical), "critical")
        .when(psi > limits.psi_warning, "warning")
        .otherwise("healthy")
    )


def with_status(monitoring: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    return monitoring.select(
        "*",
        st.psi_band(F.col("psi")).alias("psi_band"),
        health_status(F.col("auc"), F.col("psi"), limits).alias("status"),
    )


def latest(monitoring: DataFrame, model: str = MODEL, month: str = MONTH) -> DataFrame:
    """The newest month of each model."""
    rest = [c for c in monitoring.columns if c != model]
    newest = F.max_by(F.struct(*rest), month).alias("newest")
    return monitoring.groupBy(model).agg(newest).select(model, "newest.*")


def monitoring_documents(monitoring: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """One nested report per model: latest metrics, status and the monthly summary."""
    month = F.struct(
        F.col(MONTH).alias("month"), "auc", "gini", "psi", F.col("row_count").alias("row_count")
    )
    grouped = monitoring.groupBy(MODEL).agg(
        F.max_by(F.struct("auc", "gini", "psi", "row_count"), MONTH).alias("latest_metrics"),
        F.max(MONTH).alias("latest_snapshot_month"),
        F.array_sort(F.collect_list(month)).alias("monthly_summary"),
    )
    status = health_status(F.col("latest_metrics.auc"), F.col("latest_metrics.psi"), limits)
    return grouped.select(
        F.col(MODEL).alias("algorithm"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_updated"),
        "latest_snapshot_month",
        "latest_metrics",
        status.alias("status"),
        "monthly_summary",
    )


def date_coverage(predictions: DataFrame, labels: DataFrame, day: str = "snapshot_date") -> DataFrame:
    """Every snapshot date of either side and where it occurs."""
    p = predictions.select(day).distinct().withColumn("in_predictions", F.lit(True))
    t = labels.select(day).distinct().withColumn("in_labels", F.lit(True))
    present = p.join(t, day, "full_outer")
    return present.select(
        day,
        F.coalesce("in_predictions", F.lit(False)).alias("in_predictions"),
        F.coalesce("in_labels", F.lit(False)).alias("in_labels"),
    )


def common_dates(left: DataFrame, right: DataFrame, day: str = "snapshot_date") -> DataFrame:
    """Distinct first: a plain intersect would join the raw rows of both sides."""
    return left.select(day).distinct().intersect(right.select(day).distinct())


def dates_only_in(left: DataFrame, right: DataFrame, day: str = "snapshot_date") -> DataFrame:
    return left.select(day).distinct().subtract(right.select(day).distinct())


def score_summary(scored: DataFrame, keys: list[str], score: str = "model_predictions") -> DataFrame:
    return scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_predictions"),
        F.avg(score).alias("avg_probability"),
        F.stddev_samp(score).alias("std_probability"),
    )


def mean_shift(scored: DataFrame, model: str, sample: str, score: str, first: str, second: str) -> DataFrame:
    """Absolute difference of the mean scores of two samples, per model."""
    mean = [F.avg(F.when(F.col(sample) == s, F.col(score))) for s in (first, second)]
    return scored.groupBy(model).agg(
        mean[0].alias(f"mean_{first}"),
        mean[1].alias(f"mean_{second}"),
        F.abs(mean[1] - mean[0]).alias("shift"),
    )


def drift_zones(monitoring: DataFrame) -> DataFrame:
    """Green / yellow / red zone per metric (documented thresholds)."""

    def zone(green: Column, yellow: Column) -> Column:
        return F.when(green, "green").when(yellow, "yellow").otherwise("red")

    auc, psi, gin, n = F.col("auc"), F.col("psi"), F.col("gini"), F.col("row_count")
    return monitoring.select(
        MODEL,
        MONTH,
        F.when(auc.isNotNull(), zone(auc >= 0.75, auc >= 0.70)).alias("auc_zone"),
        F.when(psi.isNotNull(), zone(psi < 0.10, psi <= 0.25)).alias("psi_zone"),
        F.when(gin.isNotNull(), zone(gin >= 0.50, gin >= 0.40)).alias("gini_zone"),
        zone(n > 500, n >= 100).alias("volume_zone"),
    )
