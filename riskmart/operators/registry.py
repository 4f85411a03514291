"""Model registry tables: performance documents, versions, comparison and selection."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..config import TemporalSplits

SPLITS = ["test", "oot"]
# metric by which the best model is reported -> column of the comparison
BEST_BY = ["oot_gini", "oot_auc", "oot_pr_auc", "oot_f1", "test_gini"]


def _short(metric: str) -> str:
    return "auc" if metric == "auc_roc" else metric


METRIC_COLUMNS = [f"{s}_{_short(m)}" for s in SPLITS for m in fv.METRICS]
COMPARISON_COLUMNS = [
    "model",
    "train_samples",
    "test_samples",
    "oot_samples",
    *METRIC_COLUMNS,
    "top_feature",
]


def enabled_only(models: DataFrame, settings: DataFrame, model: str = "model") -> DataFrame:
    """Models switched on in ``settings`` (algorithm, enabled); all when none is."""
    chosen = settings.agg(F.collect_set(F.when(F.col("enabled"), F.col("algorithm"))).alias("on"))  # a few settings
    on = chosen.scalar()
    return models.where((F.size(on) == 0) | F.array_contains(on, F.col(model)))


def _interval_structs(splits: TemporalSplits | None) -> Column:
    """The windows of the run as ISO dates; null fields where there is none."""
    windows = splits.named() if splits else {}
    fields = []
    for name in ("train", "test", "oot"):
        window = windows.get(name)
        ends = [("start_date", window and window.start), ("end_date", window and window.end)]
        fields.append(F.struct(*[F.lit(d and d.isoformat()).cast("string").alias(n) for n, d in ends]).alias(name))
    return F.struct(*fields)


def performance_documents(
    evaluation: DataFrame,
    samples: DataFrame,
    importance: DataFrame | None = None,
    top_n: int = 20,
    splits: TemporalSplits | None = None,
    feature_count: int = len(fv.MODEL_FEATURES),
) -> DataFrame:
    """Nested performance record per model version.

    ``evaluation``: (algorithm, version, split, metrics...); ``samples``: (split, rows);
    ``importance``: (algorithm, method, feature, importance); ``splits``: the windows of the run.
    """
    metric_struct = F.struct(*[F.col(m) for m in fv.METRICS])
    metrics = evaluation.groupBy("algorithm", "version").agg(
        F.struct(
            *[F.max_by(metric_struct, F.when(F.col("split") == s, 1)).alias(s) for s in SPLITS]
        ).alias("metrics")
    )
    counts = [
        F.sum(F.when(F.col("split") == s, F.col("rows"))).alias(name)
        for s, name in [("train", "training_samples"), ("test", "test_samples"), ("oot", "oot_samples")]
    ]
    features = F.lit(feature_count).cast("long").alias("feature_count")
    sizes = samples.agg(*counts).select(F.struct("*", features).alias("data_info"))
    documents = metrics.withColumn("data_info", sizes.scalar())
    if importance is None:
        empty = F.lit(None).cast(
            "struct<method:string,importance:array<struct<feature:string,importance:double,abs_importance:double>>,"
            "top_features:array<struct<feature:string,importance:double,abs_importance:double>>>"
        )
        documents = documents.withColumn("feature_importance", empty)
    else:
        documents = documents.join(importance_structs(importance, top_n), "algorithm", "left")
    return documents.select(
        "algorithm",
        "version",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("training_date"),
        "metrics",
        "data_info",
        _interval_structs(splits).alias("temporal_splits"),
        "feature_importance",
    )


def model_metadata(documents: DataFrame, settings: dict, score: float, algorithms: list[str]) -> DataFrame:
    """The metadata record of saved versions: the performance document, what was searched and how it ran."""
    return documents.withColumns(
        {
            "model_name": F.col("algorithm"),
            "best_params": F.lit(json.dumps(settings, sort_keys=True)),
            "search_score": F.lit(score),
            "execution_mode": F.lit("single_algorithm" if len(algorithms) == 1 else "multi_algorithm"),
        }
    )


def importance_structs(importance: DataFrame, top_n: int = 20) -> DataFrame:
    """Importance lists per algorithm, greatest first; a model has few features."""
    entry = F.struct(
        (-F.abs("importance")).alias("order"),
        "feature",
        "importance",
        F.abs("importance").alias("abs_importance"),
    )
    listed = importance.groupBy("algorithm").agg(
        F.first("method").alias("method"), F.array_sort(F.collect_list(entry)).alias("ordered")
    )
    plain = F.transform(
        "ordered",
        lambda e: F.struct(
            e["feature"].alias("feature"),
            e["importance"].alias("importance"),
            e["abs_importance"].alias("abs_importance"),
        ),
    )
    return listed.select(
        "algorithm",
        F.struct("method", plain.alias("importance"), F.slice(plain, 1, top_n).alias("top_features")).alias(
            "feature_importance"
        ),
    )


def with_default(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def flatten_documents(documents: DataFrame) -> DataFrame:
    """The comparison row of each document; absent metrics are 0.0, no feature is ``N/A``."""
    metrics = [
        with_default(F.col(f"metrics.{s}.{m}"), 0.0).alias(f"{s}_{_short(m)}")
        for s in SPLITS
        for m in fv.METRICS
    ]
    info = F.col("data_info")
    top = F.try_element_at(F.col("feature_importance.top_features"), F.lit(1))["feature"]
    return documents.select(
        F.col("algorithm").alias("model"),
        with_default(info["training_samples"], 0).alias("train_samples"),
        with_default(info["test_samples"], 0).alias("test_samples"),
        with_default(info["oot_samples"], 0).alias("oot_samples"),
        *metrics,
        with_default(top, "N/A").alias("top_feature"),
    )


def wide_metrics(evaluation: DataFrame, model: str = "model_algorithm") -> DataFrame:
    """One row per model with test_* and oot_* metrics, pivoted from (model, split) rows."""
    pivoted = evaluation.groupBy(F.col(model).alias("model")).agg(
        *[
            F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{_short(m)}")
            for s in SPLITS
            for m in fv.METRICS
        ]
    )
    return pivoted.select("model", *[with_default(F.col(c), 0.0).alias(c) for c in METRIC_COLUMNS])


def ranked_models(comparison: DataFrame, position: str = "position") -> DataFrame:
    """Models by OOT GINI, greatest first; ties keep the listed order."""
    return comparison.orderBy(F.desc("oot_gini"), position)


def _first_best(metric: str, position: str) -> Column:
    return F.max_by("model", F.struct(F.col(metric), (-F.col(position)).alias("earlier")))


def best_models(comparison: DataFrame, position: str = "position") -> DataFrame:
    """The best model by each reported metric; of equal models the first listed wins."""
    return comparison.agg(*[_first_best(m, position).alias(m) for m in BEST_BY])


def recommendation(comparison: DataFrame, position: str = "position") -> DataFrame:
    """Recommended model, reason and the number compared; no row for fewer than two models."""
    return (
        comparison.agg(
            F.count(F.lit(1)).alias("models_compared"),
            _first_best("oot_gini", position).alias("recommended_model"),
            F.max("oot_gini").alias("_gini"),
        )
        .where(F.col("models_compared") >= 2)
        .select(
            "recommended_model",
            F.format_string("Best OOT GINI: %.4f", F.col("_gini")).alias("recommendation_reason"),
            "models_compared",
        )
    )


def comparison_document(comparison: DataFrame, position: str = "position") -> DataFrame:
    """The nested comparison report; one row, or none for fewer than two models."""
    columns = [c for c in COMPARISON_COLUMNS if c in comparison.columns]
    entry = F.struct(
        (-F.col("oot_gini")).alias("_order"), F.col(position).alias("_pos"), F.struct(*columns).alias("row")
    )
    listed = comparison.agg(
        F.count(F.lit(1)).alias("models_compared"),
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["row"]).alias("comparison_table"),
        F.struct(*[_first_best(m, position).alias(m) for m in BEST_BY]).alias("best_models"),
    ).where(F.col("models_compared") >= 2)
    first = F.element_at("comparison_table", 1)
    return listed.select(
        F.current_timestamp().cast("string").alias("timestamp"),
        "models_compared",
        "comparison_table",
        "best_models",
        first["model"].alias("recommended_model"),
        F.format_string("Best OOT GINI: %.4f", first["oot_gini"]).alias("recommendation_reason"),
    )


# Header of the comparison file (fixed values), in the order of ``COMPARISON_COLUMNS``.
CSV_HEADER = [
    "Model", "Train_Samples", "Test_Samples", "OOT_Samples",
    "Test_AUC", "Test_GINI", "Test_PR_AUC", "Test_Accuracy", "Test_Precision", "Test_Recall", "Test_F1",
    "OOT_AUC", "OOT_GINI", "OOT_PR_AUC", "OOT_Accuracy", "OOT_Precision", "OOT_Recall", "OOT_F1",
    "Top_Feature",
]


def comparison_file(comparison: DataFrame, position: str = "position") -> DataFrame:
    """The comparison under the file's column names, best model first; metrics as text with four decimals."""
    columns = [
        (F.format_string("%.4f", F.col(c)) if c in METRIC_COLUMNS else F.col(c)).alias(header)
        for c, header in zip(COMPARISON_COLUMNS, CSV_HEADER, strict=True)
    ]
    return ranked_models(comparison, position).select(*columns)


def chosen_model(recommended: DataFrame, override: str | None = None) -> DataFrame:
    """The override, else the recommendation, else the default; always exactly one row."""
    return recommended.agg(
        F.coalesce(
            F.lit(override).cast("string"), F.max("recommended_model"), F.lit(fv.DEFAULT_ALGORITHM)
        ).alias("algorithm")
    )


def degradation(comparison: DataFrame, metric: str = "auc") -> DataFrame:
    """Relative change from test to OOT (documented report column)."""
    test, oot = F.col(f"test_{metric}"), F.col(f"oot_{metric}")
    return comparison.select("model", F.try_divide(oot - test, test).alias("degradation"))


def newest(versions: DataFrame, keys: list[str], order: str, keep: int = 10) -> DataFrame:
    """The newest ``keep`` rows per key, numbered from 1. Spark limits each key's rows before the
    shuffle, so a key with many versions costs no more than the others."""
    recent = Window.partitionBy(*keys).orderBy(F.desc(order))
    return versions.withColumn("recency", F.row_number().over(recent)).where(F.col("recency") <= keep)


def version_index(documents: DataFrame, root: str) -> DataFrame:
    """Index rows of saved versions: paths, time and the headline metrics."""
    folder = F.concat(F.lit(f"{root}/"), F.col("algorithm"), F.lit("/v"), F.col("version"))
    pairs = [("auc", "auc_roc"), ("gini", "gini"), ("pr_auc", "pr_auc"), ("accuracy", "accuracy")]
    return documents.select(
        "version",
        F.concat(folder, F.lit("/model")).alias("model_path"),
        F.concat(folder, F.lit("/metadata")).alias("metadata_path"),
        F.concat(folder, F.lit("/performance")).alias("performance_path"),
        F.col("version").alias("created_at"),
        "algorithm",
        *[
            with_default(F.col(f"metrics.{s}.{m}"), 0.0).alias(f"{s}_{short}")
            for short, m in pairs
            for s in SPLITS
        ],
    )
