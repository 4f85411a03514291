"""Fixed table schemas. No reader of this package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

from .fixed_values import DRUGS, FEATURE_STORE_COLUMNS, METRICS

# Identifiers are BIGINT: INT would overflow, and so lose rows, at cluster scale.
_BIGINT = {"encounter_id", "patient_nbr"}
_INT = {
    "admission_type_id",
    "discharge_disposition_id",
    "admission_source_id",
    "time_in_hospital",
    "num_lab_procedures",
    "num_procedures",
    "num_medications",
    "number_outpatient",
    "number_emergency",
    "number_inpatient",
    "number_diagnoses",
}
ENCOUNTER_COLUMNS = [
    "encounter_id",
    "patient_nbr",
    "race",
    "gender",
    "age",
    "weight",
    "admission_type_id",
    "discharge_disposition_id",
    "admission_source_id",
    "time_in_hospital",
    "payer_code",
    "medical_specialty",
    "num_lab_procedures",
    "num_procedures",
    "num_medications",
    "number_outpatient",
    "number_emergency",
    "number_inpatient",
    "diag_1",
    "diag_2",
    "diag_3",
    "number_diagnoses",
    "max_glu_serum",
    "A1Cresult",
    *DRUGS,
    "change",
    "diabetesMed",
    "readmitted",
    "snapshot_date",
]


def _encounter_type(name: str) -> T.DataType:
    if name in _BIGINT:
        return T.LongType()
    if name in _INT:
        return T.IntegerType()
    return T.DateType() if name == "snapshot_date" else T.StringType()


ENCOUNTER = T.StructType([T.StructField(c, _encounter_type(c)) for c in ENCOUNTER_COLUMNS])
RAW_ENCOUNTER = T.StructType([T.StructField(c, T.StringType()) for c in ENCOUNTER_COLUMNS])

LABEL_STORE = T.StructType(
    [
        T.StructField("encounter_id", T.LongType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("snapshot_date", T.DateType()),
    ]
)


def _feature_type(name: str) -> T.DataType:
    if name == "medication_density":
        return T.DoubleType()
    return _encounter_type(name) if name in ENCOUNTER_COLUMNS and name != "diabetesMed" else T.IntegerType()


FEATURE_STORE = T.StructType([T.StructField(c, _feature_type(c)) for c in FEATURE_STORE_COLUMNS])

PREDICTIONS = T.StructType(
    [
        T.StructField("encounter_id", T.LongType()),
        T.StructField("snapshot_date", T.DateType()),
        T.StructField("model_algorithm", T.StringType()),
        T.StructField("model_predictions", T.DoubleType()),
        T.StructField("prediction_timestamp", T.TimestampType()),
    ]
)
MONITORING = T.StructType(
    [
        T.StructField("model_algorithm", T.StringType()),
        T.StructField("snapshot_month", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("auc", T.DoubleType()),
        T.StructField("gini", T.DoubleType()),
        T.StructField("psi", T.DoubleType()),
    ]
)

_METRIC_SET = T.StructType([T.StructField(m, T.DoubleType()) for m in METRICS])
_FEATURE_SCORE = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("importance", T.DoubleType()),
        T.StructField("abs_importance", T.DoubleType()),
    ]
)
_INTERVAL = T.StructType([T.StructField("start_date", T.StringType()), T.StructField("end_date", T.StringType())])
PERFORMANCE_DOCUMENT = T.StructType(
    [
        T.StructField("algorithm", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("training_date", T.StringType()),
        T.StructField(
            "metrics",
            T.StructType([T.StructField("test", _METRIC_SET), T.StructField("oot", _METRIC_SET)]),
        ),
        T.StructField(
            "data_info",
            T.StructType(
                [
                    T.StructField(c, T.LongType())
                    for c in ("training_samples", "test_samples", "oot_samples", "feature_count")
                ]
            ),
        ),
        T.StructField("temporal_splits", T.StructType([T.StructField(s, _INTERVAL) for s in ("train", "test", "oot")])),
        T.StructField(
            "feature_importance",
            T.StructType(
                [
                    T.StructField("method", T.StringType()),
                    T.StructField("importance", T.ArrayType(_FEATURE_SCORE)),
                    T.StructField("top_features", T.ArrayType(_FEATURE_SCORE)),
                ]
            ),
        ),
    ]
)
_INDEX_METRICS = [f"{s}_{m}" for m in ("auc", "gini", "pr_auc", "accuracy") for s in ("test", "oot")]
VERSION_INDEX = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in ("version", "model_path", "metadata_path", "performance_path", "created_at", "algorithm")
    ]
    + [T.StructField(m, T.DoubleType()) for m in _INDEX_METRICS]
)
PREDICTION_METADATA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("snapshot_date", T.StringType()),
        T.StructField("algorithm", T.StringType()),
        T.StructField("num_predictions", T.LongType()),
        T.StructField("avg_probability", T.DoubleType()),
        T.StructField("predictions_path", T.StringType()),
    ]
)
_MONTH_SUMMARY = T.StructType(
    [
        T.StructField("month", T.StringType()),
        T.StructField("auc", T.DoubleType()),
        T.StructField("gini", T.DoubleType()),
        T.StructField("psi", T.DoubleType()),
        T.StructField("row_count", T.LongType()),
    ]
)
MONITORING_DOCUMENT = T.StructType(
    [
        T.StructField("algorithm", T.StringType()),
        T.StructField("last_updated", T.StringType()),
        T.StructField("latest_snapshot_month", T.StringType()),
        T.StructField(
            "latest_metrics",
            T.StructType(
                [
                    T.StructField("auc", T.DoubleType()),
                    T.StructField("gini", T.DoubleType()),
                    T.StructField("psi", T.DoubleType()),
                    T.StructField("row_count", T.LongType()),
                ]
            ),
        ),
        T.StructField("status", T.StringType()),
        T.StructField("monthly_summary", T.ArrayType(_MONTH_SUMMARY)),
    ]
)
