"""Medallion layers. Each handles all months in one plan; nothing loops over months."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv
from ..functions import encounter as enc
from ..functions import icd9
from ..functions.dates import snapshot_month
from ..schemas import ENCOUNTER


def bronze(raw: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Raw text rows with their month; ``first``/``last`` bound the snapshot dates loaded."""
    day = F.col("snapshot_date").try_cast("date")
    rows = raw
    if first is not None:
        rows = rows.where(day >= F.lit(first))
    if last is not None:
        rows = rows.where(day <= F.lit(last))
    return rows.withColumn("snapshot_month", snapshot_month(day))


def typed(rows: DataFrame, schema: T.StructType = ENCOUNTER) -> DataFrame:
    """Cast the columns that are present to their types; text that is no number becomes NULL."""
    types = {f.name: f.dataType for f in schema.fields}
    return rows.select(
        *[
            F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`")
            for c in rows.columns
        ]
    )


def silver(bronze_rows: DataFrame) -> DataFrame:
    """Typed encounters with the laboratory placeholders filled."""
    cleaned = typed(bronze_rows)
    results = [c for c in ("max_glu_serum", "A1Cresult") if c in cleaned.columns]
    return cleaned.withColumns({c: enc.none_if_missing(F.col(c)) for c in results})


def deduplicate(rows: DataFrame, key: tuple[str, ...] = ("encounter_id", "snapshot_date")) -> DataFrame:
    """One row per key (documented option of the cleaned layer): of rows that differ, the greatest by
    their other columns in order, nulls being smallest.

    The maximum of a struct sorts whole rows. They are shuffled first: before the shuffle a task may hold many rows that
    were narrow when they were read, after it the planner sizes the tasks by the rows themselves."""
    rest = [c for c in rows.columns if c not in key]
    last = F.max(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("last")
    return rows.repartition(*key).groupBy(*key).agg(last).select(*key, "last.*").select(*[f"`{c}`" for c in rows.columns])


def label_store(silver_rows: DataFrame) -> DataFrame:
    label = enc.readmission_label(F.col("readmitted")).alias("label")
    return silver_rows.select("encounter_id", label, "snapshot_date")


def feature_rules(strict_race: bool = False) -> dict[str, Callable[[], Column]]:
    """The rule of every derived feature, stored or optional, by name. A rule is built when it is
    called, so that a caller builds only the columns it selects."""
    c = F.col
    rules = {
        "race_cleaned": lambda: enc.race_cleaned(c("race")),
        **{n: partial(enc.race_flag, c("race"), n, strict_race) for n in enc.RACE_FLAGS},
        "is_female": lambda: enc.is_female(c("gender")),
        "age_midpoint": lambda: enc.age_midpoint(c("age")),
        "age_group_index": lambda: enc.age_group_index(c("age")),
        "age_group_label": lambda: enc.age_group_label(c("age")),
        "admission_type_desc": lambda: enc.admission_type_desc(c("admission_type_id")),
        "admission_severity_score": lambda: enc.admission_severity_score(c("admission_type_id")),
        "discharge_severity_score": lambda: enc.discharge_severity_score(c("discharge_disposition_id")),
        "admission_source_risk_score": lambda: enc.admission_source_risk_score(c("admission_source_id")),
        "medication_intensity": enc.medication_intensity,
        "diagnosis_density": enc.diagnosis_density,
        "max_glu_serum_ord": lambda: enc.max_glu_serum_ord(c("max_glu_serum")),
        "A1Cresult_ord": lambda: enc.a1c_result_ord(c("A1Cresult")),
        **{f"{d}_ord": partial(enc.drug_ord, d) for d in fv.DRUGS},
        "change": lambda: enc.change_flag(c("change")),
        "diabetesMed": lambda: enc.diabetes_med_flag(c("diabetesMed")),
        "total_visits": enc.total_visits,
        "poor_glucose_control": enc.poor_glucose_control,
        "severity_x_visits": enc.severity_x_visits,
        "medication_density": enc.medication_density,
        "weight_midpoint": lambda: enc.weight_midpoint(c("weight")),
        "weight_group_label": lambda: enc.weight_group_label(c("weight")),
        "is_obese": lambda: enc.is_obese(c("weight")),
        "payer_risk_score": lambda: enc.payer_risk_score(c("payer_code")),
    }
    return rules


def feature_store(
    silver_rows: DataFrame, columns: list[str] = fv.FEATURE_STORE_COLUMNS, strict_race: bool = False
) -> DataFrame:
    """The named feature columns (by default the stored ones), in one projection."""
    rules = feature_rules(strict_race)
    return silver_rows.select(
        *[rules[name]().alias(name) if name in rules else F.col(f"`{name}`") for name in columns]
    )


def diagnosis_features(rows: DataFrame) -> DataFrame:
    """Add the diagnosis groups and what is counted over them."""
    return icd9.with_diagnosis_categories(rows).select(
        "*",
        icd9.high_risk_diag_count().alias("high_risk_diag_count"),
        *icd9.primary_category_dummies(),
        icd9.has_circulatory().alias("has_circulatory"),
        icd9.multiple_systems().alias("multiple_systems"),
    )


def model_rows(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Labels and features on the composite key."""
    return labels.join(features, ["encounter_id", "snapshot_date"], "inner")


def scored_rows(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Predictions with their true label; only the key and the label are read of the labels."""
    key = ["encounter_id", "snapshot_date"]
    return predictions.join(labels.select(*key, "label"), key, "inner").withColumn(
        "snapshot_month", snapshot_month(F.col("snapshot_date"))
    )


def not_yet_scored(features: DataFrame, predictions: DataFrame) -> DataFrame:
    """Feature rows without a prediction (documented option of the scoring job)."""
    key = ["encounter_id", "snapshot_date"]
    return features.join(predictions.select(*key), key, "left_anti")


def feature_names(columns: list[str], excluded: list[str] = fv.NON_FEATURE_COLUMNS) -> list[str]:
    """All columns less the excluded ones, in order."""
    return [c for c in columns if c not in excluded]


def present(wanted: list[str], columns: list[str]) -> list[str]:
    """The wanted columns that exist, in the wanted order."""
    return [c for c in wanted if c in columns]


def rows_per_layer(tables: dict[str, DataFrame]) -> DataFrame:
    """(layer, snapshot_month, rows): only the partition column of each table is read."""
    tagged = [t.select(F.lit(name).alias("layer"), "snapshot_month") for name, t in tables.items()]
    return stack_rows(tagged).groupBy("layer", "snapshot_month").agg(F.count(F.lit(1)).alias("rows"))


def stack_rows(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column that one frame lacks is NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
