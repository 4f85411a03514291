"""Rule-based retrain decisions and alerts, one row per model (and month)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Thresholds

RETRAIN, SCHEDULE, NO_ACTION = "Retrain", "Schedule Retrain", "No Action"
HEALTHY_REASON = "Model metrics within acceptable range"


def decision(auc: Column, psi: Column, limits: Thresholds = Thresholds()) -> Column:
    return (
        F.when((auc < limits.auc) | (psi > limits.psi_critical), RETRAIN)
        .when(psi > limits.psi_warning, SCHEDULE)
        .otherwise(NO_ACTION)
    )


def reasons(auc: Column, psi: Column, limits: Thresholds = Thresholds()) -> Column:
    """The broken rules as text, joined by ``; ``; empty when there is none."""
    low_auc = F.format_string(f"AUC (%.4f) below threshold ({limits.auc:.2f})", auc)
    critical = F.format_string(f"PSI (%.4f) exceeds critical threshold ({limits.psi_critical:.2f})", psi)
    warning = F.format_string(f"PSI (%.4f) exceeds warning threshold ({limits.psi_warning:.2f})", psi)
    retrain = F.coalesce(auc < limits.auc, F.lit(False))
    parts = F.array(
        F.when(retrain, low_auc),
        F.when(psi > limits.psi_critical, critical).when((psi > limits.psi_warning) & ~retrain, warning),
    )
    return F.array_join(F.array_compact(parts), "; ")


def decide(
    monitoring: DataFrame, limits: Thresholds = Thresholds(), auto_retrain: bool = False
) -> DataFrame:
    """Decision, reason and retrain flag for every monitored (model, month)."""
    auc, psi = F.col("auc"), F.col("psi")
    why = reasons(auc, psi, limits)
    verdict = decision(auc, psi, limits)
    return monitoring.select(
        "*",
        verdict.alias("decision"),
        (verdict == RETRAIN).alias("retrain_needed"),
        F.when(why == "", HEALTHY_REASON).otherwise(why).alias("reason"),
        F.lit(auto_retrain).alias("auto_retrain_enabled"),
    )


def governance_documents(decided: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """The nested decision record of each row."""
    return decided.select(
        F.col("model_algorithm").alias("algorithm"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_updated"),
        F.col("snapshot_month").alias("latest_snapshot_month"),
        F.struct("auc", "gini", "psi", "row_count").alias("metrics"),
        F.struct(
            F.lit(limits.auc).alias("auc_threshold"),
            F.lit(limits.psi_warning).alias("psi_warning"),
            F.lit(limits.psi_critical).alias("psi_critical"),
        ).alias("thresholds"),
        "decision",
        "retrain_needed",
        "reason",
        "auto_retrain_enabled",
    )


def retrain_triggers(decided: DataFrame) -> DataFrame:
    """Rows that start a retraining: retrain needed and automatic retraining on."""
    return decided.where(F.col("retrain_needed") & F.col("auto_retrain_enabled")).select(
        "model_algorithm",
        "snapshot_month",
        "decision",
        "reason",
        F.current_timestamp().alias("triggered_at"),
    )


def exit_code(verdict: Column) -> Column:
    """0 no action, 1 schedule, 2 retrain (documented option)."""
    return F.when(verdict == RETRAIN, 2).when(verdict == SCHEDULE, 1).otherwise(0)


# --- alerts relative to a baseline ------------------------------------------------------------
# rule -> (metric, limit, alert when above the limit, limit is a factor of the baseline)
ALERT_RULES = {
    "min_gini": ("gini", 0.90, False, True),
    "min_auc": ("auc", 0.90, False, True),
    "max_psi": ("psi", 0.2, True, False),
    "critical_psi": ("psi", 0.5, True, False),
    "max_ks_stat": ("ks_stat", 0.15, True, False),
    "max_pred_shift": ("pred_shift", 0.05, True, False),
    "min_pred_rate": ("pred_rate", 0.80, False, True),
    "max_pred_rate": ("pred_rate", 1.20, True, True),
    "max_null_pct": ("null_pct", 5.0, True, False),
    "min_records_per_month": ("row_count", 1000.0, False, False),
}
# Documented only.
EXTRA_ALERT_RULES = {
    "accuracy_drop": ("accuracy", 0.95, False, True),
    "data_drift_psi": ("psi", 0.2, True, False),
    "missing_rate": ("null_pct", 10.0, True, False),
}


def alerts(observed: DataFrame, keys: list[str], rules: dict | None = None) -> DataFrame:
    """Evaluate the rules whose metric is present.

    ``observed`` holds one column per metric and ``base_<metric>`` for baseline rules. The
    result has one row per (keys, rule): value, limit and whether it alerts.
    """
    usable = {
        name: rule
        for name, rule in (rules or ALERT_RULES).items()
        if rule[0] in observed.columns and (not rule[3] or f"base_{rule[0]}" in observed.columns)
    }
    if not usable:
        raise ValueError("no rule applies to the columns given")
    rows = []
    for name, (metric, limit, above, relative) in usable.items():
        value = F.col(metric).cast("double")
        bound = F.col(f"base_{metric}").cast("double") * limit if relative else F.lit(float(limit))
        broken = value > bound if above else value < bound
        rows.append(
            F.struct(
                F.lit(name).alias("rule"),
                value.alias("value"),
                bound.alias("limit"),
                F.coalesce(broken, F.lit(False)).alias("alert"),
            )
        )
    return observed.select(*keys, F.inline(F.array(*rows)))


def observations(wide: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Long form (keys, metric, value, baseline) of a table with a column per metric; the baseline is ``base_<metric>``,
    or null where there is no such column."""
    cells = []
    for metric in metrics:
        base = F.col(f"base_{metric}") if f"base_{metric}" in wide.columns else F.lit(None)
        cells.append(
            F.struct(
                F.lit(metric).alias("metric"),
                F.col(metric).cast("double").alias("value"),
                base.cast("double").alias("baseline"),
            )
        )
    return wide.select(*keys, F.inline(F.array(*cells)))


def scan_rules(observed: DataFrame, keys: list[str], rules: dict | None = None) -> DataFrame:
    """(keys, rule, value, limit, alert): every rule held against every observation of its metric, in one pass.

    ``observed``: (keys, metric, value, baseline), whatever is observed: models, features, months. A relative rule
    says nothing where there is no baseline; an unknown value raises no alert.
    """
    table = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.lit(metric).alias("on"),
                F.lit(float(limit)).alias("bound"),
                F.lit(above).alias("above"),
                F.lit(relative).alias("relative"),
            )
            for name, (metric, limit, above, relative) in (rules or ALERT_RULES).items()
        ]
    )
    usable = F.filter(table, lambda r: (r["on"] == F.col("metric")) & (~r["relative"] | F.col("baseline").isNotNull()))
    held = observed.select(*keys, "value", "baseline", F.inline(usable))
    limit = F.when(F.col("relative"), F.col("baseline") * F.col("bound")).otherwise(F.col("bound"))
    broken = F.when(F.col("above"), F.col("value") > limit).otherwise(F.col("value") < limit)
    return held.select(*keys, "rule", "value", limit.alias("limit"), F.coalesce(broken, F.lit(False)).alias("alert"))


def monitoring_thresholds(baseline: DataFrame, limits: dict | None = None) -> DataFrame:
    """The thresholds document: absolute rules as they are, relative ones worked out from ``baseline`` (one row with a
    column per metric)."""
    rules = limits or ALERT_RULES
    bounds = {
        name: F.col(metric).cast("double") * limit if relative else F.lit(float(limit))
        for name, (metric, limit, _above, relative) in rules.items()
        if not relative or metric in baseline.columns
    }
    groups = {
        "performance": ["min_gini", "min_auc"],
        "drift": ["max_psi", "critical_psi", "max_ks_stat"],
        "predictions": ["max_pred_shift", "min_pred_rate", "max_pred_rate"],
        "data_quality": ["max_null_pct", "min_records_per_month"],
    }
    return baseline.select(
        *[F.struct(*[bounds[r].alias(r) for r in names if r in bounds]).alias(group) for group, names in groups.items()]
    )
