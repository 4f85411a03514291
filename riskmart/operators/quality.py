"""Data-quality gates: declared checks, compiled into one aggregate per input, and a call that raises on them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Gates

KEY_FEATURES = ["age_midpoint", "admission_severity_score", "poor_glucose_control", "label"]
ROW_KEY = ["encounter_id", "snapshot_date"]


class QualityError(ValueError):
    """A data-quality gate failed."""


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fail before any job runs when a required column is missing (Q6)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise QualityError(f"missing columns: {', '.join(missing)}")
    return df


def null_percentages(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, null_pct) from one aggregate over the rows."""
    measured = rows.agg(*[(F.avg(F.col(f"`{c}`").isNull().cast("double")) * 100.0).alias(c) for c in columns])
    return measured.unpivot([], columns, "feature", "null_pct")


def duplicate_count(rows: DataFrame, key: list[str] = ROW_KEY) -> DataFrame:
    """Rows beyond the first of their key."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates")
    )


@dataclass(frozen=True)
class Check:
    """A declared check: an aggregate over the rows and when it passes. A check with a ``key`` counts the rows beyond the
    first of their key instead, which takes a grouping of its own."""

    name: str
    threshold: str
    passed: Callable[[Column], Column]
    value: Callable[[], Column] | None = None
    key: tuple[str, ...] = ()


def few_nulls(feature: str, below: float = 5.0) -> Check:
    share = lambda: F.avg(F.col(f"`{feature}`").isNull().cast("double")) * 100.0
    return Check(f"{feature}_null_pct", f"< {below:g}", lambda v: v < below, share)


def positive_rate(low: float = 0.05, high: float = 0.30, label: str = "label") -> Check:
    rate = lambda: F.avg(F.col(label).cast("double"))
    return Check("label_positive_rate", f"{low:.2f} to {high:.2f}", lambda v: (v > low) & (v < high), rate)


def no_days_after(last_day: date) -> Check:
    late = lambda: F.greatest(F.date_diff(F.max("snapshot_date"), F.lit(last_day)), F.lit(0))
    return Check("days_after_oot_end", "= 0", lambda v: v == 0, late)


def ages_in_range(low: int = 0, high: int = 100) -> Check:
    outside = lambda: F.count_if(~F.col("age_midpoint").between(low, high))
    return Check("age_out_of_range", "= 0", lambda v: v == 0, outside)


def months_of_history(at_least: int = 10) -> Check:
    months = lambda: F.count_distinct(F.trunc("snapshot_date", "MM"))
    return Check("months_of_history", f">= {at_least}", lambda v: v >= at_least, months)


def has_rows(name: str = "rows") -> Check:
    return Check(name, "> 0", lambda v: v > 0, lambda: F.count(F.lit(1)))


def split_rows(split: str, above: int = 0) -> Check:
    return Check(f"{split}_rows", f"> {above}", lambda v: v > above, lambda: F.count_if(F.col("split") == split))


def both_classes(split: str = "train", label: str = "label") -> Check:
    classes = lambda: F.count_distinct(F.when(F.col("split") == split, F.col(label)))
    return Check(f"{split}_classes", "= 2", lambda v: v == 2, classes)


def no_duplicates(key: Sequence[str] = ROW_KEY) -> Check:
    return Check("duplicate_records", "= 0", lambda v: v == 0, key=tuple(key))


def _row(check: Check, value: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check"),
        value.cast("double").alias("value"),
        F.lit(check.threshold).alias("threshold"),
        F.coalesce(check.passed(value), F.lit(False)).alias("passed"),
    )


def measure(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: (check, value, threshold, passed). One aggregate holds all plain checks and only what they
    need; each key that is checked for duplicates is one more."""
    plain, reports = [c for c in checks if not c.key], []
    if plain:
        stats = rows.agg(*[c.value().alias(f"v{i}") for i, c in enumerate(plain)])
        reports.append(stats.select(F.inline(F.array(*[_row(c, F.col(f"v{i}")) for i, c in enumerate(plain)]))))
    for check in checks:
        if check.key:
            copies = duplicate_count(rows, list(check.key))
            reports.append(copies.select(F.inline(F.array(_row(check, F.col("duplicates"))))))
    return reduce(DataFrame.unionByName, reports)


def quality_report(
    rows: DataFrame,
    last_day: date,
    key: list[str] = ROW_KEY,
    features: list[str] = KEY_FEATURES,
    min_months: int = 10,
) -> DataFrame:
    """All checks of the training rows in two aggregates."""
    checks = [few_nulls(f) for f in features]
    checks += [positive_rate(), no_days_after(last_day), ages_in_range(), months_of_history(min_months), has_rows()]
    return measure(rows, [*checks, no_duplicates(key)])


def training_gates(gates: Gates) -> list[Check]:
    """What the rows of the three windows must hold before a run is stored."""
    checks = [months_of_history(gates.min_months), split_rows("train", gates.min_train_rows)]
    checks += [split_rows("test", gates.min_test_rows), split_rows("oot"), both_classes("train")]
    if gates.max_null_pct is not None:
        checks += [few_nulls(f, gates.max_null_pct) for f in KEY_FEATURES]
    if gates.positive_rate is not None:
        checks.append(positive_rate(*gates.positive_rate))
    if gates.last_day is not None:
        checks.append(no_days_after(gates.last_day))
    if gates.ages is not None:
        checks.append(ages_in_range(*gates.ages))
    return [*checks, no_duplicates()] if gates.unique_keys else checks


def enforce(report: DataFrame) -> DataFrame:
    """Raise when a check of the report failed; the report has a handful of rows."""
    failed = [r["check"] for r in report.where(~F.col("passed")).collect()]
    if failed:
        raise QualityError(f"failed checks: {', '.join(sorted(failed))}")
    return report


def history_report(rows: DataFrame, min_train: int = 1000, min_test: int = 500) -> DataFrame:
    """Enough rows per split to train and to test."""
    return measure(rows, [split_rows("train", min_train), split_rows("test", min_test)])


def non_empty_report(frames: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several tables, each of which must hold rows."""
    return reduce(DataFrame.unionByName, [measure(frame, [has_rows(name)]) for name, frame in frames.items()])


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail when a table or a snapshot has no rows; reads at most one."""
    if df.isEmpty():
        raise QualityError(f"no rows: {what}")
    return df
