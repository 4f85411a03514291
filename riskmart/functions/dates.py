"""Months, windows and temporal splits."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TemporalSplits, Window


def snapshot_month(day: Column) -> Column:
    """``yyyy-MM``."""
    return F.date_format(day, "yyyy-MM")


def partition_label(day: Column) -> Column:
    """``yyyy_MM``."""
    return F.date_format(day, "yyyy_MM")


def normalise_date(text: Column) -> Column:
    """Parse a date or timestamp text and write it as ``yyyy-MM-dd``; NULL if it is no date."""
    return F.date_format(text.try_cast("date"), "yyyy-MM-dd")


def in_month(day: Column, month: date) -> Column:
    """Half-open month range: unlike ``year(d) = y and month(d) = m`` it reaches the scan."""
    first = month.replace(day=1)
    return (day >= F.lit(first)) & (day < F.lit(_shift_months(first, 1)))


def in_window(day: Column, window: Window) -> Column:
    return day.between(F.lit(window.start), F.lit(window.end))


def month_list(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """First-of-month dates from the month of ``start`` up to ``end``, one row each."""
    first = F.trunc(F.col(start), "MM")
    step = F.expr("INTERVAL 1 MONTH")
    return bounds.select(F.explode(F.sequence(first, F.col(end), step)).alias("snapshot_date"))


def split_of(day: Column, splits: TemporalSplits) -> Column:
    """train / test / oot by closed intervals; NULL outside all three."""
    out = F.when(in_window(day, splits.train), "train")
    out = out.when(in_window(day, splits.test), "test")
    return out.when(in_window(day, splits.oot), "oot")


def with_split(df: DataFrame, splits: TemporalSplits, day: str = "snapshot_date") -> DataFrame:
    """Add ``split`` and keep the rows of the three windows, in a single pass."""
    inside = None
    for window in splits.named().values():
        hit = in_window(F.col(day), window)
        inside = hit if inside is None else inside | hit
    return df.where(inside).withColumn("split", split_of(F.col(day), splits))


def _shift_months(day: date, months: int) -> date:
    total = day.year * 12 + day.month - 1 + months
    return date(total // 12, total % 12 + 1, day.day)


@dataclass(frozen=True)
class RelativeWindows:
    train_test: Window
    oot: Window


def relative_windows(train_date: date, train_test_months: int = 108, oot_months: int = 12) -> RelativeWindows:
    """Windows counted back from the first-of-month training date."""
    oot_start = _shift_months(train_date, -oot_months)
    start = _shift_months(oot_start, -train_test_months)
    one_day = timedelta(days=1)
    return RelativeWindows(Window(start, oot_start - one_day), Window(oot_start, train_date - one_day))


def relative_window_columns(train_date: Column, train_test_months: int, oot_months: int) -> list[Column]:
    """The same four bounds as columns, for a training date held in a table."""
    oot_start = F.add_months(train_date, -oot_months)
    return [
        F.add_months(oot_start, -train_test_months).alias("train_test_start"),
        F.date_sub(oot_start, 1).alias("train_test_end"),
        oot_start.alias("oot_start"),
        F.date_sub(train_date, 1).alias("oot_end"),
    ]
