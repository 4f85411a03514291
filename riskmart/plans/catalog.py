"""Registry of queries over the test tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RiskConfig, TemporalSplits, Window
from ..functions.dates import snapshot_month, with_split
from ..operators import layers
from ..session import prepare
from ..sources import encounters, scratch
from .jobs import Mart

# Windows that cover the dates of the test tables.
SPLITS = TemporalSplits(
    train=Window(date(1995, 1, 1), date(1998, 12, 31)),
    test=Window(date(1999, 1, 1), date(2000, 12, 31)),
    oot=Window(date(2001, 1, 1), date(2001, 12, 31)),
)
CONFIG = RiskConfig(splits=SPLITS)
MONTH = date(1998, 7, 1)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


class Tables:
    """The inputs of a query, derived lazily from the tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        prepare(spark)
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return encounters.table(self.spark, self.sf_dir, name)

    def path(self, name: str) -> str:
        """A fresh folder on the shared scratch space."""
        return scratch.fresh_path(self.spark, name)

    def mart(self) -> Mart:
        return Mart(self.path("mart"))

    @cached_property
    def raw(self) -> DataFrame:
        return encounters.raw_encounters(self.spark, self.sf_dir)

    @cached_property
    def bronze(self) -> DataFrame:
        return layers.bronze(self.raw)

    @cached_property
    def silver(self) -> DataFrame:
        return layers.silver(self.bronze)

    @cached_property
    def features(self) -> DataFrame:
        return layers.feature_store(self.silver)

    @cached_property
    def labels(self) -> DataFrame:
        return encounters.labels(self.spark, self.sf_dir)

    @cached_property
    def predictions(self) -> DataFrame:
        return encounters.predictions(self.spark, self.sf_dir)

    @cached_property
    def scored(self) -> DataFrame:
        return layers.scored_rows(self.predictions, self.labels)

    @cached_property
    def split_scores(self) -> DataFrame:
        return with_split(self.scored, SPLITS)

    @cached_property
    def wide_scores(self) -> DataFrame:
        return with_split(encounters.wide_predictions(self.spark, self.sf_dir), SPLITS)

    @cached_property
    def model_rows(self) -> DataFrame:
        return with_split(layers.model_rows(self.labels, self.features), SPLITS)

    @cached_property
    def diagnoses(self) -> DataFrame:
        return layers.diagnosis_features(self.silver.select("encounter_id", "diag_1", "diag_2", "diag_3"))

    @cached_property
    def volume(self) -> DataFrame:
        return encounters.volume_scores(self.spark, self.sf_dir)

    def month(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("snapshot_month", snapshot_month(F.col("snapshot_date")))


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``, with its check query if there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


def r6(column: str | Column) -> Column:
    """Rounded to six places under its own name, as the check query does."""
    if isinstance(column, str):
        return F.round(F.col(column), 6).alias(column)
    return F.round(column, 6)


def r6_sql(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)
