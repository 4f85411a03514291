"""Log and standard scaling fitted on the training rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv

SCALER_SCHEMA = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("log", T.BooleanType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("std_pop", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Recipe:
    """Which columns are logged and which only scaled; all others pass through."""

    log_columns: tuple[str, ...] = tuple(fv.LOG_SCALE_COLUMNS)
    scale_columns: tuple[str, ...] = tuple(fv.SCALE_ONLY_COLUMNS)

    def restricted(self, columns: list[str]) -> "Recipe":
        return Recipe(
            tuple(c for c in self.log_columns if c in columns),
            tuple(c for c in self.scale_columns if c in columns),
        )


STANDARD = Recipe()
# Earlier variants: seven scaled columns without log, or the three logged ones alone.
SCALE_ALL = Recipe((), tuple(fv.LOG_SCALE_COLUMNS + fv.SCALE_ONLY_COLUMNS))
LOG_ONLY = Recipe(tuple(fv.LOG_SCALE_COLUMNS), ())


def _input(column: str, log: bool) -> Column:
    value = F.col(column).cast("double")
    return F.log1p(value) if log else value


@dataclass(frozen=True)
class Scaler:
    """Fitted statistics: a handful of numbers per column, applied as literals."""

    stats: dict[str, tuple[bool, float, float]]  # feature -> (log, mean, population std)

    @staticmethod
    def fit(train: DataFrame, recipe: Recipe = STANDARD) -> "Scaler":
        """One aggregate over the training rows; NULLs are left out of both moments."""
        recipe = recipe.restricted(train.columns)
        columns = [(c, True) for c in recipe.log_columns] + [(c, False) for c in recipe.scale_columns]
        if not columns:
            return Scaler({})
        moments = []
        for c, log in columns:
            moments += [F.avg(_input(c, log)).alias(f"mean_{c}"), F.stddev_pop(_input(c, log)).alias(f"std_{c}")]
        row = train.agg(*moments).first()
        return Scaler({c: (log, row[f"mean_{c}"], row[f"std_{c}"]) for c, log in columns})

    def column(self, name: str) -> Column:
        if name not in self.stats:
            return F.col(f"`{name}`").cast("double").alias(name)
        log, mean, std = self.stats[name]
        centred = _input(name, log) - F.lit(mean)
        return (centred if not std else centred / F.lit(std)).alias(name)

    def transform(self, rows: DataFrame, features: list[str]) -> DataFrame:
        """Scale ``features`` in one projection; the other columns are kept as they are."""
        return rows.select(
            *[self.column(c) if c in features else F.col(f"`{c}`") for c in rows.columns]
        )

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(c, log, mean, std) for c, (log, mean, std) in self.stats.items()]
        return spark.createDataFrame(rows, SCALER_SCHEMA)

    @staticmethod
    def from_table(table: DataFrame) -> "Scaler":
        return Scaler({r["feature"]: (r["log"], r["mean"], r["std_pop"]) for r in table.collect()})


def scaler_statistics(train: DataFrame, recipe: Recipe = STANDARD) -> DataFrame:
    """The scaler as a lazy table (feature, log, mean, std_pop)."""
    recipe = recipe.restricted(train.columns)
    columns = [(c, True) for c in recipe.log_columns] + [(c, False) for c in recipe.scale_columns]
    row = train.agg(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.lit(log).alias("log"),
                F.avg(_input(c, log)).alias("mean"),
                F.stddev_pop(_input(c, log)).alias("std_pop"),
            ).alias(f"s{i}")
            for i, (c, log) in enumerate(columns)
        ]
    )
    return row.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(columns))])))


def preprocess(
    split_rows: DataFrame, recipe: Recipe = STANDARD, features: list[str] = fv.MODEL_FEATURES
) -> tuple[DataFrame, Scaler]:
    """Fit on the train split, transform all splits in one pass. Feature names stay with their
    values; columns are not reordered."""
    wanted = [c for c in features if c in split_rows.columns]
    scaler = Scaler.fit(split_rows.where(F.col("split") == "train"), recipe)
    return scaler.transform(split_rows, wanted), scaler
