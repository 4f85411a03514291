"""Writers. Month partitions are replaced one by one, so a rerun changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import snapshot_month
from .readers import MONTH

# The CSV writer would otherwise strip blanks around values.
CSV_OPTIONS = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def with_month(df: DataFrame) -> DataFrame:
    return df if MONTH in df.columns else df.withColumn(MONTH, snapshot_month(F.col("snapshot_date")))


def write_months(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    keys: tuple[str, ...] = (MONTH,),
    grouped: bool = False,
) -> None:
    """Write a table partitioned by ``keys``, replacing only the partitions ``df`` holds.

    The rebalance hint groups a month's rows into few files, and splits a month that is far
    larger than the others over many tasks; a plain ``repartition(month)`` would not. Rows that
    come ``grouped`` already, row by row from a table written so, are written in scan order.
    """
    rows = with_month(df)
    writer = (rows if grouped else rows.hint("rebalance", *keys)).write.partitionBy(*keys).mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic")
    if file_format == "csv":
        writer = writer.options(**CSV_OPTIONS)
    writer.format(file_format).save(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Scores by algorithm and month. "Latest" is a query on the month, not a second copy."""
    write_months(predictions, path, keys=("model_algorithm", MONTH))


def write_splits(splits: DataFrame, scaler: DataFrame, metadata: DataFrame, root: str, run: str) -> str:
    """One preprocessing run: rows by split, the scaler table and one metadata row."""
    path = f"{root}/run={run}"
    splits.hint("rebalance", "split").write.partitionBy("split").mode("overwrite").parquet(f"{path}/splits")
    scaler.write.mode("overwrite").parquet(f"{path}/scaler")
    metadata.write.mode("overwrite").json(f"{path}/metadata")
    return path


def write_json(report: DataFrame, path: str) -> None:
    """One JSON document per row."""
    report.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str, decimals: dict[str, int] | None = None) -> None:
    """CSV with a header; columns named in ``decimals`` are printed with that many places."""
    fixed = decimals or {}
    df.select(
        *[
            F.format_string(f"%.{fixed[c]}f", F.col(f"`{c}`")).alias(c) if c in fixed else F.col(f"`{c}`")
            for c in df.columns
        ]
    ).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str) -> None:
    """A catalogue table at ``path``, bucketed by ``keys``: two such tables join on exactly these
    keys without a shuffle. The keys must be spread evenly, as the encounter key is."""
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    writer.mode("overwrite").option("path", path).saveAsTable(table)
