"""Readers. Every one takes a fixed schema; month filters reach the partition directories."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import in_month, snapshot_month

MONTH = "snapshot_month"


def partitioned(schema: T.StructType) -> T.StructType:
    """A table schema plus its month partition column."""
    if MONTH in schema.names:
        return schema
    return T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line; ``path`` may be a file, a directory or a glob."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV table partitioned by month."""
    return spark.read.schema(partitioned(schema)).option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table partitioned by month."""
    return spark.read.schema(partitioned(schema)).parquet(path)


def read_table_merged(spark: SparkSession, path: str) -> DataFrame:
    """All months of a table whose files gained columns over time: schemas are merged."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_tree(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every Parquet file below ``path``, whatever its directory is called."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)


def read_paths(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Several directories as one table."""
    return spark.read.schema(schema).parquet(*paths)


def month_of(table: DataFrame, month: date) -> DataFrame:
    """One month: the partition filter prunes directories, the range holds row by row."""
    wanted = F.lit(month.strftime("%Y-%m"))
    return table.where((F.col(MONTH) == wanted) & in_month(F.col("snapshot_date"), month))


def months_between(table: DataFrame, first: date, last: date) -> DataFrame:
    """A closed range of snapshot dates, pruned to its month directories."""
    months = F.col(MONTH).between(first.strftime("%Y-%m"), last.strftime("%Y-%m"))
    days = F.col("snapshot_date").between(F.lit(first), F.lit(last))
    return table.where(months & days)


def month_or_scan(
    spark: SparkSession, root: str, month: date, schema: T.StructType, whole_tree: bool = False
) -> DataFrame:
    """One month of a partitioned table, pruned to its directory. With ``whole_tree`` every file below ``root`` is
    read, whatever its directory is called, and rows are kept by their date: for trees without month directories."""
    if not whole_tree:
        return month_of(read_table(spark, root, schema), month)
    rows = read_tree(spark, root, schema).where(in_month(F.col("snapshot_date"), month))
    return rows.withColumn(MONTH, snapshot_month(F.col("snapshot_date")))


def exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def refuse_stream_table(spark: SparkSession, path: str) -> None:
    """A table that a file stream writes is read by the stream's own log, which leaves out files of a batch job."""
    if exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} is loaded by a stream; a batch load into it would be read by nobody")


def refuse_batch_table(spark: SparkSession, path: str) -> None:
    """The log of a file stream would hide the files that a batch job has written before."""
    if exists(spark, path) and not exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} is loaded by batch jobs; a stream into it would hide their rows")


def feature_source(mart: str, uploaded: bool = False) -> str:
    """Scoring reads the feature store, or the folder of manual uploads."""
    return f"{mart}/gold/{'upload' if uploaded else 'feature_store'}"


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON document per line, or one pretty-printed document per file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def latest_run(runs: DataFrame, version: str = "version", keys: list[str] | None = None) -> DataFrame:
    """The greatest version (per key), with the other columns of its row."""
    rest = [c for c in runs.columns if c != version and c not in (keys or [])]
    newest = F.max(F.struct(version, *rest)).alias("newest")
    return runs.groupBy(*(keys or [])).agg(newest).select(*(keys or []), "newest.*")


def read_splits(spark: SparkSession, run_path: str, schema: T.StructType) -> DataFrame:
    """The preprocessed train / test / oot rows of one run."""
    with_split = T.StructType([f for f in schema.fields if f.name != "split"])
    return spark.read.schema(with_split.add("split", T.StringType())).parquet(f"{run_path}/splits")
