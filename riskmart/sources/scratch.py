"""Intermediate tables on shared storage.

A plan that reads one intermediate result twice, and needs both readings to agree,
writes it as a Parquet table under the folder the cluster names in
``spark.checkpoint.dir``. Unlike executor-local blocks the table outlives any executor.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the session names."""
    root = spark.conf.get(_SETTING, None)
    if not root:
        raise ValueError(f"set {_SETTING} to a folder that all executors share, when the session is built")
    return root.rstrip("/")


def application_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/riskmart/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete one intermediate table, once no plan needs it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once no plan needs them any more."""
    discard(spark, application_folder(spark))


def stored(df: DataFrame, name: str, codec: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` once and read it back: one consistent result, lineage cut; and where it lies. ``codec``: another
    than the session's."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """The table of ``stored``."""
    return stored(df, name, codec)[0]
