"""Incremental load: new landing files flow through the same layer rules as the batch load.

Every layer is a row-wise rule, so the stream needs no state and no watermark. Each table has a
file sink of its own, which writes every landing file exactly once, also after a failure. A mart
is loaded either by this stream or by the batch job, not by both: the sink keeps its own file log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import layers
from ..plans.jobs import Mart
from ..schemas import ENCOUNTER, RAW_ENCOUNTER
from ..session import prepare
from ..sources.readers import MONTH, partitioned, refuse_batch_table
from ..sources.writers import with_month


def landing_stream(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """Raw encounters of the CSV files that arrive in ``landing``."""
    reader = spark.readStream.schema(RAW_ENCOUNTER).option("header", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(landing)


def _sink(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        with_month(rows)
        .writeStream.format("parquet")
        .partitionBy(MONTH)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _table_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """New files of a month-partitioned table."""
    return spark.readStream.schema(partitioned(schema)).parquet(path)


def load_new_files(
    spark: SparkSession, landing: str, mart: Mart, checkpoints: str, files_per_batch: int | None = None
) -> None:
    """Bring all tables up to date with the landing folder, layer by layer, then stop.

    Only bronze parses the landing files; each later layer reads the table before it.
    """
    prepare(spark)
    for path in (mart.bronze, mart.silver, mart.labels, mart.features):
        refuse_batch_table(spark, path)
    raw = landing_stream(spark, landing, files_per_batch)
    _sink(layers.bronze(raw), mart.bronze, f"{checkpoints}/bronze").awaitTermination()
    bronze = _table_stream(spark, mart.bronze, RAW_ENCOUNTER)
    _sink(layers.silver(bronze), mart.silver, f"{checkpoints}/silver").awaitTermination()
    silver = _table_stream(spark, mart.silver, ENCOUNTER)
    gold = [
        _sink(layers.label_store(silver), mart.labels, f"{checkpoints}/label_store"),
        _sink(layers.feature_store(silver), mart.features, f"{checkpoints}/feature_store"),
    ]
    for query in gold:
        query.awaitTermination()
