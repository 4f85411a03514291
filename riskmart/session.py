"""Session settings the package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM does not compile methods above 8,000 bytes of bytecode. Wide feature projections
    # exceed that as one generated method; below the limit Spark splits them into small ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def prepare(spark: SparkSession) -> None:
    """Bring the method limit into a session that somebody else has built: with Spark's own limit the wide projections
    run as methods that the JVM never compiles. A lower limit is left as it is."""
    if int(spark.conf.get(METHOD_LIMIT, "65535")) > int(SETTINGS[METHOD_LIMIT]):
        spark.conf.set(METHOD_LIMIT, SETTINGS[METHOD_LIMIT])


def local_session(cores: int | str = "*", name: str = "riskmart", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
