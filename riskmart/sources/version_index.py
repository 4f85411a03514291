"""The index of registered model versions: numbered snapshots, committed by rename.

A snapshot is one JSON file with all index rows that are kept. A commit writes the next snapshot under a hidden name
and renames it to its number, which fails if another commit took that number; it then starts again from the newer one.
So a reader sees a whole snapshot or the one before, also if a writer dies half-way. Works on any Hadoop file system.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.registry import newest
from ..schemas import VERSION_INDEX

KEEP = 10
#: Snapshots that stay, so that a reader of the one before the newest can finish.
SNAPSHOTS = 2
ATTEMPTS = 10


def _folder(root: str) -> str:
    return f"{root}/versions"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _snapshots(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed snapshots, ascending."""
    found = _file_system(spark, root).globStatus(_path(spark, f"{_folder(root)}/[0-9]*.json"))
    return sorted(int(f.getPath().getName().removesuffix(".json")) for f in found or [])


def _snapshot(root: str, number: int) -> str:
    return f"{_folder(root)}/{number:012d}.json"


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file to a name that is still free; False if it is taken."""
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, target).toUri(), spark._jsc.hadoopConfiguration()
    )
    no_overwrite = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(_path(spark, source), _path(spark, target), no_overwrite)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


def _read(spark: SparkSession, root: str, numbers: list[int]) -> DataFrame:
    if not numbers:
        return spark.createDataFrame([], VERSION_INDEX)
    return spark.read.schema(VERSION_INDEX).json(_snapshot(root, numbers[-1]))


def versions(spark: SparkSession, root: str) -> DataFrame:
    """All registered versions; none before the first commit."""
    return _read(spark, root, _snapshots(spark, root))


def latest(spark: SparkSession, root: str) -> DataFrame:
    """The newest version of each algorithm: a query, not a second copy."""
    return newest(versions(spark, root), ["algorithm"], "version", keep=1).drop("recency")


def commit(spark: SparkSession, root: str, rows: DataFrame, keep: int = KEEP) -> int:
    """Add index rows and return the number of the new snapshot.

    A row replaces one of the same algorithm and version. The newest ``keep`` versions of each algorithm stay; the
    folders of the others are deleted once no snapshot names them as kept.
    """
    files = _file_system(spark, root)
    files.mkdirs(_path(spark, _folder(root)))
    key = ["algorithm", "version"]
    for _ in range(ATTEMPTS):
        numbers = _snapshots(spark, root)
        number = numbers[-1] + 1 if numbers else 0
        added = rows.select(*VERSION_INDEX.names)
        together = _read(spark, root, numbers).join(added, key, "left_anti").unionByName(added)
        staging = f"{_folder(root)}/.staging-{uuid.uuid4().hex}"
        ranked = newest(together, ["algorithm"], "version", keep=2**31 - 1)
        try:
            # A few rows for each algorithm: one file.
            ranked.where(F.col("recency") <= keep).drop("recency").coalesce(1).write.option("ignoreNullFields", False).json(staging)
            written = files.globStatus(_path(spark, f"{staging}/part-*.json"))
            done = _rename(spark, written[0].getPath().toString(), _snapshot(root, number))
        finally:
            files.delete(_path(spark, staging), True)
        if done:
            _prune(spark, root, ranked.where(F.col("recency") > keep))
            for old in numbers[: max(0, len(numbers) + 1 - SNAPSHOTS)]:
                files.delete(_path(spark, _snapshot(root, old)), False)
            return number
    raise RuntimeError(f"{ATTEMPTS} attempts to commit to {root} met other writers")


def _prune(spark: SparkSession, root: str, dropped: DataFrame) -> None:
    """Delete the folders of versions that are no longer kept."""
    files = _file_system(spark, root)
    for row in dropped.select("algorithm", "version").collect():  # what one commit pushed out
        files.delete(_path(spark, version_folder(root, row.algorithm, row.version)), True)


def version_folder(root: str, algorithm: str, version: str) -> str:
    return f"{root}/{algorithm}/v{version}"
