"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import materialize

#: Bytes of text that a task holds decoded at a time. A longer single text is a slice of its own.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: Column, modulus: int) -> Column:
    """crc32 of an id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def rows_with_texts(
    batches: Iterator[pa.RecordBatch], text: str = "text", slice_bytes: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Cut record batches into row ranges of about ``slice_bytes`` of text; each with its texts, null as empty."""
    for batch in batches:
        column = pc.fill_null(batch.column(text).cast(pa.large_string()), "")
        sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
        start = used = 0
        for i, size in enumerate(sizes):
            if used and used + size > slice_bytes:
                yield batch.slice(start, i - start), column.slice(start, i - start)
                start, used = i, 0
            used += int(size)
        if start < len(sizes):
            yield batch.slice(start), column.slice(start)


def text_slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", slice_bytes: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The row ranges of ``rows_with_texts`` with nulls of the text column replaced by empty texts."""
    for batch, texts in rows_with_texts(batches, text, slice_bytes):
        yield batch.set_column(batch.schema.get_field_index(text), text, texts)


def integer_names(keys: DataFrame, columns: list[str], name: str) -> DataFrame:
    """One integer per distinct row of ``columns``, in their sort order: distinct rows are sorted into
    ranges and numbered range by range. Equal rows share a number and different rows never do."""
    distinct = keys.select(*columns).distinct()
    in_order = distinct.repartitionByRange(*columns).sortWithinPartitions(*columns)
    return materialize(in_order.withColumn(name, F.monotonically_increasing_id()), name)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for all nodes of the links (a, b); root is the smallest node reachable.

    Alternates large-star and small-star steps: each node's larger neighbours, then its smaller ones, are
    hung on its smallest neighbour, until every component is a star. Each step is a map-side combined
    minimum and a join, so that a hub is neither collected nor scanned by one task: the minima are written
    first, so that the join has shuffles of its own, which the adaptive planner can split at a hub. Steps are
    written to the shared folder, which also cuts the lineage.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = materialize(edges, "edges"), None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = materialize(least, "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.where("a != b").distinct(), "large-star")
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        hung = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = materialize(hung.where("a != b").distinct(), "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
