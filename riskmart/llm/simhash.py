"""SimHash near-duplicates, searched by pigeonring filtering.

A fingerprint has four segments of 16 bits in a ring. If two fingerprints differ in at most ``LIMIT`` = 3
bits, some segment starts a chain of consecutive segments whose cumulative differences stay within their
proportional share of the limit: at most 0 bits in the first, 1 in the first two, 2 in the first three and
3 in all. The first two conditions form a 32-bit join key (the first segment as it is; the second with
each of its one-bit neighbours on one side of the join), so candidates agree on far more than a single
segment. The third condition and the full check follow on the joined row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, materialize, text_slices

SHINGLE_WORDS = 3
SEED = 42
LIMIT = 3
SEGMENTS, SEGMENT_BITS = 4, 16


def shingle_hashes(text: bytes, size: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of every run of ``size`` words, repeats included; of all words if there are fewer."""
    words = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    runs = map(b" ".join, zip(*(words[i:] for i in range(size))))
    return [xxhash.xxh64_intdigest(run, SEED) for run in runs]


def fingerprint(hashes: list[int]) -> int:
    """The bits set in more than half of the hashes; zero if there are none."""
    if not hashes:
        return 0
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    major = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(major, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        prints = [fingerprint(shingle_hashes(t)) for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
        signed = pa.array(np.array(prints, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), signed], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of each row of ``docs(doc_id, text)``; a null text is empty and has fingerprint zero. Ids
    may be of any type that has an order."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints, T.StructType([rows.schema["doc_id"], T.StructField("fp", T.LongType())]))


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, SEGMENT_BITS * (i % SEGMENTS)).bitwiseAND(0xFFFF)


def _chain_keys(fp: Column, near: bool) -> Column:
    """One key per start of a chain; with ``near`` also the keys whose second segment has one bit flipped."""
    flips = [0] + [1 << b for b in range(SEGMENT_BITS)] if near else [0]
    keys = [
        F.struct(F.lit(i).alias("start"), (_segment(fp, i) * 65536 + _segment(fp, i + 1).bitwiseXOR(flip)).alias("key"))
        for i in range(SEGMENTS)
        for flip in flips
    ]
    return F.explode(F.array(*keys))


def links(prints: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints (column fp) that differ in at most ``LIMIT`` bits. The planner takes the
    keys for as small as the fingerprints they are exploded from and would broadcast them, hence the hint."""
    left = prints.select(F.col("fp").alias("a"), _chain_keys(F.col("fp"), near=False).alias("k")).select("a", "k.*")
    right = prints.select(F.col("fp").alias("b"), _chain_keys(F.col("fp"), near=True).alias("k")).select("b", "k.*")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    outside_three = F.lit(0)  # the chain's fourth segment is the one before its start
    for i in range(SEGMENTS):
        outside_three = F.when(F.col("start") == i, _segment(differ, i + 3)).otherwise(outside_three)
    close = (F.col("a") < F.col("b")) & (F.bit_count(differ) <= LIMIT)
    ring = F.bit_count(differ) - F.bit_count(outside_three) <= 2
    return left.join(right.hint("merge"), ["start", "key"]).where(ring & close).select("a", "b").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Documents link if their fingerprints differ in at most three bits; component_id is the smallest doc_id
    reachable by links. Equal fingerprints are searched once, however many documents have them. Texts
    without words have fingerprint zero and link like any other. Null ids are ignored in component_id
    unless a component has no other. Other columns are ignored; an empty table gives an empty result.
    """
    rows = materialize(fingerprints(docs), "fingerprints")
    prints = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(prints)).withColumnRenamed("node", "fp")
    rooted = prints.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labelled = rooted.join(least, "root").select("fp", "component_id")
    hex_print = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(labelled, "fp").select("doc_id", hex_print, "component_id")
