"""Documents to training sequences: quality, exact and near duplicates, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. ``run`` writes what each
returns as Parquet to the shared folder and reads it again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import exact_dedup, packing, pii, quality, simhash
from riskmart.llm.common import table
from riskmart.llm.queries import WORD_TOKENIZER
from riskmart.sources.scratch import discard, stored


def _keys(docs: DataFrame) -> list[str]:
    """Names of two key columns that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    free = ""
    while any(f"_{k}{free}" in taken for k in ("text_key", "id_key")):
        free += "_"
    return [f"_text_key{free}", f"_id_key{free}"]


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of doc_id and text: rows with equal keys are copies of one row. Null ids have a key too."""
    text_key, id_key = _keys(docs)
    return docs.withColumns(
        {text_key: F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), id_key: F.coalesce("doc_id", F.lit(-1))}
    )


def _keep(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """One row of ``docs`` for each of the keys. Joined and made distinct in one shuffle by key; of copies that differ
    in other columns one stays."""
    names = _keys(docs)
    return _keyed(docs).join(keys, names, "left_semi").dropDuplicates(names).drop(*names)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking does not reject."""
    return quality.keep(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest doc_id, null being the smallest."""
    keys = _keys(docs)
    rows = _keyed(docs).select(F.struct("doc_id", *keys).alias("doc_id"), "text")
    kept = exact_dedup.exact_duplicates(rows).where("kept")
    return _keep(docs, kept.select(*(f"doc_id.{k}" for k in keys)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest doc_id, null being the largest."""
    keys = _keys(docs)
    by_id = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *keys)
    found = simhash.near_duplicates(_keyed(docs).select(by_id.alias("doc_id"), "text"))
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return _keep(docs, kept.select(*(f"doc_id.{k}" for k in keys)))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind; n_chars follows the text."""
    return pii.mask(docs, pii.learn(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents and their places in training sequences."""
    return packing.pack_documents(docs, WORD_TOKENIZER)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents. Each stage's table is deleted once the next one's is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, path = stored(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
