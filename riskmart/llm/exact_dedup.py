"""Exact duplicates by deterministic block naming.

Texts are cut into blocks of a fixed number of characters. Blocks are sorted into integer names (equal
blocks, equal names; different blocks, different names), then adjacent names are paired and the pairs
sorted into names, until every text has one name. No fingerprint decides: a hash only deals the blocks
out, and blocks that share one are told apart by sorting the blocks themselves.

The text is shuffled once, as distinct blocks per map task; all later steps move rows of a few integers,
and pairs halve at every level. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import integer_names, materialize

BLOCK_CHARS = 4096


def _blocks(text: Column, chars: int) -> Column:
    return F.when(F.length(text) <= chars, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chars}}}"), F.lit(0))
    )


def shared_hashes(blocks: DataFrame) -> DataFrame:
    """Blocks whose hash another block has too: (h, block, nth), nth being the block's place among them."""
    same = blocks.groupBy("h").agg(F.array_sort(F.collect_set("block")).alias("same"))
    return same.where(F.size("same") > 1).select("h", F.posexplode("same").alias("nth", "block"))


def _pair_up(names: DataFrame) -> DataFrame:
    """Adjacent names (place 2i and 2i + 1) as rows (row_id, place i, left, right); -1 where a row ends."""
    even = F.col("place") % 2 == 0
    return names.groupBy("row_id", F.floor(F.col("place") / 2).alias("pair")).agg(
        F.max(F.when(even, F.col("name"))).alias("left"),
        F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("right"),
        F.max("left_over").alias("left_over"),
    )


def identities(docs: DataFrame, block_chars: int = BLOCK_CHARS, hashed=F.xxhash64) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: (row_id, doc_id, n_blocks, identity, text_sha256).

    Rows have equal (n_blocks, identity) exactly where their texts are equal. A null text is empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    cut = docs.select("doc_id", text.alias("text")).withColumn("blocks", _blocks(F.col("text"), block_chars))
    blocks = cut.select(F.explode("blocks").alias("block")).select(hashed("block").alias("h"), "block")
    clashes = materialize(shared_hashes(blocks), "clashing-blocks")

    placed = (
        cut.withColumn("row_id", F.monotonically_increasing_id())  # before the blocks are exploded: one for each text
        .select(
            "row_id",
            "doc_id",
            F.sha2(F.col("text").cast("binary"), 256).alias("sha"),
            F.size("blocks").alias("n_blocks"),
            F.posexplode("blocks").alias("place", "block"),
        )
        .withColumn("h", hashed("block"))
        .join(clashes, ["h", "block"], "left")  # an empty table unless hashes clash, so no shuffle of text
        .select(
            "row_id",
            "doc_id",
            "n_blocks",
            "place",
            "h",
            F.coalesce("nth", F.lit(0)).alias("nth"),
            F.when(F.col("place") == 0, F.col("sha")).alias("text_sha256"),
        )
    )
    placed = materialize(placed, "placed-blocks")
    named = placed.join(integer_names(placed, ["h", "nth"], "name"), ["h", "nth"])
    named = materialize(named.select("row_id", "doc_id", "n_blocks", "place", "name", "text_sha256"), "named-blocks")

    firsts = named.where("place = 0").select("row_id", "doc_id", "n_blocks", "text_sha256")
    whole = named.where("n_blocks = 1").select("row_id", F.col("name").alias("identity"))
    level = named.where("n_blocks > 1").select("row_id", "place", "name", F.col("n_blocks").alias("left_over"))
    most = named.agg(F.max("n_blocks")).first()[0] or 1
    while most > 1:
        pairs = materialize(_pair_up(level), "pairs")
        joined = pairs.join(integer_names(pairs, ["left", "right"], "name"), ["left", "right"])
        halved = F.ceil(F.col("left_over") / 2).cast("int").alias("left_over")
        named_pairs = materialize(
            joined.select("row_id", F.col("pair").alias("place"), "name", halved), "named-pairs"
        )
        whole = whole.union(named_pairs.where("left_over = 1").select("row_id", F.col("name").alias("identity")))
        level, most = named_pairs.where("left_over > 1"), (most + 1) // 2
    return firsts.join(whole, "row_id")


def exact_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of rows with equal texts the one with the largest doc_id stays; null ids come last, and of repeated
    rows with that id one stays. Null and empty texts are equal. Other columns of ``docs`` are ignored; an
    empty table gives an empty result.
    """
    rows = materialize(identities(docs, block_chars), "identities")
    order = F.struct("doc_id", "row_id")  # null ids sort first, so that they never win
    groups = rows.groupBy("n_blocks", "identity").agg(F.max(order).alias("best"), F.count("*").alias("group_size"))
    groups = materialize(groups, "groups")  # so that the join can be split at a hot group
    return rows.join(groups, ["n_blocks", "identity"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("best.row_id")).alias("kept"),
        "text_sha256",
    )
