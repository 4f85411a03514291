"""Merkle manifest of a dataset, with a proof for every row by pointer jumping.

Each row is a leaf. The leaves of a partition (lang) form a binary tree, and the trees' roots, ordered by partition,
form another. Every node holds a segment: the siblings met on the way to an ancestor, at first its parent. Self-joins
of the nodes concatenate each segment with the ancestor's own, which doubles the distance, until every leaf's segment
reaches the root. After r joins only nodes of every 2^r-th level are anybody's ancestor, so only these are kept; leaves
join them once for each r.

Rows are numbered by sorted ranges, not by a window over a partition, and hashes are paired by number, so a partition
of any size is spread over all tasks. Only DataFrame functions are used, and text is read once and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
PARTITION = "lang"
#: Rows whose id's crc32 this divides are tampered with in the check of the proofs.
TAMPER_EVERY = 7

#: A step of a segment is one byte, telling where the sibling stands, and the sibling's 32 bytes, if there is one.
ALONE, ON_THE_LEFT, ON_THE_RIGHT = (bytearray([b]) for b in (0, 1, 2))
STEP = "array<binary>"
#: The tree above the partitions' trees, which are numbered from 0.
TOP = -1


def _field(value: Column) -> Column:
    """``-`` for null; else the number of bytes of the value as text, a colon and the text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _sha(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def leaf_hash(changed: dict[str, Column] | None = None) -> Column:
    """Lowercase hex sha256 of a row's fields; ``changed`` gives other values for some."""
    return _sha(*(_field((changed or {}).get(f, F.col(f))) for f in FIELDS))


def tampered_leaf() -> Column:
    """The leaf hash after one is added to ``n_chars`` where the id is chosen for tampering, else the leaf hash."""
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")  # the greatest long has a successor too
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    return F.when(chosen, leaf_hash({"n_chars": more}))


def numbered(rows: DataFrame, order: list[str], group: list[str], name: str) -> DataFrame:
    """``rows`` with column ``name``: 0, 1, ... in each group by ``order``, which starts with the group's columns.

    Rows are sorted into ranges; a range's first number in a group follows from the counts of the ranges before.
    """
    at = F.monotonically_increasing_id()  # the range's number times 2^33, plus the place in it
    in_order = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at)
    in_order = materialize(in_order.withColumn("_range", F.shiftright("_at", 33)), f"by-{name}")
    ranges = in_order.groupBy(*group, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(before), F.lit(0))
    ranges = materialize(ranges.select(*group, "_range", (start - F.col("_first")).alias("_shift")), f"ranges-{name}")
    left, right = in_order.alias("l"), ranges.alias("r")
    same = F.lit(True)
    for column in [*group, "_range"]:
        same = same & F.col(f"l.{column}").eqNullSafe(F.col(f"r.{column}"))
    number = (F.col("l._at") + F.col("r._shift")).alias(name)
    return left.join(right, same).select(*(F.col(f"l.{c}") for c in rows.columns), number)


def _pairs(nodes: DataFrame) -> DataFrame:
    """Runs of two consecutive nodes (tree, n, idx, hash): (tree, n, idx of the parent, first, second or null, hash)."""
    even = F.col("idx") % 2 == 0
    return (
        nodes.groupBy("tree", "n", F.shiftright("idx", 1).alias("idx"))
        .agg(F.max(F.when(even, F.col("hash"))).alias("first"), F.max(F.when(~even, F.col("hash"))).alias("second"))
        .withColumn("hash", _sha(F.col("first"), F.coalesce("second", F.lit(""))))
    )


def _grow(leaves: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The runs of each level above the leaves (tree, idx, n, hash), n being the number of the tree's leaves, and the
    roots (tree, hash). Trees with one node left are done."""
    levels, level = [], leaves.where("n > 1")
    roots = leaves.where("n = 1").select("tree", "hash")
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        runs = materialize(_pairs(level), f"{name}-runs")
        levels.append(runs)
        parents = runs.select("tree", "idx", F.ceil(F.col("n") / 2).alias("n"), "hash")
        roots = roots.union(parents.where("n = 1").select("tree", "hash"))
        level, most = parents.where("n > 1"), (most + 1) // 2
    return levels, roots


def _steps(runs: DataFrame, level: int) -> DataFrame:
    """Each node of the runs with its step to the parent: (tree, level, idx, up_tree, up_level, up_idx, segment)."""
    first, second = F.unhex("first"), F.unhex("second")
    step_of_first = F.when(second.isNull(), F.lit(ALONE)).otherwise(F.concat(F.lit(ON_THE_RIGHT), second))
    both = F.array(
        F.struct(F.lit(0).alias("side"), step_of_first.alias("step")),
        F.struct(F.lit(1).alias("side"), F.concat(F.lit(ON_THE_LEFT), first).alias("step")),
    )
    nodes = runs.select("tree", "idx", "n", "second", F.explode(both).alias("b")).where("b.side = 0 OR second IS NOT NULL")
    return nodes.select(
        "tree",
        F.lit(level).alias("level"),
        (F.col("idx") * 2 + F.col("b.side")).alias("idx"),
        F.col("tree").alias("up_tree"),
        F.lit(level + 1).alias("up_level"),
        F.col("idx").alias("up_idx"),
        F.array("b.step").alias("segment"),
        "n",
    )


def _links(levels: list[DataFrame], top: list[DataFrame]) -> DataFrame:
    """All nodes with a parent. The root of a partition's tree is the top tree's leaf of the same number."""
    links = None
    for tree, runs_of in ((0, levels), (TOP, top)):
        for level, runs in enumerate(runs_of):
            found = _steps(runs, level)
            if tree != TOP:  # a run that is all of its level has the root above it
                last = F.col("n") <= 2
                found = found.withColumns(
                    {
                        "up_idx": F.when(last, F.col("tree")).otherwise(F.col("up_idx")),
                        "up_level": F.when(last, F.lit(0)).otherwise(F.col("up_level")),
                        "up_tree": F.when(last, F.lit(TOP).cast("long")).otherwise(F.col("up_tree")),
                    }
                )
            found = found.drop("n")
            links = found if links is None else links.union(found)
    return links


def _jump(nodes: DataFrame, ancestors: DataFrame) -> DataFrame:
    """Each node's segment followed by its ancestor's, and the ancestor's ancestor. A node whose ancestor is the root,
    which has no segment, stays."""
    further = ancestors.select(
        *(F.col(c).alias(f"up_{c}") for c in ("tree", "level", "idx")),
        *(F.col(f"up_{c}").alias(f"next_{c}") for c in ("tree", "level", "idx")),
        F.col("segment").alias("rest"),
    )
    joined = nodes.join(further, ["up_tree", "up_level", "up_idx"], "left")
    ahead = {f"up_{c}": F.coalesce(f"next_{c}", f"up_{c}") for c in ("tree", "level", "idx")}
    ahead["segment"] = F.concat("segment", F.coalesce("rest", F.array().cast(STEP)))
    return joined.withColumns(ahead).select(*nodes.columns)


def fold(leaf: Column, segment: Column) -> Column:
    """The root that a leaf and the siblings of its segment give."""

    def parent(own: Column, step: Column) -> Column:
        side, sibling = F.substring(step, 1, 1), F.lower(F.hex(F.substring(step, 2, 32)))
        return F.when(side == F.lit(ON_THE_LEFT), _sha(sibling, own)).otherwise(_sha(own, sibling))

    return F.aggregate(segment, leaf, parent)


def proofs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, leaf, tampered (leaf, null where not tampered with), subroot, root, and
    ``segment``, the steps from the leaf to the root."""
    hashed = docs.select(*FIELDS).select("doc_id", PARTITION, leaf_hash().alias("leaf"), tampered_leaf().alias("tampered"))
    hashed = materialize(hashed, "leaves")
    trees = hashed.groupBy(PARTITION).agg(F.count("*").alias("n"))
    trees = materialize(numbered(trees, [PARTITION], [], "tree"), "trees")
    same = F.col("h.lang").eqNullSafe(F.col("t.lang"))
    placed = hashed.alias("h").join(trees.alias("t"), same).select("h.*", "tree", "n")
    placed = materialize(numbered(placed, ["tree", "doc_id", "leaf"], ["tree"], "idx"), "numbered-leaves")

    levels, subroots = _grow(placed.select("tree", "idx", "n", F.col("leaf").alias("hash")), "tree")
    subroots = materialize(subroots, "subroots")
    tops = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(trees.count()).alias("n"), "hash")
    top, roots = _grow(tops, "top")
    root = roots.first()  # one hash; none for an empty table

    alone = F.col("n") == 1  # a lone leaf is its tree's root
    leaves = placed.select(
        "*",
        F.when(alone, F.lit(TOP).cast("long")).otherwise(F.col("tree")).alias("up_tree"),
        F.lit(0).alias("up_level"),
        F.when(alone, F.col("tree")).otherwise(F.col("idx")).alias("up_idx"),
        F.array().cast(STEP).alias("segment"),
    )
    depth = len(levels) + len(top)
    if depth:
        links = _links(levels, top)
        leaves = _jump(leaves, links.where("level = 0"))  # each leaf's own step
        nodes = materialize(links.where((F.col("tree") == TOP) | (F.col("level") > 0)), "nodes")
        reach = 1
        while reach < depth:
            leaves = _jump(leaves, nodes)
            reach *= 2
            if reach < depth:
                kept = nodes.where((F.col("tree") == TOP) | (F.col("level") % reach == 0))
                nodes = materialize(_jump(kept, nodes), "nodes")
    below = subroots.select("tree", F.col("hash").alias("subroot"))
    return leaves.join(below, "tree").select(
        "doc_id", PARTITION, "leaf", "tampered", "subroot", F.lit(root and root["hash"]).cast("string").alias("root"), "segment"
    )


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``proof_sha256`` is the hash of all siblings of the proof, ``folded_root`` what the proof makes of the tampered leaf
    (the leaf itself, where not tampered with), ``verified`` whether that is the root. Nulls in any column have a leaf
    text of their own; rows of a partition are ordered by doc_id, null first, then by leaf, so repeated rows have
    neighbouring leaves with equal hashes; a null partition comes first. Other columns are ignored; an empty table
    gives an empty result.
    """
    siblings = F.transform("segment", lambda step: F.lower(F.hex(F.substring(step, 2, 32))))
    folded = fold(F.coalesce("tampered", "leaf"), F.col("segment"))
    found = proofs(docs).select(
        "doc_id", "leaf", "subroot", "root", _sha(F.array_join(siblings, "")).alias("proof_sha256"), folded.alias("folded_root")
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
