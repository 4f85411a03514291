"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe, embedding, exact_dedup, html_text, kmeans, language, language_model, license_scan, merkle, packing, pii, quality,
    simhash,
)
from .common import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digests(pii.find(docs, pii.learn(docs)))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scores(table(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans.clusters(table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii, op2_quality, op3_packing, op4_bpe, op5_language_id, op6_exact_dedup, op7_html_text,
        op8_embedding_near_dedup, op9_lm_score, op10_simhash_near_dedup, op11_license_scan, op12_clusters,
        op13_merkle_manifest,
    )
}



def _clusters_sql() -> str:
    """The rounds one after another, over one row per vector and component."""
    assigned = """
near{r} AS MATERIALIZED (
  SELECT vec_id, min((distance, k)) AS best
  FROM (SELECT vec_id, k, sum((x - c) * (x - c))::BIGINT AS distance FROM parts JOIN centroids{r} USING (i) GROUP BY vec_id, k)
  GROUP BY vec_id)"""
    moved = """
centroids{s} AS MATERIALIZED (
  SELECT k, i, coalesce((total - ((total % n) + n) % n) // n, c)::BIGINT AS c
  FROM centroids{r} LEFT JOIN (
    SELECT struct_extract(best, 2) AS k, i, sum(x)::BIGINT AS total, count(*) AS n
    FROM parts JOIN near{r} USING (vec_id) GROUP BY ALL) USING (k, i))"""
    rounds = [assigned.format(r=r) + "," + moved.format(r=r, s=r + 1) for r in range(kmeans.ROUNDS)]
    return (
        f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({kmeans.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = {kmeans.DIMENSIONS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {kmeans.DIMENSIONS}),
parts AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept),
firsts AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('{kmeans.SEED}:' || vec_id)) - 1 AS k
  FROM kept ORDER BY k LIMIT {kmeans.CLUSTERS}),
centroids0 AS MATERIALIZED (SELECT k, i, x AS c FROM firsts JOIN parts USING (vec_id)),"""
        + ",".join(rounds)
        + ","
        + assigned.format(r=kmeans.ROUNDS)
        + f""",
hashed AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM centroids{kmeans.ROUNDS} GROUP BY k),
flat AS (
  SELECT vec_id, struct_extract(best, 2) AS k, struct_extract(best, 1)::BIGINT AS distance FROM near{kmeans.ROUNDS})
SELECT vec_id, k::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM flat JOIN hashed USING (k)"""
    )


_MERKLE_SQL = """
WITH RECURSIVE texts AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
             lambda rest, turn: xor(rest >> 1, 3988292384 * (rest & 1)))) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, idx,
         sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || coalesce(strlen(m::VARCHAR) || ':' || m, '-') || tail) AS shown
  FROM (SELECT *, CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS m FROM texts)),
nodes AS (
  SELECT tree, 0 AS level, idx, leaf AS hash, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 2, sha256(string_agg(hash, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 2),
subroots AS (SELECT tree, level AS height, hash FROM nodes WHERE n = 1),
top AS (
  SELECT 0 AS level, tree AS idx, hash, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 2, sha256(string_agg(hash, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM top WHERE n > 1 GROUP BY level, idx // 2),
steps AS (
  SELECT leaves.tree, leaves.idx, o.level AS step, CASE WHEN o.idx % 2 = 0 THEN 'L' ELSE 'R' END AS side, o.hash
  FROM leaves JOIN nodes o ON o.tree = leaves.tree AND o.idx = xor(leaves.idx // (1 << o.level), 1) AND o.n > 1
  UNION ALL
  SELECT leaves.tree, leaves.idx, height + o.level, CASE WHEN o.idx % 2 = 0 THEN 'L' ELSE 'R' END, o.hash
  FROM leaves JOIN subroots USING (tree) JOIN top o ON o.idx = xor(leaves.tree // (1 << o.level), 1) AND o.n > 1),
proofs AS (
  SELECT tree, idx, string_agg(hash, '' ORDER BY step) AS proof, map(list(step), list(side || hash)) AS by_step
  FROM steps GROUP BY tree, idx),
folds AS (
  SELECT l.tree, l.idx, 0 AS step, shown AS hash, by_step, height + (SELECT max(level) FROM top) AS height
  FROM leaves l JOIN subroots USING (tree) LEFT JOIN proofs p ON p.tree = l.tree AND p.idx = l.idx
  UNION ALL
  SELECT tree, idx, step + 1,
         sha256(CASE WHEN by_step[step] IS NULL THEN hash
                     WHEN by_step[step][1] = 'L' THEN by_step[step][2:] || hash ELSE hash || by_step[step][2:] END),
         by_step, height
  FROM folds WHERE step < height),
folded AS (SELECT tree, idx, hash AS folded_root FROM folds WHERE step = height)
SELECT doc_id, leaf, subroots.hash AS subroot, top.hash AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root,
       folded_root = top.hash AS verified
FROM leaves JOIN subroots USING (tree) JOIN top ON top.n = 1
JOIN folded ON folded.tree = leaves.tree AND folded.idx = leaves.idx
LEFT JOIN proofs ON proofs.tree = leaves.tree AND proofs.idx = leaves.idx"""

ORACLE_SQL = {
    "op6_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op12_clusters": _clusters_sql(),
    "op13_merkle_manifest": _MERKLE_SQL,
}
