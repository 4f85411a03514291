import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from riskmart.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.text or ""].append(r.doc_id)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(
        (str(r.doc_id), str(best[r.text or ""]), len(groups[r.text or ""]), hashlib.sha256((r.text or "").encode()).hexdigest())
        for r in rows
    )


def result(rows):
    return sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in rows)


def test_documents(documents):
    found = exact_dedup.exact_duplicates(documents).collect()
    assert result(found) == brute(documents.collect())
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)


def test_odd_rows(odd_docs):
    found = exact_dedup.exact_duplicates(odd_docs).collect()
    assert result(found) == brute(odd_docs.collect())
    assert sum(r.kept for r in found) == len({r.text or "" for r in odd_docs.collect()})  # one of each group
    assert exact_dedup.exact_duplicates(odd_docs.limit(0)).count() == 0


def test_small_blocks_and_clashing_hashes(documents):
    docs = documents.limit(60).select("doc_id", F.substring("text", 1, 90).alias("text"))
    docs = docs.union(docs.select(F.col("doc_id") + 1000, F.expr("substr(text, 1, 83)"))).union(docs).cache()
    few = lambda c: F.pmod(F.xxhash64(c), F.lit(3))  # noqa: E731  almost all blocks share a hash
    ids = exact_dedup.identities(docs, block_chars=8, hashed=few).collect()
    texts = {(r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in docs.collect()}
    by_identity = defaultdict(set)
    for r in ids:
        by_identity[r.n_blocks, r.identity].add(r.text_sha256)
    assert all(len(s) == 1 for s in by_identity.values())
    assert len(by_identity) == len({t for _, t in texts})


def test_no_python_in_the_plan(documents):
    plan = exact_dedup.exact_duplicates(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
