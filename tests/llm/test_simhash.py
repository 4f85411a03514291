import random
import re

import xxhash
from pyspark.sql import functions as F

from riskmart.llm import simhash


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a in root:
            for b in root:
                if (a ^ b).bit_count() <= 3 and root[b] < root[a]:
                    root[a], changed = root[b], True
    return root


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    root = brute_components({brute_print(r.text) for r in rows})
    least = {}
    for r in rows:
        of = root[brute_print(r.text)]
        least[of] = min((i for i in (least.get(of), r.doc_id) if i is not None), default=None)
    want = sorted(str((r.doc_id, f"{brute_print(r.text):016x}", least[root[brute_print(r.text)]])) for r in rows)
    assert sorted(str(tuple(r)) for r in simhash.near_duplicates(docs).collect()) == want


def test_documents_with_near_copies(documents):
    docs = documents.select("doc_id", "text").limit(40)
    near = docs.select(F.col("doc_id") + 1000, F.concat("text", F.lit(" tail")))
    check(docs.union(near).union(docs.select(F.col("doc_id") + 2000, F.upper("text"))).cache())


def test_odd_rows(odd_docs):
    check(odd_docs)
    assert simhash.near_duplicates(odd_docs.limit(0)).count() == 0


def test_links_equal_all_pairs(spark):
    rng = random.Random(4)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for p in list(prints):
        for bits in (1, 2, 3, 4, 5):
            q = p
            for b in rng.sample(range(64), bits):
                q ^= 1 << b
            prints.add(q)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    found = {frozenset(r) for r in simhash.links(frame).collect()}
    some = list(prints)
    want = {
        frozenset((signed(a), signed(b)))
        for i, a in enumerate(some) for b in some[i + 1 :] if (a ^ b).bit_count() <= 3
    }
    assert found == want and want


def test_keys_of_links_are_not_broadcast(spark):
    """68 keys a fingerprint are sized as one, so that a small table of fingerprints makes a broadcast that fills the driver."""
    plan = simhash.links(spark.range(1000).withColumnRenamed("id", "fp"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
