import hashlib
import zlib

import pytest

from riskmart.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, n_chars):
    values = [row.doc_id, row.source, row.lang, n_chars, row.text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(hashes):
    """The levels of a tree, leaves first."""
    levels = [hashes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return levels


def steps(levels, at):
    """(sibling, whether it stands on the left) or None, level by level."""
    found = []
    for level in levels[:-1]:
        other = at ^ 1
        found.append((level[other], other < at) if other < len(level) else None)
        at //= 2
    return found


def brute(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r.lang, []).append(r)
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    for v in by_lang.values():
        v.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.n_chars)))
    trees = [tree([leaf(r, r.n_chars) for r in by_lang[lang]]) for lang in langs]
    top = tree([t[-1][0] for t in trees])
    found = []
    for t, lang in enumerate(langs):
        for i, r in enumerate(by_lang[lang]):
            path = steps(trees[t], i) + steps(top, t)
            changed = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and r.n_chars is not None
            own = leaf(r, r.n_chars + 1 if changed else r.n_chars)
            for step in path:
                own = sha(own) if step is None else sha(step[0] + own if step[1] else own + step[0])
            proof = sha("".join(s[0] for s in path if s))
            found.append((r.doc_id, trees[t][0][i], trees[t][-1][0], top[-1][0], proof, own, own == top[-1][0]))
    return found


def assert_same(docs):
    found = merkle.manifest(docs)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got, want = sorted(map(str, map(tuple, found.collect()))), sorted(map(str, brute(docs.collect())))
    assert got == want
    return want


def test_documents(documents):
    assert_same(documents)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, idx int, tree string, hash string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)


def test_odd_rows(spark):
    rows = [
        (1, "a", "en", "s", 1), (1, "a", "en", "s", 1), (1, "b", "en", "s", 1), (None, "c", "en", None, 7), (2, None, None, None, None),
        (3, "", "", "", 0), (4, "é\U0001f600", "é", "1:2", 2**63 - 1), (5, "x" * 100_000, "en", "s", -3),
        (None, None, None, None, None), (0, "z", "￿", "s", 1), (9, "z", "\U00010000", "s", 1),
    ]
    rows += [(i, f"t{i}", "de", "s", i) for i in range(100, 121)]
    verified = [r.endswith("True)") for r in assert_same(frame(spark, rows))]
    assert any(verified) and not all(verified)
    assert merkle.manifest(frame(spark, rows).limit(0)).collect() == []


@pytest.mark.parametrize("sizes", [[1], [2], [1, 1], [1, 3], [5, 1, 1], [17], [8, 1, 4], [1] * 9])
def test_small_trees(spark, sizes):
    rows = [(100 * t + i, "text", f"l{t}", "s", i) for t, n in enumerate(sizes) for i in range(n)]
    assert_same(frame(spark, rows))


def test_segments_and_no_python(documents):
    found = merkle.proofs(documents)
    assert "Python" not in (plan := found._jdf.queryExecution().toString()) and "Arrow" not in plan
    row = found.where("tampered IS NULL").first()
    assert row.segment and all(s[0] in (0, 1, 2) and len(s) == (33 if s[0] else 1) for s in row.segment)


def test_numbers_follow_the_order(spark):
    rows = spark.createDataFrame([(f"g{i % 3}", i * 7919 % 1000) for i in range(1000)], "g string, v long")
    found = merkle.numbered(rows, ["g", "v"], ["g"], "n").collect()
    for g in ("g0", "g1", "g2"):
        own = sorted((r.v, r.n) for r in found if r.g == g)
        assert [n for _, n in own] == list(range(len(own)))
