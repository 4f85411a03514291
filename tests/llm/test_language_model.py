import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from riskmart.llm import common, language_model


def words(text):
    return (text or "").encode().lower().split() + ["end"]


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    counts = Counter(w for r in rows if not held(r.doc_id) for w in words(r.text))
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for r in rows:
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words(r.text))
        want.append((str(r.doc_id), held(r.doc_id), len(words(r.text)), sum(counts[w] > 0 for w in words(r.text)), total, base))
    found = language_model.scores(docs).collect()
    order = lambda t: (t[0], t[2], t[3], round(t[5], 3))
    got = sorted(((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=order)
    for a, b in zip(got, sorted(want, key=order), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    return found


@pytest.mark.parametrize("frequent", [100_000, 50])
def test_base_scores_of_documents(documents, monkeypatch, frequent):
    monkeypatch.setattr(language_model, "FREQUENT_WORDS", frequent)
    found = check(documents)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > 1.05 * sum(r.base_score for r in held)  # not much worse than the base


def test_odd_rows(odd_docs):
    check(odd_docs)
    assert language_model.scores(odd_docs.limit(0)).count() == 0


def test_filter_never_lowers_a_count():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 4000).astype(np.uint64)
    counts = rng.integers(1, 5000, 4000)
    segment = language_model.Filter.segment_of(keys, 2)
    bits = np.stack([language_model.Filter.build(keys[segment == s], counts[segment == s]) for s in range(2)])
    found = language_model.Filter(bits).levels(keys)
    assert (found >= language_model.level(counts)).all()
    assert (found == language_model.level(counts)).mean() > 0.9
    assert (language_model.Filter(bits).levels(rng.integers(0, 2**63, 4000).astype(np.uint64)) > 0).mean() < 0.1


def test_slices_keep_every_word(monkeypatch):
    monkeypatch.setattr(common, "SLICE_BYTES", 200)
    texts = [None if i % 17 == 0 else f"word{i} Other{i % 7}  last\t{i}" * (i % 5) for i in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    counted = Counter()
    for part in common.text_slices([batch]):
        found = language_model.words_of(part.column("text"))
        distinct = found.distinct.to_pylist()
        counted.update(distinct[i] for i in found.index)
    assert counted == Counter(w for t in texts for w in (t or "").lower().split())


def exact_scores(rows, least_pair=1):
    """Scores from exact quantised counts, without a filter."""
    texts = {i: words(r.text) for i, r in enumerate(rows)}
    held = [zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 10 == 0 for r in rows]
    singles = Counter(w for i, t in texts.items() if not held[i] for w in t)
    pairs = Counter(p for i, t in texts.items() if not held[i] for p in zip(["end", *t], t))
    value = lambda c: float(language_model.count_of_level(language_model.level(np.array([c])))[0]) if c else 0.0
    total, distinct, share = sum(singles.values()), len(singles), language_model.PAIR_SHARE
    out = []
    for t in texts.values():
        score = 0.0
        for before, word in zip(["end", *t], t):
            pair = value(pairs[before, word]) if pairs[before, word] >= least_pair else 0.0
            c_before = max(value(singles[before]), pair)
            p1 = (value(singles[word]) + 0.1) / (total + 0.1 * (distinct + 1))
            score += math.log10(share * pair / c_before + (1 - share) * p1 if c_before else p1)
        out.append(score)
    return out


def test_no_ngram_is_left_out_whatever_the_size(documents, monkeypatch):
    docs = documents.limit(60)
    rows = docs.select("doc_id", "text").collect()
    want = sum(exact_scores(rows))
    for tokens_per_part, slice_bytes in ((2_000_000, 4 << 20), (700, 20_000)):
        monkeypatch.setattr(language_model, "MAX_BITS", 1 << 16, raising=False)
        monkeypatch.setattr(language_model, "TOKENS_PER_PART", tokens_per_part)
        monkeypatch.setattr(language_model, "NGRAM_SLICE_BYTES", slice_bytes, raising=False)
        found = language_model.scores(spark_rows(docs, rows)).collect()
        assert sum(r.score for r in found) == pytest.approx(want, rel=0.01)


def spark_rows(docs, rows):
    return docs.sparkSession.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id long, text string")


def test_scores_of_each_document(documents):
    docs = documents.limit(60)
    rows = docs.select("doc_id", "text").collect()
    want = {r.doc_id: x for r, x in zip(rows, exact_scores(rows))}
    found = language_model.scores(spark_rows(docs, rows)).collect()
    near = [abs(r.score - want[r.doc_id]) <= 0.03 * abs(want[r.doc_id]) + 1e-9 for r in found]
    assert len(found) == len(want) and all(near)  # the filter errs on a few n-grams of each


def test_small_counts_are_read_back_as_they_are():
    counts = np.arange(1, 4)
    assert np.array_equal(language_model.count_of_level(language_model.level(counts)), counts)
    many = np.arange(1, 100_000)
    levels = language_model.level(many)
    for q in np.unique(levels)[:-1]:
        assert language_model.count_of_level(np.array([q]))[0] == many[levels == q].mean()
    assert language_model.count_of_level(np.array([0]))[0] == 0
