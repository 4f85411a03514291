import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.llm import language, quality


def test_languages_of_documents(documents):
    found = language.languages(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_counts_equal_one_by_one(documents):
    rows = documents.where("lang is not null").limit(30)
    model = language.learn(rows)
    counts = np.zeros((len(model.langs), language.BUCKETS))
    import pyarrow as pa

    for r in rows.collect():
        buckets, _ = language.ngram_buckets(pa.array([r.text]))
        counts[model.langs.index(r.lang)] += np.bincount(buckets, minlength=language.BUCKETS)
    smooth = counts + language.SMOOTHING
    want = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T
    assert np.allclose(model.log_prob, want)


def test_odd_languages(odd_docs):
    found = language.languages(odd_docs).collect()
    assert len(found) == odd_docs.count()
    by_id = {r.doc_id: r for r in found}
    assert by_id[3].lang_pred == by_id[4].lang_pred == by_id[8].lang_pred == "und"
    assert language.languages(odd_docs.limit(0)).count() == 0


def test_quality_of_documents(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = quality.score(documents, quality.learn(documents, labels))
    rows = found.join(labels, "doc_id").collect()
    assert found.count() == documents.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9


def test_bradley_terry_orders_pairs():
    rng = np.random.default_rng(1)
    better, worse = rng.normal(1, 1, (500, 3)), rng.normal(0, 1, (500, 3))
    w = quality.bradley_terry(better - worse)
    assert (w > 0).all()
    gradient = (better - worse).T @ (1 / (1 + np.exp((better - worse) @ w))) / 500 - quality.RIDGE * w
    assert np.abs(gradient).max() < 1e-6


@pytest.mark.parametrize("kept", ["true", "quality = 1", "quality = 0", "false"])
def test_odd_quality(odd_docs, kept):
    labels = odd_docs.select("doc_id", "quality", F.lit(None).alias("score")).where(kept)
    found = quality.score(odd_docs, quality.learn(odd_docs, labels)).collect()
    assert len(found) == odd_docs.count() and all(0 <= r.score <= 1 for r in found)
    assert quality.score(odd_docs.limit(0), quality.learn(odd_docs.limit(0), labels)).count() == 0


def plain_buckets(text):
    """Buckets of the 1- to 3-grams of a text, one character after another."""
    points = [ord(c) for c in text.lower()]
    for order in (1, 2, 3):
        for i in range(len(points) - order + 1):
            rolled = 0
            for p in points[i : i + order]:
                rolled = (rolled * 1_000_003 + p + 1) % 2**64
            yield ((rolled + order) * 0x9E3779B97F4A7C15 % 2**64) >> 48


def test_predictions_equal_a_plain_naive_bayes(spark, documents):
    rows = [r for r in documents.select("doc_id", "text", "lang").orderBy(F.xxhash64("doc_id")).limit(60).collect()]
    rows = [(r.doc_id, r.text[:400], r.lang) for r in rows]
    found = language.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    counts, docs = {}, {}
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 3 != 1 and lang is not None:
            docs[lang] = docs.get(lang, 0) + 1
            own = counts.setdefault(lang, {})
            for b in plain_buckets(text):
                own[b] = own.get(b, 0) + 1
    total = {lang: sum(own.values()) for lang, own in counts.items()}
    texts = {i: text for i, text, _ in rows}
    for r in found:
        logs = {}
        for lang, own in counts.items():
            log = np.log(docs[lang] / sum(docs.values()))
            for b in plain_buckets(texts[r.doc_id]):
                log += np.log((own.get(b, 0) + 0.5) / (total[lang] + 0.5 * 2**16))
            logs[lang] = log
        best = max(sorted(logs), key=logs.get)
        assert r.lang_pred == best
        assert r.score == pytest.approx(1 / sum(np.exp(v - logs[best]) for v in logs.values()), abs=1e-6)


def test_quality_equals_pairwise_ranking_by_gradient(spark, documents, sf_dir):
    """The same pairs fitted by plain gradient descent, the cut tried at every score."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    known = {r.doc_id: r.quality > 0 for r in labels.where("quality is not null").collect()}
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    ids = [i for i in texts if i in known and zlib.crc32(str(i).encode()) % 5]
    stats = np.array([quality.statistics(texts[i]) for i in ids])
    good = np.array([known[i] for i in ids])
    order = np.lexsort(stats.T)
    stats, good = stats[order], good[order]
    z = np.clip((stats - stats.mean(axis=0)) / (stats.std(axis=0) + 1e-6), -5, 5)
    x = np.hstack([z, z * z])
    rng = np.random.default_rng(7)
    pairs = x[rng.choice(np.flatnonzero(good), quality.PAIRS)] - x[rng.choice(np.flatnonzero(~good), quality.PAIRS)]
    w = quality.bradley_terry(pairs)
    p = 1 / (1 + np.exp(pairs @ w))
    assert np.abs(pairs.T @ p / len(p) - quality.RIDGE * w).max() < 1e-3  # where the loss is least
    raw = x @ w
    met = [((raw >= cut) == good).sum() for cut in np.sort(raw)]
    cut = np.sort(raw)[int(np.argmax(met))]
    every = np.array([quality.statistics(t) for t in texts.values()])
    zz = np.clip((every - stats.mean(axis=0)) / (stats.std(axis=0) + 1e-6), -5, 5)
    want = dict(zip(texts, np.hstack([zz, zz * zz]) @ w >= cut))
    found = quality.score(documents, quality.learn(documents, labels)).collect()
    assert np.mean([r.predicted == want[r.doc_id] for r in found]) > 0.995


def test_long_texts_are_counted_in_pieces(documents, monkeypatch):
    import pyarrow as pa

    rows = documents.where("lang is not null").limit(20).collect()
    texts = pa.array([r.text for r in rows] + ["", "a", "İab" * 9], pa.large_string())
    model = language.learn(documents.where("lang is not null").limit(100))
    whole = model.predict(texts)
    plain = np.bincount(language.ngram_buckets(texts)[0], minlength=language.BUCKETS)
    for size in (1, 2, 7, 100):
        monkeypatch.setattr(language, "PIECE_CHARS", size)
        names, scores = model.predict(texts)
        assert names == whole[0] and np.allclose(scores, whole[1])
        counts = sum(s * np.bincount(language.ngram_buckets(p)[0], minlength=language.BUCKETS) for p, _, s in language.cut_long(texts))
        assert np.array_equal(counts, plain)
