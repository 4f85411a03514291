"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts cover every training document. Each task adds its n-gram counts into one array per language and
slice; Spark sums them. The matrix of log probabilities has a fixed number of columns and one row per
language, so its size does not depend on the corpus, and is broadcast to the scoring tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, text_slices

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
HELD_OUT_MODULUS, HELD_OUT_REST = 3, 1
UNKNOWN = "und"
#: Characters of a longer text whose n-grams are held at a time, some 50 bytes each.
PIECE_CHARS = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def ngram_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all character n-grams of lower-cased texts, and the text each belongs to.

    Texts are joined by one line feed after each; n-grams over such a boundary are left out.
    """
    lowered = pc.utf8_lower(texts)
    lengths = pc.utf8_length(lowered).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    points = np.frombuffer("".join(t + "\n" for t in lowered.to_pylist()).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    ends = np.zeros(len(points), bool)
    ends[np.cumsum(lengths) - 1] = True
    rolled, spans_end = np.zeros(len(points), np.uint64), np.zeros(len(points), bool)
    buckets, owners = [], []
    for order in range(1, max(ORDERS) + 1):
        rolled = rolled[: len(points) - order + 1] * np.uint64(1_000_003) + points[order - 1 :] + np.uint64(1)
        spans_end = spans_end[: len(points) - order + 1] | ends[order - 1 :]
        if order in ORDERS:
            inside = ~spans_end
            buckets.append((((rolled[inside] + np.uint64(order)) * _MIX) >> np.uint64(48)).astype(np.int32))
            owners.append(owner[: len(rolled)][inside])
    return np.concatenate(buckets), np.concatenate(owners)


def cut_long(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, int]]:
    """Texts in parts of bounded size: (parts, the text of each, sign).

    A long text is cut into pieces that look ahead by the characters an n-gram may still need. N-grams that start in
    the look-ahead are those of the next piece: the look-ahead follows on its own with sign -1.
    """
    if not len(texts) or pc.max(pc.utf8_length(texts)).as_py() <= PIECE_CHARS:
        yield texts, np.arange(len(texts)), 1
        return
    ahead = max(ORDERS) - 1
    for i, text in enumerate(texts.to_pylist()):
        for start in range(0, max(1, len(text)), PIECE_CHARS):
            stop = start + PIECE_CHARS
            yield pa.array([text[start : stop + ahead]], pa.large_string()), np.array([i]), 1
            if stop < len(text):
                yield pa.array([text[stop : stop + ahead]], pa.large_string()), np.array([i]), -1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in text_slices(batches):
        langs = pc.dictionary_encode(batch.column("lang"))
        for parts, whose, sign in cut_long(batch.column("text")):
            buckets, owners = ngram_buckets(parts)
            which = langs.indices.to_numpy(zero_copy_only=False)[whose][owners]
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                found = sign * np.bincount(buckets[which == code], minlength=BUCKETS)
                totals[lang] = totals[lang] + found if lang in totals else found
    for lang, counts in totals.items():
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used)), pa.array(used.astype(np.int32)), pa.array(counts[used].astype(np.int64))],
            ["lang", "bucket", "n"],
        )


class Model:
    """Languages and their matrix of log probabilities (languages x buckets), with log priors."""

    def __init__(self, langs: list[str], counts: np.ndarray, docs: np.ndarray):
        self.langs = langs
        rows = counts.sum(axis=1, keepdims=True)
        self.log_prob = np.log((counts + SMOOTHING) / (rows + SMOOTHING * BUCKETS)).T.copy()
        self.log_prior = np.log(docs / docs.sum()) if len(docs) else docs

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        n = len(texts)
        if not self.langs:
            return [UNKNOWN] * n, np.zeros(n)
        logs = np.tile(self.log_prior, (n, 1))
        for parts, whose, sign in cut_long(texts) if n else ():
            buckets, owners = ngram_buckets(parts)
            for code in range(len(self.langs)):  # sparse product: sum the rows of the n-grams present
                logs[:, code] += sign * np.bincount(whose[owners], self.log_prob[:, code][buckets], minlength=n)
        logs -= logs.max(axis=1, keepdims=True)
        share = np.exp(logs)
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        lettered = [any(map(str.isalpha, t)) for t in texts.to_pylist()]
        names = [self.langs[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
        return names, np.where(lettered, share[np.arange(n), best], 0.0)


def learn(docs: DataFrame) -> Model:
    """Fit on all rows of ``docs(text, lang)`` whose lang is not null.

    Brings languages x buckets counts to the driver, whatever the number of documents.
    """
    rows = docs.where("lang is not null").select("text", "lang")
    per_lang = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(per_lang)
    counts = np.zeros((len(langs), BUCKETS))
    summed = rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = summed.toArrow()
    at = {lang: i for i, lang in enumerate(langs)}
    codes = np.array([at[x] for x in found.column("lang").to_pylist()], np.int64)
    counts[codes, found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return Model(langs, counts, np.array([per_lang[x] for x in langs], float))


def held_out(doc_id: Column) -> Column:
    return crc_mod(doc_id, HELD_OUT_MODULUS) == HELD_OUT_REST


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned. Other columns are
    ignored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            names, scores = shared.value.predict(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, then predict all."""
    return identify(docs, learn(docs.where(~held_out(F.col("doc_id")))))
