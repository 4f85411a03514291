"""Quality scores by Bradley-Terry ranking.

A document of higher quality is preferred over one of lower quality. Weights are learned by logistic loss on
the feature differences of such pairs, so they order documents rather than fit two classes. A cut is then
taken at a quantile of the learned scores, and scores are shifted so that the cut lies at ``CUT_SCORE``.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, rows_with_texts, text_slices

#: Labelled documents that weights are fitted on, at most: those with the smallest hashes of their ids.
FIT_ROWS = 20_000
#: Preference pairs drawn from them.
PAIRS = 60_000
RIDGE = 1e-3
CUT_SCORE = 0.3
HELD_OUT_MODULUS, HELD_OUT_REST = 5, 0
ROUNDS = 12

_CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",",
            b"!?", b"%$&#*@^~", b"|<>{}[]()=/\\_", b"'\"-:;+", bytes(range(128, 256))]
_OF_BYTE = np.array([[byte in c for c in _CLASSES] for byte in range(256)], float)
N_STATS = len(_CLASSES) + 10


def statistics(text: str) -> list[float]:
    """Shape of a whole text: kinds of characters, length of words, repetition of words and lines."""
    raw = text.encode("utf-8", "replace")
    size = len(raw)
    if not size:
        return [0.0] * N_STATS
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _OF_BYTE / size
    words, lines = raw.split(), raw.split(b"\n")
    found = Counter(words)
    n = max(1, len(words))
    singles = sum(1 for c in found.values() if c == 1)
    repeated = sum(a == b for a, b in zip(words, words[1:]))
    letters = kinds[0] + kinds[1] + 1e-9
    return [
        *kinds,
        math.log1p(size),
        math.log1p(n),
        sum(map(len, words)) / n,
        len(found) / n,
        singles / n,
        max(found.values(), default=0) / n,
        repeated / n,
        1 - len(set(lines)) / len(lines),
        len(zlib.compress(raw, 1)) / size,
        kinds[1] / letters,
    ]


def _expanded(stats: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    z = np.clip((stats - mean) / std, -5, 5)
    return np.hstack([z, z * z])


class Ranking:
    """Weights of the statistics and the cut."""

    def __init__(self, stats: np.ndarray, good: np.ndarray, seed: int = 7):
        stats = stats.reshape(-1, N_STATS)
        self.mean = stats.mean(axis=0) if len(stats) else np.zeros(N_STATS)
        self.std = stats.std(axis=0) + 1e-6 if len(stats) else np.ones(N_STATS)
        x = _expanded(stats, self.mean, self.std)
        better, worse = np.flatnonzero(good), np.flatnonzero(~good)
        self.weights, self.cut = np.zeros(2 * N_STATS), 0.0
        if len(better) and len(worse):
            rng = np.random.default_rng(seed)
            self.weights = bradley_terry(x[rng.choice(better, PAIRS)] - x[rng.choice(worse, PAIRS)])
            raw = np.sort(x @ self.weights)
            self.cut = raw[best_quantile(x @ self.weights, good)]
        elif len(worse):
            self.cut = 10.0  # nothing good was seen

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = _expanded(stats, self.mean, self.std) @ self.weights - self.cut
        return 1 / (1 + np.exp(-np.clip(raw + math.log(CUT_SCORE / (1 - CUT_SCORE)) + 1e-9, -500, 500)))


def bradley_terry(differences: np.ndarray) -> np.ndarray:
    """Weights w that maximise the sum of log sigmoid(w . d) over preferred-minus-other differences d."""
    w = np.zeros(differences.shape[1])
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(np.clip(differences @ w, -500, 500)))  # chance of the other order
        gradient = differences.T @ p / len(p) - RIDGE * w
        hessian = (differences * (p * (1 - p))[:, None]).T @ differences / len(p) + RIDGE * np.eye(len(w))
        w = w + np.linalg.solve(hessian, gradient)
    return w


def best_quantile(raw: np.ndarray, good: np.ndarray) -> int:
    """How many of the lowest scores to reject so that most labels are met; the fewest if several are best."""
    ordered = good[np.argsort(raw, kind="stable")]
    right = np.concatenate([[0], np.cumsum(~ordered)]) + np.concatenate([np.cumsum(ordered[::-1])[::-1], [0]])
    return min(int(right.argmax()), len(raw) - 1)


def _statistics_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        stats = pa.array([statistics(t) for t in batch.column("text").to_pylist()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("good"), stats], ["doc_id", "good", "stats"])


def held_out(doc_id: Column) -> Column:
    return crc_mod(doc_id, HELD_OUT_MODULUS) == HELD_OUT_REST


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Ranking:
    """Fit on at most ``fit_rows`` labelled documents outside the held-out fold, one row for each id: that with the
    greatest statistics. Rows of ``labels`` without doc_id or quality are ignored; quality above 0 is good."""
    usable = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
    sample = (
        usable.groupBy("doc_id")
        .agg((F.max("quality") > 0).alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "good", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(_statistics_rows, f"doc_id {id_type}, good boolean, stats array<double>")
    one_each = counted.groupBy("doc_id").agg(F.max(F.struct("stats", "good")).alias("row"))  # bounded by fit_rows
    found = one_each.select("row.good", "row.stats").toArrow()
    order = np.lexsort(np.array(found.column("stats").to_pylist()).reshape(-1, N_STATS).T)
    stats = np.array(found.column("stats").to_pylist()).reshape(-1, N_STATS)[order]
    return Ranking(stats, np.array(found.column("good").to_pylist(), bool)[order])


def score(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted. Null and empty texts are scored like
    any other, from zero statistics. Other columns are ignored; an empty table gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(ranking)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            stats = np.array([statistics(t) for t in batch.column("text").to_pylist()])
            scores = shared.value.score(stats)
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= CUT_SCORE).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``score`` predicts to be good."""
    shared = docs.sparkSession.sparkContext.broadcast(ranking)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in rows_with_texts(batches):
            stats = np.array([statistics(t) for t in texts.to_pylist()])
            yield batch.filter(pa.array(shared.value.score(stats) >= CUT_SCORE))

    return docs.mapInArrow(run, docs.schema)
