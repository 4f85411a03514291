"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs over the whole training corpus are quantised on a logarithmic scale. For a
count of level q the filter holds the pairs (n-gram, 1) to (n-gram, q), so a count is read back by probing for
rising levels until one is missing: errors can only raise a count, and rarely by more than a level. The filter
is dealt into parts by the n-gram's hash, and each part into segments at ``BITS_PER_ITEM``, so its size follows
the number of n-grams and nothing is left out at any size. No machine holds all of it: the distinct n-grams of a
slice of texts are sent to their parts, where a task merges the counts, builds the part and probes it; levels
travel back to the slice, a byte for each n-gram.

    p1(w)     = (c(w) + 0.1) / (N + 0.1 (V + 1))
    p(w | u)  = L c(u w) / c(u) + (1 - L) p1(w)

All c are levels, read from the filter but for those of the most frequent words, which every task knows.

The exact unigram score beside it looks up the most frequent words in a broadcast table of fixed size and all
others by a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, materialize, text_slices

HELD_OUT_MODULUS, HELD_OUT_REST = 10, 0
ADD = 0.1
#: Counts are kept as levels: level q stands for BASE ** (q - 1) and up.
BASE = 1.5
#: L, the share of the pair estimate; all of it goes to p1 after a word never seen. Chosen on a training fold (remainder 1
#: scored by the others): -3.890 log10 a token at 0.15, -3.851 at 0.3, -3.847 at 0.4, -3.855 at 0.5.
PAIR_SHARE = 0.4
BITS_PER_ITEM, PROBES = 12, 3
MOST_LEVELS = 110  # of a 64-bit count
SEGMENT_BITS = 1 << 18
SEGMENT_SHIFT = 16
KEY_BYTES = 5  # of a key, beside its part
#: Bytes of text whose n-grams are sent to the filter together. A longer single text is a slice of its own.
NGRAM_SLICE_BYTES = 4 << 20
ROW_BYTES = 64  # what a row counts beside its text
#: Words in the broadcast table of exact counts.
FREQUENT_WORDS = 100_000
#: Training tokens per part of the filter.
TOKENS_PER_PART = 2_000_000
END_HASH = np.uint64(0x2545F4914F6CDD1D)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers so that every bit depends on every other."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def level(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / math.log(BASE) + 1e-9).astype(np.int64)


def count_of_level(levels: np.ndarray) -> np.ndarray:
    """The count a level stands for: 0 for none, else the mean of the whole numbers in its range."""
    first, beyond = (np.ceil(np.power(BASE, levels + shift) - 1e-9) for shift in (-1.0, 0.0))
    return np.where(levels > 0, (first + np.maximum(beyond - 1, first)) / 2, 0.0)


class Words(NamedTuple):
    """Tokens of some texts: an index into ``distinct`` for each, the text each belongs to, words per text."""

    index: np.ndarray
    owner: np.ndarray
    lengths: np.ndarray
    distinct: pa.Array


def words_of(texts: pa.Array) -> Words:
    """Words are runs of anything but ASCII white space, after lower-casing A-Z."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    values = split.flatten()
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    filled = pc.greater(pc.binary_length(values), 0)  # leading or trailing space leaves empty ones
    if not pc.all(filled).as_py():
        owner, values = owner[filled.to_numpy(zero_copy_only=False)], values.filter(filled)
    encoded = values.dictionary_encode()
    index = encoded.indices.to_numpy(zero_copy_only=False)
    return Words(index, owner, np.bincount(owner, minlength=len(texts)), encoded.dictionary)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _listed(words: pa.Array) -> list[bytes]:
    return words.cast(pa.large_binary()).to_pylist()


def token_hashes(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every token (words, then one end per text), hash of the one before it (the end before a
    first word), and its text; ``hashes`` are those of the distinct words."""
    n = len(words.lengths)
    tokens = with_ends(words, hashes, END_HASH)
    before = np.concatenate([[END_HASH], tokens[:-1]]) if len(tokens) else tokens
    return tokens, before, np.repeat(np.arange(n), words.lengths + 1)


def with_ends(words: Words, of_distinct: np.ndarray, of_end) -> np.ndarray:
    """A value for every token, from those of the distinct words and that of an end."""
    values = np.full(len(words.index) + len(words.lengths), of_end, of_distinct.dtype)
    is_word = np.ones(len(values), bool)
    is_word[np.cumsum(words.lengths + 1) - 1] = False
    values[is_word] = of_distinct[words.index]
    return values


def pair_hashes(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mix(before * _PAIR + tokens)


class Filter:
    """A segmented log-frequency Bloom filter."""

    def __init__(self, segments: np.ndarray):
        self.segments = segments  # segments x SEGMENT_BITS / 8 bytes

    @staticmethod
    def places(keys: np.ndarray, levels: np.ndarray) -> np.ndarray:
        """PROBES bit places in a segment of each (key, level)."""
        h = mix(keys + levels.astype(np.uint64) * _PAIR)
        mask = np.uint64(SEGMENT_BITS - 1)
        return np.stack([(h >> np.uint64(20 * i)) & mask for i in range(PROBES)])

    @staticmethod
    def segment_of(keys: np.ndarray, n: int) -> np.ndarray:
        """Keys are hashes, so their upper bits deal them out evenly."""
        return ((keys >> np.uint64(SEGMENT_SHIFT)) % np.uint64(n)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The bytes of one segment."""
        levels = level(counts)
        bits = np.zeros(SEGMENT_BITS, bool)
        each = np.repeat(keys, levels)
        upto = np.arange(len(each)) - np.repeat(np.cumsum(levels) - levels, levels) + 1
        bits[cls.places(each, upto).ravel()] = True
        return np.packbits(bits, bitorder="little")

    @classmethod
    def over(cls, keys: np.ndarray, counts: np.ndarray) -> Filter:
        """A filter of all keys with a count, with as many segments as they need."""
        keys, counts = keys[counts > 0], counts[counts > 0]
        n = max(1, math.ceil(int(level(counts).sum()) * BITS_PER_ITEM / SEGMENT_BITS))
        segment = cls.segment_of(keys, n)
        order = np.argsort(segment, kind="stable")
        cuts = np.searchsorted(segment[order], np.arange(1, n))
        return cls(np.stack([cls.build(keys[o], counts[o]) for o in np.split(order, cuts)]))

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The highest level up to which each key is present. A key leaves at its first missing bit."""
        flat = self.segments.ravel()
        start = self.segment_of(keys, len(self.segments)) * SEGMENT_BITS
        found = np.zeros(len(keys), np.int64)
        alive, mask = np.arange(len(keys)), np.uint64(SEGMENT_BITS - 1)
        for at in range(1, MOST_LEVELS + 1):
            h = mix(keys + np.array([at], np.uint64) * _PAIR)
            for i in range(PROBES):
                place = start + ((h >> np.uint64(20 * i)) & mask).astype(np.int64)
                present = np.flatnonzero((flat[place >> 3] >> (place & 7).astype(np.uint8)) & 1)
                alive, keys, start, h = alive[present], keys[present], start[present], h[present]
            if not len(alive):
                break
            found[alive] = at
        return found


class Ngrams(NamedTuple):
    """Keys of a slice's distinct words that are not frequent, of the end and of its distinct pairs; exact counts
    of the frequent ones among its distinct words (0 for others), places of the others, the pair of each token."""

    keys: np.ndarray
    known: np.ndarray
    rare: np.ndarray
    pair_of: np.ndarray

    @staticmethod
    def of(words: Words, frequent: dict[bytes, int]) -> Ngrams:
        distinct = _listed(words.distinct)
        hashes = _hashes(distinct)
        known = np.fromiter((frequent.get(w, 0) for w in distinct), np.int64, len(distinct))
        rare = np.flatnonzero(known == 0)
        tokens, before, _ = token_hashes(words, hashes)
        pairs, pair_of = np.unique(pair_hashes(before, tokens), return_inverse=True)
        return Ngrams(np.concatenate([hashes[rare], [END_HASH], pairs]), known, rare, pair_of)

    def counts(self, words: Words, weights: np.ndarray) -> np.ndarray:
        """How often each key occurs, each text counting by its weight (0 or 1)."""
        singles = np.bincount(words.index, weights[words.owner], minlength=len(self.known))[self.rare]
        owner = np.repeat(np.arange(len(weights)), words.lengths + 1)
        pairs = np.bincount(self.pair_of, weights[owner], minlength=len(self.keys) - len(self.rare) - 1)
        return np.concatenate([singles, [weights.sum()], pairs]).astype(np.int64)

    def by_part(self, parts: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """The parts that hold any of the keys, in order, and the places of their keys."""
        part = (mix(self.keys) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order])) + 1
        return part[order][np.concatenate([[0], cuts])], np.split(order, cuts)


def score_texts(words: Words, ngrams: Ngrams, levels: np.ndarray, n_tokens: int, n_distinct: int) -> np.ndarray:
    """log10 probability of each text with its end, from the levels of the slice's n-grams."""
    n = len(ngrams.rare)
    counts = count_of_level(levels)
    of_word = count_of_level(np.where(ngrams.known > 0, level(ngrams.known), 0))
    of_word[ngrams.rare] = counts[:n]
    single = with_ends(words, of_word, counts[n])
    p1 = (single + ADD) / (n_tokens + ADD * (n_distinct + 1))
    pair = counts[n + 1 :][ngrams.pair_of]
    c_before = np.concatenate([counts[n : n + 1], single[:-1]])
    c_before = np.maximum(c_before[: len(single)], pair)  # a quantised history may fall below its pair
    share = np.where(c_before > 0, PAIR_SHARE, 0.0)
    p = share * pair / np.maximum(c_before, 1.0) + (1 - share) * p1
    owner = np.repeat(np.arange(len(words.lengths)), words.lengths + 1)
    return np.bincount(owner, np.log10(np.maximum(p, 1e-300)), minlength=len(words.lengths))


def held_out(doc_id: Column) -> Column:
    return crc_mod(doc_id, HELD_OUT_MODULUS) == HELD_OUT_REST


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        words = words_of(batch.column("text"))
        counts = np.bincount(words.index, minlength=len(words.distinct)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([words.distinct.cast(pa.string()), pa.array(counts)], ["token", "c"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with a number of their slice and their place in it; a null text is empty."""
    first = TaskContext.get().partitionId() << 33
    n = used = at = 0
    for batch in batches:
        column = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
        slices, places = [], []
        for size in pc.add(pc.binary_length(column), ROW_BYTES).to_pylist():
            if used and used + size > NGRAM_SLICE_BYTES:
                n, used, at = n + 1, 0, 0
            slices.append(first + n)
            places.append(at)
            used, at = used + size, at + 1
        columns = [pa.array(slices, pa.int64()), pa.array(places, pa.int64()), batch.column("doc_id"), batch.column("held_out"), column.cast(pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["slice", "at", "doc_id", "held_out", "text"])


def _with_large_texts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Texts are cast before they are cut, as Arrow loses words of cast slices."""
    at = batch.schema.get_field_index("text")
    return batch.set_column(at, "text", batch.column(at).cast(pa.large_string()))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row ranges of consecutive rows of one slice. A slice may come in several, told apart by their first place."""
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = _with_large_texts(batch)
        slices, at = (batch.column(c).to_numpy() for c in ("slice", "at"))
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(slices) != 0) | (np.diff(at) != 1)]))
        for start, end in zip(starts, np.append(starts[1:], batch.num_rows)):
            yield batch.slice(start, end - start)


_PACKED = "part int, slice long, start long, keys binary, counts binary"


def _pack_ngrams(parts: int, frequent: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct n-grams of a run of texts with their counts in training texts, packed by part."""
    for batch in _runs(batches):
        words = words_of(batch.column("text"))
        ngrams = Ngrams.of(words, frequent.value)
        training = ~batch.column("held_out").to_numpy(zero_copy_only=False)
        counts = ngrams.counts(words, training.astype(np.float64)).astype("<u4")
        part, places = ngrams.by_part(parts)
        columns = [
            pa.array(part, pa.int32()),
            pa.array(np.full(len(part), batch.column("slice")[0].as_py()), pa.int64()),
            pa.array(np.full(len(part), batch.column("at")[0].as_py()), pa.int64()),
            pa.array([_short(ngrams.keys[p]) for p in places], pa.binary()),
            pa.array([_small(counts[p]) for p in places], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["part", "slice", "start", "keys", "counts"])


def _short(keys: np.ndarray) -> bytes:
    """The lower ``KEY_BYTES`` of each key: of the four million or so of a part, some seven pairs agree in 40 bits and count as one."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def _long(packed: bytes) -> np.ndarray:
    keys = np.zeros((len(packed) // KEY_BYTES, 8), np.uint8)
    keys[:, :KEY_BYTES] = np.frombuffer(packed, np.uint8).reshape(-1, KEY_BYTES)
    return keys.view("<u8").ravel()


def _small(counts: np.ndarray) -> bytes:
    """A byte for each count if all fit, else four."""
    return counts.astype("u1" if counts.max(initial=0) < 256 else "<u4").tobytes()


def _probe_part(rows: pd.DataFrame) -> pd.DataFrame:
    """Merge the counts of one part, build its segments, and read back the level of every n-gram sent here."""
    sizes = [len(k) // KEY_BYTES for k in rows["keys"]]
    keys = np.concatenate([_long(k) for k in rows["keys"]])
    counts = np.concatenate([np.frombuffer(c, "u1" if len(c) == n else "<u4") for c, n in zip(rows["counts"], sizes)])
    unique, at = np.unique(keys, return_inverse=True)
    total = np.bincount(at, counts, minlength=len(unique)).astype(np.int64)
    del keys, counts
    levels = Filter.over(unique, total).levels(unique).astype(np.uint8)[at]
    cuts = np.cumsum(sizes)[:-1]
    return rows[["part", "slice", "start"]].assign(levels=[x.tobytes() for x in np.split(levels, cuts)])


def word_counts(training: DataFrame) -> DataFrame:
    """(token, c) of all words of ``training(text)``."""
    counted = training.select("text").mapInArrow(_word_counts, "token string, c long")
    return counted.groupBy("token").agg(F.sum("c").alias("c"))


def ngram_levels(slices: DataFrame, parts: int, frequent: Broadcast) -> DataFrame:
    """(part, slice, start, levels) of the n-grams of each run of ``slices``, in the order of ``Ngrams.by_part``."""
    packed = slices.mapInArrow(lambda b: _pack_ngrams(parts, frequent, b), _PACKED)
    return packed.groupBy("part").applyInPandas(_probe_part, "part int, slice long, start long, levels binary")


_SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
    "rare array<struct<token:string,n:long>>"
)


def scores(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null text is empty: only its end is scored. With nothing to learn from all counts are 0. Other columns
    are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    slices = materialize(rows.mapInArrow(_cut, "slice long, at long, doc_id long, held_out boolean, text string"), "slices", "zstd")
    training = slices.where("not held_out").select("text")
    n_docs = training.count()
    counts = materialize(word_counts(training), "word-counts")
    total = counts.agg(F.sum("c"), F.count("*")).first()
    n_tokens, n_distinct = (total[0] or 0) + n_docs, total[1] + (1 if n_docs else 0)
    top = counts.orderBy(F.desc("c"), "token").limit(FREQUENT_WORDS).toArrow()
    frequent = dict(zip(_listed(top.column("token")), top.column("c").to_pylist()))
    parts = max(1, math.ceil(n_tokens / TOKENS_PER_PART))
    below = math.log10(n_tokens + ADD * (n_distinct + 1))
    shared = spark.sparkContext.broadcast(frequent)

    def score_run(batch: pa.RecordBatch, levels_by_part: list[bytes]) -> pa.RecordBatch:
        words = words_of(batch.column("text"))
        ngrams = Ngrams.of(words, shared.value)
        _, places = ngrams.by_part(parts)
        levels = np.empty(len(ngrams.keys), np.uint8)
        levels[np.concatenate(places)] = np.frombuffer(b"".join(levels_by_part), np.uint8)
        n = len(words.lengths)
        n_distinct_here = len(words.distinct)
        known = ngrams.known[words.index]
        of_word = np.where(known > 0, np.log10(known + ADD) - below, 0.0)
        base = np.bincount(words.owner, of_word, minlength=n) + math.log10(n_docs + ADD) - below
        n_known = np.bincount(words.owner, known > 0, minlength=n).astype(np.int64) + (1 if n_docs else 0)
        rare = np.flatnonzero(known == 0)
        both, n_rare = np.unique(words.owner[rare].astype(np.int64) * (n_distinct_here + 1) + words.index[rare], return_counts=True)
        owner, index = both // (n_distinct_here + 1), both % (n_distinct_here + 1)
        offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
        tokens = words.distinct.cast(pa.string()).take(pa.array(index))
        lists = pa.ListArray.from_arrays(
            pa.array(offsets), pa.StructArray.from_arrays([tokens, pa.array(n_rare.astype(np.int64))], ["token", "n"])
        )
        score = score_texts(words, ngrams, levels, n_tokens, n_distinct)
        columns = [batch.column("doc_id"), batch.column("held_out"), pa.array((words.lengths + 1).astype(np.int64)), pa.array(n_known), pa.array(base), pa.array(score), lists]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare"])

    def score_slice(texts: pa.Table, levels: pa.Table) -> pa.Table:
        """One slice: its runs are cut as when their n-grams were sent."""
        texts, levels = texts.sort_by("at"), levels.sort_by([("start", "ascending"), ("part", "ascending")])
        rows = _with_large_texts(pa.RecordBatch.from_arrays([c.combine_chunks() for c in texts.columns], texts.column_names))
        by_start: dict[int, list[bytes]] = {}
        for start, packed in zip(levels.column("start").to_pylist(), levels.column("levels").to_pylist()):
            by_start.setdefault(start, []).append(packed)
        ends = [*list(by_start)[1:], rows.num_rows]
        return pa.Table.from_batches([score_run(rows.slice(start, end - start), by_start[start]) for start, end in zip(by_start, ends)])

    levels = ngram_levels(slices, parts, shared)
    scored = slices.groupBy("slice").cogroup(levels.groupBy("slice")).applyInArrow(score_slice, _SCORED)
    scored = materialize(scored.withColumn("row_id", F.monotonically_increasing_id()), "scored")
    rest = scored.select("row_id", F.explode("rare").alias("r")).select("row_id", "r.token", "r.n")
    looked_up = rest.join(counts, "token", "left").select("row_id", "n", F.coalesce("c", F.lit(0)).alias("c"))
    looked_up = looked_up.groupBy("row_id").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("n") * (F.log10(F.col("c") + ADD) - below)).alias("rare_score"),
    )
    return scored.join(looked_up, "row_id", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("rare_score", F.lit(0.0))).alias("base_score"),
        "score",
    )
