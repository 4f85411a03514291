"""Packing documents into sequences by a grouping genetic algorithm on islands.

Items are dealt by hash into groups of bounded size. Each group evolves on several islands (Spark groups of
their own) whose chromosomes are whole packings. A crossover injects well-filled bins of one parent into the
other, removes the bins that now hold duplicates, and best-fits the displaced items. After each epoch an
island sends its elite packing to the next island of the group. The best packing of each group stays.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_slices

CAPACITY = 4096
END_ID = 1
ID_BYTES = 4
GROUP_ITEMS = 20_000
ISLANDS = 2
EPOCHS = 2
POPULATION, GENERATIONS = 4, 4
#: Chunks between white space that a worker remembers with their ids, and characters of each, at most.
CACHE_CHUNKS, CACHED_CHARS = 400_000, 64
#: Bytes of text cut at a time: a larger slice repeats fewer chunks of the one before.
SLICE_BYTES = 2 << 20
#: Byte-level vocabularies show a byte that is no visible character as one from 256 on, in order.
BYTE_CHARACTERS = {
    byte: 256 + nth
    for nth, byte in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b))
}
LATIN_END = 0x250


class WordTokenizer:
    """Ids of whole texts from a tokenizer that cuts lower-cased text into words and drops white space.

    Words do not affect each other, so texts are cut at white space, each different chunk is cut into words, and
    the words are encoded by the library's model.
    """

    WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # as in the tokenizer file

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        kinds = (r"\p{L}", r"\p{N}", r"\s")
        letters, numbers, spaces = (
            "".join(re.escape(chr(c)) for c in range(LATIN_END) if regex.match(kind, chr(c))) for kind in kinds
        )
        self.latin = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+").findall
        self.any = regex.compile(self.WORDS).findall
        self.not_space = regex.compile(r"\S+").findall
        self.separators = re.compile("[\x1c-\x1f]").search
        self.beyond_latin = re.compile(f"[^\\0-{chr(LATIN_END - 1)}]").search
        self.model = self.tokenizer.model
        self.cache: dict[str, bytes] = {}  # chunk -> little-endian 32-bit ids
        self.word_ids: dict[str, bytes] = {}  # the same of the chunks' words

    def normal(self, text: str) -> str:
        if text.isascii() or not self.beyond_latin(text):
            return text.lower()  # composed already, and lower-cased character by character
        return self.tokenizer.normalizer.normalize_str(text)

    def chunks(self, texts: list[str]) -> pa.LargeListArray:
        """The normalised texts between white space; no word reaches over white space."""
        texts = [self.normal(text) for text in texts]
        if any(map(self.separators, texts)):  # Arrow also cuts at four separators that are no white space to the tokenizer
            return pa.array([self.not_space(text) for text in texts], pa.large_list(pa.large_string()))
        return pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))

    def words(self, chunk: str) -> list[str]:
        return self.latin(chunk) if chunk.isascii() or not self.beyond_latin(chunk) else self.any(chunk)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers.

        Arrow cuts the texts and numbers their different chunks; only chunks that are new go through Python, and numpy
        strings the chunks' ids together.
        """
        cut = self.chunks(texts)
        coded = cut.flatten().dictionary_encode()
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.cache) >= CACHE_CHUNKS:
            self.cache.clear()
            self.word_ids.clear()
        ids_of = list(map(self.cache.get, chunks))
        for i, found in enumerate(ids_of):
            if found is None:
                chunk = chunks[i]
                ids_of[i] = found = self.encode_chunk(chunk)
                if len(chunk) <= CACHED_CHARS:
                    self.cache[chunk] = found
        return strung(ids_of, coded.indices.to_numpy(), cut.offsets.to_numpy())

    def encode_chunk(self, chunk: str) -> bytes:
        """The ids of a chunk. Its words are normal already, so they go straight to the tokenizer's model."""
        if chunk.isalpha():  # one word
            return self.encode_word(chunk)
        return b"".join(map(self.encode_word, self.words(chunk)))

    def encode_word(self, word: str) -> bytes:
        found = self.word_ids.get(word)
        if found is None:
            shown = word
            if not word.isascii() or not word.isprintable():
                shown = word.encode("utf-8").decode("latin-1").translate(BYTE_CHARACTERS)
            found = array("I", [token.id for token in self.model.tokenize(shown)]).tobytes()
            if len(word) <= CACHED_CHARS:
                self.word_ids[word] = found
        return found


def strung(parts: list[bytes], order: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The ids of ``parts[order]``, one row for each pair of neighbouring bounds."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // ID_BYTES
    starts = np.cumsum(sizes) - sizes
    ids = np.frombuffer(b"".join(parts), "<u4")
    taken = sizes[order]
    ends = np.concatenate([[0], np.cumsum(taken)])
    place = np.repeat(starts[order] - ends[:-1], taken) + np.arange(ends[-1])
    whole = ids[place]
    at = ends[bounds]
    return [whole[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of each row of ``docs(doc_id, text)``: (doc_id, piece, start, length, ids_crc32).

    A document is its ids and then ``END_ID``; only documents longer than ``capacity`` are cut. A null text is
    empty, so it is one piece of length 1. ``path`` names the tokenizer file on every worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in text_slices(batches, slice_bytes=SLICE_BYTES):
            rows: list[list] = [[], [], [], [], []]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokenizer.encode(batch.column("text").to_pylist())):
                ids += END_ID.to_bytes(ID_BYTES, "little")
                for nth, start in enumerate(range(0, len(ids) // ID_BYTES, capacity)):
                    part = ids[start * ID_BYTES : (start + capacity) * ID_BYTES]
                    for column, value in zip(rows, (doc_id, nth, start, len(part) // ID_BYTES, zlib.crc32(part))):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(column, kind) for column, kind in zip(rows, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


Bins = list[list[int]]


def best_fit(order: list[int], lengths: list[int], bins: Bins, capacity: int) -> Bins:
    """Put items, in this order, each into the fullest of ``bins`` that has room, or into a new one."""
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some bin has room r
    for b, items in enumerate(bins):
        room = capacity - sum(lengths[i] for i in items)
        by_room.setdefault(room, []).append(b)
        rooms |= 1 << room
    for i in order:
        length = lengths[i]
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            same = by_room[room]
            b = same.pop()
            if not same:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        by_room.setdefault(room - length, []).append(b)
        rooms |= 1 << (room - length)
    return bins


def fitness(bins: Bins, lengths: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first; among equals, fuller and emptier bins over even ones."""
    return -len(bins), sum((sum(lengths[i] for i in items) / capacity) ** 2 for items in bins)


def crossover(giver: Bins, taker: Bins, lengths: list[int], capacity: int, rng: np.random.Generator) -> Bins:
    """Whole well-filled bins of ``giver`` in ``taker``: bins with duplicates go, what they lose is refitted."""
    ranked = sorted(giver, key=lambda items: -sum(lengths[i] for i in items))
    well_filled = ranked[: max(1, int(len(ranked) * rng.uniform(0.3, 0.7)))]
    injected = [list(items) for items in well_filled]
    taken = bytearray(len(lengths))
    for items in injected:
        for i in items:
            taken[i] = 1
    kept, displaced = [], []
    for items in taker:
        if any(taken[i] for i in items):
            displaced += [i for i in items if not taken[i]]
        else:
            kept.append(list(items))
    displaced.sort(key=lambda i: -lengths[i])
    return best_fit(displaced, lengths, injected + kept, capacity)


def evolve(lengths: list[int], start: list[Bins], capacity: int, seed: int) -> Bins:
    """The best packing found from ``start`` (packings known already) and new random ones."""
    rng = np.random.default_rng(seed)
    sizes = np.array(lengths)
    population = [[list(items) for items in bins] for bins in start]
    if not population:
        population.append(best_fit(np.argsort(-sizes, kind="stable").tolist(), lengths, [], capacity))
    while len(population) < POPULATION:
        order = np.argsort(-sizes * rng.uniform(0.9, 1.1, len(sizes)), kind="stable").tolist()
        population.append(best_fit(order, lengths, [], capacity))
    least = math.ceil(sizes.sum() / capacity)
    ranked = sorted(((fitness(b, lengths, capacity), b) for b in population), key=lambda x: x[0], reverse=True)
    for _ in range(GENERATIONS):
        if len(ranked[0][1]) <= least:
            break  # as few as there can be
        first, second = rng.choice(len(ranked), 2, replace=False)
        for giver, taker in ((first, second), (second, first)):
            child = crossover(ranked[giver][1], ranked[taker][1], lengths, capacity, rng)
            ranked.append((fitness(child, lengths, capacity), child))
        ranked = sorted(ranked, key=lambda x: x[0], reverse=True)[:POPULATION]
    return ranked[0][1]


def _as_bins(numbers: np.ndarray) -> Bins:
    order = np.argsort(numbers, kind="stable")
    return [part.tolist() for part in np.split(order, np.flatnonzero(np.diff(numbers[order])) + 1)]


def _bin_numbers(bins: Bins, n: int) -> np.ndarray:
    numbers = np.zeros(n, np.int64)
    for b, items in enumerate(bins):
        numbers[items] = b
    return numbers


_PACKED = "grp long, island int, item long, length long, bin long"


def _epoch(capacity: int, epoch: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Rows of one island: its items, once for each packing it knows (none in the first epoch)."""
        rows = rows.sort_values(["origin", "item"], kind="stable")
        parts = [part for _, part in rows.groupby("origin", sort=True)]
        items = parts[0]
        known = [_as_bins(p["bin"].to_numpy()) for p in parts] if epoch else []
        seed = (int(key[0]) * ISLANDS + int(key[1])) * 64 + epoch
        bins = evolve(items["length"].tolist(), known, capacity, seed)
        numbers = _bin_numbers(bins, len(items))
        return items.assign(bin=numbers)[["grp", "island", "item", "length", "bin"]]

    return run


def _final(rows: pd.DataFrame) -> pd.DataFrame:
    """The best island's packing of one group, with places in the sequences."""
    bins = rows.groupby("island")["bin"].nunique()
    best = rows[rows["island"] == bins.idxmin()].sort_values(["bin", "item"], kind="stable")
    offset = best.groupby("bin")["length"].cumsum() - best["length"]
    sequence = best["grp"] * (1 << 32) + best["bin"]
    return pd.DataFrame({"item": best["item"], "sequence_id": sequence, "offset": offset})


def pack(items: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS) -> DataFrame:
    """(item, sequence_id, offset) for ``items(item, length)``; item is unique, 1 <= length <= capacity."""
    n = items.count()
    groups = max(1, math.ceil(n / group_items))
    dealt = items.select(
        F.pmod(F.xxhash64("item"), F.lit(groups)).alias("grp"),
        F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        "item",
        "length",
        F.lit(0).alias("origin"),
        F.lit(-1).cast("long").alias("bin"),
    )
    packed = dealt.groupBy("grp", "island").applyInPandas(_epoch(capacity, 0), _PACKED)
    for epoch in range(1, EPOCHS):
        packed = materialize(packed, "islands")
        elite = packed.withColumn("island", ((F.col("island") + 1) % ISLANDS).cast("int"))
        known = packed.withColumn("origin", F.lit(0)).unionByName(elite.withColumn("origin", F.lit(1)))
        packed = known.groupBy("grp", "island").applyInPandas(_epoch(capacity, epoch), _PACKED)
    return packed.groupBy("grp").applyInPandas(_final, "item long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Repeated rows are packed as often as they come. Other columns are ignored; an empty table gives an empty
    result.
    """
    found = pieces(docs, path, capacity).withColumn("item", F.monotonically_increasing_id())
    found = materialize(found, "pieces")
    return found.join(pack(found.select("item", "length"), capacity), "item").drop("item")
