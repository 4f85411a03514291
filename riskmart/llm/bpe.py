"""Byte-level BPE by prefix dynamic programming.

Byte-pair encoding has this property: every prefix of a byte string has exactly one valid last token. So
one table per string, holding the last token of each prefix, stands for the encodings of all prefixes. It
is filled left to right: a token that starts where a prefix ends is the last token of the longer prefix
exactly if it may stand after that prefix's own last token. Time is linear in the length, even for runs
of one character, and appending or editing only refills what changed.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices

#: Encoded pieces that a worker remembers; beyond that it starts afresh.
CACHE_PIECES = 400_000
CACHE_PAIRS = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Byte tokens by rank, and which token may follow which."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.never = max(self.tokens) + 1
        self.halves = lru_cache(maxsize=None)(self._halves)
        self.edge = lru_cache(maxsize=None)(self._edge)
        self.pairs: dict[int, bool] = {}
        #: A trie of the tokens: node and byte to node; node to the rank of the token that ends there, or -1.
        self.child: dict[int, int] = {}
        self.rank_at = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                node = self.child.setdefault(node << 8 | byte, len(self.rank_at))
                if node == len(self.rank_at):
                    self.rank_at.append(-1)
            self.rank_at[node] = rank

    def _halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes ``token``; None for one byte or if no merges lead to it."""
        parts, limit = [token[i : i + 1] for i in range(len(token))], self.ranks[token]
        while len(parts) > 2:
            rank, at = min((self.ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= limit:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def reachable(self, token: bytes) -> bool:
        return len(token) == 1 or self.halves(token) is not None

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The tokens at one end of ``token`` as merges build it up, from a single byte to itself, each with
        the rank of the merge that ends it."""
        edge, until = [], self.never
        while True:
            edge.append((token, until))
            if len(token) == 1:
                return edge[::-1]
            token, until = self.halves(token)[side], self.ranks[token]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the token ``right`` may stand after ``left``; ``left`` is -1 at the start."""
        key = (left + 1) << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = self._may_follow(self.tokens[left] if left >= 0 else b"", self.tokens[right])
            self.pairs[key] = known
        return known

    def _may_follow(self, left: bytes, right: bytes) -> bool:
        """Whether merging ``left + right`` never merges across the boundary.

        Both ends next to the boundary grow by merges of ascending rank. Between two such events the tokens
        that touch would merge first if their joint rank came before the next event; of equal ranks the
        leftmost goes first. An empty ``left`` is the start of the string.
        """
        if not self.reachable(right):
            return False
        if not left:
            return True
        a, b, ranks, never = self.edge(left, 1), self.edge(right, 0), self.ranks, self.never
        i = j = 0
        while True:
            (end_a, next_a), (end_b, next_b) = a[i], b[j]
            across = ranks.get(end_a + end_b, never)
            if across < next_a and across <= next_b and across != never:
                return False
            if next_a <= next_b:
                if next_a == never:
                    return True
                i += 1
            else:
                j += 1


class PrefixTable:
    """The valid last token (its rank) of every prefix of a byte string; -1 for the empty one."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def _fill(self, end: int) -> int:
        """The last token of the prefix that ends at ``end``; earlier prefixes are known."""
        v = self.vocabulary
        for start in range(max(0, end - v.longest), end):
            rank = v.ranks.get(self.data[start:end])
            if rank is not None and v.may_follow(self.last[start], rank):
                return rank
        raise ValueError("the vocabulary lacks a byte of the text")

    def append(self, data: bytes) -> None:
        """Add bytes at the end; the prefixes so far keep their tokens."""
        v, first = self.vocabulary, len(self.data)
        self.data = data = self.data + data
        child, rank_at, known, last, size = v.child.get, v.rank_at, v.pairs.get, self.last, len(data)
        last.extend([-1] * (size - first))
        for start in range(max(0, first - v.longest), size):
            left, node, end = (last[start] + 1) << 32, 0, start
            for byte in data[start : start + v.longest]:  # as long as some token begins with these bytes
                node = child(node << 8 | byte)
                if node is None:
                    break
                end += 1
                if last[end] < 0:
                    rank = rank_at[node]
                    if rank >= 0:
                        fits = known(left | rank)
                        if fits or fits is None and v.may_follow(last[start], rank):
                            last[end] = rank
            if last[start + 1] < 0:
                raise ValueError("the vocabulary lacks a byte of the text")

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Put ``data`` in place of ``[start, end)``; prefixes before the edit stay as they are, and so do
        those behind it once as many in a row as the longest token has bytes have come out as before."""
        old, shift = self.last, len(data) - (end - start)
        self.data = self.data[:start] + data + self.data[end:]
        self.last, agree = old[: start + 1], 0
        for at in range(start + 1, len(self.data) + 1):
            if agree >= self.vocabulary.longest:
                self.last.extend(old[at - shift :])
                break
            self.last.append(self._fill(at))
            behind = at - shift
            agree = agree + 1 if at > start + len(data) and self.last[at] == old[behind] else 0

    def ids(self) -> list[int]:
        found, end = [], len(self.data)
        while end:
            found.append(self.last[end])
            end -= len(self.vocabulary.tokens[found[-1]])
        return found[::-1]


LATIN_END = 0x250


def latin_pattern(pattern: str) -> re.Pattern:
    """``pattern`` for texts of characters below ``LATIN_END``, where the letter, number and space classes are
    short lists that the standard library matches faster."""
    letters, numbers, spaces = (
        "".join(re.escape(chr(c)) for c in range(LATIN_END) if regex.match(kind, chr(c)))
        for kind in (r"\p{L}", r"\p{N}", r"\s")
    )
    short = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]").replace(r"\p{L}", f"[{letters}]")
    short = short.replace(r"\p{N}", f"[{numbers}]").replace(r"\S", f"[^{spaces}]").replace(r"\s", f"[{spaces}]")
    return re.compile(short)


class Encoder:
    """Texts to ids and back: each match of the pattern is encoded by itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.split_any = regex.compile(pattern).findall
        self.split_latin = latin_pattern(pattern).findall
        self.beyond_latin = re.compile(f"[^\0-{chr(LATIN_END - 1)}]").search
        self.cache: dict[str, list[int]] = {}

    def split(self, text: str) -> list[str]:
        return self.split_any(text) if self.beyond_latin(text) else self.split_latin(text)

    def piece(self, piece: str) -> list[int]:
        data = piece.encode()
        whole = self.vocabulary.ranks.get(data)
        if whole is not None:  # a token of the list is used as it is, even if no merges lead to it
            return [whole]
        return PrefixTable(self.vocabulary, data).ids()

    def encode(self, text: str) -> list[int]:
        cache, ids = self.cache, []
        for piece in self.split(text):
            known = cache.get(piece)
            if known is None:
                if len(cache) >= CACHE_PIECES:
                    cache.clear()
                known = self.piece(piece)
                if len(piece) <= 64:
                    cache[piece] = known
            ids += known
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array, decoded binary) of each row of ``docs(doc_id, text)``; a null text is empty.
    ``path`` names the rank file on every worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in text_slices(batches):
            ids = [encoder.encode(t) for t in batch.column("text").to_pylist()]
            decoded = pa.array([encoder.decode(i) for i in ids], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), decoded], ["doc_id", "ids", "decoded"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256. Encodes and decodes like
    ``encode`` but hashes in the task, so ids do not travel. Null and empty texts have no tokens. Other
    columns are ignored; an empty table gives an empty result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        names = {rank: str(rank) for rank in encoder.vocabulary.tokens}
        for batch in text_slices(batches):
            counts, of_ids, of_bytes = [], [], []
            for text in batch.column("text").to_pylist():
                ids = encoder.encode(text)
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
