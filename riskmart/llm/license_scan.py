"""License scans by diagonal voting.

All rolling word grams of all texts are joined by hash with the positions of the same grams in license templates.
Each hit (word i of the text, word j of the template) votes for the diagonal i - j, the place where the template
would start. Votes are summed by diagonal; neighbouring diagonals, as missing or added words make them, are merged
around the one with most votes; a span is verified by the share of words it has in common with the template. Grams
that share a hash are told apart by their words in the join.

Only votes leave the scan: texts are cut into words task by task and not shuffled.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, materialize, rows_with_texts
from .license_texts import TEMPLATES, Template

#: Least share of common words of a span that is not a base phrase.
SIMILARITY = 0.8
#: Diagonals so many words from the one with most votes are merged with it.
DRIFT = 12
#: A window over diagonals covers so many of a text at a time.
CELL = 1 << 16
#: Template positions that are broadcast at once, some 100 bytes each. Longer lists of templates are scanned in parts.
BROADCAST_POSITIONS = 200_000

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_NO_WORD = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_IS_WORD = np.array([_WORD.match(bytes([b])) is not None for b in range(256)])


def words(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())  # bytes: lower-cases A-Z only


def spaced(text: bytes, longest: int) -> tuple[bytes, np.ndarray]:
    """The words of a lower-cased text joined by single spaces, and where each ends. Words of more than ``longest``
    bytes, which no template has, are replaced by a zero byte."""
    raw = np.frombuffer(text, np.uint8)
    word = _IS_WORD[raw]
    after = np.zeros(len(raw), bool)
    after[1:] = word[:-1] & ~word[1:]
    kept = raw[word | after]
    ends = np.flatnonzero(~_IS_WORD[kept])
    kept[ends] = 32
    if len(kept) and kept[-1] != 32:
        ends = np.append(ends, len(kept))
    joined = kept.tobytes()
    if len(ends) and np.diff(ends, prepend=-1).max() > longest + 1:
        return spaced_words(w if len(w) <= longest else b"\0" for w in joined.split())
    return joined, ends.astype(np.int32)


def spaced_words(found: Iterable[bytes]) -> tuple[bytes, np.ndarray]:
    found = list(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return b" ".join(found), (np.cumsum(sizes + 1) - 1).astype(np.int32)


def pieces(text: bytes, longest: int, carry: int) -> Iterator[tuple[int, int, int, bytes, np.ndarray]]:
    """A text in pieces of about ``SLICE_BYTES``, cut between words: (new words, index of the first word, words
    carried over from the piece before, words joined by spaces, ends). Each piece starts with the last ``carry``
    words of the one before, so that no gram is lost at a cut."""
    text = text.lower()  # bytes: A-Z only
    at, first, held = 0, 0, b""
    while True:
        stop = min(at + SLICE_BYTES, len(text))
        if stop < len(text):
            inside = np.flatnonzero(~_IS_WORD[np.frombuffer(text, np.uint8, stop - at, at)])
            if len(inside):
                stop = at + int(inside[-1]) + 1
            else:  # inside a very long word: up to its end
                beyond = _NO_WORD.search(text, stop)
                stop = beyond.end() if beyond else len(text)
        joined, ends = spaced(text[at:stop], longest)
        new, carried = len(ends), held.count(b" ") + 1 if held else 0
        if carried:
            shifted = ends + np.int32(len(held) + 1)
            joined, ends = held + b" " + joined, np.concatenate([spaced_words(held.split(b" "))[1], shifted])
        yield new, first - carried, carried, joined, ends
        at, first = stop, first + new
        if at >= len(text):
            return
        held = b" ".join(joined.split()[-carry:])


_PIECE = "n_words long, first long, carried int, joined binary, ends array<int>"


def _cut(batches: Iterator[pa.RecordBatch], longest: int, carry: int) -> Iterator[pa.RecordBatch]:
    for batch, texts in rows_with_texts(batches):
        whose, cut, size = [], [], 0
        for i, text in enumerate(texts.cast(pa.large_binary()).to_pylist()):
            for piece in pieces(text, longest, carry):
                whose.append(i)
                cut.append(piece)
                size += len(piece[3])
                if size > SLICE_BYTES:
                    yield _piece_batch(batch, whose, cut)
                    whose, cut, size = [], [], 0
        if cut:
            yield _piece_batch(batch, whose, cut)


def _piece_batch(batch: pa.RecordBatch, whose: list[int], cut: list[tuple]) -> pa.RecordBatch:
    new, first, carried, joined, ends = zip(*cut)
    bounds = np.concatenate([[0], np.cumsum([len(e) for e in ends])]).astype(np.int32)
    ids = batch.select(["row_id", "doc_id"]).take(pa.array(whose))
    arrays = [
        *ids.columns,
        pa.array(new, pa.int64()),
        pa.array(first, pa.int64()),
        pa.array(carried, pa.int32()),
        pa.array(joined, pa.binary()),
        pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(ends), pa.int32())),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["row_id", "doc_id", "n_words", "first", "carried", "joined", "ends"])


def _positions(templates: Sequence[Template]) -> list[tuple[int, int, bytes]]:
    """(template, place, gram) of all grams of the templates."""
    found = []
    for number, template in enumerate(templates):
        own = words(template.text)
        if not 2 <= template.gram <= len(own):
            raise ValueError(f"a gram has 2 words at least and no more than its template: {template}")
        for place in range(len(own) - template.gram + 1):
            found.append((number, place, b" ".join(own[place : place + template.gram])))
    return found


def votes(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Hits (row_id, doc_id, template, place, word), and one row or more of each text with its n_words and no
    template. Written to the shared folder."""
    spark = docs.sparkSession
    positions = _positions(templates)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", F.col("text").cast("string").alias("text")
    )
    longest = max(len(w) for t in templates for w in words(t.text))
    sizes = sorted({t.gram for t in templates})
    cut = functools.partial(_cut, longest=longest, carry=max(sizes) - 1)
    schema = T.StructType([*rows.schema.fields[:2], *T._parse_datatype_string(_PIECE).fields])
    word = rows.mapInArrow(cut, schema).select("*", F.posexplode_outer("ends").alias("i", "end"))
    gram = word.select("*", F.explode(F.array(*map(F.lit, sizes))).alias("size"))
    i, size = F.col("i"), F.col("size")
    start = F.when(i >= size, F.get("ends", i - size) + 1).otherwise(0)
    whole = (i >= size - 1) & (i >= F.col("carried"))
    gram = gram.withColumn("gram", F.when(whole, F.substring("joined", start + 1, F.col("end") - start)))
    gram = gram.withColumn("hash", F.when(whole, F.xxhash64("gram")))
    one_each = (size == sizes[0]) & F.coalesce(i == 0, F.lit(True))  # no gram ends at a first word
    found = None
    for part in range(0, len(positions), BROADCAST_POSITIONS):
        some = _template_grams(spark, positions[part : part + BROADCAST_POSITIONS])
        joined = gram.join(F.broadcast(some), F.col("hash") == F.col("t_hash"), "left")
        same = F.col("gram") == F.col("t_gram")
        hits = joined.where(same if found is not None else F.coalesce(same, one_each))
        hits = hits.select(
            "row_id",
            "doc_id",
            F.when(F.col("template").isNull(), F.col("n_words")).alias("n_words"),
            "template",
            "place",
            (F.col("first") + i - size + 1).alias("word"),
        )
        found = hits if found is None else found.unionByName(hits)
    return materialize(found, "license-votes")


def _template_grams(spark: SparkSession, positions: list[tuple[int, int, bytes]]) -> DataFrame:
    rows = spark.createDataFrame([(t, p, bytearray(g)) for t, p, g in positions], "template int, place int, t_gram binary")
    return rows.withColumn("t_hash", F.xxhash64("t_gram"))


def _template_table(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    rows = [(n, t.label, len(words(t.text)), t.gram, t.exact, t.base) for n, t in enumerate(templates)]
    return spark.createDataFrame(
        rows, "template int, label string, length int, size int, exact boolean, base boolean"
    )


def _by_cells(rows: DataFrame, at: str) -> DataFrame:
    """Rows dealt out by cells of column ``at``, those near a border to both, so that no window holds more than a
    cell of a text. Each row is its ``own`` cell's."""
    cells = [F.floor((F.col(at) + shift) / CELL) for shift in (-DRIFT, 0, DRIFT)]
    return rows.select("*", cells[1].alias("own"), F.explode(F.array_distinct(F.array(*cells))).alias("cell"))


def _merge_neighbours(diagonals: DataFrame) -> DataFrame:
    """One row per diagonal that has most votes within ``DRIFT`` words (ties: the first), with the places that it and
    its neighbours have together."""
    at = F.col("diagonal")
    near = Window.partitionBy("row_id", "template", "cell").orderBy("diagonal").rangeBetween(-DRIFT, DRIFT)
    rank = F.struct(F.size("places"), -at)
    together = _by_cells(diagonals, "diagonal").select(
        "*",
        F.array_distinct(F.flatten(F.collect_list("places").over(near))).alias("together"),
        F.min(at + F.array_min("places")).over(near).alias("start_word"),
        F.max(at + F.array_max("places") + F.col("size")).over(near).alias("end_word"),
        (rank == F.max(rank).over(near)).alias("best"),
    )
    return together.where("best AND own = cell").drop("best", "own", "cell")


def _best_reading(found: DataFrame) -> DataFrame:
    """Notices share sentences: of spans that start within ``DRIFT`` words the one with the best score stays (ties:
    the longer template, then the earlier one)."""
    near = Window.partitionBy("row_id", "cell").orderBy("start_word").rangeBetween(-DRIFT, DRIFT)
    rank = F.struct("score", "length", -F.col("template"), -F.col("start_word"))
    ranked = _by_cells(found, "start_word").withColumn("best", rank == F.max(rank).over(near))
    return ranked.where("best AND own = cell")


def _common_words(places: Column, size: Column) -> Column:
    """How many words of the template the grams at these places cover."""
    covered = F.transform(places, lambda p: F.sequence(p, p + size - 1))
    return F.size(F.array_distinct(F.flatten(covered)))


def spans(hits: DataFrame, templates: Sequence[Template] = TEMPLATES, similarity: float = SIMILARITY) -> DataFrame:
    """(row_id, doc_id, label, base, start_word, end_word, score) of verified spans; words count from 0, end exclusive.

    The score of a span is the number of words in common over the longer of span and template. An exact template
    is found only word for word, each occurrence on its own."""
    diagonals = (
        hits.where("template IS NOT NULL")
        .groupBy("row_id", "doc_id", "template", (F.col("word") - F.col("place")).alias("diagonal"))
        .agg(F.collect_set("place").alias("places"))
        .join(F.broadcast(_template_table(hits.sparkSession, templates)), "template")  # as long as the list of templates
    )
    columns = ["row_id", "doc_id", "label", "base", "start_word", "end_word", "score"]
    whole = diagonals.where("exact AND size(places) = length - size + 1").select(
        *columns[:4],
        F.col("diagonal").alias("start_word"),
        (F.col("diagonal") + F.col("length")).alias("end_word"),
        F.lit(1.0).alias("score"),
    )
    merged = _merge_neighbours(diagonals.where("NOT exact"))
    longer = F.greatest(F.col("length").cast("long"), F.col("end_word") - F.col("start_word"))
    scored = merged.withColumn("score", _common_words(F.col("together"), F.col("size")) / longer)
    return whole.unionByName(_best_reading(scored.where(F.col("score") >= similarity)).select(*columns))


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts the places of base phrases and ``first_word`` and ``last_word`` are the smallest and largest
    start of one, null if there is none. ``labels`` has those of all spans. ``score`` is the greatest of a span, 0
    without one. A null text is empty: no words and no labels. Repeated rows and rows without an id have a result
    each; other columns are ignored; an empty table gives an empty result.
    """
    hits = votes(docs, templates)
    found = spans(hits, templates, similarity)
    texts = hits.where("template IS NULL").select("row_id", "doc_id", "n_words")
    base = F.col("base")
    joined = lambda labels: F.array_join(F.array_sort(F.collect_set(labels)), ",")
    return (
        texts.unionByName(found, allowMissingColumns=True)
        .groupBy("row_id", "doc_id")
        .agg(
            F.sum("n_words").alias("n_words"),
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, F.col("start_word"))).alias("first_word"),
            F.max(F.when(base, F.col("start_word"))).alias("last_word"),
            joined(F.when(base, F.col("label"))).alias("base_labels"),
            joined(F.col("label")).alias("labels"),
            F.coalesce(F.max("score"), F.lit(0.0)).alias("score"),
        )
        .drop("row_id")
    )
