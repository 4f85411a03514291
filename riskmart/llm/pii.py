"""Personal data by fixed patterns and a skip-chain conditional random field.

Patterns give the base spans. Every base span, and every other token or number group that could be personal
data, is a node of its document's graph. Neighbours in the text are joined by chain edges; distant nodes with
the same or a similar core (all digits, the last seven digits, the address in lower case) by skip edges, each to
its next occurrence, so the number of edges is linear. Potentials are learned from base spans of a bounded sample
of documents, by pseudo-likelihood; loopy message passing then settles the labels of a document together. Base
spans keep their label, other nodes get one or none. All other words can only be unlabelled, so they need no
node: they act through the features of their neighbours.

When a document is settled, all occurrences of a core are two hops apart, however many there are: a base span tells its
label to each of them at once, and the others share one variable without text of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_with_texts, text_slices

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = len(KINDS)
N_LABELS = len(KINDS) + 1
#: Documents with nodes that the field is trained on, at most: those with the smallest hashes of their ids.
FIT_DOCS = 3_000
#: Nodes of one of them, at most: the first in the text.
FIT_NODES = 2_000
#: Messages pass until none changes by more than this; the rounds end those that keep swinging.
MESSAGE_TOLERANCE, MOST_ROUNDS = 1e-3, 1_000
FIT_ROUNDS, FIT_RATE, RIDGE = 150, 0.5, 1e-4
NEAR_CHARS = 48
CONTEXT_BUCKETS = 64
#: Prior means of the potentials between equal labels, by type of edge: chain, same, similar. What is learned moves
#: away from them only as far as repeated entities in the sample say so.
CONSISTENCY = (0.0, 5.0, 4.0)
FIXED_UNARY = 60.0  # what holds a base span to its label

_ANY = re.compile(r"[0-9@]").search
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+").finditer
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+").finditer
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").finditer
_NUMBER = re.compile(r"(?<![+(])[+(]*+[0-9](?:[ ().\-/]{0,2}[0-9])*").finditer
_TRIM = frozenset(".,;:!?'\"()<>[]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]  # start, end, kind


def luhn(digits: str) -> bool:
    doubled = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]
    values = [ord(d) - 48 for d in reversed(digits)]
    return (sum(values[::2]) + sum(doubled[v] for v in values[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done, 0
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, without those that fail its check, by start and kind."""
    found = list(_emails(text)) if "@" in text else []
    for m in _IP(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in m[0].split(".")):
            found.append((m.start(), m.end(), 1))
    for m in _CARD(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


def other_candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Words with @ and number groups of at least four digits that touch no base span."""
    found, at = [], text.find("@")
    while at >= 0:
        start = end = at
        while start and not text[start - 1].isspace() and at - start < 80:
            start -= 1
        while end < len(text) and not text[end].isspace() and end - at < 80:
            end += 1
        following = end
        while end > start and text[end - 1] in _TRIM:
            end -= 1
        while start < end and text[start] in _TRIM:
            start += 1
        if start < end:
            found.append((start, end))
        at = text.find("@", following)
    found += [m.span() for m in _NUMBER(text) if m.end() - m.start() >= 4]
    out, reach, b = [], 0, 0
    ends = 0  # of base spans that start before the candidate's end
    for start, end in sorted(found):
        while b < len(base) and base[b][0] < end:
            ends = max(ends, base[b][1])
            b += 1
        if ends <= start and reach <= start:
            out.append((start, end))
            reach = end
    return out


class Graph(NamedTuple):
    """Nodes and edges of several documents."""

    doc: list[int]
    spans: list[tuple[int, int]]
    label: list[int]  # of base spans; -1 for others
    features: list[list[int]]
    edges: list[tuple[int, int, int]]  # node, later node, type: 0 chain, 1 same, 2 similar
    cores: list[tuple[int, int, int]]  # node, number of a core of a document, type: 1 same, 2 similar


#: Feature numbers: bias, @, digits (20), dots (6), other separators (6), three checks of three states, contexts.
_CHECKS = 1 + 2 + 20 + 6 + 6
N_FEATURES = _CHECKS + 9 + 2 * CONTEXT_BUCKETS


def _bucket(word: str) -> int:
    return xxhash.xxh32_intdigest(word.lower().encode("utf-8", "replace")) % CONTEXT_BUCKETS


def node_features(text: str, start: int, end: int) -> list[int]:
    said = text[start:end]
    digits = _NOT_DIGIT.sub("", said)
    others = sum(said.count(c) for c in " ()-/")
    parts = said.split(".")
    checks = (
        said.startswith("+"),
        12 <= len(digits) <= 19 and luhn(digits),
        len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 and int(p) <= 255 for p in parts),
    )
    before, after = text[max(0, start - NEAR_CHARS) : start].split(), text[end : end + NEAR_CHARS].split()
    return [
        0,
        1 + ("@" in said),
        3 + min(len(digits), 19),
        23 + min(said.count("."), 5),
        29 + min(others, 5),
        *(_CHECKS + 3 * i + int(ok) for i, ok in enumerate(checks)),
        _CHECKS + 9 + _bucket(before[-1] if before else ""),
        _CHECKS + 9 + CONTEXT_BUCKETS + _bucket(after[0] if after else ""),
    ]


def graph_of(texts: list[str], bases: list[list[Span]]) -> Graph:
    graph = Graph([], [], [], [], [], [])
    n_cores = 0
    for doc, (text, base) in enumerate(zip(texts, bases)):
        if not base and not _ANY(text):
            continue
        nodes = [(s, e, k) for s, e, k in base] + [(s, e, -1) for s, e in other_candidates(text, base)]
        nodes.sort()
        last: dict[tuple[int, str], int] = {}
        number: dict[tuple[int, str], int] = {}
        for nth, (start, end, kind) in enumerate(nodes):
            node = len(graph.doc)
            graph.doc.append(doc)
            graph.spans.append((start, end))
            graph.label.append(kind)
            graph.features.append(node_features(text, start, end))
            if nth and start - nodes[nth - 1][1] <= NEAR_CHARS:
                graph.edges.append((node - 1, node, 0))
            said = text[start:end]
            digits = _NOT_DIGIT.sub("", said)
            cores = [(1, said.lower() if "@" in said else digits)]
            if "@" not in said and len(digits) >= 7:
                cores.append((2, digits[-7:]))
            for core in cores:
                if not core[1]:
                    continue
                if core in last:
                    graph.edges.append((last[core], node, core[0]))
                last[core] = node
                graph.cores.append((node, number.setdefault(core, n_cores + len(number)), core[0]))
        n_cores += len(number)
    return graph


def first_nodes(graph: Graph, count: int) -> Graph:
    """The first nodes of the graph of one document, and the edges between them."""
    edges = [e for e in graph.edges if e[1] < count]
    cores = [c for c in graph.cores if c[0] < count]
    return Graph(graph.doc[:count], graph.spans[:count], graph.label[:count], graph.features[:count], edges, cores)


class Field(NamedTuple):
    """Potentials: labels x features, and one labels x labels table for each type of edge."""

    unary: np.ndarray
    pair: np.ndarray


def _unary(field: Field, features: np.ndarray) -> np.ndarray:
    return field.unary.T[features].sum(axis=1)


def fit(graph: Graph, seed: int = 3) -> Field:
    """Pseudo-likelihood by gradient ascent: each node's label given its features and its neighbours' labels.

    Nodes that are no base span count as unlabelled, but for those with the core of a base span, which the field is to
    find: they are left out. So that the field does not just repeat the patterns, a second copy of each base node
    has the patterns' own checks set to unknown.
    """
    prior = np.array(CONSISTENCY)[:, None, None] * np.eye(N_LABELS)
    unary, pair = np.zeros((N_LABELS, N_FEATURES)), prior.copy()
    n = len(graph.doc)
    if not n:
        unary[OUTSIDE, 0] = 1.0
        return Field(unary, pair)
    label = np.array([OUTSIDE if k < 0 else k for k in graph.label])
    features = np.array(graph.features)
    blurred = features.copy()
    blurred[:, 5:8] = _CHECKS + 2 + 3 * np.arange(3)
    around = np.zeros((3, n, N_LABELS))  # labels of neighbours, by type of edge
    for i, j, kind in graph.edges:
        around[kind, i, label[j]] += 1
        around[kind, j, label[i]] += 1
    is_base = label != OUTSIDE
    near_miss = ~is_base & (around[1:, :, :OUTSIDE].sum(axis=(0, 2)) > 0)
    x = np.zeros((n + is_base.sum(), N_FEATURES))
    np.put_along_axis(x[:n], features, 1, axis=1)
    np.put_along_axis(x[n:], blurred[is_base], 1, axis=1)
    y = np.concatenate([label, label[is_base]])
    near = np.concatenate([around, around[:, is_base]], axis=1)
    target = np.eye(N_LABELS)[y]
    counted = np.concatenate([~near_miss, np.ones(int(is_base.sum()), bool)])
    for _ in range(FIT_ROUNDS):
        logits = x @ unary.T + np.einsum("knl,kyl->ny", near, pair)
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        miss = (target - p) * counted[:, None]
        unary += FIT_RATE * (miss.T @ x / len(y) * N_LABELS - RIDGE * unary)
        step = np.einsum("ny,knl->kyl", miss, near) / len(y) * N_LABELS
        pair += FIT_RATE * ((step + step.transpose(0, 2, 1)) / 2 - RIDGE * (pair - prior))  # an edge has no direction
    return Field(unary, pair)


def _told(field: Field, graph: Graph, label: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]], int]:
    """What base spans tell the other occurrences of their cores, and edges from those of any other core to a
    variable of its own, numbered after the nodes; the number of nodes and variables."""
    n = len(label)
    told = np.zeros((n, N_LABELS))
    if not graph.cores:
        return told, [], n
    node, core, kind = np.array(graph.cores).T
    said = np.zeros((core.max() + 1, N_LABELS), bool)
    is_base = label[node] >= 0
    said[core[is_base], label[node[is_base]]] = True
    hears = ~is_base & said.any(axis=1)[core]
    out = np.where(said[core[hears]][:, :, None], field.pair[kind[hears]], -np.inf)
    heard = np.logaddexp.reduce(out, axis=1)
    np.add.at(told, node[hears], heard - heard.max(axis=1, keepdims=True))
    free = ~said.any(axis=1)[core] & (np.bincount(core)[core] > 1)
    _, hub = np.unique(core[free], return_inverse=True)
    return told, list(zip(node[free], n + hub, kind[free])), n + int(hub.max(initial=-1)) + 1


def settle(field: Field, graph: Graph) -> np.ndarray:
    """The likeliest label of each node after loopy sum-product message passing, damped by half. A document stops when
    its own messages settle, so its labels do not depend on the documents beside it."""
    label = np.array(graph.label)
    told, shared, n_all = _told(field, graph, label)
    unary = np.zeros((n_all, N_LABELS))
    unary[: len(label)] = _unary(field, np.array(graph.features)) + told
    fixed = np.flatnonzero(label >= 0)
    unary[fixed] = 0
    unary[fixed, label[fixed]] = FIXED_UNARY
    belief = unary.copy()
    edges = [e for e in graph.edges if e[2] == 0] + shared
    if edges:
        i, j, kind = np.array(edges).T
        source, target, tables = np.concatenate([i, j]), np.concatenate([j, i]), field.pair[np.concatenate([kind, kind])]
        back = np.concatenate([np.arange(len(i)) + len(i), np.arange(len(i))])
        messages = np.zeros((len(source), N_LABELS))
        of_doc = np.tile(np.array(graph.doc)[i], 2)  # both ends of an edge are of one document
        moving = np.ones(of_doc.max() + 1, bool)
        for _ in range(MOST_ROUNDS):
            out = (belief[source] - messages[back])[:, :, None] + tables
            top = out.max(axis=1, keepdims=True)
            new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
            step = np.where(moving[of_doc][:, None], (new - new.max(axis=1, keepdims=True) - messages) / 2, 0.0)
            messages = messages + step
            belief = unary.copy()
            np.add.at(belief, target, messages)
            change = np.zeros(len(moving))
            np.maximum.at(change, of_doc, np.abs(step).max(axis=1))
            moving &= change >= MESSAGE_TOLERANCE
            if not moving.any():
                break
    return belief[: len(label)].argmax(axis=1)


def all_spans(field: Field, texts: list[str]) -> tuple[list[list[Span]], list[list[Span]]]:
    """Base spans, and all spans, of each text."""
    bases = [base_spans(t) if _ANY(t) else [] for t in texts]
    spans = [list(b) for b in bases]
    graph = graph_of(texts, bases)
    if graph.doc:
        for node, kind in enumerate(settle(field, graph)):
            if graph.label[node] < 0 and kind != OUTSIDE:
                spans[graph.doc[node]].append((*graph.spans[node], int(kind)))
    return bases, [sorted(s, key=lambda s: (s[0], s[2], s[1])) for s in spans]


def learn(docs: DataFrame, fit_docs: int = FIT_DOCS, fit_nodes: int = FIT_NODES) -> Field:
    """Train on the ``fit_docs`` documents with the smallest hashes among those with a digit or @, one row for each id (that
    with the greatest nodes) and at most ``fit_nodes`` nodes of each."""
    rows = docs.where(F.col("text").rlike("[0-9@]")).select("doc_id", "text")
    order = F.xxhash64("doc_id")
    chosen = rows.select("doc_id").distinct().orderBy(order, "doc_id").limit(fit_docs)
    sample = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "text")  # the rows of fit_docs ids

    def excerpts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Only nodes, features and edges travel to the driver, not texts."""
        for batch in text_slices(batches):
            texts = batch.column("text").to_pylist()
            graphs = [first_nodes(graph_of([t], [base_spans(t)]), fit_nodes) for t in texts]
            columns = [
                batch.column("doc_id"),
                pa.array([g.label for g in graphs], pa.list_(pa.int32())),
                pa.array([[f for node in g.features for f in node] for g in graphs], pa.list_(pa.int32())),
                pa.array([[x for edge in g.edges for x in edge] for g in graphs], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "features", "edges"])

    listed = sample.mapInArrow(excerpts, "doc_id long, label array<int>, features array<int>, edges array<int>")
    one_each = listed.groupBy("doc_id").agg(F.max(F.struct("label", "features", "edges")).alias("row"))
    found = one_each.select("doc_id", "row.*").toArrow()  # fit_docs rows of fit_nodes nodes
    rows_found = sorted(zip(*(found.column(c).to_pylist() for c in ("doc_id", "label", "features", "edges"))), key=str)
    graph, width = Graph([], [], [], [], [], []), len(node_features("0", 0, 1))
    for _, label, features, edges in rows_found:
        first = len(graph.doc)
        graph.doc.extend([0] * len(label))
        graph.label.extend(label)
        graph.features.extend(features[i : i + width] for i in range(0, len(features), width))
        graph.edges.extend((first + edges[i], first + edges[i + 1], edges[i + 2]) for i in range(0, len(edges), 3))
    return fit(graph)


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each span, or run of overlapping spans, replaced by the name of its first kind."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def find(docs: DataFrame, field: Field) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, n_added, base, spans, masked.

    ``base`` and ``spans`` list kind:start:end in code points, end exclusive, joined by commas; the first four
    counts are of base spans, n_added is of those that the field adds. A null text is empty and has no spans. Other columns are ignored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "n_added", "base", "spans", "masked"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = batch.column("text").to_pylist()
            bases, spans = all_spans(shared.value, texts)
            counts = [pa.array([sum(s[2] == k for s in row) for row in bases], pa.int64()) for k in range(len(KINDS))]
            counts.append(pa.array([len(row) - len(base) for row, base in zip(spans, bases)], pa.int64()))
            written = [pa.array(map(_written, rows), pa.string()) for rows in (bases, spans)]
            clean = pa.array([masked(t, s) if s else t for t, s in zip(texts, spans)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, *written, clean], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(run, f"doc_id long, {counts}, n_added long, base string, spans string, masked string")


def mask(docs: DataFrame, field: Field) -> DataFrame:
    """The rows of ``docs``, with all their columns, personal data in the text replaced by its kind. A column
    n_chars follows the text; a null text stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in rows_with_texts(batches):
            texts = column.to_pylist()
            _, spans = all_spans(shared.value, texts)
            at = batch.schema.get_field_index("text")
            was = batch.column(at).to_pylist()
            clean = [masked(t, s) if s else old for t, s, old in zip(texts, spans, was)]
            batch = batch.set_column(at, "text", pa.array(clean, batch.schema.field(at).type))
            sizes = batch.schema.get_field_index("n_chars")
            if sizes >= 0:
                old_sizes = batch.column(sizes).to_pylist()
                new = [len(c) if s else old for c, s, old in zip(clean, spans, old_sizes)]
                batch = batch.set_column(sizes, "n_chars", pa.array(new, batch.schema.field(sizes).type))
            yield batch

    return docs.mapInArrow(run, docs.schema)


def digests(found: DataFrame) -> DataFrame:
    """The rows of ``find`` with the base spans hashed and without texts."""
    counts = [f"n_{k}" for k in KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans", "n_added")
