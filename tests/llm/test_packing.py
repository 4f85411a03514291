import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskmart.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return tokenizer


def check(docs, library):
    rows = [tuple(r) for r in packing.pack_documents(docs, PATH).collect()]
    want = []
    for r in docs.collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        for nth, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want.append((r.doc_id, nth, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted((r[:5] for r in rows), key=str) == sorted(want, key=str)
    sequences = {}
    for r in rows:
        sequences.setdefault(r[5], []).append((r[6], r[3]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    return len(sequences), sum(w[3] for w in want)


def test_documents(documents, library):
    used, tokens = check(documents, library)
    assert used <= -(-tokens // 4096) + 1


def test_odd_rows(odd_docs, library):
    check(odd_docs, library)
    assert packing.pack_documents(odd_docs.limit(0), PATH).count() == 0


def test_crossover_keeps_every_item_once():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 60, 300).tolist()
    first = packing.best_fit(list(range(300)), lengths, [], 100)
    second = packing.best_fit(list(range(299, -1, -1)), lengths, [], 100)
    child = packing.crossover(first, second, lengths, 100, rng)
    assert sorted(i for items in child for i in items) == list(range(300))
    assert all(sum(lengths[i] for i in items) <= 100 for items in child)
    best = packing.evolve(lengths, [first, second], 100, 5)
    assert len(best) <= min(len(first), len(second))


@pytest.mark.parametrize("seed", [0, 15, 16])
def test_crossover_improves_on_the_greedy_seeds(monkeypatch, seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(20, 60, int(rng.integers(20, 80))).tolist()
    best = packing.evolve(lengths, [], 100, seed)
    monkeypatch.setattr(packing, "GENERATIONS", 0)
    assert len(best) < len(packing.evolve(lengths, [], 100, seed))


def test_several_groups_and_islands(spark):
    rng = np.random.default_rng(3)
    items = spark.createDataFrame([(i, int(n)) for i, n in enumerate(rng.integers(1, 100, 900))], "item long, length long")
    rows = packing.pack(items, capacity=100, group_items=200).join(items, "item").collect()
    assert len(rows) == 900
    used = {}
    for r in rows:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 100 and len(used) < 1.06 * sum(used.values()) / 100
