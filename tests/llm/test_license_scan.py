import re
from collections import defaultdict

import numpy as np
import pytest

from riskmart.llm import license_scan
from riskmart.llm.license_texts import NAMES, NOTICES, TEMPLATES, Template

PLAIN_WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def plain_words(text):
    return PLAIN_WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def base(text):
    words = plain_words(text)
    found = []
    for phrase, label in PHRASES.items():
        own = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    starts = [i for i, _ in found]
    labels = ",".join(sorted({label for _, label in found}))
    return len(words), len(found), min(starts, default=None), max(starts, default=None), labels


def best_span(text, template):
    """The best score of a fuzzy template in ``text``, one diagonal after another."""
    own, words, k = plain_words(template.text), plain_words(text), template.gram
    places = defaultdict(set)
    for i in range(len(words) - k + 1):
        for j in range(len(own) - k + 1):
            if words[i : i + k] == own[j : j + k]:
                places[i - j].add(j)
    best = 0.0
    for d in places:
        near = {e: p for e, p in places.items() if abs(e - d) <= license_scan.DRIFT}
        if max(near, key=lambda e: (len(near[e]), -e)) != d:
            continue
        covered = {w for p in near.values() for j in p for w in range(j, j + k)}
        length = max(e + max(p) + k for e, p in near.items()) - min(e + min(p) for e, p in near.items())
        best = max(best, len(covered) / max(length, len(own)))
    return best


def notice(label):
    return next(t.text for t in NOTICES if t.label == label)


def scan(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return [r for r in sorted(found, key=lambda r: r.doc_id)]


def test_base_places_of_documents(documents):
    found = {r.doc_id: r for r in license_scan.scan(documents).collect()}
    rows = documents.collect()
    assert len(found) == len(rows)
    assert any(r.n_base for r in found.values())
    for r in rows:
        f = found[r.doc_id]
        assert (f.n_words, f.n_base, f.first_word, f.last_word, f.base_labels) == base(r.text)
        assert set(filter(None, f.base_labels.split(","))) <= set(f.labels.split(","))
        assert f.score == (1.0 if f.n_base else 0.0)


def test_odd_rows(odd_docs):
    found = license_scan.scan(odd_docs)
    rows = sorted((str(r.doc_id), r.n_words, r.n_base, r.labels, r.score) for r in found.collect())
    assert rows == sorted((str(r.doc_id), base(r.text)[0], 0, "", 0.0) for r in odd_docs.collect())
    assert license_scan.scan(odd_docs.limit(0)).collect() == []


def test_repeats_overlaps_and_letters(spark):
    texts = [
        "MIT License, mit-license; MIT  LICENSE mit mit license",
        "cc by cc by cc by-nc 4.0",
        "Mit Lizenz. MITİ License MIT License",  # letters beyond ASCII stay as they are; so does a no-break space
        "GNU General Public License, version 3; the GNU Affero General Public License",
        "word " * 300_000 + "Apache License, Version 2.0",  # several pieces
        "x" * 3_000_000 + " mit license " + "y" * 3_000_000,  # words longer than a piece
        "mit " * 400_000 + "license",
    ]
    found = scan(spark, texts)
    for text, f in zip(texts, found):
        assert (f.n_words, f.n_base, f.first_word, f.last_word, f.base_labels) == base(text)
    assert found[1].labels == "cc-by,cc-by-nc"
    assert found[3].labels == "agpl,gpl,gpl-3"
    assert found[4].labels == "apache,apache-2.0"


def test_notices_with_changed_words(spark):
    rng = np.random.default_rng(5)
    texts, labels = [], []
    for template in NOTICES:
        words = template.text.split()
        for kind in ("whole", "added", "dropped", "half"):
            own = list(words)
            at = int(rng.integers(5, len(own) - 4))
            if kind == "added":
                own[at:at] = ["quite"]
            elif kind == "dropped":
                del own[at]
            elif kind == "half":
                own = own[: len(own) // 2]
            filler = [f"w{x}" for x in rng.integers(0, 50, 400)]
            texts.append(" ".join([*filler[:200], *own, *filler[200:]]))
            labels.append(template.label)
    for i, f in enumerate(scan(spark, texts)):
        scores = {t.label: best_span(texts[i], t) for t in NOTICES}
        best = max(scores.values())
        exact = {t.label for t in NAMES if f" {t.text} " in " ".join(plain_words(texts[i]))}
        exact |= set(filter(None, f.base_labels.split(",")))
        if best < license_scan.SIMILARITY:
            assert (set(filter(None, f.labels.split(","))), f.score) == (exact, 1.0 if exact else 0.0)
        else:
            assert f.score == pytest.approx(1.0 if exact else best)
            assert labels[i] in f.labels.split(",")
        if i % 4 == 0:
            assert set(f.labels.split(",")) == {labels[i]} | exact


def test_spans_of_a_notice_twice(spark):
    own = notice("bsd")
    text = f"a b c {own} d e {own} f"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = license_scan.spans(license_scan.votes(docs)).orderBy("start_word").collect()
    n = len(plain_words(own))
    assert [(r.label, r.start_word, r.end_word, r.score) for r in found] == [("bsd", 3, 3 + n, 1.0), ("bsd", 5 + n, 5 + 2 * n, 1.0)]


def test_pieces_cover_the_text(monkeypatch):
    monkeypatch.setattr(license_scan, "SLICE_BYTES", 40)
    rng = np.random.default_rng(3)
    for _ in range(50):
        text = "".join(rng.choice(list("abé ,-Z"), 300)) + "x" * int(rng.integers(0, 90)) + " end"
        want = license_scan.words(text)
        got = []
        for new, first, carried, joined, ends in license_scan.pieces(text.encode(), 1000, 4):
            words = joined.split()
            assert len(words) == len(ends) == new + carried and first == len(got) - carried
            assert [joined[s:e] for s, e in zip([0, *(e + 1 for e in ends[:-1])], ends)] == words
            assert words[:carried] == got[len(got) - carried :]
            got += words[carried:]
        assert got == want


def test_many_templates_are_broadcast_in_parts(spark, monkeypatch):
    texts = ["the mit license", "under the apache license version 2 0", notice("isc"), "", None]
    whole = scan(spark, texts)
    monkeypatch.setattr(license_scan, "BROADCAST_POSITIONS", 60)
    assert scan(spark, texts) == whole


def test_a_gram_fits_its_template(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="gram"):
        license_scan.votes(docs, [*TEMPLATES, Template("x", "two words", 3)])
