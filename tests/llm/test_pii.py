import hashlib
import random
import re
import time

import pytest

from riskmart.llm import pii

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def brute(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
            ok = (
                True,
                kind == 1 and all(int(p) <= 255 for p in m[0].split(".")),
                12 <= len(digits) <= 19 and total % 10 == 0,
                9 <= len(digits) <= 15,
            )[kind]
            if ok:
                found.append((m.start(), m.end(), kind))
    return sorted(found, key=lambda s: (s[0], s[2]))


@pytest.fixture(scope="module")
def field(documents):
    return pii.learn(documents)


def test_base_spans_equal_plain_patterns(documents):
    rng = random.Random(8)
    made = ["".join(rng.choices("01239 .-+()@aB%é\n", k=rng.randrange(90))) for _ in range(4000)]
    made += ["1.2.3.4.5.6.7.8", "a@b@c.de@f.g", "0001.2.3.4", "4111 1111 1111 1111", "+1 (017) 555-7713", "1.1.1.1" * 50]
    for text in made + [r.text for r in documents.collect()]:
        assert pii.base_spans(text) == brute(text)


def test_repeated_entities_get_one_label(field):
    text = "Call +1 (017) 555-7713 today.\n" + "words between. " * 40 + "Or (017) 555-7713 later; in 1999 we had 20000 visits."
    base, spans = (x[0] for x in pii.all_spans(field, [text]))
    assert [text[s:e] for s, e, _ in base] == ["+1 (017) 555-7713"]
    assert set(base) <= set(spans)
    assert [(pii.KINDS[k], text[s:e]) for s, e, k in spans] == [("phone", "+1 (017) 555-7713"), ("phone", "(017) 555-7713")]
    assert pii.masked(text, spans).count("<PHONE>") == 2
    assert pii.all_spans(field, ["Version 4.0 of 1999, with 20000 visits."])[1][0] == []


@pytest.mark.parametrize("first", [0, 25, 50])
def test_fifty_repeats_get_one_label(field, first):
    said = ["Or (017) 555-7713 later"] * 51
    said[first] = "Call +1 (017) 555-7713 today"
    text = (".\n" + "words between. " * 40).join(said)
    base, spans = (x[0] for x in pii.all_spans(field, [text]))
    assert len(base) == 1 and len(spans) == 51 and all(k == pii.KINDS.index("phone") for *_, k in spans)


def test_documents(documents, field):
    found = pii.digests(pii.find(documents, field)).collect()
    assert len(found) == documents.count()
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in found:
        base = [f"{pii.KINDS[k]}:{s}:{e}" for s, e, k in brute(texts[r.doc_id])]
        assert set(base) <= set(r.spans.split(","))
        assert r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added == len([x for x in r.spans.split(",") if x])


def test_odd_rows(odd_docs):
    field = pii.learn(odd_docs)
    found = {r.doc_id: r for r in pii.find(odd_docs, field).collect()}
    assert found[7].n_email == found[7].n_phone == 1 and found[3].spans == ""
    assert found[7].masked == "mail <EMAIL> now, call <PHONE>"
    assert pii.find(odd_docs.limit(0), pii.learn(odd_docs.limit(0))).count() == 0


def test_hostile_texts_take_linear_time(field):
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1 " * 100_000, "+1((" * 50_000, "a@" * 100_000, "1." * 100_000):
        pii.all_spans(field, [text])


def test_base_digests_and_counts_by_kind(documents, field):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in pii.digests(pii.find(documents, field)).collect():
        base = brute(texts[r.doc_id])
        written = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, e, k in base)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in base) for k in range(4)]


def test_runs_of_brackets_take_linear_time():
    started = time.process_time()
    for text in ("1" + "(" * 1_000_000, "+" * 1_000_000, "1(" * 300_000):
        pii.other_candidates(text, [])
    assert time.process_time() - started < 6
    old = re.compile(r"[+(]*[0-9](?:[ ().\-/]{0,2}[0-9])*")
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choices("12+( ().-/a", k=rng.randrange(40)))
        assert [m.span() for m in pii._NUMBER(text)] == [m.span() for m in old.finditer(text)]


def test_labels_do_not_depend_on_the_documents_beside(field):
    phones = "Call +1 (017) 555-7713 today, or (017) 555-7713, 017 555 7713 later."
    swinging = " ".join(f"{a}{b}{a}-1234567" for a in range(10) for b in range(10))
    alone = pii.all_spans(field, [phones])[1][0]
    assert pii.all_spans(field, [swinging, phones, swinging])[1][1] == alone


def test_what_the_field_learns_from_is_bounded(spark):
    rows = [(1, "id 1234 " * (i % 3 + 1)) for i in range(500)] + [(2, "number 12345 and " * 5_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    real = pii.fit
    try:
        pii.fit = lambda graph: seen.append(len(graph.doc)) or real(graph)
        pii.learn(docs, fit_docs=10, fit_nodes=300)
    finally:
        pii.fit = real
    assert seen == [3 + 300]
