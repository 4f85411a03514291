from collections import defaultdict

import corpus_pipeline as pipeline
from riskmart.llm import pii, quality, simhash

from .test_simhash import brute_components, brute_print

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_stages_against_brute_force(spark, documents, sf_dir):
    docs = documents
    kept = pipeline.keep_quality(spark, docs, sf_dir)
    ranking = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = {r.doc_id for r in quality.score(docs, ranking).where("predicted = 1").collect()}
    assert rows(kept) == [r for r in rows(docs) if r[0] in good]

    single = pipeline.drop_exact_copies(spark, kept, sf_dir)
    last = {}
    for r in sorted(kept.collect(), key=lambda r: r.doc_id):
        last[r.text] = tuple(r)
    assert rows(single) == sorted(last.values(), key=str)

    apart = pipeline.drop_near_copies(spark, single, sf_dir)
    texts = {r.doc_id: r.text for r in single.collect()}
    root = brute_components({brute_print(t) for t in texts.values()})
    first = defaultdict(list)
    for doc_id, text in texts.items():
        first[root[brute_print(text)]].append(doc_id)
    assert sorted(r.doc_id for r in apart.collect()) == sorted(min(ids) for ids in first.values())

    masked = pipeline.mask_personal_data(spark, apart, sf_dir)
    field = pii.learn(apart)
    want = []
    for r in apart.collect():
        _, spans = pii.all_spans(field, [r.text])
        text = pii.masked(r.text, spans[0])
        assert not any(r.text[s:e] in text for s, e, _ in spans[0]) or not spans[0]
        want.append((r.doc_id, text, r.lang, r.source, len(text) if spans[0] else r.n_chars))
    assert rows(masked) == sorted(want, key=str)
    packed = pipeline.pack(spark, masked, sf_dir)
    assert {r.doc_id for r in packed.collect()} == {r[0] for r in want}
    assert all(f.columns == COLUMNS for f in (kept, single, apart, masked))


def test_run_chains_the_stages(spark, sf_dir):
    assert pipeline.run(spark, sf_dir).count() > 0


def test_odd_rows(spark, odd_docs, sf_dir):
    docs = odd_docs
    for name, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
    single = pipeline.drop_exact_copies(spark, docs, sf_dir).collect()
    assert len(single) == len({r.text or "" for r in docs.collect()})
    texts = {brute_print(r.text) for r in docs.collect()}
    assert pipeline.drop_near_copies(spark, docs, sf_dir).count() == len(set(brute_components(texts).values()))


def test_columns_named_like_the_keys_stay(spark, odd_docs, sf_dir):
    docs = odd_docs.selectExpr("*", "7 AS _text_key", "8 AS _id_key", "9 AS _TEXT_KEY_")
    for stage in (pipeline.drop_exact_copies, pipeline.drop_near_copies):
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        assert {(r._text_key, r._id_key) for r in out.collect()} == {(7, 8)}


def test_the_near_copy_stage_broadcasts_no_keys_of_links(spark, odd_docs, sf_dir, monkeypatch):
    plans, components = [], simhash.components

    def watched(links):
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return components(links)

    monkeypatch.setattr(simhash, "components", watched)
    assert pipeline.drop_near_copies(spark, odd_docs, sf_dir).count() > 0
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]
