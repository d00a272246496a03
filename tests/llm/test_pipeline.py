import collections

import pytest
from test_licenses_packing import check_pack
from test_neardup_topk_sketch_fixity import brute_components, shingles
from test_secrets_sharding import all_spans

import corpus_pipeline
from ordo.llm import mixing, quality
from ordo.llm.common import table


def masked(text):
    out, at = [], 0
    for a, _, _, e in sorted(all_spans(text)):
        if e <= at:
            continue
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = e
    return "".join(out) + text[at:]


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    base, docs, out = tmp_path_factory.mktemp("stages"), table(spark, sf, "documents"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, sf).write.parquet(str(base / str(k)))
        docs = spark.read.parquet(str(base / str(k)))
        out.append((name, before, docs))
    return out


def test_stages_are_chained_and_keep_columns(stages):
    assert len(stages) == 5
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes


def test_quality_stage_keeps_what_scores_enough(spark, sf, stages):
    _, before, after = stages[0]
    scores = {r["doc_id"]: r["score"] for r in quality.classify(before, table(spark, sf, "labels")).collect()}
    assert {r["doc_id"] for r in after.collect()} == {k for k, v in scores.items() if v >= quality.THRESHOLD}


def test_one_document_of_each_group_stays(stages):
    _, before, after = stages[1]
    want = brute_components({r["doc_id"]: shingles(r["text"], 5) for r in before.collect()})
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(k for k, v in want.items() if k == v)


def test_secrets_are_masked_and_clean_texts_stay(stages):
    _, before, after = stages[2]
    was = {r["doc_id"]: r for r in before.collect()}
    rows = after.collect()
    assert len(rows) == len(was)
    for r in rows:
        old = was[r["doc_id"]]
        assert r["text"] == masked(old["text"])
        assert r["n_chars"] == (len(r["text"]) if r["text"] != old["text"] else old["n_chars"])


def test_mix_repeats_documents(stages):
    _, before, after = stages[3]
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(before).collect() if r["copies"]}
    assert collections.Counter(r["doc_id"] for r in after.collect()) == want


def test_packing_holds_every_copy(stages):
    _, before, after = stages[4]
    copies = collections.Counter(r["doc_id"] for r in before.collect())
    rows = after.collect()
    pieces = collections.Counter((r["doc_id"], r["piece"]) for r in rows)
    assert all(n == copies[k] for (k, _), n in pieces.items()) and {k for k, _ in pieces} == set(copies)
    single = {r["doc_id"]: r["text"] for r in before.collect() if copies[r["doc_id"]] == 1}
    check_pack(rows, single, list(single)[:30])


def test_stages_take_odd_and_empty_tables(spark, sf, odd, none):
    for docs in (odd.select("doc_id", "text", "lang", "source", "n_chars"), none):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
        assert docs.count() >= 0
