"""Stages of the pipeline, held against brute force on what the stage before kept."""

import hashlib

import pytest

import corpus_pipeline
from ludoscope.llm import catalog

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage was given and what it kept."""
    out, docs = {}, catalog.table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF).persist()
        out[name] = (docs, kept)
        docs = kept
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "near duplicates", "repeated passages", "packing"]
    for name, (docs, kept) in stages.items():
        if name != "packing":
            assert tuple(kept.columns) == corpus_pipeline.COLUMNS and dict(kept.dtypes) == dict(docs.dtypes)


def test_toxic_documents_go(spark, stages):
    docs, kept = stages["toxicity"]
    verdict = {r["doc_id"]: r["predicted"] for r in catalog.op7_toxicity(spark, SF).collect()}
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect() if not verdict[r["doc_id"]]}


def test_poor_documents_go(stages):
    from test_words_and_counts import brute

    docs, kept = stages["quality rules"]

    def good(text):
        c = brute(text)
        n, chars = c["n_words"], c["word_chars"]
        return (
            n >= 20 and 100 * c["n_repeat_words"] <= 30 * n and 10 * c["n_symbols"] <= n and 2 * c["n_dup_lines"] <= c["n_lines"]
            and 100 * c["n_stutter"] <= 30 * n and 3 * n <= chars <= 10 * n and 2 * c["n_letters"] >= chars
        )

    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect() if good(r["text"])}


def test_one_of_each_group_stays(stages):
    from test_near_dups import brute

    docs, kept = stages["near duplicates"]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert {r["doc_id"] for r in kept.collect()} == {doc_id for doc_id, _, component in brute(rows, 80) if doc_id == component}


def test_passages_go_once(stages):
    from test_repeats import brute

    docs, kept = stages["repeated passages"]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r for r in kept.collect()}
    assert len(got) == len(rows)
    for doc_id, _, removed, digest in brute(list(rows.items()), 50):
        text = got[doc_id]["text"]
        assert got[doc_id]["n_chars"] == len(text)
        assert hashlib.sha256(" ".join(text.split()).encode()).hexdigest() == digest
        assert removed or text == rows[doc_id]


def test_all_is_packed(stages):
    docs, kept = stages["packing"]
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {r["doc_id"] for r in docs.collect()}
    assert max(r["sum(length)"] for r in kept.groupBy("sequence_id").sum("length").collect()) <= 1024


def test_whole_run(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == stages["packing"][1].columns and got.count() == stages["packing"][1].count()
