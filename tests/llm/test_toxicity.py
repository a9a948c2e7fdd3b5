"""Segments against all of them, learning on planted words, and held-out accuracy on the given labels."""

import random
import time

import pyarrow as pa
import pytest

from ludoscope.llm import catalog, toxicity


def brute(scores):
    """Maximal segments by their definition: take the best one, shortest on a tie, and go on left and right of it."""
    if not scores or max(scores) <= 0:
        return []
    best = max(((sum(scores[i:j]), -(j - i), -i), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1))
    (total, _, _), i, j = best
    return [*brute(scores[:i]), (total, i, j), *[(s, a + j, b + j) for s, a, b in brute(scores[j:])]]


def test_segments_are_the_maximal_ones():
    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.choice([-3, -2, -1, 1, 2, 5, -4, 3]) + rng.random() / 100 for _ in range(rng.randint(0, 14))]
        got = toxicity.maximal_segments([(s, i, i + 1) for i, s in enumerate(scores)])
        want = brute(scores)
        assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
        assert all(abs(x[0] - y[0]) < 1e-9 for x, y in zip(got, want))


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(2)
    words = [f"{a}{b}" for a in "bcdfghjk" for b in ("an", "ert", "isol", "ump")]
    rows = []
    for i in range(900):
        own = [rng.choice(words) for _ in range(rng.randint(5, 200))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                own.insert(rng.randrange(len(own) + 1), rng.choice(["GRUBLO,", "vexnard", f"schlimm{rng.choice(words)}"]))
        rows.append((i, " ".join(own), int(toxic)))
    return rows


def test_planted_words_are_found(spark, planted):
    docs = spark.createDataFrame([(i, t, "x", None) for i, t, _ in planted], "doc_id long, text string, source string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in planted if i % 5], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model, passages=True).collect()
    truth = {i: y for i, _, y in planted}
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in got if r["doc_id"] % 5 == 0) >= 178
    for r in got:
        assert 0 <= r["score"] <= 1 and r["source"] == "x"
        for p in r["passages"]:
            assert any(w in r["text"].encode()[p["begin"] : p["end"]].decode().lower() for w in ("grublo", "vexnard", "schlimm"))
    assert sum(bool(r["passages"]) for r in got if truth[r["doc_id"]]) >= 0.9 * sum(truth.values())


def test_every_copy_of_a_passage_is_found(spark, planted):
    docs = spark.createDataFrame([(i, t) for i, t, _ in planted], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, y) for i, _, y in planted], "doc_id long, toxic int"))
    passage, clean = "vexnard grublo vexnard grublo", "ban cert disol gump " * 1500
    texts = [f"{clean}{passage} {clean}{passage} {clean}", f"vexnard {clean}grublo {clean}{passage} {clean}"]
    got = toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, passages=True).collect()
    for r in got:
        spans = [(p["begin"], p["end"]) for p in r["passages"]]
        begin = r["text"].find(passage)
        while begin >= 0:
            assert any(a <= begin and begin + len(passage) <= b < begin + 2 * len(passage) for a, b in spans), (begin, spans)
            begin = r["text"].find(passage, begin + 1)


def test_segments_of_many_falling_sums_are_linear():
    began = time.process_time()
    assert len(toxicity.maximal_segments([(1.0 if i % 2 else -2.0, i, i + 1) for i in range(100_000)])) == 50_000
    assert time.process_time() - began < 5


def test_edges(spark, planted):
    docs = spark.createDataFrame([(i, t) for i, t, _ in planted], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in planted] + [(None, 1), (3, None), (10**9, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "123 !!"), (3, "vexnard " * 100_000)], "doc_id long, text string")
    got = toxicity.score(odd, model).collect()
    assert len(got) == 5 and all(r["predicted"] == 0 for r in got if r["doc_id"] != 3)
    assert toxicity.score(odd.limit(0), model).count() == 0
    for none in (labels.limit(0), labels.where("toxic = 0")):
        assert {r["predicted"] for r in toxicity.score(odd, toxicity.fit(docs, none)).collect()} == {0}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = catalog.op7_toxicity(spark, sf).where("held_out")
    both = got.join(catalog.table(spark, sf, "labels"), "doc_id").groupBy("quality", "toxic", "predicted").count().collect()
    for least, quality in ((0.98, (0, 1)), (0.99, (1,))):
        rows = [r for r in both if r["quality"] in quality]
        assert sum(r["count"] for r in rows if r["toxic"] == r["predicted"]) >= least * sum(r["count"] for r in rows)


def test_letters_fold_case():
    (_, words), = toxicity.letters(pa.array(["RÉEUX réeux x1Y", None], pa.string()))
    assert words.count.tolist() == [4, 0] and words.hash[0] == words.hash[1]
