"""The mix against plain arithmetic, its draws and its edge cases."""

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ludoscope.llm import mixing

SCHEMA = "doc_id long, source string, text string, size string, copy int, _key string"


def plain_targets(sizes, percent=150, limit=2):
    """By passes: whoever is above the limit stops there, the rest is shared anew."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, stopped = Fraction(percent * sum(sizes.values()), 100), set()
    while True:
        free = [s for s in order if s not in stopped]
        left = total - sum(limit * sizes[s] for s in stopped)
        share = {s: weight[s] * left / sum(weight[o] for o in free) for s in free}
        more = {s for s in free if share[s] > limit * sizes[s]}
        if not more:
            return {s: float(share.get(s, limit * sizes[s])) for s in order}
        stopped |= more


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100, "d": 100}, {"a": 1, "b": 1000, "c": 5, None: 7}, {"a": 10_000, "b": 1, "B": 2, "é": 3, "z": 0, None: 50},
    {None: 4}, {"a": 0, "b": 9}, {f"s{i:03}": 1 + i * i % 97 for i in range(60)},
])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    want = plain_targets(sizes)
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_words(spark):
    texts = [None, "", "  ", "a", " a\tb\nc\x0bd\x0ce\rf ", "a b c d", "x " * 100_000]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    assert [r.n for r in rows.orderBy("i").select(mixing.word_count("text").alias("n")).collect()] == [0, 0, 0, 1, 6, 2, 100_000]


def some_docs(spark, n=3000):
    rows = [(i, ["hot", "hot", "b", None, "c"][i % 5], "w " * (1 + i % 50), "s", 0, "k") for i in range(n)]
    rows += [(None, "b", "no id here", "s", 0, "k"), (5, "hot", None, "s", 0, "k"), (6, "b", "", "s", 0, "k"), rows[0], rows[0]]
    return spark.createDataFrame(rows, SCHEMA)


def test_mix(spark):
    docs = some_docs(spark)
    plan = mixing.plan_mix(docs)
    per = plan.groupBy("source").agg(
        F.first("target").alias("target"), F.first("source_size").alias("source_size"), F.sum("size").alias("size"),
        F.sum(F.col("copies") * F.col("size")).alias("taken"), F.max("copies").alias("most"), F.min("copies").alias("least")).collect()
    for r in per:
        assert r.source_size == r.size and r.most <= 2 and r.least == int(r.target / r.size)
        assert r.taken == pytest.approx(r.target, rel=0.1)
    assert sorted(map(str, plan.collect())) == sorted(map(str, mixing.plan_mix(docs.repartition(7)).collect()))
    assert plan.count() == docs.count()


def test_copies_are_rows(spark):
    docs = some_docs(spark, 200)
    plan = {(r.doc_id, r.text, r.source): r.copies for r in mixing.plan_mix(docs).collect()}
    mixed = mixing.mix(docs).groupBy("doc_id", "text", "source").agg(F.count(F.lit(1)).alias("n"), F.max("copy").alias("last")).collect()
    repeats = {(0, "w ", "hot"): 3}
    assert {(r.doc_id, r.text, r.source): r.n for r in mixed} == {k: n * repeats.get(k, 1) for k, n in plan.items() if n}
    assert all(r["last"] < 2 for r in mixed)


def test_looked_up_without_a_broadcast(spark, monkeypatch):
    docs = some_docs(spark)
    want = sorted(map(str, mixing.plan_mix(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mixing.plan_mix(docs).collect())) == want


def test_columns_that_clash_and_no_rows(spark):
    docs = some_docs(spark, 10).withColumn("target", F.lit("t")).withColumn("copies", F.lit("c"))
    plan = mixing.plan_mix(docs)
    assert plan.columns == ["doc_id", "source", "text", "copy", "_key", "size", "source_size", "target", "copies"]
    assert {r._key for r in plan.collect()} == {"k"} and plan.schema["target"].dataType.simpleString() == "double"
    assert mixing.plan_mix(docs.limit(0)).collect() == []
    empty = spark.createDataFrame([(1, "a", None), (2, None, "")], "doc_id long, source string, text string")
    assert [(r.target, r.copies) for r in mixing.plan_mix(empty).collect()] == [(0.0, 0), (0.0, 0)]


def test_native(spark):
    plan = mixing.plan_mix(some_docs(spark, 10))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
