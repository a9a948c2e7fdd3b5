"""Phrases against a plain count, with ranges, shards and hot prefixes of tiny size."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ludoscope.llm import collocations

SCHEMA = "doc_id long, lang string, text string, f long, phrase string"


def plain(rows):
    counts, sizes = Counter(), Counter()
    for _, lang, text, *_ in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, 6):
                    if i + m <= len(words):
                        counts[lang, tuple(words[i : i + m])] += 1
    return counts, sizes


def plain_best(rows, least, best, percent):
    counts, sizes = plain(rows)
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    around = Counter()
    for (lang, words), a in found.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                inner = lang, words[i : i + m]
                around[inner] = max(around[inner], a)
    out = []
    for (lang, words), a in found.items():
        if 100 * around[lang, words] >= percent * a:
            continue
        cuts = [(1000 * a * sizes[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, counts[lang, words[:k]], counts[lang, words[k:]], sizes[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:best]
        ranked += [(r[0], i, *r[1:]) for i, r in enumerate(own, 1)]
    return sorted(ranked)


def some_rows(seed, n=300):
    draw = random.Random(seed)
    vocabulary = ["a", "B", "été", "the", "x1", "中文", "Ä", "q r", "-"]
    rows = []
    for i in range(n):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(0, 60))]
        if i % 3 == 0:
            # One prefix in a third of the rows, going on in many ways.
            words += ["all", "rights", "reserved", draw.choice(["by", "to"]), f"w{draw.randrange(50)}"] * 3
        text = "".join(w + draw.choice([" ", " ", " ", " \t ", ", ", ".\n", "\r"]) for w in words)
        rows.append((i, draw.choice(["en", "en", None, "und", "de|x"]), text, 1, "p"))
    return [*rows, (None, "en", None, None, None), (7, "en", "", 0, ""), (8, "fr", " . ", 0, ""), rows[0], rows[0]]


@pytest.mark.parametrize("shard, ranges, hot", [(2_000_000, 2_000_000, 4096), (700, 300, 4096), (500, 200, 16)])
def test_counts(spark, shard, ranges, hot):
    rows = some_rows(1)
    counts, sizes = plain(rows)
    got = collocations.phrase_counts(spark.createDataFrame(rows, SCHEMA).repartition(3), 5, shard, ranges, hot).collect()
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in got if r.length} == {k: n for k, n in counts.items() if n >= 5}
    assert len([r for r in got if r.length]) == len({(r.lang, r.phrase) for r in got if r.length})
    total = Counter()
    for r in got:
        if r.length == 0:
            total[r.lang] += r.f
    assert total == +sizes


@pytest.mark.parametrize("percent", [100, 60])
def test_best_phrases(spark, percent):
    rows = some_rows(2)
    got = collocations.collocations(spark.createDataFrame(rows, SCHEMA), least=5, best=40, percent=percent)
    assert sorted(tuple(r) for r in got.collect()) == plain_best(rows, 5, 40, percent)


def test_large_numbers(spark):
    """Products beyond 64 bits, and counts beyond a byte."""
    text = "new york " * 70_000 + ". new . york " * 3
    rows = [(i, "en", text, 0, "") for i in range(3)]
    got = collocations.collocations(spark.createDataFrame(rows, SCHEMA), best=10)
    assert sorted(tuple(r) for r in got.collect()) == plain_best(rows, 100, 10, 100)


def test_a_hot_prefix_is_split(spark):
    """A third of all windows begins alike: its ranges are no larger than others."""
    rows = [(i, "en", " ".join(f"one hot pre x{i}y{j} z{j}" for j in range(200)), 0, "") for i in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = collocations.phrase_counts(docs, 100, 2_000, 500, 64).where("length = 3")
    counts, _ = plain(rows)
    assert {r.phrase: r.f for r in got.collect()} == {" ".join(k[1]): n for k, n in counts.items() if len(k[1]) == 3 and n >= 100}


def test_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(none).collect() == []
    assert collocations.collocations(none.union(spark.createDataFrame([(1, None, None, 1, "x")], SCHEMA))).collect() == []
    assert collocations.collocations(none).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert collocations.collocations(none.withColumn("x", F.lit(1))).count() == 0
