"""The title index against a full scan; rules of lemmas on held-out pairs; the map of topics."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludoscope.operators import lemmas, similar, titles, topics


def some_titles(seed, n=120):
    draw = random.Random(seed)
    words = ["castle", "castles", "of", "the", "mad", "king", "a", "go", "x", "été", "war", "wars", "ii", "2"]
    return [(i, " ".join(draw.choices(words, k=draw.randint(0, 4)))) for i in range(n)] + [(500, None), (501, "Go"), (502, "go!"), (503, "")]


@pytest.mark.parametrize("least", [0.6, 0.7, 0.85, 1.0])
def test_names_find_what_a_full_scan_finds(spark, least):
    draw = random.Random(7)
    rows = some_titles(1)
    games = spark.createDataFrame(rows, "game_id int, game string")
    names = set()
    for _, t in rows:
        t = list(t or "zz")
        for _ in range(draw.randint(0, 3)):
            if t:
                t[draw.randrange(len(t))] = draw.choice(["", "a", "bc", " "])
        names.add("".join(t))
    asked = spark.createDataFrame([(n,) for n in names] + [(None,), ("",), ("zzzzzzzzzz",)], "name string")
    got = {r["name"]: (r["game_id"], round(r["score"], 9)) for r in titles.match_names(titles.build_title_index(games, least), asked).collect()}
    every = asked.where("name is not null").distinct().join(games.where("game is not null"), F.lit(True))
    scored = every.withColumn("score", similar.title_score(F.col("game"), F.col("name"))).where(F.col("score") >= least - 1e-9)
    best = scored.groupBy("name").agg(F.min(F.struct((-F.col("score")).alias("s"), "game", "game_id")).alias("t")).collect()
    assert got == {r["name"]: (r["t"]["game_id"], round(-r["t"]["s"], 9)) for r in best}
    assert "zzzzzzzzzz" not in got


def test_names_met_edit_by_edit_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(titles, "MEETINGS", -1)
    test_names_find_what_a_full_scan_finds(spark, 0.85)


def test_numbered_titles_do_not_all_meet(spark, monkeypatch):
    """Titles of few words and a number share all but the number's grams, so their pairs by grams are a square."""
    monkeypatch.setattr(titles, "MEETINGS", 40)
    games = spark.createDataFrame([(i, f"{a} {b} {i}") for i, (a, b) in enumerate([(a, b) for a in ("red", "large", "old") for b in ("bolt", "gear")] * 60)], "game_id int, game string")
    names = games.select(F.replace(F.substr("game", F.lit(2)), F.lit("g"), F.lit("gg")).alias("name"))
    stats = {}
    got = {r["name"]: (r["game"], round(r["score"], 9)) for r in titles.match_names(titles.build_title_index(games), names, stats).collect()}
    every = names.join(games, F.lit(True)).withColumn("score", similar.title_score(F.col("game"), F.col("name"))).where("score >= 0.7 - 1e-9")
    best = every.groupBy("name").agg(F.min(F.struct((-F.col("score")).alias("s"), "game")).alias("t")).collect()
    assert got == {r["name"]: (r["t"]["game"], round(-r["t"]["s"], 9)) for r in best}
    assert stats["crowded"] > 300 and stats["met"] <= 40 * 360


def test_bound_has_to_say_something(spark):
    with pytest.raises(ValueError):
        titles.build_title_index(spark.createDataFrame([(1, "x")], "game_id int, game string"), 0.5)


def test_one_name_as_fuzzy_match_has_it(spark):
    games = spark.createDataFrame(some_titles(3), "game_id int, game string")
    asked = spark.createDataFrame([("castl of mad king",)], "name string")
    one = similar.fuzzy_match(games.where("game is not null"), "castl of mad king").first()
    got = titles.match_names(titles.build_title_index(games, 0.6), asked).first()
    assert (got["game_id"], round(got["score"], 9)) == (one["game_id"], round(one["score"], 9))


def english(word):
    for a, b in (("ies", "y"), ("sses", "ss"), ("xes", "x"), ("ing", ""), ("ed", ""), ("ss", "ss"), ("s", "")):
        if word.endswith(a):
            return word[: len(word) - len(a)] + b
    return word


def some_pairs():
    draw = random.Random(2)
    stems = ["".join(draw.choices("bcdfglmnprt", k=1) + draw.choices("aeiou", k=1) + draw.choices("bcdfglmnprtx", k=1) + draw.choices("ktln", k=1)) for _ in range(400)]
    words = {s + e for s in stems for e in draw.sample(["ies", "sses", "xes", "ing", "ed", "s", "ss", ""], 3)}
    return [(w, english(w)) for w in sorted(words)]


def test_rules_carry_over_to_words_held_out(spark):
    pairs = [*some_pairs(), ("went", "go"), ("was", "be"), ("was", "bee"), ("", ""), ("a", "a"), (None, "x"), ("x", None)]
    kept = [p for i, p in enumerate(pairs) if i % 5]
    held = [p for i, p in enumerate(pairs) if not i % 5 and p[0] and p[1]]
    rules, exceptions = lemmas.learn_rules(spark.createDataFrame(kept, "token string, lemma string"))
    found = {r["token"]: r["lemma"] for r in lemmas.lemmas_of(spark.createDataFrame(pairs, "token string, lemma string"), rules, exceptions).collect()}
    known = {t: m for t, m in reversed(kept) if t is not None and m is not None}
    assert all(found[t] == m for t, m in known.items())
    right = sum(found[t] == m for t, m in held) / len(held)
    assert right > 0.95 and len(rules) < 60 and exceptions.count() < 0.05 * len(kept)
    assert known.get("was", "be") == "be" and lemmas.learn_rules(spark.createDataFrame([], "token string, lemma string"))[0] == {}


def test_the_longest_suffix_counts_and_a_whole_word_is_no_suffix(spark):
    rules = {"s": "1:", "ies": "3:y", "ss": "0:"}
    words = spark.createDataFrame([("cats",), ("ponies",), ("ies",), ("glass",), ("s",), ("",), ("cat",)], "token string")
    got = {r["token"]: r["lemma"] for r in lemmas.lemmas_of(words, rules, spark.createDataFrame([("glass", "glas")], "token string, lemma string")).collect()}
    assert got == {"cats": "cat", "ponies": "pony", "ies": "ie", "glass": "glas", "s": "s", "": "", "cat": "cat"}


@pytest.mark.parametrize("k", [1, 2, 3, 7])
def test_plane_is_the_best_fit(k):
    points = np.random.default_rng(k).normal(size=(k, 2)) * [3, 1]
    apart = np.linalg.norm(points[:, None] - points[None], axis=2)
    placed = topics.plane(apart)
    assert np.allclose(np.linalg.norm(placed[:, None] - placed[None], axis=2), apart)
    for axis in placed.T:
        assert axis[np.argmax(np.abs(axis).round(9))] >= 0
    deep = np.random.default_rng(k).normal(size=(k, 5))
    gram = np.linalg.svd(deep - deep.mean(axis=0), compute_uv=False)[:2]
    flat = topics.plane(np.linalg.norm(deep[:, None] - deep[None], axis=2))
    assert np.allclose(np.linalg.norm(flat, axis=0)[: len(gram)], np.sort(gram)[::-1][: flat.shape[1]])


def test_divergences_and_saliency(spark):
    rng = np.random.default_rng(1)
    p = rng.random((3, 6)) * (rng.random((3, 6)) < 0.7) + 1e-3 * np.eye(3, 6)
    p[2] = [0, 0, 0, 0, 0, 1]
    p[1, 5] = 0
    p /= p.sum(axis=1, keepdims=True)
    share = np.array([0.5, 0.3, 0.2])
    table = spark.createDataFrame([(t, f"w{w}", float(p[t, w])) for t in range(3) for w in range(6) if p[t, w] > 0], "topic int, term string, p double")
    shares = spark.createDataFrame([(t, float(s)) for t, s in enumerate(share)], "topic int, share double")

    def kl(a, b):
        return sum(x * np.log(x / y) for x, y in zip(a, b) if x > 0)

    got = {(r["topic_a"], r["topic_b"]): r["divergence"] for r in topics.divergences(table).collect()}
    for a in range(3):
        for b in range(a + 1, 3):
            m = (p[a] + p[b]) / 2
            assert got[a, b] == pytest.approx((kl(p[a], m) + kl(p[b], m)) / 2)
    joint = p * share[:, None]
    for r in topics.term_saliency(table, shares, 100).collect():
        w = int(r["term"][1:])
        total = joint[:, w].sum()
        assert r["p"] == pytest.approx(total) and r["saliency"] == pytest.approx(total * kl(joint[:, w] / total, share))
