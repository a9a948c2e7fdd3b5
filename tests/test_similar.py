"""Block-wise neighbours against brute force, with blocks small enough to matter."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludoscope.functions import blocks
from ludoscope.operators import bounded, similar
from ludoscope.operators.text import tfidf


def catalogue():
    """A third of the games share one set, some hold nothing, two small sets are disjoint."""
    rnd = random.Random(7)
    names = [f"a{i}" for i in range(90)]
    sets = {g: frozenset(["a0", "a1"]) for g in range(30)}
    sets |= {g: frozenset() for g in range(30, 35)}
    sets |= {35: frozenset(["a80"]), 36: frozenset(["a81"]), 37: frozenset(names)}
    sets |= {g: frozenset(rnd.sample(names, rnd.randint(1, 12))) for g in range(38, 90)}
    return sets, len(set().union(*sets.values()))


def hamming(a, b, size):
    return 1 - len(a ^ b) / size


def jaccard(a, b, _):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("block, few", [(7, 1), (20, 8), (4096, 8)])
@pytest.mark.parametrize("name, measure", [("hamming_topk", hamming), ("jaccard_topk", jaccard)])
def test_topk_is_exact(spark, monkeypatch, name, measure, block, few):
    monkeypatch.setattr(similar, "ATTR_BLOCK", block)
    monkeypatch.setattr(bounded, "FEW_BLOCKS", few)
    sets, size = catalogue()
    games = spark.createDataFrame([(g,) for g in sets], "game_id int")
    attrs = spark.createDataFrame([(g, "m", n) for g, s in sets.items() for n in s], "game_id int, kind string, name string")
    got = {}
    for r in getattr(similar, name)(games, attrs, 5).orderBy("game_id", "rank").collect():
        got.setdefault(r["game_id"], []).append((r["other_id"], round(r["similarity"], 9)))
    for g, s in sets.items():
        scored = sorted(((-measure(s, t, size), o) for o, t in sets.items() if o != g))
        assert got[g] == [(o, round(-v, 9)) for v, o in scored[:5]]
    one = getattr(similar, name.replace("topk", "similarity"))(games, attrs, 40).collect()
    assert {r["game_id"]: round(r["similarity"], 9) for r in one} == {
        g: round(measure(sets[40], s, size), 9) for g, s in sets.items()}


@pytest.mark.parametrize("share", [1, 8, 10**9])
@pytest.mark.parametrize("chunk", [1, 7, 10**6])
def test_inner_products(monkeypatch, share, chunk):
    monkeypatch.setattr(blocks, "SPARSE_SHARE", share)
    monkeypatch.setattr(blocks, "PAIR_CHUNK", chunk)
    monkeypatch.setattr(blocks, "TERM_TILE", 2)
    rng = np.random.default_rng(1)
    sides, dense = [], []
    for n in (9, 6):
        m = rng.random((n, 15)) * (rng.random((n, 15)) < 0.4)
        m[:, 0] = 1.0
        rows, terms = m.nonzero()
        sides.append((np.arange(n), rows, terms * 10, m[rows, terms]))
        dense.append(m)
    assert np.allclose(blocks.inner_products(*sides), dense[0] @ dense[1].T)
    empty = (np.arange(3), np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0))
    assert not blocks.inner_products(empty, sides[1]).any()


def test_best_columns_breaks_ties_by_column():
    table = np.array([[1.0, 3.0, 3.0, 3.0], [0.0, 0.0, 0.0, 0.0], [4.0, 1.0, 2.0, 3.0]])
    rows, cols = blocks.best_columns(table, 2)
    assert cols.tolist() == [1, 2, 0, 1, 0, 3] and rows.tolist() == [0, 0, 1, 1, 2, 2]


@pytest.mark.parametrize("block, tile", [(5, 3), (512, 4096)])
def test_cosine_topk_is_exact(spark, monkeypatch, block, tile):
    monkeypatch.setattr(similar, "TEXT_BLOCK", block)
    monkeypatch.setattr(bounded, "FEW_BLOCKS", 2)
    monkeypatch.setattr(blocks, "TERM_TILE", tile)
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    docs = {d: "same text here" if d < 8 else " ".join(rnd.choices(words, k=rnd.randint(2, 30))) for d in range(24)}
    df = {w: sum(w in t.split() for t in docs.values()) for t in docs.values() for w in t.split()}
    vectors = {}
    for d, t in docs.items():
        raw = {w: n * (math.log((1 + len(docs)) / (1 + df[w])) + 1) for w, n in Counter(t.split()).items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        vectors[d] = {w: v / norm for w, v in raw.items()}
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    weights = tfidf(table, numbered=True)
    got = {}
    for r in similar.cosine_topk(weights, 4).orderBy("doc_id", "rank").collect():
        got.setdefault(r["doc_id"], []).append((r["other_id"], round(r["similarity"], 6)))
    for d, v in vectors.items():
        scored = sorted(
            (-round(sum(x * vectors[o].get(w, 0.0) for w, x in v.items()), 9), o) for o in vectors if o != d)
        assert got[d] == [(o, round(-s, 6)) for s, o in scored[:4]]


def test_blocks_that_cannot_matter_never_meet(spark, monkeypatch):
    """Games of some families that share nothing, of different sizes: blocks of different families are ruled out."""
    monkeypatch.setattr(similar, "ATTR_BLOCK", 20)
    monkeypatch.setattr(bounded, "FIRST_ROUND", 2)
    monkeypatch.setattr(bounded, "FEW_BLOCKS", 1)
    rnd = random.Random(5)
    sets = {}
    for family in range(8):
        names = [f"f{family}n{i}" for i in range(14)]
        for g in range(60):
            sets[100 * family + g] = frozenset(rnd.sample(names, 2 + family))
    games = spark.createDataFrame([(g,) for g in sets], "game_id int")
    attrs = spark.createDataFrame([(g, "m", n) for g, s in sets.items() for n in s], "game_id int, kind string, name string")
    size = len(set().union(*sets.values()))
    for name, measure in (("jaccard_topk", jaccard), ("hamming_topk", hamming)):
        stats, got = {}, {}
        for r in getattr(similar, name)(games, attrs, 3, stats=stats).orderBy("game_id", "rank").collect():
            got.setdefault(r["game_id"], []).append(r["other_id"])
        for g, s in sets.items():
            assert got[g] == [o for _, o in sorted((-measure(s, t, size), o) for o, t in sets.items() if o != g)[:3]]
        assert stats["met"] < stats["pairs"] / 2


def test_texts_of_different_words_never_meet(spark, monkeypatch):
    monkeypatch.setattr(similar, "TEXT_BLOCK", 16)
    monkeypatch.setattr(bounded, "FEW_BLOCKS", 1)
    rnd = random.Random(4)
    rows = [(100 * t + d, " ".join(rnd.choices([f"t{t}w{i}" for i in range(30)], k=12))) for t in range(6) for d in range(32)]
    weights = tfidf(spark.createDataFrame(rows, "doc_id long, text string"), numbered=True)
    stats, whole = {}, {}
    got = sorted(map(tuple, similar.cosine_topk(weights, 3, stats=stats).collect()))
    monkeypatch.setattr(similar, "TEXT_BLOCK", 10_000)
    assert got == sorted(map(tuple, similar.cosine_topk(weights, 3, stats=whole).collect()))
    assert whole == {"pairs": 1, "met": 1} and stats["met"] < 0.8 * stats["pairs"]


@pytest.mark.parametrize("seed", range(20))
def test_bounds_hold(seed):
    """No pair of rows of two blocks scores above the bound of their summaries."""
    rng = np.random.default_rng(seed)
    n_terms = 12
    sides = [(rng.random((5, n_terms)) < rng.uniform(0.05, 0.9)).astype(float) for _ in range(2)]
    limits = [(m.sum(axis=1).min(), m.sum(axis=1).max()) for m in sides]
    shared = sides[0] @ sides[1].T
    a, b = sides[0].sum(axis=1)[:, None], sides[1].sum(axis=1)[None, :]
    top = np.array([[sides[0].max(axis=0) @ sides[1].max(axis=0)]])
    ends = [(np.array([[low]]), np.array([[high]])) for low, high in limits]
    for measure, bound in (similar.jaccard_measures(), similar.hamming_measures(n_terms)):
        assert measure(shared, a, b).max() <= bound(top, *ends)[0, 0] + 1e-12


def test_blocks_are_shipped_by_groups_and_in_steps(spark, monkeypatch):
    """40 blocks meet in pairs: a block goes out once per group of blocks, not once per block."""
    monkeypatch.setattr(bounded, "SHIPMENTS", 3)
    monkeypatch.setattr(bounded, "FEW_BLOCKS", 50)
    rng = np.random.default_rng(8)
    m = rng.integers(0, 4, (200, 12)).astype(float)
    rows = spark.createDataFrame([(i, np.flatnonzero(v).tolist(), v[v > 0].tolist()) for i, v in enumerate(m)], "key long, terms array<long>, weights array<double>")
    found = bounded.best_partners(rows, 4, lambda dot, a, b: dot, lambda dot, a, b: dot, 5, ["key"])
    dots, got = m @ m.T, {}
    for r in found.best.orderBy("key", F.col("score").desc(), "partner").collect():
        got.setdefault(r["key"], []).append((r["partner"], r["score"]))
    for i in range(200):
        assert got[i] == [(int(j), dots[i, j]) for j in np.lexsort((np.arange(200), -dots[i]))[:4]]
    # One block at a time, each of the 820 pairs would send two blocks, or one if it is a block's own.
    assert found.met == found.pairs == 820 and found.shipped < 820
