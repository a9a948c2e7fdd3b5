"""Near duplicates against all pairs."""

import random
import re

import numpy as np
import pytest

from ludoscope.llm import hyperminhash, near_dups


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, percent):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    return [(rows[i][0], len(sets[i]), min(groups[find(i)])) for i in range(len(rows))]


@pytest.mark.parametrize("percent", [80, 85])
def test_groups_equal_all_pairs(spark, percent):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 160))]
        for _ in range(rng.choice([1, 1, 2, 12])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7 % 1009, " ".join(text).title() if rng.random() < 0.3 else " ".join(text)))
    rows += [(5000, ""), (5001, None), (5002, " \n"), (5003, "one"), (5004, "ONE"), (5005, "one two")]
    got = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == sorted(brute(rows, percent))


def test_large_bucket_is_worked_off_in_blocks(spark, monkeypatch):
    from ludoscope.llm import frames

    monkeypatch.setattr(frames, "BLOCK_ITEMS", 16)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(w if rng.random() > 0.012 else f"x{rng.random()}" for w in base)) for i in range(90)]
    got = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == sorted(brute(rows, 85))


def test_edges(spark):
    text = " ".join(f"a{i}" for i in range(40))
    rows = [(1, text, "x"), (1, text, "x"), (1, "another text with seven words in it", "y"), (None, text, None), (None, "alone in the world with no id", None), (0, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(near_dups.near_duplicates(docs).collect(), key=str)
    assert len(got) == 6
    assert all(not r["kept"] for r in got if r["doc_id"] is None)
    assert {r["component_id"] for r in got if r["n_copies"] == 3} == {1}
    assert near_dups.near_duplicates(docs.limit(0)).count() == 0


def test_drop_keeps_one_row_of_each_group(spark):
    text = " ".join(f"a{i}" for i in range(40))
    rows = [(3, text, "c"), (2, text + " tail", "b"), (2, text + " tail", "b"), (None, text, "n"), (9, "", "e"), (8, None, "f"), (None, "alone in the world with no id", "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = near_dups.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted(r["source"] for r in got.collect()) == ["b", "e", "f", "m"]


def test_estimates_follow_similarity():
    rng = np.random.default_rng(2)
    for size in (3, 40, 1500):
        for share in (0.5, 0.8, 0.95):
            both = rng.integers(0, 2**63, int(size * share * 2 / (1 + share)) or 1, dtype=np.uint64)
            sets = [np.unique(np.concatenate((both, rng.integers(0, 2**63, size - len(both), dtype=np.uint64)))) for _ in range(2)]
            jaccard = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
            regs = hyperminhash.registers(np.concatenate(sets), np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])]))
            assert abs(hyperminhash.estimate(regs[0], regs[1]) - jaccard) < 0.17


def test_a_column_of_our_own_name_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text, "a"), (2, text, "b"), (3, "other words here for all of us", "c")], "doc_id long, text string, _row string")
    got = near_dups.drop_near_duplicates(docs)
    assert got.columns == docs.columns and sorted((r["doc_id"], r["_row"]) for r in got.collect()) == [(1, "a"), (3, "c")]
