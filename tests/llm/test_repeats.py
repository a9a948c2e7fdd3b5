"""Repeated passages against plain Python, automata against all substrings."""

import hashlib
import random
import re

import pytest

from ludoscope.llm import repeats


def brute(rows, size):
    owner = {}
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    for (doc_id, _), own in zip(rows, words):
        for i in range(len(own) - size + 1):
            key = tuple(own[i : i + size])
            owner[key] = min(owner.get(key, doc_id), doc_id)
    out = []
    for (doc_id, _), own in zip(rows, words):
        gone = {i + k for i in range(len(own) - size + 1) if owner[tuple(own[i : i + size])] < doc_id for k in range(size)}
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        out.append((doc_id, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    passages = [[f"p{rng.randint(0, 9)}" for _ in range(rng.randint(5, 40))] for _ in range(12)]
    rows = []
    for i in range(120):
        own = []
        for _ in range(rng.randint(0, 5)):
            own += rng.choice(passages) if rng.random() < 0.6 else [f"u{rng.randint(0, 3)}" for _ in range(rng.randint(1, 15))]
        rows.append((i * 13 % 131, " ".join(own)))
    return rows + [(500, rows[3][1]), (501, rows[3][1]), (502, None), (503, ""), (504, "\n".join(rows[4][1].split()))]


@pytest.mark.parametrize("size", [10, 20])
def test_removal_equals_brute_force(spark, size, monkeypatch):
    monkeypatch.setattr(repeats, "TEXTS", 3)
    rows = corpus(size)
    got = repeats.count_repeats(spark.createDataFrame(rows, "doc_id long, text string"), size)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, size))


def test_windows_with_an_owner_in_between(spark):
    """The anchor's first document has it in other surroundings, so a later one owns the window."""
    middle = [f"m{i}" for i in range(8)]
    rows = [(1, " ".join([*(f"a{i}" for i in range(30)), *middle, *(f"b{i}" for i in range(30))]))]
    rows += [(k, " ".join([*(f"c{i}" for i in range(30)), *middle, *(f"d{i}" for i in range(30))]) + f" tail{k}") for k in (2, 3)]
    got = repeats.count_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 12)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, 12))
    assert dict((r["doc_id"], r["n_removed"]) for r in got.collect()) == {1: 0, 2: 0, 3: 68}


def test_strip_keeps_columns_and_untouched_texts(spark):
    long = " ".join(f"a{i}" for i in range(60))
    rows = [(1, "x", long, 9), (2, "y", "keep  this\tspacing", 18), (3, "z", f"own {long} end", 0), (4, None, long, 0), (4, None, long, 0), (None, "n", long, 7), (5, "e", None, None), (1, "dup", "another text", 12)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, n_chars long")
    got = repeats.strip_repeats(docs)
    assert got.columns == docs.columns
    texts = sorted((str(r["doc_id"]), r["source"], r["text"], r["n_chars"]) for r in got.collect() if r["source"])
    assert texts == sorted([
        ("1", "x", long, len(long)), ("2", "y", "keep  this\tspacing", 18), ("3", "z", "own end", 7), ("None", "n", long, len(long)), ("5", "e", None, None), ("1", "dup", "another text", 12),
    ], key=str)
    assert [r["text"] for r in got.collect() if r["doc_id"] == 4] == ["", ""]
    assert repeats.strip_repeats(docs.limit(0)).count() == 0


def test_automaton_matches_all_substrings():
    rng = random.Random(3)
    for _ in range(200):
        refs = [[rng.randint(0, 3) for _ in range(rng.randint(0, 25))] for _ in range(rng.randint(1, 4))]
        automaton = repeats.SuffixAutomaton()
        for ref in refs:
            automaton.add(ref)
        inside = {tuple(r[i:j]) for r in refs for i in range(len(r)) for j in range(i + 1, len(r) + 1)}
        query = [rng.randint(0, 3) for _ in range(30)]
        for end, length in enumerate(automaton.matches(query), 1):
            assert length == max(k for k in range(end + 1) if k == 0 or tuple(query[end - k : end]) in inside)


def test_given_references(spark):
    passage = " ".join(f"q{i}" for i in range(70))
    docs = spark.createDataFrame([(1, f"before {passage} after", 1), (2, "q1 q2 q3", 2), (3, None, 3)], "doc_id long, text string, extra int")
    refs = spark.createDataFrame([(f"x {passage} y",), (None,)], "text string")
    got = {r["doc_id"]: r["text"] for r in repeats.strip_references(docs, refs).collect()}
    assert got == {1: "before after", 2: "q1 q2 q3", 3: None}


@pytest.mark.parametrize("bound", ["REFERENCE_WORDS", "REFERENCE_BYTES"])
def test_references_beyond_the_bound_give_the_same(spark, monkeypatch, bound):
    rows = [(i, t, "r", "k") for i, t in corpus(7)]
    docs = spark.createDataFrame([*rows[:80], (900, None, "r", "k"), rows[0]], "doc_id long, text string, _row string, _kept string")
    refs = spark.createDataFrame([(t,) for _, t, *_ in rows[80:]] + [(None,), ("",)], "text string")
    want = sorted(map(str, repeats.strip_references(docs, refs, 10).collect()))
    monkeypatch.setattr(repeats, bound, 5)
    got = repeats.strip_references(docs, refs, 10)
    assert got.columns == docs.columns and sorted(map(str, got.collect())) == want
    assert want != sorted(map(str, docs.collect()))
    assert repeats.strip_references(docs, refs.limit(0), 10).count() == docs.count()


def test_columns_with_names_of_our_own(spark):
    long = " ".join(f"a{i}" for i in range(60))
    docs = spark.createDataFrame([(1, long, "c", 1), (2, long + " end", "d", 2)], "doc_id long, text string, _changes string, __changes int")
    got = repeats.strip_repeats(docs)
    assert got.columns == docs.columns and sorted((r["doc_id"], r["text"], r["_changes"]) for r in got.collect()) == [(1, long, "c"), (2, "end", "d")]
