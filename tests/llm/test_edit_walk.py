"""Fingerprints against a walk of one character after the other, and the pairing with next documents."""

import hashlib
import random

import numpy as np

from ludoscope.llm import edit_walk


def slow(text):
    out, j, at = [], 0, 0
    for character in text:
        mixed = int(edit_walk.mix(np.array([ord(character)], dtype=np.uint64))[0])
        end = j + int(edit_walk._WAITS[(mixed & (edit_walk.CLASSES - 1)) * edit_walk.PERIOD + j % edit_walk.PERIOD])
        while edit_walk._AT[at] < end:
            out.append("%x" % ((mixed >> 32) % 15 + 1))
            at += 1
        j = end
    return "".join(out)


def corpus():
    rng = random.Random(8)
    letters = "etaoin shrdlu éß中😀"
    return ["".join(rng.choice(letters) for _ in range(n)) for n in [0, 1, 2, 3, 4, 7, 63, 64, 100, 500, 3000, 40, 9000] * 3]


def test_walk_is_the_plain_one(monkeypatch):
    texts = corpus()
    points = [edit_walk._characters(t) for t in texts]
    none = np.zeros(len(texts), dtype=np.int64)
    want = [slow(t) for t in texts]
    for cells in (4_000_000, 3_000):
        monkeypatch.setattr(edit_walk, "_CELLS", cells)
        assert [edit_walk.as_text(s) for s in edit_walk.walk(points, none, none)[0]] == want
    assert [edit_walk.as_text(edit_walk.samples_of(f)) for f in want] == want


def test_rows_beside_next_documents(spark):
    texts = corpus()
    rows = [(1000 - 3 * i, t) for i, t in enumerate(texts)] + [(7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ordered = sorted((i, t or "") for i, t in rows)
    for per_range in (2_000, 5, 1):
        got = {r["doc_id"]: r for r in edit_walk.compare_with_next(docs, per_range).collect()}
        assert len(got) == len(rows)
        for (doc_id, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
            k = len(text) // 4
            edited = text[: len(text) - k] + after[:k]
            r = got[doc_id]
            assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
            assert r["fingerprint"] == slow(text) and r["edited_fingerprint"] == slow(edited)
            assert 0 <= r["near_next"] <= 1 and (r["near_edited"] > 0.5 or len(text) < 70)


def test_repeated_and_null_ids(spark):
    rows = [(None, "b", 1), (None, "a", 1), (3, "same text", 1), (3, "same text", 1), (9, "z" * 100_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    got = edit_walk.compare_with_next(docs, 1).collect()
    assert len(got) == 5
    assert sorted(r["near_next"] for r in got if r["doc_id"] == 3)[-1] == 1.0
    assert edit_walk.compare_with_next(docs.limit(0)).count() == 0
    alone = edit_walk.compare_with_next(docs.where("doc_id = 9")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0


def test_likeness_falls_with_edits():
    rng = random.Random(9)
    base = "".join(rng.choice("etaoin shrdlu") for _ in range(4000))

    def prints(text):
        return edit_walk.samples_of(slow(text))

    near = []
    for edits in (0, 4, 40, 400):
        text = list(base)
        for _ in range(edits):
            at = rng.randrange(len(text))
            text[at : at + 1] = rng.choice([[], ["x"], [text[at], "y"]])
        near.append(edit_walk.likeness(prints(base), prints("".join(text))))
    other = "".join(rng.choice("etaoin shrdlu") for _ in range(4000))
    # The distance grows up to the square of the number of edits, so many small edits soon look like another text.
    assert near[0] == 1.0 and near[1] > 0.9 and max(near[2:]) < 0.5
    assert edit_walk.likeness(prints(base), prints(other)) < 0.15


def test_groups_of_like_documents(spark):
    rng = random.Random(10)
    rows = []
    for group in range(15):
        base = "".join(rng.choice("etaoin shrdlu") for _ in range(rng.randint(200, 5000)))
        for copy in range(4):
            text = base if copy < 2 else base[: len(base) // 2] + "xy" + base[len(base) // 2 + 1 :]
            rows.append((group * 10 + copy, text))
    rows += [(900, ""), (901, None)]
    prints = edit_walk.fingerprint_texts(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r["group_id"] for r in edit_walk.like_groups(prints, 0.8).collect()}
    assert got == {i: i if i >= 900 else i // 10 * 10 for i, _ in rows}
