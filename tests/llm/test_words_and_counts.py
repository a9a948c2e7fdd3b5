"""Words, windows and counts against plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from ludoscope.llm import quality
from ludoscope.llm.text_stats import counted
from ludoscope.llm.words import word_chunks

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aA b\n\t é#$1\x1c", max_size=60)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_and_windows(texts):
    for row, words in word_chunks(pa.array(texts, pa.string()), lower=True):
        seen: dict = {}
        for i in range(len(words.count)):
            own = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), texts[row + i] or ""))
            hashes = words.hash[words.first[i] : words.first[i + 1]].tolist()
            assert len(hashes) == len(own)
            for h, w in zip(hashes, own):
                assert seen.setdefault(h, w) == w
            starts, window = words.windows(3)
            mine = [k for k in range(len(starts)) if words.doc[starts[k]] == i]
            assert len(mine) == max(0, len(own) - 2)
            for k in mine:
                at = int(starts[k] - words.first[i])
                assert seen.setdefault((3, int(window[k])), tuple(own[at : at + 3])) == tuple(own[at : at + 3])


def brute(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(8)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_stutter": sum(a == b for a, b in zip(words, words[1:])), "n_letters": len(re.findall("[A-Za-zÀ-￿]", text or "")),
    }


def test_counts():
    rng = random.Random(1)
    texts = ["", None, " \n ", "\n\n", "a", "a\na\n a\na", "x " * 40] + [
        "".join(rng.choice(["a", "b", "é", " ", " ", " ", "\n", "#", "中", " ", "1"]) for _ in range(rng.randint(0, 300))) for _ in range(200)
    ]
    for row, words in word_chunks(pa.array(texts, pa.string())):
        for i in range(len(words.count)):
            for name, value in brute(texts[row + i]).items():
                assert counted(words, name)[i] == value, (name, texts[row + i])


def test_cascade_is_the_conjunction_of_its_rules_in_any_order():
    texts = ["w" * 5 + " x" * 30, "a b", None, "one two three four five six seven eight nine ten " * 3, "%%% $$$ " * 20 + "a b c " * 10,
             " ".join(f"word{i}" for i in range(50)), "\n".join(["same line here"] * 3 + [f"other line {i}" for i in range(2)] + [f"q{i}" for i in range(30)])]
    for row, words in word_chunks(pa.array(texts, pa.string())):
        want = ~np.any([r.rejects(words) for r in quality.RULES], axis=0)
        for rules in (quality.RULES, quality.RULES[::-1]):
            assert quality.run_cascade(words, rules)[0].tolist() == want.tolist()
    assert want.tolist()[5]


def test_rules_are_ordered_by_rejection_per_cost():
    a, b, c = quality.RULES[:3]
    assert quality.order_rules({a.name: (1.0, 0.5), b.name: (0.1, 0.2), c.name: (1.0, 0.0)}, (a, b, c)) == [b, a, c]


def test_grade_edges(spark):
    rows = [(1, None, "x", True), (1, None, "x", True), (None, "", "y", None), (2, " ".join(f"word{i}" for i in range(40)), None, False), (3, "long word " * 200_000, "z", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra string, kept boolean")
    got = {(r["doc_id"], r["extra"]): (r["kept"], r["stopped_by"]) for r in quality.grade(docs).collect()}
    assert quality.grade(docs).count() == 5
    assert got[(2, None)] == (True, None) and got[(1, "x")] == (False, "few_words") and got[(None, "y")][0] is False and got[(3, "z")][0] is False
    assert quality.grade(docs.limit(0)).count() == 0
