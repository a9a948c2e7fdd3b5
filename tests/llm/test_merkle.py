"""The manifest against a plain tree with hashlib."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludoscope.llm import merkle
from ludoscope.llm.sha_states import absorb, finish, fresh

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, digest string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def climb(nodes):
    """The levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 3])) for i in range(0, len(last), 3)])
    return levels


def way(levels, i):
    """(left siblings, right siblings) of node i at every level."""
    out = []
    for level in levels[:-1]:
        low = i - i % 3
        out.append(("".join(level[low:i]), "".join(level[i + 1 : low + 3])))
        i //= 3
    return out


def plain(rows, edited):
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row, row[4]), leaf_of(row, edited(row))))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(sources[s])]) for s in order}
    top = climb([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (known, doc_id, leaf, new) in enumerate(sorted(sources[s])):
            steps = way(trees[s], i) + way(top, k)
            folded = new
            for left, right in steps:
                folded = h(left + folded + right)
            proof = h("".join(left + right for left, right in steps))
            out.append((doc_id if known else None, leaf, trees[s][-1][0], top[-1][0], proof, folded))
    return sorted(out, key=repr)


def run(spark, rows, edited_column, changed):
    docs = spark.createDataFrame(rows, SCHEMA)
    manifest = merkle.build(docs, keep={"edited": merkle.leaf_digest([F.col(c) if c != "text" else edited_column for c in merkle.FIELDS])})
    changes = manifest.leaves.select("tree", "at", F.when(changed, F.col("edited")).otherwise(F.col("leaf")).alias("digest"), "doc_id", "leaf")
    return manifest, sorted(
        ((r.doc_id, *(bytes(x).hex() for x in (r.leaf, r.root)), manifest.root.hex(), bytes(r.proof).hex(), bytes(r.folded).hex())
         for r in merkle.fold(manifest, changes).collect()), key=repr)


def some_rows(n, sources, seed=3):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        text = draw.choice([None, "", "a\nb", "line\n" * draw.randrange(5), "é中\n😀", f"text {i}"])
        out.append((i if draw.random() < 0.97 else None, draw.choice(sources), draw.choice([None, "en"]), draw.choice([None, 5, -1]), text, "t", "d"))
    return out


@pytest.mark.parametrize("n, sources", [
    (1, ["only"]), (2, ["only"]), (4, [None]), (40, [None, "", "b", "B", "é", "z"]),
    # More than a chunk in one source, and more sources than a chunk holds.
    (2500, ["hot", "hot", "hot", "small", None]), (1900, [f"s{i}" for i in range(900)]),
])
def test_against_a_plain_tree(spark, n, sources):
    rows = some_rows(n, sources)
    rows += [rows[0], rows[0]]
    _, got = run(spark, rows, F.replace("text", F.lit("\n"), F.lit("")), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0)

    def edited(row):
        return row[4] if row[4] is None or row[0] is None or zlib.crc32(str(row[0]).encode()) % 2 else row[4].replace("\n", "")

    assert got == plain(rows, edited)


@pytest.mark.parametrize("n", [729, 730, 2187, 2188])
def test_edges_of_chunks(spark, n):
    rows = [(i, "s", None, None, str(i), "", "") for i in range(n)]
    _, got = run(spark, rows, F.col("text"), F.lit(False))
    assert got == plain(rows, lambda row: row[4])


def test_many_changes_of_one_leaf_and_unknown_ones(spark):
    rows = [(i, "s", None, None, str(i), "", "") for i in range(10)]
    manifest, _ = run(spark, rows, F.col("text"), F.lit(False))
    leaf = manifest.leaves.where("doc_id = 4").select("tree", "at").first()
    changes = spark.range(40_000).select(F.lit(leaf.tree).alias("tree"), F.lit(leaf.at).alias("at"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"), "id")
    changes = changes.union(spark.createDataFrame([(leaf.tree, 10, b"x" * 32, -1), (99, 0, b"x" * 32, -2), (leaf.tree, 5000, b"x" * 32, -3)], changes.schema))
    out = merkle.fold(manifest, changes).groupBy().agg(F.count("folded"), F.count_distinct("folded"), F.count_distinct("proof"), F.count(F.lit(1))).first()
    assert tuple(out) == (40_000, 40_000, 1, 40_003)


def test_no_rows(spark):
    manifest = merkle.build(spark.createDataFrame([], SCHEMA))
    assert manifest.root is None and manifest.leaves.count() == 0
    changes = manifest.leaves.select("tree", "at", F.col("leaf").alias("digest"), "doc_id")
    assert merkle.fold(manifest, changes).collect() == []


def test_states_are_those_of_the_standard():
    draw = np.random.default_rng(5)
    children = draw.integers(0, 256, (3, 20_000, 32)).astype(np.uint8)
    state = fresh(20_000)
    assert finish(state[:1], np.zeros(1))[0].tobytes() == hashlib.sha256(b"").digest()
    for k in range(3):
        state = absorb(state, children[k])
        digest = finish(state, np.full(20_000, k + 1))
        for i in (0, 8191, 8192, 19_999):
            assert digest[i].tobytes().hex() == h("".join(children[j, i].tobytes().hex() for j in range(k + 1)))
