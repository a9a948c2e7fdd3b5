"""Likeness of games by attributes and by text (inventory K1-K6).

One game against all is a join on the attributes it holds. The k nearest of every game are found
block against block (``bounded``): like rows share a block, a task multiplies two blocks and passes on
only the k best per row, and blocks whose bound is below what their rows have already never meet. Nothing
is left out, no pair is ever shuffled, and a popular attribute or a large group of equal games cannot fill
one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ludoscope.functions.blocks import inner_products, vectors
from ludoscope.functions.scale import salted_lookup, top_per_key, with_position
from ludoscope.functions.text import title_score
from ludoscope.operators.bounded import Bound, Measure, best_partners
from ludoscope.session import cut_lineage, delete, stored_at

ATTR_BLOCK = 2048
TEXT_BLOCK = 512
#: Rows per pivot of the order of texts, up to 256 pivots.
PIVOT_ROWS = 32


def _shared_counts(games: DataFrame, attrs: DataFrame, probe: int) -> DataFrame:
    """Per game: own attributes, and those shared with the probe; games without attributes hold 0."""
    held = attrs.select("game_id", "kind", "name").distinct()
    mine = held.where(F.col("game_id") == probe).select("kind", "name")
    size = mine.agg(F.count(F.lit(1))).scalar()
    counts = (
        held.join(mine.withColumn("_shared", F.lit(True)), ["kind", "name"], "left")
        .groupBy("game_id")
        .agg(F.count(F.lit(1)).alias("own"), F.count("_shared").alias("shared"))
    )
    zero = F.lit(0)
    return games.select("game_id").join(counts, "game_id", "left").select(
        "game_id",
        F.coalesce("own", zero).alias("own"),
        F.coalesce("shared", zero).alias("shared"),
        size.alias("probe"),
    )


def hamming_similarity(games: DataFrame, attrs: DataFrame, probe: int) -> DataFrame:
    """K1: 1 - share of attributes in which a game differs from the probe, for every game."""
    size = attrs.agg(F.count_distinct("kind", "name")).scalar()
    differing = F.col("own") + F.col("probe") - 2 * F.col("shared")
    return _shared_counts(games, attrs, probe).select("game_id", (1 - differing / size).alias("similarity"))


def jaccard_similarity(games: DataFrame, attrs: DataFrame, probe: int) -> DataFrame:
    """K3: shared attributes over all attributes of a game and the probe; two empty sets are equal."""
    union = F.col("own") + F.col("probe") - F.col("shared")
    return _shared_counts(games, attrs, probe).select(
        "game_id", F.when(union == 0, 1.0).otherwise(F.col("shared") / union).alias("similarity")
    )


def attribute_sets(games: DataFrame, attrs: DataFrame, rarest_first: bool = False) -> DataFrame:
    """(game_id, terms): the numbers of a game's attributes, in order; no attributes, no numbers.

    Numbers follow kind and name, or ``rarest_first`` how many games have the attribute.
    """
    held = attrs.select("game_id", "kind", "name").distinct()
    names = held.groupBy("kind", "name").agg(F.count(F.lit(1)).alias("_games"))
    order = [*([F.col("_games")] if rarest_first else []), F.col("kind"), F.col("name")]
    held = held.join(with_position(names, order, "term", start=0).drop("_games"), ["kind", "name"])
    lists = held.groupBy("game_id").agg(F.array_sort(F.collect_list(F.col("term"))).alias("terms"))
    return games.select(F.col("game_id").cast("long").alias("game_id")).join(lists, "game_id", "left").withColumn(
        "terms", F.coalesce("terms", F.array().cast("array<long>"))
    )


def _attribute_topk(games: DataFrame, attrs: DataFrame, k: int, measure: Measure, bound: Bound, stats: dict | None) -> DataFrame:
    """Exact top k of every game by a measure on attribute sets. Sets of one size that begin with the same rare attributes share a block.

    Games with equal sets are one row of the block step. Such a group needs no more than its k + 1
    smallest ids: ties go to the smaller id, so a larger one can never be among k partners.
    """
    sets = cut_lineage(attribute_sets(games, attrs, rarest_first=True))
    key = F.min("game_id").alias("key")
    groups = cut_lineage(sets.groupBy("terms").agg(key, F.count(F.lit(1)).alias("_rows")))
    ones = F.transform("terms", lambda t: F.lit(1.0))
    found = best_partners(
        groups.select("key", "terms", ones.alias("weights")), k + 1, measure, bound, ATTR_BLOCK, [F.size("terms"), F.col("terms"), F.col("key")])
    near = found.best
    if stats is not None:
        stats.update(pairs=found.pairs, met=found.met)

    named = salted_lookup(sets, groups.select("terms", "key"), "terms", ["game_id"], groups.select("terms", "_rows"))
    first = top_per_key(named.select("key", "game_id"), ["key"], [F.col("game_id")], k + 1, "_n")
    members = first.groupBy("key").agg(F.collect_list("game_id").alias("ids"))
    candidates = near.join(members.withColumnRenamed("key", "partner"), "partner").select(
        "key", "score", F.explode("ids").alias("game_id")
    )
    best = top_per_key(candidates, ["key"], [F.col("score").desc(), F.col("game_id")], k + 1, "_n")
    listed = best.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("_n", "game_id", "score"))).alias("near"))
    each = salted_lookup(named, listed, "key", ["game_id"], groups.select("key", "_rows"))
    others = F.slice(F.filter("near", lambda x: x["game_id"] != F.col("game_id")), 1, k)
    return each.select("game_id", F.posexplode(others).alias("pos", "n")).select(
        "game_id",
        F.col("n.game_id").alias("other_id"),
        F.col("n.score").alias("similarity"),
        (F.col("pos") + 1).alias("rank"),
    )


def _fewest_extra(shared: np.ndarray, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most attributes a set of each side can share, and the fewest more that either side must have."""
    most = np.minimum(shared, np.minimum(a[1], b[1]))
    return most, np.maximum(a[0] - most, 0), np.maximum(b[0] - most, 0)


def hamming_measures(size: int) -> tuple[Measure, Bound]:
    """The Hamming similarity of sets out of ``size`` attributes, and the most that two blocks of sets allow."""

    def bound(shared: np.ndarray, a: tuple, b: tuple) -> np.ndarray:
        _, left, right = _fewest_extra(shared, a, b)
        return 1 - np.maximum(np.maximum(b[0] - a[1], a[0] - b[1]), left + right) / size

    return lambda shared, a, b: 1 - (a + b - 2 * shared) / size, bound


def jaccard_measures() -> tuple[Measure, Bound]:
    """The Jaccard similarity of sets, of which empty ones are equal, and the most that two blocks of sets allow."""

    def measure(shared: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        union = a + b - shared
        return np.where(union == 0, 1.0, shared / np.maximum(union, 1))

    def bound(shared: np.ndarray, a: tuple, b: tuple) -> np.ndarray:
        most, left, right = _fewest_extra(shared, a, b)
        best = np.where(most > 0, most / np.maximum(most + left + right, 1), 0.0)
        return np.where((a[0] == 0) & (b[0] == 0), 1.0, best)

    return measure, bound


def hamming_topk(games: DataFrame, attrs: DataFrame, k: int, stats: dict | None = None) -> DataFrame:
    """K2: the ``k`` games nearest by Hamming similarity to every game, disjoint small sets included.

    ``stats`` receives the pairs of blocks there are and those that were compared (met).
    """
    size = max(1, attrs.select("kind", "name").distinct().count())
    return _attribute_topk(games, attrs, k, *hamming_measures(size), stats)


def jaccard_topk(games: DataFrame, attrs: DataFrame, k: int, stats: dict | None = None) -> DataFrame:
    """K3: the ``k`` games nearest by Jaccard similarity to every game; ``stats`` as for K2."""
    return _attribute_topk(games, attrs, k, *jaccard_measures(), stats)


def _nearest_pivots(rows: DataFrame, pivots: int) -> DataFrame:
    """``rows`` with ``pivot``: which of some drawn rows is most like each, judged by the pivots' 100 largest weights.

    At most 256 pivots are drawn, so what the tasks are sent is bounded. They only say which rows share a block.
    """
    drawn = rows.orderBy(F.xxhash64("key"), "key").limit(pivots).select(
        "key", F.slice(F.array_sort(F.transform(F.arrays_zip("terms", "weights"), lambda x: F.struct((-x["weights"]).alias("w"), x["terms"].alias("t")))), 1, 100).alias("p"))
    table = drawn.select("key", F.col("p.t").alias("terms"), F.transform("p.w", lambda w: -w).alias("weights")).toPandas()
    held = vectors(table)

    def label(parts):
        for part in parts:
            part = part.sort_values("key")
            like = inner_products(vectors(part), held)
            yield part.assign(pivot=like.argmax(axis=1) if like.size else 0)

    return rows.mapInPandas(label, "key long, terms array<long>, weights array<double>, pivot long")


def cosine_topk(tfidf: DataFrame, k: int, digits: int = 9, stats: dict | None = None) -> DataFrame:
    """K4: the ``k`` documents nearest to every document by cosine of their TF-IDF rows.

    Scores are rounded to ``digits`` places before they are ranked, so sums taken in another order
    cannot change a tie. No two documents of two blocks are more alike than the product of the blocks' largest weights per
    term. ``stats`` as for K2.
    """
    pairs = F.array_sort(F.collect_list(F.struct("term_id", "tfidf")))
    rows = tfidf.groupBy(F.col("doc_id").cast("long").alias("key")).agg(pairs.alias("_p")).select(
        "key", F.col("_p.term_id").alias("terms"), F.col("_p.tfidf").alias("weights")
    )
    rows, path = stored_at(rows, "texts")
    labeled = _nearest_pivots(rows, min(256, max(1, rows.count() // PIVOT_ROWS)))
    found = best_partners(
        labeled, k + 1, lambda dot, a, b: np.round(dot, digits), lambda dot, a, b: dot + 10.0**-digits, TEXT_BLOCK, [F.col("pivot"), F.col("key")])
    delete(tfidf.sparkSession, path)
    if stats is not None:
        stats.update(pairs=found.pairs, met=found.met)
    others = found.best.where(F.col("key") != F.col("partner"))
    return top_per_key(others, ["key"], [F.col("score").desc(), F.col("partner")], k, "rank").select(
        F.col("key").alias("doc_id"), F.col("partner").alias("other_id"), F.col("score").alias("similarity"), "rank"
    )


def cosine_similarity(tfidf: DataFrame, doc_id: int) -> DataFrame:
    """K4: one document against every other one; a document without a shared term has similarity 0."""
    probe = tfidf.where(F.col("doc_id") == doc_id).select("term", F.col("tfidf").alias("_w"))
    # The terms of one document; the others stay where they are.
    both = tfidf.where(F.col("doc_id") != doc_id).join(F.broadcast(probe), "term", "left")
    return both.groupBy("doc_id").agg(F.coalesce(F.sum(F.col("tfidf") * F.col("_w")), F.lit(0.0)).alias("similarity"))


def fuzzy_match(games: DataFrame, name: str | Column) -> DataFrame:
    """K5: the game whose title is closest to ``name``: one row (game_id, game, score)."""
    query = F.lit(name) if isinstance(name, str) else name
    scored = games.select("game_id", "game", title_score(F.col("game"), query).alias("score"))
    return scored.orderBy(F.col("score").desc(), "game", "game_id").limit(1)


def neighbours_by_text(tfidf: DataFrame, titles: DataFrame, doc_id: int, k: int = 10, digits: int = 9) -> DataFrame:
    """K6: titles of the ``k`` documents most like one document."""
    scores = cosine_similarity(tfidf, doc_id).withColumn("similarity", F.round("similarity", digits))
    best = scores.orderBy(F.col("similarity").desc(), "doc_id").limit(k)
    return best.join(titles, best["doc_id"] == titles["game_id"]).select("doc_id", "game", "similarity")
