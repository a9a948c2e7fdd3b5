"""k-modes, k-prototypes and silhouettes (inventory G1-G6).

Games with the same attributes always share a cluster, so the loops run over distinct attribute
sets with their number of games. The driver holds the k centroids, as lists of the attributes they hold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ludoscope.functions.scale import salted_lookup, with_position  # noqa: F401
from ludoscope.operators.similar import attribute_sets
from ludoscope.session import cut_lineage



@dataclass
class Clustering:
    """Labels (game_id, cluster), the centroids, the final cost, the cost after each pass."""

    labels: DataFrame
    centroids: list
    cost: float
    costs: list[float]

    @property
    def n_iter(self) -> int:
        return len(self.costs)


def _mismatch(centroid: Sequence[int]) -> Column:
    """In how many attributes a set and a centroid differ."""
    terms = F.array(*[F.lit(t) for t in centroid]).cast("array<long>")
    return F.size("terms") + len(centroid) - 2 * F.size(F.array_intersect("terms", terms))


def _nearest(distances: list[Column]) -> tuple[Column, Column]:
    """(cluster, distance) of the nearest centroid; the first one wins a tie."""
    table = F.array(*distances)
    return F.array_position(table, F.array_min(table)).cast("int") - 1, F.array_min(table)


def signatures(games: DataFrame, attrs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sets, groups): each game's attributes, and the distinct sets (key, terms, n) with their number of games."""
    sets = cut_lineage(attribute_sets(games, attrs))
    groups = sets.groupBy("terms").agg(F.min("game_id").alias("key"), F.count(F.lit(1)).alias("n"))
    return sets, cut_lineage(groups.select("key", "terms", "n"))


def _attribute_counts(groups: DataFrame) -> DataFrame:
    """(t, held): the number of games that hold each attribute."""
    return groups.select("n", F.explode("terms").alias("t")).groupBy("t").agg(F.sum("n").alias("held"))


def init_cao(groups: DataFrame, k: int) -> list[list[int]]:
    """Dense and far apart first centroids (Cao, Liang and Bai, 2009).

    Density is the mean share of games that agree with a set, attribute by attribute; the next
    centroid has the largest product of density and distance to the nearest chosen one. So the centroids for a
    smaller ``k`` are the first of those for a larger one.
    """
    total = groups.agg(F.sum("n")).first()[0] or 0
    counts = _attribute_counts(groups)
    base = counts.agg(F.sum(total - F.col("held"))).first()[0] or 0
    gain = groups.select("key", F.explode("terms").alias("t")).join(counts, "t").groupBy("key").agg(
        F.sum(2 * F.col("held") - total).alias("_gain"))
    dense = groups.join(gain, "key", "left").withColumn("_density", base + F.coalesce("_gain", F.lit(0)))
    dense = cut_lineage(dense.drop("_gain"))
    chosen: list[list[int]] = []
    while len(chosen) < k:
        if chosen:
            far = [_mismatch(c) * F.col("_density") for c in chosen]
            score = F.least(*far) if len(far) > 1 else far[0]
        else:
            score = F.col("_density")
        best = dense.select("terms", "key", score.alias("_s")).orderBy(F.col("_s").desc(), "key").limit(1).first()
        if best is None or (chosen and best["_s"] <= 0):
            break
        chosen.append(list(best["terms"]))
    return chosen


def init_huang(groups: DataFrame, k: int, seed: int = 34) -> list[list[int]]:
    """Centroids drawn attribute by attribute with the attribute's share as chance (Huang, 1998).

    The draw is a digest of seed, centroid and attribute; each drawn set gives way to the nearest
    real one that is not taken yet.
    """
    total = groups.agg(F.sum("n")).first()[0] or 0
    counts = cut_lineage(_attribute_counts(groups))
    chosen: list[list[int]] = []
    taken: list[int] = []
    for c in range(k):
        digest = F.md5(F.concat(F.lit(f"{seed}|{c}|"), F.col("t").cast("string")))
        draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / (1 << 32)
        drawn = [r["t"] for r in counts.where(draw < F.col("held") / total).orderBy("t").collect()]
        free = groups.where(~F.col("key").isin(*taken)) if taken else groups
        near = free.select("terms", "key", _mismatch(drawn).alias("_d"))
        best = near.orderBy("_d", "key").limit(1).first()
        if best is None:
            break
        chosen.append(list(best["terms"]))
        taken.append(best["key"])
    return chosen


def kmodes_pass(groups: DataFrame, centroids: list[list[int]]) -> tuple[list[list[int]], float]:
    """One pass: the modes of the groups nearest to each centroid, and the cost before moving.

    A mode holds an attribute when more than half of the cluster's games do; an empty cluster keeps
    its centroid. One aggregation gives sizes, cost and attribute counts, and only attributes of modes reach the driver.
    """
    cluster, distance = _nearest([_mismatch(c) for c in centroids])
    rows = groups.select("n", cluster.alias("c"), distance.alias("d"), F.explode(
        F.concat(F.array(F.lit(-1).cast("long")), F.col("terms"))).alias("t"))
    sums = rows.groupBy("c", "t").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("d")).alias("cost"))
    size = F.max(F.when(F.col("t") == -1, F.col("n"))).over(Window.partitionBy("c"))
    kept = sums.withColumn("size", size).where((F.col("t") == -1) | (2 * F.col("n") > F.col("size"))).collect()
    filled = {r["c"] for r in kept}
    moved = [[] if i in filled else list(c) for i, c in enumerate(centroids)]
    for r in kept:
        if r["t"] >= 0:
            moved[r["c"]].append(r["t"])
    return [sorted(c) for c in moved], float(sum(r["cost"] for r in kept if r["t"] == -1))


def _run(groups: DataFrame, centroids: list[list[int]], max_iter: int) -> tuple[list[list[int]], list[float]]:
    """The best centroids and the costs of passes from the given ones until the cost stops to fall."""
    costs: list[float] = []
    best = centroids
    for _ in range(max_iter):
        moved, cost = kmodes_pass(groups, centroids)
        if costs and cost >= costs[-1]:
            break
        costs.append(cost)
        best = centroids
        if moved == centroids:
            break
        centroids = moved
    return best, costs


def kmodes(
    games: DataFrame, attrs: DataFrame, k: int, init: str = "Cao", max_iter: int = 100, seed: int = 34
) -> Clustering:
    """G1: k-modes on attribute sets; the mismatch of two sets is the number of attributes they differ in."""
    sets, groups = signatures(games, attrs)
    if init == "Cao":
        centroids = init_cao(groups, k)
    elif init == "Huang":
        centroids = init_huang(groups, k, seed)
    else:
        raise ValueError("init is 'Cao' or 'Huang'")
    best, costs = _run(groups, centroids, max_iter)
    placed = groups.select("terms", _nearest([_mismatch(c) for c in best])[0].alias("cluster"))
    labels = salted_lookup(sets, placed, "terms", ["game_id"], groups.select("terms", F.col("n").alias("_rows")))
    return Clustering(labels.select("game_id", "cluster"), best, costs[-1], costs)


def init_cao_mixed(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], k: int) -> list[list]:
    """First prototypes by Cao, Liang and Bai (2009) on the categories; their numbers are the means of the rows with just these categories.

    The density of a combination of categories is the number of rows that share each of them, summed up. The densest comes first; then
    always that with the largest of: density times the number of categories that differ, in the nearest one chosen. Counts are
    whole numbers and ties go to the smallest categories, so the start does not depend on the order of rows. Only distinct combinations
    are looked at; there are as many prototypes as combinations if these are fewer than ``k``.
    """
    groups = rows.groupBy(*categorical).agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(c) for c in numeric])
    groups = cut_lineage(groups.withColumn("_density", F.lit(0).cast("long")))
    for c in categorical:
        held = groups.groupBy(c).agg(F.sum("_n").alias("_held"))
        groups = groups.join(held, c).withColumn("_density", F.col("_density") + F.col("_held")).drop("_held")
    groups = cut_lineage(groups)
    chosen: list[list] = []
    while len(chosen) < k:
        apart = [sum(((F.col(c) != F.lit(old[len(numeric) + i])).cast("int") for i, c in enumerate(categorical)), F.lit(0)) for old in chosen]
        score = F.col("_density") * (F.least(*apart) if len(apart) > 1 else apart[0] if apart else F.lit(1))
        order = [score.desc(), *[F.col(c) for c in categorical]]
        first = groups.where(score > 0).orderBy(*order).limit(1).collect()
        if not first:
            break
        chosen.append([first[0][c] for c in (*numeric, *categorical)])
    return chosen


def kprototypes(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    k: int,
    gamma: float | None = None,
    max_iter: int = 100,
    key: str = "game_id",
    seed: int = 34,
    init: str = "hash",
) -> Clustering:
    """K-prototypes: squared distance of the numbers + ``gamma`` x differing categories.

    Rows with a missing value are left out. ``gamma`` is half the mean deviation of the numeric
    columns unless given. The first prototypes are the rows with the smallest digests, or with ``init`` "Cao" those of ``init_cao_mixed``.
    """
    if init not in ("hash", "Cao"):
        raise ValueError("init is 'hash' or 'Cao'")
    columns = [*numeric, *categorical]
    rows = df.select(key, *[F.col(c).cast("double") for c in numeric], *[F.col(c) for c in categorical])
    rows = cut_lineage(rows.na.drop("any"))
    if gamma is None:
        spread = rows.agg(*[F.stddev_pop(c).alias(c) for c in numeric]).first()
        gamma = sum(spread) / len(numeric) / 2
    if init == "Cao":
        centroids = init_cao_mixed(rows, numeric, categorical, k)
    else:
        draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
        start = rows.groupBy(*columns).agg(F.min(draw).alias("_draw")).orderBy("_draw").limit(k).collect()
        centroids = [[r[c] for c in columns] for r in start]

    def distances(centroids: list[list]) -> list[Column]:
        out = []
        for c in centroids:
            squares = sum(((F.col(n) - c[i]) * (F.col(n) - c[i]) for i, n in enumerate(numeric)), F.lit(0.0))
            differ = sum(
                ((F.col(n) != F.lit(c[len(numeric) + i])).cast("int") for i, n in enumerate(categorical)), F.lit(0)
            )
            out.append(squares + gamma * differ)
        return out

    costs: list[float] = []
    best = centroids
    for _ in range(max_iter):
        cluster, distance = _nearest(distances(centroids))
        placed = rows.select("*", cluster.alias("_c"), distance.alias("_d"))
        means = placed.groupBy("_c").agg(*[F.avg(n).alias(n) for n in numeric], F.sum("_d").alias("_cost")).collect()
        cost = sum(r["_cost"] for r in means)
        if costs and cost >= costs[-1]:
            break
        costs.append(cost)
        best = centroids
        moved = [list(c) for c in centroids]
        for r in means:
            moved[r["_c"]][: len(numeric)] = [r[n] for n in numeric]
        for i, name in enumerate(categorical):
            counts = placed.groupBy("_c", name).agg(F.count(F.lit(1)).alias("n"))
            modes = counts.groupBy("_c").agg(F.min_by(name, F.struct(-F.col("n"), F.col(name))).alias("mode")).collect()
            for r in modes:
                moved[r["_c"]][len(numeric) + i] = r["mode"]
        if moved == centroids:
            break
        centroids = moved
    cluster, _ = _nearest(distances(best))
    return Clustering(rows.select(key, cluster.alias("cluster")), best, costs[-1], costs)


def cluster_sizes(labels: DataFrame, col: str = "cluster") -> DataFrame:
    """Number of rows in each cluster."""
    return labels.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def _set_scores(placed: DataFrame) -> DataFrame:
    """(terms, cluster, silhouette) of distinct attribute sets (terms, cluster, n), each standing for n games.

    All distances from a game to the games of a cluster add up to: the cluster's attributes, plus its size times the game's
    number of attributes, less twice the cluster's count of each attribute the game holds. Clusters travel as
    one short row: size and attributes.
    """
    held = placed.select("cluster", "n", F.explode("terms").alias("t"))
    counts = held.groupBy("t", "cluster").agg(F.sum("n").alias("n"))
    base = placed.groupBy("cluster").agg(F.sum("n").alias("size"), F.sum(F.col("n") * F.size("terms")).alias("base"))
    every = base.agg(F.collect_list(F.struct("cluster", "size", "base"))).scalar()
    found = placed.select("terms", "cluster", F.explode("terms").alias("t")).join(counts.select("t", F.col("cluster").alias("other"), "n"), "t")
    shared = found.groupBy("terms", "cluster", "other").agg(F.sum("n").alias("shared")).groupBy("terms", "cluster").agg(
        F.map_from_entries(F.collect_list(F.struct("other", "shared"))).alias("_shared"))
    far = placed.join(shared, ["terms", "cluster"], "left").withColumn("_every", every)

    def total(c: Column) -> Column:
        both = F.coalesce(F.try_element_at("_shared", c["cluster"]), F.lit(0))
        return c["base"] + c["size"] * F.size("terms") - 2 * both

    mine = F.get(F.filter("_every", lambda c: c["cluster"] == F.col("cluster")), F.lit(0))
    others = F.filter("_every", lambda c: c["cluster"] != F.col("cluster"))
    scored = far.select(
        "terms", "cluster", "n", mine["size"].alias("_size"), (total(mine) / F.greatest(mine["size"] - 1, F.lit(1))).alias("_a"),
        F.array_min(F.transform(others, lambda c: total(c) / c["size"])).alias("_b"),
    )
    a, b = F.col("_a"), F.col("_b")
    score = F.when((F.col("_size") == 1) | b.isNull() | (F.greatest(a, b) == 0), 0.0).otherwise((b - a) / F.greatest(a, b))
    return scored.select("terms", "cluster", "n", score.alias("silhouette"))


def silhouette_samples(attrs: DataFrame, labels: DataFrame, col: str = "cluster") -> DataFrame:
    """(game_id, cluster, silhouette) by Hamming distance, without any pair of games.

    Games with the same attributes in the same cluster have one score and are one row of the work.
    """
    labels = labels.select("game_id", F.col(col).alias("cluster"))
    sets = cut_lineage(attribute_sets(labels, attrs).join(labels, "game_id"))
    placed = cut_lineage(sets.groupBy("terms", "cluster").agg(F.count(F.lit(1)).alias("n")))
    scores = _set_scores(placed).drop("n")
    return sets.join(scores, ["terms", "cluster"]).select("game_id", "cluster", "silhouette")


def silhouette(attrs: DataFrame, labels: DataFrame, col: str = "cluster") -> DataFrame:
    """The mean of the per-game scores, one row."""
    return silhouette_samples(attrs, labels, col).agg(F.avg("silhouette").alias("silhouette"))


def silhouette_sweep(games: DataFrame, attrs: DataFrame, ks: Sequence[int], init: str = "Cao", max_iter: int = 100) -> DataFrame:
    """(k, silhouette) of the k-modes clustering for each k.

    The attribute sets are made once. Cao's centroids are chosen one after the other, so those of the largest k serve
    every other k too.
    """
    _, groups = signatures(games, attrs)
    chosen = init_cao(groups, max(ks)) if init == "Cao" else []
    rows = []
    for k in ks:
        starts = chosen[:k] if init == "Cao" else init_huang(groups, k)
        best, _ = _run(groups, starts, max_iter)
        placed = groups.select("terms", _nearest([_mismatch(c) for c in best])[0].alias("cluster"), "n")
        mean = _set_scores(placed).agg(F.sum(F.col("silhouette") * F.col("n")) / F.sum("n"))
        rows.append((k, mean.first()[0]))
    return games.sparkSession.createDataFrame(rows, "k int, silhouette double")
