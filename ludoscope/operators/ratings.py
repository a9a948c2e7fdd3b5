"""Profiling and shaping of ratings (inventory R1-R11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ludoscope.functions.scale import with_position


CELL_SIDE = 1_000
#: Tasks that make the pairs of all cells, at most.
CELL_TASKS = 1_000


def dense_ids(df: DataFrame, col: str, start: int = 0, appearance: str | None = None, name: str = "id") -> DataFrame:
    """(value, id) with ids counting up from ``start``.

    Values are numbered in sorted order, or by first appearance when ``appearance`` names the
    column that holds the order of the rows.
    """
    values = df.where(F.col(col).isNotNull()).groupBy(col)
    if appearance is None:
        return with_position(values.agg(F.lit(1).alias("_1")).select(col), [F.col(col)], name, start)
    seen = values.agg(F.min(appearance).alias("_seen"))
    return with_position(seen, [F.col("_seen"), F.col(col)], name, start).drop("_seen")


def utility_matrix(ratings: DataFrame, user: str = "user_id", game: str = "game_id") -> DataFrame:
    """R2: the user x game matrix in cell form (row, col, rating); several ratings of a pair add up.

    Rows and columns are numbered from 0 in sorted order. Cells that are not listed are 0.
    """
    cells = ratings.groupBy(user, game).agg(F.sum("rating").alias("rating"))
    rows = dense_ids(ratings, user, name="row")
    cols = dense_ids(ratings, game, name="col")
    return cells.join(rows, user).join(cols, game).select("row", "col", "rating")


def utility_wide(ratings: DataFrame, games: Sequence[int] | None = None) -> DataFrame:
    """R2: the same as one column per game, by default of all that are rated; missing cells are 0."""
    if games is None:
        games = [r[0] for r in ratings.select("game_id").distinct().orderBy("game_id").collect()]
    wide = ratings.groupBy("user_id").pivot("game_id", list(games)).agg(F.sum("rating"))
    return wide.na.fill(0.0)


def utility_rows(ratings: DataFrame) -> DataFrame:
    """R2: the same for any number of games, a row per user: (user_id, n_cells, cells).

    A column per game stops at some thousands of games and takes users x games of room. Here ``n_cells`` is the row's length and ``cells``
    lists those that are not 0, (game_id, rating), under the names the columns would have. As there, a missing numeric user is 0.
    """
    n_cells = ratings.select("game_id").distinct().agg(F.count(F.lit(1))).scalar()
    sums = ratings.groupBy("user_id", "game_id").agg(F.sum("rating").alias("rating"))
    name = F.coalesce(F.col("game_id").cast("string"), F.lit("null")).alias("game_id")
    held = F.when(F.col("rating") != 0, F.struct(name, "rating"))
    rows = sums.groupBy("user_id").agg(F.collect_list(held).alias("cells")).na.fill(0, ["user_id"])
    return rows.select("user_id", n_cells.alias("n_cells"), "cells")


def value_counts(ratings: DataFrame) -> DataFrame:
    """How often each value fills the matrix, the zeros of the empty cells included."""
    cells = ratings.groupBy("user_id", "game_id").agg(F.sum("rating").alias("value"))
    stored = cells.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    empty = cells.agg(
        F.lit(0.0).alias("value"),
        (F.count_distinct("user_id") * F.count_distinct("game_id") - F.count(F.lit(1))).alias("n"),
    )
    return stored.unionByName(empty).groupBy("value").agg(F.sum("n").alias("n"))


def sparsity(ratings: DataFrame) -> DataFrame:
    """Size of the matrix, mean number of ratings per user and share of empty cells."""
    sizes = ratings.agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("game_id").alias("n_games"),
    )
    return sizes.withColumns({
        "mean_per_user": F.col("n_ratings") / F.col("n_users"),
        "sparsity": 1 - F.col("n_ratings") / (F.col("n_users") * F.col("n_games")),
    })


def ratings_per_user(ratings: DataFrame) -> DataFrame:
    """Number of ratings of each user."""
    return ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, col: str, bins: int = 50, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Counts in ``bins`` bins of equal width over the column's range, the last one closed.

    Bins without a row are kept. ``lo`` and ``hi`` limit the view to bins that touch that range;
    they do not move the bins.
    """
    value = F.col(col).cast("double")
    one = F.min(value) == F.max(value)
    low = F.min(value) - F.when(one, 0.5).otherwise(0.0)
    high = F.max(value) + F.when(one, 0.5).otherwise(0.0)
    span = df.agg(low.alias("low"), ((high - low) / bins).alias("width"))
    low, width = span.select("low").scalar(), span.select("width").scalar()
    place = F.least(F.floor((value - low) / width), F.lit(bins - 1)).cast("int")
    counts = df.where(value.isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    view = edges.join(counts, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("left_edge"),
        (low + (F.col("bin") + 1) * width).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
    if lo is not None:
        view = view.where(F.col("right_edge") >= lo)
    if hi is not None:
        view = view.where(F.col("left_edge") <= hi)
    return view


def counts_and_means(ratings: DataFrame, item: str = "game_id") -> DataFrame:
    """Number and mean of the ratings of each item."""
    return ratings.groupBy(item).agg(F.count("rating").alias("n"), F.avg("rating").alias("mean"))


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Spark's own random split."""
    return df.randomSplit(list(weights), seed=seed)


def split_label(weights: Sequence[float], keys: Sequence[str], seed: int = 34) -> Column:
    """The number of the part a row falls in, decided by the digest of its keys alone."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(1 << 32)
    total, edge, label = sum(weights), 0.0, F.lit(len(weights) - 1)
    bounds = []
    for weight in weights[:-1]:
        edge += weight / total
        bounds.append(edge)
    for part in reversed(range(len(bounds))):
        label = F.when(draw < bounds[part], part).otherwise(label)
    return label


def hash_split(df: DataFrame, weights: Sequence[float], keys: Sequence[str], seed: int = 34) -> list[DataFrame]:
    """A split that does not change with partitioning; the parts cover every row once."""
    label = split_label(weights, keys, seed)
    return [df.where(label == part) for part in range(len(weights))]


def feature_pairs(df: DataFrame) -> DataFrame:
    """The pairs to score, without the rating."""
    return df.select("user_id", "game_id")


def unrated_games(ratings: DataFrame, user: DataFrame) -> DataFrame:
    """Every game the user has not rated, with the user's id and rating 0.0.

    ``user`` holds one ``user_id`` or, for an unknown name, no row; then the result is empty.
    """
    return unrated_all(ratings, user)


def unrated_all(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """The same for all given users at once.

    The pairs are the feature itself. They are made in cells of about ``CELL_SIDE`` users by as many games, so a cell
    stays the same however many there are. What is shuffled is lists, of the users, games and ratings of a cell; pairs come into being behind
    the last shuffle.
    """
    games = ratings.select("game_id").distinct()
    users = users.select("user_id").distinct()
    user_blocks, game_blocks = (max(1, -(-side.count() // CELL_SIDE)) for side in (users, games))

    def numbered(side: DataFrame, key: str, block: str, blocks: int) -> DataFrame:
        return side.withColumn(block, F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"))

    def listed(side: DataFrame, key: str, block: str) -> DataFrame:
        # Structs, as a list of bare values would lose a null.
        ids = F.collect_list(F.struct(key))[key].alias(key)
        return side.groupBy(block).agg(ids)

    members, titles = numbered(users, "user_id", "_ub", user_blocks), numbered(games, "game_id", "_gb", game_blocks)
    rated = numbered(members.join(ratings.where("game_id IS NOT NULL").select("user_id", "game_id"), "user_id"), "game_id", "_gb", game_blocks)
    seen = rated.groupBy("_ub", "_gb", "user_id").agg(F.collect_set("game_id").alias("_own"))
    seen = seen.groupBy("_ub", "_gb").agg(F.map_from_entries(F.collect_list(F.struct("user_id", "_own"))).alias("_rated"))
    # Cells are small and their pairs many, so the number of tasks is set and does not follow sizes.
    tasks = min(user_blocks * game_blocks, CELL_TASKS)

    def dealt(side: DataFrame, other: str, blocks: int) -> DataFrame:
        return side.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(tasks, "_ub", "_gb")

    rows = dealt(listed(members, "user_id", "_ub"), "_gb", game_blocks).join(seen.hint("shuffle_hash"), ["_ub", "_gb"], "left")
    rows = rows.select("_ub", "_gb", "_rated", F.explode("user_id").alias("user_id"))
    rows = rows.select("_ub", "_gb", "user_id", F.try_element_at("_rated", F.col("user_id")).alias("_own"))
    cols = dealt(listed(titles, "game_id", "_gb"), "_ub", user_blocks).select("_ub", "_gb", F.explode("game_id").alias("game_id"))
    pairs = rows.join(cols.hint("shuffle_hash"), ["_ub", "_gb"])
    return pairs.where(~F.coalesce(F.array_contains("_own", F.col("game_id")), F.lit(False))).select("user_id", "game_id", F.lit(0.0).alias("rating"))
