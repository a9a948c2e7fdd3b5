"""Collaborative filtering with MLlib's ALS (inventory A1-A10)."""

from __future__ import annotations

import itertools
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ludoscope.functions.blocks import best_columns
from ludoscope.functions.scale import salted_lookup, top_per_key, with_position
from ludoscope.session import cut_lineage, delete, shared_dir, stored_at

USERS_PER_BLOCK = 1024
GAMES_PER_BLOCK = 1024
#: Bytes of all games' factors up to which they are sent to every task.
SMALL_FACTORS = 64 << 20
#: Blocks of games a block of users meets in the first round, and how many times more up to the end of each one after.
FIRST_BLOCKS, BLOCK_GROWTH = 4, 8
#: Blocks of users and of games in a fit, and ratings a block holds at most (30 bytes each while it is built).
LEAST_BLOCKS, BLOCK_PAIRS = 10, 25_000_000
#: Bytes of a task's share of memory that a rating of its block takes, the ratings Spark keeps beside it included.
PAIR_BYTES = 64
#: Iterations between checkpoints of a fit: the shuffle files of so many are on disk at a time.
CHECKPOINT_EVERY = 2
#: Users whose reach over all blocks of games is worked out at a time.
REACH_ROWS = 64


def als_blocks(pairs: int, held: int = BLOCK_PAIRS) -> int:
    """Blocks for a fit on so many ratings, of which a task has memory for ``held``.

    In every iteration a factor goes to each block that holds one of its ratings, so more blocks mean more shuffled bytes for the same
    ratings. Their number therefore rises only where a block would get too large for a task.
    """
    return max(LEAST_BLOCKS, -(-pairs // max(1, min(held, BLOCK_PAIRS))))


def task_pairs(spark: SparkSession) -> int:
    """The ratings of a block that a task has memory for, by the smallest executor's memory for blocks and sorts."""
    sc = spark.sparkContext
    members, each = sc._jsc.sc().getExecutorMemoryStatus().iterator(), {}
    while members.hasNext():
        one = members.next()
        each[one._1()] = one._2()._1()
    # Beside executors the driver runs no tasks.
    driver = sc._jvm.org.apache.spark.SparkEnv.get().blockManager().blockManagerId().hostPort()
    sizes = [size for at, size in each.items() if at != driver] or list(each.values())
    cores = max(1, sc.defaultParallelism // len(sizes))
    return max(1, min(sizes) // cores // PAIR_BYTES)


def fit_als(
    train: DataFrame,
    rank: int = 5,
    max_iter: int = 20,
    reg: float = 0.2,
    nonnegative: bool = True,
    seed: int = 1,
    blocks: int | None = None,
    checkpoint_interval: int = CHECKPOINT_EVERY,
) -> ALSModel:
    """A1: explicit-feedback ALS; pairs with an unseen user or game are dropped when scoring.

    By default there are as many blocks of users and of games as ``als_blocks`` gives for the executors' memory.
    """
    shared_dir(train.sparkSession)
    if blocks is None:
        blocks = als_blocks(train.count(), task_pairs(train.sparkSession))
    als = ALS(
        rank=rank, maxIter=max_iter, regParam=reg, nonnegative=nonnegative, seed=seed,
        numUserBlocks=blocks, numItemBlocks=blocks, implicitPrefs=False, alpha=1.0,
        userCol="user_id", itemCol="game_id", ratingCol="rating", coldStartStrategy="drop",
        checkpointInterval=checkpoint_interval,
        intermediateStorageLevel="MEMORY_AND_DISK", finalStorageLevel="MEMORY_AND_DISK",
    )
    return als.fit(train)


def score(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """A2: the predicted rating of each pair the model knows."""
    return model.transform(pairs)


def score_user(model: ALSModel, user_id: int | None, games: DataFrame) -> DataFrame:
    """A2 for one user: the predicted rating of each of ``games``.

    The user's factors are a scalar of the plan, so the games are joined on their own ids only and
    one user's rows never meet in one task. A user the model does not know gets no rows.
    """
    mine = model.userFactors.where(F.col("id") == F.lit(user_id)).select("features").scalar()
    factors = model.itemFactors.select(F.col("id").alias("game_id"), F.col("features").alias("_g"))
    scored = games.join(factors, "game_id").withColumn("_u", mine)
    return scored.withColumn("prediction", _dot("_u", "_g")).where("prediction IS NOT NULL").drop("_u", "_g")


def _dot(a: str, b: str) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def rmse(model: ALSModel, data: DataFrame) -> float | None:
    """A3: root mean squared error over the pairs that can be scored; null if there is none."""
    return score(model, data).agg(F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2)))).first()[0]


def rmse_join(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """A4: the same from two tables joined on the pair."""
    both = actual.select("user_id", "game_id", "rating").join(
        predicted.select("user_id", "game_id", "prediction"), ["user_id", "game_id"]
    )
    return both.agg(F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))).alias("rmse"))


def grid_search(
    train: DataFrame,
    val: DataFrame,
    ranks: Iterable[int] = (5,),
    regs: Iterable[float] = (0.2,),
    iters: Iterable[int] = (20,),
    **als: object,
) -> tuple[ALSModel, DataFrame]:
    """A5: fit every combination, keep the model with the lowest validation error.

    Returns it with the table (rank, reg, max_iter, rmse, best); of equal errors the first is best. ``train`` and ``val`` are stored
    for the length of the search, as every fit reads them and needs the memory itself.
    """
    (train, train_path), (val, val_path) = stored_at(train, "train"), stored_at(val, "val")
    best, best_error, best_row, rows = None, float("inf"), None, []
    for rank, reg, max_iter in itertools.product(ranks, regs, iters):
        model = fit_als(train, rank=rank, reg=reg, max_iter=max_iter, **als)
        error = rmse(model, val)
        rows.append((rank, reg, max_iter, error))
        if best is None or (error is not None and error < best_error):
            best, best_error = model, float("inf") if error is None else error
            best_row = None if error is None else len(rows) - 1
    for path in (train_path, val_path):
        delete(train.sparkSession, path)
    marked = [(*row, i == best_row) for i, row in enumerate(rows)]
    return best, train.sparkSession.createDataFrame(marked, "rank int, reg double, max_iter int, rmse double, best boolean")


def holdout_eval(model: ALSModel, test: DataFrame) -> DataFrame:
    """Pairs in the holdout, pairs scored and the error, from one pass over the scores."""
    pairs = test.agg(F.count(F.lit(1))).scalar()
    error = F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2)))
    return score(model, test).where(F.col("prediction").isNotNull() & F.col("rating").isNotNull()).agg(
        pairs.alias("n_pairs"), F.count(F.lit(1)).alias("n_scored"), error.alias("rmse")
    )


def label_blind_check(model: ALSModel, data: DataFrame) -> DataFrame:
    """Pairs whose prediction changes when the ratings are blanked; none when all is well."""
    shown = score(model, data).select("user_id", "game_id", "prediction")
    blind = score(model, data.withColumn("rating", F.lit(0.0))).select("user_id", "game_id", "prediction")
    return shown.exceptAll(blind)


def rank_predictions(scored: DataFrame) -> DataFrame:
    """Each user's games from the highest prediction down, ``rank`` counting from 1, ties by game."""
    order = [F.col("user_id"), F.col("prediction").desc(), F.col("game_id")]
    placed = with_position(scored, order, "_place")
    lists = placed.groupBy("user_id").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    named = salted_lookup(
        placed, lists.select("user_id", "_first"), "user_id", ["_place"], lists.select("user_id", "_rows"))
    return named.withColumn("rank", F.col("_place") - F.col("_first") + 1).drop(
        "_place", "_first"
    )


def _unit_directions(features: str) -> Column:
    """The direction of a factor in coarse steps: rows that sort together point the same way."""
    norm = F.sqrt(F.aggregate(features, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.transform(features, lambda x: F.floor(8 * x / F.when(norm > 0, norm).otherwise(1.0)))


def _block_extremes(games: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every block of games in order: the largest norm, and the largest and smallest value in each place of the factors.

    Ids of factors are ints, so blocks are half a million at most.
    """

    def extremes(block: pd.DataFrame) -> pd.DataFrame:
        table = np.stack(block["features"]).astype("f8")
        norm = np.sqrt((table * table).sum(axis=1)).max()
        return pd.DataFrame({"gb": [block["gb"].iloc[0]], "norm": [norm], "high": [table.max(axis=0)], "low": [table.min(axis=0)]})

    found = games.groupBy("gb").applyInPandas(extremes, "gb long, norm double, high array<double>, low array<double>").toPandas().sort_values("gb")
    return found["norm"].to_numpy(), np.stack(found["high"]), np.stack(found["low"])


def _reach(users: np.ndarray, norm: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The highest prediction possible of each user (rows) in each block of games (columns).

    No product exceeds that of the norms, nor the sum over places of each value times the block's extreme on its side.
    """
    by_norm = np.sqrt((users * users).sum(axis=1))[:, None] * norm[None, :]
    by_place = np.maximum(users, 0) @ high.T + np.minimum(users, 0) @ low.T
    return np.minimum(by_norm, by_place)


def recommend_all(
    model: ALSModel, ratings: DataFrame, n: int, users: DataFrame | None = None, stats: dict | None = None
) -> DataFrame:
    """The ``n`` best unrated games of every user, or of the given ones: (user_id, game_id, prediction, rank).

    Games are put in blocks from the longest factor down. Once a user's ``n``-th prediction is above the highest possible one of
    a block, the user needs none of its games; the result is that of all products. Factors of games up to ``SMALL_FACTORS``
    bytes go to every task, which takes its users through the blocks and stops when nobody needs more. Beyond that, blocks of
    users, of like direction, meet blocks of games in rounds, the most promising first, and a block of users that
    needs none of a block's games never meets it. ``stats`` receives users, games and scored, the number of predictions worked out.
    """
    user_factors, game_factors = model.userFactors, model.itemFactors
    if users is not None:
        user_factors = user_factors.join(
            users.select(F.col("user_id").alias("id")).distinct(), "id", "left_semi"
        )
    n_games = game_factors.count()
    if 4 * model.rank * n_games <= SMALL_FACTORS:
        return _recommend_small(user_factors, game_factors, ratings, n, stats)
    return _recommend_in_rounds(user_factors, game_factors, ratings, n, stats)


def _slack(floor: np.ndarray) -> np.ndarray:
    """A little below, as sums taken in another order may differ."""
    return floor - 1e-9 * np.maximum(1, np.abs(floor))


def _recommend_small(user_factors: DataFrame, game_factors: DataFrame, ratings: DataFrame, n: int, stats: dict | None) -> DataFrame:
    """``recommend_all`` with the games' factors in every task."""
    spark = user_factors.sparkSession
    table = game_factors.toPandas()
    n_users = user_factors.count()
    schema = "user_id int, game_id int, prediction double, rank int"
    if not len(table) or not n_users:
        return spark.createDataFrame([], schema)
    factors = np.stack(table["features"]).astype("f8")
    norms = np.sqrt((factors * factors).sum(axis=1))
    order = np.lexsort((table["id"].to_numpy(), -norms))
    ids, factors, norms = table["id"].to_numpy()[order], factors[order], norms[order]
    starts = np.arange(0, len(ids), GAMES_PER_BLOCK)
    extremes = norms[starts], np.maximum.reduceat(factors, starts), np.minimum.reduceat(factors, starts)
    sent = spark.sparkContext.broadcast((ids, factors.astype("f4"), extremes))
    blocks, count = max(1, -(-n_users // USERS_PER_BLOCK)), stats is not None

    def block(col: str) -> Column:
        return F.pmod(F.xxhash64(F.col(col).cast("int")), F.lit(blocks)).cast("int").alias("ub")

    def best(cell: pd.DataFrame, seen: pd.DataFrame) -> pd.DataFrame:
        gid, table, (norm, high, low) = sent.value
        if cell.empty:
            return pd.DataFrame({"user_id": [], "game_id": [], "prediction": [], "rank": []})
        cell = cell.sort_values("id")
        uid, users = cell["id"].to_numpy(), np.stack(cell["features"]).astype("f8")
        by_id = np.argsort(gid)
        seen = seen[seen["user_id"].isin(uid) & seen["game_id"].isin(gid)]
        rated_game = by_id[np.searchsorted(gid[by_id], seen["game_id"].to_numpy())]
        rated_user = np.searchsorted(uid, seen["user_id"].to_numpy())
        turn = np.argsort(rated_game, kind="stable")
        rated_game, rated_user = rated_game[turn], rated_user[turn]
        reach = _reach(users, norm, high, low)
        top, named, scored = np.full((len(uid), n), -np.inf), np.full((len(uid), n), np.iinfo("i4").max), 0
        for b, start in enumerate(range(0, len(gid), GAMES_PER_BLOCK)):
            floor = _slack(top[:, -1])
            # Games from here on are no longer than this block's longest.
            if (reach[:, b:].max(axis=1) < floor).all():
                break
            live = np.flatnonzero(reach[:, b] >= floor)
            if not len(live):
                continue
            stop = min(start + GAMES_PER_BLOCK, len(gid))
            scores = users[live] @ table[start:stop].astype("f8").T
            low_seen, high_seen = np.searchsorted(rated_game, [start, stop])
            row = np.searchsorted(live, rated_user[low_seen:high_seen]).clip(max=len(live) - 1)
            held = live[row] == rated_user[low_seen:high_seen]
            scores[row[held], rated_game[low_seen:high_seen][held] - start] = -np.inf
            scored += scores.size
            columns = np.argsort(gid[start:stop])
            rows, cols = best_columns(scores[:, columns], n)
            place = np.arange(len(rows)) - np.searchsorted(rows, np.arange(len(live)))[rows]
            more, more_named = np.full((len(live), n), -np.inf), np.full((len(live), n), np.iinfo("i4").max)
            more[rows, place], more_named[rows, place] = scores[rows, columns[cols]], gid[start:stop][columns[cols]]
            both, both_named = np.hstack([top[live], more]), np.hstack([named[live], more_named])
            keep = np.lexsort((both_named, -both), axis=1)[:, :n]
            top[live], named[live] = np.take_along_axis(both, keep, 1), np.take_along_axis(both_named, keep, 1)
        rows, ranks = np.nonzero(np.isfinite(top))
        out = pd.DataFrame({"user_id": uid[rows], "game_id": named[rows, ranks], "prediction": top[rows, ranks], "rank": ranks + 1})
        # The count travels as a row of rank 0, of several if it is large.
        counts = [min(scored - at, 1 << 30) for at in range(0, scored, 1 << 30)] if count else []
        return pd.concat([out, pd.DataFrame({"user_id": uid[:1].repeat(len(counts)), "game_id": counts, "prediction": np.nan, "rank": 0})]) if counts else out

    members = user_factors.select(block("id"), "id", "features")
    rated = ratings.select(block("user_id"), F.col("user_id").cast("int").alias("user_id"), F.col("game_id").cast("int").alias("game_id")).distinct()
    found = members.groupBy("ub").cogroup(rated.groupBy("ub")).applyInPandas(best, schema)
    if count:
        found = cut_lineage(found)
        stats.update(users=n_users, games=len(ids), scored=found.where("rank = 0").agg(F.sum("game_id")).first()[0] or 0)
        found = found.where("rank > 0")
    return found


def _recommend_in_rounds(user_factors: DataFrame, game_factors: DataFrame, ratings: DataFrame, n: int, stats: dict | None) -> DataFrame:
    """``recommend_all`` with blocks of users and of games that meet in rounds."""
    length = F.aggregate("features", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    games = with_position(game_factors, [length.desc(), F.col("id")], "_place", start=0)
    games = cut_lineage(games.select(F.floor(F.col("_place") / GAMES_PER_BLOCK).cast("long").alias("gb"), "id", "features"))
    members = with_position(user_factors, [_unit_directions("features"), F.col("id")], "_place", start=0)
    members = cut_lineage(members.select(F.floor(F.col("_place") / USERS_PER_BLOCK).cast("long").alias("ub"), "id", "features"))
    n_users, n_games = members.count(), games.count()
    schema = "user_id int, game_id int, prediction double"
    if not n_users or not n_games:
        return members.sparkSession.createDataFrame([], f"{schema}, rank int")
    norm, high, low = _block_extremes(games)

    rated = ratings.select(F.col("user_id").cast("int").alias("user_id"), F.col("game_id").cast("int").alias("game_id")).distinct()
    rated = salted_lookup(rated, members.select(F.col("id").alias("user_id"), "ub"), "user_id", ["game_id"])
    rated = cut_lineage(salted_lookup(rated, games.select(F.col("id").alias("game_id"), "gb"), "game_id", ["user_id"]))

    def next_blocks(start: int, stop: int):
        def choose(block: pd.DataFrame) -> pd.DataFrame:
            users, floors = np.stack(block["features"]).astype("f8"), _slack(block["floor"].to_numpy())
            most, needed = np.full(len(norm), -np.inf), np.zeros(len(norm), bool)
            for at in range(0, len(users), REACH_ROWS):
                reach = _reach(users[at : at + REACH_ROWS], norm, high, low)
                most = np.maximum(most, reach.max(axis=0))
                needed |= (reach >= floors[at : at + REACH_ROWS, None]).any(axis=0)
            order = np.argsort(-most, kind="stable")[start:]
            wanted = needed[order]
            now = order[: stop - start][wanted[: stop - start]].tolist()
            # -1: there are more to come.
            now += [-1] if wanted[stop - start :].any() else []
            return pd.DataFrame({"ub": [block["ub"].iloc[0]] * len(now), "gb": now}, dtype="i8")

        return choose

    def best_in_block(cell: pd.DataFrame, seen: pd.DataFrame) -> pd.DataFrame:
        us = cell[cell["is_user"]]
        gs = cell[~cell["is_user"]].sort_values("id")
        nothing = pd.DataFrame({"user_id": [], "game_id": [], "prediction": [], "scored": []})
        if us.empty or gs.empty:
            return nothing
        gb = int(gs["gb"].iloc[0])
        factors = np.stack(us["features"]).astype("f8")
        live = _reach(factors, norm[gb : gb + 1], high[gb : gb + 1], low[gb : gb + 1])[:, 0] >= _slack(us["floor"].to_numpy())
        us, factors = us[live], factors[live]
        if us.empty:
            return nothing
        order = np.argsort(us["id"].to_numpy())
        uid, floor, factors, gid = us["id"].to_numpy()[order], us["floor"].to_numpy()[order], factors[order], gs["id"].to_numpy()
        scores = factors @ np.stack(gs["features"]).astype("f8").T
        seen = seen[seen["user_id"].isin(uid)]
        scores[np.searchsorted(uid, seen["user_id"]), np.searchsorted(gid, seen["game_id"])] = -np.inf
        rows, cols = best_columns(scores, n)
        value = scores[rows, cols]
        held = np.isfinite(value) & (value >= _slack(floor)[rows])
        picked = pd.DataFrame({"user_id": uid[rows[held]], "game_id": gid[cols[held]], "prediction": value[held]})
        picked["scored"] = 0
        return pd.concat([picked, pd.DataFrame({"user_id": [uid[0]], "game_id": [gid[0]], "prediction": [np.nan], "scored": [scores.size]})])

    best, start, stop, scored = None, 0, FIRST_BLOCKS, 0
    while True:
        floor = F.lit(float("-inf"))
        if best is not None:
            floors = best.where(F.col("rank") == n).select(F.col("user_id").alias("id"), F.col("prediction").alias("_floor"))
            held = members.join(floors, "id", "left").select("ub", "id", "features", F.coalesce("_floor", floor).alias("floor"))
        else:
            held = members.withColumn("floor", floor)
        held = cut_lineage(held)
        chosen = cut_lineage(held.groupBy("ub").applyInPandas(next_blocks(start, stop), "ub long, gb long"))
        pairs = chosen.where("gb >= 0")
        both = held.join(pairs, "ub").select("ub", "gb", F.lit(True).alias("is_user"), "id", "features", "floor").unionByName(
            games.join(pairs, "gb").select("ub", "gb", F.lit(False).alias("is_user"), "id", "features", floor.alias("floor")))
        between = rated.join(pairs, ["ub", "gb"], "left_semi").select("user_id", "game_id", F.col("ub").alias("to_ub"), F.col("gb").alias("to_gb"))
        found = both.groupBy("ub", "gb").cogroup(between.groupBy("to_ub", "to_gb")).applyInPandas(best_in_block, f"{schema}, scored long")
        if stats is not None:
            found = cut_lineage(found)
            scored += found.agg(F.sum("scored")).first()[0] or 0
        found = found.where("scored = 0").drop("scored")
        found = found if best is None else found.unionByName(best.drop("rank"))
        best = cut_lineage(top_per_key(found, ["user_id"], [F.col("prediction").desc(), F.col("game_id")], n, "rank"))
        if chosen.where("gb < 0").isEmpty():
            break
        start, stop = stop, stop * BLOCK_GROWTH
    if stats is not None:
        stats.update(users=n_users, games=n_games, scored=scored)
    return best


def attach_labels(scored: DataFrame, labeled: DataFrame) -> DataFrame:
    """A10: the labelled game's columns on each scored pair; games without labels drop out."""
    games = labeled.withColumn("game_id", F.col("game_id").cast("int"))
    pairs = scored.drop("rating").withColumn("game_id", F.col("game_id").cast("int"))
    return pairs.join(games, "game_id")


def dot_products(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """A2 from the stored factors: the predicted rating as the dot product of user and game factors."""
    users = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("_u"))
    games = model.itemFactors.select(F.col("id").alias("game_id"), F.col("features").alias("_g"))
    return (
        pairs.join(users, "user_id")
        .join(games, "game_id")
        .withColumn("prediction", _dot("_u", "_g"))
        .drop("_u", "_g")
    )


def save_model(model: ALSModel, path: str) -> None:
    """Store the model, replacing an earlier one."""
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    """Load a stored model."""
    return ALSModel.load(path)

