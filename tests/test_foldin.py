"""Folding in against a solver that tries every set of free places, and what it leaves alone."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludoscope.operators import collab, foldin
from ludoscope.plans.recommend import refresh_changed
from ludoscope.session import cut_lineage


def best_of_all(a, b):
    """The bounded minimum: of all choices of free places, the feasible one with the lowest value."""
    k, best = len(b), (0.0, np.zeros(len(b)))
    for size in range(1, k + 1):
        for free in map(list, itertools.combinations(range(k), size)):
            x = np.zeros(k)
            x[free] = np.linalg.solve(a[np.ix_(free, free)], b[free])
            if (x >= 0).all():
                best = min(best, (x @ a @ x - 2 * b @ x, x), key=lambda t: t[0])
    return best[1]


@pytest.mark.parametrize("k", [1, 2, 4, 6])
def test_solver(k):
    rng = np.random.default_rng(k)
    m = rng.normal(size=(50, k + 3, k))
    a, b = np.einsum("nij,nik->njk", m, m) + 0.1 * np.eye(k), rng.normal(size=(50, k)) * 5
    got = foldin.solve(a, b, True)
    assert np.allclose(got, [best_of_all(x, y) for x, y in zip(a, b)], atol=1e-7)
    assert np.allclose(np.einsum("njk,nk->nj", a, foldin.solve(a, b, False)), b)


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(3)
    rows = [(u, g, float(rng.integers(1, 11))) for u in range(40) for g in range(30) if rng.random() < 0.4]
    ratings = cut_lineage(spark.createDataFrame(rows, "user_id int, game_id int, rating double"))
    return ratings, collab.fit_als(ratings, rank=3, max_iter=8)


def test_changed_ids_get_the_solution_and_others_stay(spark, fitted, tmp_path):
    ratings, model = fitted
    new = spark.createDataFrame([(3, 5, 9.0), (77, 5, 8.0), (77, 6, 2.0), (3, 99, 4.0), (88, 999, 1.0), (3, 7, None)], ratings.schema)
    every = ratings.join(new.select("user_id", "game_id"), ["user_id", "game_id"], "left_anti").unionByName(new)
    changed, moved, again = refresh_changed(model, every, new, str(tmp_path / "m"), most_drift=10.0)
    assert not again and 0 < moved < 10
    old_users, old_games = ({r["id"]: np.array(r["features"]) for r in f.collect()} for f in (model.userFactors, model.itemFactors))
    users, games = ({r["id"]: np.array(r["features"]) for r in f.collect()} for f in (changed.userFactors, changed.itemFactors))
    touched_users, touched_games = {3, 77, 88}, {5, 6, 7, 99, 999}
    assert all((users[u] == old_users[u]).all() for u in set(old_users) - touched_users)
    assert all((games[g] == old_games[g]).all() for g in set(old_games) - touched_games)
    rows = [r for r in every.collect() if r["rating"] is not None]

    def solution(own, side, other, factors):
        mine = [(factors[r[other]], r["rating"]) for r in rows if r[side] == own and r[other] in factors]
        a = sum(np.outer(f, f) for f, _ in mine) + 0.2 * len(mine) * np.eye(3)
        return best_of_all(a, sum(f * v for f, v in mine))

    for u in (3, 77):
        assert np.allclose(users[u], solution(u, "user_id", "game_id", old_games), atol=1e-4)
    for g in (5, 6, 99):
        assert np.allclose(games[g], solution(g, "game_id", "user_id", users), atol=1e-4)
    # Nobody with a factor has rated the game 999, so neither it nor its user has one.
    assert 88 not in users and 999 not in games
    # The result is a model like any other.
    assert collab.score(changed, spark.createDataFrame([(77, 5, 0.0)], ratings.schema)).count() == 1


def test_a_large_drift_fits_anew(spark, fitted, tmp_path):
    ratings, model = fitted
    other = ratings.withColumn("rating", 11 - F.col("rating"))
    changed, moved, again = refresh_changed(model, other, other, str(tmp_path / "m"), most_drift=1e-6, max_iter=3)
    assert again and moved > 1e-6 and changed.rank == 3


def test_a_hot_user_and_no_change(spark, fitted, tmp_path):
    ratings, model = fitted
    changed, moved, again = refresh_changed(model, ratings, ratings.limit(0), str(tmp_path / "m"))
    assert (moved, again) == (0.0, False) and changed.userFactors.count() == model.userFactors.count()
