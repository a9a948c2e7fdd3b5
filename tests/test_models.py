"""Models and clusterings against plain computations of the same thing."""

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ludoscope import fixtures as fx, schemas
from ludoscope.operators import clusters, collab, serve, topics
from ludoscope.plans.recommend import recommend_for_user
from ludoscope.session import cut_lineage


@pytest.fixture(scope="module")
def rated(spark, sf):
    ratings = cut_lineage(fx.ratings(spark, sf))
    # Someone who rated nearly everything, and a game nearly everyone rated.
    heavy = ratings.select("game_id").distinct().where("game_id % 20 <> 0").select(
        F.lit(9000).alias("user_id"), "game_id", F.lit(5.0).alias("rating"))
    ratings = cut_lineage(ratings.unionByName(heavy).dropDuplicates(["user_id", "game_id"]))
    return ratings, collab.fit_als(ratings, max_iter=3)


@pytest.mark.parametrize("blocks, small", [((16, 32), 0), ((16, 32), 1 << 20), ((1024, 4096), 1 << 20)])
def test_recommend_all_matches_scoring_every_pair(spark, rated, monkeypatch, blocks, small):
    ratings, model = rated
    monkeypatch.setattr(collab, "SMALL_FACTORS", small)
    monkeypatch.setattr(collab, "USERS_PER_BLOCK", blocks[0])
    monkeypatch.setattr(collab, "GAMES_PER_BLOCK", blocks[1])
    got = {(r["user_id"], r["rank"]): r["prediction"] for r in collab.recommend_all(model, ratings, 15).collect()}
    seen = {(r["user_id"], r["game_id"]) for r in ratings.collect()}
    users = {r["id"]: np.array(r["features"], "f8") for r in model.userFactors.collect()}
    games = sorted((r["id"], np.array(r["features"], "f8")) for r in model.itemFactors.collect())
    n = 0
    for u, f in users.items():
        scores = sorted((float(f @ g) for i, g in games if (u, i) not in seen), reverse=True)[:15]
        n += len(scores)
        assert [round(got[u, i + 1], 6) for i in range(len(scores))] == [round(s, 6) for s in scores]
    assert n == len(got)


class Factors:
    """A model of given factors."""

    def __init__(self, spark, users, games):
        kind = "id int, features array<float>"
        self.rank = len(games[0])
        self.userFactors = spark.createDataFrame([(i, list(map(float, f))) for i, f in enumerate(users)], kind)
        self.itemFactors = spark.createDataFrame([(i, list(map(float, f))) for i, f in enumerate(games)], kind)


@pytest.mark.parametrize("small", [0, 1 << 20])
@pytest.mark.parametrize("signed", [False, True])
def test_recommend_all_stops_early_and_is_exact(spark, monkeypatch, signed, small):
    """Games of very different lengths: most are never scored; equal games and zero factors have ties."""
    monkeypatch.setattr(collab, "SMALL_FACTORS", small)
    monkeypatch.setattr(collab, "USERS_PER_BLOCK", 8)
    monkeypatch.setattr(collab, "GAMES_PER_BLOCK", 10)
    monkeypatch.setattr(collab, "FIRST_BLOCKS", 2)
    rng = np.random.default_rng(2)
    users = rng.random((40, 4)) - (0.5 if signed else 0)
    games = (rng.random((300, 4)) - (0.5 if signed else 0)) * rng.pareto(2, 300)[:, None]
    games[100:120], users[:2], games[:3] = games[99], 0, 0
    users, games = users.astype("f4").astype("f8"), games.astype("f4").astype("f8")
    # User 5 has rated nearly everything, user 6 all.
    seen = {(5, g) for g in range(297)} | {(6, g) for g in range(300)} | {(u, g) for u in range(40) for g in rng.choice(300, 5).tolist()}
    ratings = spark.createDataFrame([(u, g, 1.0) for u, g in seen], "user_id int, game_id int, rating double")
    stats, got = {}, {}
    for r in collab.recommend_all(Factors(spark, users, games), ratings, 6, stats=stats).collect():
        got.setdefault(r["user_id"], {})[r["rank"]] = (r["game_id"], round(r["prediction"], 9))
    for u in range(40):
        scores = [(-round(float(users[u] @ games[g]), 9), g) for g in range(300) if (u, g) not in seen]
        assert [got.get(u, {}).get(i + 1) for i in range(min(6, len(scores)))] == [(g, -s) for s, g in sorted(scores)[:6]]
    assert 6 not in got and len(got[5]) == 3
    assert stats["users"] == 40 and stats["games"] == 300 and stats["scored"] < 40 * 300 / 2


def test_recommend_all_without_factors(spark):
    ratings = spark.createDataFrame([], "user_id int, game_id int, rating double")
    none = Factors(spark, np.zeros((0, 2)), np.ones((3, 2)))
    assert collab.recommend_all(none, ratings, 5).collect() == []


def test_recommend_chosen_users(spark, rated):
    ratings, model = rated
    chosen = spark.createDataFrame([(3,), (9000,), (123456,)], "user_id int")
    recs = collab.recommend_all(model, ratings, 4, chosen)
    assert {r["user_id"] for r in recs.collect()} == {3, 9000}


def test_unknown_name_is_served_nothing(spark, sf, rated):
    ratings, model = rated
    served = recommend_for_user(model, ratings, fx.users(spark, sf), fx.labeled(spark, sf), "nobody")
    assert served.count() == 0


def test_served_list_is_the_diversified_list(spark, sf, rated):
    ratings, model = rated
    served = [r["game_id"] for r in recommend_for_user(
        model, ratings, fx.users(spark, sf), fx.labeled(spark, sf), "Customer#000000005").collect()]
    pairs = ratings.select("game_id").distinct().join(
        ratings.where("user_id = 5").select("game_id"), "game_id", "left_anti").withColumn("user_id", F.lit(5))
    games = serve.filter_players(fx.labeled(spark, sf), [])
    listed = collab.rank_predictions(collab.score(model, pairs).join(games, "game_id"))
    places = serve.diversify(listed).orderBy("place").limit(20)
    assert served == [r["game_id"] for r in places.collect()]


def test_search_keeps_the_lowest_error(spark, rated):
    ratings, _ = rated
    best, table = collab.grid_search(ratings, ratings, [1, 3], [0.1], [2])
    rows = table.collect()
    assert sum(r["best"] for r in rows) == 1
    assert best.rank == min(rows, key=lambda r: r["rmse"])["rank"]


def test_nmf_against_dense_updates(spark):
    rng = np.random.default_rng(5)
    v = rng.random((30, 12)) * (rng.random((30, 12)) < 0.4)
    v[:, 0] = rng.random(30)  # a column every row holds
    cells = spark.createDataFrame(
        [(int(i), int(j), float(v[i, j])) for i, j in zip(*v.nonzero())], "row int, col int, value double")
    k, scale = 4, np.sqrt(v.sum() / ((v.sum(1) > 0).sum() * (v.sum(0) > 0).sum()) / 4)

    def start(key, n):
        ids = spark.range(n).select(F.col("id").cast("int").alias(key))
        rows = topics.start_factor(ids, key, k, 34, F.lit(float(scale))).orderBy(key).collect()
        return np.array([r["f"] for r in rows])

    w, h = start("row", 30), start("col", 12).T
    for _ in range(3):
        h *= (w.T @ v) / (w.T @ w @ h + 0.1 * h + topics.TINY)
        w *= (v @ h.T) / (w @ (h @ h.T) + 0.1 * w + topics.TINY)
    found = topics.nmf(cells, k, iters=3, alpha=0.1)
    got = np.array([r["f"] for r in found.w.orderBy("row").collect()])
    assert np.allclose(got, w[v.sum(1) > 0], atol=1e-9)
    assert topics.nmf_error(cells, found) == pytest.approx(np.linalg.norm(v - w @ h), rel=1e-9)
    metrics = topics.nmf_metrics(cells, found)
    x = w @ h
    assert metrics["kl"] == pytest.approx(np.where(v > 0, v * np.log(np.where(v > 0, v, 1) / x), 0).sum() - v.sum() + x.sum())
    assert metrics["evar"] == pytest.approx(1 - ((v - x) ** 2).sum() / (v ** 2).sum())


def test_nmf_error_falls(spark, sf):
    cells = cut_lineage(fx.attrs(spark, sf).select(
        F.col("game_id").alias("row"), F.col("name").alias("col"), F.lit(1.0).alias("value")))
    placed = topics.Placed.of(cells)
    errors = [topics.nmf_error(cells, topics.nmf(placed, 3, iters=i)) for i in (1, 3)]
    assert errors[1] <= errors[0]


@pytest.mark.parametrize("init", ["Cao", "Huang"])
def test_kmodes_cost_falls_and_groups_equal_sets(spark, sf, init):
    games, attrs = fx.games(spark, sf), fx.attrs(spark, sf)
    found = clusters.kmodes(games, attrs, 5, init)
    assert all(a > b for a, b in zip(found.costs, found.costs[1:]))
    assert found.labels.count() == games.count() and found.n_iter == len(found.costs)
    sets = clusters.attribute_sets(games, attrs).join(found.labels, "game_id")
    assert sets.groupBy("terms").agg(F.count_distinct("cluster").alias("n")).where("n > 1").count() == 0


def test_kmodes_with_fewer_sets_than_clusters(spark):
    games = spark.createDataFrame([(i,) for i in range(6)], "game_id int")
    attrs = spark.createDataFrame(
        [(i, "m", f"n{i % 2 * 70 + j}") for i in range(5) for j in range(70)], "game_id int, kind string, name string")
    found = clusters.kmodes(games, attrs, 5)
    assert found.cost == 0 and found.labels.select("cluster").distinct().count() == 3


def test_silhouette_equals_mllib(spark, sf):
    attrs, labels = fx.attrs(spark, sf), fx.topics(spark, sf)
    named = attrs.withColumn("name", F.concat_ws("|", "kind", "name"))
    names = [r["name"] for r in named.select("name").distinct().orderBy("name").collect()]
    wide = named.groupBy("game_id").pivot("name", names).agg(F.lit(1.0)).na.fill(0.0).join(labels, "game_id")
    vectors = wide.select(array_to_vector(F.array(*[F.col(f"`{n}`") for n in names])).alias("features"), "topic")
    want = ClusteringEvaluator(predictionCol="topic", metricName="silhouette").evaluate(vectors)
    assert clusters.silhouette(attrs, labels, "topic").first()[0] == pytest.approx(want, abs=1e-9)


def test_silhouette_of_lone_members(spark):
    attrs = spark.createDataFrame([(1, "m", "a"), (2, "m", "a"), (3, "m", "b")], "game_id int, kind string, name string")
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 2)], "game_id int, cluster int")
    got = {r["game_id"]: r["silhouette"] for r in clusters.silhouette_samples(attrs, labels).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 0.0, 4: 0.0}


def test_const_schema(spark):
    assert spark.createDataFrame([], schemas.RATINGS).columns == ["user_id", "game_id", "rating"]


def test_vcol_start_and_consensus_against_numpy(spark):
    rng = np.random.default_rng(4)
    v = (rng.random((30, 12)) < 0.4) * rng.random((30, 12))
    v[:, 0] = 1.0
    cells = spark.createDataFrame([(int(r), int(c), float(v[r, c])) for r, c in zip(*v.nonzero())], "row int, col int, value double")
    start = {r["row"]: r["f"] for r in topics.vcol_start(cells, "row", "col", 3, 7).collect()}
    import hashlib

    for i in range(3):
        drawn = [c for c in range(12) if int(hashlib.md5(f"vcol7|{c}|{i}".encode()).hexdigest()[:6], 16) / (1 << 24) < 0.2] or list(range(12))
        assert np.allclose([start[r][i] for r in range(30)], v[:, drawn].mean(axis=1))
    found = topics.nmf(cells, 3, iters=5, start="vcol")
    w, h = (np.array([r["f"] for r in f.orderBy(k).collect()]) for f, k in ((found.w, "row"), (found.h, "col")))
    assert (w >= 0).all() and (h >= 0).all() and topics.nmf_error(cells, found) == pytest.approx(np.linalg.norm(v - w @ h.T), rel=1e-6)

    labels = rng.integers(0, 3, (4, 50))
    labels[1] = labels[0]
    rows = [(int(r), run, int(t)) for run in range(4) for r, t in enumerate(labels[run])]
    got = topics.consensus_dispersion(spark.createDataFrame(rows, "row int, run int, topic int")).first()
    c = np.mean([a[:, None] == a[None] for a in labels], axis=0)
    assert (got["n"], got["runs"]) == (50, 4) and got["dispersion"] == pytest.approx((4 * (c - 0.5) ** 2).mean())
    one = topics.nmf_consensus(cells, 2, 2, iters=2).first()
    assert one["k"] == 2 and 0 <= one["dispersion"] <= 1


def test_a_sweep_packs_its_cells_once(spark, monkeypatch):
    cells = cut_lineage(spark.createDataFrame([(i, i * j % 7, 1.0 + i % 3) for i in range(12) for j in range(1, 4)], "row long, col long, value double").distinct())
    packed, whole = [], topics._stripes
    monkeypatch.setattr(topics, "_stripes", lambda *a: packed.append(a) or whole(*a))
    got = {r["k"]: r for r in topics.nmf_sweep(cells, [2, 3], iters=1).collect()}
    assert len(packed) == 2
    for k in (2, 3):
        assert got[k]["error"] == pytest.approx(topics.nmf_error(cells, topics.nmf(cells, k, iters=1)), rel=1e-9)
