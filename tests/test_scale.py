"""Helpers that spread hot keys and global orders."""

import pytest
from pyspark.sql import functions as F

from ludoscope.functions import scale
from ludoscope.operators import collab, ratings as rating_ops, serve
from ludoscope.plans import recommend


def test_position_is_total_order(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("v")).repartition(7)
    rows = scale.with_position(df, [F.col("v").desc()], "p", start=1).collect()
    assert sorted((r["p"], r["v"]) for r in rows) == [(i + 1, 999 - i) for i in range(1000)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_lookup_with_hot_key(spark, how):
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    dims = spark.range(1500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = scale.salted_lookup(facts, dims, "k", ["id"], how=how).select("id", "k", "v")
    want = facts.join(dims, "k", how).select("id", "k", "v")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    salted = scale.hot_keys(facts.groupBy("k").agg(F.count("*").alias("_rows")), "k").collect()
    assert [r["k"] for r in salted] == [0]


def test_salted_lookup_keeps_rows_without_key(spark):
    facts = spark.range(100).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"))
    dims = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    got = scale.salted_lookup(facts, dims, "k", ["id"], how="left")
    assert got.count() == 100 and got.where("v is null").count() == 50


def test_salted_lookup_on_empty(spark):
    facts = spark.createDataFrame([], "id long, k long")
    dims = spark.createDataFrame([(1, 2)], "k long, v long")
    assert scale.salted_lookup(facts, dims, "k", ["id"]).count() == 0


def test_product_gives_every_pair_once(spark):
    a = spark.range(37).withColumnRenamed("id", "a")
    b = spark.range(53).withColumnRenamed("id", "b")
    pairs = scale.product(a, "a", b, "b", 5, 3).collect()
    assert len(pairs) == 37 * 53 == len({(r["a"], r["b"]) for r in pairs})


def test_one_served_request_reads_one_users_ratings(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ratings")
    rows = [(u, g, float((u * g) % 5 + 1)) for u in range(6) for g in range(12) if (u + g) % 3]
    spark.createDataFrame(rows, "user_id int, game_id int, rating double").write.parquet(path)
    ratings = spark.read.parquet(path)
    model = collab.fit_als(ratings, rank=2, max_iter=2)
    users = spark.createDataFrame([(4, "ann")], "user_id int, username string")
    labeled = spark.createDataFrame(
        [(g, f"game {g}", 60, 1, 4, 2, 1.5, g + 1, g % 9 + 1) for g in range(12)],
        "game_id int, game string, playing_time int, min_players int, max_players int, best_num_players int, avg_weight double, rank int, topic int")
    served = recommend.recommend_for_user(model, ratings, users, labeled, "ann")
    assert sorted(r["game_id"] for r in served.collect()) == [g for g in range(12) if (4 + g) % 3 == 0]
    assert recommend.recommend_for_user(model, ratings, users, labeled, "nobody").count() == 0
    # Without the stored step in between the plan shows all that is read.
    monkeypatch.setattr(recommend, "cut_lineage", lambda df: df)
    plan = recommend.recommend_for_user(model, ratings, users, labeled, "ann")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
    assert scans and all("EqualTo(user_id,4)" in line and "rating:" not in line.split("ReadSchema")[1] for line in scans)


def test_diversified_list_is_evaluated_once(spark, tmp_path):
    path = str(tmp_path / "ranked")
    spark.createDataFrame([(g, g % 3 + 1, g + 1) for g in range(9)], "game_id int, topic int, rank int").write.parquet(path)
    found = serve.diversify(spark.read.parquet(path))
    assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString()
    assert [r["game_id"] for r in found.orderBy("place").collect()][:4] == [0, 1, 2, 3]


def test_errors_without_pairs_to_score(spark):
    rows = [(u, g, 3.0) for u in range(3) for g in range(3)]
    ratings = spark.createDataFrame(rows, "user_id int, game_id int, rating double")
    other = spark.createDataFrame([(9, 9, 1.0)], "user_id int, game_id int, rating double")
    model, table = collab.grid_search(ratings, other, ranks=[2], regs=[0.2], iters=[1])
    assert model is not None and [r["rmse"] for r in table.collect()] == [None]


def test_unrated_pairs_of_several_cells_are_made_behind_the_last_shuffle(spark, monkeypatch):
    monkeypatch.setattr(rating_ops, "CELL_SIDE", 3)
    rated = [(u, g, 1.0) for u in range(7) for g in range(9) if (u * 5 + g) % 4 == 0] + [(1, None, 1.0), (None, 2, 1.0)]
    ratings = spark.createDataFrame(rated + rated[:5], "user_id int, game_id int, rating double")
    users = spark.createDataFrame([(u,) for u in (*range(8), 3, None)], "user_id int")
    found = rating_ops.unrated_all(ratings, users)
    held = {(u, g) for u, g, _ in rated if u is not None and g is not None}
    games = {g for _, g, _ in rated}
    expected = [(u, g) for u in (*range(8), None) for g in games if (u, g) not in held]
    key = lambda p: tuple(-1 if x is None else x for x in p)
    assert sorted(((r["user_id"], r["game_id"]) for r in found.collect()), key=key) == sorted(expected, key=key)
    # Sizes of plans do not tell how many copies a list becomes; the pairs themselves are not shuffled.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [_ub" in plan and "BroadcastHashJoin [_ub" not in plan and "LeftAnti" not in plan


def test_blocks_of_a_fit_rise_with_what_a_block_holds_only():
    assert [collab.als_blocks(n) for n in (0, 600_000, 36_000_000, 216_000_000)] == [10] * 4
    assert collab.als_blocks(10_000_000_000) * collab.BLOCK_PAIRS >= 10_000_000_000
