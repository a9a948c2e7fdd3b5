"""What jobs leave on disk, and what a task has to hold."""

from pyspark.sql import functions as F

from ludoscope import session
from ludoscope.operators import bounded, collab


def _shuffle_mb(spark) -> float:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")) / 1e6


def _wide(spark):
    rows = spark.range(200_000).select("id", F.md5(F.col("id").cast("string")).alias("v"))
    return rows.repartition(3, "v")


def test_stored_steps_leave_no_shuffle_files(spark):
    before = _shuffle_mb(spark)
    kept = [session.cut_lineage(_wide(spark)), session.stored(_wide(spark), "rows"), session.cut_lineage(_wide(spark), keep_partitioning=True)]
    assert _shuffle_mb(spark) - before < 2 and [k.count() for k in kept] == [200_000] * 3
    assert spark.conf.get(session.SHUFFLES_END, None) in (None, "false")


def test_a_search_stores_its_parts_once_and_deletes_them(spark, monkeypatch):
    paths, gone = [], []
    stored_at, delete = collab.stored_at, collab.delete
    monkeypatch.setattr(collab, "stored_at", lambda df, name: paths.append(stored_at(df, name)) or paths[-1])
    monkeypatch.setattr(collab, "delete", lambda s, path: gone.append(path) or delete(s, path))
    rows = [(u, g, float((u * g) % 5 + 1)) for u in range(6) for g in range(8)]
    ratings = spark.createDataFrame(rows, "user_id int, game_id int, rating double")
    _, table = collab.grid_search(ratings, ratings, ranks=[2], regs=[0.2, 0.5], iters=[2])
    assert table.where("best").count() == 1 and gone == [path for _, path in paths] and len(gone) == 2


class _Fit:
    def __init__(self, **given):
        self.given = given

    def fit(self, train):
        return self.given


def test_a_fit_keeps_few_iterations_on_disk(spark, monkeypatch):
    monkeypatch.setattr(collab, "ALS", _Fit)
    ratings = spark.createDataFrame([(1, 1, 1.0)], "user_id int, game_id int, rating double")
    assert 1 <= collab.fit_als(ratings)["checkpointInterval"] <= 3


def test_blocks_of_a_fit_follow_the_memory_of_a_task(spark, monkeypatch):
    assert collab.als_blocks(216_000_000, 12_000_000) == 18 and collab.als_blocks(30, 0) == 30
    assert 0 < collab.task_pairs(spark) < 8 << 30
    monkeypatch.setattr(collab, "ALS", _Fit)
    monkeypatch.setattr(collab, "task_pairs", lambda s: 3)
    ratings = spark.range(60).selectExpr("cast(id as int) user_id", "cast(id as int) game_id", "1.0D rating")
    assert collab.fit_als(ratings)["numUserBlocks"] == collab.fit_als(ratings)["numItemBlocks"] == 20


def test_reach_is_worked_out_in_slices(spark, monkeypatch):
    monkeypatch.setattr(collab, "SMALL_FACTORS", 0)
    monkeypatch.setattr(collab, "USERS_PER_BLOCK", 16)
    monkeypatch.setattr(collab, "GAMES_PER_BLOCK", 4)
    monkeypatch.setattr(collab, "REACH_ROWS", 5)
    rows = [(u, g, float((u * 7 + g * 3) % 5 + 1)) for u in range(24) for g in range(30) if (u + g) % 3]
    ratings = spark.createDataFrame(rows, "user_id int, game_id int, rating double")
    model = collab.fit_als(ratings, rank=2, max_iter=2)
    found = collab.recommend_all(model, ratings, 3)
    monkeypatch.setattr(collab, "REACH_ROWS", 1 << 30)
    whole = collab.recommend_all(model, ratings, 3)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect())) and found.count() == 72


def test_a_search_for_partners_keeps_one_step_on_disk(spark, monkeypatch):
    made, gone = [], []
    stored_at, delete = bounded.stored_at, bounded.delete
    monkeypatch.setattr(bounded, "stored_at", lambda df, name: made.append(stored_at(df, name)) or made[-1])
    monkeypatch.setattr(bounded, "delete", lambda s, path: gone.append(path) or delete(s, path))
    monkeypatch.setattr(bounded, "SHIPMENTS", 1)
    rows = spark.range(90).selectExpr("id key", "array(id % 7, 10 + id % 5) terms", "array(1.0D, 0.5D) weights")
    before = _shuffle_mb(spark)
    found = bounded.best_partners(rows, 3, lambda dot, a, b: dot, lambda dot, a, b: dot, 5, [F.col("key")])
    assert found.best.count() == 270
    assert len(made) > 2 and gone == [path for _, path in made[:-1]] and _shuffle_mb(spark) - before < 0.5
