"""Streams run twice and batches done again give the batch result."""

import datetime
import glob
import os

from pyspark.sql import DataFrameReader, DataFrameWriter, functions as F

from ludoscope.streaming import feeds

HTML = "<title>T</title><article>text</article>"


def links(spark, rows):
    return spark.createDataFrame(
        [(u, s, HTML, t) for u, s, t in rows], "url string, source string, html string, t string"
    ).select("url", "source", "html", F.col("t").cast("timestamp").alias("ts"))


def test_articles_once_per_source_and_day(spark, tmp_path):
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    first = links(spark, [
        ("u1", "cnn", "2024-01-05 01:00:00"), ("u1", "cnn", "2024-01-05 02:00:00"), ("u1", "nyt", "2024-01-05 03:00:00"),
        ("v/politics/1", "vox", "2024-01-05 01:00:00"), ("v/food", "vox", "2024-01-05 01:00:00")])
    # Next poll: the same link again, the next day's link, and one that lands days late.
    second = links(spark, [
        ("u1", "cnn", "2024-01-05 05:00:00"), ("u1", "cnn", "2024-01-06 00:00:01"), ("old", "cnn", "2024-01-01 00:00:00")])

    def poll():
        feeds.stream_articles(spark, landing, first.schema, out, mark).awaitTermination()
        return sorted((r["source"], str(r["day"]), r["url"]) for r in feeds.read_articles(spark, out).collect())

    first.write.mode("append").parquet(landing)
    assert poll() == [("cnn", "2024-01-05", "u1"), ("nyt", "2024-01-05", "u1"), ("vox", "2024-01-05", "v/politics/1")]
    second.write.mode("append").parquet(landing)
    both = poll()
    assert ("cnn", "2024-01-06", "u1") in both and ("cnn", "2024-01-01", "old") in both and len(both) == 5
    assert poll() == both
    batch = feeds.articles_from(first.unionByName(second)).select("source", "day", "url")
    assert sorted((r[0], str(r[1]), r[2]) for r in batch.collect()) == both
    # A batch that is done again replaces its own folder.
    number = feeds.read_articles(spark, out).where("url = 'old'").select("_metadata.file_path").first()[0].split("batch=")[1].split("/")[0]
    feeds.load_articles_batch(second, int(number), out)
    assert sorted((r["source"], str(r["day"]), r["url"]) for r in feeds.read_articles(spark, out).collect()) == both


def test_recent_links_are_known_without_the_store(spark, tmp_path, monkeypatch):
    """The stream is stopped between batches; its state is read from the checkpoint again."""
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    today = datetime.date.today()
    asked = []
    real = feeds._stored_keys
    monkeypatch.setattr(feeds, "_stored_keys", lambda *a: asked.append(a[3:]) or real(*a))

    def poll(rows):
        links(spark, rows).write.mode("append").parquet(landing)
        feeds.stream_articles(spark, landing, links(spark, rows).schema, out, mark).awaitTermination()
        return sorted((r["source"], r["url"]) for r in feeds.read_articles(spark, out).collect())

    one, two = (f"{today - datetime.timedelta(days=d)} 01:00:00" for d in (0, 1))
    assert poll([("u1", "cnn", one), ("u1", "cnn", one), ("u1", "nyt", one)]) == [("cnn", "u1"), ("nyt", "u1")]
    assert poll([("u1", "cnn", one), ("u2", "cnn", two)]) == [("cnn", "u1"), ("cnn", "u2"), ("nyt", "u1")]
    assert poll([("u2", "cnn", two), ("u1", "nyt", one)]) == [("cnn", "u1"), ("cnn", "u2"), ("nyt", "u1")]
    assert asked == []
    # Days before the horizon are asked for, and only they.
    old = "2020-05-05 00:00:00"
    assert len(poll([("old", "cnn", old), ("u1", "cnn", one)])) == 4
    assert len(poll([("old", "cnn", old)])) == 4
    assert asked[0] == (datetime.date(2020, 5, 5), datetime.date(2020, 5, 5))
    # A link of an old day whose state is gone is found in the store.
    feeds.load_articles_batch(links(spark, [("old", "cnn", old)]), 99, out, "ts", feeds.HORIZON_DAYS)
    assert len(feeds.read_articles(spark, out).collect()) == 4


def test_compaction(spark, tmp_path):
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def poll(*urls):
        rows = links(spark, [(u, "cnn", f"2024-01-0{1 + i % 3} 00:00:00") for i, u in enumerate(urls)])
        rows.write.mode("append").parquet(landing)
        feeds.stream_articles(spark, landing, rows.schema, out, mark).awaitTermination()
        return sorted((r["url"], str(r["day"])) for r in feeds.read_articles(spark, out).collect())

    for k in range(3):
        before = poll(f"a{k}", f"b{k}", f"c{k}")
    last = max(numbers := [int(p.split("batch=")[1]) for p in glob.glob(f"{out}/batch=*")])
    assert feeds.compact_articles(spark, out) == len(numbers) - 1
    assert {int(p.split("batch=")[1]) for p in glob.glob(f"{out}/batch=*")} == {last - 1, last}
    assert poll("a0", "b1") == before
    assert len(poll("a0", "new")) == len(before) + 1
    # One that was cut short after its mark is ended by the next.
    now = sorted(map(str, feeds.read_articles(spark, out).collect()))
    draft = spark.read.parquet(out).where(F.col("batch") <= last).drop("batch")
    draft.write.partitionBy("day").parquet(f"{out}/_compact")
    os.makedirs(f"{out}/_compact_done/{last}")
    feeds.compact_articles(spark, out)
    assert sorted(map(str, feeds.read_articles(spark, out).collect())) == now and not os.path.exists(f"{out}/_compact")


def test_new_games_do_not_read_the_store(spark, tmp_path, monkeypatch):
    landing, store, names, mark = (str(tmp_path / n) for n in ("in", "store", "names", "mark"))
    schema = "game string, game_id string, username string, rating double, comment string"
    users = spark.createDataFrame([(1, "ann")], "user_id long, username string")
    read = []
    real = DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *p, **k: read.append(p[0]) or real(self, *p, **k))

    def load(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(landing)
        read.clear()
        feeds.stream_ratings(spark, landing, spark.createDataFrame([], schema).schema, users, users, store, names, mark).awaitTermination()
        return store in read

    assert not load([("G", "1", "ann", 5.0, None), ("G", "1", None, 6.0, "x"), ("G", "1", None, 7.0, "y")])
    assert not load([("H", "2", "ann", 5.0, None)])
    assert load([("H", "2", "ann", 5.0, None), ("H", "2", "bob", 5.0, None), ("I", "3", "ann", 1.0, None), ("G", "1", None, 8.0, "z")])
    rows = sorted((r["game"], str(r["username"]), r["rating"]) for r in spark.read.parquet(store).collect())
    assert rows == [("G", "None", 6.0), ("G", "None", 7.0), ("G", "ann", 5.0), ("H", "ann", 5.0), ("H", "bob", 5.0), ("I", "ann", 1.0)]


def test_ratings_skip_loaded_games_and_extend_directory(spark, tmp_path):
    landing, store, names, mark = (str(tmp_path / n) for n in ("in", "store", "names", "mark"))
    schema = "game string, game_id string, username string, rating double, comment string"
    users = spark.createDataFrame([(1, "ann")], "user_id long, username string")
    raw = spark.createDataFrame([(1, "ann"), (2, "bob"), (3, "cyd")], "user_id long, username string")

    def load(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(landing)
        feeds.stream_ratings(
            spark, landing, spark.read.parquet(landing).schema, raw, users, store, names, mark).awaitTermination()
        return sorted((r["game"], r["username"], r["user_id"]) for r in spark.read.parquet(store).collect())

    assert load([("G", "1", "ann", 5.0, None), ("G", "1", "bob", 6.0, "x")]) == [("G", "ann", 1), ("G", "bob", 2)]
    both = load([("G", "1", "cyd", 5.0, None), ("H", "2", "dan", 6.0, "x")])
    assert both == [("G", "ann", 1), ("G", "bob", 2), ("G", "cyd", 3), ("H", "dan", None)]
    assert sorted(r["username"] for r in spark.read.parquet(names).collect()) == ["ann", "bob", "cyd"]
    again = spark.createDataFrame([("G", "1", "ann", 5.0, None), ("G", "1", "cyd", 5.0, None), ("H", "2", "dan", 6.0, "x")], schema)
    feeds.load_ratings_batch(again, 1, raw, store, names)
    assert sorted((r["game"], r["username"], r["user_id"]) for r in spark.read.parquet(store).collect()) == both


RATED = "game string, game_id string, username string, rating double, comment string"


def stored_ratings(spark, tmp_path, *batches, raw=((2, "bob"),), users=((1, "ann"),)):
    """The store after the batches, and the user directory."""
    store, names = str(tmp_path / "store"), str(tmp_path / "names")
    raw, users = (spark.createDataFrame(list(r), "user_id long, username string") for r in (raw, users))
    nothing = spark.createDataFrame([], RATED)
    nothing.write.parquet(str(tmp_path / "in"))
    feeds.stream_ratings(spark, str(tmp_path / "in"), nothing.schema, raw, users, store, names, str(tmp_path / "mark")).awaitTermination()
    for number, rows in enumerate(batches):
        feeds.load_ratings_batch(spark.createDataFrame(rows, RATED), number, raw, store, names)
    return store, names


def test_ratings_of_a_batch_are_moved_twice(spark, tmp_path, monkeypatch):
    """By name for the user's id and by bucket for the store, which also says what is loaded."""
    written = {}
    real = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: written.update({path: self._df}) or real(self, path, *a, **k))
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store, _ = stored_ratings(spark, tmp_path, [("G", "1", "ann", 5.0, "x")], [("G", "1", "ann", 5.0, "x"), ("G", "1", "bob", 6.0, "y")])
        node, moves = written[f"{store}/batch=1"]._jdf.queryExecution().executedPlan().initialPlan(), 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    while node.children().size():
        moves += node.getClass().getSimpleName() == "ShuffleExchangeExec"
        node = next(c for c in (node.children().apply(i) for i in range(node.children().size())) if "comment" in c.output().toString())
    assert moves == 2
    assert sorted((r["username"], r["user_id"]) for r in spark.read.parquet(store).collect()) == [("ann", 1), ("bob", 2)]


def test_a_large_bucket_has_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feeds, "FILE_ROWS", 4, raising=False)
    rows = [(f"G{i}", str(i), name, 5.0, None) for i in range(100) for name in ("ann", "bob", None)]
    more = rows + [(f"G{i}", str(i), "cyd", 5.0, None) for i in range(150)]
    store, _ = stored_ratings(spark, tmp_path, rows, more)
    found = spark.read.parquet(store)
    assert found.where("bucket IS NULL").isEmpty()
    assert sorted((r[0], str(r[1])) for r in found.select("game", "username").collect()) == sorted({(r[0], str(r[2])) for r in more})
    held = {tuple(r) for r in found.select("batch", "bucket", "game", F.input_file_name()).collect()}
    assert len({(b, f) for _, b, _, f in held}) > len({(n, b) for n, b, _, _ in held})
    # No game lies in two files of a batch.
    assert len(held) == len({(n, g) for n, _, g, _ in held})


def test_odd_ratings_are_kept_as_they_were(spark, tmp_path):
    """Ratings without a game are never known; equal rows of one batch stay, and a name the directory has twice gives two."""
    none, twice = (None, "0", "ann", 1.0, None), ("G", "1", "bob", 2.0, None)
    store, names = stored_ratings(
        spark, tmp_path, [none, twice, twice, ("H", "2", "dan", 3.0, None)], [none, twice, ("G", "1", "ann", 4.0, None), ("H", "2", "eve", 3.0, None)],
        raw=((2, "bob"), (1, "ann"), (9, "zoe"), (7, "bob"), (5, "eve")), users=((1, "ann"), (3, "ann")))
    rows = sorted((str(r["game"]), r["username"], r["user_id"] or 0) for r in spark.read.parquet(store).collect())
    assert rows == [("G", "ann", 1), ("G", "ann", 3), ("G", "bob", 2), ("G", "bob", 2), ("H", "dan", 0), ("H", "eve", 5)] + [("None", "ann", 1)] * 2 + [("None", "ann", 3)] * 2
    assert sorted((r["username"], r["user_id"], r["batch"]) for r in spark.read.parquet(names).collect()) == [
        ("ann", 1, -1), ("ann", 3, -1), ("bob", 2, 0), ("eve", 5, 1)]
