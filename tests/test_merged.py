"""Merges of the stored table: what they touch, what a failure leaves, what readers see."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from ludoscope.sources import merged
from ludoscope.sources.tables import update_where, upsert


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(500).select(F.col("id").alias("game_id"), F.concat(F.lit("g"), "id").alias("game"), (F.col("id") % 7).alias("time"))
    merged.create_merged(rows, path, "game_id", 16)
    return path, rows


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/data/*/*/*.parquet")}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_equals_the_join(spark, table):
    path, rows = table
    updates = spark.createDataFrame([(3, None, "yes"), (1000, 5, "yes"), (77, 9, None)], "game_id long, time long, seen string")
    merged.merge_upsert(spark, path, updates)
    assert rows_of(merged.read_merged(spark, path)) == rows_of(upsert(rows, updates, "game_id"))
    # A second merge, on a table whose buckets have different columns.
    more = spark.createDataFrame([(4, "four"), (1000, "new")], "game_id long, game string")
    merged.merge_upsert(spark, path, more)
    assert rows_of(merged.read_merged(spark, path)) == rows_of(upsert(upsert(rows, updates, "game_id"), more, "game_id"))
    assert rows_of(merged.read_merged(spark, path, version=0)) == rows_of(rows)


def test_update_where(spark, table):
    path, rows = table
    mapping = spark.createDataFrame([(3, 100), (9999, 1)], "game_id long, time long")
    merged.merge_update(spark, path, mapping, "time")
    assert rows_of(merged.read_merged(spark, path)) == rows_of(update_where(rows, mapping, "game_id", "time"))


def test_other_buckets_keep_their_files(spark, table):
    path, _ = table
    before, old = files(path), merged.listing(spark, path)
    time.sleep(0.02)
    merged.merge_upsert(spark, path, spark.createDataFrame([(3, 1)], "game_id long, time long"))
    after, new = files(path), merged.listing(spark, path)
    assert {f: t for f, t in after.items() if f in before} == before
    changed = {b for b in new.folders if new.folders[b] != old.folders.get(b)}
    assert len(changed) == 1 and {f.split("_bucket=")[1].split("/")[0] for f in set(after) - set(before)} == {str(b) for b in changed}


def test_a_failed_merge_leaves_the_old_state(spark, table, monkeypatch):
    path, rows = table
    broken = spark.createDataFrame([(3, 1)], "game_id long, time long").withColumn("time", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception):
        merged.merge_upsert(spark, path, broken)
    # All is written, but the commit fails.
    real = merged._commit
    monkeypatch.setattr(merged, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        merged.merge_upsert(spark, path, spark.createDataFrame([(3, 1)], "game_id long, time long"))
    monkeypatch.setattr(merged, "_commit", real)
    assert rows_of(merged.read_merged(spark, path)) == rows_of(rows)
    assert merged.vacuum(spark, path) >= 1
    assert rows_of(merged.read_merged(spark, path)) == rows_of(rows)
    merged.merge_upsert(spark, path, spark.createDataFrame([(3, 1)], "game_id long, time long"))
    assert merged.read_merged(spark, path, keys=[3]).first()["time"] == 1


def test_two_merges_cannot_both_commit(spark, table, monkeypatch):
    path, rows = table
    first = merged.listing(spark, path)
    merged.merge_upsert(spark, path, spark.createDataFrame([(3, 1)], "game_id long, time long"))
    monkeypatch.setattr(merged, "listing", lambda *a, **k: first)
    with pytest.raises(merged.MergeConflict):
        merged.merge_upsert(spark, path, spark.createDataFrame([(4, 1)], "game_id long, time long"))
    monkeypatch.undo()
    assert merged.listing(spark, path).version == 1
    assert {r["game_id"]: r["time"] for r in merged.read_merged(spark, path, keys=[3, 4]).collect()} == {3: 1, 4: 4}


def test_one_key_reads_one_bucket(spark, table):
    path, _ = table
    one = merged.read_merged(spark, path, keys=[42])
    assert [r["game"] for r in one.collect()] == ["g42"] and len({f.split("_bucket=")[1].split("/")[0] for f in one.inputFiles()}) == 1


def test_refused_and_empty_changes(spark, table):
    path, _ = table
    kind = "game_id long, time long"
    for rows in ([(3, 1), (3, 2)], [(None, 1)]):
        with pytest.raises(ValueError):
            merged.merge_upsert(spark, path, spark.createDataFrame(rows, kind))
    merged.merge_upsert(spark, path, spark.createDataFrame([], kind))
    assert merged.listing(spark, path).version == 0


def test_vacuum_keeps_what_is_named(spark, table):
    path, _ = table
    for k in range(3):
        merged.merge_upsert(spark, path, spark.createDataFrame([(k, 50 + k)], "game_id long, time long"))
    now = rows_of(merged.read_merged(spark, path))
    assert merged.vacuum(spark, path, keep=2) == 0
    assert rows_of(merged.read_merged(spark, path)) == now and merged._versions(spark, path) == [2, 3]
    everything = spark.range(500).select(F.col("id").alias("game_id"), F.lit(0).cast("long").alias("time"))
    merged.merge_upsert(spark, path, everything)
    now = rows_of(merged.read_merged(spark, path))
    assert merged.vacuum(spark, path) >= 4 and rows_of(merged.read_merged(spark, path)) == now


def test_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    merged.create_merged(spark.createDataFrame([], "game_id string, x int"), path, "game_id")
    assert merged.read_merged(spark, path).collect() == []
    merged.merge_upsert(spark, path, spark.createDataFrame([("a", 1)], "game_id string, x int"))
    assert [tuple(r) for r in merged.read_merged(spark, path).collect()] == [("a", 1)]
