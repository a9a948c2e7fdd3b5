"""A stored table that is changed by key without being rewritten whole (inventory S7, S8).

Rows lie in buckets by a hash of their key, each in a folder of its own. A merge reads and rewrites the buckets that its keys
fall into, in a new folder, and then commits a list that names every bucket's folder. Readers follow the newest list, so
they see all of a merge or nothing; what a failed merge has written is in no list. Two merges at once cannot both commit.
Old folders stay readable until ``vacuum`` removes them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ludoscope.sources.tables import update_where, upsert

#: Buckets of a new table; a list has one entry for each, so it is small at any size of the table.
BUCKETS = 256


class MergeConflict(RuntimeError):
    """Somebody else committed to the table in the meantime; the merge has to be done again."""


@dataclass(frozen=True)
class Listing:
    """What the table holds at one version: the folder of each bucket that has rows."""

    version: int
    key: str
    buckets: int
    schema: T.StructType
    folders: dict[int, str]


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, place = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[:-5]) for n in _names(spark, f"{path}/_lists") if n.endswith(".json") and n[:-5].isdigit())


def listing(spark: SparkSession, path: str, version: int | None = None) -> Listing:
    """The newest list of the table, or that of an earlier version which is still kept."""
    known = _versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no merged table at {path}")
    version = known[-1] if version is None else version
    fs, place = _file_system(spark, f"{path}/_lists/{version:010}.json")
    stream = fs.open(place)
    try:
        raw = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Listing(version, raw["key"], raw["buckets"], T.StructType.fromJson(raw["schema"]), {int(b): f for b, f in raw["folders"].items()})


def _commit(spark: SparkSession, path: str, new: Listing) -> None:
    """Put the list in place, complete and under its number, or not at all."""
    text = json.dumps({"key": new.key, "buckets": new.buckets, "schema": new.schema.jsonValue(), "folders": new.folders})
    fs, draft = _file_system(spark, f"{path}/_lists/.draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    _, place = _file_system(spark, f"{path}/_lists/{new.version:010}.json")
    # A rename onto a file that exists fails, so of two merges the first one wins.
    if fs.exists(place) or not fs.rename(draft, place):
        fs.delete(draft, False)
        raise MergeConflict(f"version {new.version} of {path} exists")


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, key: str, buckets: int) -> tuple[str, list[int]]:
    """Write the rows to a new folder, and name it and the buckets it has."""
    folder = f"data/{uuid.uuid4().hex}"
    placed = rows.withColumn("_bucket", _bucket(key, buckets)).repartition("_bucket")
    placed.write.partitionBy("_bucket").parquet(f"{path}/{folder}")
    found = [int(n.split("=")[1]) for n in _names(rows.sparkSession, f"{path}/{folder}") if n.startswith("_bucket=")]
    return folder, found


def create_merged(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Store ``df``, which has one row per ``key``, as the first version of a merged table."""
    folder, found = _write(df, path, key, buckets)
    _commit(df.sparkSession, path, Listing(0, key, buckets, df.schema, {b: folder for b in found}))


def read_merged(spark: SparkSession, path: str, version: int | None = None, keys: Sequence[object] | None = None) -> DataFrame:
    """The table's rows; of given ``keys`` only, reading no bucket but theirs."""
    held = listing(spark, path, version)
    wanted = set(held.folders)
    if keys is not None:
        kind = held.schema[held.key].dataType
        asked = spark.createDataFrame([(k,) for k in keys], T.StructType([T.StructField(held.key, kind)]))
        wanted &= {r[0] for r in asked.select(_bucket(held.key, held.buckets)).distinct().collect()}
    rows = _read(spark, path, held, wanted)
    return rows if keys is None else rows.where(F.col(held.key).isin(list(keys)))


def _read(spark: SparkSession, path: str, held: Listing, wanted: set[int]) -> DataFrame:
    folders = [f"{path}/{held.folders[b]}/_bucket={b}" for b in sorted(wanted & set(held.folders))]
    if not folders:
        return spark.createDataFrame([], held.schema)
    # Folders from before a column was added give null for it.
    return spark.read.schema(held.schema).parquet(*folders)


def _merge(spark: SparkSession, path: str, changes: DataFrame, change) -> None:
    held = listing(spark, path)
    key = held.key
    touched = changes.groupBy(key).agg(F.count(F.lit(1)).alias("n")).groupBy(_bucket(key, held.buckets).alias("b")).agg(
        F.max("n").alias("most"), F.count_if(F.col(key).isNull()).alias("nulls")).collect()
    if any(r["most"] > 1 or r["nulls"] for r in touched):
        raise ValueError(f"changes hold a {key} twice or none")
    if not touched:
        return
    buckets = {r["b"] for r in touched}
    merged = change(_read(spark, path, held, buckets), changes)
    folder, found = _write(merged, path, key, held.buckets)
    folders = {b: f for b, f in held.folders.items() if b not in buckets} | {b: folder for b in found}
    _commit(spark, path, Listing(held.version + 1, key, held.buckets, merged.schema, folders))


def merge_upsert(spark: SparkSession, path: str, updates: DataFrame) -> None:
    """S7 on the stored table: insert or update by its key, field by field, as ``upsert`` does.

    ``updates`` has one row per key; a repeated or null key is refused before anything is written.
    """
    key = listing(spark, path).key
    _merge(spark, path, updates, lambda old, new: upsert(old, new, key))


def merge_update(spark: SparkSession, path: str, mapping: DataFrame, col: str) -> None:
    """S8 on the stored table: set ``col`` on the rows whose key the mapping (key, col) names; unknown keys add nothing."""
    key = listing(spark, path).key
    _merge(spark, path, mapping, lambda old, new: update_where(old, new, key, col))


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove folders that none of the last ``keep`` versions names, and the older lists; the number of folders removed.

    A merge that is still running has folders in no list yet, so nothing may be merging meanwhile.
    """
    known = _versions(spark, path)
    kept = {f for v in known[-keep:] for f in listing(spark, path, v).folders.values()}
    # Lists go first: no list may name a folder that is gone.
    for version in known[:-keep]:
        fs, place = _file_system(spark, f"{path}/_lists/{version:010}.json")
        fs.delete(place, False)
    old = [n for n in _names(spark, f"{path}/data") if f"data/{n}" not in kept]
    for name in old:
        fs, place = _file_system(spark, f"{path}/data/{name}")
        fs.delete(place, True)
    return len(old)
