"""Helpers of the operators here: groups of sorted Arrow rows, binary columns, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ludoscope.session import stored, tune


#: Items, and their weight, that one part of a bucket holds on average.
BLOCK_ITEMS, BLOCK_WEIGHT = 512, 500_000


def ready(df: DataFrame) -> DataFrame:
    """The same rows, with adaptive execution and its skew handling on in their session."""
    tune(df.sparkSession)
    return df


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names that ``df`` has no column of: those wanted, or with more underscores before them. Case does not tell columns apart."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def binary_rows(matrix: np.ndarray) -> pa.Array:
    """A binary column with one row of a two-dimensional array per value."""
    width = matrix.shape[1] * matrix.itemsize
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(
        pa.binary(), len(matrix), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(matrix).tobytes())]
    )


def per_group(key: str, work: Callable[[pa.Table], pa.RecordBatch | None]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow over partitions sorted by ``key``: ``work`` gets all rows of one key at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if held and keys[a] != last:
                    out = work(pa.Table.from_batches(held))
                    held = []
                    if out is not None:
                        yield out
                held.append(batch.slice(a, b - a))
                last = keys[a]
        if held and (out := work(pa.Table.from_batches(held))) is not None:
            yield out

    return run


def roots(n: int, pairs: Iterable[tuple[int, int]]) -> np.ndarray:
    """The smallest member of each item's component, for n items and some links between them."""
    up = list(range(n))

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(n)], dtype=np.int64)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of a link.

    Alternates large-star and small-star steps. Each step is a minimum per node, summed up before the shuffle, and a join
    back, so no node's neighbours meet in one place. Every round is stored, and ends when it changed no link; a
    component of diameter d takes about log(d) rounds.
    """
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "links")
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: larger neighbours of u go to the smallest node around u.
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        # Small star: all smaller neighbours of u, and u, go to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        edges = stored(small.select("e.*").where("u != v").distinct(), "links")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def meeting_blocks(items: DataFrame, weight: str) -> DataFrame:
    """(block, key): items (key, bands, a weight) that meet in a band, in blocks of bounded size on average.

    A bucket, all items with one band, is cut into even parts, and every two parts are a block. So any two items of a
    bucket meet in a block. Buckets of different bands with the same members count once.
    """
    rows = items.select("key", weight, F.explode("bands").alias("band"))
    sizes = rows.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.sum(weight).alias("weight"),
        F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64("key", F.lit(7))).alias("y"),
    ).where("n > 1")
    parts = F.greatest(F.ceil(F.col("n") / BLOCK_ITEMS), F.ceil(F.col("weight") / BLOCK_WEIGHT)).cast("int")
    sizes = sizes.select("band", F.xxhash64("n", "x", "y").alias("bucket"), parts.alias("parts"))
    members = rows.select("band", "key").join(sizes, "band").select("bucket", "parts", "key").distinct()
    # Part i meets every other part; a bucket of one part is the pair (0, 0).
    own = F.pmod(F.xxhash64("key", F.lit(11)), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    members = members.withColumn("i", own).withColumn("j", other).where("parts = 1 or i != j")
    block = F.xxhash64("bucket", F.least("i", "j"), F.greatest("i", "j"))
    return members.select(block.alias("block"), "key")


def _mark(edges: DataFrame) -> tuple:
    """A number of rows and an order-free digest of them."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(row)
