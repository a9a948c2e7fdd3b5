"""Best-fit packing with matched large items: what goes together is worked out on counts of lengths, and then joined to the rows."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from ludoscope.llm.bpe import encode_tree, load_ranks
from ludoscope.llm.frames import free_names, ready
from ludoscope.session import stored

CAPACITY = 1024
END = 2
#: Rows of a length that are numbered in one group.
GROUP_ROWS = 20_000


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of a tokenizer's JSON file, and their ids."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in found):
        raise ValueError("an added token is not matched as it stands")
    return {t["content"]: t["id"] for t in found}


def encoder(encode: Callable[[str], list[int]], added: Mapping[str, int]) -> Callable[[str], list[int]]:
    """``encode``, but wherever the text of an added token stands (the longest if there are more), its id."""
    if not added:
        return encode
    tokens = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

    def with_added(text: str) -> list[int]:
        parts = tokens.split(text)
        if len(parts) == 1:
            return encode(text)
        return [i for k, part in enumerate(parts) for i in ([added[part]] if k % 2 else encode(part) if part else [])]

    return with_added


def token_pieces(
    docs: DataFrame, path: str, pattern: str, end: int = END, capacity: int = CAPACITY, ids: bool = False, added: Mapping[str, int] | None = None
) -> DataFrame:
    """Every document's ids followed by ``end``, in pieces of at most ``capacity``: doc_id, piece, start, length, ids_crc32 (and ids).

    The text of a token in ``added`` gives its id, as in the tokenizers library; without, it is text like any other.
    Only a document longer than that is cut: all its pieces are full but the first, which takes what is left over. A null or
    empty text is the end id alone. Rows are taken one by one, so a repeated row has its pieces again.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinary = load_ranks(path, pattern).encode_ordinary
        encode = encoder(lambda text: encode_tree(text, ordinary), added or {})
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows: list[tuple] = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    own = np.array([*encode(text or ""), end], dtype="<u4")
                    first = (len(own) - 1) % capacity + 1
                    stops = range(first, len(own) + 1, capacity)
                    for k, stop in enumerate(stops):
                        start = 0 if k == 0 else stop - capacity
                        rows.append((doc_id, k, start, stop - start, zlib.crc32(own[start:stop].tobytes()), own[start:stop].astype(np.int32) if ids else None))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.list_(pa.int32())] if ids else [])]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(kinds)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    fields = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if ids else "")
    return ready(docs).select("doc_id", "text").mapInArrow(work, fields)


def plan_bins(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """How to fill bins with ``counts[length]`` items of each length: (lengths in a bin, number of such bins).

    Items above a third of the capacity share a bin with one other at most. From the largest down, each is matched with the
    largest one left that fits, which gives the most pairs as smaller items fit wherever larger ones do. The others go, the
    largest first, each into the bin with the smallest gap that takes it, and into new bins when there is none. Equal
    items in equal bins are moved together, so the work depends on the capacity and not on the number of items.
    """
    left = {size: n for size, n in counts.items() if n}
    if any(not 1 <= size <= capacity for size in left):
        raise ValueError("a length is out of range")
    gaps: list[dict[tuple[int, ...], int]] = [{} for _ in range(capacity + 1)]

    def put(items: tuple[int, ...], n: int) -> None:
        gap = capacity - sum(items)
        gaps[gap][items] = gaps[gap].get(items, 0) + n

    large = sorted((size for size in left if 3 * size > capacity), reverse=True)
    for a in large:
        for b in large:
            if not left[a]:
                break
            if b > a or a + b > capacity or not left[b]:
                continue
            n = left[a] // 2 if a == b else min(left[a], left[b])
            if n:
                put((a, b), n)
                left[a] -= n
                left[b] -= n
        if left[a]:
            put((a,), left[a])
            left[a] = 0
    for size in sorted((size for size in left if left[size]), reverse=True):
        n = left[size]
        gap = size
        while n and gap <= capacity:
            if not gaps[gap]:
                gap += 1
                continue
            items, bins = next(iter(gaps[gap].items()))
            take = min(n, bins)
            gaps[gap][items] -= take
            if not gaps[gap][items]:
                del gaps[gap][items]
            put((*items, size), take)
            n -= take
            gap = size
        each = capacity // size
        if n // each:
            put((size,) * each, n // each)
        if n % each:
            put((size,) * (n % each), 1)
    return [(items, n) for row in gaps for items, n in row.items()]


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` (doc_id, piece, length and more) with sequence_id and offset: its bin, and its place there from 0 without gaps.

    The driver sees the number of pieces of each length, ``capacity`` numbers. Pieces of one length are numbered in groups of
    about ``group_rows`` picked by hash, and a piece's number tells its bin and place. Full pieces are bins of their own.
    Lengths must lie between 1 and the capacity; an empty table gives an empty table. Columns sequence_id and offset are
    replaced if ``pieces`` has them, all others are kept, repeated rows included.
    """
    pieces = stored(ready(pieces.drop("sequence_id", "offset")), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(size is None or not 1 <= size <= capacity for size in counts):
        raise ValueError("a length is out of range")
    counts.pop(capacity, None)
    (place,) = free_names(pieces, "_number")
    slots: dict[int, list[tuple[int, int, int]]] = {size: [] for size in counts}
    given = dict.fromkeys(counts, 0)
    sequence = 0
    for items, bins in plan_bins(counts, capacity):
        filled = 0
        for size in items:
            slots[size].append((given[size], sequence - given[size], filled))
            given[size] += bins
            filled += size
        sequence += bins
    table = {size: np.array(rows, dtype=np.int64) for size, rows in slots.items()}

    def place_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", place))
            bins, offset = np.zeros(len(size), dtype=np.int64), np.zeros(len(size), dtype=np.int64)
            for own in np.unique(size):
                here = size == own
                rows = table[int(own)]
                slot = np.searchsorted(rows[:, 0], number[here], side="right") - 1
                bins[here], offset[here] = number[here] + rows[slot, 1], rows[slot, 2]
            kept = batch.drop_columns([place])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(bins), pa.array(offset)], names=[*kept.schema.names, "sequence_id", "offset"])

    salts = max(1, -(-max(counts.values(), default=0) // group_rows))
    salt = F.pmod(F.xxhash64(*[c for c in ("doc_id", "piece") if c in pieces.columns]), F.lit(salts)).cast("int")
    salted, row, ahead = free_names(pieces, "_salt", "_row", "_before")
    partial = pieces.where(F.col("length") < capacity).withColumn(salted, salt)
    sizes = partial.groupBy("length", salted).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy(salted).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", salted, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(ahead))
    order = [F.col(c) for c in pieces.columns if dict(pieces.dtypes)[c].split("<")[0] not in ("array", "map")]
    number = F.row_number().over(Window.partitionBy("length", salted).orderBy(*order)) - 1
    numbered = partial.withColumn(row, number).join(sizes, ["length", salted]).withColumn(place, F.col(ahead) + F.col(row))
    numbered = numbered.select(*pieces.columns, place)
    schema = StructType(list(pieces.schema.fields)).add("sequence_id", "long").add("offset", "long")
    whole = pieces.where(F.col("length") == capacity).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return numbered.mapInArrow(place_rows, schema).unionByName(whole)
