"""Near-duplicate documents by HyperMinHash: banded registers, corrected estimates, and links confirmed on full sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ludoscope.llm.frames import binary_rows, components, free_names, meeting_blocks, per_group, ready, roots
from ludoscope.llm.hyperminhash import BANDS, BUCKETS, bands, estimate, registers
from ludoscope.llm.words import Words, word_chunks
from ludoscope.session import stored

SHINGLE = 5
#: Estimates this far below the threshold are still verified: over four standard deviations at BUCKETS registers.
MARGIN = 0.14


def shingle_sets(words: Words) -> list[np.ndarray]:
    """Each text's distinct shingles, sorted: windows of SHINGLE words, or the whole sequence of a shorter text."""
    starts, hashes = words.windows(SHINGLE)
    cut = np.searchsorted(words.doc[starts], np.arange(len(words.count) + 1)) if len(starts) else np.zeros(len(words.count) + 1, dtype=np.int64)
    short = np.flatnonzero((words.count > 0) & (words.count < SHINGLE))
    alone = dict(zip(short.tolist(), words.whole(short))) if len(short) else {}
    sets = []
    for i in range(len(words.count)):
        own = np.sort(hashes[cut[i] : cut[i + 1]])
        if len(own):
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif i in alone:
            own = np.array([alone[i]], dtype=np.uint64)
        sets.append(own)
    return sets


def _digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, words in word_chunks(batch.column("text"), lower=True):
            sets = shingle_sets(words)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            full = np.flatnonzero(sizes)
            regs = np.zeros((len(sets), BUCKETS), dtype=np.uint16)
            keys = np.zeros((len(sets), BANDS), dtype=np.int64)
            if len(full):
                bounds = np.concatenate(([0], np.cumsum(sizes[full])))
                regs[full] = registers(np.concatenate([sets[i] for i in full]), bounds)
                keys[full] = bands(regs[full])
            ends = np.arange(len(sets) + 1, dtype=np.int32) * BANDS
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(row, len(sets)),
                    pa.array(sizes),
                    pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel())),
                    binary_rows(regs),
                ],
                names=["doc_id", "n_shingles", "key", "bands", "registers"],
            )


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, words in word_chunks(batch.column("text"), lower=True):
            keys = batch.column("key").slice(row, len(words.count)).to_pylist()
            # A doc_id may stand before several texts; only the one of this class counts.
            own = [(k, s.tobytes()) for k, s in zip(keys, shingle_sets(words)) if len(s) and _digest(s) == k]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in own], pa.binary()) for i in (0, 1)], names=["key", "shingles"])


def _candidates(floor: float):
    """Of one block: the sets that an estimate links with another one."""

    def work(table: pa.Table) -> pa.RecordBatch | None:
        regs = np.frombuffer(b"".join(table["registers"].to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS)
        near = np.zeros(len(regs), dtype=bool)
        for i in range(len(regs) - 1):
            if (hit := estimate(regs[i + 1 :], regs[i]) >= floor).any():
                near[i] = True
                near[i + 1 :] |= hit
        if not near.any():
            return None
        return table.select(["block", "key"]).filter(pa.array(near)).combine_chunks().to_batches()[0]

    return per_group("block", work)


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The size of every intersection, as a product of incidence matrices over the shingles that two sets or more share."""
    n = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate(([True], values[1:] != values[:-1]))
    term = np.cumsum(new) - 1
    shared = np.bincount(term)[term] > 1
    term, owner = np.unique(term[shared], return_inverse=True)[1], owner[shared]
    out = np.zeros((n, n), dtype=np.float64)
    if not len(term):
        return out.astype(np.int64)
    terms = int(term.max()) + 1
    step = max(1, 4_000_000 // n)
    for low in range(0, terms, step):
        here = (term >= low) & (term < low + step)
        cells = np.zeros((n, min(step, terms - low)), dtype=np.float32)
        cells[owner[here], term[here] - low] = 1.0
        out += cells @ cells.T
    return np.rint(out).astype(np.int64)


def _verified(percent: int):
    """Of one block: links to the smallest key of each group that full sets confirm."""

    def work(table: pa.Table) -> pa.RecordBatch | None:
        keys = table["key"].to_pylist()
        order = sorted(range(len(keys)), key=keys.__getitem__)
        keys = [keys[i] for i in order]
        raw = table["shingles"].to_pylist()
        sets = [np.frombuffer(raw[i], dtype=np.uint64) for i in order]
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        both = _overlaps(sets)
        linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
        a, b = np.nonzero(np.triu(linked, 1))
        top = roots(len(keys), zip(a.tolist(), b.tolist()))
        away = np.flatnonzero(top != np.arange(len(keys)))
        if not len(away):
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array([keys[i] for i in away], pa.binary()), pa.array([keys[top[i]] for i in away], pa.binary())], names=["a", "b"]
        )

    return per_group("block", work)


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its group of documents linked by similar shingle sets.

    Words are lower-cased (A-Z); a set holds the distinct windows of five words, or the whole sequence of a shorter text.
    Two sets are linked when their intersection is at least ``percent`` hundredths of their union. Returns doc_id,
    n_shingles, component_id (the smallest doc_id that links reach), kept (doc_id = component_id) and n_copies, the
    number of rows with just this set.

    Equal sets are one node. Nodes that agree in one of the bands of registers are compared in blocks of bounded size:
    corrected estimates first, and where one comes near the threshold, the full sets. A pair at the threshold is missed
    with probability (1 - J^5)^24: 8e-7 at 0.85, 7e-5 at 0.8.

    A null text or one without words has an empty set, is linked with nothing and is its own component. A null doc_id is
    never a component_id unless all of a group are null; its kept is false. Rows repeated under one doc_id are one
    node if their texts are equal. Further columns of ``docs`` are ignored.
    """
    docs = ready(docs).select("doc_id", "text")
    sketches = stored(
        docs.mapInArrow(_sketch, "doc_id long, n_shingles long, key binary, bands array<long>, registers binary"), "sketches"
    )
    least = sketches.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_copies"), F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"), F.first("registers").alias("registers"),
    )
    classes = stored(least, "classes")
    # Keys of single members need no registers, so those join to the members of buckets only.
    blocks = meeting_blocks(classes, "n_shingles").join(classes.select("key", "registers"), "key").repartition("block").sortWithinPartitions("block")
    floor = percent / 100 - MARGIN
    near = stored(blocks.select("block", "key", "registers").mapInArrow(_candidates(floor), "block long, key binary"), "near")
    # One text of each class that has candidates gives the full set.
    one = near.select("key").distinct().join(classes.select("key", F.col("least").alias("doc_id")), "key")
    sets = docs.join(one, docs["doc_id"].eqNullSafe(one["doc_id"])).select("key", "text").mapInArrow(_sets, "key binary, shingles binary")
    sets = sets.groupBy("key").agg(F.first("shingles").alias("shingles"))
    full = near.join(sets, "key").select("block", "key", "shingles").repartition("block").sortWithinPartitions("block")
    links = full.mapInArrow(_verified(percent), "a binary, b binary")
    groups = components(links, "a", "b")
    merged = groups.join(classes.select(F.col("key").alias("node"), "least"), "node")
    lowest = merged.groupBy("component").agg(F.min("least").alias("component_id"))
    named = merged.join(lowest, "component").select(F.col("node").alias("key"), "component_id")
    named = classes.select("key", "least", "n_copies").join(named, "key", "left").select("key", F.coalesce("component_id", "least").alias("component_id"), "n_copies")
    out = sketches.select("doc_id", "n_shingles", "key").join(named, "key", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
    )


def drop_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that with the smallest doc_id, a null one only if there is no other.

    Groups are those of ``near_duplicates`` over rows, so of rows repeated under one doc_id one stays too. Documents without
    words are in no group and all stay. All columns are kept.
    """
    (row,) = free_names(docs, "_row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    groups = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), percent).where("n_shingles > 0")
    # Only groups of two or more can lose a row.
    sizes = groups.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component_id")
    members = groups.join(sizes, "component_id").select(F.col("doc_id").alias("_row"), "component_id").join(rows.select(F.col(row).alias("_row"), "doc_id"), "_row")
    order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "_row")
    stays = members.groupBy("component_id").agg(F.min(order).alias("first"))
    gone = members.join(stays, "component_id").where(F.col("_row") != F.col("first._row")).select(F.col("_row").alias(row))
    return rows.join(gone, row, "left_anti").select(*docs.columns)
