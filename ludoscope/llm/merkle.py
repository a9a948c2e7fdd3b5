"""A Merkle manifest of a dataset whose parents keep the state of the hash before each child's slot.

Leaves are numbered within their source; three nodes in a row make a parent, and the sources' roots are the leaves of a top
tree. Trees are worked on in chunks of 729 nodes, six levels of parents, so no task sees a whole source: the tops of a
round's chunks are the nodes of the next, and a million executors' leaves need four rounds. A chunk's row holds its digests
and, for every parent, the states of SHA-256 before the second and the third child.

Folding a changed leaf resumes the state before its slot and takes in the new digest and the siblings to the right of it;
what stands on the left is in the state already. A leaf's way above its chunk is the same for the whole chunk and worked
out once, from the top down.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ludoscope.functions.scale import with_position
from ludoscope.llm.frames import binary_rows, ready
from ludoscope.llm.sha_states import absorb, finish, fresh
from ludoscope.session import cut_lineage, stored

FAN, LEVELS = 3, 6
CHUNK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows worked on at a time.
ROWS = 1 << 15
#: A step of a way: slot, size of the run, state before the slot, the run's others from left to right.
STEP = np.dtype([("slot", "u1"), ("run", "u1"), ("state", "<u4", 8), ("others", "u1", (2, 32))])

_CHUNKS = "tree long, chunk long, n long, m int, digests binary, states binary, top binary"


def leaf_digest(columns: Sequence[str | Column]) -> Column:
    """The digest of some values: each is its bytes in UTF-8, ``:`` and the value, or ``-`` for a null. Numbers are decimal."""
    parts = []
    for c in columns:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def number_leaves(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, source, leaf and more) with tree, at and n: their source's number, the place there, and its leaves.

    Sources are ordered by their bytes, null first, and leaves by doc_id, null first, then by their digest, so repeated rows
    have places next to each other. A source's number is the place of its first leaf in the whole order.
    """
    order = [F.col(c).asc_nulls_first() for c in ("source", "doc_id", "leaf")]
    placed = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))
    placed = placed.select("*", F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_in"), key.alias("_key"))
    # A row per part and source: as many as sources, and one more for each part at most.
    runs = placed.groupBy("_part", "_key").agg(F.count(F.lit(1)).alias("_n"), F.min("_in").alias("_low"))
    parts = runs.groupBy("_part").agg(F.sum("_n").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.join(F.broadcast(parts.select("_part", before.alias("_off"))), "_part")
    own = Window.partitionBy("_key")
    runs = runs.select("_part", "_key", "_off", F.min(F.col("_off") + F.col("_low")).over(own).alias("tree"), F.sum("_n").over(own).alias("n"))
    both = placed.join(runs, ["_part", "_key"])
    return both.select(*rows.columns, "tree", (F.col("_off") + F.col("_in") - F.col("tree")).alias("at"), "n")


def _pieces(batches: Iterable[pa.RecordBatch], whole: tuple[str, str] | None = None) -> Iterator[pa.Table]:
    """Rows some ten thousand at a time; with ``whole``, groups of two keys that stand together are not parted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < ROWS:
            continue
        table, cut = pa.Table.from_batches(held), None
        if whole:
            a, b = (table.column(k).to_numpy() for k in whole)
            other = np.flatnonzero((a != a[-1]) | (b != b[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
        if cut != 0:
            yield table.slice(0, cut).combine_chunks()
        held = table.slice(cut).to_batches() if cut is not None else []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, 32)


def _depth(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Levels of parents in a chunk of m nodes of a tree of n."""
    depth = np.zeros(len(n), dtype=np.int64)
    left = m.astype(np.int64).copy()
    while (more := left > 1).any():
        depth[more] += 1
        left = -(-left // FAN)
    return np.where(n > CHUNK, LEVELS, depth)


def _ragged(rows: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary column: each value is the next so many rows of an array."""
    data = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1) if len(rows) else np.zeros((0, 1), dtype=np.uint8)
    ends = np.concatenate(([0], np.cumsum(sizes * data.shape[1]))).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data.tobytes())]).cast(pa.binary())


def _build_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _pieces(batches, ("tree", "chunk")):
        tree, chunk, n = (table.column(c).to_numpy() for c in ("tree", "chunk", "n"))
        first = np.flatnonzero(np.concatenate(([True], (tree[1:] != tree[:-1]) | (chunk[1:] != chunk[:-1]))))
        m = np.diff(np.append(first, len(tree)))
        depth = _depth(n[first], m)
        owner, digest, left = np.repeat(np.arange(len(first)), m), _digests(table.column("digest")), m.copy()
        levels, kept = [(owner, digest)], []
        for level in range(int(depth.max())):
            start = np.cumsum(left) - left
            place = np.arange(len(owner)) - start[owner]
            heads = np.flatnonzero((place % FAN == 0) & (depth[owner] > level))
            run = np.minimum(FAN, left[owner[heads]] - place[heads])
            state, states = fresh(len(heads)), np.zeros((len(heads), FAN - 1, 8), dtype=np.uint32)
            for slot in range(FAN):
                here = np.flatnonzero(run > slot)
                if slot:
                    states[here, slot - 1] = state[here]
                state[here] = absorb(state[here], digest[heads[here] + slot])
            digest, owner = finish(state, run), owner[heads]
            left = np.bincount(owner, minlength=len(m))
            levels.append((owner, digest))
            kept.append((owner, states))
        owners = np.concatenate([o for o, _ in levels])
        order = np.argsort(owners, kind="stable")
        digests, sizes = np.concatenate([d for _, d in levels])[order], np.bincount(owners, minlength=len(m))
        parents = np.concatenate([o for o, _ in kept]) if kept else np.zeros(0, dtype=np.int64)
        states = (np.concatenate([s for _, s in kept]) if kept else np.zeros((0, FAN - 1, 8), dtype=np.uint32))[np.argsort(parents, kind="stable")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(tree[first]), pa.array(chunk[first]), pa.array(n[first]), pa.array(m.astype(np.int32)), _ragged(digests, sizes),
             _ragged(states.reshape(-1, (FAN - 1) * 8), np.bincount(parents, minlength=len(m))), binary_rows(digests[np.cumsum(sizes) - 1])],
            names=["tree", "chunk", "n", "m", "digests", "states", "top"])


class _Chunks:
    """Some chunks' rows in arrays, and the step of any of their nodes at any level."""

    def __init__(self, table: pa.Table) -> None:
        self.tree, self.chunk, n, m = (table.column(c).to_numpy() for c in ("tree", "chunk", "n", "m"))
        digests, states = table.column("digests").to_pylist(), table.column("states").to_pylist()
        self.digests = np.frombuffer(b"".join(digests), dtype=np.uint8).reshape(-1, 32)
        self.states = np.frombuffer(b"".join(states), dtype=np.uint32).reshape(-1, FAN - 1, 8)
        self.depth, self.size = _depth(n, m), m.astype(np.int64)
        self.node = np.concatenate(([0], np.cumsum([len(d) // 32 for d in digests])))[:-1].astype(np.int64)
        self.parent = np.concatenate(([0], np.cumsum([len(s) // (32 * (FAN - 1)) for s in states])))[:-1].astype(np.int64)

    def steps(self, own: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Level by level: the nodes (chunk ``own``, ``place`` there) that go up there, and their steps."""
        size, node, parent, place = self.size.copy(), self.node.copy(), self.parent.copy(), place.copy()
        for level in range(int(self.depth[own].max()) if len(own) else 0):
            here = np.flatnonzero(self.depth[own] > level)
            c, up = own[here], place[here] // FAN
            steps = np.zeros(len(here), dtype=STEP)
            slot = place[here] - FAN * up
            run = np.minimum(FAN, size[c] - FAN * up)
            steps["slot"], steps["run"], steps["state"] = slot, run, fresh(1)[0]
            later = slot > 0
            steps["state"][later] = self.states[(parent[c] + up)[later], slot[later] - 1]
            for k in range(FAN - 1):
                held = run > k + 1
                at = node[c] + FAN * up + k + (k >= slot)
                steps["others"][held, k] = self.digests[at[held]]
            yield here, steps
            place[here] = up
            node += size
            size = -(-size // FAN)
            parent += size


def _climb(steps: np.ndarray, digest: np.ndarray, proof: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One step up: the parents' digests, from the resumed states, and the proofs with the run's others taken in."""
    state = absorb(steps["state"], digest)
    for k in range(FAN - 1):
        here = np.flatnonzero(steps["run"] > k + 1)
        proof[here] = absorb(proof[here], steps["others"][here, k])
        blocks[here] += 1
        right = here[steps["slot"][here] <= k]
        state[right] = absorb(state[right], steps["others"][right, k])
    return finish(state, steps["run"]), proof, blocks


def _node_ways(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every node of upper chunks: its steps in the chunk, then the chunk's."""
    for table in _pieces(batches):
        for low in range(0, table.num_rows, 16):
            part = table.slice(low, 16).combine_chunks()
            chunks, above, roots = _Chunks(part), part.column("way").to_pylist(), part.column("root").to_pylist()
            own = np.repeat(np.arange(part.num_rows), chunks.size)
            place = np.arange(len(own)) - np.repeat(np.cumsum(chunks.size) - chunks.size, chunks.size)
            ways = [b""] * len(own)
            for here, steps in chunks.steps(own, place):
                for i, step in zip(here.tolist(), steps):
                    ways[i] += step.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunks.tree[own]), pa.array(chunks.chunk[own] * CHUNK + place), pa.array([w + above[c] for w, c in zip(ways, own.tolist())], pa.binary()),
                 pa.array([roots[c] for c in own.tolist()], pa.binary())], names=["tree", "at", "way", "root"])


def _fold_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Changes behind their chunk's row: each is folded up its chunk and then along the chunk's way."""
    carry: pa.Table | None = None
    for table in _pieces(batches):
        if carry is not None:
            table = pa.concat_tables([carry, table]).combine_chunks()
        is_chunk = table.column("n").is_valid().to_numpy()
        heads = np.flatnonzero(is_chunk)
        if not len(heads):
            changes, found = table, np.zeros(table.num_rows, dtype=bool)
            own = np.full(table.num_rows, -1)
        else:
            carry = table.slice(int(heads[-1]), 1)
            changes = table.filter(pa.array(~is_chunk)).combine_chunks()
            held = table.filter(pa.array(is_chunk)).combine_chunks()
            chunks = _Chunks(held)
            own = np.cumsum(is_chunk)[~is_chunk] - 1
            at = changes.column("at").to_numpy(zero_copy_only=False)
            found = (own >= 0) & (changes.column("tree").to_numpy() == chunks.tree[own]) & (changes.column("chunk").to_numpy() == chunks.chunk[own])
            found &= at - chunks.chunk[own] * CHUNK < chunks.size[own]
        if not changes.num_rows:
            continue
        rows = np.flatnonzero(found)
        folded, proof, root = (np.zeros((changes.num_rows, 32), dtype=np.uint8) for _ in range(3))
        if len(rows):
            own, place = own[rows], at[rows] % CHUNK
            digest, state, blocks = _digests(changes.column("digest").take(pa.array(rows))).copy(), fresh(len(rows)), np.zeros(len(rows), dtype=np.int64)
            for here, steps in chunks.steps(own, place):
                digest[here], state[here], blocks[here] = _climb(steps, digest[here], state[here], blocks[here])
            ways = held.column("way").to_pylist()
            count = np.array([len(w) // STEP.itemsize for w in ways])
            above, first = np.frombuffer(b"".join(ways), dtype=STEP), np.cumsum(count) - count
            for k in range(int(count[own].max())):
                here = np.flatnonzero(count[own] > k)
                digest[here], state[here], blocks[here] = _climb(above[first[own[here]] + k], digest[here], state[here], blocks[here])
            folded[rows], proof[rows], root[rows] = digest, finish(state, blocks), _digests(held.column("root"))[own]
        none = pa.array(~found)
        columns = [pc.if_else(none, pa.scalar(None, pa.binary()), binary_rows(x)) for x in (folded, proof, root)]
        yield from pa.table([changes.column("row"), *columns], names=["row", "folded", "proof", "root"]).to_batches()


@dataclass
class Manifest:
    """A built manifest.

    leaves: the rows with tree, at and n. rounds: for each round the chunks (tree, chunk, n, m, digests, states, top) with
    way (the steps above the chunk) and root (of its source). root: the dataset's digest, None if it is empty.
    """

    leaves: DataFrame
    rounds: list[DataFrame]
    root: bytes | None


def _forest(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The chunks of each round, and the roots (tree, digest), of nodes (tree, at, n, digest)."""
    rounds, roots = [], []
    widest = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        cells = nodes.select("tree", F.floor(F.col("at") / CHUNK).cast("long").alias("chunk"), "at", "n", "digest")
        cells = cells.repartition("tree", "chunk").sortWithinPartitions("tree", "chunk", "at")
        chunks = stored(cells.mapInArrow(_build_chunks, _CHUNKS), "merkle")
        rounds.append(chunks)
        roots.append(chunks.where(F.col("n") <= CHUNK).select("tree", F.col("top").alias("digest")))
        if widest <= CHUNK:
            break
        widest = -(-widest // CHUNK)
        nodes = chunks.where(F.col("n") > CHUNK).select(
            "tree", F.col("chunk").alias("at"), F.ceil(F.col("n") / CHUNK).cast("long").alias("n"), F.col("top").alias("digest"))
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return rounds, found


def _with_ways(rounds: list[DataFrame], roots: DataFrame) -> list[DataFrame]:
    """The chunks of each round with way and root, from the last round down; ``roots``: tree, way, root."""
    done: list[DataFrame] = []
    above: DataFrame | None = None
    for chunks in reversed(rounds):
        found = chunks.where(F.col("n") <= CHUNK).join(roots, "tree")
        if above is not None:
            found = found.unionByName(chunks.where(F.col("n") > CHUNK).join(above.withColumnRenamed("at", "chunk"), ["tree", "chunk"]))
        found = stored(found, "ways")
        done.insert(0, found)
        above = found.mapInArrow(_node_ways, "tree long, at long, way binary, root binary")
    return done


def build(docs: DataFrame, fields: Sequence[str] = FIELDS, keep: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs`` (doc_id, source and the ``fields`` that a leaf is made of).

    ``keep``: more columns of the leaves' table, as expressions over ``docs``, so that texts are read once and never
    shuffled. Other columns of ``docs`` are ignored. Nulls are values of their own; repeated rows are leaves of their own;
    an empty table has no root.
    """
    rows = stored(ready(docs).select("doc_id", "source", leaf_digest(fields).alias("leaf"), *[c.alias(n) for n, c in (keep or {}).items()]), "leaves")
    leaves = stored(number_leaves(rows), "leaves")
    rounds, subroots = _forest(leaves.select("tree", "at", "n", F.col("leaf").alias("digest")))
    numbered = stored(with_position(subroots, [F.col("tree")], "at", start=0), "subroots")
    total = numbered.count()
    if not total:
        return Manifest(leaves, [], None)
    top, root = _forest(numbered.select(F.lit(0).cast("long").alias("tree"), "at", F.lit(total).cast("long").alias("n"), "digest"))
    digest = bytes(root.first()["digest"])
    end = root.select("tree", F.lit(b"").alias("way"), F.lit(digest).alias("root"))
    ways = _with_ways(top, end)[0].mapInArrow(_node_ways, "tree long, at long, way binary, root binary")
    ways = numbered.join(ways.select("at", "way"), "at").select("tree", "way", F.col("digest").alias("root"))
    return Manifest(leaves, _with_ways(rounds, ways), digest)


def fold(manifest: Manifest, changes: DataFrame) -> DataFrame:
    """``changes`` (tree, at, digest and more): what the dataset's root would be with each one alone.

    Returns the other columns with folded, proof (the digest of all siblings on the way, level by level, from left to right)
    and root (of the leaf's source). The three are null where the manifest has no such leaf. Any number of changes may name
    one leaf.
    """
    others = [c for c in changes.columns if c not in ("tree", "at", "digest")]
    row = F.struct(*others)
    rows = changes.select("tree", F.floor(F.col("at") / CHUNK).cast("long").alias("chunk"), "at", "digest", row.alias("row"))
    if not manifest.rounds:
        empty = F.lit(None).cast("binary")
        return rows.select("row.*", empty.alias("folded"), empty.alias("proof"), empty.alias("root"))
    chunks = manifest.rounds[0].drop("top")
    both = chunks.unionByName(rows, allowMissingColumns=True).repartition("tree", "chunk")
    # A chunk's own row has no place, and null is first.
    both = both.sortWithinPartitions("tree", "chunk", F.col("at").asc_nulls_first())
    kind = rows.schema["row"].dataType.simpleString()
    return both.mapInArrow(_fold_rows, f"row {kind}, folded binary, proof binary, root binary").select("row.*", "folded", "proof", "root")
