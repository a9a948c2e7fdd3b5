"""Document fingerprints by randomised edit embedding: all texts walk over their characters with the same random steps.

At step j of the walk a text shows the character it stands at, and moves on to the next one or stays, as a random bit shared by
all texts says for (j, character). Two texts that differ by a few edits soon stand at the same place again, so what they
show differs in a number of steps that is bounded by their edit distance. A fingerprint keeps a hash of four bits of what
is shown at fixed random steps, SAMPLES of each octave of steps; likeness is the weighted share of equal samples,
corrected for those that agree by chance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ludoscope.llm.frames import components, meeting_blocks, per_group, ready, roots
from ludoscope.llm.words import mix
from ludoscope.session import stored

SAMPLES, OCTAVES = 64, 40
BANDS, BAND_SAMPLES = 20, 8
#: Rows of a range of doc_ids, of which each is worked off by one task.
RANGE_ROWS = 2_000
PERIOD, CLASSES = 256, 64
_CELLS = 4_000_000
_ROWS = 2_048


def _steps() -> np.ndarray:
    """For each class of characters and step modulo PERIOD: how many steps until the text has moved on."""
    bits = mix(np.arange(CLASSES * PERIOD, dtype=np.uint64) + np.uint64(0x51ED270B)).reshape(CLASSES, PERIOD) >> np.uint64(63)
    bits[:, PERIOD - 1] = 1
    waits = np.zeros((CLASSES, PERIOD), dtype=np.int32)
    wait = np.ones(CLASSES, dtype=np.int32)
    for j in range(PERIOD - 1, -1, -1):
        wait = np.where(bits[:, j] == 1, 1, wait + 1).astype(np.int32)
        waits[:, j] = wait
    return waits.ravel()


def _sampled() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sampled steps in order, the weight of each, and where each octave begins among them."""
    at, weight, begin = [np.zeros(1, dtype=np.int64)], [np.ones(1)], [0]
    for e in range(OCTAVES):
        begin.append(sum(map(len, at)))
        low = 1 << e
        if low <= SAMPLES:
            own = np.arange(low, 2 * low, dtype=np.int64)
        else:
            # One step in each of SAMPLES even parts of the octave.
            part = low // SAMPLES
            own = low + part * np.arange(SAMPLES, dtype=np.int64)
            own += (mix(own.astype(np.uint64)) % np.uint64(part)).astype(np.int64)
        at.append(own)
        weight.append(np.full(len(own), low / len(own)))
    return np.concatenate(at), np.concatenate(weight), np.array(begin)


_WAITS = _steps()
_AT, _WEIGHT, _OCTAVE = _sampled()
_HEX = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)


def _characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)


def walk(texts: list[np.ndarray], start: np.ndarray, mark: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Walk over some texts (code points) from step ``start`` each, many at a time, one character after the other.

    Returns each text's samples (1 to 15) from its start on, and the step at which it arrives at character ``mark``.
    """
    out: list[list[np.ndarray]] = [[] for _ in texts]
    arrived = start.copy()
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    done = 0
    while done < len(order) and len(texts[order[done]]):
        longest = len(texts[order[done]])
        lanes = order[done : done + max(1, _CELLS // min(longest, 65_536))]
        lanes = [i for i in lanes if len(texts[i])]
        done += len(lanes)
        sizes = np.array([len(texts[i]) for i in lanes])
        now = start[lanes].copy()
        low = 0
        while low < longest:
            alive = int(np.searchsorted(-sizes, -low, side="left"))
            high = min(longest, low + max(256, _CELLS // alive))
            cells = np.zeros((high - low, alive), dtype=np.int32)
            marks = []
            for k in range(alive):
                own = mix(texts[lanes[k]][low:high])
                marks.append((own >> np.uint64(32)) % np.uint64(15) + np.uint64(1))
                cells[: len(own), k] = (own & np.uint64(CLASSES - 1)).astype(np.int32) * PERIOD
            path = np.zeros((high - low, alive), dtype=np.int64)
            before = now[:alive].copy()
            live = np.searchsorted(-sizes[:alive], -(low + np.arange(high - low)), side="left")
            for s, m in enumerate(live.tolist()):
                j = now[:m]
                j += _WAITS.take(cells[s, :m] + (j & (PERIOD - 1)).astype(np.int32))
                path[s, :m] = j
            for k in range(alive):
                i, n = lanes[k], len(marks[k])
                own = path[:n, k]
                steps = _AT[np.searchsorted(_AT, before[k]) : np.searchsorted(_AT, own[-1])]
                out[i].append(marks[k][np.searchsorted(own, steps, side="right")].astype(np.uint8))
                if low < mark[i] <= low + n:
                    arrived[i] = own[mark[i] - low - 1]
            low = high
    return [np.concatenate(own) if own else np.zeros(0, dtype=np.uint8) for own in out], arrived


def as_text(samples: np.ndarray) -> str:
    """A fingerprint: one hexadecimal digit per sample."""
    return _HEX[samples].tobytes().decode()


def samples_of(fingerprint: str) -> np.ndarray:
    """The samples of a fingerprint."""
    raw = np.frombuffer(fingerprint.encode(), dtype=np.uint8)
    return np.where(raw > 57, raw - 87, raw - 48).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """How alike two texts are by their samples, from 0 (as by chance) to 1 (all equal); two empty ones are alike."""
    most, least = max(len(a), len(b)), min(len(a), len(b))
    if not most:
        return 1.0
    same = float(_WEIGHT[:least][a[:least] == b[:least]].sum() / _WEIGHT[:most].sum())
    if not least:
        return 0.0
    if len(a) == len(b) and same >= 1.0 - 1e-12:
        return 1.0
    chance = float(np.dot(np.bincount(a, _WEIGHT[: len(a)], 16) / _WEIGHT[: len(a)].sum(), np.bincount(b, _WEIGHT[: len(b)], 16) / _WEIGHT[: len(b)].sum()))
    chance *= float(_WEIGHT[:least].sum() / _WEIGHT[:most].sum())
    return min(1.0, max(0.0, (same - chance) / (1.0 - chance))) if chance < 1.0 - 1e-9 else same


def fingerprint_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars (code points) and fingerprint of every row of ``docs``; a null or empty text has the empty fingerprint."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                part = batch.slice(low, _ROWS)
                texts = [_characters(t or "") for t in part.column("text").to_pylist()]
                none = np.zeros(len(texts), dtype=np.int64)
                samples, _ = walk(texts, none, none)
                columns = [part.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(map(as_text, samples), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_chars", "fingerprint"])

    return ready(docs).select("doc_id", "text").mapInArrow(work, "doc_id long, n_chars long, fingerprint string")


def in_ranges(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows (doc_id, text) dealt to even ranges of doc_id: (range, turn, doc_id, text) sorted within its partition.

    Each range also holds the first row of the next one, and the last range the very first row, with turn 1. Bounds are doc_ids that
    occur, found by quantiles; null doc_ids come first.
    """
    docs = docs.select("doc_id", "text")
    facts = docs.agg(F.count(F.lit(1)), F.min("doc_id"), F.count("doc_id")).first()
    n = max(1, -(-facts[0] // range_rows))
    bounds: list[int] = []
    if n > 1 and facts[2]:
        found = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], max(10_000, 20 * n))).first()[0]
        bounds = sorted({b for b in found if b != facts[1]} | ({facts[1]} if facts[2] < facts[0] else set()))
    first = F.col("doc_id").isNull() if facts[2] < facts[0] else F.col("doc_id").eqNullSafe(F.lit(facts[1]))
    if not bounds:
        own, copies = F.lit(0), F.when(first, F.array(F.struct(F.lit(0).alias("range"), F.lit(1).alias("turn"))))
    else:
        # Two levels of bounds, so a row is compared with about twice their square root.
        width = int(len(bounds) ** 0.5) + 1
        groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
        upto = lambda values: F.size(F.filter(values, lambda b: b <= F.col("doc_id")))
        level = upto(F.lit([g[0] for g in groups]))
        inner = upto(F.get(F.array(*[F.lit(g) for g in groups]), level - 1))
        own = F.when(F.col("doc_id").isNull() | (level == 0), F.lit(0)).otherwise((level - 1) * width + inner)
        at_bound = F.coalesce(F.get(F.lit(bounds), own - 1) == F.col("doc_id"), F.lit(False))
        guard = lambda at: F.array(F.struct(at.cast("int").alias("range"), F.lit(1).alias("turn")))
        copies = F.when(at_bound, guard(own - 1)).when(first, guard(F.lit(len(bounds))))
    home = F.array(F.struct(own.cast("int").alias("range"), F.lit(0).alias("turn")))
    place = F.explode(F.concat(home, F.coalesce(copies, F.filter(home, lambda x: F.lit(False))))).alias("place")
    placed = docs.select(place, "doc_id", "text").select("place.*", "doc_id", "text")
    return placed.repartition(len(bounds) + 1, "range").sortWithinPartitions("range", "turn", "doc_id", "text")


def compare_with_next(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Every document's fingerprint, that of its text with the last quarter taken from the next document, and likenesses.

    The next document is that with the next doc_id, and after the last one the first; rows repeated under one doc_id follow each
    other by their text, and null doc_ids come first. The last floor(n_chars / 4) code points give way to the first as many
    (or all) of the next text. A null text is empty; two empty texts are alike (1). A single document is its own next one.
    The walk over the edited text goes on from where the first three quarters have led.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def finish(ids: list, texts: list[str]) -> pa.RecordBatch:
        """Rows for all texts but the last one, which only follows."""
        points = [_characters(t) for t in texts]
        none = np.zeros(len(texts), dtype=np.int64)
        size = np.array([len(t) for t in texts], dtype=np.int64)
        keep = size - size // 4
        samples, arrived = walk(points, none, keep)
        tails = [points[i + 1][: size[i] - keep[i]] for i in range(len(texts) - 1)]
        rest, _ = walk(tails, arrived[:-1].copy(), none[:-1])
        rows = []
        for i, tail in enumerate(rest):
            edited = np.concatenate((samples[i][: np.searchsorted(_AT, arrived[i])], tail))
            changed = texts[i][: keep[i]] + texts[i + 1][: size[i] - keep[i]]
            rows.append((
                ids[i], int(size[i]), hashlib.sha256(changed.encode()).hexdigest(), as_text(samples[i]), as_text(edited),
                likeness(samples[i], edited), likeness(samples[i], samples[i + 1]),
            ))
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        current, closed, held = None, False, 0
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                for at, turn, doc_id, text in zip(*(part.column(c).to_pylist() for c in ("range", "turn", "doc_id", "text"))):
                    if at != current:
                        ids, texts, current, closed, held = [], [], at, False, 0
                    if closed:
                        continue
                    text = text or ""
                    ids.append(doc_id)
                    texts.append(text)
                    held += len(text)
                    if turn or len(ids) > _ROWS or held > _CELLS:
                        if len(ids) > 1:
                            yield finish(ids, texts)
                        # The last row goes on as the first of the next lot, or was only there to follow.
                        ids, texts, held, closed = [doc_id], [text], len(text), bool(turn)

    fields = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_ranges(ready(docs), range_rows).mapInArrow(work, fields)


# --- groups of like documents ---


def _bands(samples: np.ndarray) -> list[int]:
    """Keys of BANDS draws of BAND_SAMPLES bits each from the last whole octaves; none for an empty text.

    A text just over the start of an octave also has the keys of one just under it.
    """
    if not len(samples):
        return []
    top = int(np.searchsorted(_OCTAVE, len(samples), side="right")) - 1
    ends = {int(_OCTAVE[top])}
    if len(samples) - _OCTAVE[top] < SAMPLES // 4 and top > 1:
        ends.add(int(_OCTAVE[top - 1]))
    if len(samples) >= int(_OCTAVE[top + 1]) - SAMPLES // 4:
        ends.add(int(_OCTAVE[top + 1]))
    keys = []
    for end in sorted(ends):
        low = max(0, end - 2 * SAMPLES)
        usable = np.arange(low, min(end, len(samples)))
        if not len(usable):
            usable = np.arange(len(samples))
        for band in range(BANDS):
            pick = mix(np.arange(BAND_SAMPLES, dtype=np.uint64) + np.uint64(1000 * (band + 1) + 17 * end))
            own = samples[low + (pick % np.uint64(max(1, end - low))).astype(np.int64).clip(0, len(samples) - 1 - low)]
            keys.append(int(mix(np.array([hash_bytes(own.tobytes()) ^ (band + 1)], dtype=np.uint64)).view(np.int64)[0]))
    return keys


def hash_bytes(raw: bytes) -> int:
    """64 bits of a stable hash."""
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")


def like_groups(prints: DataFrame, least: float = 0.8) -> DataFrame:
    """doc_id and group_id of rows (doc_id, fingerprint): the smallest doc_id that links of a likeness of ``least`` reach.

    Equal fingerprints are one node. Nodes that agree in a band of sampled bits meet in blocks of bounded size, where whole
    fingerprints verify them. Empty fingerprints are linked with nothing; null ones count as empty.
    """
    prints = stored(ready(prints).select("doc_id", F.coalesce("fingerprint", F.lit("")).alias("fingerprint")), "prints")
    nodes = prints.where("fingerprint != ''").groupBy("fingerprint").agg(F.min("doc_id").alias("least"))

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("fingerprint").to_pylist()
            columns = [
                pa.array([hashlib.blake2b(f.encode(), digest_size=16).digest() for f in own], pa.binary()), batch.column("fingerprint"),
                batch.column("least"), pa.array([_bands(samples_of(f)) for f in own], pa.list_(pa.int64())), pa.array(list(map(len, own)), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "fingerprint", "least", "bands", "n"])

    nodes = stored(nodes.mapInArrow(keys, "key binary, fingerprint string, least long, bands array<long>, n long"), "nodes")

    def verify(table: pa.Table) -> pa.RecordBatch | None:
        keys, own = table["key"].to_pylist(), [samples_of(f) for f in table["fingerprint"].to_pylist()]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        pairs = [(x, y) for x in range(len(order)) for y in range(x) if likeness(own[order[x]], own[order[y]]) >= least]
        top = roots(len(order), pairs)
        away = np.flatnonzero(top != np.arange(len(order)))
        if not len(away):
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array([keys[order[i]] for i in away], pa.binary()), pa.array([keys[order[top[i]]] for i in away], pa.binary())], names=["a", "b"]
        )

    blocks = meeting_blocks(nodes, "n").join(nodes.select("key", "fingerprint"), "key").repartition("block").sortWithinPartitions("block")
    links = blocks.select("block", "key", "fingerprint").mapInArrow(per_group("block", verify), "a binary, b binary")
    groups = components(links, "a", "b").withColumnRenamed("node", "key").join(nodes.select("key", "fingerprint", "least"), "key")
    lowest = groups.groupBy("component").agg(F.min("least").alias("group_id"))
    named = groups.join(lowest, "component").select("fingerprint", "group_id")
    alone = nodes.select("fingerprint", "least").join(named, "fingerprint", "left").select("fingerprint", F.coalesce("group_id", "least").alias("group_id"))
    return prints.join(alone, "fingerprint", "left").select("doc_id", F.coalesce("group_id", "doc_id").alias("group_id"))
