"""Phrases whose words stand together more often than chance has it, from weighted acyclic automata of n-grams.

A shard, some million words of one task, sorts its windows of five words and keeps them as an automaton: windows in order,
each as the length of the path it shares with the one before, the labels beyond it and its count. The weight of a state is
the sum of the windows below it, so one path holds the counts of all its prefixes. Automata are cut by ranges of hashed
prefixes, so that a range gets every path that begins with its prefixes, from all shards; there they are united level by
level, weights summed, and states below the least count go before the next level. The automaton that is left is composed
with that of the candidates' parts: over whole phrases, a join.

What a prefix is: the first word. One that holds more than 1/4096 of a sample's windows counts by itself, and its windows go
by their first two words, those of such a pair by three, and so on, so no prefix fills a range. The sample says what is
split, never what is counted.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ludoscope.functions.scale import salted_lookup, top_per_key
from ludoscope.llm.frames import per_group, ready
from ludoscope.llm.words import Words, mix, text_bytes
from ludoscope.session import cut_lineage, stored

LONGEST, LEAST, BEST, PERCENT = 5, 100, 2000, 100
#: Words of a shard, words that a range holds on average, and documents of the sample that balances ranges.
SHARD_WORDS, RANGE_WORDS, SAMPLE_DOCS, HOT_SHARE = 800_000, 1_000_000, 4_000, 4096
#: Tasks that unite ranges; Spark's shuffles do not grow well beyond this.
MOST_TASKS = 20_000
_BITS = 21
_ID = (1 << _BITS) - 1
_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[list(b".,;:!?\n\x0b\x0c\r")] = True
_BETWEEN = _BREAKS.copy()
_BETWEEN[[9, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CHUNK_BYTES = 1 << 20

_PARTS = "cell string, lang string, base int, names int, words binary, wide boolean, paths binary, labels binary, counts binary, large binary"


def _chain(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a sequence from that of all but its last word and the last word's."""
    return mix(before * np.uint64(0xD6E8FEB86659FD93) + word)


class _Shard:
    """The words of one language that a task has read: their hashes, where pieces begin, and the words by hash."""

    def __init__(self) -> None:
        self.hashes: list[np.ndarray] = []
        self.begins: list[np.ndarray] = []
        self.words: dict[int, bytes] = {}
        self.size = 0

    def add(self, texts: pa.Array) -> None:
        data, bounds = text_bytes(texts)
        row = 0
        while row < len(texts):
            stop = int(np.searchsorted(bounds, bounds[row] + _CHUNK_BYTES, side="right")) - 1
            stop = min(max(stop, row + 1), len(texts))
            part = _LOWER[data[bounds[row] : bounds[stop]]]
            found = Words(part, bounds[row : stop + 1] - bounds[row], between=_BETWEEN)
            if len(found.hash):
                ends = np.cumsum(_BREAKS[part])[found.begin]
                begins = np.ones(len(found.hash), dtype=bool)
                begins[1:] = (ends[1:] != ends[:-1]) | (found.doc[1:] != found.doc[:-1])
                values, first = np.unique(found.hash, return_index=True)
                raw = part.tobytes()
                for value, a, b in zip(values.tolist(), found.begin[first].tolist(), found.end[first].tolist()):
                    if value not in self.words:
                        self.words[value] = raw[a:b]
                self.hashes.append(found.hash)
                self.begins.append(begins)
                self.size += len(found.hash)
            row = stop

    def windows(self, step: int = SHARD_WORDS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Some million words at a time: word hashes in order, distinct windows of word numbers (from 1, 0 for none) in order, counts."""
        if not self.size:
            return
        hashes, begins = np.concatenate(self.hashes), np.concatenate(self.begins)
        stops = np.append(np.flatnonzero(begins), len(hashes))
        for low in range(0, len(hashes), step):
            high = min(low + step, len(hashes))
            names, number = np.unique(hashes[low : high + LONGEST - 1], return_inverse=True)
            number = np.concatenate((number.astype(np.int64) + 1, np.zeros(LONGEST - 1, dtype=np.int64)))
            at = np.arange(low, high)
            left = stops[np.searchsorted(stops, at, side="right")] - at
            w = [np.where(left > d, number[d : d + high - low], 0) for d in range(LONGEST)]
            heads, head = np.unique((w[0] << (2 * _BITS)) | (w[1] << _BITS) | w[2], return_inverse=True)
            whole, counts = np.unique((head.astype(np.int64) << (2 * _BITS)) | (w[3] << _BITS) | w[4], return_counts=True)
            head = heads[whole >> (2 * _BITS)]
            yield names, np.stack([head >> (2 * _BITS), (head >> _BITS) & _ID, head & _ID, (whole >> _BITS) & _ID, whole & _ID], axis=1, dtype=np.int32, casting="same_kind"), counts


def _prefixes(names: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """The hash of each window's first words."""
    padded = np.concatenate((np.zeros(1, dtype=np.uint64), names))
    out = np.zeros(len(windows), dtype=np.uint64)
    for d in range(length):
        out = _chain(out, padded[windows[:, d]])
    return out


def _cut(windows: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct first words of sorted windows that are long enough, with the sums of their counts."""
    held = windows[:, length - 1] > 0
    windows, counts = windows[held], counts[held]
    if not len(windows):
        return windows, counts
    new = np.flatnonzero(np.concatenate(([True], (windows[1:, :length] != windows[:-1, :length]).any(axis=1))))
    short = np.zeros((len(new), LONGEST), dtype=np.int32)
    short[:, :length] = windows[new, :length]
    return short, np.add.reduceat(counts, new)


def _by_base(names: np.ndarray, windows: np.ndarray, counts: np.ndarray, hot: dict[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(base, windows, counts): each counts for its prefixes of ``base`` words and more."""
    for base in range(1, LONGEST):
        is_hot = np.isin(_prefixes(names, windows, base), hot[base])
        heads, sums = _cut(windows[is_hot], counts[is_hot], base)
        yield base, np.concatenate((windows[~is_hot], heads)), np.concatenate((counts[~is_hot], sums))
        longer = is_hot & (windows[:, base] > 0)
        windows, counts = windows[longer], counts[longer]
    yield LONGEST, windows, counts


def _parts(lang: str, shard: _Shard, ranges: int, hot: dict[int, np.ndarray], step: int) -> Iterator[pa.RecordBatch]:
    """The shard's automaton in rows: one for each range of prefixes."""
    for names, windows, counts in shard.windows(step):
        texts = [shard.words[h] for h in names.tolist()]
        for base, paths, sums in _by_base(names, windows, counts, hot):
            if not len(paths):
                continue
            cell = (_prefixes(names, paths, base) % np.uint64(ranges)).astype(np.int64)
            # In order within a range: prefixes of hot paths have come after the others.
            order = np.lexsort((*[paths[:, d] for d in reversed(range(LONGEST))], cell)) if base < LONGEST and len(hot[base]) else np.argsort(cell, kind="stable")
            cell, paths, sums = cell[order], paths[order], sums[order]
            first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
            shared = np.zeros(len(paths), dtype=np.int64)
            same = np.ones(len(paths) - 1, dtype=bool)
            for d in range(LONGEST):
                same &= (paths[1:, d] == paths[:-1, d]) & (paths[1:, d] > 0)
                shared[1:] += same
            shared[first] = 0
            length = (paths > 0).sum(axis=1)
            own = (np.arange(LONGEST) >= shared[:, None]) & (paths > 0)
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(paths))))
            label_group = np.repeat(group, own.sum(axis=1))
            known, local = np.unique((label_group << _BITS) | paths[own], return_inverse=True)
            owner = known >> _BITS
            bounds = np.searchsorted(owner, np.arange(len(first) + 1))
            local = local - bounds[label_group]
            wide = bool((np.diff(bounds) > 65535).any())
            labels = local.astype(np.uint32 if wide else np.uint16)
            label_bounds = np.searchsorted(label_group, np.arange(len(first) + 1))
            codes, small = (shared * 8 + length).astype(np.uint8), np.minimum(sums, 255).astype(np.uint8)
            listed = [texts[i - 1] for i in (known & _ID).tolist()]
            path_bounds = np.append(first, len(paths))
            rows = []
            for k, (a, b, la, lb, na, nb) in enumerate(zip(
                    path_bounds[:-1].tolist(), path_bounds[1:].tolist(), label_bounds[:-1].tolist(), label_bounds[1:].tolist(), bounds[:-1].tolist(), bounds[1:].tolist())):
                large = sums[a:b][small[a:b] == 255].astype(np.int64)
                rows.append((f"{cell[a]}|{lang}", lang, base, nb - na, b" ".join(listed[na:nb]), wide, codes[a:b].tobytes(), labels[la:lb].tobytes(), small[a:b].tobytes(), large.tobytes()))
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.bool_(), *[pa.binary()] * 4]
            fields = ["cell", "lang", "base", "names", "words", "wide", "paths", "labels", "counts", "large"]
            for low in range(0, len(rows), 512):
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[low : low + 512]], kind) for i, kind in enumerate(kinds)], names=fields)


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    for lang in batch.column("lang").unique().to_pylist():
        yield lang, batch.column("text").filter(pc.equal(batch.column("lang"), lang))


def _shards(ranges: int, hot: dict[int, np.ndarray], step: int):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, _Shard] = {}
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                for lang, texts in _by_language(batch.slice(low, 1024)):
                    shards.setdefault(lang, _Shard()).add(texts)
                if sum(s.size for s in shards.values()) >= step:
                    for lang, shard in shards.items():
                        yield from _parts(lang, shard, ranges, hot, step)
                    shards = {}
        for lang, shard in shards.items():
            yield from _parts(lang, shard, ranges, hot, step)

    return work


def _unite(rows: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The words, the paths as word numbers (from 1) and the counts of some shards' rows."""
    def joined(name: str) -> list[bytes]:
        return rows.column(name).to_pylist()

    paths = joined("paths")
    code = np.frombuffer(b"".join(paths), dtype=np.uint8)
    shared, length = (code >> 3).astype(np.int64), (code & 7).astype(np.int64)
    counts = np.frombuffer(b"".join(joined("counts")), dtype=np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(b"".join(joined("large")), dtype=np.int64)
    labels = joined("labels")
    wide = rows.column("wide").to_pylist()
    if any(wide):
        numbers = np.concatenate([np.frombuffer(x, dtype=np.uint32 if w else np.uint16).astype(np.int64) for x, w in zip(labels, wide)])
    else:
        numbers = np.frombuffer(b"".join(labels), dtype=np.uint16).astype(np.int64)
    names = rows.column("names").to_numpy().astype(np.int64)
    coded = pa.array(b" ".join(joined("words")).split(b" "), pa.binary()).dictionary_encode()
    per_row = np.array([len(x) // (4 if w else 2) for x, w in zip(labels, wide)])
    numbers = coded.indices.to_numpy().astype(np.int64)[numbers + np.repeat(np.cumsum(names) - names, per_row)] + 1
    own = (np.arange(LONGEST) >= shared[:, None]) & (np.arange(LONGEST) < length[:, None])
    full = np.zeros((len(code), LONGEST), dtype=np.int32)
    full[own] = numbers
    for d in range(LONGEST):
        last = np.maximum.accumulate(np.where(own[:, d], np.arange(len(code)), 0))
        full[:, d] = np.where(length > d, full[last, d], 0)
    return coded.dictionary.to_pylist(), full, counts


def _count_range(least: int):
    """For all rows of a range: its phrases found ``least`` times or more, and the sum of all words as the phrase of length 0."""

    def work(rows: pa.Table) -> pa.RecordBatch | None:
        lang = rows.column("lang")[0].as_py()
        phrases, lengths, sums = [], [], []
        for base in sorted(set(rows.column("base").to_pylist())):
            words, paths, counts = _unite(rows.filter(pc.equal(rows.column("base"), base)).combine_chunks())
            if base == 1:
                phrases.append("")
                lengths.append(0)
                sums.append(int(counts.sum()))
            state = np.zeros(len(paths), dtype=np.int64)
            for d in range(LONGEST):
                held = paths[:, d] > 0
                if not held.all():
                    paths, counts, state = paths[held], counts[held], state[held]
                if not len(paths):
                    break
                _, first, state = np.unique((state << 32) | paths[:, d], return_index=True, return_inverse=True)
                if d + 1 < base:
                    continue
                weight = np.zeros(len(first), dtype=np.int64)
                np.add.at(weight, state, counts)
                often = weight >= least
                for i in np.flatnonzero(often).tolist():
                    phrases.append(b" ".join(words[w - 1] for w in paths[first[i], : d + 1].tolist()).decode())
                    lengths.append(d + 1)
                    sums.append(int(weight[i]))
                keep = often[state]
                paths, counts, state = paths[keep], counts[keep], state[keep]
        if not phrases:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(phrases)), pa.array(phrases), pa.array(lengths, pa.int32()), pa.array(sums, pa.int64())], names=["lang", "phrase", "length", "f"])

    return work


def _sample_hot(share: int):
    """From a sample: words (length 0), and the prefixes of up to four words with their windows where they are many."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _by_language(batch):
                shard = _Shard()
                shard.add(texts)
                for names, windows, _ in shard.windows():
                    rows = [(0, 0, shard.size)]
                    for length in range(1, LONGEST):
                        held = windows[windows[:, length - 1] > 0]
                        value, n = np.unique(_prefixes(names, held, length), return_counts=True)
                        many = n > max(1, len(held) // (4 * share))
                        rows += [(length, h, c) for h, c in zip(value[many].view(np.int64).tolist(), n[many].tolist())]
                        rows.append((-length, 0, len(held)))
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int32(), pa.int64(), pa.int64()))], names=["length", "h", "n"])

    return work


def phrase_counts(
    docs: DataFrame, least: int = LEAST, shard_words: int = SHARD_WORDS, range_words: int = RANGE_WORDS, hot_share: int = HOT_SHARE
) -> DataFrame:
    """(lang, phrase, length, f): every phrase of up to five words found ``least`` times or more in its language, and its count.

    The row with length 0 has the number of all words of the language. Words are told apart by 64-bit hashes within a shard.
    """
    rows = ready(docs).select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    total = docs.count()
    if not total:
        return docs.sparkSession.createDataFrame([], "lang string, phrase string, length int, f long")
    share = min(1.0, SAMPLE_DOCS / total)
    sample = rows if share == 1 else rows.sample(share, seed=1)
    seen = sample.mapInArrow(_sample_hot(hot_share), "length int, h long, n long").groupBy("length", "h").agg(F.sum("n").alias("n"))
    seen = cut_lineage(seen)
    found = {r["length"]: r["n"] for r in seen.where("length <= 0").collect()}
    ranges = max(1, round(found.get(0, 0) / share / range_words))
    hot: dict[int, np.ndarray] = {}
    for length in range(1, LONGEST):
        # Fewer than ``hot_share`` prefixes can hold more than that share each.
        large = seen.where((F.col("length") == length) & (F.col("n") * hot_share > F.lit(found.get(-length, 0)))) if ranges > 1 else None
        hot[length] = np.array([r["h"] for r in large.select("h").collect()] if large is not None else [], dtype=np.int64).view(np.uint64)
    parts = rows.mapInArrow(_shards(ranges, hot, shard_words), _PARTS)
    # As many tasks as ranges, so that a task stays the same size however much there is; a task may also take several ranges in turn.
    tasks = min(max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), ranges), MOST_TASKS)
    return parts.repartition(tasks, "cell").sortWithinPartitions("cell").mapInArrow(per_group("cell", _count_range(least)), "lang string, phrase string, length int, f long")


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST, percent: int = PERCENT) -> DataFrame:
    """The ``best`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``docs`` has text and lang; a null text is empty, a null language is ``und``, other columns are ignored and repeated rows
    count again. Phrases of two to five words found ``least`` times are candidates; the cut with the lowest
    floor(1000 a n / (l r)) counts, the smallest first part on ties. One that lies in a longer candidate found at least
    ``percent`` hundredths as often goes. Numbers are exact up to 38 digits. Without candidates the table is empty.
    """
    grams = stored(phrase_counts(docs, least), "grams")
    sizes = cut_lineage(grams.where("length = 0").groupBy("lang").agg(F.sum("f").alias("n")))
    key = F.concat("lang", F.lit("\t"), "phrase")
    counted = grams.where("length > 0").select(key.alias("key"), "f")
    words = F.split("phrase", " ")
    candidates = grams.where("length > 1").select("lang", "phrase", "length", F.col("f").alias("a"), words.alias("words"))

    def part(start: int | Column, length: Column) -> Column:
        return F.concat("lang", F.lit("\t"), F.array_join(F.slice("words", start, length), " "))

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1)))
    cuts = stored(cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("length") - F.col("k")).alias("right")), "cuts")
    both = salted_lookup(cuts, counted.select(F.col("key").alias("left"), F.col("f").alias("l")), "left", ["phrase", "k"])
    both = salted_lookup(both, counted.select(F.col("key").alias("right"), F.col("f").alias("r")), "right", ["phrase", "k"])
    both = salted_lookup(both, sizes, "lang", ["phrase", "k"])
    exact = "decimal(38,0)"
    both = both.withColumn("top", F.lit(1000).cast(exact) * F.col("a") * F.col("n")).withColumn("bottom", F.col("l").cast(exact) * F.col("r"))
    both = both.withColumn("score", F.expr(f"CAST(top AS {exact}) div CAST(bottom AS {exact})"))
    scored = both.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # Every phrase inside a candidate, with the largest count of those it is inside of.
    inner = candidates.where("length > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("length") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("length") - F.col("m") + 1)))
    around = inner.select(part(F.col("at"), F.col("m")).alias("key"), "a").groupBy("key").agg(F.max("a").alias("around"))
    kept = scored.withColumn("key", key).join(around, "key", "left").where(F.col("around").isNull() | (100 * F.col("around") < percent * F.col("a")))
    chosen = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    ranked = top_per_key(chosen, ["lang"], [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], best, "rank")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
