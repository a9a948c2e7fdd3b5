"""Passages repeated across documents, found by matching statistics on suffix automata of reference shards.

``strip_references`` takes a reference of bounded size and broadcasts its shards. In ``strip_repeats`` the corpus is its
own reference and grows without bound, so a shard is one document, and it is brought together with just the texts that share
an anchor with it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ludoscope.llm.frames import free_names, ready
from ludoscope.llm.words import Words, mix, word_chunks
from ludoscope.session import stored

WINDOW, GRAM = 50, 8
#: Texts that are held against one copy of a reference, on average.
TEXTS = 1024
#: Words of a reference that one automaton holds, and all of it may hold.
SHARD_WORDS, REFERENCE_WORDS = 50_000, 2_000_000
REFERENCE_BYTES = 64 << 20


class SuffixAutomaton:
    """The suffix automaton of some word sequences; no path leads from one sequence into the next."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, sequence: Iterable[int]) -> None:
        """Add a sequence, word by word."""
        last = 0
        for word in sequence:
            last = self._extend(last, word)

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, known, word)
        state = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            target = self.next[at][word]
            self.link[state] = target if self.length[target] == self.length[at] + 1 else self._split(at, target, word)
        return state

    def _split(self, at: int, target: int, word: int) -> int:
        """A copy of ``target`` for the shorter strings that end in it."""
        copy = len(self.next)
        self.next.append(dict(self.next[target]))
        self.length.append(self.length[at] + 1)
        self.link.append(self.link[target])
        self.link[target] = copy
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def matches(self, sequence: Iterable[int]) -> Iterator[int]:
        """Matching statistics: at each word, the length of the longest suffix so far that occurs in a reference."""
        state = length = 0
        for word in sequence:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            yield length


def _slide_min(values: np.ndarray, span: int) -> np.ndarray:
    """The smallest of values[i:i+span] for each i, by doubling; places near the end have fewer."""
    out, have = values.copy(), 1
    while have < span:
        step = min(have, span - have)
        out[:-step] = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:-step]
        have += step
    return out


def _anchored(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first word, the hash and the anchor of every window: the smallest hash of the GRAM-word windows inside it.

    Equal windows have equal anchors, and neighbours mostly share theirs, so anchors stand for windows at a small share of their number.
    """
    starts, hashes = words.windows(size)
    gram = min(GRAM, size)
    at, grams = words.windows(gram)
    row = np.full(len(words.hash), np.iinfo(np.uint64).max, dtype=np.uint64)
    row[at] = mix(grams)
    return starts, hashes, _slide_min(row, size - gram + 1)[starts]


def _key(words: Words, i: int) -> bytes:
    """A digest of a text's word sequence."""
    return hashlib.blake2b(words.hash[words.first[i] : words.first[i + 1]].tobytes(), digest_size=16).digest()


def _sequence(words: Words, i: int, keep: np.ndarray | None = None) -> bytes:
    """A text's words, or those kept, joined by one space."""
    raw = words.data.tobytes() if words.memo.get("raw") is None else words.memo["raw"]
    words.memo["raw"] = raw
    low, high = words.first[i], words.first[i + 1]
    if keep is None:
        return b" ".join(raw[words.bounds[i] : words.bounds[i + 1]].split())
    at = low + np.flatnonzero(keep)
    return b" ".join([raw[a:b] for a, b in zip(words.begin[at].tolist(), words.end[at].tolist())]) if high > low else b""


def _survey(size: int):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in word_chunks(batch.column("text")):
                n = len(words.count)
                starts, _, anchors = _anchored(words, size)
                cut = np.searchsorted(words.doc[starts], np.arange(n + 1))
                own = [np.unique(anchors[cut[i] : cut[i + 1]]) for i in range(n)]
                ends = np.concatenate(([0], np.cumsum([len(a) for a in own]))).astype(np.int32)
                flat = np.concatenate(own).view(np.int64) if n else np.zeros(0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, n), pa.array(words.count.astype(np.int64)),
                        pa.array([_key(words, i) for i in range(n)], pa.binary()),
                        pa.array([hashlib.sha256(_sequence(words, i)).hexdigest() for i in range(n)], pa.string()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    ],
                    names=["doc_id", "n_words", "key", "sha256", "anchors"],
                )

    return work


def _held_against(size: int):
    """For rows sorted by (first, part, turn): texts held against the automaton of the first document that has their anchors.

    Turn 0 brings the reference, turn 1 the texts, one at a time. Of a text, only windows with the anchors listed are looked
    at. Those that occur in the reference are gone. The others come out with a hash and a check: their anchor stands there in
    other surroundings, so another document owns them, perhaps the text itself.
    """
    names = ["doc_id", "number", "gone", "window", "check", "at"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, automaton = None, SuffixAutomaton()
        for batch in batches:
            for row, words in word_chunks(batch.column("text")):
                n = len(words.count)
                part = batch.slice(row, n)
                first, chunk, turn, ids, numbers = (part.column(c).to_pylist() for c in ("first", "part", "turn", "doc_id", "number"))
                starts, hashes, anchors = _anchored(words, size)
                cut = np.searchsorted(words.doc[starts], np.arange(n + 1))
                out: list[tuple] = []
                for i in range(n):
                    if (first[i], chunk[i]) != group:
                        group, automaton = (first[i], chunk[i]), SuffixAutomaton()
                    low = int(words.first[i])
                    own = words.hash[low : words.first[i + 1]]
                    if turn[i] == 0:
                        automaton.add(own.tolist())
                        continue
                    here = slice(cut[i], cut[i + 1])
                    wanted = np.isin(anchors[here], np.asarray(part.column("anchors")[i].values).view(np.uint64))
                    at = starts[here][wanted] - low
                    step = np.zeros(len(own) + 1, dtype=np.int64)
                    np.add.at(step, at, 1)
                    np.add.at(step, at + size, -1)
                    covered = np.concatenate(([0], (np.cumsum(step[:-1]) > 0).astype(np.int8), [0]))
                    length = np.zeros(len(own) + 1, dtype=np.int64)
                    for a, b in zip(np.flatnonzero(np.diff(covered) == 1).tolist(), np.flatnonzero(np.diff(covered) == -1).tolist()):
                        length[a + 1 : b + 1] = np.fromiter(automaton.matches(own[a:b].tolist()), np.int64, b - a)
                    gone = length[at + size] >= size
                    rest = np.flatnonzero(wanted)[~gone] + cut[i]
                    check = mix(hashes[rest] ^ anchors[rest]) ^ words.hash[starts[rest]] ^ mix(words.hash[starts[rest] + size - 1])
                    out.append((ids[i], numbers[i], at[gone], hashes[rest].view(np.int64), (check >> np.uint64(32)).astype(np.uint32).view(np.int32), at[~gone]))
                kinds = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names=names)

    return work


def _keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the key and a short number of their word sequence: a doc_id may stand before several texts."""
    for batch in batches:
        for row, words in word_chunks(batch.column("text")):
            part = batch.slice(row, len(words.count))
            keys = [_key(words, i) for i in range(len(words.count))]
            numbers = pa.array([zlib.crc32(k) - (1 << 31) for k in keys], pa.int32())
            columns = [part.column("doc_id"), pa.array(keys, pa.binary()), numbers, part.column("text"), part.column("uses")]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "number", "text", "uses"])


def _strip(size: int):
    """Candidate texts without the words that their windows ``at`` cover."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in word_chunks(batch.column("text")):
                n = len(words.count)
                part = batch.slice(row, n)
                gone, kept = [], []
                for i, at in enumerate(part.column("at")):
                    step = np.zeros(int(words.count[i]) + 1, dtype=np.int64)
                    places = np.asarray(at.values)
                    np.add.at(step, places, 1)
                    np.add.at(step, places + size, -1)
                    keep = np.cumsum(step[:-1]) == 0
                    gone.append(int(len(keep) - keep.sum()))
                    kept.append(_sequence(words, i, keep))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("key"), pa.array(gone, pa.int64()),
                        pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array([k.decode() for k in kept], pa.string()),
                    ],
                    names=["doc_id", "key", "n_removed", "sha256", "kept"],
                )

    return work


def find_repeats(docs: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Every row's word sequence (doc_id, key, n_words, n_removed, kept_sha256), and what is left of sequences that lose a part.

    The second table has doc_id, key, kept. A window is owned by the smallest doc_id it occurs in; in any other document
    its words are removed. Equal sequences are one to begin with: all but the smallest doc_id lose everything, if they
    are as long as a window. Of the others, only windows whose anchor occurs under two doc_ids are looked at:

    1. The smallest doc_id with an anchor owns every window with it that it has. Its suffix automaton is the reference
       shard that the other texts with that anchor are streamed through; a reference with many texts is copied to as
       many parts, so none of them holds more than about TEXTS.
    2. Windows that are not in that reference have an owner in between. Their owner is a minimum per window hash, summed
       up before the shuffle and joined back, so no window's rows meet in one place.
    """
    docs = ready(docs).select("doc_id", "text")
    fields = "doc_id long, n_words long, key binary, sha256 string, anchors array<long>"
    survey = stored(docs.mapInArrow(_survey(size), fields), "survey")
    long = survey.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= size))
    firsts = long.groupBy("key").agg(F.min("doc_id").alias("first"))
    known = survey.select("doc_id", "n_words", "key", "sha256").join(firsts, "key", "left")
    own = long.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("anchors").alias("anchors"))
    own = own.select("doc_id", F.explode("anchors").alias("anchor"))
    shared = own.groupBy("anchor").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("anchor", "first")
    # A document's anchors are as many as its text has; a doc_id before several texts has those of all.
    members = own.join(shared, "anchor").where("doc_id > first").groupBy("doc_id", "first").agg(F.collect_set("anchor").alias("anchors"))
    members = stored(members, "members")
    parts = members.groupBy("first").agg(F.ceil(F.count(F.lit(1)) / TEXTS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("doc_id"), "parts").cast("int").alias("part")
    uses = members.join(parts, "first").select("doc_id", F.struct("first", part, F.lit(1).alias("turn"), "anchors").alias("use"))
    none = F.array().cast("array<bigint>").alias("anchors")
    copies = parts.select(F.col("first").alias("doc_id"), "first", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    uses = uses.unionByName(copies.select("doc_id", F.struct("first", "part", F.lit(0).alias("turn"), none).alias("use")))
    uses = uses.groupBy("doc_id").agg(F.collect_list("use").alias("uses"))
    # The right side grows with the corpus, so it is never broadcast.
    texts = docs.join(uses.hint("merge"), "doc_id").select("doc_id", "text", "uses")
    texts = stored(texts.mapInArrow(_keyed, StructType().add("doc_id", "long").add("key", "binary").add("number", "integer").add("text", "string").add(texts.schema["uses"])), "texts")
    held = texts.select("doc_id", "number", "text", F.explode("uses").alias("use")).select("doc_id", "number", "text", "use.*")
    held = held.repartition("first", "part").sortWithinPartitions("first", "part", "turn")
    fields = "doc_id long, number int, gone array<int>, window array<long>, check array<int>, at array<int>"
    found = stored(held.mapInArrow(_held_against(size), fields), "windows")
    rows = found.select("doc_id", "number", F.explode(F.arrays_zip("window", "check", "at")).alias("x")).select("doc_id", "number", "x.*")
    owners = rows.groupBy("window", "check").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).where("owner < last")
    late = rows.join(owners.select("window", "check", "owner"), ["window", "check"]).where("doc_id > owner")
    late = late.groupBy("doc_id", "number").agg(F.collect_set("at").alias("gone"))
    late = found.where(F.size("gone") > 0).select("doc_id", "number", "gone").unionByName(late)
    late = late.groupBy("doc_id", "number").agg(F.flatten(F.collect_set("gone")).alias("at"))
    cut = texts.join(late.hint("merge"), ["doc_id", "number"]).select("doc_id", "key", "at", "text")
    left = stored(cut.mapInArrow(_strip(size), "doc_id long, key binary, n_removed long, sha256 string, kept string"), "left")
    part = left.groupBy("doc_id", "key").agg(F.max("n_removed").alias("some"), F.max("sha256").alias("cut_sha256"))
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    out = known.join(part, ["doc_id", "key"], "left").select(
        "doc_id", "key", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("some", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("cut_sha256", "sha256")).alias("kept_sha256"),
    )
    return out, left.select("doc_id", "key", "kept")


def count_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of ``docs`` (doc_id, text); see ``strip_repeats``."""
    return find_repeats(docs, size)[0].select("doc_id", "n_words", "n_removed", "kept_sha256")


def strip_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with every word removed that is covered by a window of ``size`` words which also starts under a smaller doc_id.

    Windows are judged on the input. A text that loses words becomes the words kept, joined by one space; any other text
    stays as it is, white space included. Texts shorter than a window, null ones and those without doc_id lose nothing, and
    rows repeated under one doc_id do not remove each other. Other columns are kept, but n_chars, where there is one,
    follows the text. A text may become empty; its row stays.
    """
    columns = docs.columns
    found, left = find_repeats(docs, size)
    gone = found.where("n_removed = n_words and n_words > 0").select("doc_id", "key", F.lit("").alias("kept")).distinct()
    change = left.join(gone.select("doc_id", "key"), ["doc_id", "key"], "left_anti").unionByName(gone)
    (listed,) = free_names(docs, "_changes")
    changes = change.groupBy("doc_id").agg(F.collect_list(F.struct("key", "kept")).alias(listed))
    both = docs.join(changes, "doc_id", "left").select(*[c for c in columns if c != "text"], "text", listed)
    schema = StructType(list(both.schema.fields)[:-1])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in word_chunks(batch.column("text")):
                part = batch.slice(row, len(words.count))
                texts = part.column("text").to_pylist()
                for i, own in enumerate(part.column(listed).to_pylist()):
                    for change in own or ():
                        if change["key"] == _key(words, i):
                            texts[i] = change["kept"]
                rest = part.drop_columns(["text", listed])
                yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(texts, pa.string())], names=[*rest.schema.names, "text"])

    out = both.mapInArrow(work, schema)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(schema["n_chars"].dataType))
    return out.select(*columns)


# --- given references ---


def strip_references(docs: DataFrame, references: DataFrame, size: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with every word removed that lies in a span of at least ``size`` words which occurs in a text of ``references``.

    The references (text) are broadcast to the tasks up to REFERENCE_WORDS words and REFERENCE_BYTES bytes in all; more of them meet the
    documents by their windows, see ``_strip_windows``, with the same result. A task builds the automata of their shards once and streams its documents through each. A reference longer than a shard
    goes on in the next one with an overlap, so no span is lost that is no longer than the overlap of 4 * size words; longer ones
    are found as overlapping parts. Null and empty texts stay as they are.
    """
    counted = references.where("text is not null").select("text", F.size(F.split(F.trim("text"), "\\s+")).alias("n"))
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    if total[0] > REFERENCE_WORDS or total[1] > REFERENCE_BYTES:
        return _strip_windows(docs, references, size)
    held = docs.sparkSession.sparkContext.broadcast([r["text"] for r in counted.select("text").collect()])
    plain = ready(docs)

    def build() -> list[SuffixAutomaton]:
        shards, room = [SuffixAutomaton()], shard_words
        for _, words in word_chunks(pa.array(held.value, pa.string())):
            for i in range(len(words.count)):
                own = words.hash[words.first[i] : words.first[i + 1]].tolist()
                at = 0
                while at < len(own):
                    if room <= 0:
                        shards.append(SuffixAutomaton())
                        room = shard_words
                    part = own[at : at + max(room, 8 * size)]
                    shards[-1].add(part)
                    room -= len(part)
                    at += len(part)
                    if at < len(own):
                        at -= 4 * size
        return shards

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = None
        for batch in batches:
            shards = shards or build()
            for row, words in word_chunks(batch.column("text")):
                part = batch.slice(row, len(words.count))
                texts = part.column("text").to_pylist()
                for i in range(len(texts)):
                    n = int(words.count[i])
                    if n < size:
                        continue
                    own = words.hash[words.first[i] : words.first[i + 1]].tolist()
                    step = np.zeros(n + 1, dtype=np.int64)
                    for shard in shards:
                        for end, length in enumerate(shard.matches(own), 1):
                            if length >= size:
                                step[end - length] += 1
                                step[end] -= 1
                    keep = np.cumsum(step[:-1]) == 0
                    if not keep.all():
                        texts[i] = _sequence(words, i, keep).decode()
                columns = [pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in part.schema.names]
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return plain.mapInArrow(work, plain.schema)


def _windows_with(size: int, row: str, flagged: str):
    """For rows with a list ``flagged`` of anchors: the windows that have one of them, (row, at, window, check)."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words in word_chunks(batch.column("text")):
                part = batch.slice(first, len(words.count))
                starts, hashes, anchors = _anchored(words, size)
                cut = np.searchsorted(words.doc[starts], np.arange(len(words.count) + 1))
                ids, lists = part.column(row).to_pylist(), part.column(flagged)
                for i in range(len(words.count)):
                    here = np.arange(cut[i], cut[i + 1])
                    here = here[np.isin(anchors[here], np.asarray(lists[i].values).view(np.uint64))]
                    check = mix(hashes[here] ^ anchors[here]) ^ words.hash[starts[here]] ^ mix(words.hash[starts[here] + size - 1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[i]] * len(here), pa.int64()), pa.array((starts[here] - words.first[i]).astype(np.int32)), pa.array(hashes[here].view(np.int64)), pa.array(check.view(np.int64))],
                        names=["row", "at", "window", "check"])

    return work


def _strip_windows(docs: DataFrame, references: DataFrame, size: int) -> DataFrame:
    """``strip_references`` for references of any size: windows of ``size`` words meet by their hashes.

    Only windows whose anchor stands on both sides are hashed and shuffled. A window counts once however often the references have it, and
    a document's windows are as many as its words. Two windows are taken for one if 128 bits of hashes agree.
    """
    (row,) = free_names(docs, "_row")
    rows = stored(ready(docs).withColumn(row, F.monotonically_increasing_id()), "rows")
    given = stored(references.where("text is not null").select("text", F.monotonically_increasing_id().alias("row")), "references")

    def anchors(df: DataFrame) -> DataFrame:
        plain = df.select(F.col("row").alias("doc_id"), "text").mapInArrow(_survey(size), "doc_id long, n_words long, key binary, sha256 string, anchors array<long>")
        return plain.select(F.col("doc_id").alias("row"), F.explode("anchors").alias("anchor"))

    mine, theirs = anchors(rows.select(F.col(row).alias("row"), "text")), anchors(given)
    shared = stored(theirs.select("anchor").distinct().join(mine.select("anchor").distinct(), "anchor"), "anchors")

    def windows(df: DataFrame, own: DataFrame) -> DataFrame:
        held = own.join(shared, "anchor").groupBy("row").agg(F.collect_set("anchor").alias("anchors"))
        return df.join(held.hint("merge"), "row").select("row", "text", "anchors").mapInArrow(_windows_with(size, "row", "anchors"), "row long, at int, window long, check long")

    known = windows(given, theirs).select("window", "check").distinct()
    found = windows(rows.select(F.col(row).alias("row"), "text"), mine).join(known, ["window", "check"])
    cut = found.groupBy("row").agg(F.collect_set("at").alias("at"))
    texts = rows.select(F.col(row).alias("row"), "text").join(cut.hint("merge"), "row").select(F.col("row").alias("doc_id"), F.lit(b"").alias("key"), "at", "text")
    (kept,) = free_names(rows, "_kept")
    left = texts.mapInArrow(_strip(size), "doc_id long, key binary, n_removed long, sha256 string, kept string").select(F.col("doc_id").alias(row), F.col("kept").alias(kept))
    return rows.join(left, row, "left").withColumn("text", F.coalesce(kept, "text")).select(*docs.columns)
