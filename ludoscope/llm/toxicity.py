"""Toxic passages as maximal scoring segments over token log-odds, and documents scored by extreme-value statistics of them."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructType

from ludoscope.llm.frames import per_group, ready
from ludoscope.llm.words import Words, mix, text_bytes

#: Labelled rows that the model is fitted on, about: more are thinned by a hash of doc_id. Everything else covers all rows.
TRAIN_ROWS = 50_000
#: Two independent tables of counts; a feature counts as the less telling one of its two places.
TABLES, PLACES = 2, 1 << 19
#: A feature's log-odds matter from this many standard deviations on.
LEAST_Z = 3.0
#: And from these odds on: frequent words that lean slightly to one side would add up over long texts.
LEAST_ODDS = 1.0
#: The Dirichlet prior: PRIOR_DOCS documents spread like the whole sample, and half a document on each side.
PRIOR_DOCS, PRIOR_FLAT = 10.0, 0.5
#: Besides whole words, their first bytes: word stems in languages with endings.
PREFIXES = (5, 6, 7, 8)
#: Karlin and Altschul's K; lambda is 1 for log-likelihood ratios.
KARLIN_K = 0.1
CHUNK = 1 << 19
BLOCK = 1 << 13
_U_LOW, _U_HIGH, _U_STEP = -12.0, 60.0, 0.25

_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[65:91] = _BETWEEN[97:123] = _BETWEEN[128:] = False


@dataclass(frozen=True)
class Model:
    """Places with telling log-odds per table, their counts, the two class sizes, what other tokens add, and the calibration.

    ``rest`` is what a token adds that does not tell, where every telling one counts; ``rest_once`` where each counts once in its document.
    """

    places: tuple[np.ndarray, ...]
    toxic: tuple[np.ndarray, ...]
    clean: tuple[np.ndarray, ...]
    n_toxic: int
    n_clean: int
    rest: float = -0.01
    rest_once: float = -0.01
    levels: tuple[np.ndarray, np.ndarray] = (np.zeros(1), np.full(1, 0.5))


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds ratio of a feature between toxic and clean documents under a Dirichlet prior, and its z score."""
    share = (toxic + clean + 0.5) / (n_toxic + n_clean + 1.0)
    prior = PRIOR_DOCS * share + PRIOR_FLAT
    a, b = np.maximum(toxic, 0) + prior, np.maximum(clean, 0) + prior
    whole = PRIOR_DOCS + 2 * PRIOR_FLAT
    odds = np.log(a / np.maximum(n_toxic + whole - a, 0.5)) - np.log(b / np.maximum(n_clean + whole - b, 0.5))
    return odds, odds / np.sqrt(1.0 / a + 1.0 / b)


def letters(texts: pa.Array) -> Iterator[tuple[int, Words]]:
    """Words of letters (a to z and everything beyond ASCII), folded to lower case in ASCII and Latin-1."""
    data, bounds = text_bytes(texts)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(bounds, bounds[row] + CHUNK, side="right")) - 1
        stop = min(max(stop, row + 1), len(texts))
        part = data[bounds[row] : bounds[stop]].copy()
        part[(part >= 65) & (part <= 90)] += 32
        second = np.flatnonzero(part[:-1] == 0xC3) + 1
        second = second[(part[second] >= 0x80) & (part[second] <= 0x9E) & (part[second] != 0x97)]
        part[second] += 32
        yield row, Words(part, bounds[row : stop + 1] - bounds[row], between=_BETWEEN)
        row = stop


def _features(words: Words) -> np.ndarray:
    """Each word's features: itself and its beginnings, one row per kind."""
    kinds = [words.hash, *(words.prefixes(k) for k in PREFIXES)]
    return np.stack([mix(h ^ np.uint64(i + 1)) for i, h in enumerate(kinds)])


def _places(features: np.ndarray, t: int) -> np.ndarray:
    return ((features >> np.uint64(32 * t)) & np.uint64(PLACES - 1)).astype(np.int64)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean documents each place occurs, as blocks of one partition's counts."""
    counts = np.zeros(TABLES * PLACES * 2, dtype=np.int32)
    for batch in batches:
        label = batch.column("_toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        for row, words in letters(batch.column("text")):
            features, doc = _features(words).ravel(), np.tile(words.doc, 1 + len(PREFIXES))
            for t in range(TABLES):
                pairs = np.unique(doc * PLACES + _places(features, t))
                own = (t * PLACES + pairs % PLACES) * 2 + label[row + pairs // PLACES]
                counts += np.bincount(own, minlength=len(counts)).astype(np.int32)
    for k in range(len(counts) // BLOCK):
        block = counts[k * BLOCK : (k + 1) * BLOCK]
        if block.any():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([block.tobytes()], pa.binary())], names=["block", "counts"])


def _telling(n_toxic: int, n_clean: int):
    """Of one block: places that tell, also once a clean document is taken out."""

    def work(table: pa.Table) -> pa.RecordBatch | None:
        total = np.zeros(BLOCK, dtype=np.int64)
        for raw in table["counts"]:
            total += np.frombuffer(raw.as_buffer(), dtype=np.int32)
        toxic, clean = total[1::2], total[0::2]
        z = np.maximum(log_odds(toxic, clean, n_toxic, n_clean)[1], log_odds(toxic, clean - 1, n_toxic, n_clean)[1])
        at = np.flatnonzero((z >= LEAST_Z) & (toxic > 0))
        if not len(at):
            return None
        first = table["block"][0].as_py() * BLOCK // 2
        return pa.RecordBatch.from_arrays([pa.array(first + at), pa.array(toxic[at]), pa.array(clean[at])], names=["place", "toxic", "clean"])

    return per_group("block", work)


def maximal_segments(scores: Iterable[tuple[float, int, int]]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, begin, end), in linear time, of runs (score, begin, end) in order.

    Each candidate keeps the sums before and after it. A new one joins back over the last candidate that starts lower, as
    long as it ends higher; what is left when the scores end is maximal.
    """
    found: list[tuple[float, float, int, int, int]] = []
    total = 0.0
    for score, begin, end in scores:
        before, total = total, total + score
        if score <= 0:
            continue
        low, high = before, total
        k = len(found) - 1
        while True:
            # A candidate that starts no lower is passed over with all those that it passed over itself.
            while k >= 0 and found[k][0] >= low:
                k = found[k][4]
            if k < 0 or found[k][1] >= high:
                found.append((low, high, begin, end, k))
                break
            low, begin, back = found[k][0], found[k][2], found[k][4]
            del found[k:]
            k = back
    return [(high - low, begin, end) for low, high, begin, end, _ in found]


def evidence(segments: list[tuple[float, int, int]], n: int) -> float:
    """-ln P of the best sums of segment scores in a text of ``n`` tokens, after Karlin and Altschul's sum statistics."""
    base = math.log(KARLIN_K * n + 1.0)
    best, total = -base, 0.0
    for r, (score, _, _) in enumerate(sorted(segments, reverse=True), 1):
        total += score - base
        if r == 1:
            best = total
        elif total > 1.0:
            best = max(best, total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r))
    return best


class Scorer:
    """A model ready for use in a task."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.at = []
        for places in model.places:
            at = np.full(PLACES, -1, dtype=np.int32)
            at[places] = np.arange(len(places))
            self.at.append(at)

    def odds(self, words: Words, label: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The words that tell, wherever they stand, and their log-odds. With labels, each document's own count is taken out first."""
        m = self.model
        features = _features(words)
        at = [self.at[t][_places(features, t)] for t in range(TABLES)]
        kind, word = np.nonzero((at[0] >= 0) & (at[1] >= 0))
        values, sure = [], []
        for t in range(TABLES):
            k = at[t][kind, word]
            toxic, clean = m.toxic[t][k], m.clean[t][k]
            n_toxic, n_clean = np.int64(m.n_toxic), np.int64(m.n_clean)
            if label is not None:
                own = label[words.doc[word]]
                toxic, clean = toxic - own, clean - (1 - own)
                n_toxic, n_clean = n_toxic - own, n_clean - (1 - own)
            o, z = log_odds(toxic, clean, n_toxic, n_clean)
            values.append(o)
            sure.append(z)
        less = sure[1] < sure[0]
        value, z = np.where(less, values[1], values[0]), np.where(less, sure[1], sure[0])
        tells = (z >= LEAST_Z) & (value >= LEAST_ODDS)
        word, value, z = word[tells], value[tells], z[tells]
        order = np.lexsort((-z, word))
        word, value = word[order], value[order]
        first = np.concatenate(([True], word[1:] != word[:-1])) if len(word) else np.zeros(0, dtype=bool)
        return word[first], value[first]

    def once(self, words: Words, word: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of words that tell, those that stand first in their document: the odds are those of occurring in a document at all."""
        _, once = np.unique(mix(words.hash[word] ^ mix(words.doc[word].astype(np.uint64) + np.uint64(1))), return_index=True)
        once.sort()
        return word[once], value[once]

    def segments(self, words: Words, word: np.ndarray, value: np.ndarray, rest: float) -> list[list[tuple[float, int, int]]]:
        """Each document's maximal segments as (score, first word, word after the last)."""
        cut = np.searchsorted(word, words.first)
        out = []
        for i in range(len(words.count)):
            runs: list[tuple[float, int, int]] = []
            last = int(words.first[i])
            for w, v in zip(word[cut[i] : cut[i + 1]].tolist(), value[cut[i] : cut[i + 1]].tolist()):
                if w > last:
                    runs.append((rest * (w - last), last, w))
                runs.append((v, w, w + 1))
                last = w + 1
            out.append(maximal_segments(runs) if runs else [])
        return out

    def score(self, u: np.ndarray) -> np.ndarray:
        """The calibrated probability of label 1."""
        # Between two levels the evidence decides; where they are level it still orders texts, by a thousandth at most.
        return 0.999 * np.interp(u, *self.model.levels) + 0.001 * (u - _U_LOW) / (_U_HIGH - _U_LOW)


def _calibrate(rows: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Levels of evidence and the probability of label 1 there, never falling: isotonic regression over (bin, label, documents)."""
    total: dict[int, list[float]] = {}
    for u, y, n in rows:
        own = total.setdefault(u, [0.0, 0.0])
        own[0] += n
        own[1] += n * y
    pools: list[list[float]] = []
    for u in sorted(total):
        n, y = total[u]
        pools.append([n, y, (u + 0.5) * n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [x + z for x, z in zip(pools[-1], last)]
    return np.array([_U_LOW + _U_STEP * c / n for n, _, c in pools]), np.array([y / n for n, y, _ in pools])


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on documents (doc_id, text) with a label (doc_id, toxic), on about ``train_rows`` of them at most.

    Every part is a job over those documents: counts per place, then the evidence of each document with its own count taken
    out, in bins. The driver gets the telling places (2 * PLACES at most) and the bins. Rows without a doc_id, text or label do
    not count; of labels that contradict each other, 1 holds. Without labels of both kinds every score is the share of
    label 1, or just below 0.5 without any.
    """
    labels = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("long").alias("_toxic"))
    known = labels.count()
    if known > train_rows:
        labels = labels.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < int((1 << 30) * train_rows / known))
    # About train_rows labels, so the broadcast is bounded by the parameter.
    train = ready(docs).select("doc_id", "text").where("text is not null").join(F.broadcast(labels), "doc_id").select("text", "_toxic")
    sizes = {r["_toxic"]: r["n"] for r in train.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    none = tuple(np.zeros(0, dtype=np.int64) for _ in range(TABLES))
    if not n_toxic or not n_clean:
        share = np.full(1, (n_toxic + 0.5) / (n_toxic + n_clean + 1.0))
        return Model(none, none, none, n_toxic, n_clean, levels=(np.zeros(1), share))
    blocks = train.mapInArrow(_count, "block int, counts binary").repartition("block").sortWithinPartitions("block")
    found = blocks.mapInArrow(_telling(n_toxic, n_clean), "place long, toxic long, clean long").collect()
    place, toxic, clean = (np.array([r[k] for r in found], dtype=np.int64) for k in range(3))
    tables = [place // PLACES == t for t in range(TABLES)]
    model = Model(
        tuple(place[t] - PLACES * k for k, t in enumerate(tables)), tuple(toxic[t] for t in tables), tuple(clean[t] for t in tables), n_toxic, n_clean
    )
    hits = train.mapInArrow(_hits(model), "toxic long, tells long, once long, words long")
    sums = {r[0]: r[1:] for r in hits.groupBy("toxic").agg(F.sum("tells"), F.sum("once"), F.sum("words")).collect()}

    def rest(k: int) -> float:
        rate = {y: (r[k] + 0.5) / (r[2] + 1.0) for y, r in sums.items()}
        return min(math.log((1 - rate.get(1, 0.0)) / (1 - rate.get(0, 0.0))), -1e-4)

    model = replace(model, rest=rest(0), rest_once=rest(1))
    bins = train.mapInArrow(_evidence(model), "bin int, toxic long").groupBy("bin", "toxic").count().collect()
    return replace(model, levels=_calibrate([tuple(r) for r in bins]))


def _hits(model: Model):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            label = batch.column("_toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            for row, words in letters(batch.column("text")):
                own = label[row : row + len(words.count)]
                tells = scorer.odds(words, own)
                n = [np.bincount(words.doc[word], minlength=len(own)) for word, _ in (tells, scorer.once(words, *tells))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (own, *n, words.count)], names=["toxic", "tells", "once", "words"])

    return work


def _bin(u: float) -> int:
    return int((min(max(u, _U_LOW), _U_HIGH) - _U_LOW) / _U_STEP)


def _evidence(model: Model):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            label = batch.column("_toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            for row, words in letters(batch.column("text")):
                own = label[row : row + len(words.count)]
                found = scorer.segments(words, *scorer.once(words, *scorer.odds(words, own)), model.rest_once)
                u = [_bin(evidence(s, int(n))) for s, n in zip(found, words.count)]
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int32()), pa.array(own)], names=["bin", "toxic"])

    return work


def score(docs: DataFrame, model: Model, passages: bool = False) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from 0.5 on), and with the toxic passages if asked.

    A passage is (score, begin, end) in bytes of the UTF-8 text, for each maximal segment over all telling words that is significant by
    itself. The document's score counts each telling word once, as the calibration does. Only the text is looked at. A null or empty text has no evidence and gets the score of that. All columns are kept but those
    named like a result, which are replaced; every row gets one row.
    """
    results = ["score", "predicted", *(["passages"] if passages else [])]
    plain = ready(docs.drop(*[c for c in results if c in docs.columns]))
    schema = StructType(list(plain.schema.fields)).add("score", "double").add("predicted", "integer")
    span = pa.list_(pa.struct([("score", pa.float64()), ("begin", pa.int64()), ("end", pa.int64())]))
    if passages:
        schema = schema.add("passages", ArrayType(StructType().add("score", "double").add("begin", "long").add("end", "long")))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for row, words in letters(batch.column("text")):
                n = len(words.count)
                tells = scorer.odds(words)
                found = scorer.segments(words, *scorer.once(words, *tells), model.rest_once)
                u = np.array([evidence(s, int(k)) for s, k in zip(found, words.count)], dtype=float)
                p = scorer.score(np.clip(u, _U_LOW, _U_HIGH))
                extra = [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
                if passages:
                    spans = [
                        [
                            {"score": s, "begin": int(words.begin[a] - words.bounds[i]), "end": int(words.end[b - 1] - words.bounds[i])}
                            for s, a, b in own
                            if s > math.log(KARLIN_K * int(words.count[i]) + 1.0)
                        ]
                        for i, own in enumerate(scorer.segments(words, *tells, model.rest))
                    ]
                    extra.append(pa.array(spans, span))
                part = batch.slice(row, n)
                yield pa.RecordBatch.from_arrays([*part.columns, *extra], names=[*part.schema.names, *results])

    return plain.mapInArrow(work, schema)
