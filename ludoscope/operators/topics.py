"""Matrix factorisation and topic models (inventory M1-M10).

A matrix is a table of cells (row, col, value); a factor is a table (id, f) with one short array
per row or column. Only k x k numbers ever reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, functions as F

from ludoscope.functions.scale import SALTS, hot_keys, salted_lookup, top_per_key, with_position
from ludoscope.functions.text import terms
from ludoscope.operators.text import without_stop
from ludoscope.operators.topicmodel import Documents, TopicModel, fit, place
from ludoscope.session import cut_lineage, scratch_path

TINY = 1e-12
#: Ids in a block of a factor, as a power of two, and cells that one place of a block holds on average.
BLOCK_BITS, STRIPE_CELLS = 12, 500_000


@dataclass
class Factors:
    """W (row, f) and H (col, f) of V ~ W H."""

    w: DataFrame
    h: DataFrame
    k: int


@dataclass
class _Side:
    """The cells placed by one key, and in how many places each factor row of that key is needed."""

    cells: DataFrame
    copies: DataFrame
    key: str


def _place(cells: DataFrame, key: str, other: str) -> _Side:
    """Store the cells by ``key``, a key with many cells spread over several places."""
    counts = cells.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    hot = F.broadcast(hot_keys(counts, key))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    placed = cells.join(hot, key, "left").withColumn("_salt", salt).drop("_hot")
    placed = placed.repartition(key, "_salt").sortWithinPartitions(key, "_salt")
    copies = counts.join(hot, key, "left").select(
        F.col(key), F.when(F.col("_hot"), SALTS).otherwise(1).alias("_copies")
    )
    return _Side(cut_lineage(placed, keep_partitioning=True), cut_lineage(copies), key)


def _sums(k: int) -> list[Column]:
    """Per topic, the sum of cell value x factor."""
    return [F.expr(f"sum(value * f[{i}]) AS _s{i}") for i in range(k)]


def _weighted(side: _Side, factor: DataFrame, out: str, k: int) -> DataFrame:
    """(out, s): for each row or column, the sum of value x factor over its cells."""
    sent = factor.select(side.key, F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("_salt"), "f")
    joined = side.cells.join(sent, [side.key, "_salt"])
    return joined.groupBy(out).agg(*_sums(k)).select(out, F.array(*[f"_s{i}" for i in range(k)]).alias("s"))


def gram(factor: DataFrame, k: int) -> np.ndarray:
    """The k x k products of a factor with itself: the only numbers brought to the driver."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = factor.selectExpr(*[f"sum(f[{i}] * f[{j}])" for i, j in pairs]).first()
    out = np.zeros((k, k))
    for (i, j), value in zip(pairs, row):
        out[i, j] = out[j, i] = value or 0.0
    return out


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def start_factor(ids: DataFrame, key: str, k: int, seed: int, scale: Column) -> DataFrame:
    """Starting values in (0, 1] x ``scale`` that depend on the id alone."""

    def draw(i: int) -> Column:
        text = F.concat_ws("|", F.lit(f"{key}{seed}"), F.col(key).cast("string"), F.lit(str(i)))
        return (F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("double") + 1) / (1 << 24)

    kept = [c for c in ids.columns if c != key]
    return ids.select(key, *kept, F.array(*[draw(i) * scale for i in range(k)]).alias("f"))


def vcol_start(cells: DataFrame, key: str, other: str, k: int, seed: int, share: float = 0.2) -> DataFrame:
    """Starting values (key, f) as means: topic i starts from the mean of the ``other`` lines of the matrix drawn for it.

    About ``share`` of the lines are drawn for each topic, by a digest of their id; a topic that draws none takes all. With rows
    as ``key`` that is the mean of drawn columns, and the other way round.
    """
    text = lambda i: F.concat_ws("|", F.lit(f"vcol{seed}"), F.col(other).cast("string"), F.lit(str(i)))
    drawn = [F.conv(F.substring(F.md5(text(i)), 1, 6), 16, 10).cast("double") / (1 << 24) < share for i in range(k)]
    lines = cells.select(other).distinct().agg(F.count(F.lit(1)).alias("n"), *[F.count_if(d).alias(f"n{i}") for i, d in enumerate(drawn)]).first()
    sums = [F.sum(F.when(d if lines[f"n{i}"] else F.lit(True), F.col("value")).otherwise(0.0)) / float(lines[f"n{i}"] or max(lines["n"], 1)) for i, d in enumerate(drawn)]
    return cells.groupBy(key).agg(F.array(*sums).alias("f"))


def _blocks_from(ids: DataFrame, factor: DataFrame, key: str) -> DataFrame:
    """Starting values (key, f) as blocks (b, f)."""
    rows = ids.join(factor.withColumnRenamed(key, "id"), "id")
    listed = rows.groupBy("b").agg(F.array_sort(F.collect_list(F.struct("pos", "f"))).alias("_l"))
    return cut_lineage(listed.select("b", F.flatten(F.transform("_l", lambda x: x["f"])).alias("f")))


@dataclass
class Placed:
    """The cells of a matrix, stored once by row and once by column, with their mean."""

    by_row: _Side
    by_col: _Side
    mean: float

    @classmethod
    def of(cls, cells: DataFrame) -> Placed:
        cells = cells.select("row", "col", F.col("value").cast("double").alias("value"))
        by_row, by_col = _place(cells, "row", "col"), _place(cells, "col", "row")
        total = by_row.cells.agg(F.sum("value")).first()[0] or 0.0
        return cls(by_row, by_col, total / max(by_row.copies.count() * by_col.copies.count(), 1))

    @cached_property
    def stripes(self) -> tuple[_Stripes, _Stripes]:
        """The cells packed by row and by column, the same for every rank and run."""
        return _packed(self.by_row.cells.select("row", "col", "value"))

    @cached_property
    def squares(self) -> float:
        """The sum of all squared values."""
        return self.by_row.cells.selectExpr("sum(value * value)").first()[0] or 0.0

    @cached_property
    def counts(self) -> tuple[DataFrame, DataFrame]:
        """How many cells each row and each column has."""
        plain = self.by_row.cells
        return tuple(cut_lineage(plain.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))) for key in ("row", "col"))


@dataclass
class _Stripes:
    """The cells of one side's blocks of ids, packed: (b, sub, pos, other, value), and the ids themselves (b, pos, id)."""

    cells: DataFrame
    parts: DataFrame
    ids: DataFrame


def _numbered(cells: DataFrame, key: str) -> DataFrame:
    """(key, number), every id once."""
    return with_position(cells.select(key).distinct(), [F.col(key)], f"_{key}", start=0)


def _stripes(cells: DataFrame, ids: DataFrame, key: str, other: str) -> _Stripes:
    """Cells packed by blocks of ``key``, and a block with many cells over several places."""
    b, pos = F.shiftright(f"_{key}", BLOCK_BITS), F.col(f"_{key}").bitwiseAND((1 << BLOCK_BITS) - 1)
    rows = cells.select(b.alias("b"), pos.cast("int").alias("pos"), F.col(f"_{other}").alias("other"), "value")
    parts = cut_lineage(rows.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / STRIPE_CELLS).cast("int").alias("parts")))
    sub = F.pmod(F.xxhash64("other"), F.col("parts")).cast("int")
    packed = rows.join(parts, "b").withColumn("sub", sub).groupBy("b", "sub").agg(F.collect_list(F.struct("pos", "other", "value")).alias("_c"))
    packed = packed.select("b", "sub", *[F.col(f"_c.{n}").alias(n) for n in ("pos", "other", "value")])
    kept = cut_lineage(packed.sortWithinPartitions("b", "sub"), keep_partitioning=True)
    return _Stripes(kept, parts, cut_lineage(ids.select(b.alias("b"), pos.cast("int").alias("pos"), F.col(key).alias("id"))))


def _packed(cells: DataFrame) -> tuple[_Stripes, _Stripes]:
    """The stripes of the rows and of the columns, with ids numbered."""
    rows, cols = _numbered(cells, "row"), _numbered(cells, "col")
    both = cut_lineage(cells.join(rows, "row").join(cols, "col"))
    return _stripes(both, rows, "row", "col"), _stripes(both, cols, "col", "row")


def _blocks_of(ids: DataFrame, key: str, k: int, seed: int, scale: Column) -> DataFrame:
    """Starting values as blocks (b, f): a block's rows one behind the other."""
    rows = start_factor(ids.withColumnRenamed("id", key), key, k, seed, scale)
    listed = rows.groupBy("b").agg(F.array_sort(F.collect_list(F.struct("pos", "f"))).alias("_l"))
    return cut_lineage(listed.select("b", F.flatten(F.transform("_l", lambda x: x["f"])).alias("f")))


def _block_gram(blocks: DataFrame, k: int) -> np.ndarray:
    """The k x k products of a factor with itself, summed up over its blocks by Spark."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            for f in batch.column("f"):
                own = np.asarray(f.values).reshape(-1, k)
                total += own.T @ own
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total.ravel())], names=["i", "g"])

    out = np.zeros(k * k)
    for r in blocks.select("f").mapInArrow(work, "i long, g double").groupBy("i").agg(F.sum("g").alias("g")).collect():
        out[r["i"]] = r["g"]
    return out.reshape(k, k)


def _half_step(stripes: _Stripes, given: DataFrame, moved: DataFrame, k: int, alpha: float) -> DataFrame:
    """New blocks of one factor (Lee and Seung, 2001, with an L2 penalty ``alpha``) from the blocks of the other one.

    Factor blocks go to the stored stripes; a stripe sums up what it has for each id of the other side, and only these
    sums are shuffled, to the block that moves.
    """
    products = _block_gram(given, k)
    size = 1 << BLOCK_BITS

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pos, other, value, f in zip(*(batch.column(c) for c in ("pos", "other", "value", "f"))):
                f = np.asarray(f.values).reshape(-1, k)
                pos, other, value = (np.asarray(x.values) for x in (pos, other, value))
                ids, at = np.unique(other, return_inverse=True)
                total = np.stack([np.bincount(at, value * f[pos, i], minlength=len(ids)) for i in range(k)], axis=1)
                block = ids >> BLOCK_BITS
                cuts = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(ids)]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block[cuts[:-1]]), pa.array([1] * (len(cuts) - 1), pa.int32()),
                        pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array((ids & (size - 1)).astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array((cuts * k).astype(np.int32)), pa.array(total.ravel())),
                    ],
                    names=["b", "turn", "pos", "f"],
                )

    def update(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, old, above = None, np.zeros((0, k)), np.zeros((0, k))

        def done() -> pa.RecordBatch:
            new = old * above / (old @ products + alpha * old + TINY)
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([new.ravel()], pa.list_(pa.float64()))], names=["b", "f"])

        for batch in batches:
            for b, turn, pos, f in zip(batch.column("b").to_pylist(), batch.column("turn").to_pylist(), batch.column("pos"), batch.column("f")):
                own = np.asarray(f.values).reshape(-1, k)
                if turn == 0:
                    if block is not None:
                        yield done()
                    block, old, above = b, own, np.zeros_like(own)
                else:
                    above[np.asarray(pos.values)] += own
        if block is not None:
            yield done()

    sent = given.join(stripes.parts, "b").select("b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("sub"), "f")
    partial = stripes.cells.join(sent, ["b", "sub"]).select("pos", "other", "value", "f").mapInArrow(sums, "b long, turn int, pos array<int>, f array<double>")
    base = moved.select("b", F.lit(0).alias("turn"), F.array().cast("array<int>").alias("pos"), "f")
    both = base.unionByName(partial).repartition("b").sortWithinPartitions("b", "turn")
    return cut_lineage(both.mapInArrow(update, "b long, f array<double>"))


def nmf(
    cells: DataFrame | Placed,
    k: int,
    iters: int = 100,
    alpha: float = 0.0,
    seed: int = 34,
    tol: float | None = None,
    start: str = "draw",
) -> Factors:
    """M1: V ~ W H with no negative entry, by multiplicative updates on the cells.

    ``start`` is ``draw`` (a number per id) or ``vcol`` (means of drawn columns for W, of drawn rows for H).

    ``cells`` holds (row, col, value) with the non-zero entries. They are stored twice, packed by blocks of rows and by blocks
    of columns, so an iteration moves factor blocks and sums only. With ``tol`` the loop ends when the error falls
    by less than that share.
    """
    if isinstance(cells, Placed):
        plain, mean = cells.by_row.cells.select("row", "col", "value"), cells.mean
    else:
        plain, mean = cut_lineage(cells.select("row", "col", F.col("value").cast("double").alias("value"))), None
    by_row, by_col = cells.stripes if isinstance(cells, Placed) else _packed(plain)
    if mean is None:
        total = plain.agg(F.sum("value")).first()[0] or 0.0
        mean = total / max(by_row.ids.count() * by_col.ids.count(), 1)
    scale = F.lit(float(np.sqrt(mean / k)))
    if start == "vcol":
        w = _blocks_from(by_row.ids, vcol_start(plain, "row", "col", k, seed), "row")
        h = _blocks_from(by_col.ids, vcol_start(plain, "col", "row", k, seed), "col")
    else:
        w = _blocks_of(by_row.ids, "row", k, seed, scale)
        h = _blocks_of(by_col.ids, "col", k, seed, scale)

    def factors() -> Factors:
        return Factors(_rows_of(w, by_row.ids, "row", k), _rows_of(h, by_col.ids, "col", k), k)

    last = None
    for _ in range(iters):
        h = _half_step(by_row, w, h, k, alpha)
        w = _half_step(by_col, h, w, k, alpha)
        if tol is not None:
            error = nmf_error(cells if isinstance(cells, Placed) else plain, factors())
            if last is not None and last - error <= tol * last:
                break
            last = error
    return factors()


def _rows_of(blocks: DataFrame, ids: DataFrame, key: str, k: int) -> DataFrame:
    """(key, f), one row per id again."""
    size = (F.size("f") / k).cast("int")
    each = F.posexplode(F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.slice("f", i * k + 1, k)))
    rows = blocks.select("b", each.alias("pos", "f"))
    return rows.join(ids, ["b", "pos"]).select(F.col("id").alias(key), "f")


def nmf_error(cells: DataFrame | Placed, factors: Factors) -> float:
    """M2: the Frobenius norm of V - W H, reading the non-zero cells only."""
    k = factors.k
    side = cells.by_row if isinstance(cells, Placed) else _place(cells, "row", "col")
    squares = side.cells.selectExpr("sum(value * value)").first()[0] or 0.0
    across = _weighted(side, factors.w.join(side.copies, "row"), "col", k)
    dots = " + ".join(f"s[{i}] * f[{i}]" for i in range(k))
    cross = across.join(factors.h, "col").selectExpr(f"sum({dots})").first()[0] or 0.0
    rest = float((gram(factors.w, k) * gram(factors.h, k)).sum())
    return float(np.sqrt(max(squares - 2 * cross + rest, 0.0)))


def sparseness(factor: DataFrame, k: int) -> float:
    """Mean over topics of Hoyer's sparseness of the topic's entries."""
    one = [f"sum(abs(f[{i}]))" for i in range(k)]
    two = [f"sqrt(sum(f[{i}] * f[{i}]))" for i in range(k)]
    n, *norms = factor.selectExpr("count(1)", *one, *two).first()
    root = float(np.sqrt(n))
    return float(np.mean([
        (root - a / max(b, TINY)) / max(root - 1, TINY) for a, b in zip(norms[:k], norms[k:])
    ]))


def nmf_metrics(cells: DataFrame | Placed, factors: Factors) -> dict[str, float]:
    """M3: residual sum of squares, explained variance, Kullback-Leibler divergence, sparseness."""
    k = factors.k
    placed = cells if isinstance(cells, Placed) else Placed.of(cells)
    plain = placed.by_row.cells.drop("_salt")
    by_row, by_col = placed.counts
    half = salted_lookup(plain, factors.w.withColumnRenamed("f", "_w"), "row", ["col"], by_row)
    joined = salted_lookup(half, factors.h.withColumnRenamed("f", "_h"), "col", ["row"], by_col)
    fitted = _dot(F.col("_w"), F.col("_h"))
    v, x = F.col("value"), F.greatest(fitted, F.lit(TINY))
    row = joined.agg(
        F.sum(v * v).alias("squares"),
        F.sum(v * fitted).alias("cross"),
        F.sum(F.when(v > 0, v * F.log(v / x)).otherwise(0.0) - v).alias("kl"),
    ).first()
    sides = [
        np.array(f.selectExpr(*[f"sum(f[{i}])" for i in range(k)]).first(), dtype="f8")
        for f in (factors.w, factors.h)
    ]
    # The Frobenius norm as in ``nmf_error``, from the cells that are joined already.
    rss = max(placed.squares - 2 * (row["cross"] or 0.0) + float((gram(factors.w, k) * gram(factors.h, k)).sum()), 0.0)
    return {
        "rss": rss,
        "evar": 1 - rss / row["squares"],
        "kl": row["kl"] + float(sides[0] @ sides[1]),
        "sparseness_w": sparseness(factors.w, k),
        "sparseness_h": sparseness(factors.h, k),
    }


def nmf_sweep(cells: DataFrame, ranks: Sequence[int], iters: int = 100, alpha: float = 0.0, seed: int = 34) -> DataFrame:
    """M3: one row per rank with the error and the other measures of its factorisation."""
    placed = Placed.of(cells)
    rows = []
    for k in ranks:
        found = nmf_metrics(placed, nmf(placed, k, iters, alpha, seed))
        rows.append((k, float(np.sqrt(found["rss"])), *found.values()))
    return cells.sparkSession.createDataFrame(
        rows, "k int, error double, rss double, evar double, kl double, sparseness_w double, sparseness_h double"
    )


def consensus_dispersion(labels: DataFrame) -> DataFrame:
    """M3: how alike several runs' clusterings are: one row (n, runs, dispersion) from ``labels`` (row, run, topic).

    The consensus of two rows is the share of runs that put them together, the dispersion the mean of 4 (c - 1/2)^2 over all
    pairs, 1 if all runs agree. No table of pairs is made: the sum of c follows from the sizes of topics, that of c^2 from the sizes of
    two runs' topics' common parts, of which there are (runs x topics)^2. Every row has a label in every run.
    """
    lists = labels.groupBy("row").agg(F.collect_list(F.struct("run", "topic")).alias("l"))
    one = lists.select(F.explode("l").alias("a"), "l")
    common = one.select("a", F.explode("l").alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).cast("double").alias("n"))
    own = F.col("a.run") == F.col("b.run")
    sums = common.agg(
        F.sum(F.when(own & (F.col("a.topic") == F.col("b.topic")), F.col("n") * F.col("n"))).alias("once"),
        F.sum(F.col("n") * F.col("n")).alias("twice"), F.sum(F.when(own, F.col("n"))).alias("rows"), F.count_distinct(F.col("a.run")).alias("runs"))
    n, runs = F.col("rows") / F.col("runs"), F.col("runs").cast("double")
    spread = 4 * F.col("twice") / (runs * runs) - 4 * F.col("once") / runs + n * n
    return sums.select(n.cast("long").alias("n"), F.col("runs"), (spread / (n * n)).alias("dispersion"))


def nmf_consensus(cells: DataFrame, k: int, runs: int, iters: int = 100, alpha: float = 0.0, seed: int = 34, start: str = "vcol") -> DataFrame:
    """M3: the dispersion of ``runs`` factorisations that start from different draws, rows labelled by their strongest topic."""
    placed = Placed.of(cells)
    labels = None
    for run in range(runs):
        found = nmf(placed, k, iters, alpha, seed + run, start=start)
        one = assign_topic(found.w).select("row", F.lit(run).alias("run"), "topic")
        labels = one if labels is None else labels.unionByName(one)
    return consensus_dispersion(labels).withColumn("k", F.lit(k))


def topic_terms(h: DataFrame, n: int, key: str = "col") -> DataFrame:
    """M4: (topic, rank, term, weight) of the ``n`` heaviest terms of each topic."""
    long = h.select(F.col(key).alias("term"), F.posexplode("f").alias("topic", "weight"))
    long = long.withColumn("topic", F.col("topic") + 1)
    return top_per_key(long, ["topic"], [F.col("weight").desc(), F.col("term")], n, "rank")


def assign_topic(w: DataFrame, key: str = "row") -> DataFrame:
    """M5: (key, topic): the heaviest topic of each row, counting from 1; the first one wins a tie."""
    return w.select(key, F.array_position("f", F.array_max("f")).cast("int").alias("topic"))


def topic_sizes(assigned: DataFrame, k: int) -> DataFrame:
    """M6: rows in each topic; empty topics are listed with 0."""
    counts = assigned.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    every = assigned.sparkSession.range(1, k + 1).select(F.col("id").cast("int").alias("topic"))
    return every.join(counts, "topic", "left").select("topic", F.coalesce("n", F.lit(0)).alias("n"))


def label_games(games: DataFrame, assigned: DataFrame, official: DataFrame) -> DataFrame:
    """M7: games with their topic and official title; games without either drop out."""
    titles = official.select("game_id", F.col("title").alias("_title"))
    joined = games.join(assigned.select("game_id", "topic"), "game_id").join(titles, "game_id")
    return joined.select(
        F.col("rank").alias("Board Game Rank"),
        "game_id",
        F.col("game").alias("bgg_game"),
        F.col("_title").alias("Game"),
        F.col("description").alias("Description"),
        F.col("topic").alias("nmf"),
        F.col("playing_time").alias("Playing Time"),
        F.col("min_players").alias("Min Players"),
        F.col("max_players").alias("Max Players"),
        F.col("best_num_players").alias("Best Num Players"),
        "avg_rating",
        F.col("avg_weight").alias("Avg Weight"),
    )


def cluster_members(assigned: DataFrame, titles: DataFrame, cluster: int, col: str = "topic") -> DataFrame:
    """M8: ids and titles of one cluster."""
    return assigned.where(F.col(col) == cluster).join(titles, "game_id").select("game_id", "game")


@dataclass
class Topics:
    """A fitted LDA with its vocabulary, the documents' term counts as vectors, and those it was fitted on in blocks."""

    model: TopicModel
    words: CountVectorizerModel
    vectors: DataFrame
    documents: Documents

    @cached_property
    def shares(self) -> DataFrame:
        """(topic, share) of the corpus; worked out once, as it takes a pass over all documents."""
        k = range(self.model.k)
        # Rows of one id weigh by the length of all of them, and those of none not at all.
        each = self.model.shares(self.documents).groupBy("doc_id").agg(F.sum("length").alias("length"), *[F.sum(F.col("share")[t]).alias(f"s{t}") for t in k])
        own = F.when(F.col("doc_id").isNotNull(), F.col("length"))
        sums = each.agg(F.array(*[F.sum(F.col(f"s{t}") * own) / F.sum("length") for t in k]).alias("s"))
        return cut_lineage(sums.select(F.posexplode("s").alias("topic", "share")).withColumn("topic", F.col("topic") + 1))


def lda(
    docs: DataFrame,
    k: int,
    max_iter: int = 10,
    min_df: float = 1,
    max_df: float = 1.0,
    stop: Sequence[str] = (),
    seed: int = 34,
    weighted: bool = False,
) -> Topics:
    """M9: LDA on term counts, or ``weighted`` on TF-IDF rows of length 1 with idf = ln((1 + n) / (1 + df)) + 1.

    The vocabulary is MLlib's and kept on the driver, narrower document frequencies make it smaller; topics are not (``topicmodel``).
    The words of a document's parts are brought together, as a document is one vector.
    """
    words = without_stop(terms(F.col("text")), stop)
    if "part" in docs.columns:
        lists = F.array_sort(F.collect_list(F.struct("part", words.alias("w"))))
        listed = docs.groupBy("doc_id").agg(F.flatten(F.transform(lists, lambda x: x["w"])).alias("tokens"))
    else:
        listed = docs.select("doc_id", words.alias("tokens"))
    limits = {"minDF": float(min_df), "maxDF": float(max_df)}
    if isinstance(max_df, int) or max_df == 1.0:
        limits["maxDF"] = float(max_df) if isinstance(max_df, int) else float((1 << 63) - 1)
    found = CountVectorizer(inputCol="tokens", outputCol="features", vocabSize=(1 << 31) - 1, **limits).fit(listed)
    vectors = found.transform(listed).select("doc_id", "features")
    documents = place(vectors, len(found.vocabulary), k, weighted)
    return Topics(fit(documents, k, max_iter, seed), found, vectors, documents)


def vocabulary_table(topics: Topics) -> DataFrame:
    """(i, term) of a fitted model, from its stored form."""
    spark = topics.vectors.sparkSession
    path = scratch_path(spark, "vocabulary")
    topics.words.write().save(path)
    return spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("i", "term"))


def doc_topics(topics: Topics) -> DataFrame:
    """M9: (doc_id, topic, share) for every document and topic; shares of 0 for a document without a kept term."""
    none = topics.documents.empty.select("doc_id", F.array_repeat(F.lit(0.0), topics.model.k).alias("share"))
    every = topics.model.shares(topics.documents).select("doc_id", "share").unionByName(none)
    return every.select("doc_id", F.posexplode("share").alias("topic", "share")).withColumn("topic", F.col("topic") + 1)


def lda_terms(topics: Topics, n: int) -> DataFrame:
    """M9: (topic, rank, term, weight) of the ``n`` heaviest terms."""
    rows = topics.model.rows().select("i", F.posexplode("p").alias("topic", "weight"))
    best = top_per_key(rows, ["topic"], [F.col("weight").desc(), F.col("i")], n, "rank")
    return best.join(vocabulary_table(topics), "i").select((F.col("topic") + 1).alias("topic"), "rank", "term", "weight")


def topic_term_table(topics: Topics) -> DataFrame:
    """(topic, term, p) with p(term | topic), for every term."""
    rows = topics.model.rows().join(vocabulary_table(topics), "i").select("term", F.posexplode("p").alias("topic", "p"))
    return rows.select((F.col("topic") + 1).alias("topic"), "term", "p")


def topic_shares(topics: Topics) -> DataFrame:
    """(topic, share): how much of the corpus each topic holds, documents weighted by length."""
    return topics.shares


def term_relevance(topics: Topics, lam: float = 0.6, n: int = 30) -> DataFrame:
    """The ``n`` most relevant terms per topic: lam log p(w|t) + (1 - lam) log (p(w|t) / p(w))."""
    # A number per topic; a term's topics lie in one row, so p(w) takes no shuffle.
    shares = F.array(*[F.lit(r["share"]) for r in topics.shares.orderBy("topic").collect()])
    rows = topics.model.rows().join(vocabulary_table(topics), "i").withColumn("p_all", _dot(F.col("p"), shares))
    each = rows.select("term", "p_all", F.posexplode("p").alias("topic", "p")).withColumn("topic", F.col("topic") + 1)
    log_p = F.log("p")
    scored = each.withColumn("relevance", lam * log_p + (1 - lam) * (log_p - F.log("p_all")))
    return top_per_key(scored, ["topic"], [F.col("relevance").desc(), F.col("term")], n, "rank").select(
        "topic", "rank", "term", "p", "relevance"
    )


def topic_distances(topics: Topics) -> DataFrame:
    """Jensen-Shannon divergence between every two topics, in nats."""
    return topics.model.divergences()


def divergences(table: DataFrame) -> DataFrame:
    """Jensen-Shannon divergence of a table (topic, term, p), in nats: (topic_a, topic_b, divergence), topic_a being the smaller. A term a topic lacks has p = 0 there."""
    # k topics per term, so the pairs of a term are k x k however many documents there are.
    a = table.select(F.col("topic").alias("topic_a"), "term", F.col("p").alias("pa"))
    b = table.select(F.col("topic").alias("topic_b"), "term", F.col("p").alias("pb"))
    pa, pb = F.col("pa"), F.col("pb")
    middle = (pa + pb) / 2

    def half(p: Column) -> Column:
        return F.when(p > 0, p * F.log(p / middle)).otherwise(0.0) / 2

    both = a.join(b, "term").where(F.col("topic_a") < F.col("topic_b"))
    shared = both.groupBy("topic_a", "topic_b").agg(F.sum(half(pa) + half(pb)).alias("d"), F.sum("pa").alias("in_a"), F.sum("pb").alias("in_b"))
    # A term of one topic alone adds p log(2) / 2: what of either topic's total was not met above.
    totals = table.groupBy("topic").agg(F.sum("p").alias("total"))
    ids = totals.select(F.col("topic").alias("topic_a"), F.col("total").alias("all_a"), F.lit(1).alias("_k"))
    pairs = ids.join(totals.select(F.col("topic").alias("topic_b"), F.col("total").alias("all_b"), F.lit(1).alias("_k")), "_k").where("topic_a < topic_b")
    every = pairs.join(shared, ["topic_a", "topic_b"], "left")
    zero = F.lit(0.0)
    alone = F.col("all_a") - F.coalesce("in_a", zero) + F.col("all_b") - F.coalesce("in_b", zero)
    return every.select("topic_a", "topic_b", (F.coalesce("d", zero) + alone * float(np.log(2)) / 2).alias("divergence"))


def plane(distances: np.ndarray) -> np.ndarray:
    """Classical scaling: points in the plane whose distances are the best fit of rank two to a symmetric table of distances.

    Signs are fixed: of each axis, the point farthest from the middle, the first of several, is on the positive side.
    """
    k = len(distances)
    middle = np.eye(k) - 1.0 / k
    values, vectors = np.linalg.eigh(-0.5 * middle @ (distances**2) @ middle)
    out = np.zeros((k, 2))
    for axis, i in enumerate(np.argsort(-values, kind="stable")[:2]):
        at = vectors[:, i] * np.sqrt(max(values[i], 0.0))
        far = int(np.argmax(np.abs(at) > np.abs(at).max() * (1 - 1e-9)))
        out[:, axis] = -at if at[far] < 0 else at
    return out


def topic_map(table: DataFrame, shares: DataFrame) -> DataFrame:
    """(topic, x, y, share), topics of a table (topic, term, p) placed so that distances stand for divergences.

    The k x k divergences go through the driver.
    """
    spark = table.sparkSession
    ids = [r[0] for r in shares.select("topic").orderBy("topic").collect()]
    number = {t: i for i, t in enumerate(ids)}
    distances = np.zeros((len(ids), len(ids)))
    for r in divergences(table).collect():
        i, j = number[r["topic_a"]], number[r["topic_b"]]
        distances[i, j] = distances[j, i] = r["divergence"]
    rows = [(t, float(x), float(y)) for t, (x, y) in zip(ids, plane(distances) if ids else [])]
    kind = table.schema["topic"].dataType.simpleString()
    return spark.createDataFrame(rows, f"topic {kind}, x double, y double").join(shares.select("topic", "share"), "topic")


def term_saliency(table: DataFrame, shares: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` most salient terms over all topics, (term, p, distinctiveness, saliency).

    p is the term's share of the corpus; its distinctiveness how far its topics differ from those of the corpus (the sum over topics of
    p(t|w) log(p(t|w) / p(t))); saliency is their product. Ties go by term.
    """
    joint = table.where("p > 0").join(shares.where("share > 0").select("topic", "share"), "topic").withColumn("_j", F.col("p") * F.col("share"))
    # The sum of j/p log(j/(p share)) over topics is the sum of j log(p(w|t)) / p - log(p).
    sums = joint.groupBy("term").agg(F.sum("_j").alias("_p"), F.sum(F.col("_j") * F.log("p")).alias("_s"))
    told = F.col("_s") / F.col("_p") - F.log("_p")
    scored = sums.select("term", F.col("_p").alias("p"), told.alias("distinctiveness"), (F.col("_p") * told).alias("saliency"))
    return scored.orderBy(F.round(F.col("saliency"), 12).desc(), "term").limit(n)
