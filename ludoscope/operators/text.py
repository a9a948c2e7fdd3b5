"""Corpora, term counts and TF-IDF in long form (inventory T1-T10)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ludoscope.functions.scale import salted_lookup, top_per_key, with_position
from ludoscope.functions.text import terms, tokens
from ludoscope.operators.ngrams import ngram_weights
from ludoscope.session import stored


def comments_corpus(comments: DataFrame, order: Sequence[str], part_rows: int = 10_000) -> DataFrame:
    """The comments of each game joined by blanks, in order: (game_id, part, text).

    Missing comments are skipped. A game with more than ``part_rows`` comments goes on in a second
    part and so on, because its whole text need not fit one row. Parts are rows of one document: the
    counts below add them up, count the document once, and let phrases run on over their edges.
    """
    said = comments.where(F.col("comment").isNotNull()).select("game_id", *order, "comment")
    placed = with_position(said, [F.col("game_id"), *[F.col(c) for c in order], F.col("comment")], "_place", start=0)
    games = placed.groupBy("game_id").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    numbered = salted_lookup(
        placed, games.select("game_id", "_first"), "game_id", ["_place"], games.select("game_id", "_rows"))
    part = F.floor((F.col("_place") - F.col("_first")) / part_rows).alias("part")
    lines = F.array_sort(F.collect_list(F.struct("_place", "comment")))
    return numbered.groupBy("game_id", part).agg(
        F.array_join(F.transform(lines, lambda x: x["comment"]), " ").alias("text")
    )


def tokenize(docs: DataFrame, col: str = "text") -> DataFrame:
    """The words of each document as an array column ``tokens``."""
    return docs.withColumn("tokens", tokens(F.col(col))).drop(col)


def _put_lemmas(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of words ``_t`` with the lemmas of the known ones among them, ``_w``, in their place."""
    for batch in batches:
        known, texts = batch.column("_w").flatten(), batch.column("_t")
        lists = texts.flatten()
        words = lists.flatten()
        if len(known):
            at = pc.index_in(words, value_set=known.field("token"))
            words = pc.coalesce(pc.take(known.field("lemma"), at), words)

        def ends(of: pa.ListArray) -> pa.Array:
            lengths = pc.fill_null(pc.list_value_length(of), 0).to_numpy(zero_copy_only=False)
            return pa.array(np.concatenate(([0], np.cumsum(lengths))).astype("i4"))

        done = pa.ListArray.from_arrays(ends(texts), pa.ListArray.from_arrays(ends(lists), words))
        keys = [c for c in batch.schema.names if c not in ("_t", "_w")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keys), done], names=[*keys, "_t"])


def lemmatize(docs: DataFrame, lemmas: DataFrame | None = None) -> DataFrame:
    """Lower-cased lemmas in place of the tokens.

    ``lemmas(token, lemma)`` is the dictionary, one row per lower-cased token; tokens it lacks stay
    as they are. Characters that are no word characters are stripped. A row is known by its doc_id (and part).
    """
    lower = F.transform("tokens", lambda t: F.lower(t))
    if lemmas is not None:
        key = [c for c in ("doc_id", "part") if c in docs.columns]
        others = docs.drop("tokens")
        held = docs.select(*key, lower.alias("_t"))
        # Each word of a document once, and on from there only those the dictionary knows; texts stay lists.
        words = held.select(*key, F.explode(F.array_distinct("_t")).alias("token"))
        known = words.join(lemmas.where("token IS NOT NULL").select("token", "lemma"), "token").select(
            *key, F.lit(None).cast("array<string>").alias("_t"), F.struct("token", "lemma").alias("_w"))
        whole = held.withColumn("_w", F.lit(None).cast("struct<token:string,lemma:string>")).unionByName(known)
        found = whole.groupBy(*key).agg(F.collect_list("_t").alias("_t"), F.collect_list("_w").alias("_w"))
        # Rows of one document are one text, their words in order of place.
        places = F.flatten(F.transform("_t", lambda t: F.transform(t, lambda x, i: F.struct(i.alias("pos"), x.alias("token")))))
        docs = found.mapInArrow(_put_lemmas, found.select(*key, "_t").schema).select(*key, F.when(F.size("_t") > 1, F.transform(
            F.array_sort(places), lambda p: p["token"])).otherwise(F.flatten("_t")).alias("tokens"))
        docs = others.join(docs, key) if others.columns != key else docs
    else:
        docs = docs.withColumn("tokens", lower)
    return docs.withColumn("tokens", F.transform("tokens", lambda t: F.regexp_replace(t, r"[^\p{L}\p{N}_]+", "")))


def without_stop(words: Column, stop: Sequence[str]) -> Column:
    """T4: the words that are not on the list; repeated words stay repeated."""
    if not stop:
        return words
    return F.filter(words, lambda w: ~w.isin(*stop))


def remove_stopwords(docs: DataFrame, stop: Sequence[str]) -> DataFrame:
    """T4: the same on the ``tokens`` column."""
    return docs.withColumn("tokens", without_stop(F.col("tokens"), stop))


def ngrams(words: Column, low: int = 1, high: int = 3, after: Column | None = None) -> Column:
    """All runs of ``low`` to ``high`` neighbouring words, joined by blanks, that start in ``words``.

    ``after`` holds the words that follow, where a text goes on in another row.
    """
    whole = words if after is None else F.concat(words, after)

    def of_length(n: int) -> Column:
        last = F.least(F.size(words), F.size(whole) - (n - 1))
        starts = F.when(last >= 1, F.sequence(F.lit(1), last))
        runs = F.transform(starts, lambda i: F.array_join(F.slice(whole, i, n), " "))
        return F.coalesce(runs, F.array().cast("array<string>"))

    return F.concat(*[of_length(n) for n in range(low, high + 1)])


def _with_following(lists: DataFrame, n: int) -> DataFrame:
    """Parts (doc_id, part, _w) with ``_after``, the first ``n`` words of the parts behind; parts without words are left out."""
    lists = lists.where(F.size("_w") > 0)
    heads = lists.select("doc_id", "part", F.slice("_w", 1, n).alias("_head"))
    behind = Window.partitionBy("doc_id").orderBy("part").rowsBetween(1, n)
    after = F.slice(F.flatten(F.collect_list("_head").over(behind)), 1, n)
    return lists.join(heads.select("doc_id", "part", after.alias("_after")), ["doc_id", "part"])


def term_counts(docs: DataFrame, stop: Sequence[str] = (), ngram_range: tuple[int, int] = (1, 1)) -> DataFrame:
    """T5: (doc_id, term, tf) over lower-cased words of two or more characters; parts of a document count as one.

    Whole texts are brought together by document, so their terms, which take many times their room, are counted where they are. A
    document in parts may be of any size and has its terms shuffled instead.
    """
    words = without_stop(terms(F.col("text")), stop)
    if "part" not in docs.columns:
        docs = docs.select("doc_id", "text").repartition("doc_id")
    if ngram_range != (1, 1):
        parted = "part" in docs.columns and ngram_range[1] > 1
        lists = docs.select("doc_id", *(["part"] if parted else []), words.alias("_w"))
        if parted:
            lists = _with_following(lists, ngram_range[1] - 1)
        words = ngrams(F.col("_w"), *ngram_range, F.col("_after") if parted else None)
        docs = lists
    return docs.select("doc_id", F.explode(words).alias("term")).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def n_documents(docs: DataFrame) -> Column:
    """The number of documents, each counted once however many parts it has."""
    return docs.agg(F.count_distinct("doc_id")).scalar()


def counted_terms(
    docs: DataFrame, stop: Sequence[str] = (), ngram_range: tuple[int, int] = (1, 1)
) -> tuple[DataFrame, DataFrame]:
    """The term counts and the (term, df) table, each stored once as several steps read them."""
    counts = stored(term_counts(docs, stop, ngram_range), "term-counts")
    return counts, stored(counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "frequencies")


def within_limits(
    frequencies: DataFrame, n_docs: Column, min_df: float = 1, max_df: float = 1.0
) -> DataFrame:
    """T5: the (term, df) within the limits; whole numbers count documents, fractions are shares of them."""
    low = F.lit(min_df) if isinstance(min_df, int) else min_df * n_docs
    high = F.lit(max_df) if isinstance(max_df, int) else max_df * n_docs
    return frequencies.where((F.col("df") >= low) & (F.col("df") <= high))


def count_vectorize(
    docs: DataFrame,
    min_df: float = 1,
    max_df: float = 1.0,
    stop: Sequence[str] = (),
    ngram_range: tuple[int, int] = (1, 1),
) -> DataFrame:
    """T5: term counts of the terms within the document-frequency limits: (doc_id, term, tf, df)."""
    counts, frequencies = counted_terms(docs, stop, ngram_range)
    n_docs = n_documents(docs)
    kept = within_limits(frequencies, n_docs, min_df, max_df)
    return salted_lookup(counts, kept, "term", ["doc_id"], frequencies.withColumnRenamed("df", "_rows"))


def vocabulary(counts: DataFrame, start: int = 0) -> DataFrame:
    """(term, term_id) in alphabetical order."""
    return with_position(counts.select("term").distinct(), [F.col("term")], "term_id", start)


def tfidf(
    docs: DataFrame,
    min_df: float = 1,
    max_df: float = 1.0,
    stop: Sequence[str] = (),
    ngram_range: tuple[int, int] = (1, 1),
    numbered: bool = False,
) -> DataFrame:
    """(doc_id, term, tf, tfidf) with idf = ln((1 + n) / (1 + df)) + 1 and rows of length 1.

    T10 is this with a domain ``stop`` list and ``max_df=0.5``. ``numbered`` adds ``term_id``. Runs of words of whole texts are known by
    their hashes (``ngrams``), as a table of them is many times the text.
    """
    if ngram_range[1] > 1 and not numbered and "part" not in docs.columns:
        return ngram_weights(docs.select("doc_id", "text"), without_stop(terms(F.col("text")), stop), *ngram_range, min_df, max_df)
    counts, frequencies = counted_terms(docs, stop, ngram_range)
    n_docs = n_documents(docs)
    kept = within_limits(frequencies, n_docs, min_df, max_df)
    idf = F.log((1 + n_docs) / (1 + F.col("df"))) + 1
    weights = kept.withColumn("_idf", idf)
    if numbered:
        weights = with_position(weights, [F.col("term")], "term_id", start=0)
    sizes = frequencies.withColumnRenamed("df", "_rows")
    raw = salted_lookup(counts.where("doc_id IS NOT NULL"), weights, "term", ["doc_id"], sizes).withColumn("_w", F.col("tf") * F.col("_idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy("doc_id")))
    return raw.select("doc_id", "term", "tf", (F.col("_w") / norm).alias("tfidf"), *(["term_id"] if numbered else []))


def top_phrases(weights: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` terms of the highest weight in each document, ties in alphabetical order."""
    return top_per_key(weights, ["doc_id"], [F.col("tfidf").desc(), F.col("term")], n, "rank")


