"""Mixing of sources to target weights: tokens per source give a repetition rate, and each document is emitted so often.

Everything is a DataFrame expression. Words are counted where the text is read, sums per source are partial before the
shuffle, and a document's copies depend on its own row and the seed alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ludoscope.functions.scale import salted_lookup, with_position
from ludoscope.llm.frames import ready
from ludoscope.session import cut_lineage

WEIGHTS = (3, 1, 2)
PERCENT, LIMIT = 150, 2
#: The rates are broadcast up to so many sources and bytes of their names; beyond, rows are looked up by salted keys.
BROADCAST_SOURCES, BROADCAST_BYTES = 50_000, 4_000_000

WORD, BLANKS = r"[^\x20\x09-\x0D]++", " \t\n\x0b\f\r"


def word_count(text: str | Column) -> Column:
    """The number of words of a text: every word becomes one sign, then blanks go. A null has none."""
    return F.length(F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "x"), BLANKS, "")).cast("long")


def _level(sources: DataFrame, percent: int, limit: int) -> DataFrame:
    """``sources`` (source, source_size, weight) with ``target``: the share by weight, nowhere above the limit.

    Whoever is above stops at the limit and the others share what is left by weight, until nobody is above. Sums are whole
    numbers, and a pass is one sum over the table.
    """
    exact = "decimal(38,0)"
    sums = [F.coalesce(F.sum(F.col(c).cast(exact)), F.lit(0)).alias(c) for c in ("source_size", "weight")]
    whole = sources.agg(*sums).first()
    budget, weight, stopped = percent * int(whole["source_size"]), int(whole["weight"]), 0
    left = budget
    while True:
        # Of whole numbers: weight * left / (100 * total weight) > limit * size. Who is above once stays so, as shares only grow.
        share = F.col("weight").cast(exact) * F.lit(left).cast(exact)
        above = share > F.lit(100 * limit * weight).cast(exact) * F.col("source_size")
        now = sources.where(above).agg(F.count(F.lit(1)).alias("n"), *sums).first()
        if now["n"] == stopped:
            break
        stopped, left = now["n"], budget - 100 * limit * int(now["source_size"])
        weight = int(whole["weight"]) - int(now["weight"])
        if not weight:
            above = F.lit(True)
            break
    shared = F.col("weight") * F.lit(float(left)) / F.lit(float(100 * max(weight, 1)))
    target = F.when(above, (limit * F.col("source_size")).cast("double")).otherwise(shared)
    return sources.select("source", "source_size", "weight", target.alias("target"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, limit: int = LIMIT) -> DataFrame:
    """(source, source_size, weight, target) from rows of (source, size).

    Sources in order of code points, null last, take the weights in turn, and share ``percent`` of all sizes; a target stops
    at ``limit`` times its source's size. Without any size all targets are 0.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = with_position(sums, [F.col("source").asc_nulls_last()], "_place", start=0)
    turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod("_place", F.lit(len(weights))) + 1).cast("int"))
    return _level(placed.select("source", "source_size", turn.cast("long").alias("weight")), percent, limit)


def draw(seed: int, *columns: str | Column) -> Column:
    """A number from 0 to 1 that depends on the columns and the seed only: the first 52 bits of a digest."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c, F.lit("-")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def plan_mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, limit: int = LIMIT, seed: int = 0) -> DataFrame:
    """``docs`` (doc_id, source, text and more) with size, source_size, target and copies.

    A source's rate is its target over its size. Each document is taken floor(rate) times and once more if its draw is below
    the fraction, so copies are ``limit`` at most. Draws are made from doc_id, or from the text where it is null. Columns of
    these four names are replaced. Repeated rows are drawn alike; a null or empty text has size 0; an empty table gives an
    empty one.
    """
    new = ["size", "source_size", "target", "copies"]
    rows = ready(docs.drop(*new)).withColumn("size", word_count("text"))
    rates = cut_lineage(source_targets(rows.select("source", "size"), weights, percent, limit))
    extent = rates.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("source")), F.lit(0)).alias("bytes")).first()
    # Null is a source like any other: both sides carry a key that tells it from all names.
    key, taken = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")), set(docs.columns)
    name = next(n for n in ("_key", *(f"_key{i}" for i in range(len(taken)))) if n not in taken)
    rates = rates.select(key.alias(name), "source_size", "target")
    rows = rows.withColumn(name, key)
    if extent["n"] <= BROADCAST_SOURCES and extent["bytes"] <= BROADCAST_BYTES:
        both = rows.join(F.broadcast(rates), name)
    else:
        both = salted_lookup(rows, rates, name, ["doc_id"])
    rate = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    again = draw(seed, F.coalesce(F.col("doc_id").cast("string"), F.col("text"))) < rate - F.floor(rate)
    return both.withColumn("copies", (F.floor(rate) + again.cast("long")).cast("int")).select(*rows.drop(name).columns, *new[1:])


def mix(docs: DataFrame, **options: object) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as ``plan_mix`` says, ``copy`` counting from 0."""
    plan = plan_mix(docs.drop("copy"), **options)
    copies = F.explode(F.sequence(F.lit(0), F.col("copies") - 1))
    return plan.where("copies > 0").select("*", copies.alias("copy")).drop("size", "source_size", "target", "copies")
