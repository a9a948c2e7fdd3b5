"""The corpus pipeline: toxic documents go, then poor ones, then near copies, then repeated passages; the rest is packed.

Every stage takes (spark, docs, sf_dir), with docs as the stage before left them, and returns a DataFrame. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ludoscope.llm import near_dups, packing, quality, repeats, toxicity
from ludoscope.llm.catalog import ADDED, PATTERN, RANKS, held_out, table
from ludoscope.session import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, after the labels that are not held out; a text without words is not."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return toxicity.score(docs.select(*COLUMNS), model).where("predicted = 0").select(*COLUMNS)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that every quality rule lets pass."""
    return quality.grade(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a similarity of 0.8 or more."""
    return near_dups.drop_near_duplicates(docs.select(*COLUMNS), percent=80)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 words or more that stand in an earlier one."""
    return repeats.strip_repeats(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces in sequences of 1024 ids."""
    return packing.pack(packing.token_pieces(docs, RANKS, PATTERN, added=ADDED))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_poor),
    ("near duplicates", drop_near_copies),
    ("repeated passages", drop_passages),
    ("packing", pack_sequences),
]

#: SQL cannot express the toxicity model; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
