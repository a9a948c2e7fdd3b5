"""Small building blocks that keep plans even when a key is hot or an order is global."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ludoscope.session import cut_lineage

# A key is hot when it holds more than 1/256 of the rows, so at most 255 keys can be.
HOT_PARTS = 256
SALTS = 32


def hot_keys(counts: DataFrame, key: str, rows: str = "_rows") -> DataFrame:
    """Keys with more than 1/256 of all rows; never more than 255 of them, whatever the data."""
    total = counts.agg(F.sum(rows)).scalar()
    return counts.where(F.col(rows) * HOT_PARTS > total).select(key, F.lit(True).alias("_hot"))


def salted_lookup(
    facts: DataFrame,
    dims: DataFrame,
    key: str,
    spread_by: Sequence[str],
    counts: DataFrame | None = None,
    how: str = "inner",
) -> DataFrame:
    """Join of a large table to a table with unique keys, with hot keys split.

    Rows of a hot key go to ``SALTS`` places picked by ``spread_by``; only the dimension rows of
    those few keys are copied. Rows without a key match nothing and are spread as well.
    ``counts(key, _rows)`` may be passed when it is known already. Lookups that are not done over
    and over leave hot keys to adaptive execution instead, which needs no counts.
    """
    if counts is None:
        counts = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    hot = F.broadcast(hot_keys(counts, key))
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int")
    left = facts.join(hot, key, "left").withColumn(
        "_salt", F.when(F.col("_hot") | F.col(key).isNull(), salt).otherwise(F.lit(0))
    )
    right = dims.join(hot, key, "left").withColumn(
        "_salt",
        F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))),
    )
    return left.drop("_hot").join(right.drop("_hot"), [key, "_salt"], how).drop("_salt")


def with_position(df: DataFrame, order: Sequence[Column], name: str, start: int = 1) -> DataFrame:
    """Add the row's place in a total order, without bringing the rows into one task.

    Rows are range-partitioned and sorted; the table of partition sizes (one row per partition)
    gives each partition its offset. The sorted rows are stored first, so both passes see the
    same partitions even when an executor is lost.
    """
    placed = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_off") + F.col("_at").bitwiseAND((1 << 33) - 1) + start)
        .drop("_part", "_off", "_at")
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Column, keep: Sequence[str]) -> DataFrame:
    """The ``keep`` columns of the smallest row per key by ``order``; partly aggregated before the shuffle."""
    best = F.min_by(F.struct(*keep), order).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in keep])


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str) -> DataFrame:
    """The first ``n`` rows per key; Spark limits each key before the shuffle, so a hot key stays small."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)


def product(
    left: DataFrame, left_key: str, right: DataFrame, right_key: str, left_blocks: int = 32, right_blocks: int = 32
) -> DataFrame:
    """Every pair of a left and a right row, as an equi-join on even cells, one per two blocks.

    The pairs are the feature itself (all candidates of all users). No side has to fit in memory and
    no cell grows with a hot key, because cells are picked by hash of the unique keys.
    """

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    def block(key: str, blocks: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")

    rows = left.withColumn("_lb", block(left_key, left_blocks)).withColumn("_rb", every(right_blocks))
    cols = right.withColumn("_rb", block(right_key, right_blocks)).withColumn("_lb", every(left_blocks))
    return rows.join(cols, ["_lb", "_rb"]).drop("_lb", "_rb")
