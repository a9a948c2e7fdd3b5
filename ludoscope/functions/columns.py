"""Projection and reshaping of tables (inventory C4-C13)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

#: Columns of a wide form, which all pass through the driver and every plan.
WIDEST = 10_000


def project_rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """C4: the columns of ``names`` in that order, under their new names."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def round_cols(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round half to even."""
    return df.withColumns({c: F.bround(F.col(f"`{c}`"), d) for c, d in digits.items()})


def fill_cast(df: DataFrame, col: str, value: int = 0, dtype: str = "int") -> DataFrame:
    """Nulls to ``value``, then the column to ``dtype``."""
    return df.withColumn(col, F.coalesce(F.col(f"`{col}`"), F.lit(value)).cast(dtype))


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows that hold any null."""
    return df.na.drop("any")


def const_rating(df: DataFrame, value: float = 0.0) -> DataFrame:
    """The same rating on every row."""
    return df.withColumn("rating", F.lit(value))


def select_by_name(df: DataFrame, substring: str, exclude: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """The columns whose name contains ``substring``, without ``exclude``, after the ``keep`` columns."""
    chosen = [c for c in df.columns if substring in c and c not in exclude and c not in keep]
    return df.select(*[F.col(f"`{c}`") for c in [*keep, *chosen]])


def column_names(values: DataFrame, col: str) -> list:
    """The different values of a column in order, to become columns; more than ``WIDEST`` are refused.

    The long form holds the same and has no such limit.
    """
    found = [r[0] for r in values.select(col).distinct().orderBy(col).limit(WIDEST + 1).collect()]
    if len(found) > WIDEST:
        raise ValueError(f"more than {WIDEST} columns for {col}; use the long form")
    return found


def attribute_names(attrs: DataFrame, kind: str) -> list[str]:
    """The names of a kind in order, as far as they become columns: as many as the wide form has."""
    return column_names(attrs.where(F.col("kind") == kind), "name")


def one_hot(games: DataFrame, attrs: DataFrame, kind: str, names: Sequence[str] | None = None) -> DataFrame:
    """A boolean column ``<name>_<kind>`` per name, by default of all there are; games without the attribute hold false."""
    names = attribute_names(attrs, kind) if names is None else names
    flags = [
        F.coalesce(F.bool_or(F.when(F.col("name") == n, True)), F.lit(False)).alias(f"{n}_{kind}") for n in names
    ]
    held = attrs.where(F.col("kind") == kind).select("game_id", "name")
    return games.select("game_id").join(held, "game_id", "left").groupBy("game_id").agg(*flags)


def concat_features(a: DataFrame, b: DataFrame, key: str = "game_id") -> DataFrame:
    """C11: the columns of both tables side by side, row by row of the key."""
    return a.join(b, key)


def transpose(cells: DataFrame, row: str, col: str) -> DataFrame:
    """Swap rows and columns of a matrix in cell form."""
    return cells.withColumnsRenamed({row: "_row", col: row}).withColumnRenamed("_row", col).select(*cells.columns)


def describe_columns(df: DataFrame) -> DataFrame:
    """Name, type and number of values of each column, read in one pass."""
    counts = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"), F.lit(t).alias("type"), F.count(F.col(f"`{c}`")).alias("non_null")
                )
                for c, t in df.dtypes
            ]
        ).alias("_c")
    )
    return counts.select(F.inline("_c"))
