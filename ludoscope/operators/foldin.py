"""New ratings taken into a fitted ALS model without fitting it anew (inventory W5).

With the factors of the other side fixed, a user's (or a game's) factor is the solution of a small least-squares problem of its
own. Its k x k sums are partial aggregates, so somebody with a third of all ratings is no larger a task than anybody else.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, functions as F

from ludoscope.functions.scale import salted_lookup

#: Sweeps over a factor's places end when no place moves by more than this share of the largest.
CLOSE = 1e-12
MOST_SWEEPS = 10_000


def solve(a: np.ndarray, b: np.ndarray, nonnegative: bool) -> np.ndarray:
    """The minimum of x'Ax - 2b'x for each of n positive definite A (n x k x k) and b (n x k), over x >= 0 if asked.

    The bounded problems are swept place by place, all at once: each place moves to its own best value given the
    others. That ends at the only minimum there is.
    """
    if not nonnegative:
        return np.linalg.solve(a, b[:, :, None])[:, :, 0]
    x = np.zeros_like(b)
    open_ = np.arange(len(b))
    for _ in range(MOST_SWEEPS):
        before = x[open_].copy()
        for j in range(b.shape[1]):
            slope = b[open_, j] - np.einsum("nk,nk->n", a[open_, j], x[open_])
            x[open_, j] = np.maximum(0, x[open_, j] + slope / a[open_, j, j])
        moved = np.abs(x[open_] - before).max(axis=1) > CLOSE * np.maximum(np.abs(x[open_]).max(axis=1), 1e-300)
        open_ = open_[moved]
        if not len(open_):
            break
    return x


def fold_in(fixed: DataFrame, ratings: DataFrame, key: str, other: str, rank: int, reg: float = 0.2, nonnegative: bool = True) -> DataFrame:
    """(id, features) of every ``key`` of ``ratings`` (key, other, rating) against the ``fixed`` factors (id, features) of ``other``.

    The penalty is that of MLlib's ALS, ``reg`` times the number of ratings. Ratings without a value or with an unknown other
    side do not count; a key without any other gets no factor. Several ratings of a pair all count.
    """
    known = ratings.where(F.col("rating").isNotNull() & F.col(key).isNotNull()).select(key, F.col(other).cast("int").alias("_other"), F.col("rating").cast("double").alias("_r"))
    both = salted_lookup(known, fixed.select(F.col("id").alias("_other"), F.col("features").cast("array<double>").alias("_f")), "_other", [key])
    place = [F.col("_f")[i] for i in range(rank)]
    products = [F.sum(place[i] * place[j]).alias(f"a{i}_{j}") for i in range(rank) for j in range(i + 1)]
    sums = both.groupBy(F.col(key).cast("int").alias("id")).agg(
        F.count(F.lit(1)).alias("n"), *products, *[F.sum(F.col("_r") * place[i]).alias(f"b{i}") for i in range(rank)])

    def solved(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            a = np.zeros((len(part), rank, rank))
            for i in range(rank):
                for j in range(i + 1):
                    a[:, i, j] = a[:, j, i] = part[f"a{i}_{j}"]
            a[:, range(rank), range(rank)] += reg * part["n"].to_numpy()[:, None]
            x = solve(a, part[[f"b{i}" for i in range(rank)]].to_numpy(), nonnegative)
            yield pd.DataFrame({"id": part["id"], "features": list(x.astype("f4"))})

    return sums.mapInPandas(solved, "id int, features array<float>")


def replace_factors(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old`` factors with those of ``new`` in place of, and beside, its own."""
    return old.join(new.select("id"), "id", "left_anti").select("id", "features").unionByName(new.select("id", "features"))


def drift(old: DataFrame, new: DataFrame) -> float:
    """How far the ``new`` factors are from the ``old`` ones of their ids, squared, as a share of all old ones squared; new ids count whole."""

    def squared(a: str) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))

    total = old.agg(F.sum(squared("features"))).first()[0] or 0.0
    was = new.join(old.select("id", F.col("features").alias("_old")), "id", "left")
    apart = F.zip_with("features", F.coalesce("_old", F.transform("features", lambda x: F.lit(0.0).cast("float"))), lambda x, y: x - y)
    moved = was.select(apart.alias("d")).agg(F.sum(squared("d"))).first()[0] or 0.0
    return moved / total if total else float("inf") if moved else 0.0


def with_factors(model: ALSModel, users: DataFrame, games: DataFrame, path: str) -> ALSModel:
    """A model like ``model`` with other factors, stored at ``path``."""
    model.write().overwrite().save(path)
    users.select("id", "features").write.mode("overwrite").parquet(f"{path}/userFactors")
    games.select("id", "features").write.mode("overwrite").parquet(f"{path}/itemFactors")
    return ALSModel.load(path)
