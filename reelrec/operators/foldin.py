"""T4: factors of users who came after the fit, by one exact ALS half-step with the item factors as they are.

For a user with ratings r of items v the factors solve (sum v v' + reg n I) x = sum r v, n being the number of ratings: what ALS
itself solves for every user in its last step, so a user of the training set gets the model's own factors.

The sums are an aggregate over ratings: rows are dealt out by user and sorted, and a task adds them up as they come, one user's sums
at a time.  A user with at least one of ``HOT`` parts of all ratings (there are at most ``HOT`` such users) is dealt out over
``SALTS`` tasks; the partial sums, a few rows of fixed size per user, meet in a second step that solves.  Ratings of items that the
model does not know, and null or NaN ones, are left out; a user without any other gets no row.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HOT = 1000
SALTS = 32
CELLS = 1 << 20              # products held at once
SUMS = "userId int, n long, sums array<double>"


def _runs(users: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], users[1:] != users[:-1]])) if len(users) else np.zeros(0, dtype=np.int64)


def _added(batches: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``users, n, sums`` with the rows of a user side by side -> one row per user; the last user waits for the next batch."""
    held = None
    for users, n, sums in batches:
        if held is not None:
            users, n, sums = (np.concatenate([a, b]) for a, b in zip(held, (users, n, sums)))
        at = _runs(users)
        users, n, sums = users[at], np.add.reduceat(n, at), np.add.reduceat(sums, at, axis=0)
        held = users[-1:], n[-1:], sums[-1:]
        if len(users) > 1:
            yield users[:-1], n[:-1], sums[:-1]
    if held is not None:
        yield held


def _sums_task(rank: int):
    """Rows ``userId, rating, features`` sorted by user -> SUMS: the upper triangle of sum v v', then sum r v."""
    row, column = np.triu_indices(rank)

    def products(batches):
        step = max(1, CELLS // (rank * rank))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                v = np.asarray(batch.column("features").flatten(), dtype=np.float64).reshape(batch.num_rows, rank)
                r = np.asarray(batch.column("rating"), dtype=np.float64)
                yield (np.asarray(batch.column("userId")), np.ones(len(r), dtype=np.int64),
                       np.concatenate([v[:, row] * v[:, column], v * r[:, None]], axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for users, n, sums in _added(products(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(users, pa.int32()), pa.array(n), pa.array(list(sums), pa.list_(pa.float64()))],
                                             names=["userId", "n", "sums"])
    return run


def _solve_task(rank: int, reg: float):
    """SUMS sorted by user -> ``id, features``."""
    row, column = np.triu_indices(rank)

    def partial(batches):
        for b in batches:
            if b.num_rows:
                width = len(row) + rank
                yield (np.asarray(b.column("userId")), np.asarray(b.column("n")),
                       np.asarray(b.column("sums").flatten(), dtype=np.float64).reshape(b.num_rows, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for users, n, sums in _added(partial(batches)):
            a = np.zeros((len(users), rank, rank))
            a[:, row, column] = sums[:, :len(row)]
            a[:, column, row] = sums[:, :len(row)]
            a[:, range(rank), range(rank)] += reg * n[:, None]
            x = np.linalg.solve(a, sums[:, len(row):, None])[:, :, 0]
            yield pa.RecordBatch.from_arrays([pa.array(users, pa.int32()), pa.array(list(x.astype(np.float32)), pa.list_(pa.float32()))],
                                             names=["id", "features"])
    return run


def user_half_step(ratings: DataFrame, item_factors: DataFrame, rank: int, reg: float, *, hot: int = HOT) -> DataFrame:
    """``userId, movieId, rating`` and ``id, features`` -> ``id int, features array<float>`` of the users."""
    r = ratings.select("userId", "movieId", "rating").where("userId is not null and rating is not null and not isnan(rating)")
    counts = r.groupBy("userId").agg(F.count(F.lit(1)).alias("_n"))
    total = F.lit(r.count())
    large = F.broadcast(counts.where(F.col("_n") * hot >= total).select("userId", F.lit(True).alias("_large")))    # at most ``hot`` rows
    items = item_factors.select(F.col("id").alias("movieId"), "features")
    salt = F.when(F.col("_large"), F.pmod(F.xxhash64("movieId", "rating"), F.lit(SALTS))).otherwise(F.lit(0)).alias("_salt")
    rows = r.join(items, "movieId").join(large, "userId", "left").select("userId", "rating", "features", salt)
    sums = (rows.repartition("userId", "_salt").sortWithinPartitions("userId").drop("_salt")
            .mapInArrow(_sums_task(rank), SUMS))
    return (sums.repartition("userId").sortWithinPartitions("userId")
            .mapInArrow(_solve_task(rank, reg), "id int, features array<float>"))


def fold_in(model: ALSModel, ratings: DataFrame, reg: float) -> DataFrame:
    """Factors of the users of ``ratings`` under the model's items; ``reg`` is the one the model was fitted with."""
    return user_half_step(ratings, model.itemFactors, model.rank, reg)
