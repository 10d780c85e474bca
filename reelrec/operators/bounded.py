"""M5 M6: exact top-k of dot products that leaves out items which cannot be among the best.

|u . i| <= |u| |i|, so with the items in descending order of their norms a user is done as soon as his norm times the next
norm is under his k-th score.  The catalogue is cut into slices by norm (bounds from approximate quantiles; items of one norm are
dealt out by hash): the first of about ``slice_bytes``, each of the next twice as large, up to ``SLICE_BYTES``.  The slices go to
every task one after the other, largest norms first: a round scores the
users that are still open against one slice, in chunks of ``scoring.CHUNK`` items, and a chunk is scored for those users alone whose
bound reaches their k-th score.  Between rounds the users' lists are a written table; users that are done are no longer
read, and once none is open the rest of the catalogue is not either.  The result is that of scoring every pair, ties included: a chunk
is left out only if its bound is strictly lower (with a margin for rounding), and equal scores go to the smaller item id.

A slice has a size bound whatever the catalogue is; the rounds are as many as slices, and each reads fewer users.  With norms that are
all alike nothing can be left out; ``scored`` says how many pairs were.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrec.operators.scoring import MARGIN, USERS, by_norm, lists, matrix, scan
from reelrec.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 32 << 20       # float64 features of a slice
LISTS = "id int, norm double, features array<double>, ids array<int>, scores array<double>, scored long"


def _norm(features: F.Column) -> F.Column:
    return F.sqrt(F.aggregate(features, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def _round_task(shared, k: int, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, USERS):
                batch = whole.slice(at, USERS)
                n = batch.num_rows
                ids = np.array(batch.column("ids").flatten(), dtype=np.int64).reshape(n, k)
                scores = np.array(batch.column("scores").flatten(), dtype=np.float64).reshape(n, k)
                norm = np.asarray(batch.column("norm"), dtype=np.float64)
                feat = matrix(batch.column("features"), dim)
                scored = scan(feat, norm, np.full(n, -np.inf), ids, scores, shared.value, k)
                total = np.asarray(batch.column("scored"), dtype=np.int64) + scored
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("norm"), batch.column("features"), lists(ids.astype(np.int32), pa.int32()),
                     lists(scores, pa.float64()), pa.array(total)],
                    names=["id", "norm", "features", "ids", "scores", "scored"])
    return run


def _cuts(items: DataFrame, n: int, first: int, most: int) -> list[float]:
    """Norms between slices of ``first`` items, then twice as many each, ``most`` at most; largest first."""
    at, rows, sizes = 0, first, []
    while at + rows < n:
        at, rows = at + rows, min(2 * rows, most)
        sizes.append(at)
    error = max(min(first, n) / (4 * n), 1e-5)
    return sorted(set(items.approxQuantile("norm", [1 - x / n for x in sizes], error)), reverse=True) if sizes else []


def _slices(items: DataFrame, cuts: list[float]) -> list[tuple[int, float, float]]:
    """``size, largest norm, lower bound`` of the items between neighbouring cuts, largest norms first; empty ones left out.
    The last one's lower bound is -inf: nothing comes after it."""
    over = F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut > F.col("norm")) if cuts else F.array()
    found = items.groupBy(F.size(over).alias("at")).agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("most")).orderBy("at").collect()
    return [(r["n"], r["most"], cuts[r["at"]] if r is not found[-1] else -math.inf) for r in found]


def bounded_lists(user_factors: DataFrame, item_factors: DataFrame, k: int = 5, *, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``id, ids, scores, scored``: each user's best items in order, and how many items were scored for it.  ``slice_bytes`` is the
    size of the first slice."""
    spark = user_factors.sparkSession
    double = F.transform("features", lambda x: x.cast("double")).alias("features")
    items = item_factors.select("id", double, _norm(F.col("features")).alias("norm"))
    items = stored(items.repartitionByRange("norm").sortWithinPartitions("norm"), "items")     # a slice is read from where it lies
    n, dim = items.agg(F.count(F.lit(1)), F.max(F.size("features"))).first()
    empty = F.array_repeat(F.lit(-1), k).alias("ids"), F.array_repeat(F.lit(-math.inf), k).alias("scores")
    users = user_factors.select("id", _norm(F.col("features")).alias("norm"), double, *empty, F.lit(0).cast("long").alias("scored"))
    if not n:
        return users.select("id", F.array().cast("array<int>").alias("ids"), F.array().cast("array<double>").alias("scores"), "scored")
    rows = max(1, slice_bytes // (8 * dim))
    most_rows = max(rows, SLICE_BYTES // (8 * dim))
    cuts = _cuts(items, n, rows, most_rows)
    open_, done = users, []
    for size, most, low in _slices(items, cuts):
        own = (F.col("norm") >= low) & (F.col("norm") <= most)
        deals = math.ceil(size / (2 * most_rows))                  # more than one where many items have one norm
        for deal in range(deals):
            part = items.where(own & (F.pmod(F.xxhash64("id"), F.lit(deals)) == deal)).select("id", "features").toArrow()   # a slice, twice at most
            shared = spark.sparkContext.broadcast(by_norm(part.column("id").to_numpy().astype(np.int64),
                                                          matrix(part.column("features").combine_chunks(), dim)))
            after = stored(open_.mapInArrow(_round_task(shared, k, dim), LISTS), "lists")
            rest = most if deal + 1 < deals else low          # no norm that is still to come is over it
            more = F.col("norm") * rest * (1 + MARGIN) >= F.element_at("scores", -1) if rest > -math.inf else F.lit(False)
            done.append(after.where(~more))
            open_ = after.where(more)
            shared.unpersist()
            if open_.isEmpty():
                return _listed(done)
    return _listed(done)


def _listed(done: list[DataFrame]) -> DataFrame:
    out = reduce(DataFrame.unionByName, done)
    found = F.filter(F.arrays_zip("ids", "scores"), lambda x: x["ids"] >= 0)
    return out.select("id", found["ids"].alias("ids"), found["scores"].alias("scores"), "scored")


def bounded_top_k(user_factors: DataFrame, item_factors: DataFrame, k: int = 5, *, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``userId, movieId, score`` like ``scoring.factor_top_k``, without scoring every pair.  Item ids are not negative."""
    lists = bounded_lists(user_factors, item_factors, k, slice_bytes=slice_bytes)
    return (lists.select(F.col("id").alias("userId"), F.explode(F.arrays_zip("ids", "scores")).alias("_r"))
            .select("userId", F.col("_r.ids").alias("movieId"), F.col("_r.scores").alias("score")))


def scored_share(lists: DataFrame, n_items: int) -> float:
    """Pairs that were scored, as a share of all."""
    scored, users = lists.agg(F.sum("scored"), F.count(F.lit(1))).first()
    return (scored or 0) / (users * n_items) if users and n_items else 0.0
