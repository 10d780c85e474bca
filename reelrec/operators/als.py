"""Explicit-feedback ALS with ``pyspark.ml``.

* fit: ``ALS(rank=10, maxIter=10, regParam=0.07)``, ``coldStartStrategy="drop"`` so pairs
  unknown to the model give no prediction (as the RDD model did); where its blocks would not fit
  a task, the same model by ``als_parts``;
* evaluation predicts the *test* pairs and joins the facts (D2 ruling), reporting the
  row count beside RMSE; an empty join is a failed run (null), never a winner (D3);
* the grid is a driver loop over fits on persisted train/test, some at a time if asked: each fit is itself a
  distributed job and only one metric row per run comes back;
* recommendations score the model's own factor tables with the blocked top-k of
  ``scoring.factor_top_k`` (an equi-join of factor blocks, vectorised top-k, ties by movie
  id) instead of ``recommendForAllUsers``, whose plan is a cartesian product of blocks;
  no per-user driver loop either way.
"""

from __future__ import annotations

import itertools
import math
import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrec.operators.als_parts import fit_in_parts
from reelrec.operators.bounded import bounded_top_k
from reelrec.operators.scoring import best_run, factor_top_k, rmse
from reelrec.session import held

# The reference's live training settings.
DEFAULT_RANK = 10
DEFAULT_ITERATIONS = 10
DEFAULT_LAMBDA = 0.07
DEFAULT_K = 5
DEFAULT_SEED = 42
# User and item blocks: the parallelism of every ALS stage, and part of the model: factors are
# initialised per block, so another number gives another model.  Never taken from the session.
DEFAULT_BLOCKS = 10
# Iterations between checkpoints of the factors: ALS deletes the shuffle files of the iterations before.  The factors are the same.
CHECKPOINT_INTERVAL = 3
# Ratings of a block that a task may hold: ``ALS`` takes about 45 bytes for each while it sorts them, and later the factors they need.
HELD_RATINGS = 3_000_000
# A block's factors and in-links should fit a task: ``blocks_for`` gives the number for a table.
BLOCK_RATINGS = 20_000_000
BLOCK_FACTOR_BYTES = 64 << 20

METRICS_SCHEMA = T.StructType([
    T.StructField("run_id", T.IntegerType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("iterations", T.IntegerType()),
    T.StructField("lambda", T.DoubleType()),
    T.StructField("blocks", T.IntegerType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("n", T.LongType()),
    T.StructField("model_path", T.StringType()),
])


RUNG_SCHEMA = T.StructType([T.StructField("rung", T.IntegerType()), *METRICS_SCHEMA.fields[:7]])


def als_estimator(rank: int = DEFAULT_RANK, iterations: int = DEFAULT_ITERATIONS,
                  reg: float = DEFAULT_LAMBDA, seed: int = DEFAULT_SEED, blocks: int = DEFAULT_BLOCKS) -> ALS:
    return ALS(rank=rank, maxIter=iterations, regParam=reg, seed=seed, userCol="userId",
               itemCol="movieId", ratingCol="rating", coldStartStrategy="drop", nonnegative=False,
               numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=CHECKPOINT_INTERVAL)


def fit(train: DataFrame, rank: int = DEFAULT_RANK, iterations: int = DEFAULT_ITERATIONS,
        reg: float = DEFAULT_LAMBDA, seed: int = DEFAULT_SEED, blocks: int = DEFAULT_BLOCKS) -> ALSModel:
    """M1.  The three input columns are persisted for the fit (ALS reads its input more
    than once); the fitted factors are materialised by ``fit``, so the input is released.

    More than ``HELD_RATINGS`` ratings a block are fitted in parts: the same model in tasks of bounded size."""
    est = als_estimator(rank, iterations, reg, seed, blocks)
    with held(train.select("userId", "movieId", "rating")) as data:
        large = iterations > 0 and dict(data.dtypes)["userId"] == dict(data.dtypes)["movieId"] == "int"
        if large:
            bad = F.col("userId").isNull() | F.col("movieId").isNull() | F.col("rating").isNull() | F.isnan("rating")
            found = data.agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad")).first()
            large = found["n"] > HELD_RATINGS * blocks and not found["bad"]          # ALS itself says what is wrong with a bad row
        return fit_in_parts(est, data, found["n"]) if large else est.fit(data)


def blocks_for(n_ratings: int, n_users: int, n_items: int, rank: int = DEFAULT_RANK) -> int:
    """Blocks for a table of that size: about ``BLOCK_RATINGS`` ratings (12 bytes each) and ``BLOCK_FACTOR_BYTES`` of factors
    (4 bytes a number) in each, ten at least.  100 TB of ratings at 24 bytes are 4e12 rows: 200,000 blocks."""
    factors = max(n_users, n_items) * rank * 4
    return max(DEFAULT_BLOCKS, math.ceil(n_ratings / BLOCK_RATINGS), math.ceil(factors / BLOCK_FACTOR_BYTES))


def predict_pairs(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """M2: predictions for (userId, movieId) pairs; unknown users/movies give no row.

    The dot product of the factors as ``model.transform`` gives it (floats, added in order), as an expression on the columns instead
    of a function of boxed numbers.  The factors are hashed, not sorted: a partition of them is less than the block that ALS holds."""
    users, items = (factors.select(F.col("id").alias(f"_{side}"), F.col("features").alias(f"_{side}_features")).hint("shuffle_hash")
                    for side, factors in (("user", model.userFactors), ("item", model.itemFactors)))
    j = pairs.join(users, pairs["userId"] == users["_user"]).join(items, pairs["movieId"] == items["_item"])
    dot = reduce(lambda a, b: a + b, [F.get("_user_features", F.lit(k)) * F.get("_item_features", F.lit(k)) for k in range(model.rank)])
    return j.withColumn("prediction", dot.cast("double")).where(~F.isnan("prediction")).select(*pairs.columns, "prediction")


def evaluate(model: ALSModel, test: DataFrame) -> DataFrame:
    """A4 on held-out ratings: one row ``rmse, n``."""
    return rmse(predict_pairs(model, test.select("userId", "movieId", "rating")))


def save(model: ALSModel, path: str) -> str:
    """K7: ``<root>/<run>``; overwrite makes reruns idempotent."""
    model.write().overwrite().save(path)
    return path


def load(path: str) -> ALSModel:
    """S4."""
    return ALSModel.load(path)


@dataclass
class GridResult:
    metrics: DataFrame
    best: DataFrame
    rungs: DataFrame             # what candidates scored in each rung of successive halving


def _scored(runs: list[tuple], train: DataFrame, test: DataFrame, seed: int, blocks: int, model_root: str | None, concurrent: int) -> list[tuple]:
    """A row of METRICS_SCHEMA per run.  At most ``concurrent`` fits are at work, each in a scheduler pool of its own, so with the
    fair scheduler they share the cluster."""
    spark = train.sparkSession

    def one(run):
        run_id, r, it, lam = run
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"grid-{run_id % concurrent}" if concurrent > 1 else None)
        model = fit(train, r, it, lam, seed, blocks)
        m = evaluate(model, test).first()
        path = save(model, os.path.join(model_root, f"run={run_id}")) if model_root else None
        return (run_id, int(r), int(it), float(lam), int(blocks), m["rmse"], int(m["n"]), path)

    if concurrent <= 1:
        return [one(run) for run in runs]
    with ThreadPoolExecutor(concurrent) as pool:
        return list(pool.map(inheritable_thread_target(spark)(one), runs))


def grid_search(train: DataFrame, test: DataFrame, *, ranks=(DEFAULT_RANK,), iterations=(DEFAULT_ITERATIONS,),
                lambdas=(DEFAULT_LAMBDA,), seed: int = DEFAULT_SEED, blocks: int = DEFAULT_BLOCKS,
                model_root: str | None = None, concurrent: int = 1, rungs: int = 0, keep: float = 0.5) -> GridResult:
    """M3 + A5: fit every (rank, iterations, lambda), score each on ``test``, keep the best.

    Not ``CrossValidator``/``TrainValidationSplit``: the hold-out is chronological, so a random split would leak the future.

    ``concurrent`` fits run at a time; the results don't depend on it.  With ``rungs`` the grid is thinned before (successive
    halving): ``train`` must have ``ts``, and in rung i of n the candidates are fitted on its first i + 1 of n + 2 parts by time
    and scored on the next part; the best ``keep`` of them go on.  The rest are fitted on all of ``train``.
    """
    spark = train.sparkSession
    runs = [(i, *p) for i, p in enumerate(itertools.product(ranks, iterations, lambdas), start=1)]
    thinned = []
    if rungs:
        at = [(i + 1) / (rungs + 2) for i in range(rungs + 1)]
        cuts = train.approxQuantile("ts", at, 0.001)
        for rung, (cut, end) in enumerate(zip(cuts[:-1], cuts[1:]), start=1):
            with held(train.where(F.col("ts") <= cut)) as inner, held(train.where((F.col("ts") > cut) & (F.col("ts") <= end))) as after:
                found = _scored(runs, inner, after, seed, blocks, None, concurrent)
            thinned += [(rung, *row[:7]) for row in found]
            order = sorted(found, key=lambda row: (row[5] is None or math.isnan(row[5]), row[5], row[0]))
            kept = {row[0] for row in order[:max(1, math.ceil(len(order) * keep))]}
            runs = [run for run in runs if run[0] in kept]
    with held(train.select("userId", "movieId", "rating")) as train, held(test.select("userId", "movieId", "rating")) as test:
        rows = _scored(runs, train, test, seed, blocks, model_root, concurrent)
    metrics = spark.createDataFrame(rows, METRICS_SCHEMA)
    return GridResult(metrics, best_run(metrics), spark.createDataFrame(thinned, RUNG_SCHEMA))


def _ranked(recs: DataFrame) -> DataFrame:
    """Adds ``rank`` (1 = best), so that a stored list keeps its order."""
    best_first = Window.partitionBy("userId").orderBy(F.desc("score"), F.asc("movieId"))
    return recs.withColumn("rank", F.row_number().over(best_first)).withColumnRenamed("score", "rating")


def recommend_all_users(model: ALSModel, k: int = DEFAULT_K, *, bounds: bool = False) -> DataFrame:
    """M5: top-k for every user; rated movies are not removed (as in the reference).  With ``bounds`` items whose norms are too
    small for a user are not scored (``bounded``): the same lists, less work where norms differ."""
    top_k = bounded_top_k if bounds else factor_top_k
    return _ranked(top_k(model.userFactors, model.itemFactors, k))


def recommend_users(model: ALSModel, users: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """M4 for a set of users (one user = a one-row frame); users unknown to the model get
    no rows (the router sends them to the popular list)."""
    wanted = model.userFactors.join(users.select(F.col("userId").alias("id")), "id", "left_semi")
    return _ranked(factor_top_k(wanted, model.itemFactors, k))
