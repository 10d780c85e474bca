"""ALS properties (never golden floats): top-k equals scoring on the model's own factors,
k rows per user, distinct movies, non-increasing scores, determinism, save/load."""

import random

import pytest
from pyspark.sql import functions as F

from reelrec.operators import als, als_parts, popularity, scoring, split
from reelrec.sources import fixtures as fx

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def data(spark):
    train, test = split.chronological_split(fx.ratings(spark, SF_SMALL), 0.6)
    return train.persist(), test.persist()


@pytest.fixture(scope="module")
def model(data):
    return als.fit(data[0], rank=4, iterations=5)


def test_top_k_properties_and_builtin_agreement(spark, model):
    recs = als.recommend_all_users(model, 5)
    rows = recs.collect()
    by_user = {}
    for r in sorted(rows, key=lambda r: (r["userId"], r["rank"])):
        by_user.setdefault(r["userId"], []).append((r["movieId"], r["rating"]))
    assert all(sorted(r["rank"] for r in rows if r["userId"] == u) == [1, 2, 3, 4, 5] for u in list(by_user)[:20])
    assert len(by_user) == model.userFactors.count()
    for items in by_user.values():
        assert len(items) == 5 and len({m for m, _ in items}) == 5
        scores = [s for _, s in items]
        assert scores == sorted(scores, reverse=True)          # in the order of the rank column
    # Spark ML's own all-user top-k (float32 scores, arbitrary ties) as the oracle
    builtin = model.recommendForAllUsers(5).select("userId", F.explode("recommendations").alias("r"))
    theirs = sorted(round(r["r"]["rating"], 3) for r in builtin.collect())
    assert sorted(round(r["rating"], 3) for r in rows) == theirs


def test_recommend_users_subset(spark, model, data):
    user = popularity.nth_user(data[0], 2)
    got = als.recommend_users(model, user, 5).collect()
    uid = user.first()["userId"]
    assert len(got) == 5 and {r["userId"] for r in got} == {uid}
    ref = model.recommendForUserSubset(user, 5).select(F.explode("recommendations").alias("r")).collect()
    assert sorted(round(r["rating"], 3) for r in got) == sorted(round(r["r"]["rating"], 3) for r in ref)
    unknown = spark.createDataFrame([(-1,)], "userId int")
    assert als.recommend_users(model, unknown, 5).count() == 0


def test_same_seed_same_factors(data):
    a = als.fit(data[0], rank=3, iterations=3, seed=11).userFactors.orderBy("id").collect()
    b = als.fit(data[0], rank=3, iterations=3, seed=11).userFactors.orderBy("id").collect()
    assert [tuple(r.features) for r in a] == [tuple(r.features) for r in b]


def test_same_factors_under_another_parallelism(spark, data):
    """Blocks are a parameter, not the session's parallelism: the input's partitioning, which follows the
    cores, changes factors by rounding only."""
    few = als.fit(data[0].repartition(2), rank=3, iterations=3, seed=11)
    many = als.fit(data[0].repartition(13), rank=3, iterations=3, seed=11)
    a, b = ({r["id"]: r["features"] for r in m.userFactors.collect()} for m in (few, many))
    assert a.keys() == b.keys()
    assert max(abs(x - y) for i in a for x, y in zip(a[i], b[i])) < 1e-3


def test_callers_caches_survive(spark, data):
    train, test = data[0].select("userId", "movieId", "rating").persist(), data[1].select("userId", "movieId", "rating").persist()
    als.grid_search(train, test, ranks=(2,), iterations=(1,))
    ratings = fx.ratings(spark, SF_SMALL).persist()
    split.chronological_split(ratings, 0.6)
    kept = [df.storageLevel.useMemory for df in (train, test, ratings)]
    for df in (train, test, ratings):
        df.unpersist()
    assert all(kept)


def test_train_rmse_beats_global_mean(spark, data, model):
    train = data[0]
    mu = train.agg(F.avg("rating")).first()[0]
    base = scoring.rmse(train.withColumn("prediction", F.lit(mu))).first()["rmse"]
    fitted = als.evaluate(model, train).first()["rmse"]
    assert fitted < base


def test_grid_and_save_load(spark, data, scratch):
    res = als.grid_search(data[0], data[1], ranks=(3,), iterations=(3,), lambdas=(0.07, 0.5), model_root=scratch)
    metrics = res.metrics.collect()
    assert [m["run_id"] for m in metrics] == [1, 2]
    best = res.best.first()
    assert best["rmse"] == min(m["rmse"] for m in metrics if m["rmse"] is not None)
    loaded = als.load(best["model_path"])
    user = popularity.nth_user(data[0], 1)
    a = sorted(tuple(r) for r in als.recommend_users(loaded, user, 5).collect())
    assert len(a) == 5
    again = sorted(tuple(r) for r in als.recommend_users(als.load(best["model_path"]), user, 5).collect())
    assert a == again


def test_shuffle_files_go_while_a_fit_runs(spark):
    """ALS deletes the files of earlier iterations at a checkpoint: more than one falls into a fit."""
    est = als.als_estimator()
    assert 0 < est.getCheckpointInterval() * 2 <= est.getMaxIter()


def test_predictions_are_the_models_and_come_by_hashed_factors(spark, model, data):
    """The numbers of ``model.transform``, bit by bit, without its function of boxed rows; unknown and null ids give no row."""
    pairs = data[1].select("userId", "movieId").unionByName(spark.createDataFrame([(-1, 1), (None, 1), (1, None)], "userId int, movieId int"))
    got = als.predict_pairs(model, pairs)
    theirs = model.transform(pairs.where("userId is not null and movieId is not null")).withColumn("prediction", F.col("prediction").cast("double"))
    key = lambda r: (r["userId"], r["movieId"], r["prediction"])
    assert sorted(map(key, got.collect())) == sorted(map(key, theirs.collect())) and got.columns == theirs.columns
    plain = spark.createDataFrame([(1, 1)], "userId int, movieId int")
    plan = als.predict_pairs(model, plain)._jdf.queryExecution().executedPlan().toString()
    assert "UDF(" not in plan and "SortMergeJoin" not in plan and plan.count("ShuffledHashJoin") == 2


def test_split_of_a_stored_table_caches_nothing(spark, scratch):
    path = scratch + "/ratings"
    fx.ratings(spark, SF_SMALL).write.parquet(path)
    stored = spark.read.parquet(path)
    held = [sorted(map(tuple, part.collect())) for part in split.chronological_split(stored, 0.6)]
    again = [sorted(map(tuple, part.collect())) for part in split.chronological_split(stored, 0.6, persist=False)]
    assert held == again


def _factors(model):
    return [{r["id"]: r["features"] for r in side.collect()} for side in (model.userFactors, model.itemFactors)]


def test_fit_in_parts_is_the_model_of_als(spark, monkeypatch, scratch):
    """Blocks that a task may not hold: parts of few ratings give ALS's own factors; ratings repeat, ids are negative or have many."""
    r = random.Random(5)
    rows = [(r.randrange(-40, 300), r.choice([7, r.randrange(-20, 200)]), r.randrange(1, 11) / 2) for _ in range(6000)]
    df = spark.createDataFrame(rows + rows[:50], "userId int, movieId int, rating double").repartition(5)
    kw = {"rank": 4, "iterations": 3, "reg": 0.1, "seed": 3, "blocks": 3}
    whole = als.fit(df, **kw)
    calls = []

    def few(est, data, n):
        calls.append(n)
        return als_parts.fit_in_parts(est, data, n, part_ratings=700)
    monkeypatch.setattr(als, "HELD_RATINGS", 1000)
    monkeypatch.setattr(als, "fit_in_parts", few)
    monkeypatch.setattr(als_parts, "CELLS", 256)                       # the item with half of the ratings takes turns
    monkeypatch.setattr(als_parts, "DEALT_ROWS", 500)
    parts = als.fit(df, **kw)
    assert calls == [6050]
    for a, b in zip(_factors(whole), _factors(parts)):
        assert a.keys() == b.keys() and max(abs(x - y) for i in a for x, y in zip(a[i], b[i])) < 1e-4
    assert parts.rank == 4 and [{p.name: v for p, v in m.extractParamMap().items()} for m in (whole, parts)] == 2 * [
        {p.name: v for p, v in whole.extractParamMap().items()}]
    assert parts.userFactors.dtypes == whole.userFactors.dtypes and parts.getColdStartStrategy() == "drop"
    assert _factors(als.load(als.save(parts, scratch + "/model"))) == _factors(parts)
    assert als.evaluate(parts, df).first()["rmse"] == pytest.approx(als.evaluate(whole, df).first()["rmse"], abs=1e-6)
    nulls = df.withColumn("rating", F.when(F.col("movieId") != 7, F.col("rating")))
    with pytest.raises(Exception, match="MUST NOT be Null"):           # ALS's own words
        als.fit(nulls, **kw)
    monkeypatch.setattr(als, "HELD_RATINGS", 3000)
    als.fit(df, **kw)
    assert calls == [6050]                                             # the blocks fit a task


def test_a_part_has_few_ratings_whatever_the_blocks(spark):
    df = spark.range(20_000).selectExpr("cast(id % 3000 as int) userId", "cast(id % 1700 as int) movieId", "cast(1 as float) rating")
    links = als_parts._dealt(df, 40).mapPartitions(als_parts._links_task(40), True)
    sizes = links.map(lambda x: (len(x[1][1][3]), int(x[1][1][4].sum()))).collect()
    assert sum(n for n, _ in sizes) == 20_000 and max(n for n, _ in sizes) < 1000 and all(needed <= n for n, needed in sizes)
