"""The ALS half-step, the grid's concurrency and halving, popularity kept by a stream, and the ordered replay."""

import os
import random

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from reelrec.operators import als, foldin, popularity
from reelrec.sinks import files
from reelrec.sources import fixtures as fx
from reelrec.streaming import popularity as kept
from reelrec.streaming import replay

from conftest import SF_SMALL


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_half_step_is_the_normal_equations(spark):
    r = np.random.default_rng(2)
    items = {i: r.normal(size=6).astype(np.float32) for i in range(60)}
    ratings = [(u, int(i), float(r.integers(1, 11)) / 2) for u in range(40) for i in r.integers(0, 70, r.integers(1, 30))]
    ratings += [(7, int(i % 60), 3.0 + i % 3) for i in range(2500)]             # a hot user, with repeats
    extra = [(7, 1, float("nan")), (8, 1, None), (None, 1, 2.0), (99, 65, 4.0)]
    df = spark.createDataFrame(ratings + extra, "userId int, movieId int, rating double").withColumn("features", F.lit("x")).repartition(7)
    factors = spark.createDataFrame([(i, v.tolist()) for i, v in items.items()], "id int, features array<float>")
    expected = {}
    for u in {x[0] for x in ratings}:
        own = [(items[i].astype(float), s) for v, i, s in ratings if v == u and i in items]
        if own:
            m, s = np.stack([x for x, _ in own]), np.array([x for _, x in own])
            expected[u] = np.linalg.solve(m.T @ m + 0.1 * len(s) * np.eye(6), m.T @ s)
    for hot in (foldin.HOT, 1, 10**9):                                          # some, one and all users are dealt out
        got = {x["id"]: x["features"] for x in foldin.user_half_step(df, factors, 6, 0.1, hot=hot).collect()}
        assert got.keys() == expected.keys()
        assert all(np.allclose(got[u], expected[u], atol=1e-4) for u in got)
    assert foldin.user_half_step(df.limit(0), factors, 6, 0.1).collect() == []


def test_concurrent_grid_and_halving(spark):
    ratings = fx.ratings(spark, SF_SMALL)
    cut = ratings.approxQuantile("ts", [0.6], 0.0)[0]
    train, test = ratings.where(F.col("ts") <= cut), ratings.where(F.col("ts") > cut)
    kw = {"ranks": (3,), "iterations": (2,), "lambdas": (0.05, 0.2, 1.0, 4.0)}
    one, two = (als.grid_search(train, test, concurrent=n, **kw) for n in (1, 2))
    assert rows(one.metrics.drop("model_path")) == rows(two.metrics.drop("model_path")) and one.rungs.count() == 0
    assert rows(one.best) == rows(two.best)
    thin = als.grid_search(train, test, rungs=2, **kw)
    assert rows(thin.rungs.groupBy("rung").count()) == [(1, 4), (2, 2)]
    left = thin.metrics.collect()
    assert len(left) == 1 and tuple(left[0]) in {tuple(x) for x in one.metrics.collect()}      # fitted on all of train
    second = {x["run_id"]: x["rmse"] for x in thin.rungs.where("rung = 2").collect()}
    first = {x["run_id"]: x["rmse"] for x in thin.rungs.where("rung = 1").collect()}
    assert set(second) == set(sorted(first, key=first.get)[:2]) and left[0]["run_id"] == min(second, key=second.get)


def test_blocks_for():
    assert als.blocks_for(1000, 10, 10) == als.DEFAULT_BLOCKS
    assert als.blocks_for(4 * 10**12, 10**9, 10**7) == 200_000 and als.blocks_for(10, 10**9, 1, 100) == 5961


def test_popularity_of_a_stream(spark, scratch):
    folder, root, checkpoint = (os.path.join(scratch, x) for x in ("in", "list", "ck"))
    r, every = random.Random(4), []

    def part(weights):
        new = [(r.choices(range(len(weights)), weights)[0] if r.random() < 0.95 else None,) for _ in range(300)]
        every.extend(x for x, in new if x is not None)
        spark.createDataFrame(new, "movieId int").coalesce(1).write.mode("append").parquet(folder)

    def run(**kw):
        kept.start_popularity(spark.readStream.schema("movieId int").parquet(folder), root, 4, checkpoint, **kw).awaitTermination()

    def dies(_):
        raise RuntimeError("died")

    def recount():
        return sorted(((m, every.count(m)) for m in set(every)), key=lambda x: (-x[1], x[0]))[:4]
    for weights in ([9, 5, 3, 3, 1, 1, 1, 1], [1, 1, 1, 1, 9, 9, 1, 1], [1] * 8):      # others come up
        part(weights)
        if weights[4] == 9:
            before = rows(kept.popular(spark, root))
            with pytest.raises(StreamingQueryException):
                run(before_publish=dies)
            assert rows(kept.popular(spark, root)) == before
        run()
        assert rows(kept.popular(spark, root)) == sorted(recount())
    run()                                                                       # nothing new
    assert rows(kept.popular(spark, root)) == sorted(recount())
    assert len(files.children(spark, f"{root}/data")) <= 2


def test_replay_in_order(spark, scratch):
    folder = os.path.join(scratch, "in")
    r = random.Random(9)
    first = spark.createDataFrame([(r.randrange(50), i) for i in range(400)], "ts int, v int").repartition(5)
    n = replay.replay_in_order(first, folder, ["ts"], 4)
    assert 1 < n <= 4
    n += replay.replay_in_order(spark.createDataFrame([(1, 1000), (0, 1001)], "ts int, v int"), folder, ["ts"], 1)
    seen = []
    (spark.readStream.schema("ts int, v int").option("maxFilesPerTrigger", "1").parquet(folder).writeStream
     .foreachBatch(lambda df, _: seen.append([tuple(x) for x in df.collect()]))
     .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start().awaitTermination())
    assert len(seen) == n and seen[-1] == [(0, 1001), (1, 1000)]                # a later replay comes after
    in_turn = [x for batch in seen[:-1] for x in batch]
    assert [t for t, _ in in_turn] == sorted(t for t, _ in in_turn) and sorted(in_turn) == rows(first)
    assert all(a[-1][0] < b[0][0] for a, b in zip(seen[:-2], seen[1:-1]))       # equal keys are in one batch
    counts = popularity.movie_popularity(first.withColumnRenamed("ts", "movieId"))
    assert counts.count() == len({t for t, _ in in_turn})


def test_replay_makes_more_ranges_of_a_large_table(spark, scratch, monkeypatch):
    monkeypatch.setattr(replay, "FILE_ROWS", 100)
    n = replay.replay_in_order(spark.range(2000).selectExpr("cast(id as int) as ts"), os.path.join(scratch, "in"), ["ts"], 3)
    counts = [r[0] for r in spark.read.parquet(os.path.join(scratch, "in")).groupBy(F.input_file_name()).count().select("count").collect()]
    assert n == len(counts) > 10 and sum(counts) == 2000 and max(counts) < 400
