"""Joins of bucketed tables without a shuffle, top-k with norm bounds, and the membership index."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelrec.operators import als, bounded, membership, scoring
from reelrec.sinks import colocated, snapshots, tables
from reelrec.sources import fixtures as fx

from conftest import SF_SMALL


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_under_the_joins(spark):
    ratings = fx.ratings(spark, SF_SMALL)
    pairs = ratings.groupBy("userId", "movieId").agg(F.avg("rating").alias("prediction"))
    movies = fx.movies(spark, SF_SMALL).select("movieId", "title")
    colocated.store(pairs, "c_predictions", ["userId", "movieId"], 8)
    colocated.store(ratings, "c_facts", ["userId", "movieId"], 8)
    colocated.store(pairs, "c_recs", ["movieId"], 8)
    colocated.store(movies, "c_titles", ["movieId"], 8)
    colocated.store(ratings.select("userId").distinct(), "c_asked", ["userId"], 8)
    colocated.store(fx.known_users(spark, SF_SMALL), "c_known", ["userId"], 8)
    assert colocated.bucketing(spark, "c_facts") == (8, ["userId", "movieId"])
    for found, expected in ((colocated.join("c_predictions", "c_facts", spark), pairs.join(ratings, ["userId", "movieId"])),
                            (colocated.join("c_recs", "c_titles", spark), pairs.select("movieId", "userId", "prediction").join(movies, "movieId")),
                            (colocated.known_and_new("c_asked", "c_known", spark).where("known").drop("known"), fx.known_users(spark, SF_SMALL))):
        assert "Exchange" not in plan(found) and "SortMergeJoin" in plan(found)
        assert rows(found.select(*sorted(found.columns))) == rows(expected.select(*sorted(expected.columns)))
    assert len([f for f in spark.table("c_facts").inputFiles()]) <= 8             # a file for each bucket
    colocated.store(movies, "c_other", ["movieId"], 4)
    for other in ("c_other", "c_facts"):
        with pytest.raises(ValueError):
            colocated.join("c_recs", other, spark)
    tables.drop_if_exists(spark, "c_plain")
    tables.create_as(movies, "c_plain")
    assert colocated.bucketing(spark, "c_plain") is None


def factors(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id int, features array<float>")


def brute(users, items, k):
    out = []
    for u, v in enumerate(users.astype(np.float32).astype(float)):
        scores = items.astype(np.float32).astype(float) @ v
        best = sorted(range(len(items)), key=lambda i: (-scores[i], i))[:k]
        out += [(u, i, round(scores[i], 6)) for i in best]
    return sorted(out)


@pytest.mark.parametrize("kind", ["spread", "ties", "zero", "few"])
def test_bounds_give_the_brute_force_lists(spark, kind):
    r = np.random.default_rng(5)
    users, items = r.normal(size=(70, 4)), r.normal(size=(900, 4))
    if kind == "spread":
        items *= np.exp(-np.arange(900) / 60)[r.permutation(900), None]
    elif kind == "ties":                                    # whole numbers: many equal scores and norms
        users, items = r.integers(-2, 3, (70, 4)), np.repeat(r.integers(-2, 3, (60, 4)), 15, axis=0)
    elif kind == "zero":
        users[:20] = 0
        items[:800] = 0
    else:
        items = items[:3]
    u, i = factors(spark, users).repartition(3), factors(spark, items)
    for size in (1 << 25, 4000, 1000):                      # one slice, some, many
        lists = bounded.bounded_lists(u, i, 5, slice_bytes=size).cache()
        got = sorted((x["id"], m, round(s, 6)) for x in lists.collect() for m, s in zip(x["ids"], x["scores"]))
        assert got == brute(users, items, 5)
        share = bounded.scored_share(lists, len(items))
        assert share <= 1 and (kind != "spread" or share < 0.5)
        lists.unpersist()
    assert rows(bounded.bounded_top_k(u, i, 5).select("userId", "movieId")) == [t[:2] for t in brute(users, items, 5)]


def test_bounds_of_empty_sides(spark):
    u, i = factors(spark, np.ones((3, 2))), factors(spark, np.ones((3, 2)))
    assert bounded.bounded_top_k(u, i.limit(0), 2).collect() == [] == bounded.bounded_top_k(u.limit(0), i, 2).collect()
    assert bounded.scored_share(bounded.bounded_lists(u, i.limit(0), 2), 0) == 0


def test_rounds_do_not_count_the_items(spark, monkeypatch):
    """A slice of one item first: the rounds grow with the logarithm of the items, and end when no user is open."""
    r, tags, stored = np.random.default_rng(6), [], bounded.stored
    monkeypatch.setattr(bounded, "stored", lambda df, tag: (tags.append(tag), stored(df, tag))[1])
    users, items = r.normal(size=(20, 4)), r.normal(size=(600, 4))
    got = bounded.bounded_top_k(factors(spark, users), factors(spark, items), 5, slice_bytes=32)
    assert rows(got.select("userId", "movieId")) == [t[:2] for t in brute(users, items, 5)]
    assert tags.count("lists") <= 12


def test_bounds_serve_a_model(spark):
    model = als.fit(fx.ratings(spark, SF_SMALL).select("userId", "movieId", "rating"), rank=4, iterations=2)
    with_bounds, without = (als.recommend_all_users(model, 5, bounds=b).select("userId", "rank", F.round("rating", 5).alias("rating")) for b in (True, False))
    assert rows(with_bounds) == rows(without) != []


def test_membership_index(spark, scratch):
    root, r = os.path.join(scratch, "m"), random.Random(3)
    ids = {r.randrange(-200_000, 200_000) for _ in range(3000)} | {0, 1, 32767, 32768, 32769, -1, 2**31 - 1, -2**31}
    users = spark.createDataFrame([(i,) for i in ids] + [(None,)], "userId int")
    half = F.col("userId") % 2 == 0
    membership.add(spark, root, users.where(half))
    first = snapshots.read(spark, root)
    membership.add(spark, root, users)                       # some are known already
    index = snapshots.read(spark, root)
    assert membership.size(index).first()["n"] == len(ids) and membership.size(first).first()["n"] == sum(i % 2 == 0 for i in ids)
    asked = {r.randrange(-200_000, 200_000) for _ in range(3000)} | set(list(ids)[:500]) | {2**31 - 1, 32768, -1}
    frame = spark.createDataFrame([(i,) for i in asked], "userId int")
    assert {x[0] for x in membership.known(frame, index).collect()} == asked & ids
    assert {x[0] for x in membership.new(frame, index).collect()} == asked - ids
    apart = membership.merged(membership.bitmaps(users.where(~half)), membership.bitmaps(users.where(half)), membership.bitmaps(users.limit(9)))
    assert {x[0] for x in membership.known(frame, apart).collect()} == asked & ids
    assert membership.known(spark.createDataFrame([(None,)], "userId int"), index).collect() == []
    assert membership.known(frame, index.limit(0)).collect() == [] and membership.bitmaps(users.limit(0)).collect() == []
