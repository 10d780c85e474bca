"""O6 properties: exact sizes, disjoint, ordered, partition-independent, brute-force equal."""

import random

import pytest
from pyspark.sql import functions as F

from reelrec.operators import split
from reelrec.sources import fixtures as fx

from conftest import SF_SMALL

ORDER = ["ts", "userId", "movieId", "rating"]


def brute(rows, k, desc=False):
    return sorted(sorted(rows, key=lambda r: (r[3], r[0], r[1], r[2]), reverse=desc)[:k])


def as_rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def ratings(spark):
    return fx.ratings(spark, SF_SMALL).persist()


def test_split_sizes_and_order(spark, ratings):
    n = ratings.count()
    train, test = split.chronological_split(ratings, 0.6, exact_rows=50, buckets=16)
    tr, te = as_rows(train), as_rows(test)
    assert len(tr) == int(n * 0.6) and len(te) == int(n * (1 - 0.6))
    full = [tuple(r) for r in ratings.collect()]
    triples = [(u, m, r, ts) for u, m, r, ts in full]
    assert tr == [t[:3] for t in brute(triples, int(n * 0.6))]
    assert te == [t[:3] for t in brute(triples, int(n * 0.4), desc=True)]


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_split_partition_independent(spark, ratings, parts):
    base, _ = split.chronological_split(ratings, 0.6)
    again, _ = split.chronological_split(ratings.repartition(parts), 0.6, exact_rows=100, buckets=8)
    assert as_rows(base) == as_rows(again)


def test_ties_on_full_key_and_hot_value(spark):
    # a third of the rows share one timestamp, and many rows are exact duplicates
    rnd = random.Random(7)
    rows = [(1, 1, 2.5, 100)] * 40 + [(rnd.randint(1, 5), rnd.randint(1, 9), 0.5 * rnd.randint(1, 10), 100)
                                      for _ in range(30)]
    rows += [(rnd.randint(1, 5), rnd.randint(1, 9), 0.5 * rnd.randint(1, 10), rnd.randint(0, 1000)) for _ in range(80)]
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double, ts long")
    for k in (1, 39, 40, 41, 75, 149, 150):
        got = as_rows(split.first_k(df, ORDER, k, output=["userId", "movieId", "rating"], exact_rows=4, buckets=4))
        assert got == [t[:3] for t in brute(rows, k)], k
        got = as_rows(split.first_k(df, ORDER, k, descending=True, output=["userId", "movieId", "rating"],
                                    exact_rows=4, buckets=4))
        assert got == [t[:3] for t in brute(rows, k, desc=True)], k


def test_plan_has_no_single_task_limit(spark, ratings):
    train, _ = split.chronological_split(ratings, 0.6)
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "CollectLimit" not in plan and "GlobalLimit" not in plan


def test_select_kth_rejects_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    with pytest.raises(ValueError, match="null"):
        split.select_kth(df, ["a", "b"], 1)


def test_k_zero_and_all(spark, ratings):
    n = ratings.count()
    assert split.first_k(ratings, ORDER, 0).count() == 0
    assert split.first_k(ratings, ORDER, n, output=ORDER).count() == n
    assert ratings.where(F.col("ts").isNull()).count() == 0


def test_empty_and_single_row_inputs(spark):
    empty = spark.createDataFrame([], "userId int, movieId int, rating double, ts long")
    tr, te = split.chronological_split(empty, 0.6)
    assert tr.count() == 0 and te.count() == 0
    one = spark.createDataFrame([(1, 2, 3.0, 4)], "userId int, movieId int, rating double, ts long")
    tr, te = split.chronological_split(one, 0.6)
    assert tr.count() == 0 and te.count() == 0          # int(0.6) = int(0.4) = 0, as the reference
    two = spark.createDataFrame([(1, 2, 3.0, 4), (1, 3, 3.0, 5)], "userId int, movieId int, rating double, ts long")
    tr, te = split.chronological_split(two, 0.6)
    assert as_rows(tr) == [(1, 2, 3.0)] and te.count() == 0


def test_day_histogram_fallback_matches(spark, ratings, monkeypatch):
    base_tr, base_te = split.chronological_split(ratings, 0.6)
    monkeypatch.setattr(split, "MAX_COARSE_GROUPS", 2)      # too many days: plain stats path
    tr, te = split.chronological_split(ratings, 0.6, exact_rows=50, buckets=16)
    assert as_rows(tr) == as_rows(base_tr) and as_rows(te) == as_rows(base_te)
