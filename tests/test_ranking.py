"""W1 / O7 against brute force, including hot duplicate rows and the chunked expansion."""

import random

import pytest

from reelrec.operators import ranking
from reelrec.sources import fixtures as fx

from conftest import SF_SMALL


def brute_rank(rows):
    out = []
    by = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0], r[1], r[3])):
        by[r[2]] = by.get(r[2], 0) + 1
        out.append(r + (by[r[2]],))
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 3, 16, None])
def test_rank_matches_window(spark, parts):
    df = fx.ratings(spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    got = sorted(tuple(r) for r in ranking.rank_within_rating(df, partitions=parts).collect())
    assert got == brute_rank(rows)


def test_hot_duplicates_chunked(spark):
    rnd = random.Random(3)
    rows = [(5, 5, 4.0, 9)] * 57 + [(rnd.randint(1, 4), rnd.randint(1, 4), 4.0, rnd.randint(1, 3)) for _ in range(40)]
    rows += [(rnd.randint(1, 4), rnd.randint(1, 4), 1.0, 1) for _ in range(20)]
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double, ts long")
    got = sorted(tuple(r) for r in ranking.rank_within_rating(df, partitions=4, expand_chunk=10).collect())
    assert got == brute_rank(rows)


def test_null_ratings_keep_their_band(spark):
    rows = [(i, 1, r, 1) for i, r in enumerate([None, None, None, 1.0, 1.0, 1.0, 2.0])]
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double, ts long")
    got = sorted(((r["rating"], r["rank"], r["band"]) for r in ranking.rank_band_sample(df).collect()), key=str)
    assert got == [(1.0, 1, 1), (1.0, 2, 2), (1.0, 3, 3), (2.0, 1, 3), (None, 1, 1), (None, 2, 2), (None, 3, 3)]
    assert ranking.banded(df, 1).count() == 2 and ranking.rank_band_sample(df, (1, 2)).count() == 7


def test_bands_are_disjoint_and_complete(spark):
    df = fx.ratings(spark, SF_SMALL)
    bands = ranking.rank_band_sample(df).collect()
    assert len(bands) == df.count()
    sizes = {}
    for r in bands:
        sizes.setdefault(r["rating"], []).append((r["rank"], r["band"]))
    for ranks in sizes.values():
        n = len(ranks)
        for rank, band in ranks:
            assert band == (1 if rank <= n // 3 else 2 if rank <= 2 * (n // 3) else 3)


def test_parts_grow_in_number(spark):
    df = spark.range(3)
    few = ranking._partitions(df, None, 1000)
    assert ranking._partitions(df, None, 5000 * ranking.PART_ROWS) == 5000 > few and ranking._partitions(df, 4, 10**12) == 4


def test_rows_are_ranked_in_their_parts(spark):
    """Duplicates expand where they lie; no window over the rows."""
    rows = [(i % 7, 1, float(i % 3), 5) for i in range(90)] + [(1, 1, None, 5)] * 3
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double, ts long")
    ranked = ranking.rank_within_rating(df, partitions=5)
    assert "Window" not in ranked._jdf.queryExecution().executedPlan().toString()
    got = sorted((tuple(r) for r in ranked.collect()), key=str)
    expect = [r[:5] for r in df.selectExpr("*", "row_number() over (partition by rating order by userId, movieId, ts)").collect()]
    assert got == sorted((tuple(r) for r in expect), key=str)
