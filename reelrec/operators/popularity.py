"""Counts, popularity, top-k, n-th user, title lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrec.operators.split import select_kth


def rating_count(ratings: DataFrame) -> DataFrame:
    """A1: one row, ``n`` as bigint (the reference's ``.toInt`` wrapped past 2^31)."""
    return ratings.agg(F.count(F.lit(1)).alias("n"))


def movie_popularity(ratings: DataFrame) -> DataFrame:
    """A2: ratings per movie (partial count before the shuffle, final after)."""
    return ratings.groupBy("movieId").agg(F.count(F.lit(1)).alias("cnt"))


def distinct_users(ratings: DataFrame) -> DataFrame:
    """A3."""
    return ratings.select("userId").distinct()


def dedupe_movies(movies: DataFrame) -> DataFrame:
    """One row per movie id (D14): the smallest (title, genres) row wins, whole."""
    return movies.groupBy("movieId").agg(F.min(F.struct("title", "genres")).alias("_m")).select("movieId", "_m.title", "_m.genres")


def duplicate_movies(movies: DataFrame) -> DataFrame:
    """Movie ids with more than one row (D14): ``movieId, n``, what ``dedupe_movies`` decides on."""
    return movies.groupBy("movieId").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def popular_top_k(ratings: DataFrame, movies: DataFrame, k: int = 5) -> DataFrame:
    """O4 + J2: the k most-rated movies (ties by movie id), then their titles.

    As in the reference the limit comes first and the title join second, so a movie
    missing from ``movies`` shortens the list (D14).  The top-k plan is
    ``TakeOrderedAndProject`` over the partial counts; the k-row side is broadcast.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    top = movie_popularity(ratings).orderBy(F.desc("cnt"), F.asc("movieId")).limit(k)
    titles = movies.select("movieId", "title")
    return titles.join(F.broadcast(top), "movieId", "inner").select("movieId", "title", "cnt")


def nth_user(ratings: DataFrame, n: int) -> DataFrame:
    """The n-th smallest distinct user id (1-based), one row.

    Found by histogram selection over the distinct ids, not by taking n rows to one task.
    ``n`` larger than the number of users raises, as does ``n < 1``.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    users = distinct_users(ratings)
    cut = select_kth(users, ["userId"], n)
    return users.where(F.col("userId") == F.lit(cut.key[0]).cast("int"))


def with_titles(recs: DataFrame, movies: DataFrame) -> DataFrame:
    """One left join instead of a title query per recommended movie; a movie missing
    from the table keeps its row with a null title (D15)."""
    return recs.join(movies.select("movieId", "title"), "movieId", "left")
