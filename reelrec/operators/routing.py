"""Route recommendation requests (batch form of the stream step T4).

Known users (those the model has recommendations for, or those in the training set) get
their stored top-k; every other requesting user gets the popular list with score 0.0.
One set per (batch, user): a user seen twice in a batch is answered once (D22).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default number of buckets of a stored recommendation table (see ``user_bucket``): a parameter of
# the table, which its readers must pass on.
USER_BUCKETS = 256
BUCKET_COL = "ubucket"


def user_bucket(user: F.Column | str = "userId", buckets: int = USER_BUCKETS) -> F.Column:
    """Bucket of a user id.  Serving writes recommendations partitioned by it, so a batch
    of a few users reads only their buckets (a static partition filter in ``route``)."""
    u = F.col(user) if isinstance(user, str) else user
    return F.pmod(F.xxhash64(u), F.lit(buckets)).cast("int")


def request_users(decoded: DataFrame) -> DataFrame:
    """Distinct requesting users of a batch."""
    return decoded.select("userId").distinct()


def known_users(users: DataFrame, known: DataFrame) -> DataFrame:
    """J3 (P8 as a semi join): requesting users present in ``known``."""
    return users.join(known.select("userId"), "userId", "left_semi")


def new_users(users: DataFrame, known: DataFrame) -> DataFrame:
    """Requesting users absent from ``known`` (anti join; decoded users are never null)."""
    return users.join(known.select("userId"), "userId", "left_anti")


def _popular_rows(popular: DataFrame) -> list[int]:
    """The popular list: as many rows as the caller's k."""
    return sorted({r["movieId"] for r in popular.select("movieId").collect() if r["movieId"] is not None})


def _popular_array(popular: DataFrame, movies: DataFrame | None, score: float | None = 0.0):
    if movies is not None:
        popular = popular.join(movies.select("movieId"), "movieId", "left_semi")
    ids = _popular_rows(popular)
    if score is None:
        return F.array(*[F.lit(i).cast("int") for i in ids]) if ids else F.array().cast("array<int>")
    items = [F.struct(F.lit(i).cast("int").alias("movieId"), F.lit(score).cast("double").alias("rating"))
             for i in ids]
    return F.array(*items) if items else F.array().cast("array<struct<movieId:int,rating:double>>")


def fallback_popular(users: DataFrame, popular: DataFrame, movies: DataFrame | None = None) -> DataFrame:
    """J4 + P9: each user x each popular movie, score 0.0 (ids in the right order, D5).

    The popular list is the k rows its caller asked for, so it is inlined as a literal array and
    exploded per user: no join, every user row stays where it is.
    With ``movies`` given, only popular movies that exist there are offered.
    """
    arr = _popular_array(popular, movies, score=None)
    return users.select("userId", F.explode(arr).alias("movieId"), F.lit(0.0).alias("rating"))


def route(users: DataFrame, recommendations: DataFrame, popular: DataFrame,
          movies: DataFrame | None = None, score: str = "score", buckets: int = USER_BUCKETS) -> DataFrame:
    """Known users' stored top-k, the popular list (score 0.0) for everyone else.

    One left join of the batch users with the recommendations: a matched user expands to
    its stored rows, an unmatched one to the inlined popular list.  The recommendations
    are read once (no anti-join second pass, no union).
    ``recommendations``: ``userId, movieId, <score>``; output ``userId, movieId, rating``.
    """
    keys = ["userId"]
    if BUCKET_COL in recommendations.columns:
        # Stored by user bucket: read only the buckets this batch touches.  The bucket list
        # is at most ``buckets`` values, so it is a bounded partition filter, not data.
        keys = [BUCKET_COL, "userId"]
        users = users.select("userId", user_bucket("userId", buckets).alias(BUCKET_COL))
        touched = sorted(r[0] for r in users.select(BUCKET_COL).distinct().collect())
        recommendations = recommendations.where(F.col(BUCKET_COL).isin(touched))
    recs = recommendations.select(*keys, F.col("movieId").cast("int").alias("movieId"),
                                  F.col(score).cast("double").alias("rating"))
    joined = users.join(recs, keys, "left")
    own = F.array(F.struct(F.col("movieId"), F.col("rating")))
    rows = F.when(F.col("movieId").isNull(), _popular_array(popular, movies)).otherwise(own)
    return (joined.select("userId", F.explode(rows).alias("_r"))
            .select("userId", F.col("_r.movieId").alias("movieId"), F.col("_r.rating").alias("rating")))
