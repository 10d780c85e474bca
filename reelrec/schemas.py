"""Record schemas.  Ids are int (``pyspark.ml`` ALS needs int ids),
time is epoch seconds as bigint, ratings are double."""

from __future__ import annotations

from pyspark.sql import types as T

LINKS = T.StructType([
    T.StructField("movieId", T.IntegerType()),
    T.StructField("imdbId", T.IntegerType()),
    T.StructField("tmdbId", T.IntegerType()),
])

MOVIES = T.StructType([
    T.StructField("movieId", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])

USERS = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
])

RATINGS = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("movieId", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("ts", T.LongType()),
])

TAGS = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("movieId", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("ts", T.LongType()),
])

# Split output and recommendation rows share this shape.
RATING_TRIPLE = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("movieId", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
])

RECOMMENDATION = RATING_TRIPLE

WIRE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])
