"""Film-rating tables derived from the warehouse test tables.

The reference reads MovieLens-style text; the test data is a TPC-H-like warehouse.  These
views give rows of the same shape, computed by Spark from the given tables so the work
grows with them (mapping in FIXTURES.md):

* ratings:  lineitem JOIN orders   -> userId = o_custkey, movieId = l_partkey,
            rating = ceil(l_quantity / 5) / 2 (half stars 0.5..5.0), ts = o_orderdate epoch s
* movies:   part                   -> title = p_name, genres = p_type | p_brand
* users:    customer               -> gender, age from the key
* factors:  embeddings             -> every tenth vec_id is a user vector, the rest item vectors
* text:     each record rendered as the delimited line the reference ingests
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrec.functions.text import epoch_seconds, to_int_id
from reelrec.sources.tables import read_table

# Fixed values of the fixture mapping.
USER_VECTOR_MODULUS = 10        # embeddings.vec_id % 10 = 0 are users
KNOWN_USER_MODULUS = 3          # a third of the rating users count as known to the router
IMDB_BASE = 100000
TMDB_BASE = 200000
LINK_GAP_MODULUS = 7            # parts with p_size % 7 = 0 have no tmdb id (line ends with ',')
TOPIC = "real-time"


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, name, base_dir=sf_dir)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    # two large tables: a shuffled join, so the rows that come out are spread over tasks
    od = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate").hint("merge")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return j.select(
        to_int_id(F.col("o_custkey"), "userId").alias("userId"),
        to_int_id(F.col("l_partkey"), "movieId").alias("movieId"),
        (F.ceil(F.col("l_quantity") / 5) / 2).cast("double").alias("rating"),
        epoch_seconds("o_orderdate").cast("long").alias("ts"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "part")
    return p.select(to_int_id(F.col("p_partkey"), "movieId").alias("movieId"),
                    F.col("p_name").alias("title"),
                    F.concat_ws("|", "p_type", "p_brand").alias("genres"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    return c.select(to_int_id(k, "userId").alias("userId"),
                    F.when(k % 2 == 0, "F").otherwise("M").alias("gender"),
                    (F.lit(18) + k % 50).cast("int").alias("age"))


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def links_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``movieId,imdbId,tmdbId``; parts with p_size % 7 = 0 miss the last field."""
    p = t(spark, sf_dir, "part").select("p_partkey", "p_size")
    tmdb = F.when(F.col("p_size") % LINK_GAP_MODULUS != 0, _s(F.col("p_partkey") + TMDB_BASE)).otherwise("")
    return p.select(F.concat(_s("p_partkey"), F.lit(","), _s(F.col("p_partkey") + IMDB_BASE),
                             F.lit(","), tmdb).alias("value"))


def movie_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation-2 ``movieid::title::genres``."""
    m = movies(spark, sf_dir)
    return m.select(F.concat_ws("::", _s("movieId"), "title", "genres").alias("value"))


def user_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation-2 ``userid::gender::age::segment`` (fields past the third are ignored)."""
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    u = users(spark, sf_dir).join(c, F.col("userId") == F.col("c_custkey"))
    return u.select(F.concat_ws("::", _s("userId"), "gender", _s("age"), "c_mktsegment").alias("value"))


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation-2 ``userid::movieid::rating::timestamp``."""
    r = ratings(spark, sf_dir)
    return r.select(F.concat_ws("::", _s("userId"), _s("movieId"), _s("rating"), _s("ts")).alias("value"))


def tag_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``userId,movieId,"word, word",ts``: a quoted tag holding commas."""
    p = t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return p.select(F.concat(_s(F.col("p_partkey") % 10), F.lit(","), _s("p_partkey"), F.lit(',"'),
                             F.replace(F.col("p_name"), F.lit(" "), F.lit(", ")), F.lit('",'),
                             _s(F.col("p_size") + 1000)).alias("value"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommendation requests as wire messages: key = topic, value = user%movie%value."""
    e = t(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return e.select(F.lit(TOPIC).alias("key"),
                    F.concat_ws("%", _s("user_id"), _s(F.col("event_id") % 100), _s("value")).alias("value"))


def factors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(user factors, item factors) as ``id int, features array<float>``."""
    e = t(spark, sf_dir, "embeddings").select("vec_id", "embedding")

    def shape(df: DataFrame) -> DataFrame:
        return df.select(to_int_id(F.col("vec_id"), "vec_id").alias("id"), F.col("embedding").alias("features"))
    user = F.col("vec_id") % USER_VECTOR_MODULUS == 0
    return shape(e.where(user)), shape(e.where(~user))


def known_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users that the router counts as known: a third of those with ratings."""
    return ratings(spark, sf_dir).where(F.col("userId") % KNOWN_USER_MODULUS == 0).select("userId").distinct()


def quoted_movie_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma lines whose quoted title holds commas and doubled quotes, with blanks around the id; every
    fifth line has two fields only."""
    p = t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    quoted = F.concat(F.lit('"'), F.replace(F.col("p_name"), F.lit(" "), F.lit(', "" ')), F.lit('"'))
    return p.select(F.when(F.col("p_partkey") % 5 == 0, F.concat(_s("p_partkey"), F.lit(","), quoted))
                    .otherwise(F.concat(F.lit(" "), _s("p_partkey"), F.lit("\t,"), quoted, F.lit(","), F.col("p_type"))).alias("value"))


def duplicated_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movies with a second row for every third id, whose title is smaller for some and larger for others."""
    m = movies(spark, sf_dir)
    other = F.concat(F.when(F.col("movieId") % 2 == 0, F.lit("a ")).otherwise(F.lit("z ")), "title")
    return m.unionByName(m.where(F.col("movieId") % 3 == 0).select("movieId", other.alias("title"), F.lit("other").alias("genres")))


def short_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request messages of one, two or three fields, some with a bad rating or a bad user."""
    e = t(spark, sf_dir, "events").select("event_id", "user_id")
    u, k = _s("user_id"), F.col("event_id") % 5
    value = (F.when(k == 0, u).when(k == 1, F.concat(u, F.lit("%7"))).when(k == 2, F.concat(u, F.lit("%7%x")))
             .when(k == 3, F.concat(F.lit("x"), u)).otherwise(F.concat(F.lit(" "), u, F.lit("%7%4.5"))))
    return e.select(F.lit(TOPIC).alias("key"), value.alias("value"))
