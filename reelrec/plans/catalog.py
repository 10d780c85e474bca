"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator of the
survey inventory.  Every query reads the warehouse tables (or what Spark derives from
them) in full; computed columns carry the same names as in ``reelrec.plans.oracle``."""

from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelrec import schemas
from reelrec.functions import parse, wire
from reelrec.operators import als, bounded, foldin, membership, popularity, ranking, routing, scoring, split
from reelrec.session import ensure_checkpoint_dir
from reelrec.sinks import colocated, snapshots, tables
from reelrec.sources import fixtures as fx
from reelrec.sources.text import read_lines
from reelrec.streaming import ingest, ledger, replay, router
from reelrec.streaming import popularity as popularity_stream

Query = Callable[[SparkSession, str], DataFrame]

# Fixed query parameters.
TOP_K = 5
NTH_USER = 100
TRAIN_FRACTION = 0.6
DAMPING_GRID = (0.0, 1.0, 5.0, 25.0)
ALS_GRID_LAMBDAS = (0.07, 0.2)
REPLAY_RANGES = 6
LATE_USER_MODULUS = 5         # users left out of the fit by the half-step's queries


def _path(spark: SparkSession, tag: str) -> str:
    """A fresh folder in the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def _stored(df: DataFrame, tag: str) -> DataFrame:
    """Written once and read back, so that what reads it several times doesn't compute it again."""
    path = _path(df.sparkSession, tag)
    tables.write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _splits(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return split.chronological_split(_stored(fx.ratings(spark, d), "ratings"), TRAIN_FRACTION, persist=False)


def _popular(spark: SparkSession, d: str) -> DataFrame:
    return popularity.popular_top_k(fx.ratings(spark, d), fx.movies(spark, d), TOP_K)


def _request_users(spark: SparkSession, d: str) -> DataFrame:
    return routing.request_users(wire.decode_users(fx.requests(spark, d)).rows)


def _factor_recs(spark: SparkSession, d: str) -> DataFrame:
    users, items = fx.factors(spark, d)
    return scoring.factor_top_k(users, items, TOP_K)


def _round(c: str, places: int = 6) -> F.Column:
    return F.round(F.col(c), places).alias(c)


# ---- phase 1: counts and popularity -------------------------------------------------

def q_rating_count(spark, d):
    return popularity.rating_count(fx.ratings(spark, d))


def q_movie_popularity(spark, d):
    return popularity.movie_popularity(fx.ratings(spark, d))


def q_popular_top_k(spark, d):
    return _popular(spark, d)


def q_distinct_users(spark, d):
    return popularity.distinct_users(fx.ratings(spark, d))


def q_nth_user(spark, d):
    return popularity.nth_user(fx.ratings(spark, d), NTH_USER)


# ---- phase 2: ingest ----------------------------------------------------------------

def q_ingest_incomplete_filter(spark, d):
    return parse.drop_incomplete(fx.links_lines(spark, d), ",")


def q_ingest_links(spark, d):
    return parse.parse_delimited(fx.links_lines(spark, d), schemas.LINKS, ",").rows


def q_ingest_movies(spark, d):
    return parse.parse_delimited(fx.movie_lines(spark, d), schemas.MOVIES, "::").rows


def q_ingest_users(spark, d):
    return parse.parse_delimited(fx.user_lines(spark, d), schemas.USERS, "::").rows


def q_ingest_ratings(spark, d):
    return parse.parse_delimited(fx.rating_lines(spark, d), schemas.RATINGS, "::").rows


def q_ingest_quarantine(spark, d):
    """P2 quarantine: with the incomplete-line filter off, lines missing their last field
    are set aside with a reason instead of failing the job."""
    res = parse.parse_delimited(fx.links_lines(spark, d), schemas.LINKS, ",", drop_incomplete_lines=False)
    return res.rejects


def q_ingest_movies_quoted(spark, d):
    """Quotes, commas and doubled quotes inside a title; lines of two fields are set aside."""
    return parse.parse_csv_quoted(fx.quoted_movie_lines(spark, d), schemas.MOVIES).rows


def q_movies_deduped(spark, d):
    """One whole row per movie id."""
    return popularity.dedupe_movies(fx.duplicated_movies(spark, d))


def q_text_round_trip(spark, d):
    """Lines written as text files, read back and parsed."""
    path = _path(spark, "lines")
    fx.rating_lines(spark, d).write.text(path)
    return parse.parse_delimited(read_lines(spark, path), schemas.RATINGS, "::").rows


def _table(spark) -> str:
    return f"reelrec_{uuid.uuid4().hex[:12]}"


def q_publish_twice(spark, d):
    """K1 K2 K9: a table published, then replaced by a plan that reads it and changes every row."""
    name = _table(spark)
    tables.publish(fx.users(spark, d), name)
    tables.publish(spark.table(name).withColumn("age", F.col("age") + 1), name)
    return spark.table(name)


def q_publish_interrupted(spark, d):
    """K1 K2: a publish that stops before its pointer is swapped; readers between, before and after."""
    root = _path(spark, "snapshots")
    snapshots.publish(fx.users(spark, d), root)
    pinned = snapshots.read(spark, root)
    staged = snapshots.stage(snapshots.read(spark, root).withColumn("age", F.col("age") + 1), root)
    between = snapshots.read(spark, root)                           # the driver died here: the old rows
    snapshots.commit(spark, root, staged)                           # the next one goes on
    seen = {"between": between, "pinned": pinned, "after": snapshots.read(spark, root)}
    return functools.reduce(DataFrame.unionByName, [df.withColumn("reader", F.lit(r)) for r, df in seen.items()])


def q_ctas_append(spark, d):
    """A table created because it is missing, one created from a plan, both appended to by name; read
    through a named view."""
    empty, name, m = _table(spark), _table(spark), fx.movies(spark, d)
    even = F.col("movieId") % 2 == 0
    tables.create_if_missing(spark, empty, m.schema)
    tables.append(m.where(even), empty)
    tables.create_as(spark.table(empty), name)
    tables.create_if_missing(spark, name, m.schema)                 # is there: nothing changes
    tables.append(m.where(~even).select("genres", "title", "movieId"), name)
    view = _table(spark)
    tables.name_view(spark.table(name), view)
    return spark.sql(f"select movieId, title, genres from {view}")


class _Died(RuntimeError):
    """What the recovery queries raise in place of a crash."""


def _dies(batch_id: int) -> None:
    raise _Died(f"batch {batch_id}")


def _router(spark, d, base, **kw) -> router.RouterConfig:
    recs, popular = _stored(_factor_recs(spark, d), "recs"), _stored(_popular(spark, d), "popular")
    return router.RouterConfig(recommendations=lambda _: recs, popular=lambda _: popular, out_path=os.path.join(base, "out"),
                               ledger=True, **kw)


def _halves(spark, d) -> list[DataFrame]:
    """The requests in two parts; all of a user's are in one."""
    req = fx.requests(spark, d)
    half = F.pmod(F.xxhash64(F.substring_index("value", "%", 1)), F.lit(2)) == 0
    return [req.where(half), req.where(~half)]


def _run_router(spark, cfg, base) -> None:
    stream = router.file_request_stream(spark, os.path.join(base, "in"))
    router.start_router(stream, cfg, os.path.join(base, "checkpoint"), available_now=True).awaitTermination()


def _times(routed: DataFrame) -> DataFrame:
    """Every routed row and how often it is there."""
    return routed.groupBy("userId", "movieId", _round("rating")).agg(F.count(F.lit(1)).alias("times"))


def q_stream_restart(spark, d):
    """Half of the requests through the router, then a restart from its checkpoint with the rest."""
    base = _path(spark, "stream")
    cfg = _router(spark, d, base)
    for part in _halves(spark, d):
        router.replay_to_files(part, os.path.join(base, "in"))
        _run_router(spark, cfg, base)
    return router.routed_rows(spark, cfg).select("userId", "movieId", _round("rating"))


def q_stream_recovery(spark, d):
    """The second batch dies when its rows are written and not committed; the restart runs it again."""
    base = _path(spark, "stream")
    cfg = _router(spark, d, base)
    first, second = _halves(spark, d)
    router.replay_to_files(first, os.path.join(base, "in"))
    _run_router(spark, cfg, base)
    router.replay_to_files(second, os.path.join(base, "in"))
    cfg.before_commit = _dies
    try:
        _run_router(spark, cfg, base)
        raise AssertionError("the batch did not die")
    except StreamingQueryException:
        cfg.before_commit = None
    _run_router(spark, cfg, base)
    return _times(router.routed_rows(spark, cfg))


def q_stream_trigger(spark, d):
    """A router with a processing-time trigger, stopped when it has read what there was."""
    base = _path(spark, "stream")
    cfg = _router(spark, d, base)
    router.replay_to_files(fx.requests(spark, d), os.path.join(base, "in"))
    stream = router.file_request_stream(spark, os.path.join(base, "in"))
    query = router.start_router(stream, cfg, os.path.join(base, "checkpoint"), trigger="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return _times(router.routed_rows(spark, cfg))


def _ingest_growing(spark, lines: DataFrame, schema, delim: str) -> tuple[ingest.Ingested, str]:
    """Lines in three parts that arrive one after the other; the run over the third dies once before its commit."""
    base = _path(spark, "ingest")
    folder, root = os.path.join(base, "in"), os.path.join(base, "out")
    lines, part = _stored(lines, "lines"), F.pmod(F.xxhash64("value"), F.lit(3))
    for k in range(3):
        lines.where(part == k).write.mode("append").text(folder)
        if k == 2:
            try:
                ingest.ingest_new(spark, folder, root, schema, delim, before_commit=_dies)
                raise AssertionError("the batch did not die")
            except StreamingQueryException:
                pass
        out = ingest.ingest_new(spark, folder, root, schema, delim)
    return out, folder


def q_ingest_incremental(spark, d):
    """Three runs over a growing folder, one of which dies and runs again."""
    return _ingest_growing(spark, fx.rating_lines(spark, d), schemas.RATINGS, "::")[0].rows


def q_ingest_files(spark, d):
    """The ledger of an incremental ingest: lines of the files, each read once, and what became of them."""
    out, folder = _ingest_growing(spark, fx.links_lines(spark, d), schemas.LINKS, ",")
    there = spark.read.text(folder).select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("there"))
    per_file = out.files.groupBy("file").agg(F.count(F.lit(1)).alias("times"), F.sum("lines").alias("lines"))
    seen = there.join(per_file, "file", "full")
    counts = seen.agg(F.sum("there").alias("lines_there"), F.sum("lines").alias("lines_read"), F.max("times").alias("times_read"))
    good = out.rows.agg(F.count(F.lit(1)).alias("n_rows"))
    both = counts.unionByName(good, allowMissingColumns=True)       # a row each, side by side
    return both.agg(*(F.max(c).alias(c) for c in both.columns))


def q_ingest_tags_repaired(spark, d):
    return parse.parse_tag_lines(fx.tag_lines(spark, d), schemas.TAGS).rows


# ---- phase 3: split and ranks -------------------------------------------------------

def q_split_train(spark, d):
    return _splits(spark, d)[0]


def q_split_test(spark, d):
    return _splits(spark, d)[1]


def q_rank_within_rating(spark, d):
    return ranking.rank_within_rating(fx.ratings(spark, d))


def q_rank_band_sample(spark, d):
    return ranking.rank_band_sample(fx.ratings(spark, d))


# ---- phase 4: wire, routing, titles -------------------------------------------------

def q_wire_encode(spark, d):
    return wire.encode(fx.ratings(spark, d))


def q_wire_decode(spark, d):
    return wire.decode(fx.requests(spark, d)).rows


def q_request_users(spark, d):
    """Users of messages that may lack the movie or the rating."""
    return routing.request_users(wire.decode_users(fx.short_requests(spark, d)).rows)


def q_route_known_users(spark, d):
    return routing.known_users(_request_users(spark, d), fx.known_users(spark, d))


def q_route_new_users(spark, d):
    return routing.new_users(_request_users(spark, d), fx.known_users(spark, d))


def q_fallback_popular(spark, d):
    fresh = routing.new_users(_request_users(spark, d), fx.known_users(spark, d))
    return routing.fallback_popular(fresh, _popular(spark, d), fx.movies(spark, d))


def q_recommend_routed(spark, d):
    routed = routing.route(_request_users(spark, d), _factor_recs(spark, d), _popular(spark, d))
    return routed.select("userId", "movieId", _round("rating"))


def q_recommendation_titles(spark, d):
    recs = _factor_recs(spark, d)
    return popularity.with_titles(recs, fx.movies(spark, d)).select("userId", "movieId", _round("score"), "title")


# ---- phase 5: scoring without ALS randomness ----------------------------------------

def q_factor_top_k(spark, d):
    return _factor_recs(spark, d).select("userId", "movieId", _round("score"))


def _item_mean_join(spark, d):
    train, test = _splits(spark, d)
    pairs = test.select("userId", "movieId").distinct()
    return scoring.prediction_fact_join(scoring.item_mean_predictions(train, pairs), test)


def q_prediction_fact_join(spark, d):
    return _item_mean_join(spark, d).select("userId", "movieId", _round("prediction"), "rating")


def q_rmse_item_mean(spark, d):
    return scoring.rmse(_item_mean_join(spark, d)).select(_round("rmse"), "n")


def q_best_run(spark, d):
    """A grid of damped item-mean models scored on the test split; the best run wins."""
    train, test = _splits(spark, d)
    stats = _stored(train.groupBy("movieId").agg(F.sum("rating").alias("_s"), F.count(F.lit(1)).alias("_c")), "stats")
    mu = stats.agg(F.sum("_s") / F.sum("_c")).first()[0]          # one scalar, from the statistics
    runs = F.array(*[F.struct(F.lit(i + 1).alias("run_id"), F.lit(float(v)).alias("damping"))
                     for i, v in enumerate(DAMPING_GRID)])
    models = stats.select("movieId", "_s", "_c", F.explode(runs).alias("_run")).select(
        "movieId", F.col("_run.run_id").alias("run_id"), F.col("_run.damping").alias("damping"),
        ((F.col("_s") + F.col("_run.damping") * F.lit(mu)) / (F.col("_c") + F.col("_run.damping"))).alias("prediction"))
    scored = test.join(models, "movieId", "inner")
    err = F.col("prediction") - F.col("rating")
    metrics = scored.groupBy("run_id", "damping").agg(F.sqrt(F.avg(err * err)).alias("rmse"),
                                                       F.count(F.lit(1)).alias("n"))
    return scoring.best_run(metrics).select("run_id", "damping", _round("rmse"), "n")


# ---- tables that meet without a shuffle, top-k with bounds, membership index --------------

def q_colocated_predictions(spark, d):
    """Predictions and held-out ratings, bucketed by (user, movie), joined bucket by bucket."""
    train, test = _splits(spark, d)
    pairs = test.select("userId", "movieId").distinct()
    left, right = _table(spark), _table(spark)
    colocated.store(scoring.item_mean_predictions(train, pairs), left, ["userId", "movieId"])
    colocated.store(test, right, ["userId", "movieId"])
    return colocated.join(left, right, spark).select("userId", "movieId", _round("prediction"), "rating")


def q_colocated_titles(spark, d):
    """Recommendations and titles, bucketed by movie."""
    left, right = _table(spark), _table(spark)
    colocated.store(_factor_recs(spark, d), left, ["movieId"])
    colocated.store(fx.movies(spark, d).select("movieId", "title"), right, ["movieId"])
    return colocated.join(left, right, spark, "left").select("userId", "movieId", _round("score"), "title")


def q_colocated_membership(spark, d):
    """Request users and known users, bucketed by user."""
    left, right = _table(spark), _table(spark)
    colocated.store(_request_users(spark, d), left, ["userId"])
    colocated.store(fx.known_users(spark, d), right, ["userId"])
    return colocated.known_and_new(left, right, spark)


def q_membership_index(spark, d):
    """The index built of half of the known users, added to with the others; request users split by it."""
    root, everyone = _path(spark, "members"), fx.known_users(spark, d)
    half = F.pmod(F.xxhash64("userId"), F.lit(2)) == 0
    membership.add(spark, root, everyone.where(half))
    membership.add(spark, root, everyone.where(~half))
    index, asked = snapshots.read(spark, root), _stored(_request_users(spark, d), "asked")
    return (membership.known(asked, index).withColumn("known", F.lit(True))
            .unionByName(membership.new(asked, index).withColumn("known", F.lit(False))))


def _weighted_factors(spark, d):
    users, items = fx.factors(spark, d)
    weight = F.lit(1.0) / (1 + F.col("id") % 50)
    return users, items.select("id", F.transform("features", lambda x: x.cast("double") * weight).alias("features"))


def q_bounded_top_k(spark, d):
    """M6: exact top-k over items of different norms, with bounds."""
    users, items = _weighted_factors(spark, d)
    return bounded.bounded_top_k(users, items, TOP_K, slice_bytes=1 << 16).select("userId", "movieId", _round("score"))


# ---- streams that keep something up to date ----------------------------------------------

def q_popularity_stream(spark, d):
    """The popular list of a stream of ratings in three parts; one batch dies before it publishes and runs again."""
    base = _path(spark, "popularity")
    folder, root, checkpoint = (os.path.join(base, x) for x in ("in", "list", "checkpoint"))
    ratings, part = fx.ratings(spark, d), F.pmod(F.xxhash64("userId", "movieId", "ts"), F.lit(3))
    for k in range(3):
        ratings.where(part == k).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(ratings.schema).parquet(folder)
        if k == 1:
            try:
                popularity_stream.start_popularity(stream, root, TOP_K, checkpoint, before_publish=_dies).awaitTermination()
                raise AssertionError("the batch did not die")
            except StreamingQueryException:
                pass
        popularity_stream.start_popularity(stream, root, TOP_K, checkpoint).awaitTermination()
    return popularity.with_titles(popularity_stream.popular(spark, root), fx.movies(spark, d)).select("movieId", "title", "cnt")


def q_replay_in_order(spark, d):
    """Ratings replayed in the order of (ts, user, movie); whether each is after all rows of the batches before."""
    base, keys = _path(spark, "replay"), ["ts", "userId", "movieId"]
    folder, root = os.path.join(base, "in"), os.path.join(base, "out")
    ratings = fx.ratings(spark, d)
    replay.replay_in_order(ratings, folder, keys, REPLAY_RANGES)

    def keep(batch: DataFrame, batch_id: int) -> None:
        ledger.write(spark, root, batch_id, {"rows": batch})
    stream = spark.readStream.schema(ratings.schema).option("maxFilesPerTrigger", "1").parquet(folder)
    (stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
     .start().awaitTermination())
    seen, key = ledger.read(spark, root, "rows", ratings.schema), F.struct(*keys)
    ends = seen.groupBy("batch_id").agg(F.max(key).alias("_last"))                     # a row a batch
    before = ends.select("batch_id", F.lag("_last").over(Window.orderBy("batch_id")).alias("_before"))
    met = seen.join(before, "batch_id").withColumn("in_order", F.coalesce(key > F.col("_before"), F.lit(True)))
    return met.select("userId", "movieId", "rating", "ts", "in_order")


# ---- phase 6: ALS.  A trained model has no SQL equivalent: the queries return its real output, and those named ``_checks`` what
# must hold of it whatever the factors are: which rows there are, and checks computed from them.

def _mean_rmse(train: DataFrame) -> float:
    mu = train.agg(F.avg("rating")).first()[0]
    return scoring.rmse(train.withColumn("prediction", F.lit(mu))).first()["rmse"]


def q_als_train_summary(spark, d):
    """M1 A4: a fitted model's parameters, size and errors."""
    train, test = _splits(spark, d)
    model = als.fit(train)
    errors = als.evaluate(model, train).select(F.lit("train").alias("part"), "rmse", "n").unionByName(
        als.evaluate(model, test).select(F.lit("test").alias("part"), "rmse", "n"))
    return errors.select("part", _round("rmse"), "n", F.lit(model.rank).alias("rank"), F.lit(model.userFactors.count()).alias("n_users"),
                         F.lit(model.itemFactors.count()).alias("n_items"))


def q_als_train_summary_checks(spark, d):
    train, test = _splits(spark, d)
    model = als.fit(train)
    better = als.evaluate(model, train).first()["rmse"] < _mean_rmse(train)
    m = als.evaluate(model, test)
    return m.select(F.lit(model.rank).alias("rank"), F.lit(als.DEFAULT_ITERATIONS).alias("iterations"),
                    F.lit(als.DEFAULT_LAMBDA).alias("lambda"), "n",
                    F.lit(model.userFactors.count()).cast("long").alias("n_users"),
                    F.lit(model.itemFactors.count()).cast("long").alias("n_items"),
                    (F.col("rmse") > 0).alias("scored"), F.lit(better).alias("better_than_mean"))


def q_als_predict_pairs(spark, d):
    """M2: predictions of the held-out pairs."""
    train, test = _splits(spark, d)
    p = als.predict_pairs(als.fit(train), test.select("userId", "movieId", "rating"))
    return p.select("userId", "movieId", "rating", _round("prediction"))


def q_als_predict_pairs_checks(spark, d):
    train, test = _splits(spark, d)
    p = als.predict_pairs(als.fit(train), test.select("userId", "movieId", "rating"))
    finite = ~F.isnan("prediction") & (F.abs("prediction") < float("inf"))
    return p.select("userId", "movieId", "rating", finite.alias("finite"))


def q_als_grid(spark, d):
    """M3 A5: the runs of a grid, two at a time, thinned by one rung on an inner fold; whether a run won."""
    ratings = _stored(fx.ratings(spark, d), "ratings")
    cut = ratings.approxQuantile("ts", [TRAIN_FRACTION], 0.001)[0]
    found = als.grid_search(ratings.where(F.col("ts") <= cut), ratings.where(F.col("ts") > cut), lambdas=(*ALS_GRID_LAMBDAS, 1.0, 5.0),
                            concurrent=2, rungs=1)
    best = found.best.first()["run_id"]
    last = found.metrics.select(F.lit(2).alias("rung"), *als.RUNG_SCHEMA.names[1:])
    return (found.rungs.unionByName(last).withColumn("rmse", F.round("rmse", 6))
            .withColumn("won", (F.col("rung") == 2) & (F.col("run_id") == best)))


def q_als_grid_checks(spark, d):
    train, test = _splits(spark, d)
    found = als.grid_search(train, test, lambdas=ALS_GRID_LAMBDAS, model_root=_path(spark, "models"))
    runs, best = found.metrics.collect(), found.best.first()      # a row per run of the grid
    mean = _mean_rmse(train)
    rows = [(r["run_id"], r["rank"], r["iterations"], r["lambda"], r["blocks"], r["n"],
             als.evaluate(als.load(r["model_path"]), train).first()["rmse"] < mean,
             (r["run_id"] == best["run_id"]) == (r["rmse"] == min(x["rmse"] for x in runs))) for r in runs]
    return spark.createDataFrame(rows, "run_id int, rank int, iterations int, lambda double, blocks int, n long, "
                                       "better_than_mean boolean, best_is_least boolean")


def _checked(recs: DataFrame, model, k: int) -> DataFrame:
    """``userId, rank`` and whether the list has k movies, falls in score, and has the model's scores."""
    recs = _stored(recs, "recs")
    whole = recs.groupBy("userId").agg((F.countDistinct("movieId") == k).alias("distinct_movies"))
    before = F.lag("rating").over(Window.partitionBy("userId").orderBy("rank"))
    r = recs.withColumn("falling", F.coalesce(before >= F.col("rating"), F.lit(True)))
    u = model.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("uf"))
    i = model.itemFactors.select(F.col("id").alias("movieId"), F.col("features").alias("if"))
    dot = F.aggregate(F.zip_with("uf", "if", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    r = r.join(u, "userId").join(i, "movieId").withColumn("own_score", F.abs(dot - F.col("rating")) < 1e-6)
    return r.join(whole, "userId").select("userId", "rank", "distinct_movies", "falling", "own_score")


def q_recommend_one_user(spark, d):
    """M4: titles for the first user of the training set."""
    train, _ = _splits(spark, d)
    recs = als.recommend_users(als.fit(train), popularity.nth_user(train, 1), TOP_K)
    return popularity.with_titles(recs, fx.movies(spark, d)).select("userId", "rank", "movieId", "title", _round("rating"))


def q_recommend_one_user_checks(spark, d):
    train, _ = _splits(spark, d)
    model = als.fit(train)
    recs = als.recommend_users(model, popularity.nth_user(train, 1), TOP_K)
    titled = popularity.with_titles(recs, fx.movies(spark, d)).where("title is not null").drop("title")
    return _checked(titled, model, TOP_K)


def q_recommend_all_users(spark, d):
    """M5: the k best movies of every user, items that cannot be among them not scored."""
    train, _ = _splits(spark, d)
    return als.recommend_all_users(als.fit(train), TOP_K, bounds=True).select("userId", "rank", "movieId", _round("rating"))


def q_recommend_all_users_checks(spark, d):
    train, _ = _splits(spark, d)
    model = als.fit(train)
    return _checked(als.recommend_all_users(model, TOP_K), model, TOP_K)


def _late_users(spark, d):
    """A model without every fifth user, the ratings of all, and the factors that the half-step gives them."""
    train, _ = _splits(spark, d)
    train = _stored(train, "train")
    model = als.fit(train.where(F.col("userId") % LATE_USER_MODULUS != 0))
    return model, train, _stored(foldin.fold_in(model, train, als.DEFAULT_LAMBDA), "folded")


def q_fold_in_users(spark, d):
    """T4: factors by the half-step: a user of the training set has the model's own, others have new ones."""
    model, _, folded = _late_users(spark, d)
    own = model.userFactors.select("id", F.col("features").alias("own"))
    far = F.array_max(F.zip_with("features", "own", lambda a, b: F.abs(a - b)))
    return folded.join(own, "id", "left").select(F.col("id").alias("userId"), F.col("own").isNotNull().alias("trained"),
                                                 F.coalesce(far < 1e-3, F.lit(False)).alias("own_factors"))


def q_recommend_late_users(spark, d):
    """T4 M4: movies for users who came after the fit."""
    model, _, folded = _late_users(spark, d)
    late = folded.join(model.userFactors.select("id"), "id", "left_anti")
    return scoring.factor_top_k(late, model.itemFactors, TOP_K).select("userId", "movieId", _round("score"))


def q_model_round_trip(spark, d):
    """A saved model, read back, has the same factors."""
    train, _ = _splits(spark, d)
    model = als.fit(train, rank=4, iterations=3)
    back = als.load(als.save(model, _path(spark, "model")))
    a = model.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("a"))
    b = back.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("b"))
    return a.join(b, "userId", "full").select("userId", F.coalesce(F.col("a") == F.col("b"), F.lit(False)).alias("same"))


QUERIES: dict[str, Query] = {
    "rating_count": q_rating_count,
    "movie_popularity": q_movie_popularity,
    "popular_top_k": q_popular_top_k,
    "distinct_users": q_distinct_users,
    "nth_user": q_nth_user,
    "ingest_incomplete_filter": q_ingest_incomplete_filter,
    "ingest_links": q_ingest_links,
    "ingest_movies": q_ingest_movies,
    "ingest_users": q_ingest_users,
    "ingest_ratings": q_ingest_ratings,
    "ingest_tags_repaired": q_ingest_tags_repaired,
    "ingest_quarantine": q_ingest_quarantine,
    "ingest_movies_quoted": q_ingest_movies_quoted,
    "movies_deduped": q_movies_deduped,
    "text_round_trip": q_text_round_trip,
    "publish_twice": q_publish_twice,
    "ctas_append": q_ctas_append,
    "publish_interrupted": q_publish_interrupted,
    "stream_restart": q_stream_restart,
    "stream_recovery": q_stream_recovery,
    "stream_trigger": q_stream_trigger,
    "ingest_incremental": q_ingest_incremental,
    "ingest_files": q_ingest_files,
    "split_train": q_split_train,
    "split_test": q_split_test,
    "rank_within_rating": q_rank_within_rating,
    "rank_band_sample": q_rank_band_sample,
    "wire_encode": q_wire_encode,
    "wire_decode": q_wire_decode,
    "request_users": q_request_users,
    "route_known_users": q_route_known_users,
    "route_new_users": q_route_new_users,
    "fallback_popular": q_fallback_popular,
    "recommend_routed": q_recommend_routed,
    "recommendation_titles": q_recommendation_titles,
    "factor_top_k": q_factor_top_k,
    "prediction_fact_join": q_prediction_fact_join,
    "rmse_item_mean": q_rmse_item_mean,
    "best_run": q_best_run,
    "colocated_predictions": q_colocated_predictions,
    "colocated_titles": q_colocated_titles,
    "colocated_membership": q_colocated_membership,
    "membership_index": q_membership_index,
    "bounded_top_k": q_bounded_top_k,
    "als_train_summary": q_als_train_summary,
    "als_train_summary_checks": q_als_train_summary_checks,
    "als_predict_pairs": q_als_predict_pairs,
    "als_predict_pairs_checks": q_als_predict_pairs_checks,
    "als_grid": q_als_grid,
    "als_grid_checks": q_als_grid_checks,
    "recommend_one_user": q_recommend_one_user,
    "recommend_one_user_checks": q_recommend_one_user_checks,
    "recommend_all_users": q_recommend_all_users,
    "recommend_all_users_checks": q_recommend_all_users_checks,
    "popularity_stream": q_popularity_stream,
    "replay_in_order": q_replay_in_order,
    "fold_in_users": q_fold_in_users,
    "recommend_late_users": q_recommend_late_users,
    "model_round_trip": q_model_round_trip,
}
