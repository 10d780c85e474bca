"""Stream router: availableNow over three files, restart with a fourth (no loss, no
repeat), one recommendation set per (batch, user), replay of a batch is idempotent."""

import glob
import os

from pyspark.sql import functions as F

from reelrec.functions import wire
from reelrec.operators import popularity, scoring
from reelrec.sources import fixtures as fx
from reelrec.streaming import router

from conftest import SF_SMALL


def _cfg(spark, scratch):
    users, items = fx.factors(spark, SF_SMALL)
    recs_path = os.path.join(scratch, "recs")
    scoring.factor_top_k(users, items, 5).write.parquet(recs_path)
    pop_path = os.path.join(scratch, "popular")
    popularity.popular_top_k(fx.ratings(spark, SF_SMALL), fx.movies(spark, SF_SMALL), 5).write.parquet(pop_path)
    return router.RouterConfig(recommendations=lambda s: s.read.parquet(recs_path),
                               popular=lambda s: s.read.parquet(pop_path),
                               out_path=os.path.join(scratch, "out"),
                               rejects_path=os.path.join(scratch, "rejects"))


def _users(df):
    return {r.userId for r in wire.decode(df).rows.select("userId").distinct().collect()}


def test_available_now_restart_and_replay(spark, scratch):
    req = fx.requests(spark, SF_SMALL)
    parts = [req.where(F.pmod(F.hash("value"), F.lit(4)) == i) for i in range(4)]
    src = os.path.join(scratch, "src")
    for p in parts[:3]:
        router.replay_to_files(p.coalesce(1), src)
    bad = spark.createDataFrame([("real-time", "bad"), ("real-time", None)], "key string, value string")
    router.replay_to_files(bad.coalesce(1), src)
    cfg = _cfg(spark, scratch)
    ck = os.path.join(scratch, "ck")

    def run():
        q = router.start_router(router.file_request_stream(spark, src, max_files_per_trigger=2), cfg, ck,
                                available_now=True)
        q.awaitTermination(300)
        assert q.exception() is None

    run()
    assert len(glob.glob(os.path.join(cfg.out_path, "batch_id=*"))) == 2   # four files, two per trigger
    router.replay_to_files(parts[3].coalesce(1), src)
    run()                                                                    # restart from the checkpoint
    assert len(glob.glob(os.path.join(cfg.out_path, "batch_id=*"))) == 3   # only the new file was read

    out = spark.read.parquet(cfg.out_path)
    per = out.groupBy("batch_id", "userId").count().collect()
    assert per and all(r["count"] == 5 for r in per)                        # one set per (batch, user)
    assert {r.userId for r in out.select("userId").distinct().collect()} == _users(req)   # no loss
    assert {r.userId for r in out.where("batch_id = 2").select("userId").distinct().collect()} == _users(parts[3])
    assert out.where(F.col("userId") % 10 == 0).where(F.col("rating") == 0.0).count() == 0   # model users
    assert out.where(F.col("userId") % 10 != 0).where(F.col("rating") != 0.0).count() == 0  # popular fallback
    assert spark.read.parquet(cfg.rejects_path).count() == 2

    # replaying a batch id rewrites the same folder with the same rows
    step = router.route_batch(cfg)
    step(parts[3], 7)
    first = sorted(tuple(r) for r in spark.read.parquet(os.path.join(cfg.out_path, "batch_id=7")).collect())
    step(parts[3], 7)
    second = sorted(tuple(r) for r in spark.read.parquet(os.path.join(cfg.out_path, "batch_id=7")).collect())
    assert first == second and len(first) == 5 * len(_users(parts[3]))


def test_processing_time_trigger(spark, scratch):
    src = os.path.join(scratch, "src")
    router.replay_to_files(fx.requests(spark, SF_SMALL).coalesce(1), src)
    cfg = _cfg(spark, scratch)
    q = router.start_router(router.file_request_stream(spark, src), cfg, os.path.join(scratch, "ck"),
                            trigger="1 second", name="reelrec_router_test")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(cfg.out_path).select("userId").distinct().count() == len(
        _users(fx.requests(spark, SF_SMALL)))


def test_kafka_options():
    from reelrec.sources import kafka
    opts = kafka.kafka_write_options("h1:9092,h2:9092", "real-time")
    assert opts == {"kafka.bootstrap.servers": "h1:9092,h2:9092", "topic": "real-time", "kafka.acks": "all"}


def test_bucketed_recommendations_prune_partitions(spark, scratch):
    from reelrec.operators import routing
    users, items = fx.factors(spark, SF_SMALL)
    recs_path = os.path.join(scratch, "recs_by_bucket")
    (scoring.factor_top_k(users, items, 5).withColumn(routing.BUCKET_COL, routing.user_bucket("userId"))
     .write.partitionBy(routing.BUCKET_COL).parquet(recs_path))
    recs = spark.read.parquet(recs_path)
    pop = popularity.popular_top_k(fx.ratings(spark, SF_SMALL), fx.movies(spark, SF_SMALL), 5)
    batch = spark.createDataFrame([(30,), (70,), (121,)], "userId int")
    out = routing.route(batch, recs, pop)
    rows = sorted(tuple(r) for r in out.collect())
    assert len(rows) == 15 and {r[0] for r in rows} == {30, 70, 121}
    assert all(r[2] == 0.0 for r in rows if r[0] == 121)
    plan = out._jdf.queryExecution().executedPlan().toString()
    touched = sorted({r[0] for r in batch.select(routing.user_bucket("userId")).collect()})
    assert "IN (" + ",".join(str(b) for b in touched) + ")" in plan    # static partition pruning


def test_route_batch_jdbc_append_carries_batch_id(spark, scratch):
    from reelrec.sinks import jdbc
    cfg = _cfg(spark, scratch)
    cfg.jdbc = {"url": "jdbc:derby:memory:reelrec_stream;create=true", "table": "user_movies_recommendation",
                "properties": {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}, "max_connections": 1}
    batch = fx.requests(spark, SF_SMALL).limit(20)
    router.route_batch(cfg)(batch, 3)
    router.route_batch(cfg)(batch, 3)           # a replay leaves one copy
    back = jdbc.jdbc_read(spark, cfg.jdbc["url"], cfg.jdbc["table"], cfg.jdbc["properties"])
    rows = back.collect()
    assert rows and {r["batch_id"] for r in rows} == {3}
    assert len(rows) == spark.read.parquet(os.path.join(cfg.out_path, "batch_id=3")).count()
