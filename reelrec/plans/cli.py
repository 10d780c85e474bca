"""``spark-submit -m``-style entry points, one per job of the reference application.

    python -m reelrec.plans.cli ingest --ratings.dat hdfs:///data/ratings.dat --movies.dat ... --prefix new_
    python -m reelrec.plans.cli split --ratings new_ratings --train new_trainingdata --test new_testdata
    python -m reelrec.plans.cli popular --train new_trainingdata --movies new_movies --out top5df
    python -m reelrec.plans.cli train --train new_trainingdata --test new_testdata --model-root /models --metrics runs
    python -m reelrec.plans.cli serve-all --model /models/run=1 --out recs
    python -m reelrec.plans.cli serve-one --model /models/run=1 --train new_trainingdata --movies new_movies --index 3
    python -m reelrec.plans.cli movies-to-jdbc --movies new_movies --jdbc-url jdbc:... --jdbc-table movies
    python -m reelrec.plans.cli replay --ratings new_ratings --files /messages
    python -m reelrec.plans.cli banded --ratings new_ratings --train band_train --test band_test
    python -m reelrec.plans.cli stream --kafka host:9092 --recs recs --popular top5df --out /recs_stream --checkpoint /ck

The session comes from the cluster (``getOrCreate``); nothing here sets cluster sizing.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from reelrec.functions import wire
from reelrec.operators import als, routing
from reelrec.plans import jobs
from reelrec.session import ensure_checkpoint_dir
from reelrec.sources.kafka import MAX_OFFSETS_PER_TRIGGER, kafka_request_stream
from reelrec.streaming import router


def _floats(s: str) -> tuple[float, ...]:
    return tuple(float(x) for x in s.split(","))


def _ints(s: str) -> tuple[int, ...]:
    return tuple(int(x) for x in s.split(","))


def _jdbc(a) -> dict | None:
    if not a.jdbc_url:
        return None
    props = json.loads(a.jdbc_properties) if a.jdbc_properties else {}
    return {"url": a.jdbc_url, "table": a.jdbc_table, "properties": props, "max_connections": a.jdbc_connections}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="reelrec")
    sub = p.add_subparsers(dest="cmd", required=True)

    ing = sub.add_parser("ingest", help="delimited text -> typed tables + quarantine")
    for kind in jobs.FORMATS:
        ing.add_argument(f"--{kind}", dest=kind.replace(".", "_"))
    ing.add_argument("--prefix", default="")
    ing.add_argument("--quarantine")
    ing.add_argument("--duplicates", help="table for movie ids with several rows")
    ing.add_argument("--on-error", default="quarantine", choices=["quarantine", "fail", "drop"])
    ing.add_argument("--quoted", action="store_true", help="RFC-4180 quotes in comma files")

    sp = sub.add_parser("split", help="chronological train/test split")
    sp.add_argument("--ratings", required=True)
    sp.add_argument("--train", required=True)
    sp.add_argument("--test", required=True)
    sp.add_argument("--fraction", type=float, default=0.6)

    po = sub.add_parser("popular", help="top-k most rated movies with titles")
    po.add_argument("--train", required=True)
    po.add_argument("--movies", required=True)
    po.add_argument("--out", required=True)
    po.add_argument("--k", type=int, default=5)

    tr = sub.add_parser("train", help="ALS grid search, models saved per run")
    tr.add_argument("--train", required=True)
    tr.add_argument("--test", required=True)
    tr.add_argument("--model-root", required=True)
    tr.add_argument("--metrics", required=True)
    tr.add_argument("--ranks", type=_ints, default=(10,))
    tr.add_argument("--iterations", type=_ints, default=(10,))
    tr.add_argument("--lambdas", type=_floats, default=(0.07,))
    tr.add_argument("--blocks", type=int, default=als.DEFAULT_BLOCKS, help="ALS blocks: parallelism, part of the model")

    ba = sub.add_parser("banded", help="train and test tables sampled by rank band")
    ba.add_argument("--ratings", required=True)
    ba.add_argument("--train", required=True)
    ba.add_argument("--test", required=True)
    ba.add_argument("--bounds", type=_ints, help="two ranks; default: thirds of each rating value")

    re = sub.add_parser("replay", help="ratings table as encoded messages")
    re.add_argument("--ratings", required=True)
    re.add_argument("--topic", default=wire.DEFAULT_TOPIC)
    re.add_argument("--files", help="folder for Parquet messages")
    re.add_argument("--kafka", help="bootstrap servers")

    for name in ("serve-all", "serve-one", "stream", "movies-to-jdbc"):
        s = sub.add_parser(name)
        s.add_argument("--jdbc-url")
        s.add_argument("--jdbc-table", default="movies" if name == "movies-to-jdbc" else "recommendations")
        s.add_argument("--jdbc-properties", help="JSON, e.g. driver/user/password")
        s.add_argument("--jdbc-connections", type=int)
        if name == "movies-to-jdbc":
            s.add_argument("--movies", required=True)
        if name in ("serve-all", "serve-one"):
            s.add_argument("--k", type=int, default=5)
            s.add_argument("--model", required=True)
        if name in ("serve-all", "stream"):
            s.add_argument("--buckets", type=int, default=routing.USER_BUCKETS, help="of the stored recommendations")
        if name == "serve-all":
            s.add_argument("--out", required=True)
        if name == "serve-one":
            s.add_argument("--train", required=True)
            s.add_argument("--movies", required=True)
            s.add_argument("--index", type=int, required=True)
            s.add_argument("--out", help="table for the result")
        if name == "stream":
            s.add_argument("--kafka", help="bootstrap servers; else --files")
            s.add_argument("--topics", default=wire.DEFAULT_TOPIC)
            s.add_argument("--kafka-option", action="append", default=[], metavar="KEY=VALUE", help="passed to the source, e.g. kafka.group.id=g")
            s.add_argument("--max-offsets", type=int, default=MAX_OFFSETS_PER_TRIGGER, help="messages of a micro-batch")
            s.add_argument("--files", help="folder of key/value Parquet files")
            s.add_argument("--recs", required=True, help="table userId, movieId, rating")
            s.add_argument("--popular", required=True)
            s.add_argument("--movies")
            s.add_argument("--out", required=True)
            s.add_argument("--rejects")
            s.add_argument("--checkpoint", required=True)
            s.add_argument("--trigger", default=router.DEFAULT_TRIGGER)
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"reelrec-{a.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if a.cmd == "ingest":
        sources = {k: getattr(a, k.replace(".", "_")) for k in jobs.FORMATS if getattr(a, k.replace(".", "_"))}
        print(jobs.ingest(spark, sources, table_prefix=a.prefix, quarantine_table=a.quarantine,
                          on_error=a.on_error, quoted=a.quoted, duplicates_table=a.duplicates))
    elif a.cmd == "split":
        print(jobs.split_tables(spark, a.ratings, a.train, a.test, a.fraction))
    elif a.cmd == "popular":
        jobs.popular_table(spark, a.train, a.movies, a.out, a.k)
    elif a.cmd == "train":
        print(jobs.train(spark, a.train, a.test, a.model_root, a.metrics, ranks=a.ranks,
                         iterations=a.iterations, lambdas=a.lambdas, blocks=a.blocks).best)
    elif a.cmd == "serve-all":
        jobs.serve_all(spark, a.model, a.out, a.k, _jdbc(a), a.buckets)
    elif a.cmd == "serve-one":
        jobs.serve_one(spark, a.model, a.train, a.movies, a.index, a.k, a.out, _jdbc(a)).show(truncate=False)
    elif a.cmd == "movies-to-jdbc":
        jobs.movies_to_jdbc(spark, a.movies, _jdbc(a))
    elif a.cmd == "replay":
        jobs.replay(spark, a.ratings, a.topic, path=a.files, kafka=a.kafka)
    elif a.cmd == "banded":
        jobs.banded_tables(spark, a.ratings, a.train, a.test, a.bounds)
    elif a.cmd == "stream":
        source = (kafka_request_stream(spark, a.kafka, a.topics, max_offsets_per_trigger=a.max_offsets,
                                       **dict(o.split("=", 1) for o in a.kafka_option)) if a.kafka
                  else router.file_request_stream(spark, a.files))
        cfg = router.RouterConfig(
            recommendations=lambda s: s.table(a.recs).withColumnRenamed("rating", "score"),
            popular=lambda s: s.table(a.popular),
            movies=(lambda s: s.table(a.movies)) if a.movies else None,
            out_path=a.out, rejects_path=a.rejects, jdbc=_jdbc(a), buckets=a.buckets)
        router.start_router(source, cfg, a.checkpoint, trigger=a.trigger).awaitTermination()


if __name__ == "__main__":
    main()
