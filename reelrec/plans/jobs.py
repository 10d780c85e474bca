"""Composed batch jobs, one per entry point of the reference application.

* ``ingest``: delimited text -> typed tables + a quarantine table (S1 P1-P3 K2)
* ``split``: ratings table -> train / test tables by time (O6 K2)
* ``popular``: train -> top-k table with titles (A2 O4 J2 K2)
* ``train``: grid of ALS fits -> saved models, metrics table, best run (M1 M3 A4 A5 K7)
* ``serve_all`` / ``serve_one``: saved model -> recommendation table, JDBC (S4 M4 M5 J2 K2 K5)
* ``movies_to_jdbc``: movies table -> JDBC, one row per id (K5)
* ``replay``: ratings table -> encoded messages, to files or Kafka (H8 T6 K6)
* ``banded_tables``: ratings -> train / test tables sampled by rank band (W1 O7 K2)
Every step is a DataFrame plan and one write; the driver sees counts, histogram buckets
and one metric row per grid run.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrec import schemas
from reelrec.functions import parse
from reelrec.functions import wire
from reelrec.operators import als, popularity, ranking, routing, split
from reelrec.session import ensure_checkpoint_dir
from reelrec.sinks import tables
from reelrec.sinks.jdbc import MAX_CONNECTIONS, jdbc_append
from reelrec.sources.kafka import write_kafka
from reelrec.sources.text import read_lines
from reelrec.streaming.router import replay_to_files

# Per record kind: schema, delimiter, parser (generation 1 = comma files, 2 = '::' files).
FORMATS = {
    "links": (schemas.LINKS, ",", "plain"),
    "movies": (schemas.MOVIES, ",", "plain"),
    "ratings": (schemas.RATINGS, ",", "plain"),
    "tags": (schemas.TAGS, ",", "tags"),
    "movies.dat": (schemas.MOVIES, "::", "plain"),
    "users.dat": (schemas.USERS, "::", "plain"),
    "ratings.dat": (schemas.RATINGS, "::", "plain"),
}


def parse_kind(lines: DataFrame, kind: str, *, on_error: str = "quarantine", quoted: bool = False) -> parse.ParseResult:
    schema, delim, how = FORMATS[kind]
    if how == "tags":
        return parse.parse_tag_lines(lines, schema, on_error=on_error)
    if quoted and delim == ",":
        return parse.parse_csv_quoted(lines, schema, on_error=on_error)
    return parse.parse_delimited(lines, schema, delim, on_error=on_error)


def ingest(spark: SparkSession, sources: dict[str, str], *, table_prefix: str = "", quarantine_table: str | None = None,
           on_error: str = "quarantine", quoted: bool = False, duplicates_table: str | None = None) -> dict[str, str]:
    """Text files -> published tables ``<prefix><kind>``; returns kind -> table name.

    Bad lines of every kind land in one quarantine table with their kind and reason; movie ids with
    several rows are reported in ``duplicates_table``."""
    published, rejects = {}, []
    for kind, path in sources.items():
        res = parse_kind(read_lines(spark, path), kind, on_error=on_error, quoted=quoted)
        name = table_prefix + kind.replace(".dat", "")
        rows = res.rows
        if res.staged is not None:              # read and parse the file once; rows and rejects come from that
            staged = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest-{uuid.uuid4().hex}"
            tables.write_parquet(res.staged, staged)
            back = spark.read.schema(res.staged.schema).parquet(staged)
            rows = back.where("_reason is null").select(*res.rows.columns)
            rejects.append(back.where("_reason is not null").select("value", F.col("_reason").alias("reason"), F.lit(kind).alias("kind")))
        tables.publish(rows, name)
        published[kind] = name
        if duplicates_table and kind.startswith("movies"):
            tables.publish(popularity.duplicate_movies(spark.table(name)), duplicates_table)
    if quarantine_table and rejects:
        out = rejects[0]
        for r in rejects[1:]:
            out = out.unionByName(r)
        tables.publish(out, quarantine_table)
    return published


def split_tables(spark: SparkSession, ratings_table: str, train_table: str, test_table: str,
                 fraction: float = 0.6) -> tuple[int, int]:
    train, test = split.chronological_split(spark.table(ratings_table), fraction)
    tables.publish(train, train_table)
    tables.publish(test, test_table)
    return spark.table(train_table).count(), spark.table(test_table).count()


def popular_table(spark: SparkSession, train_table: str, movies_table: str, out_table: str, k: int = 5) -> None:
    top = popularity.popular_top_k(spark.table(train_table), popularity.dedupe_movies(spark.table(movies_table)), k)
    tables.publish(top, out_table)


@dataclass
class TrainResult:
    metrics_table: str
    best: dict


def train(spark: SparkSession, train_table: str, test_table: str, model_root: str, metrics_table: str, *,
          ranks=(als.DEFAULT_RANK,), iterations=(als.DEFAULT_ITERATIONS,), lambdas=(als.DEFAULT_LAMBDA,),
          seed: int = als.DEFAULT_SEED, blocks: int = als.DEFAULT_BLOCKS) -> TrainResult:
    res = als.grid_search(spark.table(train_table), spark.table(test_table), ranks=ranks, iterations=iterations,
                          lambdas=lambdas, seed=seed, blocks=blocks, model_root=model_root)
    tables.publish(res.metrics, metrics_table)
    best = res.best.first()
    return TrainResult(metrics_table, best.asDict() if best else {})


def _to_jdbc(df: DataFrame, jdbc: dict) -> None:
    jdbc_append(df, jdbc["url"], jdbc["table"], jdbc.get("properties"), max_connections=jdbc.get("max_connections") or MAX_CONNECTIONS)


def serve_all(spark: SparkSession, model_path: str, out_table: str, k: int = 5, jdbc: dict | None = None,
              buckets: int = routing.USER_BUCKETS) -> None:
    """All-user top-k, stored partitioned by user bucket so stream batches prune files.  ``buckets`` is
    a property of the table: its readers pass the same number."""
    recs = als.recommend_all_users(als.load(model_path), k).withColumn(
        routing.BUCKET_COL, routing.user_bucket("userId", buckets))
    # few buckets to a task (not tasks x buckets small files), rows sorted by user inside
    # each file so Parquet min/max statistics can skip row groups on user filters
    recs = recs.repartitionByRange(buckets, routing.BUCKET_COL).sortWithinPartitions("userId", "rank")
    recs.write.mode("overwrite").format("parquet").partitionBy(routing.BUCKET_COL).saveAsTable(out_table)
    if jdbc:
        _to_jdbc(spark.table(out_table).drop(routing.BUCKET_COL), jdbc)


def serve_one(spark: SparkSession, model_path: str, train_table: str, movies_table: str, index: int,
              k: int = 5, out_table: str | None = None, jdbc: dict | None = None) -> DataFrame:
    """M4 for the ``index``-th user (1-based) of the training table, with titles; stored in a table
    and appended to JDBC if these are given."""
    user = popularity.nth_user(spark.table(train_table), index)
    recs = als.recommend_users(als.load(model_path), user, k)
    titled = popularity.with_titles(recs, popularity.dedupe_movies(spark.table(movies_table)))
    if out_table:
        tables.publish(titled, out_table)
        titled = spark.table(out_table)
    if jdbc:
        _to_jdbc(titled.select("userId", "movieId", "rating"), jdbc)
    return titled


def movies_to_jdbc(spark: SparkSession, movies_table: str, jdbc: dict) -> None:
    """The movies dimension, one row per id."""
    _to_jdbc(popularity.dedupe_movies(spark.table(movies_table)), jdbc)


def replay(spark: SparkSession, ratings_table: str, topic: str, *, path: str | None = None, kafka: str | None = None) -> None:
    """A ratings table as encoded messages: one batch write to files or to Kafka."""
    messages = wire.encode(spark.table(ratings_table), topic)
    if path:
        replay_to_files(messages, path)
    if kafka:
        write_kafka(messages, kafka, topic)


def banded_tables(spark: SparkSession, ratings_table: str, train_table: str, test_table: str,
                  bounds: tuple[int, int] | None = None) -> None:
    """Train and test tables sampled by rank band: bands 1 and 2 of every rating value."""
    ratings = spark.table(ratings_table)
    tables.publish(ranking.banded(ratings, 1, bounds), train_table)
    tables.publish(ranking.banded(ratings, 2, bounds), test_table)
