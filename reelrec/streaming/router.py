"""The request stream, routed per micro-batch.

    source (Kafka or a Parquet file stream of ``key, value``)
      -> decode (H8, bad messages quarantined)
      -> foreachBatch: distinct users of the batch (D22)
                       known users  -> their stored top-k        (J3 + join)
                       other users  -> popular list, score 0.0   (J4)
                       union (U1) -> <out>/batch_id=<id>  (overwrite: a replayed batch
                                     rewrites the same folder, so the sink is idempotent)
                       optional JDBC append of that batch, tagged with batch_id
                       with a ledger: rows and rejects of an attempt, then one entry that makes them count

The stored recommendations and the popular list are re-read once per batch (D21), so a
refreshed model table is picked up without restarting.  The streaming checkpoint keeps
source offsets, so a restart resumes instead of skipping to the latest offset (T5).
The driver gets the popular list (its k rows) and the user buckets a batch touches; all else is a few joins and one write.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelrec import schemas
from reelrec.functions import wire
from reelrec.operators import routing
from reelrec.sinks.jdbc import MAX_CONNECTIONS, delete_batch, jdbc_append
from reelrec.streaming import ledger

# Fixed value: the reference's live micro-batch interval.
DEFAULT_TRIGGER = "15 seconds"


def file_request_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of ``key, value`` messages as a stream (test stand-in for Kafka)."""
    r = spark.readStream.schema(schemas.WIRE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def replay_to_files(messages: DataFrame, path: str) -> None:
    """A table replayed as stream input (one append of encoded rows)."""
    messages.select("key", "value").write.mode("append").parquet(path)


@dataclass
class RouterConfig:
    recommendations: Callable[[SparkSession], DataFrame]   # userId, movieId, score
    popular: Callable[[SparkSession], DataFrame]           # movieId, ...
    out_path: str
    rejects_path: str | None = None
    movies: Callable[[SparkSession], DataFrame] | None = None
    jdbc: dict | None = None                               # url, table, properties
    buckets: int = routing.USER_BUCKETS                    # of the stored recommendations
    ledger: bool = False                                   # batches count once they are in the ledger below out_path
    before_commit: ledger.Step | None = None               # runs between a batch's rows and its ledger entry


def route_batch(cfg: RouterConfig) -> Callable[[DataFrame, int], None]:
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if cfg.ledger and ledger.committed(spark, cfg.out_path, batch_id):
            return
        # the batch is read by routing, the bucket list and the rejects: read the source once
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _route_one(cfg, spark, batch, batch_id)
        finally:
            batch.unpersist()
    return run


def _route_one(cfg: RouterConfig, spark: SparkSession, batch: DataFrame, batch_id: int) -> None:
    """One micro-batch: decode, route, write ``batch_id=<id>`` (overwrite), rejects, JDBC."""
    decoded = wire.decode_users(batch)
    users = routing.request_users(decoded.rows)
    movies = cfg.movies(spark) if cfg.movies else None
    routed = routing.route(users, cfg.recommendations(spark), cfg.popular(spark), movies, buckets=cfg.buckets)
    if cfg.ledger:
        def step(done: int) -> None:
            if cfg.jdbc:
                attempt = spark.read.parquet(os.path.join(cfg.out_path, "rows", f"batch_id={done}"))
                _to_jdbc(cfg, spark, attempt.drop("attempt"), done)
            if cfg.before_commit:
                cfg.before_commit(done)
        ledger.write(spark, cfg.out_path, batch_id, {"rows": routed, "rejects": decoded.rejects}, step)
        return
    target = os.path.join(cfg.out_path, f"batch_id={batch_id}")
    routed.write.mode("overwrite").parquet(target)
    if cfg.rejects_path:
        decoded.rejects.write.mode("overwrite").parquet(os.path.join(cfg.rejects_path, f"batch_id={batch_id}"))
    if cfg.jdbc:
        _to_jdbc(cfg, spark, spark.read.parquet(target), batch_id)


def _to_jdbc(cfg: RouterConfig, spark: SparkSession, rows: DataFrame, batch_id: int) -> None:
    """The rows of a batch, in place of those that an attempt before may have sent."""
    rows = rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
    delete_batch(spark, cfg.jdbc["url"], cfg.jdbc["table"], batch_id, cfg.jdbc.get("properties"))
    jdbc_append(rows, cfg.jdbc["url"], cfg.jdbc["table"], cfg.jdbc.get("properties"),
                max_connections=cfg.jdbc.get("max_connections") or MAX_CONNECTIONS)


def routed_rows(spark: SparkSession, cfg: RouterConfig) -> DataFrame:
    """``batch_id, userId, movieId, rating`` of the committed batches of a router with a ledger."""
    return ledger.read(spark, cfg.out_path, "rows", schemas.RECOMMENDATION)


def start_router(requests: DataFrame, cfg: RouterConfig, checkpoint: str, *,
                 trigger: str | None = DEFAULT_TRIGGER, available_now: bool = False,
                 name: str | None = None) -> StreamingQuery:
    """T1 + T2: start the stream; ``available_now`` drains what is there and stops."""
    w = requests.writeStream.foreachBatch(route_batch(cfg)).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()
