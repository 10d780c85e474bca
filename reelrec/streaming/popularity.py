"""The list of most-rated movies, kept up to date by a stream of ratings.

Counts per movie are the state of a streaming aggregation.  A micro-batch gives the new counts of the movies it
rated (update mode) and merges them with the list published before: counts only grow, so the k best are among the old list and
the movies that changed.  The list is published as a snapshot; a batch that runs again gives the same counts, and the larger
count of a movie stands, so nothing doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelrec.sinks import snapshots
from reelrec.streaming.ledger import Step


def best(counts: DataFrame, k: int) -> DataFrame:
    """``movieId, cnt`` of the k largest counts, ties by id."""
    return counts.orderBy(F.desc("cnt"), F.asc("movieId")).limit(k)


def _merge(root: str, k: int, before_publish: Step | None):
    def run(changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        old = snapshots.current(spark, root)
        if old is not None:
            changed = changed.unionByName(snapshots.read(spark, root, old)).groupBy("movieId").agg(F.max("cnt").alias("cnt"))
        staged = snapshots.stage(best(changed, k), root)
        if before_publish:
            before_publish(batch_id)
        snapshots.commit(spark, root, staged, expected=old)
        snapshots.expire(spark, root, keep=2)
    return run


def start_popularity(ratings: DataFrame, root: str, k: int, checkpoint: str, *, trigger: str | None = None,
                     before_publish: Step | None = None) -> StreamingQuery:
    """Keeps the k most-rated movies of a stream ``movieId, ...`` at ``root``; without ``trigger`` it reads what is there and stops."""
    counts = ratings.where("movieId is not null").groupBy("movieId").agg(F.count(F.lit(1)).alias("cnt"))
    w = counts.writeStream.outputMode("update").foreachBatch(_merge(root, k, before_publish)).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=trigger) if trigger else w.trigger(availableNow=True)).start()


def popular(spark: SparkSession, root: str) -> DataFrame:
    """The list now."""
    return snapshots.read(spark, root)
