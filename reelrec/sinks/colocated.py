"""K3 for tables that meet again and again: bucketed and sorted by their join key.

Spark joins two tables of one bucketing without a shuffle: bucket n of one meets bucket n of the other in one task.  The
number of buckets is a property of the tables that are to meet, not of a run: choose it so that a bucket of the
larger one is about 1 GB at its final size (a join reads a bucket in a task), and give all of them the same.  A key that
holds a large part of all rows makes one bucket large; such tables stay unbucketed, where AQE splits the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


def store(df: DataFrame, table: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``df`` as a table bucketed and sorted by ``keys``.  It is dealt out by the buckets' own hash first, so each bucket is
    one file (written by one task)."""
    (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, keys[0], *keys[1:])
     .sortBy(keys[0], *keys[1:]).saveAsTable(table))
    return df.sparkSession.table(table)


def bucketing(spark: SparkSession, table: str) -> tuple[int, list[str]] | None:
    """Number of buckets and their columns; None if the table has none."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if not rows.get("Num Buckets", "").isdigit():
        return None
    return int(rows["Num Buckets"]), rows["Bucket Columns"].strip("[]").replace("`", "").split(", ")


def join(left: str, right: str, spark: SparkSession, how: str = "inner") -> DataFrame:
    """The join of two tables on the columns they are both bucketed by, bucket by bucket; raises if they aren't alike."""
    on = bucketing(spark, left)
    if on is None or on != bucketing(spark, right):
        raise ValueError(f"{left} and {right} are not bucketed alike")
    return spark.table(left).join(spark.table(right).hint("merge"), on[1], how)


def known_and_new(requests: str, known: str, spark: SparkSession) -> DataFrame:
    """The request users of one table with ``known``, whether the other table has them; both bucketed by user."""
    there = bucketing(spark, known)
    if there is None or there != bucketing(spark, requests):
        raise ValueError(f"{requests} and {known} are not bucketed alike")
    member = spark.table(known).select(*there[1], F.lit(True).alias("known")).hint("merge")
    return spark.table(requests).join(member, there[1], "left").withColumn("known", F.coalesce("known", F.lit(False)))
