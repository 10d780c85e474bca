"""A maintained index of known users, so that a micro-batch does not derive them again.

The index is a table of bitmaps: ``bucket`` is a range of 32,768 ids (Spark's ``bitmap_bucket_number``) and ``bits`` has a bit for
each of them.  Bitmaps of one bucket merge by OR, so new users are added by building the bitmaps of the new rows alone and
merging those with the stored ones, and any number of partial indexes can be merged in any order.  Unlike a Bloom filter the
answer is exact: a set bit is a known user.  A bucket takes 4 KB: 1,000,000,000 dense ids are 125 MB.

The index is kept as snapshots: an update publishes a new one, and a batch that has begun keeps the one it resolved.  A lookup
joins the distinct buckets of a batch with the index; the ids of a bucket are at most 32,768 per distinct id, so no key is hot.
Null ids are no members.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrec.sinks import snapshots


def bitmaps(users: DataFrame) -> DataFrame:
    """``userId`` -> ``bucket, bits``."""
    u = F.col("userId").cast("long")
    return (users.where("userId is not null").groupBy(F.bitmap_bucket_number(u).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(u)).alias("bits")))


def merged(*indexes: DataFrame) -> DataFrame:
    """One index of the users of all."""
    every = indexes[0]
    for other in indexes[1:]:
        every = every.unionByName(other)
    return every.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def add(spark: SparkSession, root: str, users: DataFrame) -> str:
    """Adds users to the index at ``root`` (made if it is not there) and publishes it; the users that it has are not read
    again, only their bitmaps."""
    before = snapshots.current(spark, root)
    new = bitmaps(users)
    if before is not None:
        new = merged(snapshots.read(spark, root, before), new)
    return snapshots.publish(new, root, expected=before)


def size(index: DataFrame) -> DataFrame:
    """One row ``n``: users in the index."""
    return index.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))


def _member(users: DataFrame, index: DataFrame) -> DataFrame:
    u = F.col("userId").cast("long")
    position = F.bitmap_bit_position(u)
    asked = users.withColumn("_bucket", F.bitmap_bucket_number(u))
    met = asked.join(index.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits")), "_bucket", "left")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(bitmap_bit_position(cast(userId as long)) div 8 as int) + 1, 1)")), 16, 10).cast("long")
    bit = F.getbit(byte, F.pmod(position, F.lit(8)).cast("int"))
    return met.withColumn("_known", F.coalesce(bit == 1, F.lit(False))).drop("_bucket", "_bits")


def known(users: DataFrame, index: DataFrame) -> DataFrame:
    """The users that the index has."""
    return _member(users, index).where("_known").drop("_known")


def new(users: DataFrame, index: DataFrame) -> DataFrame:
    """The users that the index does not have."""
    return _member(users, index).where(~F.col("_known")).drop("_known")
