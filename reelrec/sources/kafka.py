"""S3 / K6: Kafka edge as option builders over the (key, value) string schema.

The Kafka connector jar is not on this image's classpath, so these are exercised only
for their options in tests; the same ``key, value`` frames flow through file streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


MAX_OFFSETS_PER_TRIGGER = 1_000_000     # messages of a micro-batch, also of the first after an outage


def kafka_request_stream(spark: SparkSession, bootstrap: str, topics: str = "real-time",
                         starting_offsets: str = "latest", max_offsets_per_trigger: int | None = MAX_OFFSETS_PER_TRIGGER,
                         **extra: str) -> DataFrame:
    """Subscribe to ``topics``; values cast to string as the reference's deserializers did.

    Offsets live in the streaming checkpoint, so a restart resumes where it stopped instead
    of skipping to the latest offset (T5 ruling)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", topics)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in extra.items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("key").cast("string").alias("key"),
                                F.col("value").cast("string").alias("value"))


def kafka_write_options(bootstrap: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, "kafka.acks": "all"}


def write_kafka(messages: DataFrame, bootstrap: str, topic: str) -> None:
    """K6: batch write of (key, value) messages with ``acks=all``."""
    (messages.select("key", "value").write.format("kafka")
     .options(**kafka_write_options(bootstrap, topic)).save())
