"""A table replayed as stream input in the order of its keys.

Rows are range-partitioned and sorted by the keys, one file per range; a range holds about ``FILE_ROWS`` rows at most, so a large
table makes more ranges, not larger ones.  The files are renamed into the stream's folder with
modification times that rise in key order, which is the order in which a file stream takes them: with one file a trigger the
stream sees the rows in order across batches, equal keys in one batch.  A later replay comes after the files that are there.  For
file systems that keep modification times (HDFS, local); on an object store use a Kafka topic with one partition.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from reelrec.session import stored
from reelrec.sinks import files

TICK = 1000                  # milliseconds between files
FILE_ROWS = 5_000_000


def replay_in_order(messages: DataFrame, folder: str, keys: Sequence[str], ranges: int) -> int:
    """Writes ``messages`` as at most ``ranges`` Parquet files ordered by ``keys``, or as many as keep a file to about
    ``FILE_ROWS`` rows; returns how many."""
    spark = messages.sparkSession
    messages = stored(messages, "messages")               # counted, sampled and sorted from here
    ranges = max(ranges, -(-messages.count() // FILE_ROWS))
    staging = f"{folder.rstrip('/')}__{uuid.uuid4().hex}"
    messages.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).write.parquet(staging)
    parts = [name for name, _ in files.children(spark, staging) if name.startswith("part-")]     # by partition number
    last = max([t for _, t in files.children(spark, folder)], default=0)
    start = max(last + TICK, int(time.time() * 1000) - TICK * len(parts))
    tag = uuid.uuid4().hex
    for i, name in enumerate(parts):
        files.set_time(spark, f"{staging}/{name}", start + i * TICK)
        files.move(spark, f"{staging}/{name}", f"{folder}/{tag}-{name}")
    files.delete(spark, staging)
    return len(parts)
