"""Which attempt of which micro-batch counts.

    <root>/<name>/batch_id=<id>/attempt=<uuid>/   rows that an attempt wrote, one folder per named output
    <root>/ledger/<id>                            the attempt that counts, one line of JSON

A micro-batch writes all its outputs under an attempt of its own, then puts one ledger entry (written beside and
renamed).  Readers join the stored rows with the ledger, so an attempt that died half-way never shows, in no output.  Spark runs
a batch again with the same id and offsets if it died before its own commit: a batch with an entry is done and
skipped, one without is written anew.  So every row counts once, without ``distinct``.  One stream writes to a root.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrec.sinks import files

ENTRY = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("attempt", T.StringType())])
Step = Callable[[int], None]


def committed(spark: SparkSession, root: str, batch_id: int) -> bool:
    return files.exists(spark, f"{root}/ledger/{batch_id}")


def write(spark: SparkSession, root: str, batch_id: int, outputs: dict[str, DataFrame], before_commit: Step | None = None) -> bool:
    """Stores the outputs of a batch and commits it; False if it was committed before.  ``before_commit`` runs when the rows
    are written and the entry is not: side effects that must be repeatable, or a fault in a test."""
    if committed(spark, root, batch_id):
        return False
    attempt = f"a{uuid.uuid4().hex}"
    for name, df in outputs.items():
        folder = f"{root}/{name}/batch_id={batch_id}"
        files.delete(spark, folder)                       # attempts that died
        df.write.parquet(f"{folder}/attempt={attempt}")
    if before_commit:
        before_commit(batch_id)
    files.swap_text(spark, f"{root}/ledger/{batch_id}", json.dumps({"batch_id": batch_id, "attempt": attempt}))
    return True


def entries(spark: SparkSession, root: str) -> DataFrame:
    """``batch_id, attempt`` of the committed batches."""
    if not files.exists(spark, f"{root}/ledger"):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).option("pathGlobFilter", "*[0-9]").json(f"{root}/ledger")


def read(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """Rows of a named output in committed batches, with their ``batch_id``."""
    if not files.exists(spark, f"{root}/{name}"):
        return spark.createDataFrame([], schema).withColumn("batch_id", F.lit(0).cast("long")).limit(0)
    stored = spark.read.schema(T.StructType([*schema.fields, *ENTRY.fields])).parquet(f"{root}/{name}")
    return stored.join(entries(spark, root), ["batch_id", "attempt"], "left_semi").drop("attempt")
