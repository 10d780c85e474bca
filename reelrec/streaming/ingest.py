"""Ingest of the files that are new in a folder.

The folder is a text stream that is read until nothing is left (``availableNow``) and then stops, so a job can run on any
schedule.  Spark's checkpoint knows which files were read; every micro-batch parses its files once (and reads them again to count lines) and commits
rows, rejected lines and a row per file through the ledger.  Any number of runs over a growing folder give what one run over the whole
gives, also if runs die between.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrec.functions.parse import ParseResult, parse_delimited
from reelrec.streaming import ledger

REJECTS = T.StructType([T.StructField("value", T.StringType()), T.StructField("reason", T.StringType())])
FILES = T.StructType([T.StructField("file", T.StringType()), T.StructField("lines", T.LongType())])
MAX_FILES = 1000             # files of a micro-batch


def _one_batch(parse: Callable[[DataFrame], ParseResult], root: str, before_commit: ledger.Step | None):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if ledger.committed(spark, root, batch_id):
            return
        found = parse(batch.select("value"))
        rows, rejects, kept = found.rows, found.rejects, batch
        if found.staged is not None:                                # rows and rejects of one parse; a good line's text is not kept
            bad = F.col("_reason").isNotNull()
            kept = found.staged.withColumn("value", F.when(bad, F.col("value")))
        kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if found.staged is not None:
                rows = kept.where(~bad).select(*rows.columns)
                rejects = kept.where(bad).select("value", F.col("_reason").alias("reason"))
            seen = batch.groupBy("file").agg(F.count(F.lit(1)).alias("lines"))
            ledger.write(spark, root, batch_id, {"rows": rows, "rejects": rejects, "files": seen}, before_commit)
        finally:
            kept.unpersist()
    return run


@dataclass
class Ingested:
    rows: DataFrame
    rejects: DataFrame
    files: DataFrame             # file, lines, batch_id: one row per file that was read


def ingested(spark: SparkSession, root: str, schema: T.StructType) -> Ingested:
    """Everything committed so far."""
    return Ingested(ledger.read(spark, root, "rows", schema).select(*schema.names),
                    ledger.read(spark, root, "rejects", REJECTS).select(*REJECTS.names), ledger.read(spark, root, "files", FILES))


def ingest_new(spark: SparkSession, folder: str, root: str, schema: T.StructType, delim: str, *,
               parse: Callable[[DataFrame], ParseResult] | None = None, max_files: int = MAX_FILES,
               before_commit: ledger.Step | None = None) -> Ingested:
    """Parses the files of ``folder`` that no earlier run has, into ``root``.  Files must appear whole (renamed
    into the folder), as Spark's text sink leaves them."""
    parse = parse or (lambda lines: parse_delimited(lines, schema, delim))
    lines = (spark.readStream.option("maxFilesPerTrigger", str(max_files)).text(folder)
             .select("value", F.col("_metadata.file_path").alias("file")))
    stream = (lines.writeStream.foreachBatch(_one_batch(parse, root, before_commit))
              .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    stream.awaitTermination()
    return ingested(spark, root, schema)
