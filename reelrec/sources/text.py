"""Text line scan.  One row per line in column ``value``; split sizes come from
``spark.sql.files.maxPartitionBytes`` (the reference asked for at least 12 splits; on a
cluster the file splitter already gives far more)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path)
