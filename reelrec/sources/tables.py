"""Whole-table scans.  Parquet paths or catalog names; pruning and filter pushdown are
left to Catalyst (callers select columns before actions)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

WAREHOUSE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                    "events", "documents", "embeddings", "pages", "benchmark", "labels",
                    "conversations")


def read_table(spark: SparkSession, name_or_path: str, base_dir: str | None = None) -> DataFrame:
    """``spark.table(name)`` for catalog names, ``spark.read.parquet`` for paths."""
    if base_dir is not None:
        return spark.read.parquet(os.path.join(base_dir, f"{name_or_path}.parquet"))
    if "/" in name_or_path or name_or_path.endswith(".parquet"):
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)
