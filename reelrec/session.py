"""Session helpers.

Library code never sets cluster-sized knobs; it reads what the session has.  The only
setting we fill in is the checkpoint folder, and only when the cluster left
``spark.checkpoint.dir`` unset: then a folder below the warehouse, which is shared too.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "reelrec",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and benches (UI off, AQE on, UTC)."""
    builder = SparkSession.builder
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The reliable checkpoint folder the cluster configured, if any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    try:
        return spark.conf.get("spark.checkpoint.dir")
    except Exception:  # noqa: BLE001 - unset key
        return sc.getConf().get("spark.checkpoint.dir")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``Dataset.checkpoint`` usable: the session's ``spark.checkpoint.dir`` (the cluster's
    shared folder), else a folder below the warehouse.  Never a machine-local temp folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = checkpoint_dir(spark) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once below the checkpoint folder and read back: cuts the lineage, survives lost executors."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` persisted for the duration; a frame that the caller has persisted is left alone."""
    level = df.storageLevel
    if level.useMemory or level.useDisk:
        yield df
        return
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
