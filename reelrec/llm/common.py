"""Shared helpers of the operators: reading tables, tables written to the shared folder,
and pickling by value so that executors need no copy of this package."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrec.session import ensure_checkpoint_dir

SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def by_value(name: str) -> None:
    """Tasks get the functions of module ``name`` with the task, not by import."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


def per_worker(key: tuple, make: Callable):
    """``make()``, kept for the next tasks of this Python worker; one object a worker, that of the last key."""
    kept = sys.modules.setdefault("_reelrec_kept", types.ModuleType("_reelrec_kept")).__dict__
    if kept.get("key") != key:
        kept.update(key=None, value=None)
        kept.update(value=make(), key=key)
    return kept["value"]


def trim() -> None:
    """Gives freed memory back to the system: a Python worker that waits for its next task would keep it."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc
    if release:
        release(0)


def trimmed(run: Callable) -> Callable:
    """A function of ``applyInArrow`` or ``mapInArrow`` that trims when a group or a task is done."""
    import inspect

    if inspect.isgeneratorfunction(run):
        def task(batches):
            try:
                yield from run(batches)
            finally:
                trim()
    else:
        def task(group):
            out = run(group)
            trim()
            return out
    return task


by_value(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, survives lost
    executors, and is read with column pruning by everything that uses it."""
    path = shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.written_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with ``_key``, a long for each (``doc_id``, ``text``) in the order of ``doc_id``; null for a null id.

    Where no id has two texts it is the id and the second result is None.  Otherwise the distinct
    (id, two hashes of the text) are numbered in sorted order, and that table is the second result."""
    d = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    hashes = {"_h1": F.xxhash64("text"), "_h2": F.xxhash64(F.lit(1), F.col("text"))}
    ids = d.where("doc_id is not null").select("doc_id", *[h.alias(n) for n, h in hashes.items()])
    if ids.groupBy("doc_id").agg(F.min("_h1").alias("a"), F.max("_h1").alias("b")).where("a < b").isEmpty():
        return d.withColumn("_key", F.col("doc_id")), None
    order = ["doc_id", "_h1", "_h2"]
    names = ids.distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    names = written(names.withColumn("_key", F.monotonically_increasing_id()), "keys")
    return d.withColumns(hashes).join(names, order, "left").drop("_h1", "_h2").select(*d.columns, "_key"), names


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
