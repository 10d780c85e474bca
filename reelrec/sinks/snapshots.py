"""K1 K2: a table as a row of snapshots, one of which a pointer file names.

    <root>/data/<snapshot>/      Parquet files, written once and never changed
    <root>/manifests/<snapshot>  schema, rows, the snapshot before it
    <root>/CURRENT               the snapshot that readers take

A publish writes the rows, then the manifest, then swaps the pointer by renaming a file over it.  The driver may die
after any of these steps: readers see the old rows until the pointer is swapped and all new ones from then on, and a
folder that no pointer ever named is garbage that ``expire`` deletes.  A reader resolves the pointer once, so it
keeps its rows while newer snapshots are published.  Publishers of one table take turns (one job owns a table);
``expected`` makes a publish fail if another one came between.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrec.sinks import files


class Moved(RuntimeError):
    """The table's pointer is not what the publisher expected."""


def current(spark: SparkSession, root: str) -> str | None:
    """The snapshot that readers take now; None if nothing was published."""
    pointer = f"{root}/CURRENT"
    return files.read_text(spark, pointer).strip() if files.exists(spark, pointer) else None


def manifest(spark: SparkSession, root: str, snapshot: str) -> dict:
    return json.loads(files.read_text(spark, f"{root}/manifests/{snapshot}"))


def stage(df: DataFrame, root: str) -> str:
    """Writes the rows and the manifest of a new snapshot, which nobody reads yet."""
    spark, snapshot, rows = df.sparkSession, uuid.uuid4().hex, Observation()
    before = current(spark, root)
    df.observe(rows, F.count(F.lit(1)).alias("n")).write.parquet(f"{root}/data/{snapshot}")
    files.swap_text(spark, f"{root}/manifests/{snapshot}",
                    json.dumps({"schema": json.loads(df.schema.json()), "rows": rows.get["n"], "before": before}))
    return snapshot


def commit(spark: SparkSession, root: str, snapshot: str, expected: str | None = None) -> None:
    """Readers take ``snapshot`` from now on.  With ``expected`` only if that one is current."""
    manifest(spark, root, snapshot)                   # whole, or this raises
    if expected is not None and current(spark, root) != expected:
        raise Moved(f"{root} is at {current(spark, root)}, not at {expected}")
    files.swap_text(spark, f"{root}/CURRENT", snapshot)


def publish(df: DataFrame, root: str, expected: str | None = None) -> str:
    """Full replace of the rows; ``df`` may read the table itself."""
    snapshot = stage(df, root)
    commit(df.sparkSession, root, snapshot, expected)
    return snapshot


def read(spark: SparkSession, root: str, snapshot: str | None = None) -> DataFrame:
    """The current rows, or those of ``snapshot``; later publishes don't change what this frame reads."""
    snapshot = snapshot or current(spark, root)
    if snapshot is None:
        raise FileNotFoundError(f"nothing was published at {root}")
    schema = T.StructType.fromJson(manifest(spark, root, snapshot)["schema"])
    return spark.read.schema(schema).parquet(f"{root}/data/{snapshot}")


def history(spark: SparkSession, root: str) -> list[str]:
    """The current snapshot and those before it, newest first, as far as their manifests exist."""
    out, at = [], current(spark, root)
    while at and files.exists(spark, f"{root}/manifests/{at}"):
        out.append(at)
        at = manifest(spark, root, at)["before"]
    return out


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Deletes all but the last ``keep`` published snapshots, and what publishes that died left behind.  Not while
    another publish is at work."""
    kept = set(history(spark, root)[:max(1, keep)])
    gone = [name for name, _ in files.children(spark, f"{root}/data") if name not in kept]
    for name in gone:
        files.delete(spark, f"{root}/manifests/{name}")
        files.delete(spark, f"{root}/data/{name}")
    return gone
