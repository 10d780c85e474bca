"""Small files beside the data (pointers, manifests, ledger entries) through the session's Hadoop file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def swap_text(spark: SparkSession, path: str, text: str) -> None:
    """``path`` holds ``text`` whole or stays as it was: written beside it, then renamed over it."""
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    out = _fs(spark, beside).create(_path(spark, beside), False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    overwrite = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = overwrite
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _fs(spark, path).makeQualified(_path(spark, path)).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(_path(spark, beside), _path(spark, path), options)


def children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """``(name, modification time)`` of what lies in a folder, by name; nothing if there is none."""
    if not exists(spark, path):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in _fs(spark, path).listStatus(_path(spark, path)))


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def set_time(spark: SparkSession, path: str, millis: int) -> None:
    _fs(spark, path).setTimes(_path(spark, path), millis, -1)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Renames a file; the folder it goes to is made if it is not there."""
    fs = _fs(spark, path)
    fs.mkdirs(_path(spark, to).getParent())
    if not fs.rename(_path(spark, path), _path(spark, to)):
        raise OSError(f"{path} was not renamed to {to}")
