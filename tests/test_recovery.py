"""Snapshots, the batch ledger and incremental ingest: steps that die half-way leave what was there."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrec import schemas
from reelrec.functions import parse
from reelrec.sinks import files, snapshots, tables
from reelrec.streaming import ingest, ledger


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_snapshot_pointer(spark, scratch):
    root = os.path.join(scratch, "t")
    assert snapshots.current(spark, root) is None
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, root)
    first = snapshots.publish(spark.createDataFrame([(1, "a"), (2, None)], "k int, v string"), root)
    pinned = snapshots.read(spark, root)
    second = snapshots.stage(snapshots.read(spark, root).withColumn("w", F.col("k") * 10), root)
    assert rows(snapshots.read(spark, root)) == [(1, "a"), (2, None)]                 # staged only
    with pytest.raises(snapshots.Moved):
        snapshots.commit(spark, root, second, expected="other")
    snapshots.commit(spark, root, second, expected=first)
    assert rows(snapshots.read(spark, root)) == [(1, "a", 10), (2, None, 20)]
    assert rows(pinned) == [(1, "a"), (2, None)] == rows(snapshots.read(spark, root, first))
    assert snapshots.manifest(spark, root, second)["rows"] == 2
    assert snapshots.history(spark, root) == [second, first]


def test_snapshots_without_a_manifest_cannot_be_committed_and_expire(spark, scratch):
    root = os.path.join(scratch, "t")
    keep = [snapshots.publish(spark.range(n), root) for n in (1, 2, 3)]
    spark.range(9).write.parquet(f"{root}/data/torn")                                 # died before its manifest
    with pytest.raises(Exception):
        snapshots.commit(spark, root, "torn")
    staged = snapshots.stage(spark.range(7), root)
    assert set(snapshots.expire(spark, root, keep=2)) == {"torn", staged, keep[0]}
    assert rows(snapshots.read(spark, root)) == [(0,), (1,), (2,)] and snapshots.read(spark, root, keep[1]).count() == 2
    assert [name for name, _ in files.children(spark, root) if name.endswith(".tmp")] == []


def test_failed_write_leaves_the_pointer(spark, scratch):
    root = os.path.join(scratch, "t")
    snapshots.publish(spark.createDataFrame([(1,)], "a int"), root)
    with pytest.raises(Exception):
        snapshots.publish(spark.createDataFrame([("x",)], "a string").selectExpr("cast(raise_error(a) as int) as a"), root)
    assert rows(snapshots.read(spark, root)) == [(1,)]


def test_table_publish_is_one_catalog_change(spark, monkeypatch):
    """The catalog change fails: the table has the old rows.  After three publishes two folders are left."""
    tables.drop_if_exists(spark, "t_swap")
    tables.publish(spark.createDataFrame([(1,)], "a int"), "t_swap")
    real = type(spark).sql

    def dies(self, query, *args, **kw):
        if "SET LOCATION" in query:
            raise KeyboardInterrupt
        return real(self, query, *args, **kw)
    monkeypatch.setattr(type(spark), "sql", dies)
    with pytest.raises(KeyboardInterrupt):
        tables.publish(spark.createDataFrame([(2,)], "a int"), "t_swap")
    monkeypatch.undo()
    assert rows(spark.table("t_swap")) == [(1,)]
    first = tables._location(spark, "t_swap")
    for n in (3, 4):
        tables.publish(spark.createDataFrame([(n,)], "a int"), "t_swap")
        assert rows(spark.table("t_swap")) == [(n,)]
    assert not files.exists(spark, first)
    tables.publish(spark.createDataFrame([("x", 1)], "b string, a int"), "t_swap")    # other columns
    assert rows(spark.table("t_swap")) == [("x", 1)]
    tables.append(spark.createDataFrame([(5, "y")], "a int, b string"), "t_swap")
    assert rows(spark.table("t_swap")) == [("x", 1), ("y", 5)]


def test_ledger_counts_committed_attempts_only(spark, scratch):
    root, schema = os.path.join(scratch, "l"), spark.range(0).schema
    assert ledger.read(spark, root, "rows", schema).count() == 0

    def dies(batch_id):
        raise RuntimeError("died")
    with pytest.raises(RuntimeError):
        ledger.write(spark, root, 0, {"rows": spark.range(5)}, dies)
    assert ledger.read(spark, root, "rows", schema).count() == 0 and not ledger.committed(spark, root, 0)
    assert ledger.write(spark, root, 0, {"rows": spark.range(3), "other": spark.range(1)})
    assert not ledger.write(spark, root, 0, {"rows": spark.range(3)})                 # replayed after its commit
    assert ledger.write(spark, root, 10, {"rows": spark.range(3, 5)})
    assert rows(ledger.read(spark, root, "rows", schema)) == [(0, 0), (0, 1), (0, 2), (10, 3), (10, 4)]
    assert rows(ledger.entries(spark, root).select("batch_id")) == [(0,), (10,)]


def test_ingest_of_a_growing_folder(spark, scratch):
    folder, root = os.path.join(scratch, "in"), os.path.join(scratch, "out")

    def put(name, lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(folder)
    put("a", ["1,2,3", "4,5,6", "bad,1,2", "7,8,"])
    first = ingest.ingest_new(spark, folder, root, schemas.LINKS, ",")
    assert rows(first.rows) == [(1, 2, 3), (4, 5, 6)] and rows(first.rejects) == [("bad,1,2", "bad int: movieId")]
    put("b", ["1,2,3"])
    put("c", ["9,9,9"])

    def dies(batch_id):
        raise RuntimeError("died")
    with pytest.raises(StreamingQueryException):
        ingest.ingest_new(spark, folder, root, schemas.LINKS, ",", max_files=1, before_commit=dies)
    assert rows(ingest.ingested(spark, root, schemas.LINKS).rows) == [(1, 2, 3), (4, 5, 6)]
    whole = ingest.ingest_new(spark, folder, root, schemas.LINKS, ",", max_files=1)
    assert rows(whole.rows) == [(1, 2, 3), (1, 2, 3), (4, 5, 6), (9, 9, 9)]          # an equal line of another file counts
    assert rows(ingest.ingest_new(spark, folder, root, schemas.LINKS, ",").rows) == rows(whole.rows)
    once = parse.parse_delimited(spark.read.text(folder), schemas.LINKS, ",")
    assert rows(once.rows) == rows(whole.rows) and rows(once.rejects) == rows(whole.rejects)
    per_file = whole.files.collect()
    assert len(per_file) == len({r["file"] for r in per_file}) == 3 and sum(r["lines"] for r in per_file) == 6


def test_a_batch_is_parsed_once(spark, scratch):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def number(line):
        calls.add(1)
        return int(line) if line.isdigit() else None

    def parsed(lines):
        staged = lines.select("value", number("value").alias("n")).withColumn("_reason", F.when(F.col("n").isNull(), F.lit("no number")))
        staged = staged.select(F.inline(F.array(F.struct("value", "n", "_reason"))))
        good = F.col("_reason").isNull()
        return parse.ParseResult(staged.where(good).select("n"), staged.where(~good).select("value", F.col("_reason").alias("reason")), staged)
    folder, schema = os.path.join(scratch, "in"), T.StructType([T.StructField("n", T.IntegerType())])
    spark.createDataFrame([("1",), ("x",), ("3",), ("y",)], "value string").write.text(folder)
    out = ingest.ingest_new(spark, folder, os.path.join(scratch, "out"), schema, ",", parse=parsed)
    assert sorted(r[0] for r in out.rows.collect()) == [1, 3] and sorted(tuple(r) for r in out.rejects.collect()) == [("x", "no number"), ("y", "no number")]
    assert sum(r["lines"] for r in out.files.collect()) == 4 == calls.value
