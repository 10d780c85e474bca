"""Parquet writes and catalog tables (no Hive needed: ``USING parquet``).

The reference staged Parquet, dropped the table, re-created it and ran ``load data``;
here a publish writes a new folder and then points the table there in one catalog change, so a failed write
or a dead driver leaves the old rows, and a plan may read the table it replaces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reelrec.sinks import files

BEFORE = "reelrec.before"    # table property: the folder of the rows before


def write_parquet(df: DataFrame, path: str) -> None:
    """K1: overwrite a Parquet path (re-runnable)."""
    df.write.mode("overwrite").parquet(path)


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def publish(df: DataFrame, table: str) -> None:
    """K2 + K9: full replace of ``table`` with ``df``, which may read the table.

    The rows go to a new folder; then one catalog change points the table there, so a driver that dies leaves
    the old rows or the new ones.  The folder before is kept for readers that have resolved it, the one before that is
    deleted.  Only a change of columns takes two catalog steps (drop, create).
    """
    spark = df.sparkSession
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}__{uuid.uuid4().hex}"
    df.write.parquet(folder)
    same = spark.catalog.tableExists(table) and [(f.name, f.dataType) for f in spark.table(table).schema] == [
        (f.name, f.dataType) for f in df.schema]
    if same:
        before = _location(spark, table)
        older = spark.sql(f"SHOW TBLPROPERTIES {table} ('{BEFORE}')").first()["value"]
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{BEFORE}' = '{before}')")
        spark.catalog.refreshTable(table)
        if "__" in older.rsplit("/", 1)[-1]:
            files.delete(spark, older)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path=folder, source="parquet", schema=df.schema)


def create_as(df: DataFrame, table: str) -> None:
    """K3: create-table-as-select; fails if the table exists."""
    df.writeTo(table).using("parquet").create()


def append(df: DataFrame, table: str) -> None:
    """K4: insert-select, columns matched by name; a missing or extra one raises."""
    names = df.sparkSession.table(table).columns
    if sorted(names) != sorted(df.columns):
        raise ValueError(f"{table} has {names}, the rows have {df.columns}")
    df.select(*names).write.insertInto(table)


def create_if_missing(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """K8."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet")


def drop_if_exists(spark: SparkSession, table: str) -> None:
    """K9."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def name_view(df: DataFrame, name: str) -> DataFrame:
    """Name a plan for SQL users; replacing is allowed (re-runnable)."""
    df.createOrReplaceTempView(name)
    return df
