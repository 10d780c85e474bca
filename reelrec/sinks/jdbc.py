"""K5: JDBC append of recommendation rows.

Connections = partitions of the written frame, capped by ``max_connections`` (a coalesce, no
shuffle).  A stream batch carries ``batch_id`` and is written from the per-batch Parquet output; its
earlier rows are deleted first, so a replayed batch leaves one copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


MAX_CONNECTIONS = 16


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, *,
                batch_size: int = 10_000, max_connections: int | None = MAX_CONNECTIONS) -> None:
    if max_connections:
        df = df.coalesce(max_connections)
    (df.write.mode("append").option("batchsize", str(batch_size))
     .jdbc(url, table, properties=dict(properties or {})))


def jdbc_read(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None) -> DataFrame:
    return spark.read.jdbc(url, table, properties=dict(properties or {}))


def delete_batch(spark: SparkSession, url: str, table: str, batch_id: int, properties: dict[str, str] | None = None) -> None:
    """Delete the rows of a stream batch, if the table is there: one statement from the driver."""
    jvm = spark._jvm
    info = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        info.setProperty(k, str(v))
    if properties and properties.get("driver"):
        jvm.java.lang.Class.forName(properties["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(url, info)
    try:
        tables = connection.getMetaData().getTables(None, None, "%", None)
        names = set()
        while tables.next():
            names.add(tables.getString("TABLE_NAME").lower())
        if table.split(".")[-1].strip('"`').lower() in names:
            quote = connection.getMetaData().getIdentifierQuoteString().strip()      # as Spark's writer names columns
            statement = connection.prepareStatement(f"DELETE FROM {table} WHERE {quote}batch_id{quote} = ?")
            statement.setLong(1, int(batch_id))
            statement.executeUpdate()
            if not connection.getAutoCommit():
                connection.commit()
    finally:
        connection.close()
