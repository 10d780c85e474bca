"""Tables: publish twice = same table, CTAS refuses an existing table, append, create
if missing; JDBC append round-trip through embedded in-memory Derby (in-process)."""

import pytest
from pyspark.sql.utils import AnalysisException

from reelrec import schemas
from reelrec.sinks import jdbc, tables


def test_publish_is_rerunnable(spark):
    df = spark.createDataFrame([(1, 2, 3.0), (4, 5, 1.5)], schemas.RATING_TRIPLE)
    tables.publish(df, "t_publish")
    tables.publish(df, "t_publish")
    assert sorted(tuple(r) for r in spark.table("t_publish").collect()) == [(1, 2, 3.0), (4, 5, 1.5)]
    # publish a plan that reads the table it replaces
    tables.publish(spark.table("t_publish").where("userId = 1"), "t_publish")
    assert [tuple(r) for r in spark.table("t_publish").collect()] == [(1, 2, 3.0)]


def test_ctas_append_create_if_missing(spark):
    df = spark.createDataFrame([(1, 2, 3.0)], schemas.RATING_TRIPLE)
    tables.drop_if_exists(spark, "t_ctas")
    tables.create_as(df, "t_ctas")
    with pytest.raises(AnalysisException):
        tables.create_as(df, "t_ctas")
    tables.append(df, "t_ctas")
    assert spark.table("t_ctas").count() == 2
    tables.create_if_missing(spark, "t_top", schemas.MOVIES)
    tables.create_if_missing(spark, "t_top", schemas.MOVIES)
    assert spark.table("t_top").columns == ["movieId", "title", "genres"]
    tables.name_view(df, "v_rec")
    tables.name_view(df, "v_rec")
    assert spark.sql("select count(*) from v_rec").first()[0] == 1


def test_jdbc_append_derby_in_memory(spark):
    url = "jdbc:derby:memory:reelrec;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([(1, 2, 3.0), (4, 5, 1.5)], schemas.RECOMMENDATION)
    jdbc.jdbc_append(df, url, "user_movies_recommendation", props, max_connections=1)
    jdbc.jdbc_append(df, url, "user_movies_recommendation", props, max_connections=1)
    back = jdbc.jdbc_read(spark, url, "user_movies_recommendation", props)
    assert back.count() == 4


def test_checkpoint_folder_is_the_configured_one_or_below_the_warehouse(spark):
    from reelrec.session import ensure_checkpoint_dir
    folder = ensure_checkpoint_dir(spark)
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    assert configured.removeprefix("file:").rstrip("/") in folder


def test_append_matches_by_name(spark):
    tables.drop_if_exists(spark, "t_named")
    tables.create_as(spark.createDataFrame([(1, 2)], "a int, b int"), "t_named")
    tables.append(spark.createDataFrame([(4, 3)], "b int, a int"), "t_named")
    assert sorted(tuple(r) for r in spark.table("t_named").collect()) == [(1, 2), (3, 4)]
    with pytest.raises(ValueError):
        tables.append(spark.createDataFrame([(4, 3)], "b int, c int"), "t_named")


def test_failed_publish_keeps_the_old_table(spark):
    tables.publish(spark.createDataFrame([(1,)], "a int"), "t_kept")
    with pytest.raises(Exception):
        tables.publish(spark.createDataFrame([("x",)], "a string").selectExpr("cast(raise_error(a) as int) as a"), "t_kept")
    assert [tuple(r) for r in spark.table("t_kept").collect()] == [(1,)]
