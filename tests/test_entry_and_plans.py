"""Driver contract, plan shape (pruning, pushdown, no single-task limits, no row-wise
Python UDFs) and the composed batch jobs end to end."""

import os

from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from reelrec.plans.catalog import QUERIES
from reelrec.plans.oracle import ORACLE
from reelrec.plans import jobs
from reelrec.sources import fixtures as fx

from conftest import SF_SMALL



def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_and_registry(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["movieId", "title", "cnt"]
    assert df.count() == 5
    qs, sql = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sql) <= set(qs)
    # every query of the reference's operators has its SQL; those that return a trained model's output have a query of checks
    trained = {"als_train_summary", "als_predict_pairs", "als_grid", "recommend_one_user", "recommend_all_users", "recommend_late_users"}
    assert set(QUERIES) - set(ORACLE) == trained
    assert {f"{q}_checks" for q in trained - {"recommend_late_users"}} | {"fold_in_users"} <= set(ORACLE)


def test_scan_pruning_and_no_python_udf(spark):
    df = fx.ratings(spark, SF_SMALL)
    p = plan(df.groupBy("movieId").count())
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in p
    assert "ReadSchema: struct<o_orderkey:bigint>" in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_filter_pushdown_to_parquet(spark):
    users, items = fx.factors(spark, SF_SMALL)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,49.0)]" in plan(
        fx.t(spark, SF_SMALL, "lineitem").where("l_quantity > 49"))
    assert users.count() == fx.t(spark, SF_SMALL, "embeddings").where("vec_id % 10 = 0").count()     # grows with the table
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in plan(items)


def test_popular_uses_top_k_not_global_sort(spark):
    p = plan(entry_mod.queries()["popular_top_k"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p and "BroadcastHashJoin" in p


def _write_lines(df, path):
    df.coalesce(2).write.mode("overwrite").text(path)


def test_jobs_end_to_end(spark, scratch):
    paths = {
        "links": os.path.join(scratch, "links.txt"),
        "tags": os.path.join(scratch, "tags.txt"),
        "movies.dat": os.path.join(scratch, "movies.dat"),
        "users.dat": os.path.join(scratch, "users.dat"),
        "ratings.dat": os.path.join(scratch, "ratings.dat"),
    }
    _write_lines(fx.links_lines(spark, SF_SMALL), paths["links"])
    _write_lines(fx.tag_lines(spark, SF_SMALL), paths["tags"])
    _write_lines(fx.movie_lines(spark, SF_SMALL), paths["movies.dat"])
    _write_lines(fx.user_lines(spark, SF_SMALL), paths["users.dat"])
    _write_lines(fx.rating_lines(spark, SF_SMALL).unionByName(
        spark.createDataFrame([("userid::movieid::rating::timestamp",)], "value string")), paths["ratings.dat"])
    out = jobs.ingest(spark, paths, table_prefix="new_", quarantine_table="new_quarantine")
    assert out["ratings.dat"] == "new_ratings"
    n = spark.table("new_ratings").count()
    assert n == fx.ratings(spark, SF_SMALL).count()
    assert [tuple(r) for r in spark.table("new_quarantine").select("kind", "reason").collect()] == [
        ("ratings.dat", "bad int: userId")]
    tr, te = jobs.split_tables(spark, "new_ratings", "new_trainingdata", "new_testdata")
    assert (tr, te) == (int(n * 0.6), int(n * (1 - 0.6)))
    jobs.popular_table(spark, "new_trainingdata", "new_movies", "top5df")
    assert spark.table("top5df").count() == 5
    res = jobs.train(spark, "new_trainingdata", "new_testdata", os.path.join(scratch, "models"), "model_runs",
                     ranks=(3,), iterations=(3,), lambdas=(0.07,))
    assert res.best["run_id"] == 1 and res.best["n"] > 0
    jobs.serve_all(spark, res.best["model_path"], "recs_all")
    assert spark.table("recs_all").groupBy("userId").count().where("count <> 5").count() == 0
    one = jobs.serve_one(spark, res.best["model_path"], "new_trainingdata", "new_movies", 3)
    assert one.count() == 5 and one.where(F.col("title").isNull()).count() == 0


def test_cli_split_and_popular(spark):
    from reelrec.plans import cli
    from reelrec.sinks import tables
    tables.publish(fx.ratings(spark, SF_SMALL), "cli_ratings")
    tables.publish(fx.movies(spark, SF_SMALL), "cli_movies")
    cli.main(["split", "--ratings", "cli_ratings", "--train", "cli_train", "--test", "cli_test"])
    n = spark.table("cli_ratings").count()
    assert spark.table("cli_train").count() == int(n * 0.6)
    cli.main(["popular", "--train", "cli_train", "--movies", "cli_movies", "--out", "cli_top5"])
    assert spark.table("cli_top5").count() == 5
    args = cli.parser().parse_args(["ingest", "--ratings.dat", "/x", "--prefix", "new_"])
    assert args.ratings_dat == "/x" and args.prefix == "new_"


def test_no_registered_query_plans_a_non_scaling_node(spark):
    bad = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "CollectLimit")
    for name, fn in QUERIES.items():
        p = plan(fn(spark, SF_SMALL))
        found = [b for b in bad if b in p]
        assert not found, (name, found)


def test_cli_serving_and_stream_arguments():
    from reelrec.plans import cli
    a = cli.parser().parse_args(["stream", "--files", "/in", "--recs", "recs", "--popular", "top5df",
                                 "--out", "/out", "--checkpoint", "/ck"])
    assert (a.files, a.kafka, a.trigger, a.topics) == ("/in", None, "15 seconds", "real-time")
    b = cli.parser().parse_args(["serve-all", "--model", "/m/run=1", "--out", "recs", "--jdbc-url", "jdbc:x",
                                 "--jdbc-properties", '{"user": "u"}', "--jdbc-connections", "4"])
    assert cli._jdbc(b) == {"url": "jdbc:x", "table": "recommendations",
                            "properties": {"user": "u"}, "max_connections": 4}
    c = cli.parser().parse_args(["serve-one", "--model", "m", "--train", "t", "--movies", "m", "--index", "2", "--out", "one"])
    assert (c.out, c.index, cli._jdbc(c)) == ("one", 2, None)
    t = cli.parser().parse_args(["train", "--train", "a", "--test", "b", "--model-root", "/m", "--metrics", "r",
                                 "--lambdas", "0.05,0.07", "--iterations", "10,20"])
    assert t.lambdas == (0.05, 0.07) and t.iterations == (10, 20) and t.ranks == (10,)


def test_jobs_that_store_and_replay(spark, scratch):
    from reelrec.sinks import jdbc
    from reelrec.sinks import tables as sink
    sink.publish(fx.ratings(spark, SF_SMALL), "j_ratings")
    sink.publish(fx.duplicated_movies(spark, SF_SMALL), "j_movies")
    sink.publish(spark.table("j_ratings").select("userId", "movieId", "rating"), "j_train")
    from reelrec.operators import als
    model = als.save(als.fit(spark.table("j_train"), rank=2, iterations=1), os.path.join(scratch, "m"))
    derby = {"url": "jdbc:derby:memory:reelrec_jobs;create=true", "properties": {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}}
    one = jobs.serve_one(spark, model, "j_train", "j_movies", 2, out_table="j_one", jdbc=derby | {"table": "one_user"})
    assert one.count() == 5 == jdbc.jdbc_read(spark, derby["url"], "one_user", derby["properties"]).count()
    jobs.movies_to_jdbc(spark, "j_movies", derby | {"table": "movies"})
    assert jdbc.jdbc_read(spark, derby["url"], "movies", derby["properties"]).count() == fx.movies(spark, SF_SMALL).count()
    jobs.replay(spark, "j_ratings", "t", path=os.path.join(scratch, "messages"))
    assert spark.read.parquet(os.path.join(scratch, "messages")).count() == spark.table("j_ratings").count()
    jobs.banded_tables(spark, "j_ratings", "j_band1", "j_band2")
    n = spark.table("j_ratings").groupBy("rating").count().selectExpr("sum(count div 3)").first()[0]
    assert spark.table("j_band1").count() == spark.table("j_band2").count() == n


def test_ingest_reports_duplicates_and_reads_once(spark, scratch):
    path = os.path.join(scratch, "movies.txt")
    spark.createDataFrame([("1,A,x",), ("1,B,y",), ("2,C,z",), ("q,D,z",)], "value string").coalesce(1).write.text(path)
    jobs.ingest(spark, {"movies": path}, table_prefix="dup_", quarantine_table="dup_bad", duplicates_table="dup_report")
    assert spark.table("dup_movies").count() == 3 and spark.table("dup_bad").count() == 1
    assert [tuple(r) for r in spark.table("dup_report").collect()] == [(1, 2)]


def test_ingest_quoted_option(spark, scratch):
    path = os.path.join(scratch, "movies.txt")
    lines = ['11,"American President, The (1995)",Comedy|Drama', "12,Plain Title (1996),Drama", "13,bad,"]
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(path)
    jobs.ingest(spark, {"movies": path}, table_prefix="q_", quoted=True)
    got = sorted(tuple(r) for r in spark.table("q_movies").collect())
    assert got == [(11, "American President, The (1995)", "Comedy|Drama"), (12, "Plain Title (1996)", "Drama")]
    jobs.ingest(spark, {"movies": path}, table_prefix="n_")           # naive split, as the reference
    assert spark.table("n_movies").where("movieId = 11").first()["title"] == '"American President'
