"""Shared intermediates leave their rows, and no shuffle files of the job that wrote them."""

from pyspark.sql import functions as F

from forgerank.llm import op5_ngram_join
from forgerank.session import CLEANUP, shared


def test_shuffle_files_go_with_the_job(spark):
    status = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    spark._jvm.java.lang.System.gc()
    before, set_before = status.shuffleStatuses().size(), spark.conf.get(CLEANUP)
    df = spark.range(5000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")).join(
        spark.range(7).withColumnRenamed("id", "k"), "k", "full")
    out = shared(df, "counts")
    assert status.shuffleStatuses().size() <= before
    assert spark.conf.get(CLEANUP) == set_before
    assert out.agg(F.sum("n")).first()[0] == df.agg(F.sum("n")).first()[0] == 5000


def test_sets_are_filtered_and_cut_by_one_worker(spark):
    docs = spark.createDataFrame([(k, f"a b c d e f {k}") for k in range(20)] + [(None, "x")], "doc_id long, text string")
    sets = op5_ngram_join._sets_of(docs, spark.createDataFrame([(3,), (5,), (None,)], "id long"))
    assert sets._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    got = {x.doc_id: x.n for x in sets.collect()}
    assert got[3] == got[5] == 3 and len(got) < 20
