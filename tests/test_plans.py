"""Plan checks and properties: no Cartesian product, no nested-loop join, no
Python UDF in any registered query; the distributed rank moves no data row to a
single partition; pre-aggregating PRs before the repo join changes nothing."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL
from forgerank.operators import scoring as S
from forgerank.plans.registry import Tables

QUERIES = {k: f for k, f in E.queries().items() if k != "pipeline" and not re.match(r"op\d+_", k)}
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_forbidden_operators(spark, key):
    plan = physical(QUERIES[key](spark, SMALL))
    for op in FORBIDDEN:
        assert op not in plan, f"{key}: {op}"


@pytest.mark.parametrize("key", ["enrich_candidates_global", "enrich_candidates_region"])
def test_rank_has_no_single_partition_data_window(spark, key):
    df = QUERIES[key](spark, SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # The only un-partitioned window is over the per-partition row counts.
    assert plan.count("Window [sum(") <= 1
    assert "row_number()" not in plan


def test_preaggregation_equals_join_then_count(spark):
    t = Tables(spark, SMALL)
    pre = S.user_repo_stats(t.prs, t.repos)
    r = t.repos.select(S.full_name().alias("repo_name"), "total_prs", "stars")
    post = (t.prs.join(r, "repo_name", "inner")
            .groupBy("username", "repo_name", "total_prs", "stars")
            .agg(F.count("id").cast("int").alias("user_prs")))
    cols = ["username", "repo_name", "user_prs", "total_prs", "stars"]
    assert sorted(map(tuple, pre.select(*cols).collect())) == sorted(map(tuple, post.select(*cols).collect()))


def test_split_credit_sums_to_total(spark):
    df = QUERIES["analyze_users"](spark, SMALL)
    bad = df.where(F.abs(F.col("total_score") - (F.col("ai_score") + F.col("backend_score") + F.col("frontend_score")
                                                  + F.col("devops_score") + F.col("data_score"))) > 1e-3)
    assert bad.count() == 0
