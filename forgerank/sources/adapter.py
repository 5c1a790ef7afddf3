"""Driver tables -> domain tables (users, repos, pull requests, attempts).

The mapping is fixed so that it can be repeated word for word in DuckDB
(``forgerank.plans.adapter_sql``). Every table is derived by Spark from the driver
parquet files, so the work grows with them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import cust_login
from .tables import read_table

AS_OF = dt.datetime(2024, 2, 15, 0, 0, 0)


def ts(text: str):
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def as_of_col(as_of: dt.datetime = AS_OF):
    return ts(as_of.strftime("%Y-%m-%d %H:%M:%S"))


def _plus_days(base: str, days):
    return F.timestamp_add("DAY", days, ts(base))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``github_users`` rows, one per customer."""
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("c_custkey")
    ks = k.cast("string")
    j = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
          .join(r, F.col("n_regionkey") == r.r_regionkey, "left"))
    return j.select(
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("https://avatars.githubusercontent.com/u/"), ks).alias("avatar_url"),
        F.when(k % 4 == 0, F.concat(F.lit("see LinkedIn.com/in/dev-"), ks))
         .when(k % 4 == 1, F.concat(F.lit("lnkd.in/x_"), ks))
         .when(k % 4 == 2, F.lit("no link")).alias("bio"),
        F.floor(F.abs(F.col("c_acctbal")) * 2).cast("int").alias("followers"),
        F.col("c_nationkey").cast("int").alias("following"),
        F.lit(0).alias("public_repos"),
        F.when(k % 5 == 0, F.concat(F.lit("https://linkedin.com/in/web-"), ks)).alias("blog"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("n_name"), F.lit(", "), F.col("r_name"))).alias("location"),
        F.when(k % 6 == 0, F.concat(F.lit("dev"), ks, F.lit("@example.com"))).alias("email"),
        F.lit(None).cast("string").alias("twitter_username"),
        F.col("c_mktsegment").alias("company"),
        F.when(k % 3 == 0, F.lit(True)).when(k % 3 == 1, F.lit(False)).alias("hireable"),
        _plus_days("2010-01-01 00:00:00", k % 4000).alias("created_at"),
        _plus_days("2024-01-01 00:00:00", k % 46).alias("scraped_at"),
        k.alias("user_key"),
        social_accounts(k).alias("social_accounts"),
    )


def social_accounts(k):
    """Accounts shown on the profile page: two of seven users have one or more."""
    acct = lambda p, u: F.struct(F.lit(p).alias("provider"), u.alias("url"))
    tw = acct("TWITTER", F.concat(F.lit("https://twitter.com/u"), k.cast("string")))
    li = acct("LINKEDIN", F.concat(F.lit("https://www.linkedin.com/in/acct-"), k.cast("string")))
    return (F.when(k % 7 == 3, F.array(tw, li)).when(k % 7 == 4, F.array(tw))
             .otherwise(F.array().cast("array<struct<provider:string,url:string>>")))


def _topics_by_brand(brand_no):
    b = brand_no % 8
    arr = lambda *xs: F.array(*[F.lit(x) for x in xs])
    return (F.when(b == 0, F.array().cast("array<string>"))
             .when(b == 1, arr("machine-learning", "python"))
             .when(b == 2, arr("api", "docker"))
             .when(b == 3, arr("react", "ui"))
             .when(b == 4, arr("kubernetes", "aws"))
             .when(b == 5, arr("data-science", "pandas"))
             .when(b == 6, arr("Email", "django")))


def _language_by_type(t):
    return (F.when(t == "ECONOMY", "Python").when(t == "LARGE", "TypeScript")
             .when(t == "MEDIUM", "Go").when(t == "PROMO", "Shell").when(t == "SMALL", "R"))


def returned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (read_table(spark, sf_dir, "lineitem")
            .where(F.col("l_returnflag") == "R")
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    "l_extendedprice", "l_shipdate"))


def repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``github_repos`` rows keyed by a unique repo name (short name kept for K2)."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    # Partial aggregation before the shuffle: one row per part leaves each map task.
    totals = (returned_lines(spark, sf_dir).groupBy("l_partkey")
              .agg(F.count(F.lit(1)).alias("n_returned")))
    k = F.col("p_partkey")
    short = F.regexp_replace(F.col("p_name"), " ", "-")
    lang = _language_by_type(F.col("p_type"))
    j = p.join(totals, p.p_partkey == totals.l_partkey, "left")
    return j.select(
        F.concat(short, F.lit("-"), k.cast("string")).alias("repo_name"),
        short.alias("short_name"),
        cust_login(F.floor(k / 10)).alias("owner_login"),
        F.lit(None).cast("string").alias("description"),
        lang.alias("primary_language"),
        F.when(k % 50 == 0, F.col("p_size") * F.col("p_size") * F.col("p_size") * 10)
         .otherwise(F.col("p_size")).cast("int").alias("stars"),
        F.lit(0).alias("forks"),
        F.lit(0).alias("watchers"),
        F.when(k % 97 == 0, F.lit(0)).otherwise(F.coalesce(F.col("n_returned"), F.lit(0)))
         .cast("int").alias("total_prs"),
        (k % 7 == 0).alias("is_fork"),
        F.lit(False).alias("is_archived"),
        _topics_by_brand(F.substring(F.col("p_brand"), 7, 10).cast("int")).alias("topics"),
        F.concat(F.when(lang.isNull(), F.array().cast("array<string>")).otherwise(F.array(lang)),
                 F.when(F.col("p_size") % 4 == 0, F.array(F.lit("Shell")))
                  .otherwise(F.array().cast("array<string>"))).alias("languages"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        _plus_days("2023-01-01 00:00:00", k % 365).alias("pushed_at"),
        _plus_days("2024-02-01 00:00:00", k % 10).alias("scraped_at"),
        k.alias("repo_key"),
    )


def raw_pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed merged-PR rows (before the keyed upsert), with their landing order."""
    li = returned_lines(spark, sf_dir)
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    short = F.regexp_replace(F.col("p_name"), " ", "-")
    j = (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
           .join(p, li.l_partkey == p.p_partkey, "inner"))
    return j.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("id"),
        cust_login(F.col("o_custkey")).alias("username"),
        F.concat(cust_login(F.floor(F.col("l_partkey") / 10)), F.lit("/"), short, F.lit("-"),
                 F.col("p_partkey").cast("string")).alias("repo_name"),
        F.col("l_shipdate").alias("merged_at"),
        F.col("o_orderdate").alias("created_at"),
        F.struct(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"),
                 F.col("l_extendedprice").alias("c")).alias("seq"),
    )


def pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``github_pull_requests``: landed rows after the K3 upsert (first insert wins,
    ``merged_at`` from the last)."""
    from ..operators.upsert import upsert_pull_requests
    return upsert_pull_requests(None, raw_pull_requests(spark, sf_dir))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment attempts landed by an outside caller, one per row of ``events``, in
    landing order ``seq``; status/body by event type. Which of a user's attempts count
    is the operator's decision (O2)."""
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    kk = F.get_json_object(F.col("props"), "$.k").cast("int")
    et = F.col("event_type")
    return e.select(
        cust_login(F.col("user_id")).alias("username"),
        F.col("event_id").alias("seq"),
        F.when(et == "error", F.when(kk < 30, 500).when(kk < 50, 429).otherwise(404))
         .otherwise(200).cast("int").alias("status"),
        F.when(et == "click", F.lit('[{"data":{"open_to_work":true}}]'))
         .when(et == "view", F.lit('[{"open_to_work":false}]'))
         .when(et == "signup", F.lit('[{"messages":"timed out"}]'))
         .when(et == "purchase", F.lit('{"x":1}')).alias("body"),
        F.lit(None).cast("string").alias("error_text"),
    )


def enrichment_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prior enrichment columns of the leaderboard, per user."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k = F.col("c_custkey")
    return c.select(
        F.col("c_name").alias("username"),
        F.when(k % 7 == 0, F.lit(True)).when(k % 7 == 1, F.lit(False)).alias("is_open_to_work"),
        F.when(k % 13 == 0, F.lit(True)).when(k % 13 == 1, F.lit(False))
         .alias("otw_permanent_failure"),
        F.when(k % 13 == 0, F.lit("INVALID_RESPONSE")).alias("otw_error_code"),
        F.when(k % 7 <= 1, _plus_days("2024-01-10 00:00:00", k % 20)).alias("otw_scraped_at"),
    )
