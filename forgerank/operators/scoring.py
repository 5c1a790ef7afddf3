"""Stage 2/3 scoring (live path) and the model-A scorer.

Shuffle plan at scale: PRs are pre-aggregated to (user, repo) with a partial
HashAggregate *before* they meet the repo attributes, so a famous repo with a
huge PR count leaves each map task as one row per contributor. The join to
repos is on a unique key; AQE picks broadcast from runtime sizes and splits a
skewed partition otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions.columns import experience_level, repo_score


def full_name(owner: str = "owner_login", name: str = "repo_name") -> Column:
    return F.concat(F.col(owner), F.lit("/"), F.col(name))


# J1 + A1 --------------------------------------------------------------------------
def user_repo_stats(prs: DataFrame, repos: DataFrame) -> DataFrame:
    """PRs per (user, repo) joined to the repo on ``owner/name``: one scan and one
    aggregation of the PRs. A famous repo's contributors make a skewed partition of
    the join, which AQE splits (the repo side is unique by key)."""
    counts = (prs.where(F.col("username").isNotNull())
                 .groupBy("username", "repo_name")
                 .agg(F.count("id").cast("int").alias("user_prs")))
    r = repos.select(full_name().alias("repo_name"), "total_prs", "stars")
    return counts.join(r, "repo_name").select(
        "username", "repo_name", "user_prs", "total_prs", "stars")


# A2 + F4 --------------------------------------------------------------------------
def user_repo_scores(stats: DataFrame, min_stars: int | None = None) -> DataFrame:
    scored = stats.withColumn(
        "repo_score", repo_score("user_prs", "total_prs", "stars", min_stars=min_stars))
    return scored.where(F.col("repo_score") > 0)


# A3 -------------------------------------------------------------------------------
def user_scores(repo_scores: DataFrame) -> DataFrame:
    """Sum of stored repo scores; a user with no rows gets no row."""
    return repo_scores.groupBy("username").agg(
        F.sum("repo_score").alias("total_score"),
        F.count(F.lit(1)).alias("n_repos"),
        F.sum("user_prs").cast("long").alias("contribution_count"))


# Q1 -------------------------------------------------------------------------------
def leaderboard(prs: DataFrame, repos: DataFrame, profiles: DataFrame) -> DataFrame:
    """Stage 2 -> 3 -> leaderboard sync."""
    totals = user_scores(user_repo_scores(user_repo_stats(prs, repos)))
    p = profiles.select("username", "name", "avatar_url")
    return totals.join(p, "username", "inner").select(
        "username", "name", "avatar_url", "total_score", "n_repos", "contribution_count")


# T1 -------------------------------------------------------------------------------
def top_members(board: DataFrame, n: int = 10) -> DataFrame:
    """F5 + order by total_score desc (username breaks ties) + limit: TakeOrderedAndProject."""
    cols = [c for c in ["username", "name", "avatar_url", "total_score", "bio", "location"]
            if c in board.columns]
    return (board.where(F.col("total_score") > 0)
                 .orderBy(F.desc("total_score"), F.asc("username")).limit(n).select(*cols))


# F6 -------------------------------------------------------------------------------
def member_profile(board: DataFrame, requests: DataFrame) -> DataFrame:
    """Point lookups in batch: one row per requested username that exists."""
    cols = [c for c in ["username", "name", "avatar_url", "total_score", "bio", "location"]
            if c in board.columns]
    return board.select(*cols).join(requests.select("username").distinct(), "username", "inner")


# Model A -------------------------------------------------------------------------
def categorize_exact(repos: DataFrame, categories=D.CATEGORIES_EXACT,
                     hints=D.LANGUAGE_HINTS) -> DataFrame:
    """J6 + J8: exact lower(topic) membership per category, language hint only when
    no topic matched. Adds ``categories`` (array in category order). The
    dictionaries are literal arrays: no join, no shuffle."""
    lowered = F.transform(F.coalesce(F.col("topics"), F.array().cast("array<string>")),
                          lambda t: F.lower(t))
    hits = [F.when(F.arrays_overlap(lowered, F.array(*[F.lit(k) for k in kws])), F.lit(cat))
            for cat, kws in categories.items()]
    by_topic = F.filter(F.array(*hits), lambda x: x.isNotNull())
    hint_map = F.create_map(*[x for kv in hints.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    hint = F.when(F.col("primary_language").isNotNull() & (F.col("primary_language") != ""),
                  F.element_at(hint_map, F.col("primary_language")))
    cats = F.when(F.size(by_topic) > 0, by_topic).otherwise(
        F.when(hint.isNotNull(), F.array(hint)).otherwise(F.array().cast("array<string>")))
    return repos.withColumn("categories", cats)


def score_users(user_repos: DataFrame, top_n: int = D.TOP_REPOS_MODEL_A,
                top_skills: int = D.TOP_SKILLS, categories=D.CATEGORIES_EXACT) -> DataFrame:
    """Q3, model A over per-user repos (columns: username, owner_login, name,
    full_name, stars, primary_language, languages, topics, user_prs, total_prs).

    Sums come from one grouped aggregate (skew safe, partial), the top-10 list from
    a WindowGroupLimit-pruned window, skills from a (user, skill) aggregate.
    """
    from ..session import shared
    user_repos = shared(user_repos, "user_repos")
    r = user_repos.withColumn(
        "score", repo_score("user_prs", "total_prs", "stars", min_stars=D.MIN_STARS))
    scored = categorize_exact(r.where(F.col("score") > 0), categories)
    sums = scored.groupBy("username").agg(
        F.sum("score").alias("total_score"),
        *[F.sum(F.when(F.array_contains("categories", c), F.col("score")).otherwise(0.0))
          .alias(f"{c.lower()}_score") for c in categories])
    w = W.partitionBy("username").orderBy(F.desc("score"), F.asc("full_name"))
    top = (scored.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= top_n))
    top_agg = top.groupBy("username").agg(
        F.array_sort(F.collect_list(F.struct("pos", "full_name", "score", "primary_language")))
         .alias("top"))
    langs = (top.where(F.col("primary_language").isNotNull() & (F.col("primary_language") != ""))
                .groupBy("username", "primary_language").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("username").agg(F.array_sort(F.collect_list(
                    F.struct(F.col("primary_language").alias("k"), F.col("n").alias("v"))))
                    .alias("langs")))
    skills = top_skills_by_frequency(user_repos, top_skills)
    users = user_repos.select("username").distinct()
    out = (users.join(sums, "username", "left").join(top_agg, "username", "left")
                .join(langs, "username", "left").join(skills, "username", "left"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return out.select(
        "username",
        zero("total_score").alias("total_score"),
        *[zero(f"{c.lower()}_score").alias(f"{c.lower()}_score") for c in categories],
        experience_level(zero("total_score")).alias("experience_level"),
        F.coalesce(F.array_join(F.transform("top", lambda x: x["full_name"]), ","), F.lit(""))
         .alias("top_repos"),
        F.coalesce(F.array_join(F.transform("langs", lambda x: F.concat(x["k"], F.lit(":"),
                                x["v"].cast("string"))), ","), F.lit("")).alias("languages"),
        F.coalesce(F.col("skills"), F.lit("")).alias("unique_skills"),
    )


def top_skills_by_frequency(user_repos: DataFrame, n: int = D.TOP_SKILLS) -> DataFrame:
    """Per repo with user PRs > 0 the distinct lower-cased {language, languages,
    topics}; repos counted per skill; the n most frequent (ties by skill name)."""
    arr0 = F.array().cast("array<string>")
    terms = F.array_distinct(F.transform(F.concat(
        F.when(F.col("primary_language").isNotNull() & (F.col("primary_language") != ""),
               F.array("primary_language")).otherwise(arr0),
        F.coalesce("languages", arr0), F.coalesce("topics", arr0)), lambda x: F.lower(x)))
    per = (user_repos.where(F.col("user_prs") > 0)
                     .select("username", F.explode(terms).alias("skill"))
                     .groupBy("username", "skill").agg(F.count(F.lit(1)).alias("n")))
    w = W.partitionBy("username").orderBy(F.desc("n"), F.asc("skill"))
    top = per.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= n)
    return top.groupBy("username").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "skill"))), lambda x: x["skill"]), ",")
        .alias("skills"))


def repo_score_model_a(repos: DataFrame) -> DataFrame:
    """X11 on its own: capped share score with the 10-star cutoff."""
    return repos.withColumn("score", repo_score("user_prs", "total_prs", "stars",
                                                min_stars=D.MIN_STARS))
