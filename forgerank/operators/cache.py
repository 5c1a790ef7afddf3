"""Freshness predicates and the cached-profile read model.

The reference looks a user up by the lower-cased login but compares it with the
stored login exactly (D10), so a stored mixed-case login never hits;
``profile_lookup`` keeps that behaviour for batch lookups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dictionaries as D


def fresh_users(users: DataFrame, as_of: Column, days: int = D.FRESH_DAYS) -> DataFrame:
    """F8: ``now - scraped_at < days``; a null ``scraped_at`` is stale."""
    return users.where(F.col("scraped_at") > F.timestamp_add("DAY", F.lit(-days), as_of))


def cached_profile(users: DataFrame) -> DataFrame:
    """Stored row -> profile; url rebuilt from the login, no repositories."""
    return users.select(
        F.col("username").alias("login"), "name", "avatar_url",
        F.concat(F.lit(D.PROFILE_URL_PREFIX), "username").alias("url"),
        "company", "blog", "location", "email", "bio", "twitter_username",
        F.lit(None).cast("string").alias("linkedin"),
        F.col("hireable").alias("is_hireable"), F.col("blog").alias("website_url"),
        "followers", "following",
        F.lit(0).alias("repo_count"), F.lit(0).alias("contribution_count"),
        F.lit("").alias("unique_skills"))


def profile_lookup(users: DataFrame, requests: DataFrame, as_of: Column) -> DataFrame:
    """Batch form of the cached-user lookup: request logins are lower-cased, stored
    logins are compared as stored; only fresh rows are served."""
    req = requests.select(F.lower("username").alias("username")).distinct()
    return cached_profile(fresh_users(users, as_of).join(req, "username", "inner"))
