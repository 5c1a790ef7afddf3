"""Discovery work list (Q7): locations (X4), follower slices (X3), the per-slice
result cap (T6), the one-hour freshness check (F9) and the anti join (J3).

The live search is re-aimed at the landed ``github_users`` table: a user is
found for a location when one comma-separated part of their location equals
the location (case-insensitive). That is an equi join on the exploded parts,
not a theta join, so it partitions on the location key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions.columns import follower_slice, follower_slice_index, split_locations


def locations_from_argument(arg: DataFrame, col: str = "arg") -> DataFrame:
    """X4 over an argument column: one row per trimmed, non-empty location."""
    return arg.select(F.explode(split_locations(col)).alias("location")).distinct()


def discover(users: DataFrame, locations: DataFrame, cap: int = D.USERS_PER_SLICE_CAP) -> DataFrame:
    """Search results: per (location, follower slice) at most ``cap`` users
    (10 pages of 100), in search order (followers desc, login)."""
    parts = users.select(
        "username", "followers", "scraped_at",
        F.explode(F.transform(F.split(F.lower(F.coalesce("location", F.lit(""))), ","),
                              lambda x: F.trim(x))).alias("part")).distinct()
    locs = locations.select("location", F.lower("location").alias("part"))
    hits = parts.join(locs, "part", "inner").select(
        "location", "username", "followers",
        follower_slice("followers").alias("slice"),
        follower_slice_index("followers").alias("slice_no"))
    w = W.partitionBy("location", "slice").orderBy(F.desc("followers"), F.asc("username"))
    ranked = hits.where(F.col("slice").isNotNull()).withColumn("hit", F.row_number().over(w))
    return ranked.where(F.col("hit") <= cap).withColumn(
        "page", ((F.col("hit") - 1) / 100).cast("int") + 1)


def fresh_matches(users: DataFrame, discovered: DataFrame, as_of: Column,
                  hours: int = D.DISCOVERY_FRESH_HOURS) -> DataFrame:
    """``username IN (found logins) AND scraped_at > now - 1h`` (case-sensitive IN)."""
    found = discovered.select("username").distinct()
    recent = users.where(F.col("scraped_at") > F.timestamp_add("HOUR", F.lit(-hours), as_of))
    return recent.select("username").join(found, "username", "left_semi")


def discover_todo(users: DataFrame, discovered: DataFrame, as_of: Column) -> DataFrame:
    """Found logins minus the fresh set, compared lower-cased."""
    fresh = fresh_matches(users, discovered, as_of).select(F.lower("username").alias("__k")).distinct()
    return (discovered.withColumn("__k", F.lower("username"))
                      .join(fresh, "__k", "left_anti").drop("__k"))
