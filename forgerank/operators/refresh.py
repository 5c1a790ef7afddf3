"""Full refresh for a set of users (Q8): landed payloads -> parsed rows -> keyed
upserts (K1-K3) -> stage 2/3 scores (K4, K5) -> legacy and leaderboard sync (K6, K7)
-> stage 4 analyses (K8), as one set of Spark jobs over every user instead of a
per-user loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..session import shared
from . import ingest as I
from . import scoring as S
from .analysis import analyses_rows, upsert_analyses
from .upsert import (sync_leaderboard, sync_legacy_users, upsert_pull_requests, upsert_repos_short_name,
                     upsert_user_repo_scores, upsert_user_scores, upsert_users)


def stage1_pull_requests(repo_rows: DataFrame, pr_rows: DataFrame,
                         min_stars: int = D.MIN_STARS) -> DataFrame:
    """For each user's qualifying repos (F1), the fetched PRs authored by the user
    (F2, case-insensitive), stored with the author's login; an id seen twice keeps
    its first insert (K3) in fetch order (repo position, then payload position)."""
    q = (repo_rows.where(F.col("stars") >= min_stars)
         .select("username", F.col("full_name").alias("repo_id"), "payload_index",
                 F.lower("username").alias("__l")))
    p = pr_rows.select("id", "repo_id", "nth", "author_login", "merged_at", "created_at",
                       F.lower("author_login").alias("__l"))
    found = q.join(p, ["repo_id", "__l"], "inner").select(
        "id", F.col("author_login").alias("username"), F.col("repo_id").alias("repo_name"),
        "merged_at", "created_at", F.struct("payload_index", "nth").alias("ord"))
    return upsert_pull_requests(None, found, order=["ord"])


def full_refresh(profiles_landed: DataFrame, repos_landed: DataFrame, prs_landed: DataFrame,
                 as_of: Column, old: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Landed payloads to every stored table, in the order of the stages: ``users`` (K1),
    ``repos`` (K2), ``pull_requests`` (K3), ``user_repo_scores`` (K4), ``user_scores`` (K5),
    ``legacy_users`` (K6), ``leaderboard`` (K7), ``analyses`` (K8), and ``quarantine``, the
    payloads that could not be read with the reason. ``old`` holds the versions of the
    tables that are stored already."""
    old = old or {}
    profiles, bad = I.parse_profile(profiles_landed)
    users = shared(upsert_users(old.get("users"), profiles.withColumn("scraped_at", as_of)), "users")
    repo_rows = shared(I.parse_repos(repos_landed), "parsed_repos")
    repos = shared(upsert_repos_short_name(
        old.get("repos"), repo_rows.select(
            F.col("name").alias("repo_name"), "owner_login", "stars", "total_prs", "primary_language", "is_fork",
            "topics", "pushed_at", F.lit(0).alias("forks"), "payload_index", "full_name"),
        order=["payload_index", "full_name"]), "repos")
    prs = shared(stage1_pull_requests(repo_rows, I.parse_pull_requests(prs_landed)), "pull_requests")
    scored = S.user_repo_scores(S.user_repo_stats(prs, repos))
    pair_scores = shared(upsert_user_repo_scores(old.get("user_repo_scores"), scored, as_of), "user_repo_scores")
    totals = shared(S.user_scores(pair_scores), "totals")
    user_scores = upsert_user_scores(old.get("user_scores"), totals.select("username", "total_score"), as_of)
    analyses = upsert_analyses(old.get("analyses"), analyses_rows(repos, prs, users, as_of))
    quarantine = (bad.withColumn("payload", F.lit("profile"))
                  .unionByName(I.unreadable(repos_landed, "user", "user not found").withColumn("payload", F.lit("repos")))
                  .unionByName(I.unreadable(prs_landed, "repository", "repository not found").withColumn("payload", F.lit("prs"))))
    return {"users": users, "repos": repos, "pull_requests": prs, "user_repo_scores": pair_scores,
            "totals": totals, "user_scores": user_scores,
            "legacy_users": sync_legacy_users(old.get("legacy_users"), totals, users, as_of),
            "leaderboard": sync_leaderboard(old.get("leaderboard"), totals, users, as_of),
            "analyses": analyses, "quarantine": quarantine}
