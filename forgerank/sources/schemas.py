"""Declared schemas of the domain tables (the union of the reference's three
schema declarations). Scores are DOUBLE inside the engine."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, D, B, TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.TimestampNTZType()
ARR = T.ArrayType(T.StringType())


def st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


TOP_REPO = st(("name", S, True), ("owner", S, True), ("stars", I, True), ("prs", I, True),
              ("score", D, True), ("categories", ARR, True))

SCHEMAS = {
    "github_users": st(("username", S, False), ("name", S, True), ("avatar_url", S, True), ("bio", S, True),
                       ("followers", I, False), ("following", I, False), ("public_repos", I, False),
                       ("blog", S, True), ("location", S, True), ("email", S, True),
                       ("twitter_username", S, True), ("company", S, True), ("hireable", B, True),
                       ("created_at", TS, True), ("scraped_at", TS, False)),
    "github_repos": st(("repo_name", S, False), ("owner_login", S, False), ("description", S, True),
                       ("primary_language", S, True), ("stars", I, False), ("forks", I, False),
                       ("watchers", I, False), ("total_prs", I, False), ("is_fork", B, False),
                       ("is_archived", B, False), ("topics", ARR, True), ("created_at", TS, True),
                       ("pushed_at", TS, True), ("scraped_at", TS, False)),
    "github_pull_requests": st(("id", S, False), ("username", S, False), ("repo_name", S, False),
                               ("state", S, False), ("additions", I, True), ("deletions", I, True),
                               ("merged_at", TS, True), ("created_at", TS, True)),
    "user_repo_scores": st(("username", S, False), ("repo_name", S, False), ("user_prs", I, False),
                           ("total_prs", I, False), ("stars", I, False), ("repo_score", D, False),
                           ("computed_at", TS, False)),
    "user_scores": st(("username", S, False), ("total_score", D, False), ("updated_at", TS, False)),
    "analyses": st(("id", S, False), ("username", S, False), ("total_score", D, False),
                   ("ai_score", D, False), ("backend_score", D, False), ("frontend_score", D, False),
                   ("devops_score", D, False), ("data_score", D, False), ("unique_skills", ARR, True),
                   ("linkedin", S, True), ("top_repos", T.ArrayType(TOP_REPO), True),
                   ("languages", T.MapType(S, I), True), ("contribution_count", I, False),
                   ("cached_at", TS, False)),
    "leaderboard": st(("username", S, False), ("name", S, True), ("avatar_url", S, True), ("url", S, True),
                      ("total_score", D, False), ("ai_score", D, False), ("backend_score", D, False),
                      ("frontend_score", D, False), ("devops_score", D, False), ("data_score", D, False),
                      ("unique_skills", ARR, True), ("company", S, True), ("blog", S, True),
                      ("location", S, True), ("email", S, True), ("bio", S, True),
                      ("twitter_username", S, True), ("linkedin", S, True), ("hireable", B, False),
                      ("is_open_to_work", B, True), ("otw_scraped_at", TS, True), ("created_at", TS, True),
                      ("updated_at", TS, False), ("otw_permanent_failure", B, True),
                      ("otw_error_code", S, True)),
    "users": st(("username", S, False), ("name", S, True), ("avatar_url", S, True), ("bio", S, True),
                ("company", S, True), ("blog", S, True), ("location", S, True), ("email", S, True),
                ("twitter_username", S, True), ("linkedin", S, True), ("hireable", B, True),
                ("website_url", S, True), ("followers", I, True), ("following", I, True),
                ("public_repos", I, True), ("score", D, True), ("last_fetched", TS, True),
                ("created_at", TS, True), ("updated_at", TS, True), ("raw_json", S, True)),
    "repos": st(("id", S, False), ("username", S, False), ("repo_name", S, False), ("full_name", S, False),
                ("stars", I, False), ("forks", I, False), ("language", S, True), ("description", S, True),
                ("url", S, True), ("pushed_at", TS, True), ("is_fork", B, False), ("topics", ARR, True),
                ("languages", ARR, True), ("merged_pr_count", I, False), ("merged_prs_by_user_count", I, False)),
    "api_cache": st(("cache_key", S, False), ("response", S, False), ("cached_at", TS, False),
                    ("expires_at", TS, False)),
    "token_rate_limit": st(("token_index", I, False), ("remaining", I, False), ("reset_time", I, False),
                           ("last_updated", TS, False)),
}
