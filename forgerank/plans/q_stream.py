"""Streaming and end-to-end refresh queries."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions.columns import cust_login
from ..operators import analysis as AN
from ..operators import ingest as I
from ..operators.refresh import full_refresh
from ..session import scratch_path
from ..sources import adapter as A
from ..sources.tables import read_table
from ..streaming.incremental import (Refresh, board, dedupe_requests, land_in_files, land_in_order, landing_files,
                                     refresh_pull_requests, refresh_repositories)
from .adapter_sql import cust, with_ctes
from .q_analysis import Q4_CTES, stage4_ctes
from .q_ingest import REPO_PAYLOAD
from .q_ops import NEWEST
from .q_scoring import SCORE_EXPR
from .registry import ORACLE, Tables, register, rounded

# R1 ---------------------------------------------------------------------------------
@register("incremental_refresh")
def q_incremental_refresh(spark, sf_dir):
    """Repository payloads land with half the stars and one pull request more than there are, except for
    every fifth repository, which is not there yet; some payloads are broken. Pull requests land
    in four arrivals by their landing order, so ids come back in later ones. Then all repositories
    land as they are now. The result must equal the one-shot leaderboard."""
    t = Tables(spark, sf_dir)
    files = landing_files(t.raw_prs)
    state = Refresh(spark, scratch_path(spark, "refresh"), buckets=files)  # as many parts as the input asks for
    early = t.repos.where("repo_key % 5 <> 0").withColumn("stars", F.floor(F.col("stars") / 2).cast("int")).withColumn(
        "total_prs", F.col("total_prs") + 1)

    def some_broken(repos):
        return I.repository_payloads(repos).withColumn(
            "response", F.when(F.crc32("cache_key") % 10 == 0, F.substring("response", 1, 40)).otherwise(F.col("response")))

    landing = land_in_files(early, scratch_path(spark, "landing_repos"), files, build=some_broken)
    refresh_repositories(state, landing, files_per_batch=files)
    prs = land_in_order(t.raw_prs, scratch_path(spark, "landing_prs"), F.col("seq.a"), 4, files, "id")
    refresh_pull_requests(state, prs, spark.read.parquet(prs).schema, files_per_batch=files)
    land_in_files(t.repos, landing, files, mode="append", build=I.repository_payloads)
    refresh_repositories(state, landing, files_per_batch=files)
    return rounded(board(state, t.users), "total_score")


ORACLE["incremental_refresh"] = ORACLE["leaderboard"]


# R2 ---------------------------------------------------------------------------------
@register("dedupe_requests", f"""
WITH RECURSIVE req AS (SELECT DISTINCT 'member:' || {cust('user_id')} AS k, ts + to_days(CAST(event_id % 3 * 40 AS INTEGER)) AS t
  FROM events),
served AS (SELECT k, min(t) AS t FROM req GROUP BY k
  UNION ALL SELECT r.k, min(r.t) FROM served s JOIN req r ON r.k = s.k AND r.t >= s.t + INTERVAL 30 DAY GROUP BY r.k, s.t)
SELECT k AS cache_key, t AS requested_at FROM served""")
def q_dedupe_requests(spark, sf_dir):
    """Every event is a lookup request for its user, spread over four months so that keys
    expire and come back; within the 30-day TTL of a served request a key is not served. They land in
    four arrivals by time, so a key's requests come in several."""
    e = read_table(spark, sf_dir, "events").select(
        F.concat(F.lit("member:"), cust_login("user_id")).alias("cache_key"),
        F.timestamp_add("DAY", (F.col("event_id") % 3 * 40).cast("int"), F.col("ts").cast("timestamp_ntz")).alias("requested_at"))
    files = landing_files(e)
    landing = land_in_order(e, scratch_path(spark, "landing_requests"), F.unix_micros(F.col("requested_at").cast("timestamp")), 4, files,
                            "cache_key")
    schema = spark.read.parquet(landing).schema
    return dedupe_requests(spark, landing, schema, files_per_batch=files)


# Q8 ---------------------------------------------------------------------------------
FULL_REFRESH_CTES = {
    **Q4_CTES, **REPO_PAYLOAD, **NEWEST,
    "np": """SELECT id, repo_name AS repo_id, nth, CASE WHEN id LIKE '%-7' THEN 'ghost' ELSE username END AS author_login
             FROM newest""",
    "s1": """SELECT n.id, n.author_login AS username, n.repo_id AS repo_name,
             row_number() OVER (PARTITION BY n.id ORDER BY q.payload_index, n.nth) AS k
             FROM (SELECT username, full_name, payload_index FROM pfirst WHERE stars >= 10) q
             JOIN np n ON n.repo_id = q.full_name AND lower(n.author_login) = lower(q.username)""",
    "sp": "SELECT id, username, repo_name FROM s1 WHERE k = 1",
    "rep": "SELECT DISTINCT owner_login || '/' || name AS full_name, total_prs, stars FROM pfirst",
    "st": """SELECT p.username, p.repo_name, CAST(count(p.id) AS INTEGER) AS user_prs, r.total_prs, r.stars
             FROM sp p JOIN rep r ON p.repo_name = r.full_name GROUP BY p.username, p.repo_name, r.total_prs, r.stars""",
    "sc": f"SELECT *, {SCORE_EXPR} AS repo_score FROM st WHERE {SCORE_EXPR} > 0",
    "tt": """SELECT username, sum(repo_score) AS total_score, count(*) AS n_repos,
             CAST(sum(user_prs) AS BIGINT) AS contribution_count FROM sc GROUP BY 1""",
}


_STAGE4 = stage4_ctes()


def _own_name(sql: str) -> str:
    """The stage-4 SQL over the refreshed tables, its names kept apart from those above."""
    sql = re.sub(rf"\b({'|'.join(_STAGE4)})\b(?=\s|$|,|\.|\))", r"z_\1", sql)
    return sql.replace("a_repos", "k2").replace("a_prs", "sp")


FULL_REFRESH_CTES["k2"] = """SELECT owner_login, name AS repo_name, stars, primary_language, topics FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY payload_index DESC, full_name DESC) AS k FROM pfirst) WHERE k = 1"""
FULL_REFRESH_CTES |= {f"z_{k}": _own_name(v) for k, v in _STAGE4.items()}
FULL_REFRESH_CTES["z_out"] = ("SELECT owner_login, round(0.0 + " + " + ".join(
    f"{c}_score" for c in D.CATEGORIES_SUBSTRING) + ", 4) AS analysis_score FROM z_sums")


@register("full_refresh", with_ctes("""
SELECT u.username, u.name, u.avatar_url, round(t.total_score, 4) AS total_score, t.n_repos, t.contribution_count,
  round(t.total_score, 4) AS legacy_score, z.analysis_score
FROM a_users u LEFT JOIN tt t ON t.username = u.username LEFT JOIN z_out z ON z.owner_login = u.username
WHERE t.username IS NOT NULL OR z.owner_login IS NOT NULL""", "a_users", "a_repos", "a_prs", "a_raw_prs",
                                    extra=FULL_REFRESH_CTES))
def q_full_refresh(spark, sf_dir):
    """Q8: every user's profile, repository and merged-PR payloads parsed, upserted,
    scored, synced and analysed; one row for each user with a score or an analysis."""
    t = Tables(spark, sf_dir)
    # The users may lie in one file: dealt first, so that no one task makes and parses all profiles.
    profiles = I.profile_payloads(t.users.repartition("username"), F.col("social_accounts"))
    repos = I.repo_payloads(AN.user_repo_candidates(t.users, t.repos, t.prs))
    prs = I.pr_payloads(I.newest_prs_per_repo(t.raw_prs))
    out = full_refresh(profiles, repos, prs, A.as_of_col())
    board = (out["leaderboard"].select("username", "total_score")
             .join(out["totals"].select("username", "n_repos", "contribution_count"), "username")
             .join(out["legacy_users"].select("username", F.col("score").alias("legacy_score")), "username"))
    analysed = out["analyses"].select("username", F.col("total_score").alias("analysis_score"))
    rows = out["users"].select("username", "name", "avatar_url").join(board.join(analysed, "username", "full"), "username")
    return rounded(rows, "total_score", "legacy_score", "analysis_score")
