"""Stage 2/3 scoring, leaderboard and model A queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions.columns import experience_level
from ..operators import scoring as S
from .adapter_sql import with_ctes
from .registry import Tables, register, rounded

# ------------------------------------------------------------------ shared SQL
STATS_SQL = """
SELECT p.username, p.repo_name, CAST(count(p.id) AS INTEGER) AS user_prs, r.total_prs, r.stars
FROM a_prs p JOIN (SELECT owner_login || '/' || repo_name AS full_name, total_prs, stars FROM a_repos) r
  ON p.repo_name = r.full_name
WHERE p.username IS NOT NULL
GROUP BY p.username, p.repo_name, r.total_prs, r.stars"""

SCORE_EXPR = ("CASE WHEN coalesce(total_prs > 0, FALSE) THEN least(CAST(coalesce(stars, 0) AS DOUBLE) * "
              "(CAST(user_prs AS DOUBLE) / CAST(total_prs AS DOUBLE)), 10000.0) ELSE 0.0 END")

SCORED = {"stats": STATS_SQL,
          "scored": f"SELECT *, {SCORE_EXPR} AS repo_score FROM stats WHERE {SCORE_EXPR} > 0",
          "totals": """SELECT username, sum(repo_score) AS total_score, count(*) AS n_repos,
                         CAST(sum(user_prs) AS BIGINT) AS contribution_count FROM scored GROUP BY username""",
          "board": """SELECT t.username, u.name, u.avatar_url, t.total_score, t.n_repos, t.contribution_count
                        FROM totals t JOIN a_users u ON t.username = u.username"""}


def level_sql(x: str) -> str:
    parts = " ".join(f"WHEN {x} < {b} THEN '{label}'" for b, label in D.LEVELS)
    return f"CASE {parts} ELSE '{D.TOP_LEVEL}' END"


def board(t: Tables):
    return S.leaderboard(t.prs, t.repos, t.users)


# Q1 flagship ------------------------------------------------------------------
@register("leaderboard", with_ctes("""
SELECT username, name, avatar_url, round(total_score, 4) AS total_score, n_repos, contribution_count
FROM board""", "a_users", "a_repos", "a_prs", extra=SCORED))
def q_leaderboard(spark, sf_dir):
    return rounded(board(Tables(spark, sf_dir)), "total_score")


@register("user_repo_stats", with_ctes("SELECT * FROM stats", "a_repos", "a_prs",
                                        extra={"stats": STATS_SQL}))
def q_user_repo_stats(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return S.user_repo_stats(t.prs, t.repos)


@register("user_repo_scores", with_ctes("""
SELECT username, repo_name, user_prs, total_prs, stars, round(repo_score, 4) AS repo_score FROM scored""",
    "a_repos", "a_prs", extra={k: SCORED[k] for k in ["stats", "scored"]}))
def q_user_repo_scores(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rounded(S.user_repo_scores(S.user_repo_stats(t.prs, t.repos)), "repo_score")


@register("user_scores", with_ctes("""
SELECT username, round(total_score, 4) AS total_score, n_repos, contribution_count,
  {lvl} AS experience_level FROM totals""".format(lvl=level_sql("total_score")),
    "a_repos", "a_prs", extra={k: SCORED[k] for k in ["stats", "scored", "totals"]}))
def q_user_scores(spark, sf_dir):
    t = Tables(spark, sf_dir)
    tot = S.user_scores(S.user_repo_scores(S.user_repo_stats(t.prs, t.repos)))
    tot = tot.withColumn("experience_level", experience_level("total_score"))
    return rounded(tot, "total_score")


# T1 -----------------------------------------------------------------------------
@register("top_members", with_ctes("""
SELECT b.username, b.name, b.avatar_url, round(b.total_score, 4) AS total_score, u.bio, u.location
FROM board b JOIN a_users u ON b.username = u.username
WHERE b.total_score > 0 ORDER BY b.total_score DESC, b.username LIMIT 10""",
    "a_users", "a_repos", "a_prs", extra=SCORED))
def q_top_members(spark, sf_dir):
    t = Tables(spark, sf_dir)
    b = board(t).join(t.users.select("username", "bio", "location"), "username", "inner")
    return rounded(S.top_members(b, 10), "total_score")


# F6 -----------------------------------------------------------------------------
@register("member_profile", with_ctes("""
SELECT b.username, b.name, b.avatar_url, round(b.total_score, 4) AS total_score, u.bio, u.location
FROM board b JOIN a_users u ON b.username = u.username
WHERE b.username IN (SELECT DISTINCT username FROM a_attempts)""",
    "a_users", "a_repos", "a_prs", "a_attempts", extra=SCORED))
def q_member_profile(spark, sf_dir):
    t = Tables(spark, sf_dir)
    b = board(t).join(t.users.select("username", "bio", "location"), "username", "inner")
    return rounded(S.member_profile(b, t.attempts), "total_score")


# X2 -----------------------------------------------------------------------------
@register("experience_level", with_ctes(f"""
SELECT {level_sql('total_score')} AS experience_level, count(*) AS n_users
FROM totals GROUP BY 1""", "a_repos", "a_prs",
    extra={k: SCORED[k] for k in ["stats", "scored", "totals"]}))
def q_experience_level(spark, sf_dir):
    t = Tables(spark, sf_dir)
    tot = S.user_scores(S.user_repo_scores(S.user_repo_stats(t.prs, t.repos)))
    return (tot.groupBy(experience_level("total_score").alias("experience_level"))
               .agg(F.count(F.lit(1)).alias("n_users")))


# X11 ----------------------------------------------------------------------------
@register("repo_score_model_a", with_ctes("""
SELECT username, repo_name, user_prs, total_prs, stars,
  round(CASE WHEN coalesce(stars, 0) >= 10 AND coalesce(total_prs > 0, FALSE)
    THEN least(CAST(coalesce(stars, 0) AS DOUBLE) * (CAST(user_prs AS DOUBLE) / CAST(total_prs AS DOUBLE)), 10000.0)
    ELSE 0.0 END, 4) AS score
FROM stats""", "a_repos", "a_prs", extra={"stats": STATS_SQL}))
def q_repo_score_model_a(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rounded(S.repo_score_model_a(S.user_repo_stats(t.prs, t.repos)), "score")
