"""Payload ingest queries: payloads are built by Spark from the adapter tables,
landed as JSON text, then parsed back (S2-S6, X1, X5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..operators import analysis as AN
from ..operators import ingest as I
from .adapter_sql import with_ctes
from .q_analysis import Q4_CTES, profile_link_sql
from .q_ops import DISC, NEWEST, discovered
from .registry import Tables, register


def parsed_profiles(t: Tables):
    u = t.users
    rows, _ = I.parse_profile(I.profile_payloads(u, F.col("social_accounts")))
    return rows


PROFILE_LINK = profile_link_sql()


@register("parse_profile", with_ctes(f"""
SELECT username, name, avatar_url, bio, followers, following, 0 AS public_repos, blog, blog AS website_url,
  location, email, twitter_username, company, hireable, created_at, {PROFILE_LINK} AS linkedin FROM a_users""",
    "a_users"))
def q_parse_profile(spark, sf_dir):
    return parsed_profiles(Tables(spark, sf_dir))


@register("extract_link", with_ctes(f"SELECT username, {PROFILE_LINK} AS linkedin FROM a_users", "a_users"))
def q_extract_link(spark, sf_dir):
    """X1 over the landed profiles: LINKEDIN account, else bio, else website."""
    return parsed_profiles(Tables(spark, sf_dir)).select("username", "linkedin")


@register("request_key", with_ctes(f"""
SELECT username, '{D.REQUEST_KEY_PREFIX}' || sha256('{{"query":"GetUser","variables":{{"login":"' || username || '"}}}}')
  AS cache_key FROM a_users""", "a_users"))
def q_request_key(spark, sf_dir):
    return I.profile_requests(Tables(spark, sf_dir).users)


REPO_PAYLOAD = {
    "nown": "SELECT username, count(*) AS n_owned FROM capped WHERE relation = 0 GROUP BY 1",
    "pidx": """SELECT c.*, CASE WHEN c.relation = 0 THEN c.pos - 1 ELSE coalesce(n.n_owned, 0) + c.pos - 1 END
               AS payload_index FROM capped c LEFT JOIN nown n ON c.username = n.username""",
    "pfirst": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY username, full_name ORDER BY payload_index)
               AS rr FROM pidx) WHERE rr = 1""",
}


@register("parse_repos", with_ctes("""
SELECT username, payload_index, full_name, stars, primary_language, total_prs, owner_login || '/' || name = full_name AS ok,
  array_to_string(coalesce(topics, CAST([] AS VARCHAR[])), ',') AS topics,
  array_to_string(coalesce(languages, CAST([] AS VARCHAR[])), ',') AS languages
FROM pfirst""", "a_users", "a_repos", "a_prs", extra={**Q4_CTES, **REPO_PAYLOAD}))
def q_parse_repos(spark, sf_dir):
    """S3 + U1 over landed repository payloads (owned, then contributed)."""
    t = Tables(spark, sf_dir)
    cand = AN.user_repo_candidates(t.users, t.repos, t.prs)
    r = I.parse_repos(I.repo_payloads(cand))
    return r.select("username", F.col("payload_index").cast("long").alias("payload_index"), "full_name", "stars", "primary_language", "total_prs",
                    (F.concat("owner_login", F.lit("/"), "name") == F.col("full_name")).alias("ok"),
                    F.array_join("topics", ",").alias("topics"), F.array_join("languages", ",").alias("languages"))


@register("parse_pull_requests", with_ctes("""
SELECT id, 'https://github.com/' || repo_name || '/pull/' || id AS url, repo_name AS repo_id,
  CASE WHEN id LIKE '%-7' THEN 'ghost' ELSE username END AS author_login,
  CASE WHEN id LIKE '%-6' THEN NULL ELSE merged_at END AS merged_at, created_at
FROM newest""", "a_raw_prs", extra=NEWEST))
def q_parse_pull_requests(spark, sf_dir):
    """S4 over one landed payload per repo (its newest 100 merged PRs)."""
    t = Tables(spark, sf_dir)
    return I.parse_pull_requests(I.pr_payloads(I.newest_prs_per_repo(t.raw_prs))).drop("nth")


@register("parse_pr_search", with_ctes("""
SELECT p.username, CASE WHEN p.id LIKE '%-5' THEN 'https://github.com/' || p.repo_name || '/pull/' || p.id ELSE p.id END AS id,
  p.repo_name AS repo_id, p.merged_at
FROM a_prs p JOIN qual q ON q.username = p.username AND q.full_name = p.repo_name""",
    "a_users", "a_repos", "a_prs", extra=Q4_CTES))
def q_parse_pr_search(spark, sf_dir):
    """Search results of each user's merged PRs in their first 50 qualifying repos."""
    return I.parse_pr_search(landed_searches(Tables(spark, sf_dir)))


def landed_searches(t: Tables):
    from pyspark.sql import Window as W
    uni = AN.user_repos_union(AN.user_repo_candidates(t.users, t.repos, t.prs))
    w = W.partitionBy("username").orderBy("position")
    qual = (uni.where(F.col("stars") >= D.MIN_STARS).withColumn("q", F.row_number().over(w))
               .where(F.col("q") <= D.QUALIFYING_REPOS_CAP).select("username", "full_name"))
    found = t.prs.select("username", "id", F.col("repo_name").alias("full_name"), "merged_at", "created_at") \
                 .join(qual, ["username", "full_name"], "inner")
    return I.search_payloads(found)


def damaged(landed, by: str):
    """The landing with every third text (by the length of a column) cut short and every third an error message."""
    n = F.length(by) % 3
    return landed.withColumn("response", F.when(n == 0, F.expr("left(response, length(response) - 2)")).when(
        n == 1, F.lit('{"message": "rate limit"}')).otherwise(F.col("response")))


def damaged_sql(by: str, reason: str) -> str:
    return f"CASE WHEN length({by}) % 3 = 0 THEN 'not JSON' ELSE '{reason}' END AS reason"


@register("quarantine_pr_search", with_ctes(f"""
SELECT DISTINCT p.username AS cache_key, {damaged_sql("p.username", "no search result")}
FROM a_prs p JOIN qual q ON q.username = p.username AND q.full_name = p.repo_name WHERE length(p.username) % 3 < 2""",
    "a_users", "a_repos", "a_prs", extra=Q4_CTES))
def q_quarantine_pr_search(spark, sf_dir):
    """The searches whose pages no parser can read, with the reason."""
    return I.unreadable_pr_search(damaged(landed_searches(Tables(spark, sf_dir)), "cache_key")).distinct()


@register("quarantine_search_page", with_ctes(f"""
SELECT DISTINCT location, slice, page, {damaged_sql("location", "no items")} FROM disc WHERE length(location) % 3 < 2""",
    "a_users", extra=DISC))
def q_quarantine_search_page(spark, sf_dir):
    """The pages without a list of hits."""
    landed = damaged(I.search_page_payloads(discovered(Tables(spark, sf_dir))), "location")
    return I.unreadable_search_page(landed).withColumn("page", F.col("page").cast("long"))


@register("parse_search_page", with_ctes("""
SELECT location, slice, page, (hit - 1) % 100 AS i, username FROM disc""", "a_users", extra=DISC))
def q_parse_search_page(spark, sf_dir):
    """User-search pages (100 logins each) back to logins."""
    t = Tables(spark, sf_dir)
    landed = I.search_page_payloads(discovered(t))
    return I.parse_search_page(landed).select("location", "slice", F.col("page").cast("long").alias("page"),
                                              F.col("i").cast("long").alias("i"),
                                              "username")
