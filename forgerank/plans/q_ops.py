"""Discovery, upserts, landing-table, key-audit and stage-1 queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions.columns import extract_link, repo_score
from ..operators import discovery as DI
from ..operators import quality as QU
from ..operators import scoring as S
from ..operators import upsert as U
from ..sources import adapter as A
from ..session import scratch_path
from ..sources.store import Store, day_part, hash_part
from ..sources.tables import read_table
from .adapter_sql import with_ctes
from .q_analysis import Q4_CTES, link_sql
from .q_ranking import AS_OF_SQL
from .q_scoring import SCORE_EXPR, STATS_SQL
from .registry import Tables, register, rounded

# ------------------------------------------------------------------ discovery
LOC_ARG_SQL = "' ' || string_agg(r_name, ' , ,') || ' ,'"


def slice_sql(x: str, index: bool = False) -> str:
    parts = []
    for i, (label, lo, hi) in enumerate(D.FOLLOWER_SLICES):
        cond = f"{x} >= {lo}" if hi is None else f"{x} BETWEEN {lo} AND {hi}"
        parts.append(f"WHEN {cond} THEN " + (str(i) if index else f"'{label}'"))
    return "CASE " + " ".join(parts) + " END"


DISC = {
    "locs": f"""SELECT DISTINCT trim(x) AS location FROM (SELECT unnest(string_split({LOC_ARG_SQL}, ',')) AS x FROM region)
             WHERE length(trim(x)) > 0""",
    "parts": """SELECT DISTINCT username, followers, scraped_at, trim(p) AS part FROM a_users,
             unnest(string_split(lower(coalesce(location, '')), ',')) AS t(p)""",
    "hits": f"""SELECT l.location, p.username, p.followers, {slice_sql('p.followers')} AS slice,
             {slice_sql('p.followers', True)} AS slice_no FROM parts p JOIN locs l ON p.part = lower(l.location)""",
    "ranked": """SELECT *, row_number() OVER (PARTITION BY location, slice ORDER BY followers DESC, username) AS hit
             FROM hits WHERE slice IS NOT NULL""",
    "disc": f"SELECT *, (hit - 1) // 100 + 1 AS page FROM ranked WHERE hit <= {D.USERS_PER_SLICE_CAP}",
    "fresh": f"""SELECT DISTINCT lower(username) AS k FROM a_users WHERE scraped_at > {AS_OF_SQL} - INTERVAL 1 HOUR
             AND username IN (SELECT username FROM disc)""",
}


def locations(spark, sf_dir):
    """The discovery argument string (comma-separated locations) built from the
    region names: region is a fixed 5-row dimension, so the one-row aggregate is
    bounded; X4 then splits it back into locations."""
    arg = read_table(spark, sf_dir, "region").agg(
        F.concat(F.lit(" "), F.concat_ws(" , ,", F.collect_list("r_name")), F.lit(" ,")).alias("arg"))
    return DI.locations_from_argument(arg)


def discovered(t: Tables):
    return DI.discover(t.users, locations(t.spark, t.sf_dir))


@register("split_locations", with_ctes("SELECT location FROM locs", extra={"locs": DISC["locs"]}))
def q_split_locations(spark, sf_dir):
    return locations(spark, sf_dir)


@register("discover_slices", with_ctes("""
SELECT location, slice, slice_no, username, followers, hit, page FROM disc""", "a_users", extra=DISC))
def q_discover_slices(spark, sf_dir):
    return discovered(Tables(spark, sf_dir)).select(
        "location", "slice", "slice_no", "username", "followers",
        F.col("hit").cast("long").alias("hit"), F.col("page").cast("long").alias("page"))


@register("discover_todo", with_ctes("""
SELECT location, slice, username, followers FROM disc WHERE lower(username) NOT IN (SELECT k FROM fresh)""",
                                       "a_users", extra=DISC))
def q_discover_todo(spark, sf_dir):
    from ..session import shared
    t = Tables(spark, sf_dir)
    found = shared(discovered(t), "discovered")  # read twice: the work list and the freshness lookup
    return DI.discover_todo(t.users, found, A.as_of_col()).select(
        "location", "slice", "username", "followers")


# ------------------------------------------------------------------ upserts
STORE_BUCKETS = 16  # parts of the queries' stores; a larger table is given more when it is created


def through_store(old, batch, keys, change):
    """``batch`` merged into a stored version of ``old`` in parts by key: only the parts that the
    batch touches are read and written anew."""
    store = Store.of(old, scratch_path(old.sparkSession, "store"), hash_part(keys, STORE_BUCKETS))
    store.merge(batch, change)
    return store.read()


@register("upsert_users", with_ctes("""
SELECT username, name, bio, followers, public_repos, scraped_at FROM a_users""", "a_users"))
def q_upsert_users(spark, sf_dir):
    """K1: an older snapshot, then a batch holding two scrapes of every user."""
    u = Tables(spark, sf_dir).users.drop("user_key")
    old = (u.withColumn("followers", F.col("followers") + 1)
            .withColumn("public_repos", F.lit(7))
            .withColumn("scraped_at", F.timestamp_add("DAY", F.lit(-40), "scraped_at")))
    earlier = u.withColumn("bio", F.lit(None).cast("string")).withColumn(
        "scraped_at", F.timestamp_add("DAY", F.lit(-1), "scraped_at"))
    out = through_store(old, u.unionByName(earlier), ["username"], U.upsert_users)
    return out.select("username", "name", "bio", "followers", "public_repos", "scraped_at")


K2_COLS = ["repo_name", "owner_login", "stars", "total_prs", "primary_language", "forks", "watchers",
           "description", "is_archived", "created_at"]


@register("upsert_repos_short_name", with_ctes(f"""
SELECT short_name AS repo_name, owner_login, stars, total_prs, primary_language, 0 AS forks, 0 AS watchers,
  CAST(NULL AS VARCHAR) AS description, FALSE AS is_archived, CAST(NULL AS TIMESTAMP) AS created_at
FROM (SELECT *, row_number() OVER (PARTITION BY short_name ORDER BY scraped_at DESC, repo_key DESC) AS rn FROM a_repos)
WHERE rn = 1""", "a_repos"))
def q_upsert_repos_short_name(spark, sf_dir):
    """K2: repos stored under their short name; the last landed row per name wins."""
    r = Tables(spark, sf_dir).repos
    landed = r.withColumn("repo_name", F.col("short_name")).drop("short_name")
    # Two batches: the second meets the stored rows of the first.
    early = landed.where(F.col("scraped_at") < F.expr("TIMESTAMP_NTZ '2024-02-06 00:00:00'"))
    late = landed.where(F.col("scraped_at") >= F.expr("TIMESTAMP_NTZ '2024-02-06 00:00:00'"))
    old = U.upsert_repos_short_name(None, early, ["scraped_at", "repo_key"])
    out = through_store(old, late, ["repo_name"], lambda o, n: U.upsert_repos_short_name(o, n, ["scraped_at", "repo_key"]))
    return out.select(*K2_COLS)


@register("upsert_pull_requests", with_ctes("""
SELECT id, username, repo_name, 'MERGED' AS state, 0 AS additions, 0 AS deletions, merged_at, created_at
FROM (SELECT id,
        first_value(username) OVER w AS username, first_value(repo_name) OVER w AS repo_name,
        first_value(created_at) OVER w AS created_at, last_value(merged_at) OVER w AS merged_at,
        row_number() OVER (PARTITION BY id ORDER BY s_a % 2, s_a, s_b, s_c) AS rn
      FROM a_raw_prs
      WINDOW w AS (PARTITION BY id ORDER BY s_a % 2, s_a, s_b, s_c ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
WHERE rn = 1""", "a_raw_prs"))
def q_upsert_pull_requests(spark, sf_dir):
    """K3 in two batches by the landing order: ids of both keep their first row and
    take state and merge time from the last."""
    raw = Tables(spark, sf_dir).raw_prs
    early = F.col("seq.a") % 2 == 0
    first = raw.where(early).withColumn("seq", F.struct(F.lit(0).alias("batch"), "seq"))
    second = raw.where(~early).withColumn("seq", F.struct(F.lit(1).alias("batch"), "seq"))
    return through_store(U.upsert_pull_requests(None, first), second, ["id"], U.upsert_pull_requests)


K4_SCORE_OLD = SCORE_EXPR.replace("total_prs", "t_old")


@register("upsert_user_repo_scores", with_ctes(f"""
SELECT username, repo_name, user_prs, total_prs, stars, round(repo_score, 4) AS repo_score, computed_at FROM (
  SELECT username, repo_name, user_prs, total_prs, stars, repo_score, {AS_OF_SQL} AS computed_at FROM nw
  UNION ALL
  SELECT username, repo_name, user_prs, t_old AS total_prs, stars, {K4_SCORE_OLD} AS repo_score,
    {AS_OF_SQL} - INTERVAL 1 DAY AS computed_at
  FROM od WHERE {K4_SCORE_OLD} > 0 AND (username, repo_name) NOT IN (SELECT (username, repo_name) FROM nw))""",
    "a_repos", "a_prs", extra={"stats": STATS_SQL,
                               "nw": f"SELECT *, {SCORE_EXPR} AS repo_score FROM stats WHERE {SCORE_EXPR} > 0",
                               "od": "SELECT *, CASE WHEN total_prs = 0 THEN 1 ELSE total_prs END AS t_old FROM stats"}))
def q_upsert_user_repo_scores(spark, sf_dir):
    """K4: a zero score is not written, so the older positive row stays."""
    t = Tables(spark, sf_dir)
    stats = S.user_repo_stats(t.prs, t.repos)
    old_stats = stats.withColumn("total_prs", F.when(F.col("total_prs") == 0, 1).otherwise(F.col("total_prs")))
    old = (S.user_repo_scores(old_stats)
           .withColumn("computed_at", F.timestamp_add("DAY", F.lit(-1), A.as_of_col())))
    new = stats.withColumn("repo_score", repo_score("user_prs", "total_prs", "stars"))
    out = through_store(old, new, ["username", "repo_name"], lambda o, n: U.upsert_user_repo_scores(o, n, A.as_of_col()))
    return rounded(out.select("username", "repo_name", "user_prs", "total_prs", "stars", "repo_score",
                              "computed_at"), "repo_score")


@register("upsert_user_scores", with_ctes(f"""
SELECT username, round(sum(repo_score), 4) AS total_score, {AS_OF_SQL} AS updated_at FROM scored GROUP BY username""",
    "a_repos", "a_prs", extra={"stats": STATS_SQL,
                               "scored": f"SELECT *, {SCORE_EXPR} AS repo_score FROM stats WHERE {SCORE_EXPR} > 0"}))
def q_upsert_user_scores(spark, sf_dir):
    t = Tables(spark, sf_dir)
    tot = S.user_scores(S.user_repo_scores(S.user_repo_stats(t.prs, t.repos))).select("username", "total_score")
    old = tot.withColumn("total_score", F.col("total_score") * 2).withColumn(
        "updated_at", F.timestamp_add("DAY", F.lit(-1), A.as_of_col()))
    out = through_store(old, tot, ["username"], lambda o, n: U.upsert_user_scores(o, n, A.as_of_col()))
    return rounded(out, "total_score")


SCORED_T = {"stats": STATS_SQL,
            "scored": f"SELECT *, {SCORE_EXPR} AS repo_score FROM stats WHERE {SCORE_EXPR} > 0",
            "totals": "SELECT username, sum(repo_score) AS total_score FROM scored GROUP BY username"}


@register("sync_legacy_users", with_ctes(f"""
SELECT u.username,
  CASE WHEN t.username IS NOT NULL THEN u.name ELSE upper(u.name) END AS name,
  u.blog AS website_url,
  round(CASE WHEN t.username IS NOT NULL THEN t.total_score ELSE 0.0 END, 4) AS score,
  u.followers, 0 AS public_repos, CASE WHEN u.user_key % 3 <> 1 THEN {link_sql('u.bio', 'u.blog')} END AS linkedin,
  CASE WHEN u.user_key % 3 <> 1 THEN u.created_at ELSE {AS_OF_SQL} END AS created_at,
  CASE WHEN t.username IS NOT NULL THEN {AS_OF_SQL} ELSE u.scraped_at END AS last_fetched
FROM a_users u LEFT JOIN totals t ON u.username = t.username
WHERE u.user_key % 3 <> 1 OR t.username IS NOT NULL""", "a_users", "a_repos", "a_prs", extra=SCORED_T))
def q_sync_legacy_users(spark, sf_dir):
    """K6: the legacy table keeps linkedin and created_at of existing rows."""
    t = Tables(spark, sf_dir)
    u = t.users
    old = u.where("user_key % 3 <> 1").select("username", F.upper("name").alias("name"), "avatar_url", "bio", "company", "blog", "location", "email",
                   "twitter_username", "hireable", F.col("blog").alias("website_url"), "followers",
                   "following", F.lit(0).alias("public_repos"), F.lit(0.0).alias("score"),
                   F.col("scraped_at").alias("last_fetched"), F.col("scraped_at").alias("updated_at"),
                   extract_link(None, F.col("bio"), F.col("blog")).alias("linkedin"), "created_at")
    tot = S.user_scores(S.user_repo_scores(S.user_repo_stats(t.prs, t.repos)))
    out = through_store(old, tot, ["username"], lambda o, n: U.sync_legacy_users(o, n, u, A.as_of_col()))
    return rounded(out.select("username", "name", "website_url", "score", "followers", "public_repos",
                              "linkedin", "created_at", "last_fetched"), "score")


@register("sync_leaderboard", with_ctes(f"""
SELECT u.username, CASE WHEN t.username IS NOT NULL THEN u.name ELSE lower(u.name) END AS name,
  round(CASE WHEN t.username IS NOT NULL THEN t.total_score ELSE 0.0 END, 4) AS total_score,
  CASE WHEN t.username IS NOT NULL THEN {AS_OF_SQL} ELSE u.scraped_at END AS updated_at,
  CASE WHEN u.user_key % 3 <> 0 THEN u.location END AS location,
  CASE WHEN u.user_key % 3 <> 0 THEN s.is_open_to_work END AS is_open_to_work,
  CASE WHEN u.user_key % 3 <> 0 THEN coalesce(u.hireable, FALSE) ELSE FALSE END AS hireable,
  CASE WHEN u.user_key % 3 <> 0 THEN 1.5 ELSE 0.0 END::DOUBLE AS ai_score
FROM a_users u LEFT JOIN totals t ON u.username = t.username LEFT JOIN a_state s ON u.username = s.username
WHERE u.user_key % 3 <> 0 OR t.username IS NOT NULL""",
    "a_users", "a_repos", "a_prs", "a_state", extra=SCORED_T))
def q_sync_leaderboard(spark, sf_dir):
    """K7: only name, avatar, total_score and updated_at are written; location and the
    enrichment columns of the existing rows are untouched."""
    t = Tables(spark, sf_dir)
    old = t.users.where("user_key % 3 <> 0").join(t.state, "username", "left").select(
        "username", F.lower("name").alias("name"), "avatar_url", F.lit(0.0).alias("total_score"),
        F.col("scraped_at").alias("updated_at"), "location", "is_open_to_work",
        F.coalesce("hireable", F.lit(False)).alias("hireable"), F.lit(1.5).alias("ai_score"))
    tot = S.user_scores(S.user_repo_scores(S.user_repo_stats(t.prs, t.repos)))
    out = through_store(old, tot, ["username"], lambda o, n: U.sync_leaderboard(o, n, t.users, A.as_of_col()))
    return rounded(out.select("username", "name", "total_score", "updated_at", "location", "is_open_to_work",
                              "hireable", "ai_score"), "total_score")


# ------------------------------------------------------------------ landing table
def landed_responses(t: Tables):
    """Landing rows from the attempts: the member lookup key, the body, arrival order."""
    return t.attempts.select(F.concat(F.lit("member:"), "username").alias("cache_key"),
                             F.col("body").alias("response"), "seq")


@register("upsert_responses", with_ctes(f"""
SELECT cache_key, response, moment AS cached_at, moment + INTERVAL 30 DAY AS expires_at FROM (
  SELECT 'member:' || username AS cache_key, body AS response,
    CASE seq % 2 WHEN 0 THEN {AS_OF_SQL} - INTERVAL 1 DAY ELSE {AS_OF_SQL} END AS moment,
    row_number() OVER (PARTITION BY username ORDER BY seq % 2 DESC, seq DESC) AS rn FROM a_attempts) WHERE rn = 1""",
    "a_attempts"))
def q_upsert_responses(spark, sf_dir):
    """K9 with the TTL arithmetic X6, in two batches a day apart; a key of the second
    replaces the stored response of the first."""
    landed = landed_responses(Tables(spark, sf_dir))
    half = F.col("seq") % 2 == 0
    old = U.upsert_responses(None, landed.where(half), F.timestamp_add("DAY", F.lit(-1), A.as_of_col()))
    return through_store(old, landed.where(~half), ["cache_key"], lambda o, n: U.upsert_responses(o, n, A.as_of_col()))


RESP_SQL = """SELECT 'event:' || CAST(event_id AS VARCHAR) AS cache_key, props AS response, ts AS cached_at,
  ts + INTERVAL 30 DAY AS expires_at FROM events"""


def response_table(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "props")
    return e.select(F.concat(F.lit("event:"), F.col("event_id").cast("string")).alias("cache_key"),
                    F.col("props").alias("response"), F.col("ts").alias("cached_at"),
                    F.timestamp_add("DAY", F.lit(D.RESPONSE_TTL_DAYS), "ts").alias("expires_at"))


def landing_store(spark, sf_dir):
    return Store.of(response_table(spark, sf_dir), scratch_path(spark, "landing"), day_part("expires_at"))


@register("purge_expired", with_ctes(f"SELECT * FROM resp WHERE expires_at >= {AS_OF_SQL}", extra={"resp": RESP_SQL}))
def q_purge_expired(spark, sf_dir):
    """K10 on the landing table in parts by day of expiry: expired days are dropped unread."""
    store = landing_store(spark, sf_dir)
    U.purge_expired_parts(store, A.as_of_col())
    return store.read()


@register("live_responses", with_ctes(f"SELECT * FROM resp WHERE expires_at > {AS_OF_SQL}", extra={"resp": RESP_SQL}))
def q_live_responses(spark, sf_dir):
    """F7 on the same table: only days of expiry from the present one on are read."""
    return U.live_parts(landing_store(spark, sf_dir), A.as_of_col())


@register("evolve_schema", with_ctes("""
SELECT b.username, round(b.total_score, 4) AS total_score, s.is_open_to_work, CAST(NULL AS TIMESTAMP) AS otw_scraped_at,
  FALSE AS otw_permanent_failure, CAST(NULL AS VARCHAR) AS otw_error_code
FROM board b LEFT JOIN a_state s ON b.username = s.username""", "a_users", "a_repos", "a_prs", "a_state",
    extra={**SCORED_T, "board": "SELECT t.username, t.total_score FROM totals t JOIN a_users u ON t.username = u.username"}))
def q_evolve_schema(spark, sf_dir):
    """Add the enrichment columns only where missing."""
    t = Tables(spark, sf_dir)
    b = S.leaderboard(t.prs, t.repos, t.users).select("username", "total_score").join(
        t.state.select("username", "is_open_to_work"), "username", "left")
    out = U.evolve_schema(b, {"is_open_to_work": "boolean", "otw_scraped_at": "timestamp_ntz",
                              "otw_permanent_failure": ("boolean", False), "otw_error_code": "string"})
    return rounded(out, "total_score")


# ------------------------------------------------------------------ key audit
def audit_sql(name, src, keys):
    k = ", ".join(keys)
    nul = " OR ".join(f"{x} IS NULL" for x in keys)
    return f"""SELECT '{name}' AS table_name, '{",".join(keys)}' AS key_columns, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows,
  count(*) FILTER (WHERE n > 1) AS duplicated_keys, CAST(coalesce(sum(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS extra_rows,
  CAST(coalesce(sum(n) FILTER (WHERE {nul}), 0) AS BIGINT) AS null_key_rows
FROM (SELECT {k}, count(*) AS n FROM {src} GROUP BY {k})"""


AUDITS = [("github_users", "a_users", ["username"]), ("github_repos", "a_repos", ["repo_name"]),
          ("github_repos_short", "a_repos", ["short_name"]), ("landed_pull_requests", "a_raw_prs", ["id"]),
          ("github_pull_requests", "a_prs", ["id"]), ("user_repo_scores", "stats", ["username", "repo_name"])]


@register("check_keys", with_ctes(" UNION ALL ".join(audit_sql(*a) for a in AUDITS),
                                    "a_users", "a_repos", "a_prs", "a_raw_prs", extra={"stats": STATS_SQL}))
def q_check_keys(spark, sf_dir):
    t = Tables(spark, sf_dir)
    tabs = {"github_users": (t.users, ["username"]), "github_repos": (t.repos, ["repo_name"]),
            "github_repos_short": (t.repos, ["short_name"]), "landed_pull_requests": (t.raw_prs, ["id"]),
            "github_pull_requests": (t.prs, ["id"]),
            "user_repo_scores": (S.user_repo_stats(t.prs, t.repos), ["username", "repo_name"])}
    return QU.check_keys(tabs)


@register("scan_tables", with_ctes("""
SELECT username, name, avatar_url, bio, followers, following, public_repos, blog, location, email, twitter_username,
  company, hireable, created_at, scraped_at FROM a_users""", "a_users"))
def q_scan_tables(spark, sf_dir):
    """The stored ``github_users`` table scanned with its declared schema (columns
    outside the schema are pruned at the scan)."""
    from ..sources.schemas import SCHEMAS
    from .registry import stored_path
    return spark.read.schema(SCHEMAS["github_users"]).parquet(stored_path(spark, sf_dir, "users"))


# ------------------------------------------------------------------ freshness / cache
@register("fresh_users", with_ctes(f"""
SELECT username, scraped_at FROM a_users WHERE scraped_at > {AS_OF_SQL} - INTERVAL 30 DAY""", "a_users"))
def q_fresh_users(spark, sf_dir):
    """F8: ``now - scraped_at < 30 days``; a null time is stale."""
    from ..operators.cache import fresh_users
    return fresh_users(Tables(spark, sf_dir).users, A.as_of_col()).select("username", "scraped_at")


@register("cached_profile", with_ctes(f"""
SELECT username AS login, name, avatar_url, 'https://github.com/' || username AS url, company, blog, location, email,
  bio, twitter_username, CAST(NULL AS VARCHAR) AS linkedin, hireable AS is_hireable, blog AS website_url,
  followers, following, 0 AS repo_count, 0 AS contribution_count, '' AS unique_skills
FROM a_users WHERE scraped_at > {AS_OF_SQL} - INTERVAL 30 DAY""", "a_users"))
def q_cached_profile(spark, sf_dir):
    """A fresh stored user turned back into a profile, with no repositories."""
    from ..operators.cache import cached_profile, fresh_users
    return cached_profile(fresh_users(Tables(spark, sf_dir).users, A.as_of_col()))


# ------------------------------------------------------------------ stage 1
NEWEST = {"newest": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY repo_name
             ORDER BY created_at DESC, id) AS nth FROM (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER
               (PARTITION BY repo_name, id ORDER BY s_a DESC, s_b DESC, s_c DESC) AS k FROM a_raw_prs) WHERE k = 1))
             WHERE nth <= 100"""}


def newest_prs(t: Tables):
    from ..operators.ingest import newest_prs_per_repo
    return newest_prs_per_repo(t.raw_prs)


@register("newest_prs_per_repo", with_ctes("SELECT repo_name, id, username, created_at, nth FROM newest",
                                             "a_raw_prs", extra=NEWEST))
def q_newest_prs_per_repo(spark, sf_dir):
    return newest_prs(Tables(spark, sf_dir)).select("repo_name", "id", "username", "created_at",
                                                    F.col("nth").cast("long").alias("nth"))


@register("user_prs_in_repo", with_ctes("""
SELECT q.username, n.id, n.repo_name FROM (SELECT DISTINCT username, full_name FROM uni WHERE stars >= 10) q
JOIN newest n ON n.repo_name = q.full_name AND lower(n.username) = lower(q.username)""",
    "a_users", "a_repos", "a_prs", "a_raw_prs", extra={**Q4_CTES, **NEWEST}))
def q_user_prs_in_repo(spark, sf_dir):
    """F1 + T3 + F2: for every user, their qualifying repos' newest 100 merged PRs
    authored by them (case-insensitive)."""
    from ..operators.analysis import user_repo_candidates, user_repos_union
    from ..operators.ingest import user_prs_in_repo
    t = Tables(spark, sf_dir)
    uni = user_repos_union(user_repo_candidates(t.users, t.repos, t.prs))
    return user_prs_in_repo(uni, newest_prs(t)).select("username", "id", "repo_name")
