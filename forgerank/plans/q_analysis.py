"""Stage-4 analysis (Q2), user analysis from repo lists (Q4) and model A (Q3)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..operators import analysis as AN
from ..operators import scoring as S
from .adapter_sql import with_ctes
from .q_scoring import level_sql
from .registry import Tables, register, rounded

E = "CAST([] AS VARCHAR[])"


def sql_list(xs) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


def substr_cats_sql(words: str) -> str:
    parts = []
    for cat, kws in D.CATEGORIES_SUBSTRING.items():
        parts.append(f"CASE WHEN len(list_filter({words}, lambda w: len(list_filter({sql_list(kws)}, "
                     f"lambda k: contains(w, k))) > 0)) > 0 THEN '{cat}' END")
    return "list_filter([" + ", ".join(parts) + "], lambda x: x IS NOT NULL)"


WORDS4 = (f"list_transform(list_concat(coalesce(topics, {E}), CASE WHEN primary_language IS NOT NULL "
          f"AND primary_language <> '' THEN [lower(primary_language)] ELSE {E} END), lambda s: lower(s))")


def exact_cats_sql() -> str:
    low = f"list_transform(coalesce(topics, {E}), lambda t: lower(t))"
    hits = [f"CASE WHEN list_has_any({low}, {sql_list(kws)}) THEN '{cat}' END"
            for cat, kws in D.CATEGORIES_EXACT.items()]
    by_topic = "list_filter([" + ", ".join(hits) + "], lambda x: x IS NOT NULL)"
    hint = "CASE primary_language " + " ".join(
        f"WHEN '{k}' THEN '{v}'" for k, v in D.LANGUAGE_HINTS.items()) + " END"
    return (f"CASE WHEN len({by_topic}) > 0 THEN {by_topic} WHEN primary_language IS NOT NULL AND "
            f"primary_language <> '' AND ({hint}) IS NOT NULL THEN [{hint}] ELSE {E} END")


# ------------------------------------------------------------------ stage 4 SQL
def stage4_ctes(pr_key: str = "short") -> dict:
    key = "o.repo_name" if pr_key == "short" else "o.owner_login || '/' || o.repo_name"
    cats4 = substr_cats_sql(WORDS4)
    sums = ", ".join(f"sum(CASE WHEN list_contains(categories, '{c}') THEN share ELSE 0.0 END) AS {c}_score"
                     for c in D.CATEGORIES_SUBSTRING)
    return {
        "owned": "SELECT * FROM a_repos WHERE owner_login IN (SELECT username FROM a_users)",
        "cnt": "SELECT username AS owner_login, repo_name AS pr_repo, CAST(count(*) AS INTEGER) AS prs FROM a_prs GROUP BY 1, 2",
        "rp": f"""SELECT o.owner_login, o.repo_name, o.stars, o.primary_language, o.topics,
                    coalesce(c.prs, 0) AS prs FROM owned o LEFT JOIN cnt c
                    ON c.owner_login = o.owner_login AND c.pr_repo = {key}""",
        "sc": f"""SELECT *, ln(CAST(stars AS DOUBLE) + 1.0) * 10.0 + CAST(prs AS DOUBLE) * 5.0 AS score,
                    {cats4} AS categories FROM rp""",
        "sc2": "SELECT *, CASE WHEN len(categories) > 0 THEN score / len(categories) END AS share FROM sc",
        "sums": f"SELECT owner_login, {sums}, CAST(sum(prs) AS INTEGER) AS contribution_count FROM sc2 GROUP BY 1",
        "top4": """SELECT owner_login, repo_name, score, row_number() OVER (PARTITION BY owner_login
                    ORDER BY score DESC, repo_name) AS pos FROM sc2""",
        "topagg": "SELECT owner_login, string_agg(repo_name, ',' ORDER BY pos) AS top_repos FROM top4 WHERE pos <= 5 GROUP BY 1",
        "langs": """SELECT owner_login, string_agg(primary_language || ':' || CAST(n AS VARCHAR), ','
                    ORDER BY primary_language, n) AS languages FROM (SELECT owner_login, primary_language,
                    count(*) AS n FROM sc2 WHERE primary_language IS NOT NULL AND primary_language <> ''
                    GROUP BY 1, 2) GROUP BY 1""",
        "tskills": f"""SELECT owner_login, string_agg(skill, ',' ORDER BY skill) AS unique_skills FROM (
                    SELECT owner_login, skill, row_number() OVER (PARTITION BY owner_login ORDER BY skill) AS rn
                    FROM (SELECT DISTINCT owner_login, lower(t) AS skill FROM sc2, unnest(coalesce(topics, {E})) AS u(t)))
                    WHERE rn <= 10 GROUP BY 1""",
    }


def analyze_sql(pr_key: str) -> str:
    total = " + ".join(f"s.{c}_score" for c in D.CATEGORIES_SUBSTRING)
    cats = ", ".join(f"round(s.{c}_score, 4) AS {c}_score" for c in D.CATEGORIES_SUBSTRING)
    return with_ctes(f"""
SELECT lower(s.owner_login) AS id, s.owner_login AS username, round(0.0 + {total}, 4) AS total_score, {cats},
  coalesce(k.unique_skills, '') AS unique_skills, t.top_repos, coalesce(l.languages, '') AS languages,
  s.contribution_count, CAST(NULL AS VARCHAR) AS linkedin
FROM sums s LEFT JOIN topagg t ON s.owner_login = t.owner_login LEFT JOIN langs l ON s.owner_login = l.owner_login
LEFT JOIN tskills k ON s.owner_login = k.owner_login""", "a_users", "a_repos", "a_prs",
                     extra=stage4_ctes(pr_key))


def _analyze(pr_key):
    def run(spark, sf_dir):
        t = Tables(spark, sf_dir)
        out = AN.analyze_users(t.repos, t.prs, t.users, pr_key=pr_key)
        return rounded(out, "total_score", *[f"{c}_score" for c in D.CATEGORIES_SUBSTRING])
    return run


# Q2 -----------------------------------------------------------------------------
register("analyze_users", analyze_sql("short"))(_analyze("short"))
register("analyze_users_full_key", analyze_sql("full"))(_analyze("full"))


# K8 -----------------------------------------------------------------------------
K8_COLS = "id, username, total_score, contribution_count, unique_skills, top_repos, languages, cached_at"


def _k8_sql() -> str:
    total = "round(0.0 + " + " + ".join(f"s.{c}_score" for c in D.CATEGORIES_SUBSTRING) + ", 4)"
    moment = "TIMESTAMP '2024-02-15 00:00:00'"
    return with_ctes(f"""
SELECT lower(s.owner_login) AS id, s.owner_login AS username,
  CASE WHEN u.user_key % 3 = 0 THEN -1.0 ELSE {total} END AS total_score,
  s.contribution_count, coalesce(k.unique_skills, '') AS unique_skills, t.top_repos, coalesce(l.languages, '') AS languages,
  CASE WHEN u.user_key % 3 = 0 THEN {moment} - INTERVAL 1 DAY ELSE {moment} END AS cached_at
FROM sums s JOIN a_users u ON u.username = s.owner_login LEFT JOIN topagg t ON s.owner_login = t.owner_login
LEFT JOIN langs l ON s.owner_login = l.owner_login LEFT JOIN tskills k ON s.owner_login = k.owner_login""", "a_users", "a_repos", "a_prs", extra=stage4_ctes())


@register("upsert_analyses", _k8_sql())
def q_upsert_analyses(spark, sf_dir):
    """K8: two thirds of the users have an older stored row (total -1, a day before); two
    thirds are analysed anew, stored or not, and a third keeps its old row."""
    from ..session import shared
    from ..sources.adapter import as_of_col
    from .q_ops import through_store
    t = Tables(spark, sf_dir)
    keys = t.users.select("username", "user_key")
    rows = shared(AN.analyses_rows(t.repos, t.prs, t.users, as_of_col()).join(keys, "username"), "analyses")
    old = (rows.where("user_key % 3 = 0 or user_key % 2 = 0").drop("user_key")
           .withColumn("total_score", F.lit(-1.0)).withColumn("cached_at", F.timestamp_add("DAY", F.lit(-1), "cached_at")))
    new = rows.where("user_key % 3 <> 0").drop("user_key")
    out = AN.analyses_text(through_store(old, new, ["id"], AN.upsert_analyses))
    return rounded(out.select(*[c.strip() for c in K8_COLS.split(",")]), "total_score")


@register("categorize_substring", with_ctes(f"""
SELECT owner_login, repo_name, array_to_string({substr_cats_sql(WORDS4)}, ',') AS categories FROM a_repos""",
                                              "a_repos"))
def q_categorize_substring(spark, sf_dir):
    r = AN.categorize_substring(Tables(spark, sf_dir).repos)
    return r.select("owner_login", "repo_name", F.array_join("categories", ",").alias("categories"))


@register("categorize_by_dictionary", with_ctes(f"""
SELECT owner_login, repo_name, array_to_string({substr_cats_sql(WORDS4)}, ',') AS categories FROM a_repos""",
                                                 "a_repos"))
def q_categorize_by_dictionary(spark, sf_dir):
    """J7 with the dictionary as a table of (position, category, keyword)."""
    from ..operators.patterns import categorize_by_dictionary
    words = [(i, c, k) for i, (c, kws) in enumerate(D.CATEGORIES_SUBSTRING.items()) for k in kws]
    dictionary = spark.createDataFrame(words, "position int, category string, keyword string")
    r = categorize_by_dictionary(Tables(spark, sf_dir).repos, dictionary)
    return r.select("owner_login", "repo_name", F.array_join("categories", ",").alias("categories"))


@register("categorize_by_names", with_ctes("""
SELECT r.owner_login, r.repo_name, count(*) AS n_names, min(u.username) AS first_name
FROM a_repos r JOIN (SELECT DISTINCT username FROM a_users WHERE username IS NOT NULL) u
  ON contains(lower(r.owner_login || '/' || r.repo_name), lower(u.username))
GROUP BY r.owner_login, r.repo_name""", "a_users", "a_repos"))
def q_categorize_by_names(spark, sf_dir):
    """J7's substring join with a dictionary that grows with the data: every stored
    username, looked for in every repository's path."""
    from ..operators.patterns import contains_pairs
    t = Tables(spark, sf_dir)
    path = F.lower(F.concat("owner_login", F.lit("/"), "repo_name"))
    repos = t.repos.select("owner_login", "repo_name", path.alias("text"))
    names = t.users.select("username", F.lower("username").alias("pattern")).where("username is not null").distinct()
    found = contains_pairs(repos, names).join(names, "pattern")
    return (repos.join(found, "text").groupBy("owner_login", "repo_name")
            .agg(F.count(F.lit(1)).alias("n_names"), F.min("username").alias("first_name")))


@register("language_histogram", with_ctes("SELECT owner_login, languages FROM langs", "a_users", "a_repos",
                                            "a_prs", extra=stage4_ctes()))
def q_language_histogram(spark, sf_dir):
    t = Tables(spark, sf_dir)
    owned = t.repos.join(t.users.select(F.col("username").alias("owner_login")), "owner_login", "left_semi")
    return AN.language_histogram(owned.select("owner_login", "primary_language"), "owner_login")


@register("topic_skills", with_ctes("SELECT owner_login, unique_skills FROM tskills", "a_users", "a_repos",
                                      "a_prs", extra=stage4_ctes()))
def q_topic_skills(spark, sf_dir):
    t = Tables(spark, sf_dir)
    owned = t.repos.join(t.users.select(F.col("username").alias("owner_login")), "owner_login", "left_semi")
    return AN.topic_skills(owned.select("owner_login", "topics"), "owner_login").withColumnRenamed(
        "skills", "unique_skills")


@register("top_repos", with_ctes("SELECT owner_login, repo_name, round(score, 4) AS score, pos FROM top4 WHERE pos <= 5",
                                   "a_users", "a_repos", "a_prs", extra=stage4_ctes()))
def q_top_repos(spark, sf_dir):
    """Top 5 owned repos per user by the stage-4 score (WindowGroupLimit)."""
    from ..functions.columns import stage4_repo_score
    t = Tables(spark, sf_dir)
    r = AN.owned_repos_with_pr_counts(t.repos, t.prs, t.users).withColumn(
        "score", stage4_repo_score("stars", "prs"))
    w = W.partitionBy("owner_login").orderBy(F.desc("score"), F.asc("repo_name"))
    top = r.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= 5)
    return rounded(top.select("owner_login", "repo_name", "score", F.col("pos").cast("long").alias("pos")), "score")


@register("distinct_users", with_ctes("SELECT DISTINCT username FROM a_users", "a_users"))
def q_distinct_users(spark, sf_dir):
    return Tables(spark, sf_dir).users.select("username").distinct()


# ------------------------------------------------------------------ Q4 SQL
Q4_CTES = {
    "r": """SELECT owner_login, repo_name AS name, owner_login || '/' || repo_name AS full_name, stars,
              primary_language, languages, topics, total_prs FROM a_repos""",
    "owned": "SELECT r.owner_login AS username, 0 AS relation, r.* FROM r JOIN a_users u ON u.username = r.owner_login",
    "contributed": """SELECT k.username, 1 AS relation, r.* FROM (SELECT DISTINCT username, repo_name AS full_name FROM a_prs) k
              JOIN r ON r.full_name = k.full_name WHERE k.username IN (SELECT username FROM a_users)""",
    "cand": """SELECT *, row_number() OVER (PARTITION BY username, relation ORDER BY stars DESC, full_name) AS pos
              FROM (SELECT * FROM owned UNION ALL SELECT * FROM contributed)""",
    "capped": "SELECT * FROM cand WHERE pos <= 50",
    "uni": """SELECT * EXCLUDE (rr), struct_pack(relation := relation, pos := pos) AS position FROM (SELECT *, row_number() OVER
              (PARTITION BY username, full_name ORDER BY relation, pos) AS rr FROM capped) WHERE rr = 1""",
    "qual": """SELECT username, full_name FROM (SELECT username, full_name, row_number() OVER (PARTITION BY username
              ORDER BY position) AS q FROM uni WHERE stars >= 10) WHERE q <= 50""",
    "qcnt": """SELECT p.username, p.repo_name AS full_name, CAST(count(*) AS INTEGER) AS user_prs FROM a_prs p
              JOIN qual q ON q.username = p.username AND q.full_name = p.repo_name GROUP BY 1, 2""",
    "ur": """SELECT u.*, coalesce(c.user_prs, 0) AS user_prs FROM uni u LEFT JOIN qcnt c
              ON u.username = c.username AND u.full_name = c.full_name""",
}
Q4_NEED = ("a_users", "a_repos", "a_prs")


def q4(body: str, more: dict | None = None) -> str:
    extra = dict(Q4_CTES)
    extra.update(more or {})
    return with_ctes(body, *Q4_NEED, extra=extra)


def _ur(t: Tables):
    return AN.model_a_inputs(t.users, t.repos, t.prs)


@register("top_repos_by_stars", q4("SELECT username, relation, pos, full_name, stars FROM capped"))
def q_top_repos_by_stars(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return AN.user_repo_candidates(t.users, t.repos, t.prs).select(
        "username", "relation", F.col("pos").cast("long").alias("pos"), "full_name", "stars")


@register("user_repos_union", q4("SELECT username, full_name, relation, pos FROM uni"))
def q_user_repos_union(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return AN.user_repos_union(AN.user_repo_candidates(t.users, t.repos, t.prs)).select(
        "username", "full_name", "relation", F.col("pos").cast("long").alias("pos"))


@register("repo_user_pr_counts", q4("SELECT username, full_name, user_prs FROM ur"))
def q_repo_user_pr_counts(spark, sf_dir):
    return _ur(Tables(spark, sf_dir)).select("username", "full_name", "user_prs")


@register("qualifying_repos", with_ctes("""
SELECT owner_login, repo_name, stars FROM a_repos WHERE stars >= 10""", "a_repos"))
def q_qualifying_repos(spark, sf_dir):
    """the star threshold applied before any PR work."""
    return Tables(spark, sf_dir).repos.where(F.col("stars") >= D.MIN_STARS).select(
        "owner_login", "repo_name", "stars")


A11 = {
    "sk0": f"""SELECT username, position, 0 AS part, coalesce(languages, {E}) AS arr FROM ur
              UNION ALL SELECT username, position, 1 AS part, coalesce(topics, {E}) AS arr FROM ur""",
    "sk1": "SELECT username, position, part, arr, unnest(generate_series(1, len(arr))) AS i FROM sk0",
    "sk2": """SELECT username, lower(arr[i]) AS skill, part, position, i, row_number() OVER (PARTITION BY username,
              lower(arr[i]) ORDER BY part, position, i) AS rn FROM sk1""",
    "sk3": """SELECT username, string_agg(skill, ',' ORDER BY part, position, i) AS unique_skills FROM sk2
              WHERE rn = 1 AND skill <> '' GROUP BY 1""",
    "ulang": """SELECT username, string_agg(primary_language || ':' || CAST(n AS VARCHAR), ',' ORDER BY primary_language, n)
              AS languages FROM (SELECT username, primary_language, count(*) AS n FROM ur WHERE primary_language IS NOT NULL
              AND primary_language <> '' GROUP BY 1, 2) GROUP BY 1""",
    "uper": "SELECT username, count(*) AS n_repos, CAST(sum(user_prs) AS BIGINT) AS contribution_count FROM ur GROUP BY 1",
}

LINK_SQL = ("CASE WHEN nullif(regexp_extract({t}, '(?i)(?:linkedin\\.com/in/|lnkd\\.in/)([a-zA-Z0-9_-]+)', 1), '') "
            "IS NOT NULL THEN 'https://linkedin.com/in/' || regexp_extract({t}, "
            "'(?i)(?:linkedin\\.com/in/|lnkd\\.in/)([a-zA-Z0-9_-]+)', 1) END")


def link_sql(bio: str = "bio", web: str = "blog") -> str:
    return f"coalesce({LINK_SQL.format(t=bio)}, {LINK_SQL.format(t=web)})"


def profile_link_sql(user: str = "") -> str:
    """The profile link: a LINKEDIN account first, else the text of bio or website."""
    u = f"{user}." if user else ""
    return (f"CASE WHEN {u}user_key % 7 = 3 THEN 'https://www.linkedin.com/in/acct-' || CAST({u}user_key AS VARCHAR) "
            f"ELSE {link_sql(u + 'bio', u + 'blog')} END")


@register("unique_skills", q4("SELECT username, unique_skills FROM sk3", A11))
def q_unique_skills(spark, sf_dir):
    return AN.unique_skills(_ur(Tables(spark, sf_dir)))


# Q4 -----------------------------------------------------------------------------
@register("user_analysis", q4(f"""
SELECT a.username, coalesce(p.n_repos, 0) AS n_repos, coalesce(p.contribution_count, 0) AS contribution_count,
  coalesce(l.languages, '') AS languages, coalesce(s.unique_skills, '') AS unique_skills,
  {profile_link_sql('a')} AS linkedin
FROM a_users a LEFT JOIN uper p ON a.username = p.username LEFT JOIN ulang l ON a.username = l.username
LEFT JOIN sk3 s ON a.username = s.username""", A11))
def q_user_analysis(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return AN.user_analysis(t.users, t.repos, t.prs)


# ------------------------------------------------------------------ model A SQL
def model_a_ctes() -> dict:
    sums = ", ".join(f"sum(CASE WHEN list_contains(categories, '{c}') THEN score ELSE 0.0 END) AS {c.lower()}_score"
                     for c in D.CATEGORIES_EXACT)
    terms = (f"list_distinct(list_transform(list_concat(CASE WHEN primary_language IS NOT NULL AND primary_language <> '' "
             f"THEN [primary_language] ELSE {E} END, coalesce(languages, {E}), coalesce(topics, {E})), lambda x: lower(x)))")
    return {
        "ma": """SELECT *, CASE WHEN coalesce(stars, 0) >= 10 AND coalesce(total_prs > 0, FALSE) THEN
                  least(CAST(coalesce(stars, 0) AS DOUBLE) * (CAST(user_prs AS DOUBLE) / CAST(total_prs AS DOUBLE)), 10000.0)
                  ELSE 0.0 END AS score FROM ur""",
        "mpos": f"SELECT *, {exact_cats_sql()} AS categories FROM ma WHERE score > 0",
        "msums": f"SELECT username, sum(score) AS total_score, {sums} FROM mpos GROUP BY 1",
        "mtop": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY username ORDER BY score DESC, full_name)
                  AS tpos FROM mpos) WHERE tpos <= 10""",
        "mtopagg": "SELECT username, string_agg(full_name, ',' ORDER BY tpos) AS top_repos FROM mtop GROUP BY 1",
        "mlangs": """SELECT username, string_agg(primary_language || ':' || CAST(n AS VARCHAR), ',' ORDER BY primary_language, n)
                  AS languages FROM (SELECT username, primary_language, count(*) AS n FROM mtop WHERE primary_language IS NOT NULL
                  AND primary_language <> '' GROUP BY 1, 2) GROUP BY 1""",
        "mterms": f"SELECT username, unnest({terms}) AS skill FROM ur WHERE user_prs > 0",
        "mskills": """SELECT username, string_agg(skill, ',' ORDER BY rn) AS unique_skills FROM (SELECT username, skill,
                  row_number() OVER (PARTITION BY username ORDER BY n DESC, skill) AS rn FROM (SELECT username, skill,
                  count(*) AS n FROM mterms GROUP BY 1, 2)) WHERE rn <= 10 GROUP BY 1""",
        "musers": "SELECT DISTINCT username FROM ur",
    }


MA_SCORES = ["total_score"] + [f"{c.lower()}_score" for c in D.CATEGORIES_EXACT]


# Q3 -----------------------------------------------------------------------------
@register("score_users", q4(f"""
SELECT u.username, {', '.join(f'round(coalesce(s.{c}, 0.0), 4) AS {c}' for c in MA_SCORES)},
  {level_sql('coalesce(s.total_score, 0.0)')} AS experience_level,
  coalesce(t.top_repos, '') AS top_repos, coalesce(l.languages, '') AS languages,
  coalesce(k.unique_skills, '') AS unique_skills
FROM musers u LEFT JOIN msums s ON u.username = s.username LEFT JOIN mtopagg t ON u.username = t.username
LEFT JOIN mlangs l ON u.username = l.username LEFT JOIN mskills k ON u.username = k.username""", model_a_ctes()))
def q_score_users(spark, sf_dir):
    return rounded(S.score_users(_ur(Tables(spark, sf_dir))), *MA_SCORES)


@register("categorize_exact", with_ctes(f"""
SELECT owner_login, repo_name, array_to_string({exact_cats_sql()}, ',') AS categories FROM a_repos""", "a_repos"))
def q_categorize_exact(spark, sf_dir):
    r = S.categorize_exact(Tables(spark, sf_dir).repos)
    return r.select("owner_login", "repo_name", F.array_join("categories", ",").alias("categories"))


@register("top_skills", q4("SELECT username, unique_skills FROM mskills", model_a_ctes()))
def q_top_skills(spark, sf_dir):
    return S.top_skills_by_frequency(_ur(Tables(spark, sf_dir))).withColumnRenamed("skills", "unique_skills")


@register("language_histogram_top", q4("SELECT username, languages FROM mlangs", model_a_ctes()))
def q_language_histogram_top(spark, sf_dir):
    """Histogram over each user's model-A top 10 only."""
    ur = _ur(Tables(spark, sf_dir))
    from ..functions.columns import repo_score
    r = ur.withColumn("score", repo_score("user_prs", "total_prs", "stars", min_stars=D.MIN_STARS)) \
          .where(F.col("score") > 0)
    w = W.partitionBy("username").orderBy(F.desc("score"), F.asc("full_name"))
    top = r.withColumn("tpos", F.row_number().over(w)).where(F.col("tpos") <= D.TOP_REPOS_MODEL_A)
    return AN.language_histogram(top.select("username", "primary_language"))
