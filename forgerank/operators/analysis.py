"""Stage-4 skill analysis (Q2) and the payload-based user analysis (Q4).

Per-user loops of the reference become group keys. Everything per user is a
grouped aggregate (partial, skew safe) or a top-N window that Spark prunes with
WindowGroupLimit before the shuffle; the per-user frames are then joined on the
user key, each holding at most one row per user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions.columns import stage4_repo_score
from .scoring import full_name



def arr0():
    return F.array().cast("array<string>")


# J7 -------------------------------------------------------------------------------
def substring_categories(topics: Column, language: Column,
                         categories=D.CATEGORIES_SUBSTRING) -> Column:
    """Category names (dictionary order) where any lower-cased topic or language
    contains any keyword. Literal arrays inside nested ``exists``: no join."""
    words = F.transform(F.concat(F.coalesce(topics, arr0()),
                                 F.when(language.isNotNull() & (language != ""),
                                        F.array(F.lower(language))).otherwise(arr0())),
                        lambda s: F.lower(s))
    hits = []
    for cat, kws in categories.items():
        kw = F.array(*[F.lit(k) for k in kws])
        hit = F.exists(words, lambda w: F.exists(kw, lambda k: w.contains(k)))
        hits.append(F.when(hit, F.lit(cat)))
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


def categorize_substring(repos: DataFrame, categories=D.CATEGORIES_SUBSTRING) -> DataFrame:
    return repos.withColumn("categories", substring_categories(
        F.col("topics"), F.col("primary_language"), categories))


# J2 -------------------------------------------------------------------------------
def owned_repos_with_pr_counts(repos: DataFrame, prs: DataFrame, users: DataFrame,
                               pr_key: str = "short") -> DataFrame:
    """Repos owned by each listed user with that user's PR count for the repo.

    The reference keys PRs by ``owner/name`` but looks them up by the short name,
    so the count is 0 (``pr_key="short"``, default, D1); ``"full"`` looks them up
    by ``owner/name``."""
    listed = users.select(F.col("username").alias("owner_login")).distinct()
    owned = repos.join(listed, "owner_login", "left_semi")
    counts = (prs.groupBy(F.col("username").alias("owner_login"),
                          F.col("repo_name").alias("pr_repo"))
                 .agg(F.count(F.lit(1)).cast("int").alias("prs")))
    key = F.col("repo_name") if pr_key == "short" else full_name()
    j = owned.withColumn("pr_repo", key).join(counts, ["owner_login", "pr_repo"], "left")
    return j.withColumn("prs", F.coalesce("prs", F.lit(0))).drop("pr_repo")


def analyze_users(repos: DataFrame, prs: DataFrame, users: DataFrame, pr_key: str = "short",
                  top_n: int = D.TOP_REPOS_STAGE4, top_skills: int = D.TOP_SKILLS,
                  categories=D.CATEGORIES_SUBSTRING) -> DataFrame:
    """Q2 with lists as text: the stored rows (``analyses_rows``), their arrays joined by
    commas. Users without repos get no row."""
    rows = analyses_rows(repos, prs, users, F.lit(None).cast("timestamp_ntz"), pr_key, categories, top_n, top_skills)
    return analyses_text(rows).drop("cached_at")


def analyses_text(rows: DataFrame) -> DataFrame:
    """Stored analyses with skills, top repositories (names) and languages as text."""
    langs = F.array_sort(F.map_entries("languages"))
    return rows.withColumns({
        "unique_skills": F.array_join("unique_skills", ","),
        "top_repos": F.array_join(F.transform("top_repos", lambda x: x["name"]), ","),
        "languages": F.array_join(F.transform(langs, lambda x: F.concat(x["key"], F.lit(":"), x["value"].cast("string"))), ",")})


# A7 / A8 --------------------------------------------------------------------------
def language_histogram(rows: DataFrame, user: str = "username",
                       as_text: bool = True) -> DataFrame:
    """Two-pass histogram: (user, language) counts, then one map/text per user.
    Empty or null languages are skipped; the key keeps its case."""
    per = (rows.where(F.col("primary_language").isNotNull() & (F.col("primary_language") != ""))
               .groupBy(user, "primary_language").agg(F.count(F.lit(1)).alias("n")))
    entries = F.array_sort(F.collect_list(F.struct(
        F.col("primary_language").alias("k"), F.col("n").cast("int").alias("v"))))
    agg = per.groupBy(user).agg(entries.alias("e"))
    if as_text:
        return agg.select(user, F.array_join(F.transform(
            "e", lambda x: F.concat(x["k"], F.lit(":"), x["v"].cast("string"))), ",")
            .alias("languages"))
    return agg.select(user, F.map_from_entries("e").alias("languages"))


# A10 ------------------------------------------------------------------------------
def topic_skills(rows: DataFrame, user: str = "username", n: int = D.TOP_SKILLS) -> DataFrame:
    """Distinct lower-cased topics, alphabetical, first n. Distinct (user, topic)
    rows, then a top-n window, so no unbounded set is collected."""
    t = (rows.select(user, F.explode(F.coalesce("topics", arr0())).alias("t"))
             .select(user, F.lower("t").alias("skill")).distinct())
    w = W.partitionBy(user).orderBy("skill")
    top = t.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= n)
    return top.groupBy(user).agg(F.array_join(F.array_sort(F.collect_list("skill")), ",")
                                 .alias("skills"))


# T4 + U1 --------------------------------------------------------------------------
REPO_FIELDS = ["owner_login", "name", "full_name", "stars", "primary_language", "languages",
               "topics", "total_prs", "is_fork", "pushed_at"]


def top_repos_by_stars(rows: DataFrame, cap: int | Column, most: int | None = None) -> DataFrame:
    """T4: per (user, relation) the ``cap`` repos with most stars (payload order). A cap that
    depends on the row comes with its largest value, ``most``."""
    w = W.partitionBy("username", "relation").orderBy(F.desc("stars"), F.asc("full_name"))
    top = rows.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= (cap if most is None else most))
    return top if most is None else top.where(F.col("pos") <= cap)


def pr_pair_counts(prs: DataFrame) -> DataFrame:
    """Merged PRs per (user, ``owner/name``): one partial aggregation over the PR table."""
    return prs.groupBy("username", F.col("repo_name").alias("full_name")).agg(
        F.count(F.lit(1)).cast("int").alias("user_prs"))


def user_repo_candidates(users: DataFrame, repos: DataFrame, prs: DataFrame,
                         owned_cap: int = D.OWNED_REPOS_CAP,
                         contributed_cap: int = D.CONTRIBUTED_REPOS_CAP,
                         pairs: DataFrame | None = None) -> DataFrame:
    """The two repository lists of each user's payload: owned (relation 0) and
    contributed to (relation 1), each the top 50 by stars. ``pairs`` (``pr_pair_counts``)
    takes the place of ``prs`` and adds the pair's ``user_prs``, null without any.

    Both lists are dealt by user once; the windows here and in what follows need no other order of rows."""
    r = repos.select(F.col("owner_login"), F.col("repo_name").alias("name"),
                     full_name().alias("full_name"), "stars", "primary_language", "languages",
                     "topics", "total_prs", "is_fork", "pushed_at")
    owned = (r.join(users.select(F.col("username").alias("owner_login")), "owner_login", "inner")
              .withColumn("username", F.col("owner_login")).withColumn("relation", F.lit(0)))
    cols = ["username", "relation", *REPO_FIELDS]
    if pairs is None:
        contrib_keys = prs.select("username", F.col("repo_name").alias("full_name")).distinct()
    else:
        contrib_keys = pairs.select("username", "full_name", "user_prs")
        # A user's own repositories have the user's name in front.
        own = contrib_keys.where(F.col("full_name").startswith(F.concat("username", F.lit("/"))))
        owned = owned.join(own, ["username", "full_name"], "left")
        cols.append("user_prs")
    contributed = contrib_keys.join(r, "full_name").withColumn("relation", F.lit(1))
    both = owned.select(*cols).unionByName(contributed.select(*cols)).repartition("username")
    both = both.join(users.select("username"), "username", "left_semi").select(*cols)
    cap = F.when(F.col("relation") == 0, owned_cap).otherwise(contributed_cap)
    return top_repos_by_stars(both, cap, max(owned_cap, contributed_cap))


def user_repos_union(candidates: DataFrame) -> DataFrame:
    """Owned ++ contributed, first per ``owner/name`` wins, order kept
    (``position`` = payload order)."""
    w = W.partitionBy("username", "full_name").orderBy("relation", "pos")
    first = (candidates.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r"))
    return first.withColumn("position", F.struct("relation", "pos"))


# J4 + F1 + T5 ---------------------------------------------------------------------
def repo_user_pr_counts(user_repos: DataFrame, prs: DataFrame | None,
                        min_stars: int = D.MIN_STARS, cap: int = D.QUALIFYING_REPOS_CAP) -> DataFrame:
    """The user's merged PRs searched in the first 50 qualifying (>= 10 stars) repos,
    counted per repo and left-joined back to all repos (0 when absent). Without ``prs``
    the rows hold the pair's count, ``user_prs``, already."""
    if prs is not None:
        user_repos = user_repos.join(pr_pair_counts(prs), ["username", "full_name"], "left")
    qualifies = F.col("stars") >= min_stars
    w = W.partitionBy("username").orderBy("position").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = user_repos.withColumn("__q", F.count(F.when(qualifies, 1)).over(w))
    searched = qualifies & (F.col("__q") <= cap)
    return ranked.withColumn("user_prs", F.when(searched, F.coalesce("user_prs", F.lit(0))).otherwise(F.lit(0))).drop("__q")


# A11 ------------------------------------------------------------------------------
def unique_skills(user_repos: DataFrame) -> DataFrame:
    """All languages then all topics, lower-cased, empties removed, first seen order.
    A user has as many repos as the lists' caps allow, so they are one array."""
    rows = user_repos.groupBy("username").agg(F.array_sort(F.collect_list(F.struct(
        "position", F.coalesce("languages", arr0()).alias("l"), F.coalesce("topics", arr0()).alias("t")))).alias("r"))
    words = F.concat(F.flatten(F.transform("r", lambda x: x["l"])), F.flatten(F.transform("r", lambda x: x["t"])))
    found = F.array_distinct(F.filter(F.transform(words, lambda x: F.lower(x)), lambda x: x != ""))
    return rows.select("username", found.alias("s")).where(F.size("s") > 0).select(
        "username", F.array_join("s", ",").alias("unique_skills"))


def user_analysis(users: DataFrame, repos: DataFrame, prs: DataFrame) -> DataFrame:
    """Q4: per user the deduplicated repos, PR counts (J4), language histogram over
    all repos (A7), contribution count (A12), unique skills (A11), profile link (X1)."""
    from ..functions.columns import extract_link
    from ..session import shared
    ur = shared(model_a_inputs(users, repos, prs), "user_repos")
    per = ur.groupBy("username").agg(F.count(F.lit(1)).alias("n_repos"),
                                     F.sum("user_prs").cast("long").alias("contribution_count"))
    langs = language_histogram(ur.select("username", "primary_language"))
    skills = unique_skills(ur)
    prof = users.select("username", extract_link(F.col("social_accounts"), F.col("bio"), F.col("blog")).alias("linkedin"))
    out = (prof.join(per, "username", "left").join(langs, "username", "left")
               .join(skills, "username", "left"))
    return out.select(
        "username",
        F.coalesce("n_repos", F.lit(0)).alias("n_repos"),
        F.coalesce("contribution_count", F.lit(0)).alias("contribution_count"),
        F.coalesce("languages", F.lit("")).alias("languages"),
        F.coalesce("unique_skills", F.lit("")).alias("unique_skills"),
        "linkedin")


def model_a_inputs(users: DataFrame, repos: DataFrame, prs: DataFrame) -> DataFrame:
    """Per-user repo rows of Q4 in the shape ``score_users`` takes. Counts travel with the
    pairs, and both lists are dealt by user once: capping, union and search are windows there."""
    from ..session import shared
    # Read twice: by the contributed lists, and by the owned ones for the owner's own.
    pairs = shared(pr_pair_counts(prs), "pr_pairs")
    union = user_repos_union(user_repo_candidates(users, repos, prs, pairs=pairs))
    return repo_user_pr_counts(union, None)


# K8 + X16 ---------------------------------------------------------------------------
def analyses_rows(repos: DataFrame, prs: DataFrame, users: DataFrame, as_of: Column,
                  pr_key: str = "short", categories=D.CATEGORIES_SUBSTRING,
                  top_n: int = D.TOP_REPOS_STAGE4, top_skills: int = D.TOP_SKILLS) -> DataFrame:
    """Q2 in the stored ``analyses`` shape: per owner, split-credit category sums, the
    first topics alphabetically as an array, the top repos as an array of structs (name,
    owner, stars, prs, score, categories), languages as a map, contribution count,
    ``linkedin`` null, ``cached_at`` = as_of."""
    from ..session import shared
    r = categorize_substring(owned_repos_with_pr_counts(repos, prs, users, pr_key), categories)
    r = shared(r.withColumn("score", stage4_repo_score("stars", "prs")).withColumn(
        "share", F.when(F.size("categories") > 0, F.col("score") / F.size("categories"))), "stage4_repos")
    sums = r.groupBy("owner_login").agg(
        *[F.sum(F.when(F.array_contains("categories", c), F.col("share")).otherwise(0.0))
          .alias(f"{c}_score") for c in categories],
        F.sum("prs").cast("int").alias("contribution_count"))
    w = W.partitionBy("owner_login").orderBy(F.desc("score"), F.asc("repo_name"))
    item = F.struct(F.col("repo_name").alias("name"), F.col("owner_login").alias("owner"),
                    F.col("stars").cast("int").alias("stars"), F.col("prs").alias("prs"),
                    F.col("score").alias("score"), F.col("categories").alias("categories"))
    top = (r.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= top_n)
            .groupBy("owner_login").agg(F.array_sort(F.collect_list(F.struct("pos", item.alias("i"))))
                                        .alias("t")))
    langs = language_histogram(r.select("owner_login", "primary_language"), "owner_login", as_text=False)
    skills = topic_skills(r.select("owner_login", "topics"), "owner_login", top_skills)
    out = (sums.join(top, "owner_login", "left").join(langs, "owner_login", "left")
               .join(skills, "owner_login", "left"))
    total = sum((F.col(f"{c}_score") for c in categories), F.lit(0.0))
    return out.select(
        F.lower("owner_login").alias("id"), F.col("owner_login").alias("username"),
        total.alias("total_score"), *[F.col(f"{c}_score") for c in categories],
        F.coalesce(F.split("skills", ","), arr0()).alias("unique_skills"),
        F.lit(None).cast("string").alias("linkedin"),
        F.transform("t", lambda x: x["i"]).alias("top_repos"),
        F.coalesce("languages", F.create_map().cast("map<string,int>")).alias("languages"),
        "contribution_count", as_of.alias("cached_at"))


def upsert_analyses(old: DataFrame | None, rows: DataFrame) -> DataFrame:
    """K8: keyed on ``id`` = lower(username); every column replaced."""
    from .upsert import upsert
    return upsert(old, rows, ["id"], [F.col("cached_at")])
