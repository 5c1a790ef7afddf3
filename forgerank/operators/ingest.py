"""Landed payloads -> rows (S2-S6), the request key (X5) and the stage-1 PR
selection (T3, F2).

Payloads are JSON text, one document per row. Parsing is ``from_json`` with a
declared schema plus column expressions; arrays become rows with
``posexplode``. Building payloads from tables (``*_payloads``) is the landing
side, used to produce test input from the driver tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dictionaries as D
from ..functions.columns import extract_link, request_key

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# ------------------------------------------------------------------ schemas
COUNT = T.StructType([T.StructField("totalCount", T.IntegerType())])
NAME = T.StructType([T.StructField("name", T.StringType())])
LOGIN = T.StructType([T.StructField("login", T.StringType())])

PROFILE = T.StructType([T.StructField("user", T.StructType([
    T.StructField("login", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("avatarUrl", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("bio", T.StringType()), T.StructField("followers", COUNT),
    T.StructField("following", COUNT), T.StructField("createdAt", T.StringType()),
    T.StructField("updatedAt", T.StringType()), T.StructField("isHireable", T.BooleanType()),
    T.StructField("company", T.StringType()), T.StructField("websiteUrl", T.StringType()),
    T.StructField("location", T.StringType()), T.StructField("email", T.StringType()),
    T.StructField("twitterUsername", T.StringType()),
    T.StructField("socialAccounts", T.StructType([T.StructField("nodes", T.ArrayType(T.StructType([
        T.StructField("provider", T.StringType()), T.StructField("url", T.StringType())])))])),
]))])

REPO = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("owner", LOGIN),
    T.StructField("stargazerCount", T.IntegerType()), T.StructField("primaryLanguage", NAME),
    T.StructField("pushedAt", T.StringType()), T.StructField("isFork", T.BooleanType()),
    T.StructField("pullRequests", COUNT),
    T.StructField("repositoryTopics", T.StructType([T.StructField("nodes", T.ArrayType(
        T.StructType([T.StructField("topic", NAME)])))])),
    T.StructField("languages", T.StructType([T.StructField("nodes", T.ArrayType(NAME))])),
])
NODES = lambda t: T.StructType([T.StructField("nodes", T.ArrayType(t))])
REPOS = T.StructType([T.StructField("user", T.StructType([
    T.StructField("repositories", NODES(REPO)), T.StructField("repositoriesContributedTo", NODES(REPO))]))])

PR_NODE = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("author", LOGIN), T.StructField("state", T.StringType()),
    T.StructField("mergedAt", T.StringType()), T.StructField("createdAt", T.StringType())])
REPO_PRS = T.StructType([T.StructField("repository", T.StructType([
    T.StructField("pullRequests", NODES(PR_NODE))]))])

SEARCH_NODE = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("mergedAt", T.StringType()), T.StructField("createdAt", T.StringType()),
    T.StructField("repository", T.StructType([T.StructField("owner", LOGIN),
                                              T.StructField("name", T.StringType())]))])
SEARCH = T.StructType([T.StructField("search", NODES(SEARCH_NODE))])
SEARCH_PAGE = T.StructType([T.StructField("items", T.ArrayType(LOGIN))])


def iso(c: Column) -> Column:
    return F.date_format(c, ISO)


def from_iso(c: Column) -> Column:
    """ISO text (fractions and offsets allowed) -> UTC timestamp; empty, missing or
    no time at all -> null."""
    moment = F.try_to_timestamp(F.nullif(c, F.lit("")))
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz"))


def arr0():
    return F.array().cast("array<string>")


# ------------------------------------------------------------------ S2 profile
def profile_payloads(users: DataFrame, accounts: Column) -> DataFrame:
    u = F.struct(
        F.col("username").alias("login"), "name", F.col("avatar_url").alias("avatarUrl"),
        F.concat(F.lit(D.PROFILE_URL_PREFIX), "username").alias("url"), "bio",
        F.struct(F.col("followers").alias("totalCount")).alias("followers"),
        F.struct(F.col("following").alias("totalCount")).alias("following"),
        iso(F.col("created_at")).alias("createdAt"), iso(F.col("scraped_at")).alias("updatedAt"),
        F.col("hireable").alias("isHireable"), "company", F.col("blog").alias("websiteUrl"),
        "location", "email", F.col("twitter_username").alias("twitterUsername"),
        F.struct(accounts.alias("nodes")).alias("socialAccounts"))
    return users.select(F.col("username").alias("cache_key"),
                        F.to_json(F.struct(u.alias("user"))).alias("response"))


def parse_profile(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Profile payload -> one ``github_users`` row (+ the extracted link, D8).
    Returns ``(rows, quarantine)``; a payload without a user is quarantined."""
    p = landed.select("cache_key", F.from_json("response", PROFILE).alias("p"))
    bad = p.where(F.col("p.user").isNull()).select("cache_key", F.lit("user not found").alias("reason"))
    u = p.where(F.col("p.user").isNotNull()).select("p.user.*")
    rows = u.select(
        F.col("login").alias("username"), "name", F.col("avatarUrl").alias("avatar_url"), "bio",
        F.col("followers.totalCount").alias("followers"), F.col("following.totalCount").alias("following"),
        F.lit(0).alias("public_repos"),
        F.col("websiteUrl").alias("blog"), F.col("websiteUrl").alias("website_url"),
        "location", "email", F.col("twitterUsername").alias("twitter_username"), "company",
        F.col("isHireable").alias("hireable"), from_iso(F.col("createdAt")).alias("created_at"),
        extract_link(F.col("socialAccounts.nodes"), F.col("bio"), F.col("websiteUrl")).alias("linkedin"))
    return rows, bad


def unreadable(landed: DataFrame, root: str, reason: str, keys: tuple[str, ...] = ("cache_key",), kind: str = "OBJECT") -> DataFrame:
    """Payloads that are no JSON, or whose ``root`` of this kind is missing or null: the rows
    that a parser gives nothing for, with the reason."""
    body = F.try_parse_json("response")
    there = F.coalesce(F.schema_of_variant(F.try_variant_get(body, f"$.{root}", "variant")).startswith(kind), F.lit(False))
    return landed.where(~there).select(*keys, F.when(body.isNull(), F.lit("not JSON")).otherwise(F.lit(reason)).alias("reason"))


# ------------------------------------------------------------------ S3 repositories
def _repo_node(prefix: str = "") -> Column:
    g = lambda c: F.col(prefix + c)
    lang = g("primary_language")
    return F.struct(
        g("name").alias("name"), F.struct(g("owner_login").alias("login")).alias("owner"),
        g("stars").alias("stargazerCount"),
        F.when(lang.isNotNull(), F.struct(lang.alias("name"))).alias("primaryLanguage"),
        iso(g("pushed_at")).alias("pushedAt"), g("is_fork").alias("isFork"),
        F.struct(g("total_prs").alias("totalCount")).alias("pullRequests"),
        F.struct(F.transform(F.coalesce(g("topics"), arr0()), lambda t: F.struct(
            F.struct(t.alias("name")).alias("topic"))).alias("nodes")).alias("repositoryTopics"),
        F.struct(F.transform(F.coalesce(g("languages"), arr0()), lambda t: F.struct(t.alias("name")))
                 .alias("nodes")).alias("languages"))


def repo_payloads(candidates: DataFrame) -> DataFrame:
    """One payload per user: owned then contributed lists, each in star order.
    A list holds at most the payload cap (50) entries, so the per-user collect is bounded."""
    node = F.struct(F.col("pos"), _repo_node().alias("n"))
    per = candidates.groupBy("username").agg(
        F.array_sort(F.collect_list(F.when(F.col("relation") == 0, node))).alias("o"),
        F.array_sort(F.collect_list(F.when(F.col("relation") == 1, node))).alias("c"))
    user = F.struct(
        F.struct(F.transform("o", lambda x: x["n"]).alias("nodes")).alias("repositories"),
        F.struct(F.transform("c", lambda x: x["n"]).alias("nodes")).alias("repositoriesContributedTo"))
    return per.select(F.col("username").alias("cache_key"),
                      F.to_json(F.struct(user.alias("user"))).alias("response"))


def repository_payloads(repos: DataFrame) -> DataFrame:
    """One payload a repository."""
    rows = repos.withColumn("name", F.col("repo_name"))
    return rows.select(F.concat("owner_login", F.lit("/"), "repo_name").alias("cache_key"),
                       F.to_json(F.struct(_repo_node().alias("repository"))).alias("response"))


def parse_repository(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A repository's own payload -> (repo_name ``owner/name``, stars, total_prs), counts 0 where they are
    missing. Returns ``(rows, quarantine)``; payloads that are no JSON, or without a repository of
    an owner and a name, are quarantined whole, with the reason."""
    p = landed.select("cache_key", "response", F.from_json("response", T.StructType([T.StructField("repository", REPO)])).alias("p"))
    owner, name = F.nullif(F.col("p.repository.owner.login"), F.lit("")), F.nullif(F.col("p.repository.name"), F.lit(""))
    there = owner.isNotNull() & name.isNotNull()
    reason = F.when(F.try_parse_json("response").isNull(), F.lit("not JSON")).otherwise(F.lit("repository not found"))
    rows = p.where(there).select(F.concat(owner, F.lit("/"), name).alias("repo_name"),
                                 F.coalesce("p.repository.stargazerCount", F.lit(0)).alias("stars"),
                                 F.coalesce("p.repository.pullRequests.totalCount", F.lit(0)).alias("total_prs"))
    return rows, p.where(~there).select("cache_key", "response", reason.alias("reason"))


def parse_repos(landed: DataFrame) -> DataFrame:
    """S3 + F14 + U1: owned ++ contributed, rows lacking owner or name skipped,
    defaults 0/null/false/[], first per ``owner/name`` kept in payload order."""
    p = landed.select(F.col("cache_key").alias("username"), F.from_json("response", REPOS).alias("p"))
    both = F.concat(F.coalesce(F.col("p.user.repositories.nodes"), F.array().cast(T.ArrayType(REPO))),
                    F.coalesce(F.col("p.user.repositoriesContributedTo.nodes"), F.array().cast(T.ArrayType(REPO))))
    rows = p.select("username", F.posexplode(both).alias("payload_index", "r"))
    blank = F.lit("")  # an empty login or name is missing, as a null one is
    rows = rows.where(F.nullif(F.col("r.owner.login"), blank).isNotNull() & F.nullif(F.col("r.name"), blank).isNotNull())
    flat = rows.select(
        "username", "payload_index",
        F.col("r.name").alias("name"), F.col("r.owner.login").alias("owner_login"),
        F.concat(F.col("r.owner.login"), F.lit("/"), F.col("r.name")).alias("full_name"),
        F.coalesce(F.col("r.stargazerCount"), F.lit(0)).alias("stars"),
        F.col("r.primaryLanguage.name").alias("primary_language"),
        from_iso(F.col("r.pushedAt")).alias("pushed_at"),
        F.coalesce(F.col("r.isFork"), F.lit(False)).alias("is_fork"),
        F.coalesce(F.col("r.pullRequests.totalCount"), F.lit(0)).alias("total_prs"),
        F.coalesce(F.transform(F.col("r.repositoryTopics.nodes"), lambda n: n["topic"]["name"]), arr0())
         .alias("topics"),
        F.coalesce(F.transform(F.col("r.languages.nodes"), lambda n: n["name"]), arr0()).alias("languages"))
    w = W.partitionBy("username", "full_name").orderBy("payload_index")
    return flat.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


# ------------------------------------------------------------------ S4 merged PRs of a repo
def newest_prs_per_repo(raw_prs: DataFrame, cap: int = D.PRS_PER_REPO_CAP) -> DataFrame:
    """The newest ``cap`` merged PRs of each repo (payload order: created desc). A PR
    landed more than once (same id) takes one place, with its last landed row.
    The row_number filter lets Spark prune per partition before the shuffle."""
    fields = [c for c in raw_prs.columns if c not in ("repo_name", "id")]
    once = raw_prs.groupBy("repo_name", "id").agg(F.max_by(F.struct(*fields), "seq").alias("__r")).select(
        "repo_name", "id", "__r.*")
    w = W.partitionBy("repo_name").orderBy(F.desc("created_at"), F.asc("id"))
    return once.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= cap)


def pr_payloads(newest: DataFrame) -> DataFrame:
    line = F.element_at(F.split("id", "-"), -1)
    node = F.struct(
        F.col("nth"), F.struct(
            "id", F.concat(F.lit(D.PROFILE_URL_PREFIX), "repo_name", F.lit("/pull/"), "id").alias("url"),
            F.when(line != "7", F.struct(F.col("username").alias("login"))).alias("author"),
            F.lit("MERGED").alias("state"),
            F.when(line == "6", F.lit("")).otherwise(iso(F.col("merged_at"))).alias("mergedAt"),
            iso(F.col("created_at")).alias("createdAt")).alias("n"))
    per = newest.groupBy("repo_name").agg(F.array_sort(F.collect_list(node)).alias("a"))
    body = F.struct(F.struct(F.struct(F.transform("a", lambda x: x["n"]).alias("nodes"))
                             .alias("pullRequests")).alias("repository"))
    return per.select(F.col("repo_name").alias("cache_key"), F.to_json(body).alias("response"))


def parse_pull_requests(landed: DataFrame) -> DataFrame:
    """One row per node; ``repo_id = owner/repo`` (the request key); a missing
    author is ``ghost``; a missing merge time becomes null."""
    p = landed.select(F.col("cache_key").alias("repo_id"), F.from_json("response", REPO_PRS).alias("p"))
    n = p.select("repo_id", F.posexplode(F.coalesce(F.col("p.repository.pullRequests.nodes"),
                                                    F.array().cast(T.ArrayType(PR_NODE)))).alias("nth", "n"))
    return n.select(
        F.col("n.id").alias("id"), F.col("n.url").alias("url"), "repo_id", "nth",
        F.coalesce(F.nullif(F.col("n.author.login"), F.lit("")), F.lit(D.GHOST_LOGIN)).alias("author_login"),
        from_iso(F.col("n.mergedAt")).alias("merged_at"),
        from_iso(F.col("n.createdAt")).alias("created_at"))


def user_prs_in_repo(user_repos: DataFrame, newest: DataFrame, min_stars: int = D.MIN_STARS) -> DataFrame:
    """F1 + F2: for each user's qualifying repos, the fetched PRs whose author equals
    the user case-insensitively (equi join on the lower-cased login)."""
    q = (user_repos.where(F.col("stars") >= min_stars)
         .select("username", F.col("full_name").alias("repo_name"), F.lower("username").alias("__l"))
         .distinct())
    n = newest.select("id", "repo_name", F.lower("username").alias("__l"))
    return q.join(n, ["repo_name", "__l"], "inner").drop("__l")


# ------------------------------------------------------------------ S5 PR search
def search_payloads(found: DataFrame, page_size: int = 100) -> DataFrame:
    """Search result documents per user, split into pages of about ``page_size``
    nodes: the page is a hash of the PR id over the user's page count (a grouped
    count, partial), so no window or group ever holds all of a heavy user's PRs."""
    line = F.element_at(F.split("id", "-"), -1)
    owner = F.element_at(F.split("full_name", "/"), 1)
    name = F.element_at(F.split("full_name", "/"), 2)
    node = F.struct(
        F.when(line == "5", F.lit("")).otherwise(F.col("id")).alias("id"),
        F.concat(F.lit(D.PROFILE_URL_PREFIX), "full_name", F.lit("/pull/"), "id").alias("url"),
        iso(F.col("merged_at")).alias("mergedAt"), iso(F.col("created_at")).alias("createdAt"),
        F.struct(F.struct(owner.alias("login")).alias("owner"), name.alias("name")).alias("repository"))
    pages = found.groupBy("username").agg(
        F.ceil(F.count(F.lit(1)) / page_size).cast("long").alias("__pages"))
    paged = found.join(pages, "username", "inner").withColumn(
        "page", F.pmod(F.xxhash64("id"), F.col("__pages")))
    per = paged.groupBy("username", "page").agg(
        F.array_sort(F.collect_list(F.struct("id", node.alias("n")))).alias("a"))
    body = F.struct(F.struct(F.transform("a", lambda x: x["n"]).alias("nodes")).alias("search"))
    return per.select(F.col("username").alias("cache_key"), "page", F.to_json(body).alias("response"))


def parse_pr_search(landed: DataFrame) -> DataFrame:
    """Nodes without a repository are skipped; the id falls back to the url;
    the author is the searched user."""
    p = landed.select(F.col("cache_key").alias("username"), F.from_json("response", SEARCH).alias("p"))
    n = p.select("username", F.explode(F.coalesce(F.col("p.search.nodes"),
                                                  F.array().cast(T.ArrayType(SEARCH_NODE)))).alias("n"))
    n = n.where(F.col("n.repository").isNotNull())
    return n.select(
        "username",
        F.coalesce(F.nullif(F.col("n.id"), F.lit("")), F.col("n.url")).alias("id"),
        F.concat(F.col("n.repository.owner.login"), F.lit("/"), F.col("n.repository.name")).alias("repo_id"),
        from_iso(F.col("n.mergedAt")).alias("merged_at"))


def unreadable_pr_search(landed: DataFrame) -> DataFrame:
    """The pages of search results that ``parse_pr_search`` gives nothing for because they hold no result
    at all (an empty result is one)."""
    return unreadable(landed, "search", "no search result")


# ------------------------------------------------------------------ S6 user search page
def search_page_payloads(hits: DataFrame) -> DataFrame:
    per = hits.groupBy("location", "slice", "page").agg(
        F.array_sort(F.collect_list(F.struct("hit", F.struct(F.col("username").alias("login")).alias("u"))))
         .alias("a"))
    return per.select("location", "slice", "page",
                      F.to_json(F.struct(F.transform("a", lambda x: x["u"]).alias("items"))).alias("response"))


def parse_search_page(landed: DataFrame) -> DataFrame:
    p = landed.select("location", "slice", "page", F.from_json("response", SEARCH_PAGE).alias("p"))
    return p.select("location", "slice", "page",
                    F.posexplode(F.col("p.items")).alias("i", "u")).select(
        "location", "slice", "page", "i", F.col("u.login").alias("username"))


def unreadable_search_page(landed: DataFrame) -> DataFrame:
    """The search pages without a list of hits."""
    return unreadable(landed, "items", "no items", ("location", "slice", "page"), "ARRAY")


# ------------------------------------------------------------------ X5
def profile_requests(users: DataFrame, query: str = "GetUser") -> DataFrame:
    """The request behind each profile payload and its fingerprint."""
    return users.select("username", request_key(F.lit(query), F.struct(F.col("username").alias("login")))
                        .alias("cache_key"))
