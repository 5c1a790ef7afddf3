"""Keyed upserts (ON CONFLICT DO UPDATE) as set-based DataFrame jobs.

A table version is immutable: an upsert unions the current rows with the
arriving batch and keeps one row per key; callers write the result as a new
version (never over the path being read). One generic ``upsert`` covers K1-K9.

Per key, updated columns come from the latest row and untouched columns from the
earliest one (old table first, then arrival order). This is a grouped
``max_by``/``min_by`` with partial aggregation, so a key holding a large share of
the rows is combined map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dictionaries as D

VER = "__ver"


def _version(df: DataFrame, batch: int, order: list, types: dict) -> DataFrame:
    fields = [F.lit(batch).alias("b")]
    for i, o in enumerate(order):
        c = F.col(o) if isinstance(o, str) else o
        fields.append((c if batch > 0 else F.lit(None)).cast(types[i]).alias(f"o{i}"))
    return df.withColumn(VER, F.struct(*fields))


def upsert(old: DataFrame | None, new: DataFrame, keys: list[str], order: list,
           update_cols: list[str] | None = None, drop: list[str] | None = None) -> DataFrame:
    """Generic keyed upsert.

    ``order`` lists columns (or expressions) of ``new`` that define arrival
    order; later rows win for ``update_cols`` (all non-key columns by default),
    the first row ever seen for the key keeps the other columns.
    ``drop`` names helper columns of ``new`` that are not part of the table.
    """
    drop = drop or []
    data_cols = [c for c in new.columns if c not in keys and c not in drop]
    upd = data_cols if update_cols is None else [c for c in data_cols if c in update_cols]
    keep = [c for c in data_cols if c not in upd]
    probe = new.select(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}")
                         for i, o in enumerate(order)])
    types = {i: f.dataType.simpleString() for i, f in enumerate(probe.schema.fields)}
    parts = [_version(new, 1, order, types).select(*keys, *data_cols, VER)]
    if old is not None:
        parts.insert(0, _version(old.select(*keys, *data_cols), 0, order, types))
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    aggs = []
    if upd:
        aggs.append(F.max_by(F.struct(*upd), VER).alias("__u"))
    if keep:
        aggs.append(F.min_by(F.struct(*keep), VER).alias("__k"))
    out = both.groupBy(*keys).agg(*aggs)
    sel = list(keys) + ([F.col(f"__u.{c}").alias(c) for c in upd]) + \
        ([F.col(f"__k.{c}").alias(c) for c in keep])
    return out.select(*sel).select(*keys, *data_cols)


def replace_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``upsert`` where ``new`` holds a key once, never null, and every column: its rows take the places of the old
    ones. An anti join on the keys alone; no row is sorted and folded with its columns."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


# K1 -----------------------------------------------------------------------------
def upsert_users(old: DataFrame | None, new: DataFrame, order: list | None = None) -> DataFrame:
    """Profile upsert on ``username``: every column replaced, ``public_repos`` forced 0."""
    new = new.withColumn("public_repos", F.lit(0))
    return upsert(old, new, ["username"], order or ["scraped_at"])


# K2 -----------------------------------------------------------------------------
def upsert_repos_short_name(old: DataFrame | None, new: DataFrame, order: list) -> DataFrame:
    """Repo upsert keyed on the SHORT name: a second owner's repo of the same name
    replaces the first, owner included (kept as the reference stores it)."""
    new = (new.withColumn("forks", F.lit(0)).withColumn("watchers", F.lit(0))
              .withColumn("description", F.lit(None).cast("string"))
              .withColumn("created_at", F.lit(None).cast("timestamp_ntz"))
              .withColumn("is_archived", F.lit(False)))
    return upsert(old, new, ["repo_name"], order)


# K3 -----------------------------------------------------------------------------
def upsert_pull_requests(old: DataFrame | None, new: DataFrame, order: list | None = None) -> DataFrame:
    """PR insert on ``id``: only ``state`` and ``merged_at`` are updated, the other
    columns keep the first insert; state is always MERGED, additions/deletions 0."""
    order = order or ["seq"]
    base = (new.withColumn("state", F.lit("MERGED"))
               .withColumn("additions", F.lit(0)).withColumn("deletions", F.lit(0)))
    cols = ["id", "username", "repo_name", "state", "additions", "deletions", "merged_at",
            "created_at"]
    helper = [c for c in base.columns if c not in cols]
    return upsert(old, base.select(*cols, *helper), ["id"], order,
                  update_cols=["state", "merged_at"], drop=helper)


# K4 -----------------------------------------------------------------------------
def upsert_user_repo_scores(old: DataFrame | None, scores: DataFrame, as_of: Column) -> DataFrame:
    """Scores of 0 are not written, so an older row for that pair stays."""
    new = scores.where(F.col("repo_score") > 0).withColumn("computed_at", as_of)
    return upsert(old, new, ["username", "repo_name"], ["repo_score", "user_prs", "total_prs", "stars"])


# K5 -----------------------------------------------------------------------------
def upsert_user_scores(old: DataFrame | None, totals: DataFrame, as_of: Column) -> DataFrame:
    return upsert(old, totals.withColumn("updated_at", as_of), ["username"], ["total_score"])


# K6 -----------------------------------------------------------------------------
LEGACY_SET = ["name", "avatar_url", "bio", "company", "blog", "location", "email",
              "twitter_username", "hireable", "website_url", "followers", "following",
              "public_repos", "score", "last_fetched", "updated_at"]


def sync_legacy_users(old: DataFrame | None, user_scores: DataFrame, profiles: DataFrame,
                      as_of: Column) -> DataFrame:
    """Legacy ``users`` sync: inner join score -> profile (no profile, no sync);
    ``website_url = blog``; columns not named keep their old values."""
    p = profiles.select("username", "name", "avatar_url", "bio", "company", "blog", "location",
                        "email", "twitter_username", "hireable", "followers", "following")
    j = user_scores.select("username", "total_score").join(p, "username", "inner")
    new = j.select(
        "username", "name", "avatar_url", "bio", "company", "blog", "location", "email",
        "twitter_username", "hireable",
        F.col("blog").alias("website_url"),
        F.coalesce("followers", F.lit(0)).alias("followers"),
        F.coalesce("following", F.lit(0)).alias("following"),
        F.lit(0).alias("public_repos"),
        F.coalesce("total_score", F.lit(0.0)).alias("score"),
        as_of.alias("last_fetched"), as_of.alias("updated_at"),
        F.lit(None).cast("string").alias("linkedin"),
        as_of.alias("created_at"),
    )
    return upsert(old, new, ["username"], ["score", "name", "bio", "blog", "location"], update_cols=LEGACY_SET)


# K7 -----------------------------------------------------------------------------
LEADERBOARD_SET = ["name", "avatar_url", "total_score", "updated_at"]
# FIXED VALUES: defaults of the columns that may not be null, for inserted rows.
LEADERBOARD_DEFAULTS = {"ai_score": 0.0, "backend_score": 0.0, "frontend_score": 0.0, "devops_score": 0.0,
                        "data_score": 0.0, "hireable": False}


def sync_leaderboard(old: DataFrame | None, user_scores: DataFrame, profiles: DataFrame,
                     as_of: Column) -> DataFrame:
    """Leaderboard sync: only name, avatar, total_score, updated_at are written; every
    other column of an existing row is untouched, and of an inserted row takes its
    default."""
    j = user_scores.select("username", "total_score").join(
        profiles.select("username", "name", "avatar_url"), "username", "inner")
    new = j.select("username", "name", "avatar_url", "total_score", as_of.alias("updated_at"))
    if old is None:
        return new
    extra = [c for c in old.columns if c not in new.columns]
    o = old.alias("o")
    n = new.alias("n")
    full = o.join(n, F.col("o.username") == F.col("n.username"), "full_outer")
    sel = [F.coalesce(F.col("n.username"), F.col("o.username")).alias("username")]
    hit = F.col("n.username").isNotNull()
    for c in LEADERBOARD_SET:
        sel.append(F.when(hit, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
    inserted = F.col("o.username").isNull()
    for c in extra:
        stored = F.col(f"o.{c}")
        if c in LEADERBOARD_DEFAULTS:
            stored = F.when(inserted, F.lit(LEADERBOARD_DEFAULTS[c]).cast(old.schema[c].dataType)).otherwise(stored)
        sel.append(stored.alias(c))
    return full.select(*sel)


# K9 / K10 / F7 ------------------------------------------------------------------
def upsert_responses(old: DataFrame | None, landed: DataFrame, as_of: Column,
                     ttl_days: int = D.RESPONSE_TTL_DAYS, order: list | None = None) -> DataFrame:
    """Landing-table upsert on ``cache_key``: response, cached_at, expires_at = now + ttl."""
    new = (landed.withColumn("cached_at", as_of)
                 .withColumn("expires_at", F.timestamp_add("DAY", F.lit(ttl_days), as_of)))
    return upsert(old, new.select("cache_key", "response", "cached_at", "expires_at",
                                  *[c for c in new.columns if c == "seq"]),
                  ["cache_key"], order or ["seq"], drop=["seq"])


def purge_expired(responses: DataFrame, as_of: Column) -> DataFrame:
    """Delete rows with ``expires_at < now``; the rest is the new version."""
    return responses.where(F.col("expires_at") >= as_of)


def live_responses(responses: DataFrame, as_of: Column) -> DataFrame:
    """Strictly ``expires_at > now`` (a row expiring exactly now is neither live nor purged)."""
    return responses.where(F.col("expires_at") > as_of)


def _day(spark, as_of: Column) -> str:
    return spark.range(1).select(F.date_format(as_of, "yyyy-MM-dd")).first()[0]


def purge_expired_parts(store, as_of: Column) -> None:
    """K10 on a table in parts by day of expiry: days before the present one leave the manifest
    unread, only the present day is rewritten, and the later ones keep their files."""
    today = _day(store.spark, as_of)
    store.drop([p for p in store.parts() if p < today or p == "none"])
    if today in store.parts():
        store.replace(purge_expired(store.read([today]), as_of), [today])


def live_parts(store, as_of: Column) -> DataFrame:
    """F7 on a table in parts by day of expiry: no file of an earlier day is read."""
    today = _day(store.spark, as_of)
    return live_responses(store.read([p for p in store.parts() if today <= p != "none"]), as_of)


# K13 ----------------------------------------------------------------------------
def evolve_schema(df: DataFrame, columns: dict) -> DataFrame:
    """ADD COLUMN IF NOT EXISTS: ``columns`` gives a type, or a type and the default that
    existing rows take (null without one). Columns that are there stay as they are."""
    out = df
    for name, spec in columns.items():
        if name not in df.columns:
            typ, default = spec if isinstance(spec, tuple) else (spec, None)
            out = out.withColumn(name, F.lit(default).cast(typ))
    return out
