"""Row-level column expressions (all built-in Spark functions, no UDFs)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dictionaries as D


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round4(c: Column | str) -> Column:
    return F.round(_c(c), 4)


def cust_login(key: Column | str) -> Column:
    """``Customer#`` + key left-padded to 9 digits (same format as c_name)."""
    return F.concat(F.lit("Customer#"), F.lpad(_c(key).cast("string"), 9, "0"))


# X1 ---------------------------------------------------------------------------
def extract_link(accounts: Column | None, bio: Column | str, website: Column | str,
                 pattern: str = D.LINK_PATTERN) -> Column:
    """Profile link: LINKEDIN social account url, else id found in bio, else in website."""

    def from_text(t: Column) -> Column:
        found = F.nullif(F.regexp_extract(t, pattern, 1), F.lit(""))
        return F.when(found.isNotNull(), F.concat(F.lit(D.LINK_URL_PREFIX), found))

    by_text = F.coalesce(from_text(_c(bio)), from_text(_c(website)))
    if accounts is None:
        return by_text
    is_link = lambda a: a["provider"] == F.lit("LINKEDIN")
    first = F.try_element_at(F.filter(accounts, is_link), F.lit(1))
    return F.when(F.coalesce(F.exists(accounts, is_link), F.lit(False)), first["url"]).otherwise(by_text)


# X2 ---------------------------------------------------------------------------
def experience_level(total: Column | str, levels=D.LEVELS, top=D.TOP_LEVEL) -> Column:
    t = _c(total)
    expr = None
    for bound, label in levels:
        expr = F.when(t < bound, label) if expr is None else expr.when(t < bound, label)
    return expr.otherwise(top)


# X3 ---------------------------------------------------------------------------
def follower_slice(followers: Column | str, slices=D.FOLLOWER_SLICES) -> Column:
    f = _c(followers)
    expr = None
    for label, lo, hi in slices:
        cond = (f >= lo) if hi is None else f.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def follower_slice_index(followers: Column | str, slices=D.FOLLOWER_SLICES) -> Column:
    f = _c(followers)
    expr = None
    for i, (_, lo, hi) in enumerate(slices):
        cond = (f >= lo) if hi is None else f.between(lo, hi)
        expr = F.when(cond, i) if expr is None else expr.when(cond, i)
    return expr


# X4 ---------------------------------------------------------------------------
def split_locations(s: Column | str) -> Column:
    return F.filter(F.transform(F.split(_c(s), ","), lambda x: F.trim(x)),
                    lambda x: F.length(x) > 0)


# X5 ---------------------------------------------------------------------------
def request_key(query: Column | str, variables: Column | str,
                prefix: str = D.REQUEST_KEY_PREFIX) -> Column:
    body = F.to_json(F.struct(_c(query).alias("query"), _c(variables).alias("variables")))
    return F.concat(F.lit(prefix), F.sha2(body, 256))


# A2 / X11 -----------------------------------------------------------------------
def repo_score(user_prs: Column | str, total_prs: Column | str, stars: Column | str,
               min_stars: int | None = None, cap: float = D.MAX_REPO_SCORE) -> Column:
    """Capped share score. ``min_stars=None`` is the stage-2 form (no cutoff);
    ``min_stars=10`` is model A. Null/0/negative totals give 0, never a division."""
    u, t, s = _c(user_prs), _c(total_prs), F.coalesce(_c(stars), F.lit(0))
    ok = F.coalesce(t > 0, F.lit(False))
    if min_stars is not None:
        ok = ok & (s >= min_stars)
    raw = s.cast("double") * (u.cast("double") / F.when(ok, t).cast("double"))
    return F.when(ok, F.least(raw, F.lit(float(cap)))).otherwise(F.lit(0.0))


# X10 ----------------------------------------------------------------------------
def stage4_repo_score(stars: Column | str, prs: Column | str) -> Column:
    return F.ln(_c(stars).cast("double") + 1.0) * 10.0 + _c(prs).cast("double") * 5.0


# X14 / X15 ----------------------------------------------------------------------
def retryable_status(status: Column | str) -> Column:
    s = _c(status)
    return (s >= 500) | (s == 429)


def retryable_error(text: Column | str, needles=D.RETRYABLE_ERRORS_REGIONAL) -> Column:
    t = _c(text)
    cond = F.lit(False)
    for n in needles:
        cond = cond | t.contains(n)
    return F.coalesce(cond, F.lit(False))


# F10 ----------------------------------------------------------------------------
def _regex_literal(p: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", p)


def in_region(location: Column | str, patterns=D.BAY_AREA_PATTERNS) -> Column:
    """Non-null location whose lower-cased text contains any pattern (one regex)."""
    loc = _c(location)
    alternation = "|".join(_regex_literal(p) for p in patterns)
    return loc.isNotNull() & F.lower(loc).rlike(alternation)
