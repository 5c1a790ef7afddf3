"""Global and regional ranking, region filters and counts.

``ROW_NUMBER() OVER (ORDER BY score DESC)`` with no partition would move every row
into one task. ``global_rank`` computes the same numbers distributed:

1. a global sort (range partitioning on the full ordering key, so a score value
   shared by many rows is split across partitions by the tie-break key);
2. in the same job every row is tagged with ``monotonically_increasing_id`` (the
   partition index in its upper bits, the position inside the sorted partition in
   the lower bits) and written to the shared checkpoint folder, which fixes the
   sampled range bounds (executor loss re-reads files, not a re-sampled sort);
3. the row count per partition index;
4. the partition counts (one row per partition, a size bounded by the
   partition count) turned into offsets and broadcast back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions.columns import extract_link, in_region

LOCAL_BITS = 33


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rnk") -> DataFrame:
    """Exact ``row_number()`` over a total ``order`` without a single-partition window."""
    from ..session import shared
    # One job: range-partitioned sort, then each row tagged with its partition index
    # (upper bits) and position inside the partition (lower bits), written out.
    tagged = shared(df.orderBy(*order).withColumn("__mid", F.monotonically_increasing_id()), "rank")
    pid = F.shiftright("__mid", LOCAL_BITS)
    counts = tagged.groupBy(pid.alias("__pid")).agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: a single-partition window over it is tiny.
    offsets = counts.select("__pid", (F.sum("__n").over(
        W.orderBy("__pid").rowsBetween(W.unboundedPreceding, -1))).alias("__off"))
    offsets = offsets.select("__pid", F.coalesce("__off", F.lit(0)).alias("__off"))
    local = F.col("__mid").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))
    out = (tagged.withColumn("__pid", pid)
                 .join(F.broadcast(offsets), "__pid", "inner")
                 .withColumn(rank_col, (F.col("__off") + local + 1).cast("long")))
    return out.drop("__mid", "__pid", "__off")


def score_order(score: str = "total_score", key: str = "username") -> list[Column]:
    """Scores are stored as float4; rank on that value, ties broken by the key."""
    return [F.col(score).cast("float").desc(), F.col(key).asc()]


# The leaderboard with the profile and enrichment columns -------------------------
def full_leaderboard(board: DataFrame, profiles: DataFrame, state: DataFrame | None) -> DataFrame:
    prof = profiles.select("username", "bio", "location", "company", "hireable",
                           extract_link(F.col("social_accounts"), F.col("bio"), F.col("blog")).alias("linkedin"))
    out = board.join(prof, "username", "inner")
    if state is not None:
        out = out.join(state, "username", "left")
    return out


def has_link(c: str = "linkedin") -> Column:
    """F12."""
    return F.col(c).isNotNull() & (F.col(c) != "")


# F10 ---------------------------------------------------------------------------------
def region_members(board: DataFrame, patterns=D.BAY_AREA_PATTERNS) -> DataFrame:
    return board.where(in_region("location", patterns))


# W1 / W2 -----------------------------------------------------------------------------
def _after(key: dict, score: str = "total_score", name: str = "username") -> Column:
    """Rows that come after the row with this key in ``score_order``."""
    s = F.col(score).cast("float")
    at = F.lit(key["s"]).cast("float")
    return (s < at) | ((s == at) & (F.col(name) > F.lit(key["u"])))


def _last_key(df: DataFrame, n: int) -> dict | None:
    """The key of the n-th row in ``score_order`` (of the last, if there are fewer)."""
    top = df.select(F.col("total_score").cast("float").alias("s"), F.col("username").alias("u")).orderBy(
        F.desc("s"), F.asc("u")).limit(n)
    row = top.agg(F.max_by(F.struct("s", "u"), F.struct(-F.col("s"), F.col("u"))).alias("last"),
                  F.count(F.lit(1)).alias("n")).first()
    return None if not row["n"] else {"s": row["last"]["s"], "u": row["last"]["u"], "n": row["n"]}


def ranked_candidates(board: DataFrame, wanted: Column, skip: int, take: int) -> DataFrame:
    """Rank everyone by score, skip the first ``skip``, and of the ``wanted`` rows after
    them take the first ``take``, each with its rank in the whole board.

    The board is not sorted as a whole: the key at ``skip`` and the key of the last row
    taken are two bounded top-n queries, and only the rows between them are ranked."""
    from ..session import shared
    board = shared(board, "board")
    start = _last_key(board, skip) if skip else None
    if skip and (start is None or start["n"] < skip):
        return board.limit(0).withColumn("rnk", F.lit(0).cast("long"))
    rest = board.where(_after(start)) if start else board
    end = _last_key(rest.where(wanted), take)
    if end is None:
        return board.limit(0).withColumn("rnk", F.lit(0).cast("long"))
    ranked = global_rank(rest.where(~_after(end)), score_order())
    return ranked.withColumn("rnk", F.col("rnk") + skip).where(wanted)


def enrich_candidates_global(board: DataFrame, skip: int = D.GLOBAL_SKIP,
                             take: int = D.GLOBAL_TAKE) -> DataFrame:
    """Rank everyone, then rank > skip and a link; the first ``take`` by rank."""
    return ranked_candidates(board, has_link(), skip, take)


def eligible() -> Column:
    """F11, applied after the rank."""
    return (has_link() & F.col("is_open_to_work").isNull()
            & ~F.coalesce(F.col("otw_permanent_failure"), F.lit(False)))


def enrich_candidates_region(board: DataFrame, skip: int = D.REGION_SKIP,
                             take: int = D.REGION_TAKE, patterns=D.BAY_AREA_PATTERNS) -> DataFrame:
    """Region filter first, rank inside the region, eligibility after the rank."""
    return ranked_candidates(region_members(board, patterns), eligible(), skip, take)


# A13 / A14 ---------------------------------------------------------------------------
def region_outcome_counts(board: DataFrame, patterns=D.BAY_AREA_PATTERNS) -> DataFrame:
    m = region_members(board, patterns).where(has_link())
    return m.agg(F.count_if(F.col("is_open_to_work") == True).alias("open_to_work"),  # noqa: E712
                 F.count_if(F.col("is_open_to_work") == False).alias("not_open_to_work"),  # noqa: E712
                 F.count_if(F.col("otw_permanent_failure") == True).alias("permanent_failures"))  # noqa: E712


def region_count(board: DataFrame, patterns=D.BAY_AREA_PATTERNS) -> DataFrame:
    return region_members(board, patterns).agg(F.count(F.lit(1)).alias("members"))
