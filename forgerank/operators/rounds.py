"""Enrichment over several landings: resolution as a mergeable state (O2 with K11, K12, A13, A14, A16).

A user's state is the first ``max_retries + 1`` of their attempts in landing order, which is all
that O2 ever looks at. States merge by putting two of them together and keeping the first
attempts again; this is associative, commutative and idempotent, so it does not matter how attempts are
cut into landings, in which order these come, or whether one comes twice.

``EnrichmentRounds`` keeps the states and the leaderboard in versioned stores by user. A landing reads the parts
of its own users only, and the statistics are counters to which each landing adds what its
touched rows count now less what they counted before; no other row is read for them.

Defined results: attempts equal in all columns are one attempt, others of the same number are tried in
the order of their columns; a null user has a state like any other but no leaderboard row; an empty
landing changes nothing; a landing's tag counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions.columns import in_region
from ..session import release, shared
from ..sources.store import Store, hash_part
from . import outcomes as O
from .ranking import has_link

KEY = "username"


# O2 as a state -------------------------------------------------------------------------
def _first(kept: Column, max_retries: int) -> Column:
    return F.slice(F.array_sort(F.array_distinct(kept)), 1, max_retries + 1)


def attempt_states(classified: DataFrame, max_retries: int = D.MAX_RETRIES, order: str = "seq") -> DataFrame:
    """(username, kept): Spark prunes later attempts before the shuffle (WindowGroupLimit)."""
    rank = F.dense_rank().over(W.partitionBy(KEY).orderBy(order))
    rest = [c for c in classified.columns if c not in (KEY, order)]
    early = classified.withColumn("__n", rank).where(F.col("__n") <= max_retries + 1)
    return early.groupBy(KEY).agg(_first(F.collect_set(F.struct(order, *rest)), max_retries).alias("kept"))


def merge_states(old: DataFrame, new: DataFrame, max_retries: int = D.MAX_RETRIES) -> DataFrame:
    both = old.unionByName(new).groupBy(KEY).agg(F.flatten(F.collect_list("kept")).alias("kept"))
    return both.select(KEY, _first(F.col("kept"), max_retries).alias("kept"))


def resolve_states(states: DataFrame) -> DataFrame:
    """The columns of ``outcomes.resolve_attempts``, from states: the first success or the first
    attempt that is not retryable, else the last one kept."""
    tried = F.transform("kept", lambda x, i: F.struct(x.alias("r"), i.cast("int").alias("attempt")))
    ends = F.filter(tried, lambda x: x["r"]["success"] | ~x["r"]["retryable"])
    s = states.select(KEY, F.coalesce(F.get(ends, F.lit(0)), F.element_at(tried, -1)).alias("at"),
                      F.size("kept").cast("long").alias("attempts_landed"))
    return s.select(KEY, "at.r.*", "at.attempt", "attempts_landed").withColumn(
        "permanent", ~F.col("success") & ~F.col("retryable"))


# A13, A14, A16 as counters ---------------------------------------------------------------
def _yes(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(False))


def _region(patterns) -> Column:
    return F.coalesce(in_region("location", patterns), F.lit(False))


def outcome_counters() -> dict[str, Column]:
    """A16 over resolved users."""
    s, p = F.col("success"), F.col("permanent")
    return {"total": F.lit(True), "success": s, "permanent_failures": ~s & p, "transient_failures": ~s & ~p,
            "failed": ~s, "open_to_work": s & _yes("open_to_work")}


def board_counters(patterns=D.BAY_AREA_PATTERNS) -> dict[str, Column]:
    """A14 and A13 over leaderboard rows."""
    linked = _region(patterns) & F.coalesce(has_link(), F.lit(False))
    return {"members": _region(patterns), "members_open": linked & _yes("is_open_to_work"),
            "members_not_open": linked & F.coalesce(~F.col("is_open_to_work"), F.lit(False)),
            "members_failed": linked & _yes("otw_permanent_failure")}


def moved(after: DataFrame, before: DataFrame | None, counters: dict[str, Column]) -> DataFrame:
    """One row: what ``after`` counts less what ``before`` counts."""
    def signed(df, sign):
        return df.select(*[F.when(c, F.lit(sign)).otherwise(0).cast("long").alias(n) for n, c in counters.items()])

    rows = signed(after, 1) if before is None else signed(after, 1).unionByName(signed(before, -1))
    return rows.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in counters])


class EnrichmentRounds:
    """Rounds over a leaderboard with the enrichment columns (``ranking.full_leaderboard``).

    A landing is staged in full before any table takes it: first the counters, then the board, the
    states last, each under the landing's tag. What it adds to the counters is computed from states
    that only the last write changes, so a landing that was cut off is simply landed again."""

    def __init__(self, spark: SparkSession, path: str, mode: str = "regional", max_retries: int = D.MAX_RETRIES,
                 patterns=D.BAY_AREA_PATTERNS):
        self.spark, self.path, self.mode = spark, path.rstrip("/"), mode
        self.max_retries, self.patterns = max_retries, patterns
        self.base, self.board, self.states, self.log = (Store(spark, f"{self.path}/{n}") for n in ("base", "board", "states", "log"))

    def begin(self, board: DataFrame, parts: int = 64) -> EnrichmentRounds:
        """Stores the leaderboard that the rounds start from, once."""
        if self.log.version():
            return self
        spec = hash_part([KEY], parts)
        Store.of(board, self.base.path, spec)
        start = self.base.read()
        Store.of(start, self.board.path, spec)
        none = moved(start.limit(0).select(F.lit(False).alias("success"), F.lit(False).alias("permanent"),
                                           F.lit(False).alias("open_to_work")), None, outcome_counters())
        first = none.unionByName(moved(start, None, board_counters(self.patterns)), allowMissingColumns=True)
        Store.of(first.withColumn("tag", F.lit("begin")), self.log.path, hash_part(["tag"], 1))
        return self

    def land(self, attempts: DataFrame, as_of: Column, tag: str) -> bool:
        """Takes a landing of attempts; False if its tag has been taken."""
        batch = shared(attempt_states(O.classify(attempts, self.mode), self.max_retries), "landed_states")
        if self.states.version() is None:
            Store.create(self.spark, self.states.path, batch.schema, self.base.manifest()["spec"])
        if tag in self.states.manifest()["tags"]:
            return False
        parts = self.base.touched(batch)
        users = batch.select(KEY)

        def mine(store):
            return store.read(parts).join(users.withColumnRenamed(KEY, "__k"), F.col(KEY).eqNullSafe(F.col("__k")), "left_semi")

        old = shared(mine(self.states), "old_states")
        new = shared(merge_states(old, batch, self.max_retries), "new_states")
        result = resolve_states(new)
        write = O.apply_outcomes if self.mode == "regional" else O.apply_outcomes_overwrite
        # From the rows the rounds began with: an attempt that lands late may undo an outcome.
        after = shared(write(mine(self.base), result, as_of), "board_after")
        # The board as the old states left it, which a landing cut off after the board's write still shows.
        before = write(mine(self.base), resolve_states(old), as_of)
        delta = self._delta(result, resolve_states(old), after, before)
        self.log.merge(delta.withColumn("tag", F.lit(tag)), lambda a, b: a.unionByName(b), tag)
        self.board.merge(after, _replace, tag, parts)
        self.states.merge(new, _replace, tag, parts)
        release(batch, old, new, after)
        return True

    def _delta(self, result, old_result, after, before) -> DataFrame:
        outcome = moved(result, old_result, outcome_counters())
        return shared(outcome.unionByName(moved(after, before, board_counters(self.patterns)), allowMissingColumns=True), "moved")

    def statistics(self) -> DataFrame:
        """One row: A16 over all users with an attempt, A14 and A13 over the board as it stands."""
        names = [*outcome_counters(), *board_counters(self.patterns)]
        return self.log.read().agg(*[F.sum(n).alias(n) for n in names])


def _replace(old: DataFrame, rows: DataFrame) -> DataFrame:
    keys = rows.select(F.col(KEY).alias("__k"))
    return old.join(keys, F.col(KEY).eqNullSafe(F.col("__k")), "left_anti").unionByName(rows)
