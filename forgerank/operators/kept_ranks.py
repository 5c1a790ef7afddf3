"""Ranks kept between rounds.

The board is a versioned table cut by order-preserving slices of the score. Its manifest
holds the number of rows of each slice, which every write moves, so it is the histogram of
the scores: the slice with rank ``skip`` follows from the counts, slices above it are never
read, and of the slices below only as many as hold the rows taken. Only these are sorted.

``update`` takes the new rows of some users. A second table, in parts by user, says in which
slice a user stands, so only the slices that users leave or enter are read and written. Both
writes carry the batch's tag: a batch that was cut off is run again, before the next one, and counts once.

Slices are fixed by the score's value, not by the data, so their number is bounded by the
range of float4 (``STEPS`` for an e-fold). A slice that holds a large share of all rows, as
equal scores do, is several files, and its rows are ranked by a range-partitioned sort.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dictionaries as D
from ..functions.columns import in_region
from ..session import shared
from ..sources.store import BEYOND, Store, hash_part, part_of, score_part
from .ranking import eligible, global_rank, has_link, score_order

STEPS = 16
PLACE = T.StructType([T.StructField("username", T.StringType()), T.StructField("slice", T.StringType())])


def _height(part: str) -> int:
    return -BEYOND - 1 if part == "none" else int(part)


class KeptRanks:
    """A ranked board under ``path``; ``member`` are the rows that are ranked (all, if None).

    Users are unique; a batch with several rows of one user is refused by no check, so reduce
    it before (``upsert.latest``). Null scores rank last; an empty board gives no candidates."""

    def __init__(self, spark: SparkSession, path: str, member: Column | None = None):
        self.spark, self.path, self.member = spark, path, member

    def begin(self, schema: T.StructType, buckets: int, steps: int = STEPS) -> KeptRanks:
        self.board = Store.create(self.spark, f"{self.path}/board", schema, score_part("total_score", steps), "username")
        self.places = Store.create(self.spark, f"{self.path}/places", PLACE, hash_part(["username"], buckets))
        return self

    def update(self, batch: DataFrame, tag: str) -> None:
        """Puts the users of ``batch`` where their new rows rank; those that are no members any more leave."""
        batch = shared(batch, "ranked_batch")
        spec = self.board.manifest()["spec"]
        stay = batch if self.member is None else batch.where(F.coalesce(self.member, F.lit(False)))
        now = stay.select("username", part_of(spec).alias("slice"))
        users = batch.select("username")
        before = self.places.read(self.places.touched(users)).join(users, "username", "left_semi")
        slices = [r[0] for r in before.select("slice").union(now.select("slice")).distinct().collect()]
        self.board.merge(stay, lambda old, new: old.join(users, "username", "left_anti").unionByName(new.select(old.columns)),
                         tag, slices)
        self.places.merge(users, lambda old, _: old.join(users, "username", "left_anti").unionByName(now), tag)

    def histogram(self) -> list[tuple[str, int]]:
        """(slice, rows) from the greatest scores down."""
        return sorted(((p, e["rows"]) for p, e in self.board.parts().items()), key=lambda x: -_height(x[0]))

    def _runs(self, slices: list[tuple[str, int]], least: int) -> Iterator[list[str]]:
        """Runs of slices with at least ``least`` rows, then twice as many, and so on."""
        run, n = [], 0
        for part, rows in slices:
            run.append(part)
            n += rows
            if n >= least:
                yield run
                run, n, least = [], 0, 2 * least
        if run:
            yield run

    def candidates(self, wanted: Column, skip: int, take: int) -> DataFrame:
        """What ``ranking.ranked_candidates`` gives for the whole board."""
        above, rest = 0, self.histogram()
        while rest and above + rest[0][1] <= skip:
            above += rest.pop(0)[1]
        read: list[str] = []
        found = 0
        for run in self._runs(rest, 2 * take + skip - above):
            read += run
            rows = self.board.read(run)
            if len(read) == len(run) and above < skip:  # the first run holds rows that are skipped, wanted ones among them
                rows = global_rank(rows, score_order()).where(F.col("rnk") > skip - above)
            found += rows.where(wanted).count()
            if found >= take:
                break
        ranked = global_rank(self.board.read(read), score_order()).withColumn("rnk", F.col("rnk") + above)
        return ranked.where(wanted).where(F.col("rnk") > skip).orderBy("rnk").limit(take)

    def global_candidates(self, skip: int = D.GLOBAL_SKIP, take: int = D.GLOBAL_TAKE) -> DataFrame:
        """W1."""
        return self.candidates(has_link(), skip, take)

    def region_candidates(self, skip: int = D.REGION_SKIP, take: int = D.REGION_TAKE) -> DataFrame:
        """W2, on a board whose members are a region's (``region_board``)."""
        return self.candidates(eligible(), skip, take)


def region_board(spark: SparkSession, path: str, patterns=D.BAY_AREA_PATTERNS) -> KeptRanks:
    return KeptRanks(spark, path, in_region("location", patterns))
