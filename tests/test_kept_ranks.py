"""Kept ranks: equal to the naive window after every update, slices outside the answer unread and unwritten."""

import math
import random

import pytest
from pyspark.sql import functions as F

from forgerank.operators import ranking as R
from forgerank.operators.kept_ranks import KeptRanks, _height, region_board
from forgerank.sources.store import Store, part_of, score_part

SCHEMA = "username string, total_score double, linkedin string, location string"


def board(rows, spark):
    return spark.createDataFrame(rows, SCHEMA)


def naive(rows, skip, take):
    """The same by plain Python: float4 scores downwards, nulls last, then the name."""
    import numpy as np
    order = sorted(rows, key=lambda r: (r[1] is None, -float(np.float32(r[1] or 0.0)), r[0]))
    return [(k + 1, r[0]) for k, r in enumerate(order) if k + 1 > skip and r[2]][:take]


def got(ranks, skip, take):
    return sorted((r.rnk, r.username) for r in ranks.candidates(R.has_link(), skip, take).collect())


def some(r, names):
    return [(f"u{k}", r.choice([None, 0.0, 1.0, 1.0, r.random() * 10 ** r.randint(-2, 6), -r.random()]),
             r.choice(["in/x", None, "in/y"]), r.choice(["San Francisco", "Paris"])) for k in names]


def test_updates_equal_the_naive_window(spark, tmp_path):
    r = random.Random(3)
    ranks = KeptRanks(spark, str(tmp_path)).begin(board([], spark).schema, 4)
    assert got(ranks, 0, 5) == []
    now = {}
    for n, names in enumerate((range(300), range(250, 330), [7])):
        batch = some(r, names)
        now |= {x[0]: x for x in batch}
        ranks.update(board(batch, spark), f"b{n}")
        for skip, take in ((0, 5), (100, 20), (320, 50), (5000, 5)):
            assert got(ranks, skip, take) == naive(now.values(), skip, take), (n, skip)
    assert sum(n for _, n in ranks.histogram()) == len(now)


def test_only_slices_left_or_entered_are_written(spark, tmp_path, monkeypatch):
    rows = [(f"u{k}", float(k), "x", None) for k in range(1000)]
    ranks = KeptRanks(spark, str(tmp_path)).begin(board([], spark).schema, 4)
    ranks.update(board(rows, spark), "all")
    before = ranks.board.parts()
    ranks.update(board([("u5", 900.0, "x", None)], spark), "one")
    after = ranks.board.parts()
    changed = {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
    assert len(changed) == 2 and len(before) > 20
    # A replayed batch counts once.
    version = ranks.board.version()
    ranks.update(board([("u5", 900.0, "x", None)], spark), "one")
    assert ranks.board.version() == version
    # Candidates read few rows of the board.
    read, plain = [], Store.read
    monkeypatch.setattr(Store, "read", lambda self, parts=None, version=None: (read.append(set(parts)), plain(self, parts, version))[1])
    got(ranks, 500, 10)
    assert sum(after[p]["rows"] for p in set().union(*read)) < 300


def test_a_cut_off_update_is_finished_by_its_replay(spark, tmp_path, monkeypatch):
    ranks = KeptRanks(spark, str(tmp_path)).begin(board([], spark).schema, 4)
    rows = [(f"u{k}", float(k), "x", None) for k in range(50)]
    ranks.update(board(rows, spark), "all")
    plain = ranks.places.merge
    monkeypatch.setattr(ranks.places, "merge", lambda *a: (_ for _ in ()).throw(RuntimeError("cut off")))
    batch = board([("u3", 1e6, "x", None)], spark)
    with pytest.raises(RuntimeError):
        ranks.update(batch, "b")
    monkeypatch.setattr(ranks.places, "merge", plain)
    ranks.update(batch, "b")
    ranks.update(board([("u3", 2.5, "x", None)], spark), "c")
    rows[3] = ("u3", 2.5, "x", None)
    assert got(ranks, 0, 100) == naive(rows, 0, 100)


def test_members_come_and_go(spark, tmp_path):
    ranks = region_board(spark, str(tmp_path)).begin(board([], spark).schema, 4)
    ranks.update(board([("a", 3.0, "x", "San Francisco"), ("b", 2.0, "x", "Paris"), ("c", 1.0, "x", "San Francisco")], spark), "1")
    assert got(ranks, 0, 9) == [(1, "a"), (2, "c")]
    ranks.update(board([("a", 3.0, "x", "Paris"), ("b", 2.0, "x", "San Francisco")], spark), "2")
    assert got(ranks, 0, 9) == [(1, "b"), (2, "c")]


def test_slices_keep_the_order_of_scores(spark):
    xs = [None, float("-inf"), -3e38, -5.0, -1e-30, -0.0, 0.0, 1e-45, 0.3, 1.0, 1.0000001, 7e5, 3.4e38, float("inf"), math.nan]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(xs)], "k int, s double")
    parts = [r.p for r in df.select("k", part_of(score_part("s", 16)).alias("p")).orderBy("k").collect()]
    heights = [_height(p) for p in parts]
    assert heights == sorted(heights) and len(set(heights)) >= 9, parts
