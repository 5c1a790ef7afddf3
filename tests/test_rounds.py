"""Enrichment rounds: states that merge, counters that move, landings cut off."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from forgerank.operators import outcomes as O
from forgerank.operators import ranking as R
from forgerank.operators import rounds as RO
from forgerank.session import scratch_path

BODIES = [(200, '[{"open_to_work":true}]'), (200, '[{"open_to_work":false}]'), (500, None), (429, None), (404, None), (200, '{"x":1}')]
BOARD = "username string, total_score double, location string, linkedin string, is_open_to_work boolean, " \
        "otw_scraped_at timestamp_ntz, otw_permanent_failure boolean, otw_error_code string"


@pytest.fixture(scope="module")
def landed(spark):
    r = random.Random(5)
    rows = []
    for k in range(240):
        status, body = r.choice(BODIES[2:4] if r.random() < 0.5 else BODIES)
        rows.append((f"u{r.randrange(40)}", k, status, body, None))
    rows += [(None, 900, 200, BODIES[0][1], None), (None, 901, 500, None, None)]
    return spark.createDataFrame(rows, "username string, seq long, status int, body string, error_text string")


def board(spark):
    where = ["Bay Area", None, "Berlin", "Oakland"]
    rows = [(f"u{k}", float(k), where[k % 4], None if k % 5 == 0 else "x", [None, True, False][k % 3], None, [None, True][k % 2], None)
            for k in range(45)]
    return spark.createDataFrame(rows, BOARD)


def texts(df, *cols):
    cols = cols or sorted(df.columns)
    return sorted(str(tuple(r)) for r in df.select(*cols).collect())


def test_states_resolve_as_attempts_do(spark, landed):
    c = O.classify(landed, "regional")
    want = O.resolve_attempts(c)
    got = RO.resolve_states(RO.attempt_states(c))
    assert sorted(got.columns) == sorted(want.columns)
    assert texts(got, *sorted(want.columns)) == texts(want, *sorted(want.columns))


def test_merging_does_not_depend_on_cuts_or_order(spark, landed):
    c = O.classify(landed, "regional")
    cuts = [RO.attempt_states(c.where(F.col("seq") % 3 == k)) for k in range(3)]
    want = texts(RO.attempt_states(c))
    for a, b, d in itertools.permutations(cuts):
        assert texts(RO.merge_states(RO.merge_states(a, b), RO.merge_states(d, a))) == want


@pytest.mark.parametrize("mode", ["regional", "global"])
def test_rounds_equal_one_landing(spark, as_of, landed, mode):
    rounds = RO.EnrichmentRounds(spark, scratch_path(spark, "rounds_test"), mode).begin(board(spark), 8)
    start = rounds.statistics().first()
    assert start["total"] == 0 and start["members"] == R.region_count(board(spark)).first()["members"]
    for k in (2, 0, 1):
        assert rounds.land(landed.where(F.col("seq") % 3 == k), as_of, f"t{k}")
    assert not rounds.land(landed.where("seq % 3 = 0"), as_of, "t0")
    rounds.land(landed.where("seq < 60"), as_of, "seen before")
    rounds.land(landed.limit(0), as_of, "empty")
    res = O.resolve_attempts(O.classify(landed, mode))
    want = (O.apply_outcomes if mode == "regional" else O.apply_outcomes_overwrite)(board(spark), res, as_of)
    assert texts(rounds.board.read()) == texts(want)
    got = rounds.statistics().first().asDict()
    a16 = O.outcome_summary(res).first().asDict()
    a13 = R.region_outcome_counts(want).first().asDict()
    assert {k: got[k] for k in a16} == a16
    assert [got["members_open"], got["members_not_open"], got["members_failed"]] == list(a13.values())


@pytest.mark.parametrize("broken", ["board", "states"])
def test_a_landing_cut_off_is_landed_again(spark, as_of, landed, broken, monkeypatch):
    def go(cut):
        rounds = RO.EnrichmentRounds(spark, scratch_path(spark, "rounds_cut")).begin(board(spark), 4)
        rounds.land(landed.where("seq < 120"), as_of, "a")
        if cut:
            store = getattr(rounds, broken)
            with monkeypatch.context() as m:
                m.setattr(store, "merge", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
                with pytest.raises(RuntimeError):
                    rounds.land(landed.where("seq >= 120"), as_of, "b")
        rounds.land(landed.where("seq >= 120"), as_of, "b")
        return texts(rounds.board.read()), rounds.statistics().first()

    assert go(True) == go(False)


def test_untouched_parts_keep_their_files(spark, as_of, landed):
    rounds = RO.EnrichmentRounds(spark, scratch_path(spark, "rounds_parts")).begin(board(spark), 16)
    before = rounds.board.parts()
    one = landed.where("username = 'u1'")
    rounds.land(one, as_of, "one")
    touched = set(rounds.base.touched(one))
    after = rounds.board.parts()
    assert touched and {p for p in after if after[p]["write"] != before[p]["write"]} <= touched
