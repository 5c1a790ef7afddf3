"""Deltas against a full computation, replay at every point, stale shares, dead letters, pruned logs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from forgerank.operators import ingest as I
from forgerank.operators.upsert import replace_rows, upsert
from forgerank.plans import registry  # noqa: F401  (the registry loads the query modules in order)
from forgerank.plans import q_stream
from forgerank.session import scratch_path
from forgerank.sources.store import Store
from forgerank.streaming import incremental as R

PRS = "id string, username string, repo_name string, merged_at timestamp_ntz, created_at timestamp_ntz, seq struct<a:int>"
REPOS = "repo_name string, stars int, total_prs int"


def prs(spark, rows, start=0):
    return spark.createDataFrame([(i, u, r, None, None, (start + k,)) for k, (i, u, r) in enumerate(rows)], PRS)


def scores(state, **kw):
    return {r.username: (round(r.total_score, 9), r.n_repos, r.contribution_count) for r in state.scores(**kw).collect()}


def naive(seen, repos):
    """By user, from the first row of each id and the repositories as they are."""
    first, n, out = {}, {}, {}
    for i, u, r in seen:
        first.setdefault(i, (u, r))
    for u, r in first.values():
        if u is not None:
            n[u, r] = n.get((u, r), 0) + 1
    for (u, r), k in n.items():
        stars, total = repos.get(r, (0, 0))
        share = min(stars * k / total, 10000.0) if total > 0 else 0.0
        if share > 0:
            t, c, p = out.get(u, (0.0, 0, 0))
            out[u] = (t + share, c + 1, p + k)
    return {u: (round(t, 9), c, p) for u, (t, c, p) in out.items()}


def test_any_order_of_batches_equals_one_computation(spark):
    r = random.Random(4)
    state, seen, repos = R.Refresh(spark, scratch_path(spark, "t_state"), 4), [], {}
    for k in range(6):
        if k % 2:
            rows = [(f"{r.randint(0, 60)}", r.choice("uvw") if r.random() > 0.05 else None, f"o/{r.randint(0, 5)}") for _ in range(25)]
            once = {}
            for x in rows:
                once.setdefault(x[0], x)
            state.pull_requests(prs(spark, rows), f"p{k}")
            seen += rows
        else:
            rows = [(f"o/{i}", r.choice([0, 7, 30]), r.choice([0, 4, 16])) for i in r.sample(range(7), 4)]
            state.repositories(spark.createDataFrame(rows, REPOS), f"r{k}")
            repos.update({a: (b, c) for a, b, c in rows})
        assert scores(state) == naive(seen, repos)


def test_a_changed_repository_writes_its_contributors_only(spark):
    state = R.Refresh(spark, scratch_path(spark, "t_state"), 8)
    state.repositories(spark.createDataFrame([(f"o/{i}", 10, 10) for i in range(40)], REPOS), "r0")
    state.pull_requests(prs(spark, [(str(i), f"u{i}", f"o/{i}") for i in range(40)]), "p0")
    before, pairs = state.totals.parts(), state.pairs.parts()
    state.repositories(spark.createDataFrame([("o/3", 20, 10)] + [(f"o/{i}", 10, 10) for i in range(40) if i != 3], REPOS), "r1")
    after, now = state.totals.parts(), state.pairs.parts()
    assert sum(after[p] != before[p] for p in after) == 1 and sum(now[p] != pairs[p] for p in now) == 1
    assert scores(state)["u3"] == (2.0, 1, 1) and scores(state)["u4"] == (1.0, 1, 1)


def test_stale_shares(spark):
    state = R.Refresh(spark, scratch_path(spark, "t_state"), 2)
    state.repositories(spark.createDataFrame([("o/a", 10, 4), ("o/b", 6, 2)], REPOS), "r0")
    state.pull_requests(prs(spark, [("1", "u", "o/a"), ("2", "u", "o/b"), ("3", "v", "o/a")]), "p0")
    state.repositories(spark.createDataFrame([("o/a", 10, 0)], REPOS), "r1")  # shares of o/a are zero now
    assert scores(state) == {"u": (3.0, 1, 1)}
    assert scores(state, keep_stale=True) == {"u": (5.5, 2, 2), "v": (2.5, 1, 1)}
    state.pull_requests(prs(spark, [("4", "v", "o/a")]), "p1")  # the row that stays is the one last written
    assert scores(state, keep_stale=True)["v"] == (2.5, 1, 1)
    state.repositories(spark.createDataFrame([("o/a", 10, 5)], REPOS), "r2")
    assert scores(state) == scores(state, keep_stale=True) == {"u": (5.0, 2, 2), "v": (4.0, 1, 2)}


@pytest.mark.parametrize("cut", [0, 1, 2, 3])
def test_a_batch_cut_off_anywhere_counts_once(spark, monkeypatch, cut):
    """The run ends before, between and after the tables take the batch, then the batch is replayed."""
    state = R.Refresh(spark, scratch_path(spark, "t_state"), 2)
    state.repositories(spark.createDataFrame([("o/a", 10, 4), ("o/b", 100, 1)], REPOS), "r0")
    state.pull_requests(prs(spark, [("1", "u", "o/a")]), "p0")
    batch, done = prs(spark, [("1", "u", "o/b"), ("2", "u", "o/a"), ("3", "v", "o/b")]), []
    add, merge = R.IdLog.add, Store.merge

    def or_lost(f):
        def run(*a, **k):
            if len(done) == cut:
                raise RuntimeError("lost")
            done.append(1)
            return f(*a, **k)
        return run

    monkeypatch.setattr(R.IdLog, "add", or_lost(add))
    monkeypatch.setattr(Store, "merge", or_lost(merge))
    if cut < 3:
        with pytest.raises(RuntimeError):
            state.pull_requests(batch, "p1")
    else:
        state.pull_requests(batch, "p1")
    monkeypatch.undo()
    again = R.Refresh(spark, state.path)
    if cut < 3:  # a batch whose last table has been published is never given again by the stream
        again.pull_requests(batch, "p1")
    assert scores(again) == {"u": (5.0, 1, 2), "v": (100.0, 1, 1)}


def test_a_batch_is_folded_once_and_merged_without_a_fold(spark, monkeypatch):
    """What the tables take is read as it was written: the sums by user are not made again for each
    use, and stored pairs are not sorted and folded with the new ones."""
    state, plans = R.Refresh(spark, scratch_path(spark, "t_state"), 2), {}
    merge = Store.merge

    def seen(store, batch, change, *a):
        def plan(df):
            return df._jdf.queryExecution().executedPlan().toString()

        plans[store.path.rpartition("/")[2]] = plan(batch), plan(change(store.read(), batch))
        return merge(store, batch, change, *a)

    monkeypatch.setattr(Store, "merge", seen)
    state.repositories(spark.createDataFrame([("o/a", 10, 4)], REPOS), "r0")
    for k in range(2):
        state.pull_requests(prs(spark, [(str(k), "u", "o/a"), (f"{k}v", f"v{k}", "o/a")]), f"p{k}")
    assert "Aggregate" not in plans["scores"][0]
    assert "Aggregate" not in plans["pairs"][1] and "Aggregate" not in plans["repos"][1]
    assert scores(state) == {"u": (5.0, 1, 2), "v0": (2.5, 1, 1), "v1": (2.5, 1, 1)}


def test_replaced_rows_equal_an_upsert(spark):
    schema = "repo_name string, username string, n long, last string"
    old = spark.createDataFrame([("a", "u", 1, "x"), ("a", "v", 2, None), ("b", "u", 3, "y")], schema)
    new = spark.createDataFrame([("a", "v", 5, "z"), ("b", "w", 6, None), ("b", "u", 7, None)], schema)
    for o, n in ((old, new), (old.limit(0), new), (old, new.limit(0))):
        want = upsert(o, n, ["repo_name", "username"], ["n"])
        got = replace_rows(o, n, ["repo_name", "username"])
        assert got.columns == want.columns and sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_payloads_are_made_of_dealt_rows(spark, monkeypatch):
    """One file of users or repositories does not mean one task that makes and parses all payloads."""
    asked = []
    path = R.land_in_files(spark.range(100).coalesce(1), scratch_path(spark, "t_landing"), 4,
                           build=lambda df: asked.append(df.rdd.getNumPartitions()) or df.selectExpr("cast(id as string) as response"))
    rows = spark.read.parquet(path)
    assert asked == [4] and rows.columns == ["response"] and rows.distinct().count() == 100

    class Stop(Exception):
        pass

    def stop(profiles, *_):
        asked.append(profiles._jdf.queryExecution().optimizedPlan().toString())
        raise Stop

    monkeypatch.setattr(q_stream, "full_refresh", stop)
    with pytest.raises(Stop):
        q_stream.q_full_refresh(spark, SMALL)
    assert "RepartitionByExpression [username" in asked[1]


def test_bad_payload_mended_in_the_next_run(spark):
    state = R.Refresh(spark, scratch_path(spark, "t_state"), 2)
    good = '{"repository":{"name":"a","owner":{"login":"o"},"stargazerCount":10,"pullRequests":{"totalCount":4}}}'
    odd = '{"repo":{"name":"b","owner":{"login":"o"},"stargazerCount":6,"pullRequests":{"totalCount":2}}}'
    landing = scratch_path(spark, "t_landing")
    payloads = spark.createDataFrame([("o/a", good), ("o/b", odd), ("o/c", "{"), (None, None)], "cache_key string, response string")
    payloads.coalesce(1).write.parquet(landing)
    R.refresh_repositories(state, landing)
    state.pull_requests(prs(spark, [("1", "u", "o/a"), ("2", "u", "o/b")]), "p0")
    assert scores(state) == {"u": (2.5, 1, 1)}
    letters = {r.cache_key: (r.reason, r.version, r.n_tries, r.solved) for r in state.dead_letters.read().collect()}
    assert letters == {"o/b": ("repository not found", "1", 1, False), "o/c": ("not JSON", "1", 1, False), None: ("not JSON", "1", 1, False)}
    # The same parser leaves them; the next version reads one of them.
    state.repository_payloads(payloads.limit(0), "x1")
    assert {r.n_tries for r in state.dead_letters.read().collect()} == {1}

    def parse(df):
        return I.parse_repository(df.withColumn("response", F.regexp_replace("response", '"repo":', '"repository":')))

    state.repository_payloads(payloads.limit(0), "x2", parse, "2")
    assert scores(state) == {"u": (5.5, 2, 2)}
    letters = {r.cache_key: (r.version, r.n_tries, r.solved) for r in state.dead_letters.read().collect()}
    assert letters == {"o/b": ("2", 2, True), "o/c": ("2", 2, False), None: ("2", 2, False)}


def test_served_log_reads_days_within_a_ttl(spark):
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    schema = "cache_key string, requested_at timestamp_ntz"
    path = scratch_path(spark, "t_served") + "/log"
    serve = R._serve_batch(spark, path, 10)
    for k in range(6):
        serve(spark.createDataFrame([(f"k{i}", day(20 * k + i)) for i in range(4)], schema), k)
    log = spark.read.schema(R.SERVED).parquet(path)
    late = spark.createDataFrame([("k1", day(45)), ("new", day(43))], schema)
    near = R._near(log, late, 10)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and ">= 2024-02-03" in plan and "<= 2024-02-25" in plan
    read = {r[0] for r in near.select(F.input_file_name()).distinct().collect()}
    assert len(log.inputFiles()) == 24 and len(read) == 4 and all("/day=2024-02-1" in f for f in read)
    serve(late, 6)
    serve(late, 6)
    assert spark.read.schema(R.SERVED).parquet(path).where("batch_id = 6").select("cache_key").collect() == [("new",)]
    R.forget_served(spark, path.removesuffix("/log"), f"{day(60):%Y-%m-%d}")
    assert min(r.requested_at for r in spark.read.schema(R.SERVED).parquet(path).collect()) == day(60)
