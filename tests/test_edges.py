"""Hand-made edge rows per operator."""

import datetime as dt

from pyspark.sql import functions as F

from forgerank.functions import columns as C
from forgerank.operators import analysis as AN
from forgerank.operators import cache as CA
from forgerank.operators import discovery as DI
from forgerank.operators import ingest as I
from forgerank.operators import outcomes as O
from forgerank.operators import ranking as R
from forgerank.operators import scoring as S
from forgerank.operators import upsert as U


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_repo_score_guards_and_cap(spark):
    df = spark.createDataFrame(
        [(1, 0, 50), (1, -1, 50), (1, None, 50), (1, 2, None), (1, 1, 9), (1, 1, 10),
         (99999, 100000, 10000), (1, 1, 10000), (10001, 10000, 10000), (5, 2, 100)],
        "u int, t int, s int")
    stage2 = [r[0] for r in df.select(C.repo_score("u", "t", "s")).collect()]
    assert stage2[:4] == [0.0, 0.0, 0.0, 0.0]          # null/0/negative totals, null stars
    assert stage2[4] == 9.0 and stage2[5] == 10.0       # no star cutoff in stage 2
    assert abs(stage2[6] - 9999.9) < 1e-9
    assert stage2[7] == 10000.0 and stage2[8] == 10000.0  # capped
    assert stage2[9] == 250.0                            # user_prs > total_prs is not capped by share
    model_a = [r[0] for r in df.select(C.repo_score("u", "t", "s", min_stars=10)).collect()]
    assert model_a[4] == 0.0 and model_a[5] == 10.0


def test_experience_level_boundaries(spark):
    vals = [9.99, 10, 99.99, 100, 499.99, 500, 1999.99, 2000]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = [r[0] for r in df.select(C.experience_level("x")).collect()]
    assert got == ["Newcomer", "Contributor", "Contributor", "Active Contributor",
                   "Active Contributor", "Core Contributor", "Core Contributor", "Open Source Leader"]


def test_follower_slices(spark):
    df = spark.createDataFrame([(v,) for v in [0, 9, 10, 20, 21, 10000, 10001]], "f int")
    got = [r[0] for r in df.select(C.follower_slice("f")).collect()]
    assert got == ["0..9", "0..9", "10..20", "10..20", "21..30", "5001..10000", ">10000"]


def test_split_locations(spark):
    df = spark.createDataFrame([(" Sydney , ,Berlin,",)], "arg string")
    assert sorted(r[0] for r in DI.locations_from_argument(df).collect()) == ["Berlin", "Sydney"]


def test_extract_link_forms(spark):
    acc = "array<struct<provider:string,url:string>>"
    df = spark.createDataFrame([
        ([("LINKEDIN", "https://www.linkedin.com/in/acc")], "lnkd.in/bio", None),
        ([("TWITTER", "https://t")], "see LinkedIn.com/in/Bio_1 now", "https://linkedin.com/in/web"),
        ([], None, "https://LINKEDIN.COM/in/web-2"),
        (None, "nothing", "none"),
        ([], "lnkd.in/x_5", None),
    ], f"a {acc}, bio string, web string")
    got = [r[0] for r in df.select(C.extract_link(F.col("a"), F.col("bio"), F.col("web"))).collect()]
    assert got == ["https://www.linkedin.com/in/acc", "https://linkedin.com/in/Bio_1",
                   "https://linkedin.com/in/web-2", None, "https://linkedin.com/in/x_5"]


def test_region_substring_overmatch(spark):
    df = spark.createDataFrame([("Mansfield",), ("Louisville",), ("Latin America",),
                                ("Bay Area, CA",), (None,), ("Berlin",)], "location string")
    got = [r[0] for r in df.select(C.in_region("location")).collect()]
    assert got == [True, True, True, True, False, False]


def test_categories_substring_overtrigger(spark):
    df = spark.createDataFrame([(["Email"], None), (["django"], None), (["build"], None),
                                (["javascript"], None), (None, "Go"), (None, ""), ([], None)],
                               "topics array<string>, primary_language string")
    got = [tuple(r[0]) for r in AN.categorize_substring(df).select("categories").collect()]
    assert got[0] == ("ai",)                   # "email" contains "ai"
    assert got[1] == ("backend",)              # django contains go and django
    assert got[2] == ("frontend",)             # "build" contains "ui"
    assert set(got[3]) == {"backend", "frontend"}  # javascript contains java
    assert got[4] == ("backend",) and got[5] == () and got[6] == ()


def test_categories_exact_and_language_fallback(spark):
    df = spark.createDataFrame([(["docker"], "Python"), ([], "Python"), ([], "python"),
                                (["Machine-Learning"], None), (None, "Go")],
                               "topics array<string>, primary_language string")
    got = [tuple(r[0]) for r in S.categorize_exact(df).select("categories").collect()]
    assert got == [("Backend", "DevOps"), ("AI",), (), ("AI",), ("Backend",)]


def test_union_first_wins_and_topn_ties(spark):
    cand = spark.createDataFrame([
        ("u", 0, 1, "a/x", 5), ("u", 1, 1, "a/x", 99), ("u", 1, 2, "b/y", 3)],
        "username string, relation int, pos int, full_name string, stars int")
    got = rows(AN.user_repos_union(cand).orderBy("full_name"), "full_name", "relation", "stars")
    assert got == [("a/x", 0, 5), ("b/y", 1, 3)]


def _lists(spark):
    users = spark.createDataFrame([("u",), ("v",), ("v",), (None,)], "username string")
    repos = spark.createDataFrame(
        [(o, n, s, lang, langs, topics, 9, False, None) for o, n, s, lang, langs, topics in (
            ("u", "own", 50, "Go", ["Go", ""], ["API"]), ("u", "unsearched", 3, None, None, ["api", None]),
            ("v", "x", 20, "C", ["C"], None), ("v", "x", 20, "C", ["C"], None), ("w", "y", 30, "R", [], ["z", "C"]),
            ("u/a", "b", 40, "Lua", ["Lua"], []), (None, "n", 70, "Perl", ["Perl"], []))],
        "owner_login string, repo_name string, stars int, primary_language string, languages array<string>, topics array<string>, "
        "total_prs int, is_fork boolean, pushed_at timestamp_ntz")
    prs = spark.createDataFrame([(str(k), u, r) for k, (u, r) in enumerate(
        [("u", "u/own")] * 3 + [("u", "u/unsearched"), ("u", "v/x"), ("u", "v/x"), ("u", "u/a/b"), ("v", "w/y"), ("v", "v/x"),
         ("x", "w/y"), (None, "w/y"), ("u", None), ("v", "gone/gone")])], "id string, username string, repo_name string")
    return AN.model_a_inputs(users, repos, prs)


def test_repo_lists_with_counts_of_own_contributed_and_unsearched_repos(spark):
    got = rows(_lists(spark).orderBy("username", "position"), "username", "relation", "full_name", "user_prs")
    assert got == [("u", 0, "u/own", 3), ("u", 0, "u/unsearched", 0), ("u", 1, "u/a/b", 1), ("u", 1, "v/x", 2),
                   ("v", 0, "v/x", 1), ("v", 1, "w/y", 1)]
    assert sorted(rows(AN.unique_skills(_lists(spark)), "username", "unique_skills")) == [("u", "go,lua,c,api"), ("v", "c,z")]


def test_skills_of_repo_lists_deal_the_lists_once(spark):
    """From the lists on, every step is by user: one exchange of the lists, none of their exploded rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for f in (AN.unique_skills, S.top_skills_by_frequency):
            plan = f(_lists(spark))._jdf.queryExecution().executedPlan().toString()
            by_user = [x for x in plan.split("\n") if "Exchange hashpartitioning(username" in x]
            assert not [x for x in by_user if "skill" in x], plan
            assert plan.count("REPARTITION_BY_COL") == 1 and plan.count("Scan parquet") <= 2, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_topic_skills_alphabetical_first_ten(spark):
    topics = [f"T{i:02d}" for i in range(12, 0, -1)]
    df = spark.createDataFrame([("u", topics[:6]), ("u", topics[6:] + ["t01"])], "username string, topics array<string>")
    got = AN.topic_skills(df).collect()[0]["skills"].split(",")
    assert got == [f"t{i:02d}" for i in range(1, 11)]


def test_upsert_semantics(spark):
    old = spark.createDataFrame([("k", 1, "old", 0)], "id string, v int, keep string, seq int")
    new = spark.createDataFrame([("k", 2, "new1", 1), ("k", 3, "new2", 2), ("j", 9, "n", 1)],
                                "id string, v int, keep string, seq int")
    out = U.upsert(old, new, ["id"], ["seq"], update_cols=["v"], drop=["seq"])
    assert sorted(rows(out, "id", "v", "keep")) == [("j", 9, "n"), ("k", 3, "old")]
    twice = U.upsert(U.upsert(old, new, ["id"], ["seq"], drop=["seq"]).withColumn("seq", F.lit(0)),
                     new, ["id"], ["seq"], drop=["seq"])
    once = U.upsert(old, new, ["id"], ["seq"], drop=["seq"])
    assert sorted(rows(twice, "id", "v", "keep")) == sorted(rows(once, "id", "v", "keep"))


def test_short_name_upsert_replaces_owner(spark):
    ts = dt.datetime(2024, 1, 1)
    new = spark.createDataFrame([("tool", "alice", 5, ts, 0), ("tool", "bob", 7, ts, 1)],
                                "repo_name string, owner_login string, stars int, scraped_at timestamp_ntz, pos int")
    out = U.upsert_repos_short_name(None, new, ["scraped_at", "pos"])
    assert rows(out, "repo_name", "owner_login", "stars") == [("tool", "bob", 7)]


def test_freshness_edges(spark, as_of):
    a = dt.datetime(2024, 2, 15)
    df = spark.createDataFrame([("exact", a - dt.timedelta(days=30)),
                                ("inside", a - dt.timedelta(days=30) + dt.timedelta(milliseconds=1)),
                                ("null", None)], "username string, scraped_at timestamp_ntz")
    assert rows(CA.fresh_users(df, as_of), "username") == [("inside",)]
    resp = spark.createDataFrame([("now", a), ("later", a + dt.timedelta(seconds=1)),
                                  ("before", a - dt.timedelta(seconds=1))], "cache_key string, expires_at timestamp_ntz")
    assert sorted(rows(U.live_responses(resp, as_of), "cache_key")) == [("later",)]
    assert sorted(rows(U.purge_expired(resp, as_of), "cache_key")) == [("later",), ("now",)]


def test_profile_lookup_lowercases_the_request_only(spark, as_of):
    a = dt.datetime(2024, 2, 10)
    users = spark.createDataFrame([("alice", a), ("Bob", a)], "username string, scraped_at timestamp_ntz")
    for c in ["name", "avatar_url", "company", "blog", "location", "email", "bio", "twitter_username"]:
        users = users.withColumn(c, F.lit(None).cast("string"))
    users = users.withColumn("hireable", F.lit(None).cast("boolean")).withColumn(
        "followers", F.lit(1)).withColumn("following", F.lit(1))
    req = spark.createDataFrame([("Alice",), ("Bob",)], "username string")
    assert rows(CA.profile_lookup(users, req, as_of), "login") == [("alice",)]


def test_discovery_case_insensitive_anti_join(spark, as_of):
    a = dt.datetime(2024, 2, 15)
    users = spark.createDataFrame([("Alice", a - dt.timedelta(minutes=10)), ("carol", a - dt.timedelta(hours=2))],
                                  "username string, scraped_at timestamp_ntz")
    found = spark.createDataFrame([("Alice",), ("alice",), ("carol",), ("dave",)], "username string")
    todo = sorted(r[0] for r in DI.discover_todo(users, found, as_of).collect())
    assert todo == ["carol", "dave"]   # 'alice' is skipped too: the fresh set is lower-cased


def _board(spark, n, link=True):
    data = [(f"u{i:03d}", float(i % 7), "x" if link else "", None, None) for i in range(n)]
    return spark.createDataFrame(data, "username string, total_score double, linkedin string, "
                                       "is_open_to_work boolean, otw_permanent_failure boolean")


def test_distributed_rank_equals_naive(spark):
    from pyspark.sql import Window as W
    b = _board(spark, 500).repartition(7)
    got = {r["username"]: r["rnk"] for r in R.global_rank(b, R.score_order()).collect()}
    w = W.orderBy(*R.score_order())
    naive = {r["username"]: r["rnk"] for r in b.withColumn("rnk", F.row_number().over(w)).collect()}
    assert got == naive


def test_rank_offsets_and_eligibility(spark):
    b = _board(spark, 10)
    assert R.enrich_candidates_global(b, skip=10, take=5).count() == 0
    assert R.enrich_candidates_global(b, skip=9, take=5).count() == 1
    assert R.enrich_candidates_global(b, skip=0, take=5).count() == 5
    assert R.enrich_candidates_global(_board(spark, 10, link=False), skip=0, take=5).count() == 0
    flags = spark.createDataFrame([("a", 3.0, "x", None, None), ("b", 2.0, "x", None, False),
                                   ("c", 1.0, "x", None, True), ("d", 0.5, "x", True, None)],
                                  "username string, total_score double, linkedin string, "
                                  "is_open_to_work boolean, otw_permanent_failure boolean")
    ranked = R.global_rank(flags, R.score_order())
    assert sorted(r[0] for r in ranked.where(R.eligible()).select("username").collect()) == ["a", "b"]


def test_attempt_resolution(spark):
    data = [("r_then_ok", 0, 500, "x", None), ("r_then_ok", 1, 200, '[{"open_to_work":true}]', None),
            ("r_then_ok", 2, 404, "x", None),
            ("perm_first", 0, 404, "x", None), ("perm_first", 1, 200, '[{"open_to_work":true}]', None),
            ("three_r", 0, 500, "x", None), ("three_r", 1, 429, "x", None), ("three_r", 2, 503, "x", None)]
    df = spark.createDataFrame(data, "username string, attempt int, status int, body string, error_text string")
    res = {r["username"]: r for r in O.resolve_attempts(O.classify(df), order="attempt").collect()}
    assert res["r_then_ok"]["success"] and res["r_then_ok"]["attempt"] == 1
    assert res["perm_first"]["permanent"] and res["perm_first"]["error_code"] == "HTTP_404"
    assert res["three_r"]["attempt"] == 2 and not res["three_r"]["permanent"]
    assert res["three_r"]["error_code"] == "HTTP_503"


def test_response_forms(spark):
    data = [('[{"data":{"open_to_work":true}}]', 200, None, True, None),
            ('[{"open_to_work":false}]', 200, None, False, None),
            ('{"data":{"open_to_work":true}}', 200, None, True, None),
            ('[{"messages":"timed out"}]', 200, None, None, "APIFY_TIMEOUT"),
            ("[]", 200, None, None, "INVALID_RESPONSE"), ('{"x":1}', 200, None, None, "INVALID_RESPONSE"),
            ('[{"open_to_work":"true"}]', 200, None, None, "INVALID_RESPONSE"),
            ("not json", 200, None, None, "UNKNOWN_ERROR"), ("", 503, None, None, "HTTP_503"),
            (None, None, "connect ECONNREFUSED", None, "TRANSIENT_ERROR"),
            (None, None, "boom", None, "UNKNOWN_ERROR")]
    df = spark.createDataFrame([(f"u{i}", 0, d[1], d[0], d[2]) for i, d in enumerate(data)],
                               "username string, attempt int, status int, body string, error_text string")
    got = {r["username"]: (r["open_to_work"], r["error_code"]) for r in O.classify(df).collect()}
    for i, d in enumerate(data):
        assert got[f"u{i}"] == (d[3], d[4]), (i, d, got[f"u{i}"])


def test_apply_outcomes_rules(spark, as_of):
    board = spark.createDataFrame([("ok", None, None, None, None), ("perm", None, None, None, None),
                                   ("trans", True, None, None, None), ("none", False, None, None, None)],
                                  "username string, is_open_to_work boolean, otw_scraped_at timestamp_ntz, "
                                  "otw_permanent_failure boolean, otw_error_code string")
    out = spark.createDataFrame([("ok", True, True, False, None), ("perm", False, None, True, "HTTP_404"),
                                 ("trans", False, None, False, "HTTP_500")],
                                "username string, success boolean, open_to_work boolean, permanent boolean, error_code string")
    got = {r["username"]: r for r in O.apply_outcomes(board, out, as_of).collect()}
    assert got["ok"]["is_open_to_work"] is True and got["ok"]["otw_permanent_failure"] is False
    assert got["perm"]["otw_permanent_failure"] is True and got["perm"]["otw_error_code"] == "HTTP_404"
    assert got["trans"]["is_open_to_work"] is True and got["trans"]["otw_scraped_at"] is None
    assert got["none"]["is_open_to_work"] is False
    g2 = {r["username"]: r for r in O.apply_outcomes_overwrite(board, out, as_of).collect()}
    assert g2["trans"]["is_open_to_work"] is None and g2["trans"]["otw_scraped_at"] is not None


def test_parse_payload_edges(spark):
    landed = spark.createDataFrame([
        ("missing", '{"user": null}'),
        ("ok", '{"user": {"login": "ok", "followers": {"totalCount": 3}, "following": {"totalCount": 1},'
               ' "websiteUrl": "lnkd.in/w1", "socialAccounts": {"nodes": [{"provider": "TWITTER", "url": "t"}]}}}')],
        "cache_key string, response string")
    ok, bad = I.parse_profile(landed)
    assert rows(ok, "username", "followers", "blog", "website_url", "linkedin") == [
        ("ok", 3, "lnkd.in/w1", "lnkd.in/w1", "https://linkedin.com/in/w1")]
    assert rows(bad, "cache_key") == [("missing",)]
    repos = spark.createDataFrame([("u", '{"user": {"repositories": {"nodes": [{"name": "a", "owner": {"login": "o"}}, '
                                         '{"name": null, "owner": {"login": "o"}}]}, "repositoriesContributedTo": '
                                         '{"nodes": [{"name": "a", "owner": {"login": "o"}, "stargazerCount": 50}]}}}')],
                                  "cache_key string, response string")
    got = rows(I.parse_repos(repos), "full_name", "stars", "is_fork", "total_prs", "topics")
    assert got == [("o/a", 0, False, 0, [])]
    prs = spark.createDataFrame([("o/a", '{"repository": {"pullRequests": {"nodes": [{"id": "1", "author": null,'
                                         ' "mergedAt": ""}, {"id": "2", "author": {"login": "x"}, "mergedAt": "2024-01-02T00:00:00Z"}]}}}')],
                                "cache_key string, response string")
    got = sorted(rows(I.parse_pull_requests(prs), "id", "author_login", "merged_at", "repo_id"))
    assert got == [("1", "ghost", None, "o/a"), ("2", "x", dt.datetime(2024, 1, 2), "o/a")]
    search = spark.createDataFrame([("me", '{"search": {"nodes": [{"id": "", "url": "u1", "repository": '
                                           '{"owner": {"login": "o"}, "name": "a"}}, {"id": "z", "repository": null}]}}')],
                                   "cache_key string, response string")
    assert rows(I.parse_pr_search(search), "username", "id", "repo_id") == [("me", "u1", "o/a")]


def test_stage4_pr_key_modes(spark):
    repos = spark.createDataFrame([("tool", "alice", 9, None, ["api"])],
                                  "repo_name string, owner_login string, stars int, primary_language string, topics array<string>")
    prs = spark.createDataFrame([("1", "alice", "alice/tool"), ("2", "alice", "alice/tool")],
                                "id string, username string, repo_name string")
    users = spark.createDataFrame([("alice",)], "username string")
    short = AN.analyze_users(repos, prs, users, pr_key="short").collect()[0]
    full = AN.analyze_users(repos, prs, users, pr_key="full").collect()[0]
    assert short["contribution_count"] == 0 and full["contribution_count"] == 2
    import math
    assert abs(full["total_score"] - (math.log(10) * 10 + 10)) < 1e-9
    assert abs(short["backend_score"] - short["total_score"]) < 1e-9


def test_typed_analyses_and_upsert(spark, as_of):
    repos = spark.createDataFrame([("tool", "Alice", 9, "Go", ["api", "ui"]), ("lib", "Alice", 0, None, None)],
                                  "repo_name string, owner_login string, stars int, primary_language string, topics array<string>")
    prs = spark.createDataFrame([("1", "Alice", "Alice/tool")], "id string, username string, repo_name string")
    users = spark.createDataFrame([("Alice",)], "username string")
    rows = AN.analyses_rows(repos, prs, users, as_of)
    r = rows.collect()[0]
    assert r["id"] == "alice" and r["unique_skills"] == ["api", "ui"]
    assert r["languages"] == {"Go": 1}
    assert [x["name"] for x in r["top_repos"]] == ["tool", "lib"]
    assert r["top_repos"][0]["categories"] == ["backend", "frontend"]
    again = AN.upsert_analyses(rows, rows)
    assert again.count() == 1


def test_request_dedupe_within_ttl(spark):
    from forgerank.session import scratch_path
    from forgerank.streaming.incremental import dedupe_requests, land_in_files
    t0 = dt.datetime(2024, 1, 1)
    rows = [("member:a", t0), ("member:b", t0 + dt.timedelta(hours=1)),
            ("member:a", t0 + dt.timedelta(days=2)), ("member:b", t0 + dt.timedelta(days=3))]
    df = spark.createDataFrame(rows, "cache_key string, requested_at timestamp")
    landing = land_in_files(df, scratch_path(spark, "t_requests"), 2)
    served = dedupe_requests(spark, landing, spark.read.parquet(landing).schema, ttl_days=30)
    assert sorted(r[0] for r in served.select("cache_key").collect()) == ["member:a", "member:b"]


def test_expired_and_late_requests_are_served(spark):
    from forgerank.session import scratch_path
    from forgerank.streaming.incremental import dedupe_requests, land_in_files
    t0 = dt.datetime(2024, 5, 1)
    day = lambda n: t0 + dt.timedelta(days=n)
    state = scratch_path(spark, "t_state")
    landing = scratch_path(spark, "t_requests")
    schema = "cache_key string, requested_at timestamp_ntz"
    first = [("a", day(0)), ("a", day(10)), ("a", day(45)), ("b", day(0)), ("b", day(30)), ("c", day(100))]
    land_in_files(spark.createDataFrame(first, schema), landing, 1)
    df_schema = spark.createDataFrame([], schema).schema
    got = lambda: sorted(map(tuple, dedupe_requests(spark, landing, df_schema, 30, state_dir=state).collect()))
    assert got() == [("a", day(0)), ("a", day(45)), ("b", day(0)), ("b", day(30)), ("c", day(100))]
    # A second run on the same state: a late key, a repeat inside the TTL, one after it.
    spark.createDataFrame([("late", day(-106)), ("a", day(50)), ("a", day(80))], schema).write.mode("append").parquet(landing)
    assert got() == [("a", day(0)), ("a", day(45)), ("a", day(80)), ("b", day(0)), ("b", day(30)), ("c", day(100)),
                     ("late", day(-106))]


def test_refresh_goes_on_after_a_stop(spark):
    from forgerank.session import scratch_path
    from forgerank.streaming.incremental import incremental_refresh
    repos = spark.createDataFrame([("a", "o", 10, 4), ("b", "o", 100, 1)], "repo_name string, owner_login string, stars int, total_prs int")
    users = spark.createDataFrame([("u", "U", "x"), ("v", "V", "y")], "username string, name string, avatar_url string")
    schema = ("id string, username string, repo_name string, merged_at timestamp_ntz, "
              "created_at timestamp_ntz, seq struct<a:int>")
    data = [("1", "u", "o/a", None, None, (1,)), ("2", "u", "o/b", None, None, (2,)), ("3", "v", "o/a", None, None, (3,)),
            ("2", "u", "o/a", None, None, (4,)), ("4", "v", "o/a", None, None, (5,))]
    parts = [spark.createDataFrame(data[a:b], schema) for a, b in ((0, 2), (2, 3), (3, 5))]
    landing, state = scratch_path(spark, "t_landing"), scratch_path(spark, "t_state")
    for p in parts[:2]:
        p.coalesce(1).write.mode("append").parquet(landing)
    s = parts[0].schema
    incremental_refresh(spark, landing, s, repos, users, buckets=8, state_dir=state)
    parts[2].coalesce(1).write.mode("append").parquet(landing)
    resumed = incremental_refresh(spark, landing, s, repos, users, buckets=5, state_dir=state)  # the stored 8 holds
    once = incremental_refresh(spark, landing, s, repos, users, files_per_batch=100)
    assert sorted(map(tuple, resumed.collect())) == sorted(map(tuple, once.collect()))


def test_inserted_leaderboard_rows_take_defaults(spark, as_of):
    old = spark.createDataFrame([("a", "A", "x", 1.0, None, True, 2.0)], "username string, name string, avatar_url string, "
                                "total_score double, updated_at timestamp_ntz, hireable boolean, ai_score double")
    scores = spark.createDataFrame([("a", 5.0), ("b", 6.0)], "username string, total_score double")
    prof = spark.createDataFrame([("a", "A2", "x"), ("b", "B", "y")], "username string, name string, avatar_url string")
    got = {r.username: r for r in U.sync_leaderboard(old, scores, prof, as_of).collect()}
    assert got["a"].hireable is True and got["a"].ai_score == 2.0 and got["a"].total_score == 5.0
    assert got["b"].hireable is False and got["b"].ai_score == 0.0


def test_added_columns_take_their_default(spark):
    out = U.evolve_schema(spark.createDataFrame([(1,)], "a int"), {"a": "string", "b": ("boolean", False), "c": "string"})
    assert out.collect()[0].asDict() == {"a": 1, "b": False, "c": None}


def test_iso_times(spark):
    texts = ["2024-01-01T00:00:00Z", "2024-01-01T00:00:00.123Z", "2024-01-01T02:00:00+02:00", "", None, "not a time"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(I.from_iso(F.col("t")).alias("t"))
    day = dt.datetime(2024, 1, 1)
    assert [r.t for r in df.collect()] == [day, day.replace(microsecond=123000), day, None, None, None]


def test_repo_nodes_without_owner_or_name_are_skipped(spark):
    body = '{"user":{"repositories":{"nodes":[{"name":"x","owner":{"login":""}},{"name":"","owner":{"login":"o"}},{"name":"x","owner":{"login":"o"}}]}}}'
    df = spark.createDataFrame([("u", body)], "cache_key string, response string")
    assert [r.full_name for r in I.parse_repos(df).collect()] == ["o/x"]


def test_a_pr_landed_twice_takes_one_place(spark):
    rows_ = [("r", "1", "u", dt.datetime(2024, 1, 3), (1,)), ("r", "1", "w", dt.datetime(2024, 1, 3), (2,)), ("r", "2", "u", dt.datetime(2024, 1, 2), (1,)),
             ("r", "3", "u", dt.datetime(2024, 1, 1), (1,))]
    df = spark.createDataFrame(rows_, "repo_name string, id string, username string, created_at timestamp_ntz, seq struct<a:int>")
    assert sorted(rows(I.newest_prs_per_repo(df, 2), "id", "username", "nth")) == [("1", "w", 1), ("2", "u", 2)]


def test_odd_messages_raise(spark):
    bodies = ['[{"messages":{"a":1}}]', '[{"messages":5}]', '[{"messages":true}]', '[{"messages":0,"open_to_work":true}]',
              '[{"messages":false,"open_to_work":true}]', '[{"messages":null,"open_to_work":true}]']
    df = spark.createDataFrame([(f"u{i}", i, 200, b, None) for i, b in enumerate(bodies)],
                               "username string, seq int, status int, body string, error_text string")
    got = {r.username: (r.error_code, r.open_to_work) for r in O.classify(df).collect()}
    assert [got[f"u{i}"] for i in range(6)] == [("UNKNOWN_ERROR", None)] * 3 + [(None, True)] * 3


def test_pr_with_missing_repo_is_dropped(spark):
    prs = spark.createDataFrame([("1", "u", "o/a"), ("2", "u", "o/gone")], "id string, username string, repo_name string")
    repos = spark.createDataFrame([("a", "o", 10, 20)], "repo_name string, owner_login string, total_prs int, stars int")
    got = rows(S.user_repo_stats(prs, repos), "username", "repo_name", "user_prs")
    assert got == [("u", "o/a", 1)]


def test_top_n_ties_break_on_name(spark):
    repos = spark.createDataFrame([(f"r{i:02d}", "own", 5, None, None) for i in range(11)],
                                  "repo_name string, owner_login string, stars int, primary_language string, topics array<string>")
    prs = spark.createDataFrame([], "id string, username string, repo_name string")
    users = spark.createDataFrame([("own",)], "username string")
    top = AN.analyze_users(repos, prs, users).collect()[0]["top_repos"]
    assert top == "r00,r01,r02,r03,r04"


def test_skill_frequency_ties_and_case(spark):
    data = [("u", "o/r1", "Go", ["API", "zeta"], 1), ("u", "o/r2", "go", ["api"], 2),
            ("u", "o/r3", None, ["beta", "alpha"], 1), ("u", "o/r4", None, ["gamma"], 0)]
    df = spark.createDataFrame(data, "username string, full_name string, primary_language string, "
                                     "topics array<string>, user_prs int").withColumn(
        "languages", F.array().cast("array<string>"))
    skills = S.top_skills_by_frequency(df).collect()[0]["skills"].split(",")
    # api and go in two repos each; the rest once, alphabetical; gamma's repo has no PRs
    assert skills == ["api", "go", "alpha", "beta", "zeta"]


def test_unreadable_payloads_are_kept_apart(spark):
    df = spark.createDataFrame([("a", "not json"), ("b", '{"user":null}'), ("c", '{"user":{}}'), ("d", None), ("e", "{}")],
                               "cache_key string, response string")
    got = dict(rows(I.unreadable(df, "user", "user not found"), "cache_key", "reason"))
    assert got == {"a": "not JSON", "b": "user not found", "d": "not JSON", "e": "user not found"}


def test_a_full_refresh_over_stored_tables(spark, as_of):
    from forgerank.operators.refresh import full_refresh
    land = lambda rs: spark.createDataFrame(rs, "cache_key string, response string")
    prof = land([("u", '{"user":{"login":"u","name":"New"}}'), ("x", "broken")])
    repo = land([("u", '{"user":{"repositories":{"nodes":[{"name":"r","owner":{"login":"u"},"stargazerCount":50,"pullRequests":{"totalCount":2}}]}}}'),
                 ("y", '{"user":null}')])
    prs = land([("u/r", '{"repository":{"pullRequests":{"nodes":[{"id":"1","author":{"login":"u"},"mergedAt":"2024-01-01T00:00:00.5Z"}]}}}')])
    first = full_refresh(prof, repo, prs, as_of)
    assert {(r.cache_key, r.payload) for r in first["quarantine"].collect()} == {("x", "profile"), ("y", "repos")}
    board = first["leaderboard"].collect()
    assert [(r.username, r.total_score) for r in board] == [("u", 25.0)]
    assert first["legacy_users"].first()["score"] == 25.0 and first["analyses"].first()["username"] == "u"
    old = {"analyses": first["analyses"].withColumn("username", F.lit("z")).withColumn("id", F.lit("z")),
           "user_scores": first["user_scores"].withColumn("username", F.lit("z"))}
    second = full_refresh(prof, repo, prs, as_of, old)
    assert sorted(r.username for r in second["analyses"].collect()) == ["u", "z"]
    assert sorted(r.username for r in second["user_scores"].collect()) == ["u", "z"]


def test_unreadable_searches_are_kept_apart(spark):
    df = spark.createDataFrame([("a", '{"search": {"nodes": []}}'), ("b", '{"search": null}'), ("c", '{"search": {"no'), ("d", None),
                                ("e", '{"message": "x"}'), ("f", ""), ("g", '{"search": []}')], "cache_key string, response string")
    got = dict(rows(I.unreadable_pr_search(df), "cache_key", "reason"))
    none = "no search result"
    assert got == {"b": none, "c": "not JSON", "d": "not JSON", "e": none, "f": "not JSON", "g": none}
    pages = spark.createDataFrame([("x", 0, 1, '{"items": []}'), ("x", 0, 2, '{"items": {}}'), ("x", None, 3, "[")],
                                  "location string, slice int, page int, response string")
    assert rows(I.unreadable_search_page(pages), "page", "reason") == [(2, "no items"), (3, "not JSON")]
    assert not I.unreadable_search_page(pages.limit(0)).collect()
