"""Ranking, region, enrichment outcome queries (W1, W2, F10-F12, A13, A14, A16,
O1-O3, K11, K12, Q5, Q6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..operators import outcomes as O
from ..operators import ranking as R
from ..operators import scoring as S
from ..sources.adapter import as_of_col
from .adapter_sql import with_ctes
from .q_analysis import profile_link_sql
from .q_scoring import SCORED
from .registry import Tables, register, rounded

AS_OF_SQL = "TIMESTAMP '2024-02-15 00:00:00'"
NEED = ("a_users", "a_repos", "a_prs", "a_state")

FB = dict(SCORED)
FB["fb"] = f"""SELECT b.username, b.name, b.avatar_url, b.total_score, b.n_repos, b.contribution_count,
  u.bio, u.location, u.company, u.hireable, {profile_link_sql('u')} AS linkedin,
  s.is_open_to_work, s.otw_permanent_failure, s.otw_error_code, s.otw_scraped_at
FROM board b JOIN a_users u ON b.username = u.username LEFT JOIN a_state s ON b.username = s.username"""


def region_sql(col: str = "location") -> str:
    likes = " OR ".join(f"lower({col}) LIKE '%{p}%'" for p in D.BAY_AREA_PATTERNS)
    return f"({col} IS NOT NULL AND ({likes}))"


RANK_ORDER = "CAST(total_score AS REAL) DESC, username"
LINK_OK = "linkedin IS NOT NULL AND linkedin <> ''"


def fb_sql(body: str, more: dict | None = None, need=NEED) -> str:
    extra = dict(FB)
    extra.update(more or {})
    return with_ctes(body, *need, extra=extra)


def full_board(t: Tables):
    return R.full_leaderboard(S.leaderboard(t.prs, t.repos, t.users), t.users, t.state)


CAND_COLS = ["username", "name", "linkedin", "location", "total_score", "rnk", "is_open_to_work"]


# F10 --------------------------------------------------------------------------------
@register("region_members", fb_sql(f"""
SELECT username, location, round(total_score, 4) AS total_score FROM fb WHERE {region_sql()}"""))
def q_region_members(spark, sf_dir):
    m = R.region_members(full_board(Tables(spark, sf_dir)))
    return rounded(m.select("username", "location", "total_score"), "total_score")


@register("regions_by_dictionary", with_ctes(f"""
SELECT username, 'bay area' AS region FROM a_users WHERE {region_sql()}
UNION ALL
SELECT u.username, p.region FROM a_users u
JOIN (SELECT DISTINCT lower(trim(string_split(location, ',')[1])) AS region FROM a_users WHERE location IS NOT NULL) p
  ON contains(lower(u.location), p.region)""", "a_users"))
def q_regions_by_dictionary(spark, sf_dir):
    """F10 with the dictionary as a table: the fixed patterns, and the first part of every
    location that the users name as a region of its own."""
    from ..operators.patterns import regions_of
    users = Tables(spark, sf_dir).users.select("username", "location")
    fixed = spark.createDataFrame([("bay area", p) for p in D.BAY_AREA_PATTERNS], "region string, pattern string")
    part = F.lower(F.trim(F.get(F.split("location", ","), 0)))
    own = users.where("location is not null").select(part.alias("region"), part.alias("pattern")).distinct()
    return regions_of(users, fixed.unionByName(own)).select("username", "region")


# A14 --------------------------------------------------------------------------------
@register("region_count", fb_sql(f"SELECT count(*) AS members FROM fb WHERE {region_sql()}"))
def q_region_count(spark, sf_dir):
    return R.region_count(full_board(Tables(spark, sf_dir)))


# A13 --------------------------------------------------------------------------------
@register("region_outcome_counts", fb_sql(f"""
SELECT count(*) FILTER (WHERE is_open_to_work = TRUE) AS open_to_work,
  count(*) FILTER (WHERE is_open_to_work = FALSE) AS not_open_to_work,
  count(*) FILTER (WHERE otw_permanent_failure = TRUE) AS permanent_failures
FROM fb WHERE {region_sql()} AND {LINK_OK}"""))
def q_region_outcome_counts(spark, sf_dir):
    return R.region_outcome_counts(full_board(Tables(spark, sf_dir)))


# W1 ---------------------------------------------------------------------------------
W1_SQL = f"""SELECT * FROM (SELECT *, row_number() OVER (ORDER BY {RANK_ORDER}) AS rnk FROM fb)
WHERE rnk > {D.GLOBAL_SKIP} AND {LINK_OK} ORDER BY rnk LIMIT {D.GLOBAL_TAKE}"""


@register("enrich_candidates_global", fb_sql(f"""
SELECT username, name, linkedin, location, round(total_score, 4) AS total_score, rnk, is_open_to_work
FROM cand""", {"cand": W1_SQL}))
def q_enrich_candidates_global(spark, sf_dir):
    c = R.enrich_candidates_global(full_board(Tables(spark, sf_dir)))
    return rounded(c.select(*CAND_COLS), "total_score")


# W2 ---------------------------------------------------------------------------------
W2_SQL = f"""SELECT * FROM (SELECT *, row_number() OVER (ORDER BY {RANK_ORDER}) AS rnk FROM fb WHERE {region_sql()})
WHERE rnk > {D.REGION_SKIP} AND {LINK_OK} AND is_open_to_work IS NULL
  AND (otw_permanent_failure IS NULL OR otw_permanent_failure = FALSE)
ORDER BY rnk LIMIT {D.REGION_TAKE}"""


@register("enrich_candidates_region", fb_sql(f"""
SELECT username, name, linkedin, location, round(total_score, 4) AS total_score, rnk, is_open_to_work
FROM cand""", {"cand": W2_SQL}))
def q_enrich_candidates_region(spark, sf_dir):
    c = R.enrich_candidates_region(full_board(Tables(spark, sf_dir)))
    return rounded(c.select(*CAND_COLS), "total_score")


# W1 / W2 with kept ranks ---------------------------------------------------------------
def _kept(t: Tables, ranks):
    """The board in three batches: two thirds of the users with half their scores, a third with
    their own, then all whose scores have been halved with their own."""
    board = full_board(t)
    third = F.pmod(F.xxhash64("username"), F.lit(3))
    ranks.begin(board.schema, 8)
    ranks.update(board.where(third > 0).withColumn("total_score", F.col("total_score") / 2), "halves")
    ranks.update(board.where(third == 0), "others")
    ranks.update(board.where(third > 0), "whole")
    return ranks


@register("kept_ranks_global", fb_sql(f"""
SELECT username, name, linkedin, location, round(total_score, 4) AS total_score, rnk, is_open_to_work
FROM cand""", {"cand": W1_SQL}))
def q_kept_ranks_global(spark, sf_dir):
    from ..operators.kept_ranks import KeptRanks
    from ..session import scratch_path
    c = _kept(Tables(spark, sf_dir), KeptRanks(spark, scratch_path(spark, "ranks"))).global_candidates()
    return rounded(c.select(*CAND_COLS), "total_score")


@register("kept_ranks_region", fb_sql(f"""
SELECT username, name, linkedin, location, round(total_score, 4) AS total_score, rnk, is_open_to_work
FROM cand""", {"cand": W2_SQL}))
def q_kept_ranks_region(spark, sf_dir):
    from ..operators.kept_ranks import region_board
    from ..session import scratch_path
    c = _kept(Tables(spark, sf_dir), region_board(spark, scratch_path(spark, "ranks"))).region_candidates()
    return rounded(c.select(*CAND_COLS), "total_score")


# ------------------------------------------------------------------ outcome SQL
def classify_ctes(mode: str = "regional") -> dict:
    needles = D.RETRYABLE_ERRORS_REGIONAL if mode == "regional" else D.RETRYABLE_ERRORS_GLOBAL

    def has_needle(x):
        return "coalesce(" + " OR ".join(f"contains({x}, '{n}')" for n in needles) + ", FALSE)"

    ctes = {
        "c0": "SELECT *, CASE WHEN json_valid(body) THEN body END AS j FROM a_attempts",
        "c1": f"""SELECT *,
  coalesce(status IS NOT NULL AND NOT (status BETWEEN 200 AND 299), FALSE) AS http_fail,
  status IS NULL AS raised,
  (j IS NULL OR json_type(j) = 'NULL') AS bad_json,
  coalesce(json_type(j) = 'ARRAY' AND json_array_length(j) > 0, FALSE) AS nonempty,
  coalesce(json_type(j, '$[0]') = 'NULL', FALSE) AS first_null,
  coalesce(CASE json_type(j, '$[0].messages')
    WHEN 'VARCHAR' THEN json_extract_string(j, '$[0].messages') <> '' AND contains(json_extract_string(j, '$[0].messages'), '{D.TIMEOUT_MESSAGE}')
    WHEN 'ARRAY' THEN list_contains(json_extract_string(j, '$[0].messages[*]'), '{D.TIMEOUT_MESSAGE}') ELSE FALSE END, FALSE) AS timed_out,
  coalesce(json_type(j, '$[0].data.open_to_work') = 'BOOLEAN', FALSE) AS a_data,
  coalesce(json_type(j, '$[0].open_to_work') = 'BOOLEAN', FALSE) AS a_flat,
  coalesce(json_type(j) <> 'ARRAY' AND json_type(j, '$.data.open_to_work') = 'BOOLEAN', FALSE) AS o_data
FROM c0""",
        "c2": """SELECT *, CASE WHEN http_fail OR raised OR bad_json THEN NULL
  WHEN nonempty AND first_null THEN NULL WHEN nonempty AND timed_out THEN NULL
  WHEN nonempty AND a_data THEN CAST(json_extract(j, '$[0].data.open_to_work') AS BOOLEAN)
  WHEN nonempty AND a_flat THEN CAST(json_extract(j, '$[0].open_to_work') AS BOOLEAN)
  WHEN o_data THEN CAST(json_extract(j, '$.data.open_to_work') AS BOOLEAN) END AS open_to_work FROM c1""",
    }
    if mode == "regional":
        exc = f"(raised AND {has_needle('error_text')})"
        ctes["cls"] = f"""SELECT username, seq, status, open_to_work IS NOT NULL AS success, open_to_work,
  CASE WHEN http_fail THEN status >= 500 OR status = 429
       WHEN raised OR bad_json OR (nonempty AND first_null) THEN {exc}
       WHEN nonempty AND timed_out THEN TRUE ELSE FALSE END AS retryable,
  CASE WHEN http_fail THEN '{D.CODE_HTTP_PREFIX}' || CAST(status AS VARCHAR)
       WHEN raised OR bad_json OR (nonempty AND first_null) THEN CASE WHEN {exc} THEN '{D.CODE_TRANSIENT}' ELSE '{D.CODE_UNKNOWN}' END
       WHEN nonempty AND timed_out THEN '{D.CODE_TIMEOUT}'
       WHEN open_to_work IS NOT NULL THEN NULL ELSE '{D.CODE_INVALID}' END AS error_code
FROM c2"""
    else:
        err = """CASE WHEN http_fail THEN 'HTTP ' || CAST(status AS VARCHAR) || ': ' || coalesce(body, '')
       WHEN raised THEN coalesce(error_text, '') WHEN bad_json THEN 'Unexpected token in JSON'
       WHEN nonempty AND first_null THEN 'Cannot read properties of null'
       WHEN nonempty AND timed_out THEN 'API timeout'
       WHEN open_to_work IS NOT NULL THEN NULL
       ELSE 'Unexpected response format: ' || body END"""
        ctes["cls"] = f"""SELECT username, seq, status, open_to_work IS NOT NULL AS success, open_to_work,
  open_to_work IS NULL AND {has_needle(err)} AS retryable,
  CASE WHEN open_to_work IS NOT NULL THEN NULL ELSE 'FAILED' END AS error_code FROM c2"""
    ctes["res"] = f"""SELECT * EXCLUDE (rr), NOT success AND NOT retryable AS permanent FROM (
  SELECT *, row_number() OVER (PARTITION BY username ORDER BY NOT (success OR NOT retryable),
      CASE WHEN success OR NOT retryable THEN attempt ELSE -attempt END) AS rr,
    count(*) OVER (PARTITION BY username) AS attempts_landed
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY username ORDER BY seq) - 1 AS INTEGER) AS attempt FROM cls)
  WHERE attempt <= {D.MAX_RETRIES}) WHERE rr = 1"""
    return ctes


def outcomes(t: Tables, mode: str = "regional"):
    return O.resolve_attempts(O.classify(t.attempts, mode))


CLS_COLS = ["username", "seq", "status", "success", "open_to_work", "retryable", "error_code"]
RES_COLS = CLS_COLS + ["attempt", "permanent", "attempts_landed"]


# S7 / O1 ----------------------------------------------------------------------------
@register("classify_response", with_ctes(f"SELECT {', '.join(CLS_COLS)} FROM cls", "a_attempts",
                                           extra=classify_ctes()))
def q_classify_response(spark, sf_dir):
    return O.classify(Tables(spark, sf_dir).attempts).select(*CLS_COLS)


# O2 + O3 ----------------------------------------------------------------------------
@register("resolve_attempts", with_ctes(f"SELECT {', '.join(RES_COLS)} FROM res", "a_attempts",
                                          extra=classify_ctes()))
def q_resolve_attempts(spark, sf_dir):
    return outcomes(Tables(spark, sf_dir)).select(*RES_COLS)


@register("resolve_attempts_global", with_ctes(f"SELECT {', '.join(RES_COLS)} FROM res", "a_attempts",
                                                 extra=classify_ctes("global")))
def q_resolve_attempts_global(spark, sf_dir):
    return outcomes(Tables(spark, sf_dir), "global").select(*RES_COLS)


# A16 --------------------------------------------------------------------------------
SUMMARY_SQL = """SELECT count(*) AS total, count(*) FILTER (WHERE success) AS success,
  count(*) FILTER (WHERE NOT success AND permanent) AS permanent_failures,
  count(*) FILTER (WHERE NOT success AND NOT permanent) AS transient_failures,
  count(*) FILTER (WHERE NOT success) AS failed,
  count(*) FILTER (WHERE success AND open_to_work = TRUE) AS open_to_work FROM res"""


@register("outcome_summary", with_ctes(SUMMARY_SQL, "a_attempts", extra=classify_ctes()))
def q_outcome_summary(spark, sf_dir):
    return O.outcome_summary(outcomes(Tables(spark, sf_dir)))


@register("outcome_summary_global", with_ctes(SUMMARY_SQL, "a_attempts", extra=classify_ctes("global")))
def q_outcome_summary_global(spark, sf_dir):
    """A16, short form of the global round (failure kinds from the global rule)."""
    return O.outcome_summary(outcomes(Tables(spark, sf_dir), "global"))


# K11 --------------------------------------------------------------------------------
STATE_OUT = ["username", "is_open_to_work", "otw_scraped_at", "otw_permanent_failure", "otw_error_code"]
K11_SELECT = f"""SELECT f.username,
  CASE WHEN coalesce(r.success OR r.permanent, FALSE) THEN CASE WHEN r.success THEN r.open_to_work END ELSE f.is_open_to_work END AS is_open_to_work,
  CASE WHEN coalesce(r.success OR r.permanent, FALSE) THEN {AS_OF_SQL} ELSE f.otw_scraped_at END AS otw_scraped_at,
  CASE WHEN coalesce(r.success OR r.permanent, FALSE) THEN coalesce(r.permanent, FALSE) ELSE f.otw_permanent_failure END AS otw_permanent_failure,
  CASE WHEN coalesce(r.success OR r.permanent, FALSE) THEN CASE WHEN r.success THEN NULL ELSE coalesce(r.error_code, '{D.CODE_UNKNOWN}') END
       ELSE f.otw_error_code END AS otw_error_code
FROM {{src}} f LEFT JOIN res r ON f.username = r.username"""
K12_SELECT = f"""SELECT f.username,
  CASE WHEN r.username IS NOT NULL THEN r.open_to_work ELSE f.is_open_to_work END AS is_open_to_work,
  CASE WHEN r.username IS NOT NULL THEN {AS_OF_SQL} ELSE f.otw_scraped_at END AS otw_scraped_at,
  f.otw_permanent_failure, f.otw_error_code
FROM {{src}} f LEFT JOIN res r ON f.username = r.username"""
NEED_O = NEED + ("a_attempts",)


@register("apply_outcomes", fb_sql(K11_SELECT.format(src="fb"), classify_ctes(), NEED_O))
def q_apply_outcomes(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return O.apply_outcomes(full_board(t), outcomes(t), as_of_col()).select(*STATE_OUT)


# K12 --------------------------------------------------------------------------------
@register("apply_outcomes_overwrite", fb_sql(K12_SELECT.format(src="fb"), classify_ctes("global"), NEED_O))
def q_apply_outcomes_overwrite(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return O.apply_outcomes_overwrite(full_board(t), outcomes(t, "global"), as_of_col()).select(*STATE_OUT)


# Q5 ---------------------------------------------------------------------------------
def _round(t: Tables, mode: str, cands):
    """Attempts of the candidates only, classified once; the resolved outcome goes along
    with the row it is written to."""
    from ..session import shared
    cands = shared(cands, "candidates")
    mine = t.attempts.join(cands.select("username"), "username", "left_semi")
    res = shared(O.resolve_attempts(O.classify(mine, mode)), "outcomes")
    upd = (O.apply_outcomes if mode == "regional" else O.apply_outcomes_overwrite)(cands, res, as_of_col())
    out = upd.join(res.select("username", F.col("error_code").alias("outcome")), "username", "left")
    return rounded(out.select("username", "rnk", "total_score", "outcome", *STATE_OUT[1:]), "total_score")


ROUND_SQL = """SELECT u.username, u.rnk, round(u.total_score, 4) AS total_score, r.error_code AS outcome,
  u.is_open_to_work, u.otw_scraped_at, u.otw_permanent_failure, u.otw_error_code
FROM (SELECT c.username, c.rnk, c.total_score, k.* EXCLUDE (username) FROM cand c JOIN upd k ON c.username = k.username) u
LEFT JOIN res r ON u.username = r.username"""


@register("enrichment_round", fb_sql(ROUND_SQL, {**classify_ctes(), "cand": W2_SQL,
                                                  "upd": K11_SELECT.format(src="cand")}, NEED_O))
def q_enrichment_round(spark, sf_dir):
    """Q5: regional candidates, their landed responses classified and resolved,
    written with the regional rule."""
    t = Tables(spark, sf_dir)
    return _round(t, "regional", R.enrich_candidates_region(full_board(t)))


# Q6 ---------------------------------------------------------------------------------
@register("enrichment_round_global", fb_sql(ROUND_SQL, {**classify_ctes("global"), "cand": W1_SQL,
                                                         "upd": K12_SELECT.format(src="cand")}, NEED_O))
def q_enrichment_round_global(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _round(t, "global", R.enrich_candidates_global(full_board(t)))


# O2 over several landings -------------------------------------------------------------
def _rounds(t: Tables):
    """All attempts in three landings that cut through users and come out of order, onto
    the whole leaderboard."""
    from ..operators.rounds import EnrichmentRounds
    from ..session import scratch_path
    rounds = EnrichmentRounds(t.spark, scratch_path(t.spark, "rounds")).begin(full_board(t), 8)
    for k in (1, 0, 2):
        rounds.land(t.attempts.where(F.col("seq") % 3 == k), as_of_col(), f"landing-{k}")
    return rounds


@register("enrichment_rounds", fb_sql(K11_SELECT.format(src="fb"), classify_ctes(), NEED_O))
def q_enrichment_rounds(spark, sf_dir):
    return _rounds(Tables(spark, sf_dir)).board.read().select(*STATE_OUT)


@register("enrichment_rounds_statistics", fb_sql(f"""
SELECT r.*, b.* FROM (
  SELECT count(*) AS total, count(*) FILTER (WHERE success) AS success,
    count(*) FILTER (WHERE NOT success AND permanent) AS permanent_failures,
    count(*) FILTER (WHERE NOT success AND NOT permanent) AS transient_failures,
    count(*) FILTER (WHERE NOT success) AS failed, count(*) FILTER (WHERE success AND open_to_work) AS open_to_work
  FROM res) r,
 (SELECT count(*) AS members, count(*) FILTER (WHERE {LINK_OK} AND u.is_open_to_work) AS members_open,
    count(*) FILTER (WHERE {LINK_OK} AND NOT u.is_open_to_work) AS members_not_open,
    count(*) FILTER (WHERE {LINK_OK} AND u.otw_permanent_failure) AS members_failed
  FROM fb JOIN upd u ON fb.username = u.username WHERE {region_sql()}) b""",
    {**classify_ctes(), "upd": K11_SELECT.format(src="fb")}, NEED_O))
def q_enrichment_rounds_statistics(spark, sf_dir):
    """A13, A14 and A16 of the rounds, from counters that each landing moved."""
    return _rounds(Tables(spark, sf_dir)).statistics()
