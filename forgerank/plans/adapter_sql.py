"""The adapter of ``forgerank.sources.adapter`` written as DuckDB CTEs.

Used only by the oracle SQL (``oracle_sql()``), never by the Spark jobs. The
views ``customer nation region part orders lineitem events`` are registered by
the checker.
"""

CUST = "'Customer#' || lpad(CAST({k} AS VARCHAR), 9, '0')"


def cust(k: str) -> str:
    return CUST.format(k=k)


ADAPTER_CTES = {
    "a_users": f"""
SELECT c.c_name AS username, c.c_name AS name,
  'https://avatars.githubusercontent.com/u/' || CAST(c.c_custkey AS VARCHAR) AS avatar_url,
  CASE c.c_custkey % 4 WHEN 0 THEN 'see LinkedIn.com/in/dev-' || CAST(c.c_custkey AS VARCHAR)
    WHEN 1 THEN 'lnkd.in/x_' || CAST(c.c_custkey AS VARCHAR) WHEN 2 THEN 'no link' END AS bio,
  CAST(floor(abs(c.c_acctbal) * 2) AS INTEGER) AS followers,
  CAST(c.c_nationkey AS INTEGER) AS following,
  0 AS public_repos,
  CASE WHEN c.c_custkey % 5 = 0 THEN 'https://linkedin.com/in/web-' || CAST(c.c_custkey AS VARCHAR) END AS blog,
  CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE n.n_name || ', ' || r.r_name END AS location,
  CASE WHEN c.c_custkey % 6 = 0 THEN 'dev' || CAST(c.c_custkey AS VARCHAR) || '@example.com' END AS email,
  CAST(NULL AS VARCHAR) AS twitter_username,
  c.c_mktsegment AS company,
  CASE c.c_custkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS hireable,
  TIMESTAMP '2010-01-01 00:00:00' + to_days(CAST(c.c_custkey % 4000 AS INTEGER)) AS created_at,
  TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c.c_custkey % 46 AS INTEGER)) AS scraped_at,
  c.c_custkey AS user_key
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "a_returned": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate
FROM lineitem WHERE l_returnflag = 'R'""",
    "a_repos": f"""
SELECT replace(p.p_name, ' ', '-') || '-' || CAST(p.p_partkey AS VARCHAR) AS repo_name,
  replace(p.p_name, ' ', '-') AS short_name,
  {cust('p.p_partkey // 10')} AS owner_login,
  CAST(NULL AS VARCHAR) AS description,
  CASE p.p_type WHEN 'ECONOMY' THEN 'Python' WHEN 'LARGE' THEN 'TypeScript' WHEN 'MEDIUM' THEN 'Go'
    WHEN 'PROMO' THEN 'Shell' WHEN 'SMALL' THEN 'R' END AS primary_language,
  CAST(CASE WHEN p.p_partkey % 50 = 0 THEN p.p_size * p.p_size * p.p_size * 10 ELSE p.p_size END AS INTEGER) AS stars,
  0 AS forks, 0 AS watchers,
  CAST(CASE WHEN p.p_partkey % 97 = 0 THEN 0 ELSE coalesce(t.n_returned, 0) END AS INTEGER) AS total_prs,
  p.p_partkey % 7 = 0 AS is_fork,
  FALSE AS is_archived,
  CASE CAST(substr(p.p_brand, 7) AS INTEGER) % 8
    WHEN 0 THEN CAST([] AS VARCHAR[])
    WHEN 1 THEN ['machine-learning', 'python']
    WHEN 2 THEN ['api', 'docker']
    WHEN 3 THEN ['react', 'ui']
    WHEN 4 THEN ['kubernetes', 'aws']
    WHEN 5 THEN ['data-science', 'pandas']
    WHEN 6 THEN ['Email', 'django'] END AS topics,
  list_concat(
    CASE p.p_type WHEN 'ECONOMY' THEN ['Python'] WHEN 'LARGE' THEN ['TypeScript'] WHEN 'MEDIUM' THEN ['Go']
      WHEN 'PROMO' THEN ['Shell'] WHEN 'SMALL' THEN ['R'] ELSE CAST([] AS VARCHAR[]) END,
    CASE WHEN p.p_size % 4 = 0 THEN ['Shell'] ELSE CAST([] AS VARCHAR[]) END) AS languages,
  CAST(NULL AS TIMESTAMP) AS created_at,
  TIMESTAMP '2023-01-01 00:00:00' + to_days(CAST(p.p_partkey % 365 AS INTEGER)) AS pushed_at,
  TIMESTAMP '2024-02-01 00:00:00' + to_days(CAST(p.p_partkey % 10 AS INTEGER)) AS scraped_at,
  p.p_partkey AS repo_key
FROM part p LEFT JOIN (SELECT l_partkey, count(*) AS n_returned FROM a_returned GROUP BY l_partkey) t
  ON p.p_partkey = t.l_partkey""",
    "a_raw_prs": f"""
SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS id,
  {cust('o.o_custkey')} AS username,
  {cust('l.l_partkey // 10')} || '/' || replace(p.p_name, ' ', '-') || '-' || CAST(p.p_partkey AS VARCHAR) AS repo_name,
  l.l_shipdate AS merged_at, o.o_orderdate AS created_at,
  l.l_partkey AS s_a, l.l_suppkey AS s_b, l.l_extendedprice AS s_c
FROM a_returned l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey""",
    "a_prs": """
SELECT id, username, repo_name, 'MERGED' AS state, 0 AS additions, 0 AS deletions, merged_at, created_at
FROM (SELECT id,
        first_value(username) OVER w AS username, first_value(repo_name) OVER w AS repo_name,
        first_value(created_at) OVER w AS created_at, last_value(merged_at) OVER w AS merged_at,
        row_number() OVER (PARTITION BY id ORDER BY s_a, s_b, s_c) AS rn
      FROM a_raw_prs
      WINDOW w AS (PARTITION BY id ORDER BY s_a, s_b, s_c ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
WHERE rn = 1""",
    "a_attempts": f"""
SELECT {cust('user_id')} AS username, event_id AS seq,
  CAST(CASE WHEN event_type = 'error' THEN (CASE WHEN k < 30 THEN 500 WHEN k < 50 THEN 429 ELSE 404 END) ELSE 200 END AS INTEGER) AS status,
  CASE event_type WHEN 'click' THEN '[{{"data":{{"open_to_work":true}}}}]'
    WHEN 'view' THEN '[{{"open_to_work":false}}]'
    WHEN 'signup' THEN '[{{"messages":"timed out"}}]'
    WHEN 'purchase' THEN '{{"x":1}}' END AS body,
  CAST(NULL AS VARCHAR) AS error_text
FROM (SELECT user_id, event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)""",
    "a_state": """
SELECT c_name AS username,
  CASE c_custkey % 7 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS is_open_to_work,
  CASE c_custkey % 13 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS otw_permanent_failure,
  CASE WHEN c_custkey % 13 = 0 THEN 'INVALID_RESPONSE' END AS otw_error_code,
  CASE WHEN c_custkey % 7 <= 1 THEN TIMESTAMP '2024-01-10 00:00:00' + to_days(CAST(c_custkey % 20 AS INTEGER)) END AS otw_scraped_at
FROM customer""",
}


def with_ctes(body: str, *names: str, extra: dict | None = None) -> str:
    """Prefix ``body`` with the adapter CTEs it needs (dependencies included)."""
    deps = {"a_repos": ["a_returned"], "a_raw_prs": ["a_returned"], "a_prs": ["a_returned", "a_raw_prs"]}
    order = list(ADAPTER_CTES)
    want = set()
    for n in names:
        want.add(n)
        want.update(deps.get(n, []))
    parts = [f"{n} AS ({ADAPTER_CTES[n]})" for n in order if n in want]
    if extra:
        parts += [f"{k} AS ({v})" for k, v in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body
