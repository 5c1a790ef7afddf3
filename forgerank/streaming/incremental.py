"""Structured Streaming jobs.

R1 incremental refresh keeps scores current under landed pull requests and landed repositories,
in either order, without going back to what was landed before:

* ``ids``: ids of pull requests seen (``sources.id_log``); only an id's first row counts (K3);
* ``pairs``: pull requests by (repository, user), in parts by repository, so that it is
  the reverse index from a repository to its contributors as well;
* ``repos``: stars and total of each repository;
* ``scores``: by user the sums over the user's pairs, in parts by user.

A batch touches pairs: those that got pull requests, or all of a repository whose stars or total
have changed. Each touched pair gives its user the difference between its share before and
after, so a famous repository costs one row a contributor and no user is
recomputed. Shares are added as decimals, so differences cancel exactly and the sums do
not depend on the order of batches. A share that has become zero leaves a tombstone: the
pair keeps its last positive share, and ``scores(keep_stale=True)`` counts that as a stored
row that is not overwritten would (D11).

A batch is exactly once. What it changes is computed in full and written to its staging folder before
any table is touched; every table then takes it under the batch's tag, once. A batch that
is replayed after its first table has been published takes its changes from there.

Payloads of repositories that cannot be read go to ``dead_letters`` with the reason and the parser's
version; a run with another version takes them up again.

R2 duplicate suppression: each micro-batch looks its request keys up in a log of
served requests; a request is served unless one of its key was served within the TTL
before it. Nothing is dropped for being late, and an expired key is served anew. The log is cut by
day, and a batch reads only the days within a TTL of its requests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dictionaries as D
from ..functions.columns import repo_score
from ..operators import ingest as I
from ..operators import scoring as S
from ..operators.upsert import replace_rows, upsert, upsert_pull_requests
from ..session import release, scratch_path, shared
from ..sources.id_log import IdLog
from ..sources.store import Store, hash_part

PR_COLS = ["id", "username", "repo_name", "merged_at", "created_at", "seq"]
BUCKETS = 16


def landing_files(df: DataFrame, least: int = 4) -> int:
    """Files to land: as many as the input has partitions, which follows its bytes."""
    return max(least, df.rdd.getNumPartitions())


def land_in_files(df: DataFrame, path: str, files: int, key: str | None = None, mode: str = "overwrite",
                  build: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Land rows as ``files`` parquet files (one file = one arrival); rows sharing
    ``key`` land in the same file. ``build`` makes what lands of each row, after the rows are dealt."""
    parts = df.repartition(files, key) if key else df.repartition(files)
    (build(parts) if build else parts).write.mode(mode).parquet(path)
    return path


def land_in_order(df: DataFrame, path: str, order: Column, arrivals: int, files: int, key: str) -> str:
    """Land rows in ``arrivals`` that follow each other by a number, each as ``files`` files:
    rows sharing ``key`` are in one file of an arrival, and in as many arrivals as their numbers span."""
    at = F.coalesce(order.cast("double"), F.lit(float("-inf")))
    cuts = df.select(F.percentile_approx(at, [k / arrivals for k in range(1, arrivals)], 10000)).first()[0] or []
    bounds = [None, *cuts, None]
    for low, high in zip(bounds, bounds[1:]):
        some = F.lit(True) if low is None else at > low
        land_in_files(df.where(some if high is None else some & (at <= high)), path, files, key, "append")
    return path


# ------------------------------------------------------------------ R1
SHARE = "decimal(38,12)"
PAIRS = f"repo_name string, username string, n long, share {SHARE}, last {SHARE}, last_n long"
REPO_ROWS = "repo_name string, stars int, total_prs int"
SUMS = {"total": SHARE, "n_repos": "long", "prs": "long", "last_total": SHARE, "last_repos": "long", "last_prs": "long"}
LETTERS = "digest string, cache_key string, response string, reason string, version string, n_tries long, solved boolean"


def _schema(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


class Refresh:
    """The state of R1 under ``path`` and the batches that change it."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")

        def store(name, schema, keys):
            return Store.create(spark, f"{self.path}/{name}", _schema(schema), hash_part(keys, buckets))

        self.ids = IdLog(spark, f"{self.path}/ids", buckets)
        self.pairs = store("pairs", PAIRS, ["repo_name"])
        self.repos = store("repos", REPO_ROWS, ["repo_name"])
        self.totals = store("scores", "username string, " + ", ".join(f"{c} {t}" for c, t in SUMS.items()), ["username"])
        self.dead_letters = store("dead_letters", LETTERS, ["digest"])

    # ---- the two kinds of batches
    def pull_requests(self, batch: DataFrame, tag: str) -> None:
        """Landed pull requests: ids that are new count for their pair."""
        def changes():
            first = upsert_pull_requests(None, batch.select(*PR_COLS), order=["seq"])
            new = self._staged(tag, "ids", self.ids.unseen(first).select("id", "username", "repo_name"))
            got = new.where("username is not null and repo_name is not null").groupBy("repo_name", "username").agg(
                F.count(F.lit(1)).alias("d"))
            parts = self.pairs.touched(got)  # of the repositories too, which are dealt alike
            stored = self.pairs.read(parts).join(got, ["repo_name", "username"], "right").select(
                "repo_name", "username", F.coalesce("n", F.lit(0)).alias("n"), "share", "last", "last_n",
                (F.coalesce("n", F.lit(0)) + F.col("d")).alias("n_new"))
            return stored.join(self.repos.read(parts), "repo_name", "left"), parts

        self._apply(tag, changes, ids=True)

    def repositories(self, rows: DataFrame, tag: str, order: list[str] | None = None) -> None:
        """Repository rows (repo_name, stars, total_prs): all pairs of those that have changed. Of several
        rows of one repository the last by ``order`` counts."""
        def changes():
            last = upsert(None, rows.where("repo_name is not null").select("repo_name", "stars", "total_prs", *(order or [])),
                          ["repo_name"], order or ["stars", "total_prs"], drop=order or [])
            stored = self.repos.read(self.repos.touched(last))
            old = stored.select("repo_name", F.struct("stars", "total_prs").alias("old"))
            changed = last.join(old, "repo_name", "left").where(~F.col("old").eqNullSafe(F.struct("stars", "total_prs"))).drop("old")
            changed = self._staged(tag, "repos", changed)
            pairs = self.pairs.read(self.pairs.touched(changed)).withColumn("n_new", F.col("n"))
            return pairs.join(changed, "repo_name"), None

        self._apply(tag, changes)

    def repository_payloads(self, landed: DataFrame, tag: str, parse: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
                            version: str = "1") -> None:
        """Landed payloads (cache_key, response) of repositories. ``parse`` gives (rows, unreadable payloads with
        a reason). Payloads that other versions of the parser could not read are tried again."""
        parse = parse or I.parse_repository
        again = self.dead_letters.read().where(~F.col("solved") & (F.col("version") != version))
        both = shared(landed.select("cache_key", "response").unionByName(again.select("cache_key", "response")).distinct(), "payloads")
        rows, bad = parse(both)
        digest = F.sha2(F.concat_ws(":", F.coalesce("cache_key", F.lit("")), F.coalesce("response", F.lit(""))), 256)
        failed = bad.select(digest.alias("digest"), "cache_key", "response", "reason")
        tried = both.select(digest.alias("digest")).join(self.dead_letters.read().select("digest"), "digest", "left_semi")
        letters = failed.withColumn("solved", F.lit(False)).unionByName(
            tried.join(failed, "digest", "left_anti").withColumn("solved", F.lit(True)), allowMissingColumns=True)
        letters = shared(letters.dropDuplicates(["digest"]), "letters")
        self.repositories(rows, tag)
        self.dead_letters.merge(letters, lambda old, new: self._letters(old, new, version), tag)

    @staticmethod
    def _letters(old: DataFrame, new: DataFrame, version: str) -> DataFrame:
        o, n = old.alias("o"), new.alias("n")
        both = o.join(n, "digest", "full")
        hit = F.col("n.solved").isNotNull()
        return both.select(
            "digest", *[F.coalesce(f"o.{c}", f"n.{c}").alias(c) for c in ("cache_key", "response")],
            F.coalesce("n.reason", "o.reason").alias("reason"), F.when(hit, F.lit(version)).otherwise(F.col("o.version")).alias("version"),
            (F.coalesce("o.n_tries", F.lit(0)) + hit.cast("long")).alias("n_tries"), F.coalesce("n.solved", "o.solved").alias("solved"))

    # ---- one batch, once
    def _staging(self, tag: str) -> str:
        return f"{self.path}/staging/{tag}"

    def _staged(self, tag: str, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self._staging(tag)}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self._staging(tag)}/{name}")

    def _begun(self, tag: str) -> bool:
        """Whether a table has taken the batch; it was staged in full before."""
        return self.ids.has(tag) or any(tag in s.manifest()["tags"] for s in (self.pairs, self.repos, self.totals))

    def _apply(self, tag: str, changes, ids: bool = False) -> None:
        parts = None
        if not self._begun(tag):
            touched, parts = changes()
            share = repo_score("n_new", "total_prs", "stars").cast(SHARE)
            there = share > 0
            touched = touched.select(
                "repo_name", "username", F.col("n").alias("n_old"), F.col("share").alias("share_old"), F.col("last").alias("last_old"),
                F.col("last_n").alias("last_n_old"), F.col("n_new").alias("n"), F.coalesce(share, F.lit(0)).cast(SHARE).alias("share"),
                F.when(there, share).otherwise(F.col("last")).cast(SHARE).alias("last"),
                F.when(there, F.col("n_new")).otherwise(F.col("last_n")).cast("long").alias("last_n"))
            self._staged(tag, "pairs", touched)
        touched = self.spark.read.parquet(f"{self._staging(tag)}/pairs")
        if ids:
            self.ids.add(self.spark.read.parquet(f"{self._staging(tag)}/ids"), tag)
        else:
            repos = self.spark.read.schema(_schema(REPO_ROWS)).parquet(f"{self._staging(tag)}/repos")
            self.repos.merge(repos, lambda o, n: replace_rows(o, n, ["repo_name"]), tag)
        self.pairs.merge(touched.select("repo_name", "username", "n", "share", "last", "last_n"),
                         lambda o, n: replace_rows(o, n, ["repo_name", "username"]), tag, parts)

        def part(new, old, count=None):
            a, b = F.col(new), F.col(old)
            if count is None:
                return F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))
            return F.when(a > 0, count[0]).otherwise(0) - F.when(b > 0, count[1]).otherwise(0)

        ones = (F.lit(1), F.lit(1))
        deltas = {"total": part("share", "share_old"), "n_repos": part("share", "share_old", ones),
                  "prs": part("share", "share_old", (F.col("n"), F.col("n_old"))), "last_total": part("last", "last_old"),
                  "last_repos": part("last", "last_old", ones), "last_prs": part("last_n", "last_n_old")}
        users = touched.groupBy("username").agg(*[F.sum(d).cast(SUMS[c]).alias(c) for c, d in deltas.items()])
        # Read twice: for the parts that it touches, and by the merge.
        users = shared(users.where(F.greatest(*[F.abs(c) for c in SUMS]) > 0), "user_deltas")
        self.totals.merge(users, lambda o, n: o.unionByName(n).groupBy("username").agg(
            *[F.sum(c).cast(t).alias(c) for c, t in SUMS.items()]), tag)
        release(users)
        self.pairs.files.delete(self._staging(tag))

    # ---- reading
    def scores(self, keep_stale: bool = False) -> DataFrame:
        """(username, total_score, n_repos, contribution_count). With ``keep_stale`` a share that has become
        zero still counts as it last was; without, it is gone, and so are users with nothing else."""
        a = "last_" if keep_stale else ""
        return self.totals.read().where(F.col(f"{a or 'n_'}repos") > 0).select(
            "username", F.col(f"{a}total").cast("double").alias("total_score"), F.col(f"{a or 'n_'}repos").alias("n_repos"),
            F.col(f"{a}prs").alias("contribution_count"))


def _stream(spark: SparkSession, landing: str, schema, files_per_batch: int, checkpoint: str, take) -> None:
    """Runs a file stream to its present end."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    q = (stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def refresh_repositories(state: Refresh, landing: str, files_per_batch: int = 1, parse=None, version: str = "1") -> None:
    """Takes up repository payloads (cache_key, response) that have landed since the last call."""
    _stream(state.spark, landing, "cache_key string, response string", files_per_batch, f"{state.path}/ckpt_repos",
            lambda batch, k: state.repository_payloads(batch, f"repos-{k}", parse, version))


def refresh_pull_requests(state: Refresh, landing: str, schema, files_per_batch: int = 1) -> None:
    """Takes up pull requests that have landed since the last call."""
    _stream(state.spark, landing, schema, files_per_batch, f"{state.path}/ckpt",
            lambda batch, k: state.pull_requests(batch, f"prs-{k}"))


def incremental_refresh(spark: SparkSession, landing: str, schema, repos: DataFrame,
                        profiles: DataFrame, files_per_batch: int = 1, buckets: int = BUCKETS,
                        state_dir: str | None = None, keep_stale: bool = False) -> DataFrame:
    """Brings the state up to the present repositories (a table; its changes are found) and to all
    landed pull requests, and returns the refreshed leaderboard.

    ``state_dir`` holds the tables and the streams' checkpoints: a later call with the same
    folder goes on after the files it has seen. Without one the state is a scratch
    folder. ``buckets`` (more for larger state) is fixed by the first run and kept."""
    state = Refresh(spark, state_dir or scratch_path(spark, "refresh"), buckets)
    rows = repos.select(S.full_name().alias("repo_name"), "stars", "total_prs")
    state.repositories(rows, f"table-{state.repos.version()}")
    refresh_pull_requests(state, landing, schema, files_per_batch)
    return board(state, profiles, keep_stale)


def board(state: Refresh, profiles: DataFrame, keep_stale: bool = False) -> DataFrame:
    """The current scores of users with a profile."""
    p = profiles.select("username", "name", "avatar_url")
    return state.scores(keep_stale).join(p, "username").select(
        "username", "name", "avatar_url", "total_score", "n_repos", "contribution_count")


# ------------------------------------------------------------------ R2
def _read_state(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The state table, or None before the first batch wrote it."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return None


SERVED = "cache_key string, requested_at timestamp_ntz, day string, batch_id long"


def _not_served(requests: DataFrame, served: DataFrame, ttl_days: int, arrived_before: bool = False) -> DataFrame:
    """Requests that no served request of their key covers: served at s, it covers s to
    s + TTL. If it arrived in an earlier batch its response is there already, so it also
    covers a late request from less than a TTL before s."""
    s = served.select(F.col("cache_key").alias("__k"), F.col("requested_at").alias("__s"))
    start = F.timestamp_add("DAY", F.lit(-ttl_days), F.col("__s"))
    after = F.col("requested_at") > start if arrived_before else F.col("requested_at") >= F.col("__s")
    covers = ((F.col("cache_key") == F.col("__k")) & after
              & (F.col("requested_at") < F.timestamp_add("DAY", F.lit(ttl_days), F.col("__s"))))
    return requests.join(s, covers, "left_anti")


def _near(log: DataFrame, requests: DataFrame, ttl_days: int) -> DataFrame:
    """The log's days within a TTL of the requests, as literal bounds that leave other folders unread."""
    def day(c, n):
        return F.date_format(F.timestamp_add("DAY", F.lit(n), c), "yyyy-MM-dd")

    low, high = requests.agg(day(F.min("requested_at"), -ttl_days), day(F.max("requested_at"), ttl_days)).first()
    return log.where(F.lit(False)) if low is None else log.where((F.col("day") >= low) & (F.col("day") <= high))


def _serve_batch(spark: SparkSession, path: str, ttl_days: int):
    """One micro-batch of R2. By key, the first request that nothing served covers is
    served, then the first one after its TTL, and so on: one grouped minimum a pass, as
    many passes as TTLs fit into the batch's time span. The log is partitioned by day and
    batch; a replayed batch leaves out what it wrote and writes the same parts again."""
    def run(batch: DataFrame, batch_id: int):
        left = shared(batch.select("cache_key", F.col("requested_at").cast("timestamp_ntz").alias("requested_at")), "requests")
        seen = _read_state(spark, path, SERVED)
        if seen is not None:
            near = _near(seen, left, ttl_days).where(F.col("batch_id") != batch_id)
            left = shared(_not_served(left, near, ttl_days, True), "requests")
        picked = []
        while not left.isEmpty():
            first = shared(left.groupBy("cache_key").agg(F.min("requested_at").alias("requested_at")), "served_now")
            picked.append(first)
            rest = shared(_not_served(left, first, ttl_days), "requests")
            release(left)
            left = rest
        out = spark.createDataFrame([], "cache_key string, requested_at timestamp_ntz")
        for p in picked:
            out = out.unionByName(p)
        out = out.withColumn("day", F.coalesce(F.date_format("requested_at", "yyyy-MM-dd"), F.lit("none"))).withColumn("batch_id", F.lit(batch_id))
        (out.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "batch_id").parquet(path))
    return run


def forget_served(spark: SparkSession, state_dir: str, before: str) -> None:
    """Drops the days of the served log before this one (YYYY-MM-DD), whole and unread. Requests from
    up to a TTL after them that arrive later are then served again."""
    from ..sources.store import _Files
    files = _Files(spark, state_dir)
    for name in files.names(f"{state_dir.rstrip('/')}/log"):
        if name.startswith("day=") and name[4:] < before:
            files.delete(f"{state_dir.rstrip('/')}/log/{name}")


def dedupe_requests(spark: SparkSession, landing: str, schema, ttl_days: int = D.RESPONSE_TTL_DAYS,
                    files_per_batch: int = 1, state_dir: str | None = None) -> DataFrame:
    """R2: the requests (cache_key, requested_at) that are served; identical keys within
    the TTL of a served one are not. ``state_dir`` as in ``incremental_refresh``."""
    base = state_dir.rstrip("/") if state_dir else scratch_path(spark, "served")
    _stream(spark, landing, schema, files_per_batch, f"{base}/ckpt", _serve_batch(spark, f"{base}/log", ttl_days))
    log = _read_state(spark, f"{base}/log", SERVED)
    return (log if log is not None else spark.createDataFrame([], SERVED)).select("cache_key", "requested_at")
