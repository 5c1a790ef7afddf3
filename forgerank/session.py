"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces shuffle
# partitions from runtime sizes, and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "forgerank", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system and is used as is; without it
    this raises, as a folder of one machine would lose the tables of the others. Only a
    local master (tests) gets a scratch folder when nothing is configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="forgerank-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub path of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{os.getpid()}-{next(_seq)}"


def _counter():
    i = 0
    while True:
        i += 1
        yield i


_seq = _counter()


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared(df, name: str = "shared"):
    """Write an intermediate used by several branches of one plan as a parquet table
    in the shared checkpoint folder and scan it back: one job computes it, the
    branches read it (with column pruning), and a lost executor re-reads files
    instead of recomputing the lineage. The job's shuffle files go when it ends, not
    when the driver happens to collect its garbage."""
    path = scratch_path(df.sparkSession, name)
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        conf.set(CLEANUP, before) if before is not None else conf.unset(CLEANUP)
    out = df.sparkSession.read.parquet(path)
    out._scratch_path = path
    return out


def release(*frames) -> None:
    """Deletes the files of ``shared`` frames that nothing will read any more."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
