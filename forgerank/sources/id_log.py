"""A log of ids seen, merged level by level, with Bloom filters in front of it.

Every batch adds one run of ids, dealt to buckets by hash. ``FANOUT`` runs of a level are merged
into one run of the next, so a log of n batches has some log n runs, and an id is rewritten as
often as there are levels. A run has filters beside its ids: blocks of 32,768 bits, one for
about ``BLOCK_IDS`` ids of a bucket, in which every id sets ``BITS`` bits. They are made with
partially aggregated bitmaps and are a tenth of the ids' size.

A batch asks the filters first. Only buckets of runs whose filters hold one of its ids have
their ids read, by file, and an exact anti join settles those. So new ids cost the filters,
and ids seen before cost the buckets that they are in.

Runs and merges become visible by one rename (as in ``store``), under the batch's tag: a
batch replayed after that adds nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared
from .store import _Files

FANOUT = 4
BITS = 4
BLOCK_BITS = 32768
BLOCK_IDS = BLOCK_BITS // 10
FILTER = "bucket int, block int, bits binary"


def _bits(col: str) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(k), col), F.lit(BLOCK_BITS)) for k in range(BITS)]


def _is_set(bits: str, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1


class IdLog:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, fanout: int = FANOUT):
        """The log under ``path``; a new one gets ``buckets``, one that is there keeps its own."""
        self.spark, self.path, self.fanout = spark, path.rstrip("/"), fanout
        self.files = _Files(spark, self.path)
        self.buckets = self.manifest(buckets)["buckets"]
        self.last_read: list[str] = []  # folders of ids that the last question read

    def manifest(self, buckets: int | None = None) -> dict:
        names = [n for n in self.files.names(f"{self.path}/manifests") if n.endswith(".json") and not n.startswith(".")]
        if names:
            return json.loads(self.files.read(f"{self.path}/manifests/{names[-1]}"))
        return {"version": 0, "buckets": buckets or self.buckets, "runs": [], "tags": []}

    def _bucket(self, col: str) -> Column:
        return F.pmod(F.xxhash64(col), F.lit(self.buckets)).cast("int")

    def _ids(self, run: dict, buckets=None) -> list[str]:
        return [f"{self.path}/ids/{run['name']}/bucket={b}" for b in run["rows"] if buckets is None or int(b) in buckets]

    def _read(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema("id string").parquet(*folders) if folders else self.spark.createDataFrame([], "id string")

    def unseen(self, batch: DataFrame, col: str = "id") -> DataFrame:
        """The rows of the batch whose id is not in the log."""
        runs = self.manifest()["runs"]
        self.last_read = []
        if not runs:
            return batch
        heads = [(k, int(b), -(-n // BLOCK_IDS)) for k, run in enumerate(runs) for b, n in run["rows"].items()]
        heads = self.spark.createDataFrame(heads, "run int, bucket int, blocks int")  # a row a run and bucket
        asked = batch.select(F.col(col).alias("id")).where("id is not null").distinct().withColumn("bucket", self._bucket("id"))
        asked = asked.join(heads, "bucket").withColumn("block", F.pmod(F.xxhash64(F.lit(-1), "id"), F.col("blocks")).cast("int"))
        filters = None
        for k, run in enumerate(runs):
            own = self.spark.read.schema(FILTER).parquet(f"{self.path}/filters/{run['name']}").withColumn("run", F.lit(k))
            filters = own if filters is None else filters.unionByName(own)
        held = asked.join(filters, ["run", "bucket", "block"])
        for at in _bits("id"):
            held = held.where(_is_set("bits", at))
        held = shared(held.select("id", "run", "bucket"), "maybe_seen")
        wanted: dict[int, set] = {}
        for run, bucket in held.select("run", "bucket").distinct().collect():  # at most a row a run and bucket
            wanted.setdefault(run, set()).add(bucket)
        for run, buckets in wanted.items():
            self.last_read += self._ids(runs[run], buckets)
        if not self.last_read:
            return batch
        seen = self._read(self.last_read).join(held.select("id").distinct(), "id", "left_semi").distinct()
        return batch.join(seen.withColumnRenamed("id", "__seen"), F.col(col) == F.col("__seen"), "left_anti")

    def has(self, tag: str) -> bool:
        return tag in self.manifest()["tags"]

    def add(self, ids: DataFrame, tag: str, col: str = "id") -> None:
        """Adds ids that the log does not hold (``unseen``), once for a tag."""
        m = self.manifest()
        if tag in m["tags"]:
            return
        runs = [*m["runs"], self._write(ids.select(F.col(col).alias("id")).where("id is not null").distinct(), 0)]
        level = 0
        while sum(r["level"] == level for r in runs) >= self.fanout:
            low = [r for r in runs if r["level"] == level]
            runs = [r for r in runs if r["level"] != level]
            runs.append(self._write(self._read([f for r in low for f in self._ids(r)]), level + 1))
            level += 1
        runs = [r for r in runs if r["rows"]]
        self.files.publish(f"{self.path}/manifests/{m['version'] + 1:012d}.json", json.dumps(
            {**m, "version": m["version"] + 1, "runs": runs, "tags": [*m["tags"][-100:], tag]}))
        self._clean(runs, m["version"] + 1)

    def _write(self, ids: DataFrame, level: int) -> dict:
        name = f"{level}-{uuid.uuid4().hex[:12]}"
        dealt = ids.withColumn("bucket", self._bucket("id")).hint("rebalance", "bucket")
        dealt.write.partitionBy("bucket").parquet(f"{self.path}/ids/{name}")
        stored = self.spark.read.schema("id string, bucket int").parquet(f"{self.path}/ids/{name}")
        rows = {str(b): n for b, n in stored.groupBy("bucket").count().collect()}  # at most a row a bucket
        blocks = self.spark.createDataFrame([(int(b), -(-n // BLOCK_IDS)) for b, n in rows.items()], "bucket int, blocks int")
        placed = stored.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64(F.lit(-1), "id"), F.col("blocks")).cast("int"))
        bits = placed.select("bucket", "block", F.explode(F.array(*_bits("id"))).alias("at"))
        (bits.groupBy("bucket", "block").agg(F.bitmap_construct_agg("at").alias("bits"))
         .write.parquet(f"{self.path}/filters/{name}"))
        return {"name": name, "level": level, "rows": rows}

    def _clean(self, runs: list[dict], version: int) -> None:
        live = {r["name"] for r in runs}
        for kind in ("ids", "filters"):
            for name in self.files.names(f"{self.path}/{kind}"):
                if name not in live:
                    self.files.delete(f"{self.path}/{kind}/{name}")
        for n in self.files.names(f"{self.path}/manifests"):
            if n != f"{version:012d}.json":
                self.files.delete(f"{self.path}/manifests/{n}")
