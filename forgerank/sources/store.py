"""Versioned tables in parts, of which a write touches only some.

A table is a folder of immutable Parquet files, one sub folder a part and version, and a row of
manifests. A manifest names, for every part that holds rows, the version whose files are
current, with its rows and its smallest and largest key. A write puts the new files of the parts that it
touches beside the old ones and then publishes one manifest by a rename, so readers see
one version as a whole and a run that is cut off before the rename has changed nothing. Old
versions stay readable until ``vacuum``.

Parts are given by an expression: ``hash_part`` deals keys to a fixed number of buckets (keyed
upserts), ``day_part`` cuts by day (expiry), ``score_part`` by order-preserving slices of a score (ranks). The expression and the schema are the table's own, kept with the
manifest by name. Files are written after a rebalancing by part, so small parts are one file and a part with
a large share of the rows is several.

One writer at a time: a second one that publishes the same version number fails. A write
may carry a tag (a micro-batch's id); a tag that is published already makes it a no-op, so a
replayed batch is idempotent.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "__part"


def hash_part(keys: list[str], buckets: int) -> dict:
    return {"kind": "hash", "columns": keys, "buckets": buckets}


def day_part(column: str) -> dict:
    return {"kind": "day", "columns": [column]}


def score_part(column: str, steps: int) -> dict:
    return {"kind": "score", "columns": [column], "steps": steps}


BEYOND = 1 << 20  # the part of infinite scores; NaN, which sorts above them, is one further


def part_of(spec: dict) -> Column:
    """The part of a row, as text: a bucket's number, a day as YYYY-MM-DD, or a slice of scores (``none``
    without one). Slices are even on a log scale, ``steps`` of them where a score grows e-fold; a greater
    score, as float4, is never in a lower slice."""
    if spec["kind"] == "score":
        x = F.col(f"`{spec['columns'][0]}`").cast("float").cast("double")
        size = F.least(F.floor(F.log1p(F.least(F.abs(x), F.lit(1e300))) * spec["steps"]), F.lit(BEYOND - 1))
        part = F.when(F.isnan(x), BEYOND + 1).when(F.abs(x) == float("inf"), F.signum(x) * BEYOND).otherwise(F.signum(x) * size)
        return F.coalesce(part.cast("long").cast("string"), F.lit("none"))
    if spec["kind"] == "hash":
        return F.pmod(F.xxhash64(*spec["columns"]), F.lit(spec["buckets"])).cast("string")
    return F.coalesce(F.date_format(spec["columns"][0], "yyyy-MM-dd"), F.lit("none"))


class _Files:
    """The few calls on the shared file system that Spark has no table for."""

    def __init__(self, spark: SparkSession, base: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self.path(base).getFileSystem(self.conf)

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def names(self, folder: str) -> list[str]:
        if not self.fs.exists(self.path(folder)):
            return []
        return sorted(f.getPath().getName() for f in self.fs.listStatus(self.path(folder)))

    def read(self, p: str) -> str:
        stream = self.fs.open(self.path(p))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, p: str, text: str) -> None:
        """Writes a file under another name and renames it; fails if it exists."""
        folder, _, name = p.rpartition("/")
        draft = self.path(f"{folder}/.{name}-{uuid.uuid4().hex}")
        out = self.fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self.fs.exists(self.path(p)) or not self.fs.rename(draft, self.path(p)):
            self.fs.delete(draft, False)
            raise FileExistsError(f"{p} was published by another writer")

    def delete(self, p: str) -> None:
        self.fs.delete(self.path(p), True)


class Store:
    """A table in parts under ``path``. ``order`` is the column whose smallest and largest value is kept by part."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = _Files(spark, self.path)

    # ---- versions
    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType, spec: dict, order: str | None = None) -> Store:
        """An empty table; the one that is there if there is one."""
        out = cls(spark, path)
        if out.version() is None:
            out._publish({"version": 0, "schema": schema.jsonValue(), "spec": spec, "order": order or spec["columns"][0],
                          "parts": {}, "tags": {}})
        return out

    @classmethod
    def of(cls, df: DataFrame, path: str, spec: dict, order: str | None = None) -> Store:
        """A new table that holds the rows of ``df``."""
        out = cls.create(df.sparkSession, path, df.schema, spec, order)
        out.replace(df, None)
        return out

    def version(self) -> int | None:
        names = [n for n in self.files.names(f"{self.path}/manifests") if n.endswith(".json") and not n.startswith(".")]
        return int(names[-1].split(".")[0]) if names else None

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return json.loads(self.files.read(f"{self.path}/manifests/{version:012d}.json"))

    def _publish(self, m: dict) -> None:
        self.files.publish(f"{self.path}/manifests/{m['version']:012d}.json", json.dumps(m))

    # ---- reading
    def folder(self, part: str, write: str) -> str:
        return f"{self.path}/data/{write}/{PART}={part}"

    def read(self, parts=None, version: int | None = None) -> DataFrame:
        """The rows of one version; of the given parts only, whose files alone are listed and read."""
        return self._rows(self.manifest(version), parts)

    def _rows(self, m: dict, parts) -> DataFrame:
        schema = T.StructType.fromJson(m["schema"])
        live = [p for p in m["parts"] if parts is None or p in parts]
        if not live:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self.folder(p, m["parts"][p]["write"]) for p in live])

    def parts(self) -> dict[str, dict]:
        """By part: the write that its files are of, rows, and the least and greatest value of the order column."""
        return self.manifest()["parts"]

    # ---- writing
    def touched(self, batch: DataFrame, m: dict | None = None) -> list[str]:
        """The parts that rows of the batch lie in: at most as many as there are parts."""
        return [r[0] for r in batch.select(part_of((m or self.manifest())["spec"]).alias("p")).distinct().collect()]

    def merge(self, batch: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame], tag: str | None = None,
              parts: list[str] | None = None) -> bool:
        """Replaces the touched parts (``parts``, where they are known) by ``change(their rows, batch)``, whose
        rows must stay in these parts; False if a write with this tag is published already."""
        m = self.manifest()
        if tag is not None and tag in m["tags"]:
            return False
        parts = self.touched(batch, m) if parts is None else parts
        if not parts:
            return False
        return self._write(m, change(self._rows(m, set(parts)), batch), parts, tag)

    def replace(self, rows: DataFrame, parts: list[str] | None, tag: str | None = None) -> bool:
        """Puts ``rows`` in the place of the given parts (of all, if None)."""
        m = self.manifest()
        return self._write(m, rows, list(m["parts"]) if parts is None else parts, tag)

    def drop(self, parts: list[str], tag: str | None = None) -> bool:
        """Takes parts out of the table; no file is read or written but the manifest."""
        m = self.manifest()
        gone = set(parts) & set(m["parts"])
        if gone:
            self._publish(self._next(m, {p: e for p, e in m["parts"].items() if p not in gone}, tag))
        return bool(gone)

    def _next(self, m: dict, parts: dict, tag: str | None) -> dict:
        tags = m["tags"] if tag is None else {**dict(list(m["tags"].items())[-100:]), tag: m["version"] + 1}
        return {**m, "version": m["version"] + 1, "parts": parts, "tags": tags}

    def _write(self, m: dict, rows: DataFrame, parts: list[str], tag: str | None) -> bool:
        schema = T.StructType.fromJson(m["schema"])
        write = f"{m['version'] + 1:012d}-{uuid.uuid4().hex[:8]}"  # its own folder, whoever else writes this version
        target = f"{self.path}/data/{write}"
        cols = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
        dealt = rows.select(*cols).withColumn(PART, part_of(m["spec"])).hint("rebalance", PART)
        dealt.write.mode("overwrite").partitionBy(PART).parquet(target)
        kept = {p: e for p, e in m["parts"].items() if p not in set(parts)}
        written = [n.partition("=")[2] for n in self.files.names(target) if n.startswith(f"{PART}=")]
        strange = set(written) & set(kept)
        if strange:
            raise ValueError(f"rows of parts {sorted(strange)[:3]} in a write that does not touch them")
        if written:
            stored = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(PART, T.StringType())])).parquet(target)
            order = F.col(f"`{m['order']}`")
            stats = stored.groupBy(PART).agg(F.count(F.lit(1)), F.min(order).cast("string"), F.max(order).cast("string")).collect()
            kept |= {p: {"write": write, "rows": n, "least": a, "greatest": z} for p, n, a, z in stats}
        self._publish(self._next(m, kept, tag))
        return True

    def vacuum(self, keep: int = 1) -> None:
        """Deletes all that the last ``keep`` versions do not name, files of cut-off writes included."""
        last = self.version()
        versions = [v for v in range(max(0, last - keep + 1), last + 1)]
        live = {self.folder(p, e["write"]) for v in versions for p, e in self.manifest(v)["parts"].items()}
        for v in self.files.names(f"{self.path}/data"):
            for part in self.files.names(f"{self.path}/data/{v}"):
                folder = f"{self.path}/data/{v}/{part}"
                if part.startswith(f"{PART}=") and folder not in live:
                    self.files.delete(folder)
        for n in self.files.names(f"{self.path}/manifests"):
            if n.startswith(".") or int(n.split(".")[0]) < versions[0]:
                self.files.delete(f"{self.path}/manifests/{n}")
