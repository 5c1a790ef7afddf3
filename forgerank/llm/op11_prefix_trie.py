"""Conversation prefix trie by truncation peeling.

Every distinct sequence of a conversation's first d turns is a node of depth d. A turn is
known by the digest of its role and text, a sequence by two running XORs of hashes of
(place, digest), 128 bits, so texts are read once and never moved. A conversation is one
row: the path of its nodes' keys, each with the code points of the node's last text.

Peeling descends from the greatest depth. The rows of a level are the conversations that
end there and the nodes that survive from the level below, whose paths have lost their
last turn; grouped by the last key that is left they give the level's nodes and, in the
same aggregation, smallest member, members, children, leaves and saved code points of the
subtree. Equal paths are one row from the level on where they meet, before any shuffle
(partial aggregation), so a sequence that a third of all conversations share costs a row a
task. Every level is written once and is the next one's input.

The ``SINGLE`` levels nearest to the root are peeled one by one. Below them most rows meet no other
for many turns, so these levels are peeled in bands whose widths double: a row that shares
no node of the band with another loses all its turns in the band at once, and where rows
do meet, their band is halved until it is one level. So a conversation of n turns takes
some log n steps, and only as many more as there are levels where sequences part.

Held at once are one conversation's path (20 bytes a turn) and nothing else: the ids of
the conversations that end in a node are sorted and hashed as a stream.

Defined results: null role and text count as empty; a null place sorts first; rows of one
conversation with the same place are turns of their own, ordered by role and then by the
turn's digest; repeated rows are repeated turns; rows without a conversation id belong to no
conversation; an empty table has no nodes, not even a root; other columns are ignored.
Ids divided by 100 are rounded down, also negative ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import release, scratch_path, shared
from .common import table

PATH = "array<struct<depth:int,k1:long,k2:long,size:int>>"
NO_ENDS = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, size): the turns by conversation, numbered from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        digest.alias("digest"), F.length(text).alias("size"))
    place = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "digest")
    return rows.select("conv_id", F.row_number().over(place).alias("pos"), "digest", "size")


def rebuilt_turns(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns): conversation c begins with the first h turns of conversation
    c - c % every, h being its id's crc32 % most, and goes on with its own after its first h.
    The lent turns of a conversation are fewer than ``most``, the borrowers fewer than ``every``."""
    def lent(c):
        return (F.crc32(F.col(c).cast("string").cast("binary")) % most).cast("int")

    ids = shared(turns.select("conv_id").distinct(), "conversations")
    first = turns.where((F.pmod("conv_id", F.lit(every)) == 0) & (F.col("pos") < most))
    first = first.withColumnRenamed("conv_id", "base")
    borrowed = (ids.withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(every))).join(first, "base")
                .where(F.col("pos") <= lent("conv_id")))
    own = turns.where(F.col("pos") > lent("conv_id"))
    cols = ["conv_id", "pos", "digest", "size"]
    both = borrowed.select(F.lit(0).alias("part"), *cols).union(own.select(F.lit(1), *cols))
    place = Window.partitionBy("conv_id").orderBy("part", "pos")
    return ids, both.select("conv_id", F.row_number().over(place).alias("pos"), "digest", "size")


def paths(ids: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, path) of every conversation, with turns or without."""
    sofar = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    keys = [F.bit_xor(F.xxhash64(F.lit(k), "pos", "digest")).over(sofar).alias(f"k{k}") for k in (1, 2)]
    steps = turns.select("conv_id", F.struct(F.col("pos").alias("depth"), *keys, "size").alias("step"))
    grouped = steps.groupBy("conv_id").agg(F.sort_array(F.collect_list("step")).alias("path"))
    return ids.join(grouped, "conv_id", "left").select(
        "conv_id", F.coalesce("path", F.array()).cast(PATH).alias("path"))


SINGLE = 8
SUMS = ["n_convs", "n_children", "n_leaves", "saved"]
NODE = "depth int, k1 long, k2 long, p1 long, p2 long, conv_id long, n_convs long, n_children long, n_leaves long, saved long"


def _keys(depth: int) -> list:
    """The key of the path's node at this depth; the root's is zero."""
    return [F.element_at("path", depth)[k] if depth else F.lit(0).cast("long") for k in ("k1", "k2")]


def _stripped(rows: DataFrame, depth: int) -> DataFrame:
    """Finished rows as their nodes' parents at this depth see them."""
    return rows.select("conv_id", F.slice("path", 1, depth).alias("path"), "n_convs", F.lit(1).cast("long").alias("n_children"),
                       "n_leaves", "saved")


def _level(rows: DataFrame, d: int) -> tuple[DataFrame, DataFrame]:
    """(nodes, rows for the next level) of the rows at depth d, regrouped."""
    k1, k2 = _keys(d)
    level = rows.groupBy(k1.alias("k1"), k2.alias("k2")).agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in SUMS], F.first("path").alias("path"))
    gain = (F.col("n_convs") - 1) * F.element_at("path", d)["size"] if d else F.lit(0)
    done = shared(level.select(
        "k1", "k2", "conv_id", "n_convs", "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
        (F.col("saved") + gain).alias("saved"), "path"), "trie_level")
    p1, p2 = _keys(d - 1) if d else [F.lit(None).cast("long")] * 2
    nodes = done.select(F.lit(d).alias("depth"), "k1", "k2", p1.alias("p1"), p2.alias("p2"), "conv_id", *SUMS)
    return nodes, _stripped(done, d - 1) if d else None


def _alone(rows: DataFrame, lo: int) -> tuple[DataFrame, DataFrame]:
    """(nodes, rows at depth ``lo``) of rows that share no node below ``lo`` with another."""
    size = F.size("path")
    leaves = F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long")

    def saved(depth):  # what the turns from this depth to the path's end save
        texts = F.aggregate(F.slice("path", depth, size - depth + 1), F.lit(0).cast("long"), lambda t, x: t + x["size"])
        return F.col("saved") + (F.col("n_convs") - 1) * texts

    each = rows.withColumn("depth", F.explode(F.sequence(F.lit(lo + 1), size)))
    at, up = F.element_at("path", F.col("depth")), F.when(F.col("depth") > 1, F.element_at("path", F.greatest(F.col("depth") - 1, F.lit(1))))
    nodes = each.select(
        "depth", at["k1"].alias("k1"), at["k2"].alias("k2"), F.coalesce(up["k1"], F.lit(0)).alias("p1"),
        F.coalesce(up["k2"], F.lit(0)).alias("p2"), "conv_id", "n_convs",
        F.when(F.col("depth") == size, F.col("n_children")).otherwise(1).cast("long").alias("n_children"), leaves.alias("n_leaves"),
        saved(F.col("depth")).alias("saved"))
    done = rows.select("conv_id", "path", "n_convs", leaves.alias("n_leaves"), saved(F.lit(lo + 1)).alias("saved"))
    return nodes, _stripped(done, lo)


def _descend(rows: DataFrame, lo: int, hi: int, nodes: list[DataFrame]) -> DataFrame:
    """Peels rows whose depths lie above ``lo`` and up to ``hi`` down to ``lo``."""
    if hi - lo == 1:
        found, up = _level(rows, hi)
        nodes.append(found)
        return up
    k1, k2 = _keys(lo + 1)
    rows = shared(rows.withColumn("k1", k1).withColumn("k2", k2), "band")
    many = shared(rows.groupBy("k1", "k2").count().where("count > 1").select("k1", "k2"), "meeting")
    if many.isEmpty():
        found, up = _alone(rows, lo)
        nodes.append(found)
        return up
    found, up = _alone(rows.join(many, ["k1", "k2"], "left_anti"), lo)
    nodes.append(found)
    meeting, mid = rows.join(many, ["k1", "k2"], "left_semi").drop("k1", "k2"), (lo + hi) // 2
    upper = _descend(meeting.where(F.size("path") > mid), mid, hi, nodes)
    return up.unionByName(_descend(meeting.where(F.size("path") <= mid).unionByName(upper), lo, mid, nodes))


def peel(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, ended) of the trie over (conv_id, path) rows: ``nodes`` has (depth, k1, k2, p1, p2,
    conv_id, n_convs, n_children, n_leaves, saved), p1 and p2 the parent's key; ``ended`` has
    (depth, k1, k2, conv_id) for every conversation and the node that it ends in."""
    spark = conversations.sparkSession
    last = F.when(F.size("path") > 0, F.element_at("path", -1))
    ended = conversations.select(F.size("path").alias("depth"), *[
        F.coalesce(last[k], F.lit(0)).cast("long").alias(k) for k in ("k1", "k2")], "conv_id", "path")
    # Conversations with equal turns are one row from here on; a row waits in the band of its depth.
    none = F.lit(0).cast("long")
    distinct = ended.groupBy("depth", "k1", "k2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                                                      F.first("path").alias("path"))
    beyond = F.ceil(F.log2(F.greatest(F.col("depth"), F.lit(SINGLE)) / SINGLE)).cast("int")
    at = scratch_path(spark, "waiting")
    (distinct.select("conv_id", "path", "n_convs", none.alias("n_children"), none.alias("n_leaves"), none.alias("saved"),
                     (F.least(F.col("depth"), F.lit(SINGLE)) + beyond).alias("band"))
     .write.mode("overwrite").partitionBy("band").parquet(at))
    waiting = spark.read.schema(f"conv_id long, path {PATH}, n_convs long, n_children long, n_leaves long, saved long, band int").parquet(at)
    deepest = waiting.agg(F.max("band")).first()[0]
    nodes, up = [], None
    for band in range(-1 if deepest is None else deepest, -1, -1):
        rows = waiting.where(F.col("band") == band).drop("band")
        rows = rows if up is None else rows.unionByName(up)
        if band > SINGLE:
            up = _descend(rows, SINGLE << (band - SINGLE - 1), SINGLE << (band - SINGLE), nodes)
        else:
            found, up = _level(rows, band)
            nodes.append(found)
    out = spark.createDataFrame([], NODE)
    for found in nodes:
        out = out.union(found)
    return out, ended.drop("path")


def ends_digest(ended: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): the hash of the ids that end in a node, ascending and
    joined by commas. A running hash over sorted rows holds a node of any size."""
    schema = "depth int, k1 long, k2 long, ends_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, out = None, None, []

        def batch_of(rows):
            cols = list(zip(*rows)) or [()] * 4
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                              names=["depth", "k1", "k2", "ends_sha256"])

        for batch in batches:
            for *key, conv in zip(*[batch.column(c).to_pylist() for c in ("depth", "k1", "k2", "conv_id")]):
                if key != node:
                    if node is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(b",%d" % conv)
            if len(out) >= 5000:
                yield batch_of(out)
                out = []
        if node is not None:
            out.append((*node, digest.hexdigest()))
        yield batch_of(out)

    dealt = ended.repartition("depth", "k1", "k2").sortWithinPartitions("depth", "k1", "k2", "conv_id")
    return dealt.mapInArrow(run, schema)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row a node of the trie over (conv_id, path) rows, with its parent's smallest member
    and the digest of the conversations that end in it."""
    nodes, ended = peel(conversations)
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(ends_digest(ended), ["depth", "k1", "k2"], "left").join(parents, ["depth", "p1", "p2"], "left")
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = shared(ordered_turns(table(spark, sf_dir, "conversations")), "turns")
    rows = shared(paths(*rebuilt_turns(turns)), "paths")
    release(turns)
    return prefix_trie(rows).select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), "ends_sha256")


QUERIES = {"op11_prefix_trie": op11_prefix_trie}
ORACLE: dict[str, str] = {}
