"""N-gram Jaccard join by filtering under several global token orders.

A document's set holds its distinct ``SIZE``-word shingles, as 64-bit hashes. Two
documents link when their sets' Jaccard similarity is at least ``PERCENT`` / 100, and
``near_duplicates`` gives every document the smallest id that links lead to.

A set of n shingles that is similar enough to another shares one of its first
n - ceil(0.8 n) + 1 shingles with the other's, whatever global order both are sorted in.
The first order, which puts frequent shingles last, makes the candidates: its prefixes are the
postings that are joined, and a pair is formed only at places from which on its sets can
still share enough. The candidates are then intersected with three more filters before any
set is moved: length bounds, parity signatures (sets that differ in d shingles differ in at
most d bits), and the prefixes under two other orders, independent and pseudo-random, which
must share as many shingles as similar sets share there. The signatures prune most of them.
Only pairs that pass all have their whole sets fetched and compared.

Frequencies only shape the first order (any order gives the same links): each task
reports shingles met in ``COMMON`` or more documents of a slice, and the
``COMMON_KEPT`` most frequent are broadcast, a fixed bound.

Groups of copies never turn into all pairs. Documents with equal sets are one node for
the join, linked by their set's digest. In the first round a posting list gives each of
its documents two pairs, with the list's first document of a compatible size and with the
one before it by size; verified links are joined into components. In the second round
only pairs of documents that are still in different components and not yet verified are
formed, and only if their signatures, folded to 256 bits, allow it. The links left out would all lie within a component, so the components are exact.

Defined results: null or empty texts have no shingles and link with nothing; a text of
fewer words is one shingle; rows with the same id are one document that links by any of
its texts, each row keeping its own count; null ids link with nothing and have a null
component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import release, shared
from .common import U64, bit, id_filter, lower_ascii, mix, row_slices, table, text_buffer, word_bounds, word_hashes
from .components import components

SIZE = 5
PERCENT = 80
COMMON = 4
COMMON_KEPT = 1 << 17
ORDERS = 3
SIGNATURE = 512  # bits at least
SLICE = 1 << 20

_ORDER = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_PLACE = [U64(x) for x in (0x8CB92BA72F3D8DD7, 0xABC98388FB8FAC03, 0x139408DCBBF7A44F,
                           0x4B1A2F0D7C6E9D35, 0xE7037ED1A0B428DB)]


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """For each row the sorted hashes of its distinct shingles."""
    data, off = text_buffer(texts)
    data = lower_ascii(data)
    starts, ends, first = word_bounds(data, off)
    words = word_hashes(data, starts, ends)
    n = len(words) - SIZE + 1
    if n > 0:
        h = np.zeros(n, U64)
        for k in range(SIZE):
            h += words[k:k + n] * _PLACE[k]
        h = mix(h)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= SIZE:
            out.append(np.unique(h[a:b - SIZE + 1]))
        elif b > a:  # the whole sequence, told apart from longer ones by its length
            out.append(mix((words[a:b] * np.array(_PLACE[:b - a])).sum(keepdims=True) + U64(b - a)))
        else:
            out.append(np.zeros(0, U64))
    return out


def prefix_length(n: int) -> int:
    """n - ceil(PERCENT / 100 * n) + 1"""
    return n - -(-PERCENT * n // 100) + 1


def random_prefix(s: np.ndarray, order: int) -> np.ndarray:
    """The prefix of a set under a pseudo-random order."""
    p = prefix_length(len(s))
    rank = mix(s ^ _ORDER[order])
    return s[np.argpartition(rank, p - 1)[:p]] if p < len(s) else s


def signature(s: np.ndarray) -> np.ndarray:
    """Parity bits of a set, as 64-bit integers: two sets that differ in d shingles differ in
    at most d bits. There are two to four bits a shingle, a power of two, so that a long
    signature folds onto one of half its length."""
    bits = max(SIGNATURE, 1 << (2 * len(s) - 1).bit_length())
    odd = np.bincount((mix(s) & U64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def _digests(docs: DataFrame) -> DataFrame:
    """Rows of documents (doc_id, n, key, sig) and, with a null key, of common shingles (token, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kind = ["doc_id", "n", "key", "sig", "token"], pa.list_(pa.int64())
        for whole in batches:
            for batch in row_slices(whole, SLICE):
                sets = shingle_sets(batch.column("text"))
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else b"" for s in sets]
                rows = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                     pa.array([signature(s) if len(s) else None for s in sets], kind), pa.nulls(rows, pa.int64())], names=names)
                distinct = dict(zip(keys, sets))  # copies in the slice count once
                token, n = np.unique(np.concatenate([*distinct.values(), np.zeros(0, U64)]), return_counts=True)
                token, n = token[n >= COMMON], n[n >= COMMON]
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(token), pa.int64()), pa.array(n.astype(np.int64)), pa.nulls(len(token), pa.binary()),
                     pa.nulls(len(token), kind), pa.array(token.view(np.int64))], names=names)

    return docs.mapInArrow(run, "doc_id long, n long, key binary, sig array<long>, token long")


def _postings(docs: DataFrame, common) -> DataFrame:
    """(token, n, doc_id, place) for the first order's prefix of every document, with the token's
    place in it; of documents with equal sets in a task, the first one's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, level = common.value
        seen: set[bytes] = set()
        for whole in batches:
            for batch in row_slices(whole, SLICE):
                out: list[tuple] = []
                for doc, s in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text"))):
                    if doc is None or not len(s):
                        continue
                    key = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    if key in seen:
                        continue
                    seen.add(key)
                    rank = mix(s ^ _ORDER[0]) >> U64(18)
                    if len(token):
                        at = np.minimum(np.searchsorted(token, s), len(token) - 1)
                        rank = np.where(token[at] == s, rank | (level[at] << U64(46)), rank)
                    p = prefix_length(len(s))
                    picked = np.argsort(rank, kind="stable")[:p]
                    out.append((s[picked], np.full(p, len(s)), np.full(p, doc), np.arange(p)))
                cols = [np.concatenate([o[k] for o in out] or [np.zeros(0)]).astype(np.uint64 if k == 0 else np.int64)
                        for k in range(4)]
                yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in cols],
                                                 names=["token", "n", "doc_id", "place"])

    return docs.mapInArrow(run, "token long, n long, doc_id long, place long")


def _sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, n, s, o1, o2) for the ids (column ``id``), and few others: a document's set and its
    prefixes under the other orders. Texts are cut only where the id passes a fixed-size bit filter."""
    bits = id_filter(ids, "id")
    docs = docs.where("doc_id is not null").select("doc_id", "text", bit("doc_id").alias("bit"))
    names = ["doc_id", "n", "s", *[f"o{k}" for k in range(1, ORDERS)]]

    # The filter is looked up here, as one before this would be a second worker in each task.
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(bits.value).view(bool)
        for group in batches:
            group = group.filter(pa.array(known[group.column("bit").to_numpy(zero_copy_only=False)]))
            for batch in row_slices(group, SLICE):
                sets = shingle_sets(batch.column("text"))
                cols = [sets, *[[random_prefix(s, k) if len(s) else s for s in sets] for k in range(1, ORDERS)]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                     *[pa.array([x.view(np.int64) for x in col], pa.list_(pa.int64())) for col in cols]], names=names)

    return docs.mapInArrow(run, ", ".join(["doc_id long", "n long", *[f"{c} array<long>" for c in names[2:]]]))


def _with_both(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    for x in ("a", "b"):
        pairs = pairs.join(sets.select(*[F.col(c).alias(x if c == "doc_id" else f"{c}{x}") for c in sets.columns]), x)
    return pairs


def _least(a: str, b: str) -> Column:
    """The shingles that similar sets of these sizes share at least."""
    return F.expr(f"({PERCENT} * ({a} + {b}) + {99 + PERCENT}) div {100 + PERCENT}")


def _room(n_a: str, at_a: str, n_b: str, at_b: str) -> Column:
    """Whether sets whose first common shingle lies at these places of the first order can be similar:
    all others that they share come after it in both."""
    return F.least(F.col(n_a) - F.col(at_a), F.col(n_b) - F.col(at_b)) >= _least(n_a, n_b)


def _share_prefix(k: int) -> Column:
    """Whether two prefixes under order k share as many shingles as similar sets must share
    there: all that they share but those that can lie beyond a prefix."""
    beyond = F.expr(f"({PERCENT} * greatest(na, nb) + 99) div 100") - 1
    return F.size(F.array_intersect(f"o{k}a", f"o{k}b")) >= F.greatest(F.lit(1), _least("na", "nb") - beyond)


def _verified(docs: DataFrame, signatures: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that every filter leaves and whose whole sets are similar. The signatures come
    first, similar sets differing in at most a ninth of their sizes' sum; then the prefixes under the
    other orders, and only then sets are moved, all within Spark's own rows."""
    def half(x):  # the other side's set is a little smaller and its signature half as long
        n = (F.size(x) / 2).cast("int")
        return F.zip_with(F.slice(x, 1, n), F.slice(x, n + 1, n), lambda p, q: p.bitwiseXOR(q))

    a = F.when(F.size("siga") > F.size("sigb"), half("siga")).otherwise(F.col("siga"))
    b = F.when(F.size("sigb") > F.size("siga"), half("sigb")).otherwise(F.col("sigb"))
    apart = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    near = _with_both(pairs, signatures).where(_sizes_fit("na", "nb")).where(((100 + PERCENT) * apart <= (100 - PERCENT) * (F.col("na") + F.col("nb"))))
    near = shared(near.select("a", "b").distinct(), "near_pairs")
    ids = near.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = shared(_sets_of(docs, ids), "near_sets")
    left = _with_both(near, sets.drop("s")).where(_sizes_fit("na", "nb"))
    for k in range(1, ORDERS):
        left = left.where(_share_prefix(k))
    left = shared(left.select("a", "b").distinct(), "prefix_pairs")
    both = _with_both(left, sets.select("doc_id", "s"))
    links = shared(both.where(similar("sa", "sb")).select("a", "b").distinct(), "links")
    release(near, sets, left)
    return links


def similar(a: str, b: str) -> Column:
    """Whether two whole sets are similar enough."""
    inter = F.size(F.array_intersect(a, b))
    return 100 * inter >= PERCENT * (F.size(a) + F.size(b) - inter)


def _sizes_fit(a: str, b: str):
    return (PERCENT * F.greatest(a, b) <= 100 * F.least(a, b))


def _open(lists: DataFrame, parts: DataFrame, signatures: DataFrame) -> DataFrame:
    """The lists that hold documents of several components, with these (``c``) and with the documents'
    signatures folded to four integers."""
    by_token = Window.partitionBy("token")
    part = lists.join(parts.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "token", "n", "doc_id", "place", F.coalesce("component", "doc_id").alias("c"))
    part = part.withColumn("low", F.min("c").over(by_token)).withColumn("high", F.max("c").over(by_token))
    part = part.where("low <> high").drop("low", "high")
    folded = [F.expr(f"aggregate(sequence({k}, size(sig) - 1, 4), 0L, (t, i) -> t ^ sig[i])").alias(f"s{k}") for k in range(4)]
    return shared(part.join(signatures.select("doc_id", "n", *folded), ["doc_id", "n"]), "open_lists")


def _joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    """The components after further links: these are lifted to the components that they join."""
    tops = parts.withColumnRenamed("id", "x")

    def top_of(col):
        return F.coalesce(F.col("component"), F.col(col)).alias(col)

    lifted = (links.join(tops, F.col("a") == F.col("x"), "left").select(top_of("a"), "b")
              .join(tops, F.col("b") == F.col("x"), "left").select("a", top_of("b")))
    up = shared(components(lifted, "a", "b"), "components").select(F.col("id").alias("u"), F.col("component").alias("v"))
    every = parts.union(up.select("u", "u"))
    return shared(every.join(up, F.col("component") == F.col("u"), "left").groupBy("id").agg(
        F.min(F.coalesce("v", "component")).alias("component")), "components")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark = docs.sparkSession
    digests = shared(_digests(docs), "shingle_digests")
    rows = digests.where("key is not null").drop("token")
    signatures = rows.where("doc_id is not null and n > 0").select("doc_id", "n", "sig")

    # Frequent shingles, most frequent last in the first order.
    top = (digests.where("token is not null").groupBy("token").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "token").limit(COMMON_KEPT).toArrow())
    token = top.column("token").to_numpy().view(np.uint64) if top.num_rows else np.zeros(0, U64)
    by = np.argsort(token)
    level = (U64(len(token)) - np.arange(len(token), dtype=U64))[by]
    common = spark.sparkContext.broadcast((token[by], level))

    # Equal sets.
    same = rows.where("doc_id is not null and n > 0")
    equal = same.groupBy("key").agg(F.min("doc_id").alias("b"), F.count(F.lit(1)).alias("k")).where("k > 1")
    equal = same.join(equal, "key").select(F.col("doc_id").alias("a"), "b").where("a <> b")

    # Dealt before sizes are added, which then do not travel.
    lists = _postings(docs, common).repartition("token").withColumn("size", (F.log("n") * 1e6).cast("long"))
    by_token = Window.partitionBy("token")
    fitting = by_token.orderBy("size").rangeBetween(-223200, 0)  # 10**6 * log(100 / PERCENT), rounded up
    before = F.lag(F.struct("doc_id", "n")).over(by_token.orderBy("size", "doc_id"))
    lists = (lists.withColumn("prev", before).withColumn("first", F.min(F.struct("size", "doc_id", "n")).over(fitting))
             .withColumn("low", F.min("doc_id").over(by_token)).withColumn("high", F.max("doc_id").over(by_token)))
    lists = shared(lists.where("low <> high").select("token", "n", "doc_id", "place", F.col("first").dropFields("size").alias("first"), "prev"),
                   "posting_lists")
    pairs = (lists.select("n", F.col("doc_id").alias("b"), F.explode(F.array("first", "prev")).alias("x"))
             .select("n", "b", F.col("x.doc_id").alias("a"), F.col("x.n").alias("m"))
             .where("a <> b").where(_sizes_fit("n", "m"))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    tried = shared(pairs, "first_pairs")
    links = _verified(docs, signatures, tried).union(equal)
    parts = shared(components(links, "a", "b"), "components")

    part = _open(lists, parts, signatures)
    release(lists)
    # What the first round leaves: pairs across components, formed where their place in the lists allows them to be similar.
    x = part.select("token", *[F.col(c).alias(f"{c}_a") for c in ("n", "doc_id", "place", "c", "s0", "s1", "s2", "s3")])
    y = part.select("token", *[F.col(c).alias(f"{c}_b") for c in ("n", "doc_id", "place", "c", "s0", "s1", "s2", "s3")])
    apart = sum((F.bit_count(F.col(f"s{k}_a").bitwiseXOR(F.col(f"s{k}_b"))) for k in range(4)), F.lit(0))
    more = (x.join(y, (x["token"] == y["token"]) & F.expr("c_a <> c_b and doc_id_a < doc_id_b") & _sizes_fit("n_a", "n_b")
                   & _room("n_a", "place_a", "n_b", "place_b")
                   & ((100 + PERCENT) * apart <= (100 - PERCENT) * (F.col("n_a") + F.col("n_b"))))
            .select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b")).distinct())
    more = _verified(docs, signatures, more.join(tried, ["a", "b"], "left_anti"))
    if not more.isEmpty():
        parts = _joined(parts, more)
    parts = parts.groupBy("id").agg(F.min("component").alias("component"))
    out = rows.join(parts.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op5_ngram_join": op5_ngram_join}
ORACLE: dict[str, str] = {}
