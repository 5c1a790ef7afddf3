"""Benchmark decontamination by spaced-seed hashing.

Tokens are runs of ASCII letters, digits and non-ASCII bytes, A-Z lowered. A document
is contaminated by a benchmark item if, in one alignment of the two, some ``WINDOW``
consecutive tokens of the item agree with the document's in all but at most
``SUBSTITUTIONS``; an item shorter than the window must appear whole and exactly.

Seeds: at every token of a text, each mask of ``MASKS`` takes the tokens at its places
and ignores those between. The masks are chosen so that any window with at most
``SUBSTITUTIONS`` changed tokens still has a place where one of them is untouched
(checked by a test), so no overlap is missed. Items shorter than the window are seeded
by their first tokens under ``SHORT`` masks that fit.

Plan: one pass over the documents hashes the seeds and tests them against a bit filter
of the benchmark's seeds (fixed size, broadcast); documents with hits are kept with
their token hashes. Their hits join the benchmark's seeds on the hash, which gives
alignments (document, item, offset), and each distinct alignment is verified. The
documents' texts are never shuffled. A benchmark too large for the filter only lets
more hits through to the join.

Defined results: null or empty texts and items without tokens overlap with nothing; an
item or a document that occurs in several rows counts in each row; null ids are kept;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared
from .common import U64, lower_ascii, mix, range_hash, prefix_hash, row_slices, table, text_buffer

WINDOW = 15
SUBSTITUTIONS = 3
MASKS = [(0, 1, 2, 4, 5), (0, 1, 3, 7, 8)]
SHORT = [tuple(range(n)) for n in range(1, 5)]  # for items of fewer tokens than the first mask spans
FILTER_BITS = 24  # of the benchmark's seed filter: 16 MB as bytes
PROBES = 3
SLICE = 1 << 20
BROADCAST_ROWS = 500_000

_TOKEN = np.zeros(256, bool)
_TOKEN[48:58] = _TOKEN[65:91] = _TOKEN[97:123] = _TOKEN[128:] = True
_STEP = mix(np.arange(1, 33, dtype=U64) * U64(0xC2B2AE3D27D4EB4F)) | U64(1)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token, row i's tokens at first[i]:first[i + 1])."""
    data, off = text_buffer(texts)
    if not len(data):
        return np.zeros(0, U64), np.zeros(len(off), np.int64)
    inside = _TOKEN[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    edges = off[off < len(data)]
    before[edges] = False
    after[edges[edges > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return range_hash(prefix_hash(lower_ascii(data)), starts, ends), np.searchsorted(starts, off)


def seed_hashes(tokens: np.ndarray, mask: tuple[int, ...], tag: int) -> np.ndarray:
    """Hash of the masked tokens at each place; the last places of the array have none."""
    n = len(tokens) - mask[-1]
    if n <= 0:
        return np.zeros(0, U64)
    h = np.full(n, tag + 1, U64)
    for k, place in enumerate(mask):
        h += tokens[place:place + n] * _STEP[k]
    return mix(h)


def probes(h: np.ndarray) -> list[np.ndarray]:
    top = U64((1 << FILTER_BITS) - 1)
    return [((h >> U64(20 * k)) & top).astype(np.int64) for k in range(PROBES)]


def masks_for(n: int) -> list[tuple[int, tuple[int, ...]]]:
    """(tag, mask) that seed an item of n tokens."""
    if n >= WINDOW:
        return list(enumerate(MASKS))
    if n > MASKS[0][-1]:
        return [(0, MASKS[0])]
    k = min(n, len(SHORT))
    return [(len(MASKS) + k - 1, SHORT[k - 1])] if k else []


ALL_MASKS = [*enumerate(MASKS), *[(len(MASKS) + i, m) for i, m in enumerate(SHORT)]]


def by_seed(owner: np.ndarray, seed: np.ndarray, place: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """For each of ``n`` owners its distinct seeds, and for each of these its places."""
    order = np.lexsort((place, seed, owner))
    owner, seed, place = owner[order], seed[order], place[order]
    new = np.ones(len(seed), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (seed[1:] != seed[:-1])
    start = np.flatnonzero(new)
    outer = pa.array(np.searchsorted(owner[start], np.arange(n + 1)), pa.int32())
    places = pa.ListArray.from_arrays(pa.array(np.append(start, len(seed)), pa.int32()), pa.array(place, pa.int64()))
    return pa.ListArray.from_arrays(outer, pa.array(seed[start], pa.int64())), pa.ListArray.from_arrays(outer, places)


def benchmark_seeds(items: DataFrame, text: str = "text", item_id: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """(items with their token hashes, (seed, item row, places in the item))."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"),
                        F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, first = tokens_of(batch.column("text"))
            lists, seeds, places, owners = [], [], [], []
            for row, (a, b) in enumerate(zip(first[:-1], first[1:])):
                own = tokens[a:b]
                lists.append(own.view(np.int64))
                for tag, mask in masks_for(len(own)):
                    found = seed_hashes(own, mask, tag)
                    found = found[:1] if len(own) < WINDOW else found  # a short item counts only whole
                    seeds.append(found.view(np.int64))
                    places.append(np.arange(len(found)))
                    owners.append(np.full(len(found), row))
            none = [np.zeros(0, np.int64)]
            seed, place = by_seed(*[np.concatenate(x or none) for x in (owners, seeds, places)], len(lists))
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), batch.column("item_id"), pa.array(lists, pa.list_(pa.int64())), seed, place],
                names=["item", "item_id", "item_tokens", "seeds", "places"])

    out = shared(rows.mapInArrow(run, "item long, item_id long, item_tokens array<long>, seeds array<long>, "
                                      "places array<array<long>>"), "benchmark_seeds")
    seeds = out.select("item", F.inline(F.arrays_zip(F.col("seeds").alias("seed"), F.col("places").alias("ats"))))
    return out.select("item", "item_id", "item_tokens"), seeds


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """Filter positions of the benchmark's seeds: at most 2**FILTER_BITS numbers."""
    top = (1 << FILTER_BITS) - 1
    places = F.array(*[F.shiftrightunsigned("seed", 20 * k).bitwiseAND(F.lit(top)).cast("int") for k in range(PROBES)])
    got = seeds.select(F.explode(places).alias("p")).distinct().toArrow().column("p").to_numpy()
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[got] = True
    return np.packbits(bits)


def candidates(docs: DataFrame, bits, id_col: str, text: str) -> DataFrame:
    """Documents with a seed that passes the filter: their tokens and the passing seeds."""
    rows = docs.select(F.monotonically_increasing_id().alias("doc"), F.col(id_col).alias("doc_id"),
                       F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(bits.value).view(bool)
        for whole in batches:
            for batch in row_slices(whole, SLICE):
                tokens, first = tokens_of(batch.column("text"))
                owner = np.repeat(np.arange(batch.num_rows), np.diff(first))
                hit_at, hit_seed = [], []
                for tag, mask in ALL_MASKS:
                    h = seed_hashes(tokens, mask, tag)
                    ok = np.arange(len(h))
                    for p in range(PROBES):
                        ok = ok[known[probes(h[ok])[p]]]
                    ok = ok[owner[ok] == owner[ok + mask[-1]]] if len(ok) else ok
                    hit_at.append(ok)
                    hit_seed.append(h[ok].view(np.int64))
                at, seed = np.concatenate(hit_at), np.concatenate(hit_seed)
                rows_hit, row = np.unique(owner[at], return_inverse=True)
                seeds, places = by_seed(row, seed, at - first[owner[at]], len(rows_hit))
                picked = batch.take(pa.array(rows_hit))
                yield pa.RecordBatch.from_arrays(
                    [picked.column("doc"), picked.column("doc_id"),
                     pa.array([tokens[first[r]:first[r + 1]].view(np.int64) for r in rows_hit], pa.list_(pa.int64())),
                     seeds, places], names=["doc", "doc_id", "tokens", "seeds", "places"])

    return rows.mapInArrow(run, "doc long, doc_id long, tokens array<long>, seeds array<long>, places array<array<long>>")


def overlap(doc: np.ndarray, item: np.ndarray, offset: int) -> tuple[int, int]:
    """(windows of the item that agree, most agreeing tokens in a window) when item token
    j lies on document token j + offset."""
    n = len(item)
    place = np.arange(n) + offset
    inside = (place >= 0) & (place < len(doc))
    same = np.zeros(n, bool)
    same[inside] = doc[place[inside]] == item[inside]
    size = min(WINDOW, n)
    total = np.append(0, np.cumsum(same))
    agree = total[size:] - total[:-size]
    need = WINDOW - SUBSTITUTIONS if n >= WINDOW else n
    return int((agree >= need).sum()), int(agree.max())


def offsets(places: list[np.ndarray], ats: list[np.ndarray], n_doc: int, n_item: int) -> np.ndarray:
    """Distinct offsets at which a seed of the item lies on its like in the document."""
    mark = np.zeros(n_doc + n_item, bool)
    for p, a in zip(places, ats):
        for at in a:
            mark[p - at + n_item] = True
    return np.flatnonzero(mark) - n_item


def overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text",
             item_id: str = "item_id") -> DataFrame:
    """(doc_id, item_id, n_windows, n_agree): contaminated documents with the items found
    in them, the number of agreeing windows in their best alignment and the most agreeing
    tokens in one of these."""
    spark = docs.sparkSession
    items, seeds = benchmark_seeds(items, item_id=item_id)
    bits = spark.sparkContext.broadcast(seed_filter(seeds))
    cand = shared(candidates(docs, bits, id_col, text), "seed_hits")
    hits = cand.select("doc", F.inline(F.arrays_zip(F.col("seeds").alias("seed"), F.col("places").alias("places"))))
    if (seeds.select(F.sum(F.size("ats"))).first()[0] or 0) <= BROADCAST_ROWS:
        seeds = F.broadcast(seeds)
    meets = hits.join(seeds, "seed").groupBy("doc", "item").agg(
        F.collect_list("places").alias("places"), F.collect_list("ats").alias("ats"))
    pairs = meets.join(items, "item").join(cand.select("doc", "doc_id", "tokens"), "doc")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = []
            for r in range(batch.num_rows):
                doc, item = [batch.column(c)[r].values.to_numpy() for c in ("tokens", "item_tokens")]
                places, ats = [[x.values.to_numpy() for x in batch.column(c)[r]] for c in ("places", "ats")]
                best.append(max(overlap(doc, item, int(o)) for o in offsets(places, ats, len(doc), len(item))))
            got = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("item_id"),
                 pa.array([x[0] for x in best], pa.int64()), pa.array([x[1] for x in best], pa.int64())],
                names=["doc_id", "item_id", "n_windows", "n_agree"])
            yield got.filter(pa.array([x[0] > 0 for x in best], pa.bool_()))

    return pairs.select("doc_id", "tokens", "item_id", "item_tokens", "places", "ats").mapInArrow(
        verify, "doc_id long, item_id long, n_windows long, n_agree long")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op4_decontaminate": op4_decontaminate}
ORACLE: dict[str, str] = {}
