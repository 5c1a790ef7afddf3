"""Target-distribution importance resampling by bit-sliced aggregation.

Features are the runs of 1 to 3 words of a text; a feature's bucket is the crc32 of its bytes
modulo ``BUCKETS``. A bucket's gain says how much more often the target texts have it than
all documents, and a document's weight is the sum of the gains over its features.

The sum is taken on bits. A document's bucket counts become planes of ``BUCKETS`` bits, plane j
holding bit j of every count; the gains become planes as well, in two's complement, so
that the last one counts negative. Then

    weight = sum over j, k of  (+-) 2**(j + k) * popcount(count plane j AND gain plane k)

which is exact in integers, whatever the length of the text. The crc of a run of words is
put together from those of its words: a crc is linear, so appending n bytes multiplies it by
a matrix that depends on n alone.

Corpus counts are summed over all documents (one array of ``BUCKETS`` numbers a task), the gains
made of them are ``BUCKETS`` numbers. The draw ranks all rows by score in a range-partitioned sort.

Defined results: null and empty texts have no features and weight 0; rows are documents of
their own, also with the same id; a null id is hashed as an empty one and sorts before the others; rows
that agree in id and score are ranked by their number of features; without target texts, or on an empty
table, the formula holds with zero counts; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import global_rank
from ..session import shared
from .common import lower_ascii, row_slices, table, text_buffer, word_bounds

BUCKETS = 10_000
RUN = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
SCALE = 1000
SLICE = 1 << 20
ROWS = 64  # documents whose planes are made together
LONG = 48  # bytes of a word above which its runs are hashed one by one

# FIXED VALUES: bytes of a word after lower-casing, digits, a-z and all beyond ASCII.
_CHARS = np.zeros(256, bool)
_CHARS[0x30:0x3A] = _CHARS[0x61:0x7B] = _CHARS[0x80:] = True

_TABLE = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)  # register 0, byte b


def _shift_tables(most: int) -> np.ndarray:
    """[n, i, b]: what byte i of a crc register, of value b, becomes after n zero bytes."""
    out = np.zeros((most + 1, 4, 256), np.uint32)
    cur = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(most + 1):
        out[n] = cur
        cur = (cur >> np.uint32(8)) ^ _TABLE[cur & np.uint32(255)]
    return out


_SHIFT = _shift_tables(LONG + 1)
_FLAT = _SHIFT.reshape(-1)


def _shifted(reg: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Registers after n zero bytes each (n up to ``LONG`` + 1)."""
    at = n.astype(np.int64) * 1024
    out = _FLAT[at + (reg & np.uint32(255))]
    for i in (1, 2, 3):
        out = out ^ _FLAT[at + 256 * i + ((reg >> np.uint32(8 * i)) & np.uint32(255))]
    return out


def run_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(crc32, document) of all runs of 1 to ``RUN`` words that lie in one document, words
    being joined by one space."""
    n = len(starts)
    size = ends - starts
    short = np.minimum(size, LONG)
    zero = np.zeros(n, np.uint32)  # register of the word's bytes, from zero
    order = np.argsort(-short, kind="stable")
    alive = np.searchsorted(-short[order], -np.arange(1, LONG + 1), side="right")
    for k in range(int(short.max(initial=0))):
        row = order[:alive[k]]
        reg = zero[row]
        zero[row] = (reg >> np.uint32(8)) ^ _TABLE[(reg ^ data[starts[row] + k]) & np.uint32(255)]
    ones = np.full(n, 0xFFFFFFFF, np.uint32)
    reg = _shifted(ones, short) ^ zero
    spaced = _shifted(np.full(n, _TABLE[0x20], np.uint32), short) ^ zero  # a space, then the word, from zero
    long = size > LONG
    crcs, owners = [], []
    for m in range(1, RUN + 1):
        if m > 1:  # the run of m words that ends at word i: shift the shorter run and add the word
            reg = _shifted(reg[:-1], short[m - 1:] + 1) ^ spaced[m - 1:] if n >= m else np.zeros(0, np.uint32)
        if n < m:
            break
        first, last = np.arange(n - m + 1), np.arange(m - 1, n)
        crc = reg ^ np.uint32(0xFFFFFFFF)
        if long.any():
            within = np.cumsum(np.append(0, long))
            for i in np.flatnonzero(within[last + 1] > within[first]).tolist():
                crc[i] = zlib.crc32(b" ".join(data[starts[j]:ends[j]].tobytes() for j in range(i, i + m)))
        same = owner[first] == owner[last]
        crcs.append(crc[same])
        owners.append(owner[first][same])
    return np.concatenate([np.zeros(0, np.uint32), *crcs]), np.concatenate([np.zeros(0, np.int64), *owners])


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, document of each, words by document) of a batch of texts, in order of documents."""
    data, off = text_buffer(texts)
    data = lower_ascii(data)
    starts, ends, first = word_bounds(data, off, _CHARS)
    owner = np.repeat(np.arange(len(off) - 1), np.diff(first))
    crcs, owners = run_crcs(data, starts, ends, owner)
    order = np.argsort(owners, kind="stable")
    return (crcs % np.uint32(BUCKETS)).astype(np.int64)[order], owners[order], np.diff(first)


def bucket_counts(texts: DataFrame, col: str = "text") -> np.ndarray:
    """How often each bucket occurs in all texts: ``BUCKETS`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for whole in batches:
            for batch in row_slices(whole, SLICE, "t"):
                total += np.bincount(features(batch.column("t"))[0], minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    rows = texts.select(F.col(col).alias("t")).mapInArrow(run, "bucket int, n long")
    got = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(SCALE * ln(share in the target / share in the source)) by bucket, with one added to each count."""
    s_all, t_all = float(source.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array([math.floor(SCALE * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


WORDS = -(-BUCKETS // 64)


def planes_of(bits: np.ndarray) -> np.ndarray:
    """Rows of ``BUCKETS`` booleans as rows of 64-bit words."""
    padded = np.zeros((len(bits), WORDS * 64), bool)
    padded[:, :BUCKETS] = bits
    return np.packbits(padded, axis=1).view(np.uint64)


def gain_planes(gain: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """(planes, their values): bit planes of the gains in two's complement; the last value is negative."""
    width = max(int(np.abs(gain).max(initial=0)).bit_length(), 1) + 1
    planes = planes_of(np.array([(gain >> k) & 1 for k in range(width)], bool))
    return planes, [1 << k for k in range(width - 1)] + [-(1 << (width - 1))]


def weigh(buckets: np.ndarray, owner: np.ndarray, n: int, planes: np.ndarray, values: list[int]) -> list[int]:
    """Weights of n documents from their features (in order of documents)."""
    out: list[int] = []
    bounds = np.searchsorted(owner, np.arange(n + 1))
    for a in range(0, n, ROWS):
        b = min(a + ROWS, n)
        part = slice(bounds[a], bounds[b])
        counts = np.bincount((owner[part] - a) * BUCKETS + buckets[part], minlength=(b - a) * BUCKETS).reshape(b - a, BUCKETS)
        weight = np.zeros(b - a, np.int64)
        for j in range(int(counts.max(initial=0)).bit_length()):
            plane = planes_of((counts >> j) & 1 == 1)
            for gain, value in zip(planes, values):
                weight += np.bitwise_count(plane & gain).sum(axis=1).astype(np.int64) * (value << j)
        out += weight.tolist()
    return out


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) for every row."""
    shared_planes = docs.sparkSession.sparkContext.broadcast(gain_planes(gain))  # a few times BUCKETS bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, values = shared_planes.value
        for whole in batches:
            for batch in row_slices(whole, SLICE, "t"):
                buckets, owner, words = features(batch.column("t"))
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(words), pa.array(np.bincount(owner, minlength=n)),
                     pa.array(weigh(buckets, owner, n, planes, values), pa.int64())],
                    names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("t"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank): of the documents with ``least_words``
    words, ``percent`` in a hundred are drawn without replacement, with odds that follow the
    weights (the highest of weight plus Gumbel noise that the seed and the id determine)."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(-SCALE * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))
    scored = weights(docs, gain).withColumn("score", F.col("weight") + noise)
    scored = shared(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    enough = F.col("n_words") >= least_words
    drawn = percent * (scored.where(enough).count()) // 100
    # Repeated rows share all but the row number, by which the sort can deal them to several tasks.
    ranked = global_rank(scored, [enough.desc(), F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("n_features"), F.asc("row")], "rank")
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score",
                         F.when(enough & (F.col("rank") <= drawn), F.col("rank")).alias("rank"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {"op12_resample": op12_resample}
ORACLE: dict[str, str] = {}
