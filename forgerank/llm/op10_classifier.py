"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

Features of a document: its distinct words, hashed to ``2**WORD_BITS`` places, with
weight 1 + log(count) scaled to unit length; structure statistics of the whole text and
its stated length, each put into one of ``BINS`` bins cut at the training quantiles.
The score is the logistic of w0 + sum(w x) + 1/2 sum_f((sum v_f x)^2 - sum (v_f x)^2):
by that identity all pairwise interactions cost time linear in the features.

The model is fitted with numpy on at most ``SAMPLE`` labelled rows (those least by a
hash of their id; a documented bound on what the driver holds) and broadcast; its size
is fixed by the parameters. Scoring maps over the documents where they lie, without a
shuffle. Language, source and id are never inputs.

Defined results: a null text scores as the empty text; null ``n_chars`` is counted from
the text; repeated rows are scored alike and kept; labels that are null or of ids that
are null are not learned from, an id with several labels counts with the lowest; without
any labels all scores are 0.5; an empty table gives an empty result; other columns are
carried along, but a column named like an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lower_ascii, mix, row_slices, table, text_buffer, without, word_bounds, word_hashes

WORD_BITS = 14
BINS = 8
FACTORS = 8
SAMPLE = 6000
EPOCHS = 12
THRESHOLD = 0.7
SLICE = 1 << 20

STATS = ["log_words", "word_length", "upper", "digits", "symbols", "punctuation", "not_ascii", "lines",
         "distinct_words", "top_word", "same_as_last", "distinct_pairs", "capitals", "log_chars"]

_KIND = np.zeros((256, 5), bool)
_KIND[65:91, 0] = True
_KIND[48:58, 1] = True
for _c in b"#*$%&|<>{}[]\\^~_=+@/":
    _KIND[_c, 2] = True
for _c in b".,;:!?'\"()-":
    _KIND[_c, 3] = True
_KIND[128:, 4] = True


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of consecutive ranges of ``values``, empty ranges included; a range's sum does not
    depend on its neighbours, not even in the last bit."""
    out = np.zeros(len(bounds) - 1, np.float64)
    some = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(some):
        out[some] = np.add.reduceat(np.asarray(values, np.float64), bounds[some])
    return out


def grouped(owner: np.ndarray, key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, key) with their counts, in order."""
    both, n = np.unique((owner.astype(np.uint64) << np.uint64(bits)) | key.astype(np.uint64), return_counts=True)
    return (both >> np.uint64(bits)).astype(np.int64), (both & np.uint64((1 << bits) - 1)).astype(np.int64), n


def featurize(texts: pa.Array, n_chars: pa.Array | None):
    """(row bounds, word places, word weights, statistics by row)."""
    data, off = text_buffer(texts)
    rows = len(off) - 1
    starts, ends, first = word_bounds(data, off)
    hashes = word_hashes(lower_ascii(data), starts, ends)
    counts = np.diff(first)
    owner = np.repeat(np.arange(rows), counts)
    doc, place, n = grouped(owner, hashes >> np.uint64(64 - WORD_BITS), WORD_BITS)
    weight = 1 + np.log(n)
    bounds = np.searchsorted(doc, np.arange(rows + 1))
    weight = weight / np.sqrt(np.maximum(sums(weight * weight, bounds), 1e-12))[doc]
    words, size = np.maximum(counts, 1), np.maximum(np.diff(off), 1)
    kinds = [sums(_KIND[data, k], off) / size for k in range(5)]
    top = np.zeros(rows)
    np.maximum.at(top, doc, n)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    pair_owner, pairs = owner[1:][owner[1:] == owner[:-1]], mix(hashes[1:] ^ (hashes[:-1] * np.uint64(3)))
    pairs = pairs[owner[1:] == owner[:-1]] >> np.uint64(40)
    pair_doc, _, _ = grouped(pair_owner, pairs, 24)
    length = _KIND[data, 0]
    capital = sums(length, np.append(starts, len(data)))[:len(starts)] if len(starts) else np.zeros(0)
    capital = (capital >= 2) & (2 * capital > ends - starts) if len(starts) else np.zeros(0, bool)
    chars = np.diff(off) - sums((data & 0xC0) == 0x80, off)
    if n_chars is not None:
        given = pc.cast(n_chars, pa.float64()).to_numpy(zero_copy_only=False)
        chars = np.where(np.isnan(given), chars, np.maximum(given, 0))
    stats = np.stack([
        np.log1p(counts), sums(ends - starts, first) / words, *kinds[:5], sums(data == 10, off) / words,
        np.diff(bounds) / words, top / words, sums(same, first) / words,
        np.bincount(pair_doc, minlength=rows) / np.maximum(counts - 1, 1), sums(capital, first) / words,
        np.log1p(chars)], axis=1)
    return bounds, place, weight, stats


def with_bins(bounds, place, weight, stats, cuts):
    """All features by row: places, weights and row starts; every row has its bins."""
    rows, n_stats = stats.shape
    bins = np.stack([np.searchsorted(cuts[k], stats[:, k], side="right") for k in range(n_stats)], axis=1)
    bins = bins + (1 << WORD_BITS) + np.arange(n_stats) * BINS
    counts = np.diff(bounds)
    owner = np.concatenate([np.repeat(np.arange(rows), counts), np.repeat(np.arange(rows), n_stats)])
    order = np.argsort(owner, kind="stable")
    idx = np.concatenate([place, bins.ravel()])[order]
    val = np.concatenate([weight, np.full(rows * n_stats, n_stats ** -0.5)])[order]
    return idx, val, bounds[:-1] + np.arange(rows) * n_stats


def raw_score(model, idx, val, at):
    """The factorisation machine's value before the logistic, by the sum-of-squares identity."""
    w0, w, v = model
    if not len(at):
        return np.zeros(0), None, None
    vx = v[idx] * val[:, None]
    s = np.add.reduceat(vx, at)
    pairs = 0.5 * (s * s - np.add.reduceat(vx * vx, at)).sum(axis=1)
    return w0 + np.add.reduceat(w[idx] * val, at) + pairs, s, vx


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(bounds, place, weight, stats, y, seed: int = 7):
    """(cuts, model) fitted by Adagrad on the logistic loss, classes weighted alike."""
    cuts = [np.unique(np.quantile(stats[:, k], np.arange(1, BINS) / BINS)) for k in range(stats.shape[1])]
    idx, val, at = with_bins(bounds, place, weight, stats, cuts)
    ends = np.append(at[1:], len(idx))
    rng = np.random.default_rng(seed)
    dim = (1 << WORD_BITS) + BINS * stats.shape[1]
    w, v, w0 = np.zeros(dim), rng.normal(0, 0.05, (dim, FACTORS)), 0.0
    gw, gv, g0 = np.full(dim, 1e-6), np.full((dim, FACTORS), 1e-6), 1e-6
    share = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // 128)):
            pick = np.concatenate([np.arange(at[r], ends[r]) for r in rows])
            sizes = ends[rows] - at[rows]
            start = np.cumsum(sizes) - sizes
            i, x = idx[pick], val[pick]
            raw, s, vx = raw_score((w0, w, v), i, x, start)
            err = (logistic(raw) - y[rows]) * share[rows] / len(rows)
            e = np.repeat(err, sizes)
            d0, dw = err.sum(), np.bincount(i, e * x, dim) + 1e-5 * w
            own = np.repeat(s, sizes, axis=0) - vx
            dv = np.stack([np.bincount(i, e * x * own[:, f], dim) for f in range(FACTORS)], axis=1) + 1e-5 * v
            g0 += d0 * d0
            gw += dw * dw
            gv += dv * dv
            w0 -= 0.2 * d0 / np.sqrt(g0)
            w -= 0.2 * dw / np.sqrt(gw)
            v -= 0.05 * dv / np.sqrt(gv)
    return cuts, (w0, w, v)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> list:
    """Features and quality of at most ``bound`` labelled documents that are not held out; of rows
    with one id, of the row whose text has the least hash."""
    picked = (labels.where("doc_id is not null and quality is not null").where(~held_out())
              .groupBy("doc_id").agg(F.min("quality").alias("__y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))
    chars = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), chars.alias("chars"))
    rows = rows.join(F.broadcast(picked), "doc_id")  # at most ``bound`` rows
    rows = rows.withColumn("__h", F.xxhash64("text", "chars"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, place, weight, stats = featurize(batch.column("text"), batch.column("chars"))
            cut = bounds.astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("__h"), batch.column("__y"),
                pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(place, pa.int64())),
                pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(weight, pa.float64())),
                pa.array(list(stats), pa.list_(pa.float64()))], names=["doc_id", "h", "y", "place", "weight", "stats"])

    out = rows.mapInArrow(run, "doc_id long, h long, y int, place array<long>, weight array<double>, stats array<double>")
    one = out.groupBy("doc_id").agg(F.min_by(F.struct("y", "place", "weight", "stats"), "h").alias("f"))
    return one.select("doc_id", "f.*").orderBy("doc_id").toArrow()


def train(docs: DataFrame, labels: DataFrame):
    got = sample(docs, labels)
    if got.num_rows == 0:
        return None
    place = got.column("place").combine_chunks()
    bounds = np.append(0, np.cumsum(pc.list_value_length(place).to_numpy(zero_copy_only=False))).astype(np.int64)
    return fit(bounds, place.flatten().to_numpy(zero_copy_only=False),
               got.column("weight").combine_chunks().flatten().to_numpy(zero_copy_only=False),
               np.array(got.column("stats").to_pylist()), got.column("y").to_numpy().astype(float))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if the score is at least 0.7)."""
    docs = without(docs, "score", "predicted")
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(train(docs, labels))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        for whole in batches:
            for batch in row_slices(whole, SLICE):
                score = np.full(batch.num_rows, 0.5)
                if fitted is not None:
                    cuts, m = fitted
                    chars = batch.column("n_chars") if "n_chars" in names else None
                    raw, _, _ = raw_score(m, *with_bins(*featurize(batch.column("text"), chars), cuts))
                    score = logistic(raw)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                    names=[*names, "score", "predicted"])

    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    return docs.mapInArrow(run, schema)


def op10_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    out = classify(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")


QUERIES = {"op10_classifier": op10_classifier}
ORACLE: dict[str, str] = {}
