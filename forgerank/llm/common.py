"""Helpers shared by the operators of this subpackage.

The text helpers work on Arrow string columns inside ``mapInArrow``: a batch's
texts lie in one contiguous UTF-8 buffer, so word boundaries and word hashes are
computed for all rows of the batch with a few numpy passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator adds (case aside), so that a
    table which already has a column of that name gives no ambiguous reference."""
    drop = {n.lower() for n in names}
    return df.select([f"`{c}`" for c in df.columns if c.lower() not in drop])


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of the whole column, offsets of its rows); null counts as empty."""
    col = col.fill_null("")
    width = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, data = col.buffers()
    if offsets is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(offsets, width)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (xor-shift and multiply)."""
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inv = U64(base), U64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n + 1:
            size = max(n + 1, 1 << 16)
            up, down = np.full(size, self.base), np.full(size, self.inv)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up, self.down


_powers = Powers(int(_BASE))
_SCRAMBLE = mix(np.arange(1, 257, dtype=U64) * U64(0xA0761D6478BD642F))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``range_hash`` gives the hash of any byte range."""
    _, down = _powers.upto(len(data))
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_SCRAMBLE[data] * down[:len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges; equal bytes give equal hashes anywhere."""
    up, _ = _powers.upto(len(prefix))
    return mix((prefix[end] - prefix[start]) * up[start] + (end - start).astype(U64))


_WORD = np.ones(256, bool)
_WORD[[0x20, 9, 10, 11, 12, 13]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray, chars: np.ndarray = _WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte bounds of the words of all rows, runs of the bytes that are
    set in ``chars`` (``[^\\x20\\x09-\\x0D]+`` if not given), and for row i its words at
    first[i]:first[i + 1]."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = chars[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    edges = offsets[offsets < len(data)]
    before[edges] = False
    after[edges[edges > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hash(prefix_hash(data), starts, ends)


def row_slices(batch: pa.RecordBatch, max_bytes: int, col: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batch of about ``max_bytes`` of text each (one row at least)."""
    if batch.num_rows == 0:
        return
    _, off = text_buffer(batch.column(col))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(off, off[start] + max_bytes, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


FILTER_BITS = 24


def bit(col: str) -> Column:
    """The place of an id in the bits of ``id_filter``."""
    return F.xxhash64(col).bitwiseAND(F.lit((1 << FILTER_BITS) - 1)).cast("int")


def id_filter(ids: DataFrame, col: str):
    """Broadcast bits of the ids' hashes: 2**FILTER_BITS of them whatever the number of ids,
    so that a full filter costs movement of rows, never rows."""
    got = ids.select(bit(col).alias("p")).distinct().toArrow().column("p").to_numpy()
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[got] = True
    return ids.sparkSession.sparkContext.broadcast(np.packbits(bits))


def filtered(df: DataFrame, bits, col: str, inside: bool) -> DataFrame:
    """The rows whose id passes the filter (or does not), without a shuffle. Rows that pass
    hold all rows with one of the ids, and few others while the filter is not full."""
    place, names = free_name(df, "bit"), df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(bits.value).view(bool)
        for batch in batches:
            passes = known[batch.column(place).to_numpy(zero_copy_only=False)]
            yield batch.filter(pa.array(passes if inside else ~passes)).select(names)

    return df.withColumn(place, bit(col)).mapInArrow(run, df.schema)
