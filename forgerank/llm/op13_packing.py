"""Best-fit packing in bulk-synchronous rounds.

Documents are encoded where they lie; what moves is a row for each piece: its place in the
document, length and checksum. Pieces are range-sorted by length, longest first, which gives
every piece a rank; sequences that still have room are range-sorted by it in every round.

A round is a sweep over sizes from large to small: gaps are stacked as they are met, and a
length takes the gap on top, the smallest one that it fits, for as many of its pieces as the gap holds.
The sweep needs the number of pieces and of gaps of each size only, at most ``CAPACITY`` each, and
yields ranges: the gaps of rank a to b take the pieces from rank f on, m of them each. So
pieces that compete for one gap are told apart by rank, and every gap takes pieces of one
length a round. Each gap row finds its range, notes what it takes and keeps the rest as the
next round's gap; sequences that nothing left can enter drop out.

Rounds go through the lengths in bands, the longest half first (best fit decreasing); a
band is swept until it is empty. As many sequences as the ids need at least are open from
the start, more are opened for pieces that no gap can take any more. The number of rounds
depends on the lengths that occur, not on the number of documents. In the end pieces meet
their places by rank, one to one. Every round's gaps are written before they are used, so
a lost executor reads files again and ranks never change.

Encoding: the library is given each distinct pre-token that a worker has not met once (up to
``MEMO`` remembered, then anew); texts with characters outside ``PLAIN``, or with a special token's
string, go to it cut at white space alone, which the tokenizer drops.

Defined results: a null text encodes as the empty text, a piece of the end id alone; rows are
documents of their own, also with the same or without an id; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import LOCAL_BITS, global_rank
from ..session import shared
from .common import row_slices, table

CAPACITY = 4096
END_ID = 1
MEMO = 400_000
SLICE = 2 << 20
# FIXED VALUES: characters for which lower-casing and cutting here and in the library agree, the mark of a token
# that ends a word, the tokenizer's pre-token pattern.
PLAIN = r"[\t\n\r\x20-\x7e\xa0-ɏ]*+"
WORD_END = "</w>"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


class Encoder:
    """Ids of texts by a tokenizers file, little-endian unsigned 32-bit integers. A text is cut at
    white space into chunks, a chunk that is not remembered into pre-tokens; those that are new
    go to the library as one text, whose ids are cut after each that ends a word."""

    def __init__(self, data: dict):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if "library" not in data:
            library = data["library"] = Tokenizer.from_str(data["file"])
            data["chunks"], data["words"] = {}, {}
            vocabulary = library.get_vocab()
            data["ends"] = np.zeros(max(vocabulary.values()) + 1, bool)
            data["ends"][[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.library, self.chunks, self.words, self.ends = (data[k] for k in ("library", "chunks", "words", "ends"))
        self.plain = regex.compile(PLAIN).fullmatch
        self.fine = regex.compile(PATTERN).findall
        self.coarse = regex.compile(r"[^\t\n\r ]+").findall
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]

    def whole(self, texts: list[str]) -> list[bytes]:
        got = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in got]

    def learn(self, chunks: set[str]) -> None:
        """Remembers the ids of chunks of a plain text."""
        cut = {c: self.fine(c) for c in chunks}
        new = list({w for words in cut.values() for w in words if w not in self.words})
        if len(self.words) + len(new) > MEMO:
            self.words.clear()
            new = list({w for words in cut.values() for w in words})
        if new:
            raw = self.whole([" ".join(new)])[0]
            ends = np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) * 4 + 4
            if len(ends) != len(new):
                self.words.update(zip(new, self.whole(new)))
            else:
                self.words.update((w, raw[a:b]) for w, a, b in zip(new, [0, *ends[:-1].tolist()], ends.tolist()))
        words = self.words
        self.chunks.update((c, b"".join([words[w] for w in own])) for c, own in cut.items())

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. What is new in all of them is learnt at once."""
        cut = [t.lower().split() if self.plain(t) and not any(s in t for s in self.special) else None for t in texts]
        plain = [c for c in cut if c is not None]
        new = set().union(*plain) - self.chunks.keys()
        if len(self.chunks) + len(new) > MEMO:
            self.chunks.clear()
            new = set().union(*plain)
        self.learn(new)
        get = self.chunks.__getitem__
        return [b"".join(map(get, c)) if c is not None else b"".join(self.whole(self.coarse(t))) for c, t in zip(cut, texts)]


def pieces(docs: DataFrame, tokenizer_file: str, end_id: int = END_ID, capacity: int = CAPACITY,
           id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32): the documents' ids in pieces of at most ``capacity``."""
    with open(tokenizer_file, encoding="utf-8") as f:
        data = docs.sparkSession.sparkContext.broadcast({"file": f.read()})  # as large as the vocabulary
    end, width = struct.pack("<I", end_id), 4 * capacity
    names = ["row", "doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(data.value)
        for whole in batches:
            for batch in row_slices(whole, SLICE):
                owner, piece, length, crc = [], [], [], []
                for i, ids in enumerate(encode([t or "" for t in batch.column("text").to_pylist()])):
                    ids += end
                    for k, a in enumerate(range(0, len(ids), width)):
                        part = ids[a:a + width]
                        owner.append(i)
                        piece.append(k)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                take = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(take), batch.column("doc_id").take(take), pa.array(piece, pa.int32()),
                     pa.array([k * capacity for k in piece], pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=names)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text).alias("text"))
    return rows.mapInArrow(run, "row long, doc_id long, piece int, start long, length long, ids_crc32 long")


def sweep(docs: np.ndarray, gaps: np.ndarray, first: np.ndarray, least: int) -> np.ndarray:
    """One round for the lengths of at least ``least``, on counts by size: ``docs`` not yet placed, of
    which length s begins at rank first[s], and ``gaps``. All three are moved on. The result
    has a row a match: gaps in the round's order (largest first) from a to b take pieces of length s
    from rank f on, m a gap, n together."""
    moves: list[tuple] = []
    stack: list[list[int]] = []
    before = 0
    left = gaps.copy()
    for s in range(len(docs) - 1, least - 1, -1):
        if gaps[s]:
            stack.append([s, before, before + int(gaps[s])])
            before += int(gaps[s])
        while docs[s] and stack:
            g, a, z = stack[-1]
            m = g // s
            n = min(int(docs[s]), (z - a) * m)
            b = a - (-n // m)
            moves.append((a, b, s, int(first[s]), m, n))
            left[g] -= b - a
            left[g - m * s] += n // m
            if n % m:
                left[g - n % m * s] += 1
            docs[s] -= n
            first[s] += n
            if b == z:
                stack.pop()
            else:
                stack[-1][1] = b
    gaps[:] = left
    gaps[0] = 0
    return np.array(sorted(moves), np.int64).reshape(-1, 6)


def _sorted_gaps(gaps: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """The gaps in order, largest first, each with its partition and place there (``at``), and the
    number of gaps before each partition."""
    order = [F.desc("gap"), F.asc("seq")]
    out = shared(gaps.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn("at", F.monotonically_increasing_id()), "gaps")
    counts = dict(out.groupBy(F.shiftright("at", LOCAL_BITS).alias("p")).count().collect())
    sizes = [counts.get(p, 0) for p in range(max(counts, default=-1) + 1)]
    return out, np.cumsum([0, *sizes])


def _taken(gaps: DataFrame, before: np.ndarray, moves: np.ndarray) -> DataFrame:
    """(seq, gap, s, f, k): what each gap takes, k pieces of length s from rank f on."""
    data = gaps.sparkSession.sparkContext.broadcast((before, moves))  # one number a partition, a few a size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets, match = data.value
        for batch in batches:
            at = batch.column("at").to_numpy()
            rank = offsets[at >> LOCAL_BITS] + (at & ((1 << LOCAL_BITS) - 1))
            i = np.searchsorted(match[:, 0], rank, side="right") - 1
            a, b, s, f, m, n = match[np.maximum(i, 0)].T if len(match) else np.zeros((6, len(at)), np.int64)
            nth = rank - a
            k = np.where((i >= 0) & (rank < b), np.minimum(m, n - nth * m), 0)
            yield pa.RecordBatch.from_arrays([batch.column("seq"), batch.column("gap"), pa.array(s), pa.array(f + nth * m), pa.array(k)],
                                             names=["seq", "gap", "s", "f", "k"])

    return gaps.mapInArrow(run, "seq long, gap long, s long, f long, k long")


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY, order: list[str] | None = None) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``. Lengths are 1 to ``capacity``; ``order`` names columns that
    tell the rows apart. No sequence holds more than ``capacity``, and offsets leave no holes."""
    spark = items.sparkSession
    docs = np.zeros(capacity + 1, np.int64)
    for s, n in items.groupBy(length).count().collect():  # at most ``capacity`` rows
        docs[s] = n
    sizes = np.arange(capacity + 1)
    first = docs.sum() - np.cumsum(docs)  # ranks are by descending length
    ranked = global_rank(items, [F.desc(length), *[F.asc(c) for c in order or []]], "rank")

    new = -(-int((docs * sizes).sum()) // capacity)
    opened, gaps = 0, np.zeros(capacity + 1, np.int64)
    rows = spark.createDataFrame([], "seq long, gap long")
    places, least = spark.createDataFrame([], "rank long, sequence_id long, offset long"), capacity
    while docs.any():
        least = max(1, least // 2)
        while docs[least:].any():
            if new:
                rows = rows.union(spark.range(opened, opened + new).select(F.col("id").alias("seq"), F.lit(capacity).cast("long").alias("gap")))
                opened, gaps[capacity] = opened + new, gaps[capacity] + new
            at, before = _sorted_gaps(rows)
            taken = _taken(at, before, sweep(docs, gaps, first, least))
            slot = F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("i")
            found = taken.where("k > 0").select("seq", "gap", "s", "f", slot)
            places = places.union(found.select((F.col("f") + F.col("i") + 1).alias("rank"), F.col("seq").alias("sequence_id"),
                                               (capacity - F.col("gap") + F.col("i") * F.col("s")).alias("offset")))
            waiting = np.flatnonzero(docs)
            low = int(waiting[0]) if len(waiting) else capacity + 1
            gaps[:low] = 0
            rows = taken.select("seq", (F.col("gap") - F.col("k") * F.col("s")).alias("gap")).where(F.col("gap") >= low)
            widest = int(np.flatnonzero(gaps)[-1]) if gaps.any() else 0
            over = max(least, widest + 1)  # pieces of this band that no gap can take any more
            new = -(-int((docs * sizes)[over:].sum()) // capacity)
    return ranked.join(places, "rank").drop("rank")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rows = shared(pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")), "pieces")
    return pack(rows, order=["row", "piece"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {"op13_packing": op13_packing}
ORACLE: dict[str, str] = {}
