"""Token-id files: documents encoded by a tokenizers file, ids range-coded in blocks.

Documents are put in ascending order by a range partitioning on the id; each partition
writes its ids as segments. A segment holds whole documents (a table of ids and lengths)
and blocks of token ids, each coded on its own and checksummed (``range_coder``), so a
lost block spoils no other and any segment can be read alone. Segments lie in Parquet
files, one row each, keyed by (shard, segment); the places of documents in the whole
follow from the segments' totals alone.

Encoding: the library is given each distinct pre-token of a slice that a worker does not
remember; pre-tokens and chunks between single spaces are remembered, up to some ``MEMO`` of each,
of which the half met last is then forgotten. Texts with characters outside ``PLAIN``, or with a
special token's string, are passed to it whole.

Defined results: a null text encodes as the empty text, which has the end id alone;
documents are in order of (id, text), null ids first; repeated rows are documents of
their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import row_slices, table
from .range_coder import MAX_BLOCK, decode_blocks, encode_blocks, split_blocks

END_ID = 2
MEMO = 400_000
SEGMENT_IDS = 1 << 22  # ids in a segment, after which the next document starts a new one
LANES = 512
SLICE = 2 << 20
# Characters for which the pre-token pattern and the library's own agree piece by piece.
PLAIN = r"[\t\n\r\x20-\x7e\xa0-ɏ]*+"
ODD = ["  ", *[s for c in "\t\n\r\xa0" for s in (f" {c}", f"{c} ")]]
HEAD = "<4sIQI"
MAGIC = b"TOKS"


class Encoder:
    """Ids of texts by a tokenizers file, little-endian unsigned 32-bit integers. A text is cut at single
    spaces into chunks, a chunk that is not remembered into pre-tokens; those that are new go to the
    library, runs of letters as one text, whose ids are cut by the bytes they stand for."""

    def __init__(self, data: dict):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if "library" not in data:
            library = data["library"] = Tokenizer.from_str(data["file"])
            data["words"], data["chunks"] = {}, {}  # chunks: without the space before them
            vocabulary = library.get_vocab()
            data["bytes"] = np.zeros(max(vocabulary.values()) + 1, np.int64)
            data["bytes"][list(vocabulary.values())] = [len(t) for t in vocabulary]  # a character stands for a byte
        self.library, self.words, self.chunks, self.bytes = (data[k] for k in ("library", "words", "chunks", "bytes"))
        self.split = regex.compile(data["pattern"]).findall
        self.plain = regex.compile(PLAIN).fullmatch
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]

    def whole(self, texts: list[str]) -> list[bytes]:
        got = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in got]

    def odd(self, text: str) -> bool:
        """Whether a space does not stand between two other characters than white space, so that it may
        belong to a longer pre-token."""
        return text[:1] == " " or text[-1:] == " " or any(s in text for s in ODD)

    def encode_letters(self, runs: list[str]) -> list[bytes]:
        """The ids of a space and each of the runs of letters."""
        text = " " + " ".join(runs)
        raw = self.whole([text])[0]
        ends = np.cumsum(self.bytes[np.frombuffer(raw, "<u4")])
        want = np.cumsum([len(r) + 1 for r in runs] if text.isascii() else [len(r.encode()) + 1 for r in runs])
        at = np.searchsorted(ends, want)
        # A special token across runs, or ids that do not stand for the bytes of their text.
        if any(s in text for s in self.special) or ends[-1] != want[-1] or (ends[at] != want).any():
            return self.whole([" " + r for r in runs])
        cuts = (4 * at + 4).tolist()
        return [raw[a:b] for a, b in zip([0, *cuts], cuts)]

    def learn(self, cut: dict[str, list[str]], runs: set[str]) -> dict[str, bytes]:
        """The ids of each text of ``cut``, given with its pre-tokens; pre-tokens are remembered, and so are ``runs``."""
        chunks, words = self.chunks, self.words
        found = {w for own in cut.values() for w in own}
        after_space = {w: w[1:] for w in found if w[0] == " " and w[1:].isalpha()}
        runs = list(runs.union(after_space.values()).difference(chunks))
        if runs:
            chunks.update(zip(runs, self.encode_letters(runs)))
        new = [w for w in found if w not in after_space and w not in words]
        words.update(zip(new, self.whole(new)))
        return {t: b"".join([chunks[after_space[w]] if w in after_space else words[w] for w in own]) for t, own in cut.items()}

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. What is new in all of them is learnt at once."""
        for memo in (self.words, self.chunks):
            if len(memo) > MEMO:  # what was met first, as frequent words are, stays
                for _ in range(MEMO // 2):
                    memo.popitem()
        out, chunked, cut = [b""] * len(texts), {}, {}
        for i, t in enumerate(texts):
            if not self.plain(t) or any(s in t for s in self.special):
                out[i] = self.whole([t])[0]
            elif self.odd(t):
                cut[t] = self.split(t)
            else:
                first, *chunked[i] = t.split(" ")
                cut[first] = self.split(first)
        new = set().union(*chunked.values()).difference(self.chunks)
        runs = {c for c in new if c.isalpha()}
        spaced = {" " + c: c for c in new if c not in runs}
        got = self.learn(cut | {s: self.split(s) for s in spaced}, runs)
        self.chunks.update((c, got[s]) for s, c in spaced.items())
        get = self.chunks.__getitem__
        for i, t in enumerate(texts):
            if i in chunked:
                out[i] = got[t.partition(" ")[0]] + b"".join(map(get, chunked[i]))
            elif t in got:
                out[i] = got[t]
        return out

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]


def pack_segment(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """Head, table of documents (null flag, id, length), then the coded blocks."""
    size = min(MAX_BLOCK, max(512, -(-len(ids) // LANES)))
    blocks = encode_blocks([ids[i:i + size] for i in range(0, len(ids), size)])
    known = np.array([d is not None for d in doc_ids], np.uint8).tobytes()
    numbers = np.array([d or 0 for d in doc_ids], "<i8").tobytes()
    index = known + numbers + lengths.astype("<u4").tobytes()
    return struct.pack(HEAD, MAGIC, len(doc_ids), len(ids), zlib.crc32(index)) + index + b"".join(blocks)


def unpack_segment(raw: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(document ids, lengths, token ids); raises ValueError where a checksum does not fit."""
    magic, n, total, check = struct.unpack_from(HEAD, raw)
    at = struct.calcsize(HEAD)
    index = raw[at:at + 13 * n]
    if magic != MAGIC or zlib.crc32(index) != check:
        raise ValueError("not a segment of token ids, or its table is damaged")
    known = np.frombuffer(index, np.uint8, n)
    numbers = np.frombuffer(index, "<i8", n, n).tolist()
    lengths = np.frombuffer(index, "<u4", n, 9 * n).astype(np.int64)
    ids = np.concatenate([np.zeros(0, "<u4"), *decode_blocks(split_blocks(raw[at + 13 * n:]))]).astype("<u4")
    if len(ids) != total or lengths.sum() != total:
        raise ValueError("a segment of token ids is incomplete")
    return [d if k else None for d, k in zip(numbers, known)], lengths, ids


def write_files(docs: DataFrame, path: str, tokenizer_file: str, pattern: str, end_id: int = END_ID,
                id_col: str = "doc_id", text: str = "text") -> None:
    """Writes the documents' ids under ``path``, in ascending order of the document id."""
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        data = spark.sparkContext.broadcast({"file": f.read(), "pattern": pattern})  # as large as the vocabulary
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(data.value)
        shard, segment = TaskContext.get().partitionId(), 0
        doc_ids: list = []
        parts: list[bytes] = []
        total = 0

        def close():
            lengths = np.array([len(p) // 4 for p in parts])
            raw = pack_segment(doc_ids, lengths, np.frombuffer(b"".join(parts), "<u4"))
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([total], pa.int64()),
                 pa.array([raw], pa.binary())], names=["shard", "segment", "n_ids", "data"])

        for whole in batches:
            for batch in row_slices(whole, SLICE):
                texts = batch.column("text").fill_null("").to_pylist()
                for doc, ids in zip(batch.column("doc_id").to_pylist(), encode.many(texts)):
                    doc_ids.append(doc)
                    parts.append(ids + end)
                    total += len(parts[-1]) // 4
                    if total >= SEGMENT_IDS:
                        yield close()
                        segment, total = segment + 1, 0
                        doc_ids.clear()
                        parts.clear()
        if doc_ids:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dealt = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(run, "shard int, segment int, n_ids long, data binary").write.mode("overwrite").parquet(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document's ids and the number of ids before it."""
    segments = spark.read.parquet(path)
    order = Window.orderBy("shard", "segment").rowsBetween(Window.unboundedPreceding, -1)
    # One small row a segment of millions of ids.
    starts = segments.select("shard", "segment", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("start"))
    rows = segments.join(starts, ["shard", "segment"]).select("start", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, raw in zip(batch.column("start").to_pylist(), batch.column("data")):
                doc_ids, lengths, ids = unpack_segment(raw.as_py())
                ends = np.cumsum(lengths)
                body = ids.tobytes()
                for a in range(0, len(doc_ids), 2000):
                    b = min(a + 2000, len(doc_ids))
                    own = [body[4 * (e - n):4 * e] for e, n in zip(ends[a:b].tolist(), lengths[a:b].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids[a:b], pa.int64()), pa.array(start + (ends - lengths)[a:b]),
                         pa.array(lengths[a:b]), pa.array(own, pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token_files")
    write_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"),
                public_tokenizers.PATTERN)
    return read_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op6_token_files": op6_token_files}
ORACLE: dict[str, str] = {}
