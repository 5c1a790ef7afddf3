"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves a whole pre-token
that is itself a token (one table probe and one comparison). Tier two: a miss is
merged from its bytes, kept as a doubly linked list, with a heap of candidate
pairs ordered by (rank, position), so a pre-token of n bytes takes O(n log n).

The tables are built once on the driver from the rank file and broadcast; their
size is that of the vocabulary. Texts are encoded where they lie: no shuffle.
A worker remembers the ids of the pre-tokens it has met, up to ``MEMO`` of them,
then starts over; this bounds its memory and changes no result.

Defined results: a null text encodes as the empty text; an empty text has no ids
and decodes to no bytes; rows are kept as they are (repeated rows, null ids, ties);
an empty table gives an empty table; other columns are carried along, but a column
named like an added one is replaced.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import row_slices, table, without

MEMO = 400_000  # pre-tokens a worker remembers before it starts over
SLICE = 4 << 20  # bytes of text encoded at a time


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def perfect_hash(ranks: dict[bytes, int], per_bucket: int = 4) -> tuple[list, list, list]:
    """Minimal perfect hash (hash and displace) over the tokens: (displacement by bucket,
    token by slot, id by slot), with as many slots as tokens. Keys are dealt into
    buckets; largest bucket first, each gets the first displacement that sends all its
    keys to free slots. A bucket of one key takes any free slot, noted as -1 - slot."""
    n, m = len(ranks), max(1, len(ranks) // per_bucket)
    buckets: list[list[tuple[int, bytes]]] = [[] for _ in range(m)]
    for token in ranks:
        h = xxhash.xxh3_64_intdigest(token)
        buckets[(h >> 32) % m].append((h, token))
    disp, tokens, ids = [0] * m, [None] * n, [0] * n
    free = None
    for b in sorted(range(m), key=lambda i: -len(buckets[i])):
        if len(buckets[b]) > 1:
            d = 0
            while True:
                slots = [_slot(h, d, n) for h, _ in buckets[b]]
                if len(set(slots)) == len(slots) and all(tokens[s] is None for s in slots):
                    break
                d += 1
        elif buckets[b]:
            free = free or iter([s for s in range(n) if tokens[s] is None])
            slots = [next(free)]
            d = -1 - slots[0]
        else:
            break
        disp[b] = d
        for s, (_, token) in zip(slots, buckets[b]):
            tokens[s], ids[s] = token, ranks[token]
    return disp, tokens, ids


def _slot(h: int, d: int, n: int) -> int:
    x = (h ^ (d * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
    return ((x * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF) >> 17) % n


def probe(tables: tuple[list, list, list], token: bytes) -> int | None:
    """The id of a token of the vocabulary, None for any other bytes."""
    disp, tokens, ids = tables
    if not tokens:
        return None
    h = xxhash.xxh3_64_intdigest(token)
    d = disp[(h >> 32) % len(disp)]
    s = -1 - d if d < 0 else _slot(h, d, len(tokens))
    return ids[s] if tokens[s] == token else None


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """BPE of one pre-token: a heap of (rank, position) over linked bytes. The entry of
    a pair that has changed meanwhile is known by its rank no longer being the pair's."""
    n = len(piece)
    parts: list[bytes | None] = [piece[i:i + 1] for i in range(n)]
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    get = ranks.get
    heap = [(r, i) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        left = parts[i]
        if left is None or (j := nxt[i]) >= n:
            continue
        pair = left + parts[j]
        if get(pair) != rank:
            continue
        parts[i], parts[j] = pair, None
        k = nxt[i] = nxt[j]
        if k < n:
            prv[k] = i
            if (r := get(pair + parts[k])) is not None:
                heapq.heappush(heap, (r, i))
        p = prv[i]
        if p >= 0 and (r := get(parts[p] + pair)) is not None:
            heapq.heappush(heap, (r, p))
    return [ranks[p] for p in parts if p is not None]


def tables(path: str, pattern: str) -> dict:
    """What a worker needs, as plain data; ``memo`` is filled by each worker for itself."""
    ranks = load_ranks(path)
    return {"ranks": ranks, "pattern": pattern, "hash": perfect_hash(ranks),
            "by_id": {r: t for t, r in ranks.items()}, "memo": {}}


class Codec:
    """Encoder and decoder over ``tables``."""

    def __init__(self, data: dict):
        self.ranks, self.hash, self.by_id, self.memo = data["ranks"], data["hash"], data["by_id"], data["memo"]
        self.split = regex.compile(data["pattern"]).findall

    def piece(self, word: str) -> bytes:
        raw = word.encode()
        whole = probe(self.hash, raw)
        ids = [whole] if whole is not None else merge_bytes(raw, self.ranks)
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        words, memo = self.split(text), self.memo
        try:
            return b"".join([memo[w] for w in words])
        except KeyError:
            new = {w for w in words if w not in memo}
            if len(memo) + len(new) > MEMO:
                memo.clear()
                new = set(words)
            for w in new:
                memo[w] = self.piece(w)
            return b"".join([memo[w] for w in words])

    def decode(self, ids: bytes) -> bytes:
        get = self.by_id.__getitem__
        return b"".join(map(get, np.frombuffer(ids, "<u4").tolist()))


_shared: dict[tuple, object] = {}


def shared_tables(spark: SparkSession, path: str, pattern: str):
    """The broadcast tables of a rank file (their size is that of the vocabulary)."""
    key = (spark.sparkContext.applicationId, path, pattern)
    if key not in _shared:
        _shared[key] = spark.sparkContext.broadcast(tables(path, pattern))
    return _shared[key]


def _added(df: DataFrame, cols: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([*df.schema.fields, *[T.StructField(n, t) for n, t in cols]])


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """Adds ``ids`` (binary, little-endian unsigned 32-bit) and ``n_tokens``; with
    ``decoded`` also the bytes that these ids decode to, in the same pass."""
    names = ["ids", "n_tokens", *(["decoded"] if decoded else [])]
    df = without(df, *names)
    shared = shared_tables(df.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Codec(shared.value)
        for whole in batches:
            for batch in row_slices(whole, SLICE, text):
                ids = [c.encode(t) if t else b"" for t in batch.column(text).to_pylist()]
                cols = [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
                if decoded:
                    cols.append(pa.array([c.decode(x) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, *names])

    kinds = [T.BinaryType(), T.LongType(), T.BinaryType()]
    return df.mapInArrow(run, _added(df, list(zip(names, kinds))))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``, the bytes of the ids; null ids decode to no bytes."""
    df = without(df, "decoded")
    shared = shared_tables(df.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Codec(shared.value)
        for batch in batches:
            out = [c.decode(x or b"") for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             names=[*batch.schema.names, "decoded"])

    return df.mapInArrow(run, _added(df, [("decoded", T.BinaryType())]))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = encode(docs, path, public_tokenizers.PATTERN, decoded=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op1_bpe": op1_bpe}
ORACLE: dict[str, str] = {}
