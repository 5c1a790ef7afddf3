"""Context-mixing range coder for token ids, many blocks in lockstep.

Every block is coded on its own: models start empty, and the block holds its own
alphabet, length and checksum. Inside a block the model predicts ids by order:

* order 2 and order 1: the id last seen after the same two ids or one id, with a
  confidence from 0 to 3;
* order 0: adaptive counts over the block's alphabet, taken over at set intervals.

The two predicted ids are coded as hit or miss. The chance of a hit is mixed from two
adaptive estimates, one by the confidences of both orders and one by the previous id;
the weight between them moves towards the one that has been nearer. Only misses are
coded with order-0 counts. All arithmetic is on integers, so any machine decodes alike.

The blocks of one call are coded step by step side by side, each numpy operation
working on one place of all blocks, which is what makes a sequential coder affordable.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"CMX1"
U = np.uint64
FULL = U((1 << 64) - 1)
UNIT = 16  # bits written at a time
TOP, BOTTOM = U(1 << 48), U(1 << 40)
HASH_BITS = 12
SCALE = 12
STEPS = {64, 128, 256, 512}
EVERY = 1024
MAX_BLOCK = 4096


def pack_numbers(v: np.ndarray) -> bytes:
    """Numbers below 2**21, seven bits a byte, low bits first."""
    v = v.astype(np.int64)
    three = np.stack([v & 127, (v >> 7) & 127, v >> 14], axis=1)
    size = 1 + (v >= 1 << 7) + (v >= 1 << 14)
    three[:, 0] |= (size > 1) << 7
    three[:, 1] |= (size > 2) << 7
    return three[np.arange(3) < size[:, None]].astype(np.uint8).tobytes()


def unpack_numbers(raw: bytes, n: int) -> tuple[np.ndarray, int]:
    """(n numbers, bytes read)"""
    b = np.frombuffer(raw, np.uint8)[:3 * n].astype(np.int64)
    ends = np.flatnonzero(b < 128)[:n]
    starts = np.append(0, ends[:-1] + 1)
    used = int(ends[-1]) + 1 if n else 0
    owner = np.repeat(np.arange(n), ends - starts + 1)
    part = (b[:used] & 127) << (7 * (np.arange(used) - starts[owner]))
    return np.bincount(owner, part, n).astype(np.int64), used


class Model:
    """Predictions and their updates for the blocks side by side."""

    def __init__(self, sizes: np.ndarray):
        n, most = len(sizes), int(sizes.max())
        self.width = most
        self.sizes = sizes
        self.rows = np.arange(n)
        self.two = np.zeros(n << HASH_BITS, np.int32)  # id * 4 + confidence
        self.one = np.zeros(n * most, np.int32)
        self.base_two, self.base_one = self.rows << HASH_BITS, self.rows * most
        self.at_conf, self.at_prev = self.rows * 32, self.rows * 256
        self.prev = np.zeros(n, np.int64)
        self.prev2 = np.zeros(n, np.int64)
        start = np.array([8192, 20000, 36000, 48000], np.int32)
        self.by_conf = [np.tile(np.repeat(start, 8), n), np.tile(np.tile(np.repeat(start, 2), 4), n)]
        self.by_prev = [np.full(n * 256, 24000, np.int32), np.full(n * 256, 24000, np.int32)]
        self.weight = [np.full(n, 128, np.int32), np.full(n, 128, np.int32)]
        self.counts = np.zeros((n, most), np.int32)
        self.counts[np.arange(most) < sizes[:, None]] = 1
        self.cum = np.zeros((n, most + 1), np.int32)
        self.at_cum = self.rows * (most + 1)
        self.refresh(n)

    def refresh(self, k: int) -> None:
        """Takes the counts over for coding, for the first k blocks."""
        np.cumsum(self.counts[:k], axis=1, out=self.cum[:k, 1:])
        self.flat_cum = self.cum.ravel()
        self.total = self.cum[:, -1].astype(U)

    def _chance(self, which: int, i: np.ndarray, j: np.ndarray, k: int):
        a, b, w = self.by_conf[which].take(i), self.by_prev[which].take(j), self.weight[which][:k]
        return i, j, a, b, b + ((w * (a - b)) >> 8)

    def predict(self, k: int):
        """(id and share of order 2, id and share of order 1), shares of 2**SCALE, for the first k blocks."""
        self.at_two = self.base_two[:k] + (((self.prev[:k] * 40503 + self.prev2[:k] * 9973) >> 3) & ((1 << HASH_BITS) - 1))
        self.at_one = self.base_one[:k] + self.prev[:k]
        v2, v1 = self.two.take(self.at_two), self.one.take(self.at_one)
        c2, c1, p2, p1 = v2 & 3, v1 & 3, v2 >> 2, v1 >> 2
        same = (p1 == p2) & (c1 > 0) & (c2 > 0)
        self.has2, self.has1 = c2 > 0, (c1 > 0) & ~same
        self.context = c2 * 8 + c1 * 2 + same
        # What is learned where an order predicts nothing goes to places that are never read.
        i, j = self.at_conf[:k] + self.context, self.at_prev[:k] + ((self.prev[:k] & 127) << 1)
        self.mixed = [self._chance(0, i, j + self.has2, k), self._chance(1, i, j + self.has1, k)]
        top = (1 << SCALE) - 2
        f2 = self.has2 * np.minimum((self.mixed[0][4] >> (16 - SCALE)) + 1, top - 32)
        left = (1 << SCALE) - f2
        f1 = self.has1 * np.minimum(((left * self.mixed[1][4]) >> 16) + 1, left - 1)
        self.v2, self.v1, self.p2, self.p1 = v2, v1, p2, p1
        return p2, f2, p1, f1

    def _learn(self, which: int, k: int, seen: np.ndarray, hit: np.ndarray) -> None:
        i, j, a, b, _ = self.mixed[which]
        goal = hit * np.int32(65535)
        off_a, off_b = goal - a, goal - b
        self.by_conf[which][i] = a + (off_a >> 5)
        self.by_prev[which][j] = b + (off_b >> 4)
        w = self.weight[which][:k]
        w += ((np.abs(off_b) - np.abs(off_a)) >> 12) * seen
        np.maximum(w, 16, out=w)
        np.minimum(w, 240, out=w)

    def update(self, k: int, ids: np.ndarray, missed: np.ndarray) -> None:
        """Takes over the coded ids; ``missed`` are the blocks that coded one by order 0."""
        hit2, hit1 = self.has2 & (ids == self.p2), self.has1 & (ids == self.p1)
        self._learn(0, k, self.has2, hit2)
        self._learn(1, k, self.has1 & ~hit2, hit1)
        for table, at, v, p in ((self.two, self.at_two, self.v2, self.p2), (self.one, self.at_one, self.v1, self.p1)):
            conf = v & 3
            good = (conf > 0) & (ids == p)
            table[at] = np.where(good, (p << 2) | np.minimum(conf + 1, 3),
                                 np.where(conf > 1, v - 1, (ids.astype(np.int32) << 2) | 1))
        self.counts[missed, ids[missed]] += 2
        self.prev2[:k], self.prev[:k] = self.prev[:k], ids


def _order(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(blocks from longest to shortest, by step the number of blocks still running)."""
    order = np.argsort(-lengths, kind="stable")
    running = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), side="left")
    return order, running


def _settle(low: np.ndarray, rng: np.ndarray, who: np.ndarray, out: np.ndarray, pos: np.ndarray) -> None:
    """Writes the units that can no longer change, of all lanes at once."""
    while True:
        settled = (low ^ (low + rng)) < TOP
        short = rng < BOTTOM
        move = np.flatnonzero(settled | short)
        if not len(move):
            return
        cut = np.flatnonzero(short & ~settled)
        if len(cut):
            rng[cut] = (~low[cut] + U(1)) & (BOTTOM - U(1))
        lanes, a = who.take(move), low.take(move)
        out[lanes, pos.take(lanes)] = a >> U(64 - UNIT)
        pos[lanes] += 1
        low[move] = a << U(UNIT)
        rng[move] <<= U(UNIT)


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """One coded block for each array of ids (a few thousand ids each; counts must stay below 2**20)."""
    if not blocks:
        return []
    lengths = np.array([len(b) for b in blocks])
    order, running = _order(lengths)
    alphabets, steps = [], np.zeros((max(1, lengths.max()), len(blocks)), np.int32)
    for lane, b in enumerate(order):
        letters, local = np.unique(blocks[b], return_inverse=True)
        alphabets.append(letters)
        steps[:len(local), lane] = local
    sizes = np.array([max(1, len(a)) for a in alphabets])
    model = Model(sizes)
    n = len(blocks)
    out = np.zeros((n, 2 * len(steps) + 64), ">u2")
    pos = np.zeros(n, np.int64)
    low, rng = np.zeros(n, U), np.full(n, FULL)
    every = np.arange(n)
    for t, k in enumerate(running.tolist()):
        ids = steps[t, :k]
        p2, f2, p1, f1 = model.predict(k)
        hit2, hit1 = model.has2 & (ids == p2), model.has1 & (ids == p1)
        missed = np.flatnonzero(~(hit2 | hit1))
        start = np.where(hit2, 0, np.where(hit1, f2, f2 + f1)).astype(U)
        size = np.where(hit2, f2, np.where(hit1, f1, (1 << SCALE) - f2 - f1)).astype(U)
        r = rng[:k] >> U(SCALE)
        a, r = low[:k] + start * r, size * r
        if len(missed):
            s = ids.take(missed)
            at = model.at_cum.take(missed) + s
            x, y = model.flat_cum.take(at), model.flat_cum.take(at + 1)
            part = r.take(missed) // model.total.take(missed)
            a[missed] += x.astype(U) * part
            r[missed] = (y - x).astype(U) * part
        _settle(a, r, every[:k], out, pos)
        low[:k], rng[:k] = a, r
        model.update(k, ids, missed)
        if t + 1 in STEPS or (t + 1) % EVERY == 0:
            model.refresh(k)
    for _ in range(64 // UNIT):
        out[every, pos] = low >> U(64 - UNIT)
        pos += 1
        low <<= U(UNIT)
    coded: list[bytes] = [b""] * n
    for lane, b in enumerate(order):
        letters = pack_numbers(np.diff(alphabets[lane], prepend=0))
        body = letters + out[lane, :pos[lane]].tobytes()
        head = struct.pack("<4sIIII", MAGIC, lengths[b], len(alphabets[lane]), len(body),
                           zlib.crc32(blocks[b].astype("<u4").tobytes()))
        coded[b] = head + body
    return coded


HEAD = struct.calcsize("<4sIIII")


def split_blocks(raw: bytes) -> list[bytes]:
    """The coded blocks that follow one another in ``raw``."""
    out, at = [], 0
    while at < len(raw):
        magic, _, _, size, _ = struct.unpack_from("<4sIIII", raw, at)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        out.append(raw[at:at + HEAD + size])
        at += HEAD + size
    return out


def decode_blocks(coded: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; raises ValueError if one does not fit its checksum."""
    if not coded:
        return []
    heads = [struct.unpack_from("<4sIIII", c) for c in coded]
    if any(h[0] != MAGIC or HEAD + h[3] != len(c) for h, c in zip(heads, coded)):
        raise ValueError("not a block of token ids")
    lengths = np.array([h[1] for h in heads])
    order, running = _order(lengths)
    alphabets, bodies = [], []
    for b in order:
        gaps, used = unpack_numbers(coded[b][HEAD:], heads[b][2])
        alphabets.append(np.cumsum(gaps))
        bodies.append(coded[b][HEAD + used:])
    n = len(coded)
    sizes = np.array([max(1, len(a)) for a in alphabets])
    model = Model(sizes)
    data = np.zeros((n, max(map(len, bodies)) // 2 + 8), U)
    for lane, body in enumerate(bodies):
        data[lane, :len(body) // 2] = np.frombuffer(body, ">u2")
    steps = np.zeros((max(1, lengths.max()), n), np.int32)
    low, rng, code = np.zeros(n, U), np.full(n, FULL), np.zeros(n, U)
    pos = np.full(n, 64 // UNIT)
    for j in range(64 // UNIT):
        code = (code << U(UNIT)) | data[:, j]
    every = np.arange(n)
    span = np.int64(1) << 20  # over any count, so that one search serves all blocks
    flat = None
    for t, k in enumerate(running.tolist()):
        if flat is None:
            flat = (model.cum[:, 1:] + (np.arange(n) * span)[:, None]).ravel()
        p2, f2, p1, f1 = model.predict(k)
        a, r, c = low[:k], rng[:k] >> U(SCALE), code[:k]
        at = np.minimum((c - a) // r, U((1 << SCALE) - 1)).astype(np.int64)
        both = f2 + f1
        hit2, missed = at < f2, np.flatnonzero(at >= both)
        hit1 = ~hit2 & (at < both)
        ids = np.where(hit2, p2, p1)
        start = np.where(hit2, 0, np.where(hit1, f2, both)).astype(U)
        size = np.where(hit2, f2, np.where(hit1, f1, (1 << SCALE) - both)).astype(U)
        a, r = a + start * r, size * r
        if len(missed):
            total = model.total.take(missed)
            part = r.take(missed) // total
            at = np.minimum((c.take(missed) - a.take(missed)) // part, total - U(1)).astype(np.int64)
            s = np.searchsorted(flat, at + missed * span, side="right") - missed * model.width
            at = model.at_cum.take(missed) + s
            x, y = model.flat_cum.take(at), model.flat_cum.take(at + 1)
            a[missed] += x.astype(U) * part
            r[missed] = (y - x).astype(U) * part
            ids[missed] = s
        while True:
            settled = (a ^ (a + r)) < TOP
            short = r < BOTTOM
            move = np.flatnonzero(settled | short)
            if not len(move):
                break
            cut = np.flatnonzero(short & ~settled)
            if len(cut):
                r[cut] = (~a[cut] + U(1)) & (BOTTOM - U(1))
            code[move] = (code.take(move) << U(UNIT)) | data[move, pos.take(move)]
            pos[move] += 1
            a[move] <<= U(UNIT)
            r[move] <<= U(UNIT)
        low[:k], rng[:k] = a, r
        model.update(k, ids, missed)
        steps[t, :k] = ids
        if t + 1 in STEPS or (t + 1) % EVERY == 0:
            model.refresh(k)
            flat = None
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * n
    for lane, b in enumerate(order):
        ids = alphabets[lane][steps[:lengths[b], lane]].astype("<u4") if lengths[b] else np.zeros(0, "<u4")
        if zlib.crc32(ids.tobytes()) != heads[b][4]:
            raise ValueError("checksum of a block of token ids does not fit")
        out[b] = ids
    return out
