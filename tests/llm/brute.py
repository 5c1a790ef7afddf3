"""Brute-force versions of the training-data operators, on plain lists of rows."""

from __future__ import annotations

import base64
import bisect
import collections
import hashlib
import math
import re
import struct
import zlib

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(b) -> str:
    return hashlib.sha256(b.encode() if isinstance(b, str) else b).hexdigest()


_encoding = []


def bpe(text: str) -> list[int]:
    if not _encoding:
        with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoding.append(tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                           special_tokens={}))
    return _encoding[0].encode_ordinary(text)


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def op1(docs):
    out = []
    for d in docs:
        ids = bpe(d["text"] or "")
        out.append((d["doc_id"], len(ids), sha(packed(ids)), sha(d["text"] or "")))
    return out


def op2(rows):
    own = "</s>[INST] ok [/INST]"
    rows = rows + [{"conv_id": -7, "turn": t, "role": r, "text": own} for t, r in enumerate(["user", "assistant"])]
    by = collections.defaultdict(list)
    for r in rows:
        by[r["conv_id"]].append((r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
    out = []
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), sha(loss)))
    return out


def tokens4(text):
    return re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", (text or "").translate(LOWER))


def op4(docs, items, window=15, substitutions=3):
    out = []
    items = [(i["item_id"], tokens4(i["text"])) for i in items]
    for d in docs:
        doc = tokens4(d["text"])
        for item_id, item in items:
            if not item:
                continue
            size = min(window, len(item))
            need = window - substitutions if len(item) >= window else len(item)
            best = (0, 0)
            for off in range(-len(item) + 1, len(doc)):
                same = [0 <= off + j < len(doc) and doc[off + j] == w for j, w in enumerate(item)]
                agree = [sum(same[k:k + size]) for k in range(len(item) - size + 1)]
                best = max(best, (sum(a >= need for a in agree), max(agree)))
            if best[0]:
                out.append((d["doc_id"], item_id, *best))
    return out


def shingles(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def op5(docs):
    sets = [(d["doc_id"], shingles(d["text"])) for d in docs]
    up = {k: k for k, _ in sets if k is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return [(k, len(s), None if k is None else find(k)) for k, s in sets]


def op6(docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = sorted(docs, key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, d["text"] is not None, d["text"] or ""))
    out, start = [], 0
    for d in rows:
        ids = [*library.encode(d["text"] or "", add_special_tokens=False).ids, 2]
        out.append((d["doc_id"], start, len(ids), zlib.crc32(packed(ids))))
        start += len(ids)
    return out


ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def secrets(text):
    found = [("assign", m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", m.span()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    kinds = ["assign", "access", "hex"]
    return sorted(found, key=lambda x: (x[1][0], kinds.index(x[0])))


def op7(docs):
    out = []
    for d in docs:
        found = secrets(d["text"] or "")
        spans = ",".join(f"{k}:{a}:{b}" for k, (a, b) in found)
        n = collections.Counter(k for k, _ in found)
        out.append((d["doc_id"], n["assign"], n["access"], n["hex"], sha(spans), spans))
    return out


def redacted(text, mask="[REDACTED]"):
    if text is None:
        return None
    runs = []
    for _, (a, b) in secrets(text):
        if runs and a < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    for a, b in reversed(runs):
        text = text[:a] + mask + text[b:]
    return text


def op8(docs, length=400):
    raws = [(d["doc_id"], (d["text"] or "").encode()) for d in docs]
    seen = collections.Counter(b[i:i + length] for _, b in raws for i in range(len(b) - length + 1))
    out = []
    for k, b in raws:
        gone = bytearray(len(b))
        end = 0
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                start = max(end, i)
                gone[start:i + length] = b"\1" * (i + length - start)
                end = i + length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((k, len(b), sum(gone), runs, sha(kept)))
    return out


def op9(docs):
    out = []
    for d in docs:
        t = d["text"] or ""
        w = WORDS.findall(t)
        seen = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        twice = {p for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for p in range(i, i + 5)}
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        out.append((d["doc_id"], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t),
                    len(lines) - len(set(lines)), len(twice), len(w) < 10 or 100 * len(twice) > 20 * len(w)))
    return out


def op11(rows):
    by = collections.defaultdict(list)
    for r in rows:
        if r["conv_id"] is not None:
            role, text = r["role"] or "", r["text"] or ""
            digest = sha(f"{len(role.encode())}:{role}{text}")
            by[r["conv_id"]].append(((r["turn"] is not None, r["turn"] or 0, role, digest), (role, text)))
    own = {c: [t for _, t in sorted(x)] for c, x in by.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, own_members in members.items():
        gain = (len(own_members) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += gain
    return [(min(m), len(node), min(members[node[:-1]]) if node else None, len(m), kids[node], leaves[node], saved[node],
             sha(",".join(str(c) for c in sorted(m) if built[c] == node))) for node, m in members.items()]


RUNS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def op12(docs, items, buckets=10_000):
    def features(text):
        w = RUNS.findall((text or "").translate(LOWER))
        return len(w), [zlib.crc32(" ".join(w[i:i + m]).encode()) % buckets for m in (1, 2, 3) for i in range(len(w) - m + 1)]

    found = [(d["doc_id"], *features(d["text"])) for d in docs]
    s, t = collections.Counter(b for *_, f in found for b in f), collections.Counter(b for i in items for b in features(i["text"])[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows = []
    for doc, n, f in found:
        h = int(sha(f"42:{'' if doc is None else doc}")[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append((doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    drawn = 5 * len(able) // 100
    return [(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(able)] + [(*r[:4], None) for r in rows if r[4] < 20]


def op13(docs, capacity=4096):
    """The pieces, without their places."""
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for d in docs:
        ids = [*library.encode(d["text"] or "", add_special_tokens=False).ids, 1]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a:a + capacity]
            out.append((d["doc_id"], k, a, len(part), zlib.crc32(packed(part))))
    return out


def best_fit(lengths, capacity=4096):
    """Sequences that best fit decreasing uses."""
    gaps, n = [], 0
    for s in sorted(lengths, reverse=True):
        i = bisect.bisect_left(gaps, s)
        if i == len(gaps):
            n, g = n + 1, capacity
        else:
            g = gaps.pop(i)
        bisect.insort(gaps, g - s)
    return n
