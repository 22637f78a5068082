"""Byte-level BPE encoding and decoding with a rank file.

Two tiers: a minimal perfect hash over the vocabulary resolves, for all
pre-tokens of a slice at once, those that are vocabulary entries; the others
are merged with a heap over a linked list of their bytes. Hashes only propose:
a vocabulary entry, and a pre-token taken for a copy of another one, count only
after their bytes have been compared.

Long texts are encoded in pieces of about ``SLICE_BYTES``, cut where a
pre-token is sure to begin, so the arrays of a task do not grow with a text
(but for a single run without white space, which is one piece).
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, RollingHash, fresh, mix64, pieces, same_bytes, text_pass
from .pretokens import STOP, classes, code_points, spaced_starts, utf8_lengths

HASH_SEED = 9
BUCKET_KEYS = 4
# Merged pre-tokens that a task remembers (about 200 bytes each).
MEMO = 300_000
_STEP = np.uint64(0xD6E8FEB86659FD93)
# White space after a visible ASCII character always begins a pre-token.
BORDER = re.compile(rb"[!-~](?=[ \t\n\r])")
# Ids decoded at a time.
DECODE_IDS = 1 << 18


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file by id. Ranks must be 0, 1, 2, ..."""
    with open(path, "rb") as f:
        pairs = [(int(r), base64.b64decode(t)) for t, r in (x.split() for x in f if x.strip())]
    pairs.sort()
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError(f"{path}: ranks are not consecutive")
    tokens = [t for _, t in pairs]
    if len({t for t in tokens if len(t) == 1}) < 256:
        raise ValueError(f"{path}: not every byte is a token")
    return tokens


class PerfectHash:
    """Hash, displace: n keys (distinct 64-bit hashes) to n slots."""

    def __init__(self, keys: np.ndarray):
        n = len(keys)
        if len(np.unique(keys)) != n:
            raise ValueError("two vocabulary entries share a hash; choose another seed")
        self.n, self.buckets = n, n // BUCKET_KEYS + 1
        self.shift = np.zeros(self.buckets, np.int64)
        self.slot_key = np.zeros(n, np.uint64)
        self.slot_id = np.zeros(n, np.int64)
        free = np.ones(n, bool)
        bucket = self._bucket(keys)
        order = np.argsort(bucket, kind="stable")
        first = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        sizes = np.diff(first)
        for b in np.argsort(-sizes, kind="stable"):
            ids = order[first[b]:first[b + 1]]
            if len(ids) < 2:
                break
            base = 0
            while True:
                d = np.arange(base, base + 64, dtype=np.uint64)
                s = self._slots(keys[ids][:, None], d[None, :])
                ok = free[s].all(axis=0)
                t = np.sort(s, axis=0)
                ok &= (t[1:] != t[:-1]).all(axis=0)
                if ok.any():
                    k = int(np.argmax(ok))
                    break
                base += 64
            self.shift[b] = base + k
            self._put(s[:, k], keys[ids], ids)
            free[s[:, k]] = False
        single = np.flatnonzero(sizes == 1)
        slots = np.flatnonzero(free)
        ids = order[first[single]]
        self.shift[single] = -slots - 1
        self._put(slots, keys[ids], ids)

    def _bucket(self, keys):
        return ((keys >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)

    def _slots(self, keys, d):
        return (mix64(keys ^ (d * _STEP + np.uint64(1))) % np.uint64(self.n)).astype(np.int64)

    def _put(self, slots, keys, ids):
        self.slot_key[slots], self.slot_id[slots] = keys, ids

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """The id of each key, or -1."""
        d = self.shift[self._bucket(keys)]
        s = np.where(d < 0, -d - 1, self._slots(keys, np.maximum(d, 0).astype(np.uint64)))
        return np.where(self.slot_key[s] == keys, self.slot_id[s], -1)


def byte_pairs(ranks: dict[bytes, int]) -> list[int]:
    """Rank of every two bytes, or -1."""
    return [ranks.get(bytes([x, y]), -1) for x in range(256) for y in range(256)]


def merge_bytes(piece: bytes, ranks: dict[bytes, int], two: list[int]) -> list[int]:
    """Ids of one pre-token: lowest rank first, leftmost among equals. A heap
    of candidate merges (rank, begin and end packed into one integer) over
    linked parts; stale candidates are skipped."""
    n = len(piece)
    s = 20 if n < 1 << 20 else 40
    mask, top = (1 << s) - 1, 2 * s
    end = list(range(1, n + 1))          # end of the part that starts here
    end.append(-1)
    back = list(range(-1, n))            # start of the part before
    heap = [r << top | i << s | i + 2 for i, (x, y) in enumerate(zip(piece, piece[1:]))
            if (r := two[x << 8 | y]) >= 0]
    heapq.heapify(heap)
    pop, push, get = heapq.heappop, heapq.heappush, ranks.get
    while heap:
        v = pop(heap)
        e, i = v & mask, v >> s & mask
        j = end[i]
        if end[j] != e:
            continue
        end[j] = n                       # a part that is gone points past the end
        end[i] = e
        if e < n:
            back[e] = i
            z = end[e]
            q = get(piece[i:z])
            if q is not None:
                push(heap, q << top | i << s | z)
        p = back[i]
        if p >= 0:
            q = get(piece[p:e])
            if q is not None:
                push(heap, q << top | p << s | e)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class Encoder:
    """State of one task: the two tiers and a bounded memo of merged pieces."""

    def __init__(self, tokens: list[bytes], table: PerfectHash):
        self.table = table
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.roll = RollingHash(HASH_SEED)
        self.lens = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.at = np.cumsum(self.lens) - self.lens
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.two = byte_pairs(self.ranks)
        self.memo: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed little-endian unsigned 32-bit ids of each text."""
        if max(map(len, texts), default=0) <= 2 * SLICE_BYTES:
            return self._encode(texts)
        return [b"".join(self._encode([p])[0] for p in pieces(t, SLICE_BYTES, BORDER)) for t in texts]

    def _known(self, buf: np.ndarray, a: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Vocabulary ids of byte ranges, or -1; the bytes are compared."""
        ids = self.table.lookup(key)
        ids[self.lens[ids] != n] = -1
        hit = np.flatnonzero(ids >= 0)
        at = ids[hit]
        ids[hit[~same_bytes(buf, a[hit], self.blob, self.at[at], n[hit])]] = -1
        return ids

    def _merged(self, piece: bytes) -> bytes:
        got = self.memo.get(piece)
        if got is None:
            got = array("I", merge_bytes(piece, self.ranks, self.two)).tobytes()
            if len(self.memo) >= MEMO:
                self.memo.clear()
            if len(piece) <= 64:
                self.memo[piece] = got
        return got

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        strs = []
        for k, t in enumerate(texts):
            try:
                strs.append(t.decode("utf-8"))
            except UnicodeDecodeError:
                strs.append(t.decode("utf-8", "replace"))
                texts[k] = strs[-1].encode()
        cp = code_points(strs)
        cl = classes()[cp]
        at = np.concatenate([[0], np.cumsum(utf8_lengths(cp))])
        starts = np.flatnonzero(spaced_starts(cp, cl))
        del cp
        real = cl[starts] != STOP
        a = at[starts][real]
        b = np.append(at[starts[1:]], at[-1])[real]
        raw = b"\n".join(texts) + b"\n"
        buf = np.frombuffer(raw, np.uint8)
        key = self.roll.ranges(self.roll.prefix(buf), a, b)
        ids = self._known(buf, a, b - a, key)
        miss = np.flatnonzero(ids < 0)
        size = np.ones(len(ids), np.int64)
        if len(miss):
            ma, mn = a[miss], (b - a)[miss]
            uniq, first, inv = np.unique(key[miss], return_index=True, return_inverse=True)
            merged = [self._merged(raw[x:x + n]) for x, n in zip(ma[first].tolist(), mn[first].tolist())]
            like = first[inv]                 # the one that stands for each
            odd = mn != mn[like]
            fit = np.flatnonzero(~odd)
            odd[fit] = ~same_bytes(buf, ma[fit], buf, ma[like[fit]], mn[fit])
            for k in np.flatnonzero(odd).tolist():    # equal hash, other bytes
                inv[k] = len(merged)
                merged.append(self._merged(raw[ma[k]:ma[k] + mn[k]]))
            lens = np.fromiter(map(len, merged), np.int64, len(merged)) // 4
            flat = np.frombuffer(b"".join(merged), "<u4")
            off = np.cumsum(lens) - lens
            size[miss] = lens[inv]
        pos = np.concatenate([[0], np.cumsum(size)])
        out = np.empty(pos[-1], np.dtype("<u4"))
        hit = ids >= 0
        out[pos[:-1][hit]] = ids[hit]
        if len(miss):
            k = lens[inv]
            within = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            out[np.repeat(pos[miss], k) + within] = flat[np.repeat(off[inv], k) + within]
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
        cut = pos[np.searchsorted(a, bounds)].tolist()
        return [out[i:j].tobytes() for i, j in zip(cut, cut[1:])]


def _shared(spark, path: str):
    """Tokens and perfect hash, sent once; bounded by the vocabulary file."""
    tokens = read_ranks(path)
    roll = RollingHash(HASH_SEED)
    lens = np.fromiter(map(len, tokens), np.int64, len(tokens))
    end = np.cumsum(lens)
    key = roll.ranges(roll.prefix(np.frombuffer(b"".join(tokens), np.uint8)), end - lens, end)
    return spark.sparkContext.broadcast((tokens, PerfectHash(key)))


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids",
           keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and ``ids_col``: the ids packed as little-endian
    unsigned 32-bit integers, as the rank file's own library gives them
    without special tokens. A null or empty text has no ids (empty bytes);
    there is no truncation. Repeated rows and ids each give a row; an empty
    table gives none; other kept columns pass through, those named like
    ``ids_col`` (in any letter case) go. One pass beside the rows, no shuffle."""
    shared = _shared(df.sparkSession, path)

    def make():
        enc = Encoder(*shared.value)
        return lambda texts: [enc.encode(texts)]
    return text_pass(df, text_col, [T.StructField(ids_col, T.BinaryType())], make, keep)


def _decoder(tokens: list[bytes]):
    get = tokens.__getitem__

    def one(p):
        ids = np.frombuffer(p, "<u4")
        return b"".join([b"".join(map(get, ids[i:i + DECODE_IDS].tolist())) for i in range(0, len(ids), DECODE_IDS)])
    return lambda packed: [one(p) for p in packed]


def encode_and_decode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids",
                      out_col: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """:func:`encode`, then :func:`decode` of its ids, in one pass (one Python
    worker a core instead of two)."""
    shared = _shared(df.sparkSession, path)

    def make():
        enc, dec = Encoder(*shared.value), _decoder(shared.value[0])

        def each(texts):
            ids = enc.encode(texts)
            return [ids, dec(ids)]
        return each
    return text_pass(df, text_col, [T.StructField(ids_col, T.BinaryType()),
                                    T.StructField(out_col, T.BinaryType())], make, keep)


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded",
           keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) and the decoded bytes. Null ids decode
    to no bytes; an id outside the vocabulary fails. Repeated rows each give a
    row; an empty table gives none; a kept column named like ``out_col`` goes."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(path))
    copy = fresh(df, "_packed")
    keep = df.columns if keep is None else keep

    def make():
        dec = _decoder(shared.value)
        return lambda packed: [dec(packed)]
    return text_pass(df.withColumn(copy, F.col(f"`{ids_col}`")), copy,
                     [T.StructField(out_col, T.BinaryType())], make, keep)
