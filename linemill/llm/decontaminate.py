"""Benchmark decontamination: a broadcast hash set of normalised test n-grams,
a scan of every document's word windows, and a word-by-word check of each hit.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, RollingHash, edges, grouped, joined, mix64, pieces, same_bytes, text_pass

WINDOW = 10
# Windows of one broadcast part (some 35 bytes each). A larger benchmark is cut
# into parts, which a task loads one after the other for each group of texts.
PART_WINDOWS = 2_000_000
GROUP_BYTES = 16 << 20

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True
_BITS = 20
_BORDER = re.compile(rb"[ \t\n\r]")


def words_of(text: bytes) -> list[bytes]:
    """The words of a lower-cased text."""
    low = text.translate(_LOWER)
    a, b = edges(_IS_WORD[np.frombuffer(low, np.uint8)])
    return [low[i:j] for i, j in zip(a.tolist(), b.tolist())]


def _window_hash(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive word hashes."""
    m = len(h) - n + 1
    out = np.zeros(max(m, 0), np.uint64)
    if m > 0:
        for j in range(n):
            out = out * np.uint64(0x100000001B3) + h[j:j + m]
    return mix64(out + np.uint64(n))


def _word_hash(roll: RollingHash, buf: np.ndarray):
    a, b = edges(_IS_WORD[buf])
    return a, b, roll.ranges(roll.prefix(buf), a, b)


class WindowSet:
    """Distinct windows of a benchmark part as arrays: sorted hashes behind a
    bitmap for each window length, the windows' words as ranges of one text,
    and the items that hold them. Some 35 bytes a window, loaded as they are."""

    def __init__(self, items: list[tuple[str, bytes]], n: int):
        names = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(names)}
        self.names = names
        # Words with one space between, a line for each item.
        self.blob = b"\n".join([b" ".join(words_of(t)) for _, t in items]) + b"\n"
        buf = np.frombuffer(self.blob, np.uint8)
        a, b, h = _word_hash(RollingHash(10), buf)
        line = np.searchsorted(np.flatnonzero(buf == 10), a)
        first = np.searchsorted(line, np.arange(len(items) + 1))
        size = np.minimum(np.diff(first), n)
        owner = np.array([number[i] for i, _ in items], np.int64)
        self.by_len = {}
        for k in sorted(set(size[size > 0].tolist())):
            # Every window of k words of the items that are cut into such.
            at = np.arange(max(len(a) - k + 1, 0))
            at = at[(line[at] == line[at + k - 1]) & (size[line[at]] == k)]
            self.by_len[k] = self._distinct(buf, _window_hash(h, k)[at], a[at], b[at + k - 1], owner[line[at]])

    @staticmethod
    def _distinct(buf, key, start, end, item) -> dict:
        """One entry for each distinct window, equal hashes side by side, with
        its items. Windows are the same when their bytes are."""
        order = np.lexsort((start, end - start, key))
        key, start, end, item = key[order], start[order], end[order], item[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | ((end - start)[1:] != (end - start)[:-1])
        near = np.flatnonzero(~new)
        new[near] = ~same_bytes(buf, start[near], buf, start[near - 1], (end - start)[near])
        which = np.cumsum(new) - 1
        pairs = np.unique(np.stack([which, item], 1), axis=0)
        bit = np.zeros(1 << _BITS, bool)
        bit[(key >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        return {"key": key[new], "start": start[new], "end": end[new], "bitmap": np.packbits(bit),
                "item": pairs[:, 1], "first": np.searchsorted(pairs[:, 0], np.arange(new.sum() + 1))}

    def hits(self, n: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions among window hashes that the part has, and the first of
        its entries with that hash."""
        s = self.by_len[n]
        top = (h >> np.uint64(64 - _BITS)).astype(np.int64)
        at = np.flatnonzero(s["bitmap"][top >> 3] >> (7 - (top & 7)).astype(np.uint8) & 1)
        p = np.searchsorted(s["key"], h[at])
        ok = s["key"][np.minimum(p, len(s["key"]) - 1)] == h[at]
        return at[ok], p[ok]

    def items_of(self, n: int, p: int, words: bytes, h: int) -> set[str]:
        """The items that hold these words (none: not a window after all): the
        entries with the hash are compared byte by byte."""
        s, out = self.by_len[n], set()
        while p < len(s["key"]) and s["key"][p] == h:
            if self.blob[s["start"][p]:s["end"][p]] == words:
                out.update(self.names[i] for i in s["item"][s["first"][p]:s["first"][p + 1]].tolist())
            p += 1
        return out


def benchmark_parts(items: DataFrame, id_col: str, text_col: str, n: int, part_windows: int) -> list:
    """Broadcast window sets. Items come to the driver one partition at a
    time; only one part is held at once."""
    sc = items.sparkSession.sparkContext
    rows = items.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("i"),
                        F.col(f"`{text_col}`").cast("binary").alias("t")).filter("t is not null")
    parts, now, size = [], [], 0
    for i, t in rows.toLocalIterator():
        t = bytes(t)
        words = int(np.count_nonzero(np.diff(_IS_WORD[np.frombuffer(t.translate(_LOWER), np.uint8)].view(np.int8),
                                             prepend=0) == 1))
        if not words:
            continue
        now.append((i, t))
        size += max(words - n + 1, 1)
        if size >= part_windows:
            parts.append(sc.broadcast(WindowSet(now, n)))
            now, size = [], 0
    if now:
        parts.append(sc.broadcast(WindowSet(now, n)))
    return parts


class Words:
    """The words of a slice of texts: byte ranges, hashes, and where each
    text's words begin."""

    def __init__(self, texts: list[bytes], roll: RollingHash):
        buf, self.at = joined([t.translate(_LOWER) for t in texts], b"\n")
        self.a, self.b, self.h = _word_hash(roll, buf)
        self.first = np.searchsorted(self.a, self.at)
        self.raw = buf.tobytes()
        self.cover = np.zeros(len(self.a) + 1, np.int64)
        self.found: dict[int, set] = {}

    def scan(self, part: WindowSet) -> None:
        """Note where windows of ``part`` begin and end, and their items."""
        a, b, raw = self.a, self.b, self.raw
        for n in part.by_len:
            w = _window_hash(self.h, n)
            if not len(w):
                continue
            hit, entry = part.hits(n, w)
            doc = np.searchsorted(self.first, hit, side="right") - 1
            inside = hit + n <= self.first[doc + 1]
            for i, d, p in zip(hit[inside].tolist(), doc[inside].tolist(), entry[inside].tolist()):
                words = b" ".join([raw[x:y] for x, y in zip(a[i:i + n].tolist(), b[i:i + n].tolist())])
                ids = part.items_of(n, p, words, w[i])
                if ids:                       # the hash alone decides nothing
                    self.cover[i] += 1
                    self.cover[i + n] -= 1
                    self.found.setdefault(d, set()).update(ids)


def decontaminate(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", n: int = WINDOW,
                  part_windows: int = PART_WINDOWS, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: ``id_col``) plus ``n_words``, ``n_hit``,
    ``item_ids`` (strings, sorted; a null item id is an empty string),
    ``contaminated``, ``spans`` (byte ranges of hit word runs) and
    ``clean_text`` (the text without those ranges; null where none is hit).

    A null or empty document has no words; an item without words is never
    found; items that repeat an id count once; repeated documents each give
    a row; empty tables on either side give rows without hits, or no rows.
    Kept columns whose names clash with new ones go.

    Plan: one pass beside the rows. A benchmark of more than ``part_windows``
    windows is broadcast in parts; a task loads one after the other for each
    ``GROUP_BYTES`` of text, so the cost is linear in the parts and one part
    is in memory at a time.
    """
    parts = benchmark_parts(items, item_id, item_text, n, part_windows)
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
              T.StructField("item_ids", T.ArrayType(T.StringType())),
              T.StructField("contaminated", T.BooleanType()), T.StructField("spans", span),
              T.StructField("clean_text", T.StringType())]

    def make():
        roll = RollingHash(10)

        def scanned(groups):
            words = [Words(g, roll) for g in groups]
            for p in parts:
                part = p.value
                for w in words:
                    w.scan(part)
                if len(parts) > 1:
                    p.__dict__.pop("_value", None)   # one part in memory at a time
            return words

        def each(texts):
            long = [len(t) > 2 * SLICE_BYTES for t in texts]
            groups = list(grouped([t for t, far in zip(texts, long) if not far], SLICE_BYTES))
            short = iter([x for g, w in zip(groups, scanned(groups)) for x in _results(g, w)])
            out = [_long(t, scanned, n) if far else next(short) for t, far in zip(texts, long)]
            return [list(c) for c in zip(*out)] if out else [[]] * len(fields)
        return each

    return text_pass(df, text_col, fields, make, [id_col] if keep is None else keep,
                     limit=GROUP_BYTES if len(parts) > 1 else SLICE_BYTES)


def _result(text: bytes, n_words: int, covered: np.ndarray, a: np.ndarray, b: np.ndarray, items: set) -> tuple:
    """The result columns of one text: its words' byte ranges, which are hit."""
    if not items:
        return n_words, 0, [], False, [], None
    s, e = edges(covered)
    return _cleaned(text, n_words, int(covered.sum()), list(zip(a[s].tolist(), b[e - 1].tolist())), items)


def _cleaned(text: bytes, n_words: int, n_hit: int, cut: list[tuple[int, int]], items: set) -> tuple:
    left, pos = [], 0
    for x, y in cut:
        left.append(text[pos:x])
        pos = y
    clean = b"".join(left + [text[pos:]]).decode("utf-8", "replace")
    return n_words, n_hit, sorted(items), True, [{"start": x, "end": y} for x, y in cut], clean


def _results(texts: list[bytes], w: Words) -> list[tuple]:
    covered, out = np.cumsum(w.cover)[:-1] > 0, []
    for d, t in enumerate(texts):
        lo, hi = int(w.first[d]), int(w.first[d + 1])
        out.append(_result(t, hi - lo, covered[lo:hi], w.a[lo:hi] - w.at[d], w.b[lo:hi] - w.at[d],
                           w.found.get(d, set())))
    return out


def _long(text: bytes, scanned: Callable, n: int) -> tuple:
    """A long text in pieces, each with the ``n - 1`` words after it, so that
    every window is inside one; only hit words' places are kept."""
    after = re.compile(rb"[^0-9A-Za-z\x80-\xff]*(?:[0-9A-Za-z\x80-\xff]+(?:[^0-9A-Za-z\x80-\xff]+|\Z)){0,%d}" % (n - 1))
    at = words = 0
    where, start, end, items = [], [], [], set()
    for piece in pieces(text, SLICE_BYTES, _BORDER):
        w = scanned([[piece + after.match(text, at + len(piece)).group()]])[0]
        hit = np.flatnonzero(np.cumsum(w.cover)[:-1] > 0)
        where.append(hit + words)
        start.append(w.a[hit] + at)
        end.append(w.b[hit] + at)
        items |= w.found.get(0, set())
        words += int(np.searchsorted(w.a, len(piece)))
        at += len(piece)
    # A word behind a piece may be hit there and in its own one.
    where, first = np.unique(np.concatenate(where), return_index=True)
    start, end = np.concatenate(start)[first], np.concatenate(end)[first]
    if not len(where):
        return words, 0, [], False, [], None
    last = np.append(np.diff(where) > 1, True)
    cut = list(zip(start[np.append(True, last[:-1])].tolist(), end[last].tolist()))
    return _cleaned(text, words, len(where), cut, items)


def items_digest(ids) -> str:
    """SHA-256 (hex) of comma-joined ids."""
    return hashlib.sha256(",".join(ids).encode()).hexdigest()


def clean_documents(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_hit_share: float = 0.5, **kw) -> DataFrame:
    """Documents without the hit spans. A document of which ``max_hit_share``
    or more of the words are hit is dropped; others lose the spans only. The
    columns are those of ``df``, whatever their names; null texts and repeated
    rows stay as they are; an empty table gives no rows."""
    own = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    at = {c: f"c{i}" for i, c in enumerate(df.columns)}
    text = at[text_col]
    d = decontaminate(own.withColumn("original", F.col(text)), items, at[id_col], text,
                      keep=[c for c in own.columns if c != text] + ["original"], **kw)
    d = d.filter(~F.col("contaminated") | (F.col("n_hit") < max_hit_share * F.col("n_words")))
    d = d.withColumn(text, F.when(F.col("contaminated"), F.col("clean_text")).otherwise(F.col("original")))
    return d.select(*[F.col(at[c]).alias(c) for c in df.columns])
