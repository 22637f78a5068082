"""Word lattices as arrays, for the unigram trainer (A5).

A block holds the lattices of some words of one corpus: an edge for every
occurrence of a candidate piece in a word. Lattices are made once for a
training run and stored; each step of it reads the blocks, looks up the
candidates' present scores, and works on all words of a block together, one
end position after the other. Counts leave a task as whole numbers (units of
2^-32), so their sums do not depend on blocks or partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Edges of a block (of 16 bytes), after which the next one begins, and one
# count's unit. A task holds one block at a time.
BLOCK_EDGES = 1 << 17
UNIT = 1 << 32
LOG_UNIT = 1 << 20
_CHUNK = 12
NONE = -np.inf

BLOCK = "g string, n binary, size binary, src binary, dst binary, pid binary, back binary"


class _Builder:
    """Edges of the words of one block, in order of their words."""

    def __init__(self):
        self.n: list[int] = []
        self.size: list[int] = []
        self.src: list[int] = []
        self.dst: list[int] = []
        self.pid: list[int] = []
        self.nodes = 0

    def add(self, word: str, n: int, trie: dict, unknown: int) -> None:
        base, m = self.nodes, len(word)
        src, dst, pid = self.src.append, self.dst.append, self.pid.append
        for i in range(m):
            node, single = trie, False
            for e in range(i, m):
                node = node.get(word[e])
                if node is None:
                    break
                p = node.get(None)
                if p is not None:
                    src(base + i)
                    dst(base + e + 1)
                    pid(p)
                    single = single or e == i
            if not single:                       # a character without a piece
                src(base + i)
                dst(base + i + 1)
                pid(unknown)
        self.n.append(n)
        self.size.append(m)
        self.nodes += m + 1

    def row(self, g: str) -> tuple:
        size = np.array(self.size, np.int32)
        src, dst, pid = (np.array(x, np.int32) for x in (self.src, self.dst, self.pid))
        level = _levels(size)
        order = np.lexsort((src, dst, level[dst]))
        src, dst, pid = src[order], dst[order], pid[order]
        back = np.lexsort((dst, src, -level[src])).astype(np.int32)
        return (g, np.array(self.n, np.int64).tobytes(), size.tobytes(),
                src.tobytes(), dst.tobytes(), pid.tobytes(), back.tobytes())


def _levels(size: np.ndarray) -> np.ndarray:
    """Position in its word of every node."""
    first = np.cumsum(size + 1) - size - 1
    return np.arange(int((size + 1).sum())) - np.repeat(first, size + 1)


def build(words: DataFrame, tries: dict[str, dict], unknown: dict[str, int]) -> DataFrame:
    """Blocks of the table ``(g, word, n)``. ``tries`` (broadcast; bounded by
    the number of candidates) hold a candidate's number at its end."""
    bc = words.sparkSession.sparkContext.broadcast((tries, unknown))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tries, unknown = bc.value
        names = [c.split(" ")[0] for c in BLOCK.split(", ")]
        now, b = None, _Builder()
        for pdf in batches:
            for g, w, n in zip(pdf["g"].tolist(), pdf["word"].tolist(), pdf["n"].tolist()):
                if b.n and (g != now or len(b.src) >= BLOCK_EDGES):
                    yield pd.DataFrame([b.row(now)], columns=names)
                    b = _Builder()
                now = g
                b.add(w, n, tries[g], unknown[g])
        if b.n:
            yield pd.DataFrame([b.row(now)], columns=names)

    return words.select("g", "word", "n").sortWithinPartitions("g").mapInPandas(run, BLOCK)


class Block:
    """The lattices of one row, with only those edges whose candidates have a
    score (an array by number) left. Edges are in order of their end's
    position, ``back`` gives that of their start's, from behind."""

    def __init__(self, score: np.ndarray, n: bytes, size: bytes, src: bytes, dst: bytes, pid: bytes, back: bytes):
        self.n = np.frombuffer(n, np.int64)
        self.size = np.frombuffer(size, np.int32)
        self.src, self.dst, self.pid, self.back = (np.frombuffer(x, np.int32) for x in (src, dst, pid, back))
        self.score = score[self.pid]
        live = self.score > NONE
        if not live.all():
            number = np.cumsum(live) - 1
            self.back = number[self.back[live[self.back]]]
            self.src, self.dst, self.pid, self.score = (x[live] for x in (self.src, self.dst, self.pid, self.score))
        self.level = _levels(self.size)
        self.last = np.cumsum(self.size + 1) - 1
        self.first = self.last - self.size
        self.word = np.repeat(np.arange(len(self.size)), self.size + 1)

    def _steps(self, order: np.ndarray | None, key: np.ndarray):
        """Runs of edges with one level of their ``key`` node, and in each the
        runs with the same node: ``(edges, run starts, nodes)``."""
        key = key if order is None else key[order]
        if not len(key):
            return
        level = self.level[key]
        cuts = np.append(np.flatnonzero(np.r_[True, level[1:] != level[:-1]]), len(key))
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        at = np.searchsorted(new, cuts)
        for k in range(len(cuts) - 1):
            lo, hi = cuts[k], cuts[k + 1]
            runs = new[at[k]:at[k + 1]]
            yield (slice(lo, hi) if order is None else order[lo:hi]), runs - lo, key[runs]

    def _sums(self, x: np.ndarray, order, key: np.ndarray, other: np.ndarray) -> np.ndarray:
        for edges, runs, nodes in self._steps(order, key):
            v = x[other[edges]] + self.score[edges]
            m = np.maximum.reduceat(v, runs)
            m = np.where(m == NONE, 0.0, m)
            s = np.add.reduceat(np.exp(v - np.repeat(m, np.diff(np.append(runs, len(v))))), runs)
            x[nodes] = m + np.log(s)
        return x

    def expected(self) -> tuple[np.ndarray, np.ndarray]:
        """Probability of every edge, and every word's log-likelihood."""
        alpha, beta = (np.full(len(self.level), NONE) for _ in range(2))
        alpha[self.first] = beta[self.last] = 0.0
        with np.errstate(divide="ignore", invalid="ignore"):
            alpha = self._sums(alpha, None, self.dst, self.src)
            beta = self._sums(beta, self.back, self.src, self.dst)
            z = alpha[self.last]
            p = np.exp(alpha[self.src] + self.score + beta[self.dst] - z[self.word[self.src]])
        ok = z > NONE
        return np.where(ok[self.word[self.src]], np.nan_to_num(p), 0.0), np.where(ok, z, 0.0)

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """Best path of every word: its edges, and the word of each. Of equal
        paths into a node the one whose last piece starts earliest."""
        best = np.full(len(self.level), NONE)
        best[self.first] = 0.0
        into = np.full(len(self.level), -1)
        for edges, runs, nodes in self._steps(None, self.dst):
            v = best[self.src[edges]] + self.score[edges]
            m = np.maximum.reduceat(v, runs)
            size = np.diff(np.append(runs, len(v)))
            at = np.where(v == np.repeat(m, size), np.arange(len(v)), len(v))
            best[nodes] = m
            into[nodes] = np.where(m > NONE, edges.start + np.minimum.reduceat(at, runs), -1)
        node, out = self.last[best[self.last] > NONE], []
        while len(node):
            e = into[node]
            node, e = node[e >= 0], e[e >= 0]
            out.append(e)
            node = self.src[e]
        path = np.concatenate(out) if out else np.zeros(0, np.int64)
        return path, self.word[self.src[path]]


class _Totals:
    """Exact sums of ``share * n`` for each candidate in 64-bit arrays: ``n`` in
    chunks of twelve bits with an array for each, sent off before one can
    overflow (a chunk's share of BLOCK_EDGES edges stays below 2^62)."""

    def __init__(self, size: int):
        self.size, self.sums = size, []

    def add(self, pid: np.ndarray, share: np.ndarray, n: np.ndarray) -> Iterator[tuple]:
        for lo in range(0, len(pid), BLOCK_EDGES):
            cut, k = slice(lo, lo + BLOCK_EDGES), 0
            left = n[cut].copy()
            while left.any():
                if k == len(self.sums):
                    self.sums.append(np.zeros(self.size, np.int64))
                np.add.at(self.sums[k], pid[cut], share[cut] * (left & ((1 << _CHUNK) - 1)))
                left >>= _CHUNK
                k += 1
            if any(int(x.max()) > 1 << 61 for x in self.sums):
                yield from self.rest()

    def rest(self) -> Iterator[tuple]:
        for k, x in enumerate(self.sums):
            at = np.flatnonzero(x)
            yield at, np.full(len(at), k), x[at]
        self.sums = []


def count(blocks: DataFrame, score: np.ndarray, viterbi: bool = False) -> tuple[dict[int, int], dict[str, float]]:
    """One pass over the blocks: candidates' expected counts in units of
    1 / ``UNIT`` (``viterbi``: counts on best paths, in ones), and each corpus's
    log-likelihood. A task combines its counts, so about one row a candidate
    and task is shuffled; the driver gets one a candidate."""
    bc = blocks.sparkSession.sparkContext.broadcast(score)
    fields = pa.schema([("g", pa.string()), ("pid", pa.int64()), ("k", pa.int64()), ("c", pa.int64())])

    def batch(g, pid, k, c):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((g, pid, k, c), fields.types)], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Totals(len(bc.value))
        ll: dict[str, int] = {}
        for rows in batches:
            for i in range(rows.num_rows):
                g, *arrays = (c[i].as_py() for c in rows.columns)
                b = Block(bc.value, *arrays)
                if viterbi:
                    edge, word = b.best()
                    made = total.add(b.pid[edge], np.ones(len(edge), np.int64), b.n[word])
                else:
                    p, z = b.expected()
                    made = total.add(b.pid, np.floor(p * UNIT + 0.5).astype(np.int64), b.n[b.word[b.src]])
                    whole = np.floor(z * LOG_UNIT + 0.5).astype(np.int64).astype(object)
                    ll[g] = ll.get(g, 0) + int((whole * b.n.astype(object)).sum())
                for pid, k, c in made:
                    yield batch([""] * len(pid), pid, k, c)
        for pid, k, c in total.rest():
            yield batch([""] * len(pid), pid, k, c)
        # Log-likelihoods may need more than 64 bits; they go in two parts.
        for g, c in ll.items():
            yield batch([g, g], [-1, -1], [0, 1], [c & ((1 << 48) - 1), c >> 48])

    got = blocks.mapInArrow(run, "g string, pid long, k long, c long").groupBy("g", "pid", "k").agg(
        F.sum(F.col("c").cast("decimal(38,0)")).alias("c")).collect()
    bc.destroy()
    counts: dict[int, int] = {}
    ll: dict[str, int] = {}
    for r in got:
        if r.pid >= 0:
            counts[r.pid] = counts.get(r.pid, 0) + (int(r.c) << (_CHUNK * r.k))
        else:
            ll[r.g] = ll.get(r.g, 0) + (int(r.c) << (48 * r.k))
    return counts, {g: c / LOG_UNIT for g, c in ll.items()}
