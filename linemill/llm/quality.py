"""Quality by nearest-neighbour voting: labelled texts become vectors of a
latent semantic space; every document is compared with all of them by exact
cosine in blocks, and the nearest vote with their similarity as weight.

Terms are hashed words and word shapes (which kinds of bytes a token has, how
it ends, whether it repeats the token before it), singly and in twos. Weights
are log counts times inverse document frequency of the learning sample; the
space is spanned by the leading singular vectors of the sample.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import SLICE_BYTES, RollingHash, edges, joined, mix64, pieces, text_pass
from .labelled import sample

WORD_ROWS = 1 << 13
SHAPE_ROWS = 1 << 10
TERMS = WORD_ROWS + 2 * SHAPE_ROWS
DIM = 48
NEIGHBOURS = 25
# The learning sample: rows of each class, and bytes of a text.
PER_CLASS = 1500
MAX_BYTES = 16_384
BLOCK = 512               # documents whose products are held at once

# Kinds of bytes: white space 0, lower 1, upper 2, digit 4, high 8, then signs.
_KIND = np.full(256, 16, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[0x61:0x7B] = 1
_KIND[0x41:0x5B] = 2
_KIND[0x30:0x3A] = 4
_KIND[0x80:] = 8
_KIND[[ord(c) for c in ".,;:'\"()-"]] = 32
_BLANK = re.compile(rb"[\x09-\x0D ]")


class Features:
    def __init__(self):
        self.roll = RollingHash(3)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, term) and their log counts. Long texts go in pieces."""
        if max(map(len, texts), default=0) <= 2 * SLICE_BYTES:
            key, n = self._counts(texts)
        else:
            parts = [self._long(t) for t in texts]
            key = np.concatenate([k + d * TERMS for d, (k, _) in enumerate(parts)])
            n = np.concatenate([c for _, c in parts])
        return key // TERMS, key % TERMS, np.log1p(n).astype(np.float32)

    def _long(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """One text's terms and counts, piece by piece: each is led by the two
        tokens before it, which its first terms look back at."""
        total, before = np.zeros(TERMS, np.int64), []
        for p in pieces(text, SLICE_BYTES, _BLANK):
            lead = b"".join(t + b" " for t in before)
            key, n = self._counts([lead + p], len(before))
            total[key] += n
            before = (before + p.rsplit(None, 2)[-2:])[-2:]
        key = np.flatnonzero(total)
        return key, total[key]

    def _counts(self, texts: list[bytes], skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Keys (text times TERMS plus term) and their counts; the first
        ``skip`` tokens of all are looked back at only."""
        buf, at = joined(texts, b"\n")
        a, b = edges(_KIND[buf] > 0)
        if not len(a):
            z = np.zeros(0, np.int64)
            return z, z
        doc = np.searchsorted(at, a, side="right") - 1
        h = self.roll.ranges(self.roll.prefix(buf), a, b)
        kinds = np.bitwise_or.reduceat(_KIND[buf], a).astype(np.int64)    # gaps between tokens are 0
        ends = buf[b - 1]
        twice = (b - a > 1) & (buf[np.maximum(b - 2, 0)] == ends) & (_KIND[ends] >= 16)
        same = np.zeros(len(a), bool)
        same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        shape = kinds | twice << 6 | same << 7 | (b - a == 1) << 8
        pair = np.zeros(len(a), np.int64)
        pair[1:] = np.where(doc[1:] == doc[:-1], shape[:-1], 0)
        two = (mix64((shape * 1024 + pair).astype(np.uint64)) % np.uint64(SHAPE_ROWS)).astype(np.int64)
        term = np.concatenate([(h % np.uint64(WORD_ROWS)).astype(np.int64)[skip:],
                               (WORD_ROWS + shape % SHAPE_ROWS)[skip:], (WORD_ROWS + SHAPE_ROWS + two)[skip:]])
        return np.unique(np.tile(doc[skip:], 3) * TERMS + term, return_counts=True)


class Model:
    """Broadcast: a projection of fixed size and the sample's vectors."""

    def __init__(self, rows: list[tuple], dim: int = DIM, neighbours: int = NEIGHBOURS):
        texts = [r[0].encode("utf-8", "surrogatepass") for r in rows]
        self.y = np.array([r[1] for r in rows], np.float32)
        self.k = min(neighbours, len(rows))
        self.project = np.zeros((TERMS, 1), np.float32)
        self.vectors = np.zeros((0, 1), np.float32)
        if not rows:
            return
        parts = [Features()(texts[i:i + 200]) for i in range(0, len(texts), 200)]
        doc = np.concatenate([p[0] + 200 * i for i, p in enumerate(parts)])
        term, w = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
        idf = np.log((1 + len(rows)) / (1 + np.bincount(term, minlength=TERMS))).astype(np.float32) + 1
        weight = w * idf[term]
        norm = np.sqrt(np.bincount(doc, weight ** 2, len(rows))).astype(np.float32)
        weight = weight / np.maximum(norm, 1e-9)[doc]
        basis = _leading(doc, term, weight, len(rows), min(dim, len(rows)))
        self.project = (basis * idf[:, None]).astype(np.float32)
        self.vectors = self._place(doc, term, w, len(rows))

    def _place(self, doc, term, w, n: int) -> np.ndarray:
        """Unit vectors of texts (zero for texts without terms)."""
        out = np.zeros((n, self.project.shape[1]), np.float32)
        if len(doc):
            seg = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
            stops = np.append(seg[1:], len(doc))
            for i in range(0, len(seg), 64):
                lo, hi = seg[i], stops[min(i + 64, len(seg)) - 1]
                x = self.project[term[lo:hi]] * w[lo:hi, None]
                out[doc[seg[i:i + 64]]] = np.add.reduceat(x, seg[i:i + 64] - lo, axis=0)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def score(self, feats: Features, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(score, similarity of the nearest neighbour)."""
        n = len(texts)
        if not self.k:
            return np.full(n, 0.5), np.zeros(n)
        x = self._place(*feats(texts), n)
        out, near = np.zeros(n), np.zeros(n)
        for lo in range(0, n, BLOCK):
            sim = x[lo:lo + BLOCK] @ self.vectors.T
            top = np.argpartition(sim, sim.shape[1] - self.k, axis=1)[:, -self.k:]
            w = np.maximum(np.take_along_axis(sim, top, axis=1), 0).astype(np.float64) ** 2 + 1e-9
            out[lo:lo + BLOCK] = (w * self.y[top]).sum(axis=1) / w.sum(axis=1)
            near[lo:lo + BLOCK] = np.clip(sim.max(axis=1), 0, 1)
        return np.clip(out, 0, 1), near


def _leading(doc, term, weight, n: int, dim: int, rounds: int = 3) -> np.ndarray:
    """Leading right singular vectors of the sparse (text, term) matrix, by
    subspace iteration over dense blocks of texts."""
    rng = np.random.default_rng(5)
    q = rng.normal(size=(TERMS, min(TERMS, dim + 8))).astype(np.float32)
    order = np.searchsorted(doc, np.arange(0, n + 256, 256))

    def blocks():
        for i in range(len(order) - 1):
            lo, hi = order[i], order[i + 1]
            if hi > lo:
                x = np.zeros((256, TERMS), np.float32)
                x[doc[lo:hi] - 256 * i, term[lo:hi]] = weight[lo:hi]
                yield x

    for _ in range(rounds):
        q, _ = np.linalg.qr(q)
        q = sum(x.T @ (x @ q) for x in blocks())
    q, _ = np.linalg.qr(q)
    small = sum((x @ q).T @ (x @ q) for x in blocks())
    val, vec = np.linalg.eigh(small)
    return (q @ vec[:, ::-1])[:, :dim]


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality", per_class: int = PER_CLASS,
          max_bytes: int = MAX_BYTES) -> Model:
    """At most ``per_class`` rows a class, never held-out ones."""
    return Model(sample(docs, labels, label_col, "quality", per_class, max_bytes))


def classify(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns plus ``score`` (share of the neighbours' weight with
    label 1), ``predicted`` (1 from 0.5 on) and ``nearest`` (cosine). Null,
    empty and blank texts have a zero vector: all neighbours weigh the same.
    Nothing learnt: 0.5. Neighbours of equal similarity at the last place: any
    of them votes. Repeated rows each give a row; an empty table gives none;
    kept columns whose names clash with new ones go."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        feats, m = Features(), shared.value

        def each(texts):
            s, near = m.score(feats, texts)
            return [s, (s >= 0.5).astype(np.int32), near]
        return each
    return text_pass(df, text_col, [T.StructField("score", T.DoubleType()),
                                    T.StructField("predicted", T.IntegerType()),
                                    T.StructField("nearest", T.DoubleType())], make, keep)
