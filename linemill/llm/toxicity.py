"""Toxicity by a convolutional text classifier: hashed word embeddings,
filters of three widths, max pooling; trained on every labelled row that is
not held out, with a threshold for each language.

A word's embedding is the sum of the hashed rows of the word and of its
beginnings, so unseen endings of a known stem are recognised. A filter is
linear before its pooling: scoring looks up, for each hashed row, its
contribution to every filter at every offset, and adds.

Training is by rounds over shards of the rows (local steps, then an average of
the parameters): a shard is what the ids' hashes deal to it, so the model does
not depend on files or tasks, and memory is bounded by a shard's batch. One
shard's rows or fewer are learnt on the driver, where training is the same
steps over a shuffled order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, RollingHash, edges, fold_pass, joined, pieces, stored, text_pass
from .labelled import labelled_lengths, labelled_rows

ROWS = 1 << 15            # hashed embedding rows (the last one: padding)
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 12
STEMS = (3, 4, 5)         # bytes of the beginnings that are hashed too
EPOCHS = 6
LEAST_STEPS = 200       # more epochs where there are few rows
# A shard has about so many rows or bytes of text, whichever makes more shards.
SHARD_ROWS = 4096
SHARD_BYTES = 16 << 20
ROUNDS = 3              # over all shards, each followed by an average
BATCH = 64
BLOCK = 1 << 14         # words whose filters are held at once in training
FIXED = 1 << 28         # parameters are summed as whole numbers: in any order the same
PARTS = 64              # of the parameters, summed apart
# A language gets its own threshold from OWN_THRESHOLD calibration rows of each
# label on; below, that of all languages together.
OWN_THRESHOLD = 15
# Of many shards the thresholds are found among so many steps of the log odds.
BINS, ODDS = 1 << 14, 30.0
CUT = 0.7                 # where calibrated scores mean toxic

_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True
_PAD = ROWS - 1
_BORDER = re.compile(rb"[\x21-\x7E](?=[\x09-\x0D ])")


class Features:
    """Hashed rows of every word: (words, 1 + stems)."""

    def __init__(self):
        self.roll = RollingHash(4)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers, texts one after the other with padding words between
        them, and the first word of each text."""
        if max(map(len, texts), default=0) <= 2 * SLICE_BYTES:
            ids, count = self._words(texts)
        else:                                  # long texts in pieces
            parts = [[self._words([p])[0] for p in pieces(t, SLICE_BYTES, _BORDER)] for t in texts]
            ids = np.concatenate([x for p in parts for x in p])
            count = np.array([sum(map(len, p)) for p in parts])
        pad = max(WIDTHS)                      # so that no window spans two texts
        begin = np.cumsum(count) - count + pad * np.arange(len(texts))
        out = np.full((len(ids) + pad * len(texts), ids.shape[1]), _PAD, np.int32)
        out[np.arange(len(ids)) + pad * np.repeat(np.arange(len(texts)), count)] = ids
        return out, begin

    def _words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of all words, and the number of words of each text."""
        low = [t.lower() if t.isascii() else t.decode("utf-8", "replace").lower().encode() for t in texts]
        buf, at = joined(low, b"\n")
        a, b = edges(_IS_WORD[buf])
        h = self.roll.prefix(buf)
        cols = [self.roll.ranges(h, a, b)]
        for n in STEMS:
            cols.append(self.roll.ranges(h, a, np.minimum(a + n, b)) + np.uint64(n))
        ids = np.stack([(c % np.uint64(ROWS - 1)).astype(np.int32) for c in cols], axis=1)
        return ids, np.diff(np.append(np.searchsorted(a, at[:-1]), len(a)))


def _in_parts(texts: list[bytes], size: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Rows and first words of many texts, a part at a time."""
    feats, ids, begin, at = Features(), [], [], 0
    for k in range(0, len(texts), size):
        i, b = feats(texts[k:k + size])
        ids.append(i)
        begin.append(b + at)
        at += len(i)
    return np.concatenate(ids), np.concatenate(begin)


def _close(z: np.ndarray, ends: np.ndarray, w: int) -> None:
    """Windows that would reach into the next text take no part."""
    for j in range(1, w):
        at = ends - j
        z[at[(at >= 0) & (at < len(z))]] = -np.inf


def class_weights(n0: int, n1: int) -> np.ndarray:
    """Weights by label that make both labels count the same."""
    return (n0 + n1) / np.maximum(1, 2 * np.array([n0, n1], np.float64))


class Network:
    """Parameters, and their training by Adam on a logistic loss."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.E = (rng.normal(0, 0.3, (ROWS, DIM))).astype(np.float32)
        self.E[_PAD] = 0
        self.W = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.b = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.v = rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        self.c = np.zeros(1, np.float32)
        self.begin()

    def begin(self) -> None:
        """Moments as before the first step."""
        self.m = [np.zeros_like(p) for p in self.parameters()]
        self.s = [np.zeros_like(p) for p in self.parameters()]
        self.t = 0
        self.touched = np.zeros(ROWS, np.int64)      # steps that changed a row

    def parameters(self) -> list[np.ndarray]:
        return [self.E, *self.W, *self.b, self.v, self.c]

    def train(self, ids: np.ndarray, begin: np.ndarray, y: np.ndarray, epochs: int, batch: int = BATCH) -> None:
        rng = np.random.default_rng(11)
        ends = np.append(begin[1:], len(ids))
        weight = class_weights((y == 0).sum(), (y == 1).sum())
        for _ in range(max(epochs, -(-LEAST_STEPS * batch // len(y)))):
            order = rng.permutation(len(y))
            for k in range(0, len(order), batch):
                docs = order[k:k + batch]
                self.step(ids, begin[docs], ends[docs], y[docs], weight[y[docs].astype(int)])

    def pooled(self, ids: np.ndarray, begin: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each text, every filter's largest value and its first window.
        Words are taken in blocks that overlap by a window."""
        wide = max(WIDTHS) - 1
        count = np.maximum(-(-(ends - begin - wide) // BLOCK), 1)
        doc = np.repeat(np.arange(len(begin)), count)
        lo = begin[doc] + BLOCK * (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count))
        hi = np.minimum(lo + BLOCK + wide, ends[doc])
        at_offset = [np.concatenate([W[o] for W in self.W if o < len(W)], axis=1).T for o in range(max(WIDTHS))]
        bias = np.concatenate(self.b)[:, None]
        top = np.full((len(begin), len(bias)), -np.inf, np.float32)
        arg = np.zeros(top.shape, np.int64)
        k = 0
        while k < len(doc):
            n = max(1, int(np.searchsorted(np.cumsum((hi - lo)[k:k + BATCH]), BLOCK + wide, side="right")))
            size = (hi - lo)[k:k + n]
            first = np.cumsum(size) - size
            rows = np.concatenate([ids[i:j] for i, j in zip(lo[k:k + n], hi[k:k + n])])
            x = self.E[rows[:, 0]]
            for j in range(1, rows.shape[1]):
                x += self.E[rows[:, j]]
            z = at_offset[0] @ x.T
            for o in range(1, len(at_offset)):
                z[o * FILTERS:, :len(rows) - o] += at_offset[o] @ x[o:].T
            z += bias
            for q, w in enumerate(WIDTHS):
                _close(z[q * FILTERS:(q + 1) * FILTERS].T, first + size, w)
            for i in range(n):
                d, part = doc[k + i], z[:, first[i]:first[i] + size[i]]
                best = part.argmax(axis=1)
                value = part[np.arange(len(best)), best]
                more = value > top[d]
                top[d] = np.where(more, value, top[d])
                arg[d] = np.where(more, lo[k + i] + best, arg[d])
            k += n
        return top, arg

    def step(self, ids: np.ndarray, begin: np.ndarray, ends: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """One step on the texts at ``ids[begin:ends]``. Only windows that
        reach a maximum get a gradient."""
        top, arg = self.pooled(ids, begin, ends)
        p = np.maximum(top, 0)
        score = 1 / (1 + np.exp(-np.clip(p @ self.v + self.c[0], -30, 30)))
        g = ((score - y) * weight / len(y)).astype(np.float32)
        dz = g[:, None] * self.v[None, :] * (top > 0)
        dW, cells, dx = [], [], []
        for q, (w, W) in enumerate(zip(WIDTHS, self.W)):
            own, at = dz[:, q * FILTERS:(q + 1) * FILTERS], arg[:, q * FILTERS:(q + 1) * FILTERS]
            dW.append(np.zeros_like(W))
            for o in range(w):
                rows = ids[np.minimum(at + o, len(ids) - 1)]
                dW[q][o] = np.einsum("nfd,nf->df", self.E[rows].sum(axis=2), own)
                used = np.nonzero(own)
                cells.append(rows[used])
                dx.append(own[used][:, None] * W[o].T[used[1]])
        grads = [*dW, *[dz[:, q * FILTERS:(q + 1) * FILTERS].sum(axis=0) for q in range(len(WIDTHS))], p.T @ g,
                 g.sum(keepdims=True)]
        cells, dx = np.concatenate(cells), np.concatenate(dx)
        order = np.argsort(cells, axis=None, kind="stable")
        flat = cells.ravel()[order]
        seg = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]]) if len(flat) else np.zeros(0, np.int64)
        dE = np.add.reduceat(dx[order // cells.shape[1]], seg, axis=0) if len(flat) else np.zeros((0, DIM), np.float32)
        i = flat[seg]
        i, d = i[i != _PAD], dE[i != _PAD]
        self.t += 1
        fix = np.float32(0.01 * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t))
        par, m, s = self.parameters(), self.m, self.s
        m[0][i] = 0.9 * m[0][i] + 0.1 * d
        s[0][i] = 0.999 * s[0][i] + 0.001 * d * d
        self.E[i] -= fix * m[0][i] / (np.sqrt(s[0][i]) + 1e-8)
        self.touched[i] += 1
        for j in range(1, len(par)):
            m[j] += 0.1 * (grads[j - 1] - m[j])
            s[j] += 0.001 * (grads[j - 1] ** 2 - s[j])
            par[j] -= fix * m[j] / (np.sqrt(s[j]) + 1e-8)

    def change(self, since: list[np.ndarray]) -> np.ndarray:
        """How far the parameters went, in whole numbers, times the steps they
        took part in; and those steps. Such arrays are added up."""
        far = [p.astype(np.float64) - q for p, q in zip(self.parameters(), since)]
        far[0] *= self.touched[:, None]
        return np.concatenate([*[np.rint(f * (FIXED * (self.t if k else 1))).astype(np.int64).ravel()
                                 for k, f in enumerate(far)], self.touched, [self.t]])

    def move(self, total: np.ndarray) -> None:
        """By the mean change of all shards: of an embedding row, of those
        whose steps touched it."""
        touched, t = np.maximum(total[-1 - ROWS:-1], 1), max(int(total[-1]), 1)
        at = 0
        for k, p in enumerate(self.parameters()):
            by = total[at:at + p.size].reshape(p.shape) / (touched[:, None] if k == 0 else t)
            p += (by / FIXED).astype(np.float32)
            at += p.size

    def tables(self) -> list[np.ndarray]:
        """For each offset, contributions of every hashed row to the filters
        of all widths that reach that offset."""
        return [np.concatenate([self.E @ W[o] for W in self.W if o < len(W)], axis=1).astype(np.float32)
                for o in range(max(WIDTHS))]


def pooled_scores(tables, bias, v, c, ids: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Probabilities by adding table rows; the pooling runs over the words of
    each text. Words are taken in blocks of bounded size."""
    n, k = len(ids), len(begin)
    top = np.full((k, FILTERS * len(WIDTHS)), -np.inf, np.float32)
    ends = np.append(begin[1:], n)
    step = 1 << 15
    for lo in range(0, n, step):
        hi = min(n, lo + step + max(WIDTHS) - 1)
        part = ids[lo:hi]
        by_offset = [np.zeros((len(part), t.shape[1]), np.float32) for t in tables]
        for o, t in enumerate(tables):
            for j in range(part.shape[1]):
                by_offset[o] += t[part[:, j]]
        da, db = np.searchsorted(ends, lo, side="right"), np.searchsorted(begin, min(lo + step, n), side="left")
        for q, w in enumerate(WIDTHS):
            m = min(step, len(part) - w + 1)
            if m <= 0:
                continue
            z = np.zeros((m, FILTERS), np.float32)
            for o in range(w):
                # widths that reach offset o are those above it, in order
                col = sum(1 for u in WIDTHS[:q] if o < u) * FILTERS
                z += by_offset[o][o:o + m, col:col + FILTERS]
            _close(z, ends - lo, w)
            seg = np.maximum(begin[da:db] - lo, 0)
            ok = seg < m
            if ok.any():
                got = np.maximum.reduceat(z, seg[ok], axis=0)
                cut = top[da:db][ok, q * FILTERS:(q + 1) * FILTERS]
                top[da + np.flatnonzero(ok), q * FILTERS:(q + 1) * FILTERS] = np.maximum(cut, got)
    top = np.maximum(np.where(np.isfinite(top), top + np.concatenate(bias), 0), 0)
    return 1 / (1 + np.exp(-np.clip(top @ v + c, -30, 30)))


def _languages(ids: np.ndarray, begin: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Likeliest language of each text by its words' log odds."""
    total = np.zeros((len(begin) + 1, table.shape[1]))
    ends = np.append(begin[1:], len(ids))
    for lo in range(0, len(ids), 1 << 16):
        part = table[ids[lo:lo + (1 << 16), 0]]
        doc = np.searchsorted(ends, np.arange(lo, lo + len(part)), side="right")
        seg = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        total[doc[seg]] += np.add.reduceat(part, seg, axis=0)
    return total[:len(begin)].argmax(axis=1)


def _odds(count: np.ndarray) -> np.ndarray:
    """From the words of each language (rows, languages): log odds."""
    count = count + 0.1
    count[_PAD] = 1
    guess = np.log(count / count.sum(axis=0)).astype(np.float32)
    guess -= guess.mean(axis=1, keepdims=True)
    guess[_PAD] = 0
    return guess


class Model:
    """What is broadcast: tables of fixed size, and thresholds. Learns from
    ``rows`` in this process. Without ``calibration`` rows every fifth row
    calibrates."""

    def __init__(self, rows: list[tuple], epochs: int = EPOCHS, calibration: list[tuple] | None = None):
        cal = np.arange(len(rows) + len(calibration or ())) >= len(rows) if calibration else \
            np.arange(len(rows)) % 5 == 4
        rows = rows + (calibration or [])
        texts = [r[0].encode("utf-8", "surrogatepass") for r in rows]
        y = np.array([r[1] for r in rows], np.float64)
        langs = [r[2] or "" for r in rows]
        names = sorted(set(langs)) or [""]
        net, guess = Network(), np.zeros((ROWS, len(names)), np.float32)
        if rows:
            ids, begin = _in_parts(texts)
            lang = np.array([names.index(x) for x in langs])
            ends = np.append(begin[1:], len(ids))
            count = np.zeros((ROWS, len(names)))
            np.add.at(count, (ids[:, 0], np.repeat(lang, ends - begin)), 1)
            guess = _odds(count)
            if len(set(y[~cal])) == 2:
                tr = np.flatnonzero(~cal)
                sub = np.concatenate([ids[begin[d]:ends[d]] for d in tr])
                size = (ends - begin)[tr]
                net.train(sub, np.cumsum(size) - size, y[tr], epochs)
        self._set(net, names, guess)
        if rows and len(set(y)) == 2:
            p = pooled_scores(self.tables, self.bias, self.v, self.c, ids, begin)
            if len(set(y[cal])) < 2:
                cal[:] = True
            self._calibrate(p[cal], y[cal], np.ones(cal.sum()), _languages(ids, begin, self.guess)[cal])

    @classmethod
    def of(cls, net: Network, names: list[str], guess: np.ndarray) -> Model:
        """A trained network, not yet calibrated."""
        out = cls.__new__(cls)
        out._set(net, names, guess)
        return out

    def _set(self, net: Network, names: list[str], guess: np.ndarray) -> None:
        self.languages, self.guess, self.cuts = names, guess, np.full(len(names), 0.5)
        self.bias, self.v, self.c = net.b, net.v, net.c[0]
        self.tables = net.tables()

    def _calibrate(self, p: np.ndarray, hits: np.ndarray, n: np.ndarray, where: np.ndarray) -> None:
        """From scores that ``n`` rows of the guessed language ``where`` have,
        ``hits`` of them of label 1."""
        everyone = _threshold(p, hits, n)
        for k in range(len(self.languages)):
            own = where == k
            few = min(hits[own].sum(), (n - hits)[own].sum()) < OWN_THRESHOLD
            self.cuts[k] = everyone if few else _threshold(p[own], hits[own], n[own])

    def raw(self, feats: Features, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the thresholds, and guessed languages."""
        ids, begin = feats(texts)
        return pooled_scores(self.tables, self.bias, self.v, self.c, ids, begin), _languages(ids, begin, self.guess)

    def score(self, feats: Features, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        p, lang = self.raw(feats, texts)
        cut = self.cuts[lang]
        out = np.where(p < cut, CUT * p / cut, CUT + (1 - CUT) * (p - cut) / (1 - cut))
        return np.clip(out, 0, 1), lang


def _threshold(p: np.ndarray, hits: np.ndarray, n: np.ndarray) -> float:
    """Between the two scores where the F1 of label 1 is best (middle of the
    log odds)."""
    order = np.argsort(-p, kind="stable")
    q, hit = p[order], np.cumsum(hits[order])
    f1 = 2 * hit / (np.cumsum(n[order]) + hits.sum())
    f1[:-1][q[1:] == q[:-1]] = -1            # equal scores are not parted
    k = int(f1.argmax())
    low = q[k + 1] if k + 1 < len(q) else 0.0
    a, b = np.clip([q[k], low], 1e-6, 1 - 1e-6)
    mid = (np.log(a / (1 - a)) + np.log(b / (1 - b))) / 2
    return float(1 / (1 + np.exp(-mid)))


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", lang_col: str = "lang",
          epochs: int = EPOCHS, rounds: int = ROUNDS, shard_rows: int = SHARD_ROWS,
          shard_bytes: int = SHARD_BYTES) -> Model:
    """Train on all labelled rows but a fifth of the ids, which calibrates all
    thresholds (never held-out ones); texts are whole. The language column only
    groups words, for the guess of a text's language. Up to one shard: ``epochs``
    on the driver; beyond: ``rounds`` of the shards, in tasks."""
    n, size = labelled_lengths(docs, labels, label_col)
    shards = max(-(-n // shard_rows), -(-size // shard_bytes), 1)
    rows = labelled_rows(docs, labels, label_col, lang_col, "toxicity", shards)
    if shards == 1:
        got = sorted(rows.collect(), key=lambda r: r["i"])
        part = [[(bytes(r["t"]).decode("utf-8", "replace"), r["y"], r["lang"]) for r in got if r["cal"] == c]
                for c in (False, True)]
        return Model(part[0], epochs, part[1])
    return _learn_shards(stored(rows, "toxicity"), rounds)


def _learn_shards(rows: DataFrame, rounds: int) -> Model:
    count = {(r["lang"], r["cal"], r["y"]): r["count"] for r in rows.groupBy("lang", "cal", "y").count().collect()}
    names = sorted({k[0] for k in count})
    of = [[sum(c for (_, k, y), c in count.items() if k == cal and y == label) for label in (0, 1)]
          for cal in (False, True)]
    net, guess, learnable = Network(), None, min(of[0]) > 0
    weight = class_weights(*of[0])
    for _ in range(rounds if learnable else 1):
        words = guess is None                # counted in the first round
        total = _round(rows if words else rows.filter("not cal"), net, weight, names if words else [], learnable)
        if words:
            at = len(total) - ROWS * len(names)
            guess, total = _odds(total[at:].reshape(len(names), ROWS).T.astype(np.float64)), total[:at]
        net.move(total)
    model = Model.of(net, names, guess)
    if min(sum(c) for c in zip(*of)) > 0:
        model._calibrate(*_histogram(rows.filter("cal") if min(of[1]) > 0 else rows, model))
    return model


def _round(rows: DataFrame, net: Network, weight: np.ndarray, names: list[str], learnable: bool) -> np.ndarray:
    """The shards' changes of the parameters, each from ``net`` on, added up;
    and the words of each of the languages ``names``. A shard's rows come one
    after the other and in order, as they are stored."""
    start = [p.copy() for p in net.parameters()]
    shared = rows.sparkSession.sparkContext.broadcast(start)

    def make():
        feats, own, since = Features(), Network(), shared.value
        place = {x: k for k, x in enumerate(names)}
        count = np.zeros((len(names), ROWS), np.int64)
        total, now, held = None, None, []

        def step():
            size = np.array([len(i) for i, _ in held])
            ends, y = np.cumsum(size), np.array([v for _, v in held])
            own.step(np.concatenate([i for i, _ in held]), ends - size, ends, y, weight[y])
            held.clear()

        def close():
            nonlocal total
            if held:
                step()
            if own.t:
                total = own.change(since) + (0 if total is None else total)

        def feed(texts, shard, y, cal, lang):
            nonlocal now
            ids, begin = feats(texts)
            ends = np.append(begin[1:], len(ids))
            if names:
                of = np.array([place[x] for x in lang])
                np.add.at(count, (np.repeat(of, ends - begin), ids[:, 0]), 1)
            for d in range(len(texts)):
                if shard[d] != now:
                    close()
                    for p, q in zip(own.parameters(), since):
                        p[...] = q
                    own.begin()
                    now = shard[d]
                if learnable and not cal[d]:
                    held.append((ids[begin[d]:ends[d]], y[d]))
                    if len(held) == BATCH:
                        step()

        def rest():
            close()
            own.begin()
            out = own.change(own.parameters()) if total is None else total
            cut = np.array_split(np.concatenate([out, count.ravel()]), PARTS)
            return [list(range(PARTS)), [c.tobytes() for c in cut]]
        return feed, rest

    schema = "part int, total binary"
    got = fold_pass(rows, "t", schema, make, ["shard", "y", "cal", "lang"]).groupBy("part").applyInArrow(
        _added, schema).collect()
    shared.unpersist()
    return np.concatenate([np.frombuffer(r["total"], np.int64) for r in sorted(got, key=lambda r: r["part"])])


def _added(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One part of all tasks' totals, added up."""
    part, total = None, 0
    for b in rows:
        part = b.column("part").slice(0, 1)
        for v in b.column("total"):
            total = total + np.frombuffer(v.as_buffer(), np.int64)
    yield pa.RecordBatch.from_arrays([part, pa.array([total.tobytes()], pa.binary())], names=["part", "total"])


def _histogram(rows: DataFrame, model: Model) -> tuple[np.ndarray, ...]:
    """Scores in fine steps of their log odds, with the rows and those of label
    1 at each, for each guessed language."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def make():
        feats, m = Features(), shared.value

        def each(texts):
            p, lang = m.raw(feats, texts)
            p = p.astype(np.float64)
            with np.errstate(divide="ignore"):
                odds = np.clip(np.log(p) - np.log1p(-p), -ODDS, ODDS)
            return [np.minimum((odds + ODDS) * (BINS / 2 / ODDS), BINS - 1).astype(np.int32), lang.astype(np.int32)]
        return each
    got = text_pass(rows, "t", [T.StructField("bin", T.IntegerType()), T.StructField("guess", T.IntegerType())],
                    make, ["y"]).groupBy("guess", "bin").agg(F.sum("y"), F.count("y")).orderBy("guess", "bin").collect()
    where, at, hits, n = np.array(got, np.float64).T
    return 1 / (1 + np.exp(-((at + 0.5) * (2 * ODDS / BINS) - ODDS))), hits, n, where


def classify(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns plus ``score`` (0 to 1; 0.7 is the calibrated
    threshold of the text's guessed language), ``predicted`` and
    ``threshold_lang``. Whole texts, whatever their length; null and empty
    texts get the score of padding. Nothing learnt: an untrained network. Ties
    between guessed languages go to the first by name. Repeated rows each give
    a row; an empty table gives none; kept columns whose names clash with new
    ones go."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        feats, m = Features(), shared.value

        def each(texts):
            s, lang = m.score(feats, texts)
            return [s, (s >= CUT).astype(np.int32), [m.languages[i] for i in lang.tolist()]]
        return each
    return text_pass(df, text_col, [T.StructField("score", T.DoubleType()),
                                    T.StructField("predicted", T.IntegerType()),
                                    T.StructField("threshold_lang", T.StringType())], make, keep)
