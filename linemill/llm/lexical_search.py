"""Ranked lexical search of a stated set of items against all documents, by
dense matrix products.

Items come in blocks. A block's distinct terms are its vocabulary, cut into
tiles; a tile of the vocabulary is a matrix of term counts (term x item). A
tile of documents is a matrix of term impacts (document x term). Their float64
product is exact: the tiles are cut so that no sum of one can reach 2^53, all
of its terms being whole numbers, and the products are added as 64-bit
integers. Every task keeps the best ``k`` documents of each item seen so far
(all that tie with the k-th are compared by id), and a ranking of those gives
the result.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, fold_pass, pieces

# Items, and distinct terms, of a block: they bound what is broadcast.
BLOCK_ITEMS = 1024
BLOCK_TERMS = 50_000
# Rows and columns of the dense tiles.
TILE_TERMS = 2048
TILE_DOCS = 512
EXACT = 1 << 53
# Impact of a term: its weight times at most this many units.
UNIT = 10**9
# Share of the length normalisation, in hundredths.
LENGTH = 25
BUCKETS = 256

# Terms are runs of digits, letters and all bytes from 0x80.
_TERM = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80
              else 0x20 for c in range(256))
_SPACE = re.compile(rb" ")


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in order; only A to Z are lower-cased."""
    return text.translate(_TERM).split()


class Counts:
    """Term counts of texts against a vocabulary."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.get = vocabulary.get

    def __call__(self, text: bytes) -> tuple[int, Counter]:
        """All terms of the text, and how often each vocabulary entry occurs."""
        low = text.translate(_TERM)
        if len(low) <= 2 * SLICE_BYTES:
            words = low.split()
            found = Counter(map(self.get, words))
            n = len(words)
        else:
            found, n = Counter(), 0
            for p in pieces(low, SLICE_BYTES, _SPACE):
                words = p.split()
                n += len(words)
                found.update(map(self.get, words))
        found.pop(None, None)
        return n, found


def item_blocks(items: DataFrame, item_id: str, item_text: str, block_items: int, block_terms: int):
    """The items in blocks: (row number, id, term counts). They come to the
    driver one partition at a time; one block is held at once."""
    rows = items.select(F.col(f"`{item_id}`").alias("i"), F.col(f"`{item_text}`").cast("binary").alias("t"))
    block, seen, at = [], set(), 0
    for i, t in rows.toLocalIterator():
        c = Counter(terms_of(bytes(t or b"")))
        if block and (len(block) >= block_items or len(seen | c.keys()) > block_terms):
            yield block
            block, seen = [], set()
        block.append((at, i, c))
        seen |= c.keys()
        at += 1
    if block:
        yield block


def count_tiles(block, number: dict[bytes, int], weight: np.ndarray, tile_terms: int = TILE_TERMS,
                exact: int = EXACT) -> list[tuple]:
    """Vocabulary tiles (terms, rows, item columns, counts). In each, the sum
    over an item's counts of the largest possible impacts stays below
    ``exact``; a count too large for one tile is spread over several."""
    by_term: dict[int, list[tuple[int, int]]] = {}
    for q, (_, _, counts) in enumerate(block):
        for t, c in counts.items():
            by_term.setdefault(number[t], []).append((q, c))
    todo = [(t, q, c) for t in sorted(by_term) for q, c in by_term[t]]
    tiles = []
    while todo:
        terms: dict[int, int] = {}
        load = [0] * len(block)
        rows, cols, vals, later = [], [], [], []
        for t, q, c in todo:
            top = int(weight[t]) * (UNIT // 1000)
            fits = c if not top else min(c, (exact - 1 - load[q]) // top)
            if fits <= 0 or (t not in terms and len(terms) >= tile_terms):
                later.append((t, q, c))
                continue
            rows.append(terms.setdefault(t, len(terms)))
            cols.append(q)
            vals.append(fits)
            load[q] += fits * top
            if fits < c:
                later.append((t, q, c - fits))
        if not rows:
            raise ValueError("one occurrence of a term is beyond the exact range")
        tiles.append((np.array(list(terms)), np.array(rows), np.array(cols), np.array(vals, np.float64)))
        todo = later
    return tiles


class Scorer:
    """Best documents of each item of a block, tile after tile."""

    def __init__(self, tiles, n_items: int, vocabulary: dict, weight: np.ndarray, docs: int, terms: int, k: int):
        self.tiles, self.q, self.k = tiles, n_items, k
        self.weight, self.docs, self.terms = weight, docs, terms
        self.counts = Counts(vocabulary)
        self.column = []
        for t, *_ in tiles:
            c = np.full(len(weight), -1)
            c[t] = np.arange(len(t))
            self.column.append(c)
        self.dense = [None] * len(tiles)
        self.rows: list[tuple] = []               # (id, vocabulary entries, impacts)
        self.best: list[list] = [[] for _ in range(n_items)]
        self.floor = np.ones(n_items, np.int64)   # a score to beat or to tie

    def feed(self, texts, ids):
        for t, i in zip(texts, ids):
            n, found = self.counts(t)
            if not found:
                continue
            at = np.fromiter(found.keys(), np.int64, len(found))
            tf = np.fromiter(found.values(), np.int64, len(found))
            m = 100 - LENGTH + LENGTH * n * self.docs // self.terms
            self.rows.append((i, at, self.weight[at] * (UNIT * tf // (1000 * tf + 12 * m))))
            if len(self.rows) >= TILE_DOCS:
                self.score()

    def _matrix(self, j: int) -> np.ndarray:
        if self.dense[j] is None:
            terms, rows, cols, vals = self.tiles[j]
            m = np.zeros((len(terms), self.q))
            m[rows, cols] = vals
            if len(self.tiles) > 1:               # several tiles: one in memory at a time
                self.dense = [None] * len(self.tiles)
            self.dense[j] = m
        return self.dense[j]

    def score(self):
        d = len(self.rows)
        size = np.array([len(r[1]) for r in self.rows])
        doc = np.repeat(np.arange(d), size)
        at = np.concatenate([r[1] for r in self.rows])
        impact = np.concatenate([r[2] for r in self.rows])
        total = np.zeros((d, self.q), np.int64)
        for j, column in enumerate(self.column):
            c = column[at]
            here = c >= 0
            if not here.any():
                continue
            x = np.zeros((d, len(self.tiles[j][0])))
            x[doc[here], c[here]] = impact[here]
            total += (x @ self._matrix(j)).astype(np.int64)
        least = self.floor
        if d > self.k:
            least = np.maximum(least, np.partition(total, d - self.k, axis=0)[d - self.k])
        got: dict[int, list] = {}
        for r, q in zip(*np.nonzero(total >= least)):
            got.setdefault(int(q), []).append((int(total[r, q]), self.rows[r][0]))
        for q, new in got.items():
            best = sorted(self.best[q] + new, key=lambda x: (-x[0], x[1] is None, x[1]))[:self.k]
            self.best[q] = best
            if len(best) == self.k:
                self.floor[q] = best[-1][0]
        self.rows = []


def _block_counts(df: DataFrame, text_col: str, shared) -> tuple[np.ndarray, int, int]:
    """Documents that hold each entry of the block's vocabulary, documents with
    terms, and all their terms. Every task sends one row per entry it met."""
    def make():
        number = shared.value
        counts, hold, sums = Counts(number), Counter(), [0, 0]

        def feed(texts):
            for t in texts:
                n, found = counts(t)
                sums[0] += n > 0
                sums[1] += n
                hold.update(found.keys())

        def rest():
            return [[-1, -2, *hold.keys()], [*sums, *hold.values()]]
        return feed, rest
    rows = fold_pass(df, text_col, "term long, n long", make).groupBy("term").agg(F.sum("n").alias("n")).collect()
    got = {r.term: r.n for r in rows}
    return (np.array([got.get(t, 0) for t in range(len(shared.value))], np.int64), got.get(-1, 0), got.get(-2, 0))


def _ranked(scores: DataFrame, by: str, id_col: str, k: int) -> DataFrame:
    """Best ``k`` of each item, first inside buckets of ids."""
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last()]
    spread = F.pmod(F.xxhash64(id_col), F.lit(BUCKETS))
    x = scores.withColumn("_b", spread).withColumn(
        "rank", F.row_number().over(Window.partitionBy(by, "_b").orderBy(*order))).filter(F.col("rank") <= k)
    return x.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(
        F.col("rank") <= k).drop("_b")


def search(df: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_items: int = BLOCK_ITEMS,
           block_terms: int = BLOCK_TERMS, tile_terms: int = TILE_TERMS) -> DataFrame:
    """Rows ``(item_id, rank, id_col, score)``: of each row of ``items`` the
    ``k`` documents of highest score above 0 (all, if fewer), rank 1 first,
    equal scores by ascending id (nulls last; of equal ids any row).

    Null and empty texts have no terms: such documents are never found and such
    items find nothing. A document row counts as often as it is repeated, and
    an item row that repeats an id is ranked for itself. Empty tables on either
    side give no rows. Other columns, whatever their names, are not looked at.

    Plan: two passes beside the documents for each block of items (one block up
    to ``block_items`` items and ``block_terms`` terms): counts of the block's
    terms, then scores. Nothing of the documents is shuffled but ``k`` rows an
    item and task. Broadcast: one block, bounded by these two parameters.
    """
    spark = df.sparkSession
    out = T.StructType([T.StructField("_item", T.LongType()), T.StructField("item_id", items.schema[item_id].dataType),
                        T.StructField("_id", df.schema[id_col].dataType), T.StructField("score", T.LongType())])
    src = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t"))
    found = None
    for block in item_blocks(items, item_id, item_text, block_items, block_terms):
        number = {t: i for i, t in enumerate(sorted(set().union(*[c for _, _, c in block])))}
        if not number:
            continue
        df_of, n_docs, n_terms = _block_counts(src, "_t", spark.sparkContext.broadcast(number))
        if not n_docs:
            break
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df_of], np.int64)
        tiles = count_tiles(block, number, weight, tile_terms)
        shared = spark.sparkContext.broadcast(
            (tiles, [(a, i) for a, i, _ in block], number, weight, n_docs, n_terms))
        one = fold_pass(src, "_t", out, lambda shared=shared: _scoring(shared.value, k), ["_id"])
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = spark.createDataFrame([], out)
    ranked = _ranked(found, "_item", "_id", k)
    return ranked.select("item_id", "rank", F.col("_id").alias(id_col), "score")


def _scoring(value, k):
    tiles, names, number, weight, n_docs, n_terms = value
    s = Scorer(tiles, len(names), number, weight, n_docs, n_terms, k)

    def rest():
        if s.rows:
            s.score()
        flat = [(*names[q], i, score) for q, best in enumerate(s.best) for score, i in best]
        return [list(c) for c in zip(*flat)] if flat else None
    return s.feed, rest
