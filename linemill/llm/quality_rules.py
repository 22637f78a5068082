"""Quality rules: plain counts of a text, and how much more likely its hashed
n-grams are under a trusted target's multinomial than under the raw corpus's.

Words and pairs of neighbouring words fall into ``2 * BUCKETS`` hash buckets.
Counted over all trusted texts and over all texts, they give two smoothed
multinomials; the logarithm of their ratio is a weight for each bucket, held
in whole units of 2^-20, so a text's sum does not depend on any order. The sum
over the number of n-grams is the text's score. Every text is kept or not by
one threshold: the score that all but a small share of trusted texts which
were not learnt reach, less a slack.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, bitmap, fold_pass, fresh, marked, pieces, stored, text_pass

BUCKETS = 1 << 16
UNITS = 1 << 20
MULTIPLIER = 40503
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
# Share of unlearnt trusted texts that may score below the threshold before
# the slack (units of 2^-20 nats a gram) is taken off.
LOW_SHARE = 0.01
SLACK = UNITS // 4
# Scores are counted in bins of this many units: a bounded number.
BIN = 1 << 10
# Word hashes a task remembers.
MEMO = 300_000

_BLANK = re.compile(rb"[\x09-\x0D ]")
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[*range(0x09, 0x0E), 0x20]] = True
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(b"#*$%&|<>")] = True          # fixed value
_IS_LEAD = np.ones(256, bool)
_IS_LEAD[0x80:0xC0] = False


def word_hash(word: bytes) -> int:
    """31 bits of the word's MD5 (the low ones of its last eight bytes)."""
    return int.from_bytes(hashlib.md5(word, usedforsecurity=False).digest()[8:12], "little") & 0x7FFFFFFF


class Words(dict):
    """Numbers of distinct words in order of appearance, with their hashes."""

    def __init__(self):
        super().__init__()
        self.hashes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.hashes.append(word_hash(word))
        return n


class Reader:
    """Word numbers and hashes of the texts of a task."""

    def __init__(self):
        self.words = Words()

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers of all texts, their hashes, and where each text's
        words begin (one more entry: the end)."""
        if len(self.words) > MEMO:
            self.words = Words()
        number = self.words.__getitem__
        parts, size = [], []
        for t in texts:
            n = 0
            for p in pieces(t, SLICE_BYTES, _BLANK):
                x = p.split()
                parts.append(np.fromiter(map(number, x), np.int32, len(x)))
                n += len(x)
            size.append(n)
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        return ids, np.array(self.words.hashes, np.int64)[ids], np.concatenate([[0], np.cumsum(size, dtype=np.int64)])


def grams(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, and of all pairs by their first word (-1: the
    last word of a text, which begins none)."""
    one = h & (BUCKETS - 1)
    two = np.full(len(h), -1, np.int64)
    two[:-1] = BUCKETS + ((h[:-1] * MULTIPLIER + h[1:]) & (BUCKETS - 1))
    last = first[1:][np.diff(first) > 0] - 1
    two[last] = -1
    return one, two


def repeated_words(ids: np.ndarray, first: np.ndarray, n: int = WINDOW) -> np.ndarray:
    """For each text, its words inside ``n``-word windows that it holds twice
    or more often."""
    m = len(ids) - n + 1
    size = np.diff(first)
    if m <= 0:
        return np.zeros(len(size), np.int64)
    doc = np.repeat(np.arange(len(size)), size)
    at = np.flatnonzero(doc[:m] == doc[n - 1:])
    key = doc[at]
    for j in range(n):                        # names of windows one word longer each time
        key = np.unique(key * (int(ids.max()) + 1) + ids[at + j], return_inverse=True)[1]
    again = at[np.bincount(key, minlength=1)[key] > 1] if len(at) else at
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + n, -1)
    total = np.concatenate([[0], np.cumsum(np.cumsum(cover)[:-1] > 0)])
    return total[first[1:]] - total[first[:-1]]


def _lines(text: bytes) -> Iterator[bytes]:
    if len(text) <= SLICE_BYTES:
        yield from text.split(b"\n")
        return
    lo = 0
    while (hi := text.find(b"\n", lo)) >= 0:
        yield text[lo:hi]
        lo = hi + 1
    yield text[lo:]


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen, n = set(), 0
    for x in _lines(text):
        if x.strip():
            n += 1
            seen.add(x)
    return n - len(seen)


def _chars(text: bytes) -> tuple[int, int]:
    """Code points in words, and symbols."""
    chars = symbols = 0
    for i in range(0, len(text), SLICE_BYTES):
        b = np.frombuffer(text, np.uint8, min(SLICE_BYTES, len(text) - i), i)
        chars += int(np.count_nonzero(_IS_LEAD[b])) - int(np.count_nonzero(_IS_BLANK[b]))
        symbols += int(np.count_nonzero(_IS_SYMBOL[b]))
    return chars, symbols


def base_counts(texts: list[bytes], ids: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    n = np.diff(first)
    chars = np.array([_chars(t) for t in texts], np.int64).reshape(-1, 2)
    again = repeated_words(ids, first)
    failed = (n < MIN_WORDS) | (100 * again > MAX_REPEAT_PERCENT * n)
    return [n, chars[:, 0], chars[:, 1], np.array([repeated_lines(t) for t in texts], np.int64), again, failed]


def gram_counts(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often each bucket occurs in all texts. Counted in the tasks; each
    sends its non-empty buckets, so the driver gets ``2 * BUCKETS`` sums."""
    def make():
        reader, counts = Reader(), np.zeros(2 * BUCKETS, np.int64)

        def feed(texts):
            _, h, first = reader.read(texts)
            one, two = grams(h, first)
            for x in (one, two[two >= 0]):
                counts[:] += np.bincount(x, minlength=2 * BUCKETS)

        def rest():
            at = np.flatnonzero(counts)
            return [at, counts[at]]
        return feed, rest
    rows = fold_pass(df.select(text_col), text_col, "bucket int, n long", make).groupBy("bucket").agg(
        F.sum("n").alias("n")).toPandas()
    out = np.zeros(2 * BUCKETS, np.int64)
    out[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def weights(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Logarithm of the ratio of the two smoothed multinomials, in units."""
    def logs(c):
        return np.log((c + 1) / (c.sum() + len(c)))
    return np.floor(UNITS * (logs(target) - logs(raw)) + 0.5).astype(np.int64)


def _score(weight: np.ndarray, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of weights and number of n-grams of each text."""
    one, two = grams(h, first)
    w = weight[one] + np.where(two >= 0, weight[two], 0)
    total = np.concatenate([[0], np.cumsum(w)])
    n = np.diff(first)
    return total[first[1:]] - total[first[:-1]], n + np.maximum(n - 1, 0)


def score(df: DataFrame, weight: np.ndarray, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns plus the base counts, ``llr_sum`` (units) and
    ``n_grams``. One pass beside the rows; the weights are broadcast
    (``2 * BUCKETS`` numbers)."""
    shared = df.sparkSession.sparkContext.broadcast(weight)
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    fields = [T.StructField(c, T.LongType()) for c in longs] + [T.StructField("base_failed", T.BooleanType())]
    fields += [T.StructField(c, T.LongType()) for c in ("llr_sum", "n_grams")]

    def make():
        reader = Reader()

        def each(texts):
            ids, h, first = reader.read(texts)
            return [*base_counts(texts, ids, first), *_score(shared.value, h, first)]
        return each
    return text_pass(df, text_col, fields, make, keep)


def threshold(scored: DataFrame, low_share: float = LOW_SHARE, slack: int = SLACK) -> int | None:
    """The lower edge (units a gram) of the bin that holds the ``low_share``
    quantile of the rows that pass the base rules, less the slack; None where
    there are none. Bins are bounded in number by the range of the weights."""
    bins = scored.filter(~F.col("base_failed")).select(F.expr(f"floor(llr_sum / n_grams / {BIN})").alias("b")).groupBy(
        "b").agg(F.count("*").alias("n")).orderBy("b").collect()
    left = low_share * sum(r.n for r in bins)
    for r in bins:
        left -= r.n
        if left < 0:
            return r.b * BIN - slack
    return None


def rows_of(df: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose id is in ``ids`` (one column ``i``). A bitmap of
    the ids lets most other rows go before the join, always one by shuffle,
    deals out the rest with their texts."""
    key, maybe = fresh(df, "_i"), fresh(df, "_maybe")
    likely = marked(df, bitmap(ids.select(F.col("i").cast("string").alias("i")), "i"), maybe,
                    F.col(f"`{id_col}`").cast("string")).filter(maybe).drop(maybe)
    wanted = ids.select(F.col("i").alias(key)).hint("merge")
    return likely.join(wanted, F.col(f"`{id_col}`") == F.col(key), "left_semi")


def calibration_fold(id_col: str = "i"):
    """True for a quarter of the trusted ids, by their MD5."""
    return F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("long") % 4 == 0


def quality_rules(df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  keep: list[str] | None = None, low_share: float = LOW_SHARE, slack: int = SLACK) -> DataFrame:
    """``keep`` columns (default: all but the text) plus ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``llr`` (nats a gram; null without words) and ``kept``.

    ``trusted`` is a table with a column of ids (its first): the rows of ``df``
    with these ids are the target, three quarters of the ids for its counts
    and one quarter for the threshold (all for both, where one of them has no
    row that passes the base rules). The raw corpus is all of ``df``.

    A null text has no words and fails; ids that are null or without a row
    name nothing; rows that repeat an id, and equal texts, each count and each
    get a row; without any trusted row, weights are zero and every text that
    passes the base rules is kept. An empty table gives no rows. Kept columns
    whose names clash with new ones go.

    Plan: three passes beside the rows and no shuffle of text, but for the
    trusted rows, which are joined to their ids and stored once.
    """
    i = F.col(f"`{trusted.columns[0]}`")
    ids = trusted.select(i.alias("i")).filter(i.isNotNull()).distinct()
    src = df.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t"))
    target = stored(rows_of(src, ids, "i"), "quality-target")
    raw = gram_counts(src, "t")

    def learnt(rows):
        counts = gram_counts(rows, "t")
        return weights(counts, raw) if counts.any() else np.zeros(2 * BUCKETS, np.int64)

    weight = learnt(target.filter(~calibration_fold()))
    cut = threshold(score(target.filter(calibration_fold()), weight, "t"), low_share, slack) if weight.any() else None
    if cut is None:
        weight = learnt(target)
        cut = threshold(score(target, weight, "t"), low_share, slack)
    out = score(df, weight, text_col, keep)
    fine = F.lit(True) if cut is None else F.col("llr_sum") >= F.lit(cut) * F.col("n_grams")
    llr = F.when(F.col("n_grams") > 0, F.col("llr_sum") / F.col("n_grams") / F.lit(UNITS))
    return out.withColumns({"llr": llr, "kept": ~F.col("base_failed") & fine}).drop("llr_sum", "n_grams")
