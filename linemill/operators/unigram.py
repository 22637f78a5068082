"""Unigram subword vocabularies: encode (F3) and learn (A5).

Text is normalised (NFKC, controls dropped, white space collapsed to one
``▁`` before every word), so a line splits into words that each begin with
``▁``; pieces never cross a word boundary. Encoding is a Viterbi search per
distinct word (memoised in each task). Learning is expectation maximisation
over the table of distinct words, whose lattices are made once
(:mod:`.lattice`): every E-step is a pass over them with the current scores
broadcast, followed by a sum for each piece; pruning scores the candidates in a
``mapInPandas`` over the candidate table. The driver only ever holds the
candidate vocabulary, whose size is a parameter. Expected counts are summed as
integers, so the learnt scores and ids do not depend on the partitioning.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir, spread, stored, stored_large_rows
from . import lattice
from .tokenwise import distinct_udf

# --- fixed values -----------------------------------------------------------
WORD_START = "▁"          # the "▁" marker that replaces white space
META_PIECES = ["<unk>", "<s>", "</s>"]   # ids 0, 1, 2, score 0
UNK_PENALTY = 10.0             # an unknown character scores min score - 10
# -----------------------------------------------------------------------------


# --- fixed values: normalisation before NFKC ---------------------------------
# Code points that count as white space, and code points that vanish.
SPACES = [0x09, 0x0A, 0x0C, 0x0D, 0x061C, 0x1680, 0x200B, 0x200C, 0x200E, 0x200F, 0x2028, 0x2029, 0x2581, 0xFEFF,
          0xFFFD]
REMOVED = [*range(0x01, 0x09), 0x0B, *range(0x0E, 0x20), 0x7F, 0x8F, 0x9F]
KEPT = "～"                # U+FF5E is not folded
# Unicode 16 letters and digits that older NFKC tables do not fold.
LETTER_S, OUTLINED_A, OUTLINED_0 = 0xA7F1, 0x1CCD6, 0x1CCF0
# -----------------------------------------------------------------------------
_BEFORE = {**dict.fromkeys(SPACES, " "), **dict.fromkeys(REMOVED), LETTER_S: "S",
           **{OUTLINED_A + i: chr(0x41 + i) for i in range(26)}, **{OUTLINED_0 + i: chr(0x30 + i) for i in range(10)}}


def normalize(text: str) -> str:
    """Controls dropped, white space runs to one ``▁``, NFKC, a ``▁`` before
    the first word; empty or blank text gives ``""``."""
    if not text:
        return ""
    folded = KEPT.join(unicodedata.normalize("NFKC", x) for x in text.translate(_BEFORE).split(KEPT))
    words = [w for w in folded.replace(WORD_START, " ").split(" ") if w]
    return WORD_START + WORD_START.join(words) if words else ""


def split_words(norm: str) -> list[str]:
    """Words of a normalised string, each starting with ``▁``."""
    if not norm:
        return []
    return [WORD_START + w for w in norm[1:].split(WORD_START)]


def piece_trie(pieces, values: dict | None = None) -> dict:
    """Character trie of the pieces (nested dicts; key ``None`` marks a
    piece end and holds the piece, or its value). Walking it finds every piece
    starting at a position without building a substring per candidate length."""
    root: dict = {}
    for p in pieces:
        node = root
        for ch in p:
            node = node.setdefault(ch, {})
        node[None] = values[p] if values else p
    return root


class Segmenter:
    """Best segmentation under piece log-probabilities, in double precision.

    Pieces never span a word boundary, so a line's best path is the
    concatenation of its words' best paths; words are solved once each and
    memoised. Of paths with equal scores the one whose last piece starts
    earliest wins (at every position). A character that no piece covers costs
    ``unk``; neighbouring unknown characters are one piece."""

    def __init__(self, scores: dict[str, float], max_len: int | None = None,
                 cache_size: int = 200_000):
        self.scores = scores
        self.max_len = min(max_len or 10 ** 9, max((len(p) for p in scores), default=1))
        self.trie = piece_trie(scores)
        self.unk = (min(scores.values()) if scores else 0.0) - UNK_PENALTY
        self.cache: dict[str, list[str]] = {}
        self.cache_size = cache_size

    def viterbi(self, word: str, without: str | None = None) -> list[str]:
        """The best path, optionally with one piece forbidden."""
        n, sc = len(word), self.scores
        best = [-math.inf] * (n + 1)
        back = [0] * (n + 1)
        known = [False] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            bi = best[i]
            single = False
            node = self.trie
            for e in range(i, min(n, i + self.max_len)):
                node = node.get(word[e])
                if node is None:
                    break
                piece = node.get(None)
                if piece is None or piece == without:
                    continue
                single = single or e == i
                v = bi + sc[piece]
                if v > best[e + 1]:
                    best[e + 1], back[e + 1], known[e + 1] = v, i, True
            if not single and bi + self.unk > best[i + 1]:
                best[i + 1], back[i + 1], known[i + 1] = bi + self.unk, i, False
        out, j, open_ = [], n, False
        while j > 0:
            i = back[j]
            if not known[j] and open_:
                out[-1] = word[i:j] + out[-1]
            else:
                out.append(word[i:j])
            open_ = not known[j]
            j = i
        return out[::-1]

    def word(self, w: str) -> list[str]:
        hit = self.cache.get(w)
        if hit is None:
            hit = self.viterbi(w)
            if len(self.cache) >= self.cache_size:
                self.cache.clear()
            self.cache[w] = hit
        return hit

    def line(self, text: str) -> list[str]:
        """Pieces of a line, or of a token between white space."""
        return [p for w in split_words(normalize(text)) for p in self.word(w)]


def unigram_encode(df: DataFrame, col: str, vocab: DataFrame, out_col: str = "pieces",
                   max_vocab: int = 1 << 20) -> DataFrame:
    """a line column to unigram pieces (``ARRAY<STRING>``).

    Lines are cut at plain white space natively; a task normalises and solves
    each distinct token of an Arrow batch once (and remembers it), and puts the
    lines together again with Arrow kernels. ``vocab(piece, score)`` is bounded
    by its declared size (checked) and broadcast; meta pieces are never matched.
    An empty or blank line gives an empty list, so line alignment holds; null
    stays null."""
    spark = df.sparkSession
    rows = vocab.select("piece", "score").limit(max_vocab + 1).collect()
    if len(rows) > max_vocab:
        raise ValueError(f"vocabulary larger than the broadcast bound {max_vocab}")
    scores = {r.piece: float(r.score) for r in rows if r.piece not in META_PIECES}
    bc = spark.sparkContext.broadcast(scores)
    enc = distinct_udf(lambda: Segmenter(bc.value).line, pa.string(), "array<string>")
    return df.withColumn(out_col, enc(_tokens(col)))


def _tokens(col: str):
    """A text cut at plain white space; runs of it leave empty tokens (a split
    at one sign needs no pattern)."""
    c = F.col(col)
    for s in "\t\n\r\f":
        c = F.replace(c, F.lit(s), F.lit(" "))
    return F.split(c, " ")


# ---------------------------------------------------------------- training
@dataclass
class UnigramModel:
    pieces: list[tuple[str, float]]   # normal pieces, best score first
    loglik: list[float]

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        rows = [(p, i, 0.0, "meta") for i, p in enumerate(META_PIECES)]
        rows += [(p, i + len(META_PIECES), s, "normal") for i, (p, s) in enumerate(self.pieces)]
        return spark.createDataFrame(rows, "piece string, id int, score double, kind string")


def word_histogram(lines: DataFrame, col: str = "line", by: list[str] = ()) -> DataFrame:
    """Normalised words with their counts (for each corpus named by the
    columns ``by``). Lines are cut at plain white space and counted natively
    first; only the distinct tokens are normalised."""
    raw = (lines.select(*by, F.explode(_tokens(col)).alias("t")).filter("t <> ''")
           .groupBy(*by, "t").agg(F.count(F.lit(1)).alias("n")))

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def _words(s: pd.Series) -> pd.Series:
        # Visible ASCII is its own normal form.
        return pd.Series([[WORD_START + t] if t.isascii() and t.isprintable() else split_words(normalize(t))
                          for t in s])

    return (raw.select(*by, F.explode(_words("t")).alias("word"), "n")
            .groupBy(*by, "word").agg(F.sum("n").alias("n")))


# Lengths up to which candidate substrings are counted in one round; the next
# round's are made of this round's frequent ones. Bits of its filter.
LEVELS = (5, 7, 10)
FILTER_BITS = 1 << 24
_FILTER_ROW = 1 << 15


def _window_hash(codes: np.ndarray, k: int) -> np.ndarray:
    """A hash below FILTER_BITS of every ``k`` consecutive code points (along
    the last axis)."""
    m = max(codes.shape[-1] - k + 1, 0)
    h = np.zeros((*codes.shape[:-1], m), np.uint64)
    for j in range(k):
        h = h * np.uint64(0x100000001B3) + codes[..., j:j + m].astype(np.uint64) + np.uint64(1)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(FILTER_BITS)).astype(np.int64)


# Distinct substrings a task counts before it sends them.
TASK_PIECES = 400_000


def _substrings(words: DataFrame, low: int, high: int, known: np.ndarray | None) -> DataFrame:
    """Substrings of ``low`` to ``high`` characters with their counts in each
    task: ``(g, piece, at, n)``, ``at`` a hash of those of ``high`` characters.
    With ``known``, the bits of frequent substrings one shorter than ``low``,
    only those all of whose parts of that length have their bits set (others
    cannot be frequent)."""
    bc = words.sparkSession.sparkContext.broadcast(known)
    fields = pa.schema([("g", pa.string()), ("piece", pa.string()), ("n", pa.int64()), ("at", pa.int32())])

    def reach(ws: list[str], k: int) -> list[int]:
        """How many known windows of k characters follow each other, from
        every place of the joined words on."""
        codes = np.frombuffer("".join(ws).encode("utf-32-le"), np.uint32)
        h = _window_hash(codes, k)
        ok = np.zeros(len(codes) + 1, bool)
        ok[:len(h)] = (bc.value[h >> 3] >> (h & 7).astype(np.uint8)) & 1
        stop = np.where(~ok, np.arange(len(ok)), len(ok))
        return (np.minimum.accumulate(stop[::-1])[::-1] - np.arange(len(ok))).tolist()

    def rows(sums: dict[str, dict[str, int]]) -> Iterator[pa.RecordBatch]:
        for g, counts in sums.items():
            pieces = list(counts)
            at = np.full(len(pieces), -1, np.int32)
            long = np.flatnonzero(np.fromiter(map(len, pieces), np.int64, len(pieces)) == high)
            if len(long):
                codes = np.frombuffer("".join([pieces[i] for i in long]).encode("utf-32-le"), np.uint32)
                at[long] = _window_hash(codes.reshape(-1, high), high)[:, 0]
            yield pa.RecordBatch.from_arrays([pa.array([g] * len(pieces), pa.string()), pa.array(pieces, pa.string()),
                                              pa.array(list(counts.values()), pa.int64()), pa.array(at)], schema=fields)
        sums.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, dict[str, int]] = {}
        for b in batches:
            gs, ws, ns = (c.to_pylist() for c in b.columns)
            far = reach(ws, low - 1) if bc.value is not None else None
            at = 0
            for g, w, n in zip(gs, ws, ns):
                counts = sums.setdefault(g, {})
                get = counts.get
                m = len(w)
                for i in range(m - low + 1):
                    most = min(m, i + high)
                    if far is not None:
                        most = min(most, i + far[at + i] + low - 2)
                    for e in range(i + low, most + 1):
                        p = w[i:e]
                        counts[p] = get(p, 0) + n
                at += m
            if sum(map(len, sums.values())) >= TASK_PIECES:
                yield from rows(sums)
        yield from rows(sums)

    return words.select("g", "word", "n").mapInArrow(run, "g string, piece string, n long, at int")


def seed_pieces(words: DataFrame, max_len: int, by: str | None = None, levels: tuple = LEVELS,
                is_stored: bool = False) -> DataFrame:
    """Every substring (up to ``max_len`` characters) of every word, with its
    count weighted by word frequency (in each corpus of the text column
    ``by``). Longer pieces that occur once are no candidates.

    Counted in rounds of growing length: a substring can only be frequent if
    all its parts are, so a round looks at places where parts that the round
    before found frequent follow each other. They are known by a bitmap of
    fixed size; a bit set by chance lets a substring be counted that then
    proves too rare. Every round reads the words, so they are stored first
    unless they come from a table (``is_stored``)."""
    src = words.filter(F.length("word") > 0).select(
        (F.col(by) if by else F.lit("")).alias("g"), "word", F.col("n").cast("long").alias("n"))
    if not is_stored:
        src = stored(spread(src), "unigram-words")
    rounds = sorted({min(x, max_len) for x in (*levels, max_len)})
    out, low, known = None, 1, None
    for high in rounds:
        found = stored(_substrings(src, low, high, known).groupBy("g", "piece").agg(
            F.sum("n").alias("freq"), F.max("at").alias("at")).filter(
            (F.col("freq") > 1) | (F.length("piece") == 1)), "unigram-seeds")
        part = found.select("g", "piece", "freq")
        out = part if out is None else out.unionByName(part)
        if high == max_len:
            break
        bits = found.filter("at >= 0").select(F.expr(f"at div {_FILTER_ROW}").alias("r"),
                                              F.expr(f"cast(at % {_FILTER_ROW} as bigint)").alias("bit"))
        rows = bits.groupBy("r").agg(F.bitmap_construct_agg("bit").alias("m")).collect()
        if not rows:
            break
        known = np.zeros(FILTER_BITS // 8, np.uint8)
        for r in rows:
            known[r.r * _FILTER_ROW // 8:(r.r + 1) * _FILTER_ROW // 8] = np.frombuffer(bytes(r.m), np.uint8)
        low = high + 1
    return out.withColumnRenamed("g", by) if by else out.drop("g")


# Stands for characters that coverage leaves out; it has no piece.
UNCOVERED = "▅"


def covered_characters(counts: dict[str, int], coverage: float) -> set[str]:
    """The most frequent characters (ties by code point), taken while those
    before them make up less than ``coverage`` of all characters."""
    total, before, out = sum(counts.values()), 0, set()
    for c, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        if before / total >= coverage:
            break
        out.add(c)
        before += n
    return out


def _normalise_scores(counts: dict[str, int], keep) -> dict[str, float]:
    """Log shares, in piece order (counts are integers, so sums are exact)."""
    keep = sorted(keep)
    total = sum(counts.get(p, 0) for p in keep)
    least = max(1, total // 10 ** 12)
    return {p: math.log(max(counts.get(p, 0), least)) - math.log(total) for p in keep}


class _Training:
    """Candidates of one corpus: numbers in the global score array, present
    scores, and what must stay."""

    def __init__(self, cand: dict[str, int], required: set[str], first: int, target: int):
        self.ids = {p: first + i for i, p in enumerate(sorted(cand))}
        self.scores = _normalise_scores(cand, cand)
        self.required, self.target = required, target
        self.unknown = first + len(self.ids)      # the number of unknown characters
        self.history: list[float] = []

    def put(self, score: np.ndarray) -> None:
        score[self.unknown - len(self.ids):self.unknown] = lattice.NONE
        for p, s in self.scores.items():
            score[self.ids[p]] = s
        score[self.unknown] = min(self.scores.values()) - UNK_PENALTY

    def counts(self, by_id: dict[int, int]) -> dict[str, int]:
        return {p: by_id.get(self.ids[p], 0) for p in self.scores}

    def model(self, hard: bool) -> UnigramModel:
        if hard and len(self.scores) < self.target:
            raise ValueError(f"vocabulary size {self.target + len(META_PIECES)} is too large for this corpus: "
                             f"training ended with {len(self.scores) + len(META_PIECES)} pieces")
        return UnigramModel(sorted(self.scores.items(), key=lambda kv: (-kv[1], kv[0])), self.history)


def unigram_train_each(lines: DataFrame, group_col: str, vocab_size: int = 32000, col: str = "line",
                       max_piece_len: int = 16, seed_factor: int = 10, em_iters: int = 2, shrink: float = 0.75,
                       character_coverage: float = 1.0, hard_vocab_limit: bool = True,
                       partitions: int | None = None) -> dict[str, UnigramModel]:
    """A5 for several corpora at once: a unigram vocabulary of ``vocab_size``
    pieces (meta pieces included) for each value of ``group_col`` (as text;
    null is no corpus).

    Seeds: the most frequent substrings (frequency x length); all characters
    inside ``character_coverage`` are always kept, others are unknown. Then
    rounds of ``em_iters`` EM steps followed by pruning the pieces whose removal
    costs the least likelihood, until the target size. Every step is one job
    for all corpora that are still above theirs; those that are done leave. A
    corpus that cannot give so many pieces is an error, or with
    ``hard_vocab_limit=False`` gets as many as it gives.
    ``seed_factor`` bounds the candidates the driver holds for each corpus (a
    larger one changes little: the least useful seeds are pruned first)."""
    spark = lines.sparkSession
    checkpoint_dir(spark)
    target = vocab_size - len(META_PIECES)
    if target <= 0:
        raise ValueError("vocab_size must exceed the number of meta pieces")
    named = lines.filter(F.col(group_col).isNotNull()).select(F.col(group_col).cast("string").alias("g"),
                                                              F.col(col).alias("line"))
    # AQE may coalesce a small aggregate into one partition; the passes are
    # CPU-bound, so spread the word table over all cores.
    words = stored(spread(word_histogram(named, "line", ["g"]), partitions), "unigram-words")
    chars: dict[str, dict[str, int]] = {}
    for r in words.select("g", F.explode(F.split("word", "")).alias("c"), "n").groupBy("g", "c").agg(
            F.sum("n").alias("n")).filter("c <> ''").collect():
        chars.setdefault(r.g, {})[r.c] = int(r.n)
    if character_coverage < 1.0:
        kept = {g: covered_characters(c, character_coverage) - {UNCOVERED} for g, c in chars.items()}
        words = stored(spread(_covered(words, kept), partitions), "unigram-words")
        chars = {g: {x: n for x, n in c.items() if x in kept[g]} for g, c in chars.items()}
    for g, c in chars.items():
        if len(c) > target:
            raise ValueError(f"vocabulary size {vocab_size} cannot hold all {len(c)} characters")
    seeds = seed_pieces(words, max_piece_len, "g", is_stored=True).filter(F.length("piece") > 1)
    if character_coverage < 1.0:
        seeds = seeds.filter(~F.col("piece").contains(UNCOVERED))
    seeds = stored(seeds, "unigram-seeds")
    todo: dict[str, _Training] = {}
    first = 0
    for g in sorted(chars):
        top = (seeds.filter(F.col("g") == g).orderBy(F.desc(F.col("freq") * F.length("piece")), F.asc("piece"))
               .limit(target * seed_factor).collect())
        if hard_vocab_limit and len(chars[g]) + len(top) < target:
            raise ValueError(f"vocabulary size {vocab_size} is too large for this corpus: at most "
                             f"{len(chars[g]) + len(top) + len(META_PIECES)} pieces can be formed")
        cand = {**chars[g], **{r.piece: int(r.freq) for r in top}}
        todo[g] = _Training(cand, set(chars[g]), first, target)
        first = todo[g].unknown + 1
    if not todo:
        return {}
    blocks = stored_large_rows(lattice.build(words, {g: piece_trie(t.ids, t.ids) for g, t in todo.items()},
                                             {g: t.unknown for g, t in todo.items()}), "unigram-lattices")
    score = np.full(first, lattice.NONE)
    models: dict[str, UnigramModel] = {}
    while todo:
        left = blocks.filter(F.col("g").isin(list(todo)))
        for _ in range(em_iters):
            for t in todo.values():
                t.put(score)
            by_id, ll = lattice.count(left, score)
            for g, t in todo.items():
                t.history.append(ll.get(g, 0.0))
                counts = t.counts(by_id)
                keep = [p for p in t.scores if counts[p] > 0 or p in t.required]
                t.scores = _normalise_scores(counts, keep)
        for g in [g for g, t in todo.items() if len(t.scores) <= target]:
            models[g] = todo.pop(g).model(hard_vocab_limit)
        if todo:
            for t in todo.values():
                t.put(score)
            by_id, _ = lattice.count(blocks.filter(F.col("g").isin(list(todo))), score, viterbi=True)
            _prune(spark, todo, by_id, shrink)
    return models


def unigram_train(lines: DataFrame, vocab_size: int = 32000, col: str = "line", **options) -> UnigramModel:
    """A5: learn a unigram vocabulary; the one corpus of
    :func:`unigram_train_each`."""
    one = lines.select(F.lit("all").alias("g"), F.col(col).alias("line"))
    models = unigram_train_each(one, "g", vocab_size, "line", **options)
    if not models:
        raise ValueError(f"vocabulary size {vocab_size} is too large for an empty corpus")
    return models["all"]


def _covered(words: DataFrame, kept: dict[str, set[str]]) -> DataFrame:
    """The word table with the characters outside ``kept`` (bounded by
    Unicode) as one stand-in."""
    bc = words.sparkSession.sparkContext.broadcast(kept)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["word"] = ["".join([c if c in bc.value[g] else UNCOVERED for c in w])
                           for g, w in zip(pdf["g"], pdf["word"])]
            yield pdf

    return words.select("g", "word", "n").mapInPandas(run, "g string, word string, n long").groupBy(
        "g", "word").agg(F.sum("n").alias("n"))


def _prune(spark: SparkSession, todo: dict[str, _Training], by_id: dict[int, int], shrink: float) -> None:
    """Keep a share of each corpus's pieces: required characters, pieces
    without an alternative segmentation, then by the likelihood lost when a
    piece's best-path count moves to its alternative segmentation. The
    alternatives are found beside the candidate table, not on the driver."""
    counts = {g: t.counts(by_id) for g, t in todo.items()}
    bc = spark.sparkContext.broadcast({g: (t.scores, counts[g], sum(counts[g].values())) for g, t in todo.items()})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segs: dict[str, Segmenter] = {}
        for pdf in batches:
            loss = []
            for g, p in zip(pdf["g"], pdf["piece"]):
                sc, cnt, tot = bc.value[g]
                if g not in segs:
                    segs[g] = Segmenter(sc)
                f, alt = cnt[p], segs[g].viterbi(p, without=p)
                if len(alt) <= 1:
                    loss.append(math.inf)
                    continue
                after = math.log(tot + f * (len(alt) - 1))
                lost = math.log(f) - math.log(tot) - sum(math.log(cnt.get(a, 0) + f) for a in alt) + len(alt) * after
                loss.append(f / tot * lost)
            yield pd.DataFrame({"g": pdf["g"], "piece": pdf["piece"], "loss": loss})

    used = [(g, p) for g, t in todo.items() for p in t.scores if p not in t.required and counts[g][p] > 0]
    ranked: dict[str, list] = {g: [] for g in todo}
    if used:
        table = spread(spark.createDataFrame(used, "g string, piece string"))
        for r in table.mapInPandas(run, "g string, piece string, loss double").collect():
            ranked[r.g].append((-r.loss, r.piece))
    bc.destroy()
    for g, t in todo.items():
        fixed = sorted(t.required & set(t.scores))
        room = max(0, max(t.target, int(len(t.scores) * shrink)) - len(fixed))
        keep = {*fixed, *(p for _, p in sorted(ranked[g])[:room])}
        t.scores = {p: t.scores[p] for p in sorted(keep)}
