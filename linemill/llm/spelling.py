"""Spelling variants: words one edit apart, by composing finite automata.

The vocabulary is a minimised acyclic acceptor; composed with a transducer
that copies its input but for exactly one inserted, deleted or replaced
character, and with the acceptor again, it accepts the pairs of near words. No
task holds the whole vocabulary. A pair that shares its first letters starts,
in both acceptors, at the state behind them; a pair that differs in the first
letters shares the last ones. So the words are dealt out by their first and by
their last ``CUT`` characters, and each group's automaton (of the characters
between) is composed and enumerated by itself.

A group too large for a task is dealt out again by one more character, on
either side: pairs whose edit comes later share the next character, pairs whose
edit is at the next character share the one before the group's last ones. A
composed path's edit is taken at the first difference of the two words, so
every pair is found in one group only.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, fold_pass, pieces, stored

MIN_LENGTH = 6
MIN_COUNT = 5
# A near word is a word's form if it is at least this many times as frequent.
RATIO = 5
# A run loses a character where this divides its hash.
DROP_MOD = 199
# Characters a group shares at first; twice this must not exceed MIN_LENGTH.
CUT = 3
# Characters of a group that is not dealt out again, and words that never are.
GROUP_CHARS = 400_000
GROUP_WORDS = 256
# Distinct words a task counts before it sends them.
TASK_WORDS = 200_000
ANY = 1 << 30
_BORDER = re.compile(rb"[\x00-\x40]")


def _runs(min_length: int) -> re.Pattern:
    # Fixed value: runs of these characters are words.
    return re.compile("[a-zÀ-ÿ]{%d,}" % min_length)


def word_counts(df: DataFrame, id_col: str, text_col: str, min_length: int = MIN_LENGTH,
                drop_mod: int | None = DROP_MOD) -> DataFrame:
    """``(word, n)``: runs of letters of the whole texts with A to Z in lower
    case, counted over all rows. With ``drop_mod``, a run whose CRC-32 of
    ``<id>:<run>`` it divides loses the character at that hash modulo its
    length. Words shorter than ``min_length`` are left out."""
    src = df.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("_id"),
                    F.col(f"`{text_col}`").alias("_t"))

    def make():
        find, counts = _runs(min_length).findall, {}

        def send():
            out = [list(counts.keys()), list(counts.values())]
            counts.clear()
            return out

        def feed(texts, ids):
            for t, i in zip(texts, ids):
                start = zlib.crc32(i.encode() + b":")
                for p in pieces(t, SLICE_BYTES, _BORDER):
                    for run, n in Counter(find(p.lower().decode("utf-8", "replace"))).items():
                        if drop_mod:
                            h = zlib.crc32(run.encode(), start)
                            if not h % drop_mod:
                                k = h % len(run)
                                run = run[:k] + run[k + 1:]
                                if len(run) < min_length:
                                    continue
                        counts[run] = counts.get(run, 0) + n
            return send() if len(counts) >= TASK_WORDS else None

        return feed, lambda: send() if counts else None
    return fold_pass(src, "_t", "word string, n long", make, ["_id"]).groupBy("word").agg(F.sum("n").alias("n"))


def acceptor(words: list[str]) -> tuple[list[dict], list[bool]]:
    """The minimal acyclic acceptor of sorted distinct words: transitions and
    finality of each state; state 0 is the start. Words are added in order and
    the branch that no later word can change is merged with equal states."""
    edges: list[dict] = [{}]
    final = [False]
    known: dict[tuple, int] = {}
    path: list[tuple[int, str, int]] = []     # (state, character, next state) of the last word
    last = ""

    def settle(depth: int) -> None:
        while len(path) > depth:
            s, c, t = path.pop()
            # States below t are settled, so their numbers name their languages.
            edges[s][c] = known.setdefault((final[t], *sorted(edges[t].items())), t)

    for w in words:
        d, n = 0, min(len(w), len(last))
        while d < n and w[d] == last[d]:
            d += 1
        settle(d)
        s = path[-1][2] if path else 0
        for c in w[d:]:
            edges.append({})
            final.append(False)
            edges[s][c] = t = len(edges) - 1
            path.append((s, c, t))
            s = t
        final[s] = True
        last = w
    settle(0)
    return edges, final


def _both(edges: list[dict], final: list[bool], p: int, q: int, but: str | None = None) -> Iterator[str]:
    """Strings that lead from ``p`` and from ``q`` to final states: the part of
    the composition behind the edit. With ``but``, strings that begin with
    that character are left out."""
    path: list[str] = []
    todo = [(p, q, 0, "")]
    while todo:
        p, q, d, c = todo.pop()
        if d:
            del path[d - 1:]
            path.append(c)
        if final[p] and final[q]:
            yield "".join(path)
        x, y = edges[p], edges[q]
        if len(x) > len(y):
            x, y = y, x
        for c in x:
            if c in y and not (d == 0 and c == but):
                todo.append((x[c], y[c], d + 1, c))


def near_pairs(words: list[str], edits: int = ANY, follow: str = "") -> Iterator[tuple[str, str]]:
    """Pairs of the distinct words that are one edit apart, each once, whose
    first difference is among the first ``edits`` characters. ``follow`` is
    the character that comes behind every word: a word that ends where the
    other has this character differs from it only later."""
    edges, final = acceptor(sorted(words))
    path: list[str] = []
    todo = [(0, 0, "")]
    while todo:
        q, d, c = todo.pop()
        if d:
            del path[d - 1:]
            path.append(c)
        if d >= edits:
            continue
        out = edges[q]
        if out:
            head = "".join(path)
            letters = list(out)
            for i, a in enumerate(letters):
                for x in _both(edges, final, out[a], q, a):           # a deleted
                    if x or a != follow:
                        yield head + a + x, head + x
                for b in letters[:i]:                                 # a replaced by b
                    for x in _both(edges, final, out[a], out[b]):
                        yield head + a + x, head + b + x
            for c in letters:
                todo.append((out[c], d + 1, c))


def _groups(words: DataFrame, group_chars: int, group_words: int) -> DataFrame:
    """Rows ``(l, r, e, key, word, n)``: words that share their first ``l`` and
    last ``r`` characters and whose pairs differ first within ``e`` characters
    behind the ``l``; no group is larger than the two limits."""
    key = F.concat(F.substring("word", F.lit(1), F.col("l")),
                   F.expr("substring(word, length(word) - r + 1, r)"))
    left = words.withColumns({"l": F.lit(CUT), "r": F.lit(0), "e": F.lit(ANY)})
    right = words.withColumns({"l": F.lit(0), "r": F.lit(CUT), "e": F.lit(CUT)})
    rows = stored(left.unionByName(right).withColumn("key", key), "spelling-groups")
    by, done = ["l", "r", "e", "key"], []
    while True:
        # At most rows / group_words groups can be large, in practice far fewer.
        large = stored(rows.groupBy(*by).agg(F.count("*").alias("c"), F.sum(F.length("word")).alias("s"))
                       .filter((F.col("s") > group_chars) & (F.col("c") > group_words)).select(*by),
                       "spelling-large")
        if large.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(large, by, "left_anti"))
        again = rows.join(large, by, "left_semi")
        middle = F.length("word") - F.col("l") - F.col("r")
        done.append(again.filter(middle <= 1))        # at most one word for each character, and one
        again = again.filter(middle >= 1)
        later = again.filter("e > 1").withColumns({"l": F.col("l") + 1, "e": F.when(
            F.col("e") < ANY, F.col("e") - 1).otherwise(ANY)})
        here = again.withColumns({"r": F.col("r") + 1, "e": F.lit(1)})
        rows = stored(later.unionByName(here).withColumn("key", key), "spelling-groups")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _enumerate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each group of rows; groups are contiguous."""
    now, words, ready = None, {}, []

    def pairs():
        l, r, e, key = now
        middle = {w[l:len(w) - r]: w for w in words}
        for a, b in near_pairs(list(middle), e, key[l:l + 1]):
            a, b = middle[a], middle[b]
            ready.append((a, words[a], b, words[b]))
            ready.append((b, words[b], a, words[a]))

    def batch():
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*ready), (pa.string(), pa.int64(), pa.string(), pa.int64()))], names=["word", "n", "near", "near_n"])
        ready.clear()
        return out

    for b in batches:
        for l, r, e, key, w, n in zip(*[c.to_pylist() for c in b.columns]):
            if (l, r, e, key) != now:
                if len(words) > 1:
                    pairs()
                    if len(ready) > 20_000:
                        yield batch()
                now, words = (l, r, e, key), {}
            words[w] = n
    if len(words) > 1:
        pairs()
    if ready:
        yield batch()


def near_words(words: DataFrame, group_chars: int = GROUP_CHARS, group_words: int = GROUP_WORDS) -> DataFrame:
    """Rows ``(word, n, near, near_n)`` for every ordered pair of the table
    ``(word, n)`` of distinct words that differ by one inserted, deleted or
    replaced character. Words need ``2 * CUT`` characters or more; shorter and
    null ones take no part. An empty table gives no rows."""
    rows = _groups(words.filter(F.length("word") >= 2 * CUT).select("word", F.col("n").cast("long").alias("n")),
                   group_chars, group_words)
    by = ["l", "r", "e", "key"]
    spark = words.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 2 * spark.sparkContext.defaultParallelism)
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType()),
                           T.StructField("near", T.StringType()), T.StructField("near_n", T.LongType())])
    return rows.select(*by, "word", "n").repartition(n, *by).sortWithinPartitions(*by).mapInArrow(_enumerate, schema)


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of words with a form. Forms are RATIO times as frequent, so
    a chain has no more than log(largest count) links: each round doubles the
    links followed, until none is left to follow."""
    links = stored(links.select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        on = links.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = stored(links.join(on, F.col("root") == F.col("at"), "left"), "spelling-links")
        if step.filter("next is not null").isEmpty():
            return links
        links = step.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT,
                      ratio: int = RATIO, min_length: int = MIN_LENGTH, drop_mod: int | None = DROP_MOD,
                      group_chars: int = GROUP_CHARS, group_words: int = GROUP_WORDS) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    Words are what :func:`word_counts` counts at least ``min_count`` times. A
    word's form is its most frequent near word (ties: smallest in code-point
    order) if that is at least ``ratio`` (above 1) times as frequent, else
    null; ``root`` is the end of the chain of forms, the word itself if it has
    none; ``n_near`` counts its near words.

    Null and empty texts have no words; a null id counts as empty text in the
    hash; rows that repeat an id or a text count again; an empty table gives
    no rows. Other columns, whatever their names, are not looked at.

    Plan: one pass over the text, words counted in the tasks; one aggregate of
    words; each word to two groups (more for words of large groups only), a
    task holding one group at a time; one aggregate of pairs; a join of words
    with their forms per doubling of the chains.
    """
    if min_length < 2 * CUT:
        raise ValueError(f"words need at least {2 * CUT} characters")
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    words = stored(word_counts(df, id_col, text_col, min_length, drop_mod).filter(F.col("n") >= min_count),
                   "spelling-words")
    best = near_words(words, group_chars, group_words).groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("b"))
    fits = -F.col("b.m") >= ratio * F.col("n")
    near = stored(best.select("word", "n_near", F.when(fits, F.col("b.w")).alias("form"),
                              F.when(fits, -F.col("b.m")).alias("form_n")), "spelling-near")
    roots = _roots(near.filter("form is not null"))
    out = words.join(near, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
