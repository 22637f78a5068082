"""Cleaning and tagging as DataFrame operators (P1–P7). Row-wise and
native, so they also run on streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X


def normalize_newlines(df: DataFrame, col: str) -> DataFrame:
    """CRLF to LF in ``col``."""
    return df.withColumn(col, X.normalize_newlines(col))


def drop_lines(df: DataFrame, col: str, where: Column | None = None,
               junk: Column | None = None) -> DataFrame:
    """Remove headline-tag lines (``</hl`` anywhere or ``<hl>`` at the end),
    only where ``where`` holds (the reference touches two files only)."""
    bad = junk if junk is not None else X.headline_junk(col)
    if where is not None:
        bad = where & bad
    return df.filter(~F.coalesce(bad, F.lit(False)))


def protect_amp(df: DataFrame, col: str) -> DataFrame:
    """P3 forward."""
    return df.withColumn(col, X.protect_amp(col))


def restore_amp(df: DataFrame, col: str) -> DataFrame:
    """P3 inverse."""
    return df.withColumn(col, X.restore_amp(col))


def strip_text(df: DataFrame, col: str) -> DataFrame:
    """Python-style strip."""
    return df.withColumn(col, X.strip_text(col))


def tag_language(bitext: DataFrame, src_col: str = "src", pair_col: str = "pair",
                 out_col: str = "src_tagged") -> DataFrame:
    """P5: prefix ``<2xx> `` to the English side by the pair's target language."""
    tgt_lang = F.substring(pair_col, 4, 8)
    return bitext.withColumn(out_col, X.tag_line(F.col(src_col), tgt_lang))


def tag_lines(lines: DataFrame, line_col: str = "line", lang_col: str = "lang",
              pair_col: str = "pair", side: str = "en") -> DataFrame:
    """P5 on a long lines table: tag the lines of language ``side`` only."""
    tgt_lang = F.substring(pair_col, 4, 8)
    return lines.withColumn(line_col, F.when(F.col(lang_col) == side,
                                             X.tag_line(F.col(line_col), tgt_lang))
                            .otherwise(F.col(line_col)))


def parse_corpus_name(df: DataFrame, name_col: str) -> DataFrame:
    """``pair``, ``split``, ``lang`` and ``encoded`` from a corpus file name."""
    return df.select("*", *[X.corpus_name_part(name_col, p).alias(p)
                            for p in ("pair", "split", "lang", "encoded")])


def frequency_vocab(hist: DataFrame, size: int, first_id: int = 5) -> DataFrame:
    """A word-level vocabulary: the ``size`` most frequent pre-tokens (ties by
    text), ids from ``first_id`` on. Bounded by ``size`` (a top-k), so it may be
    broadcast to encoders."""
    top = hist.orderBy(F.desc("n"), F.asc("pretoken")).limit(size)
    w = Window.orderBy(F.desc("n"), F.asc("pretoken"))  # over <= size rows only
    return top.select(F.col("pretoken").alias("piece"),
                      (F.row_number().over(w) + F.lit(first_id - 1)).cast("int").alias("id"), "n")


def vocab_pieces(vocab: DataFrame) -> DataFrame:
    """The piece column of a vocabulary, in id order (``cut -f1``)."""
    return vocab.select("id", "piece").orderBy("id")
