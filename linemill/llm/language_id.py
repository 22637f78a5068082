"""Language by compression: a text is compressed with one zstandard
raw-content dictionary per language, and the smallest result names it. Blocks
of the text are compressed apart, each from the dictionary alone, so that what
a dictionary saves grows with the text."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import learning_rows, text_pass

# The learning sample: at most this many texts a language, of which at most
# this many bytes become its dictionary.
TEXTS_PER_LANGUAGE = 96
DICTIONARY_BYTES = 65_536
# Where the two smallest sizes differ by less than this share, the text is
# rejected.
MIN_MARGIN = 0.002
# Bytes of text compressed at once, from the dictionary alone.
BLOCK_BYTES = 8_192
UNKNOWN = "und"


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          texts: int = TEXTS_PER_LANGUAGE, size: int = DICTIONARY_BYTES) -> list[tuple[str, bytes]]:
    """(language, dictionary) in order of falling frequency among the rows of
    ``df`` with text and language. The sample is bounded and repeatable: texts
    of at most ``size`` bytes of the ids with the smallest hash, one text an id
    and language (the smallest) however often they are repeated; the counts
    cover all rows. A language all of whose texts are longer gets no dictionary
    and is never predicted."""
    rows = df.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{lang_col}`").alias("l"),
                     F.octet_length(F.col(f"`{text_col}`")).alias("n")).filter("l is not null and n > 0")
    order = [r["l"] for r in rows.groupBy("l").count().orderBy(F.desc("count"), "l").collect()]
    picked = learning_rows(rows.filter(F.col("n") <= size).select("i", "l").distinct(), "i", "language", texts, "l")
    got = df.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t"),
                    F.col(f"`{lang_col}`").alias("l")).join(
        F.broadcast(picked), ["i", "l"]).filter((F.octet_length("t") <= size) & (F.octet_length("t") > 0)).groupBy(
        "i", "l").agg(F.min("t").alias("t")).orderBy(F.xxhash64(F.col("i").cast("string")), "t").collect()
    out = []
    for lang in order:
        buf, seen = b"", set()
        for r in got:
            t = r["t"].lower().encode("utf-8", "surrogatepass")
            if r["l"] == lang and t not in seen and len(buf) + len(t) < size:
                seen.add(t)
                buf += t + b"\n"
        if len(buf) >= 8:              # the library's least dictionary
            out.append((lang, buf))
    return out


class Classifier:
    """Compressors of one task."""

    def __init__(self, model: list[tuple[str, bytes]]):
        import zstandard as z
        self.langs = [lang for lang, _ in model]
        par = z.ZstdCompressionParameters(
            compression_level=9, min_match=3, strategy=z.STRATEGY_BTOPT,
            write_content_size=0, write_checksum=0, write_dict_id=0)
        self.comp = []
        for _, d in model:
            # Digested once: each text then starts from the dictionary's tables.
            words = z.ZstdCompressionDict(d, dict_type=z.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(compression_params=par)
            self.comp.append(z.ZstdCompressor(dict_data=words, compression_params=par))

    def __call__(self, text: bytes) -> tuple[str, float, float]:
        """(language, score, margin)."""
        s = text.decode("utf-8", "replace").lower()
        if not self.comp or not any(map(str.isalpha, s)):
            return UNKNOWN, 0.0, 0.0
        low = s.encode("utf-8")
        blocks = [low[i:i + BLOCK_BYTES] for i in range(0, len(low), BLOCK_BYTES)]
        n = np.array([sum(len(c.compress(b)) for b in blocks) for c in self.comp], np.float64)
        best = int(n.argmin())                 # ties: the more frequent language
        rest = np.delete(n, best)
        if not len(rest):
            return self.langs[best], 1.0, 1.0
        # Bytes saved against each rival, as odds.
        score = 1.0 / (1.0 + np.exp2(-np.minimum(rest - n[best], 1000.0)).sum())
        return self.langs[best], float(score), float((rest.min() - n[best]) / rest.min())


def identify(df: DataFrame, model: list[tuple[str, bytes]], text_col: str = "text",
             min_margin: float = MIN_MARGIN, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all but the text) plus ``lang_pred``,
    ``score`` (0 to 1), ``margin`` and ``rejected``.

    Whole texts are compressed, lower-cased, in blocks of ``BLOCK_BYTES``.
    ``und`` (score 0, rejected): the text is null, empty or without letters, or
    nothing was learnt. Ties go to the language with more learning rows and are
    rejected. Repeated rows each give a row; an empty table gives none; kept
    columns whose names clash with new ones go. The model is broadcast: one
    dictionary of bounded size a language."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        f = Classifier(shared.value)

        def each(texts):
            got = [f(t) for t in texts]
            return [[g[0] for g in got], [g[1] for g in got], [g[2] for g in got],
                    [g[0] == UNKNOWN or g[2] < min_margin for g in got]]
        return each
    return text_pass(df, text_col, [T.StructField("lang_pred", T.StringType()),
                                    T.StructField("score", T.DoubleType()),
                                    T.StructField("margin", T.DoubleType()),
                                    T.StructField("rejected", T.BooleanType())], make, keep)
