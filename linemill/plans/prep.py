"""The reference's corpus preparation flow as composed DataFrame plans.

Each function strings together operators the way the preparation script
strings together its tools, but as one lazy plan per step, so Catalyst can
prune columns and push filters through the whole chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.clean import tag_language
from ..operators.order import aligned_shuffle
from ..operators.splits import append_to_split, concat_corpora, concat_ordered, hold_out, split_quota
from ..operators.stats import count_blank_lines
from ..operators.unigram import UnigramModel, unigram_encode, unigram_train_each
from ..sources.archives import read_segments

KEYS = ["pair", "doc_no", "line_no"]


def split_parallel(bitext: DataFrame, dev: int = 2500, test: int = 2500,
                   quality: Column | None = None, seed=42) -> DataFrame:
    """Quota split per pair (Q1), then an aligned shuffle inside every
    (pair, split) (O1): ``bitext`` plus ``split`` and ``shuf_rank``."""
    s = split_quota(bitext, KEYS, dev=dev, test=test, quality=quality, seed=seed)
    return aligned_shuffle(s, KEYS, seed, group_cols=["pair", "split"])


def blank_report(bitext: DataFrame) -> DataFrame:
    """A1 on both sides of every (pair, split)."""
    sides = bitext.select("pair", "split", F.inline(F.array(
        F.struct(F.lit("src").alias("side"), F.col("src").alias("line")),
        F.struct(F.lit("tgt").alias("side"), F.col("tgt").alias("line")))))
    return count_blank_lines(sides, ["pair", "split", "side"])


# whole lines holding "</hl" or ending in "<hl>", with their line break; only
# LF ends a line (flag d), as for sed
HEADLINE_LINES = r"(?md)^(?:[^\n]*</hl[^\n]*|[^\n]*<hl>)(?:\n|$)"


def clean_segment_file(docs: DataFrame, xml_col: str = "xml", doc_col: str = "doc_id",
                       headline_files: Column | None = None, on_empty: str = "blank") -> DataFrame:
    """P1 -> P2 -> P3 -> S4 -> P4 -> P3 inverse on SGM documents, one row per
    document and no grouping: CRLF to LF, headline-tag lines deleted (only
    where ``headline_files`` holds, as ``sed '/.../d'``), bare ampersands
    protected for the XML parser and restored in the extracted text."""
    x = X.normalize_newlines(xml_col)
    if headline_files is not None:
        x = F.when(headline_files, F.regexp_replace(x, HEADLINE_LINES, "")).otherwise(x)
    protected = docs.select(doc_col, X.protect_amp(x).alias(xml_col))
    segs = read_segments(protected, xml_col, doc_col, on_empty)   # text is stripped (P4)
    return segs.withColumn("text", X.restore_amp("text"))


def add_news_dev(split_bitext: DataFrame, news: DataFrame, holdout: Column,
                 holdout_name: str = "newstest2018", seed=42) -> DataFrame:
    """Hold out one news set as its own split (Q2), append the other news
    dev sets to train (U2) and reshuffle every (pair, split) (O1)."""
    n = hold_out(news.withColumn("split", F.lit("dev")), holdout, holdout_name)
    held = n.filter(F.col("split") == holdout_name)
    extra = n.filter(F.col("split") != holdout_name).drop("split")
    base = split_parallel_drop_rank(split_bitext)
    grown = append_to_split(base, extra, "train").unionByName(held, allowMissingColumns=True)
    return aligned_shuffle(grown, KEYS, seed, group_cols=["pair", "split"])


def split_parallel_drop_rank(df: DataFrame) -> DataFrame:
    return df.drop("shuf_rank") if "shuf_rank" in df.columns else df


def corpus_lines(bitext: DataFrame, grouping: str) -> DataFrame:
    """The lines each vocabulary is learnt on (``pair``, ``multilingual``
    or ``language``), duplicates kept."""
    return concat_corpora(bitext, grouping)


def learn_vocabularies(bitext: DataFrame, grouping: str, vocab_size: int = 32000,
                       **train_args) -> dict[str, UnigramModel]:
    """U1 -> A5 for every corpus of a grouping (one model per pair, one
    multilingual model, or one per language), all in one job."""
    return unigram_train_each(corpus_lines(bitext, grouping), "corpus", vocab_size, **train_args)


def encode_sides(bitext: DataFrame, model: UnigramModel, tgt_model: UnigramModel | None = None) -> DataFrame:
    """F3 -> F4 on both sides, with one model or one for each: ``src_sp`` and
    ``tgt_sp`` piece strings."""
    spark = bitext.sparkSession
    e = unigram_encode(bitext, "src", model.vocab_df(spark), "_sp_src")
    e = unigram_encode(e, "tgt", (tgt_model or model).vocab_df(spark), "_sp_tgt")
    return e.withColumn("src_sp", X.join_pieces("_sp_src")).withColumn(
        "tgt_sp", X.join_pieces("_sp_tgt")).drop("_sp_src", "_sp_tgt")


def encode_monolingual(sides: DataFrame, models: dict[str, UnigramModel], line_col: str = "line",
                       lang_col: str = "lang") -> DataFrame:
    """F3 -> F4 on lines of several languages, each with its own language's
    model: ``line_sp``. One branch per language of ``models`` (few, named);
    lines of other languages drop out."""
    out = None
    for lang, model in sorted(models.items()):
        part = unigram_encode(sides.filter(F.col(lang_col) == lang), line_col,
                              model.vocab_df(sides.sparkSession), "_sp")
        out = part if out is None else out.unionByName(part)
    return out.withColumn(line_col + "_sp", X.join_pieces("_sp")).drop("_sp")


def multilingual_dev(encoded_dev: DataFrame, pair_order: list[str],
                     tag_first: bool = True) -> DataFrame:
    """U3 + P5: dev sets of all pairs concatenated in ``pair_order`` with the
    English side tagged ``<2xx>``. The reference builds the concatenation
    before tagging, which leaves it untagged; ``tag_first=False`` keeps that."""
    parts = concat_ordered(encoded_dev, pair_order)
    if tag_first:
        parts = tag_language(parts, "src_sp", out_col="src_sp")
    return parts
