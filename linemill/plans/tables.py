"""Corpus tables derived from the given parquet tables.

A document stands for a corpus file, ``source`` for a corpus and ``src0``
for the 2018 news hold-out; the non-English languages stand for the pairs
``en-xx``. Every table here has a DuckDB twin in :mod:`linemill.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import split_lines
from ..operators.ranks import global_rank

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Bucket width for ranks ordered by an integer id: ids are dense, so a
# bucket of 4096 consecutive ids bounds each window partition.
ID_BUCKET = 4096


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, as its files are split."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def explode_text(df: DataFrame, text_col: str = "text", keep=("doc_id", "lang", "source"),
                 newline: str = "lf") -> DataFrame:
    """One row per line of a text column, numbered from 0 inside each row."""
    return df.select(*keep, F.posexplode(split_lines(F.col(text_col), newline)).alias(
        "line_no", "line")).withColumn("line_no", F.col("line_no").cast("long")).select(
        *keep, "line_no", "line")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lines(doc_id, lang, source, line_no, line)`` — every line of every document."""
    return explode_text(documents(spark, sf_dir))


def lines_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with hash-chosen damage: blanks, CR, padding, bare ampersands, headline tags."""
    ln = lines(spark, sf_dir)
    h = F.substring(F.md5(F.concat_ws(":", F.lit("d"), "doc_id", "line_no")), 1, 1)
    line = (F.when(h == "0", F.lit(""))
            .when(h == "1", F.concat("line", F.lit("\r")))
            .when(h == "2", F.concat(F.lit("  "), "line", F.lit("\t")))
            .when(h == "3", F.concat(F.lit("a & b &amp; "), "line"))
            .when(h == "4", F.concat("line", F.lit("<hl>")))
            .when(h == "5", F.concat(F.lit("</hl "), "line"))
            .otherwise(F.col("line")))
    return ln.withColumn("line", line)


def ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with ``doc_no``: 1-based position of the document within its language."""
    docs = documents(spark, sf_dir)
    return global_rank(docs, ["doc_id"], F.floor(F.col("doc_id") / ID_BUCKET),
                       group_cols=["lang"], rank_col="doc_no")


def bitext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bitext(pair, doc_no, line_no, source, src, tgt)``: the n-th English
    document is aligned line by line with the n-th document of each other
    language (J1 applied to the derived corpora)."""
    from ..operators.joins import zip_parallel
    k = explode_text(ranked_documents(spark, sf_dir), keep=("doc_id", "lang", "source", "doc_no"))
    src = k.filter(F.col("lang") == "en").select("doc_no", "line_no", "source",
                                                 F.col("line").alias("src"))
    tgt = k.filter(F.col("lang") != "en").select(
        F.concat(F.lit("en-"), "lang").alias("pair"), "doc_no", "line_no",
        F.col("line").alias("tgt"))
    return zip_parallel(src, tgt, ["doc_no", "line_no"], strict=False).select(
        "pair", "doc_no", "line_no", "source", "src", "tgt")


def segment_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``segment_docs(doc_id, xml)``: each document as an SGM file, one
    ``<seg>`` per line. Built per row (no grouping): a document is one value."""
    docs = documents(spark, sf_dir)
    segs = F.transform(split_lines(F.col("text")), lambda ln, i: F.concat(
        F.lit('<seg id="'), (i + 1).cast("string"), F.lit('">'),
        F.replace(ln, F.lit("<"), F.lit(" ")), F.lit("</seg>")))
    xml = F.concat(F.lit('<doc docid="'), F.col("doc_id").cast("string"), F.lit('">'),
                   F.array_join(segs, ""), F.lit("</doc>"))
    return docs.select("doc_id", xml.alias("xml"))


def toy_id_arrays(lines_df: DataFrame) -> DataFrame:
    """A stand-in encoder: each space-separated word gets id ``5 + length``."""
    return lines_df.select("doc_id", "line_no", F.transform(
        F.split("line", " "), lambda w: F.lit(5) + F.length(w)).alias("ids"))


def toy_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``toy_ids(doc_id, line_no, pos, id)`` — long form of :func:`toy_id_arrays`."""
    a = toy_id_arrays(lines(spark, sf_dir))
    return a.select("doc_id", "line_no", F.posexplode("ids").alias("pos", "id")).withColumn(
        "pos", F.col("pos").cast("long"))


def trace_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(label, step, idx, x)``: the n-th vector of a label is its step n-1."""
    emb = read_table(spark, sf_dir, "embeddings")
    ranked = global_rank(emb, ["vec_id"], F.floor(F.col("vec_id") / ID_BUCKET),
                         group_cols=["label"], rank_col="_r")
    return ranked.select("label", (F.col("_r") - 1).alias("step"),
                         F.posexplode("embedding").alias("idx", "x")).select(
        "label", "step", F.col("idx").cast("long").alias("idx"),
        F.col("x").cast("double").alias("x"))


def param_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``param_trace(step, param, idx, theta_before, theta_after, grad)``.

    The value before a step is the same element one step earlier, found by
    an equi-join on ``step - 1`` (no window, so a label holding most of the
    vectors is spread over all tasks like any other). The gradient is set to
    the earlier value: the table tests the arithmetic, not learning."""
    t = trace_src(spark, sf_dir)
    prev = t.select("label", "idx", (F.col("step") + 1).alias("step"),
                    F.col("x").alias("theta_before"))
    return t.join(prev, ["label", "step", "idx"], "inner").select(
        "step", F.concat(F.lit("p"), F.col("label").cast("string")).alias("param"), "idx",
        "theta_before", F.col("x").alias("theta_after"), F.col("theta_before").alias("grad"))
