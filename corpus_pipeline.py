"""The corpus pipeline: five stages over ``documents``, each one an operator of
``linemill.llm``. Every stage but the last returns the columns of its input;
its result is written as Parquet and read again as the next stage's input.

Ids are taken to name one text; null texts count as empty, as each operator's
docstring says. Extra columns pass through whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linemill.llm import language_id
from linemill.llm.common import documents, stored
from linemill.llm.decontaminate import clean_documents
from linemill.llm.exact_dedup import drop_copies
from linemill.llm.queries import bpe_digests, language_model
from linemill.llm.simhash import drop_near_copies
from linemill.session import ship_package


def _shielded(docs: DataFrame, f: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply ``f`` with all columns but id, text and language under neutral
    names, so that no column of the table can clash with one of ``f``'s."""
    own = {"doc_id", "text", "lang"}
    safe = docs.toDF(*[c if c in own else f"c{i}_of_table" for i, c in enumerate(docs.columns)])
    return f(safe).select(*safe.columns).toDF(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; those without letters, and those
    with a narrow margin between two languages, go. The dictionaries come
    from a bounded sample of the labelled documents."""
    ship_package(spark)

    def keep(d):
        copy = d.withColumn("c_text", F.col("text"))
        return language_id.identify(copy, language_model(d), "c_text", keep=d.columns).filter("not rejected")
    return _shielded(docs, keep)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    ship_package(spark)
    return _shielded(docs, drop_copies)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints at four or fewer bits, the one with
    the smallest id."""
    ship_package(spark)
    return _shielded(docs, drop_near_copies)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their benchmark passages; documents that are mostly
    benchmark text go. ``n_chars`` stays that of the original."""
    ship_package(spark)
    return _shielded(docs, lambda d: clean_documents(d, documents(spark, sf_dir, "benchmark")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, packed ``ids``, and digests of the ids and of
    the decoded text."""
    ship_package(spark)
    return bpe_digests(docs.select("doc_id", "text"), ["doc_id"], ["ids"])


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark_passages),
    ("byte_level_bpe", tokens),
]

# Language models, fingerprints' components and byte-level merges have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
