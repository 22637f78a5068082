"""Aggregations over corpora.

All are hash aggregates with a partial (map-side) step, so a hot key — a
pre-token such as ``" the"`` that holds a large share of all rows — is
combined inside each task before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import pretoken_parts, pretokenize


def count_blank_lines(lines: DataFrame, by: list[str], line_col: str = "line") -> DataFrame:
    """A1: lines with no character at all (a space or CR is not blank), per group."""
    return lines.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col(line_col) == "").alias("n_blank"))


def corpus_summary(lines: DataFrame, batch_size: int, by: list[str] | None = None,
                   file_col: str = "doc_id") -> DataFrame:
    """A2: files, examples and batches per group, with the reference's length
    formula (first file size x (files - 1) + last file size) beside the true one."""
    by = list(by or [])
    per_file = lines.groupBy(*by, file_col).agg(F.count(F.lit(1)).alias("_n"))
    agg = per_file.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("_n").alias("n_examples"),
        F.min_by("_n", F.col(file_col)).alias("first_file_lines"),
        F.max_by("_n", F.col(file_col)).alias("last_file_lines"))
    return agg.select(
        *by, "n_files", "n_examples",
        F.ceil(F.col("n_examples") / F.lit(batch_size)).cast("long").alias("n_batches"),
        (F.col("first_file_lines") * (F.col("n_files") - 1) + F.col("last_file_lines"))
        .cast("long").alias("ref_examples"))


def pretokens(lines: DataFrame, keys: list[str], line_col: str = "line") -> DataFrame:
    """F1 in long form: ``(keys..., pos, pretoken)``."""
    return lines.select(*keys, F.posexplode(pretokenize(line_col)).alias("pos", "pretoken")
                        ).withColumn("pos", F.col("pos").cast("long"))


def pretoken_histogram(lines: DataFrame, line_col: str = "line", line_end: str | None = None,
                       by: list[str] = ()) -> DataFrame:
    """A3: count of every distinct pre-token over the corpus, or over each
    corpus named by the columns ``by``.

    ``line_end="\n"`` pre-tokenizes every line with its line break, as a
    trainer reading files line by line with their endings sees them (the
    break then forms its own white-space pre-token). Lines are cut at spaces
    and the parts counted first; only distinct parts meet the pattern."""
    text = F.col(line_col) if line_end is None else F.concat(F.col(line_col), F.lit(line_end))
    parts = (lines.select(*by, F.explode(pretoken_parts(text)).alias("_part"))
             .groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n")))
    return (parts.select(*by, F.explode(pretokenize("_part")).alias("pretoken"), "_n")
            .groupBy(*by, "pretoken").agg(F.sum("_n").alias("n")))


def plan_steps(examples: DataFrame, batch_size: int, epochs: int, extra: int = 500,
               by: list[str] | None = None) -> DataFrame:
    """Steps per epoch = ceil(examples / batch); total = epochs x steps + extra."""
    by = list(by or [])
    agg = examples.groupBy(*by).agg(F.count(F.lit(1)).alias("n_examples"))
    spe = F.ceil(F.col("n_examples") / F.lit(batch_size)).cast("long")
    return agg.select(*by, "n_examples", spe.alias("steps_per_epoch"),
                      (F.lit(epochs) * spe + F.lit(extra)).cast("long").alias("total_steps"))


def vocab_size(vocab: DataFrame) -> DataFrame:
    """Vocabulary size, split by kind (special / alphabet / merge)."""
    return vocab.groupBy().agg(
        F.count(F.lit(1)).alias("vocab_size"),
        F.count_if(F.col("kind") == "special").alias("n_special"),
        F.count_if(F.col("kind") == "alphabet").alias("n_alphabet"),
        F.count_if(F.col("kind") == "merge").alias("n_merge"))
