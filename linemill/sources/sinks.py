"""Sinks: line files (K1), single files, the LCA log (K4) and the metrics log (K5)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_lines(df: DataFrame, path: str, file_cols: list[str], order_cols: list[str],
                line_col: str = "line", partitions: int | None = None,
                parquet_twin: bool = True) -> None:
    """K1: one text output per input file (a directory per ``file_cols``
    value), one line per record, order kept.

    Rows are range-partitioned on (file, order) keys, so a very large file
    is spread over several tasks whose part files, taken in part-name
    order, continue each other; :func:`linemill.sources.lines.read_lines`
    with ``unit='dir'`` numbers them back. A Parquet twin keeps the keys."""
    keys = [*file_cols, *order_cols]
    # Without a number the exchange is sized by the data (adaptive coalescing).
    laid = (df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
            ).sortWithinPartitions(*keys)
    if parquet_twin:
        laid.write.mode("overwrite").partitionBy(*file_cols).parquet(path + ".parquet")
        # The text follows the twin, so the input is evaluated once.
        back = df.sparkSession.read.schema(df.schema).parquet(path + ".parquet")
        laid = (back.repartitionByRange(partitions, *keys) if partitions else back.repartitionByRange(*keys)
                ).sortWithinPartitions(*keys)
    laid.select(*file_cols, line_col).write.mode("overwrite").partitionBy(*file_cols).text(path)


def write_files(df: DataFrame, path: str, name_col: str, text_col: str) -> int:
    """One UTF-8 file ``path/<name>`` for each row, its text as it is (null:
    empty); names may have folders. Written by the tasks through the file
    system of ``path``; a second attempt replaces the first one's file whole.
    Returns the number of files."""
    from .archives import _fs_uri
    target = _fs_uri(df.sparkSession, path.rstrip("/"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as pafs
        fs, base = pafs.FileSystem.from_uri(target)
        for pdf in batches:
            for name, text in zip(pdf[name_col], pdf[text_col]):
                folder, _, file = f"{base}/{name}".rpartition("/")
                fs.create_dir(folder, recursive=True)
                part = f"{folder}/.{file}.{uuid.uuid4().hex}"
                with fs.open_output_stream(part) as out:
                    out.write((text or "").encode())
                fs.move(part, f"{folder}/{file}")
            yield pd.DataFrame({"n": [len(pdf)]})

    return df.select(name_col, text_col).mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0


def write_lca_log(log: DataFrame, path: str, nested: bool = False) -> None:
    """K4: the LCA log as JSON. Long rows ``(param, step, sum, mean,
    interval.sum, interval.mean)`` by default; ``nested`` writes one object
    per parameter mapping ``STEP_n`` to the four numbers, as the reference's
    log (one map per parameter, bounded by the number of logged steps)."""
    vals = F.struct(F.col("lca_sum").alias("sum"), F.col("lca_mean").alias("mean"),
                    F.col("interval_sum").alias("interval.sum"),
                    F.col("interval_mean").alias("interval.mean"))
    if nested:
        out = log.groupBy("param").agg(F.map_from_entries(F.collect_list(F.struct(
            F.concat(F.lit("STEP_"), F.col("step").cast("string")), vals))).alias("steps"))
    else:
        out = log.select("param", "step", vals.alias("v")).select("param", "step", "v.*")
    out.write.mode("overwrite").json(path)


def append_metrics(metrics: DataFrame, path: str) -> None:
    """K5: append ``(step, tag, value)`` rows to the metrics table."""
    metrics.select(F.col("step").cast("long"), F.col("tag").cast("string"),
                   F.col("value").cast("double")).write.mode("append").parquet(path)
