"""Structured Streaming entry points.

The reference only processes finished files, but every operator marked
row-wise in the survey (cleaning, tagging, pre-tokenizing, encoding,
framing, masking) is a stateless projection, so it runs unchanged on a
streaming DataFrame. These helpers wire a file stream to those operators
and to a fault-tolerant sink whose progress lives in the shared checkpoint
folder."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import scratch_path
from ..sources.lines import GLOB, LISTING, list_files, read_listed


def read_text_stream(spark: SparkSession, path: str, newline: str = "universal",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """New text files under ``path`` as a stream of ``(path, line)`` rows."""
    r = spark.readStream.format("text")
    if newline == "lf":
        r = r.option("lineSep", "\n")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.load(path)
    return df.selectExpr("_metadata.file_path as path", "value as line")


def read_table_stream(spark: SparkSession, path: str, schema: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files under ``path`` (declared schema, never inferred)."""
    r = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def write_parquet_stream(df: DataFrame, path: str, checkpoint: str | None = None,
                         available_now: bool = True, partition_by=()) -> StreamingQuery:
    """Append a stream to Parquet; the file sink plus the checkpoint give
    exactly-once output across restarts and lost executors."""
    ck = checkpoint or scratch_path(df.sparkSession, "stream-checkpoint")
    w = df.writeStream.format("parquet").option("checkpointLocation", ck).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start(path)


def numbered_lines_stream(spark: SparkSession, path: str, out: str, checkpoint: str | None = None,
                          newline: str = "universal", max_files_per_trigger: int | None = None,
                          available_now: bool = True) -> StreamingQuery:
    """S1 on a stream: every new text file under ``path`` as rows ``(path,
    line_no, line)`` of the Parquet table ``out``.

    The tasks list the files; those that no earlier listing has named are
    appended, at most ``max_files_per_trigger`` to a Parquet file, to a table
    beside the checkpoint, and the stream runs over that table. So the driver
    knows of a few listings instead of every file. A file comes whole, in one
    micro-batch, so its lines are numbered there like those of a finished file. A
    batch has a folder of its own, which a second attempt of it replaces: after
    a restart from the checkpoint no line is missing or double. Without
    ``available_now`` the files are listed again every 10 seconds."""
    if newline not in ("universal", "lf"):
        raise ValueError(f"newline must be 'universal' or 'lf', not {newline!r}")
    ck = checkpoint or scratch_path(spark, "stream-checkpoint")
    listing = f"{ck.rstrip('/')}/arrived"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(listing)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)

    def look() -> None:
        try:
            files = list_files(spark, path, recursive=False)
        except FileNotFoundError:
            if GLOB.search(path):
                return
            raise
        # Never by broadcast: paths pack so well that their files' size says little.
        known = spark.read.schema(LISTING).parquet(listing).select("path")
        new = files.hint("merge").join(known.hint("merge"), "path", "left_anti")
        if not new.isEmpty():
            new.write.mode("append").option("maxRecordsPerFile", max_files_per_trigger or 0).parquet(listing)

    def number(batch: DataFrame, n: int) -> None:
        read_listed(batch, newline).write.mode("overwrite").parquet(f"{out}/batch={n}")

    look()
    arrived = read_table_stream(spark, listing, LISTING, 1 if max_files_per_trigger else None)
    query = run_batches(arrived, number, ck, available_now)

    def keep_looking() -> None:
        try:
            while not query.awaitTermination(10):
                look()
        except Exception:
            query.stop()
            raise

    if not available_now:
        threading.Thread(target=keep_looking, daemon=True).start()
    return query


def run_batches(df: DataFrame, fn: Callable[[DataFrame, int], None],
                checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """``foreachBatch``: apply a batch function (for example the numbered
    line reader or a vocabulary lookup) to every micro-batch."""
    ck = checkpoint or scratch_path(df.sparkSession, "stream-checkpoint")
    w = df.writeStream.option("checkpointLocation", ck).foreachBatch(fn)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
