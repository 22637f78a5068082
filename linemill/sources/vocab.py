"""Vocabulary tables: load (S5), write (K2), build-or-reuse (K3).

Vocabularies are bounded by their declared size, so they are written as
single-part text files in the formats other tools read (``vocab.json``,
``merges.txt``, tab-separated ``.vocab``) plus Parquet twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lines import read_lines

MERGES_HEADER = "#version: 0.2"


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its (possibly remote) file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when a table was written to its end there (``_SUCCESS``)."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


# ---------------------------------------------------------------- versions
# A published path holds a folder for each version and numbered manifests, each
# naming one folder. A reader takes the folder of the last manifest, so it sees
# one version whole; a build that fails has published nothing.
_MANIFEST = "manifest-"


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _manifests(spark: SparkSession, path: str) -> list[str]:
    _, p, fs = _folder(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n for n in names if n.startswith(_MANIFEST))


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the version last published at ``path``, if any."""
    path = path.rstrip("/")
    names = _manifests(spark, path)
    if not names:
        return None
    folder = spark.read.format("binaryFile").load(f"{path}/{names[-1]}").first()
    return f"{path}/{bytes(folder['content']).decode().strip()}"


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Let ``write(folder)`` fill a new folder under ``path``, then publish it
    by renaming a finished manifest; until then, and for good if ``write``
    fails, readers keep the version they have. Returns the folder. Versions are
    numbered, so of two writers the later one's is current."""
    path = path.rstrip("/")
    name = f"v-{uuid.uuid4().hex}"
    write(f"{path}/{name}")
    jvm, _, fs = _folder(spark, path)
    Path = jvm.org.apache.hadoop.fs.Path
    draft = Path(f"{path}/.draft-{name}")
    out = fs.create(draft)
    out.write(bytearray(name.encode()))
    out.close()
    last = _manifests(spark, path)
    n = int(last[-1][len(_MANIFEST):]) + 1 if last else 0
    while fs.exists(Path(f"{path}/{_MANIFEST}{n:010d}")) or not fs.rename(draft, Path(f"{path}/{_MANIFEST}{n:010d}")):
        n += 1
    return f"{path}/{name}"


def load_bpe_vocab(spark: SparkSession, path: str) -> DataFrame:
    """``vocab.json`` (one JSON object piece -> id) as ``(piece, id)``."""
    raw = spark.read.option("wholetext", "true").text(path)
    m = F.from_json("value", "map<string,int>")
    return raw.select(F.explode(m).alias("piece", "id"))


def load_bpe_merges(spark: SparkSession, path: str) -> DataFrame:
    """``merges.txt`` as ``(rank, left, right)``; the header is skipped."""
    ln = read_lines(spark, path, newline="lf", unit="dir")
    # only the first line can be the header; a merge may begin like one
    head = ln.filter((F.col("line_no") == 0) & F.col("line").startswith("#version")).count()
    body = ln.filter((F.col("line_no") >= head) & (F.col("line") != ""))
    parts = F.split("line", " ", 2)
    return body.select((F.col("line_no") - F.lit(head)).cast("int").alias("rank"),
                       parts[0].alias("left"), parts[1].alias("right"))


def load_unigram_vocab(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated ``.vocab`` (piece, score) as ``(piece, id, score)``;
    the row order is the id."""
    ln = read_lines(spark, path, newline="lf", unit="dir").filter(F.col("line") != "")
    # the score follows the last tab
    return ln.select(F.regexp_extract("line", r"^(.*)\t([^\t]*)$", 1).alias("piece"),
                     F.col("line_no").cast("int").alias("id"),
                     F.regexp_extract("line", r"^(.*)\t([^\t]*)$", 2).cast("double").alias("score"))


def load_vocab(spark: SparkSession, path: str, kind: str = "parquet"):
    """Dispatch on ``kind``: ``bpe`` gives ``(vocab, merges)``, ``unigram``
    and ``parquet`` give one table."""
    if kind == "bpe":
        return load_bpe_vocab(spark, f"{path}/vocab.json"), load_bpe_merges(spark, f"{path}/merges.txt")
    if kind == "unigram":
        return load_unigram_vocab(spark, path)
    if kind == "parquet":
        return spark.read.parquet(path)
    raise ValueError(kind)


def _single_text(df: DataFrame, path: str, order: str) -> None:
    """One ordered part file: one task, sorted inside it."""
    df.repartition(1).sortWithinPartitions(order).select("value").write.mode("overwrite").text(path)


def write_bpe(vocab: DataFrame, merges: DataFrame, path: str) -> None:
    """K2 for BPE: ``path/vocab.json`` (one object) and ``path/merges.txt``
    (header, then ``left right`` per rank), plus Parquet twins."""
    # one JSON object, entries in id order (bounded by the vocabulary size)
    obj = vocab.agg(F.to_json(F.map_from_entries(F.transform(
        F.array_sort(F.collect_list(F.struct("id", "piece"))),
        lambda e: F.struct(e["piece"], e["id"])))).alias("value"))
    _single_text(obj, f"{path}/vocab.json", "value")
    spark = vocab.sparkSession
    head = spark.createDataFrame([(-1, MERGES_HEADER)], "rank int, value string")
    body = merges.select("rank", F.concat_ws(" ", "left", "right").alias("value"))
    _single_text(head.unionByName(body), f"{path}/merges.txt", "rank")
    vocab.write.mode("overwrite").parquet(f"{path}/vocab.parquet")
    merges.write.mode("overwrite").parquet(f"{path}/merges.parquet")


def write_unigram(vocab: DataFrame, path: str) -> None:
    """K2 for unigram: tab-separated ``piece<TAB>score`` in id order."""
    _single_text(vocab.select("id", F.concat_ws("\t", "piece", F.col("score").cast("string")).alias("value")),
                 path, "id")


def write_vocab(vocab: DataFrame, path: str, kind: str = "parquet", merges: DataFrame | None = None):
    """K2: write a vocabulary (and merges for ``bpe``) under ``path``."""
    if kind == "bpe":
        return write_bpe(vocab, merges, path)
    if kind == "unigram":
        return write_unigram(vocab, path)
    vocab.write.mode("overwrite").parquet(path)


def build_or_reuse(spark: SparkSession, path: str, builder: Callable[[], DataFrame],
                   overwrite: bool = False) -> DataFrame:
    """K3: read the table published at ``path`` (or written there to its end)
    unless ``overwrite``; otherwise build it, publish it and read it back. A
    build that fails leaves the old table as it is."""
    have = current_version(spark, path) or (path if table_exists(spark, path) else None)
    if overwrite or have is None:
        have = publish(spark, path, lambda folder: builder().write.parquet(folder))
    return spark.read.parquet(have)
