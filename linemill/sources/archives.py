"""Archive members (S3) and segment documents."""

from __future__ import annotations

import fnmatch
import io
import tarfile
import uuid
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip_text

MEMBER_SCHEMA = "archive string, member string, text string"


def _members(pattern: str, encoding: str):
    def run(batches):
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as tar:
                    for m in tar.getmembers():
                        if m.isfile() and fnmatch.fnmatchcase(m.name, pattern):
                            data = tar.extractfile(m).read()
                            rows.append((path, m.name, data.decode(encoding)))
            yield pd.DataFrame(rows, columns=["archive", "member", "text"])
    return run


def read_archive_members(spark: SparkSession, path: str, pattern: str = "*",
                         encoding: str = "utf-8") -> DataFrame:
    """S3: ``(archive, member, text)`` for members of tar archives whose name
    matches the wildcard ``pattern`` (as ``tar --wildcards``). Archives are
    read in parallel, one archive per row (parallel across archives, not
    inside one); lower ``spark.sql.execution.arrow.maxRecordsPerBatch`` when
    archives are large, so a batch holds few of them."""
    arch = spark.read.format("binaryFile").load(path).select("path", "content")
    return arch.mapInPandas(_members(pattern, encoding), MEMBER_SCHEMA)


# ---------------------------------------------------------------- S4
def _py_strip(s: str) -> str:
    return s.strip()


def segments_of(xml_text: str, on_empty: str = "blank"):
    """Text before the first child of every ``<seg>`` in document order,
    stripped. A segment without such text (empty, or starting with a child)
    is blank, an error or skipped by ``on_empty``."""
    root = ET.fromstring(xml_text)
    out = []
    for i, seg in enumerate(root.iter("seg"), start=1):
        t = seg.text
        if t is None:
            if on_empty == "error":
                raise ValueError(f"segment {i} has no text before its first child")
            if on_empty == "skip":
                continue
            t = ""
        out.append((i, _py_strip(t)))
    return out


# The text before the first child of every segment, by one native expression.
# What a regex cannot tell (comments, CDATA, entities) goes to the parser.
SEGMENT = r"<seg(?:\s[^>]*?)?(?:/>|>([^<]*))"
NEEDS_PARSER = r"<!--|<!\[CDATA\[|&"


def read_segments(df: DataFrame, xml_col: str = "xml", doc_col: str = "doc_id",
                  on_empty: str = "blank") -> DataFrame:
    """``(doc_col, seg_no, text)`` from a column of SGM/XML documents;
    the document key keeps its own name and type. Null documents give no rows.

    Native for documents without comments, CDATA sections and entities; the
    others are parsed per row with ``xml.etree`` inside Arrow batches
    (Spark's XML functions return the tail text after child elements, which
    is not what the segment extractor keeps)."""
    if on_empty not in ("blank", "error", "skip"):
        raise ValueError(on_empty)
    docs = df.select(F.col(doc_col), F.col(xml_col).alias("_xml")).filter("_xml is not null")
    plain = docs.filter(~F.col("_xml").rlike(NEEDS_PARSER)).select(
        doc_col, F.posexplode(F.regexp_extract_all("_xml", F.lit(SEGMENT), 1)).alias("_i", "_t"))
    if on_empty == "skip":
        plain = plain.filter("_t <> ''")
    text = strip_text("_t")
    if on_empty == "error":
        text = F.when(F.col("_t") == "", F.raise_error(F.concat(
            F.lit("a segment has no text before its first child: "), (F.col("_i") + 1).cast("string")))
        ).otherwise(text)
    plain = plain.select(doc_col, (F.col("_i") + 1).cast("int").alias("seg_no"), text.alias("text"))
    key_type = df.schema[doc_col].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            rows = []
            for d, x in zip(pdf[doc_col], pdf["_xml"]):
                rows.extend((d, n, t) for n, t in segments_of(x, on_empty))
            yield pd.DataFrame(rows, columns=[doc_col, "seg_no", "text"])

    parsed = docs.filter(F.col("_xml").rlike(NEEDS_PARSER)).mapInPandas(
        run, f"`{doc_col}` {key_type}, seg_no int, text string")
    return plain.unionByName(parsed)


# ---------------------------------------------------------------- archive writer
ARCHIVE_SCHEMA = "archive string, n_members long, n_bytes long"


def _fs_uri(spark: SparkSession, path: str) -> str:
    """The path with its file system: one without a scheme belongs to the
    cluster's default file system, as for every Spark reader and writer."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = fs.makeQualified(p).toString()
    if full.startswith("file:/") and not full.startswith("file:///"):
        return "file:///" + full[len("file:/"):].lstrip("/")
    return full


def write_archives(df: DataFrame, path: str, archive_col: str = "archive",
                   member_col: str = "member", text_col: str = "text",
                   encoding: str = "utf-8") -> DataFrame:
    """Write gzip'd tar archives ``path/<archive>.tgz``, one per value of
    ``archive_col``, holding ``text_col`` under the name ``member_col``.

    Each archive is built by one task (``applyInPandas`` per archive) and
    written through the Arrow file system of ``path`` (local, HDFS or object
    store), so the caller bounds an archive's size by how it assigns rows to
    archives (for example by id range). Returns one row per archive written."""
    target = _fs_uri(df.sparkSession, path.rstrip("/"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        import pyarrow.fs as pafs
        name = str(pdf[archive_col].iloc[0])
        buf = io.BytesIO()
        with tarfile.open(fileobj=buf, mode="w:gz") as tar:
            for m, t in sorted(zip(pdf[member_col], pdf[text_col])):
                data = (t or "").encode(encoding)
                info = tarfile.TarInfo(m)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
        fs, base = pafs.FileSystem.from_uri(target)
        fs.create_dir(base, recursive=True)
        # A second attempt writes its own file; the last rename wins whole.
        part = f"{base}/.{name}.{uuid.uuid4().hex}"
        with fs.open_output_stream(part) as out:
            out.write(buf.getvalue())
        fs.move(part, f"{base}/{name}.tgz")
        return pd.DataFrame([(name, len(pdf), buf.tell())],
                            columns=["archive", "n_members", "n_bytes"])

    return df.select(archive_col, member_col, text_col).groupBy(archive_col).applyInPandas(
        build, ARCHIVE_SCHEMA)
