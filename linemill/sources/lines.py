"""Line sources (S1) and corpus discovery.

``read_lines`` numbers the lines of text files exactly, in parallel and
without a shuffle of the text: each file split is read by one task in file
order, so ``monotonically_increasing_id`` is consecutive inside a split;
per-split minimum ids and counts (one small row per split) give every
split's offset within its file by a prefix sum.
"""

from __future__ import annotations

import fnmatch
import os
import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import basename, corpus_name_part
from ..session import many_files_session, stored


def _text_reader(spark: SparkSession, newline: str):
    r = spark.read.format("text")
    if newline == "lf":
        r = r.option("lineSep", "\n")
    elif newline != "universal":
        raise ValueError(f"newline must be 'universal' or 'lf', not {newline!r}")
    return r


def numbered(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The file splits' table, and the rows with their line numbers. ``raw`` has
    columns unit, path, _blk, _size, _mid and line."""
    blocks = raw.groupBy("unit", "path", "_blk").agg(
        F.min("_mid").alias("_m0"), F.count(F.lit(1)).alias("_n"))
    # Part files continue each other by number, not by name: part-100000 comes
    # after part-99999. Blocks of one unit: file size / split size rows.
    number = F.regexp_extract("path", r"/part-([0-9]+)[^/]*$", 1)
    w = Window.partitionBy("unit").orderBy(F.when(number != "", number.cast("long")), "path", "_blk").rowsBetween(
        Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    # One row per file split: the planner broadcasts the table while it is
    # small, so the text itself is not shuffled for its numbering.
    out = raw.join(blocks.select("path", "_blk", "_m0", "_off"), ["path", "_blk"], "inner")
    out = out.select("unit", "path", (F.col("_off") + F.col("_mid") - F.col("_m0")).alias("line_no"),
                     "line", "_size")
    return blocks, out


def read_lines(spark: SparkSession, paths, newline: str = "universal",
               trailing_empty: bool = False, unit: str = "file",
               recursive: bool = False, path_glob: str | None = None) -> DataFrame:
    """``(path, line_no, line)`` for every line of the given files.

    ``newline='universal'`` ends a line at ``\\n``, ``\\r\\n`` or a lone
    ``\\r`` (Python text mode); ``'lf'`` at ``\\n`` only (grep/sed/cat).
    ``trailing_empty`` gives exactly what ``read().split('\\n')`` yields in text
    mode: an empty last line for a file that ends in a line break, one empty
    line for an empty file, and a byte order mark kept in the first line (it
    costs a second pass over the files). ``unit='dir'`` numbers lines across
    all part files of a directory in part-name order (the layout written by
    :func:`linemill.sources.sinks.write_lines`)."""
    if isinstance(paths, str):
        paths = [paths]
    reader = _text_reader(spark, newline)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)   # files are pruned at listing
    raw = reader.load(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_blk"),
        F.col("_metadata.file_size").alias("_size"),
        F.monotonically_increasing_id().alias("_mid"),
        F.col("value").alias("line"))
    unit_col = F.regexp_extract("path", r"^(.*)/[^/]*$", 1) if unit == "dir" else F.col("path")
    raw = raw.withColumn("unit", unit_col)
    blocks, out = numbered(raw)
    if trailing_empty:
        ends = _file_ends(spark, paths, recursive, path_glob)
        out = out.join(ends.filter("_bom").select("path", "_bom"), "path", "left").withColumn(
            "line", F.when(F.col("_bom") & (F.col("line_no") == _first_line(unit)), F.concat(F.lit("\ufeff"), "line"))
            .otherwise(F.col("line"))).drop("_bom")
        per_file = blocks.groupBy("unit", "path").agg((F.max(F.col("_off") + F.col("_n"))).alias("line_no"))
        closed = F.col("_lf") if newline == "lf" else F.col("_lf") | F.col("_cr")
        out = out.unionByName(per_file.join(ends.filter(closed).select("path"), "path").select(
            "unit", "path", "line_no", F.lit("").alias("line")), allowMissingColumns=True)
        if unit == "file":
            out = out.unionByName(_empty_files(spark, paths, recursive, path_glob).select(
                F.col("path").alias("unit"), "path", F.lit(0).cast("long").alias("line_no"),
                F.lit("").alias("line")), allowMissingColumns=True)
    out = out.drop("_size")
    if unit == "file":
        out = out.drop("unit")
    return out


def _first_line(unit: str):
    return F.lit(0) if unit == "file" else F.lit(None).cast("long")


def _options(reader, recursive, path_glob):
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", path_glob) if path_glob else reader


def _file_ends(spark, paths, recursive, path_glob=None) -> DataFrame:
    """Per file with any byte: does it end in LF (``_lf``) or CR (``_cr``), and
    does it begin with a byte order mark, which the reader swallows
    (``_bom``)? Read with LF as the only separator, a file's size is its
    lines' bytes, plus one per line (less one without a final LF), plus three
    for the mark."""
    raw = _options(_text_reader(spark, "lf"), recursive, path_glob).load(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("_size"),
        F.col("_metadata.file_block_start").alias("_blk"), F.monotonically_increasing_id().alias("_mid"), "value")
    per = raw.groupBy("path").agg(
        F.max("_size").alias("_size"), F.count(F.lit(1)).alias("_n"), F.sum(F.octet_length("value")).alias("_b"),
        F.max_by(F.col("value").endswith("\r"), F.struct("_blk", "_mid")).alias("_cr"))
    rest = F.col("_size") - F.col("_b") - F.col("_n")
    return per.select("path", rest.isin(0, 3).alias("_lf"), (F.col("_cr") & rest.isin(-1, 2)).alias("_cr"),
                      (rest >= 2).alias("_bom"))


def _empty_files(spark, paths, recursive, path_glob=None) -> DataFrame:
    """``(path)`` of files without a byte: one empty line each in text mode.
    Spark's readers leave them out, so the driver lists the folders (file
    status only, as every reader does)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []

    def look(fs, status, deep):
        name = status.getPath().getName()
        if name[:1] in "._":
            return
        if status.isDirectory():
            for child in fs.listStatus(status.getPath()) if deep else []:
                look(fs, child, recursive)
        elif status.getLen() == 0 and (not path_glob or fnmatch.fnmatchcase(name, path_glob)):
            found.append((re.sub("^file:/+", "file:///", status.getPath().toString()),))

    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        for status in fs.globStatus(path) or []:
            look(fs, status, True)
    return spark.createDataFrame(found, "path string")


# ---------------------------------------------------------------- listings
# A listing has a row ``(path, size)`` for each file, the path as Hadoop writes
# it. It is a table like any other: the driver never holds it.
LISTING = "path string, size long"
ENTRIES = 10_000            # rows of a batch of a listing
GLOB = re.compile(r"[{}\[\]*?\\]")


def _arrow_place(path: str, known: dict):
    """The Arrow file system of a Hadoop path and the path in it; ``known``
    keeps file systems by scheme and authority."""
    import pyarrow.fs as pafs
    if path.startswith("file:"):
        return known.setdefault("file:", pafs.LocalFileSystem()), "/" + path[len("file:"):].lstrip("/")
    root, rest = re.match(r"([^:/]+://[^/]*)(.*)", path).groups()
    if root not in known:
        known[root] = pafs.FileSystem.from_uri(root + "/")
    fs, base = known[root]
    return fs, base.rstrip("/") + rest if base.strip("/") else rest


def _arrow_opens(path: str) -> bool:
    try:
        _arrow_place(path, {})
    except Exception:       # a file system that only Hadoop knows
        return False
    return True


def _entries(fs, folder: str) -> Iterator[tuple[str, int | None]]:
    """Names and sizes (null: a folder) of what is in a folder; none if it has
    gone. A local folder is not held whole."""
    import pyarrow.fs as pafs
    if not isinstance(fs, pafs.LocalFileSystem):
        for f in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            yield f.base_name, None if f.type == pafs.FileType.Directory else f.size
        return
    try:
        with os.scandir(folder) as it:
            for e in it:
                try:
                    yield e.name, None if e.is_dir() else e.stat().st_size
                except FileNotFoundError:
                    pass
    except FileNotFoundError:
        pass


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return name[:1] == "." or (name[:1] == "_" and "=" not in name) or name.endswith("._COPYING_")


def _list_folders(recursive: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, paths, sizes = {}, [], []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())],
                                              ["path", "size"])
        for b in batches:
            for folder in b.column(0).to_pylist():
                for name, size in _entries(*_arrow_place(folder, known)):
                    if _hidden(name) or (size is None and not recursive and "=" not in name):
                        continue
                    paths.append(f"{folder.rstrip('/')}/{name}")
                    sizes.append(size)
                    if len(paths) == ENTRIES:
                        yield batch()
                        paths, sizes = [], []
        yield batch()
    return run


def list_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """The listing of all files under ``path`` (a folder, a file or a glob),
    empty ones too; without ``recursive`` those of the folder itself and of
    partition folders (``name=value``) in it.

    The tasks list: a level's folders are a stored table, dealt to them, and
    what they find is the next one's. One folder is listed by one task. A file
    system that Arrow does not open is listed by Spark's reader, which takes
    some kilobyte of the driver a file and leaves empty files out."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(s.getPath().toString(), None if s.isDirectory() else s.getLen())
             for s in fs.globStatus(fs.makeQualified(where)) or []]
    if not found:
        raise FileNotFoundError(f"no file or folder {path}")
    if not all(_arrow_opens(p) for p, _ in found):
        r = many_files_session(spark).read.format("binaryFile")
        return r.option("recursiveFileLookup", str(recursive).lower()).load(path).select(
            "path", F.col("length").alias("size"))
    level, levels = spark.createDataFrame(found, LISTING), []
    while True:
        levels.append(level.filter("size is not null"))
        folders = level.filter("size is null").select("path")
        if folders.isEmpty():
            return reduce(DataFrame.union, levels)
        folders = folders.repartition(4 * spark.sparkContext.defaultParallelism)
        level = stored(folders.mapInArrow(_list_folders(recursive), LISTING), "listing")


# Plain files up to this size are read whole, by one task each.
WHOLE_FILE = 1 << 23
BATCH_BYTES = 1 << 22
BOM = b"\xef\xbb\xbf"
# The readers unpack files by their suffixes.
PACKED = r"\.(gz|bz2|deflate|lz4|lzo|snappy|zst|zstd|passthrough)$"


def _as_uri(path: str) -> str:
    """A Hadoop path as ``_metadata.file_path`` has it: signs that a URI cannot
    hold are quoted, other letters than ASCII stay."""
    return re.sub(r"[^A-Za-z0-9_\-!.~'()*,;:$&+=/@\u00a1-\U0010ffff]|\s", lambda m: quote(m[0], safe=""), path)


def _read_whole(newline: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, paths, numbers, lines, held = {}, [], [], [], 0

        def batch():
            # Bytes as they are, as the text reader gives them.
            return pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(numbers, pa.int64()),
                 pa.array(lines, pa.binary()).view(pa.string())], ["path", "line_no", "line"])
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, place = _arrow_place(path, known)
                with fs.open_input_stream(place, compression=None) as f:
                    data = f.read().removeprefix(BOM)
                path = _as_uri(path)
                own = data.splitlines() if newline == "universal" else data.removesuffix(b"\n").split(b"\n") if data else []
                paths += [path] * len(own)
                numbers += range(len(own))
                lines += own
                held += len(data) + (len(path) + 16) * len(own)
                if held > BATCH_BYTES:
                    yield batch()
                    paths, numbers, lines, held = [], [], [], 0
        yield batch()
    return run


def read_listed(files: DataFrame, newline: str = "universal") -> DataFrame:
    """S1 over a listing: ``(path, line_no, line)``, as :func:`read_lines`.

    The tasks open small plain files themselves, so there is no file index on
    the driver. Larger files, packed ones and those of file systems that Arrow
    does not open go through :func:`read_lines`, their names by the driver."""
    spark = files.sparkSession
    first = files.select("path").first()
    whole = F.lit(first is not None and _arrow_opens(first.path)) & (F.col("size") <= WHOLE_FILE) & ~F.col("path").rlike(PACKED)
    small = files.filter(whole).select("path").repartition(2 * spark.sparkContext.defaultParallelism)
    out = small.mapInArrow(_read_whole(newline), "path string, line_no long, line string")
    large = [GLOB.sub(r"\\\g<0>", r.path) for r in files.filter(~whole).select("path").collect()]
    if large:
        out = out.unionByName(read_lines(many_files_session(spark), large, newline))
    return out


# ---------------------------------------------------------------- S2
def glob_to_regex(pattern: str) -> str:
    """A shell glob (``*``, ``?``, ``[...]``, ``{a,b}``) as an anchored regex
    over one path component."""
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        if c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "[":
            j = pattern.find("]", i + 1)
            if j < 0:
                out.append(re.escape(c))
            else:
                body = pattern[i + 1:j]
                if body.startswith("!"):
                    body = "^" + body[1:]
                out.append("[" + body + "]")
                i = j
        elif c == "{":
            j = pattern.find("}", i + 1)
            if j < 0:
                out.append(re.escape(c))
            else:
                alts = [re.escape(a) for a in pattern[i + 1:j].split(",")]
                out.append("(" + "|".join(alts) + ")")
                i = j
        else:
            out.append(re.escape(c))
        i += 1
    return "^" + "".join(out) + "$"


def glob_match(col, pattern: str) -> Column:
    c = col if isinstance(col, Column) else F.col(col)
    return c.rlike(glob_to_regex(pattern))


def path_match(pattern: str, name_col: str = "name", path_col: str = "path") -> Column:
    """A glob without ``/`` matches the base name; one with ``/`` (as
    ``en-??/*``) matches the last components of the path."""
    if "/" not in pattern:
        return glob_match(name_col, pattern)
    parts = "/".join(glob_to_regex(p)[1:-1] for p in pattern.strip("/").split("/"))
    return F.col(path_col).rlike("(?:^|/)" + parts + "$")


def select_files(files: DataFrame, include: str | None = None, exclude=(),
                 suffixes=None, name_col: str = "name", path_col: str = "path") -> DataFrame:
    """S2 on a file listing: keep files matching ``include``, drop files
    matching any ``exclude`` glob, optionally keep only ``suffixes``. Globs
    with a ``/`` look at the path, others at the base name."""
    out = files
    if include:
        out = out.filter(path_match(include, name_col, path_col))
    for ex in ([exclude] if isinstance(exclude, str) else exclude):
        out = out.filter(~path_match(ex, name_col, path_col))
    if suffixes:
        out = out.filter(F.regexp_extract(name_col, r"(\.[^.]*)$", 1).isin(*suffixes))
    return out


def discover_corpus(spark: SparkSession, root: str, include: str | None = None, exclude=(),
                    recursive: bool = True, suffixes=None) -> DataFrame:
    """List corpus files under ``root`` (directories are never rows).

    A listing by the tasks (:func:`list_files`), so only file metadata is read
    and the driver holds none of it. Name parts (pair, split, lang) are parsed
    (P6)."""
    files = list_files(spark, root, recursive)
    files = files.withColumn("name", basename("path"))
    files = select_files(files, include, exclude, suffixes)
    return files.select(
        "path", "name", *[corpus_name_part("name", p).alias(p) for p in ("pair", "split", "lang")],
        F.regexp_extract("name", r"(\.[^.]*)$", 1).alias("suffix"), "size")


def read_corpus(spark: SparkSession, root: str, include: str | None = None, exclude=(),
                suffixes=None, newline: str = "universal") -> DataFrame:
    """S2 + S1 + P6: every line of the corpus files under ``root`` with the
    pair, split and language taken from the file name. ``include`` prunes
    files while listing; ``exclude`` and ``suffixes`` filter by name."""
    by_name = include if include and "/" not in include else None
    ln = read_lines(spark, root, newline, recursive=True, path_glob=by_name)
    ln = ln.withColumn("name", basename("path"))
    ln = select_files(ln, None if by_name else include, exclude, suffixes)
    return ln.select("path", *[corpus_name_part("name", p).alias(p)
                               for p in ("pair", "split", "lang")], "line_no", "line")
