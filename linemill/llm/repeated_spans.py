"""Repeated passages: every byte covered by a 200-byte string that also starts
elsewhere, by names (ranks) of growing length.

Prefix doubling ranks all positions by ever longer prefixes and drops a
position as soon as its rank is unique. Ranking every byte would move twenty
times the input in the first round, so the rounds here begin at 48 bytes and
only at anchors: of the 48-byte strings inside a 200-byte window the one with
the least hash. Equal windows have equal anchors at equal places, so a window
whose anchor string is unique repeats nowhere.

A row is a cell of windows that share an anchor: the anchor's place ``a`` and
the distances ``a - p`` of its windows' starts ``p``. Its core (what all the
windows of the whole cell have in common) is its name, its region (what its
own windows cover together) a second name. Spark groups the rows by core:

* core unique: no window of the cell repeats, the row is dropped;
* all regions equal: every window of the cell repeats, the rows are settled;
* else rows of equal regions are settled too, and the cells of one row of each
  region are cut into narrower cells with longer cores.

Cells are 153, 12 and 1 windows wide: cores of 48, 189 and 200 bytes. In the
last round a cell is one window, named by two independent 64-bit hashes.

Equal texts are worked on once (a text with copies repeats as a whole, and
counts twice in every group). The distinct texts are stored bucketed by their
digest, so that no later round shuffles text. Names are grouped by partial
aggregation in the map tasks, so a passage that a third of all texts hold
reaches a reducer as one row per map task.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import RollingHash, edges, fresh, mix64, slices, stored

LENGTH = 200
ANCHOR = 48
CELLS = (12, 1)            # cell widths of the later rounds
_PLACE = 24                # bits of a place inside a piece
_PIECE = 1 << 22           # windows that are worked on at once


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, by running minima from both
    ends of blocks."""
    n = len(h) - w + 1
    pad = -len(h) % w
    x = np.concatenate([h, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    left = np.minimum.accumulate(x, axis=1).reshape(-1)
    right = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[:n], left[w - 1:w - 1 + n])


class Namer:
    """Names of byte ranges of one text at a time."""

    def __init__(self, length: int, anchor: int):
        self.length, self.anchor, self.w = length, anchor, length - anchor + 1
        self.one, self.two = RollingHash(81), RollingHash(82)

    def anchors(self, b: np.ndarray):
        """(a, lo, hi, core, region): anchors, the range of window starts each
        one serves, and their names. Long texts go piece by piece: an anchor
        depends on its window alone. A range that a piece border cuts is two
        rows of the same anchor."""
        n = len(b) - self.length + 1
        out = []
        for at in range(0, n, _PIECE):
            m = min(_PIECE, n - at)
            part = b[at:at + m + self.length - 1]
            h = self.one.prefix(part)
            k = len(part) - self.anchor + 1
            i = np.arange(k)
            names = self.one.ranges(h, i, i + self.anchor)
            packed = names & np.uint64(~((1 << _PLACE) - 1) & ((1 << 64) - 1)) | i.astype(np.uint64)
            a = (_least(packed, self.w) & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
            lo = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
            hi = np.append(lo[1:], m) - 1
            a = a[lo]
            region = self._region(self.two.prefix(part), a, lo, hi)
            out.append((a + at, lo + at, hi + at, names[a], region))
        return [np.concatenate(x) for x in zip(*out)]

    def _region(self, h, a, lo, hi):
        return mix64(self.two.ranges(h, lo, hi + self.length) + (a - lo).astype(np.uint64))

    def cells(self, b: np.ndarray, a: np.ndarray, lo: np.ndarray, hi: np.ndarray, width: int):
        """The rows cut into cells of ``width`` distances from the anchor."""
        last = self.length - self.anchor                     # largest distance
        j0, j1 = (a - hi) // width, (a - lo) // width
        count = j1 - j0 + 1
        row = np.repeat(np.arange(len(a)), count)
        j = j0[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        a, lo, hi = a[row], lo[row], hi[row]
        near, far = j * width, np.minimum(j * width + width - 1, last)
        core = mix64(self.one.ranges(self.one.prefix(b), a - near, a - far + self.length)
                     + j.astype(np.uint64))
        lo, hi = np.maximum(lo, a - far), np.minimum(hi, a - near)
        return a, lo, hi, core, self._region(self.two.prefix(b), a, lo, hi)


# A row's anchor, the distances of its first and last window from it, and
# whether its text has copies, share one integer: 39 + 12 + 12 + 1 bits.
_DIST = 12
_ROW = [T.StructField("tid", T.BinaryType()), T.StructField("place", T.LongType()),
        T.StructField("core", T.LongType()), T.StructField("region", T.LongType())]
MAX_LENGTH = 1 << _DIST


def _batch(tids, copies, parts) -> pa.RecordBatch:
    n = [len(p[0]) for p in parts]
    idx = np.repeat(np.arange(len(parts)), n)
    a, lo, hi, core, region = (np.concatenate([p[i] for p in parts]) for i in range(5))
    place = (((a << _DIST | a - lo) << _DIST | a - hi) << 1) | (copies > 1)[idx]
    return pa.RecordBatch.from_arrays(
        [tids.take(pa.array(idx)).cast(pa.binary()), pa.array(place), pa.array(core.view(np.int64)),
         pa.array(region.view(np.int64))], names=[f.name for f in _ROW])


def _weight():
    """How often a row's text occurs: once, or more."""
    return F.col("place").bitwiseAND(F.lit(1)) + 1


def _unpacked(rows: DataFrame, *more: str) -> DataFrame:
    a, dist = F.shiftright("place", 2 * _DIST + 1), (1 << _DIST) - 1
    back = [F.shiftright("place", k).bitwiseAND(F.lit(dist)) for k in (_DIST + 1, 1)]
    return rows.select("tid", a.alias("a"), (a - back[0]).alias("lo"), (a - back[1]).alias("hi"), *more)


def _rows(texts: DataFrame, length: int, anchor: int, width: int | None) -> DataFrame:
    """Name rows of the first round (``width`` None) or of cells ``at``."""
    def run(batches):
        name = Namer(length, anchor)
        for batch in batches:
            size, lo = 0, 0
            parts = []
            text = batch.column(batch.schema.get_field_index("text"))
            at = batch.column(batch.schema.get_field_index("at")) if width else None
            tid, copies = (batch.column(batch.schema.get_field_index(c)) for c in ("tid", "copies"))

            def flush(hi):
                return _batch(tid.slice(lo, hi - lo), copies.slice(lo, hi - lo).to_numpy(), parts)

            for k in range(batch.num_rows):
                b = np.frombuffer(text[k].as_buffer(), np.uint8)
                if width:
                    rows = at[k].values
                    parts.append(name.cells(b, *[rows.field(i).to_numpy(zero_copy_only=False)
                                                 for i in range(3)], width))
                else:
                    parts.append(name.anchors(b))
                size += len(parts[-1][0])
                if size > 50_000:
                    yield flush(k + 1)
                    size, lo, parts = 0, k + 1, []
            if parts:
                yield flush(batch.num_rows)

    cols = ["tid", "copies", F.col("text").cast("binary").alias("text")] + (["at"] if width else [])
    return texts.select(*cols).mapInArrow(run, T.StructType(_ROW))


def _judged(rows: DataFrame, name: str) -> DataFrame:
    """Rows of repeated cores: ``settled`` (their windows repeat) or ``open``
    (to be cut further), or both. Rows of one core and one region settle each
    other; where their core has other regions too, one of them stays open, as
    a partner for those. The rows are made twice (grouping, joining) rather
    than stored."""
    groups = rows.groupBy("core").agg(
        F.sum(_weight()).alias("n"), F.min("region").alias("least"), F.max("region").alias("most")
    ).filter("n > 1").select("core", (F.col("least") == F.col("most")).alias("settled"))
    # A text with copies repeats anyway: only its open rows are still of use.
    single = _weight() == 1
    found = stored(rows.join(groups, "core").filter(single | ~F.col("settled")), name)
    mixed = found.filter("not settled").drop("settled").withColumn("own", F.xxhash64("tid", "place"))
    twins = mixed.groupBy("core", "region").agg(F.sum(_weight()).alias("n"), F.min("own").alias("first")
                                                ).filter("n > 1").drop("n")
    mixed = mixed.join(twins, ["core", "region"], "left")
    alone = F.col("first").isNull()
    mixed = _unpacked(mixed, (~alone & single).alias("settled"), (alone | (F.col("own") == F.col("first"))).alias("open"))
    return stored(mixed.filter("settled or open"), name + "-open").unionByName(
        _unpacked(found.filter("settled"), "settled", F.lit(False).alias("open")))


def _windows(rows: DataFrame, name: str) -> DataFrame:
    """The last round: windows whose two names both repeat."""
    groups = rows.groupBy("core", "region").agg(F.sum(_weight()).alias("n")).filter("n > 1")
    hit = rows.filter(_weight() == 1).join(groups, ["core", "region"], "left_semi")
    return stored(_unpacked(hit).select("tid", "lo", "hi"), name)


def _cut(b: bytes, copies: int, at, length: int) -> tuple:
    """(digest, spans, removed bytes, rest, its digest) of one text."""
    if copies > 1:
        s, e = np.array([0]), np.array([len(b)])
    else:
        lo, hi = (at.values.field(i).to_numpy(zero_copy_only=False) for i in range(2))
        change = np.zeros(len(b) + 1, np.int64)
        np.add.at(change, lo, 1)
        np.add.at(change, hi + length, -1)
        s, e = edges(np.cumsum(change)[:-1] > 0)
    left, pos = [], 0
    for x, y in zip(s.tolist(), e.tolist()):
        left.append(b[pos:x])
        pos = y
    kept = b"".join(left + [b[pos:]])
    return (hashlib.sha256(b).hexdigest(), [{"start": x, "end": y} for x, y in zip(s.tolist(), e.tolist())],
            int((e - s).sum()), kept, hashlib.sha256(kept).hexdigest())


def _per_text(rows: DataFrame, fields: list[str]) -> DataFrame:
    """One row per text: its ranges (at most one per byte of it)."""
    return rows.groupBy("tid").agg(F.collect_list(F.struct(*fields)).alias("at"))


def repeated_spans(df: DataFrame, text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR,
                   cells: tuple[int, ...] = CELLS) -> DataFrame:
    """One row per text digest that repeats anything: ``sha`` (SHA-256 hex of
    the text), ``spans`` (maximal removed byte ranges), ``n_removed``,
    ``kept`` (remaining bytes, binary), ``kept_sha256``.

    A 200-byte string repeats when it also starts at any other place, of the
    same text, of another, or of a copy; ranges are bytes of the input. Null,
    empty and shorter texts repeat nothing. Cells must end with width 1.
    """
    if not anchor <= length <= MAX_LENGTH:
        raise ValueError(f"lengths up to {MAX_LENGTH} bytes are covered, with anchors no longer")
    spark = df.sparkSession
    sha = F.sha2(F.col(f"`{text_col}`").cast("binary"), 256)
    tid = F.unhex(F.substring(sha, 1, 32))
    texts = df.filter(F.octet_length(F.col(f"`{text_col}`")) >= length).select(
        tid.alias("tid"), F.col(f"`{text_col}`").alias("text")).groupBy("tid").agg(
        F.first("text").alias("text"), F.count("*").alias("copies"))
    # An external table: bucketed by digest, so joins by digest move no text.
    table = f"repeated_spans_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts.write.option("path", scratch_path(spark, "span-texts")).option("compression", "zstd").bucketBy(
        buckets, "tid").saveAsTable(table)
    texts = spark.table(table)

    rows = _judged(_rows(texts, length, anchor, None), "span-anchors")
    done = []
    for width in cells:
        done.append(rows.filter("settled").select("tid", "lo", "hi"))
        open_ = _per_text(rows.filter("open"), ["a", "lo", "hi"])
        made = _rows(texts.join(open_, "tid"), length, anchor, width)
        if width > 1:
            rows = _judged(made, f"span-cells-{width}")
        else:
            done.append(_windows(made, "span-windows"))
    settled = done[0]
    for d in done[1:]:
        settled = settled.union(d)
    spans = _per_text(settled, ["lo", "hi"])
    found = texts.join(spans, "tid", "left").filter("at is not null or copies > 1")

    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([T.StructField("sha", T.StringType()), T.StructField("spans", span),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.BinaryType()),
                           T.StructField("kept_sha256", T.StringType())])

    def cut(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for first, last in slices(batch.column(0)):
                part = batch.slice(first, last - first)
                out = [[] for _ in range(5)]
                for text, copies, at in zip(part.column(0), part.column(1).to_pylist(), part.column(2)):
                    for o, x in zip(out, _cut(text.as_buffer().to_pybytes(), copies, at, length)):
                        o.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, arrow.types)],
                                                 names=arrow.names)

    return found.select(F.col("text").cast("binary").alias("text"), "copies", "at").mapInArrow(cut, schema)


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      length: int = LENGTH, **kw) -> DataFrame:
    """For every row of ``df``: its id, ``n_bytes``, ``n_removed``,
    ``n_spans`` and ``kept_sha256``. Ids may be null or repeat; null texts
    count as empty; an empty table gives no rows."""
    found = repeated_spans(df, text_col, length, **kw).select(
        "sha", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    sha = fresh(df, "sha")
    rows = df.select(F.col(f"`{id_col}`"), F.octet_length(text).cast("long").alias("n_bytes"),
                     F.sha2(text.cast("binary"), 256).alias(sha))
    out = rows.join(stored(found, "span-results").withColumnRenamed("sha", sha), sha, "left")
    return out.select(F.col(f"`{id_col}`"), "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
                      F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
                      F.coalesce("kept_sha256", sha).alias("kept_sha256"))
