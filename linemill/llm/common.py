"""Helpers shared by the operators of this subpackage: Arrow row passes over
text, byte-domain word and hash arrays, and the session's shared folder."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.bitmaps import bitmap, fresh, marked  # noqa: F401  (for the operators)
from ..session import stored  # noqa: F401

# Texts are handled in slices of about this many bytes, so the numpy arrays of
# a task stay small however many rows an Arrow batch holds.
SLICE_BYTES = 1 << 20


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_pass(df: DataFrame, text_col: str, fields: list[T.StructField],
              make: Callable[[], Callable[[list], list]], keep: list[str] | None = None,
              explode: bool = False, limit: int | None = None) -> DataFrame:
    """Run a text function beside the rows: no shuffle, Arrow batches.

    ``make()`` is called once per task and returns ``f(texts) -> list of
    columns``, ``texts`` being a list of UTF-8 ``bytes`` (null: empty). The
    result has the columns ``keep`` (default: all but the text) and then
    ``fields``. With ``explode`` the function returns its row indices as an
    extra first column, so a text can give any number of rows. A kept column
    whose name a new one takes (in any letter case) goes. The function gets
    about ``limit`` bytes of text at a time (default: ``SLICE_BYTES``).
    """
    keep = [c for c in df.columns if c != text_col] if keep is None else keep
    keep = [c for c in keep if c.lower() not in {f.name.lower() for f in fields}]
    at = fresh(df, "_text")
    src = df.select(*[F.col(f"`{c}`") for c in keep],
                    F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias(at))
    schema = T.StructType([src.schema[c] for c in keep] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        arrow = None
        for b in batches:
            col = b.column(b.num_columns - 1)
            kept = [b.column(i) for i in range(b.num_columns - 1)]
            if arrow is None:
                from pyspark.sql.pandas.types import to_arrow_schema
                arrow = to_arrow_schema(schema)
            for lo, hi in slices(col, limit or SLICE_BYTES):
                texts = col.slice(lo, hi - lo).to_pylist()
                out = f(texts)
                if explode:
                    idx = pa.array(out[0], type=pa.int64())
                    cols = [c.slice(lo, hi - lo).take(idx) for c in kept]
                    out = out[1:]
                else:
                    cols = [c.slice(lo, hi - lo) for c in kept]
                cols += [x if isinstance(x, pa.Array) else pa.array(x, type=arrow.field(len(kept) + i).type)
                         for i, x in enumerate(out)]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(t) if c.type != t else c for c, t in zip(cols, arrow.types)],
                    names=arrow.names)

    return src.mapInArrow(run, schema)


def fold_pass(df: DataFrame, text_col: str, schema: T.StructType | str, make: Callable[[], tuple],
              keep: list[str] = ()) -> DataFrame:
    """Fold the texts of each task into few rows, Arrow batches in and out.

    ``make()`` is called once per task and returns ``feed(texts, *kept)``,
    which may return rows (a list of columns) that leave the task at once, and
    ``rest()``, which returns the columns of the last ones, or None.
    """
    src = df.select(*[F.col(f"`{c}`") for c in keep],
                    F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias(fresh(df, "_text")))
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        feed, rest = make()

        def batch(cols):
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, arrow.types)],
                                              names=arrow.names)
        for b in batches:
            col = b.column(b.num_columns - 1)
            for lo, hi in slices(col):
                cols = feed(col.slice(lo, hi - lo).to_pylist(),
                            *[b.column(i).slice(lo, hi - lo).to_pylist() for i in range(b.num_columns - 1)])
                if cols is not None:
                    yield batch(cols)
        cols = rest()
        if cols is not None:
            yield batch(cols)

    return src.mapInArrow(run, schema)


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a binary column that hold about ``limit`` bytes each."""
    n = len(col)
    if not n:
        return
    off = np.frombuffer(col.buffers()[1], np.int32 if pa.types.is_binary(col.type)
                        or pa.types.is_string(col.type) else np.int64)
    off = off[col.offset: col.offset + n + 1].astype(np.int64)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def grouped(texts: list[bytes], limit: int) -> Iterator[list[bytes]]:
    """The texts in order, in lists of about ``limit`` bytes."""
    now, size = [], 0
    for t in texts:
        if now and size + len(t) > limit:
            yield now
            now, size = [], 0
        now.append(t)
        size += len(t)
    if now:
        yield now


def pieces(text: bytes, limit: int, border: re.Pattern) -> Iterator[bytes]:
    """The text in order, cut behind the first match of ``border`` at least
    ``limit`` bytes on; a stretch without such a place stays whole."""
    lo, n = 0, len(text)
    while n - lo > limit:
        m = border.search(text, lo + limit)
        if m is None:
            break
        yield text[lo:m.end()]
        lo = m.end()
    if lo < n or not n:
        yield text[lo:]


def same_bytes(x: np.ndarray, a: np.ndarray, y: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether ``x[a:a+n]`` equals ``y[b:b+n]``, for arrays of ranges (n > 0)."""
    if not len(n):
        return np.zeros(0, bool)
    first = np.cumsum(n) - n
    step = np.arange(first[-1] + n[-1])
    differ = x[step + np.repeat(a - first, n)] != y[step + np.repeat(b - first, n)]
    return ~np.logical_or.reduceat(differ, first)


def odd_table(seed: int) -> np.ndarray:
    """256 random 64-bit values, one per byte."""
    return np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)


class RollingHash:
    """Polynomial hashes mod 2^64 of any byte range by prefix sums.

    ``prefix(b)`` gives H with ``H[j] - H[i]`` = sum of ``tab[b[t]] * B^t``;
    multiplying by ``B^-i`` removes the position. Values are mixed at the end
    because the low bits of such sums are weak.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.tab = odd_table(seed + 1)
        self.base = int(rng.integers(1, 1 << 62)) * 4 + 1
        self.inv = pow(self.base, -1, 1 << 64)
        self.pw = self.pi = np.ones(0, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.pw) >= n:
            return
        m = max(n, 1 << 16)
        a, c = np.full(m, self.base, np.uint64), np.full(m, self.inv, np.uint64)
        a[0] = c[0] = 1
        self.pw, self.pi = np.multiply.accumulate(a), np.multiply.accumulate(c)

    def prefix(self, b: np.ndarray) -> np.ndarray:
        self.grow(len(b) + 1)
        h = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(self.tab[b] * self.pw[:len(b)], out=h[1:])
        return h

    def ranges(self, h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((h[end] - h[start]) * self.pi[start] + (end - start).astype(np.uint64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def joined(texts: list[bytes], sep: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, each followed by ``sep``; and where each
    begins (one more entry: the end)."""
    buf = np.frombuffer(sep.join(texts) + sep, np.uint8)
    lens = np.fromiter(map(len, texts), np.int64, len(texts)) + len(sep)
    return buf, np.concatenate([[0], np.cumsum(lens)])


def edges(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    d = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return d[::2], d[1::2]


def crc_mod(col, m: int):
    """``crc32(col as text) mod m`` (null: 0)."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{col}`").cast("string").cast("binary")), F.lit(m)), F.lit(0))


def learning_rows(df: DataFrame, id_col: str, salt: str, per_class: int, class_col: str,
                  buckets: int = 64) -> DataFrame:
    """A bounded, repeatable sample: at most ``per_class`` rows of each class,
    those with the smallest hash of their id. Two row_number passes, the first
    inside hash buckets, so a class that holds most rows is spread out."""
    from pyspark.sql import Window as W
    h, b, r = "_lr_hash", "_lr_bucket", "_lr_rank"
    x = df.withColumn(h, F.xxhash64(F.lit(salt), F.col(f"`{id_col}`").cast("string")))
    x = x.withColumn(b, F.pmod(F.col(h), F.lit(buckets)))
    x = x.withColumn(r, F.row_number().over(W.partitionBy(class_col, b).orderBy(h, id_col))
                     ).filter(F.col(r) <= per_class)
    x = x.withColumn(r, F.row_number().over(W.partitionBy(class_col).orderBy(h, id_col))
                     ).filter(F.col(r) <= per_class)
    return x.drop(h, b, r)
