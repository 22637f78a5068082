"""Joins of the corpus pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import UNK_ID
from ..session import checkpoint_dir, stored
from .bitmaps import bitmap, fresh, marked


class AlignmentError(ValueError):
    """The two sides of a parallel corpus do not have the same lines."""


def zip_parallel(src: DataFrame, tgt: DataFrame, keys: list[str], strict: bool = True) -> DataFrame:
    """Pair line *i* of one side with line *i* of the other.

    A shuffled equi-join on the line keys (both sides are large; no side is
    broadcast). With ``strict`` a full outer count first checks that every
    key has a partner, as the reference's length check does."""
    if strict:
        probe = src.select(*keys, F.lit(1).alias("_s")).join(
            tgt.select(*keys, F.lit(1).alias("_t")), keys, "full_outer")
        orphans = probe.filter(F.col("_s").isNull() | F.col("_t").isNull()).limit(1).count()
        if orphans:
            raise AlignmentError("parallel sides differ in length or keys")
    return src.join(tgt, keys, "inner")


def ref_to_src_member(member_col) -> F.Column:
    """J2 name rule ``${name%ref.*}src.en.sgm``: cut from the last ``ref.``."""
    c = member_col if isinstance(member_col, F.Column) else F.col(member_col)
    return F.concat(F.regexp_extract(c, r"^(.*)ref\.[^/]*$", 1), F.lit("src.en.sgm"))


def pair_ref_src(members: DataFrame, ref_pattern: str = r"ref\.[a-z]{2}\.sgm$") -> DataFrame:
    """Each reference member with the source member named after it.

    ``members(archive, member, text)``; sources without a reference drop out.
    Output ``(archive, set, ref_member, ref_lang, ref_text, src_member, src_text)``."""
    refs = members.filter(F.col("member").rlike(ref_pattern)).select(
        "archive", F.col("member").alias("ref_member"), F.col("text").alias("ref_text"),
        F.regexp_extract("member", r"ref\.([a-z]{2})\.sgm$", 1).alias("ref_lang"),
        ref_to_src_member("member").alias("src_member"))
    srcs = members.select("archive", F.col("member").alias("src_member"),
                          F.col("text").alias("src_text"))
    out = refs.join(srcs, ["archive", "src_member"], "inner")
    return out.withColumn("set", F.regexp_extract("ref_member", r"([^/]*)-ref\.", 1)).select(
        "archive", "set", "ref_member", "ref_lang", "ref_text", "src_member", "src_text")


def lookup_ids(df: DataFrame, pieces_col: str, vocab: DataFrame, out_col: str = "ids",
               key_cols: list[str] | None = None, max_vocab: int = 1 << 20) -> DataFrame:
    """Piece strings to ids through ``vocab(piece, id)``; unknown -> 3.

    A subword vocabulary is bounded by its declared size, which is checked
    here before it is broadcast; the exploded pieces (the large side) are
    never shuffled, so a piece holding a third of all rows costs nothing
    extra. Output is long: ``(keys..., _pos, id)``."""
    # Computed once: checked and joined from the same checkpoint.
    checkpoint_dir(df.sparkSession)
    vocab = vocab.select("piece", "id").limit(max_vocab + 1).checkpoint()
    n = vocab.count()
    if n > max_vocab:
        raise ValueError(f"the vocabulary exceeds the broadcast bound of {max_vocab} pieces")
    key_cols = key_cols or [c for c in df.columns if c != pieces_col]
    ex = df.select(*key_cols, F.posexplode(pieces_col).alias("_pos", "piece"))
    joined = ex.join(F.broadcast(vocab.select("piece", "id")), "piece", "left")
    return joined.select(*key_cols, "_pos", F.coalesce("id", F.lit(UNK_ID)).alias("id"))


def line_offsets(lines: DataFrame, file_col: str = "doc_id") -> DataFrame:
    """Per file: its line count and the global index of its first line when
    files are taken in ``file_col`` order (any sortable type). The file table
    (one row per file) is range-partitioned by the key and stored, so that its
    partition numbers are ordered buckets for the prefix sum."""
    from .ranks import exclusive_prefix_sum
    checkpoint_dir(lines.sparkSession)
    per_file = lines.groupBy(file_col).agg(F.count(F.lit(1)).alias("n_lines"))
    per_file = per_file.repartitionByRange(file_col).withColumn("_part", F.spark_partition_id()).checkpoint()
    return exclusive_prefix_sum(per_file, [file_col], F.col("_part"), F.col("n_lines"),
                                out_col="start").drop("_part")


# Samples of one bucket of the interval lookup.
SPAN = 1 << 16


def locate(idx: DataFrame, offsets: DataFrame, file_col: str = "doc_id", span: int = SPAN) -> DataFrame:
    """The rows of ``idx`` whose global index ``i`` lies in a file, with
    ``file_col`` and ``line_no``.

    An interval lookup of indices against the files' ranges: positions are
    cut into buckets of ``span`` samples; a bucket gets its indices, the files
    that start in it, and the file that reaches into it, and sorted by position
    every index belongs to the file last seen. Linear in both sides; a bucket
    holds at most ``span`` + 1 files, however long or short they are."""
    at, kind, file = fresh(idx, "_at"), fresh(idx, "_kind"), fresh(idx, "_file")
    bucket = fresh(idx, "_bucket")
    files = offsets.filter("n_lines > 0").select(
        F.struct(F.col(file_col).alias("f"), F.col("start").cast("long").alias("s"),
                 (F.col("start") + F.col("n_lines")).cast("long").alias("e")).alias(file))
    first, last = F.expr(f"`{file}`.s div {span}"), F.expr(f"(`{file}`.e - 1) div {span}")
    files = files.select(file, F.explode(F.sequence(first, last)).alias(bucket)).withColumns({
        at: F.greatest(F.col(f"{file}.s"), F.col(bucket) * span), kind: F.lit(0)})
    asked = idx.withColumns({bucket: F.expr(f"cast(floor(i / {span}) as bigint)"), at: F.col("i").cast("long"),
                             kind: F.lit(1)})
    both = asked.unionByName(files, allowMissingColumns=True)
    seen = F.last(file, ignorenulls=True).over(
        Window.partitionBy(bucket).orderBy(at, kind).rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn(file, seen).filter((F.col(kind) == 1) & (F.col(at) < F.col(f"{file}.e")))
    return found.select(*idx.columns, F.col(f"{file}.f").alias(file_col),
                        (F.col(at) - F.col(f"{file}.s")).alias("line_no"))


def sample_at(idx: DataFrame, lines: DataFrame, offsets: DataFrame, file_col: str = "doc_id",
              first_size=None, columns: list[str] = ()) -> DataFrame:
    """Global sample index ``i`` -> (file, line), and the named ``columns``
    of that line.

    ``offsets(file, n_lines, start)`` gives each file's first global index.
    :func:`locate` finds the file and line of every index without the lines;
    they are only read for ``columns``. A bitmap of the wanted (file, line)
    keys, of fixed size, first lets all other lines go where they are read, so
    that the join exchanges the wanted ones. The reference's equal-size formula
    (``i // first_size``, ``i % first_size``) is added for comparison when
    ``first_size`` is given."""
    out = locate(idx, offsets, file_col)
    if columns:
        keys = [file_col, "line_no"]
        out = stored(out, "sample-places")
        flag = fresh(lines, "_wanted")
        wanted = marked(lines, bitmap(out, *keys), flag, *[F.col(k) for k in keys]).filter(flag)
        out = out.join(wanted.select(*keys, *columns), keys, "inner")
    if first_size is not None:
        fs = first_size if isinstance(first_size, F.Column) else F.lit(first_size)
        out = out.withColumn("ref_file", F.floor(F.col("i") / fs)).withColumn(
            "ref_sample", F.col("i") % fs)
    return out
