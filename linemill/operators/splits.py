"""Corpus unions and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import stable_hash
from .order import DEFAULT_DIGITS, aligned_shuffle
from .ranks import global_rank, hash_bucket, quota_labels


def sides(bitext: DataFrame, keys=("pair", "doc_no", "line_no")) -> DataFrame:
    """Both sides of a bitext as rows ``(keys..., side, lang, line)`` from one
    scan (a bounded two-element generator, no union of two scans)."""
    tgt_lang = F.substring("pair", 4, 8)
    both = F.array(
        F.struct(F.lit("src").alias("side"), F.lit("en").alias("lang"), F.col("src").alias("line")),
        F.struct(F.lit("tgt").alias("side"), tgt_lang.alias("lang"), F.col("tgt").alias("line")))
    return bitext.select(*keys, F.inline(both))


def concat_corpora(bitext: DataFrame, grouping: str = "pair", english_from: str = "en-de",
                   keys=("pair", "doc_no", "line_no")) -> DataFrame:
    """Concatenations of corpus files, duplicates kept (UNION ALL).

    ``pair``: both sides of each pair form corpus ``en-xx``;
    ``multilingual``: every side of every pair (English once per pair);
    ``language``: each language alone, English taken from ``english_from`` only."""
    if grouping not in GROUPINGS:
        raise ValueError(f"unknown grouping {grouping!r}")
    return concat_groupings(bitext, [grouping], english_from, keys).drop("grouping")


GROUPINGS = ("pair", "multilingual", "language")


def concat_groupings(bitext: DataFrame, groupings=GROUPINGS, english_from: str = "en-de",
                     keys=("pair", "doc_no", "line_no")) -> DataFrame:
    """U1 for several groupings from one scan: every side of a pair becomes
    one row per grouping that takes it (a bounded generator)."""
    s = sides(bitext, keys)
    kept = (F.col("side") == "tgt") | (F.col("pair") == english_from)
    corpus = {"pair": F.col("pair"), "multilingual": F.lit("multiling"),
              "language": F.when(kept, F.col("lang"))}
    rows = F.filter(F.array(*[F.struct(F.lit(g).alias("grouping"), corpus[g].alias("corpus"))
                              for g in groupings]), lambda x: x["corpus"].isNotNull())
    return s.select(*keys, "side", "lang", "line", F.inline(rows))


def append_to_split(base: DataFrame, extra: DataFrame, split: str = "train",
                    split_col: str = "split") -> DataFrame:
    """Add ``extra`` rows to ``split`` of ``base`` (reshuffle with O1 after)."""
    return base.unionByName(extra.withColumn(split_col, F.lit(split)), allowMissingColumns=True)


def append_and_shuffle(base: DataFrame, extra: DataFrame, keys: list[str], seed=42,
                       split: str = "train", group_cols=("pair",)) -> DataFrame:
    u = append_to_split(base, extra, split)
    return aligned_shuffle(u, keys, seed, group_cols=[*group_cols, "split"])


def concat_ordered(parts: DataFrame, part_order: list[str], part_col: str = "pair",
                   order_cols=("doc_no", "line_no"), out_col: str = "line_no_all",
                   bucket_width: int = 64) -> DataFrame:
    """Concatenate parts in a fixed order (e.g. de, et, fi) keeping both
    sides aligned: every row gets its 1-based position in the concatenation."""
    pos = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(part_order, start=1))):
        pos = F.when(F.col(part_col) == p, F.lit(i)).otherwise(pos)
    df = parts.withColumn("part_no", pos).filter(F.col("part_no").isNotNull())
    first = order_cols[0]
    bucket = F.col("part_no").cast("long") * F.lit(1 << 40) + F.floor(F.col(first) / bucket_width)
    return global_rank(df, ["part_no", *order_cols], bucket, rank_col=out_col)


def split_quota(df: DataFrame, keys: list[str], group_cols=("pair",), dev: int = 2500,
                test: int = 2500, quality: Column | None = None, seed=42,
                split_col: str = "split", digits: int = DEFAULT_DIGITS) -> DataFrame:
    """Q1: per group, the first ``dev`` rows of a seeded shuffle among rows
    that pass ``quality`` are dev, the next ``test`` are test, the rest train;
    rows failing ``quality`` are train."""
    d = df.withColumn("_h", stable_hash(seed, *keys))
    return quota_labels(d, ["_h", *keys], hash_bucket(F.col("_h"), digits), list(group_cols),
                        [("dev", dev), ("test", test)], split_col, "train", quality).drop("_h")


def hold_out(df: DataFrame, predicate: Column, name: str, split_col: str = "split") -> DataFrame:
    """Q2: move rows matching ``predicate`` into their own split ``name``."""
    return df.withColumn(split_col, F.when(predicate, F.lit(name)).otherwise(F.col(split_col)))


def leaked_rows(train: DataFrame, held: DataFrame, keys: list[str]) -> DataFrame:
    """Q2 check: train rows whose key is also in the hold-out (should be empty)."""
    return train.join(held.select(*keys).distinct(), keys, "left_semi")
