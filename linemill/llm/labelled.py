"""Labelled learning rows for the classifiers, with whole texts: all of them,
dealt to shards, or a bounded, repeatable sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, learning_rows


def held_out(id_col: str = "doc_id", mod: int = 3, rest: int = 1):
    """True for rows whose labels are never learnt."""
    return crc_mod(id_col, mod) == rest


def sample(docs: DataFrame, labels: DataFrame, label_col: str, salt: str, per_class: int,
           max_bytes: int, extra: list[str] = (), id_col: str = "doc_id", text_col: str = "text",
           by: str | None = None, calibration: bool | None = None) -> list[tuple]:
    """(text, label, *extra) on the driver: of the labelled, not held-out ids
    with a text of at most ``max_bytes`` bytes, at most ``per_class`` of each
    class, those with the smallest id hash. An id gives one row, its smallest
    such text, however often it is repeated; an id labelled twice counts with
    its larger label. Null ids are never learnt; a null text counts as empty.
    The picked ids are joined by broadcast: their number is bounded.

    With ``by``, a column of ``docs``, at most ``per_class`` of each class for
    each of its values. ``calibration`` takes the fifth of the ids set apart
    for calibration (true) or the others (false)."""
    i, t = F.col(f"`{id_col}`").alias("i"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t")
    short = docs.select(i, t, *[F.col(f"`{c}`").alias(f"x{k}") for k, c in enumerate(extra)]).filter(
        F.col("i").isNotNull() & (F.octet_length("t") <= max_bytes))
    lab = labels.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{label_col}`").cast("int").alias("y")
                        ).filter(F.col("y").isin(0, 1) & F.col("i").isNotNull() & ~held_out("i"))
    if calibration is not None:
        lab = lab.filter((F.pmod(F.xxhash64(F.lit("calibration"), F.col("i").cast("string")), F.lit(5)) == 4)
                         == F.lit(calibration))
    lab = lab.groupBy("i").agg(F.max("y").alias("y"))
    stratum = F.coalesce(F.col(f"`{by}`").cast("string"), F.lit("")) if by else F.lit("")
    eligible = docs.select(i, t, stratum.alias("s")).filter(F.octet_length("t") <= max_bytes).groupBy("i").agg(
        F.min("s").alias("s"))
    lab = lab.join(eligible, "i").withColumn("class", F.concat(F.col("y").cast("string"), F.lit(" "), "s"))
    picked = learning_rows(lab, "i", salt, per_class, "class").select("i", "y")
    rows = short.join(F.broadcast(picked), "i").groupBy("i", "y").agg(
        F.min(F.struct("t", *[f"x{k}" for k in range(len(extra))])).alias("r"))
    got = sorted(rows.collect(), key=lambda r: r["i"])
    return [(r["r"]["t"], r["y"], *r["r"][1:]) for r in got]


def _labels(labels: DataFrame, label_col: str, id_col: str) -> DataFrame:
    return labels.select(F.col(f"`{id_col}`").cast("string").alias("i"), F.col(f"`{label_col}`").cast("int").alias("y")
                         ).filter(F.col("y").isin(0, 1) & F.col("i").isNotNull() & ~held_out("i"))


def _texts(docs: DataFrame, id_col: str, text_col: str, extra: list) -> DataFrame:
    """(i, t, *extra) of the rows that are not held out."""
    return docs.select(F.col(f"`{id_col}`").cast("string").alias("i"),
                       F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias("t"), *extra
                       ).filter(F.col("i").isNotNull() & ~held_out("i"))


def labelled_lengths(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id",
                     text_col: str = "text") -> tuple[int, int]:
    """How many ids :func:`labelled_rows` has, and at most how many bytes of text."""
    size = _texts(docs, id_col, text_col, []).select("i", F.octet_length("t").cast("long").alias("n"))
    both = _labels(labels, label_col, id_col).unionByName(size, allowMissingColumns=True).groupBy("i").agg(
        F.max("y").alias("y"), F.max("n").alias("n")).filter("y is not null and n is not null")
    got = both.agg(F.count("i"), F.coalesce(F.sum("n"), F.lit(0))).first()
    return got[0], got[1]


def labelled_rows(docs: DataFrame, labels: DataFrame, label_col: str, lang_col: str, salt: str, shards: int,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(shard, i, cal, y, t, lang) of all labelled, not held-out ids, whatever the
    length of the text: ``cal`` for the fifth of the ids set apart for
    calibration. An id gives one row, its smallest text, however often it is
    repeated; an id labelled twice counts with its larger label. Null ids are
    never learnt; a null text counts as empty. A shard is what an id's hash says;
    its rows are in one partition, one after the other, ordered by another hash.

    Texts are moved once: labels and texts meet in the partition of their shard."""
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang")
    dealt = _labels(labels, label_col, id_col).unionByName(
        _texts(docs, id_col, text_col, [lang]), allowMissingColumns=True).withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(salt), "i"), F.lit(shards)).cast("int")).repartition(shards, "shard")
    rows = dealt.groupBy("shard", "i").agg(F.max("y").alias("y"), F.min(F.when(
        F.col("t").isNotNull(), F.struct("t", "lang"))).alias("r")).filter("y is not null and r is not null")
    cal = F.pmod(F.xxhash64(F.lit("calibration"), "i"), F.lit(5)) == 4
    return rows.select("shard", "i", cal.alias("cal"), "y", "r.t", "r.lang").sortWithinPartitions(
        "shard", F.xxhash64(F.lit("order"), "i"), "i")
