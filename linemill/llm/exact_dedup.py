"""Exact duplicates by progressive refinement: length, then prefix hash, then
full hash. A text's whole content is hashed only while its length and its
prefix are shared with another row.

What is known after each step (lengths, prefixes, full hashes that more than
one row has) reaches the rows as a bitmap of hash values: a broadcast of fixed
size, whatever the table's. A bit set by chance only lets a row go one step
further; the full hashes decide. So there is one plan at every size, and no
text is shuffled but that of rows that have copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bitmap, marked, stored

PREFIX_CHARS = 64
# Groups of more copies are broadcast (there are fewer than rows / HOT_COPIES
# of them), so that no task gets the rows of a hot one.
HOT_COPIES = 20_000


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS, hot_copies: int = HOT_COPIES) -> DataFrame:
    """``df`` plus ``keep_id``, ``group_size`` and ``kept``.

    Texts are equal when their bytes are; a null text counts as empty. Of
    equal texts the row with the largest id stays. Rows with a null id never
    stay beside a row with an id; where all ids of a group are null, or rows
    repeat the kept id, all rows with that id have ``kept`` true except that
    null ids keep nothing unless the group has no other. An empty table gives
    no rows. Other columns pass through; of clashing names the old ones go.

    Plan: lengths, prefixes of rows whose length is shared, and full SHA-256 of
    rows whose prefix is shared too: three aggregates, combined in the map
    tasks, so a text that a third of the rows hold reaches each reducer as one
    row per map task. Rows whose full hash is not shared leave here. Those of
    groups of up to ``hot_copies`` are joined to their group by shuffle, those
    of larger groups by broadcast.
    """
    new = ("keep_id", "group_size", "kept")
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in new])
    # Rows keep their columns under neutral names until the end.
    rows = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    place = {c: f"c{i}" for i, c in enumerate(df.columns)}
    key, text = F.col(place[id_col]), F.coalesce(F.col(place[text_col]), F.lit(""))
    length, head = F.octet_length(text), F.xxhash64(F.substring(text, 1, prefix_chars))
    full = F.unhex(F.sha2(text.cast("binary"), 256))

    def shared(keys: DataFrame, *cols: str) -> DataFrame:
        return keys.groupBy(*cols).agg(F.count("*").alias("n")).filter("n > 1")

    lengths = bitmap(shared(rows.select(length.alias("l")), "l"), "l")
    rows = marked(rows, lengths, "m1", length)
    heads = bitmap(shared(rows.filter("m1").select(length.alias("l"), head.alias("h")), "l", "h"), "l", "h")
    rows = marked(rows, heads, "m2", length, head)
    maybe = F.col("m1") & F.col("m2")
    groups = stored(rows.filter(maybe).select(full.alias("f"), key.alias("i")).groupBy("f").agg(
        F.max("i").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1"), "dedup-groups")
    # The full hash is made once for each row, null where it is not needed.
    rows = marked(rows.withColumn("f", F.when(maybe, full)), bitmap(groups, "f"), "m3", F.col("f"))
    rows = rows.withColumn("m3", F.col("m3") & F.col("f").isNotNull()).drop("m1", "m2")
    hot = F.broadcast(groups.filter(F.col("group_size") > hot_copies))
    rows = rows.join(hot, "f", "left").withColumn("m3", F.col("m3") & F.col("group_size").isNull())
    few = rows.filter("m3").drop("keep_id", "group_size").join(
        groups.filter(F.col("group_size") <= hot_copies), "f", "left")
    out = rows.filter("not m3").unionByName(few)
    alone = F.col("group_size").isNull()
    out = out.withColumn("keep_id", F.when(alone, key).otherwise(F.col("keep_id"))).withColumn(
        "group_size", F.coalesce("group_size", F.lit(1)))
    out = out.withColumn("kept", F.col("keep_id").eqNullSafe(key))
    return out.select(*[F.col(place[c]).alias(c) for c in df.columns], *new)


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with its own columns."""
    own = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    at = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return exact_dedup(own, at[id_col], at[text_col]).filter("kept").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)])
