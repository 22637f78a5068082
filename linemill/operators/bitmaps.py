"""Bitmaps of hash values: what is known about keys, as a broadcast of fixed
size. They let rows go early that cannot have a partner; a join decides about
the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

# Bits of a bitmap (2 MB), in rows of BITMAP_ROW bits.
BITMAP_BITS = 1 << 24
BITMAP_ROW = 1 << 15


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have yet, in any letter case."""
    name, taken = stem, {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def bitmap(keys: DataFrame, *cols: str) -> DataFrame:
    """The bits of the keys' hash values as a table of fixed size: at most
    ``BITMAP_BITS / BITMAP_ROW`` rows."""
    at = F.pmod(F.xxhash64(*cols), F.lit(BITMAP_BITS))
    bits = keys.select(at.alias("at")).select(
        F.expr(f"at div {BITMAP_ROW}").alias("b_row"), F.expr(f"at % {BITMAP_ROW}").alias("bit"))
    return stored(bits.groupBy("b_row").agg(F.bitmap_construct_agg("bit").alias("b_map")), "bitmap")


def marked(df: DataFrame, bits_of: DataFrame, flag: str, *cols: Column) -> DataFrame:
    """``df`` with ``flag``: whether the bit of its columns' hash value is
    set. Keys of the bitmap always are; others by chance."""
    at, row, bits = fresh(df, "_at"), fresh(df, "_row"), fresh(df, "_map")
    small = F.broadcast(bits_of.select(F.col("b_row").alias(row), F.col("b_map").alias(bits)))
    x = df.withColumn(at, F.pmod(F.xxhash64(*cols), F.lit(BITMAP_BITS)))
    x = x.withColumn(row, F.expr(f"`{at}` div {BITMAP_ROW}")).join(small, row, "left")
    byte = F.conv(F.hex(F.substring(F.col(bits), F.expr(f"cast(`{at}` % {BITMAP_ROW} div 8 + 1 as int)"), F.lit(1))),
                  16, 10).cast("int")
    one = F.expr(f"cast(shiftleft(1, cast(`{at}` % 8 as int)) as int)")
    return x.withColumn(flag, F.coalesce(byte.bitwiseAND(one) != 0, F.lit(False))).drop(at, row, bits)
