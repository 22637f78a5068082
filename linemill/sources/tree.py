"""The corpus tree as bucketed tables: one table a side, a folder a split,
lines bucketed and sorted by their keys. Sides written with the same keys and
bucket count lie in matching buckets, so pairing their lines (J1), with its
length check, reads both without an exchange, and a split reads its folder
only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT = "split"


def write_side(df: DataFrame, table: str, path: str, keys: list[str], buckets: int = 64) -> None:
    """Write one side (``split``, the keys, and its columns) as the external
    table ``table`` at ``path``. One exchange deals the lines to their buckets,
    so a bucket of a split is one file."""
    (df.repartition(buckets, *keys).write.partitionBy(SPLIT).bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).mode("overwrite").saveAsTable(table))


def read_side(spark: SparkSession, table: str, split: str | None = None) -> DataFrame:
    """A side, or one split of it (without the then constant column)."""
    df = spark.table(table)
    return df if split is None else df.filter(F.col(SPLIT) == split).drop(SPLIT)


def drop_sides(spark: SparkSession, *tables: str) -> None:
    """Forget tables; the files of external tables stay."""
    for t in tables:
        spark.sql(f"drop table if exists `{t}`")
