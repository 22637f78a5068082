"""Global ranks without a single-partition window.

``Window.orderBy`` with no ``partitionBy`` moves every row into one task.
Instead rows are cut into ordered buckets (a prefix of the sort key), each
bucket is ranked in its own window partition, and a small table of bucket
counts turns into per-bucket offsets by a prefix sum. The rows are dealt to
their buckets once: counting and ranking read the same exchange, so the input
is evaluated once.

Bucket tables have one row per (group, bucket). Hash buckets are bounded by
their digits; integer buckets can be as many as ids are sparse, so their
prefix sum runs in two levels and no task sees more than ``SUPER`` of them.

Skew: for hash-ordered keys every bucket holds about ``rows / 16**digits``
rows of its group, however large one group is (a group holding a third of
all rows is split into as many buckets as any other).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Buckets per window partition of the first prefix-sum level.
SUPER = 4096


def _cols(xs) -> list[Column]:
    return [x if isinstance(x, Column) else F.col(x) for x in xs]


def hash_bucket(hex_col: Column, digits: int = 4) -> Column:
    """Ordered bucket of a hex sort key: its first ``digits`` characters."""
    return F.substring(hex_col, 1, digits)


def prefix_sums(sums: DataFrame, group_cols: list[str], bucket_col: str, weight_col: str,
                out_col: str) -> DataFrame:
    """Sum of ``weight_col`` over all earlier buckets of the group. ``sums``
    has one row per (group, bucket). Integer buckets are summed in two levels;
    string buckets (hash prefixes, bounded) in one."""
    one = Window.partitionBy(*group_cols).orderBy(bucket_col).rowsBetween(Window.unboundedPreceding, -1)
    if not isinstance(sums.schema[bucket_col].dataType, T.IntegralType):
        return sums.withColumn(out_col, F.coalesce(F.sum(weight_col).over(one), F.lit(0)))
    s = sums.withColumn("_sup", F.floor(F.col(bucket_col) / SUPER))
    inner = Window.partitionBy(*group_cols, "_sup").orderBy(bucket_col).rowsBetween(
        Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*group_cols).orderBy("_sup").rowsBetween(Window.unboundedPreceding, -1)
    tops = s.groupBy(*group_cols, "_sup").agg(F.sum(weight_col).alias("_w")).select(
        *group_cols, "_sup", F.coalesce(F.sum("_w").over(outer), F.lit(0)).alias("_before"))
    s = s.withColumn("_in", F.coalesce(F.sum(weight_col).over(inner), F.lit(0)))
    return s.join(tops, [*group_cols, "_sup"]).withColumn(out_col, F.col("_before") + F.col("_in")).drop(
        "_sup", "_before", "_in")


def bucket_offsets(df: DataFrame, group_cols: list[str], bucket_col: str) -> DataFrame:
    """Rows per (group, bucket) and the count of all earlier buckets of the group."""
    counts = df.groupBy(*group_cols, bucket_col).agg(F.count(F.lit(1)).alias("_n"))
    return prefix_sums(counts, group_cols, bucket_col, "_n", "_off")


def _dealt(df: DataFrame, group_cols: list[str], bucket: Column) -> DataFrame:
    """Rows with their bucket, dealt to tasks by (group, bucket)."""
    return df.withColumn("_bkt", bucket).repartition(*group_cols, "_bkt")


def exclusive_prefix_sum(df: DataFrame, order_cols, bucket: Column, weight: Column,
                         group_cols=(), out_col: str = "start") -> DataFrame:
    """Sum of ``weight`` over all earlier rows of the group in ``order_cols``
    order (0 for the first row), computed bucket by bucket like
    :func:`global_rank`. Used for global line offsets of files."""
    group_cols = list(group_cols)
    b = _dealt(df.withColumn("_w", weight), group_cols, bucket)
    sums = prefix_sums(b.groupBy(*group_cols, "_bkt").agg(F.sum("_w").alias("_bw")),
                       group_cols, "_bkt", "_bw", "_boff").drop("_bw")
    w = Window.partitionBy(*group_cols, "_bkt").orderBy(*_cols(order_cols)).rowsBetween(
        Window.unboundedPreceding, -1)
    inner = b.withColumn("_in", F.coalesce(F.sum("_w").over(w), F.lit(0)))
    out = inner.join(sums, [*group_cols, "_bkt"], "inner")
    return out.withColumn(out_col, (F.col("_boff") + F.col("_in")).cast("long")).drop(
        "_bkt", "_w", "_in", "_boff")


def global_rank(df: DataFrame, order_cols, bucket: Column, group_cols=(),
                rank_col: str = "rank") -> DataFrame:
    """1-based rank of every row within ``group_cols`` by ``order_cols``.

    ``bucket`` must be monotone in the order (for example a prefix of a hex
    hash that is the first order column). Equal to
    ``row_number() over (partition by groups order by order_cols)``.
    """
    group_cols = list(group_cols)
    b = _dealt(df, group_cols, bucket)
    offsets = bucket_offsets(b, group_cols, "_bkt").select(*group_cols, "_bkt", "_off")
    w = Window.partitionBy(*group_cols, "_bkt").orderBy(*_cols(order_cols))
    ranked = b.withColumn("_rn", F.row_number().over(w))
    # offsets has one row per non-empty (group, bucket); the planner may
    # broadcast it when its statistics are small, otherwise it shuffles.
    out = ranked.join(offsets, [*group_cols, "_bkt"], "inner")
    return out.withColumn(rank_col, (F.col("_off") + F.col("_rn")).cast("long")).drop(
        "_bkt", "_rn", "_off")


def quota_labels(df: DataFrame, order_cols, bucket: Column, group_cols, quotas,
                 label_col: str, rest: str, eligible: Column | None = None) -> DataFrame:
    """Label the first ``n1`` rows of each group (in order) with ``name1``, the
    next ``n2`` with ``name2`` and so on; all others get ``rest``. Rows that
    are not ``eligible`` are not counted and get ``rest``.

    Bucket counts name the bucket in which each quota ends; only the rows of
    those buckets are ranked, and only to find the key of the last row inside
    the quota. Every row is then labelled by comparing its key with its
    group's thresholds (one small row per group), so the data itself is
    neither sorted nor shuffled.
    """
    if not group_cols:              # one group of all rows
        return quota_labels(df.withColumn("_all", F.lit(0)), order_cols, bucket, ["_all"], quotas,
                            label_col, rest, eligible).drop("_all")
    group_cols, order_cols = list(group_cols), list(order_cols)
    ends, acc = [], 0
    for name, n in quotas:
        acc += int(n)
        ends.append((name, acc))
    ok = eligible if eligible is not None else F.lit(True)
    b = df.withColumn("_ok", F.coalesce(ok, F.lit(False))).withColumn("_bkt", bucket)
    counted = b.filter("_ok")
    offs = bucket_offsets(counted, group_cols, "_bkt")
    last = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(hi).cast("long").alias("hi"))
                               for i, (_, hi) in enumerate(ends)]))
    found = offs.select(*group_cols, "_bkt", "_off", "_n", last.alias("q")).filter(
        (F.col("_off") < F.col("q.hi")) & (F.col("q.hi") <= F.col("_off") + F.col("_n"))).select(
        *group_cols, "_bkt", "_off", "q.i", "q.hi")
    w = Window.partitionBy(*group_cols, "_bkt", "i").orderBy(*_cols(order_cols))
    key = F.struct(*[F.col(c) for c in order_cols])
    edge = (counted.select(*{*group_cols, "_bkt", *order_cols}).join(found, [*group_cols, "_bkt"])
            .withColumn("_rn", F.row_number().over(w)).filter(F.col("_off") + F.col("_rn") == F.col("hi")))
    limits = edge.groupBy(*group_cols).agg(*[
        F.max(F.when(F.col("i") == i, key)).alias(f"_k{i}") for i in range(len(ends))])
    # A quota of 0 rows ends before every key; a group with fewer rows than a
    # quota has no threshold for it and is inside as a whole.
    label = F.lit(rest)
    for i, (name, hi) in reversed(list(enumerate(ends))):
        inside = F.lit(False) if hi <= 0 else F.col(f"_k{i}").isNull() | (key <= F.col(f"_k{i}"))
        label = F.when(inside, F.lit(name)).otherwise(label)
    out = b.join(limits, group_cols, "left")
    return out.withColumn(label_col, F.when(F.col("_ok"), label).otherwise(F.lit(rest))).drop(
        "_ok", "_bkt", *[f"_k{i}" for i in range(len(ends))])
