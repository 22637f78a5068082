"""Shuffles, splits and ranks: properties and partition invariance."""

from pyspark.sql import functions as F

from linemill.operators.order import aligned_shuffle
from linemill.operators.splits import split_quota
from linemill.plans import tables as T

from conftest import SF_MID

KEYS = ["pair", "doc_no", "line_no"]


def _ranks(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        b = T.bitext(spark, SF_MID).select(*KEYS)
        return sorted(tuple(r) for r in aligned_shuffle(b, KEYS, seed=7).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_shuffle_is_partition_invariant_permutation(spark):
    r1, r4, r64 = _ranks(spark, 1), _ranks(spark, 4), _ranks(spark, 64)
    assert r1 == r4 == r64
    ranks = sorted(r[-1] for r in r1)
    assert ranks == list(range(1, len(ranks) + 1))


def test_split_quota_exact_sizes(spark):
    b = T.bitext(spark, SF_MID)
    s = split_quota(b, KEYS, dev=100, test=50, seed=3)
    counts = {(r.pair, r.split): r["count"] for r in s.groupBy("pair", "split").count().collect()}
    for pair in ("en-de", "en-es", "en-fr"):
        assert counts[(pair, "dev")] == 100 and counts[(pair, "test")] == 50
    assert s.count() == b.count()
    assert s.select(*KEYS).distinct().count() == b.count()


def _at(spark, parts, fn):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        return sorted(tuple(r) for r in fn().collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_quota_offsets_and_epochs_are_partition_invariant(spark):
    from linemill.operators.joins import line_offsets
    from linemill.operators.order import epoch_order
    b = lambda: split_quota(T.bitext(spark, SF_MID), KEYS, dev=50, test=50, seed=1)
    o = lambda: line_offsets(T.lines(spark, SF_MID))
    e = lambda: epoch_order(T.lines(spark, SF_MID).select("doc_id", "line_no"),
                            ["doc_id", "line_no"], seed=3, epoch=[0, 1])
    for fn in (b, o, e):
        assert _at(spark, 1, fn) == _at(spark, 64, fn)


def test_global_rank_equals_row_number(spark):
    from pyspark.sql import Window
    from linemill.operators.ranks import global_rank, hash_bucket
    from linemill.functions.hashing import stable_hash
    ln = T.lines(spark, SF_MID).select("doc_id", "line_no", "lang")
    h = ln.withColumn("h", stable_hash(9, "doc_id", "line_no"))
    ours = global_rank(h, ["h", "doc_id", "line_no"], hash_bucket(F.col("h"), 2), ["lang"], "r")
    ref = h.withColumn("r", F.row_number().over(
        Window.partitionBy("lang").orderBy("h", "doc_id", "line_no")))
    assert sorted(tuple(r) for r in ours.collect()) == sorted(tuple(r) for r in ref.select(*ours.columns).collect())


def test_quota_labels_match_row_number_for_any_quota(spark):
    """Coarse buckets (one hex digit) put quota boundaries inside buckets;
    the labels must still equal ranking every row."""
    from pyspark.sql import Window
    from linemill.functions.hashing import stable_hash
    from linemill.operators.ranks import hash_bucket, quota_labels
    ln = T.lines(spark, SF_MID).select("doc_id", "line_no", "lang").withColumn(
        "h", stable_hash(11, "doc_id", "line_no")).persist()
    ref = ln.withColumn("r", F.row_number().over(
        Window.partitionBy("lang").orderBy("h", "doc_id", "line_no")))
    for dev, test in ((1, 1), (37, 500), (1000, 0), (5000, 5000)):
        want = ref.select("doc_id", "line_no", F.when(F.col("r") <= dev, "dev")
                          .when(F.col("r") <= dev + test, "test").otherwise("train").alias("s"))
        got = quota_labels(ln, ["h", "doc_id", "line_no"], hash_bucket(F.col("h"), 1), ["lang"],
                           [("dev", dev), ("test", test)], "s", "train").select("doc_id", "line_no", "s")
        assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())
    ln.unpersist()
