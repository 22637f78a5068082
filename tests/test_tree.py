"""Bucketed sides of a corpus meet without an exchange."""

from pyspark.sql import functions as F

from linemill.operators.joins import zip_parallel
from linemill.sources.tree import drop_sides, read_side, write_side

KEYS = ["pair", "line_no"]


def test_zip_of_bucketed_sides_has_no_exchange(spark, tmp_dir):
    rows = [(p, s, n, f"{p} {s} {n}") for p in ("en-de", "en-fi") for s in ("dev", "train") for n in range(200)]
    df = spark.createDataFrame(rows, "pair string, split string, line_no long, text string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for side in ("src", "tgt"):
            write_side(df.select("pair", "split", "line_no", F.concat(F.lit(side + " "), "text").alias(side)),
                       f"tree_test_{side}", f"{tmp_dir}/{side}", KEYS, buckets=4)
        out = zip_parallel(read_side(spark, "tree_test_src", "dev"), read_side(spark, "tree_test_tgt", "dev"), KEYS)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        got = sorted(map(tuple, out.collect()))
        assert got == [(p, n, f"src {p} dev {n}", f"tgt {p} dev {n}") for p in ("en-de", "en-fi") for n in range(200)]
        assert read_side(spark, "tree_test_src").count() == 800
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        drop_sides(spark, "tree_test_src", "tree_test_tgt")
