from collections import defaultdict

from pyspark.sql import functions as F

from linemill.llm.exact_dedup import drop_copies, exact_dedup
from linemill.operators import bitmaps

from .conftest import as_tuples

COLS = ["doc_id", "text", "keep_id", "group_size", "kept"]


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    out = []
    for i, t, *_ in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, t, keep, len(groups[t or ""]), keep == i))
    return sorted(out, key=repr)


def test_matches_brute_force(odd, odd_rows):
    assert as_tuples(exact_dedup(odd), *COLS) == brute(odd_rows)


def test_hot_groups_and_chance_bits_give_the_same(odd, odd_rows, monkeypatch):
    assert as_tuples(exact_dedup(odd, hot_copies=1), *COLS) == brute(odd_rows)
    monkeypatch.setattr(bitmaps, "BITMAP_BITS", 2)          # nearly every row passes every bitmap
    assert as_tuples(exact_dedup(odd), *COLS) == brute(odd_rows)


def test_rows_stay_spread_without_automatic_broadcasts(llm):
    """Nothing depends on the planner's broadcasts, and no key (null ones
    neither) collects the rows without copies, or a third of all rows."""
    rows = [(i, f"text {i:06d}") for i in range(20_000)] + [(30_000 + i, "one hot text") for i in range(10_000)]
    old = {c: llm.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled",
                                        "spark.sql.shuffle.partitions")}
    try:
        for c, v in zip(old, ("-1", "false", "16")):
            llm.conf.set(c, v)
        df = llm.createDataFrame(rows, "doc_id long, text string").repartition(16)
        out = exact_dedup(df, hot_copies=5000)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 4000 and sum(sizes) == 30_000
        assert as_tuples(out, *COLS) == brute(rows)
    finally:
        for c, v in old.items():
            llm.conf.set(c, v)


def test_same_length_and_head_are_not_enough(llm):
    head = "x" * 64
    rows = [(1, head + "a"), (2, head + "b"), (3, head + "a"), (4, "y" * 65)]
    df = llm.createDataFrame(rows, "doc_id long, text string")
    assert as_tuples(exact_dedup(df), *COLS) == brute(rows)


def test_empty_and_clashing_columns(none, odd):
    assert exact_dedup(none).count() == 0
    inner = ["l", "h", "f", "i", "n", "m1", "m2", "m3", "_at", "_ROW", "_map", "b_row", "b_map", "c0", "C1", "_hit"]
    clash = odd.withColumn("KEPT", F.lit("old")).withColumns({c: F.lit(c) for c in inner})
    out = exact_dedup(clash)
    assert out.columns == ["doc_id", "text", "lang", *inner, "keep_id", "group_size", "kept"]
    assert as_tuples(out, *COLS) == as_tuples(exact_dedup(odd), *COLS)
    assert {tuple(r) for r in out.select(*inner).collect()} == {tuple(inner)}
    kept = drop_copies(clash.withColumn("keep_id", F.lit(7)))
    assert kept.columns == [*clash.columns, "keep_id"] and kept.first()["KEPT"] == "old"


def test_drop_copies(odd):
    kept = as_tuples(drop_copies(odd), "doc_id", "text")
    assert (1, "Hello there, world") not in kept and (4, "Hello there, world") in kept
    assert (None, "Hello there, world") not in kept
