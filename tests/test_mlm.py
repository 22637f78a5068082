"""Masking and example properties."""

from pyspark.sql import functions as F

from linemill.functions.arrays import frame_truncate, mlm_mask, mlm_mask_many
from linemill.operators.mlm import mlm_examples
from linemill.plans import tables as T

from conftest import SF_MID


def test_mask_share_specials_and_labels(spark):
    a = T.toy_id_arrays(T.lines(spark, SF_MID))
    ex = mlm_examples(a, "ids", ["doc_id", "line_no"], max_length=32, epoch=0, seed=42, p=0.15)
    z = ex.select(F.explode(F.arrays_zip("input_ids", "labels")).alias("z")).select("z.*")
    stats = z.agg(
        F.count_if(~F.col("labels").isin(0, 1, 2)).alias("maskable"),
        F.count_if(F.col("input_ids") != F.col("labels")).alias("changed"),
        F.count_if(F.col("labels").isin(0, 1, 2) & (F.col("input_ids") != F.col("labels"))).alias("bad"),
        F.count_if((F.col("input_ids") != F.col("labels")) & (F.col("input_ids") != 4)).alias("not4"),
    ).first()
    share = stats.changed / stats.maskable
    assert 0.14 < share < 0.16
    assert stats.bad == 0 and stats.not4 == 0


def test_mask_changes_with_epoch(spark):
    df = spark.createDataFrame([(1, 1, list(range(5, 200)))], "doc_id long, line_no long, ids array<int>")
    e0 = df.select(mlm_mask(F.col("ids"), ["doc_id", "line_no"], 0, 42).alias("m")).first().m
    e1 = df.select(mlm_mask(F.col("ids"), ["doc_id", "line_no"], 1, 42).alias("m")).first().m
    assert e0 != e1


def test_frame_truncate_keeps_specials(spark):
    df = spark.createDataFrame([(list(range(5, 50)),)], "ids array<int>")
    f = df.select(frame_truncate("ids", 8).alias("f")).first().f
    assert list(f) == [0, 5, 6, 7, 8, 9, 10, 2]


def test_fast_draw_share_and_specials(spark):
    a = T.toy_id_arrays(T.lines(spark, SF_MID))
    ex = mlm_examples(a, "ids", ["doc_id", "line_no"], max_length=32, epoch=1, seed=7, p=0.15,
                      draw="xxhash64")
    z = ex.select(F.explode(F.arrays_zip("input_ids", "labels")).alias("z")).select("z.*")
    s = z.agg(F.count_if(~F.col("labels").isin(0, 1, 2)).alias("m"),
              F.count_if(F.col("input_ids") != F.col("labels")).alias("c"),
              F.count_if(F.col("labels").isin(0, 1, 2) & (F.col("input_ids") != F.col("labels")))
              .alias("bad")).first()
    assert 0.14 < s.c / s.m < 0.16 and s.bad == 0


def test_mask_key_is_made_once_a_row(spark):
    """The row's part of the md5 key is bound outside the draw of a position,
    and the draws are those of the whole key."""
    import hashlib
    df = spark.createDataFrame([(7, 3, [0, 9, 9, 9, 2])], "doc_id long, line_no long, ids array<int>")
    out = df.select(mlm_mask(F.col("ids"), ["doc_id", "line_no"], 1, 42).alias("m"))
    draw = [hashlib.md5(f"42:1:7:3:{i}".encode()).hexdigest()[:8] < "26666666" for i in range(5)]
    assert out.first().m == [0, *[4 if d else 9 for d in draw[1:4]], 2]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in plan and "doc_id" not in plan[plan.index("md5"):plan.index("26666666")]


def test_many_draws_are_those_of_md5():
    """Short and long keys, one block and several, with numbers of any length."""
    import hashlib

    import numpy as np
    from linemill.functions.hashing import md5_draws
    heads = [b"", b"42:0:7:1:", "42:é:".encode(), *[b"k" * n for n in range(45, 68)], b"long" * 50]
    numbers = np.array([0, 3, 10, 99, 100, 511, 12345])
    row, number = np.repeat(np.arange(len(heads)), len(numbers)), np.tile(numbers, len(heads))
    want = [int(hashlib.md5(heads[r] + str(n).encode()).hexdigest()[:8], 16) for r, n in zip(row, number)]
    assert md5_draws(heads, row, number).tolist() == want
    assert md5_draws(heads, row[:0], number[:0]).tolist() == []


def test_masks_follow_the_draws(spark):
    import hashlib
    rows = [(1, "a", [0, 5, 6, None, 7, 2, 1, 1]), (2, None, []), (3, "b" * 80, list(range(40))), (4, "c", None)]
    df = spark.createDataFrame(rows, "k long, s string, ids array<int>").repartition(2)
    each, many = ({r.k: r.m for r in df.select("k", f(F.col("ids"), ["k", "s"], F.lit(3), 42, 0.5).alias("m")).collect()}
                  for f in (mlm_mask, mlm_mask_many))

    def one(k, s, i, x):
        d = hashlib.md5(f"42:3:{k}:{s or ''}:{i}".encode()).hexdigest()[:8]
        return 4 if x is not None and x not in (0, 1, 2) and d < "80000000" else x
    assert each == many == {k: None if ids is None else [one(k, s, i, x) for i, x in enumerate(ids)] for k, s, ids in rows}
