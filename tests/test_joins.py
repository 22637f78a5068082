"""Joins: strict alignment, index lookup with both formulas, hold-out leak check."""

import random
import re

import pytest

from linemill.operators.joins import AlignmentError, line_offsets, locate, sample_at, zip_parallel
from linemill.operators.splits import leaked_rows


def test_zip_parallel_strict(spark):
    src = spark.createDataFrame([(0, "a"), (1, "b")], "line_no long, src string")
    tgt = spark.createDataFrame([(0, "x"), (1, "y")], "line_no long, tgt string")
    assert sorted(tuple(r) for r in zip_parallel(src, tgt, ["line_no"]).collect()) == \
        [(0, "a", "x"), (1, "b", "y")]
    short = tgt.filter("line_no = 0")
    with pytest.raises(AlignmentError):
        zip_parallel(src, short, ["line_no"])


def test_sample_at_true_offsets_and_reference_formula(spark):
    # files of 3, 5 and 2 lines: the reference formula assumes equal sizes
    lines = spark.createDataFrame([(d, i) for d, n in ((1, 3), (2, 5), (3, 2)) for i in range(n)],
                                  "doc_id long, line_no long")
    offs = line_offsets(lines)
    idx = spark.range(0, 10).withColumnRenamed("id", "i")
    got = {r.i: (r.doc_id, r.line_no, r.ref_file, r.ref_sample)
           for r in sample_at(idx, lines, offs, first_size=3).collect()}
    assert got[3] == (2, 0, 1, 0)
    assert got[7] == (2, 4, 2, 1)      # the formula points at file 2, line 1 instead
    assert got[9] == (3, 1, 3, 0)      # and past the last file here


def test_leak_check(spark):
    train = spark.createDataFrame([(1,), (2,)], "k long")
    held = spark.createDataFrame([(2,), (3,)], "k long")
    assert [r.k for r in leaked_rows(train, held, ["k"]).collect()] == [2]


def test_preview_threshold(spark):
    from linemill.operators.order import preview
    few = spark.createDataFrame([(f"p{i}",) for i in range(5)], "path string")
    many = spark.createDataFrame([(f"p{i}",) for i in range(9, 3, -1)], "path string")
    assert [r.path for r in preview(few).collect()] == [f"p{i}" for i in range(5)]
    assert [r.path for r in preview(many).collect()] == ["p4", "p5", "p6"]


@pytest.mark.parametrize("span", [1, 7, 1 << 16])
def test_locate_finds_the_file_of_every_index(spark, span):
    """Empty files, files of one line, and one far longer than a bucket."""
    rng = random.Random(span)
    sizes = [rng.choice([0, 1, 1, 2, 30]) for _ in range(60)] + [500]
    rng.shuffle(sizes)
    offsets, start, want = [], 0, {}
    for f, n in enumerate(sizes):
        offsets.append((f"f{f:03d}", n, start))
        want.update({start + k: (f"f{f:03d}", k) for k in range(n)})
        start += n
    offs = spark.createDataFrame(offsets, "file string, n_lines long, start long").repartition(3)
    asked = [rng.randrange(-20, start + 20) for _ in range(300)] + list(range(start))
    idx = spark.createDataFrame([(i, f"x{i}") for i in asked], "i long, _at string").repartition(4)
    got = sorted((r.i, r["_at"], r.file, r.line_no) for r in locate(idx, offs, "file", span).collect())
    assert got == sorted((i, f"x{i}", *want[i]) for i in asked if i in want)


def test_sample_at_exchanges_only_the_wanted_lines(spark, tmp_path):
    rows = [(d, n, f"text {d} {n}") for d in range(40) for n in range(50)]
    spark.createDataFrame(rows, "doc_id long, line_no long, line string").repartition(4).write.parquet(str(tmp_path / "l"))
    lines = spark.read.parquet(str(tmp_path / "l"))
    offs = line_offsets(lines)
    idx = spark.range(0, 2000, 500).withColumnRenamed("id", "i")
    out = sample_at(idx, lines, offs, columns=["line"])
    assert sorted((r.i, r.line) for r in out.collect()) == [(i, f"text {i // 50} {i % 50}") for i in range(0, 2000, 500)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = sample_at(idx, lines, offs, columns=["line"])._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scan = max(i for i, x in enumerate(plan) if re.search(r"FileScan parquet \[.*line#", x))
    depth, above = 10**9, []
    for x in reversed(plan[:scan + 1]):               # the scan and its ancestors, from below
        at = re.search(r"[A-Za-z*(]", x)
        if at and at.start() < depth:
            depth = at.start()
            above.append(x)
    # The bitmap's filter comes before the first exchange of rows with text.
    kept = next(i for i, x in enumerate(above) if "Filter" in x and "shiftleft" in x)
    assert not any("Exchange" in x for x in above[:kept])
