"""Rules that hold at any size: no value is lost to rounding, order comes from
numbers, inputs are evaluated once, and workers need no working folder."""

import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from linemill.operators import joins, order, traces
from linemill.operators.splits import split_quota
from linemill.plans import tables as T
from linemill.plans.prep import HEADLINE_LINES
from linemill.sources.lines import read_lines
from linemill.sources.vocab import load_bpe_merges

from conftest import SF_SMALL

KEYS = ["pair", "doc_no", "line_no"]


def _trace(spark, rows):
    return spark.createDataFrame(rows, "step long, param string, idx long, theta_before double, "
                                       "theta_after double, grad double")


def test_small_and_large_products_count(spark):
    rows = [(0, "small", i, 0.0, 1e-5, 1e-5) for i in range(1000)]
    rows += [(0, "tiny", i, 0.0, 1e-7, 1e-7) for i in range(100)] + [(0, "large", 0, 0.0, 1e10, 1e10)]
    rows += [(0, "infinite", 0, 0.0, 1.0, float("inf")), (0, "undefined", 0, 0.0, 1.0, float("nan"))]
    got = {r.param: r.lca_sum for r in traces.lca_step(_trace(spark, rows), 1).collect()}
    assert got["small"] == pytest.approx(1e-7, rel=1e-12) and got["tiny"] == pytest.approx(1e-12, rel=1e-12)
    assert got["large"] == pytest.approx(1e20) and got["infinite"] == float("inf")
    assert got["undefined"] != got["undefined"]


def test_part_files_follow_their_numbers(spark, tmp_dir):
    for n, text in ((99999, "first"), (100000, "second"), (7, "zeroth")):
        with open(os.path.join(tmp_dir, f"part-{n:05d}-x.txt"), "w") as f:
            f.write(text + "\n")
    got = read_lines(spark, tmp_dir, unit="dir").orderBy("line_no").collect()
    assert [(r.line_no, r.line) for r in got] == [(0, "zeroth"), (1, "first"), (2, "second")]


def test_only_the_first_line_is_a_header(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "merges.txt"), "w") as f:
        f.write("#version: 0.2\na b\n#version x\nc d\n")
    got = sorted(tuple(r) for r in load_bpe_merges(spark, os.path.join(tmp_dir, "merges.txt")).collect())
    assert got == [(0, "a", "b"), (1, "#version", "x"), (2, "c", "d")]


@pytest.mark.parametrize("newline", ["universal", "lf"])
def test_lines_as_text_mode_gives_them(spark, tmp_dir, newline):
    files = {"lf": b"a\nb\n", "open": b"a\nb", "crlf": b"a\r\nb\r\n", "mixed": b"a\rb\n", "cr": b"a\r",
             "bom": b"\xef\xbb\xbfa\nb\n", "bom_open": b"\xef\xbb\xbfa", "empty": b"", "blank": b"\n\n",
             "bom_cr": b"\xef\xbb\xbfx\ny\r"}
    for name, data in files.items():
        with open(os.path.join(tmp_dir, name + ".txt"), "wb") as f:
            f.write(data)
    got = {}
    for r in read_lines(spark, tmp_dir, newline=newline, trailing_empty=True).collect():
        got.setdefault(os.path.basename(r.path)[:-4], {})[r.line_no] = r.line
    for name, data in files.items():
        text = data.decode()
        if newline == "universal":
            text = text.replace("\r\n", "\n").replace("\r", "\n")
        assert got[name] == dict(enumerate(text.split("\n"))), name


def test_sample_order_over_file_paths(spark):
    rows = [(f"d/{name}.txt", i, f"{name}{i}") for name, n in (("b", 3), ("a", 2), ("c", 1), ("B", 2))
            for i in range(n)]
    lines = spark.createDataFrame(rows, "path string, line_no long, line string").repartition(3)
    got = order.sort_shards(lines, "path").collect()
    want = sorted(rows)
    assert [(r.path, r.line_no) for r in got] == [w[:2] for w in want]
    assert [r.sample_idx for r in got] == list(range(len(rows)))
    idx = spark.createDataFrame([(0,), (3,), (7,)], "i long")
    hit = joins.sample_at(idx, lines, joins.line_offsets(lines, "path"), "path").collect()
    assert {(r.i, r.path, r.line_no) for r in hit} == {(i, *want[i][:2]) for i in (0, 3, 7)}


def test_headline_lines_end_at_line_feeds_only(spark):
    text = "keep\nx<hl>\u2028more\ny<hl>\u0085z\ngone<hl>\nalso </hl x\rtail\nlast"
    got = spark.createDataFrame([(text,)], "t string").select(F.regexp_replace("t", HEADLINE_LINES, "")).first()[0]
    assert got == "keep\nx<hl>\u2028more\ny<hl>\u0085z\nlast"


def _scans(df):
    """Table scans in the plan that ran (a reused exchange is not read again)."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
    return len(re.findall(r"Scan parquet", plan))


def test_ranked_input_is_evaluated_once(spark):
    b = T.bitext(spark, SF_SMALL).select(*KEYS)
    own = _scans(b)
    assert _scans(order.aligned_shuffle(b, KEYS)) <= own
    assert _scans(split_quota(b, KEYS, dev=20, test=20)) <= 3 * own


def test_short_groups_and_empty_quotas(spark):
    df = spark.createDataFrame([("a", i) for i in range(3)] + [("b", i) for i in range(50)], "g string, k long")
    for dev, test in ((0, 0), (0, 2), (2, 0), (3, 1), (100, 5)):
        got = {(r.g, r.split): r["count"] for r in split_quota(
            df, ["k"], ["g"], dev, test, F.col("k") != 1).groupBy("g", "split").count().collect()}
        for g, n in (("a", 2), ("b", 49)):
            d, t = min(dev, n), min(test, max(0, n - dev))
            assert (got.get((g, "dev"), 0), got.get((g, "test"), 0), got.get((g, "train"), 0)) == (
                d, t, n + 1 - d - t), (g, dev, test)


def test_quota_over_all_rows(spark):
    df = spark.range(30).withColumnRenamed("id", "k")
    got = {r.split: r["count"] for r in split_quota(df, ["k"], [], 4, 5).groupBy("split").count().collect()}
    assert got == {"dev": 4, "test": 5, "train": 21}


def test_queries_run_from_another_folder(tmp_dir):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import importlib.util, sys
spec = importlib.util.spec_from_file_location("__spark_entry__", {os.path.join(root, "__spark_entry__.py")!r})
e = importlib.util.module_from_spec(spec); spec.loader.exec_module(e)
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("ROWS", e.queries()["read_archive_members"](s, {SF_SMALL!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, env=env, capture_output=True, text=True,
                         timeout=300)
    assert "ROWS 200" in out.stdout, out.stderr[-2000:]
