"""File sources and sinks on temporary files."""

import io
import os
import tarfile

import pytest

from linemill.sources.archives import read_archive_members, read_segments, segments_of
from linemill.sources.lines import discover_corpus, glob_to_regex, read_lines
from linemill.sources.sinks import write_lines
from linemill.sources.vocab import build_or_reuse, load_vocab, write_vocab

EDGE = b"a\r\nb\rc\nd\n\nlast\x0bx\xc2\x85y\n"


def _write(path, data):
    with open(path, "wb") as f:
        f.write(data)


def _lines(df):
    return [r.line for r in df.orderBy("line_no").collect()]


def test_universal_and_lf_newlines(spark, tmp_dir):
    p = os.path.join(tmp_dir, "edge.txt")
    _write(p, EDGE)
    assert _lines(read_lines(spark, p)) == ["a", "b", "c", "d", "", "last\x0bx\x85y"]
    assert _lines(read_lines(spark, p, newline="lf")) == ["a\r", "b\rc", "d", "", "last\x0bx\x85y"]
    assert _lines(read_lines(spark, p, newline="lf", trailing_empty=True))[-1] == ""
    assert len(_lines(read_lines(spark, p, trailing_empty=True))) == 7


def test_line_numbers_exact_over_many_splits(spark, tmp_dir):
    lines = [f"line {i} " + "x" * (i % 37) for i in range(20000)]
    for k in range(3):
        _write(os.path.join(tmp_dir, f"f{k}.txt"), ("\n".join(lines[k:]) + "\n").encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = read_lines(spark, tmp_dir)
        assert df.rdd.getNumPartitions() > 10
        rows = df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    by_file = {}
    for r in rows:
        by_file.setdefault(r.path, {})[r.line_no] = r.line
    for path, m in by_file.items():
        k = int(path.rsplit("f", 1)[1].split(".")[0])
        assert [m[i] for i in range(len(m))] == lines[k:]


def test_write_lines_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(d, i, f"{d}-{i}") for d in range(3) for i in range(500)],
                               "doc long, line_no long, line string")
    out = os.path.join(tmp_dir, "out")
    write_lines(df, out, ["doc"], ["line_no"], partitions=7)
    back = read_lines(spark, out, newline="lf", unit="dir")
    got = {(r.unit.rsplit("=", 1)[1], r.line_no): r.line for r in back.collect()}
    assert got == {(str(d), i): f"{d}-{i}" for d in range(3) for i in range(500)}


def test_discover_corpus(spark, tmp_dir):
    for name in ["en-de.train.en", "en-de.train.de", "en-de.train.en.sp", "x.ids",
                 "en-fi.newstest2018.fi"]:
        os.makedirs(os.path.join(tmp_dir, "en-de"), exist_ok=True)
        _write(os.path.join(tmp_dir, "en-de", name), b"a\n")
    got = discover_corpus(spark, tmp_dir, include="en-??.*", exclude=["*.ids"],
                          suffixes=[".en", ".de", ".fi", ".et"])
    rows = {r.name: (r.pair, r.split, r.lang) for r in got.collect()}
    assert rows == {"en-de.train.en": ("en-de", "train", "en"),
                    "en-de.train.de": ("en-de", "train", "de"),
                    "en-fi.newstest2018.fi": ("en-fi", "newstest2018", "fi")}
    assert glob_to_regex("*{a,b}?.[!x]") == r"^[^/]*(a|b)[^/]\.[^x]$"


def test_archive_members(spark, tmp_dir):
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:gz") as tar:
        for name, text in [("dev/newstest2018-ende-ref.de.sgm", "<seg>x</seg>"),
                           ("dev/newstest2018-ende-src.en.sgm", "<seg>y</seg>"),
                           ("dev/other.txt", "z")]:
            data = text.encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    _write(os.path.join(tmp_dir, "dev.tgz"), buf.getvalue())
    got = read_archive_members(spark, os.path.join(tmp_dir, "dev.tgz"), "*ref.de.sgm").collect()
    assert [(r.member, r.text) for r in got] == [("dev/newstest2018-ende-ref.de.sgm", "<seg>x</seg>")]


def test_segments_edge_cases(spark):
    assert segments_of('<d><seg id="2">x <b>bold</b> tail</seg></d>') == [(1, "x")]
    doc = '<d><seg id="3"></seg><seg><b>q</b>t</seg><seg>  ok\t</seg></d>'
    assert segments_of(doc, "blank") == [(1, ""), (2, ""), (3, "ok")]
    assert segments_of(doc, "skip") == [(3, "ok")]
    with pytest.raises(ValueError):
        segments_of(doc, "error")
    df = spark.createDataFrame([(1, doc)], "doc_id long, xml string")
    assert [tuple(r) for r in read_segments(df).collect()] == [(1, 1, ""), (1, 2, ""), (1, 3, "ok")]


def test_vocab_round_trips(spark, tmp_dir):
    v = spark.createDataFrame([("a", 0, -1.5), ("b\tc", 1, -2.0)], "piece string, id int, score double")
    write_vocab(v, os.path.join(tmp_dir, "u.vocab"), "unigram")
    back = load_vocab(spark, os.path.join(tmp_dir, "u.vocab"), "unigram").orderBy("id").collect()
    assert [tuple(r) for r in back] == [("a", 0, -1.5), ("b\tc", 1, -2.0)]
    merges = spark.createDataFrame([(0, "a", "b")], "rank int, left string, right string")
    write_vocab(v.select("piece", "id"), os.path.join(tmp_dir, "bpe"), "bpe", merges)
    vv, mm = load_vocab(spark, os.path.join(tmp_dir, "bpe"), "bpe")
    assert sorted(tuple(r) for r in vv.collect()) == [("a", 0), ("b\tc", 1)]
    assert [tuple(r) for r in mm.collect()] == [(0, "a", "b")]
    calls = []

    def build():
        calls.append(1)
        return v
    p = os.path.join(tmp_dir, "cache")
    build_or_reuse(spark, p, build)
    build_or_reuse(spark, p, build)
    assert len(calls) == 1
    build_or_reuse(spark, p, build, overwrite=True)
    assert len(calls) == 2


def test_lca_log_nested_json(spark, tmp_dir):
    from linemill.sources.sinks import write_lca_log
    log = spark.createDataFrame([(0, "w", 1.0, 0.5, 2.0, 1.0), (25, "w", 3.0, 1.5, 4.0, 2.0)],
                                "step long, param string, lca_sum double, lca_mean double, "
                                "interval_sum double, interval_mean double")
    out = os.path.join(tmp_dir, "lca")
    write_lca_log(log, out, nested=True)
    import json
    import glob
    rows = [json.loads(line) for f in glob.glob(os.path.join(out, "*.json"))
            for line in open(f) if line.strip()]
    assert rows == [{"param": "w", "steps": {
        "STEP_0": {"sum": 1.0, "mean": 0.5, "interval.sum": 2.0, "interval.mean": 1.0},
        "STEP_25": {"sum": 3.0, "mean": 1.5, "interval.sum": 4.0, "interval.mean": 2.0}}}]


def test_segments_keep_key_name_and_type(spark):
    df = spark.createDataFrame([("dev/a.sgm", '<d><seg id="1"> x </seg></d>')], "member string, xml string")
    got = read_segments(df, "xml", "member")
    assert got.columns == ["member", "seg_no", "text"]
    assert [tuple(r) for r in got.collect()] == [("dev/a.sgm", 1, "x")]


def test_read_corpus(spark, tmp_dir):
    from linemill.sources.lines import read_corpus
    os.makedirs(os.path.join(tmp_dir, "en-de"))
    for name, body in [("en-de.train.en", b"a\nb\n"), ("en-de.train.de", b"x\ny\n"),
                       ("en-de.train.en.ids", b"1\n"), ("notes.txt", b"n\n")]:
        _write(os.path.join(tmp_dir, "en-de", name), body)
    got = read_corpus(spark, tmp_dir, include="en-*", exclude=["*.ids"])
    rows = sorted((r.pair, r.split, r.lang, r.line_no, r.line) for r in got.collect())
    assert rows == [("en-de", "train", "de", 0, "x"), ("en-de", "train", "de", 1, "y"),
                    ("en-de", "train", "en", 0, "a"), ("en-de", "train", "en", 1, "b")]


def _most_tasks(spark, group):
    """Tasks of the largest stage of a job group."""
    t = spark.sparkContext.statusTracker()
    stages = [t.getStageInfo(s) for j in t.getJobIdsForGroup(group) for s in t.getJobInfo(j).stageIds]
    return max(s.numTasks for s in stages if s)


def test_many_files_are_listed_in_few_tasks(spark, tmp_dir):
    from linemill.streaming.live import numbered_lines_stream
    most, n = 4 * spark.sparkContext.defaultParallelism, 5 * spark.sparkContext.defaultParallelism + 40
    for i in range(n):
        os.makedirs(f"{tmp_dir}/tree/d{i}")
        os.makedirs(f"{tmp_dir}/flat", exist_ok=True)
        for path in (f"{tmp_dir}/tree/d{i}/en-de.x.de", f"{tmp_dir}/flat/f{i}.txt"):
            with open(path, "w") as f:
                f.write("a\nb\n")
    before = spark.conf.getAll
    spark.sparkContext.setJobGroup("listing", "")
    try:
        assert discover_corpus(spark, f"{tmp_dir}/tree").count() == n
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert _most_tasks(spark, "listing") <= most
    q = numbered_lines_stream(spark, f"{tmp_dir}/flat", f"{tmp_dir}/out")
    q.awaitTermination()
    assert _most_tasks(spark, str(q.runId)) <= most
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 2 * n
    assert spark.conf.getAll == before
