"""Listings made by the tasks, and files read by them."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from linemill.sources.lines import WHOLE_FILE, discover_corpus, list_files, read_lines, read_listed
from linemill.streaming.live import numbered_lines_stream

FILES = {"lf": b"a\nb\n", "open": b"a\nb", "crlf": b"a\r\nb\r\n", "mixed": b"a\rb\n", "cr": b"a\r", "empty": b"",
         "blank": b"\n\n", "bom": b"\xef\xbb\xbfa\nb\n", "bom_only": b"\xef\xbb\xbf", "bom_lf": b"\xef\xbb\xbf\n",
         "bad": b"\xff\xfe\nx\x0b\x85\x00y", "breaks": "a b\u0085c\n".encode(), "sp ace%20#[x]{y}*?é": b"q\n",
         "large [1]": b"line\r\n" * (WHOLE_FILE // 6 + 1)}


def _fill(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, data in files.items():
        with open(os.path.join(folder, name), "wb") as f:
            f.write(data)


def _rows(df):
    return df.select("path", "line_no", F.col("line").cast("binary"))


@pytest.mark.parametrize("newline", ["universal", "lf"])
def test_listed_files_give_the_reader_s_lines(spark, tmp_dir, newline):
    place = f"{tmp_dir}/some files"
    _fill(place, {**{f"{k}.txt": v for k, v in FILES.items()}, "packed.txt.gz": gzip.compress(b"p\nq\n"),
                  ".hidden.txt": b"no\n", "_hidden.txt": b"no\n"})
    want, got = _rows(read_lines(spark, place, newline)), _rows(read_listed(list_files(spark, place), newline))
    assert want.count() == got.count() and not want.exceptAll(got).count()


def test_listing_of_a_tree(spark, tmp_dir):
    _fill(tmp_dir, {"top": b"12"})
    _fill(f"{tmp_dir}/a/b", {"deep": b"123", "empty": b"", ".no": b"1"})
    _fill(f"{tmp_dir}/k=1", {"part": b"1"})
    _fill(f"{tmp_dir}/_no", {"file": b"1"})

    def names(path, **kw):
        return {(r.path.removeprefix(f"file:{tmp_dir}/"), r.size) for r in list_files(spark, path, **kw).collect()}
    below = {("a/b/deep", 3), ("a/b/empty", 0)}
    assert names(tmp_dir) == below | {("top", 2), ("k=1/part", 1)}
    assert names(tmp_dir, recursive=False) == {("top", 2), ("k=1/part", 1)}
    assert names(f"{tmp_dir}/[a]") == below and names(f"{tmp_dir}/top") == {("top", 2)}
    with pytest.raises(FileNotFoundError):
        list_files(spark, f"{tmp_dir}/none")


def test_driver_keeps_listings_not_files(spark, tmp_dir):
    """the stream's own log named every file."""
    place, out, ck = (f"{tmp_dir}/{x}" for x in ("in", "out", "ck"))
    batches = []
    for half in (0, 1, 1):
        _fill(place, {f"f{i}.txt": b"a\nb\n" for i in range(half, 60, 2)})
        numbered_lines_stream(spark, place, out, ck, "lf", max_files_per_trigger=25).awaitTermination()
        batches.append(len([x for x in os.listdir(out) if x.startswith("batch=")]))
    assert 2 <= batches[0] < batches[1] == batches[2]
    log = [line for name in os.listdir(f"{ck}/sources/0") if name.isdigit()
           for line in open(f"{ck}/sources/0/{name}") if "path" in line]
    assert log and not any("/in/f" in line for line in log) and len(log) < 60
    got = spark.read.parquet(out)
    assert sorted((os.path.basename(r.path), r.line_no, r.line) for r in got.collect()) == sorted(
        (f"f{i}.txt", n, "ab"[n]) for i in range(60) for n in (0, 1))


def test_stream_goes_on_looking(spark, tmp_dir):
    _fill(f"{tmp_dir}/in", {"f0.txt": b"a\n"})
    q = numbered_lines_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", available_now=False)
    try:
        for n in (1, 2):
            for _ in range(60):
                seen = os.path.exists(f"{tmp_dir}/out") and spark.read.parquet(f"{tmp_dir}/out").count()
                if seen == n:
                    break
                q.awaitTermination(1)
            assert seen == n
            _fill(f"{tmp_dir}/in", {"f1.txt": b"b\n"})
    finally:
        q.stop()


def test_discovery_keeps_no_files_on_the_driver(spark, tmp_dir):
    """the plan held a file index of all files; empty ones were left out."""
    for i in range(200):
        _fill(f"{tmp_dir}/doc{i}/en-de", {"en-de.x.de": b"a" * i})
    found = discover_corpus(spark, tmp_dir, "en-??/*", suffixes=[".de"])
    got = {r.path.removeprefix(f"file:{tmp_dir}/"): (r.name, r.pair, r.split, r.lang, r.suffix, r.size)
           for r in found.collect()}
    assert got == {f"doc{i}/en-de/en-de.x.de": ("en-de.x.de", "en-de", "x", "de", ".de", i) for i in range(200)}
    held = found.inputFiles()
    assert len(held) < 200 and not any("en-de" in f for f in held)
