"""Property tests for the row-wise text functions (many examples per Spark job)."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from linemill.functions import text as X

ALPHABET = st.sampled_from(list("ab cdé ñß1 2'.,!&;<>\t") + [" ", " ", "__amp__", "'s", "'ll",
                                                                "été", "Ω", "7"])
TEXTS = st.lists(st.lists(ALPHABET, max_size=12).map("".join), min_size=40, max_size=80)
SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def _df(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")


@SETTINGS
@given(TEXTS)
def test_strip_equals_python(spark, texts):
    got = {r.i: r.s for r in _df(spark, texts).select("i", X.strip_text("t").alias("s")).collect()}
    assert all(got[i] == t.strip() for i, t in enumerate(texts))


@SETTINGS
@given(TEXTS)
def test_amp_round_trip(spark, texts):
    df = _df(spark, texts).select("i", "t", X.restore_amp(X.protect_amp("t")).alias("r"),
                                   X.protect_amp("t").alias("p"))
    for r in df.collect():
        assert "&" not in r.p
        if "__amp__" not in r.t:
            assert r.r == r.t


@SETTINGS
@given(TEXTS)
def test_pretokenize_matches_library(spark, texts):
    tokenizers = pytest.importorskip("tokenizers")
    pre = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    from linemill.operators.bpe import BYTE_CHARS
    rows = _df(spark, texts).select("i", X.pretokenize("t").alias("p")).collect()
    for r in rows:
        lib = [w for w, _ in pre.pre_tokenize_str(texts[r.i])]
        ours = ["".join(BYTE_CHARS[b] for b in w.encode("utf-8")) for w in r.p]
        assert ours == lib, texts[r.i]


LINE = st.text(alphabet=st.sampled_from(list("abc é\t")), max_size=30)
FILES = st.lists(st.lists(LINE, min_size=1, max_size=300), min_size=1, max_size=4)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(FILES, st.sampled_from(["\n", "\r\n"]))
def test_read_lines_numbering_over_tiny_splits(spark, tmp_path_factory, files, sep):
    import os
    from linemill.sources.lines import read_lines
    d = str(tmp_path_factory.mktemp("lines"))
    for k, lines in enumerate(files):
        with open(os.path.join(d, f"f{k}.txt"), "w", encoding="utf-8", newline="") as f:
            f.write(sep.join(lines) + sep)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        got = read_lines(spark, d).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    by = {}
    for r in got:
        by.setdefault(os.path.basename(r.path), {})[r.line_no] = r.line
    for k, lines in enumerate(files):
        m = by[f"f{k}.txt"]
        assert [m[i] for i in range(len(m))] == lines
