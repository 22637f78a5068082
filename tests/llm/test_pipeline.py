import importlib

import pytest
from pyspark.sql import functions as F

from .conftest import as_tuples

SMALL = "/root/testdata/sf0.001"


def test_stages_and_run(llm):
    import corpus_pipeline as cp
    assert [n.split("_")[0] for n, _ in cp.STAGES] == ["language", "exact", "simhash", "benchmark", "byte"]
    docs = llm.read.parquet(f"{SMALL}/documents.parquet")
    sizes, now = [], docs
    for _, stage in cp.STAGES[:-1]:
        now = stage(llm, now, SMALL)
        assert now.columns == docs.columns and now.dtypes == docs.dtypes
        sizes.append(now.count())
    assert docs.count() >= sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] > 0
    last = cp.STAGES[-1][1](llm, now, SMALL)
    run = cp.run(llm, SMALL)
    cols = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert as_tuples(run, *cols) == as_tuples(last, *cols)
    texts = {r.doc_id: r.s for r in now.select("doc_id", F.sha2("text", 256).alias("s")).collect()}
    assert {r.doc_id: r.decoded_sha256 for r in run.collect()} == texts


@pytest.mark.parametrize("which", range(5))
def test_odd_tables(llm, odd, which):
    import corpus_pipeline as cp
    df = odd.withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text")).withColumn(
        "kept", F.lit(1)).withColumn("margin", F.lit("m")).withColumn("fp", F.lit(2.0)).withColumn(
        "_Text", F.lit(3)).withColumn("n_hit", F.lit(4))
    stage = cp.STAGES[which][1]
    out = stage(llm, df, SMALL)
    assert out.count() <= 14
    if which < 4:
        assert out.columns == df.columns
        assert out.filter("margin <> 'm' or kept <> 1 or n_hit <> 4").count() == 0
    empty = stage(llm, df.filter("doc_id < 0"), SMALL)
    assert empty.count() == 0


def test_registered(llm):
    import __spark_entry__ as e
    q = e.queries()
    assert q["pipeline"] is not None
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in q) == 1
    assert importlib.import_module("corpus_pipeline").ORACLE_SQL is None
