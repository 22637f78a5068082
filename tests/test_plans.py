"""Composed preparation plans and the streaming helpers."""

import os

from pyspark.sql import functions as F

from linemill.plans import prep
from linemill.plans import tables as T
from linemill.streaming.live import read_text_stream, run_batches, write_parquet_stream
from linemill.sources.lines import read_lines

from conftest import SF_MID, SF_SMALL


def test_split_parallel_is_a_labelled_permutation(spark):
    b = T.bitext(spark, SF_MID)
    s = prep.split_parallel(b, dev=100, test=100, seed=5)
    assert s.count() == b.count()
    per = {(r.pair, r.split): (r.n, r.lo, r.hi) for r in s.groupBy("pair", "split").agg(
        F.count(F.lit(1)).alias("n"), F.min("shuf_rank").alias("lo"),
        F.max("shuf_rank").alias("hi")).collect()}
    for (pair, split), (n, lo, hi) in per.items():
        assert lo == 1 and hi == n
        if split in ("dev", "test"):
            assert n == 100


def test_clean_segment_file(spark):
    doc = ('<doc>\r\n<seg id="1">a & b &amp; c</seg>\r\n<hl>x</hl>\r\n'
           '<seg id="2">keep</seg>\r\n<seg id="3">t</seg><hl>\r\n</doc>')
    df = spark.createDataFrame([(1, doc, True), (2, doc.replace("<hl>x</hl>", ""), False)],
                               "doc_id long, xml string, hl boolean")
    got = prep.clean_segment_file(df.filter("hl"), headline_files=F.lit(True)).collect()
    assert [(r.seg_no, r.text) for r in got] == [(1, "a & b &amp; c"), (2, "keep")]


def test_learn_and_encode_sides(spark):
    b = T.bitext(spark, SF_SMALL)
    models = prep.learn_vocabularies(b, "multilingual", vocab_size=200)
    assert list(models) == ["multiling"]
    enc = prep.encode_sides(b, models["multiling"])
    dev = prep.multilingual_dev(enc, ["en-de", "en-es", "en-fr"])
    row = dev.orderBy("line_no_all").first()
    assert row.src_sp.startswith("<2de> ")
    assert dev.count() == b.count()


def test_stream_lines_through_batches(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    for k in range(3):
        with open(os.path.join(src, f"f{k}.txt"), "w") as f:
            f.write("".join(f"{k} line {i}\n" for i in range(50)))
    out = os.path.join(tmp_dir, "out")
    q = write_parquet_stream(read_text_stream(spark, src, newline="lf"), out,
                             os.path.join(tmp_dir, "ck"))
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 150
    seen = []
    q2 = run_batches(read_text_stream(spark, src, newline="lf"),
                     lambda df, i: seen.append(df.count()), os.path.join(tmp_dir, "ck2"))
    q2.awaitTermination()
    assert sum(seen) == 150
    assert read_lines(spark, src, newline="lf").agg(F.max("line_no")).first()[0] == 49


def test_training_plans(spark, tmp_dir):
    from linemill.plans import training
    lines = T.lines(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "tok")
    m1 = training.tokenizer(spark, lines, path, vocab_size=280)
    m2 = training.tokenizer(spark, lines, path, vocab_size=280)   # reused from files
    assert m1.merges == m2.merges and m1.vocab == m2.vocab
    ex = training.epoch_batches(lines, m1, max_length=16, epochs=2, batch_size=8)
    n = lines.count()
    assert ex.count() == 2 * n
    per_epoch = ex.groupBy("epoch").agg(F.countDistinct("batch_id").alias("b")).collect()
    assert all(r.b == -(-n // 8) for r in per_epoch)
    masks = ex.select("epoch", "doc_id", "line_no", "input_ids").collect()
    by_key = {}
    for r in masks:
        by_key.setdefault((r.doc_id, r.line_no), {})[r.epoch] = list(r.input_ids)
    assert any(v[0] != v[1] for v in by_key.values())       # masks differ per epoch
    plan = training.step_plan(spark, lines, batch_size=8, epochs=2, warmup=5)
    assert plan.count() == 2 * (-(-n // 8)) + 500


def test_news_dev_and_blank_report(spark):
    b = T.bitext(spark, SF_MID)
    europarl = b.filter(~F.col("source").isin("src0", "src1"))
    news = b.filter(F.col("source").isin("src0", "src1"))
    split = prep.split_parallel(europarl, dev=50, test=50, seed=2)
    grown = prep.add_news_dev(split, news, F.col("source") == "src0")
    counts = {r.split: r["count"] for r in grown.groupBy("split").count().collect()}
    n_src0 = news.filter(F.col("source") == "src0").count()
    assert counts["newstest2018"] == n_src0
    assert sum(counts.values()) == b.count()
    assert counts["train"] == europarl.count() - 300 + news.count() - n_src0
    rep = prep.blank_report(split)
    total = rep.agg(F.sum("n_lines")).first()[0]
    assert total == 2 * europarl.count()


def test_log_training(spark, tmp_dir):
    from linemill.plans import training
    trace = T.param_trace(spark, SF_SMALL)
    metrics = spark.createDataFrame([(0, "loss", 2.5), (1, "loss", 2.25)], "step long, tag string, value double")
    lca_path, m_path = os.path.join(tmp_dir, "lca"), os.path.join(tmp_dir, "metrics")
    training.log_training(trace, 5, lca_path, metrics, m_path)
    training.log_training(trace, 0, os.path.join(tmp_dir, "none"), metrics, m_path)  # LCA off
    assert spark.read.json(lca_path).count() > 0
    assert not os.path.exists(os.path.join(tmp_dir, "none"))
    assert spark.read.parquet(m_path).count() == 4
