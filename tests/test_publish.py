"""Vocabularies are published whole: a failed build leaves the old one."""

import pytest

from linemill.plans import tables as T
from linemill.plans.training import tokenizer
from linemill.sources import vocab as V

from conftest import SF_SMALL


def test_failed_build_leaves_the_old_table(spark, tmp_dir):
    def table(n):
        return lambda: spark.range(n)

    path = f"{tmp_dir}/v"
    assert V.build_or_reuse(spark, path, table(3)).count() == 3
    assert V.build_or_reuse(spark, path, table(5)).count() == 3
    first = V.current_version(spark, path)

    def dies(folder):
        spark.range(7).write.parquet(folder)
        raise RuntimeError("half-way")

    with pytest.raises(RuntimeError):
        V.publish(spark, path, dies)
    assert V.current_version(spark, path) == first
    assert V.build_or_reuse(spark, path, table(5)).count() == 3
    old = V.build_or_reuse(spark, path, table(5))
    assert V.build_or_reuse(spark, path, table(4), overwrite=True).count() == 4
    assert old.count() == 3                       # a reader stays with its version
    assert V.current_version(spark, path) != first


def test_table_written_without_a_manifest_is_used(spark, tmp_dir):
    spark.range(2).write.parquet(f"{tmp_dir}/old")
    assert V.build_or_reuse(spark, f"{tmp_dir}/old", lambda: spark.range(9)).count() == 2
    assert V.current_version(spark, f"{tmp_dir}/none") is None


def test_many_versions_keep_their_order(spark, tmp_dir):
    for n in range(12):
        got = V.publish(spark, f"{tmp_dir}/m", lambda folder, n=n: spark.range(n).write.parquet(folder))
        assert V.current_version(spark, f"{tmp_dir}/m") == got


def test_half_written_tokenizer_is_learnt_again(spark, tmp_dir, monkeypatch):
    from linemill.plans import training
    lines = T.lines(spark, SF_SMALL).filter("doc_id < 30")
    path = f"{tmp_dir}/tok"
    real = training.write_bpe

    def half(vocab, merges, folder):
        real(vocab, merges.limit(0), folder)
        raise RuntimeError("lost")

    monkeypatch.setattr(training, "write_bpe", half)
    with pytest.raises(RuntimeError):
        tokenizer(spark, lines, path, vocab_size=280)
    monkeypatch.setattr(training, "write_bpe", real)
    model = tokenizer(spark, lines, path, vocab_size=280)
    assert len(model.merges) == 19
    again = tokenizer(spark, lines, path, vocab_size=300)        # reused as it is
    assert (again.vocab, again.merges) == (model.vocab, model.merges)
