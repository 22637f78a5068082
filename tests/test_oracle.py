"""Every registered query against its DuckDB oracle (or a rows check)."""

import pytest

from linemill.plans.catalog import ORACLE, QUERIES
from oracle_harness import compare

from conftest import SF_SMALL

SLOW = {"bpe_train", "vocab_size", "bpe_encode", "mlm_examples", "unigram_train",
        "unigram_encode"}


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in ORACLE))
def test_matches_oracle(spark, name):
    r = compare(spark, name, SF_SMALL)
    assert r["cols_ok"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["hash_ok"], r


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in ORACLE))
def test_runs_without_oracle(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 1


def test_every_survey_operator_is_registered():
    expected = """read_lines discover_corpus read_archive_members read_segments load_vocab write_lines write_vocab
    build_or_reuse write_lca_log append_metrics normalize_newlines drop_lines protect_amp
    strip_text tag_language parse_corpus_name vocab_pieces zip_parallel pair_ref_src lookup_ids
    sample_at count_blank_lines corpus_summary pretoken_histogram bpe_train vocab_size plan_steps
    lca_step lca_interval batch_slots aligned_shuffle epoch_order sort_shards preview
    concat_corpora append_to_split concat_ordered split_quota hold_out pretokenize bpe_encode
    join_pieces frame_truncate pad_to attention_mask mlm_mask lr_schedule mlm_examples""".split()
    missing = [n for n in expected if n not in QUERIES]
    assert not missing, missing


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
                 "BOOLEAN": "boolean", "FLOAT": "float"}


def test_column_types_match_oracle(spark):
    from oracle_harness import TABLES
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    bad = {}
    for name, sql in ORACLE.items():
        rel = con.sql(sql)
        duck = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
        ours = {f.name: f.dataType.simpleString() for f in QUERIES[name](spark, SF_SMALL).schema.fields}
        if duck != ours:
            bad[name] = (ours, duck)
    assert not bad, bad
