"""Queries over a vocabulary of full size, and the SQL that learns one."""

import random

import duckdb
import pytest

from linemill.operators import bpe, stats
from linemill.operators.bpe import WordEncoder, bpe_train, symbol_id
from linemill.plans import oracle as O
from linemill.plans import tables as T
from linemill.plans.catalog import FULL_LEN, FULL_VOCAB, QUERIES, bpe_model
from oracle_harness import TABLES

from conftest import SF_SMALL


def _corpus(seed):
    """Few letters, so that pairs overlap and tie."""
    r = random.Random(seed)
    texts = [" ".join("".join(r.choices("abé'<s>" if seed % 2 else "ab", k=r.randint(1, 12))) for _ in range(12))
             for _ in range(20)]
    return texts + ["<s> <s> </s> <s>", "aaaa aaaaa aaa", ""]


@pytest.mark.parametrize("vocab_size", [290, 32_000])
@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_sql_learns_and_encodes_as_the_trainer(spark, monkeypatch, seed, vocab_size):
    if seed > 2:        # pieces that are known before they are made
        special = ["<s>", "ab", "</s>", "aba", "bb"]
        monkeypatch.setattr(bpe, "SPECIAL_TOKENS", special)
        monkeypatch.setattr(O, "_SPECIALS", ", ".join(f"'{p}'" for p in special))
    texts = _corpus(seed)
    lines = spark.createDataFrame([(t,) for t in texts], "line string")
    model = bpe_train(stats.pretoken_histogram(lines, line_end="\n"), vocab_size=vocab_size)
    assert seed < 3 or len(model.merges) > len(model.vocab) - 261
    con = duckdb.connect()
    con.execute("create table lines as select 0 doc_id, unnest(range(?)) line_no, unnest(?) line", [len(texts), texts])
    for candidates in (512, 3):
        sql = O.with_recursive(O.BYTES, O.bpe_whole(vocab_size, candidates), O.bpe_whole_ids())
        pieces = con.execute(sql + "select k from learn where kind = 2 order by n").fetchall()
        assert [p for p, in pieces] == model.vocab
        merges = con.execute(sql + "select w, n from learn where kind = 3 order by cast(k as bigint)").fetchall()
        assert [(symbol_id(w[0]), symbol_id(w[1]), n) for w, n in merges] == model.merges
        ids = dict(con.execute(sql + "select line_no, ids from enc").fetchall())
        tokens = lines.select(stats.pretokenize("line").alias("t"), "line").collect()
        encoder = WordEncoder(model.merges)
        want = {r.line: [i for t in r.t for i in encoder.encode(t)] for r in tokens}
        assert [ids[i] for i in range(len(texts))] == [want[t] for t in texts]


def test_vocab_size_counts_the_whole_vocabulary(spark):
    """the query stopped at 300 pieces."""
    row = QUERIES["vocab_size"](spark, SF_SMALL).first()
    whole = bpe_model(spark, SF_SMALL, FULL_VOCAB)
    assert row.vocab_size == len(whole.vocab) > 10_000
    assert (row.n_special, row.n_alphabet, row.n_merge) == (5, 256, len(whole.vocab) - 261)


def test_stream_examples_hold_whole_lines(spark):
    """39 merges, and examples of 64 ids that lost most of a line."""
    whole = bpe_model(spark, SF_SMALL, FULL_VOCAB)
    labels = {(r.doc_id, r.line_no): [int(i) for i in r.labels.split()]
              for r in QUERIES["stream_mlm_examples"](spark, SF_SMALL).collect()}
    encoder, ids = WordEncoder(whole.merges), {}
    for r in T.lines(spark, SF_SMALL).select("doc_id", "line_no", stats.pretokenize("line").alias("t")).collect():
        ids[r.doc_id, r.line_no] = [i for t in r.t for i in encoder.encode(t)]
    assert {k: [0, *v[:FULL_LEN - 2], 2] for k, v in ids.items()} == {
        k: v[:v.index(2) + 1] for k, v in labels.items()}
    assert all(len(v) == FULL_LEN for v in labels.values())
    assert max(max(v, default=0) for v in ids.values()) > 10_000
