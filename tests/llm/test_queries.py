"""Registered queries against their SQL, and the contract's columns."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linemill.llm.queries import ORACLE, QUERIES  # noqa: E402
from oracle_harness import digest, duck  # noqa: E402

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op2": "doc_id bigint, text string",
    "op3": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op4": "doc_id bigint, held_out boolean, score double, predicted int",
    "op5": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op6": "doc_id bigint, fingerprint string, component_id bigint",
    "op7": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op9": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op10": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op11": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
            "n_repeat_words bigint, base_failed boolean, kept boolean",
    "op12": "item_id bigint, rank int, doc_id bigint, score bigint",
    "op13": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
}
# Queries that do not return a row for each document.
OTHER_ROWS = {"op12": 40 * 20, "op13": None}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(llm, name):
    df = QUERIES[name](llm, SMALL)
    cols, rows = duck(SMALL, ORACLE[name])
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(cols, rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_contract_columns_and_all_rows(llm, name):
    df = QUERIES[name](llm, SMALL)
    want = [c.split(" ") for c in COLUMNS[name.split("_")[0]].split(", ")]
    assert [list(t) for t in df.dtypes[:len(want)]] == want
    n = OTHER_ROWS.get(name.split("_")[0], 200)
    assert df.count() == n if n else df.count() > 0
    assert df.filter(f"{df.columns[0]} is null").count() == 0
