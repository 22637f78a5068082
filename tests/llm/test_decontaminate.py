import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from linemill.llm import decontaminate as D

from .conftest import as_tuples

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, n):
    wins = {}
    for i, t in items:
        w = WORD.findall((t or "").translate(LOWER))
        for j in range(max(len(w) - n, 0) + 1 if w else 0):
            wins.setdefault(tuple(w[j:j + n]), set()).add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, ids = WORD.findall((t or "").translate(LOWER)), set(), set()
        for k in {len(x) for x in wins}:
            for j in range(len(w) - k + 1):
                if tuple(w[j:j + k]) in wins:
                    ids |= wins[tuple(w[j:j + k])]
                    hit.update(range(j, j + k))
        out.append((i, len(w), len(hit), sorted(ids), bool(hit)))
    return sorted(out, key=repr)


COLS = ["doc_id", "n_words", "n_hit", "item_ids", "contaminated"]


def test_documents_against_brute_force(llm, docs):
    items = llm.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()],
                 [tuple(r) for r in items.select("item_id", "text").collect()], 10)
    assert any(x[4] for x in want)
    assert as_tuples(D.decontaminate(docs, items), *COLS) == want
    # cut into many parts: the same
    assert as_tuples(D.decontaminate(docs, items, part_windows=50), *COLS) == want


def test_odd_items(llm, odd, odd_rows):
    items = [(10, "HELLO-there"), (2, "there world hello"), (None, "テスト"), (5, None), (6, "!!"), (10, "12345"),
             (7, "alpha"), (8, "of the of the of the of the of the of the")]
    df = llm.createDataFrame(items, "item_id long, text string")
    for n in (3, 10):
        assert as_tuples(D.decontaminate(odd, df, n=n), *COLS) == brute([r[:2] for r in odd_rows], items, n)


def test_spans_and_cleaning(llm):
    df = llm.createDataFrame([(1, "Keep this. One two three, four! And é this."), (2, "one two three four"),
                              (3, "clean text"), (4, None)], "doc_id long, text string").withColumn(
        "n_hit", F.lit("own"))
    items = llm.createDataFrame([(1, "one two three four")], "item_id long, text string")
    r = {x.doc_id: x for x in D.decontaminate(df, items).collect()}
    assert r[1].clean_text == "Keep this. ! And é this."
    assert [tuple(s) for s in r[1].spans] == [(11, 30)]
    left = {x.doc_id: x.text for x in D.clean_documents(df.drop("n_hit"), items).collect()}
    assert left == {1: "Keep this. ! And é this.", 3: "clean text", 4: None}


def test_empty_sides(llm, odd, none):
    items = llm.createDataFrame([], "item_id long, text string")
    assert D.decontaminate(odd, items).filter("contaminated").count() == 0
    assert D.decontaminate(none, items).count() == 0


def test_windows_with_equal_hashes_are_told_apart(monkeypatch):
    """With a hash that is the same for all windows, the bytes still decide."""
    items = [("1", b"aa bb cc"), ("2", b"bb cc aa"), ("3", b"aa bb cc dd"), ("4", b"zz"), ("1", b"yy")]
    monkeypatch.setattr(D, "_window_hash", lambda h, n: np.full(max(len(h) - n + 1, 0), 7, np.uint64))
    w = D.Words([b"x aa bb cc y", b"Bb, cc aa zz", b"cc aa bb"], D.RollingHash(10))
    w.scan(D.WindowSet(items, 3))
    assert {d: sorted(x) for d, x in w.found.items()} == {0: ["1", "3"], 1: ["2", "4"]}


@pytest.mark.parametrize("n", [2, 5])
def test_long_texts_in_pieces(llm, monkeypatch, n):
    rng = random.Random(n)
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(1, 9)))) for i in range(12)]
    docs = [(i, "".join(rng.choice(["a", "B", "c", "d", " ", ", ", "\n", "é"]) + rng.choice(["", " "])
                        for _ in range(900))) for i in range(6)]
    df, it = llm.createDataFrame(docs, "doc_id long, text string"), llm.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items, n)
    parts = D.benchmark_parts(it, "item_id", "text", n, 10**6)
    roll = D.RollingHash(10)

    def scanned(groups):
        words = [D.Words(g, roll) for g in groups]
        for w in words:
            w.scan(parts[0].value)
        return words
    whole = [D._results([t.encode()], scanned([[t.encode()]])[0])[0] for _, t in docs]
    for size in (20, 301):
        monkeypatch.setattr(D, "SLICE_BYTES", size)
        assert [D._long(t.encode(), scanned, n) for _, t in docs] == whole
    assert [(i, *r[:4]) for (i, _), r in zip(docs, whole)] == want
    assert as_tuples(D.decontaminate(df, it, n=n), *COLS) == want


def test_clashing_names(llm):
    names = ["original", "_original", "CLEAN_TEXT", "spans", "n_hit", "c0", "_text"]
    df = llm.createDataFrame([(1, "one two three four five", *names)],
                             "doc_id long, text string, " + ", ".join(f"{c} string" for c in names))
    items = llm.createDataFrame([(1, "two three")], "item_id long, text string")
    out = D.clean_documents(df, items)
    assert out.columns == df.columns and tuple(out.first()) == (1, "one  four five", *names)
