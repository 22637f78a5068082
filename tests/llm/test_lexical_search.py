"""Ranked search against a plain version, exactness of tiles, odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from linemill.llm import lexical_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def plain(docs, items, k):
    rows = [(i, Counter(terms(t)), len(terms(t))) for i, t, *_ in docs]
    n_docs, n_all = sum(n > 0 for *_, n in rows), sum(n for *_, n in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in rows:
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * (10**9 * c[t] // (1000 * c[t] + 12 * (75 + 25 * n * n_docs // n_all)))
                    for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


ITEMS = [(1, "hello WORLD of alpha"), (2, None), (3, ""), (4, "the the the beta éé"), (4, "alpha"), (None, "日本語 12"),
         (5, "nowhere-to-be-found"), (6, "Alpha alpha beta gamma delta of the")]


@pytest.mark.parametrize("sizes", [{}, {"block_items": 2}, {"block_terms": 3}, {"tile_terms": 2}])
def test_equals_a_plain_search(llm, odd, odd_rows, none, sizes):
    items = llm.createDataFrame(ITEMS, "item_id long, text string").repartition(2)
    for k in (1, 4, 100):
        got = S.search(odd, items, k, **sizes)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(odd_rows, ITEMS, k)
    assert S.search(none, items, **sizes).count() == 0
    assert S.search(odd, items.limit(0), **sizes).count() == 0


def test_many_ties_and_clashing_names(llm):
    rows = [(i, "same words here" if i % 3 else "same words", i, i, "x") for i in range(500)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, score long, _id long, _t string").repartition(7)
    items = llm.createDataFrame([(1, "same here"), (2, "words")], "item_id long, text string")
    got = sorted((tuple(r) for r in S.search(docs, items, 20).collect()), key=repr)
    assert got == plain([r[:2] for r in rows], [(1, "same here"), (2, "words")], 20)
    assert [r[2] for r in sorted(got, key=lambda r: r[1]) if r[0] == 1] == [i for i in range(500) if i % 3][:20]


def test_long_text_in_pieces(llm, monkeypatch):
    rng = random.Random(5)
    text = " ".join(rng.choice(["alpha", "Beta", "ßeta", "x1"]) for _ in range(5000))
    count = S.Counts({b"alpha": 0, b"beta": 1})
    want = count(text.encode())
    monkeypatch.setattr(S, "SLICE_BYTES", 100)
    assert count(text.encode()) == want


def test_tiles_hold_all_counts_below_the_exact_bound():
    block = [(0, "a", Counter({b"x": 70_000, b"y": 3})), (1, "b", Counter({b"y": 900_000, b"z": 1}))]
    weight = np.array([20_000, 15_000, 0])
    exact = 1 << 50
    tiles = S.count_tiles(block, {b"x": 0, b"y": 1, b"z": 2}, weight, tile_terms=1, exact=exact)
    total = Counter()
    for at, rows, cols, vals in tiles:
        load = Counter()
        for r, c, v in zip(rows, cols, vals):
            total[int(at[r]), int(c)] += int(v)
            load[c] += int(v) * int(weight[at[r]]) * 10**6
        assert max(load.values()) < exact
    assert total == {(0, 0): 70_000, (1, 0): 3, (1, 1): 900_000, (2, 1): 1}
