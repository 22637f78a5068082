"""Spelling variants against plain pair search, and groups dealt out anew."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from linemill.llm import spelling as S


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def plain_pairs(words):
    return {frozenset((a, b)) for a, b in itertools.combinations(words, 2) if near(a, b)}


def vocabulary(seed, n, letters="ab", low=1, high=8):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(low, high))) for _ in range(n)})


@pytest.mark.parametrize("seed,letters", [(1, "ab"), (2, "abc"), (3, "aéñxyz")])
def test_composition_finds_each_pair_once(seed, letters):
    words = vocabulary(seed, 250, letters, 0)
    got = list(S.near_pairs(words))
    assert len(got) == len({frozenset(p) for p in got})
    assert {frozenset(p) for p in got} == plain_pairs(words)


def test_acceptor_is_minimal_and_accepts_the_words():
    words = vocabulary(4, 300)
    edges, final = S.acceptor(words)

    def language(s):
        return frozenset(([""] if final[s] else []) + [c + x for c, t in edges[s].items() for x in language(t)])
    assert language(0) == set(words)
    reached, todo = {0}, [0]
    while todo:
        for t in edges[todo.pop()].values():
            if t not in reached:
                reached.add(t)
                todo.append(t)
    assert len({language(s) for s in reached}) == len(reached)


@pytest.mark.parametrize("limits", [(10**9, 10**9), (200, 10), (1, 3)])
def test_near_words_for_any_group_size(llm, limits):
    words = [w for w in vocabulary(5, 700, "abc", 5, 10)] + ["", "q" * 5000, "q" * 5001, "q" * 4999 + "z"]
    df = llm.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n int").repartition(3)
    got = [(r.word, r.near) for r in S.near_words(df, *limits).collect()]
    want = {tuple(o) for p in plain_pairs([w for w in words if len(w) >= 6]) for o in itertools.permutations(p)}
    assert len(got) == len(set(got)) and set(got) == want


def plain(rows, min_count=5, ratio=5):
    count = Counter()
    for i, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                count[run] += 1
    n = {w: c for w, c in count.items() if c >= min_count}
    others = {w: [] for w in n}
    for a, b in (tuple(p) for p in plain_pairs(n)):
        others[a].append(b)
        others[b].append(a)
    form = {}
    for w, x in others.items():
        best = min(x, key=lambda y: (-n[y], y), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(others[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def test_variants_equal_a_plain_version(llm):
    rng = random.Random(6)
    base = ["harbour", "straße", "colour", "colours", "Über·maß", "kitten", "letters", "abc", "ÀÉÎabc"]
    rows = []
    for i in range(400):
        words = [rng.choice(base) for _ in range(rng.randrange(0, 40))]
        words = [w[:k] + rng.choice("xyz") + w[k + 1:] if rng.random() < .05 else w
                 for w in words for k in [rng.randrange(len(w))]]
        rows.append((i, " ".join(words)))
    # A chain of forms, each five times as frequent as the one before.
    rows += [(1000 + j, " ".join([w] * 5**j)) for j, w in enumerate(["chainaa", "chainab", "chainbb", "chaibbb"], 1)]
    rows += [(None, "harbour harbour"), (3, None), (4, ""), (4, "harbour"), (4, "harbour"), (5, "ABCDEF·ABCDEFG" * 300)]
    df = llm.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n long").repartition(5)
    want = plain(rows)
    for limits in ({}, {"group_chars": 20, "group_words": 2}):
        got = S.spelling_variants(df, **limits)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert any(r[2] != r[0] and r[1] != r[2] for r in want), "no chain of forms in the fixture"
    assert S.spelling_variants(df.limit(0)).count() == 0


def test_long_text_in_pieces_counts_the_same(llm, monkeypatch):
    df = llm.createDataFrame([(1, "letters·colours 12 " * 3000)], "doc_id long, text string")
    got = {tuple(r) for r in S.word_counts(df, "doc_id", "text", drop_mod=None).collect()}
    assert got == {("letters", 3000), ("colours", 3000)}
    with pytest.raises(ValueError):
        S.spelling_variants(df, min_length=5)
