import hashlib
import random
from collections import Counter

from linemill.llm.repeated_spans import repeated_passages, repeated_spans

from .conftest import as_tuples

COLS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def brute(rows, n):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[j:j + n] for _, b in texts for j in range(len(b) - n + 1))
    out = []
    for i, b in texts:
        cover = bytearray(len(b))
        for j in range(len(b) - n + 1):
            if seen[b[j:j + n]] > 1:
                cover[j:j + n] = b"\1" * n
        kept = bytes(x for x, c in zip(b, cover) if not c)
        spans = sum(1 for k, c in enumerate(cover) if c and (not k or not cover[k - 1]))
        out.append((i, len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_small_windows_many_repeats(llm):
    rng = random.Random(8)
    pool = ["".join(rng.choice("abé ") for _ in range(rng.randrange(5, 60))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(pool)[rng.randrange(4):] for _ in range(rng.randrange(5)))) for i in range(80)]
    rows += [(100, "a" * 90), (101, "ab" * 50), (102, None), (103, ""), (None, rows[3][1]), (4, rows[4][1])]
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for n, anchor, cells in ((20, 8, (4, 1)), (20, 5, (1,)), (31, 9, (11, 5, 1))):
        got = repeated_passages(df, length=n, anchor=anchor, cells=cells)
        assert as_tuples(got, *COLS) == brute(rows, n)


def test_pieces_of_a_long_text(llm, monkeypatch):
    """The same answer when a text is worked on in small pieces."""
    from linemill.llm import repeated_spans as R
    rng = random.Random(2)
    import numpy as np
    b = np.frombuffer("".join(rng.choice("ab") for _ in range(3000)).encode(), np.uint8)
    whole = R.Namer(40, 10).anchors(b)
    monkeypatch.setattr(R, "_PIECE", 100)
    cut = R.Namer(40, 10).anchors(b)
    serve = [{p: (int(a), int(c)) for a, lo, hi, c in zip(*x[:4]) for p in range(lo, hi + 1)} for x in (whole, cut)]
    assert serve[0] == serve[1] and sorted(serve[0]) == list(range(len(b) - 39))


def test_documents(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows, 200)
    assert sum(x[2] for x in want) > 0
    assert as_tuples(repeated_passages(docs), *COLS) == want


def test_outputs_and_empty(llm, none, odd, odd_rows):
    assert repeated_passages(none).count() == 0
    assert as_tuples(repeated_passages(odd), *COLS) == brute([r[:2] for r in odd_rows], 200)
    text = "x" + "0123456789" * 3 + "y"
    df = llm.createDataFrame([(1, text), (2, "z" + text[1:])], "doc_id long, text string")
    got = {r.sha: r for r in repeated_spans(df, length=31, anchor=9, cells=(1,)).collect()}
    r = got[hashlib.sha256(text.encode()).hexdigest()]
    assert bytes(r.kept) == b"x" and [tuple(s) for s in r.spans] == [(1, 32)] and r.n_removed == 31
