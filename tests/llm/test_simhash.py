import random

import numpy as np

from linemill.llm import simhash
from linemill.llm.golay import Golay, N

from .conftest import as_tuples


def test_code_is_perfect():
    g = Golay()
    words = np.arange(0, 1 << N, 97)
    index = g.index(words)
    assert index.min() >= 0 and index.max() < 4096
    # a codeword decodes to itself, and so does every word within three bits
    code = g._error[g._byte[0, words & 255] ^ g._byte[1, words >> 8 & 255] ^ g._byte[2, words >> 16]]
    assert max(int(x).bit_count() for x in code) <= 3
    near = words ^ code
    for flip in (1, 1 << 5 | 1 << 20, 1 | 1 << 9 | 1 << 22):
        assert (g.index(near ^ flip) == index).all()


def test_one_or_six_near_indices():
    g = Golay()
    words = np.array([random.Random(1).randrange(1 << N) for _ in range(500)])
    counts = {len(set(c)) for c in np.stack(g.near(words, N)).T.tolist()}
    assert counts <= {1, 6}


def brute_links(fps, bits):
    u = [x & (1 << 64) - 1 for x in fps]
    return sorted((min(a, b), max(a, b)) for i, a in enumerate(fps) for j, b in enumerate(fps[:i])
                  if (u[i] ^ u[j]).bit_count() <= bits)


def test_links_are_all_found_once(llm):
    rng = random.Random(5)
    fps = set()
    for _ in range(40):
        c = rng.getrandbits(64)
        fps.add(c)
        for _ in range(12):
            x = c
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                x ^= 1 << b
            fps.add(x)
        # patterns across the segments: 2+2+0, 1+1+2, 4+0+0, 0+0+4
        for bits in ((0, 1, 22, 23), (0, 22, 43, 44), (3, 4, 5, 6), (60, 61, 62, 63), (21, 22, 42, 43)):
            fps.add(c ^ sum(1 << b for b in bits))
        # two bits in each of two segments
        for (a, n), (b, m) in ((simhash.SEGMENTS[i], simhash.SEGMENTS[j]) for i, j in simhash.PAIRS):
            for _ in range(3):
                bits = [a + x for x in rng.sample(range(n), 2)] + [b + x for x in rng.sample(range(m), 2)]
                fps.add(c ^ sum(1 << x for x in bits))
    fps = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = llm.createDataFrame([(x,) for x in fps], "fp long")
    for bits in (4, 2, 0):
        assert as_tuples(simhash.links(df, bits), "a", "b") == sorted(brute_links(fps, bits), key=repr)


def test_components_of_a_long_chain(llm):
    e = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (102, 101), (-5, -5)]
    got = dict(as_tuples(simhash.components(llm.createDataFrame(e, "a long, b long")), "node", "root"))
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def brute(rows, bits=4):
    fps = [simhash.fingerprint((t or "").encode()) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, f"{fps[k]:016x}", least.get(find(k))) for k, (i, _) in enumerate(rows)), key=repr)


def test_documents_and_odd_rows(docs, odd, odd_rows, monkeypatch):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert as_tuples(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == brute(rows)
    for hot in (simhash.HOT_ROWS, 1):
        monkeypatch.setattr(simhash, "HOT_ROWS", hot)
        assert as_tuples(simhash.near_duplicates(odd), "doc_id", "fingerprint", "component_id") == brute(
            [r[:2] for r in odd_rows])


def test_fingerprint_by_definition():
    import xxhash
    text = "The quick\tBROWN fox jumps over\nthe É dog"
    words = "the quick brown fox jumps over the É dog".split()
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(len(words) - 3)]
    want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert simhash.fingerprint(text.encode()) == want
    assert simhash.fingerprint(b" \n") == 0
    assert simhash.fingerprint(b"One two") == xxhash.xxh64_intdigest(b"one two", 42)


def test_empty_table_and_survivors(none, odd):
    assert simhash.near_duplicates(none).count() == 0
    left = [r.doc_id for r in simhash.drop_near_copies(odd).collect()]
    assert 1 in left and 4 not in left and 2 in left and 3 not in left
