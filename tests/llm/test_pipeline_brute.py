"""The pipeline's rows against a plain-Python version of all five stages."""

import hashlib
import re

import pytest

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def clear_language(texts, model):
    import zstandard as z
    par = z.ZstdCompressionParameters(compression_level=9, min_match=3, strategy=z.STRATEGY_BTOPT,
                                      write_content_size=0, write_checksum=0, write_dict_id=0)
    comp = []
    for _, d in model:
        words = z.ZstdCompressionDict(d, dict_type=z.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(compression_params=par)
        comp.append(z.ZstdCompressor(dict_data=words, compression_params=par))
    kept = []
    for i, t in texts:
        if t and re.search(r"[^\W\d_]", t):
            low = t.lower().encode()
            blocks = [low[k:k + 8192] for k in range(0, len(low), 8192)]
            best, second = sorted(sum(len(c.compress(b)) for b in blocks) for c in comp)[:2]
            if (second - best) / second >= 0.002:
                kept.append((i, t))
    return kept


def distinct(texts):
    last = {}
    for i, t in sorted(texts):
        last[t] = i
    return sorted((i, t) for t, i in last.items())


def far_apart(texts, bits=4):
    import xxhash
    fps = []
    for _, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER))
        grams = [" ".join(w[k:k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    return [x for k, x in enumerate(texts) if group[k] == k]        # ids rise, so k has the smallest


def without_passages(texts, items, n=10):
    windows = set()
    for t in items:
        w = WORD.findall((t or "").translate(LOWER))
        windows |= {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    out = []
    for i, t in texts:
        found = list(WORD.finditer(t.translate(LOWER)))
        words, hit = [m.group() for m in found], set()
        for k in {len(x) for x in windows}:
            for j in range(len(words) - k + 1):
                if tuple(words[j:j + k]) in windows:
                    hit.update(range(j, j + k))
        if hit and len(hit) >= 0.5 * len(words):
            continue
        keep, pos, j = [], 0, 0
        while j < len(words):
            if j in hit:
                e = j
                while e + 1 in hit:
                    e += 1
                keep.append(t[pos:found[j].start()])
                pos, j = found[e].end(), e
            j += 1
        out.append((i, "".join(keep) + t[pos:]))
    return out


def test_pipeline_equals_brute_force(llm):
    P = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    import numpy as np

    import corpus_pipeline
    from linemill.llm.bpe_codec import read_ranks
    from linemill.llm.queries import language_model
    docs = llm.read.parquet(f"{SMALL}/documents.parquet")
    items = [r.text for r in llm.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    texts = distinct(clear_language(texts, language_model(docs)))
    texts = without_passages(far_apart(texts), items)
    tokens = read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                            mergeable_ranks={t: i for i, t in enumerate(tokens)})
    want = []
    for i, t in texts:
        ids = lib.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(t.encode()).hexdigest()))
    got = corpus_pipeline.run(llm, SMALL).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want) and 0 < len(want) < 200
