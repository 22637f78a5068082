import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

RNG = random.Random(1)
ODD = ["", "a", " ", "  ", "\n\n x", "'s", "x's 're'll'd", "''s", " 's", "  's", "\t'll", " \n", "a \n b", "12 34x",
       "日本語 テスト", "ß ﬁ Ǆ ́", "don't I'LL 'S", "'rex", "\x1c \x1d a", "\x85a", "a" * 3000, " " * 2000, "'",
       "ΣΑΣ ΟΔΟΣ", "İI", "<|endoftext|>", " x<|startoftext|>y <|endoftext", "a" * 700 + " b",
       "ab" * 2000 + "é" * 900, "é café", "ꟜᲉ"]
ODD += ["".join(RNG.choice(" \t\n'sremvltdx1é日!  ́٣²") for _ in range(RNG.randrange(1, 40)))
        for _ in range(800)]
ODD += ["".join(chr(RNG.choice([RNG.randrange(0x20, 0x3000), RNG.randrange(0x20, 0xD800),
                                RNG.randrange(0xE000, 0x110000)])) for _ in range(20)) for _ in range(800)]


@pytest.fixture(scope="module")
def texts(docs):
    return ODD + [r.text for r in docs.collect()]


@pytest.fixture(scope="module")
def machine():
    from linemill.llm.token_fst import Transducer
    with open(P.path("word_bpe_49k.json"), "rb") as f:
        return Transducer(f.read())


def test_counts_equal_the_library(machine, texts):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert machine.count([t.encode() for t in texts]).tolist() == want


def test_chunk_maps_do_not_depend_on_the_cut(machine, texts, monkeypatch):
    from linemill.llm import token_fst
    raw = [t.encode() for t in texts[:300]]
    want = machine.count(raw).tolist()
    for size in (7, 64, 4096):
        monkeypatch.setattr(token_fst, "CHUNK", size)
        assert machine.count(raw).tolist() == want


def test_emptied_table_gives_the_same(machine, texts, monkeypatch):
    from linemill.llm import token_fst
    raw = [t.encode() for t in texts[:200]]
    want = machine.count(raw).tolist()
    monkeypatch.setattr(token_fst, "MAX_STATES", 10)
    assert [int(machine.count([t])[0]) for t in raw] == want


def test_count_operator(odd, odd_rows, none):
    from tokenizers import Tokenizer

    from linemill.llm.token_fst import count_tokens
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = count_tokens(odd, P.path("word_bpe_49k.json"))
    assert got.columns == ["doc_id", "lang", "n_bytes", "n_tokens"]
    want = [(i, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids))
            for i, t, _ in odd_rows]
    assert sorted(map(tuple, got.select("doc_id", "n_bytes", "n_tokens").collect()), key=repr) == sorted(
        want, key=repr)
    assert count_tokens(none, P.path("word_bpe_49k.json")).count() == 0


@pytest.fixture(scope="module")
def tokens():
    from linemill.llm.bpe_codec import read_ranks
    return read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(tokens):
    import tiktoken
    return tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                             mergeable_ranks={t: i for i, t in enumerate(tokens)})


def test_perfect_hash_is_minimal(tokens):
    from linemill.llm.bpe_codec import PerfectHash
    keys = np.random.default_rng(2).integers(0, 1 << 64, 5000, dtype=np.uint64)
    h = PerfectHash(keys)
    assert h.lookup(keys).tolist() == list(range(5000)) and len(h.slot_id) == 5000
    assert (h.lookup(keys + np.uint64(1)) == -1).all()


def test_merges_equal_the_library(tokens, library):
    from linemill.llm.bpe_codec import byte_pairs, merge_bytes
    ranks = {t: i for i, t in enumerate(tokens)}
    two = byte_pairs(ranks)
    rng = random.Random(4)
    for _ in range(1500):
        word = "".join(rng.choice("aetionsrhßéü日") for _ in range(rng.randrange(1, 30)))
        if word.encode() not in ranks:
            assert merge_bytes(word.encode(), ranks, two) == library.encode_ordinary(word)


def test_codec_round_trip(odd, odd_rows, docs, library, none):
    from linemill.llm.bpe_codec import decode, encode, encode_and_decode
    path = P.path("byte_bpe_multi_50k.tiktoken")
    for df, rows in ((odd, odd_rows), (docs, [tuple(r) for r in docs.select("doc_id", "text").collect()])):
        got = decode(encode(df, path, keep=["doc_id"]), path).collect()
        want = [(r[0], np.array(library.encode_ordinary(r[1] or ""), "<u4").tobytes(), (r[1] or "").encode())
                for r in rows]
        assert sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got), key=repr) == sorted(want, key=repr)
        both = encode_and_decode(df, path, keep=["doc_id"]).collect()
        assert sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in both), key=repr) == sorted(want, key=repr)
    assert encode(none, path).count() == 0 and encode_and_decode(none, path).count() == 0


def test_codec_odd_texts(llm, library):
    from linemill.llm.bpe_codec import encode
    df = llm.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").repartition(2)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist()
           for r in encode(df, P.path("byte_bpe_multi_50k.tiktoken"), keep=["doc_id"]).collect()}
    assert got == {i: library.encode_ordinary(t) for i, t in enumerate(ODD)}


def thue_morse(n, swap=False):
    return "".join("ab"[bin(i).count("1") % 2 ^ swap] for i in range(n))


@pytest.fixture(scope="module")
def codec(tokens):
    from linemill.llm import bpe_codec as C
    roll = C.RollingHash(C.HASH_SEED)
    lens = np.array([len(t) for t in tokens])
    end = np.cumsum(lens)
    key = roll.ranges(roll.prefix(np.frombuffer(b"".join(tokens), np.uint8)), end - lens, end)
    return C.Encoder(tokens, C.PerfectHash(key))


def ids_of(codec, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in codec.encode([t.encode() for t in texts])]


def test_pre_tokens_with_equal_hashes_keep_their_own_ids(codec, library):
    """The rolling hash of a Thue-Morse string equals its complement's; in one
    slice and in two, each text gets its own ids."""
    texts = [thue_morse(n, s) for n in (256, 512, 1024, 2048, 4096) for s in (False, True)]
    texts += [t + " " + u for t, u in zip(texts, reversed(texts))]
    want = [library.encode_ordinary(t) for t in texts]
    assert ids_of(codec, texts) == want
    assert ids_of(codec, texts[::-1])[::-1] == want
    assert [ids_of(codec, [t])[0] for t in texts] == want


def test_vocabulary_hits_compare_bytes(codec, monkeypatch):
    """With a hash that calls everything a vocabulary entry, ids stay right."""
    texts = ["hello there world", "étude zzqq 123", "the the the"]
    want = ids_of(codec, texts)
    monkeypatch.setattr(codec.table, "lookup", lambda keys: np.full(len(keys), 262))
    assert ids_of(codec, texts) == want


def test_long_texts_in_pieces_equal_whole_ones(codec, texts, monkeypatch):
    from linemill.llm import bpe_codec as C
    long = ["".join(texts), " \n ".join(texts[:900]), "x" * 5000 + " y", "  a\r\n" * 3000, ""]
    want = ids_of(codec, long)
    for size in (50, 997):
        monkeypatch.setattr(C, "SLICE_BYTES", size)
        assert ids_of(codec, long) == want
