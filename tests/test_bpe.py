"""Byte-level BPE against the public tokenizer library (test oracle only)."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from linemill.functions.arrays import SPECIAL_TOKENS
from linemill.operators import bpe, stats
from linemill.operators.mlm import mlm_examples
from linemill.plans import tables as T

from conftest import SF_SMALL

tokenizers = pytest.importorskip("tokenizers")


def _lib(texts, vocab_size):
    tok = tokenizers.ByteLevelBPETokenizer()
    tok.train_from_iterator(texts, vocab_size=vocab_size, min_frequency=2,
                            special_tokens=SPECIAL_TOKENS, show_progress=False)
    m = json.loads(tok._tokenizer.to_str())["model"]
    merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in m["merges"]]
    return tok, m["vocab"], merges


def _lines_df(spark, texts):
    return spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)],
                                 "doc_id long, line_no long, line string")


def test_toy_vocabulary_and_ids(spark):
    texts = ["ab cd", "ab cd", "ef", "ef", "gh"]
    model = bpe.bpe_train(stats.pretoken_histogram(_lines_df(spark, texts)), vocab_size=400)
    assert model.merge_strings() == [("a", "b"), ("c", "d"), ("e", "f"), ("Ġ", "cd")]
    assert [n for _, _, n in model.merges] == [261, 262, 263, 264]
    assert len(model.vocab) == 265
    cases = {"ab cd ef": [0, 261, 264, 225, 263, 2], "ab": [0, 261, 2, 1, 1, 1],
             "": [0, 2, 1, 1, 1, 1], "abcdefgh": [0, 261, 262, 263, 75, 2],
             "<mask> ab": [0, 32, 81, 69, 87, 2], "é": [0, 132, 107, 2, 1, 1]}
    masks = {"ab": [1, 1, 1, 0, 0, 0], "": [1, 1, 0, 0, 0, 0]}
    df = _lines_df(spark, list(cases))
    enc = bpe.bpe_encode(df, "line", model)
    ex = mlm_examples(enc, "ids", ["doc_id", "line_no"], max_length=6, p=0.0)
    got = {texts_: r for texts_, r in zip(cases, ex.orderBy("line_no").collect())}
    for text, ids in cases.items():
        assert list(got[text].labels) == ids, text
        assert list(got[text].input_ids) == ids, text
        if text in masks:
            assert list(got[text].attention_mask) == masks[text]


@pytest.mark.parametrize("vocab_size,limits", [(1261, {}), (290, {"segments": 40, "live_pairs": 5}),
                                               (600, {"share": 0.0})])
def test_merges_equal_library(spark, vocab_size, limits):
    lines = T.lines(spark, SF_SMALL)
    texts = [r.line for r in lines.orderBy("doc_id", "line_no").collect()]
    model = bpe.bpe_train(stats.pretoken_histogram(lines), vocab_size=vocab_size, **limits)
    tok, lib_vocab, lib_merges = _lib(texts, vocab_size)
    assert model.merge_strings() == lib_merges
    assert {p: i for i, p in enumerate(model.vocab)} == lib_vocab
    enc = bpe.bpe_encode(lines, "line", model).orderBy("doc_id", "line_no").collect()
    bad = [r.line for r in enc if list(r.ids) != tok.encode(r.line).ids]
    assert not bad, bad[:3]


def test_pair_counts_round0(spark):
    df = _lines_df(spark, ["aaa aaa", "ab"])
    pc = {(r.left_id, r.right_id): r.n for r in
          bpe.pair_counts(bpe.words_table(stats.pretoken_histogram(df))).collect()}
    a, b, sp = bpe.BYTE_IDS[ord("a")], bpe.BYTE_IDS[ord("b")], bpe.BYTE_IDS[ord(" ")]
    assert pc[(a, a)] == 4 and pc[(sp, a)] == 1 and pc[(a, b)] == 1


def _word(*ids):
    return "".join(map(bpe.symbol_char, ids))


def test_symbol_characters_keep_the_order_of_ids():
    ids = [0, 1, 260, 0xD7DF, 0xD7E0, 60_000, bpe.MAX_VOCAB - 1]
    chars = [bpe.symbol_char(i) for i in ids]
    assert [bpe.symbol_id(c) for c in chars] == ids
    assert chars == sorted(chars) and [c.encode() for c in chars] == sorted(c.encode() for c in chars)


def test_equal_symbol_merge_is_left_to_right():
    words = [("aaaaa", 3), ("aab", 2)]
    segments = [(_word(*(bpe.BYTE_IDS[ord(c)] for c in w)), n) for w, n in words]
    model = bpe.BpeModel(bpe.base_vocab())
    into = bpe.merge_segments(segments, 3, model, 263)
    assert model.merge_strings() == [("a", "a"), ("aa", "a")]
    b = bpe.BYTE_IDS[ord("b")]
    assert into == {segments[0][0]: _word(261, 262), segments[1][0]: _word(261, b)}


def _greedy(words, vocab_size, min_frequency=2):
    """One merge at a time over all words, pairs counted anew each time."""
    vocab = bpe.base_vocab()
    known = {p: i for i, p in enumerate(vocab)}
    words = [([bpe.BYTE_IDS[x] for x in w.encode()], n) for w, n in words]
    merges = []
    while len(vocab) < vocab_size:
        count = Counter()
        for w, n in words:
            for p in zip(w, w[1:]):
                count[p] += n
        best = min(count.items(), key=lambda x: (-x[1], x[0]), default=None)
        if best is None or best[1] < min_frequency:
            break
        a, b = best[0]
        s = vocab[a] + vocab[b]
        if s not in known:
            known[s] = len(vocab)
            vocab.append(s)
        merges.append((a, b, known[s]))
        for w, _ in words:
            i = 0
            while i + 1 < len(w):
                if (w[i], w[i + 1]) == (a, b):
                    w[i:i + 2] = [known[s]]
                i += 1
    return merges


def _rounds(words, vocab_size, share):
    """The trainer's rounds on a dict of words, without Spark."""
    model = bpe.BpeModel(bpe.base_vocab())
    words = {_word(*(bpe.BYTE_IDS[x] for x in w.encode())): n for w, n in words.items()}
    while len(model.vocab) < vocab_size:
        count = Counter()
        for w, n in words.items():
            for i in range(len(w) - 1):
                count[w[i:i + 2]] += n
        top = max(count.values(), default=0)
        if top < 2:
            break
        floor = max(2, int(top * share))
        live = {p for p, n in count.items() if n >= floor}
        segments = Counter()
        for w, n in words.items():
            for i, j in bpe.live_runs(w, live):
                segments[w[i:j]] += n
        into = bpe.merge_segments(sorted(segments.items()), floor, model, vocab_size)
        after = Counter()
        for w, n in words.items():
            parts, at = [], 0
            for i, j in bpe.live_runs(w, live):
                parts += [w[at:i], into.get(w[i:j], w[i:j])]
                at = j
            after["".join(parts) + w[at:]] += n
        words = after
        model.rounds += 1
    return model


def test_rounds_equal_one_merge_at_a_time():
    """Few letters; some of them make special tokens, symbols that exist."""
    old = 0
    for seed in range(120):
        rng = random.Random(seed)
        words = Counter()
        for _ in range(rng.randrange(5, 80)):
            w = "".join(rng.choice(["a", "b", "<s>", "s>", "<", "</s>"] if seed % 2 else "abc")
                        for _ in range(rng.randrange(1, 14)))
            words[w] += rng.choice([1, 2, 3, 50])
        want = _greedy(words.items(), 330)
        for share in (0.01, 0.3, 1.0):
            assert _rounds(words, 330, share).merges == want
        old += any(n < 261 for *_, n in want)
    assert old > 10


def test_several_corpora_at_once_equal_each_alone(spark):
    lines = T.lines(spark, SF_SMALL)
    hist = stats.pretoken_histogram(lines, by=["lang"])
    got = bpe.bpe_train_each(hist, "lang", vocab_size=330)
    assert sorted(got) == sorted(r.lang for r in lines.select("lang").distinct().collect())
    for lang, model in got.items():
        alone = bpe.bpe_train(stats.pretoken_histogram(lines.filter(F.col("lang") == lang)), vocab_size=330)
        assert (model.vocab, model.merges) == (alone.vocab, alone.merges)


def test_pretokenizer_matches_library(spark):
    pre = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)
    lines = T.lines(spark, SF_SMALL)
    from linemill.functions.text import pretokenize
    rows = lines.select("line", pretokenize("line").alias("t")).collect()
    table = bpe.BYTE_CHARS
    for r in rows:
        lib = [w for w, _ in pre.pre_tokenize_str(r.line)]
        ours = ["".join(table[b] for b in t.encode("utf-8")) for t in r.t]
        assert ours == lib, r.line


def test_training_from_files_keeps_line_breaks(spark, tmp_dir):
    """The library trained on a file sees each line with its break; the
    histogram with ``line_end`` reproduces that."""
    import os
    lines = T.lines(spark, SF_SMALL)
    texts = [r.line for r in lines.orderBy("doc_id", "line_no").collect()]
    path = os.path.join(tmp_dir, "train.txt")
    with open(path, "w", encoding="utf-8") as f:
        f.write("".join(t + "\n" for t in texts))
    tok = tokenizers.ByteLevelBPETokenizer()
    tok.train(files=[path], vocab_size=330, min_frequency=2, special_tokens=SPECIAL_TOKENS,
              show_progress=False)
    m = json.loads(tok._tokenizer.to_str())["model"]
    lib = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in m["merges"]]
    model = bpe.bpe_train(stats.pretoken_histogram(lines, line_end="\n"), vocab_size=330)
    assert model.merge_strings() == lib


def test_histogram_counts_parts_first(spark):
    """Parts at spaces give the pattern's pre-tokens for any white space, and
    the pattern meets each distinct part once."""
    from linemill.functions.text import pretokenize
    rnd = random.Random(5)
    signs = [*map(chr, range(0x250)), *[" "] * 150, "'s", "'ll", " ", "　", "中", "", " \t", "  "]
    texts = ["".join(rnd.choices(signs, k=rnd.randrange(40))) for _ in range(2000)] + ["", " ", "  a", "a ", None]
    df = _lines_df(spark, texts)
    for end in (None, "\n"):
        text = F.col("line") if end is None else F.concat("line", F.lit(end))
        want = Counter(r.p for r in df.select(F.explode(pretokenize(text)).alias("p")).collect())
        assert {r.pretoken: r.n for r in stats.pretoken_histogram(df, line_end=end).collect()} == dict(want)
    plan = stats.pretoken_histogram(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("regexp_extract_all") < plan.rindex("Aggregate")      # an aggregate below the pattern


def _plain_encode(token, merges):
    rank = {(a, b): (r, n) for r, (a, b, n) in enumerate(merges)}
    s = [bpe.BYTE_IDS[x] for x in token.encode()]
    while True:
        found = [(rank[p][0], i) for i, p in enumerate(zip(s, s[1:])) if p in rank]
        if not found:
            return s
        i = min(found)[1]
        s[i:i + 2] = [rank[s[i], s[i + 1]][1]]


def test_many_words_at_once_give_what_one_gives():
    """Also where a merge makes a symbol that earlier merges take."""
    rnd, in_order = random.Random(3), set()
    for _ in range(150):
        vocab = bpe.base_vocab()
        known, merges, seen = {p: i for i, p in enumerate(vocab)}, [], set()
        pool = [bpe.BYTE_IDS[b] for b in "aab é".encode()]
        for _ in range(rnd.randrange(25)):
            a, b = rnd.choices(pool, k=2)
            if (a, b) not in seen:
                seen.add((a, b))
                s = vocab[a] + vocab[b]
                if s not in known:
                    known[s] = len(vocab)
                    vocab.append(s)
                merges.append((a, b, known[s]))
                pool.append(known[s])
        w = bpe.WordEncoder(merges)
        in_order.add(w.in_order)
        tokens = ["".join(rnd.choices("ab é\n", k=rnd.randrange(60))) for _ in range(60)]
        want = [_plain_encode(t, merges) for t in tokens]
        assert w.encode_all(tokens) == want and [w.encode(t) for t in tokens] == want
    assert in_order == {True, False}


def test_training_evaluates_the_histogram_once(spark):
    read = spark.sparkContext.accumulator(0)

    def rows(batches):
        for b in batches:
            read.add(len(b))
            yield b

    hist = spark.createDataFrame([("abab", 5), ("bab", 2)], "pretoken string, n long").mapInPandas(
        rows, "pretoken string, n long")
    assert bpe.bpe_train(hist, vocab_size=263).merge_strings() and read.value == 2


def test_first_ids_of_whole_lines(spark):
    """``first`` gives the beginning of what a whole line gives, also for nulls,
    empty lines and words that reach over the cut."""
    from linemill.operators.bpe import BpeModel, base_vocab, bpe_encode
    v = base_vocab()
    a, b = v.index("a"), v.index("b")
    model = BpeModel([*v, "ab"], [(a, b, len(v))])
    rows = [(0, "ab abab  x"), (1, None), (2, ""), (3, "abcdefghij" * 9), (4, "a"), (5, "a b c d e f g h")]
    df = spark.createDataFrame(rows, "k long, line string").repartition(2)
    whole = {r.k: r.ids for r in bpe_encode(df, "line", model).collect()}
    for n in (1, 3, 7, 62):
        got = {r.k: r.ids for r in bpe_encode(df, "line", model, first=n).collect()}
        assert got == {k: ids if ids is None else ids[:n] for k, ids in whole.items()}
