import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from linemill.llm import language_id, quality, toxicity
from linemill.llm.labelled import held_out

MID = "/root/testdata/sf0.01"


def auc(score, y):
    r = np.empty(len(score))
    r[np.argsort(score, kind="stable")] = np.arange(len(score))
    n = y.sum()
    return (r[y == 1].sum() - n * (n - 1) / 2) / n / (len(y) - n)


@pytest.fixture(scope="module")
def mid(llm):
    return llm.read.parquet(f"{MID}/documents.parquet"), llm.read.parquet(f"{MID}/labels.parquet")


def test_held_out_rows(mid):
    got = mid[0].select("doc_id", held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


def test_language_accuracy(mid):
    from linemill.llm.queries import language_model
    docs = mid[0]
    model = language_model(docs)
    assert all(len(d) <= language_id.DICTIONARY_BYTES for _, d in model)
    got = language_id.identify(docs, model, keep=["doc_id", "lang"]).collect()
    test = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.lang]
    assert np.mean([r.lang == r.lang_pred for r in test]) >= 0.95
    assert np.mean([r.rejected for r in got]) < 0.03
    assert all(0 <= r.score <= 1 for r in got)


def test_long_clean_texts_are_kept(llm, mid):
    """Held-out texts of one language, 0.3, 1 and 5 MB: joined, then again with
    their words in another order, as mere repeats would cost next to nothing."""
    import random

    from linemill.llm.queries import language_model
    rng = random.Random(5)
    model = language_model(mid[0])
    rows = []
    for lang, _ in model:
        held = [r.text for r in mid[0].filter(F.col("lang") == lang).select("doc_id", "text").collect()
                if r.text and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
        text, words = "\n".join(held), " ".join(held).split()
        while len(text) < 5_000_000:
            text += "\n" + " ".join(rng.sample(words, len(words)))
        rows += [(lang, n, text[:n]) for n in (300_000, 1_000_000, 5_000_000)]
    got = language_id.identify(llm.createDataFrame(rows, "lang string, n long, text string").repartition(4), model).collect()
    assert len(got) == 3 * len(model) >= 12
    assert all(r.lang_pred == r.lang and not r.rejected for r in got), got


def test_language_odd_rows(odd, none):
    model = language_id.learn(odd)
    got = {r.doc_id: r for r in language_id.identify(odd, model).collect() if r.doc_id}
    assert all(got[i].lang_pred == "und" and got[i].rejected for i in (2, 3, 8, 11))
    assert got[5].lang_pred == "en" and got[9].lang_pred in ("en", "fr")
    assert language_id.learn(none) == []
    assert {r.lang_pred for r in language_id.identify(odd, []).collect()} == {"und"}
    assert language_id.identify(none, model).count() == 0


def test_narrow_margins_are_rejected(llm):
    import random
    rng = random.Random(1)
    a = " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(300))
    b = " ".join(rng.choice(["uno", "dos", "tres"]) for _ in range(300))
    df = llm.createDataFrame([(1, "alpha gamma beta alpha gamma"), (2, "qqq"), (3, "tres uno dos tres uno")],
                             "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.identify(df, [("x", a.encode()), ("y", b.encode())]).collect()}
    assert (got[1].lang_pred, got[1].rejected) == ("x", False) and got[2].rejected
    assert (got[3].lang_pred, got[3].rejected) == ("y", False)


def test_quality_held_out(mid):
    docs, labels = mid
    model = quality.learn(docs, labels)
    got = quality.classify(docs, model, keep=["doc_id"]).filter(held_out()).join(labels, "doc_id").collect()
    s, y = np.array([r.score for r in got]), np.array([r.quality for r in got])
    assert auc(s, y) >= 0.97 and np.mean((s >= 0.5) == y) >= 0.95


def test_quality_neighbours_are_exact(mid):
    model = quality.learn(*mid)
    texts = [r.text.encode() for r in mid[0].limit(40).collect()]
    f = quality.Features()
    x = model._place(*f(texts), len(texts))
    got, near = model.score(f, texts)
    for i in range(len(texts)):
        sim = model.vectors @ x[i]
        top = np.argsort(-sim)[:model.k]
        w = np.maximum(sim[top], 0).astype(float) ** 2 + 1e-9
        assert abs((w * model.y[top]).sum() / w.sum() - got[i]) < 1e-4 and abs(sim.max() - near[i]) < 1e-5


def test_quality_odd_rows(odd, none, llm):
    labels = llm.createDataFrame([(i, i % 2, 0) for i in range(1, 12)] + [(None, 1, 1), (3, None, None), (4, 1, 1)],
                                 "doc_id long, quality int, toxic int")
    for model in (quality.learn(odd, labels), quality.learn(none, labels)):
        got = quality.classify(odd, model).collect()
        assert len(got) == 14 and all(0 <= r.score <= 1 for r in got)
        assert quality.classify(none, model).count() == 0


def planted(rng, bad):
    words = [rng.choice("the of thing other where then one two tree".split()) for _ in range(rng.integers(5, 60))]
    if bad:
        words[rng.integers(len(words))] = "awful" + rng.choice(["ly", "ness", "est", ""])
    return " ".join(words)


def test_toxicity_learns_stems():
    rng = np.random.default_rng(3)
    rows = [(planted(rng, k % 3 == 0), int(k % 3 == 0), "en") for k in range(500)]
    model = toxicity.Model(rows)
    test = [(planted(rng, k % 3 == 0), int(k % 3 == 0)) for k in range(300)]
    s, _ = model.score(toxicity.Features(), [t.encode() for t, _ in test])
    y = np.array([v for _, v in test])
    assert auc(s, y) > 0.99 and np.mean((s >= 0.7) == y) > 0.97


def test_toxicity_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(4)
    model = toxicity.Model([(planted(rng, k % 2), k % 2, "en") for k in range(60)], epochs=1)
    texts = [b"", b"one", ("tree " * 40_000 + "awful").encode()] + [planted(rng, k % 2).encode() for k in range(50)]
    f = toxicity.Features()
    whole = model.score(f, texts)[0]
    alone = np.array([model.score(f, [t])[0][0] for t in texts])
    assert np.allclose(whole, alone, atol=1e-5)
    # the last word of a very long text counts like any other
    assert whole[2] >= model.score(f, [b"tree " * 40_000])[0][0]


def test_toxicity_operator_on_odd_rows(odd, none, llm):
    labels = llm.createDataFrame([(i, 0, i % 2) for i in range(1, 12)] + [(None, 1, 1)],
                                 "doc_id long, quality int, toxic int")
    for model in (toxicity.learn(odd, labels, epochs=1), toxicity.learn(none, labels)):
        got = toxicity.classify(odd, model).collect()
        assert len(got) == 14 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
        assert toxicity.classify(none, model).count() == 0


def test_learning_sample_is_drawn_from_eligible_rows(llm):
    """Texts that are too long are left out before the draw, so as many rows
    are learnt as there are; a repeated id gives one row."""
    from linemill.llm.labelled import sample
    rows = [(i, "x" * (10 if i % 14 == 0 else 900), "en") for i in range(300)] + [(900, f"copy {k}", "en")
                                                                               for k in range(500)]
    docs = llm.createDataFrame(rows + [(None, "y", "en")], "doc_id long, text string, lang string").repartition(5)
    labels = llm.createDataFrame([(i, i // 14 % 2) for i in range(300)] + [(900, 0), (900, 1), (None, 1), (5000, 1)],
                                 "doc_id long, toxic int")
    held = {i for i in [*range(300), 900] if zlib.crc32(str(i).encode()) % 3 == 1}
    for per_class in (3, 10, 100):
        got = sample(docs, labels, "toxic", "s", per_class, 20, ["lang"])
        for y in (0, 1):
            fit = {i for i in range(0, 300, 14) if i // 14 % 2 == y} | ({900} if y else set())
            assert sum(r[1] == y for r in got) == min(per_class, len(fit - held))
        assert all(len(r[0]) <= 20 and r[2] == "en" for r in got)
    if 900 not in held:
        assert [r[0] for r in got if r[0].startswith("copy")] == ["copy 0"]


def test_language_sample_with_a_repeated_id(llm):
    rows = [(7, f"some text number {k} with words", "en") for k in range(400)] + [(8, "autre texte ici", "fr")]
    df = llm.createDataFrame(rows + [(9, "z" * 70_000, "xx")], "doc_id long, text string, lang string").repartition(3)
    model = language_id.learn(df, texts=5)
    assert [lang for lang, _ in model] == ["en", "fr"]
    assert model[0][1] == b"some text number 0 with words\n"


def toxic_rows(n, seed=6, long=0):
    """(doc_id, text, lang, toxic): planted stems; ``long`` rows lie far beyond
    any sample's size, the planted word last."""
    rng = np.random.default_rng(seed)
    return [(k, "where then " * (2000 if k < long else 1) + planted(rng, k % 3 == 0), "en" if k % 5 else "de", int(k % 3 == 0))
            for k in range(n)]


def learnt(llm, rows, parts, **kw):
    docs = llm.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string").repartition(parts)
    labels = llm.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int").repartition(3)
    return toxicity.learn(docs, labels, **kw)


def test_toxicity_learns_from_whole_long_texts(llm):
    """Every text is longer than 16 KB: none may be left out of the learning."""
    model = learnt(llm, toxic_rows(150, long=150), 4)
    test = toxic_rows(300, seed=8)
    s = model.score(toxicity.Features(), [r[1].encode() for r in test])[0]
    assert auc(s, np.array([r[3] for r in test])) > 0.95


def test_toxicity_shards_hold_every_eligible_row_once(llm):
    from linemill.llm.labelled import labelled_lengths, labelled_rows
    rows = [(i, "x" * (i % 40) if i % 11 else None, "en") for i in range(300)] + [(900, f"copy {k}", "de")
                                                                                  for k in range(50)]
    docs = llm.createDataFrame(rows + [(None, "y", "en"), (902, "unlabelled", "en")], "doc_id long, text string, lang string")
    labels = llm.createDataFrame([(i, i % 2) for i in range(300)] + [(900, 0), (900, 1), (None, 1), (5000, 1), (901, None)],
                                 "doc_id long, toxic int")
    got = labelled_rows(docs.repartition(5), labels, "toxic", "lang", "s", 7)
    want = {str(i): (i % 2, ("x" * (i % 40) if i % 11 else "").encode(), "en") for i in range(300)}
    want["900"] = (1, b"copy 0", "de")
    want = {i: r for i, r in want.items() if zlib.crc32(i.encode()) % 3 != 1}
    rows = got.collect()
    assert len(rows) == len(want) and {r.i: (r.y, bytes(r.t), r.lang) for r in rows} == want
    assert 0 < sum(r.cal for r in rows) < len(rows) / 2 and len({r.shard for r in rows}) == 7
    n, size = labelled_lengths(docs, labels, "toxic")
    assert n == len(want) and 0 <= size - sum(len(t) for _, t, _ in want.values()) <= 1
    apart = got.groupBy("shard", F.spark_partition_id()).count().collect()
    assert len(apart) == 7


def test_toxicity_in_shards(llm):
    """Many shards learn what one does, whatever the files and tasks are."""
    rows = toxic_rows(1200)
    test = toxic_rows(300, seed=8)
    texts, y = [r[1].encode() for r in test], np.array([r[3] for r in test])
    first, again = (learnt(llm, rows, parts, rounds=5, shard_rows=300) for parts in (2, 7))
    s = first.score(toxicity.Features(), texts)[0]
    assert auc(s, y) > 0.95 and np.mean((s >= 0.7) == y) > 0.9
    assert np.array_equal(s, again.score(toxicity.Features(), texts)[0])
    assert np.array_equal(first.cuts, again.cuts) and np.array_equal(first.guess, again.guess)
    # the words of each language are counted over all rows
    one = learnt(llm, rows, 2, epochs=1)
    assert one.languages == first.languages == ["de", "en"] and np.allclose(one.guess, first.guess)


def test_toxicity_shards_with_one_label(llm):
    rows = [(i, t, lang, 0) for i, t, lang, _ in toxic_rows(60)]
    model = learnt(llm, rows, 2, shard_rows=10)
    assert np.all(model.cuts == 0.5) and np.all(model.score(toxicity.Features(), [b"one", b""])[0] >= 0)


def test_toxicity_blocks_change_nothing(monkeypatch):
    rng = np.random.default_rng(5)
    ids, begin = toxicity.Features()([b"", b"one", b"two three", *[planted(rng, k % 2).encode() for k in range(30)]])
    net = toxicity.Network()
    ends = np.append(begin[1:], len(ids))
    top, arg = net.pooled(ids, begin, ends)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    some = net.pooled(ids, begin, ends)
    assert np.allclose(top, some[0], atol=1e-5)
    x = net.E[ids].sum(axis=1)
    for d in range(len(begin)):
        for q, w in enumerate(toxicity.WIDTHS):
            z = np.array([sum(x[i + o] @ net.W[q][o] for o in range(w)) for i in range(begin[d], ends[d] - w + 1)])
            cols = slice(q * toxicity.FILTERS, (q + 1) * toxicity.FILTERS)
            assert np.allclose(z.max(axis=0), top[d, cols], atol=1e-5)
            assert np.allclose(z[arg[d, cols] - begin[d], range(z.shape[1])], top[d, cols], atol=1e-5)
