"""Long texts are worked on in pieces, with the results of whole ones."""

import random

import numpy as np
import pytest

from linemill.llm import quality, simhash, token_fst, toxicity


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    words = ["Alpha", "beta,", "GAMMA!!", "ÉTÉ", "x", "x", "日本語", "ΟΔΟΣ", "12345", "don't", "<|endoftext|>", "--", "a" * 40]
    out = [rng.choice(["", " ", "\n"]) + "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\n", "\t"])
                                                  for _ in range(n)) for n in (0, 1, 2, 3, 5, 40, 700)]
    return [t.encode() for t in [*out, "x " * 300, "y" * 900, " " * 700, "one two three"]]


@pytest.mark.parametrize("size", [1, 13, 100])
def test_pieces_change_nothing(texts, size, monkeypatch):
    P = pytest.importorskip("public_tokenizers")
    with open(P.path("word_bpe_49k.json"), "rb") as f:
        machine = token_fst.Transducer(f.read())

    def all_of():
        ids, begin = toxicity.Features()(texts)
        doc, term, w = quality.Features()(texts)
        order = np.lexsort((term, doc))
        return ([simhash.fingerprint(t) for t in texts] + machine.count(texts).tolist() + ids.tolist() + begin.tolist()
                + doc[order].tolist() + term[order].tolist() + w[order].tolist())
    want = all_of()
    for module in (simhash, quality, toxicity, token_fst):
        monkeypatch.setattr(module, "SLICE_BYTES", size)
    assert all_of() == want
