"""Token counts by a finite-state transducer compiled from a BPE file.

The transducer reads the bytes of normalised pre-tokens; the last byte of a
pre-token is a symbol of its own (256 higher), because the vocabulary marks
word ends. A state is the set of tokenizations still possible for the bytes
read in the current pre-token: (place in the vocabulary's trie, token before
it, tokens so far). Every prefix of a pre-token has exactly one valid
tokenization, and a sequence of tokens is valid when each two neighbours are,
so one hypothesis at most completes at each byte. Determinisation subtracts
the smallest count of a state's hypotheses and writes it on the transition:
those are the emitted-token counts. States and transitions are made when first
reached and kept in a table, which is emptied (between slices) when it has
grown to ``MAX_STATES``; that costs time but changes no count.

A word end leads back to the start state from any state. So the state map of a
chunk of symbols that holds a word end is constant after it, and only its head
depends on the entry state. Chunks of a slice run in lockstep, one table lookup
per step for all chunks, from the start state: that gives the constant of every
chunk with a word end, which is its right neighbour's entry state, and the
heads are run again from there. A chunk without a word end (inside an enormous
word) is run from its entry state once its left neighbour's is known, one such
chunk after the other.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import SLICE_BYTES, text_pass
from .common import pieces as cut
from .pretokens import SPACE, STOP, classes, code_points, utf8_lengths, word_starts

CHUNK = 512
MAX_STATES = 250_000
END = 256
BORDER = re.compile(rb"[\x21-\x7E](?=[\x09\x0A\x0D ])")
# Capital letters of Unicode 16 that older interpreters do not lower
# (fixed values; U+10D50 to U+10D65 follow a rule).
LOWER_16 = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B} | {
    c: c + 0x20 for c in range(0x10D50, 0x10D66)}


def _byte_of() -> dict[str, int]:
    """Byte of each printable stand-in character of byte-level vocabularies:
    printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """The lazily compiled machine of one task."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or not suffix:
            raise ValueError("a BPE vocabulary with word ends is expected")
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.split = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        byte = _byte_of()
        special = set(self.special)
        self.symbols: dict[int, tuple[int, ...]] = {}
        for tok, i in model["vocab"].items():
            if tok in special:
                continue
            end = tok.endswith(suffix)
            s = [byte[c] for c in (tok[:-len(suffix)] if end else tok)]
            if end:
                s[-1] += END
            self.symbols[i] = tuple(s)
        ident = {s: i for i, s in self.symbols.items()}
        self.single = {s[0]: i for s, i in ident.items() if len(s) == 1}
        vocab = model["vocab"]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            pair = (vocab[a], vocab[b])
            new = ident[self.symbols[pair[0]] + self.symbols[pair[1]]]
            self.merges.setdefault(pair, (rank, new))
        self.child: dict[int, int] = {}
        self.token = [-1]
        self.inner = {0}
        for i, s in self.symbols.items():
            node = 0
            for x in s:
                key = node * 512 + x
                nxt = self.child.get(key)
                if nxt is None:
                    self.inner.add(node)
                    nxt = self.child[key] = len(self.token)
                    self.token.append(-1)
                node = nxt
            self.token[node] = i
        self.reachable: dict[int, bool] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.clear()

    def clear(self) -> None:
        self.states: list[tuple] = [((0, -1, 0),)]
        self.ident = {self.states[0]: 0}
        self.column = np.full(512, -1, np.int64)
        self.columns = 0
        self.table = np.full((1024, 64), -1, np.int32)

    def merge(self, ids: list[int]) -> list[int]:
        """Plain BPE over a short list of token ids."""
        while len(ids) > 1:
            best = min(((self.merges[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.merges),
                       default=None)
            if best is None:
                break
            k = best[1]
            ids[k:k + 2] = [self.merges[(ids[k], ids[k + 1])][1]]
        return ids

    def follows(self, a: int, b: int) -> bool:
        """May token ``b`` stand after token ``a`` (-1: at a word's start)?"""
        ok = self.pairs.get((a, b))
        if ok is None:
            if a < 0:
                ok = self.merge([self.single[s] for s in self.symbols[b]]) == [b]
            else:
                ok = self.follows(-1, b) and self.merge(
                    [self.single[s] for s in self.symbols[a] + self.symbols[b]]) == [a, b]
            if len(self.pairs) >= 1_000_000:
                self.pairs.clear()
            self.pairs[(a, b)] = ok
        return ok

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        """(next state, emitted tokens)."""
        done, hyps = None, []
        for node, last, n in self.states[state]:
            nxt = self.child.get(node * 512 + symbol)
            if nxt is None:
                continue
            t = self.token[nxt]
            if done is None and t >= 0 and self.follows(last, t):
                done = (t, n + 1)
            if nxt in self.inner:
                hyps.append((nxt, last, n))
        if symbol >= END:
            return 0, done[1]
        hyps.append((0, done[0], done[1]))
        low = min(h[2] for h in hyps)
        key = tuple(sorted((a, b, n - low) for a, b, n in hyps))
        s = self.ident.get(key)
        if s is None:
            s = self.ident[key] = len(self.states)
            self.states.append(key)
        return s, low

    def fill(self, state: np.ndarray, symbol: np.ndarray) -> None:
        """Compile the missing transitions among these."""
        for k in np.unique(state * 512 + symbol).tolist():
            s, x = divmod(k, 512)
            nxt, n = self.step(s, x)
            if len(self.states) > len(self.table):
                more = np.full((len(self.table), self.table.shape[1]), -1, np.int32)
                self.table = np.concatenate([self.table, more])
            self.table[s, self.column[x]] = nxt << 8 | n

    def prepare(self, symbols: np.ndarray) -> None:
        """Columns for the symbols of a slice."""
        if len(self.states) > MAX_STATES:
            self.clear()
        new = [x for x in np.flatnonzero(np.bincount(symbols, minlength=512)).tolist() if self.column[x] < 0]
        if self.columns + len(new) > self.table.shape[1]:
            wide = np.full((len(self.table), max(len(new), 64)), -1, np.int32)
            self.table = np.concatenate([self.table, wide], axis=1)
        for x in new:
            self.column[x] = self.columns
            self.columns += 1

    def look(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        col = self.column[symbol]
        got = self.table[state, col]
        miss = got < 0
        if miss.any():
            self.fill(state[miss], symbol[miss])
            got = self.table[state, col]
        return got

    def run(self, symbols: np.ndarray) -> np.ndarray:
        """Tokens emitted at each symbol of a stream that begins at a word
        start and ends at a word end."""
        n = len(symbols)
        if not n:
            return np.zeros(0, np.int64)
        self.prepare(symbols)
        k = -(-n // CHUNK)
        grid = np.zeros(k * CHUNK, np.int64)
        grid[:n] = symbols
        grid = grid.reshape(k, CHUNK)
        length = np.full(k, CHUNK)
        length[-1] = n - (k - 1) * CHUNK
        ends = grid >= END
        head = np.where(ends.any(axis=1), ends.argmax(axis=1), -1)     # first word end, or none
        emit = np.zeros((CHUNK, k), np.uint8)
        steps = np.ascontiguousarray(grid.T)
        # Every chunk from the start state: right after its first word end.
        state = np.zeros(k, np.int64)
        for t in range(CHUNK):
            live = k if t < length[-1] else k - 1
            got = self.look(state[:live], steps[t, :live])
            state[:live] = got >> 8
            emit[t, :live] = got & 255
        # Entry state of each chunk: its left neighbour's exit. Constant maps give it at once, open ones when theirs is known.
        entry = np.zeros(k, np.int64)
        entry[1:] = state[:-1]
        for c in np.flatnonzero(head < 0).tolist():
            if c + 1 < k and entry[c]:
                s = entry[c:c + 1].copy()
                for t in range(CHUNK):
                    s = self.look(s, steps[t, c:c + 1]) >> 8
                entry[c + 1] = s[0]
        # The heads again, from the entry states.
        todo = np.flatnonzero(entry)
        state = entry[todo]
        stop = np.where(head[todo] >= 0, head[todo], length[todo] - 1)
        t = 0
        while len(todo):
            got = self.look(state, steps[t, todo])
            emit[t, todo] = got & 255
            more = stop > t
            todo, stop, state = todo[more], stop[more], (got >> 8)[more]
            t += 1
        return emit.T.reshape(-1)[:n]

    def count(self, texts: list[bytes]) -> np.ndarray:
        """Tokens of each text, special strings counting one. Long texts are
        cut where white space follows, which no pre-token and no special string
        crosses."""
        if max(map(len, texts), default=0) <= 2 * SLICE_BYTES:
            return self._count(texts)
        return np.array([sum(int(self._count([p])[0]) for p in cut(t, SLICE_BYTES, BORDER)) for t in texts], np.int64)

    def _count(self, texts: list[bytes]) -> np.ndarray:
        parts, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for d, t in enumerate(texts):
            s = t.decode("utf-8", "replace")
            pieces = [s]
            if self.split and "<|" in s:
                pieces = self.split.split(s)
                extra[d] = len(pieces) - 1
            for p in pieces:
                if not p.isascii():
                    p = unicodedata.normalize("NFC", p).replace("Σ", "σ").translate(LOWER_16)
                parts.append(p.lower())
                owner.append(d)
        cp = code_points(parts)
        cl = classes()[cp]
        begin = word_starts(cp, cl)
        size = utf8_lengths(cp)
        real = (cl != SPACE) & (cl != STOP)
        last = np.ones(len(cp), bool)
        last[:-1] = begin[1:]
        after = np.cumsum(np.where(real, size, 0))            # symbols up to and with each character
        whole = "\0".join(parts) + "\0"
        buf = np.frombuffer(whole.encode("utf-8", "surrogatepass"), np.uint8)
        sym = buf[np.repeat(real, size)].astype(np.int64)
        sym[after[last & real] - 1] += END
        total = np.concatenate([[0], np.cumsum(self.run(sym), dtype=np.int64)])
        bounds = np.concatenate([[0], total[after[cl == STOP]]])
        out = extra
        np.add.at(out, np.array(owner, np.int64), np.diff(bounds))
        return out


_COMPILED: dict[int, Transducer] = {}


def _compiled(raw: bytes) -> Transducer:
    """One machine per worker process, reused by its tasks."""
    key = hash(raw)
    if key not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[key] = Transducer(raw)
    return _COMPILED[key]


def count_tokens(df: DataFrame, path: str, text_col: str = "text", out_col: str = "n_tokens",
                 keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all but the text) plus ``n_bytes`` and
    ``out_col``: tokens of the whole text as the tokenizer file's library
    counts them, without added special tokens. Null and empty texts: 0.
    Repeated rows each give a row; an empty table gives none; kept columns
    whose names clash with new ones go. The
    file (bounded by its vocabulary) is broadcast; no shuffle."""
    with open(path, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())

    def make():
        machine = _compiled(shared.value)
        return lambda texts: [np.fromiter(map(len, texts), np.int64, len(texts)), machine.count(texts)]
    return text_pass(df, text_col, [T.StructField("n_bytes", T.LongType()),
                                    T.StructField(out_col, T.LongType())], make, keep)
