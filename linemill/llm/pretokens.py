"""Pre-token boundaries as array operations over code points.

A slice of texts becomes one array of code points; every text is followed by a
separator beyond Unicode. Characters fall into five classes, and the two
split patterns of the tokenizer files reduce to rules on runs of classes.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

OTHER, LETTER, NUMBER, SPACE, STOP = range(5)
SEPARATOR = 0x110000
# White space of the split patterns (fixed values: the Unicode property).
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
         0x202F, 0x205F, 0x3000]
# Letters and numbers of Unicode 16, which the tokenizer libraries know and
# older interpreters do not (fixed values, first and last code point).
LETTERS_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0)]
NUMBERS_16 = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
# Endings that an apostrophe takes along (fixed values of both patterns).
SHORT = "stmd"
LONG = ("re", "ve", "ll")


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point, and of the separator."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.zeros(SEPARATOR + 1, np.uint8)
    out[:SEPARATOR] = np.fromiter((kinds.get(unicodedata.category(chr(i))[0], OTHER)
                                   for i in range(SEPARATOR)), np.uint8, SEPARATOR)
    for ranges, kind in ((LETTERS_16, LETTER), (NUMBERS_16, NUMBER)):
        for a, b in ranges:
            out[a:b + 1] = kind
    out[WHITE] = SPACE
    out[SEPARATOR] = STOP
    return out


def code_points(texts: list[str]) -> np.ndarray:
    """All code points, each text followed by the separator."""
    sep = SEPARATOR.to_bytes(4, "little")
    return np.frombuffer(sep.join([t.encode("utf-32-le", "surrogatepass") for t in texts]) + sep, np.uint32)


def utf8_lengths(cp: np.ndarray) -> np.ndarray:
    """UTF-8 bytes of each code point (the separator: one)."""
    return 1 + (cp > 0x7F).astype(np.int64) + (cp > 0x7FF) + (cp > 0xFFFF) - 3 * (cp == SEPARATOR)


def _contractions(cp: np.ndarray, start: np.ndarray) -> None:
    """An apostrophe that begins a pre-token takes one of the endings along."""
    n = len(cp)
    at = np.flatnonzero((cp == 0x27) & start)
    at = at[at + 2 < n]
    if not len(at):
        return
    a, b = cp[at + 1], cp[at + 2]
    one = np.isin(a, [ord(c) for c in SHORT])
    two = np.zeros(len(at), bool)
    for w in LONG:
        two |= (a == ord(w[0])) & (b == ord(w[1]))
    two &= at + 3 < n
    for hit, k in ((at[one], 2), (at[two & ~one], 3)):
        start[hit + 1] = False
        start[hit + k] = True


def spaced_starts(cp: np.ndarray, cl: np.ndarray) -> np.ndarray:
    """Starts for the pattern that joins one space to the run after it and
    keeps other white space as pre-tokens of its own."""
    start = np.ones(len(cp), bool)
    start[1:] = (cl[1:] != cl[:-1]) | (cl[1:] == STOP)
    # The last white space character before a run stands alone; a plain space joins.
    last = np.flatnonzero((cl[:-1] == SPACE) & (cl[1:] != SPACE) & (cl[1:] != STOP))
    start[last] = True
    start[last[cp[last] == 0x20] + 1] = False
    _contractions(cp, start)
    return start


def word_starts(cp: np.ndarray, cl: np.ndarray) -> np.ndarray:
    """Starts for the pattern without white space, one number at a time."""
    start = np.ones(len(cp), bool)
    start[1:] = (cl[1:] != cl[:-1]) | (cl[1:] == STOP) | (cl[1:] == NUMBER)
    _contractions(cp, start)
    return start
