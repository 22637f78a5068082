"""Stable, partition-independent random draws.

Every random choice in the library (shuffles, splits, masks, epochs) is a
function of an md5 over a seed and a stable row key, so a result never
depends on partitioning, task retries or executor loss, and the same draw
can be written in SQL for an oracle.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_cols(parts) -> list[Column]:
    return [p if isinstance(p, Column) else F.col(p) for p in parts]


def key_string(*parts) -> Column:
    """``p1:p2:...`` with every part cast to string (nulls become empty)."""
    cols = [F.coalesce(c.cast("string"), F.lit("")) for c in _as_cols(parts)]
    return F.concat_ws(":", *cols)


def stable_hash(seed, *parts) -> Column:
    """Hex md5 of ``seed:p1:p2:...`` — the sort key of all shuffles."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key_string(*parts)))


def hex_threshold(p: float) -> str:
    """8 hex digits ``t`` such that ``substr(md5, 1, 8) < t`` has chance p."""
    if not 0.0 <= p <= 1.0:
        raise ValueError(f"probability out of range: {p}")
    return format(min(int(math.floor(p * 2 ** 32)), 2 ** 32 - 1), "08x")


# Shifts of the four rounds of md5 and its additive constants (fixed values).
_SHIFTS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
_SINES = [int(abs(math.sin(i + 1)) * 2 ** 32) for i in range(64)]
_STATE = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
# Messages hashed at once: their words stay in the processor's cache.
_AT_ONCE = 1 << 13


def md5_draws(heads: list[bytes], row: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The first 8 hex digits, as numbers, of the md5 of ``heads[row]`` followed
    by ``number`` in decimals, for arrays of both: many short messages at once."""
    out = np.zeros(len(row), np.uint32)
    if not len(row):
        return out
    digits = [b"%d\x80" % k for k in range(int(number.max()) + 1)]
    width = max(map(len, digits))
    ends = np.frombuffer(b"".join(d.ljust(width, b"\0") for d in digits), np.uint8).reshape(-1, width)
    more = np.fromiter(map(len, digits), np.int64, len(digits)) - 1
    size = np.fromiter(map(len, heads), np.int64, len(heads))
    fit = size + width <= 56              # of one block
    blocks = np.frombuffer(b"".join(h.ljust(64, b"\0") if ok else bytes(64) for h, ok in zip(heads, fit.tolist())),
                           np.uint8).reshape(-1, 64)
    one = fit[row]
    for k in np.flatnonzero(~one).tolist():
        d = hashlib.md5(heads[row[k]] + b"%d" % number[k]).digest()
        out[k] = int.from_bytes(d[:4], "big")
    short = np.flatnonzero(one)
    for lo in range(0, len(short), _AT_ONCE):
        k = short[lo:lo + _AT_ONCE]
        r, i = row[k], number[k]
        m, at = blocks[r], size[r] + more[i]
        every = np.arange(len(k))
        for j in range(width):
            m[every, size[r] + j] = ends[i, j]
        words = np.ascontiguousarray(m.view("<u4").T)
        words[14] = at * 8
        out[k] = _md5_first(words).byteswap()
    return out


def _md5_first(words: np.ndarray) -> np.ndarray:
    """First word of the md5 of messages of one block: ``words`` is (16, messages)."""
    blank = ~words.any(axis=1)
    a, b, c, d = (np.full(words.shape[1], s, np.uint32) for s in _STATE)
    f, g = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
            k = i
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
            k = (5 * i + 1) % 16
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            f ^= d
            k = (3 * i + 5) % 16
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
            k = 7 * i % 16
        a += f
        a += np.uint32(_SINES[i])
        if not blank[k]:
            a += words[k]
        shift = _SHIFTS[i // 16][i % 4]
        np.left_shift(a, np.uint32(shift), out=g)
        a >>= np.uint32(32 - shift)
        a |= g
        a += b
        a, b, c, d = d, a, b, c
    return a + np.uint32(_STATE[0])


def bernoulli(p: float, hex_col: Column) -> Column:
    """True with probability ``p`` given a uniform hex string column."""
    if p >= 1.0:
        return F.lit(True)
    return F.substring(hex_col, 1, 8) < F.lit(hex_threshold(p))
