"""The perfect binary Golay code of length 23 as a hash: every 23-bit word is
within three bits of exactly one of 4,096 codewords."""

from __future__ import annotations

from itertools import combinations

import numpy as np

N, K = 23, 12
# The generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (fixed value).
GENERATOR = 0b101011100011


def _remainder(word: int) -> int:
    for i in range(N - 1, 10, -1):
        if word >> i & 1:
            word ^= GENERATOR << (i - 11)
    return word


class Golay:
    """Decoding by syndrome: the remainder by the generator names the error."""

    def __init__(self):
        unit = [_remainder(1 << i) for i in range(N)]
        self._byte = np.zeros((3, 256), np.int64)
        for k in range(3):
            for v in range(256):
                r = 0
                for j in range(8):
                    if v >> j & 1 and 8 * k + j < N:
                        r ^= unit[8 * k + j]
                self._byte[k, v] = r
        self._error = np.zeros(1 << 11, np.int64)
        for w in range(1, 4):
            for bits in combinations(range(N), w):
                s = e = 0
                for i in bits:
                    s, e = s ^ unit[i], e | 1 << i
                self._error[s] = e

    def index(self, words: np.ndarray) -> np.ndarray:
        """The message (0 to 4,095) of the codeword nearest to each word."""
        w = words.astype(np.int64)
        s = self._byte[0, w & 255] ^ self._byte[1, w >> 8 & 255] ^ self._byte[2, w >> 16]
        return (w ^ self._error[s]) >> 11

    def near(self, words: np.ndarray, bits: int) -> list[np.ndarray]:
        """Indices of each word itself and of every word one of its first
        ``bits`` bits away, as columns."""
        return [self.index(words)] + [self.index(words ^ (1 << i)) for i in range(bits)]
