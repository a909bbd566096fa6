"""Hashed character n-grams of many texts at once (numpy), on lower-case UTF-8 bytes; white space and ASCII punctuation bound words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from ledgerloom.llm.textvec import ALNUM

#: Multipliers of the bytes of an n-gram (any odd numbers do).
_FACTORS = [np.uint32(x) for x in (2654435761, 2246822519, 3266489917, 668265263, 374761393, 1597334677)]


class Grams:
    """``buf``: bytes with blanks for all bounds; ``starts``/``ends``: its words; ``first[i]:first[i + 1]``: words of text i."""

    def __init__(self, texts: list[bytes], blank: np.ndarray = ALNUM):
        raw = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
        is_blank = blank[raw]
        self.buf = np.where(is_blank, np.uint8(32), raw)
        edge = np.flatnonzero(np.diff(np.concatenate(([True], is_blank, [True])).view(np.int8)))
        self.starts, self.ends = edge[0::2], edge[1::2]
        limits = 1 + np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        self.first = np.searchsorted(self.starts, limits)
        at = np.where(is_blank, np.arange(len(raw)), len(raw))
        self.next_blank = np.minimum.accumulate(at[::-1])[::-1]
        self.next_blank = np.append(self.next_blank[1:], len(raw))  # strictly behind

    def of(self, sizes: tuple[int, ...], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, bucket) for each size: n-grams within a word, its bounds included as a blank."""
        n = len(self.buf)
        wide = self.buf.astype(np.uint32) + np.uint32(7)
        h = np.zeros(n, np.uint32)
        for size in range(1, max(sizes) + 1):
            if n < size:
                return
            h = h[: n - size + 1] + wide[size - 1 :] * _FACTORS[size - 1]
            if size in sizes:
                pos = np.flatnonzero(self.next_blank[: len(h)] >= np.arange(size - 1, size - 1 + len(h)))
                if size < 3:  # not blanks alone
                    pos = pos[(self.buf[pos] != 32) | (self.buf[pos + size - 1] != 32)]
                x = h[pos] + np.uint32(size * 0x9E3779B1 % 2**32)
                x ^= x >> np.uint32(15)
                x *= np.uint32(0x2C1B3C6D)
                x ^= x >> np.uint32(13)
                yield pos, x & np.uint32(buckets - 1)
