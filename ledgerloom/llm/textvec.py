"""Vectorised hashing of words and word windows over batches of texts (numpy)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_PRIME = 0x9E3779B97F4A7C15 | 1
_QRIME = 0xC2B2AE3D27D4EB4F | 1
#: Texts are hashed together in pieces of about so many bytes; a longer text forms a piece of its own.
PIECE_BYTES = 1 << 18


def _seps(blank: bytes | None) -> np.ndarray:
    table = np.zeros(256, bool)
    if blank is not None:
        table[list(blank)] = True
    else:  # all ASCII but letters and digits
        table[:128] = True
        table[[b for b in range(128) if chr(b).isalnum()]] = False
    return table


#: ASCII white space alone parts words.
PLAIN = _seps(b" \t\n\x0b\x0c\r")
#: Punctuation parts words too.
ALNUM = _seps(None)

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        x = np.full(max(n, PIECE_BYTES * 2), base & (2**64 - 1), np.uint64)
        x[0] = 1
        have = _powers[base] = np.cumprod(x, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for each range, from one running sum: odd bases have inverses mod 2**64."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(base, len(values)), out=total[1:])
    back = _power(pow(base, -1, 2**64), len(values) + 1)
    return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of some texts: hash, text number, and each text's first word (``first[i]:first[i + 1]``)."""

    def __init__(self, texts: list[bytes], seps: np.ndarray = PLAIN):
        buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        blank = seps[buf]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], blank)).view(np.int8)))
        starts, ends = edge[0::2], edge[1::2]
        self.hash = _ranges(buf.astype(np.uint64) + np.uint64(1), starts, ends, _PRIME)
        limits = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        self.first = np.searchsorted(starts, limits)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words from each word on, and whether those lie in one text."""
        m = max(0, len(self.hash) - n + 1)
        at = np.arange(m)
        return _ranges(self.hash, at, at + n, _QRIME), self.text[:m] == self.text[n - 1 :] if m else np.zeros(0, bool)


def slices(batch: pa.RecordBatch, limit: int = PIECE_BYTES, column: int = 0) -> Iterator[pa.RecordBatch]:
    """The batch in parts (not copied) of about ``limit`` bytes of text, so that no more of it is Python objects at a time; a
    longer text forms a part of its own."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < len(size):
        stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def pieces(texts: list[str | None], lower: bool = False) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first text, encoded texts) for pieces of bounded size; null counts as empty."""
    at, size, own = 0, 0, []
    for i, t in enumerate(texts):
        b = ((t.lower() if lower else t) if t else "").encode()
        if own and size + len(b) > PIECE_BYTES:
            yield at, own
            at, size, own = i, 0, []
        own.append(b)
        size += len(b) + 1
    if own:
        yield at, own


def sliding(x: np.ndarray, n: int, f=np.minimum) -> np.ndarray:
    """f over each n neighbours, by doubling."""
    if len(x) < n:
        return x[:0]
    have, out = 1, x
    while have * 2 <= n:
        out = f(out[:-have], out[have:])
        have *= 2
    if have < n:
        out = f(out[: len(x) - n + 1], out[n - have :][: len(x) - n + 1])
    return out
