"""Sampled segmentations of texts into the pieces of a public vocabulary, without replacement, and their decoding.

The lattice of a text has the vocabulary's pieces as edges; a piece's probability follows Zipf's law in its merge rank. The
vocabulary normalises nothing but puts a blank ahead of the text, and so do we.
Pieces don't reach over the start of a word, so the lattice is a chain of small ones, and equal words share theirs.
A best-first search over perturbed scores (Gumbel top-k) emits the ``k`` segmentations with the largest perturbed
log-probabilities: a node stands for all paths that leave a known one within a range of its decisions, and carries their
common maximum, a Gumbel truncated at its parent's; the largest node is split next, at a decision drawn by its share. That
equals drawing without replacement. Every number drawn is a hash of the row's key, so results don't depend on how rows are
dealt.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import math
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.textvec import mix, slices

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
K, SEED = 2, 11
#: Texts are worked on together up to about so many characters; a longer text forms a piece of its own.
PIECE_CHARS = 1 << 18
#: Characters of distinct units up to which their lattices are kept for later texts (about 100 bytes each).
KEPT_CHARS = 1 << 20
#: Characters of units whose lattices are built together; a longer unit is built alone.
BUILT_CHARS = 1 << 15
#: Characters whose ways are summed as probabilities: at worst four bytes of a probability of e**-14 each.
_NEAR = 12
_SPACE = "▁"
_UNIT = re.compile(f"{_SPACE}*[^{_SPACE}\n]+|{_SPACE}+|\n")
_ALL = 2**64 - 1
_BASE, _C1, _C2 = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Vocabulary(NamedTuple):
    pieces: list[str]
    kinds: np.ndarray  # 0 piece, 1 byte, 2 neither
    starts: list[np.ndarray]  # hashes of what pieces begin with, by length, sorted
    ids: list[np.ndarray]  # the piece that is just that, or -1
    more: list[np.ndarray]  # whether a piece goes on from there
    slots: list[np.ndarray]  # by some bits of the hash: 1 + the place in ``starts`` of one that has them, or 0
    logp: np.ndarray
    byte_ids: np.ndarray
    one: np.ndarray  # for each character, its place in starts[0], or -1


def _hash_chars(chars: np.ndarray) -> np.ndarray:
    return chars.astype(np.uint64) + np.uint64(1)


def load(path: str = MODEL_PATH) -> Vocabulary:
    """The vocabulary of a SentencePiece model file, read where this is called (the driver) and sent along."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = len(sp)
    pieces = [sp.id_to_piece(i) for i in range(n)]
    kinds = np.array([1 if sp.is_byte(i) else 2 if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else 0 for i in range(n)], np.int8)
    rank = np.array([max(0.0, -sp.get_score(i)) if kinds[i] == 0 else n for i in range(n)])
    logp = -np.log(rank + 10.0)
    logp[kinds != 2] -= np.log(np.exp(logp[kinds != 2]).sum())
    logp[kinds == 2] = -np.inf
    byte_ids = np.zeros(256, np.int64)
    for i in np.flatnonzero(kinds == 1):
        byte_ids[int(pieces[i][3:5], 16)] = i
    by: dict[int, list[tuple[int, int]]] = {}
    starts: dict[int, set[int]] = {}
    inner: set[int] = set()
    for i in np.flatnonzero(kinds == 0):
        p = pieces[i]
        if _SPACE in p.lstrip(_SPACE) or "\n" in p or "�" in p:
            continue  # reaches over a word's start
        h = 0
        for j, c in enumerate(p):
            h = (h * int(_BASE) + ord(c) + 1) % 2**64
            starts.setdefault(j + 1, set()).add(h)
            if j + 1 < len(p):
                inner.add(h)
        by.setdefault(len(p), []).append((h, i))
    own = {h: i for row in by.values() for h, i in row}
    tables = [sorted(starts[m]) for m in range(1, max(by) + 1)]
    hashes = [np.array(t, np.uint64) for t in tables]
    ids = [np.array([own.get(h, -1) for h in t], np.int64) for t in tables]
    longer = [np.array([h in inner for h in t], bool) for t in tables]
    slots = [np.zeros(1 << 18, np.min_scalar_type(len(h))) for h in hashes]
    for table, h in zip(slots, hashes, strict=True):
        table[_bits(h)] = np.arange(1, len(h) + 1)
    singles = (hashes[0] - np.uint64(1)).astype(np.int64)  # the hash of one character is its code point and one
    one = np.full(int(singles.max()) + 1, -1, np.int32)
    one[singles] = np.arange(len(singles))
    return Vocabulary(pieces, kinds, hashes, ids, longer, slots, logp, byte_ids, one)


def _bits(h: np.ndarray) -> np.ndarray:
    return ((h * _C1) >> np.uint64(46)).astype(np.int64)


class _Table:
    """A numpy table that grows at its end."""

    def __init__(self, kind):
        self.data, self.size = np.empty(3 * KEPT_CHARS, kind), 0  # takes memory as far as it is filled

    def add(self, values: np.ndarray) -> None:
        n = self.size + len(values)
        if n > len(self.data):
            data = np.empty(n + n // 2, self.data.dtype)
            data[: self.size] = self.data[: self.size]
            self.data = data
        self.data[self.size : n] = values
        self.size = n


class Lattice:
    """Lattices of distinct units, which stay from one piece of text to the next. Node i: a character position; edges of a
    node are first[i]:first[i + 1], ``logprob`` given the node, ``cum`` the running sum of the node's probabilities, ``to``
    its end (-1 behind the unit), ``piece`` (negative: the bytes of a character, -1 - code point). ``nodes`` is the number
    of characters held."""

    def __init__(self, units: list[str], v: Vocabulary):
        self.known: defaultdict[str, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.v = v
        self._tables = {"root": _Table(np.int64), "first": _Table(np.int32), "logprob": _Table(np.float64), "cum": _Table(np.float64), "to": _Table(np.int32), "piece": _Table(np.int32)}
        self.clear()
        for u in units:
            self.known[u]
        self.extend()

    def clear(self) -> None:
        """Forget all units; the tables' memory stays."""
        self.known.clear()
        self.nodes = self._done = 0
        for t in self._tables.values():
            t.size = 0
        self._tables["first"].add(np.zeros(1, np.int32))

    def extend(self) -> None:
        """Lattices of the units that have become known since the last call."""
        new = list(islice(self.known, self._done, None))
        ends = np.cumsum([len(u) for u in new])
        at = 0
        while at < len(new):  # a part at a time, as building one takes far more memory than it does afterwards
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BUILT_CHARS, side="right")))
            self._build(new[at:stop])
            at = stop
        self._done = len(self.known)
        for name, t in self._tables.items():
            setattr(self, name, t.data[: t.size])

    def _build(self, units: list[str]) -> None:
        v = self.v
        text = "".join(units)
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        size = np.array([len(u) for u in units], np.int64)
        root = np.concatenate(([0], np.cumsum(size)))[:-1]
        end = np.repeat(root + size, size)
        n = len(chars)
        codes = _hash_chars(chars)
        live, h = np.arange(n, dtype=np.int32), codes
        src, piece = [], []
        for m in range(1, len(v.starts) + 1):
            if m == 1:
                at = np.where(chars < len(v.one), v.one[np.minimum(chars, len(v.one) - 1)], -1)
                likely = np.flatnonzero(at >= 0)
                at = at[likely]
            else:
                ok = live + m <= end[live]
                live, h = live[ok], h[ok]
                h = h * _BASE + codes[live + m - 1]
                at = v.slots[m - 1][_bits(h)]
                likely = np.flatnonzero(at)
                x, at = h[likely], at[likely].astype(np.int64) - 1
                same = v.starts[m - 1][at] == x
                other = np.flatnonzero(~same)  # another one has that slot
                at[other] = np.minimum(np.searchsorted(v.starts[m - 1], x[other]), len(v.starts[m - 1]) - 1)
                same[other] = v.starts[m - 1][at[other]] == x[other]
                likely, at = likely[same], at[same]
            found = v.ids[m - 1][at]
            hit = found >= 0
            src.append(live[likely[hit]])
            piece.append(found[hit])
            if m == 1:  # a character that is no piece is its bytes
                known = np.zeros(n, bool)
                known[src[0]] = True
                bare = np.flatnonzero(~known)
                src[0], piece[0] = np.concatenate((src[0], bare)), np.concatenate((piece[0], -1 - chars[bare].astype(np.int64)))
            likely = likely[v.more[m - 1][at]]
            live, h = live[likely], h[likely]
        # Each length's edges are in order of their nodes: placed by a cursor for each node, without a sort.
        counts = np.bincount(np.concatenate(src), minlength=n)
        first = np.concatenate(([0], np.cumsum(counts)))
        cursor = first[:-1].copy()
        own, length = np.empty(first[-1], np.int32), np.empty(first[-1], np.uint8)
        for m, (node, found) in enumerate(zip(src, piece, strict=True), 1):
            at = cursor[node]
            cursor[node] += 1
            own[at], length[at] = found, m
        src, piece = np.repeat(np.arange(n), counts), own
        score = v.logp[np.maximum(piece, 0)]
        bare = np.flatnonzero(piece < 0)
        code = -1 - piece[bare]
        score[bare] = v.logp[v.byte_ids[0]] * (1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
        dst = src + length
        inside = dst < end[src]
        goal = np.where(inside, dst, n)
        # Sums over all ways to the unit's end, from the end on: nodes by their distance to it, their edges side by side.
        left = end - np.arange(n)
        order = np.argsort(left.astype(np.uint16) if left.max(initial=0) < 1 << 16 else left, kind="stable")
        stops = np.searchsorted(left[order], np.arange(1, left.max(initial=0) + 2))
        k = counts[order]
        begin = np.concatenate(([0], np.cumsum(k)))
        e = np.repeat(first[:-1][order] - begin[:-1], k) + np.arange(begin[-1])
        w, to = score[e], goal[e]
        beta, near = np.zeros(n + 1), min(_NEAR, len(stops) - 1)
        ways, w[: begin[stops[near]]] = np.ones(n + 1), np.exp(w[: begin[stops[near]]])
        for d in range(len(stops) - 1):
            nodes = order[stops[d] : stops[d + 1]]
            if not len(nodes):
                continue
            x, y = begin[stops[d]], begin[stops[d + 1]]
            starts = begin[stops[d] : stops[d + 1]] - x
            if d < near:  # so few characters can't underflow
                ways[nodes] = np.add.reduceat(w[x:y] * ways[to[x:y]], starts)
                if d == near - 1:
                    known = order[: stops[near]]
                    beta[known] = np.log(ways[known])
                continue
            own = w[x:y] + beta[to[x:y]]
            top = np.maximum.reduceat(own, starts)
            beta[nodes] = top + np.log(np.add.reduceat(np.exp(own - np.repeat(top, k[stops[d] : stops[d + 1]])), starts))
        logprob = np.minimum(score + beta[goal] - beta[src], 0.0)
        logprob[first[:-1][counts == 1]] = 0.0  # without a choice exactly so: by rounding there would be other paths
        cum, at, j = np.exp(logprob), np.flatnonzero(counts > 1), 1
        while len(at):  # node by node, so that sums don't depend on what else is in the table
            cum[first[at] + j] += cum[first[at] + j - 1]
            j += 1
            at = at[counts[at] > j]
        t, nodes, edges = self._tables, self.nodes, self._tables["to"].size
        t["root"].add(root + nodes)
        t["first"].add(first[1:] + edges)
        t["logprob"].add(logprob)
        t["cum"].add(cum)
        t["to"].add(np.where(inside, dst + nodes, -1))
        t["piece"].add(piece)
        self.nodes += n

    def sample(self, unit: np.ndarray, order: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Independent walks, one for each entry: edges in order of entry and step, and the number of steps of each entry.

        ``order`` sorts the entries by unit, so that equal units are neighbours in memory. One number in [0, 1) is drawn
        for an entry: what it exceeds the chosen edge's lower bound by, over that edge's probability, is uniform again;
        after every four steps a new one is drawn.
        """
        live, node = order, self.root[unit[order]]
        edges, owners, steps = [], [], np.zeros(len(unit), np.int32)
        step = 0
        u = np.zeros(0)
        while len(live):
            if step % 4 == 0:
                u = (mix(key[live] + np.uint64(int(_C2) * step % 2**64)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            e = self.first[node]
            last = self.first[node + 1] - 1
            going = np.flatnonzero((u >= self.cum[e]) & (e < last))
            while len(going):
                e[going] += 1
                x = e[going]
                going = going[(u[going] >= self.cum[x]) & (x < last[going])]
            edges.append(e)
            owners.append(live)
            steps[live] += 1
            node = self.to[e]
            on = np.flatnonzero(node >= 0)
            e = e[on]
            u = np.clip((u[on] - self.cum[e]) / np.exp(self.logprob[e]) + 1.0, 0.0, 1.0 - 2.0**-53)
            live, node = live[on], node[on]
            step += 1
        offset = np.concatenate(([0], np.cumsum(steps)))
        out = np.empty(offset[-1], np.int32)
        for s, (e, o) in enumerate(zip(edges, owners, strict=True)):
            out[offset[o] + s] = e
        return out, steps


def _mix_one(x: int) -> int:
    """``mix`` of one number."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> shift) * factor & _ALL
    return x ^ x >> 31


def _one(key: int, *more: int) -> float:
    """A number in (0, 1) from a key and what it is for."""
    for x in more:
        key = _mix_one(key + int(_C1) * (x + 1) & _ALL)
    return ((_mix_one(key) >> 11) + 0.5) * 2.0**-53


def _int(key: np.ndarray, *more: int) -> np.ndarray:
    for x in more:
        key = mix(key + np.uint64(int(_C1) * (x + 1) % 2**64))
    return key


def _gumbel(location: float, bound: float, u: float) -> float:
    """A Gumbel variable of that location that is at most ``bound``."""
    if location == -math.inf:
        return -math.inf
    return location - math.log(math.exp(min(location - bound, 700.0)) - math.log(u))


def _less(a: float, b: float) -> float:
    """log(exp(a) - exp(b))"""
    return a + math.log(-math.expm1(b - a)) if b < a else -math.inf


class _Path:
    """A segmentation: its edges, the words they belong to, their pieces, and the log-probabilities ahead of each decision and
    behind the last."""

    def __init__(self, edges: np.ndarray, word: np.ndarray, pieces: np.ndarray, gains: np.ndarray):
        self.edges, self.word, self.pieces = edges, word, pieces
        self.ahead = np.zeros(len(gains) + 1)
        np.cumsum(gains, out=self.ahead[1:])
        self.phi = float(self.ahead[-1])

    def decision(self, low: int, high: int, u: float) -> int:
        """The decision from ``low`` on and ahead of ``high`` at which another piece is taken, by its share of the probability of
        all paths that leave this one there."""
        ahead = self.ahead
        start = float(ahead[low])
        limit = math.log1p(u * math.expm1(float(ahead[high]) - start))
        return low + min(int(np.searchsorted(start - ahead[low + 1 : high + 1], -limit, side="left")), high - low - 1)


def _units(texts: list[str], known: defaultdict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(the units of all texts, by number; how many each text has)"""
    flat: list[int] = []
    ends = [0]
    for t in texts:
        if t:
            flat.extend(map(known.__getitem__, _UNIT.findall(_SPACE + t.replace(" ", _SPACE))))
        ends.append(len(flat))
    return np.fromiter(flat, np.int64, len(flat)), np.diff(ends)


def sample_texts(texts: list[str], keys: np.ndarray, v: Vocabulary, k: int = K, lat: Lattice | None = None) -> Iterator[tuple[int, int, list[int], float, float]]:
    """(text, number from 1, piece ids, log-probability, log of the inclusion probability), best perturbed score first."""
    lat = lat or Lattice([], v)
    unit, count = _units(texts, lat.known)
    if not len(unit):
        for i in range(len(texts)):
            yield i, 1, [], 0.0, 0.0
        return
    lat.extend()
    owner = np.repeat(np.arange(len(texts)), count)
    order = np.argsort(unit, kind="stable")
    place = np.arange(len(unit)) - np.repeat(np.cumsum(count) - count, count)
    samples = []
    for s in range(k):
        e, steps = lat.sample(unit, order, _int(keys, s)[owner] + _C1 * place.astype(np.uint64))
        bounds = np.concatenate(([0], np.cumsum(np.bincount(owner, steps, len(texts)).astype(np.int64))))
        samples.append((e, np.repeat(place.astype(np.int32), steps), bounds, lat.piece[e], lat.logprob[e]))
    plain = bool(lat.piece.min(initial=0) >= 0)
    for i in range(len(texts)):
        if not count[i]:
            yield i, 1, [], 0.0, 0.0
            continue
        key = int(keys[i])
        paths: list[_Path] = []
        top = -math.log(-math.log(_one(key, 1001)))
        # What is left, in groups that share a largest perturbed log-probability: (that, path, from, to, pieces taken there). A group
        # is all paths that leave the path at a decision between the two, or, with pieces taken, those that take none of them.
        groups: list[tuple[float, int, int, int, tuple]] = []
        for s in range(k):
            own, word, pieces, gains = (x[samples[s][2][i] : samples[s][2][i + 1]] for x in (samples[s][0], samples[s][1], *samples[s][3:]))
            if s == 0:
                paths.append(_Path(own, word, pieces, gains))
                groups.append((_gumbel(_less(0.0, paths[0].phi), top, _one(key, 5001, 0)), 0, 0, len(own), ()))
                continue
            groups.sort(reverse=True)
            bound, p, low, high, taken = groups.pop(0)
            if bound == -math.inf:
                break  # there are no further segmentations
            old = paths[p]
            t = low if taken else old.decision(low, high, _one(key, 6001, s))
            a = int(old.edges[t])
            node = int(np.searchsorted(lat.first, np.int32(a), side="right")) - 1
            others = [x for x in range(int(lat.first[node]), int(lat.first[node + 1])) if x not in (taken or (a,))]
            while not others:  # a decision without another piece, met by rounding
                t -= 1
                a = int(old.edges[t])
                node = int(np.searchsorted(lat.first, np.int32(a), side="right")) - 1
                others = [x for x in range(int(lat.first[node]), int(lat.first[node + 1])) if x != a]
            share = list(accumulate(np.exp(lat.logprob[others]).tolist()))
            pick = others[min(bisect_right(share, _one(key, 2001, s) * share[-1]), len(others) - 1)]
            tail, node, step = [pick], int(lat.to[pick]), 0
            while node >= 0:  # to the end of this unit
                x, y = int(lat.first[node]), int(lat.first[node + 1])
                tail.append(x + min(bisect_right(lat.cum[x:y].tolist(), _one(key, 4001, s, step)), y - x - 1))
                node, step = int(lat.to[tail[-1]]), step + 1
            w = old.word[t]
            cut = int(np.searchsorted(word, w, side="right"))
            joined = lambda head, new, rest: np.concatenate((head[:t], new, rest[cut:]))  # noqa: B023, E731
            ends, size = np.array(tail, np.int32), t + len(tail) + len(own) - cut
            pieces = joined(old.pieces, lat.piece[ends], pieces)
            behind = float(old.ahead[t]) + float(lat.logprob[pick])
            if s < k - 1:
                paths.append(_Path(joined(old.edges, ends, own), joined(old.word, np.full(len(tail), w, np.int32), word), pieces, joined(np.diff(old.ahead), lat.logprob[ends], gains)))
                behind, phi = float(paths[-1].ahead[t + 1]), paths[-1].phi  # of one sum, so that they are equal if nothing is left to choose
            else:  # the last is never split: its probability will do
                paths.append(_Path(own[:0], word[:0], pieces, gains[:0]))
                phi = paths[-1].phi = behind + float(np.add.reduce(lat.logprob[ends[1:]])) + float(np.add.reduce(gains[cut:]))
            rest = math.log(max(share[-1] - float(np.exp(lat.logprob[pick])), 0.0) or 1e-320) if len(others) > 1 else -math.inf
            parts = [(float(old.ahead[t]) + rest, p, t, t + 1, (*(taken or (a,)), pick)), (_less(behind, phi), s, t + 1, size, ())]
            if not taken:
                parts += [(_less(float(old.ahead[low]), float(old.ahead[t])), p, low, t, ()), (_less(float(old.ahead[t + 1]), float(old.ahead[high])), p, t + 1, high, ())]
            groups += [(_gumbel(location, bound, _one(key, 3001, s, j)), *group) for j, (location, *group) in enumerate(parts)]
        limit = max([g[0] for g in groups], default=-math.inf)
        for s, p in enumerate(paths):
            phi = p.phi
            rate = phi - limit
            include = 0.0 if limit == -math.inf else (math.log(-math.expm1(-math.exp(min(rate, 700.0)))) if rate > -30 else rate)
            found = p.pieces
            least = 0 if plain else found.min()
            if least >= 0:
                out = found
            elif least >= -128:  # signs of one byte
                out = np.where(found < 0, v.byte_ids[np.where(found < 0, -1 - found, 0)], found)
            else:
                out = []
                for x in found.tolist():
                    out += [x] if x >= 0 else [int(v.byte_ids[y]) for y in chr(-1 - x).encode()]
            yield i, s + 1, out, phi, include


def _parts(v: Vocabulary) -> list[bytes]:
    """What each piece stands for; control pieces for nothing."""
    return [bytes([int(p[3:5], 16)]) if k == 1 else b"" if k == 2 else p.replace(_SPACE, " ").encode() for p, k in zip(v.pieces, v.kinds.tolist(), strict=True)]


def decode(ids: list[int], v: Vocabulary) -> str:
    """The text of a segmentation; bytes that form no character become the replacement sign."""
    return _text(ids, _parts(v))


def _text(ids: list[int], parts: list[bytes]) -> str:
    text = b"".join([parts[i] for i in ids]).decode(errors="replace")
    return text[1:] if text.startswith(" ") else text


def _decoder(parts: list[bytes], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [None if ids is None else _text([i for i in ids if i is not None and 0 <= i < len(parts)], parts) for ids in part.column(0).to_pylist()]
                yield pa.record_batch([*[part.column(i) for i in range(1, part.num_columns)], pa.array(texts, pa.string())], names=[*names, "text"])

    return run


def decode_rows(pieces: DataFrame, ids_col: str = "token_ids", model_path: str | None = None, carry: tuple[str, ...] = ("doc_id", "sample")) -> DataFrame:
    """The columns in ``carry`` and the text of each row's piece ids.

    Null ids give a null text, no ids an empty one; null or unknown ids within a list are left out. Rows are neither joined
    nor moved. An empty table gives an empty table.
    """
    kinds = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in carry)
    rows = pieces.select(F.col(ids_col).cast("array<int>"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)])
    return rows.mapInArrow(_decoder(_parts(load(model_path or model_file(pieces.sparkSession))), list(carry)), f"{kinds}, text string")


def model_file(spark: SparkSession) -> str:
    """The vocabulary: what the session sets in spark.ledgerloom.pieces, else MODEL_PATH."""
    return spark.conf.get("spark.ledgerloom.pieces", MODEL_PATH)


def _give_back() -> None:
    """Memory that is free but still held by this worker goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # of glibc alone
        ctypes.CDLL(None).malloc_trim(0)


def _encoder(v: Vocabulary, k: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _give_back()  # the worker may have served other stages
        lat = Lattice([], v)
        for whole in batches:
            for batch in slices(whole, PIECE_CHARS):
                if lat.nodes > KEPT_CHARS:
                    lat.clear()
                keys = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
                rows, number, ids, logs, inclusion = [], [], [], [], []
                for i, s, x, phi, inc in sample_texts([t or "" for t in batch.column(0).to_pylist()], keys, v, k, lat):
                    rows.append(i)
                    number.append(s)
                    ids.append(np.asarray(x, np.int32))
                    logs.append(phi)
                    inclusion.append(inc)
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32()))
                keep = [batch.column(j).take(pa.array(rows, pa.int64())) for j in range(2, batch.num_columns)]
                yield pa.record_batch([*keep, pa.array(number, pa.int32()), tokens, pa.array(logs, pa.float64()), pa.array(inclusion, pa.float64())], names=[*names, "sample", "token_ids", "log_prob", "log_inclusion"])
                del batch, keys, rows, number, ids, logs, inclusion, offsets, tokens, keep
            del whole  # else it stays while the next one is read
            _give_back()

    return run


def encode(docs: DataFrame, k: int = K, seed: int = SEED, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Up to ``k`` distinct segmentations of each text: id, ``carry``, sample, token_ids, log_prob, log_inclusion.

    The key of a row is its id (null: its text). Null and empty texts have one segmentation, the empty one; a text with
    fewer than ``k`` segmentations gets them all, with log_inclusion 0. Repeated rows get the same segmentations. Other
    columns are ignored. An empty table gives an empty table. Decoding gives the text back, unless it holds the
    vocabulary's own sign for a blank.
    """
    v = load(model_path or model_file(docs.sparkSession))
    names = [id_col, *carry]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.col(text_col), F.lit("")))
    rows = docs.select(F.col(text_col), key.alias("_key"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(names)])
    return rows.mapInArrow(_encoder(v, k, names), f"{kinds}, sample int, token_ids array<int>, log_prob double, log_inclusion double")
