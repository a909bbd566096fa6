"""Removal of repeated passages by level-wise doubling.

Level one looks at windows of ``window / 2`` words. Of those, only minimisers (the smallest hash among the windows that
one full window holds) are compared: equal full windows have equal minimisers, so none is missed, and a tenth of the
rows is shuffled. Only where a minimiser is repeated is the window doubled to full length and compared again.

Hot passages: a task first settles repeats among its own rows and sends each hash once, so a hash reaches one task at
most once per flushed block of input, however many texts hold it. Exact copies of a text are settled by digest alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.textvec import Words, mix, pieces, slices, sliding

#: Rows a task gathers before it settles repeats among them.
BLOCK = 1 << 20
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def _batch(schema: list[tuple[str, pa.DataType]], **columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[n], t) for n, t in schema], names=[n for n, _ in schema])


_L1 = [("key", pa.int64()), ("doc", pa.int64()), ("pos", pa.int32()), ("kind", pa.int8())]
_L2 = [("key", pa.int64()), ("extra", pa.int32()), ("doc", pa.int64()), ("pos", pa.int32()), ("len", pa.int32()), ("kind", pa.int8())]


def _minimisers(words: Words, half: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the half windows, their minimum per full window, and which full windows lie in one text."""
    h, _ = words.windows(half)
    low = sliding(h, window - half + 1)
    m = len(low)
    return h, low, words.text[:m] == words.text[window - 1 :][:m]


def _level_one(half: int, window: int):
    span = window - half + 1

    def settle(h, doc, pos) -> pa.RecordBatch:
        _, at, n = np.unique(h, return_inverse=True, return_counts=True)
        again = n[at] > 1
        first = np.unique(h[again], return_index=True)[1] if again.any() else np.zeros(0, int)
        key = h.copy()
        key[again] = mix(h[again] + pos[again].astype(np.uint64) * _SPREAD + doc[again].astype(np.uint64))  # settled rows need no meeting
        marks = h[again][first]
        kind = np.concatenate((again.astype(np.int8), np.full(len(marks), 2, np.int8)))
        none = np.zeros(len(marks), np.int64)
        return _batch(_L1, key=np.concatenate((key, marks)).view(np.int64), doc=np.concatenate((doc, none)), pos=np.concatenate((pos, none)).astype(np.int32), kind=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        for batch in (part for whole in batches for part in slices(whole, column=1)):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for at, texts in pieces(batch.column(1).to_pylist()):
                words = Words(texts)
                h, low, whole = _minimisers(words, half, window)
                if not len(low):
                    continue
                low = np.where(whole, low, np.uint64(0))
                pad = np.zeros(span - 1, np.uint64)
                top = sliding(np.concatenate((pad, low, pad)), span, np.maximum)  # largest minimum of the windows around
                pos = np.flatnonzero((h == top[: len(h)]) & (h > 0))
                t = words.text[pos]
                kept.append((h[pos], ids[at + t], pos - words.first[t]))
                if sum(len(x[0]) for x in kept) >= BLOCK:
                    yield settle(*map(np.concatenate, zip(*kept, strict=True)))
                    kept = []
        if kept:
            yield settle(*map(np.concatenate, zip(*kept, strict=True)))

    return run


def _level_two(half: int, window: int):
    def settle(h, extra, doc, pos) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((pos, doc, h))
        h, extra, doc, pos = (x[order] for x in (h, extra, doc, pos))
        # The same window of a repeated row is no second occurrence.
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1]) | (extra[1:] != extra[:-1])))[: len(h)]
        h, extra, doc, pos = (x[new] for x in (h, extra, doc, pos))
        again = np.concatenate(([False], (h[1:] == h[:-1]) & (extra[1:] == extra[:-1])))
        first = ~again
        n = int(first.sum())
        yield _batch(_L2, key=h[first].view(np.int64), extra=extra[first], doc=doc[first], pos=pos[first].astype(np.int32), len=np.ones(n, np.int32), kind=np.zeros(n, np.int8))
        d, p = doc[again], pos[again]
        order = np.lexsort((p, d))
        yield runs(d[order], p[order])

    def runs(d, p) -> pa.RecordBatch:
        start = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1)))) if len(d) else np.zeros(0, int)
        size = np.diff(np.concatenate((start, [len(d)]))) if len(d) else start
        return _batch(_L2, key=mix(d[start].astype(np.uint64) * _SPREAD + p[start].astype(np.uint64)).view(np.int64), extra=np.zeros(len(start), np.int32), doc=d[start], pos=p[start].astype(np.int32), len=size.astype(np.int32), kind=np.ones(len(start), np.int8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        for batch in (part for whole in batches for part in slices(whole, column=1)):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            found = batch.column(2)
            offsets, values = found.offsets.to_numpy(), found.values.to_numpy(zero_copy_only=False)
            for at, texts in pieces(batch.column(1).to_pylist()):
                words = Words(texts)
                n = len(texts)
                lo, hi = offsets[at : at + n], offsets[at + 1 : at + n + 1]
                copies = np.array([b > a and values[a] < 0 for a, b in zip(lo, hi, strict=True)], bool)
                size = np.diff(words.first)
                whole_docs = np.flatnonzero(copies & (size >= window))
                if len(whole_docs):
                    d = ids[at + whole_docs]
                    yield _batch(_L2, key=mix(d.astype(np.uint64)).view(np.int64), extra=np.zeros(len(d), np.int32), doc=d, pos=np.zeros(len(d), np.int32), len=(size[whole_docs] - window + 1).astype(np.int32), kind=np.ones(len(d), np.int8))
                h, low, whole = _minimisers(words, half, window)
                if not len(low):
                    continue
                marked = np.full(len(h), np.uint64(2**64 - 1))
                counts = np.where(copies, 0, hi - lo)
                owner = np.repeat(np.arange(n), counts)
                picks = np.concatenate([values[a:b] for a, b, c in zip(lo, hi, copies, strict=True) if not c] or [np.zeros(0, int)])
                spots = picks + words.first[owner]
                marked[spots] = h[spots]
                pos = np.flatnonzero(whole & (sliding(marked, window - half + 1) == low))
                full, _ = words.windows(window)
                t = words.text[pos]
                check = (mix(words.hash[pos] ^ (words.hash[pos + window - 1] << np.uint64(1)) ^ (h[pos] * _SPREAD)) & np.uint64(0x7FFFFFFF)).astype(np.int32)
                kept.append((full[pos], check, ids[at + t], pos - words.first[t]))
                if sum(len(x[0]) for x in kept) >= BLOCK:
                    yield from settle(*map(np.concatenate, zip(*kept, strict=True)))
                    kept = []
        if kept:
            yield from settle(*map(np.concatenate, zip(*kept, strict=True)))

    return run


def _rebuild(window: int, names: list[str], as_is: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        word = re.compile(r"[^\x20\x09-\x0D]+")
        for batch in (part for whole in batches for part in slices(whole)):
            texts, spans = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            total, removed, out = [], [], []
            for text, runs in zip(texts, spans, strict=True):
                words = word.findall(text or "")
                gone = np.zeros(len(words) + 1, np.int32)
                for r in runs or ():
                    gone[r["pos"]] += 1
                    gone[r["pos"] + r["len"] + window - 1] -= 1
                gone = np.cumsum(gone[:-1]) > 0
                total.append(len(words))
                removed.append(int(gone.sum()))
                out.append(" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]) if removed[-1] else text if as_is else " ".join(words))
            keep = [batch.column(i) for i in range(2, batch.num_columns)]
            yield pa.record_batch([*keep, pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(out, pa.string())], names=[*names, "n_words", "n_removed", "kept_text"])

    return run


def drop_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), as_is: bool = False) -> DataFrame:
    """Remove every word covered by a ``window`` of words that also starts earlier in the collection.

    Earlier: a smaller id, or the same text further left. Windows are judged on the input. Returns the id, the columns
    in ``carry``, n_words, n_removed and kept_text (kept words joined by one space; with ``as_is``, a text that loses nothing
    is given back unchanged).

    Null and empty texts have no words and stay empty. Texts shorter than a window lose nothing. Rows with a null id keep
    all words and are no source for others. Repeated rows of one id count as one text and all get the same result. Other
    columns, whatever their names, are ignored unless named in ``carry``. An empty table gives an empty table.
    ``window`` must be even.
    """
    if window < 2 or window % 2:
        raise ValueError("window must be an even number of at least 2")
    half = window // 2
    names = [id_col, *carry]
    held = [f"_c{i}" for i in range(len(names))]
    every = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("body"), *[F.col(c).alias(h) for c, h in zip(names, held, strict=True)])
    base = every.where("doc is not null")
    # Exact copies: all but the smallest id are known to be repeated throughout.
    heads = base.select("doc", F.md5(F.col("body").cast("binary")).alias("digest"))
    first = heads.groupBy("digest").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    copies = heads.join(first, "digest").where("doc > first").select("doc", F.lit(-1).alias("pos"))

    one = base.select("doc", "body").mapInArrow(_level_one(half, window), "key long, doc long, pos int, kind byte")
    seen = F.count(F.lit(1)).over(Window.partitionBy("key"))
    alive = one.withColumn("n", seen).where("kind = 1 or (kind = 0 and n > 1)").select("doc", "pos")
    marked = alive.unionByName(copies).groupBy("doc").agg(F.array_sort(F.collect_set("pos")).alias("found"))
    # Both joins below take the very same columns of `base`, so that Spark shuffles the texts once and uses them twice.
    two = base.join(marked, "doc").select("doc", "body", "found", *held).mapInArrow(_level_two(half, window), "key long, extra int, doc long, pos int, len int, kind byte")
    place = F.dense_rank().over(Window.partitionBy("key", "extra", "kind").orderBy("doc", "pos"))
    gone = two.withColumn("place", place).where("kind = 1 or place > 1").groupBy("doc").agg(F.collect_set(F.struct("pos", "len")).alias("spans"))
    kinds = [(n, docs.schema[n].dataType.simpleString()) for n in names]
    schema = ", ".join(f"`{n}` {k}" for n, k in kinds) + ", n_words long, n_removed long, kept_text string"
    nameless = every.where("doc is null").withColumn("spans", F.lit(None).cast(gone.schema["spans"].dataType))
    rows = base.join(gone, "doc", "left").unionByName(nameless)
    return rows.select("body", "spans", *held).mapInArrow(_rebuild(window, names, as_is), schema)
