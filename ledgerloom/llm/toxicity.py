"""Toxicity by subword bags: a word's vector is the mean of its hashed character n-gram vectors, a text's the mean of the
vectors of its WORST words, and a linear softmax on that gives the text's probability. Worst words are those that the model
finds most toxic; every word of the whole text competes. N-gram vectors and softmax are trained jointly in numpy, each text
through the words that are worst at that time, so misspelt words share what their n-grams have learned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import crc_bucket
from ledgerloom.llm.ngrams import Grams
from ledgerloom.llm.textvec import pieces, slices

SIZES, BUCKETS, DIM, WORST = (3, 4, 5), 1 << 17, 6, 3
#: Bound of the training sample: rows a label, and bytes a label (the row that crosses that bound is the last).
SAMPLE, SAMPLE_BYTES = 1200, 16 << 20


def worst_words(word: np.ndarray, first: np.ndarray, size: int = WORST) -> tuple[np.ndarray, list[np.ndarray]]:
    """(mean of the ``size`` largest word scores, their places) for each text; -inf for a text without words."""
    best, at = np.full(len(first) - 1, -np.inf), [np.zeros(0, np.int64)] * (len(first) - 1)
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        if b > a:
            own = word[a:b]
            top = np.argpartition(own, -size)[-size:] if b - a > size else np.arange(b - a)
            best[i], at[i] = own[top].mean(), top + a
    return best, at


def _word_means(grams: Grams, table: np.ndarray) -> np.ndarray:
    value, count = np.zeros(len(grams.buf) + 1), np.zeros(len(grams.buf) + 1)
    for pos, bucket in grams.of(SIZES, BUCKETS):
        value[pos + 1] += table[bucket]
        count[pos + 1] += 1
    value, count = np.cumsum(value), np.cumsum(count)
    a, b = grams.starts - 1, grams.ends
    return (value[b] - value[a]) / np.maximum(count[b] - count[a], 1)


def train(texts: list[str], toxic: np.ndarray, epochs: int = 60, seed: int = 7) -> tuple[np.ndarray, float]:
    """N-gram table (log odds that each n-gram adds to a word) and bias, from texts with a word each and both labels."""
    rng = np.random.default_rng(seed)
    words: dict[bytes, int] = {}
    gram_word, gram_bucket, spots, first = [], [], [], [0]
    for t in texts:
        g = Grams([t.lower().encode()])
        own = g.buf.tobytes()
        ids = [words.setdefault(own[a:b], len(words)) for a, b in zip(g.starts.tolist(), g.ends.tolist(), strict=True)]
        spots.append(np.array(ids, np.int64))
        first.append(first[-1] + len(ids))
    g = Grams([b" ".join(words)])
    owner = np.repeat(np.arange(len(g.starts)), g.ends - g.starts + 1)  # a word and the blank before it
    base = np.concatenate([np.arange(a - 1, b) for a, b in zip(g.starts, g.ends, strict=True)]) if words else np.zeros(0, int)
    at = np.full(len(g.buf), -1)
    at[base] = owner
    for pos, bucket in g.of(SIZES, BUCKETS):
        ok = at[pos] >= 0
        gram_word.append(at[pos][ok].astype(np.int32))
        gram_bucket.append(bucket[ok].astype(np.int32))
    gram_word, gram_bucket = np.concatenate(gram_word), np.concatenate(gram_bucket)
    order = np.argsort(gram_word, kind="stable")
    gram_word, gram_bucket = gram_word[order], gram_bucket[order]
    sizes = np.bincount(gram_word, minlength=len(words))
    ends = np.cumsum(sizes)
    spots, first = np.concatenate(spots), np.array(first)

    # Start from each n-gram's log odds of turning up in a toxic text.
    seen = np.zeros((2, BUCKETS))
    for i, y in enumerate(toxic):
        own = np.unique(spots[first[i] : first[i + 1]])
        seen[int(y), np.unique(np.concatenate([gram_bucket[ends[w] - sizes[w] : ends[w]] for w in own]))] += 1
    n1, n0 = max(1, toxic.sum()), max(1, len(toxic) - toxic.sum())
    alpha = 6.0 / n1  # n-grams of few texts say little
    vectors = rng.normal(0, 0.01, (BUCKETS, DIM))
    vectors[:, 0] += np.log((seen[1] / n1 + alpha) / (seen[0] / n0 + alpha))
    soft = rng.normal(0, 0.01, (DIM, 2))
    soft[0] += (-1.0, 1.0)
    bias = np.zeros(2)
    gv, gs, gb = np.full(BUCKETS, 1e-3), np.full(soft.shape, 1e-3), np.full(2, 1e-3)
    weight = np.where(toxic == 1, 0.5 / n1, 1.0 / n0) * len(toxic)  # a clean text that is rejected costs more
    for epoch in range(epochs):
        table = vectors @ (soft[:, 1] - soft[:, 0])
        score = np.bincount(gram_word, table[gram_bucket], len(words)) / np.maximum(sizes, 1)
        best, places = worst_words(score[spots], first)
        if epoch == 0:  # bias: between the two labels' worst words
            high, low = np.median(best[toxic == 1]), np.median(best[toxic == 0])
            bias[1] = -(high + low) / 2
            soft *= np.sqrt(48 / max(1e-6, high - low))
            bias *= np.sqrt(48 / max(1e-6, high - low))
            continue
        step = np.zeros_like(vectors)
        ds, db = np.zeros_like(soft), np.zeros(2)
        for i, at in enumerate(places):
            own = spots[at]
            grams = [gram_bucket[ends[w] - sizes[w] : ends[w]] for w in own]
            bag = np.concatenate(grams)
            share = np.repeat([1 / (len(x) * len(own)) for x in grams], [len(x) for x in grams])
            mean = share @ vectors[bag]
            z = mean @ soft + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            d = (p - np.eye(2)[int(toxic[i])]) * weight[i]
            np.add.at(step, bag, share[:, None] * (soft @ d))
            ds += np.outer(mean, d)
            db += d
        step, ds, db = step / len(toxic), ds / len(toxic), db / len(toxic)
        gv += (step**2).sum(1)
        gs += ds**2
        gb += db**2
        vectors -= 0.6 * step / np.sqrt(gv)[:, None]
        soft -= 0.05 * ds / np.sqrt(gs)
        bias -= 0.05 * db / np.sqrt(gb)
    return (vectors @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def _scorer(model: tuple[np.ndarray, float] | None, names: list[str], source: list[int]):
    """``source``: the batch's column of each name (0 is the text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            scores = [np.zeros(0)]
            for _, texts in pieces(batch.column(0).to_pylist(), lower=True):
                if model is None:
                    scores.append(np.zeros(len(texts)))
                    continue
                grams = Grams(texts)
                best, _ = worst_words(_word_means(grams, model[0]), grams.first)
                z = np.where(np.isfinite(best), best, 0.0) + model[1]
                scores.append(np.where(np.isfinite(best), 1 / (1 + np.exp(-np.clip(z, -500, 500))), 0.0))
            keep = [batch.column(i) for i in source]
            yield pa.record_batch([*keep, pa.array(np.concatenate(scores), pa.float64())], names=[*names, "score"])

    return run


def fit(docs: DataFrame, labels: DataFrame, fold: tuple[int, int] | None = (3, 1), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    """Train on at most SAMPLE rows of each label, those of the smallest hashes of ids, whatever their texts' length; of
    those, in the same order, as many as SAMPLE_BYTES holds, and one at least.

    ``fold`` (n, k): rows whose crc32(id) mod n is k are never learned from. Null ids, null labels and labels other than 0
    and 1 are left out, and so are texts without a word. An id with several labels counts as toxic if one says so; of
    several texts of one id the smallest is taken. None if a label has no text with a word.
    """
    marks = labels.select(F.col(id_col).cast("long").alias("doc"), F.col(label_col).cast("int").alias("toxic")).where("doc is not null and toxic in (0, 1)")
    if fold:
        marks = marks.where(crc_bucket(F.col("doc"), fold[0]) != fold[1])
    marks = marks.groupBy("doc").agg(F.max("toxic").alias("toxic"))
    picks = [marks.where(F.col("toxic") == y).orderBy(F.xxhash64("doc"), "doc").limit(SAMPLE) for y in (0, 1)]
    small = F.broadcast(picks[0].union(picks[1]))  # at most 2 * SAMPLE rows
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("body")).where("body is not null").join(small, "doc").groupBy("doc", "toxic").agg(F.min("body").alias("body"))
    before = Window.partitionBy("toxic").orderBy(F.xxhash64("doc"), "doc").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("size", F.octet_length("body").cast("long")).withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    got = sorted([(r["doc"], r["toxic"], r["body"]) for r in rows.where(F.col("before") < SAMPLE_BYTES).collect() if len(Grams([r["body"].lower().encode()]).starts)])
    y = np.array([r[1] for r in got], np.int64)
    return train([r[2] for r in got], y) if len(set(y.tolist())) == 2 else None


def score(docs: DataFrame, model, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``carry`` and score: probability that the text is toxic, by the worst words of the whole text.

    Null and empty texts and those without a letter or digit score 0. Without a model every score is 0. Rows are neither
    joined nor moved, so repeated rows, null ids and extra columns don't matter. An empty table gives an empty table.
    """
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    others = [c for c in carry if c != text_col]
    rows = docs.select(F.col(text_col).alias("_text"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(others)])
    source = [0 if c == text_col else 1 + others.index(c) for c in carry]
    return rows.mapInArrow(_scorer(model, list(carry), source), f"{kinds}, score double")
