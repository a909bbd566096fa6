"""Language identification in two steps: the family by one-versus-rest linear support vector machines, then, within the
family, one machine for each pair of its languages, which vote. Features are relative frequencies of hashed character
n-grams of the whole lower-case text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import crc_bucket
from ledgerloom.llm.ngrams import Grams
from ledgerloom.llm.textvec import pieces, slices

SIZES, BUCKETS = (1, 2, 3), 1 << 13
#: Bounds of the training sample: rows a language, languages (the most frequent), rows and bytes of text in all, which the
#: languages share evenly (the row that crosses a language's share of the bytes is its last).
SAMPLE, LANGUAGES, SAMPLE_ROWS, SAMPLE_BYTES, SALTS = 400, 100, 4000, 64 << 20, 16
#: Families by language code; a language that is not named here is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
}
_LETTER = regex.compile(r"\p{L}")
#: ASCII digits and punctuation part words; digits say nothing about the language.
_BLANK = np.zeros(256, bool)
_BLANK[:128] = True
_BLANK[[b for b in range(128) if chr(b).isalpha()]] = False


def family_of(lang: str) -> str:
    return next((f for f, own in FAMILIES.items() if lang in own), lang)


def frequencies(texts: list[bytes]) -> np.ndarray:
    """(texts, buckets): each bucket's share of the text's n-grams."""
    out = np.zeros((len(texts), BUCKETS))
    for at in range(0, len(texts), 128):
        own = texts[at : at + 128]
        g, cells = Grams(own, _BLANK), len(own) * BUCKETS
        owner = np.repeat(np.arange(len(own)), [len(t) + 1 for t in own])  # of each byte, the blank before a text included
        owner = np.concatenate((owner, [len(own) - 1] * (len(g.buf) - len(owner))))
        for pos, bucket in g.of(SIZES, BUCKETS):
            out[at : at + 128] += np.bincount(owner[pos] * BUCKETS + bucket, minlength=cells).reshape(len(own), BUCKETS)
    return out / np.maximum(out.sum(1, keepdims=True), 1)


def svm(x: np.ndarray, y: np.ndarray, steps: int = 300, reg: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and offset of a linear machine (squared hinge loss, gradient with momentum); classes weigh the same."""
    x, y = x.astype(np.float32, copy=False), y.astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), np.float32(0)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    rate = np.float32(1.0 / (2 * (np.einsum("ij,ij->i", x, x) + 1).max() + reg))
    vw, vb, reg, keep = np.zeros_like(w), np.float32(0), np.float32(reg), np.float32(0.9)
    for _ in range(steps):
        d = np.float32(-2) * share * y * np.maximum(0, 1 - y * (x @ w + b))
        vw = keep * vw + d @ x + reg * w
        vb = keep * vb + d.sum()
        w -= rate * vw
        b -= rate * vb
    return w, b


def train(texts: list[str], langs: list[str]) -> dict:
    """Tables of weights by n-gram bucket: one column for each family machine and each pair of related languages."""
    x = frequencies([t.lower().encode() for t in texts]).astype(np.float32)
    scale = 1 / (x.std(0) + 1e-4)
    scale /= np.sqrt((((x * scale) ** 2).sum(1)).mean())
    x = (x * scale).astype(np.float32)
    langs = np.array(langs)
    families = sorted({family_of(v) for v in langs})
    fam = np.array([family_of(v) for v in langs])
    machines: list[tuple[str, str, str]] = []
    columns, offsets = [], []
    jobs = [("family", f, "", np.ones(len(fam), bool), fam == f) for f in families] if len(families) > 1 else []
    for f in families:
        own = sorted(set(langs[fam == f]))
        jobs += [(f, a, b, (langs == a) | (langs == b), langs == a) for a, b in combinations(own, 2)]
    for step, a, b, rows, yes in jobs:
        w, o = svm(x[rows], np.where(yes[rows], 1.0, -1.0))
        machines.append((step, a, b))
        columns.append(w * scale)
        offsets.append(o)
    table = np.stack(columns, 1).astype(np.float64) if columns else np.zeros((BUCKETS, 0))
    return {"table": table, "offsets": np.array(offsets), "machines": machines, "families": {f: sorted(set(langs[fam == f])) for f in families}}


def margins(model: dict, texts: list[bytes]) -> np.ndarray:
    """(texts, machines) signed distances."""
    return np.concatenate([frequencies(texts[at : at + 128]) @ model["table"] for at in range(0, len(texts), 128)]) + model["offsets"]


def decide(model: dict, m: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of each row of margins: a logistic of the smallest margin that was decisive."""
    n = len(m)
    at = {key: i for i, key in enumerate(model["machines"])}
    names = list(model["families"])
    fam = np.stack([m[:, at["family", f, ""]] for f in names], 1) if len(names) > 1 else np.ones((n, 1)) * 4
    pick = fam.argmax(1)
    least = np.sort(fam, 1)[:, -1] - (np.sort(fam, 1)[:, -2] if len(names) > 1 else 0)
    lang = np.empty(n, object)
    for i, f in enumerate(names):
        rows = np.flatnonzero(pick == i)
        own = model["families"][f]
        votes, sums = np.zeros((len(rows), len(own))), np.zeros((len(rows), len(own)))
        for a, b in combinations(range(len(own)), 2):
            d = m[rows, at[f, own[a], own[b]]]
            votes[np.arange(len(rows)), np.where(d >= 0, a, b)] += 1
            sums[:, a] += d
            sums[:, b] -= d
        best = (votes + 1e-3 * np.tanh(sums)).argmax(1)
        lang[rows] = [own[j] for j in best]
        for a, b in combinations(range(len(own)), 2):
            d = np.abs(m[rows, at[f, own[a], own[b]]])
            hit = (best == a) | (best == b)
            least[rows[hit]] = np.minimum(least[rows[hit]], 2 * d[hit])
    return list(lang), 1 / (1 + np.exp(-2 * np.clip(least, 0, 50)))


def _predictor(model: dict | None, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            column = batch.column(0).to_pylist()
            langs: list[str] = []
            scores = [np.zeros(0)]
            for _, texts in pieces(column, lower=True):
                own, s = decide(model, margins(model, texts)) if model else (["und"] * len(texts), np.zeros(len(texts)))
                langs += own
                scores.append(s)
            scores = np.concatenate(scores)
            for i, t in enumerate(column):
                if t is None or not _LETTER.search(t):
                    langs[i], scores[i] = "und", 0.0
            keep = [batch.column(i) for i in range(1, batch.num_columns)]
            yield pa.record_batch([*keep, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*names, "lang_pred", "score"])

    return run


def fit(docs: DataFrame, fold: tuple[int, int] | None = (4, 2), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict | None:
    """Train on a bounded sample of each of the LANGUAGES most frequent languages, texts of any length, those of the smallest
    hashes of ids; rows whose crc32(id) mod n is k are never learned from.

    Null ids, texts and languages are left out; of several texts of one id and language the smallest is taken. None if
    there is nothing to learn from.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("body"), F.col(lang_col).alias("lang")).where("doc is not null and body is not null and lang is not null")
    if fold:
        rows = rows.where(crc_bucket(F.col("doc"), fold[0]) != fold[1])
    known = [r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()]
    if not known:
        return None
    each = max(1, min(SAMPLE, SAMPLE_ROWS // len(known)))
    heads = rows.where(F.col("lang").isin(known)).select("doc", "lang", F.pmod(F.xxhash64("doc", F.lit(1)), F.lit(SALTS)).alias("salt"))
    order = [F.xxhash64("doc"), F.col("doc")]
    for keys in (["lang", "salt"], ["lang"]):  # in parts first: no task ranks a whole language
        first = F.dense_rank().over(Window.partitionBy(*keys).orderBy(*order))
        heads = heads.withColumn("r", first).where(F.col("r") <= each)
    small = F.broadcast(heads.select("doc", "lang").distinct())  # SAMPLE_ROWS at most
    got = rows.join(small, ["doc", "lang"]).groupBy("doc", "lang").agg(F.min("body").alias("body")).withColumn("size", F.octet_length("body").cast("long"))
    before = Window.partitionBy("lang").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    got = got.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).where(F.col("before") < SAMPLE_BYTES // len(known))
    got = sorted(got.select("doc", "lang", "body").collect())
    return train([r["body"] for r in got], [r["lang"] for r in got])


def predict(docs: DataFrame, model: dict | None, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``carry``, lang_pred and score (0 to 1).

    A null text or one without a letter is ``und`` with score 0; so is every row if nothing could be learned. Rows are
    neither joined nor moved, so repeated rows, null ids and extra columns don't matter. Empty tables stay empty.
    """
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.select(F.col(text_col), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)]).mapInArrow(_predictor(model, list(carry)), f"{kinds}, lang_pred string, score double")
