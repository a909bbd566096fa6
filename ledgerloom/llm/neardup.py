"""Near duplicates: dart-throwing weighted MinHash, banded joining, exact check of candidate pairs.

Each occurrence of a five-word shingle is a unit region of its weight. Hashed darts fall on a region as a Poisson process
of rank (the first, second, ... arrival of the same region is the same in every text); a text keeps, per coordinate, the
dart of lowest rank. Two texts agree in a coordinate with probability equal to their weighted Jaccard similarity. Only
about ``k ln k + 2k`` darts a text are thrown, whatever its length.

Exact copies are settled by digest first, so that a group of copies costs one signature in the joins. Within a bucket of
at most SMALL distinct texts all pairs are candidates; in a larger one every text meets two centres, and what is not yet
in the bucket's main component then meets the whole bucket, block by block. Every link is checked on the texts' full
shingle counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize
from ledgerloom.llm.textvec import ALNUM, Words, mix, pieces, slices

BANDS, ROWS = 24, 4
SHINGLE, SIMILARITY = 5, 0.8
SMALL, BLOCK = 24, 256
_STEP = np.uint64(0xA0761D6478BD642F)


def shingles(texts: list[bytes], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count) of each distinct shingle; a text of fewer than n words has one shingle of them all."""
    words = Words(texts, ALNUM)
    h, whole = words.windows(n)
    text = words.text[: len(h)][whole]
    h = h[whole]
    size = np.diff(words.first)
    for i in np.flatnonzero((size > 0) & (size < n)):
        a, b = words.first[i], words.first[i + 1]
        own = np.uint64(b - a)
        for x in words.hash[a:b]:
            own = mix(np.array([own ^ x]))[0]
        text, h = np.append(text, i), np.append(h, own)
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (h[1:] != h[:-1])))) if len(h) else np.zeros(0, int)
    return text[new], h[new], np.diff(np.concatenate((new, [len(h)])))


def dart_signatures(texts: list[bytes], k: int = BANDS * ROWS) -> tuple[np.ndarray, np.ndarray]:
    """k dart ids for each text, and whether the text has any shingle."""
    owner, h, count = shingles(texts)
    n = len(texts)
    total = np.bincount(owner, count, n)
    cell = mix(np.repeat(h, count) + _STEP * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)).astype(np.uint64))
    owner = np.repeat(owner, count)
    best, ids = np.full(n * k, np.inf), np.zeros(n * k, np.uint64)
    todo, far = total > 0, (k * np.log(k) + 2 * k) / np.maximum(total, 1)
    while todo.any():
        at = np.flatnonzero(todo[owner])
        rank, c, arrival = np.zeros(len(at)), cell[at], 0
        best[np.repeat(todo, k)] = np.inf
        while len(at):
            arrival += 1
            dart = mix(c + np.uint64(int(_STEP) * arrival % 2**64))
            rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            near = rank <= far[owner[at]]
            at, c, rank, dart = at[near], c[near], rank[near], dart[near]
            slot = owner[at] * k + (mix(dart ^ _STEP) % np.uint64(k)).astype(np.int64)
            np.minimum.at(best, slot, rank)
            won = best[slot] == rank
            ids[slot[won]] = dart[won]
        todo &= np.isinf(best.reshape(n, k)).any(axis=1)
        far = far * 2  # rare: a coordinate that no dart has reached
    return ids.reshape(n, k), total > 0


def band_hashes(texts: list[bytes], bands: int = BANDS, rows: int = ROWS) -> list[np.ndarray | None]:
    ids, some = dart_signatures(texts, bands * rows)
    ids = ids.reshape(len(texts), bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), ids.shape[:2]).copy()
    for j in range(rows):
        out = mix(out * _STEP ^ ids[:, :, j])
    return [x if y else None for x, y in zip(out.view(np.int64), some, strict=True)]


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, column=2)):
        found: list = []
        for _, texts in pieces(batch.column(2).to_pylist(), lower=True):
            found += band_hashes(texts)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["doc", "digest", "bands"])


def similarity(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Weighted Jaccard similarity of the shingle counts of a[i] and b[i]."""
    n = len(a)
    ta, ha, ca = shingles(a)
    tb, hb, cb = shingles(b)
    text, h, c, side = np.concatenate((ta, tb)), np.concatenate((ha, hb)), np.concatenate((ca, cb)), np.repeat([0, 1], [len(ta), len(tb)])
    order = np.lexsort((side, h, text))
    text, h, c = text[order], h[order], c[order]
    same = np.flatnonzero((text[1:] == text[:-1]) & (h[1:] == h[:-1])) if len(h) else np.zeros(0, int)
    both = np.bincount(text[same], np.minimum(c[same], c[same + 1]), n)
    every = np.bincount(text, c, n) - both
    return np.where(every > 0, both / np.maximum(every, 1), 0.0)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for half in slices(whole, column=2) for part in slices(half, column=3)):
        ta, tb = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        sims = [np.zeros(0)]
        own: tuple[list, list] = ([], [])
        for x, y in zip(ta, tb, strict=True):
            own[0].append((x or "").lower().encode())
            own[1].append((y or "").lower().encode())
            if sum(map(len, own[0])) + sum(map(len, own[1])) > 1 << 20 or len(own[0]) >= 256:
                sims.append(similarity(*own))
                own = ([], [])
        sims.append(similarity(*own) if own[0] else np.zeros(0))
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(np.concatenate(sims), pa.float64())], names=["a", "b", "sim"])


def components(links: DataFrame) -> DataFrame:
    """(node, label): label is the smallest node of the component. ``links``: (a, b) with a < b.

    Alternating large-star and small-star rounds; each keeps the components and ends in stars. Minima are written before
    the edges meet them, so that both sides of a join come straight from a shuffle and Spark can split a hot node.
    """
    edges = materialize(links.select("a", "b").where("a != b").distinct())
    while True:
        both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
        low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("m").alias("a"), F.explode(F.array("u", "v")).alias("b")).where("a != b").distinct()
        new = materialize(small)
        # stars: nobody who is a centre hangs on another
        if new.select("b").intersect(new.select("a")).isEmpty() and new.groupBy("b").count().where("count > 1").isEmpty():
            return new.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(new.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())
        edges = new


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: id, digest (MD5 of the text), class_id (the smallest id of its group), n_links_found (how many
    different texts were found similar to this one: in a small bucket all, in a large one those the classes needed) and
    kept: whether the row is the class's first (smallest id, then digest), true for each of its repeats.

    Words are runs of letters and digits in lower case; a text of fewer than five words is one shingle. Exact copies
    share a class whatever they hold, so equal texts without a word do too; null texts stand alone and are kept. Rows with
    a null id get a null class and are kept. Texts are told apart by digest: rows of one id with different texts have a
    class each, unless those are similar. Repeated rows give repeated results. Other columns are ignored. An empty table
    gives none.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc"), F.md5(F.col(text_col).cast("binary")).alias("digest"), F.col(text_col).alias("text"))
    known = base.where("doc is not null and text is not null")
    signed = materialize(known.select("doc", "digest", "text").mapInArrow(_bands, "doc long, digest string, bands array<long>"))
    classes = _nodes(materialize(signed.groupBy("digest").agg(F.min("doc").alias("rep"))))
    reps = signed.join(classes, (signed.digest == classes.digest) & (signed.doc == classes.rep)).drop(signed.digest).dropDuplicates(["digest"]).select("node", "bands")
    spread = materialize(reps).select("node", F.explode("bands").alias("band"))
    # Written, so that in the join both sides come straight from a shuffle and Spark can split a hot bucket.
    sizes = materialize(spread.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("c1"), F.min_by("node", F.xxhash64("node")).alias("c2")).where("n > 1"))
    members = materialize(spread.join(sizes, "band"))
    wanted = members.select("node").distinct().join(classes, "node").select(F.col("rep").alias("doc"), "digest", "node")
    texts = materialize(known.join(wanted, ["doc", "digest"]).dropDuplicates(["doc", "digest"]).select("node", "text"))

    def check(pairs: DataFrame) -> DataFrame:
        """Those of the (a, b) pairs that are similar."""
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct()
        met = ordered.join(texts.alias("x"), F.col("a") == F.col("x.node")).join(texts.alias("y"), F.col("b") == F.col("y.node"))
        return materialize(met.select("a", "b", F.col("x.text").alias("ta"), F.col("y.text").alias("tb")).mapInArrow(_checked, "a long, b long, sim double").where(F.col("sim") >= threshold))

    few = members.where(F.col("n") <= SMALL).groupBy("band").agg(F.array_sort(F.collect_list("node")).alias("d"))  # at most SMALL each
    few = few.select("d").distinct().select(F.explode("d").alias("a"), "d").select("a", F.explode(F.filter("d", lambda x: x > F.col("a"))).alias("b"))
    many = members.where(F.col("n") > SMALL)
    stars = many.select(F.explode(F.array("c1", "c2")).alias("a"), F.col("node").alias("b"))
    links = check(few.union(stars)).select("a", "b")
    label = components(links)
    if not many.isEmpty():
        links = links.union(_settled(many, label, texts, threshold))
        label = components(links)
    label = materialize(label)
    ends = links.distinct().select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links_found"))
    named = classes.join(label, "node", "left").join(ends, "node", "left")
    if classes.where("node != rep").isEmpty():
        named = named.withColumn("class_id", F.coalesce("label", "rep")).withColumn("first", F.col("node") == F.col("class_id"))
    else:  # some nodes are no ids: the smallest id of each component is looked up
        lowest = label.join(classes, "node").groupBy("label").agg(F.min(F.struct("rep", "digest")).alias("low"))
        named = named.join(lowest, "label", "left").withColumn("class_id", F.coalesce("low.rep", "rep")).withColumn("first", F.coalesce(F.col("low.digest") == F.col("digest"), F.lit(True)))
    named = named.select("digest", "class_id", "n_links_found", "rep", "first")
    lone = F.col("doc").isNull() | F.col("class_id").isNull()
    return (
        base.drop("text").join(named, "digest", "left")
        .select(
            F.col("doc").alias("_id"), "digest", F.when(F.col("doc").isNotNull(), F.coalesce("class_id", "doc")).alias("class_id"),
            F.when(F.col("doc").isNotNull(), F.coalesce("n_links_found", F.lit(0))).alias("n_links_found"), F.when(lone, True).otherwise(F.col("first") & (F.col("doc") == F.col("rep"))).alias("kept"),
        )
        .withColumnRenamed("_id", id_col)
    )


def _nodes(classes: DataFrame) -> DataFrame:
    """(digest, rep, node): node is the class's smallest id; where several texts share that, the smallest digest has it and the
    others get numbers above all ids."""
    shared = materialize(classes.groupBy("rep").agg(F.min("digest").alias("d"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    if shared.isEmpty():
        return classes.withColumn("node", F.col("rep"))
    top = classes.agg(F.max("rep")).first()[0] + 1
    more = materialize(classes.join(shared, "rep").where("digest != d").select("digest", (F.lit(top) + F.monotonically_increasing_id()).alias("node")))
    return materialize(classes.join(more, "digest", "left").withColumn("node", F.coalesce("node", "rep")))


def _occurrences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, key) of each shingle occurrence, equal keys for equal occurrences in different texts; and texts' sizes."""
    owner, h, count = shingles(texts)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(owner, count), mix(np.repeat(h, count) + _STEP * nth.astype(np.uint64)), np.bincount(owner, count, len(texts))


def _block(threshold: float):
    """Links between the texts of two blocks: similarities from products of occurrence matrices, some columns at a time."""

    def run(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        doc, label = table["node"].to_numpy(), table["label"].to_numpy()
        body = [(x or "").lower().encode() for x in table["body"].to_pylist()]
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        tl, kl, sl = _occurrences([body[i] for i in left])
        tr, kr, sr = _occurrences([body[i] for i in right])
        shared = np.intersect1d(kl, kr)
        both = np.zeros((len(left), len(right)), np.float32)
        for at in range(0, len(shared), 4096):
            cols = shared[at : at + 4096]
            x, y = np.zeros((len(left), len(cols)), np.float32), np.zeros((len(right), len(cols)), np.float32)
            for m, t, k in ((x, tl, kl), (y, tr, kr)):
                j = np.minimum(np.searchsorted(cols, k), len(cols) - 1)
                hit = cols[j] == k
                m[t[hit], j[hit]] = 1
            both += x @ y.T
        every = sl[:, None] + sr[None, :] - both
        close = (both >= threshold * every) & (every > 0) & (label[left][:, None] != label[right][None, :])
        i, j = np.nonzero(close)
        return pa.table({"a": pa.array(np.minimum(doc[left[i]], doc[right[j]])), "b": pa.array(np.maximum(doc[left[i]], doc[right[j]]))}).group_by(["a", "b"]).aggregate([])

    return run


def _settled(many: DataFrame, label: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The links that the centres of large buckets leave open.

    In each large bucket, every member outside the bucket's largest component meets every member that is in another
    component than itself; only pairs within one component are left out. Blocks of at most about BLOCK by BLOCK texts are
    compared as matrices, so that no row is made for a pair, and no task holds more than two blocks.
    """
    at = materialize(many.select("band", "node").join(label, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label")))
    main = at.groupBy("band", "label").count().groupBy("band").agg(F.max_by("label", F.struct("count", -F.col("label"))).alias("main"), F.sum("count").alias("n"), (F.sum("count") - F.max("count")).alias("u"))
    main = materialize(main.where("u > 0"))  # written, so that Spark can split a hot bucket in the join
    at = at.join(main, "band").withColumn("out", F.col("label") != F.col("main"))
    at = at.withColumn("nl", F.ceil(F.col("u") / BLOCK).cast("int")).withColumn("nr", F.ceil(F.col("n") / BLOCK).cast("int"))
    own = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = at.where("out").select("band", "node", "label", own("nl", 1).alias("l"), every("nr").alias("r"), F.lit(0).alias("side"))
    right = at.select("band", "node", "label", every("nl").alias("l"), own("nr", 2).alias("r"), F.lit(1).alias("side"))
    sides = left.unionByName(right).join(texts.select("node", F.col("text").alias("body")), "node")
    return materialize(sides.groupBy("band", "l", "r").applyInArrow(_block(threshold), "a long, b long")).distinct()
