"""Approximate nearest neighbours by inner product: a hierarchical navigable small-world graph per shard.

Equal vectors form one class (with its smallest ids), so that copies don't crowd a graph. Classes are dealt to shards by
hash; a shard's graph is built in one task of bounded size and kept as flat arrays: vectors, neighbours of the ground
layer, and nodes and neighbours of each upper layer. Queries come in blocks; every block searches every shard, all its
queries in step; the shards' results are merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize
from ledgerloom.llm.textvec import mix

#: Distinct vectors a shard, queries a block, and queries that move in step.
SHARD, BLOCK, STEP = 4096, 8192, 512
LINKS, GROUND_LINKS, BREADTH, EXPAND, STARTS = 16, 32, 72, 4, 256
_POOL = 64


def _diverse(order: np.ndarray, near: np.ndarray, gram: np.ndarray, keep: int) -> np.ndarray:
    """For each row, up to ``keep`` of the candidates in ``order`` (nearest first, -1 for none), leaving out those that are
    nearer to one already kept than to the row itself. ``near``: the candidates' inner products with the row."""
    n, width = order.shape
    out, used = np.full((n, keep), -1, np.int32), np.zeros(n, np.int64)
    for c in range(width):
        own = order[:, c]
        ok = (own >= 0) & (used < keep)
        rows = np.flatnonzero(ok)
        if not len(rows):
            continue
        kept = out[rows]
        close = np.where(kept >= 0, gram[np.maximum(kept, 0), own[rows][:, None]], -np.inf).max(1)
        rows = rows[close < near[rows, c]]
        out[rows, used[rows]] = own[rows]
        used[rows] += 1
    return out


def _nearest(gram: np.ndarray, k: int, earlier: bool) -> tuple[np.ndarray, np.ndarray]:
    """(places, inner products) of the k nearest of each row, nearest first; ``earlier``: among the rows before it (-1: none)."""
    n = len(gram)
    k = min(k, n)
    order, near = np.empty((n, k), np.int64), np.empty((n, k), np.float32)
    for a in range(0, n, 512):
        rows = gram[a : a + 512].copy()
        at = np.arange(a, a + len(rows))
        if earlier:
            rows[np.arange(n) >= at[:, None]] = -np.inf
        else:
            rows[np.arange(len(rows)), at] = -np.inf
        top = np.argpartition(-rows, k - 1, 1)[:, :k]
        sims = np.take_along_axis(rows, top, 1)
        seq = np.argsort(-sims, 1, kind="stable")
        order[at], near[at] = np.take_along_axis(top, seq, 1), np.take_along_axis(sims, seq, 1)
    order[~np.isfinite(near)] = -1
    return order, near


def _layer(x: np.ndarray, links: int) -> np.ndarray:
    """Neighbours of each row when rows join the graph one after another: links to earlier rows, and back."""
    n = len(x)
    gram = x @ x.T
    first = _diverse(*_nearest(gram, _POOL, True), gram, links)
    i, c = np.nonzero(first >= 0)
    a, b = np.concatenate((i, first[i, c])), np.concatenate((first[i, c], i))
    sims = gram[a, b]
    seq = np.lexsort((-sims, a))
    a, b, sims = a[seq], b[seq], sims[seq]
    start = np.searchsorted(a, np.arange(n + 1))
    at = np.arange(len(a)) - start[a]
    wide = min(2 * links, int(at.max(initial=0)) + 1)
    order, near = np.full((n, wide), -1, np.int64), np.full((n, wide), -np.inf, np.float32)
    ok = at < wide
    order[a[ok], at[ok]], near[a[ok], at[ok]] = b[ok], sims[ok]
    # Half of the links are chosen to be diverse; the other half, and what room is left, goes to the nearest of all: within a
    # tight cluster the choice above keeps little but the cluster's centre.
    half = links // 2
    some, _ = _nearest(gram, links, False)
    every = np.concatenate((_diverse(order, near, gram, half), some), 1)
    again = np.zeros(every.shape, bool)  # the same row twice: the first counts
    seq = np.argsort(every, 1, kind="stable")
    ordered = np.take_along_axis(every, seq, 1)
    np.put_along_axis(again, seq[:, 1:], ordered[:, 1:] == ordered[:, :-1], 1)
    every[again] = -1
    out = np.take_along_axis(every, np.argsort(every < 0, 1, kind="stable"), 1)[:, :links].astype(np.int32)
    if out.shape[1] < links:
        out = np.concatenate((out, np.full((n, links - out.shape[1]), -1, np.int32)), 1)
    # A row that nobody links to is linked by its nearest earlier one.
    reached = np.zeros(n, bool)
    reached[out[out >= 0]] = True
    for r in np.flatnonzero(~reached):
        if first[r, 0] >= 0:
            out[first[r, 0], -1] = r
    return out


def build(vectors: np.ndarray) -> dict:
    """The graph of a shard. Vectors get one more component, which makes all lengths equal and keeps inner products."""
    x = vectors.astype(np.float64)
    square = np.einsum("ij,ij->i", x, x)
    x = np.concatenate((x, np.sqrt(np.maximum(square.max() - square, 0))[:, None]), 1)
    x = (x / max(np.sqrt(square.max()), 1e-300)).astype(np.float32)
    draw = (mix(np.arange(len(x), dtype=np.uint64) + np.uint64(99)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
    level = np.floor(-np.log(draw + 1e-18) / np.log(LINKS)).astype(int)
    layers = []
    for at in range(1, level.max(initial=0) + 1):
        nodes = np.flatnonzero(level >= at).astype(np.int32)
        layers.append((nodes, _layer(x[nodes], LINKS)))
    longest = np.argsort(-square, kind="stable")[:STARTS].astype(np.int32)
    return {"x": x, "ground": _layer(x, GROUND_LINKS), "layers": layers, "longest": longest}


def search(graph: dict, queries: np.ndarray, breadth: int = BREADTH) -> np.ndarray:
    """(queries, breadth) row numbers; -1 for none. All queries move in step.

    From the top each query goes down to the ground layer, where it starts from the row it has come to, from the rows of the
    highest layers and from the longest vectors, which are near many queries by inner product.
    """
    x, ground = graph["x"], graph["ground"]
    n = len(x)
    q = np.concatenate((queries, np.zeros((len(queries), 1))), 1)
    q = (q / np.maximum(np.sqrt(np.einsum("ij,ij->i", q, q)), 1e-300)[:, None]).astype(np.float32)
    at = np.zeros(len(q), np.int64)
    if graph["layers"]:
        at[:] = graph["layers"][-1][0][0]
    for nodes, near in reversed(graph["layers"]):
        place = np.searchsorted(nodes, at)
        best = np.einsum("ij,ij->i", q, x[at])
        live = np.arange(len(q))
        while len(live):
            step = near[place[live]]
            sims = np.where(step >= 0, np.einsum("ij,ikj->ik", q[live], x[nodes[np.maximum(step, 0)]]), -np.inf)
            pick = sims.argmax(1)
            gain = sims[np.arange(len(live)), pick]
            up = gain > best[live]
            live, step, pick = live[up], step[up], pick[up]
            place[live], best[live] = step[np.arange(len(live)), pick], gain[up]
        at = nodes[place].astype(np.int64)
    width = min(breadth, n)
    high = np.concatenate([nodes[:STARTS] for nodes, _ in graph["layers"][1:]] or [np.zeros(0, np.int32)])
    starts = np.unique(np.concatenate((graph["longest"], high)))
    ids = np.concatenate((np.broadcast_to(starts, (len(q), len(starts))), at[:, None]), 1)
    sims = np.concatenate((q @ x[starts].T, np.einsum("ij,ij->i", q, x[at])[:, None]), 1)
    sims[:, -1][np.isin(at, starts)] = -np.inf  # once is enough
    seen = np.zeros((len(q), n), bool)
    np.put_along_axis(seen, ids, True, 1)
    pad = max(0, width - ids.shape[1])
    ids, sims = np.pad(ids, ((0, 0), (0, pad)), constant_values=-1), np.pad(sims, ((0, 0), (0, pad)), constant_values=-np.inf)
    top = np.argpartition(-sims, width - 1, 1)[:, :width]
    ids, sims = np.take_along_axis(ids, top, 1), np.take_along_axis(sims, top, 1)
    done = ~np.isfinite(sims)
    ids[done] = -1
    live, expand = np.arange(len(q)), min(EXPAND, width)
    while True:
        open_ = np.where(done[live], -np.inf, sims[live])
        some = (open_ > -np.inf).any(1)
        live, open_ = live[some], open_[some]
        if not len(live):
            return ids
        take = np.argpartition(-open_, expand - 1, 1)[:, :expand] if expand < width else np.broadcast_to(np.arange(width), open_.shape)
        good = np.take_along_axis(open_, take, 1) > -np.inf
        node = np.where(good, np.take_along_axis(ids[live], take, 1), -1)
        flags = done[live]
        np.put_along_axis(flags, take, True, 1)
        step = np.where((node >= 0)[:, :, None], ground[np.maximum(node, 0)], -1).reshape(len(live), -1)
        step.sort(1)
        fresh = step >= 0
        fresh[:, 1:] &= step[:, 1:] != step[:, :-1]
        r, c = np.nonzero(fresh)
        unseen = ~seen[live[r], step[r, c]]
        r, c = r[unseen], c[unseen]
        own = step[r, c]
        seen[live[r], own] = True
        count = np.bincount(r, minlength=len(live))
        wide = int(count.max(initial=0))
        place = np.arange(len(r)) - np.repeat(np.cumsum(count) - count, count)  # new rows side by side
        new, new_ids = np.full((len(live), wide), -np.inf, np.float32), np.full((len(live), wide), -1, np.int64)
        new[r, place], new_ids[r, place] = np.einsum("ij,ij->i", q[live[r]], x[own]), own
        every = np.concatenate((sims[live], new), 1)
        top = np.argpartition(-every, width - 1, 1)[:, :width] if wide else np.broadcast_to(np.arange(width), sims[live].shape)
        sims[live] = np.take_along_axis(every, top, 1)
        ids[live] = np.take_along_axis(np.concatenate((ids[live], new_ids), 1), top, 1)
        done[live] = np.take_along_axis(np.concatenate((flags, new_ids < 0), 1), top, 1)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added up from the first component on."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


def _rows_of(column: pa.ChunkedArray, kind) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


_INDEX = "dim int, shard int, n int, vectors binary, ids array<array<bigint>>, x binary, ground binary, longest binary, nodes array<binary>, links array<binary>"


def _build(table: pa.Table) -> pa.Table:
    table = table.sort_by([("first", "ascending")])
    vectors = _rows_of(table["embedding"], np.float64)
    g = build(vectors)
    row = {"dim": vectors.shape[1], "shard": table["shard"][0].as_py(), "n": len(vectors), "vectors": vectors.tobytes(), "ids": table["ids"].to_pylist(), "x": g["x"].tobytes(), "ground": g["ground"].tobytes(), "longest": g["longest"].tobytes(), "nodes": [a.tobytes() for a, _ in g["layers"]], "links": [b.tobytes() for _, b in g["layers"]]}
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.list_(pa.int64())), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary())]
    return pa.table([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row))


def _pack(table: pa.Table) -> pa.Table:
    vectors = _rows_of(table["embedding"], np.float64)
    ids = table["vec"].to_numpy()
    return pa.table({"dim": pa.array([vectors.shape[1]], pa.int32()), "block": pa.array([table["block"][0].as_py()], pa.int32()), "q_ids": pa.array([ids.tobytes()], pa.binary()), "q_vectors": pa.array([vectors.tobytes()], pa.binary())})


def _search(k: int, breadth: int):
    """Each row holds a shard's graph and a block of queries: the k nearest that the graph finds for each query."""

    def found(row: dict) -> pa.RecordBatch:
        n, dim = row["n"], row["dim"]
        vectors = np.frombuffer(row["vectors"], np.float64).reshape(n, dim)
        layers = [(a := np.frombuffer(p, np.int32), np.frombuffer(r, np.int32).reshape(len(a), -1)) for p, r in zip(row["nodes"], row["links"], strict=True)]
        graph = {"x": np.frombuffer(row["x"], np.float32).reshape(n, dim + 1), "ground": np.frombuffer(row["ground"], np.int32).reshape(n, -1), "longest": np.frombuffer(row["longest"], np.int32), "layers": layers}
        q_ids, q = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["q_vectors"], np.float64).reshape(-1, dim)
        size = np.array([len(x) for x in row["ids"]])
        flat, first = np.array([v for x in row["ids"] for v in x], np.int64), np.cumsum(size) - size
        out = []
        for a in range(0, len(q), STEP):
            i, c = np.nonzero((hit := search(graph, q[a : a + STEP], breadth)) >= 0)
            node = hit[i, c]
            score = exact(q[a + i], vectors[node])
            order = np.lexsort((node, -score, i))  # rows are in order of their smallest ids
            i, node, score = i[order], node[order], score[order]
            ok = np.arange(len(i)) - np.searchsorted(i, i) <= k
            i, node, score = i[ok], node[ok], score[ok]
            many = size[node]  # a class is as many rows as it has ids
            vec = flat[np.repeat(first[node], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
            i, score = np.repeat(i, many), np.repeat(score, many)
            other = vec != q_ids[a + i]
            i, vec, score = i[other], vec[other], score[other]
            order = np.lexsort((vec, -score, i))
            i, vec, score = i[order], vec[order], score[order]
            ok = np.arange(len(i)) - np.searchsorted(i, i) < k
            out.append((q_ids[a + i[ok]], vec[ok], score[ok]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)]
        return pa.record_batch([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield found(batch.slice(i, 1).to_pylist()[0])

    return run


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, breadth: int = BREADTH, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score for each row whose id is divisible by ``every``: the k found nearest.

    Out of play: rows with a null id, and vectors that are null, empty, zero or hold a null or non-finite component. An
    id that comes more than once counts once, with its smallest vector. Vectors meet those of their own length only.
    Equal scores are in order of id, as far as the search finds them: a shard's search holds ``breadth`` different vectors.
    Other columns are ignored. An empty table gives none.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec"), F.col(vector_col).cast("array<double>").alias("embedding")).where("vec is not null and size(embedding) > 0")
    rows = rows.where(F.forall("embedding", lambda v: v.isNotNull() & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0))
    rows = materialize(rows.groupBy("vec").agg(F.min("embedding").alias("embedding")))
    held = F.row_number().over(Window.partitionBy("embedding").orderBy("vec"))
    classes = rows.withColumn("r", held).where(F.col("r") <= k + 1).groupBy("embedding").agg(F.array_sort(F.collect_list("vec")).alias("ids"))
    classes = materialize(classes.select("embedding", "ids", F.size("embedding").alias("dim"), F.element_at("ids", 1).alias("first")))
    asked = rows.where(F.col("vec") % every == 0).withColumn("dim", F.size("embedding"))
    shards = {r["dim"]: -(-r["count"] // SHARD) for r in classes.groupBy("dim").count().collect()}  # a row a length
    if not shards:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    blocks = {r["dim"]: -(-r["count"] // BLOCK) for r in asked.groupBy("dim").count().collect()}
    of = lambda table: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.col("dim")), F.lit(1)) if table else F.lit(1)
    index = classes.withColumn("shard", F.pmod(F.xxhash64("embedding"), of(shards)).cast("int")).groupBy("dim", "shard").applyInArrow(_build, _INDEX)
    index = materialize(index)
    packed = asked.withColumn("block", F.pmod(F.xxhash64("vec"), of(blocks)).cast("int")).groupBy("dim", "block").applyInArrow(_pack, "dim int, block int, q_ids binary, q_vectors binary")
    packed = materialize(packed).withColumn("shard", F.explode(F.sequence(F.lit(0), of(shards) - 1)))
    # A shard's graph is moved once, to the task that searches it for block after block.
    tasks = min(sum(shards.values()), 100_000)
    met = packed.repartition(tasks, "dim", "shard").join(index.repartition(tasks, "dim", "shard").hint("merge"), ["dim", "shard"])
    found = met.drop("block").mapInArrow(_search(k, breadth), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
