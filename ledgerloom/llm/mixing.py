"""Mixing sources to target weights, with DataFrame functions only.

Words are counted per source; each source's target is its share by weight, but at most MOST times its size, what is
above being shared among the others by weight. A document is then taken floor(rate) times, plus once more if a hash of
seed and id, read as a number in [0, 1), is below the rate's fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, ordered_prefix, word_count

WEIGHTS, MOST, SEED = (1, 2, 3), 3, 20240
#: Sources, and bytes of their names, up to which the table of targets is broadcast; beyond either, a salted join.
BROADCAST_SOURCES, BROADCAST_BYTES, SALTS = 10_000, 2 << 20, 64


def targets(docs: DataFrame, source_col: str = "source", text_col: str = "text", weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target), a row a source, null last in order of code points.

    Sorted by size over weight, sources stop at ``most`` times their size one after another; what is left for the
    others, shared by weight, grows until the first that needn't stop. That level is the largest of the levels met on
    the way, so two running sums and a maximum give it.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(word_count(F.col(text_col))).alias("source_size"))
    ranked = ordered_prefix(sizes, [F.col("source").asc_nulls_last()], {}, "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long")
    filled = ranked.withColumn("weight", weight).withColumn("filled_at", F.col("source_size") / F.col("weight"))
    run = ordered_prefix(filled, [F.col("filled_at"), F.col("place")], {"size_before": F.col("source_size"), "weight_before": F.col("weight")}, "_place")
    run = materialize(run)
    total = run.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    if total["s"] is None:
        return run.select("source", "source_size", F.lit(0.0).alias("target"))
    left = (F.lit(total["s"]) - most * F.col("size_before")) / (F.lit(total["w"]) - F.col("weight_before"))
    level = run.agg(F.max(left)).first()[0]
    return run.select("source", "source_size", F.least((most * F.col("source_size")).cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from the id; the same in every run. Null ids share one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") / float(2**48)


def _taken(docs: DataFrame, seed: int, id_col: str, source_col: str, text_col: str, weights: tuple[int, ...], most: int, keep: tuple[str, ...]) -> DataFrame:
    """_id, _size, _source_size, _target, _copies and _k0, _k1, ... for the columns in ``keep``."""
    goals = materialize(targets(docs, source_col, text_col, weights, most)).toDF("_source", "_source_size", "_target")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_from"), word_count(F.col(text_col)).alias("_size"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    extent = goals.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("_source")), F.lit(0)).alias("bytes")).first()
    if extent["n"] <= BROADCAST_SOURCES and extent["bytes"] <= BROADCAST_BYTES:
        met = rows.join(F.broadcast(goals), F.col("_from").eqNullSafe(F.col("_source")))
    else:
        salted = goals.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = rows.withColumn("_own", F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(SALTS)).cast("int"))
        met = met.join(salted, F.col("_from").eqNullSafe(F.col("_source")) & (F.col("_own") == F.col("_salt")))
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0)
    copies = F.floor(rate).cast("long") + (draw(F.col("_id"), seed) < rate - F.floor(rate)).cast("long")
    return met.withColumn("_copies", copies)


def mix(docs: DataFrame, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Each document's id, size in words, its source's source_size and target, and how often it is taken (copies).

    A null source is a source; null and empty texts have size 0 and are taken as often as the rate says; a source without
    words has target 0 and none of its rows is taken. Repeated rows of one id share their draw. An empty table gives an
    empty table. Other columns are ignored, whatever their names.
    """
    out = _taken(docs, seed, id_col, source_col, text_col, weights, most, ())
    return out.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_copies").alias("copies"))


def emit(docs: DataFrame, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents as the mix has them: each row as many times as it is taken, with its own columns."""
    out = _taken(docs, seed, id_col, source_col, text_col, weights, most, tuple(docs.columns)).where("_copies > 0")
    out = out.select(*[F.col(f"_k{i}") for i in range(len(docs.columns))], F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_nth"))
    return out.drop("_nth").toDF(*docs.columns)
