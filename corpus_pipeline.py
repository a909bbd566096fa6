"""A corpus pipeline of five stages over ``documents``: toxic texts go, one of each group of near duplicates stays,
repeated passages are cut, sources are mixed to target weights, and texts are split into sampled pieces.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import mixing, segmenting, toxicity
from ledgerloom.llm.neardup import near_duplicates
from ledgerloom.llm.substring import drop_repeats
from ledgerloom.operators.staging import mark, materialize, sweep

#: A text goes from this score on.
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), fold=None)
    return toxicity.score(docs, model, carry=tuple(docs.columns)).where(F.col("score") < TOXIC).select(docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group (smallest id, then digest of the text), once; rows without an id or a text all stay."""
    digest = F.md5(F.col("text").cast("binary"))
    found = near_duplicates(docs.select("doc_id", "text")).where("kept and doc_id is not null and digest is not null")
    kept = found.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    rows = docs.withColumn("_own", digest)
    once = rows.where("doc_id is not null and text is not null").join(kept, (F.col("doc_id") == F.col("_id")) & (F.col("_own") == F.col("_digest")), "left_semi").dropDuplicates(["doc_id", "_own"])
    return once.unionByName(rows.where("doc_id is null or text is null")).select(docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated passages (then joined by single blanks); other texts as they are."""
    out = drop_repeats(docs, carry=("lang", "source"), as_is=True).withColumnRenamed("kept_text", "text")
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.emit(docs)


def sample_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct segmentations of every text, with their inclusion scores."""
    return segmenting.encode(docs, carry=("lang", "source"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("source_mixing", mix_sources),
    ("sampled_pieces", sample_pieces),
]

#: Learned scores, MinHash and sampled segmentations have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written before the next stage reads it. What a stage wrote on its way, and
    the result before, are removed once its own result is written; the last stage's go when Python ends."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    start = mark()
    for _, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        end = mark()
        docs = materialize(out)
        sweep(start, end)
        start = end
    return STAGES[-1][1](spark, docs, sf_dir)
