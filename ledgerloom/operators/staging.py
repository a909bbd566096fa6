"""Intermediate results in the folder that driver and executors share, and global ranks that need them."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir. Where it names none, a temporary one, but only if driver and
    executors are one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='checkpoints-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str = "ledgerloom") -> str:
    """A new path in the shared folder, removed by ``sweep`` or when Python ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and a lost executor loses nothing."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark() -> int:
    """A point in the list of written paths."""
    return len(_written)


def sweep(since: int = 0, until: int | None = None) -> None:
    """Remove the paths written between two marks; nothing that still reads them may be evaluated afterwards."""
    paths = _written[since:until]
    _written[since:until] = [(spark, "") for spark, _ in paths]  # marks stay valid
    for spark, path in paths:
        if path and spark.sparkContext._jsc is not None:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _at_end() -> None:
    try:
        sweep()
    except Exception:  # noqa: BLE001 - the JVM may have gone first
        pass


def ordered_prefix(df: DataFrame, order: list[Column], sums: dict[str, Column], rank: str, parts: int = 32) -> DataFrame:
    """Global rank (from 1) and running sums *before* each row, without a single-task sort.

    Rows are range-partitioned and written once, so that the bounds stay as they are; each partition numbers its own
    rows; the offsets of earlier partitions (one row per partition) are added by a join on the partition number.
    """
    placed = materialize(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    own = Window.partitionBy("_part").orderBy(*order)
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn(rank, F.row_number().over(own).cast("long"))
    for name, c in sums.items():
        local = local.withColumn(name, F.coalesce(F.sum(c).over(before), F.lit(0)))
    totals = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_o_{c}") for c in ["_rows", *[f"_t_{n}" for n in sums]]])
    out = local.join(F.broadcast(offsets), "_part")  # at most `parts` rows
    out = out.withColumn(rank, F.col(rank) + F.col("_o__rows"))
    for name in sums:
        out = out.withColumn(name, F.col(name) + F.col(f"_o__t_{name}"))
    return out.drop("_part", *[c for c in offsets.columns if c != "_part"])
