"""Distribution checks per client and book, and the dashboard's pivots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def positive(ledger: DataFrame, column: str = "value_zar") -> DataFrame:
    """Rows whose value is a number above 0; text that is no number counts as none."""
    value = F.col(column) if dict(ledger.dtypes)[column] == "double" else F.col(column).try_cast("double")
    return ledger.withColumn(column, value).where(F.col(column) > 0)


def skew(ledger: DataFrame) -> DataFrame:
    """Biased skewness of positive values per client and source with more than two rows."""
    x = positive(ledger).groupBy("entity_id", "source_file").agg(F.count(F.lit(1)).alias("n"), F.skewness("value_zar").alias("skew"))
    return x.where("n > 2")


def skew_shares(skews: DataFrame) -> DataFrame:
    return skews.groupBy("source_file").agg(F.count(F.lit(1)).alias("clients"), F.sum((F.col("skew") > 0).cast("int")).alias("right_skewed"), F.sum((F.col("skew") < 0).cast("int")).alias("left_skewed"), (100 * F.avg((F.col("skew") > 0).cast("int"))).alias("right_pct"))


def lognormal_fit(ledger: DataFrame) -> DataFrame:
    """Maximum likelihood with location 0: deviation and exponential of the mean of logs."""
    ln = F.log("value_zar")
    return ledger.where("value_zar > 0").groupBy("source_file").agg(F.stddev_pop(ln).alias("shape"), F.exp(F.avg(ln)).alias("scale"), F.avg(ln).alias("mean_ln"))


def density(ledger: DataFrame, bins: int = 60) -> DataFrame:
    """Histogram as density per source, bounds from the smallest to the largest value."""
    rows = ledger.where("value_zar > 0")
    ends = rows.groupBy("source_file").agg(F.min("value_zar").alias("lo"), F.max("value_zar").alias("hi"), F.count(F.lit(1)).alias("total")).where("hi > lo")
    width = (F.col("hi") - F.col("lo")) / bins
    bin_ = F.least(F.floor((F.col("value_zar") - F.col("lo")) / width).cast("int"), F.lit(bins - 1))
    return rows.join(ends, "source_file").groupBy("source_file", bin_.alias("bin")).agg((F.count(F.lit(1)) / (F.first("total") * F.first(width))).alias("density"))


def percentile(ledger: DataFrame, p: float = 0.995, accuracy: int = 10_000) -> DataFrame:
    """Exact interpolated percentile of positive values by source.

    An approximate pass gives bounds that the wanted ranks surely lie between; only the values between them (about
    4 / ``accuracy`` of all, or all if there are at most 4 * ``accuracy``) are sorted and numbered, and the number of values
    below is added.
    """
    rows = ledger.where("value_zar > 0").select("source_file", "value_zar")
    ends = [max(0.0, p - 2 / accuracy), min(1.0, p + 2 / accuracy)]
    bounds = rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("value_zar", ends, accuracy).alias("q"), F.min("value_zar").alias("least"), F.max("value_zar").alias("most"))
    few = F.col("n") <= 4 * accuracy
    low = F.col("least") if ends[0] == 0 else F.when(few, F.col("least")).otherwise(F.col("q")[0])
    high = F.col("most") if ends[1] == 1 else F.when(few, F.col("most")).otherwise(F.col("q")[1])
    met = rows.join(bounds.select("source_file", "n", low.alias("low"), high.alias("high")), "source_file").where("value_zar <= high")
    below = met.where("value_zar < low").groupBy("source_file").agg(F.count(F.lit(1)).alias("below"))
    near = met.where("value_zar >= low").withColumn("at", F.row_number().over(Window.partitionBy("source_file").orderBy("value_zar")) - 1)
    near = near.join(below, "source_file", "left").withColumn("at", F.col("at") + F.coalesce("below", F.lit(0))).withColumn("rank", p * (F.col("n") - 1))
    wanted = near.where((F.col("at") == F.floor("rank")) | (F.col("at") == F.ceil("rank")))
    share = F.max(F.col("rank") - F.floor("rank"))
    return wanted.groupBy("source_file").agg((F.min("value_zar") + share * (F.max("value_zar") - F.min("value_zar"))).alias("p"))


def profile(books: dict[str, DataFrame]) -> DataFrame:
    """(source_file, clients, names, first_date, last_date, n) of each book."""
    parts = [df.agg(F.lit(name).alias("source_file"), F.count_distinct("entity_id").alias("clients"), F.count_distinct("entity_name").alias("names"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count(F.lit(1)).alias("n")) for name, df in books.items()]
    return reduce(DataFrame.unionByName, parts)


def heatmap(ledger: DataFrame, pillars: list[str]) -> DataFrame:
    """Mean value by sector and pillar, 0 where there is none."""
    return ledger.groupBy("sector").pivot("pillar", pillars).agg(F.avg("value_zar")).fillna(0.0)
