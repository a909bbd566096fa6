"""Operators that the DataFrame API lacks or that need a fixed tie rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.rules import significant_words


def money(c: str | Column) -> Column:
    """Sum of a money column that doesn't depend on the order of rows: exact to four decimals, returned as double."""
    return F.sum((F.col(c) if isinstance(c, str) else c).cast("decimal(20,4)")).cast("double")


def tuesday(date: Column) -> Column:
    """Start of the week that ends on Monday."""
    return F.date_sub(date, (F.dayofweek(date) + 4) % 7)


def top_rows(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group in an explicit order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def asof_forward(left: DataFrame, right: DataFrame, key: str, left_date: str, right_date: str, value: str) -> DataFrame:
    """Each left row with the nearest right row at or after its date (``next_date``, ``next_value``; smallest value of
    equal dates). One shuffle by key: both sides in one descending frame, so that the running last value is the next."""
    smallest = right.groupBy(key, right_date).agg(F.min(value).alias(value))
    a = left.withColumn("_d", F.col(left_date)).withColumn("_k", F.lit(0))
    b = smallest.select(key, F.col(right_date).alias("_d"), F.lit(1).alias("_k"), F.col(value).alias("_v"))
    both = a.unionByName(b, allowMissingColumns=True)
    back = Window.partitionBy(key).orderBy(F.col("_d").desc(), F.col("_k").desc()).rowsBetween(Window.unboundedPreceding, 0)
    near = F.last(F.when(F.col("_k") == 1, F.struct("_d", "_v")), ignorenulls=True).over(back)
    out = both.withColumn("_n", near).where("_k = 0")
    return out.select(*left.columns, F.col("_n._d").alias("next_date"), F.col("_n._v").alias("next_value"))


def match_names(variants: DataFrame, master: DataFrame) -> DataFrame:
    """entity_variant -> entity_id: all significant words of the master's name are in the variant's; most words win, then
    the smaller id. Joined on each master's first word instead of on every pair."""
    m = master.select("entity_id", significant_words(F.col("entity_name")).alias("need")).where("size(need) > 0").withColumn("w", F.element_at(F.array_sort("need"), 1))
    v = variants.select("entity_variant").distinct().withColumn("have", significant_words(F.col("entity_variant")))
    pairs = v.select("entity_variant", "have", F.explode("have").alias("w")).join(m, "w").where(F.size(F.array_except("need", "have")) == 0)
    best = top_rows(pairs, ["entity_variant"], [F.size("need").desc(), F.col("entity_id")]).select("entity_variant", "entity_id")
    return v.select("entity_variant").join(best, "entity_variant", "left")


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Deduplication that keeps the first row in a given order."""
    return top_rows(df, keys, order, 1)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], stamp: str) -> DataFrame:
    """Union of both, the latest row of each key."""
    return top_rows(old.unionByName(new), keys, [F.col(stamp).desc_nulls_last()], 1)


def append_new(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose keys ``old`` lacks."""
    return new.join(old.select(*keys), keys, "left_anti")


def coverage_gaps(have: DataFrame, keys: list[str], kinds: list[str], years: list[int]) -> DataFrame:
    """Expected (key, kind, year) that are missing; the expected sets are short lists."""
    want = have.select(*keys).distinct().withColumn("doc_type", F.explode(F.array(*[F.lit(k) for k in kinds]))).withColumn("year", F.explode(F.array(*[F.lit(y) for y in years])))
    return want.join(have, [*keys, "doc_type", "year"], "left_anti")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(column, n) of the values that aren't null, most frequent first."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), column)


def pivot_unique(df: DataFrame, index: str, column: str, value: str, names: list[str]) -> DataFrame:
    """A column for each of ``names``; raises if a cell has more than one row."""
    cells = df.groupBy(index, column).agg(F.count(F.lit(1)).alias("_n"), F.first(value).alias("_v"))
    twice = cells.where("_n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"more than one row for {twice[0][index]}, {twice[0][column]}")
    return cells.groupBy(index).pivot(column, names).agg(F.first("_v"))


def latest(df: DataFrame, keys: list[str], year: str, n: int, ties: list[str]) -> DataFrame:
    """The ``n`` rows of the latest years of each group; unknown years come last."""
    return top_rows(df, keys, [F.coalesce(F.col(year), F.lit(0)).desc(), *[F.col(c) for c in ties]], n)
