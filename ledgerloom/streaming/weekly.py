"""The weekly bucket over a stream of payments: weeks start on Tuesday, late rows count until the watermark passes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def weekly_sums(payments: DataFrame, late: str = "14 days") -> DataFrame:
    """(entity_id, week, amount) of a streaming or batch frame with entity_id, ts and amount."""
    week = F.window("ts", "7 days", "7 days", "5 days")
    rows = payments.where("entity_id is not null").withWatermark("ts", late).groupBy("entity_id", week.alias("w")).agg(F.sum("amount").alias("amount"))
    return rows.select("entity_id", F.to_date("w.start").alias("week"), "amount")
