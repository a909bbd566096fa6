"""Weekly cash features, targets, models and checkpoints."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.config import LEGS
from ledgerloom.functions import boosting
from ledgerloom.operators.relational import asof_forward, money, top_rows, tuesday

KEYS = ["entity_id", "entity_name", "sector"]
FEATURES = [
    *[f"{c}_lag{k}" for c in ("collections", "supplier_payments") for k in (1, 2, 3, 4)],
    "collections_roll4_mean", "supplier_payments_roll4_mean", "net_cash_roll4_mean", "net_cash_roll4_std", "week_of_month", "month",
    "has_tax_this_week", "has_payroll_this_week", "days_to_next_tf_maturity", "next_tf_maturity_value", "tf_maturity_within_30d", "xborder_volume",
]

FORECASTS = ["forecast_next_collections", "forecast_next_payments", "forecast_net_cash"]
#: Bound of the sample that trees are fitted on; every row is scored.
TRAIN_ROWS = 200_000


def weekly_pivot(payments: DataFrame) -> DataFrame:
    """Sum of each leg per client and week; only weeks with payments; weeks start on Tuesday."""
    rows = payments.where("entity_id is not null").withColumn("week", tuesday(F.col("date")))
    wide = rows.groupBy(*KEYS, "week").pivot("leg_type", list(LEGS)).agg(money("amount_zar"))
    wide = wide.fillna(0.0, list(LEGS))
    return wide.withColumn("net_cash", F.col("collections") - F.col("supplier_payments"))


def with_windows(weekly: DataFrame) -> DataFrame:
    """Lags by row, means and sample deviation of the four rows before (null with fewer), and next week's targets."""
    w = Window.partitionBy("entity_id").orderBy("week")
    four = w.rowsBetween(-4, -1)
    full = F.count(F.lit(1)).over(four) == 4
    out = weekly.select("*", *[F.lag(c, k).over(w).alias(f"{c}_lag{k}") for c in ("collections", "supplier_payments") for k in (1, 2, 3, 4)], *[F.when(full, F.avg(c).over(four)).alias(f"{c}_roll4_mean") for c in ("collections", "supplier_payments", "net_cash")], F.when(full, F.stddev_samp("net_cash").over(four)).alias("net_cash_roll4_std"), F.lead("collections", 1).over(w).alias("target_next_collections"), F.lead("supplier_payments", 1).over(w).alias("target_next_payments"))
    return out.withColumns({"week_of_month": F.floor((F.dayofmonth("week") - 1) / 7).cast("int") + 1, "month": F.month("week"), "has_tax_this_week": (F.col("tax") > 0).cast("int"), "has_payroll_this_week": (F.col("payroll") > 0).cast("int")})


def maturities(trade: DataFrame) -> DataFrame:
    return trade.where("entity_id is not null and tenor_days is not null and date is not null").select("entity_id", F.expr("date_add(date, tenor_days)").alias("maturity_date"), "value_zar")


def weekly_maturity(weekly: DataFrame, trade: DataFrame) -> DataFrame:
    """Days to, and value of, the next maturity at or after each week's start."""
    out = asof_forward(weekly, maturities(trade), "entity_id", "week", "maturity_date", "value_zar")
    days = F.datediff("next_date", "week")
    return out.withColumn("days_to_next_tf_maturity", days).withColumn("next_tf_maturity_value", F.coalesce("next_value", F.lit(0.0))).withColumn("tf_maturity_within_30d", F.coalesce((days <= 30).cast("int"), F.lit(0))).drop("next_date", "next_value")


def weekly_crossborder(crossborder: DataFrame) -> DataFrame:
    return crossborder.where("entity_id is not null").groupBy("entity_id", tuesday(F.col("date")).alias("week")).agg(money("value_zar").alias("xborder_volume"))


def weekly_features(payments: DataFrame, trade: DataFrame, crossborder: DataFrame, as_of: str | None = None) -> DataFrame:
    """All features; rows without four earlier weeks go. ``as_of`` hides later rows of all three books."""
    if as_of:
        payments, trade, crossborder = (x.where(F.col("date") <= F.to_date(F.lit(as_of))) for x in (payments, trade, crossborder))
    rows = weekly_maturity(with_windows(weekly_pivot(payments)), trade)
    rows = rows.join(weekly_crossborder(crossborder), ["entity_id", "week"], "left").withColumn("xborder_volume", F.coalesce("xborder_volume", F.lit(0.0)))
    return rows.na.drop(subset=["collections_lag4", "supplier_payments_lag4"])


def engagement_label(features: DataFrame, net_forecast: str = "net_cash") -> DataFrame:
    label = (F.col(net_forecast) > F.greatest(F.col("net_cash_roll4_mean"), F.lit(0.0))) | (F.col("tf_maturity_within_30d") == 1)
    return features.withColumn("label", F.coalesce(label, F.lit(False)).cast("int"))


def stale_entities(features: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """Clients without a checkpoint or with a week after it."""
    latest = features.groupBy("entity_id").agg(F.max("week").alias("latest"))
    return latest.join(checkpoint, "entity_id", "left").where(F.coalesce(F.col("latest") > F.col("last_seen"), F.lit(True))).select("entity_id", "latest", "last_seen")


def latest_week(features: DataFrame) -> DataFrame:
    return top_rows(features, ["entity_id"], [F.col("week").desc()])


def _sample(df: DataFrame, columns: list[str], rows: int) -> np.ndarray:
    """(rows, columns) of numbers: the ``rows`` rows of the smallest hashes of client and week, in order of those."""
    order = [F.xxhash64("entity_id", "week"), F.col("entity_id"), F.col("week")]
    picked = df.orderBy(*order).limit(rows).select(*[F.col(c).cast("double").alias(c) for c in columns])
    return picked.toPandas().to_numpy(np.float64).reshape(-1, len(columns))


def _scorer(model: boosting.Trees):
    @F.pandas_udf("double")
    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for x in parts:
            yield pd.Series(model.predict(x.to_numpy(np.float64)))

    return score


def fit_forecaster(features: DataFrame, target: str, trees: int = 300, depth: int = 4, rate: float = 0.05, seed: int = 42, rows: int = TRAIN_ROWS, start: boosting.Trees | None = None) -> boosting.Trees:
    """Boosted regression trees on the features of at most ``rows`` rows whose next week is known; ``start``: go on from there."""
    known = features.where("target_next_collections is not null and target_next_payments is not null")
    x = _sample(known, [*FEATURES, target], rows)
    return boosting.fit(x[:, :-1], x[:, -1], trees, depth, rate, seed=seed, start=start)


def with_forecasts(features: DataFrame, inflow: boosting.Trees, outflow: boosting.Trees) -> DataFrame:
    """Both forecasts of next week, and the net of the two, beside each row's features."""
    x = F.struct(*[F.col(c).cast("double").alias(c) for c in FEATURES])
    rows = features.withColumns({"forecast_next_collections": _scorer(inflow)(x), "forecast_next_payments": _scorer(outflow)(x)})
    return rows.withColumn("forecast_net_cash", F.col("forecast_next_collections") - F.col("forecast_next_payments"))


def fit_engagement(forecasts: DataFrame, trees: int = 250, depth: int = 3, rate: float = 0.07, seed: int = 42, rows: int = TRAIN_ROWS, start: boosting.Trees | None = None) -> tuple[boosting.Trees, float]:
    """Boosted classification trees on features and forecasts, the label taking the forecast net cash; and the AUC over the
    rows learned from."""
    x = _sample(engagement_label(forecasts, "forecast_net_cash"), [*FEATURES, *FORECASTS, "label"], rows)
    model = boosting.fit(x[:, :-1], x[:, -1], trees, depth, rate, True, seed=seed, start=start)
    return model, boosting.auc(x[:, -1], model.predict(x[:, :-1]))


def errors(forecasts: DataFrame) -> DataFrame:
    """Mean absolute errors of both forecasts over all rows whose next week is known, and the labels' positive rate: one row."""
    known = F.col("target_next_collections").isNotNull() & F.col("target_next_payments").isNotNull()
    off = lambda a, b: F.avg(F.when(known, F.abs(F.col(a) - F.col(b))))
    rows = engagement_label(forecasts, "forecast_net_cash")
    return rows.agg(off("target_next_collections", "forecast_next_collections").alias("train_mae_inflow_zar"), off("target_next_payments", "forecast_next_payments").alias("train_mae_outflow_zar"), F.avg("label").alias("positive_rate"))


class Models(NamedTuple):
    inflow: boosting.Trees
    outflow: boosting.Trees
    timing: boosting.Trees


def train(history: DataFrame, start: Models | None = None, trees: int = 300, timing_trees: int = 250, rows: int = TRAIN_ROWS) -> tuple[Models, dict[str, float | None]]:
    """All three models and their training figures: errors and positive rate over the whole history, AUC over the sample."""
    inflow = fit_forecaster(history, "target_next_collections", trees, rows=rows, start=start and start.inflow)
    outflow = fit_forecaster(history, "target_next_payments", trees, rows=rows, start=start and start.outflow)
    told = with_forecasts(history, inflow, outflow)
    timing, train_auc = fit_engagement(told, timing_trees, rows=rows, start=start and start.timing)
    return Models(inflow, outflow, timing), {**errors(told).first().asDict(), "train_auc": train_auc}


def score(latest: DataFrame, models: Models) -> DataFrame:
    """Both forecasts and a score of when to call, engaged from one half on."""
    x = F.struct(*[F.col(c).cast("double").alias(c) for c in (*FEATURES, *FORECASTS)])
    rows = with_forecasts(latest, models.inflow, models.outflow).withColumn("engagement_score", _scorer(models.timing)(x))
    return rows.select("entity_id", "entity_name", "week", *FORECASTS, "engagement_score", (F.col("engagement_score") >= 0.5).cast("int").alias("engage_next_week"))


def forecast(features: DataFrame, trees: int = 300, timing_trees: int = 250) -> DataFrame:
    """The latest week of each client, scored by models that learn from all clients."""
    held = features.persist()
    models, _ = train(held, None, trees, timing_trees)
    return score(latest_week(held), models)


def stale_history(features: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """All weeks of the clients that have any after their checkpoint."""
    return features.join(stale_entities(features, checkpoint).select("entity_id"), "entity_id", "left_semi")


def advanced(features: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """The checkpoint after a run: the latest week of each stale client, what it was of the others."""
    new = stale_entities(features, checkpoint).select("entity_id", F.col("latest").alias("last_seen"))
    return checkpoint.unionByName(new).groupBy("entity_id").agg(F.max("last_seen").alias("last_seen"))


def load_models(spark: SparkSession, folder: str) -> Models | None:
    """The models of the latest run that wrote any into ``folder``."""
    rows = _read(spark, f"{folder}/models", "run timestamp, name string, body string")
    latest = rows.groupBy("name").agg(F.max_by("body", "run").alias("body")).collect()  # a row a model
    found = {r["name"]: boosting.Trees.from_json(r["body"]) for r in latest}
    return Models(**found) if found else None


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def run(features: DataFrame, folder: str, trees: int = 300, timing_trees: int = 250, rows: int = TRAIN_ROWS) -> tuple[DataFrame, dict[str, float | None] | None]:
    """One run of the cycle: (scores of every client's latest week, training figures or None).

    Clients with weeks after their checkpoint are learned from, with their whole history, going on from the models of the
    last run; then the models and those clients' checkpoints are appended under ``folder`` (models first: a run that ends
    in between is repeated). Without such clients the last models are used.
    """
    spark, held = features.sparkSession, features.persist()
    checkpoint = _read(spark, f"{folder}/checkpoint", "entity_id string, last_seen date").groupBy("entity_id").agg(F.max("last_seen").alias("last_seen"))
    models, figures = load_models(spark, folder), None
    stale = stale_entities(held, checkpoint).persist()
    if models is None or not stale.isEmpty():
        models, figures = train(stale_history(held, checkpoint), models, trees, timing_trees, rows)
        bodies = spark.createDataFrame([(k, v.to_json()) for k, v in models._asdict().items()], "name string, body string")
        bodies.select(F.current_timestamp().alias("run"), "name", "body").coalesce(1).write.mode("append").parquet(f"{folder}/models")
        stale.select("entity_id", F.col("latest").alias("last_seen")).write.mode("append").parquet(f"{folder}/checkpoint")
    stale.unpersist()
    return score(latest_week(held), models), figures


def leaderboard(scores: DataFrame, n: int = 15) -> DataFrame:
    return scores.orderBy(F.col("engagement_score").desc(), "entity_id").limit(n)


def leaderboard_lines(scores: DataFrame, n: int = 15, width: int = 30) -> DataFrame:
    """(place, line): the leaderboard as text of fixed width."""
    top = leaderboard(scores, n).withColumn("place", F.row_number().over(Window.orderBy(F.col("engagement_score").desc(), "entity_id")))  # n rows
    net = F.concat(F.lit("R"), F.format_number(F.bround("forecast_net_cash"), 0))
    line = F.concat(F.rpad(F.col("place").cast("string"), 3, " "), F.rpad("entity_name", width, " "), F.lpad(net, 26, " "), F.lpad(F.format_number("engagement_score", 2), 19, " "), F.lpad(F.when(F.col("engage_next_week") == 1, "Yes").otherwise("No"), 10, " "))
    return top.select("place", line.alias("line"))


def find_client(clients: DataFrame, asked: str) -> DataFrame:
    """One row: asked, entity_id (that of the id, in any case, else of the only name that holds the words asked for, else null)
    and matches (names that hold them)."""
    q = asked.strip().lower()
    by_id = F.max(F.when(F.lower("entity_id") == q, F.col("entity_id")))
    named = F.lower("entity_name").contains(q) & F.lit(bool(q))
    matches = F.count_distinct(F.when(named, F.col("entity_id")))
    only = F.when(matches == 1, F.max(F.when(named, F.col("entity_id"))))
    return clients.agg(F.lit(asked).alias("asked"), F.coalesce(by_id, only).alias("entity_id"), matches.alias("matches"))
