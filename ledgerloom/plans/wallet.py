"""Wallet sizing: ledgers to priors, filings to signals, the conjugate update, and the portfolio."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerloom.config import CONFIG, WalletConfig
from ledgerloom.functions.rules import classify_line_item
from ledgerloom.operators.relational import match_names, money
from ledgerloom.operators.staging import ordered_prefix


def tidy_ledger(books: dict[str, DataFrame], cfg: WalletConfig = CONFIG) -> DataFrame:
    """Union of the books: the first ``*_zar`` column as a positive value, with pillar and source. Null keys and values go."""
    parts = []
    for name, df in books.items():
        value = next((c for c in df.columns if c.lower().endswith("_zar")), None)
        if value is None:
            raise ValueError(f"{name}: no column ends in _zar")
        parts.append(df.select("entity_id", "entity_name", "sector", F.lit(cfg.book_pillar[name]).alias("pillar"), F.lit(name).alias("source_file"), "date", F.abs(F.col(value)).alias("value_zar")))
    if not parts:
        raise ValueError("no ledger")
    return reduce(DataFrame.unionByName, parts).where("entity_id is not null and value_zar is not null")


def facts(ledger: DataFrame, cfg: WalletConfig = CONFIG) -> DataFrame:
    """One pass over the ledger: rows, sum, moments of the logs and first and last date of each client and pillar. Master, months
    and prior are made of these few rows; keep them (``persist``) where several are wanted."""
    y = F.log(F.greatest(F.col("value_zar"), F.lit(cfg.floor)))
    return ledger.groupBy("entity_id", "entity_name", "sector", "pillar").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value_zar").cast("decimal(20,4)")).alias("total"), F.sum(y).alias("sum_ln"), F.sum(y * y).alias("sum_ln2"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    )


def entity_master(ledger: DataFrame) -> DataFrame:
    """The distinct clients of a ledger or of its facts."""
    return ledger.select("entity_id", "entity_name", "sector").distinct()


def client_names(books: dict[str, DataFrame]) -> DataFrame:
    """The distinct names in all books, sorted, without nulls."""
    return reduce(DataFrame.union, [b.select("entity_name") for b in books.values()]).where("entity_name is not null").distinct().orderBy("entity_name")


def observed_months(known: DataFrame) -> DataFrame:
    """Months between a client's first and last row, 1 at least, from the facts."""
    return known.groupBy("entity_id").agg(F.greatest(F.lit(1), F.bround(F.datediff(F.max("last_date"), F.min("first_date")) / F.lit(30.44)).cast("int")).alias("months"))


def internal_prior(known: DataFrame, cfg: WalletConfig = CONFIG) -> DataFrame:
    """Prior of every client and pillar from the facts, with the defaults for none and for one row."""
    stats = known.groupBy("entity_id", "pillar").agg(F.sum("n").alias("n"), F.sum("total").cast("double").alias("total"), F.sum("sum_ln").alias("s1"), F.sum("sum_ln2").alias("s2"))
    spread = F.greatest(F.col("s2") - F.col("s1") * F.col("s1") / F.col("n"), F.lit(0.0)) / (F.col("n") - 1)
    stats = stats.withColumns({"mean_ln": F.col("s1") / F.col("n"), "var_ln": F.when(F.col("n") > 1, spread)})
    grid = known.select("entity_id").distinct().withColumn("pillar", F.explode(F.array(*[F.lit(p) for p in cfg.pillars])))
    n = F.coalesce("n", F.lit(0))
    a0_none = max(cfg.k0_no_data / 2, cfg.a0_min)
    captured = F.when(n == 0, cfg.floor).otherwise(F.greatest("total", F.lit(cfg.floor)))
    a0 = F.when(n == 0, a0_none).when(n == 1, cfg.a0_min).otherwise(F.greatest((n - 1) / 2, F.lit(cfg.a0_min)))
    b0 = F.when(n == 0, a0_none * cfg.default_log_var).when(n == 1, cfg.a0_min * cfg.default_log_var).otherwise(F.greatest((n - 1) * F.col("var_ln") / 2, a0 * 1e-6))
    m0 = F.when(n == 0, float(np.log(cfg.floor))).otherwise(F.col("mean_ln"))
    return grid.join(stats, ["entity_id", "pillar"], "left").select("entity_id", "pillar", n.cast("long").alias("n"), captured.alias("captured"), m0.alias("m0"), F.when(n == 0, cfg.k0_no_data).otherwise(n.cast("double")).alias("k0"), a0.cast("double").alias("a0"), b0.alias("b0"))


def signal_log(external: DataFrame, master: DataFrame, months: DataFrame, cfg: WalletConfig = CONFIG) -> DataFrame:
    """Line items of each entity's latest year that aren't restated, classified (``note``: by which rule), as logs of scaled volume."""
    known = external.where("not coalesce(restated, false)").join(match_names(external, master), "entity_variant").where("entity_id is not null")
    latest = known.groupBy("entity_id").agg(F.max("year").alias("year"))
    rows = known.join(latest, ["entity_id", "year"]).withColumn("c", classify_line_item(F.col("line_item"))).join(months, "entity_id", "left")
    volume = F.log(F.abs("value_zar") * F.col("c.multiplier")) + F.log(F.coalesce("months", F.lit(cfg.default_observed_months)) / F.lit(cfg.reporting_months))
    signal = F.when(F.col("c.pillar").isin(*cfg.pillars) & (F.col("value_zar") != 0), volume)
    return rows.select("entity_id", "entity_variant", "line_item", "year", F.col("c.pillar").alias("pillar"), F.col("c.multiplier").alias("ci_multiplier"), F.col("c.note").alias("note"), F.col("value_zar").alias("raw_value_zar"), signal.alias("x_i"))


def ceilings(log: DataFrame) -> DataFrame:
    items = log.where("pillar = 'ceiling_only'").groupBy("entity_id", "line_item").agg(F.max(F.abs("raw_value_zar")).alias("v"))
    return items.groupBy("entity_id").agg(F.sum("v").alias("ceiling_zar"))


def posterior(prior: DataFrame, log: DataFrame, cfg: WalletConfig = CONFIG) -> DataFrame:
    """Normal-inverse-gamma update; correlated signals count as fewer."""
    signals = log.where("x_i is not null").groupBy("entity_id", "pillar").agg(F.count(F.lit(1)).alias("n_signals"), F.avg("x_i").alias("x_bar"), (F.var_pop("x_i") * F.count(F.lit(1))).alias("ss"))
    rows = prior.join(signals, ["entity_id", "pillar"], "left").withColumn("n_signals", F.coalesce("n_signals", F.lit(0)).cast("long"))
    rows = rows.withColumn("n_eff", F.col("n_signals") / (1 + (F.col("n_signals") - 1) * cfg.rho))
    some = F.col("n_signals") > 0
    k = F.when(some, F.col("k0") + F.col("n_eff")).otherwise(F.col("k0"))
    rows = rows.withColumn("k_n", k).withColumn("m_n", F.when(some, (F.col("k0") * F.col("m0") + F.col("n_eff") * F.col("x_bar")) / F.col("k_n")).otherwise(F.col("m0")))
    rows = rows.withColumn("a_n", F.when(some, F.col("a0") + F.col("n_eff") / 2).otherwise(F.col("a0")))
    b = F.col("b0") + F.col("ss") / 2 + F.col("k0") * F.col("n_eff") * F.pow(F.col("x_bar") - F.col("m0"), 2) / (2 * F.col("k_n"))
    return rows.withColumn("b_n", F.when(some, b).otherwise(F.col("b0"))).select("entity_id", "pillar", "captured", "n_signals", "m_n", "k_n", "a_n", "b_n")


def student_t(p: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Quantile of Student's t for p < 1/2 and any df > 0, by bisection on the regularised incomplete beta function."""
    from math import lgamma

    def beta(a: np.ndarray, b: float, x: np.ndarray) -> np.ndarray:
        swap = x > (a + 1) / (a + b + 2)
        aa, bb, xx = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
        front = np.exp(np.array([lgamma(u + b) - lgamma(u) - lgamma(b) for u in a]) + aa * np.log(np.maximum(xx, 1e-300)) + bb * np.log1p(-np.minimum(xx, 1 - 1e-16))) / aa
        tiny = 1e-300
        c, d = np.ones_like(x), 1 / np.where(np.abs(1 - (aa + bb) * xx / (aa + 1)) < tiny, tiny, 1 - (aa + bb) * xx / (aa + 1))
        h = d.copy()
        for m in range(1, 300):
            for num in (m * (bb - m) * xx / ((aa + 2 * m - 1) * (aa + 2 * m)), -(aa + m) * (aa + bb + m) * xx / ((aa + 2 * m) * (aa + 2 * m + 1))):
                d = 1 / np.where(np.abs(1 + num * d) < tiny, tiny, 1 + num * d)
                c = np.where(np.abs(1 + num / c) < tiny, tiny, 1 + num / c)
                h = h * c * d
        return np.where(swap, 1 - front * h, front * h)

    lo, hi = np.zeros_like(df), np.full_like(df, 1e3)
    for _ in range(60):
        mid = (lo + hi) / 2
        tail = beta(df / 2, 0.5, df / (df + mid * mid)) / 2
        lo, hi = np.where(tail > p, mid, lo), np.where(tail > p, hi, mid)
    return -(lo + hi) / 2


@F.pandas_udf(DoubleType())
def t_ppf(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for p, df in parts:
        yield pd.Series(student_t(p.to_numpy(float), df.to_numpy(float)))


def _at_least(c: Column, low) -> Column:
    return F.greatest(c, low if isinstance(low, Column) else F.lit(low))


def _at_most(c: Column, high: Column) -> Column:
    return F.when(high > 0, F.least(c, high)).otherwise(c)


def pillar_detail(post: DataFrame, ceiling: DataFrame, cfg: WalletConfig = CONFIG) -> DataFrame:
    """Median and interval of each pillar, clamped to the floor and the client's ceiling, and the gap to what is captured."""
    rows = post.join(ceiling, "entity_id", "left").withColumn("s", F.sqrt(F.greatest(F.col("b_n") * (F.col("k_n") + 1) / (F.col("a_n") * F.col("k_n")), F.lit(1e-12))))
    rows = rows.withColumn("t", t_ppf(F.lit(cfg.alpha / 2), 2 * F.col("a_n")))
    top = F.col("ceiling_zar")
    rows = rows.withColumn("lo", _at_least(F.exp(F.col("m_n") + F.col("t") * F.col("s")), cfg.floor)).withColumn("median", _at_least(F.exp("m_n"), cfg.floor)).withColumn("hi", F.exp(F.col("m_n") - F.col("t") * F.col("s")))
    rows = rows.withColumn("hi", _at_most(F.col("hi"), top)).withColumn("median", _at_most(F.col("median"), top)).withColumn("lo", F.when(top > 0, F.least("lo", "hi")).otherwise(F.col("lo"))).withColumn("hi", F.greatest("hi", "lo"))
    return rows.select("entity_id", "pillar", "captured", "n_signals", "ceiling_zar", "lo", "median", "hi", ((F.col("hi") - F.col("lo")) / 2).alias("half_width"), (F.col("median") - F.col("captured")).alias("pillar_gap_zar"))


def portfolio(detail: DataFrame, master: DataFrame) -> DataFrame:
    """One row a client, ranked by gap; ties by id."""
    best = F.min_by(F.struct("pillar", "pillar_gap_zar"), F.struct(-F.col("pillar_gap_zar"), "pillar"))
    total = detail.groupBy("entity_id").agg(F.sum("captured").alias("captured_zar"), F.sum("median").alias("taw_median_zar"), F.sum("n_signals").alias("n_external_signals"), F.sqrt(F.sum(F.col("half_width") ** 2)).alias("taw_half_width_zar"), best.alias("best"), F.max("ceiling_zar").alias("ceiling_zar"))
    total = total.withColumns({"top_opportunity_pillar": F.col("best.pillar"), "top_opportunity_gap_zar": F.col("best.pillar_gap_zar")}).drop("best")
    rows = total.join(master, "entity_id", "left")
    high = F.col("taw_median_zar") + F.col("taw_half_width_zar")
    rows = rows.withColumn("taw_lo_zar", F.greatest(F.col("taw_median_zar") - F.col("taw_half_width_zar"), F.col("captured_zar"))).withColumn("taw_hi_zar", F.when(F.col("ceiling_zar").isNotNull(), F.least(high, F.col("ceiling_zar"))).otherwise(high))
    rows = rows.withColumn("captured_share_pct", 100 * F.try_divide("captured_zar", "taw_median_zar")).withColumn("wallet_gap_zar", F.col("taw_median_zar") - F.col("captured_zar")).withColumn("has_external_evidence", F.col("n_external_signals") > 0)
    ranked = ordered_prefix(rows.drop("ceiling_zar"), [F.col("wallet_gap_zar").desc(), F.col("entity_id")], {}, "opportunity_rank")
    return ranked.withColumn("opportunity_rank", F.col("opportunity_rank").cast("int"))


def book_sums(books: dict[str, DataFrame], low: str, high: str) -> DataFrame:
    """Sum of each book in a window of dates per client; books lack clients, so they are joined by id, not by position."""
    out = None
    for name, df in books.items():
        value = next(c for c in df.columns if c.lower().endswith("_zar"))
        part = df.where(F.col("date").between(F.to_date(F.lit(low)), F.to_date(F.lit(high)))).groupBy("entity_id", "entity_name").agg(money(value).alias(f"syn_{name}"))
        out = part if out is None else out.join(part, ["entity_id", "entity_name"], "full_outer")
    return out.withColumn("syn_wallet", reduce(lambda a, b: a + b, [F.coalesce(F.col(f"syn_{n}"), F.lit(0.0)) for n in books]))


def wallet_summary(sums: DataFrame, proxies: DataFrame) -> DataFrame:
    """Against the wallet that the filings' proxies add up to: gap and share."""
    parts = ["revenue_domestic_zar", "cost_of_revenue_zar", "revenue_international_zar", "total_borrowings_zar"]
    wallet = proxies.select("entity_name", reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in parts]).alias("wallet"))
    return sums.join(wallet, "entity_name", "left").select("entity_id", "entity_name", "syn_wallet", "wallet", (F.col("wallet") - F.col("syn_wallet")).alias("wallet_gap"), F.try_divide("syn_wallet", "wallet").alias("syn_proportion"))


def config_rows(cfg: WalletConfig = CONFIG) -> list[tuple[str, str]]:
    """(setting, value): tables and lists as JSON, everything else as text."""
    return [(k, json.dumps(v) if isinstance(v, (dict, list, tuple)) else str(v)) for k, v in asdict(cfg).items()]


def config_sheet(spark: SparkSession, ceiling: DataFrame, cfg: WalletConfig = CONFIG) -> DataFrame:
    """The settings and, below them, each client's ceiling: (block, name, value)."""
    settings = spark.createDataFrame([("config", *r) for r in config_rows(cfg)], "block string, name string, value string")
    return settings.unionByName(ceiling.select(F.lit("ceiling").alias("block"), F.col("entity_id").alias("name"), F.col("ceiling_zar").cast("string").alias("value")))


def report_sheets(spark: SparkSession, ledger: DataFrame, external: DataFrame, cfg: WalletConfig = CONFIG) -> dict[str, DataFrame]:
    """The five sheets of the wallet report, by name."""
    known = facts(ledger, cfg).persist()
    master = entity_master(known)
    log = signal_log(external, master, observed_months(known), cfg)
    ceiling = ceilings(log)
    detail = pillar_detail(posterior(internal_prior(known, cfg), log, cfg), ceiling, cfg)
    return {"Portfolio Summary": portfolio(detail, master), "Pillar Detail": detail, "External Signal Log": log, "Config": config_sheet(spark, ceiling, cfg), "Entity Master": master}
