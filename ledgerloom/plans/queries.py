"""Registered queries of the wallet, cash-cycle and filing plans, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import CONFIG, LEGS
from ledgerloom.functions import rules, text
from ledgerloom.operators import relational as rel
from ledgerloom.plans import cashcycle, diagnostics, filings, wallet
from ledgerloom.operators.staging import scratch
from ledgerloom.sources import readers, sinks, views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, dates: tuple[str, ...] = ()):
    """Register a query; dates are returned as text, which reads the same everywhere."""

    def add(f):
        QUERIES[f.__name__] = (lambda spark, d: f(spark, d).withColumns({c: F.col(c).cast("string") for c in dates})) if dates else f
        if sql:
            ORACLE[f.__name__] = f"SELECT * REPLACE ({', '.join(f'{c}::VARCHAR AS {c}' for c in dates)}) FROM ({sql})" if dates else sql
        return f

    return add


def _with(sql: str) -> str:
    return f"WITH {views.SQL.strip()}, {sql}" if not sql.startswith("SELECT") else f"WITH {views.SQL.strip()} {sql}"


def _books(spark, d) -> dict[str, DataFrame]:
    return {"transactional_banking": views.transactional_banking(spark, d), "trade_finance": views.trade_finance(spark, d), "cross_border_payments": views.cross_border_payments(spark, d)}


def _ledger(spark, d) -> DataFrame:
    return wallet.tidy_ledger(_books(spark, d))


def _facts(spark, d) -> DataFrame:
    """The ledger's facts, kept for the plans that use them several times: the books are read once."""
    return wallet.facts(_ledger(spark, d)).persist()


def _r(df: DataFrame, *cols: str, n: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c in cols})


def _lit(items) -> str:
    return ", ".join("(" + ", ".join("NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'" for v in (r if isinstance(r, tuple) else (r,))) + ")" for r in items)


def _spark_lit(spark: SparkSession, items, names: str) -> DataFrame:
    rows = [r if isinstance(r, tuple) else (r,) for r in items]
    kinds = ["string" if isinstance(next((r[i] for r in rows if r[i] is not None), ""), str) else "bigint" for i in range(len(rows[0]))]
    return spark.createDataFrame(rows, ", ".join(f"{n.strip()} {k}" for n, k in zip(names.split(","), kinds, strict=True)))


# ---- ledgers ----------------------------------------------------------------------------------------------------------


@query(_with("SELECT entity_id, pillar, source_file, count(*) AS n, sum(value_zar::DECIMAL(20,4))::DOUBLE AS total FROM ledger GROUP BY ALL"))
def ledger_union(spark, d):
    return _ledger(spark, d).groupBy("entity_id", "pillar", "source_file").agg(F.count(F.lit(1)).alias("n"), rel.money("value_zar").alias("total"))


@query(_with("SELECT DISTINCT entity_id, entity_name, sector FROM ledger"))
def entity_master(spark, d):
    return wallet.entity_master(_facts(spark, d))


@query(_with("SELECT entity_id, greatest(1, round_even(date_diff('day', min(date), max(date)) / 30.44, 0))::INT AS months FROM ledger GROUP BY 1"))
def observed_months(spark, d):
    return wallet.observed_months(_facts(spark, d))


_PRIOR = """
st AS (SELECT entity_id, pillar, count(*) AS n, sum(value_zar::DECIMAL(20,4))::DOUBLE AS total, avg(ln(greatest(value_zar, 1.0))) AS mean_ln, var_samp(ln(greatest(value_zar, 1.0))) AS var_ln FROM ledger GROUP BY 1, 2),
grid AS (SELECT * FROM (SELECT DISTINCT entity_id FROM ledger), (VALUES ('Transactional Banking'), ('Investment Banking'), ('Global Markets')) AS p(pillar)),
prior AS (SELECT entity_id, pillar, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 1.0 ELSE greatest(total, 1.0) END AS captured, CASE WHEN n IS NULL THEN 0.0 ELSE mean_ln END AS m0,
                 CASE WHEN n IS NULL THEN 3.0 ELSE n END::DOUBLE AS k0, CASE WHEN n IS NULL THEN 1.5 WHEN n = 1 THEN 1.0 ELSE greatest((n - 1) / 2, 1.0) END::DOUBLE AS a0,
                 CASE WHEN n IS NULL THEN 0.525 WHEN n = 1 THEN 0.35 ELSE greatest((n - 1) * var_ln / 2, greatest((n - 1) / 2, 1.0) * 1e-6) END::DOUBLE AS b0
          FROM grid LEFT JOIN st USING (entity_id, pillar))"""


@query(_with(_PRIOR.strip() + " SELECT entity_id, pillar, n, round(captured::DOUBLE, 4) AS captured, round(m0::DOUBLE, 6) AS m0, k0, a0, round(b0, 4) AS b0 FROM prior"))
def internal_prior(spark, d):
    out = wallet.internal_prior(_facts(spark, d))
    return out.withColumns({"captured": F.round("captured", 4), "m0": F.round("m0", 6), "b0": F.round("b0", 4)})


#: What each label is: pillar and multiplier. (The SQL knows answers, not rules.)
_FLOWS = [("Global Markets", 50.0), ("Global Markets", 12.5), ("Global Markets", 12.5), ("Global Markets", 12.5), *[("Investment Banking", 1.0)] * 5, *[("Transactional Banking", 1.0)] * 4, *[("ceiling_only", 1.0)] * 3, *[("", 0.0)] * 4]
_CLASS = "CASE " + " ".join(f"WHEN line_item = '{x}' THEN {{'pillar': '{p}', 'm': {m}}}" for x, (p, m) in zip(views.LABELS, _FLOWS, strict=True) if p) + " END"
_MATCH = """
words AS (SELECT DISTINCT entity_variant, list_distinct(regexp_extract_all(lower(entity_variant), '[a-z0-9]+')) AS w FROM ext),
stop AS (SELECT ['group', 'holdings', 'limited', 'ltd', 'plc', 'corp', 'corporation', 'company', 'co', 'the', 'international', 'sa', 'za'] AS s),
have AS (SELECT entity_variant, CASE WHEN len(list_filter(w, lambda x: NOT list_contains(s, x))) > 0 THEN list_filter(w, lambda x: NOT list_contains(s, x)) ELSE w END AS have FROM words, stop),
need AS (SELECT DISTINCT entity_id, regexp_extract_all(lower(entity_name), '[a-z0-9]+') AS need FROM ledger),
named AS (SELECT entity_variant, entity_id FROM have LEFT JOIN need ON list_has_all(have, need) QUALIFY row_number() OVER (PARTITION BY entity_variant ORDER BY len(need) DESC, entity_id) = 1)"""


@query(_with(_MATCH.strip() + " SELECT * FROM named"))
def entity_match(spark, d):
    return rel.match_names(views.external_lines(spark, d), wallet.entity_master(_facts(spark, d)))


@query("SELECT line_item, pillar, multiplier::DOUBLE AS multiplier FROM (VALUES " + _lit([(x, *f) for x, f in zip(views.LABELS, _FLOWS, strict=True)]) + ") AS t(line_item, pillar, multiplier)")
def classify_lines(spark, d):
    rows = views.external_lines(spark, d).select("line_item").distinct().withColumn("c", rules.classify_line_item(F.col("line_item")))
    return rows.select("line_item", F.coalesce("c.pillar", F.lit("")).alias("pillar"), F.coalesce("c.multiplier", F.lit(0.0)).alias("multiplier"))


_SIGNALS = _MATCH + f""",
months AS (SELECT entity_id, greatest(1, round_even(date_diff('day', min(date), max(date)) / 30.44, 0)) AS months FROM ledger GROUP BY 1),
known AS (SELECT ext.*, entity_id FROM ext JOIN named USING (entity_variant) WHERE NOT restated AND entity_id IS NOT NULL),
latest AS (SELECT *, {_CLASS} AS c FROM known QUALIFY year = max(year) OVER (PARTITION BY entity_id)),
log AS (SELECT entity_id, entity_variant, line_item, year, c.pillar AS pillar, c.m::DOUBLE AS ci_multiplier, value_zar AS raw_value_zar,
               CASE WHEN c.pillar <> 'ceiling_only' AND value_zar <> 0 THEN ln(abs(value_zar) * c.m::DOUBLE) + ln(coalesce(months, 12) / 12) END AS x_i FROM latest LEFT JOIN months USING (entity_id))"""


def _log(spark, d, known: DataFrame | None = None) -> DataFrame:
    known = known if known is not None else _facts(spark, d)
    return wallet.signal_log(views.external_lines(spark, d), wallet.entity_master(known), wallet.observed_months(known))


@query(_with(_SIGNALS.strip() + " SELECT * EXCLUDE (x_i), round(x_i, 6) AS x_i FROM log"))
def signal_log(spark, d):
    return _r(_log(spark, d).drop("note"), "x_i")


_CEIL = """,
ceil AS (SELECT entity_id, sum(v) AS ceiling_zar FROM (SELECT entity_id, line_item, max(abs(raw_value_zar)) AS v FROM log WHERE pillar = 'ceiling_only' GROUP BY 1, 2) GROUP BY 1)"""


@query(_with(_SIGNALS.strip() + _CEIL + " SELECT entity_id, round(ceiling_zar, 2) AS ceiling_zar FROM ceil"))
def client_ceiling(spark, d):
    return _r(wallet.ceilings(_log(spark, d)), "ceiling_zar", n=2)


_POST = ", " + _PRIOR.strip() + """,
sig AS (SELECT entity_id, pillar, count(*) AS ns, avg(x_i) AS xb, var_pop(x_i) * count(*) AS ss FROM log WHERE x_i IS NOT NULL GROUP BY 1, 2),
j AS (SELECT prior.*, coalesce(ns, 0) AS n_signals, ns / (1 + (ns - 1) * 0.3) AS ne, xb, ss FROM prior LEFT JOIN sig USING (entity_id, pillar)),
post AS (SELECT entity_id, pillar, captured, n_signals, coalesce((k0 * m0 + ne * xb) / (k0 + ne), m0) AS m_n, coalesce(k0 + ne, k0) AS k_n, coalesce(a0 + ne / 2, a0) AS a_n,
                coalesce(b0 + ss / 2 + k0 * ne * (xb - m0) * (xb - m0) / (2 * (k0 + ne)), b0) AS b_n FROM j)"""


def _post(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    known = _facts(spark, d)
    log = _log(spark, d, known)
    return wallet.posterior(wallet.internal_prior(known), log), wallet.ceilings(log), wallet.entity_master(known)


@query(_with(_SIGNALS.strip() + _POST + " SELECT entity_id, pillar, round(captured::DOUBLE, 4) AS captured, n_signals, round(m_n::DOUBLE, 6) AS m_n, round(k_n::DOUBLE, 6) AS k_n, round(a_n::DOUBLE, 6) AS a_n, round(b_n::DOUBLE, 4) AS b_n FROM post"))
def nig_posterior(spark, d):
    return _post(spark, d)[0].withColumns({"captured": F.round("captured", 4), "m_n": F.round("m_n", 6), "k_n": F.round("k_n", 6), "a_n": F.round("a_n", 6), "b_n": F.round("b_n", 4)})


# The t quantile by Simpson's rule and bisection, apart from the plan's continued fraction. nu: degrees of freedom.
_T = """,
nus AS (SELECT DISTINCT 2 * a_n AS nu FROM post),
bis AS (SELECT nu, 0::DOUBLE AS lo, 4::DOUBLE AS hi, 0 AS step FROM nus UNION ALL
        SELECT nu, CASE WHEN mass < 0.45 THEN mid ELSE lo END, CASE WHEN mass < 0.45 THEN hi ELSE mid END, step + 1
        FROM (SELECT *, (lo + hi) / 2 AS mid, exp(lgamma((nu + 1) / 2) - lgamma(nu / 2)) / sqrt(nu * pi()) * ((lo + hi) / 2) / 1200 *
              list_sum(list_transform(range(0, 401), lambda i: (CASE WHEN i IN (0, 400) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * pow(1 + pow((lo + hi) / 2 * i / 400, 2) / nu, -(nu + 1) / 2))) AS mass
              FROM bis WHERE step < 52)),
tq AS (SELECT nu, -(lo + hi) / 2 AS t FROM bis WHERE step = 52),
raw AS (SELECT post.*, ceiling_zar, t * sqrt(greatest(b_n * (k_n + 1) / (a_n * k_n), 1e-12)) AS w FROM post JOIN tq ON 2 * a_n = nu LEFT JOIN ceil USING (entity_id)),
cut AS (SELECT *, greatest(exp(m_n + w), 1) AS lo0, CASE WHEN ceiling_zar > 0 THEN least(greatest(exp(m_n), 1), ceiling_zar) ELSE greatest(exp(m_n), 1) END AS median,
               CASE WHEN ceiling_zar > 0 THEN least(exp(m_n - w), ceiling_zar) ELSE exp(m_n - w) END AS hi0 FROM raw),
two AS (SELECT *, CASE WHEN ceiling_zar > 0 THEN least(lo0, hi0) ELSE lo0 END AS lo FROM cut),
det AS (SELECT *, greatest(hi0, lo) AS hi FROM two)"""
_MILLIONS = lambda c: f"round_even(({c}) / 1e6, 2)::DOUBLE"


def _sql_t(sql: str) -> str:
    return _with(sql).replace("WITH ", "WITH RECURSIVE ", 1)


@query(_sql_t(_SIGNALS.strip() + _CEIL + _POST + _T + " SELECT entity_id, pillar, n_signals, " + ", ".join(f"{_MILLIONS(e)} AS {n}" for n, e in (("captured", "captured"), ("ceiling_zar", "ceiling_zar"), ("lo", "lo"), ("median", "median"), ("hi", "hi"), ("half_width", "(hi - lo) / 2"), ("pillar_gap_zar", "median - captured"))) + " FROM det"))
def pillar_detail(spark, d):
    """Amounts in millions, to two places."""
    post, ceiling, _ = _post(spark, d)
    out = wallet.pillar_detail(post, ceiling)
    return out.withColumns({c: F.bround(F.col(c) / 1e6, 2) for c in ("captured", "ceiling_zar", "lo", "median", "hi", "half_width", "pillar_gap_zar")})


_PORTFOLIO = """,
best AS (SELECT entity_id, pillar AS top_opportunity_pillar, median - captured AS top_gap FROM det QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY median - captured DESC, pillar) = 1),
tot AS (SELECT entity_id, sum(captured)::DOUBLE AS cap, sum(median)::DOUBLE AS med, sum(n_signals)::BIGINT AS n_external_signals, sqrt(sum(pow((hi - lo) / 2, 2))) AS half, max(ceiling_zar) AS top FROM det GROUP BY 1),
pf AS (SELECT *, greatest(med - half, cap) AS low, CASE WHEN top IS NOT NULL THEN least(med + half, top) ELSE med + half END AS high FROM tot JOIN best USING (entity_id) JOIN (SELECT DISTINCT entity_id, entity_name, sector FROM ledger) USING (entity_id))"""


@query(_sql_t(_SIGNALS.strip() + _CEIL + _POST + _T + _PORTFOLIO + " SELECT entity_id, entity_name, sector, top_opportunity_pillar, n_external_signals, n_external_signals > 0 AS has_external_evidence, round_even(100 * cap / med, 1)::DOUBLE AS captured_share_pct, row_number() OVER (ORDER BY med - cap DESC, entity_id)::INT AS opportunity_rank, " + ", ".join(f"{_MILLIONS(e)} AS {n}" for n, e in (("captured_zar", "cap"), ("taw_median_zar", "med"), ("taw_half_width_zar", "half"), ("top_opportunity_gap_zar", "top_gap"), ("taw_lo_zar", "low"), ("taw_hi_zar", "high"), ("wallet_gap_zar", "med - cap"))) + " FROM pf"))
def portfolio(spark, d):
    """As printed: amounts in millions to two places, shares to one."""
    post, ceiling, master = _post(spark, d)
    return sinks.wallet_report(wallet.portfolio(wallet.pillar_detail(post, ceiling), master))


_MEDIAN = """,
med AS (SELECT post.*, CASE WHEN ceiling_zar > 0 THEN least(greatest(exp(m_n), 1.0), ceiling_zar) ELSE greatest(exp(m_n), 1.0) END AS median FROM post LEFT JOIN ceil USING (entity_id))"""


@query(_with(_SIGNALS.strip() + _CEIL + _POST + _MEDIAN + " SELECT entity_id, pillar, round((median - captured)::DOUBLE, 1) AS pillar_gap_zar FROM med QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY median - captured DESC, pillar) = 1"))
def top_pillar(spark, d):
    post, ceiling, _ = _post(spark, d)
    out = rel.top_rows(wallet.pillar_detail(post, ceiling), ["entity_id"], [F.col("pillar_gap_zar").desc_nulls_last(), F.col("pillar")])
    return out.select("entity_id", "pillar", F.round("pillar_gap_zar", 1).alias("pillar_gap_zar"))


_WINDOW = ("1995-06-30", "1996-06-30")
_BOOKS_SQL = f"""
a AS (SELECT entity_id, entity_name, sum(amount_zar::DECIMAL(20,4))::DOUBLE AS t FROM tb WHERE date BETWEEN '{_WINDOW[0]}' AND '{_WINDOW[1]}' GROUP BY ALL),
b AS (SELECT entity_id, entity_name, sum(value_zar::DECIMAL(20,4))::DOUBLE AS f FROM tf WHERE date BETWEEN '{_WINDOW[0]}' AND '{_WINDOW[1]}' GROUP BY ALL),
c AS (SELECT entity_id, entity_name, sum(value_zar::DECIMAL(20,4))::DOUBLE AS x FROM xb WHERE date BETWEEN '{_WINDOW[0]}' AND '{_WINDOW[1]}' GROUP BY ALL),
sums AS (SELECT entity_id, entity_name, t AS syn_transactional_banking, f AS syn_trade_finance, x AS syn_cross_border_payments,
                round(coalesce(t, 0) + coalesce(f, 0) + coalesce(x, 0), 4) AS syn_wallet FROM a FULL JOIN b USING (entity_id, entity_name) FULL JOIN c USING (entity_id, entity_name))"""


def _proxies(spark, d) -> DataFrame:
    n = F.col("nation").cast("double")
    return views.entity(spark, d).where("nation % 2 = 0").select("entity_name", (n * 1e7).alias("revenue_domestic_zar"), (n * 2e6).alias("cost_of_revenue_zar"), F.when(n > 4, n * 1e6).alias("revenue_international_zar"), F.lit(0.0).alias("total_borrowings_zar"))


@query(_with(_BOOKS_SQL.strip() + " SELECT * FROM sums"))
def book_sums_window(spark, d):
    return _r(wallet.book_sums(_books(spark, d), *_WINDOW), "syn_wallet", n=4)


@query(_with(_BOOKS_SQL.strip() + """, w AS (SELECT entity_name, nation * 1e7 + nation * 2e6 + CASE WHEN nation > 4 THEN nation * 1e6 ELSE 0 END AS wallet FROM entity WHERE nation % 2 = 0)
SELECT entity_id, entity_name, syn_wallet, wallet::DOUBLE AS wallet, round((wallet - syn_wallet)::DOUBLE, 3) AS wallet_gap, round(CASE WHEN wallet <> 0 THEN syn_wallet / wallet END, 6)::DOUBLE AS syn_proportion FROM sums LEFT JOIN w USING (entity_name)"""))
def wallet_summary(spark, d):
    out = wallet.wallet_summary(wallet.book_sums(_books(spark, d), *_WINDOW), _proxies(spark, d))
    return _r(_r(_r(out, "syn_proportion"), "wallet_gap", n=3), "syn_wallet", n=4)


# ---- cash cycle -------------------------------------------------------------------------------------------------------

_WEEK = "(date - ((dayofweek(date) + 5) % 7)::INT)::DATE"
_PIVOT = f"""
wk AS (SELECT entity_id, entity_name, sector, {_WEEK} AS week, {', '.join(f"coalesce(sum(amount_zar::DECIMAL(20,4)) FILTER (leg_type = '{leg}'), 0)::DOUBLE AS {leg}" for leg in LEGS)} FROM tb GROUP BY ALL),
wp AS (SELECT *, collections - supplier_payments AS net_cash FROM wk)"""
_WINDOWS = ",\nww AS (SELECT *, " + ", ".join(f"lag({c}, {k}) OVER w AS {c}_lag{k}" for c in ("collections", "supplier_payments") for k in (1, 2, 3, 4)) + ", " + ", ".join(f"CASE WHEN count(*) OVER f = 4 THEN round(avg({c}) OVER f, 4) END AS {c}_roll4_mean" for c in ("collections", "supplier_payments", "net_cash")) + """,
 CASE WHEN count(*) OVER f = 4 THEN round(stddev_samp(net_cash) OVER f, 4) END AS net_cash_roll4_std, lead(collections) OVER w AS target_next_collections, lead(supplier_payments) OVER w AS target_next_payments,
 ((day(week) - 1) // 7 + 1)::INT AS week_of_month, month(week)::INT AS month, (tax > 0)::INT AS has_tax_this_week, (payroll > 0)::INT AS has_payroll_this_week
 FROM wp WINDOW w AS (PARTITION BY entity_id ORDER BY week), f AS (PARTITION BY entity_id ORDER BY week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING))"""
_ASOF = """,
mt AS (SELECT entity_id, (date + tenor_days)::DATE AS md, min(value_zar) AS v FROM tf GROUP BY 1, 2),
wa AS (SELECT ww.*, date_diff('day', week, md)::INT AS days_to_next_tf_maturity, coalesce(v, 0) AS next_tf_maturity_value, coalesce((date_diff('day', week, md) <= 30)::INT, 0) AS tf_maturity_within_30d
       FROM ww ASOF LEFT JOIN mt ON ww.entity_id = mt.entity_id AND mt.md >= ww.week)"""
_XB = f""",
xw AS (SELECT entity_id, {_WEEK} AS week, sum(value_zar::DECIMAL(20,4))::DOUBLE AS xborder_volume FROM xb GROUP BY 1, 2),
feat AS (SELECT wa.*, coalesce(xborder_volume, 0) AS xborder_volume FROM wa LEFT JOIN xw USING (entity_id, week) WHERE collections_lag4 IS NOT NULL AND supplier_payments_lag4 IS NOT NULL)"""


@query(_with(_PIVOT.strip() + " SELECT * EXCLUDE (net_cash), round(net_cash, 4) AS net_cash FROM wp"), dates=("week",))
def weekly_pivot(spark, d):
    return _r(cashcycle.weekly_pivot(views.transactional_banking(spark, d)), "net_cash", n=4)


_ROLLS = ("collections_roll4_mean", "supplier_payments_roll4_mean", "net_cash_roll4_mean", "net_cash_roll4_std")


def _features(spark, d) -> DataFrame:
    out = cashcycle.weekly_features(views.transactional_banking(spark, d), views.trade_finance(spark, d), views.cross_border_payments(spark, d))
    return _r(out, "net_cash", *_ROLLS, n=4)


@query(_with(_PIVOT.strip() + _WINDOWS + " SELECT entity_id, week, " + ", ".join(f"{c}_lag{k}" for c in ("collections", "supplier_payments") for k in (1, 2, 3, 4)) + " FROM ww"), dates=("week",))
def weekly_lags(spark, d):
    out = cashcycle.with_windows(cashcycle.weekly_pivot(views.transactional_banking(spark, d)))
    return out.select("entity_id", "week", *[f"{c}_lag{k}" for c in ("collections", "supplier_payments") for k in (1, 2, 3, 4)])


@query(_with(_PIVOT.strip() + _WINDOWS + f" SELECT entity_id, week, {', '.join(_ROLLS)}, target_next_collections, target_next_payments FROM ww"), dates=("week",))
def weekly_rolling(spark, d):
    out = cashcycle.with_windows(cashcycle.weekly_pivot(views.transactional_banking(spark, d)))
    return _r(out.select("entity_id", "week", *_ROLLS, "target_next_collections", "target_next_payments"), *_ROLLS, n=4)


@query(_with(_PIVOT.strip() + _WINDOWS + _ASOF + " SELECT entity_id, week, days_to_next_tf_maturity, next_tf_maturity_value, tf_maturity_within_30d FROM wa"), dates=("week",))
def asof_maturity(spark, d):
    out = cashcycle.weekly_maturity(cashcycle.weekly_pivot(views.transactional_banking(spark, d)), views.trade_finance(spark, d))
    return out.select("entity_id", "week", "days_to_next_tf_maturity", "next_tf_maturity_value", "tf_maturity_within_30d")


@query(_with(f"SELECT entity_id, {_WEEK} AS week, sum(value_zar::DECIMAL(20,4))::DOUBLE AS xborder_volume FROM xb GROUP BY 1, 2"), dates=("week",))
def weekly_crossborder(spark, d):
    return cashcycle.weekly_crossborder(views.cross_border_payments(spark, d))


@query(_with(_PIVOT.strip() + _WINDOWS + _ASOF + _XB + " SELECT * EXCLUDE (net_cash), round(net_cash, 4) AS net_cash FROM feat"), dates=("week",))
def weekly_features(spark, d):
    return _features(spark, d)


@query(_with(_PIVOT.strip() + _WINDOWS + _ASOF + _XB + " SELECT entity_id, week, coalesce(round(net_cash, 4) > greatest(net_cash_roll4_mean, 0) OR tf_maturity_within_30d = 1, false)::INT AS label FROM feat"), dates=("week",))
def engagement_label(spark, d):
    return cashcycle.engagement_label(_features(spark, d)).select("entity_id", "week", "label")


_CHECKPOINT = [(f"E{i:02d}", "1998-06-02" if i % 2 else "2005-01-04") for i in range(0, 20)]


@query(_with(_PIVOT.strip() + _WINDOWS + _ASOF + _XB + f", cp AS (SELECT * FROM (VALUES {_lit(_CHECKPOINT)}) AS t(entity_id, s)), lt AS (SELECT entity_id, max(week) AS latest FROM feat GROUP BY 1) SELECT entity_id, latest, s::DATE AS last_seen FROM lt LEFT JOIN cp USING (entity_id) WHERE coalesce(latest > s::DATE, true)"), dates=("latest", "last_seen",))
def stale_entities(spark, d):
    checkpoint = _spark_lit(spark, _CHECKPOINT, "entity_id, s").select("entity_id", F.to_date("s").alias("last_seen"))
    return cashcycle.stale_entities(_features(spark, d), checkpoint)


@query(_with(_PIVOT.strip() + _WINDOWS + _ASOF + _XB + " SELECT entity_id, week, collections, xborder_volume FROM feat QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY week DESC) = 1"), dates=("week",))
def latest_week(spark, d):
    return cashcycle.latest_week(_features(spark, d)).select("entity_id", "week", "collections", "xborder_volume")


@query()
def forecast_leaderboard(spark, d):
    return cashcycle.leaderboard(cashcycle.forecast(_features(spark, d)))


# ---- diagnostics ------------------------------------------------------------------------------------------------------

_SKEW = "sk AS (SELECT entity_id, source_file, count(*) AS n, avg(value_zar) AS m FROM ledger WHERE value_zar > 0 GROUP BY 1, 2 HAVING count(*) > 2), sv AS (SELECT entity_id, source_file, any_value(n) AS n, sqrt(any_value(n)) * sum((value_zar - m) ** 3) / sum((value_zar - m) ** 2) ** 1.5 AS skew FROM ledger JOIN sk USING (entity_id, source_file) WHERE value_zar > 0 GROUP BY 1, 2)"


@query(_with(_SKEW + " SELECT entity_id, source_file, n, round(skew, 6) AS skew FROM sv"))
def skew_by_client_pillar(spark, d):
    return _r(diagnostics.skew(_ledger(spark, d)), "skew")


@query(_with(_SKEW + " SELECT source_file, count(*) AS clients, sum((skew > 0)::INT)::BIGINT AS right_skewed, sum((skew < 0)::INT)::BIGINT AS left_skewed, round(100 * avg((skew > 0)::INT), 6) AS right_pct FROM sv GROUP BY 1"))
def skew_shares(spark, d):
    return _r(diagnostics.skew_shares(diagnostics.skew(_ledger(spark, d))), "right_pct")


@query(_with("SELECT source_file, round(stddev_pop(ln(value_zar)), 6) AS shape, round(exp(avg(ln(value_zar))), 2) AS scale, round(avg(ln(value_zar)), 6) AS mean_ln FROM ledger WHERE value_zar > 0 GROUP BY 1"))
def lognormal_fit(spark, d):
    return _r(_r(diagnostics.lognormal_fit(_ledger(spark, d)), "shape", "mean_ln"), "scale", n=2)


@query(_with("e AS (SELECT source_file, min(value_zar) AS lo, max(value_zar) AS hi, count(*) AS n FROM ledger WHERE value_zar > 0 GROUP BY 1) SELECT source_file, least(floor((value_zar - lo) / ((hi - lo) / 60))::INT, 59) AS bin, round(1e9 * count(*) / (any_value(n) * any_value((hi - lo) / 60)), 6) AS density FROM ledger JOIN e USING (source_file) WHERE value_zar > 0 AND hi > lo GROUP BY 1, 2"))
def hist_density(spark, d):
    return diagnostics.density(_ledger(spark, d)).withColumn("density", F.round(F.col("density") * 1e9, 6))


@query(_with("SELECT source_file, round(quantile_cont(value_zar, 0.995), 4) AS p FROM ledger WHERE value_zar > 0 GROUP BY 1"))
def percentile_995(spark, d):
    return _r(diagnostics.percentile(_ledger(spark, d)), "p", n=4)


@query(_with("SELECT sector, " + ", ".join(f"round(coalesce(avg(value_zar) FILTER (pillar = '{p}'), 0), 4)::DOUBLE AS \"{p}\"" for p in CONFIG.pillars) + " FROM ledger GROUP BY 1"))
def heatmap_pivot(spark, d):
    return _r(diagnostics.heatmap(_ledger(spark, d), list(CONFIG.pillars)), *CONFIG.pillars, n=4)


# ---- filings ----------------------------------------------------------------------------------------------------------

_TITLES = [
    "Integrated Annual Report 2024", "Audited consolidated annual financial statements 2024", "Reviewed condensed consolidated interim results 2024",
    "Results presentation FY2024", "DMTN Programme Memorandum 2023", "Notice of Annual General Meeting 2025", "Trading statement for the year ended 30 June 2025",
    "Summarised audited results 2024", "Sustainability Report 2024", "Interim report for the six months ended 31 December 2024", "Annual Report 2024",
    "FY25 results", "year ended 30 June 2024", "Annual Financial Statements 2023/24", "Cautionary announcement SENS", "Group structure", "Investor day slides.pptx", "XY_AFS_2024",
]


#: What each title is: type, score, runner-up, year and where that stands. (The SQL knows answers, not rules.)
_KNOWN = [
    ("IAR", 18, "AFS", 2024, "bare"), ("AFS", 22, "IAR", 2024, "bare"), ("INTERIM", 24, "IAR", 2024, "bare"), ("PRES", 16, "IAR", 2024, "fy_label"), ("DEBT", 14, "IAR", 2023, "bare"), ("AGM", 13, "IAR", 2025, "bare"),
    ("TRADESTMT", 14, "IAR", 2025, "explicit_fye"), ("SUMRES", 18, "IAR", 2024, "bare"), ("ESG", 11, "IAR", 2024, "bare"), ("INTERIM", 10, "IAR", 2024, "bare"), ("IAR", 10, "AFS", 2024, "bare"), ("UNKNOWN", 0, "UNKNOWN", 2025, "fy_label"),
    ("UNKNOWN", 0, "UNKNOWN", 2024, "explicit_fye"), ("AFS", 10, "IAR", 2024, "bare"), ("SENS", 15, "IAR", 0, "none"), ("UNKNOWN", 0, "UNKNOWN", 0, "none"), ("PRES", 21, "IAR", 0, "none"), ("UNKNOWN", 0, "UNKNOWN", 0, "none"),
]


def _dealt(spark, d, table: str, key: str, items: list[str]) -> DataFrame:
    """(key, t): one of the items for each row of a table, by its number."""
    return views.table(spark, d, table).select(F.col(key).cast("long").alias(key), F.element_at(F.array(*[F.lit(x) for x in items]), (F.col(key) % len(items) + 1).cast("int")).alias("t"))


def _answers(rows: list[tuple], names: str) -> str:
    return f"(VALUES {_lit([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)])}) AS a(i, {names})"


@query(f"SELECT doc_id, doc_type, score::INT AS score, runner_up, false AS ambiguous FROM documents, {_answers([k[:3] for k in _KNOWN], 'doc_type, score, runner_up')} WHERE doc_id % 18 = i")
def doc_classify(spark, d):
    return _dealt(spark, d, "documents", "doc_id", _TITLES).withColumn("c", rules.classify_document(F.col("t"))).select("doc_id", "c.doc_type", "c.score", "c.runner_up", "c.ambiguous")


@query(f"SELECT doc_id, year::INT AS year, confidence FROM documents, {_answers([k[3:] for k in _KNOWN], 'year, confidence')} WHERE doc_id % 18 = i")
def year_extract(spark, d):
    return _dealt(spark, d, "documents", "doc_id", _TITLES).withColumn("y", text.report_year(F.col("t"))).select("doc_id", F.coalesce("y.year", F.lit(0)).alias("year"), "y.confidence")


@query("""SELECT l_orderkey::BIGINT AS l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE k WHEN 0 THEN floor(l_extendedprice) WHEN 2 THEN -floor(l_extendedprice) WHEN 6 THEN 0 ELSE l_extendedprice END::DOUBLE AS value, k = 7 AS ambiguous
FROM (SELECT *, (l_orderkey + l_linenumber) % 8 AS k FROM lineitem) WHERE k <> 7 UNION ALL SELECT l_orderkey, l_linenumber, l_linenumber * 1000 + 234, true FROM lineitem WHERE (l_orderkey + l_linenumber) % 8 = 7""")
def za_number(spark, d):
    """Prices in eight spellings: blanks or dots for thousands, comma or dot for cents, brackets, a currency sign, a dash, and
    one that leaves open what the comma means."""
    price, k = F.col("l_extendedprice"), (F.col("l_orderkey") + F.col("l_linenumber")) % 8
    whole, cents = F.regexp_replace(F.format_number(F.floor(price), 0), ",", " "), F.format_number(price, 2)
    spaced = F.translate(cents, ",.", " ,")
    forms = [whole, spaced, F.concat(F.lit("("), whole, F.lit(")")), F.concat(F.lit("R"), spaced), F.translate(cents, ",.", ".,"), cents, F.lit("–"), F.concat(F.col("l_linenumber").cast("string"), F.lit(",234"))]
    rows = views.table(spark, d, "lineitem").withColumn("raw", F.element_at(F.array(*forms), (k + 1).cast("int")))
    rows = rows.withColumn("n", text.za_number(F.col("raw")))
    return rows.select(F.col("l_orderkey").cast("long").alias("l_orderkey"), F.col("l_linenumber").cast("long").alias("l_linenumber"), "n.value", "n.ambiguous")


_UNITS = ["R million", "Rm", "US$ million", "$m", "R'000", "GBP bn", "€ thousand", "ZAR bn", "All figures in R'000", "Revenue for the year", "cents per share", "USD m"]


_SCALED = [("ZAR", 1e6, 1e6, "millions"), ("ZAR", 1e6, 1e6, "millions"), ("USD", 1e6, 1.0, ""), ("ZAR", 1e6, 1.0, ""), ("ZAR", 1e3, 1e3, "thousands"), ("GBP", 1e9, 1.0, ""), ("EUR", 1e3, 1.0, ""), ("ZAR", 1e9, 1e9, "billions"), ("ZAR", 1e3, 1e3, "thousands"), ("ZAR", 1.0, 1.0, ""), ("ZAR", 1.0, 0.01, "cents"), ("USD", 1e6, 1.0, "")]


@query(f"SELECT page_id, currency, sheet_scale::DOUBLE AS sheet_scale, page_scale::DOUBLE AS page_scale, page_label FROM pages, {_answers(_SCALED, 'currency, sheet_scale, page_scale, page_label')} WHERE page_id % 12 = i")
def scale_detect(spark, d):
    u = F.col("t")
    mult, name = rules.page_scale(u)
    return _dealt(spark, d, "pages", "page_id", _UNITS).select("page_id", rules.detect_currency(u).alias("currency"), rules.sheet_scale(u).alias("sheet_scale"), mult.alias("page_scale"), F.when(name.contains("NOT DECLARED"), "").otherwise(name).alias("page_label"))


_HEADS = ["Consolidated statement of comprehensive income", "Balance sheet at 30 June", "Statements of cash flows", "Statement of changes in equity", "Directors' report"]


@query(f"SELECT page_id, statement FROM pages, {_answers(['statement_of_comprehensive_income', 'statement_of_financial_position', 'statement_of_cash_flows', 'statement_of_changes_in_equity', ''], 'statement')} WHERE page_id % 5 = i")
def statement_detect(spark, d):
    return _dealt(spark, d, "pages", "page_id", _HEADS).select("page_id", F.coalesce(rules.statement_kind(F.concat(F.lit("x "), "t", F.lit(" y"))), F.lit("")).alias("statement"))


_ROWS = ["Revenue", "Cost of sales", "Total assets", "Turnover *", "Trade and other receivables", "Net cash generated from operations", "Dividends paid", "Interest expense", "Long-term debt", "Something else", "EBIT", "Staff costs", "Bank overdraft"]


_CONCEPTS = [("revenue", 7), ("cost_of_sales", 10), ("total_assets", 10), ("revenue", 7), ("trade_receivables", 10), ("cash_from_operations", 10), ("dividends_paid", 10), ("finance_costs", 8), ("long_term_borrowings", 8), ("", 0), ("operating_profit", 8), ("staff_costs", 10), ("short_term_borrowings", 7)]


@query(f"SELECT doc_id, concept, specificity::INT AS specificity FROM documents, {_answers(_CONCEPTS, 'concept, specificity')} WHERE doc_id % 13 = i AND concept <> ''")
def label_match(spark, d):
    return _dealt(spark, d, "documents", "doc_id", _ROWS).withColumn("m", rules.match_label(F.col("t"))).where("m is not null").select("doc_id", "m.concept", "m.specificity")


_WORDS = [("a", 1, "Revenue", 10, 60, 100, 110), ("a", 1, "12", 100, 110, 100, 110), ("a", 1, "204", 200, 215, 100, 110), ("a", 1, "573", 218, 233, 100, 110), ("a", 1, "189", 300, 315, 101, 111), ("a", 1, "122", 318, 333, 101, 111), ("a", 1, "Total", 10, 40, 130, 140), ("a", 1, "assets", 43, 80, 130, 140), ("a", 1, "(1", 200, 210, 130, 140), ("a", 1, "500)", 212, 230, 130, 140), ("a", 1, "Heading", 10, 70, 160, 170)]


@query("SELECT * FROM (VALUES ('Revenue', 'revenue', 1::INT, 204573.0::DOUBLE, 204573000.0::DOUBLE, 0.8::DOUBLE), ('Total assets', 'total_assets', 0::INT, -1500.0::DOUBLE, -1500000.0::DOUBLE, 0.95::DOUBLE)) AS t(label, concept, column_index, value, scaled_value, confidence)")
def word_line_items(spark, d):
    """Golden vectors: words with coordinates to line items; the SQL holds the known results."""
    rows = filings.word_rows(_spark_lit(spark, _WORDS, "doc, page, text, x0, x1, top, bottom").withColumns({c: F.col(c).cast("double") for c in ("x0", "x1", "top", "bottom")}))
    out = filings.line_items(rows.withColumn("multiplier", F.lit(1000.0)).withColumn("scale_label", F.lit("thousands")))
    return out.select("label", "concept", "column_index", "value", "scaled_value", "confidence")


@query("SELECT source, text AS first_text, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def hash_dedupe(spark, d):
    docs = views.table(spark, d, "documents").withColumn("h", F.sha2("text", 256))
    kept = docs.groupBy(F.col("h").alias("kept_h")).agg(F.min("doc_id").alias("kept_id"))
    return docs.join(kept, F.col("h").eqNullSafe(F.col("kept_h")) & F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi").select("source", F.col("text").alias("first_text"), "doc_id")


@query("SELECT split_part(url, '#', 1) AS url_key, min(page_id) AS page_id, count(*) AS n FROM pages GROUP BY 1")
def url_dedupe(spark, d):
    return views.table(spark, d, "pages").groupBy(F.substring_index("url", "#", 1).alias("url_key")).agg(F.min("page_id").alias("page_id"), F.count(F.lit(1)).alias("n"))


@query(r"""SELECT page_id, (unnest(range(1, len(l) + 1)) - 1)::INT AS place, unnest(l) AS link, regexp_matches(lower(split_part(split_part(link, '?', 1), '#', 1)), '\.(pdf|ppt|pptx|xls|xlsx|doc|docx|zip)$') AS downloadable
FROM (SELECT page_id, list_transform(regexp_extract_all(html, '(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1), lambda x: CASE WHEN x[1] IN (chr(34), chr(39)) THEN x[2:-2] ELSE x END) AS l FROM pages)""")
def html_links(spark, d):
    return filings.page_links(views.table(spark, d, "pages")).drop("absolute")


@query("SELECT page_id, page_id % 4 < 2 AS follow FROM pages")
def link_follow(spark, d):
    """Addresses made from the page numbers: two kinds to follow, one to avoid, one of no interest."""
    ways = F.array(F.lit("/Investors/results"), F.lit("/news/2024/sens"), F.lit("/careers/annual"), F.lit("/about-us"))
    url = F.concat(F.lit("http://h.test"), F.element_at(ways, (F.col("page_id") % 4 + 1).cast("int")), F.lit("/x"))
    return views.table(spark, d, "pages").select("page_id", filings.worth_following(url, F.lit("")).alias("follow"))


_HAVE_SQL = "h AS (SELECT source AS ticker, CASE doc_id % 3 WHEN 0 THEN 'AFS' WHEN 1 THEN 'IAR' ELSE 'INTERIM' END AS doc_type, 2021 + doc_id % 5 AS year FROM documents WHERE source IS NOT NULL AND doc_id % 7 < 2)"


def _have(spark, d) -> DataFrame:
    i = F.col("doc_id")
    return views.table(spark, d, "documents").where("source is not null and doc_id % 7 < 2").select(F.col("source").alias("ticker"), F.when(i % 3 == 0, "AFS").when(i % 3 == 1, "IAR").otherwise("INTERIM").alias("doc_type"), (2021 + i % 5).alias("year"))


@query(f"WITH {_HAVE_SQL} SELECT ticker, doc_type, year::BIGINT AS year FROM (SELECT DISTINCT ticker FROM h), (VALUES ('AFS'), ('IAR'), ('INTERIM')) AS k(doc_type), (VALUES (2023), (2024), (2025)) AS y(year) WHERE (ticker, doc_type, year) NOT IN (SELECT (ticker, doc_type, year) FROM h)")
def coverage_gaps(spark, d):
    return rel.coverage_gaps(_have(spark, d), ["ticker"], ["AFS", "IAR", "INTERIM"], [2023, 2024, 2025]).select("ticker", "doc_type", F.col("year").cast("bigint").alias("year"))


@query(f"WITH {_HAVE_SQL} SELECT doc_type, year::BIGINT AS year, count(*) AS n FROM h GROUP BY 1, 2")
def manifest_coverage(spark, d):
    _have(spark, d).createOrReplaceTempView("manifest_documents")
    return spark.sql("SELECT doc_type, year, count(*) AS n FROM manifest_documents GROUP BY doc_type, year ORDER BY year DESC, doc_type")


_CAND = [(1, "u/a#1", "AFS", 2024, "h1", 1), (2, "u/a#2", "AFS", 2024, "h1", 1), (3, "u/b", "UNKNOWN", 2024, "h2", 1), (4, "u/c", "IAR", 2019, "h3", 1), (5, "u/d", "IAR", None, "h4", 0), (6, "u/e", "IAR", 2024, "h1", 1), (7, "u/f", "IAR", 2024, "h9", 1), (8, "u/old", "IAR", 2024, "h8", 1), (9, "u/g", "ESG", None, "h7", 1)]


@query("SELECT * FROM (VALUES (1::BIGINT, 'stored'), (2, 'seen'), (3, 'unclassified'), (4, 'out_of_range'), (5, 'fetch_failed'), (6, 'duplicate'), (7, 'duplicate'), (8, 'seen'), (9, 'stored')) AS t(seq, status)")
def candidate_decisions(spark, d):
    """Golden vectors of the decision chain; the SQL holds the known results."""
    cand = _spark_lit(spark, _CAND, "seq, url, doc_type, year, sha256, fetched").withColumn("fetched", F.col("fetched") == 1)
    return filings.decisions(cand, _spark_lit(spark, ["u/old"], "url"), _spark_lit(spark, ["h9"], "sha256"), 2023, 2030).select("seq", "status")


@query("""SELECT o_orderkey::BIGINT AS doc, o_orderstatus AS statement_type, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'E' || o_custkey END AS entity_name, 'L' || l_linenumber AS source_label, l_linenumber % 2 = 0 AS is_total, y AS period,
CASE WHEN y = '2023' AND l_linenumber % 2 = 1 THEN -1 ELSE l_quantity END::DOUBLE AS value, CASE WHEN l_linenumber % 3 = 0 THEN 'low' ELSE 'medium' END AS confidence
FROM orders JOIN lineitem ON o_orderkey = l_orderkey, (VALUES ('2024'), ('2023')) AS t(y) WHERE o_orderkey % 4 <> 0""")
def json_flatten(spark, d):
    """Nested extractions made of orders and their lines; an unknown value is shown as -1."""
    line, n = F.col("l_linenumber"), F.col("l_quantity").cast("double")
    some = lambda p, v: F.struct(F.lit(p).alias("period"), v.alias("value"))
    item = F.struct(F.concat(F.lit("L"), line.cast("string")).alias("source_label"), F.when(line % 2 == 0, True).alias("is_subtotal_or_total"), F.array(some("2024", n), some("2023", F.when(line % 2 == 0, n))).alias("values"), F.when(line % 3 == 0, "low").alias("confidence"))
    lines = views.table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(item).alias("line_items"))  # an order's few lines
    o = views.table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    name = F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("E"), F.col("o_custkey").cast("string")))
    docs = o.select(F.col("o_orderkey").cast("long").alias("doc"), F.to_json(F.struct((F.col("o_orderkey") % 4 != 0).alias("page_contains_financial_statement"), F.col("o_orderstatus").alias("statement_type"), name.alias("entity_name"), "line_items")).alias("json"))
    out = filings.flatten(docs).withColumn("value", F.coalesce("value", F.lit(-1.0)))
    return out.select("doc", "statement_type", "entity_name", "source_label", "is_total", "period", "value", "confidence")


@query("SELECT event_id, json_extract(props, '$.k')::INT AS k, event_type FROM events")
def event_props(spark, d):
    return views.table(spark, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"), "event_type")


_NAMES = [("https://x.co/a/Annual%20Report%202024.PDF?x=1", "bvt", 2024, "AFS"), ("https://x.co/", "mtn", None, "IAR"), ("https://x.co/R%C3%A9sultats--finals!!.pdf", "shp", 2023, "PRES")]


@query("SELECT * FROM (VALUES ('bvt', 'BVT_2024_AFS_annual-report-2024.pdf'), ('mtn', 'MTN_UNDATED_IAR_document.pdf'), ('shp', 'SHP_2023_PRES_resultats-finals.pdf')) AS t(ticker, file_name)")
def file_names(spark, d):
    rows = _spark_lit(spark, _NAMES, "url, ticker, year, kind")
    return rows.select("ticker", text.build_file_name(F.col("ticker"), F.col("year"), F.col("kind"), text.url_file_name(F.col("url")), F.lit("pdf")).alias("file_name"))


@query("""SELECT page_id, k < 4 OR k = 6 AS ok, ['.pdf', '.zip', '.pptx', '.doc', '.html', '.html', '.pdf', ''][k + 1] AS extension,
CASE k WHEN 4 THEN 'HTML returned where a document was expected' WHEN 5 THEN 'login wall / challenge page' WHEN 6 THEN 'content-type trusted, no magic bytes' WHEN 7 THEN 'unrecognised payload' ELSE '' END AS reason FROM (SELECT page_id, (page_id % 8)::INT AS k FROM pages)""")
def payload_check(spark, d):
    """Payloads of all kinds: four by their first bytes, pages, a page that asks to sign in, an unknown one that is trusted, one that isn't."""
    k = (F.col("page_id") % 8).cast("int")
    heads = [F.lit(bytearray(x)) for x in (b"%PDF-1.4 ", b"PK\x03\x04", b"PK\x03\x04", b"\xd0\xcf\x11\xe0", b"<!DOCTYPE html> ", b"<html> Sign in ", b"q" * 2000, b"q" * 20)]
    content = F.element_at(F.array(*heads), k + 1)
    url = F.concat(F.lit("http://h.test/x"), F.when(k == 2, ".PPTX?y=1").otherwise(""))
    return views.table(spark, d, "pages").withColumn("v", text.validate_payload(content, F.lit("application/pdf"), url)).select("page_id", "v.*")


@query("SELECT o_orderkey::BIGINT AS o_orderkey, o_orderdate::DATE AS parsed FROM orders WHERE o_orderkey % 9 <> 8", dates=("parsed",))
def robust_dates(spark, d):
    """Order dates in eight spellings; a ninth is no date and goes."""
    day = F.to_date("o_orderdate")
    forms = [F.date_format(day, f) for f in ("yyyy-MM-dd", "dd/MM/yyyy", "d/M/yyyy", "dd-MM-yyyy", "dd.MM.yyyy", "d MMM yyyy", "MMM d, yyyy")]
    forms.append(F.concat(forms[0], F.lit(" 10:11:12")))
    raw = F.element_at(F.array(*forms, F.concat(F.lit("31/02/"), F.year(day).cast("string"))), (F.col("o_orderkey") % 9 + 1).cast("int"))
    return views.table(spark, d, "orders").select(F.col("o_orderkey").cast("long").alias("o_orderkey"), text.robust_date(raw).alias("parsed")).where("parsed is not null")


_CELLS = [("s.xlsx", "Income Statement", 0, 0, None, "Line item"), ("s.xlsx", "Income Statement", 0, 1, None, "MTN Group\nFY2024 (Restated) (Rm)"), ("s.xlsx", "Income Statement", 0, 2, None, "FY2025 (Rm)"), ("s.xlsx", "Income Statement", 1, 0, None, "Revenue"), ("s.xlsx", "Income Statement", 1, 1, 5, None), ("s.xlsx", "Income Statement", 1, 2, 7, None)]
_FLOW = [("c.xlsx", 0, 0, None, "Acme cash flow (US$ million)"), ("c.xlsx", 2, 0, None, "Item"), ("c.xlsx", 2, 1, 2022, None), ("c.xlsx", 2, 2, 2023, None), ("c.xlsx", 3, 0, None, "Interest paid"), ("c.xlsx", 3, 1, 4, None), ("c.xlsx", 3, 2, -6, None), ("c.xlsx", 4, 0, None, "Note 1"), ("c.xlsx", 5, 0, None, "Later"), ("c.xlsx", 5, 2, 9, None)]


@query("SELECT * FROM (VALUES ('MTN Group', 'Revenue', 2024::INT, true, 5.0::DOUBLE, 5000000.0::DOUBLE), ('s', 'Revenue', 2025, false, 7.0, 7000000.0)) AS t(entity_variant, line_item, year, restated, raw_value, value_zar)")
def statement_workbook(spark, d):
    cells = _spark_lit(spark, _CELLS, "file, sheet, row_idx, col_idx, num, str").withColumn("num", F.col("num").cast("double"))
    return filings.statement_sheet(cells).drop("file", "statement")


@query("SELECT * FROM (VALUES ('Interest paid', 2023::INT, -6.0::DOUBLE, -99000000.0::DOUBLE)) AS t(line_item, year, raw_value, value_zar)")
def cashflow_workbook(spark, d):
    cells = _spark_lit(spark, _FLOW, "file, row_idx, col_idx, num, str").withColumn("num", F.col("num").cast("double"))
    return filings.cashflow_sheet(cells).drop("file")


@query("SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1")
def visited_upsert(spark, d):
    c = views.table(spark, d, "conversations").select("conv_id", "turn", "role")
    return rel.upsert(c.where("turn % 2 = 0"), c.where("turn % 2 = 1"), ["conv_id"], "turn")


# ---- sources, sinks and selections --------------------------------------------------------------------------------------


@query(_with("SELECT entity_id, leg_type, count(*) AS n, sum(amount_zar::DECIMAL(20,4))::DOUBLE AS total, min(date) AS first_date FROM tb GROUP BY 1, 2"), dates=("first_date",))
def ledger_csv_round_trip(spark, d):
    """The payments written as CSV and found and read again as a ledger folder."""
    folder = scratch(spark)
    schema = "entity_id string, entity_name string, sector string, date date, leg_type string, amount_zar double"
    sinks.write_csv(views.transactional_banking(spark, d).select(*[f.split()[0] for f in schema.split(", ")]), f"{folder}/transactional_banking.csv")
    books = readers.load_ledgers(spark, folder, ["transactional_banking"], {"transactional_banking": schema})
    return books["transactional_banking"].groupBy("entity_id", "leg_type").agg(F.count(F.lit(1)).alias("n"), rel.money("amount_zar").alias("total"), F.min("date").alias("first_date"))


@query("SELECT (row_number() OVER (ORDER BY n_name) - 1)::INT AS place, n_name AS name, n_nationkey::BIGINT AS number FROM nation")
def csv_with_index(spark, d):
    path = scratch(spark)
    sinks.write_csv(views.table(spark, d, "nation").select("n_name", "n_nationkey"), path, [F.col("n_name")], {"index": "place", "n_name": "name", "n_nationkey": "number"})
    return spark.read.schema("place int, name string, number long").option("header", True).csv(path)


@query("SELECT c_custkey::BIGINT AS c_custkey, c_name, c_acctbal FROM customer")
def json_round_trip(spark, d):
    path = scratch(spark)
    sinks.write_json(views.table(spark, d, "customer").select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_acctbal"), path)
    return spark.read.schema("c_custkey long, c_name string, c_acctbal double").json(path)


@query("SELECT * FROM (VALUES ('rho', '0.3'), ('alpha', '0.1'), ('k0_no_data', '3.0'), ('default_log_var', '0.35'), ('floor', '1.0'), ('a0_min', '1.0'), ('unit_multiplier', '1000000.0'), ('reporting_months', '12'), ('default_observed_months', '12'), ('cashflow_min_year', '2023'), ('fx_to_zar', '{\"ZAR\": 1.0, \"USD\": 16.5, \"GBP\": 23.5, \"EUR\": 20.0}'), ('pillars', '[\"Transactional Banking\", \"Investment Banking\", \"Global Markets\"]'), ('book_pillar', '{\"transactional_banking\": \"Transactional Banking\", \"trade_finance\": \"Transactional Banking\", \"cross_border_payments\": \"Global Markets\"}')) AS t(name, value)")
def config_dump(spark, d):
    return spark.createDataFrame(wallet.config_rows(), "name string, value string")


@query(_with(_SIGNALS.strip() + _CEIL + " SELECT * FROM (SELECT 'ceiling' AS block, count(*) AS n FROM ceil UNION ALL SELECT 'config', 13) WHERE n > 0"))
def report_sheets(spark, d):
    """The five sheets written as folders; the settings sheet read again, by block."""
    folder = scratch(spark)
    sinks.write_sheets(wallet.report_sheets(spark, _ledger(spark, d), views.external_lines(spark, d)), folder)
    return spark.read.option("header", True).option("escape", '"').csv(f"{folder}/config").groupBy("block").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey::BIGINT AS c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'second' ELSE c_mktsegment END AS segment FROM customer")
def overlay_overrides(spark, d):
    c = views.table(spark, d, "customer").select(F.col("c_custkey").cast("long").alias("c_custkey"), F.col("c_mktsegment").alias("segment"))
    some = c.where("c_custkey % 7 = 0").select("c_custkey", F.posexplode(F.array(F.lit("first"), F.lit("second"))).alias("seq", "segment"))
    return readers.overlay(c, some.select("c_custkey", "segment", "seq"), "c_custkey")


@query("SELECT upper(trim(n_name)) AS ticker FROM nation WHERE n_nationkey % 3 <> 0")
def ticker_list(spark, d):
    path = scratch(spark)
    n = views.table(spark, d, "nation")
    n.select(F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("# "), "n_name")).otherwise(F.concat(F.lit(" "), F.lower("n_name"), F.lit(" # note"))).alias("value")).write.text(path)
    return readers.read_tickers(spark, path)


@query("SELECT r_regionkey::BIGINT AS r_regionkey, array_to_string(list_sort(list(n_name))[1:CASE WHEN count(*) <= 4 THEN 4 ELSE 3 END], '_') || CASE WHEN count(*) > 4 THEN '_+' || (count(*) - 3) || 'more' ELSE '' END AS stamp FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey = 1 GROUP BY 1")
def folder_stamp(spark, d):
    n = views.table(spark, d, "nation").where("n_regionkey = 1").select(F.col("n_name").alias("ticker"))
    return sinks.folder_stamp(n).select(F.lit(1).cast("long").alias("r_regionkey"), "stamp")


@query(_with(_PIVOT.replace("FROM tb GROUP", "FROM (SELECT * FROM tb WHERE date <= '1996-06-30') AS tb GROUP").strip() + _WINDOWS + _ASOF.replace("FROM tf GROUP", "FROM tf WHERE date <= '1996-06-30' GROUP") + _XB.replace("FROM xb GROUP", "FROM xb WHERE date <= '1996-06-30' GROUP") + " SELECT entity_id, week, days_to_next_tf_maturity, next_tf_maturity_value, xborder_volume FROM feat"), dates=("week",))
def features_as_of(spark, d):
    """What was known at a day: later rows of all books are hidden."""
    out = cashcycle.weekly_features(views.transactional_banking(spark, d), views.trade_finance(spark, d), views.cross_border_payments(spark, d), as_of="1996-06-30")
    return out.select("entity_id", "week", "days_to_next_tf_maturity", "next_tf_maturity_value", "xborder_volume")


_STALE = f", cp AS (SELECT entity_id, s::DATE AS s FROM (VALUES {_lit(_CHECKPOINT)}) AS t(entity_id, s)), lt AS (SELECT entity_id, max(week) AS latest FROM feat GROUP BY 1), st AS (SELECT entity_id, latest, s FROM lt LEFT JOIN cp USING (entity_id) WHERE coalesce(latest > s, true))"


def _checkpoint(spark) -> DataFrame:
    return _spark_lit(spark, _CHECKPOINT, "entity_id, s").select("entity_id", F.to_date("s").alias("last_seen"))


@query(_with(_PIVOT.strip() + _WINDOWS + _ASOF + _XB + _STALE + " SELECT entity_id, week, round(net_cash, 4) AS net_cash FROM feat SEMI JOIN st USING (entity_id)"), dates=("week",))
def stale_history(spark, d):
    return cashcycle.stale_history(_features(spark, d), _checkpoint(spark)).select("entity_id", "week", "net_cash")


@query(_with(_PIVOT.strip() + _WINDOWS + _ASOF + _XB + _STALE + " SELECT entity_id, max(v) AS last_seen FROM (SELECT entity_id, s AS v FROM cp UNION ALL SELECT entity_id, latest FROM st) GROUP BY 1"), dates=("last_seen",))
def checkpoint_advance(spark, d):
    return cashcycle.advanced(_features(spark, d), _checkpoint(spark))


@query(_with(_PIVOT.strip() + _WINDOWS + _ASOF + _XB + ", lt AS (SELECT entity_id, max(week) AS last_seen FROM feat GROUP BY 1) SELECT entity_id, last_seen, 1::INT AS scored FROM lt"), dates=("last_seen",))
def orchestrator_run(spark, d):
    """A first run of the cycle with few rounds: every client is scored once and has its checkpoint written."""
    folder = scratch(spark)
    scores, _ = cashcycle.run(_features(spark, d), folder, trees=3, timing_trees=3)
    scored = scores.where("engagement_score between 0 and 1 and engage_next_week = cast(engagement_score >= 0.5 as int)").groupBy("entity_id").agg(F.count(F.lit(1)).cast("int").alias("scored"))
    return spark.read.parquet(f"{folder}/checkpoint").join(scored, "entity_id").select("entity_id", "last_seen", "scored")


@query(_with(_PIVOT.strip() + _WINDOWS + _ASOF + _XB + " SELECT round(avg(abs(target_next_collections - collections_lag1)) FILTER (target_next_payments IS NOT NULL AND target_next_collections IS NOT NULL), 2) AS train_mae_inflow_zar, round(avg(abs(target_next_payments - supplier_payments_lag1)) FILTER (target_next_payments IS NOT NULL AND target_next_collections IS NOT NULL), 2) AS train_mae_outflow_zar, round(avg((coalesce(collections_lag1 - supplier_payments_lag1 > greatest(net_cash_roll4_mean, 0), false) OR tf_maturity_within_30d = 1)::INT), 6) AS positive_rate FROM feat"))
def forecast_errors(spark, d):
    """The training figures of a forecast that says what was a week before."""
    rows = _features(spark, d).withColumns({"forecast_next_collections": F.col("collections_lag1"), "forecast_next_payments": F.col("supplier_payments_lag1"), "forecast_net_cash": F.col("collections_lag1") - F.col("supplier_payments_lag1")})
    return _r(_r(cashcycle.errors(rows), "positive_rate"), "train_mae_inflow_zar", "train_mae_outflow_zar", n=2)


@query("SELECT n_nationkey::INT AS place, rpad((n_nationkey + 1)::VARCHAR, 3, ' ') || rpad(n_name, 30, ' ') || lpad('R' || format('{:,}', 1000 * n_nationkey::BIGINT), 26, ' ') || lpad(format('{:.2f}', 1 - n_nationkey / 100), 19, ' ') || lpad(CASE WHEN n_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END, 10, ' ') AS line FROM nation WHERE n_nationkey < 15")
def leaderboard_lines(spark, d):
    k = F.col("n_nationkey")
    scores = views.table(spark, d, "nation").select(F.format_string("E%02d", k).alias("entity_id"), F.col("n_name").alias("entity_name"), (k * 1000.0).alias("forecast_net_cash"), (1 - k / 100).alias("engagement_score"), (k % 2 == 0).cast("int").alias("engage_next_week"))
    return cashcycle.leaderboard_lines(scores).select((F.col("place") - 1).cast("int").alias("place"), "line")


_ASKED = ("e03", "united s", "an", "  CANADA ", "nobody", "")


@query(_with("a AS (SELECT * FROM (VALUES " + _lit([(q, q.strip().lower()) for q in _ASKED]) + ") AS t(asked, q)), m AS (SELECT asked, max(entity_id) FILTER (lower(entity_id) = q) AS i, count(DISTINCT entity_id) FILTER (q <> '' AND contains(lower(entity_name), q)) AS matches, max(entity_id) FILTER (q <> '' AND contains(lower(entity_name), q)) AS o FROM a, entity GROUP BY 1) SELECT asked, coalesce(i, CASE WHEN matches = 1 THEN o END) AS entity_id, matches FROM m"))
def client_lookup(spark, d):
    clients = views.entity(spark, d)
    return reduce(DataFrame.unionByName, [cashcycle.find_client(clients, q) for q in _ASKED])


@query(_with("SELECT DISTINCT entity_name FROM ledger WHERE entity_name IS NOT NULL"))
def client_names(spark, d):
    return wallet.client_names(_books(spark, d))


@query(_with("SELECT 'transactional_banking' AS source_file, count(DISTINCT entity_id) AS clients, count(DISTINCT entity_name) AS names, min(date) AS first_date, max(date) AS last_date, count(*) AS n FROM tb UNION ALL SELECT 'trade_finance', count(DISTINCT entity_id), count(DISTINCT entity_name), min(date), max(date), count(*) FROM tf UNION ALL SELECT 'cross_border_payments', count(DISTINCT entity_id), count(DISTINCT entity_name), min(date), max(date), count(*) FROM xb"), dates=("first_date", "last_date"))
def book_profile(spark, d):
    return diagnostics.profile(_books(spark, d))


@query(_with("SELECT entity_name, count(*) AS n FROM tb GROUP BY 1"))
def name_counts(spark, d):
    return rel.value_counts(views.transactional_banking(spark, d), "entity_name")


@query(_with("SELECT entity_id, " + ", ".join(f"max(n) FILTER (pillar = '{p}') AS \"{p}\"" for p in CONFIG.pillars) + " FROM (SELECT entity_id, pillar, count(*) AS n FROM ledger GROUP BY 1, 2) GROUP BY 1"))
def pivot_once(spark, d):
    known = _facts(spark, d).groupBy("entity_id", "pillar").agg(F.sum("n").alias("n"))
    return rel.pivot_unique(known, "entity_id", "pillar", "n", list(CONFIG.pillars))


@query("SELECT l_orderkey::BIGINT AS l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 25 AND l_linenumber <> 3")
def positive_values(spark, d):
    """Values that come as text, some of them no numbers."""
    n = F.col("l_linenumber")
    text_value = F.when(n == 3, "n/a").otherwise((F.col("l_quantity") - 25).cast("string"))
    rows = views.table(spark, d, "lineitem").select(F.col("l_orderkey").cast("long").alias("l_orderkey"), n.cast("long").alias("l_linenumber"), text_value.alias("v"))
    return diagnostics.positive(rows, "v").select("l_orderkey", "l_linenumber", (F.col("v") + 25).alias("l_quantity"))


# ---- documents, links and files -------------------------------------------------------------------------------------------


@query("SELECT doc_id, contains(lower(text), 'license') OR contains(lower(text), 'the ') AS relevant, length(regexp_replace(text, '^[ ]+|[ ]+$', '', 'g')) >= 30 AND len(regexp_extract_all(text, '\\(cid:')) <= 5 AS reliable FROM documents")
def page_checks(spark, d):
    t = F.col("text")
    return views.table(spark, d, "documents").select("doc_id", filings.relevant(t, ("license", "the ")).alias("relevant"), filings.reliable(t).alias("reliable"))


_KINDS = ("Annual Report", "Results presentation", "AFS", "Integrated report", "Notice")


@query("SELECT page_id, 'x' || text AS text FROM (SELECT page_id, ['Annual Report', 'Results presentation', 'AFS', 'Integrated report', 'Notice'][(page_id % 5 + 1)::INT] || ' ' || (2020 + page_id % 7) AS text FROM pages) WHERE regexp_matches(text, '(Annual|Integrated) [Rr]eport|AFS') AND right(text, 4) IN ('2023', '2024', '2025')")
def report_links(spark, d):
    kind = F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (F.col("page_id") % 5 + 1).cast("int"))
    links = views.table(spark, d, "pages").select("page_id", F.concat(kind, F.lit(" "), (2020 + F.col("page_id") % 7).cast("string")).alias("text"))
    return filings.report_links(links).withColumn("text", F.concat(F.lit("x"), "text"))


_LINKS_SQL = "(SELECT page_id, ['  see ' || link || ' and ' || link || ' of ' || day, 'none ' || upper(link) || ') ' || day, day || ' https://elsewhere.test/documents/2024/x.pdf'][(page_id % 3 + 1)::INT] AS body, page_id % 3 AS k, link FROM (SELECT page_id, 'https://senspdf.jse.co.za/documents/' || (2000 + page_id % 30) || '/A/' || page_id || '.pdf' AS link, lpad((1 + page_id % 31)::VARCHAR, 2, '0') || '-' || lpad((1 + page_id % 12)::VARCHAR, 2, '0') || '-' || (2000 + page_id % 90) AS day FROM pages))"


@query(f"SELECT page_id, CASE k WHEN 0 THEN link WHEN 1 THEN upper(link) ELSE '' END AS links, try_cast((2000 + page_id % 90) || '-' || lpad((1 + page_id % 12)::VARCHAR, 2, '0') || '-' || lpad((1 + page_id % 31)::VARCHAR, 2, '0') AS DATE) AS day FROM {_LINKS_SQL}", dates=("day",))
def announcements(spark, d):
    """Links and dates in announcements made from the page numbers."""
    i = F.col("page_id")
    two = lambda n: F.lpad((1 + i % n).cast("string"), 2, "0")
    link = F.concat(F.lit("https://senspdf.jse.co.za/documents/"), (2000 + i % 30).cast("string"), F.lit("/A/"), i.cast("string"), F.lit(".pdf"))
    day = F.concat_ws("-", two(31), two(12), (2000 + i % 90).cast("string"))
    body = F.when(i % 3 == 0, F.concat(F.lit("  see "), link, F.lit(" and "), link, F.lit(" of "), day)).when(i % 3 == 1, F.concat(F.lit("none "), F.upper(link), F.lit(") "), day)).otherwise(F.concat(day, F.lit(" https://elsewhere.test/documents/2024/x.pdf")))
    rows = views.table(spark, d, "pages").withColumn("body", body)
    return rows.select("page_id", F.array_join(text.sens_links(F.col("body")), " ").alias("links"), text.sens_date(F.col("body")).alias("day"))


@query(r"""SELECT doc_id, left(regexp_replace(regexp_replace(regexp_replace(text, '[\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'), '^ | $', '', 'g'), '[<>:"/\\|?*\[\]]', '', 'g'), 60) AS name, regexp_replace(left(text, 40), '[^\p{L}\p{N} _-]', '', 'g') AS note FROM documents""")
def safe_names(spark, d):
    t = F.col("text")
    return views.table(spark, d, "documents").select("doc_id", text.safe_file_name(t).alias("name"), sinks.note_name(F.substring(t, 1, 40)).alias("note"))


@query("SELECT doc_id, greatest(2000 + doc_id % 30, 2010 + doc_id % 13)::INT AS year, (make_date(2000 + doc_id % 30, CASE WHEN source = 'web' THEN 2 ELSE 12 END, 1) + INTERVAL 1 MONTH - INTERVAL 1 DAY)::DATE AS closes FROM documents", dates=("closes",))
def file_years(spark, d):
    i = F.col("doc_id")
    name = F.concat(F.lit("r_"), (2010 + i % 13).cast("string"), F.lit("-v"), (2000 + i % 30).cast("string"), F.lit(".pdf"))
    return views.table(spark, d, "documents").select("doc_id", text.file_year(name).alias("year"), text.fiscal_year_end(F.col("source"), (2000 + i % 30).cast("int"), {"WEB": 2}).alias("closes"))


_FILES_SQL = "f AS (SELECT source AS ticker, 'f' || doc_id || '.pdf' AS name, CASE WHEN doc_id % 4 <> 0 THEN 2015 + doc_id % 9 END AS year, doc_id AS place FROM documents WHERE source IS NOT NULL), sel AS (SELECT ticker, CASE WHEN place % 3 = 0 THEN name ELSE 'unknown' END AS name FROM f WHERE place % 10 = 0 AND length(ticker) % 2 = 0)"


@query(f"WITH {_FILES_SQL}, m AS (SELECT f.*, (ticker, name) IN (SELECT (ticker, name) FROM sel) AS asked FROM f), g AS (SELECT *, bool_or(asked) OVER (PARTITION BY ticker) AS found FROM m) SELECT ticker, name, coalesce(year, 0)::INT AS year, place FROM g WHERE asked = found QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY CASE WHEN found THEN place ELSE -coalesce(year, 0) END, place) <= 3")
def chosen_files(spark, d):
    i = F.col("doc_id")
    files = views.table(spark, d, "documents").where("source is not null").select(F.col("source").alias("ticker"), F.concat(F.lit("f"), i.cast("string"), F.lit(".pdf")).alias("name"), F.when(i % 4 != 0, 2015 + i % 9).cast("int").alias("year"), i.alias("place"))
    selected = files.where("place % 10 = 0 and length(ticker) % 2 = 0").select("ticker", F.when(F.col("place") % 3 == 0, F.col("name")).otherwise("unknown").alias("name"))
    return filings.chosen_files(files, selected).withColumn("year", F.coalesce("year", F.lit(0)))


@query(r"""WITH f AS (SELECT r_name AS ticker, n_name || '.pdf' AS name, n_nationkey AS seq FROM nation JOIN region ON n_regionkey = r_regionkey) SELECT ticker, name, row_number() OVER (PARTITION BY ticker ORDER BY -seq)::INT AS place FROM f WHERE seq % 5 <> 0""")
def named_files(spark, d):
    """Answers that list a region's nations, the last first, with bullets, twice."""
    f = views.entity(spark, d).select(F.col("sector").alias("ticker"), F.concat("entity_name", F.lit(".pdf")).alias("name"), F.col("nation").alias("seq"))
    rows = F.transform(F.reverse(F.array_sort(F.collect_list(F.struct("seq", "name")))), lambda x: F.concat(F.lit(" - 1) "), x["name"], F.lit(" fits")))
    answers = f.where("seq % 5 <> 0").groupBy("ticker").agg(F.array_join(F.concat(rows, rows), "\r\n").alias("text"))
    return filings.named_files(answers, f)


@query("SELECT conv_id, turn, role FROM conversations WHERE turn % 2 = 1 AND conv_id NOT IN (SELECT conv_id FROM conversations WHERE turn % 2 = 0 AND conv_id % 3 = 0)")
def manifest_append(spark, d):
    """What a manifest lacks is appended to it."""
    c = views.table(spark, d, "conversations").select("conv_id", "turn", "role")
    path = scratch(spark)
    old = c.where("turn % 2 = 0 and conv_id % 3 = 0").withColumn("url", F.col("conv_id"))
    sinks.append_manifest(old, c.where("turn % 2 = 1").withColumn("url", F.col("conv_id")), path)
    return spark.read.parquet(path).drop("url")


_ITEMS = "it AS (SELECT l_orderkey AS doc, l_linenumber AS page, l_returnflag AS concept, l_discount * 10 AS confidence, l_linenumber % 2 AS origin, l_partkey AS line FROM lineitem)"


@query(f"WITH {_ITEMS}, b AS (SELECT * FROM it QUALIFY row_number() OVER (PARTITION BY doc, concept ORDER BY confidence DESC, page, origin, line) = 1) SELECT doc::BIGINT AS doc, concept, page::BIGINT AS page, line::BIGINT AS line, confidence < 0.8 AS low FROM b")
def best_items(spark, d):
    c = lambda n, a: F.col(n).cast("long").alias(a)
    items = views.table(spark, d, "lineitem").select(c("l_orderkey", "doc"), c("l_linenumber", "page"), F.col("l_returnflag").alias("concept"), (F.col("l_discount") * 10).alias("confidence"), (F.col("l_linenumber") % 2).alias("origin"), c("l_partkey", "line"))
    best = filings.best_items(items)
    low = filings.low_confidence(best).select("doc", "concept", F.lit(True).alias("low"))
    return best.join(low, ["doc", "concept"], "left").select("doc", "concept", "page", "line", F.coalesce("low", F.lit(False)).alias("low"))


@query("SELECT s_suppkey::BIGINT AS doc, 'revenue' AS concept, round((s_suppkey * 1000 + 500) * 1e6, 2)::DOUBLE AS scaled_value, CASE WHEN s_suppkey % 2 = 0 THEN 0.9 ELSE 0.8 END::DOUBLE AS confidence FROM supplier UNION ALL SELECT s_suppkey, 'total_assets', -(s_suppkey * 1000 + 500) * 1e6, 0.95 FROM supplier")
def extracted_rows(spark, d):
    """A page for each supplier: revenue as a row of words, for every other one also as the same row of a table; total assets in words."""
    s = views.table(spark, d, "supplier").select(F.col("s_suppkey").cast("long").alias("doc"), F.lit(1).alias("page"))
    k = F.concat(F.col("doc").cast("string"), F.lit("500"))
    word = lambda t, x0, x1, top: F.struct(t.alias("text"), F.lit(float(x0)).alias("x0"), F.lit(float(x1)).alias("x1"), F.lit(float(top)).alias("top"), F.lit(top + 10.0).alias("bottom"))
    words = s.select("doc", "page", F.explode(F.array(word(F.lit("Revenue"), 10, 60, 100), word(k, 200, 240, 101), word(F.lit("Total"), 10, 40, 130), word(F.lit("assets"), 43, 80, 130), word(F.concat(F.lit("("), k, F.lit(")")), 200, 240, 130))).alias("w")).select("doc", "page", "w.*")
    tables = s.where("doc % 2 = 0").select("doc", "page", F.lit(0).alias("line"), F.array(F.lit("Revenue "), k).alias("cells"))
    pages = s.withColumns({"multiplier": F.lit(1e6), "scale_label": F.lit("millions")})
    return filings.extract_rows(tables, words, pages).select("doc", "concept", F.round("scaled_value", 2).alias("scaled_value"), "confidence")


@query("SELECT n_name AS entity_variant, 'Revenue' AS line_item, 2024::INT AS year, n_nationkey::DOUBLE * 1e6 AS value_zar FROM nation WHERE n_nationkey < 4 UNION ALL SELECT 'Cash ' || replace(n_name, '_', ' '), 'Interest paid', 2023, -n_nationkey * 16.5e6 FROM nation WHERE n_nationkey < 4")
def workbook_lines(spark, d):
    """Two workbooks for each of four nations, written, found, read and told apart by their sheets; a sheet README names the entity."""
    folder = scratch(spark)
    for r in views.table(spark, d, "nation").where("n_nationkey < 4").collect():
        name, k = r["n_name"], r["n_nationkey"]
        sinks.write_workbook(spark, f"{folder}/{k}_Financial_Extraction.xlsx", {"README": [[f"{name} — Financial Extraction"]], "Income Statement": [["Line item", "FY2024 (Rm)"], ["Revenue", float(k)]]})
        sinks.write_workbook(spark, f"{folder}/Cash_{name}.xlsx", {"Sheet1": [["Cash flow (US$ million)"], ["Item", 2022.0, 2023.0], ["Interest paid", 1.0, float(-k)], ["Note 1"], ["Later", 5.0, 5.0]]})
    return filings.external_lines(readers.read_workbooks(spark, folder)).select("entity_variant", "line_item", "year", "value_zar")


@query("SELECT page_id, 'financial_risk_management' AS note, substring(t, 100 + page_id % 80 + 2 - 100, 100 + 41 + 600) AS excerpt FROM (SELECT page_id, repeat('x', (100 + page_id % 80)::INT) || ' financial risk management and market risk ' || repeat('y', 700) AS t FROM pages WHERE page_id % 2 = 0)")
def note_excerpts(spark, d):
    """Every other page mentions a note: a hundred signs ahead of it and six hundred behind are shown."""
    i = F.col("page_id")
    body = F.concat(F.expr("repeat('x', cast(100 + page_id % 80 as int))"), F.when(i % 2 == 0, " financial risk management and market risk ").otherwise(" nothing of note "), F.lit("y" * 700))
    pages = views.table(spark, d, "pages").select(i.alias("doc"), F.lit(1).alias("page"), body.alias("text"))
    return filings.note_hits(pages).select(F.col("doc").alias("page_id"), "note", "excerpt")
