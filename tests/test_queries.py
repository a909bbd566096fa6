"""Every registered query of the plans beside its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from ledgerloom.plans.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"


def _norm(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    return repr(round(float(v), 4)) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, con, name):
    df = QUERIES[name](spark, DATA)
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted(tuple(_norm(r[cols.index(c)]) for c in df.columns) for r in cur.fetchall())
    got = sorted(tuple(_norm(v) for v in r) for r in df.collect())
    assert got == want


def test_portfolio_invariants(spark):
    rows = QUERIES["portfolio"](spark, DATA).collect()
    assert sorted(r["opportunity_rank"] for r in rows) == list(range(1, len(rows) + 1))
    assert all(r["taw_lo_zar"] >= r["captured_zar"] - 1e-6 for r in rows)
    detail = QUERIES["pillar_detail"](spark, DATA).collect()
    assert all(r["hi"] >= r["lo"] for r in detail)


def test_forecast(spark):
    rows = QUERIES["forecast_leaderboard"](spark, DATA).collect()
    assert 0 < len(rows) <= 15 and all(0 <= r["engagement_score"] <= 1 for r in rows)
