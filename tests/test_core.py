import datetime as dt
import io
import zipfile
from pathlib import Path
from urllib.parse import urljoin

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import boosting, rules, text
from ledgerloom.operators import relational as rel
from ledgerloom.operators import staging
from ledgerloom.plans import cashcycle, diagnostics, filings, wallet
from ledgerloom.plans.queries import QUERIES
from ledgerloom.sources import readers, sinks
from ledgerloom.streaming.weekly import weekly_sums


def test_student_t():
    df = np.array([2.0, 3.0, 10.0, 100.0, 59999.0, 2.5])
    got = wallet.student_t(np.full(6, 0.05), df)
    assert np.allclose(got[:5], [-2.919986, -2.353363, -1.812461, -1.660234, -1.644879], atol=2e-5) and got[0] < got[5] < got[1]


def test_week_starts_on_tuesday(spark):
    row = spark.sql("SELECT date'2024-01-01' AS a, date'2024-01-02' AS b").select(rel.tuesday(F.col("a")).alias("a"), rel.tuesday(F.col("b")).alias("b")).first()
    assert row == (dt.date(2023, 12, 26), dt.date(2024, 1, 2))


def test_prior_cases(spark):
    d = dt.date(2024, 1, 1)
    rows = [("A", "a", "s", "Transactional Banking", "x", d, 100.0), ("B", "b", "s", "Transactional Banking", "x", d, 0.5), ("B", "b", "s", "Transactional Banking", "x", d, 10.0)]
    ledger = spark.createDataFrame(rows, "entity_id string, entity_name string, sector string, pillar string, source_file string, date date, value_zar double")
    got = {(r["entity_id"], r["pillar"]): r for r in wallet.internal_prior(wallet.facts(ledger)).collect()}
    assert got["A", "Global Markets"][2:] == (0, 1.0, 0.0, 3.0, 1.5, 1.5 * 0.35)
    assert got["A", "Transactional Banking"]["b0"] == 0.35 and got["A", "Transactional Banking"]["k0"] == 1.0
    two = got["B", "Transactional Banking"]
    assert two["a0"] == 1.0 and abs(two["b0"] - np.var([0, np.log(10)], ddof=1) / 2) < 1e-12 and two["captured"] == 10.5


def test_asof_none_ahead_and_ties(spark):
    left = spark.sql("SELECT 'a' AS k, date'2024-01-02' AS week UNION ALL SELECT 'a', date'2024-02-06' UNION ALL SELECT 'b', date'2024-01-02'")
    right = spark.sql("SELECT 'a' AS k, date'2024-01-02' AS m, 7D AS v UNION ALL SELECT 'a', date'2024-01-02', 3D")
    got = {(r["k"], str(r["week"])): (r["next_date"], r["next_value"]) for r in rel.asof_forward(left, right, "k", "week", "m", "v").collect()}
    assert got == {("a", "2024-01-02"): (dt.date(2024, 1, 2), 3.0), ("a", "2024-02-06"): (None, None), ("b", "2024-01-02"): (None, None)}


def test_windows_need_four_rows(spark):
    weeks = [("A", "a", "s", dt.date(2024, 1, 2) + dt.timedelta(7 * i), float(i), 1.0, 0.0, 0.0, 0.0, i - 1.0) for i in range(6)]
    df = spark.createDataFrame(weeks, "entity_id string, entity_name string, sector string, week date, collections double, supplier_payments double, intercompany_sweeps double, payroll double, tax double, net_cash double")
    got = cashcycle.with_windows(df).orderBy("week").collect()
    assert [r["collections_roll4_mean"] for r in got] == [None] * 4 + [1.5, 2.5] and got[-1]["target_next_collections"] is None
    assert abs(got[4]["net_cash_roll4_std"] - np.std([0, 1, 2, 3], ddof=1)) < 1e-12


def test_classify_fixture_labels(spark):
    want = {"Finance costs paid": ("Global Markets", 12.5), "Net foreign exchange gain": ("Global Markets", 50.0), "Investments": ("Investment Banking", 1.0), "Net cash generated from operations": (None, None), "Revenue": ("ceiling_only", 1.0), "Revenue growth": (None, None)}
    df = spark.createDataFrame([(k,) for k in want], "t string").select("t", rules.classify_line_item(F.col("t")).alias("c"))
    assert {r["t"]: tuple(r["c"])[:2] for r in df.collect()} == want and all(r["c"]["note"] for r in df.collect())


def test_notes_and_links(spark):
    page = spark.createDataFrame([("d", 1, "x" * 200 + " financial risk management covers the foreign currency exposure " + "y" * 900)], "doc string, page int, text string")
    got = {r["note"]: r["excerpt"] for r in filings.note_hits(page).collect()}
    assert set(got) == {"financial_risk_management", "foreign_currency_exposure"} and all(len(v) < 800 for v in got.values())
    row = spark.sql("SELECT 'https://a.co/reports/x.pdf?y=1' AS u, 'https://a.co/login' AS v").select(filings.worth_following(F.col("u"), F.lit("")), filings.worth_following(F.col("v"), F.lit("annual")), text.downloadable(F.col("u")), text.downloadable(F.col("v"))).first()
    assert tuple(row) == (True, False, True, False)


def test_payloads(spark):
    rows = [(b"%PDF-1.4", "", "u", True, ".pdf"), (b"PK\x03\x04zz", "", "a.XLSX", True, ".xlsx"), (b"\xd0\xcf\x11\xe0", "", "u", True, ".doc"), (b"<!DOCTYPE html> Sign in", "application/pdf", "u", False, ".html"), (b"q" * 2000, "application/pdf", "u", True, ".pdf"), (b"q", "application/pdf", "u", False, "")]
    df = spark.createDataFrame([r[:3] for r in rows], "c binary, k string, u string").select(text.validate_payload(F.col("c"), F.col("k"), F.col("u")).alias("v"))
    assert [(r["v"]["ok"], r["v"]["extension"]) for r in df.collect()] == [r[3:] for r in rows]


def test_workbook_reader(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="Income Statement" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Line item</t></si><si><t>FY2024 (Rm)</t></si><si><t>Revenue</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row><row r="2"><c r="A2" t="s"><v>2</v></c><c r="B2"><v>5</v></c></row></sheetData></worksheet>')
    (tmp_path / "BHP_Financial_Extraction.xlsx").write_bytes(buf.getvalue())
    cells = readers.read_workbooks(spark, str(tmp_path))
    assert readers.workbook_format(cells).first()["format"] == "statement"
    row = filings.statement_sheet(cells).first()
    assert (row["entity_variant"], row["line_item"], row["year"], row["value_zar"]) == ("BHP", "Revenue", 2024, 5e6)


def test_sources_and_sinks(spark, tmp_path):
    assert readers.find_source(["A.XLSX", "b.csv"], "a") == "A.XLSX" and readers.find_source(["x"], "a") is None
    (tmp_path / "t.txt").write_text("bvt # x\n\n# y\nmtn\n")
    tickers = readers.read_tickers(spark, str(tmp_path / "t.txt"))
    assert sorted(r[0] for r in tickers.collect()) == ["BVT", "MTN"] and sinks.folder_stamp(tickers).first()[0] == "BVT_MTN"
    df = spark.createDataFrame([("b", 2.0), ("a", 1.0)], "k string, v double")
    sinks.write_csv(df, str(tmp_path / "out"), [F.col("k")])
    back = spark.read.option("header", True).csv(str(tmp_path / "out")).orderBy("index").collect()
    assert [tuple(r) for r in back] == [("0", "a", "1.0"), ("1", "b", "2.0")]
    over = readers.overlay(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), spark.createDataFrame([("a", 2, 1), ("a", 3, 2)], "k string, v int, seq int"), "k")
    assert {tuple(r) for r in over.collect()} == {("a", 3), ("b", 1)}


def test_streaming_weeks(spark, tmp_path):
    rows = spark.sql("SELECT 'a' AS entity_id, timestamp'2024-01-01 10:00:00' AS ts, 1D AS amount UNION ALL SELECT 'a', timestamp'2024-01-02 00:00:00', 2D")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = weekly_sums(stream).writeStream.format("memory").queryName("weeks").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert {(str(r["week"]), r["amount"]) for r in spark.table("weeks").collect()} == {("2023-12-26", 1.0), ("2024-01-02", 2.0)}


def _weeks(spark, clients=6, weeks=30, extra=0):
    """Payments and maturities by rule: client i's collections rise by i a week."""
    start = dt.date(2023, 1, 3)
    rows = [(f"E{i}", f"Client {i}", "s", start + dt.timedelta(7 * w), leg, 100.0 + 10 * i + (i * w if leg == "collections" else 3.0 * (w % 4))) for i in range(clients) for w in range(weeks + (extra if i == 0 else 0)) for leg in ("collections", "supplier_payments")]
    payments = spark.createDataFrame(rows, "entity_id string, entity_name string, sector string, date date, leg_type string, amount_zar double")
    trade = spark.createDataFrame([(f"E{i}", f"Client {i}", "s", start, 5.0, 70 * i) for i in range(clients)], "entity_id string, entity_name string, sector string, date date, value_zar double, tenor_days int")
    return cashcycle.weekly_features(payments, trade, payments.select("entity_id", "entity_name", "sector", "date", F.col("amount_zar").alias("value_zar")))


def test_forecast_fits_the_whole_job(spark, monkeypatch):
    asked, real = [], cashcycle.boosting.fit
    monkeypatch.setattr(cashcycle.boosting, "fit", lambda x, y, rounds, depth, rate, *a, **k: asked.append((x.shape, float(np.mean(y)), rounds, depth, rate)) or real(x, y, 2, depth, rate, *a, **k))
    features = _weeks(spark)
    models, figures = cashcycle.train(features)
    n, known = features.count(), features.where("target_next_collections is not null").count()
    assert [(a[0], *a[2:]) for a in asked] == [((known, 20), 300, 4, 0.05)] * 2 + [((n, 23), 250, 3, 0.07)]
    rows = cashcycle.with_forecasts(features, models.inflow, models.outflow).collect()
    label = [r["forecast_net_cash"] > max(r["net_cash_roll4_mean"], 0) or r["tf_maturity_within_30d"] == 1 for r in rows]
    seen = [r for r in rows if r["target_next_collections"] is not None]
    assert np.isclose(asked[2][1], np.mean(label)) and np.isclose(figures["positive_rate"], np.mean(label)) and 0 <= figures["train_auc"] <= 1
    assert np.isclose(figures["train_mae_inflow_zar"], np.mean([abs(r["target_next_collections"] - r["forecast_next_collections"]) for r in seen]))


def test_orchestrator_goes_on_from_its_checkpoint(spark, tmp_path):
    folder = f"file://{tmp_path}/run"
    scores, figures = cashcycle.run(_weeks(spark), folder, trees=40, timing_trees=5)
    assert scores.count() == 6 and figures["train_mae_inflow_zar"] < 40
    first = cashcycle.load_models(spark, folder)
    _, again = cashcycle.run(_weeks(spark), folder, trees=40, timing_trees=5)
    assert again is None and cashcycle.load_models(spark, folder).inflow.feature.shape == first.inflow.feature.shape
    scores, figures = cashcycle.run(_weeks(spark, extra=2), folder, trees=7, timing_trees=5)
    assert figures is not None and cashcycle.load_models(spark, folder).inflow.feature.shape[0] == first.inflow.feature.shape[0] + 7
    seen = {(r["entity_id"], str(r["last_seen"])) for r in spark.read.parquet(f"{folder}/checkpoint").groupBy("entity_id").agg(F.max("last_seen").alias("last_seen")).collect()}
    assert ("E0", "2023-08-08") in seen and ("E1", "2023-07-25") in seen and len(seen) == 6


def test_boosting_against_brute_force():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 9, (60, 3)).astype(float)
    x[rng.random(x.shape) < 0.2] = np.nan
    y = rng.normal(size=60) + np.nan_to_num(x[:, 1])
    one = boosting.fit(x, y, 1, 1, 1.0, rows=1.1, columns=1.0)
    g = y.mean() - y
    best = (-1, None)
    for j in range(3):
        for cut in np.unique(x[~np.isnan(x[:, j]), j])[:-1]:
            for unknown in (False, True):
                left = np.where(np.isnan(x[:, j]), unknown, x[:, j] <= cut)
                if 0 < left.sum() < 60:
                    gain = g[left].sum() ** 2 / (left.sum() + 1) + g[~left].sum() ** 2 / ((~left).sum() + 1)
                    best = max(best, (gain, (j, cut, unknown)), key=lambda b: b[0])
    j, cut, unknown = best[1]
    left = np.where(np.isnan(x[:, j]), unknown, x[:, j] <= cut)
    want = np.where(left, -g[left].sum() / (left.sum() + 1), -g[~left].sum() / ((~left).sum() + 1)) + y.mean()
    assert np.allclose(one.predict(x), want)
    more = boosting.fit(x, y, 30, 3, 0.3, start=None)
    twice = boosting.fit(x, y, 10, 3, 0.3, start=more)
    assert np.abs(twice.predict(x) - y).mean() < np.abs(more.predict(x) - y).mean() < np.abs(y - y.mean()).mean() / 2
    assert np.array_equal(boosting.Trees.from_json(twice.to_json()).predict(x), twice.predict(x))
    s, t = np.round(rng.random(50), 1), rng.integers(0, 2, 50)
    pairs = [(a > b) + (a == b) / 2 for a in s[t == 1] for b in s[t == 0]]
    assert np.isclose(boosting.auc(t, s), np.mean(pairs)) and np.isnan(boosting.auc(t * 0, s))


def test_absolute_links(spark):
    bases = ["http://a.test/b/c/d?q#f", "https://a.test", "http://a.test/b/"]
    links = ["x.pdf", "/x", "../x", "../../../x/./y", "//h.test/z", "?k=1", "#top", "mailto:a@b", "http://o.test/", "", ".", "..", "x/../y?z#w", "a/b/"]
    rows = spark.createDataFrame([(b, x) for b in bases for x in links], "b string, x string").select("b", "x", text.absolute_url(F.col("x"), F.col("b")).alias("u")).collect()
    tidy = lambda u: u + "/" if u == "https://a.test" else u.replace("https://a.test?", "https://a.test/?").replace("https://a.test#", "https://a.test/#")
    assert [(r["b"], r["x"], tidy(r["u"])) for r in rows] == [(b, x, tidy(urljoin(b, x) if x else b.split("#")[0])) for b in bases for x in links]
    page = spark.createDataFrame([(1, "http://a.test/r/", """<a href='x.pdf'>1</a><A class="k" HREF = "y&z">2</A><a href=plain.zip>3</a><abbr href="no">""")], "page_id long, url string, html string")
    assert [(r["link"], r["absolute"], r["downloadable"]) for r in filings.page_links(page).collect()] == [("x.pdf", "http://a.test/r/x.pdf", True), ("y&z", "http://a.test/r/y&z", False), ("plain.zip", "http://a.test/r/plain.zip", True)]


def test_dates_of_many_forms(spark):
    want = {"2024-03-01 10:22:00": "2024-03-01", "2024-03-01T10:22:00Z": "2024-03-01", "1/2/24": "2024-02-01", "31/12/70": "1970-12-31", "3-Mar-24": "2024-03-03", "5 March 2024 09:00": "2024-03-05", "March 5, 2024": "2024-03-05", "31/02/2024": None, "x": None}
    df = spark.createDataFrame([(k,) for k in want], "t string").select("t", text.robust_date(F.col("t")).cast("string").alias("d"))
    assert {r["t"]: r["d"] for r in df.collect()} == want


def test_pivot_of_cells_that_come_twice(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "i string, c string, v int")
    assert {tuple(r) for r in rel.pivot_unique(df, "i", "c", "v", ["x", "y"]).collect()} == {("a", 1, 2), ("b", 3, None)}
    with pytest.raises(ValueError, match="a, x"):
        rel.pivot_unique(df.union(df.limit(1)), "i", "c", "v", ["x", "y"])


def test_ledgers_found_and_missing(spark, tmp_path):
    (tmp_path / "A.csv").write_text("entity_id,v_zar\nE1,2.5\nE2,oops\n")
    sinks.write_workbook(spark, f"file://{tmp_path}/b.xlsx", {"Sheet1": [["v_zar", "entity_id"], [4.0, "E3"]]})
    schema = "entity_id string, v_zar double"
    with pytest.warns(UserWarning, match="no c.csv"):
        books = readers.load_ledgers(spark, f"file://{tmp_path}", ["a", "b", "c"], {"a": schema, "b": schema})
    assert {k: sorted((tuple(r) for r in v.collect()), key=str) for k, v in books.items()} == {"a": [("E1", 2.5), ("E2", None)], "b": [("E3", 4.0)]}
    with pytest.raises(FileNotFoundError):
        readers.load_ledgers(spark, f"file://{tmp_path}", ["zzz"], {})


def test_overrides_of_a_file(spark, tmp_path):
    (tmp_path / "o.json").write_text('{"AAA": {"url": "u1", "month": 6}, "BBB": {"url": "u2"}, "AAA": {"url": "u3"}}')
    over = readers.read_overrides(spark, f"file://{tmp_path}/o.json", "url string, month int", "ticker")
    base = spark.createDataFrame([("AAA", "d", 1), ("CCC", "d", 2)], "ticker string, url string, month int")
    assert {tuple(r) for r in readers.overlay(base, over, "ticker").collect()} == {("AAA", "u3", None), ("BBB", "u2", None), ("CCC", "d", 2)}


def test_filing_folder(spark, tmp_path):
    (tmp_path / "abc").mkdir()
    for n in ("report_2019.pdf", "afs-2024-v2023.pdf", "undated.pdf", "x.txt"):
        (tmp_path / "abc" / n).write_text("x")
    got = {(r["path"].split("/")[-1], r["ticker"], r["year"]) for r in readers.filing_folder(spark, f"file://{tmp_path}", 2022).collect()}
    assert got == {("afs-2024-v2023.pdf", "ABC", 2024), ("undated.pdf", "ABC", None)}


def test_percentiles_are_exact(spark):
    rng = np.random.default_rng(3)
    values = {"a": rng.lognormal(3, 2, 30_000).round(2), "b": np.array([5.0]), "c": np.repeat([1.0, 2.0], 700)}
    df = spark.createDataFrame([(k, float(v)) for k, x in values.items() for v in x] + [("a", -1.0)], "source_file string, value_zar double")
    for p in (0.995, 0.5, 0.0, 1.0):
        got = {r["source_file"]: r["p"] for r in diagnostics.percentile(df, p, 1000).collect()}
        assert got.keys() == values.keys() and all(np.isclose(got[k], np.percentile(x, 100 * p)) for k, x in values.items())


def test_shared_folder_is_wanted_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="checkpoint"):
        staging.shared_folder(Session())


def test_sweep_removes_what_was_written(spark):
    start = staging.mark()
    staging.materialize(spark.range(3))
    path = staging._written[-1][1].removeprefix("file://")
    assert Path(path).exists()
    staging.sweep(start)
    assert not Path(path).exists()


def test_hash_dedupe_keeps_one_null_text(spark, tmp_path):
    rows = [(3, None, "s"), (2, None, "t"), (4, "a", "s"), (1, "a", "u")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"file://{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["hash_dedupe"](spark, f"file://{tmp_path}").collect()]
    assert sorted(got, key=str) == [("t", None, 2), ("u", "a", 1)]
