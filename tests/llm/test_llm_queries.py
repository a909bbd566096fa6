"""Registered queries beside their SQL, and the pipeline stage by stage."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from ledgerloom.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = QUERIES[name](spark, DATA)
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    want = sorted((tuple(r[cols.index(c)] for c in df.columns) for r in cur.fetchall()), key=str)
    assert sorted((tuple(r) for r in df.collect()), key=str) == want


def test_one_query_each():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 11))


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes and out.count() > 0.6 * n, name
    assert corpus_pipeline.run(spark, DATA).count() > n


def test_stages_on_odd_rows(spark):
    rows = [(1, "a b c " * 30, "en", "x", 5), (1, "a b c " * 30, "en", "x", 5), (2, None, None, None, None), (None, "some text", "de", "x", 1), (3, "", "en", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DATA).count() > 0, name
        assert stage(spark, docs.limit(0), DATA).count() == 0, name
    assert sorted(str(r["doc_id"]) for r in corpus_pipeline.keep_one_of_near_duplicates(spark, docs, DATA).collect()) == ["1", "2", "3", "None"]


def test_near_duplicate_stage_names_the_survivors(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(1, a), (1, b), (2, a), (3, a + " end"), (3, "a text that nobody else has"), (3, "a text that nobody else has"), (4, None), (None, a), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "x", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.keep_one_of_near_duplicates(spark, docs, DATA).collect()]
    assert sorted(got, key=str) == sorted([(1, a), (1, b), (3, "a text that nobody else has"), (4, None), (None, a), (5, "")], key=str)


def test_pipeline_learns_from_all_labels(spark, monkeypatch):
    seen, train = [], corpus_pipeline.toxicity.train
    monkeypatch.setattr(corpus_pipeline.toxicity, "train", lambda texts, *a, **k: seen.append(len(texts)) or train(texts, *a, **k))
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    corpus_pipeline.drop_toxic(spark, docs, DATA)
    assert seen == [docs.join(labels.where("toxic is not null"), "doc_id").where("text is not null").count()]
