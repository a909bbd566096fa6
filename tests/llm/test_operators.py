"""The operators against brute force on small fixtures, and on rows that are null, empty, long, repeated or oddly named."""

import gzip
import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import ann, langid, merkle, mixing, neardup, segmenting, toxicity, urlfilter, warc
from ledgerloom.llm.substring import drop_repeats

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, and columns with the operators' own names."""
    long = " ".join(f"w{i % 997}" for i in range(30_000))
    rows = [(1, "the cat sat on the mat and then it left again", "en", "a"), (1, "the cat sat on the mat and then it left again", "en", "a"), (2, None, "en", "a"), (3, "", None, None), (None, "some words without an id here", "de", "b"), (4, long, None, "b"), (5, "12 34 !!", "fr", "c"), (6, "\n\n \t", "fr", "c"), (7, "x" * 50_000, "fr", "c"), (8, "é 😀 ▁ " * 30, "es", None)]
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)
    for name in ("doc", "body", "digest", "class_id", "score", "size", "target", "_id", "key", "sample", "band", "pos", "bucket"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- 1 mixing


def waterfill(sizes, weights, most=3):
    goal, free, left = {}, set(sizes), sum(sizes.values())
    while free:
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        full = {s for s in free if share[s] > most * sizes[s]}
        if not full:
            return goal | share
        for s in full:
            goal[s] = most * sizes[s]
            left -= goal[s]
        free -= full
    return goal


def test_targets_are_the_iterated_shares(spark):
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 40):
        sizes = {f"s{i:02d}": int(rng.pareto(0.7) * 10) + (i % 5 > 0) for i in range(n)}
        df = spark.createDataFrame([(k, " ".join(["x"] * v)) for k, v in sizes.items()], "source string, text string")
        want = waterfill(sizes, {k: 1 + i % 3 for i, k in enumerate(sorted(sizes))})
        got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9, abs_tol=1e-9) for k in want)


def test_mix_is_near_its_targets_and_repeats(spark):
    df = spark.createDataFrame([(i, "a b c d", "xyz"[min(2, i % 7)]) for i in range(6000)], "doc_id long, text string, source string")
    a, b = mixing.mix(df).orderBy("doc_id").collect(), mixing.mix(df.repartition(7)).orderBy("doc_id").collect()
    assert a == b and all(0 <= r["copies"] <= 3 for r in a)
    taken, goal = defaultdict(int), {}
    for r in a:
        taken[r["source_size"]] += r["size"] * r["copies"]
        goal[r["source_size"]] = r["target"]
    assert all(abs(taken[k] - goal[k]) < 0.05 * goal[k] for k in goal)
    assert mixing.emit(df).count() == sum(r["copies"] for r in a)


def test_mix_without_a_broadcast(odd, monkeypatch):
    want = sorted(mixing.mix(odd).collect(), key=str)
    for name in ("BROADCAST_SOURCES", "BROADCAST_BYTES"):
        with monkeypatch.context() as m:
            m.setattr(mixing, name, 0)
            assert sorted(mixing.mix(odd).collect(), key=str) == want


def test_mix_odd_rows(odd, nothing):
    rows = mixing.mix(odd).collect()
    assert len(rows) == 10 and {r["size"] for r in rows if r["doc_id"] in (2, 3, 6)} == {0} and all(r["copies"] <= 3 for r in rows)
    assert mixing.emit(odd).columns == odd.columns and mixing.mix(nothing).count() == 0


# ---- 2 nearest neighbours


def test_neighbours_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 500)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 24))
    a = centres[rng.integers(0, 5, 1500)] + rng.normal(size=(1500, 24)) * np.where(rng.random(1500) < 0.3, 0.01, 0.5)[:, None]
    a[200:260] = a[199]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(a)]
    rows += [(2000, None), (2020, [0.0] * 24), (2040, [float("nan")] * 24), (2060, [None] * 24), (2080, []), (None, rows[3][1]), (2100, [1.0, 2.0]), (2101, [2.0, 1.0]), rows[0]]
    got = defaultdict(list)
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert got.pop(2100) == [(2101, 4.0)] and set(got) == set(range(0, 1500, 20))
    x = np.array([v for _, v in rows[:1500]])
    recall = []
    for q, found in got.items():
        s = np.zeros(1500)
        for j in range(24):
            s += x[q, j] * x[:, j]
        want = [i for i in np.lexsort((np.arange(1500), -s)) if i != q][:20]
        recall.append(len({v for v, _ in found} & set(want)) / 20)
        assert len(found) == 20 and all(c == s[v] for v, c in found) and found == sorted(found, key=lambda f: (-f[1], f[0]))
    assert np.mean(recall) >= 0.9
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_recall_on_many_shards_of_uneven_lengths():
    """Ten shards of 1,200 vectors in clusters, of lengths that differ tenfold; the worst query too."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 32))
    x = centres[rng.integers(0, 40, 12_000)] + rng.normal(size=(12_000, 32)) * 0.4
    x *= rng.lognormal(0, 0.7, 12_000)[:, None]
    q = x[::60]
    want = np.argsort(-(q @ x.T), 1)[:, :20]
    found = [[] for _ in q]
    for s in range(10):
        rows = np.arange(s, 12_000, 10)
        hits = ann.search(ann.build(x[rows]), q)
        for i, h in enumerate(hits):
            found[i] += rows[h[h >= 0]].tolist()
    recall = np.array([len(set(f) & set(w)) / 20 for f, w in zip(found, want, strict=True)])
    assert recall.mean() >= 0.97 and recall.min() >= 0.6


# ---- 3 language


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.predict(docs, langid.fit(docs), carry=("doc_id", "lang")).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(rows) == docs.count() and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97 and all(0 <= r["score"] <= 1 for r in rows)


def test_language_odd_rows(odd, nothing):
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.predict(odd, langid.fit(odd)).collect()]
    assert len(got) == 10 and all(p == "und" and s == 0 for i, p, s in got if i in (2, 3, 5, 6)) and all(p != "und" for i, p, s in got if i in (1, 4, 7, 8))
    assert langid.fit(nothing) is None and langid.predict(nothing, None).count() == 0


def test_language_margins_and_votes_against_brute_force():
    rng = np.random.default_rng(4)
    texts = [t.encode() for t in ("Der die das 12-x", "", "été à la", "a", "!!", "the quick " * 40)] * 30  # more than one block
    families = {"germanic": ["de", "en", "nl"], "romance": ["es", "fr"]}
    machines = [("family", "germanic", ""), ("family", "romance", ""), ("germanic", "de", "en"), ("germanic", "de", "nl"), ("germanic", "en", "nl"), ("romance", "es", "fr")]
    model = {"table": rng.normal(size=(langid.BUCKETS, 6)) * 9, "offsets": rng.normal(size=6), "machines": machines, "families": families}
    got = langid.margins(model, [t.lower() for t in texts])
    langs, scores = langid.decide(model, got)
    for t, m, lang, score in zip(texts, got, langs, scores, strict=True):
        total, n = np.zeros(6), 0
        for w in re.findall(rb"[a-z\x80-\xff]+", t.lower()):
            w = b" " + w + b" "
            for size in langid.SIZES:
                for i in range(len(w) - size + 1):
                    if size > 1 or w[i] != 32:
                        h = sum((c + 7) * f for c, f in zip(w[i : i + size], (2654435761, 2246822519, 3266489917))) + size * 0x9E3779B1 & 2**32 - 1
                        h = (h ^ h >> 15) * 0x2C1B3C6D & 2**32 - 1
                        total += model["table"][(h ^ h >> 13) & langid.BUCKETS - 1]
                        n += 1
        want = total / max(n, 1) + model["offsets"]
        assert np.allclose(m, want)
        family = "germanic" if want[0] >= want[1] else "romance"
        wins = Counter()
        for (f, a, b), d in zip(machines, want, strict=True):
            if f == family:
                wins[a if d >= 0 else b] += 1
        assert wins[lang] == max(wins.values()) and 0 <= score <= 1


def test_language_learns_from_any_length(spark):
    long = "le chat et la souris " * 3000
    rows = [(i, long if i % 2 else f"the cat and the mouse {i}", "fr" if i % 2 else "en") for i in range(12)] + [(50, "nobody", None), (51, None, "xx"), (None, "x", "yy")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), fold=None)
    assert model["families"] == {"germanic": ["en"], "romance": ["fr"]}
    got = langid.predict(spark.createDataFrame([(1, "la souris et le chat"), (2, "the mouse")], "doc_id long, text string"), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {1: "fr", 2: "en"}


def test_family_then_pairs():
    texts = [f"{w} " * 8 for w in ("the and", "der und", "le et", "el y") for _ in range(4)]
    model = langid.train(texts, [v for v in ("en", "de", "fr", "es") for _ in range(4)])
    assert sorted(model["machines"]) == [("family", "germanic", ""), ("family", "romance", ""), ("germanic", "de", "en"), ("romance", "es", "fr")]
    assert langid.decide(model, langid.margins(model, [b"der und", b"le et"]))[0] == ["de", "fr"]


# ---- 4 toxicity


def test_toxicity_held_out_and_misspelt(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs.join(labels, "doc_id"), model, carry=("doc_id", "toxic", "text")).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    bad, good = ([r["score"] for r in held if r["toxic"] == y] for y in (1, 0))
    # A tenth of the texts marked toxic here hold none of the words that set the others apart.
    assert np.mean([x > y for x, y in itertools.product(bad, good)]) > 0.93 and np.mean(np.array(good) < 0.7) > 0.99 and np.mean(np.array(bad) >= 0.7) > 0.85
    odd = spark.createDataFrame([(1, "the of and idiiot to"), (2, "the of and that to")], "doc_id long, text string")
    a, b = (r["score"] for r in toxicity.score(odd, model).orderBy("doc_id").collect())
    assert a > b


def test_toxicity_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (4, 0), (7, 0), (None, 1), (8, None), (2, 1)], "doc_id long, toxic int")
    rows = toxicity.score(odd, toxicity.fit(odd, labels, fold=None), carry=("doc_id", "text")).collect()
    assert len(rows) == 10 and all(0 <= r["score"] <= 1 for r in rows) and {r["score"] for r in rows if r["doc_id"] in (2, 3, 6)} == {0.0}
    assert toxicity.fit(nothing, labels) is None and [r["score"] for r in toxicity.score(odd, None).collect()] == [0.0] * 10 and toxicity.score(nothing, None).count() == 0


def plain_score(text, model):
    """Every n-gram of every word one by one."""
    table, bias = model
    words = re.findall(rb"[a-z0-9\x80-\xff]+", (text or "").lower().encode())
    if not words:
        return 0.0
    means = []
    for w in words:
        w, own = b" " + w + b" ", []
        for size in toxicity.SIZES:
            for i in range(len(w) - size + 1):
                h = sum((c + 7) * f for c, f in zip(w[i : i + size], (2654435761, 2246822519, 3266489917, 668265263, 374761393))) + size * 0x9E3779B1
                h &= 2**32 - 1
                h = (h ^ h >> 15) * 0x2C1B3C6D & 2**32 - 1
                own.append(float(table[(h ^ h >> 13) & toxicity.BUCKETS - 1]))
        means.append(sum(own) / len(own))
    worst = sorted(means)[-toxicity.WORST :]
    return 1 / (1 + math.exp(-(sum(worst) / len(worst) + bias)))


def test_toxicity_scores_against_brute_force(spark, docs, odd):
    model = np.random.default_rng(2).normal(size=toxicity.BUCKETS).astype(np.float32), -1.5
    for df in (docs.select("doc_id", "text"), odd.select("doc_id", "text")):
        for r in toxicity.score(df, model, carry=("doc_id", "text")).collect():
            assert math.isclose(r["score"], plain_score(r["text"], model), rel_tol=1e-5, abs_tol=1e-9)


def test_toxicity_learns_from_any_length_and_wants_words(spark):
    long = " ".join(f"w{i % 50}" for i in range(9000)) + " vile creep "
    rows = [(i, f"{long} {i}" if i % 2 else long.replace("vile creep", "kind friend") + str(i)) for i in range(8)] + [(20, ""), (21, "..."), (22, None), (23, "?")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in (*range(8), 20, 21, 22, 23)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels, fold=None)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    assert len(rows[1][1]) > 30_000 and min(got[i] for i in (1, 3, 5, 7)) > 0.7 > max(got[i] for i in (0, 2, 4, 6)) and {got[i] for i in (20, 21, 22, 23)} == {0.0}
    assert toxicity.fit(df, labels.where("doc_id % 2 = 0 or doc_id > 20"), fold=None) is None  # no label 1 with a word


# ---- 5 WARC


def test_warc_round_trip(spark, tmp_path):
    big = "<p>é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n</p>" * 4
    pages = [(5, "http://a/1", big), (3, "http://a/2\r\nX: y%", big), (9, None, big), (7, "u", "short"), (8, "u", "short"), (1, "u", None), (None, "u", big), (2, "u", "z" * 300_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(0)).withColumn("bytes", F.lit(""))
    warc.write(df, f"file://{tmp_path}/w", archives=3)
    got = {r["page_id"]: r for r in warc.read(spark, f"file://{tmp_path}/w").collect()}
    assert len(got) == 8 and got[3]["url"] == "http://a/2\r\nX: y%"
    for i, _, html in pages:
        want = (html or "").encode()
        assert got[i]["digest"] == hashlib.sha256(want).hexdigest()
        assert bytes(got[i]["payload"]) == (b"" if i in (5, 9) else want)
    assert [(i, got[i]["record_type"], got[i]["refers_to"]) for i in (3, 5, 9, 7, 8)] == [(3, "response", None), (5, "revisit", 3), (9, "revisit", 3), (7, "response", None), (8, "response", None)]
    full = {r["page_id"]: r["full"] for r in warc.resolved(warc.read(spark, f"file://{tmp_path}/w")).collect()}
    assert full[9] == len(big.encode()) and full[1] == 0
    one = next(tmp_path.glob("w/part-*.gz"))
    assert gzip.decompress(one.read_bytes()).endswith(b"\r\n\r\n")
    records = [h for p in tmp_path.glob("w/part-*.gz") for h, _ in warc.parse(gzip.decompress(p.read_bytes()))]
    ids = {h.get("Page-ID"): h["WARC-Record-ID"] for h in records}
    assert len(set(ids.values())) == 8 and {h["WARC-Refers-To"] for h in records if "WARC-Refers-To" in h} == {ids["3"]}
    warc.write(df.limit(0), f"file://{tmp_path}/e")
    assert warc.read(spark, f"file://{tmp_path}/e").count() == 0


def test_warc_repeated_rows_and_ties(spark, tmp_path):
    big = "x" * 200
    rows = [(4, "a", big), (4, "a", big), (4, "b", big), (9, "c", big), (9, "c", big), (None, "d", big), (None, "d", big), (None, None, None), (5, "e", "y" * 99), (6, "e", "y" * 99), (7, "e", "y" * 100), (8, "e", "y" * 100)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), f"file://{tmp_path}/w", archives=2)
    got = warc.resolved(warc.read(spark, f"file://{tmp_path}/w")).collect()
    assert sorted([(r["page_id"], r["record_type"], r["refers_to"], r["full"]) for r in got], key=str) == sorted([(4, "response", None, 200)] * 3 + [(9, "revisit", 4, 200)] * 2 + [(None, "response", None, 200)] * 2 + [(None, "response", None, 0), (5, "response", None, 99), (6, "response", None, 99), (7, "response", None, 100), (8, "revisit", 7, 100)], key=str)


# ---- 6 fingerprints


def test_fingerprints_against_brute_force(docs):
    got = {r["doc_id"]: r for r in merkle.fingerprints(docs).collect()}
    rows = sorted([(r["doc_id"], r["text"]) for r in docs.collect()], reverse=True)
    assert len(got) == len(rows)
    for (i, text), (_, nxt) in zip(rows, rows[1:] + rows[:1], strict=True):
        h = len(text) // 2
        new = text[: len(text) - h] + nxt[:h]
        marks = [merkle.fingerprint(merkle.tree(t)) for t in (text, new, nxt)]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (len(text), hashlib.sha256(new.encode()).hexdigest(), *marks[:2])
        assert math.isclose(r["near_edited"], merkle.likeness(*marks[:2])) and math.isclose(r["near_next"], merkle.likeness(marks[0], marks[2]))


def test_fingerprint_tree_by_hand():
    text = "One. Two!\n\nA line without an end " + "x" * 400 + "\nlast"
    h = lambda b: hashlib.blake2b(b, digest_size=16).digest()
    pieces, rest = [], text
    while rest:  # up to the next end of a sentence or line, 160 characters at most
        n = 0
        while n < min(160, len(rest)) and rest[n] not in ".!?\n":
            n += 1
        if n < 160:
            while n < len(rest) and rest[n] in ".!?\n":
                n += 1
        pieces.append(rest[:n])
        rest = rest[n:]
    assert "".join(pieces) == text
    tops, marks, own = [], [], []
    for p in pieces:
        own.append((h(p.encode()), len(p)))
        if p.endswith("\n") or p is pieces[-1]:
            marks.append(h(b"p" + b"".join(d + n.to_bytes(2) for d, n in own)))
            if own[-1][0][0] % 8 == 0 or p is pieces[-1]:
                tops.append(h(b"s" + b"".join(marks)))
                marks = []
            own = []
    assert merkle.fingerprint(merkle.tree(text)).split("|")[0] == h(b"r" + b"".join(tops)).hex()


def test_fingerprints_without_ids_are_dealt_out(spark):
    rows = [(None, f"text {i}.") for i in range(300)] + [(i, f"numbered {i}.") for i in range(5)]
    got = merkle.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert len(got) == 305
    texts = {hashlib.sha256(t.encode()).hexdigest() for _, t in rows}
    assert len({r["fingerprint"] for r in got}) == 305 and not texts & {r["edited_sha256"] for r in got}
    after = {r["doc_id"]: r["near_next"] for r in got if r["doc_id"] is not None}
    assert sorted(after) == list(range(5))


def test_fingerprint_locates_an_edit():
    a = "One. Two.\n" + "".join(f"Line {i} is here.\n" for i in range(40))
    b = a.replace("Line 20 is", "Line 20 was")
    x, y = (merkle.fingerprint(merkle.tree(t)) for t in (a, b))
    (span,) = merkle.locate(x, y)
    assert a[slice(*span)] == "Line 20 is here.\n" and 0.9 < merkle.likeness(x, y) < 1 and merkle.locate(x, x) == []


def test_fingerprint_odd_rows(spark, odd, nothing):
    rows = merkle.fingerprints(odd).collect()
    assert len(rows) == 10 and merkle.fingerprints(nothing).count() == 0 and all(0 <= r["near_next"] <= 1 for r in rows)
    one = merkle.fingerprints(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


# ---- 7 sampled pieces


def test_segmentations_are_drawn_without_replacement():
    v = segmenting.load()
    text, n = "thing", 6000

    def splits(s):
        if not s:
            yield ()
        for m in range(1, len(s) + 1):
            for i in (i for i, p in enumerate(v.pieces) if p == s[:m] and v.kinds[i] == 0):
                for rest in splits(s[m:]):
                    yield (i, *rest)

    flat = v._replace(logp=np.where(v.kinds == 0, v.logp / 6, v.logp))
    p = {s: math.exp(sum(flat.logp[list(s)])) for s in splits("▁" + text)}
    total = sum(p.values())
    p = {s: x / total for s, x in p.items()}
    first, second = Counter(), Counter()
    for _, s, ids, phi, inc in segmenting.sample_texts([text] * n, np.arange(n, dtype=np.uint64), flat, 2):
        (first if s == 1 else second)[tuple(map(int, ids))] += 1
        assert math.isclose(phi, math.log(p[tuple(map(int, ids))]), abs_tol=1e-9) and inc <= 0
    for s in p:
        other = sum(p[t] * p[s] / (1 - p[t]) for t in p if t != s)
        assert abs(first[s] / n - p[s]) < 5 * math.sqrt(p[s] / n) + 1e-3 and abs(second[s] / n - other) < 5 * math.sqrt(other / n) + 1e-3


def test_third_draws_and_inclusion_scores():
    """Three of the segmentations of two words: the third's distribution, and sums of p over inclusion probability that are 1 on average."""
    v = segmenting.load()
    flat = v._replace(logp=np.where(v.kinds == 0, v.logp / 8, v.logp))
    text, n = "an it", 5000
    every: dict[tuple, float] = {}
    for _, _, ids, phi, inc in segmenting.sample_texts([text], np.array([3], np.uint64), flat, 500):
        assert tuple(map(int, ids)) not in every and inc == 0.0  # there are fewer: all come, for sure
        every[tuple(map(int, ids))] = math.exp(phi)
    assert 6 < len(every) < 100 and math.isclose(sum(every.values()), 1, abs_tol=1e-9) and {segmenting.decode(s, v) for s in every} == {text}
    third, weight = Counter(), np.zeros(n)
    for i, s, ids, phi, inc in segmenting.sample_texts([text] * n, np.arange(n, dtype=np.uint64), flat, 3):
        weight[i] += math.exp(phi - inc)
        if s == 3:
            third[tuple(map(int, ids))] += 1
    assert abs(weight.mean() - 1) < 5 * weight.std() / math.sqrt(n)
    for x, p in every.items():
        want = sum(q * r / (1 - q) * p / (1 - q - r) for (a, q), (b, r) in itertools.permutations(every.items(), 2) if x not in (a, b))
        assert abs(third[x] / n - want) < 5 * math.sqrt(want / n) + 1e-3


def test_texts_with_few_segmentations():
    """All segmentations come, once each, however sums round: of texts without a choice (an IndexError before), and of others with
    fewer than are asked for."""
    v, n = segmenting.load(), 200
    for text in ["Ç.", "Ê!", "ç.", "Ñ.", "ñ", "\uffff", "\ufffd", "ﷺ", "ß! Ç.", "\n中\n"]:
        found = [(i, s, phi, inc) for i, s, ids, phi, inc in segmenting.sample_texts([text] * n, np.arange(n, dtype=np.uint64), v, 2) if segmenting.decode(ids, v) == text]
        assert found == [(i, 1, 0.0, 0.0) for i in range(n)]
    for text in ["x", "Ç. é", "ß! x Ç. é", "\ufffd the"]:
        sets = defaultdict(list)
        for i, _, ids, phi, inc in segmenting.sample_texts([text] * 30, np.arange(30, dtype=np.uint64), v, 60):
            assert inc == 0.0 and segmenting.decode(ids, v) == text
            sets[i].append((tuple(map(int, ids)), math.exp(phi)))
        every = {s for s, _ in sets[0]}
        assert 1 < len(every) < 60 and all(len(x) == len(every) and {s for s, _ in x} == every and math.isclose(sum(p for _, p in x), 1, abs_tol=1e-9) for x in sets.values())


def test_pieces_decode_and_differ(docs):
    v = segmenting.load()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = segmenting.encode(docs, k=3).collect()
    seen = defaultdict(set)
    for r in rows:
        assert segmenting.decode(r["token_ids"], v) == text[r["doc_id"]]
        seen[r["doc_id"]].add(tuple(r["token_ids"]))
    assert len(rows) == 3 * len(text) and all(len(s) == 3 for s in seen.values())
    again = segmenting.encode(docs.repartition(5), k=3).collect()
    key = lambda r: (r["doc_id"], r["sample"])
    assert [(*key(r), r["token_ids"]) for r in sorted(rows, key=key)] == [(*key(r), r["token_ids"]) for r in sorted(again, key=key)]


def test_vocabulary_normalises_nothing_and_its_own_pieces_are_paths(docs):
    import sentencepiece

    v, sp = segmenting.load(), sentencepiece.SentencePieceProcessor(model_file=segmenting.MODEL_PATH)
    assert sp.decode(sp.encode("ﬁ é Ａ  x\t")) == "ﬁ é Ａ  x\t"
    for t in [r["text"] for r in docs.limit(20).collect() if r["text"]]:
        own = sp.encode(t)
        assert segmenting.decode(own, v) == t and all(segmenting._SPACE not in v.pieces[i].lstrip(segmenting._SPACE) for i in own)


def test_decoded_rows(spark, odd):
    some = odd.where("doc_id is null or doc_id != 8")  # 8 holds the vocabulary's own sign for a blank
    back = {(r["doc_id"], r["text"]) for r in segmenting.decode_rows(segmenting.encode(some)).collect()}
    assert back == {(r["doc_id"], r["text"] or "") for r in some.collect()}
    rows = spark.createDataFrame([(1, 1, None), (2, 1, []), (3, 1, [None, 99_999_999, -1])], "doc_id long, sample int, token_ids array<int>")
    assert {r["doc_id"]: r["text"] for r in segmenting.decode_rows(rows).collect()} == {1: None, 2: "", 3: ""}
    assert segmenting.decode_rows(rows.limit(0)).count() == 0


def test_pieces_odd_rows(odd, nothing):
    rows = segmenting.encode(odd).collect()
    assert sorted({r["doc_id"] or 0 for r in rows}) == list(range(9)) and [(r["token_ids"], r["log_inclusion"]) for r in rows if r["doc_id"] in (2, 3)] == [([], 0.0)] * 2
    assert segmenting.encode(nothing).count() == 0


# ---- 8 URL filter


def test_url_rules_and_model(spark):
    urls = ["https://A.Example.NET/en/x?y", "http://net/", "http://my.net", "http://x.org/fr/1", "http://xorg/fr/1", "http://a.example.com/de/", "http://a.example.com/en/", None, "nonsense", "ftp://h#f", "x://y://z/p", "http://ÀB.com\n/q"]
    rows = urlfilter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1))).orderBy("page_id").collect()
    weights = urlfilter.fit(urlfilter.labelled_urls(spark))

    def expect(u):
        host, path = "", ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.split(r"[/?#]", rest)[0]
            path = re.split(r"[?#]", rest[len(host) :])[0]
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        best = max((r for r in urlfilter.RULES if (host == r[0].split("/")[0] or host.endswith("." + r[0].split("/")[0])) and path.startswith("/" + r[0].split("/", 1)[1])), key=lambda r: len(r[0]), default=(None, None))
        t = f"^{host}{path}$"
        grams = {xxhash.xxh64((t[i : i + n] if len(t) >= n else t).encode(), seed=42).intdigest() % 2**64 for n in urlfilter.SIZES for i in range(max(1, len(t) - n + 1))}
        grams = {(g - 2**64 if g >= 2**63 else g) % urlfilter.BUCKETS for g in grams}
        z = sum(weights[g] for g in grams) / math.sqrt(len(grams)) + weights[-1]
        return host, path, best[0], best[1] or ("block" if 1 / (1 + math.exp(-z)) >= 0.5 else "allow")

    for r, u in zip(rows, urls, strict=True):
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == expect(u), u
    assert [r["score"] for r in rows if r["page_id"] in (7, 8)] == [rows[7]["score"]] * 2


def test_url_model_on_hosts_held_out(spark):
    table = urlfilter.labelled_rows()
    part = lambda a: zlib.crc32(a.split("/")[0].encode()) % 4
    make = lambda rows: spark.createDataFrame(rows, "address string, label int")
    held = [(a, y) for a, y in table if part(a) == 0]
    weights = urlfilter.fit(make([(a, y) for a, y in table if part(a)] + [(None, 1), ("x", None)]))
    got = make(held).select(F.col("address").alias("_address"), "label").withColumn("s", urlfilter.spam_score(weights)).collect()
    assert len(table) > 250 and np.mean([(r["s"] >= 0.5) == r["label"] for r in got]) >= 0.9
    assert set(urlfilter.fit(make([]))) == {0.0}


def test_url_odd_rows(spark):
    rows = [(1, "http://a.test/x"), (1, "http://a.test/x"), (None, "http://a.test/x"), (2, None), (3, ""), (4, "://"), (5, "http://" + "a" * 20_000 + ".test/")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit(0) for c in ("path", "rule", "score", "_address", "b")})
    got = urlfilter.judge(df).collect()
    assert len(got) == 7 and len({r["score"] for r in got if r["path"] == "/x"}) == 1 and all(0 <= r["score"] <= 1 for r in got) and {r["host"] for r in got if r["page_id"] in (2, 3, 4)} == {""}
    assert urlfilter.judge(df.limit(0)).count() == 0


# ---- 9 near duplicates


def shingle_counts(t):
    w = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (t or "").lower())
    return Counter(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else Counter()


def classes(rows):
    bags = {i: shingle_counts(t) for i, t in rows}
    up = {i: i for i in bags}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for (i, a), (j, b) in itertools.combinations(rows, 2):
        x, y = bags[i], bags[j]
        if a is not None and (a == b or (x and sum((x & y).values()) >= 0.8 * sum((x | y).values()))):
            p, q = find(i), find(j)
            up[max(p, q)] = min(p, q)
    return {i: find(i) for i in bags}


def test_near_duplicates_against_brute_force(spark, docs, monkeypatch):
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(150)]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"]) < 4000]
    for i in range(70):  # one group of near copies, larger than a bucket whose pairs are all compared
        w = list(base)
        for j in rng.integers(0, 150, rng.integers(0, 5)):
            w[j] = f"n{rng.integers(1000)}"
        rows.append((10_000 + i, " ".join(w)))
    want = classes(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for small in (24, 4):
        monkeypatch.setattr(neardup, "SMALL", small)
        monkeypatch.setattr(neardup, "BLOCK", 16)
        assert {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(df).collect()} == want


def test_near_duplicates_with_ids_that_clash(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " end"), (3, c), (2, b), (4, b + " more"), (5, c + " tail"), (5, "only here"), (3, c), (1, None), (1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted({(r["doc_id"], r["class_id"], r["n_links_found"], r["kept"], r["digest"] is None or r["digest"] == hashlib.md5(c.encode()).hexdigest()) for r in neardup.near_duplicates(df).collect()})
    assert [r[:4] for r in got] == sorted([(1, 1, 0, True), (1, 1, 1, True), (2, 1, 1, False), (3, 3, 1, True), (4, 1, 1, False), (5, 3, 1, False), (5, 5, 0, True)])


def test_signatures_estimate_weighted_similarity():
    a, b = [f"x{i}" for i in range(300)], [f"x{i}" for i in range(30, 330)]
    ta, tb = " ".join(a).encode(), " ".join(b).encode()
    ids, _ = neardup.dart_signatures([ta, tb], 4096)
    assert abs((ids[0] == ids[1]).mean() - neardup.similarity([ta], [tb])[0]) < 0.04


def test_components_of_a_long_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in neardup.components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_near_duplicates_odd_rows(odd, nothing):
    got = [(r["doc_id"], r["class_id"]) for r in neardup.near_duplicates(odd).collect()]
    assert sorted(got, key=str) == sorted([(i, i) for i in (1, 1, 2, 3, None, 4, 5, 6, 7, 8)], key=str) and neardup.near_duplicates(nothing).count() == 0


# ---- 10 repeated passages


def cut(rows, window):
    seen, out = set(), {}
    for i, t in sorted(rows):
        words = WORD.findall(t or "")
        gone = set()
        for j in range(len(words) - window + 1):
            k = tuple(words[j : j + window])
            if k in seen:
                gone.update(range(j, j + window))
            seen.add(k)
        out[i] = (len(words), len(gone), " ".join(w for j, w in enumerate(words) if j not in gone))
    return out


def test_repeats_against_brute_force(spark):
    rng = np.random.default_rng(9)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(120):
        w = [f"w{x}" for x in rng.integers(0, 30 if i % 9 == 0 else 5000, rng.integers(0, 200))]
        if i % 3 == 0:
            a, n = rng.integers(0, 30), rng.integers(10, 31)
            w[len(w) // 2 : len(w) // 2] = passage[a : a + n]
        rows.append((i * 7 % 120, " ".join(w)))
    rows += [(500, rows[0][1]), (501, rows[0][1]), (502, "z " * 400), (503, None), (504, "")]
    for window in (20, 8):
        got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in drop_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window).collect()}
        assert got == cut(rows, window)


def test_repeats_odd_rows(odd, nothing):
    rows = drop_repeats(odd, carry=("lang", "source")).collect()
    assert len(rows) == 10 and next(r for r in rows if r["doc_id"] == 4)["n_removed"] == 30_000 - 997
    assert drop_repeats(nothing).count() == 0


def test_repeated_rows_are_one_text(spark):
    a, b = " ".join(f"a{i}" for i in range(45)), " ".join(f"b{i}" for i in range(30))
    rows = [(3, b), (1, a), (3, b), (1, a), (2, f"{a} end"), (1, a), (4, f"{b} {b}"), (5, a), (5, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 9):
        got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in drop_repeats(df.repartition(parts)).collect()]
        assert sorted(got) == [(1, 45, 0, a)] * 3 + [(2, 46, 45, "end")] + [(3, 30, 0, b)] * 2 + [(4, 60, 60, "")] + [(5, 45, 45, "")] * 2
