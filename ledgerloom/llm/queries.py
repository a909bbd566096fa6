"""The queries ``opN_<name>`` and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import langid, mixing, segmenting, toxicity, urlfilter, warc
from ledgerloom.llm.ann import nearest
from ledgerloom.llm.common import crc_bucket
from ledgerloom.llm.merkle import fingerprints
from ledgerloom.llm.neardup import near_duplicates
from ledgerloom.llm.substring import drop_repeats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE["op1_source_mixing"] = rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place, 1 + (place - 1) % 3 AS weight FROM s),
b AS (SELECT *, coalesce(sum(source_size) OVER w, 0) AS sb, coalesce(sum(weight) OVER w, 0) AS wb FROM r
      WINDOW w AS (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT max(((SELECT sum(source_size) FROM r) - 3 * sb)::DOUBLE / ((SELECT sum(weight) FROM r) - wb)::DOUBLE) AS level FROM b),
t AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, level * weight) AS target FROM r, l),
x AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
             ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE / 281474976710656 AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + (u < rate - floor(rate))::INT))::BIGINT AS taken FROM x
"""


@_query
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"))


# Exact neighbours: the search is approximate, and equals this where it misses none, as on tables of one small shard.
ORACLE["op2_nearest_neighbours"] = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]), lambda a, b: a + b) AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s QUALIFY rank <= 20
"""


@_query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = langid.predict(docs, langid.fit(docs))
    return out.select("doc_id", (crc_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


@_query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return out.select("doc_id", (crc_bucket(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@_query
def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    warc.write(_table(spark, sf_dir, "pages"), folder)
    out = warc.resolved(warc.read(spark, folder, with_payload=False))
    return out.select("page_id", F.col("full").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")


ORACLE["op5_warc_revisits"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to FROM f
"""


@_query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents"))


@_query
def fingerprint_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of op6: lengths and edited texts."""
    return op6_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


ORACLE["fingerprint_edits"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, length(t) AS c, coalesce(lead(t) OVER (ORDER BY doc_id DESC), first_value(t) OVER (ORDER BY doc_id DESC)) AS nx FROM d)
SELECT doc_id, c::BIGINT AS n_chars, sha256(left(t, c - c // 2) || left(nx, c // 2)) AS edited_sha256 FROM n
"""


@_query
def op7_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmenting.encode(_table(spark, sf_dir, "documents"))


@_query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"))


@_query
def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of op8: hosts, paths and rules, and the verdicts that rules give."""
    verdict = F.when(F.col("rule").isNotNull(), F.col("verdict"))
    return op8_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule", verdict.alias("verdict"))


ORACLE["url_rules"] = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT * FROM (VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')) AS v(rule, verdict)),
f AS (SELECT page_id, rule, verdict FROM p JOIN r ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, substr(rule, strpos(rule, '/')))
      QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) = 1)
SELECT p.page_id, host, path, rule, verdict FROM p LEFT JOIN f ON p.page_id = f.page_id
"""


@_query
def op9_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links_found")


# Every pair of texts that share a shingle, and all that can be reached over links. (Bands miss a pair of just 0.8 once in 250,000.)
ORACLE["op9_minhash_neardup"] = r"""
WITH RECURSIVE r AS (SELECT text, min(doc_id) AS a FROM documents WHERE text IS NOT NULL GROUP BY text),
w AS (SELECT a, regexp_extract_all(lower(text), '[a-z0-9\x{80}-\x{10FFFF}]+') AS ws FROM r),
s AS (SELECT a, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
c AS (SELECT a, s, count(*) AS n FROM s GROUP BY 1, 2),
t AS (SELECT a, sum(n) AS n FROM c GROUP BY 1),
p AS (SELECT x.a, y.a AS b, sum(least(x.n, y.n)) AS n FROM c x JOIN c y ON x.s = y.s AND x.a < y.a GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN t x ON p.a = x.a JOIN t y ON p.b = y.a WHERE 5 * p.n >= 4 * (x.n + y.n - p.n)),
ends AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT a, a AS low FROM r UNION SELECT ends.b, reach.low FROM reach JOIN ends ON reach.a = ends.a WHERE reach.low < ends.b),
k AS (SELECT a, min(low) AS class_id FROM reach GROUP BY 1),
n AS (SELECT a, count(*) AS n FROM ends GROUP BY 1)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n, 0)::BIGINT AS n_links_found FROM documents d LEFT JOIN r ON d.text = r.text LEFT JOIN k ON r.a = k.a LEFT JOIN n ON r.a = n.a
"""


@_query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLE["op10_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)),
gone AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
hit AS (SELECT DISTINCT doc_id, i + unnest(range(0, 20)) AS p FROM gone),
word AS (SELECT doc_id, generate_subscripts(ws, 1) AS p, unnest(ws) AS v FROM w),
kept AS (SELECT word.doc_id, string_agg(v, ' ' ORDER BY word.p) AS t, count(*) AS n
         FROM word ANTI JOIN hit ON word.doc_id = hit.doc_id AND word.p = hit.p GROUP BY word.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
