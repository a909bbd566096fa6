"""URL filters with DataFrame functions only: rules by host and path, else logistic regression on hashed character n-grams of
host and path. The model is fitted in one SQL expression, by gradient descent over a small labelled table, and then stands
in the scoring expression as an array of weights.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS, SIZES, EPOCHS, RATE, CUT = 1 << 14, (3, 4), 80, 8.0, 0.5
#: (rule, verdict): host, then the path that the url's path must start with.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: What the labelled hosts are made of.
SPAM = ("casino", "poker", "bets", "betting", "jackpot", "slots", "lottery", "pills", "pharma", "cheap", "discount", "replica", "loans", "payday", "free", "followers", "deals", "prize", "win", "adult", "dating", "torrent", "bonus", "spam", "click", "viagra", "earn-money")
CLEAN = ("news", "blog", "library", "museum", "school", "university", "science", "weather", "history", "garden", "music", "theatre", "docs", "project", "wiki", "travel", "kitchen", "council", "hospital", "forum", "photos", "maps", "river", "city", "books", "archive", "parks")
SYLLABLES = ("th", "er", "on", "in", "an", "re", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "it", "st")


def labelled_rows() -> list[tuple[str, int]]:
    """(address, 1 for spam): hosts made of neighbouring words of a list or of three syllables, each with a few paths."""
    out = []
    for label, words, paths in ((1, SPAM, ("/", "/buy/now", "/en/728", "/win?x")), (0, CLEAN, ("/", "/articles/2020/spring", "/en/95.html", "/fr/1204"))):
        for i, w in enumerate(words):
            second, third = words[(i + 1) % len(words)], words[(i + 7) % len(words)]
            hosts = (f"{w}-{second}.example.com", f"www.{w}{third}.test", f"m.{third}-{w}.example.org", f"{w}.example.net")
            out += [(f"{host}{paths[(i + k) % len(paths)]}", label) for k, host in enumerate(hosts)]
    n = len(SYLLABLES)
    out += [(f"{('', 'www.', 'm.', 'blog.')[i % 4]}{SYLLABLES[i % n]}{SYLLABLES[i * 7 % n]}{SYLLABLES[i * 3 // 2 % n]}.example.{('com', 'org', 'net')[i % 3]}/{('en', 'de', 'fr')[i // 3 % 3]}/{i * 131 % 9973}", 0) for i in range(60)]
    return out


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the host or a domain above it and the path's start; else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, what in sorted(rules, key=lambda r: len(r[0])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def _buckets(text: str) -> str:
    """SQL for the distinct n-gram buckets of a column, with a bound on either side; a text shorter than an n-gram is one."""
    t = f"concat('^', {text}, '$')"
    bucket = lambda x: f"cast(pmod(xxhash64({x}), {BUCKETS}) as int)"
    grams = [f"if(length({t}) < {n}, array({bucket(t)}), transform(sequence(1, greatest(1, length({t}) - {n - 1})), i -> {bucket(f'substring({t}, i, {n})')}))" for n in SIZES]
    return f"array_distinct(concat({', '.join(grams)}))"


def fit(labelled: DataFrame, epochs: int = EPOCHS) -> list[float]:
    """Weights of the buckets, then the bias, from (address, label). The table is small; it is gathered into one row.

    An empty table gives weights of zero. Rows with nulls are left out. Only buckets that the table touches are worked on:
    each row lists the places of its buckets, each bucket the rows that have it.
    """
    if epochs < 1:
        raise ValueError("epochs must be at least 1")
    rows = labelled.where("address is not null and label in (0, 1)").select(F.col("label").cast("double").alias("y"), "address")
    one = rows.agg(F.array_sort(F.collect_list(F.struct("address", "y"))).alias("rows")).select(F.posexplode("rows").alias("i", "x"))
    one = one.select("i", F.col("x.y").alias("y"), F.expr(_buckets("x.address")).alias("b"))
    lists = one.select("i", F.explode("b").alias("bucket"), (1 / F.sqrt(F.size("b"))).alias("v")).groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("who"))
    lists = lists.agg(F.array_sort(F.collect_list(F.struct("bucket", "who"))).alias("lists")).select("lists", F.expr("map_from_arrays(transform(lists, x -> x.bucket), transform(lists, (x, k) -> k))").alias("place"))
    texts = one.join(F.broadcast(lists.select("place"))).select("i", "y", F.expr("transform(b, k -> place[k])").alias("at"))  # one row
    texts = texts.agg(F.array_sort(F.collect_list(F.struct("i", "y", "at"))).alias("rows"))
    both = texts.join(F.broadcast(lists.select("lists")))  # one row
    dot = "aggregate(x.at, 0D, (s, k) -> s + w[k]) / sqrt(size(x.at)) + w[size(lists)]"
    errors = f"transform(rows, x -> (1D / (1D + exp(-({dot}))) - x.y) / size(rows))"
    moved = f"transform(lists, (l, k) -> w[k] * 0.999D - {RATE}D * aggregate(l.who, 0D, (s, r) -> s + e[r.i] * r.v))"
    bias = f"w[size(lists)] * 0.999D - {RATE}D * aggregate(e, 0D, (s, v) -> s + v)"
    step = f"transform(array({errors}), e -> concat({moved}, array({bias})))[0]"
    start = "cast(array_repeat(0D, size(lists) + 1) as array<double>)"
    got = both.select(F.expr("transform(lists, x -> x.bucket)").alias("buckets"), F.expr(f"aggregate(sequence(1, {epochs}), {start}, (w, t) -> {step})").alias("w")).first()
    weights = [0.0] * (BUCKETS + 1)
    if got is not None:
        for k, x in zip([*got["buckets"], BUCKETS], got["w"], strict=True):
            weights[k] = x
    return weights


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The labelled table: a local relation, no Python on the executors."""
    values = ", ".join(f"('{u}', {y})" for u, y in labelled_rows())
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(address, label)")


def spam_score(weights: list[float]) -> Column:
    """Probability of spam, 0 to 1, of the column _address."""
    row = F.from_json(F.lit(json.dumps(weights)), "array<double>")  # a constant, folded once
    buckets = F.expr(_buckets("_address"))
    total = F.aggregate(buckets, F.lit(0.0), lambda s, k: s + F.element_at(row, k + 1)) / F.sqrt(F.size(buckets))
    return 1 / (1 + F.exp(-(total + F.lit(float(weights[-1])))))


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", cut: float = CUT) -> DataFrame:
    """id, host, path, rule (null if none fits), score and verdict (the rule's; else block from ``cut`` on).

    A null url or one without ``://`` has an empty host and path and is judged by the model like any other, by its one n-gram. Rows are
    neither joined nor moved: repeated rows, null ids and other columns don't matter. Empty tables stay empty.
    """
    weights = fit(labelled if labelled is not None else labelled_urls(pages.sparkSession))
    rows = pages.select(F.col(id_col).alias("_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rows = rows.withColumn("_address", F.concat("host", "path")).withColumn("score", spam_score(weights))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.select(F.col("_id").alias(id_col), "host", "path", rule.alias("rule"), "score", F.coalesce(verdict, F.when(F.col("score") >= cut, "block").otherwise("allow")).alias("verdict"))
