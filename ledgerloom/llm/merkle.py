"""Document fingerprints: a Merkle tree over sections, paragraphs and sentence pieces.

A fingerprint is text: ``root|section:paragraph=leaf,leaf+paragraph=leaf;section:...``. All hashes have 128 bits, and each is
made of whole hashes below it; leaves, paragraphs and sections are printed by their first ten hex digits, a leaf with its
length. Roots are equal for equal texts. A section is a run of paragraphs that ends where a paragraph's own hash says so,
so that an insertion doesn't shift the sections behind it; walking down the branches that differ finds the edit.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PIECE = re.compile(r"[^.!?\n]{1,160}[.!?\n]*|[.!?\n]+")
#: Bytes of a hash, and bytes of it that are printed below the root.
_DIGEST, _SHORT = 16, 5


def _hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=_DIGEST).digest()


def tree(text: str) -> list[list[list[tuple[bytes, int]]]]:
    """Sections of paragraphs of (leaf hash, characters)."""
    sections: list = []
    section: list = []
    paragraph: list = []
    for piece in _PIECE.findall(text):
        paragraph.append((_hash(piece.encode()), len(piece)))
        if piece[-1] == "\n":
            section.append(paragraph)
            if paragraph[-1][0][0] % 8 == 0:
                sections.append(section)
                section = []
            paragraph = []
    if paragraph:
        section.append(paragraph)
    if section:
        sections.append(section)
    return sections


def fingerprint(sections: list) -> str:
    parts, tops = [], []
    for section in sections:
        marks = [_hash(b"p" + b"".join([h + n.to_bytes(2) for h, n in p])) for p in section]
        top = _hash(b"s" + b"".join(marks))
        tops.append(top)
        body = "+".join([m[:_SHORT].hex() + "=" + ",".join([f"{h[:_SHORT].hex()}{n:x}" for h, n in p]) for m, p in zip(marks, section, strict=True)])
        parts.append(f"{top[:_SHORT].hex()}:{body}")
    return f"{_hash(b'r' + b''.join(tops)).hex()}|{';'.join(parts)}"


def parse(mark: str) -> list:
    """The tree that a fingerprint holds."""
    _, _, body = mark.partition("|")
    leaf = lambda x: (bytes.fromhex(x[: 2 * _SHORT]), int(x[2 * _SHORT :], 16))
    return [[[leaf(x) for x in p.partition("=")[2].split(",")] for p in s.partition(":")[2].split("+")] for s in body.split(";")] if body else []


def _bag(sections: list) -> Counter:
    return Counter([x for s in sections for p in s for x in p])


def _likeness(a: Counter, b: Counter) -> float:
    total = sum([k[1] * n for k, n in a.items()]) + sum([k[1] * n for k, n in b.items()])
    if not total:
        return 1.0
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    return 2.0 * sum([k[1] * min(n, large[k]) for k, n in small.items() if k in large]) / total


def likeness(a: str, b: str) -> float:
    """Share of characters in leaves that both fingerprints hold, 0 to 1; 1 for equal roots."""
    return 1.0 if a[:32] == b[:32] else _likeness(_bag(parse(a)), _bag(parse(b)))


def locate(a: str, b: str) -> list[tuple[int, int]]:
    """Character spans of the first text whose leaves the second lacks; branches with equal hashes are not entered."""
    if a[:32] == b[:32]:
        return []
    split = lambda m: [s.partition(":") for s in m.partition("|")[2].split(";")] if m.partition("|")[2] else []
    known = {s[0] for s in split(b)}
    paragraphs = {p.partition("=")[0] for s in split(b) for p in s[2].split("+")}
    leaves = _bag(parse(b))
    out: list[tuple[int, int]] = []
    at = 0
    for section, (mark, _, body) in zip(parse(a), split(a), strict=True):
        for paragraph, raw in zip(section, body.split("+"), strict=True):
            skip = mark in known or raw.partition("=")[0] in paragraphs
            for leaf in paragraph:
                if not skip and leaf not in leaves:
                    if out and out[-1][1] == at:
                        out[-1] = (out[-1][0], at + leaf[1])
                    else:
                        out.append((at, at + leaf[1]))
                at += leaf[1]
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come bucket by bucket, ids descending; a bucket ends with a copy of the next bucket's first row."""
    held = None  # (bucket, id, text, tree, bag) that waits for the row behind it
    for batch in batches:
        out: list[tuple] = []
        for bucket, border, doc, text in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
            if border and (held is None or held[0] != bucket):
                continue  # a repeated border row
            own = tree(text)
            bag = _bag(own)
            if held is not None and held[0] == bucket:
                _, last, old, old_tree, old_bag = held
                half = len(old) // 2
                new = old[: len(old) - half] + text[:half]
                new_tree = tree(new)
                out.append((last, len(old), hashlib.sha256(new.encode()).hexdigest(), fingerprint(old_tree), fingerprint(new_tree), _likeness(old_bag, _bag(new_tree)), _likeness(old_bag, bag)))
            held = None if border else (bucket, doc, text, own, bag)
        columns = list(zip(*out, strict=True)) or [[]] * 7
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_NAMES)


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of each text, of its edited form, and their likenesses.

    Edited: the last half (rounded down) of the characters gives way to the first as many of the next row's text, ids
    descending, after the last the first. Ids that are null come last; equal ids are ordered by a hash of the text and then the
    text; a lone row is its own next. Null text counts as empty; two empty texts are alike (1). Other columns are ignored.

    Texts are moved once, by buckets of about equal numbers of ids (bounds: approximate quantiles, one row); each
    bucket gets a copy of the first row of the bucket behind it, one row a bucket. Rows without an id are dealt to as many
    buckets by ranges of the hash; rows that are alike in id and text share a bucket.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(text_col, F.lit("")).alias("body")).withColumn("mark", F.xxhash64("body"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = 4 * parts
    bounds = rows.where("doc is not null").select(F.percentile_approx("doc", [i / n for i in range(1, n)], 100 * n).alias("q")).first()["q"] or []
    splits = [float("-inf"), *sorted({float(x) for x in bounds}), float("inf")]
    # Descending: the highest ids are in bucket 0; null ids go to a bucket of their own at the end.
    dealt = Bucketizer(splits=[float("-inf"), *splits[1:-1], float("inf")], inputCol="_v", outputCol="_b")
    nameless = F.lit(len(splits)) + F.floor((F.col("mark").cast("double") / 2.0**64 + 0.5) * (n - 1)).cast("int")  # a larger hash, a later bucket
    if len(splits) < 3:
        rows = rows.withColumn("bucket", F.when(F.col("doc").isNull(), nameless).otherwise(0)).select("doc", "body", "mark", "bucket")
    else:
        rows = dealt.transform(rows.withColumn("_v", F.coalesce(F.col("doc").cast("double"), F.lit(float("-inf")))))
        rows = rows.withColumn("bucket", F.when(F.col("doc").isNull(), nameless).otherwise(F.lit(len(splits) - 2) - F.col("_b").cast("int"))).select("doc", "body", "mark", "bucket")
    place = F.struct(F.coalesce(F.bitwise_not("doc"), F.lit(0)).alias("down"), "mark")  # in the order of the rows
    first = {r["bucket"]: r["m"] for r in rows.groupBy("bucket").agg(F.min(place).alias("m")).collect()}  # a row a bucket
    if not first:
        return spark.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    order = sorted(first)
    heads = spark.createDataFrame([(order[i], *first[order[i]], order[i - 1]) for i in range(len(order))], "bucket int, head long, head_mark long, before int")
    rows = rows.join(F.broadcast(heads), "bucket").withColumn("leads", (place["down"] == F.col("head")) & (F.col("mark") == F.col("head_mark")))
    places = F.when(F.col("leads"), F.array(F.struct(F.col("bucket"), F.lit(0).alias("border")), F.struct(F.col("before").alias("bucket"), F.lit(1).alias("border")))).otherwise(F.array(F.struct(F.col("bucket"), F.lit(0).alias("border"))))
    rows = rows.select("doc", "body", "mark", F.explode(places).alias("p")).select("p.bucket", "p.border", "doc", "body", "mark")
    rows = rows.repartition(parts, "bucket").sortWithinPartitions("bucket", "border", F.col("doc").desc_nulls_last(), "mark", "body")
    return rows.mapInArrow(_compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double").withColumnRenamed("doc_id", id_col)
