"""WARC archives: revisit resolution, deduplicated writing, reading.

Only headers (id, payload digest, length) are shuffled by digest to find each payload's first capture. Records are then
dealt to archives of bounded size and written through Spark's text sink, gzipped: a record is its header block, an empty
line and the payload, and every WARC record ends with two line ends, which serve as the sink's separator.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, scratch

#: Payloads shorter than this are never revisits of one another.
SHORTEST = 100
#: About so many payload bytes (uncompressed) go to one archive, so that one fits a reader's memory.
ARCHIVE_BYTES = 16 << 20
_END = "\r\n"
#: What stands ahead of a payload: pages come without the head that they were sent with.
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _line(value: Column) -> Column:
    """A header value on one line: line ends and percent signs are percent-encoded."""
    return F.replace(F.replace(F.replace(value, F.lit("%"), F.lit("%25")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def resolve(headers: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(id, digest, refers_to) of the revisits among (id, digest, bytes): equal payloads refer to the smallest id."""
    first = headers.where((F.col("bytes") >= shortest) & F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("refers_to"), F.max("id").alias("last")).where("last > refers_to")
    first = materialize(first)  # both sides of the join below come straight from a shuffle, so Spark can split a hot digest
    return headers.where(F.col("bytes") >= shortest).join(first.drop("last"), "digest").where("id > refers_to").select("id", "digest", "refers_to").distinct()


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", shortest: int = SHORTEST, archives: int | None = None) -> DataFrame:
    """One text per page: the WARC record without its closing line ends, dealt to ``archives`` partitions.

    Null payloads are empty, null urls too. Null ids are written as responses without a page number and never refer or are
    referred to; so is each repeated row of the smallest id. A record's id is made of page number and digest, so rows that
    repeat both are one capture with one id; rows without a number get an id each.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256)).withColumn("bytes", F.octet_length("payload").cast("long"))
    heads = rows.select("id", "digest", "bytes")
    if archives is None:
        total = heads.agg(F.sum("bytes")).first()[0] or 0
        archives = max(1, -(-int(total) // ARCHIVE_BYTES))
    again = resolve(heads, shortest).withColumnRenamed("id", "deal")
    # Dealt by id (without one: by url) and digest: the join and the archives share one shuffle of the payloads.
    rows = rows.withColumn("deal", F.coalesce("id", F.xxhash64("url", F.monotonically_increasing_id())))
    met = rows.repartition(archives, "deal", "digest").join(again.repartition(archives, "deal", "digest").hint("merge"), ["deal", "digest"], "left")
    revisit = F.col("refers_to").isNotNull() & F.col("id").isNotNull()
    mark = lambda of: F.regexp_replace(F.md5(of.cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")
    capture = lambda page: mark(F.concat_ws(":", page.cast("string"), F.col("digest")))
    fresh = F.concat_ws(
        _END,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), F.when(F.col("id").isNotNull(), capture(F.col("id"))).otherwise(mark(F.concat_ws(":", F.lit("row"), F.col("deal").cast("string"), F.col("digest"))))),
        F.concat(F.lit("Page-ID: "), F.col("id").cast("string")),
        F.concat(F.lit("WARC-Target-URI: "), _line(F.col("url"))),
        F.lit("WARC-Date: 2024-01-01T00:00:00Z"),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), capture(F.col("refers_to")))),
        F.when(revisit, F.concat(F.lit("Refers-To-Page-ID: "), F.col("refers_to").cast("string"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.lit(len(_HTTP)) + F.when(revisit, 0).otherwise(F.col("bytes"))).cast("string")),
    )
    return met.select(F.concat(fresh, F.lit(_END * 2), F.lit(_HTTP), F.when(revisit, F.lit("")).otherwise(F.col("payload"))).alias("value"))


def write(pages: DataFrame, folder: str, **options) -> None:
    """Write the pages' records as gzipped archives into ``folder``."""
    records(pages, **options).write.option("lineSep", _END * 2).option("compression", "gzip").text(folder)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """(headers, content) of each record of an uncompressed archive, by Content-Length."""
    view, at = memoryview(data), 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        head = dict(x.split(": ", 1) for x in data[at:stop].decode().split(_END)[1:] if ": " in x)
        at = stop + 4 + int(head["Content-Length"])
        yield head, view[stop + 4 : at]
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"no end of record at byte {at}")
        at += 4


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def _read(with_payload: bool):
    names = ["page_id", "url", "record_type", "digest", "bytes", "refers_to", *["payload"] * with_payload]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                data = blob.as_buffer().to_pybytes()
                out: list[tuple] = []
                size = 0
                for head, content in parse(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                    kind, payload = head["WARC-Type"], content[len(_HTTP) :]
                    digest = hashlib.sha256(payload).hexdigest() if kind == "response" else head["WARC-Payload-Digest"].removeprefix("sha256:")
                    if head["WARC-Payload-Digest"] != f"sha256:{digest}":
                        raise ValueError(f"digest of record {head['WARC-Record-ID']} is wrong")
                    url = head.get("WARC-Target-URI", "").replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                    out.append((_number(head.get("Page-ID")), url, kind, digest, len(payload), _number(head.get("Refers-To-Page-ID")), *[bytes(payload)] * with_payload))
                    size += len(payload) if with_payload else 100
                    if size > 4 << 20:
                        yield _rows(out)
                        out, size = [], 0
                yield _rows(out)

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        columns = list(zip(*out, strict=True)) or [[]] * len(names)
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names=names)

    return run


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Records of the archives in ``folder``: page_id, url, record_type, digest, bytes (as stored), refers_to, payload.

    Each response's payload is held against its digest. Archives are files of bounded size, read whole by one task each.
    """
    schema = "page_id long, url string, record_type string, digest string, bytes long, refers_to long" + ", payload binary" * with_payload
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(_read(with_payload), schema)


def resolved(captures: DataFrame) -> DataFrame:
    """Captures with the full payload's length: a revisit takes that of the response it refers to."""
    own = captures.where("record_type = 'response'").select("page_id", "digest", F.col("bytes").alias("full")).dropDuplicates(["page_id", "digest"])
    own = materialize(own)  # so that Spark can split a response with many revisits
    again = captures.where("record_type = 'revisit'").select("page_id", "digest", "record_type", "refers_to")
    met = again.join(own.withColumnRenamed("page_id", "refers_to"), ["refers_to", "digest"], "left")
    cols = ["page_id", "digest", "record_type", "refers_to", "full"]
    return captures.where("record_type = 'response'").withColumn("full", F.col("bytes")).select(cols).unionByName(met.select(cols))


def archive_folder(spark: SparkSession) -> str:
    return scratch(spark, "ledgerloom-warc")
