"""Readers: ledgers, workbooks, overlays, ticker lists, filing folders."""

from __future__ import annotations

import io
import json
import re
import warnings
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import file_year

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}


def read_ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and an explicit schema; a cell that doesn't parse is null."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def find_source(names: list[str], base: str) -> str | None:
    """The file of a base name: csv, then xlsx, then xls; by exact name first, then whatever the case of the stem."""
    for ext in (".csv", ".xlsx", ".xls"):
        if base + ext in names:
            return base + ext
    low = {n.lower(): n for n in names}
    return next((low[base.lower() + ext] for ext in (".csv", ".xlsx", ".xls") if base.lower() + ext in low), None)


def load_ledgers(spark: SparkSession, folder: str, names: list[str], schemas: dict[str, str]) -> dict[str, DataFrame]:
    """The books found in ``folder`` by base name; a missing one warns, none at all is an error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = [x.getPath().getName() for x in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    out: dict[str, DataFrame] = {}
    for name in names:
        found = find_source(there, name)
        if found is None:
            warnings.warn(f"no {name}.csv or .xlsx in {folder}", stacklevel=2)
        elif found.lower().endswith(".csv"):
            out[name] = read_ledger(spark, f"{folder}/{found}", schemas[name])
        else:
            out[name] = sheet_table(read_workbooks(spark, f"{folder}/{found}"), "Sheet1", schemas[name])
    if not out:
        raise FileNotFoundError(f"none of {', '.join(names)} in {folder}")
    return out


def sheet_table(cells: DataFrame, sheet: str, schema: str) -> DataFrame:
    """A sheet whose first row holds the columns' names, as a table; a cell that doesn't parse is null."""
    own = cells.where(F.col("sheet") == sheet).withColumn("v", F.coalesce("str", F.col("num").cast("string")))
    head = own.where("row_idx = 0").select("file", "col_idx", F.trim("v").alias("name"))
    fields = [f.split() for f in schema.split(",")]
    body = own.where("row_idx > 0").join(head, ["file", "col_idx"]).groupBy("file", "row_idx").pivot("name", [n for n, _ in fields]).agg(F.first("v"))
    return body.select(*[F.col(n).try_cast(k).alias(n) for n, k in fields])


def read_overrides(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """A JSON object of objects as rows: ``key`` holds each entry's name, ``seq`` its place (a name may come twice)."""
    pairs: list[tuple] = json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()), object_pairs_hook=list)
    fields = [f.split()[0] for f in schema.split(",")]
    rows = [(k, *[dict(v).get(f) for f in fields], i) for i, (k, v) in enumerate(pairs)]
    return spark.createDataFrame(rows, f"{key} string, {schema}, seq int")


def workbook_cells(data: bytes) -> Iterator[tuple[str, int, int, float | None, str | None]]:
    """(sheet, row, column, number, text) of the filled cells of an .xlsx file."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).find("m:sheets", _NS):
            target = links[sheet.get(f"{{{_NS['r']}}}id")].lstrip("/")
            root = ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
            for c in root.iter(f"{{{_NS['m']}}}c"):
                letters, digits = re.match(r"([A-Z]+)(\d+)", c.get("r")).groups()
                col = 0
                for ch in letters:
                    col = col * 26 + ord(ch) - 64
                value, kind = c.find("m:v", _NS), c.get("t")
                inline = c.find("m:is", _NS)
                if inline is not None:
                    yield sheet.get("name"), int(digits) - 1, col - 1, None, "".join(t.text or "" for t in inline.iter(f"{{{_NS['m']}}}t"))
                elif value is not None and kind == "s":
                    yield sheet.get("name"), int(digits) - 1, col - 1, None, shared[int(value.text)]
                elif value is not None and kind in (None, "n"):
                    yield sheet.get("name"), int(digits) - 1, col - 1, float(value.text), None
                elif value is not None:
                    yield sheet.get("name"), int(digits) - 1, col - 1, None, value.text


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows = [(path, *c) for c in workbook_cells(content)]
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.string()], strict=True)], names=["file", "sheet", "row_idx", "col_idx", "num", "str"])


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """Long cells (file, sheet, row_idx, col_idx, num, str) of all .xlsx files below a path, a workbook a task row."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInArrow(_cells, "file string, sheet string, row_idx long, col_idx long, num double, str string")


def workbook_format(cells: DataFrame) -> DataFrame:
    """statement if a workbook has one of the known sheets, else cashflow."""
    known = F.col("sheet").isin("Income Statement", "Balance Sheet", "Cash Flow Statement", "Market & Governance KPIs")
    return cells.groupBy("file").agg(F.when(F.bool_or(known), "statement").otherwise("cashflow").alias("format"))


def filing_folder(spark: SparkSession, path: str, min_year: int, include_undated: bool = True) -> DataFrame:
    """(path, ticker, year) of the PDF files below a path; the ticker is the folder, the year comes from the name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", True).load(path).select("path")
    year = file_year(F.substring_index("path", "/", -1))
    rows = files.select("path", F.upper(F.element_at(F.split("path", "/"), -2)).alias("ticker"), year.alias("year"))
    return rows.where((F.col("year") >= min_year) | (F.col("year").isNull() & F.lit(include_undated)))


def read_tickers(spark: SparkSession, path: str) -> DataFrame:
    """Upper-case tickers; comments behind ``#`` and blank lines are left out."""
    line = F.upper(F.trim(F.substring_index("value", "#", 1)))
    return spark.read.text(path).select(line.alias("ticker")).where("ticker <> ''")


def overlay(defaults: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """Overrides win row by row; the last of repeated keys counts (column ``seq``)."""
    from ledgerloom.operators.relational import top_rows

    last = top_rows(overrides, [key], [F.col("seq").desc()]).drop("seq")
    return last.unionByName(defaults.join(last.select(key), key, "left_anti"))


def page_anchor_links(html: DataFrame) -> DataFrame:
    """Distinct links that end in pdf."""
    found = F.explode(F.regexp_extract_all("html", F.lit(r'(?i)href="([^"]*pdf)"'), 1)).alias("link")
    return html.select(found).distinct()
