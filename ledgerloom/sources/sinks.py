"""Sinks: CSV with index or fixed header, several sheets as folders, JSON report, text notes."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, index_by: list[Column] | None = None, names: dict[str, str] | None = None) -> None:
    """CSV with a header; ``index_by`` adds a first column 0..n-1 in that order (small reports), ``names`` renames."""
    if index_by:
        df = df.select((F.row_number().over(Window.orderBy(*index_by)) - 1).alias("index"), "*")
    df.withColumnsRenamed(names or {}).write.mode("overwrite").option("header", True).csv(path)


def write_sheets(sheets: dict[str, DataFrame], folder: str) -> None:
    """Each sheet as a CSV folder of its name."""
    for name, df in sheets.items():
        write_csv(df, f"{folder}/{name.lower().replace(' ', '_')}")


def write_workbook(spark: SparkSession, path: str, sheets: dict[str, list[list]]) -> None:
    """A small .xlsx file: sheets of rows of numbers and texts."""
    main, links = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"

    def cell(i: int, j: int, v) -> str:
        ref = f"{chr(65 + j)}{i + 1}"
        return f'<c r="{ref}"><v>{v}</v></c>' if isinstance(v, (int, float)) else f'<c r="{ref}" t="inlineStr"><is><t>{escape(v)}</t></is></c>'

    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{links}"><sheets>{"".join(f"""<sheet name={quoteattr(n)} sheetId="{i}" r:id="r{i}"/>""" for i, n in enumerate(sheets, 1))}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{k + 1}">{"".join(cell(k, j, v) for j, v in enumerate(r) if v is not None)}</row>' for k, r in enumerate(rows))
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p)
    out.write(bytearray(buf.getvalue()))
    out.close()


def wallet_report(portfolio: DataFrame) -> DataFrame:
    """The portfolio as printed: millions to two places, shares to one."""
    money = [c for c in portfolio.columns if c.endswith("_zar")]
    return portfolio.withColumns({c: F.bround(F.col(c) / 1e6, 2) for c in money} | {"captured_share_pct": F.bround("captured_share_pct", 1)}).orderBy("opportunity_rank")


def write_json(df: DataFrame, path: str) -> None:
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def append_manifest(old: DataFrame, new: DataFrame, path: str) -> None:
    """Append what the manifest lacks, by url."""
    from ledgerloom.operators.relational import append_new

    append_new(old, new, ["url"]).write.mode("append").parquet(path)


def folder_stamp(tickers: DataFrame) -> DataFrame:
    """Up to four tickers joined, else three and how many more."""
    all_ = F.array_sort(F.collect_set("ticker"))
    few = F.array_join(all_, "_")
    return tickers.agg(F.when(F.size(all_) <= 4, few).otherwise(F.concat(F.array_join(F.slice(all_, 1, 3), "_"), F.lit("_+"), (F.size(all_) - 3).cast("string"), F.lit("more"))).alias("stamp"))


def note_name(name: Column) -> Column:
    return F.regexp_replace(name, r"[^\p{L}\p{N} _-]", "")
