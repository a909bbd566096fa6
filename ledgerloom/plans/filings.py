"""Filings: page words to rows, rows to line items, candidate links to a manifest, nested extractions to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.rules import AVOID, FOLLOW, NOTES, UNDECLARED, any_of, match_label
from ledgerloom.functions.text import absolute_url, downloadable, is_numeric_cell, trim_all, za_number
from ledgerloom.operators.relational import latest, top_rows
from ledgerloom.sources.readers import workbook_format

# Phrases of pages that hold a statement, and what the text of a report link holds.
STATEMENT_WORDS = ("statement of comprehensive income", "statement of financial position", "statement of cash flows", "income statement", "balance sheet", "cash flow statement")
REPORT_YEARS = ("2023", "2024", "2025")
REPORT_WORDS = ("annual report", "integrated report", "annual financial statements", "afs")
# End of fixed values.
EXTRACTION = (
    "page_contains_financial_statement boolean, statement_type string, entity_name string, currency string, unit_scale string, periods array<string>, "
    "line_items array<struct<source_label: string, canonical_label: string, note_ref: string, is_subtotal_or_total: boolean, values: array<struct<period: string, value: double>>, confidence: string, flag_reason: string>>"
)


def word_rows(words: DataFrame, tolerance: float = 2.5) -> DataFrame:
    """(doc, page, line, label, cells, raw) from words with coordinates: a gap wider than 0.55 of the mean height (4 at
    least) starts a new cell; the label is what stands before the first numeric cell."""
    line = F.bround(F.col("top") / tolerance) * tolerance
    rows = words.withColumn("line", line)
    by = Window.partitionBy("doc", "page", "line")
    order = by.orderBy("x0", "x1", "text")
    limit = F.greatest(F.lit(4.0), 0.55 * F.avg(F.col("bottom") - F.col("top")).over(by))
    rows = rows.withColumn("n", F.count(F.lit(1)).over(by)).withColumn("new", (F.coalesce(F.col("x0") - F.lag("x1").over(order) > limit, F.lit(False))).cast("int"))
    rows = rows.where("n >= 2").withColumn("cell", F.sum("new").over(order))
    cells = rows.groupBy("doc", "page", "line", "cell").agg(F.array_sort(F.collect_list(F.struct("x0", "x1", "text"))).alias("w"))
    cells = cells.select("doc", "page", "line", "cell", F.array_join(F.transform("w", lambda x: x["text"]), " ").alias("text"))
    lines = cells.groupBy("doc", "page", "line").agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", "text"))), lambda x: x["text"]).alias("cells"))
    first = F.array_position(F.transform("cells", is_numeric_cell), True).cast("int")
    lines = lines.withColumn("at", first).where("at > 1")
    label = F.regexp_replace(F.trim(F.array_join(F.slice("cells", 1, F.col("at") - 1), " ")), r"[.\s]{3,}$", "")
    return lines.select("doc", "page", "line", F.trim(label).alias("label"), F.slice("cells", F.col("at"), F.size("cells")).alias("cells"), F.array_join("cells", " | ").alias("raw")).where(F.length("label") >= 3)


def pick_column(cells: Column, prefer: str = "first") -> Column:
    """struct(index, value, ambiguous) of the current year's figure: note references (one or two digits in the first two
    cells) and what doesn't parse are dropped; null if nothing is left."""
    parsed = F.transform(cells, lambda c, i: F.struct(i.alias("index"), za_number(c)["value"].alias("value"), za_number(c)["ambiguous"].alias("ambiguous"), (F.trim(c).rlike(r"^\d{1,2}$") & (i <= 1)).alias("note")))
    good = F.filter(parsed, lambda x: x["value"].isNotNull() & ~x["note"])
    pick = F.try_element_at(good, F.lit(1 if prefer == "first" else -1))
    return F.when(pick.isNotNull(), F.struct(pick["index"].alias("index"), pick["value"].alias("value"), pick["ambiguous"].alias("ambiguous")))


def table_rows(tables: DataFrame) -> DataFrame:
    """(doc, page, line, label, cells, raw) from the rows of ruled tables (doc, page, line, cells): the first cell is the label."""
    cells = F.transform("cells", lambda c: F.trim(F.coalesce(c, F.lit(""))))
    rows = tables.select("doc", "page", F.col("line").cast("double").alias("line"), cells.alias("all")).where(F.exists("all", lambda c: c != ""))
    return rows.select("doc", "page", "line", F.col("all")[0].alias("label"), F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(0))).alias("cells"), F.array_join("all", " | ").alias("raw"))


def extract_rows(tables: DataFrame, words: DataFrame, pages: DataFrame) -> DataFrame:
    """Line items of each page: rows of tables first (confidence + .05), then rows made of words (- .05); of rows with the same
    text on a page only the first counts, whether or not it holds an item. ``pages``: doc, page, multiplier, scale_label."""
    both = table_rows(tables).withColumn("origin", F.lit(0)).unionByName(word_rows(words).withColumn("origin", F.lit(1)))
    once = top_rows(both, ["doc", "page", "raw"], [F.col("origin"), F.col("line")])
    rows = once.join(pages, ["doc", "page"]).withColumn("adjustment", F.when(F.col("origin") == 0, 0.05).otherwise(-0.05))
    return line_items(rows, F.col("adjustment"))


def best_items(items: DataFrame) -> DataFrame:
    """The item of the highest confidence of each document and concept; of equals the first in reading order."""
    return top_rows(items, ["doc", "concept"], [F.col("confidence").desc(), F.col("page"), F.col("origin"), F.col("line")])


def low_confidence(items: DataFrame, threshold: float = 0.8) -> DataFrame:
    return items.where(F.col("confidence") < threshold)


def line_items(rows: DataFrame, adjustment: float | Column = -0.05, prefer: str = "first") -> DataFrame:
    """Concepts with value and confidence from rows with label, cells, multiplier and scale_label."""
    out = rows.withColumn("m", match_label(F.col("label"))).withColumn("p", pick_column(F.col("cells"), prefer)).where("m is not null and p is not null")
    conf = 0.5 + F.col("m.specificity") / 20 + (F.lit(adjustment) if isinstance(adjustment, float) else adjustment) - F.when(F.col("p.ambiguous"), 0.25).otherwise(0.0) - F.when(F.col("scale_label") == UNDECLARED, 0.20).otherwise(0.0)
    keep = [F.substring("raw", 1, 300).alias("raw") if c == "raw" else F.col(c) for c in rows.columns if c not in ("cells", "adjustment")]
    return out.select(*keep, F.col("m.concept").alias("concept"), F.col("p.index").alias("column_index"), F.col("p.value").alias("value"), (F.col("p.value") * F.col("multiplier")).alias("scaled_value"), F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), conf)), 2).alias("confidence"))


def note_hits(pages: DataFrame) -> DataFrame:
    """(doc, page, note, excerpt): from 100 characters before the match to 600 behind it."""
    parts = [F.struct(F.lit(k).alias("note"), F.regexp_substr("text", F.lit(f"(?isU){p}")).alias("hit")) for k, p in NOTES]
    rows = pages.select("doc", "page", "text", F.explode(F.array(*parts)).alias("n")).where("n.hit is not null")
    at = F.expr("position(n.hit, text)")
    start = F.greatest(F.lit(1), at - 100)
    return rows.select("doc", "page", F.col("n.note").alias("note"), F.trim(F.substring(F.col("text"), start, at + F.length("n.hit") + 600 - start)).alias("excerpt"))


def worth_following(url: Column, text: Column) -> Column:
    blob = F.lower(F.concat_ws(" ", url, text))
    return any_of(blob, FOLLOW) & ~any_of(blob, AVOID)


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, place, link, absolute, downloadable) of the anchors of each page, however their targets are quoted."""
    found = F.regexp_extract_all("html", F.lit(r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""), 1)
    bare = F.transform(found, lambda x: F.regexp_replace(x, """^["']|["']$""", ""))
    rows = pages.select("page_id", "url", F.posexplode(bare).alias("place", "link"))
    return rows.select("page_id", "place", "link", absolute_url(F.col("link"), F.col("url")).alias("absolute"), downloadable(F.col("link")).alias("downloadable"))


def report_links(links: DataFrame, years: tuple[str, ...] = REPORT_YEARS, words: tuple[str, ...] = REPORT_WORDS) -> DataFrame:
    """Links whose text names a year and a kind of report."""
    text = F.lower("text")
    return links.where(any_of(text, years) & any_of(text, words))


def chosen_files(candidates: DataFrame, selected: DataFrame, n: int = 3) -> DataFrame:
    """(ticker, name, year, place): of each ticker's candidates (ticker, name, year, place) the first ``n`` that are selected
    (ticker, name); where none of the selected is a candidate, the ``n`` of the latest years."""
    asked = selected.select("ticker", "name").distinct()
    marked = candidates.join(asked.withColumn("asked", F.lit(True)), ["ticker", "name"], "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    some = F.bool_or("asked").over(Window.partitionBy("ticker"))
    marked = marked.withColumn("some", some)
    picked = top_rows(marked.where("asked"), ["ticker"], [F.col("place")], n).unionByName(latest(marked.where("not some"), ["ticker"], "year", n, ["place"]))
    return picked.select("ticker", "name", "year", "place")


def named_files(answers: DataFrame, files: DataFrame) -> DataFrame:
    """(ticker, name, place): the ticker's files (ticker, name, seq) that stand in a line of its answer (ticker, text), in order of
    the lines and then of the files, each once."""
    line = F.posexplode(F.split("text", r"\r\n|\r|\n")).alias("line_no", "line")
    lines = answers.select("ticker", line).withColumn("line", trim_all(F.regexp_replace("line", r"(?U)^[\s\-*\d.)]+", "")))
    hits = lines.join(files, "ticker").where(F.col("line").contains(F.col("name"))).groupBy("ticker", "name", "seq").agg(F.min("line_no").alias("line_no"))
    return hits.withColumn("place", F.row_number().over(Window.partitionBy("ticker").orderBy("line_no", "seq"))).select("ticker", "name", "place")


def decisions(candidates: DataFrame, manifest_urls: DataFrame, manifest_hashes: DataFrame, low: int, high: int) -> DataFrame:
    """Status of each candidate: seen, unclassified, out of range, fetch failed, duplicate, stored; the first of equal
    urls or payloads in order of ``seq`` counts."""
    url = F.substring_index("url", "#", 1)
    rows = candidates.withColumn("key", url)
    known = manifest_urls.select(F.col("url").alias("key")).distinct().withColumn("known", F.lit(True))
    hashes = manifest_hashes.select("sha256").distinct().withColumn("held", F.lit(True))
    rows = rows.join(known, "key", "left").join(hashes, "sha256", "left")
    nth = F.row_number().over(Window.partitionBy("key").orderBy("seq"))
    rows = rows.withColumn("nth", nth).withColumn("seen", F.coalesce("known", F.lit(False)) | (F.col("nth") > 1))
    out_of_range = F.col("year").isNotNull() & ~F.col("year").between(low, high)
    early = F.when(F.col("seen"), "seen").when(F.col("doc_type") == "UNKNOWN", "unclassified").when(out_of_range, "out_of_range").when(~F.col("fetched"), "fetch_failed")
    rows = rows.withColumn("early", early)
    same = F.row_number().over(Window.partitionBy("sha256", F.col("early").isNull()).orderBy("seq"))
    return rows.withColumn("status", F.when(F.col("early").isNotNull(), F.col("early")).when(F.coalesce("held", F.lit(False)) | (same > 1), "duplicate").otherwise("stored")).select("seq", "url", "status")


def flatten(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """A row a period of each line item of pages that hold a statement, with defaults for what is missing."""
    rows = docs.withColumn("d", F.from_json(json_col, EXTRACTION)).where("d.page_contains_financial_statement").select("doc", "d", F.explode("d.line_items").alias("i")).select("doc", "d", "i", F.explode("i.values").alias("v"))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return rows.select("doc", text("d.statement_type").alias("statement_type"), text("d.entity_name").alias("entity_name"), text("d.currency").alias("currency"), text("d.unit_scale").alias("unit_scale"), text("i.source_label").alias("source_label"), text("i.canonical_label").alias("canonical_label"), F.coalesce("i.is_subtotal_or_total", F.lit(False)).alias("is_total"), F.col("v.period").alias("period"), F.col("v.value").alias("value"), F.coalesce("i.confidence", F.lit("medium")).alias("confidence"))


def relevant(text: Column, keywords: tuple[str, ...] = STATEMENT_WORDS) -> Column:
    return any_of(F.lower(text), keywords)


def reliable(text: Column) -> Column:
    return (F.length(F.trim(text)) >= 30) & (F.regexp_count(text, F.lit(r"\(cid:")) <= 5)


def file_entity(path: Column) -> Column:
    """The entity that a workbook's file name stands for."""
    stem = F.regexp_replace(F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", ""), "(?i)_Financial_Extraction$", "")
    return F.trim(F.replace(stem, F.lit("_"), F.lit(" ")))


def statement_sheet(cells: DataFrame) -> DataFrame:
    """Statement workbook: the header is the first of the first five rows whose first cell is ``line item`` or ``metric``;
    a header cell names entity, year and restatement; numbers below it are unpivoted."""
    head = cells.where((F.col("row_idx") < 5) & (F.col("col_idx") == 0) & F.lower(F.trim("str")).isin("line item", "metric")).groupBy("file", "sheet").agg(F.min("row_idx").alias("h"))
    pattern = r"(?is)^(.*?)\n?FY(\d{4})\s*(\(Restated\))?\s*(?:\([^)]*\))?$"
    rows = cells.join(head, ["file", "sheet"])
    top = rows.where("row_idx = h and col_idx > 0").select("file", "sheet", "col_idx", F.regexp_extract("str", pattern, 1).alias("entity"), F.regexp_extract("str", pattern, 2).alias("y"), (F.regexp_extract("str", pattern, 3) != "").alias("restated")).where("y <> ''")
    names = rows.where("row_idx > h and col_idx = 0 and trim(str) <> ''").select("file", "sheet", "row_idx", F.trim("str").alias("line_item"))
    values = rows.where("row_idx > h and col_idx > 0 and num is not null").select("file", "sheet", "row_idx", "col_idx", "num")
    stem = file_entity(F.col("file"))
    # A sheet README names the entity in its first cell, ahead of a dash between blanks.
    title = trim_all(F.split("str", r"(?U)\s+[\u2013\u2014-]\s+")[0])
    readme = cells.where("sheet = 'README' and row_idx = 0 and col_idx = 0").select("file", F.when(title != "", title).alias("readme"))
    values = values.join(readme, "file", "left")
    entity = F.when(F.trim("entity") != "", F.trim("entity")).otherwise(F.coalesce("readme", stem))
    return values.join(names, ["file", "sheet", "row_idx"]).join(top, ["file", "sheet", "col_idx"]).select("file", F.col("sheet").alias("statement"), entity.alias("entity_variant"), "line_item", F.col("y").cast("int").alias("year"), "restated", F.col("num").alias("raw_value"), (F.col("num") * 1e6).alias("value_zar"))


def cashflow_sheet(cells: DataFrame, min_year: int = 2023, fx: dict[str, float] | None = None) -> DataFrame:
    """Cash-flow workbook: the header is the first of ten rows whose other cells are all years; rows end at the first label
    that is blank or starts with ``note``; values are scaled and converted to rand."""
    from ledgerloom.config import CONFIG
    from ledgerloom.functions.rules import detect_currency, sheet_scale

    fx = fx or CONFIG.fx_to_zar
    year = F.col("num").between(2000, 2099) & (F.col("num") == F.floor("num"))
    by_row = cells.where("row_idx < 10 and col_idx > 0").where("num is not null or trim(coalesce(str, '')) <> ''").groupBy("file", "row_idx").agg(F.min(F.coalesce(year, F.lit(False)).cast("int")).alias("ok"))
    head = by_row.where("ok = 1").groupBy("file").agg(F.min("row_idx").alias("h"))
    rows = cells.join(head, "file")
    unit = rows.where("row_idx <= h and str is not null").groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_idx", "col_idx", "str"))), lambda x: x["str"]), " ").alias("unit"))
    labels = rows.where("row_idx > h and col_idx = 0").select("file", "row_idx", F.trim(F.coalesce("str", F.lit(""))).alias("line_item"))
    stop = labels.where("line_item = '' or lower(line_item) like 'note%'").groupBy("file").agg(F.min("row_idx").alias("stop"))
    labels = labels.join(stop, "file", "left").where("stop is null or row_idx < stop")
    years = rows.where("row_idx = h and col_idx > 0").select("file", "col_idx", F.col("num").cast("int").alias("year")).where(F.col("year") >= min_year)
    values = rows.where("row_idx > h and col_idx > 0 and num is not null").select("file", "row_idx", "col_idx", "num")
    rate = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in fx.items() for x in kv]), detect_currency(F.col("unit"))), F.lit(1.0))
    return values.join(labels, ["file", "row_idx"]).join(years, ["file", "col_idx"]).join(unit, "file").select("file", "line_item", "year", F.col("num").alias("raw_value"), (F.col("num") * sheet_scale(F.col("unit")) * rate).alias("value_zar"))




def external_lines(cells: DataFrame, min_year: int = 2023, fx: dict[str, float] | None = None) -> DataFrame:
    """Line items of all workbooks, each read by the layout that its sheets show."""
    kinds = workbook_format(cells)
    own = lambda kind: cells.join(kinds.where(F.col("format") == kind).select("file"), "file", "left_semi")
    a = statement_sheet(own("statement"))
    b = cashflow_sheet(own("cashflow"), min_year, fx).withColumns({"statement": F.lit("Cash Flow Statement"), "entity_variant": file_entity(F.col("file")), "restated": F.lit(False)})
    return a.unionByName(b.select(a.columns))
