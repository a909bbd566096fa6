"""Numbers, years, dates, file names and payload checks as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.rules import DOWNLOADABLE, first_of

#: Fixed value: the host of announcement documents.
SENS_HOST = "senspdf.jse.co.za"
_BLANKS = "[\\s   ]"
_DASHES = ("-", "–", "—", "nil", "Nil", "––")
_CURRENCY = r"(?i)[R$€£]|ZAR|USD"


def trim_all(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), then)[0]


def za_number(raw: Column) -> Column:
    """struct(value, negative, ambiguous, note) of a number as printed in South African statements."""

    def core_of(text: Column) -> Column:
        core = F.regexp_replace(F.regexp_replace(text, r"^[()]+|[()]+$", ""), r"^-+", "")
        return F.regexp_replace(F.regexp_replace(core, f"{_CURRENCY}|%", ""), _BLANKS, "")

    def plain_of(core: Column) -> Column:
        """struct(text to parse, thousands)"""
        comma, dot = core.contains(","), core.contains(".")
        last_is_comma = F.length(F.substring_index(core, ",", -1)) < F.length(F.substring_index(core, ".", -1))
        thousands = comma & ~dot & (F.length(F.substring_index(core, ",", -1)) == 3) & (F.length(core) > 4)
        bare, point = F.translate(core, ",", ""), F.translate(F.translate(core, ".", ""), ",", ".")
        return F.struct(F.when(comma & dot & last_is_comma, point).when((comma & dot) | thousands, bare).otherwise(F.translate(core, ",", ".")).alias("t"), thousands.alias("thousands"))

    def result(x: Column) -> Column:
        text, value = x["text"], F.when(x["plain"]["t"].rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), x["plain"]["t"].try_cast("double"))
        negative = (text.startswith("(") & text.endswith(")")) | text.startswith("-")
        empty, dash = text == "", text.isin(*_DASHES)
        return F.struct(
            F.when(empty, F.lit(None)).when(dash, 0.0).otherwise(F.when(negative, -value).otherwise(value)).cast("double").alias("value"),
            F.when(empty | dash, False).otherwise(negative).alias("negative"),
            F.when(empty | dash, False).otherwise(x["plain"]["thousands"] | value.isNull()).alias("ambiguous"),
            F.when(empty, "empty").when(dash, "dash means nil").when(value.isNull(), "unparseable").when(x["plain"]["thousands"], "3-digit group after comma: thousands vs decimal ambiguous").otherwise("").alias("note"),
        )

    return _let(_let(trim_all(raw), lambda t: F.struct(t.alias("text"), _let(core_of(t), plain_of).alias("plain"))), result)


def is_numeric_cell(cell: Column) -> Column:
    text = trim_all(cell)
    core = F.regexp_replace(F.replace(F.regexp_replace(text, r"^[()]+|[()]+$", ""), F.lit("%"), F.lit("")), r"(?U)^\s+|\s+$", "")
    core = trim_all(F.regexp_replace(core, _CURRENCY, ""))
    return text.isin("-", "–", "—") | core.rlike("^[\\d\\s .,]+$")


def report_year(text: Column, low: int = 2023, high: int = 2030) -> Column:
    """struct(year, confidence): the first pattern whose first match is a year in the window."""
    full = lambda y: F.when(F.length(y) == 4, y.try_cast("int")).otherwise(2000 + y.try_cast("int"))
    steps = [
        (F.regexp_extract(text, r"(?iU)\bFY[\s\-]?(\d{2,4})\b", 1), "fy_label"),
        (F.regexp_extract(text, r"(?iU)(?:year|period)\s+end(?:ed|ing)\s+\d{1,2}\s+\w+\s+(20\d{2})", 1), "explicit_fye"),
        (F.regexp_extract(text, r"(?U)\b20\d{2}\s*[/-]\s*(\d{2,4})\b", 1), "bare"),
        (F.regexp_extract(text, r"(?U)\b(20[12]\d)\b", 1), "bare"),
    ]
    rules = [((y != "") & full(y).between(low, high), F.struct(full(y).alias("year"), F.lit(c).alias("confidence"))) for y, c in steps]
    return first_of(rules, F.struct(F.lit(None).cast("int").alias("year"), F.lit("none").alias("confidence")))


def file_year(name: Column) -> Column:
    """The latest 20xx in a file name."""
    return F.array_max(F.transform(F.regexp_extract_all(name, F.lit(r"(20\d{2})"), 1), lambda x: x.cast("int")))


def robust_date(text: Column) -> Column:
    """Day-first, mixed formats, a time of day behind the date left out; two-digit years from 69 on are 19xx; null if none fits."""
    formats = ("yyyy-MM-dd", "d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "d MMM yyyy", "d-MMM-yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "yyyy/M/d", "yyyyMMdd")
    parsed = lambda day, these: F.coalesce(*[F.try_to_timestamp(day, F.lit(f)).cast("date") for f in these])
    short = lambda day: _let(parsed(day, ("d/M/yy", "d-M-yy", "d.M.yy", "d MMM yy", "d-MMM-yy")), lambda x: F.when(F.year(x) > 2068, F.add_months(x, -1200)).otherwise(x))
    return _let(F.regexp_replace(trim_all(text), r"(?<=\d)[T ]+\d{1,2}:\d{2}.*$", ""), lambda day: F.coalesce(parsed(day, formats), short(day)))


def absolute_url(link: Column, base: Column) -> Column:
    """The link as seen from the page at ``base``: dot segments resolved; null without a base for a link that needs one."""
    scheme, host = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)//", 1), F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.when(path.contains("/"), F.regexp_extract(path, r"^(.*/)", 1)).otherwise("/")
    own, tail = F.regexp_extract(link, r"^([^?#]*)", 1), F.regexp_extract(link, r"^[^?#]*(.*)$", 1)
    joined = F.when(link.startswith("/"), own).otherwise(F.concat(folder, own))
    step = lambda a, x: F.when(x == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(1)))).when(x == ".", a).otherwise(F.concat(a, F.array(x)))
    parts = F.aggregate(F.split(F.substring(joined, 2, 1 << 20), "/"), F.array(F.lit("")), step)
    ends_in_dots = joined.rlike(r"/\.{1,2}$")
    clean = F.concat(F.array_join(parts, "/"), F.when(ends_in_dots, "/").otherwise(""))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link).when(scheme == "", F.lit(None)).when(link.startswith("//"), F.concat(scheme, link))
        .when(link == "", F.regexp_extract(base, r"^([^#]*)", 1)).when(link.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), link))
        .when(link.startswith("?"), F.concat(host, path, link)).otherwise(F.concat(host, clean, tail))
    )


def sens_links(text: Column, host: str = SENS_HOST) -> Column:
    """Distinct links to announcement documents, in order."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?i)https?://{host.replace('.', chr(92) + '.')}/documents/\d{{4}}/[^\s\"'<>)]+\.pdf"), 0))


def sens_date(text: Column) -> Column:
    """The first dd-mm-20yy or dd/mm/20yy; null if there is none or no such day."""
    parts = [F.regexp_extract(text, r"\b(\d{2})[-/](\d{2})[-/](20\d{2})\b", i) for i in (3, 2, 1)]
    return F.when(parts[0] != "", F.try_to_timestamp(F.concat_ws("-", *parts), F.lit("yyyy-MM-dd")).cast("date"))


def safe_file_name(text: Column, most: int = 60) -> Column:
    """Blanks squeezed, reserved signs left out, cut to ``most`` characters."""
    return F.substring(F.regexp_replace(trim_all(F.regexp_replace(text, r"(?U)\s+", " ")), r'[<>:"/\\|?*\[\]]', ""), 1, most)


def fiscal_year_end(ticker: Column, year: Column, months: dict[str, int], default: int = 12) -> Column:
    """Last day of the fiscal year by each ticker's closing month (a lookup that callers pass)."""
    month = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in months.items() for x in kv]), F.upper(ticker)), F.lit(default)) if months else F.lit(default)
    return F.last_day(F.make_date(year, month, F.lit(1)))


def downloadable(url: Column) -> Column:
    return F.lower(F.substring_index(F.substring_index(url, "?", 1), "#", 1)).rlike(rf"\.({'|'.join(DOWNLOADABLE)})$")


def slug(name: Column, most: int = 80) -> Column:
    """Lower-case ASCII form of a file's stem."""
    plain = F.translate(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), "ÀÁÂÃÄÅàáâãäåÈÉÊËèéêëÌÍÎÏìíîïÒÓÔÕÖòóôõöÙÚÛÜùúûüÇçÑñÝýÿ", "AAAAAAaaaaaaEEEEeeeeIIIIiiiiOOOOOoooooUUUUuuuuCcNnYyy")
    base = F.substring_index(F.regexp_replace(plain, r"[^\x00-\x7F]", ""), "/", -1)
    stem = F.regexp_replace(base, r"(?<=.)\.[^.]*$", "")
    stem = F.regexp_replace(F.regexp_replace(F.regexp_replace(stem, r"[^A-Za-z0-9._-]+", "-"), r"^[-_.]+|[-_.]+$", ""), r"-{2,}", "-")
    cut = F.substring(stem, 1, most)
    return F.lower(F.when(cut == "", "document").otherwise(cut))


def url_file_name(url: Column) -> Column:
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    name = F.substring_index(F.regexp_replace(path, "/+$", ""), "/", -1)
    return F.when(name == "", "document.pdf").otherwise(name)


def build_file_name(ticker: Column, year: Column, kind: Column, original: Column, extension: Column) -> Column:
    ext = F.lower(F.when(extension.startswith("."), extension).otherwise(F.concat(F.lit("."), extension)))
    return F.concat(F.upper(ticker), F.lit("_"), F.coalesce(F.when(year != 0, year).cast("string"), F.lit("UNDATED")), F.lit("_"), kind, F.lit("_"), slug(original), ext)


def validate_payload(content: Column, kind: Column, url: Column) -> Column:
    """struct(ok, extension, reason) from magic bytes, else a look for HTML, else trust in the declared type."""
    head = F.hex(F.substring(content, 1, 4))
    low = F.lower(F.decode(F.substring(content, 1, 512), "ISO-8859-1"))
    made = lambda ok, ext, why: F.struct(F.lit(ok).alias("ok"), (ext if isinstance(ext, Column) else F.lit(ext)).alias("extension"), (why if isinstance(why, Column) else F.lit(why)).alias("reason"))
    office = first_of([(F.lower(url).contains(e), F.lit(e)) for e in (".pptx", ".xlsx", ".docx")], F.lit(".zip"))
    wall = F.when(low.rlike("login|sign in|cloudflare|captcha"), "login wall / challenge page").otherwise("HTML returned where a document was expected")
    return first_of(
        [
            (head == "25504446", made(True, ".pdf", "")),
            (head == "504B0304", made(True, office, "")),
            (head == "D0CF11E0", made(True, ".doc", "")),
            (low.rlike("<html|<!doctype html"), made(False, ".html", wall)),
            (kind.isin("application/pdf", "application/octet-stream") & (F.octet_length(content) > 1024), made(True, ".pdf", "content-type trusted, no magic bytes")),
        ],
        made(False, "", "unrecognised payload"),
    )
