"""Ordered pattern rules as Column expressions: one CASE over one rule number, then lookups by that number."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, weights and labels that results depend on, in order of precedence.
EXCLUDED = (
    r"depreciation", r"amortisation", r"impairment", r"income tax", r"\btax paid\b", r"earnings per share",
    r"dividend yield", r"adjusted p/e", r"shares in issue", r"lowest price", r"highest price", r"closing share price",
    r"other income", r"fair value adjustment", r"profit", r"total assets", r"total liabilities", r"total equity",
    r"total non-current", r"total current", r"property, plant", r"intangible assets", r"right-of-use", r"deferred tax",
    r"cash and cash equivalents", r"non-current assets held for sale", r"lease liabilit", r"net increase", r"net cash",
    r"other movements", r"other investing", r"other financing", r"repayment of lease", r"dividends paid",
    r"dividends received", r"acquisition of property", r"acquisition of intangible",
)
GM, IB, TB, CEILING = "Global Markets", "Investment Banking", "Transactional Banking", "ceiling_only"
FLOWS = (
    (GM, r"foreign exchange gain", 50.0), (GM, r"net monetary gain", 50.0), (GM, r"finance income", 12.5),
    (GM, r"finance cost", 12.5), (GM, r"finance costs? paid", 12.5), (GM, r"finance income received", 12.5),
    (GM, r"interest received", 12.5), (GM, r"interest paid", 12.5), (IB, r"proceeds from borrowings", 1.0),
    (IB, r"repayment of borrowings", 1.0), (IB, r"borrowings \(non-current\)", 1.0), (IB, r"borrowings \(current\)", 1.0),
    (IB, r"borrowings incurred", 1.0), (IB, r"borrowings repaid", 1.0), (IB, r"investment in associate", 1.0),
    (IB, r"^investments$|other investments", 1.0), (IB, r"disposal of subsidiaries", 1.0), (IB, r"market cap", 1.0),
    (IB, r"total shares traded", 1.0), (TB, r"trade and other receivables", 1.0), (TB, r"trade and other payables", 1.0),
    (TB, r"cash generated from operations", 1.0), (TB, r"cash flows from operations", 1.0),
    (TB, r"mobile money|mobile financial deposits", 1.0),
)
CEILINGS = (
    r"^revenue$", r"direct network and technology operating costs", r"costs of handsets",
    r"interconnect and roaming costs", r"staff costs", r"selling, distribution and marketing",
    r"government and regulatory costs", r"other operating expenses",
)
CURRENCIES = ((r"US\$|USD", "USD"), (r"£|GBP", "GBP"), (r"€|EUR", "EUR"), (r"\bZAR\b|\bRm\b|\(R\)", "ZAR"))
SHEET_SCALES = ((r"\bbn\b|\bbillion\b", 1e9), (r"\brm\b|\bmillion\b|\bmn\b|\busd\s*m\b|\$m\b", 1e6), (r"'000|\bthousand\b", 1e3))
PAGE_SCALES = (
    (r"R\s?['’]?\s?bn|R\s?billion|ZAR\s?bn", 1e9, "billions"), (r"R\s?['’]?\s?m\b|R\s?million|Rm\b|ZAR\s?m\b", 1e6, "millions"),
    (r"R\s?['’]\s?000|R\s?thousand|R'000|ZAR\s?['’]000", 1e3, "thousands"), (r"\bcents?\b", 0.01, "cents"),
)
UNDECLARED = "units (NOT DECLARED - verify manually)"
STATEMENTS = (
    (r"(consolidated\s+)?(statements?\s+of\s+)?(comprehensive\s+income|profit\s+or\s+loss|income\s+statement)", "statement_of_comprehensive_income"),
    (r"(consolidated\s+)?(statements?\s+of\s+)?(financial\s+position|balance\s+sheet)", "statement_of_financial_position"),
    (r"(consolidated\s+)?(statements?\s+of\s+)?cash\s*flows?", "statement_of_cash_flows"),
    (r"(consolidated\s+)?statements?\s+of\s+changes\s+in\s+equity", "statement_of_changes_in_equity"),
)
NOTES = (
    ("financial_risk_management", r"financial\s+(risk\s+management|instruments)\b.{0,120}?(foreign\s+currency|market\s+risk|currency\s+risk)"),
    ("foreign_currency_exposure", r"(foreign\s+currency\s+(exposure|risk)|uncovered\s+foreign|forward\s+exchange\s+contracts?)"),
    ("borrowings_and_facilities", r"(borrowings?|interest[- ]bearing\s+liabilities|credit\s+facilit(y|ies))\b.{0,200}?(maturit|repayable|facility\s+limit|covenant)"),
    ("debt_maturity_schedule", r"(maturity\s+(profile|analysis|schedule)|repayable\s+(within|after)|contractual\s+maturit)"),
    ("segmental_reporting", r"(segment(al)?\s+(report|information|analysis)|operating\s+segments|geographical\s+segments)"),
    ("group_structure", r"(principal\s+subsidiar|interest\s+in\s+subsidiar|group\s+structure|joint\s+ventures?\s+and\s+associates)"),
    ("covenants", r"(covenant|net\s+debt\s*[:/]\s*EBITDA|interest\s+cover(age)?\s+ratio|gearing\s+ratio)"),
)
_INTERIM = (r"\binterim\b", r"half[\s\-]?year", r"\bsix months?\b", r"\bH1\b", r"first half", r"\bQ[1-4]\b")
_SLIDES = (r"\bpresentation\b", r"\bslides?\b", r"\bbooklet\b", r"\bwebcast\b", r"\broadshow\b")
#: (type, base, anchors, boosts, vetoes)
DOCUMENT_TYPES = (
    ("IAR", 10, (r"integrated[\s\-]*(annual[\s\-]*)?report", r"\bIAR\b", r"\bannual report\b", r"integrated[\s\-]*review"),
     ((r"integrated", 8), (r"\bIAR\b", 6), (r"value creation", 2), (r"\.pdf(\?|$)", 2)),
     (*_INTERIM, *_SLIDES, r"notice of (the )?annual general", r"\bAGM\b", r"\bsummar(y|ised)\b")),
    ("AFS", 10, (r"(annual|consolidated|group|audited|separate)[\s\-]*financial statements", r"\bAFS\b", r"financial statements for the year", r"audited (consolidated )?results for the year"),
     ((r"\baudited\b", 8), (r"\bconsolidated\b", 4), (r"\bgroup\b", 2), (r"for the (financial )?year end", 4)),
     (*_INTERIM, *_SLIDES, r"\bsummar(y|ised)\b", r"\bprovisional\b")),
    ("SUMRES", 15, (r"summar(y|ised|ized)\s+(audited\s+)?(consolidated\s+)?(annual\s+)?(financial\s+statements|results)", r"provisional\s+(audited\s+)?results", r"(audited\s+)?(short[\s\-]?form|abridged)\s+(announcement|results)", r"preliminary\s+(audited\s+)?results"),
     ((r"for the year end", 4), (r"\baudited\b", 3)), (*_INTERIM, *_SLIDES)),
    ("INTERIM", 10, (r"\binterim\b", r"half[\s\-]?year", r"\bsix months? end", r"\bH1[\s\-]?(FY)?\d{2,4}\b"),
     ((r"results", 6), (r"reviewed|unaudited", 4), (r"condensed", 4), (r"financial statements", 3)), _SLIDES),
    ("SENS", 12, (r"\bSENS\b", r"senspdf\.jse\.co\.za", r"stock exchange news service", r"cautionary announcement", r"\bdealings? in securities\b"),
     ((r"senspdf\.jse\.co\.za", 15), (r"announcement", 3)), ()),
    ("TRADESTMT", 14, (r"trading (statement|update)", r"operational update", r"business update", r"voluntary (trading )?(statement|update)", r"pre[\s\-]?close (update|presentation)"),
     ((r"\bHEPS\b|headline earnings", 6), (r"further trading statement", 4)), ()),
    ("PRES", 12, (r"\bpresentation\b", r"results booklet", r"\bslides?\b", r"investor day", r"capital markets day", r"\bwebcast\b"),
     ((r"results", 4), (r"\.pptx?(\?|$)", 6), (r"investor", 3)), ()),
    ("DEBT", 14, (r"programme memorandum", r"base prospectus", r"\bDMTN\b", r"domestic medium[\s\-]term note", r"applicable pricing supplement", r"debt investors?", r"bond (issuance|programme)", r"credit rating (report|announcement)"),
     ((r"supplement", 3), (r"\bnotes?\b", 2)), ()),
    ("ESG", 11, (r"\bESG\b", r"sustainability report", r"climate (change )?(report|disclosure)", r"\bTCFD\b", r"\bGRI\b index", r"transformation report", r"\bB[\s\-]?BBEE\b"), (), ()),
    ("AGM", 13, (r"notice of (the )?annual general meeting", r"\bAGM\b", r"form of proxy"), (), ()),
)
#: (concept, pattern, specificity)
LABELS = (
    ("revenue", r"^revenue\s+from\s+contracts?\s+with\s+customers", 10), ("revenue", r"^total\s+revenue\b", 9), ("revenue", r"^revenue\b", 7),
    ("revenue", r"^turnover\b", 7), ("revenue", r"^sale\s+of\s+merchandise", 6), ("revenue", r"^gross\s+revenue\b", 5),
    ("cost_of_sales", r"^cost\s+of\s+sales\b", 10), ("cost_of_sales", r"^cost\s+of\s+goods\s+sold", 10), ("cost_of_sales", r"^cost\s+of\s+merchandise\s+sold", 9),
    ("gross_profit", r"^gross\s+(profit|margin)\b", 10),
    ("operating_expenses", r"^total\s+operating\s+expenses", 10), ("operating_expenses", r"^operating\s+(expenses|costs)\b", 8), ("operating_expenses", r"^other\s+operating\s+expenses", 6),
    ("staff_costs", r"^(staff|employee|personnel)\s+(costs?|expenses?|benefits?\s+expense)", 10), ("staff_costs", r"^salaries\s+and\s+wages", 8), ("staff_costs", r"^employment\s+costs?", 8),
    ("operating_profit", r"^operating\s+(profit|income)\b", 9), ("operating_profit", r"^(profit|earnings)\s+before\s+interest\s+and\s+tax", 9), ("operating_profit", r"^\bEBIT\b", 8),
    ("finance_costs", r"^finance\s+(costs?|charges?|expenses?)", 10), ("finance_costs", r"^interest\s+(paid|expense)", 8),
    ("profit_for_the_year", r"^profit\s+for\s+the\s+(year|period)", 10), ("profit_for_the_year", r"^net\s+(profit|income)\b", 8),
    ("inventories", r"^inventor(y|ies)\b", 10), ("inventories", r"^stock\s+on\s+hand", 8), ("inventories", r"^merchandise\s+inventor", 8),
    ("trade_receivables", r"^trade\s+(and\s+other\s+)?receivables", 10), ("trade_receivables", r"^trade\s+accounts?\s+receivable", 10), ("trade_receivables", r"^accounts?\s+receivable\b", 7), ("trade_receivables", r"^debtors\b", 6),
    ("trade_payables", r"^trade\s+(and\s+other\s+)?payables", 10), ("trade_payables", r"^trade\s+accounts?\s+payable", 10), ("trade_payables", r"^accounts?\s+payable\b", 7), ("trade_payables", r"^creditors\b", 6),
    ("cash_and_equivalents", r"^cash\s+and\s+cash\s+equivalents", 10), ("cash_and_equivalents", r"^cash\s+and\s+short[- ]term\s+deposits", 9), ("cash_and_equivalents", r"^bank\s+balances?\s+and\s+cash", 8),
    ("long_term_borrowings", r"^(non[- ]current|long[- ]term)\s+(interest[- ]bearing\s+)?borrowings", 10), ("long_term_borrowings", r"^long[- ]term\s+(debt|liabilities)\b", 8), ("long_term_borrowings", r"^interest[- ]bearing\s+(debt|liabilities)\b", 7),
    ("short_term_borrowings", r"^(current|short[- ]term)\s+(portion\s+of\s+)?(interest[- ]bearing\s+)?borrowings", 10), ("short_term_borrowings", r"^current\s+portion\s+of\s+long[- ]term\s+(debt|borrowings)", 10), ("short_term_borrowings", r"^bank\s+overdrafts?\b", 7),
    ("total_assets", r"^total\s+assets\b", 10), ("total_equity", r"^total\s+equity\b", 10),
    ("capital_expenditure", r"^(additions?\s+to|acquisition\s+of|purchase\s+of)\s+(property,?\s+plant\s+and\s+equipment|PPE)", 10), ("capital_expenditure", r"^capital\s+expenditure", 9), ("capital_expenditure", r"^investment\s+to\s+(maintain|expand)\s+operations", 8),
    ("debt_repayments", r"^repayments?\s+of\s+(borrowings|interest[- ]bearing|long[- ]term\s+debt)", 10), ("debt_repayments", r"^(decrease|reduction)\s+in\s+borrowings", 8),
    ("dividends_paid", r"^dividends?\s+paid\b", 10), ("dividends_paid", r"^distributions?\s+(paid\s+)?to\s+shareholders", 8),
    ("cash_from_operations", r"^(net\s+)?cash\s+(generated|flows?)\s+from\s+operat", 10), ("cash_from_operations", r"^cash\s+generated\s+by\s+operations", 9),
)
STOPWORDS = ("group", "holdings", "limited", "ltd", "plc", "corp", "corporation", "company", "co", "the", "international", "sa", "za")
DOWNLOADABLE = ("pdf", "ppt", "pptx", "xls", "xlsx", "doc", "docx", "zip")
FOLLOW = ("report", "result", "financial", "annual", "interim", "sens", "presentation", "publication", "debt", "investor", "archive", "20 23", "2023", "2024", "2025", "2026")
AVOID = ("mailto:", "javascript:", "/careers", "/contact", "/privacy", "login", "#")
# End of fixed values.


def has(text: Column, pattern: str) -> Column:
    """Case-insensitive search; Java's classes cover Unicode as Python's do."""
    return text.rlike(f"(?iU){pattern}")


def first_of(pairs: list[tuple[Column, Column]], default: Column) -> Column:
    """Value of the first condition that holds."""
    return reduce(lambda rest, p: F.when(p[0], p[1]).otherwise(rest), reversed(pairs), default)


def classify_line_item(label: Column) -> Column:
    """struct(pillar, multiplier, note): exclusions first, then flows, then ceilings; the note names the rule that fits."""
    text = F.lower(F.regexp_replace(label, r"(?U)^\s+|\s+$", ""))
    made = lambda p, m, note: F.struct(F.lit(p).cast("string").alias("pillar"), F.lit(m).cast("double").alias("multiplier"), F.lit(note).alias("note"))
    rules = [(text.rlike("|".join(f"(?:{p})" for p in EXCLUDED)), made(None, None, "excluded"))]
    rules += [(text.rlike(p), made(pillar, m, f"{p}: amount x {m:g}")) for pillar, p, m in FLOWS]
    rules += [(text.rlike("|".join(f"(?:{p})" for p in CEILINGS)), made(CEILING, 1.0, "ceiling only"))]
    return first_of(rules, made(None, None, "no rule"))


def detect_currency(text: Column) -> Column:
    return first_of([(has(text, p), F.lit(c)) for p, c in CURRENCIES], F.lit("ZAR"))


def sheet_scale(text: Column) -> Column:
    return first_of([(F.lower(text).rlike(p), F.lit(m)) for p, m in SHEET_SCALES], F.lit(1.0))


def page_scale(text: Column) -> tuple[Column, Column]:
    """(multiplier, label)"""
    return first_of([(has(text, p), F.lit(m)) for p, m, _ in PAGE_SCALES], F.lit(1.0)), first_of([(has(text, p), F.lit(n)) for p, _, n in PAGE_SCALES], F.lit(UNDECLARED))


def statement_kind(text: Column) -> Column:
    return first_of([(has(text, p), F.lit(n)) for p, n in STATEMENTS], F.lit(None).cast("string"))


def document_scores(text: Column) -> Column:
    """array of struct(score, type), best first; equal scores in the rules' order."""

    def score(base, anchors, boosts, vetoes):
        total = reduce(lambda a, b: a + b, [F.when(has(text, p), w).otherwise(0) for p, w in boosts], F.lit(base))
        ok = has(text, "|".join(f"(?:{p})" for p in anchors))
        return F.when(~has(text, "|".join(f"(?:{p})" for p in vetoes)) & ok if vetoes else ok, total).otherwise(0)

    rows = [F.struct((-score(b, a, w, v)).alias("low"), F.lit(i).alias("place"), F.lit(t).alias("type")) for i, (t, b, a, w, v) in enumerate(DOCUMENT_TYPES)]
    return F.transform(F.array_sort(F.array(*rows)), lambda x: F.struct((-x["low"]).alias("score"), x["type"].alias("type")))


def classify_document(text: Column, min_score: int = 10) -> Column:
    """struct(doc_type, score, runner_up, runner_up_score, ambiguous)"""
    top, second = document_scores(text)[0], document_scores(text)[1]
    ok = top["score"] >= min_score
    runner = F.when(ok, second["score"]).otherwise(0)
    return F.struct(
        F.when(ok, top["type"]).otherwise("UNKNOWN").alias("doc_type"), F.when(ok, top["score"]).otherwise(0).alias("score"),
        F.when(ok, second["type"]).otherwise("UNKNOWN").alias("runner_up"), runner.alias("runner_up_score"),
        ((runner > 0) & (top["score"] - runner <= 3)).alias("ambiguous"),
    )


def match_label(label: Column) -> Column:
    """struct(specificity, concept) of the best label pattern; null if none fits. The first of equals wins."""
    clean = F.regexp_replace(F.regexp_replace(label, r"(?U)\s+", " "), r"^[ .:*†]+|[ .:*†]+$", "")
    hits = F.array(*[F.when(has(clean, p), F.struct(F.lit(s).alias("specificity"), F.lit(-i).alias("place"), F.lit(c).alias("concept"))) for i, (c, p, s) in enumerate(LABELS)])
    return F.array_max(F.filter(hits, lambda x: x.isNotNull()))


def significant_words(name: Column) -> Column:
    words = F.array_distinct(F.regexp_extract_all(F.lower(name), F.lit("[a-z0-9]+"), 0))
    kept = F.array_except(words, F.array(*[F.lit(w) for w in STOPWORDS]))
    return F.when(F.size(kept) > 0, kept).otherwise(words)


def any_of(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])
