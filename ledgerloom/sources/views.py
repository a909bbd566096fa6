"""Test views: the ledgers and external line items, mapped onto the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LABELS = (
    "Foreign exchange gain", "Finance income", "Finance costs paid", "Interest received", "Proceeds from borrowings",
    "Repayment of borrowings", "Borrowings (non-current)", "Investments", "Disposal of subsidiaries", "Trade and other receivables",
    "Trade and other payables", "Cash generated from operations", "Mobile money balances", "Revenue", "Staff costs",
    "Other operating expenses", "Net cash generated from operations", "Income tax paid", "Depreciation", "Revenue growth",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def entity(spark: SparkSession, folder: str) -> DataFrame:
    n, r = table(spark, folder, "nation"), table(spark, folder, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(F.format_string("E%02d", "n_nationkey").alias("entity_id"), F.col("n_name").alias("entity_name"), F.col("r_name").alias("sector"), F.col("n_nationkey").alias("nation"))


def transactional_banking(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").select("o_custkey", F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("amount_zar"), F.substring("o_orderpriority", 1, 1).alias("p"))
    c = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    leg = F.element_at(F.array(*[F.lit(x) for x in ("collections", "supplier_payments", "intercompany_sweeps", "payroll", "tax")]), F.col("p").cast("int"))
    return o.join(c, o.o_custkey == c.c_custkey).join(entity(spark, folder), F.col("c_nationkey") == F.col("nation")).select("entity_id", "entity_name", "sector", "date", leg.alias("leg_type"), "amount_zar")


def trade_finance(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("date"), F.col("l_extendedprice").alias("value_zar"), F.col("l_quantity").cast("int").alias("tenor_days"))
    s = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    return li.join(s, li.l_suppkey == s.s_suppkey).join(entity(spark, folder), F.col("s_nationkey") == F.col("nation")).select("entity_id", "entity_name", "sector", "date", "value_zar", "tenor_days")


def cross_border_payments(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", F.to_date("l_shipdate").alias("date"), F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("value_zar"))
    o, c = table(spark, folder, "orders").select("o_orderkey", "o_custkey"), table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    rows = li.join(s, li.l_suppkey == s.s_suppkey).join(o.join(c, o.o_custkey == c.c_custkey), F.col("l_orderkey") == F.col("o_orderkey")).where("c_nationkey <> s_nationkey")
    return rows.join(entity(spark, folder), F.col("c_nationkey") == F.col("nation")).select("entity_id", "entity_name", "sector", "date", "value_zar")


def external_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items of made-up filings: every label, three years, some restated, negative, zero or of an unknown entity."""
    labels = spark.createDataFrame([(i, x) for i, x in enumerate(LABELS)], "k int, line_item string")
    e = entity(spark, folder).where("nation < 20")
    variant = F.when(F.col("nation") == 19, "Unknown Holdings").otherwise(F.concat(F.lit("The "), "entity_name", F.lit(" Group Limited")))
    rows = e.join(F.broadcast(labels)).withColumn("year", F.explode(F.array(F.lit(2022), F.lit(2023), F.lit(2024)))).where("year < 2024 or nation % 3 <> 0")
    raw = F.when(F.col("k") % 7 == 6, 0).otherwise((F.col("nation") * 37 + F.col("k") * 11 + F.col("year") % 100) * F.when(F.col("k") % 5 == 4, -1).otherwise(1)).cast("double")
    return rows.select(variant.alias("entity_variant"), F.lit("Cash Flow Statement").alias("statement"), "line_item", "year", ((F.col("nation") + F.col("k")) % 11 == 0).alias("restated"), raw.alias("raw_value"), (raw * 1e6).alias("value_zar"))


SQL = """
entity AS (SELECT 'E' || lpad(n_nationkey::VARCHAR, 2, '0') AS entity_id, n_name AS entity_name, r_name AS sector, n_nationkey AS nation
           FROM nation JOIN region ON n_regionkey = r_regionkey),
tb AS (SELECT entity_id, entity_name, sector, o_orderdate::DATE AS date,
              ['collections', 'supplier_payments', 'intercompany_sweeps', 'payroll', 'tax'][left(o_orderpriority, 1)::INT] AS leg_type, o_totalprice AS amount_zar
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN entity ON c_nationkey = nation),
tf AS (SELECT entity_id, entity_name, sector, l_shipdate::DATE AS date, l_extendedprice AS value_zar, l_quantity::INT AS tenor_days
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN entity ON s_nationkey = nation),
xb AS (SELECT entity_id, entity_name, sector, l_shipdate::DATE AS date, round(l_extendedprice * (1 - l_discount), 4) AS value_zar
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN entity ON c_nationkey = nation WHERE c_nationkey <> s_nationkey),
ledger AS (SELECT entity_id, entity_name, sector, 'Transactional Banking' AS pillar, 'transactional_banking' AS source_file, date, abs(amount_zar) AS value_zar FROM tb
           UNION ALL SELECT entity_id, entity_name, sector, 'Transactional Banking', 'trade_finance', date, abs(value_zar) FROM tf
           UNION ALL SELECT entity_id, entity_name, sector, 'Global Markets', 'cross_border_payments', date, abs(value_zar) FROM xb),
labels AS (SELECT * FROM (VALUES """ + ", ".join(f"({i}, '{x}')" for i, x in enumerate(LABELS)) + """) AS t(k, line_item)),
ext AS (SELECT CASE WHEN nation = 19 THEN 'Unknown Holdings' ELSE 'The ' || entity_name || ' Group Limited' END AS entity_variant, line_item, year,
               (nation + k) % 11 = 0 AS restated,
               (CASE WHEN k % 7 = 6 THEN 0 ELSE (nation * 37 + k * 11 + year % 100) * (CASE WHEN k % 5 = 4 THEN -1 ELSE 1 END) END)::DOUBLE AS raw_value, raw_value * 1e6 AS value_zar
        FROM entity, labels, (VALUES (2022), (2023), (2024)) AS y(year) WHERE nation < 20 AND (year < 2024 OR nation % 3 <> 0))
"""
