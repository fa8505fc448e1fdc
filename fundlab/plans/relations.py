"""The engine's relations derived from the driver's tables, in SQL that Spark and DuckDB share."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: A series for each type, status and hundred suppliers: their number grows with the tables.
_SERIES = "p_type || '-' || l_linestatus || CASE WHEN l_suppkey > 100 THEN '-' || CAST(CAST(floor((l_suppkey - 1) / 100) AS INT) AS VARCHAR(12)) ELSE '' END"
#: Relation -> its SQL over the driver's tables. Later ones do not read earlier ones.
RELATIONS = {
    "nav_daily": f"""SELECT {_SERIES} AS scheme_code, CAST(l_shipdate AS DATE) AS nav_date, round(avg(l_extendedprice) + 0.0000137, 4) AS nav
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY {_SERIES}, CAST(l_shipdate AS DATE)""",
    "calendar": "SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem",
    "benchmark_daily": "SELECT 'ALL' AS ticker, CAST(l_shipdate AS DATE) AS date, round(avg(l_extendedprice) + 0.0000137, 4) AS close FROM lineitem GROUP BY CAST(l_shipdate AS DATE)",
    "benchmark_by_ticker": "SELECT l_linestatus AS ticker, CAST(l_shipdate AS DATE) AS date, round(avg(l_extendedprice) + 0.0000137, 4) AS close FROM lineitem GROUP BY l_linestatus, CAST(l_shipdate AS DATE)",
    "scheme_ticker": f"SELECT DISTINCT {_SERIES} AS scheme_code, CASE WHEN p_type LIKE 'S%' THEN NULL ELSE l_linestatus END AS ticker FROM lineitem JOIN part ON l_partkey = p_partkey",
    "rf_observed": """SELECT DISTINCT CAST(l_shipdate AS DATE) AS date, CAST(CASE WHEN month(l_shipdate) % 3 = 0 THEN 6.5 ELSE 0.05 + 0.005 * (month(l_shipdate) % 3) END AS DOUBLE) AS rate
        FROM lineitem WHERE day(l_shipdate) % 7 = 1""",
    "scheme_metrics": """SELECT 'S' || CAST(s_suppkey AS VARCHAR(12)) AS scheme_code, max(r_name) AS canonical_category,
        round(avg(l_discount) * 2, 6) AS ret_3y_median, round(avg(l_tax), 6) AS ret_3y_p25,
        CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE round(avg(l_discount) + avg(l_tax), 6) END AS ret_5y_median,
        CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE round(avg(l_tax) * 0.9, 6) END AS ret_5y_p25,
        CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE round(avg(l_tax) - 0.03, 6) END AS alpha_3y_annualized,
        round(avg(l_quantity) / 25, 6) AS sortino_3y, round(avg(l_quantity) / 25 - 1, 6) AS info_ratio_3y,
        round(CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) / (1 + sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END)), 6) AS capture_efficiency,
        CASE WHEN s_suppkey % 23 = 0 THEN 0.2 ELSE round(0.4 + avg(l_discount) * 8, 6) END AS r_squared_3y,
        CASE WHEN s_suppkey % 29 = 0 THEN 1.9 ELSE round(avg(l_quantity) / 25, 6) END AS beta_3y,
        CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE round(avg(l_tax) * 2, 6) END AS beta_3y_std, round(0.5 + avg(l_discount), 6) AS r_squared_3y_mean,
        CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE round(avg(l_tax) * 2 + 0.5 - avg(l_discount), 6) END AS style_drift_3y,
        CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE round(avg(l_extendedprice) / 1000, 6) END AS active_share_median_1y,
        CASE WHEN s_suppkey % 10 = 1 THEN NULL ELSE round(avg(l_quantity) / 17, 6) END AS ptr_latest,
        CAST(s_suppkey % 12 AS DOUBLE) AS aum_impact_cost_days, round(max(s_acctbal) / 10 + 1000, 2) AS aum_crore, 'House ' || CAST(s_suppkey % 4 AS VARCHAR(12)) AS source_amc,
        CASE WHEN s_suppkey % 17 = 0 THEN 'POOR' WHEN s_suppkey % 19 = 0 THEN 'INSUFFICIENT_HISTORY' ELSE 'GOOD' END AS data_quality_flag,
        'f' || CAST(s_suppkey - s_suppkey % 3 AS VARCHAR(12)) || CASE WHEN s_suppkey % 3 = 2 THEN '_bonus' ELSE '' END AS base_fund_id
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY s_suppkey""",
    "holdings_monthly": """SELECT 'S' || CAST(l_suppkey AS VARCHAR(12)) AS scheme_code, 'ALL' AS ticker, CAST(date_trunc('month', l_shipdate) AS DATE) AS as_of_month,
        p_name || CASE WHEN p_partkey % 2 = 0 THEN ' Ltd.' ELSE ' Limited' END AS security_name, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 'INE' || CAST(1000000 + p_partkey % 400 AS VARCHAR(12)) || '01' END AS isin,
        CASE WHEN p_size % 6 = 0 THEN 'Debt' ELSE 'Equity' END AS instrument_type, sum(l_quantity) AS weight_pct
        FROM lineitem JOIN part ON l_partkey = p_partkey
        GROUP BY l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE), p_name, p_partkey, p_size""",
    "constituents_monthly": """SELECT 'ALL' AS ticker, CAST(date_trunc('month', l_shipdate) AS DATE) AS as_of_month, p_name || ' Inc' AS security_name, sum(l_quantity) AS weight_pct
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY CAST(date_trunc('month', l_shipdate) AS DATE), p_name""",
    "stock_adv_daily": """SELECT 'INE' || CAST(1000000 + l_partkey % 400 AS VARCHAR(12)) || '01' AS isin, CAST(l_shipdate AS DATE) AS date, sum(l_extendedprice) AS total_traded_value
        FROM lineitem WHERE l_partkey % 400 <> 7 GROUP BY l_partkey % 400, CAST(l_shipdate AS DATE)""",
    "scheme_aum_monthly": """SELECT 'S' || CAST(l_suppkey AS VARCHAR(12)) AS scheme_code, CAST(date_trunc('month', l_shipdate) AS DATE) AS as_of_month, round(sum(l_extendedprice) / 1000, 2) AS aum_crore,
        CASE WHEN l_suppkey % 3 = 0 THEN 'sheet' WHEN month(l_shipdate) % 2 = 0 THEN 'aaum' ELSE 'sheet' END AS source_amc
        FROM lineitem GROUP BY l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE), CASE WHEN l_suppkey % 3 = 0 THEN 'sheet' WHEN month(l_shipdate) % 2 = 0 THEN 'aaum' ELSE 'sheet' END""",
    "turnover_monthly": """SELECT 'S' || CAST(l_suppkey AS VARCHAR(12)) AS scheme_code, CAST(date_trunc('month', l_shipdate) AS DATE) AS as_of_month, round(avg(l_quantity) / 20, 6) AS ptr
        FROM lineitem GROUP BY l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE)""",
    "scheme_names": """SELECT 'C' || CAST(c_custkey AS VARCHAR(12)) AS scheme_code,
        CASE c_custkey % 4 WHEN 0 THEN 'Axis Mutual Fund' WHEN 1 THEN 'HDFC  mutual fund' WHEN 2 THEN 'Quant' ELSE 'Bank of India Mutual Fund' END AS amc,
        c_name || CASE c_custkey % 9 WHEN 0 THEN ' Banking & PSU Fund' WHEN 1 THEN ' ESG Integration Fund' WHEN 2 THEN ' Digital India' WHEN 3 THEN ' Health Care Fund' WHEN 4 THEN ' Power and Infra'
            WHEN 5 THEN ' Large & Mid Cap Fund' WHEN 6 THEN ' MNC Fund' WHEN 7 THEN ' Consumption' ELSE ' Flexi Cap' END
          || CASE c_custkey % 5 WHEN 0 THEN ' - Direct Plan - Growth' WHEN 1 THEN ' - Regular Plan - IDCW Payout' WHEN 2 THEN '-Direct Plan-Growth Option' WHEN 3 THEN ' Dividend Yield (Growth)' ELSE '' END AS scheme_name,
        CASE c_custkey % 6 WHEN 0 THEN 'Equity Scheme - Large & Mid Cap Fund' WHEN 1 THEN 'Equity Scheme - ELSS' WHEN 2 THEN 'Hybrid Scheme - Aggressive Hybrid Fund' WHEN 3 THEN 'Equity Scheme - Sectoral/ Thematic' WHEN 4 THEN NULL ELSE 'Debt Scheme - Gilt' END AS amfi_category,
        round(abs(c_acctbal) + 1, 2) AS aum_lakh FROM customer""",
}
#: Rows that one task of a shuffle takes; what holds more than spark.sql.shuffle.partitions of them is dealt to more tasks.
ROWS_A_TASK = 1 << 18
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages")


def tasks(spark: SparkSession, sf_dir: str) -> int | None:
    """The number of tasks for as many rows as lineitem has (read from its files' footers); None: the session's number is enough."""
    n = -(-spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() // ROWS_A_TASK)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def relation(spark: SparkSession, sf_dir: str, name: str, n: int | None = None) -> DataFrame:
    """A relation over the tables of one folder; n: the tasks that lineitem's rows are dealt to by part."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if t in RELATIONS[name]}
    if n and "lineitem" in tables:
        tables["lineitem"] = tables["lineitem"].repartition(n, "l_partkey")
    return spark.sql(re.sub(rf"\b(FROM|JOIN) ({'|'.join(tables)})\b", r"\1 {\2} AS \2", RELATIONS[name]), **tables)


def with_relations(names: list[str], body: str) -> str:
    """DuckDB SQL with the relations as common table expressions."""
    return "WITH " + ", ".join(f"{n} AS ({RELATIONS[n]})" for n in names) + (body if body.startswith(",") else " " + body)
